"""Table schemas of the three layers: raw events, flat tables, metric tables.

Column orders and cluster keys are fixed values: the output tables must keep
the same columns, in the same order, as the dashboards that read them.
"""

from __future__ import annotations

from pyspark.sql import types as T

PARAM_VALUE = T.StructType([
    T.StructField("string_value", T.StringType()),
    T.StructField("int_value", T.LongType()),
    T.StructField("double_value", T.DoubleType()),
])

EVENT_PARAM = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", PARAM_VALUE),
])

# The raw export: one row per event, parameters as a key/value array.
# ``event_date`` is the export's yyyyMMdd string; ``date_par`` is the DATE
# partition column that becomes ``event_date`` in every table downstream.
RAW_SCHEMA = T.StructType([
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("event_date", T.StringType()),
    T.StructField("date_par", T.DateType()),
    T.StructField("event_timestamp", T.LongType()),
    T.StructField("version", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("event_value_in_usd", T.DoubleType()),
    T.StructField("event_params", T.ArrayType(EVENT_PARAM)),
])

# --- fixed values: metric table column orders and cluster keys -------------
METRIC_COLUMNS = {
    "new_user": ["event_date", "country", "version", "new_user"],
    "dau": ["event_date", "country", "version", "dau"],
    "playtime": ["version", "event_date", "platform", "country", "total_sessions",
                 "avg_session_length_minutes", "avg_sessions_per_user",
                 "avg_playtime_per_user_minutes"],
    "cohort": ["event_date", "days_since_first_open", "version", "country",
               "total_users", "retained_user", "retention_rate"],
    "rev_iap_ads3": ["event_date", "version", "country", "iap_rev", "ads_rev",
                     "total_revenue", "total_user", "ad_rw_count", "ad_inter_count"],
    "winrate2": ["event_date", "version", "level", "user_start", "event_win",
                 "event_lose", "winrate"],
    "level_booster2": ["event_date", "version", "level", "num_booster", "user_start"],
    "booster_type": ["event_date", "version", "booster_type", "num_booster_used"],
    "ads_inter_rw_cnt": ["event_date", "version", "country", "total_user",
                         "ad_rw_count", "ad_inter_count"],
    "drop_final": ["event_date", "version", "level", "user_start", "user_start_next_level"],
    "drop_rate3": ["event_date", "version", "level", "user_start",
                   "user_start_next_level", "retention_rate"],
}

METRIC_CLUSTER = {
    "new_user": ["country", "version"],
    "dau": ["country", "version"],
    "playtime": ["country", "version", "platform"],
    "cohort": ["country", "version"],
    "rev_iap_ads3": ["version", "country"],
    "winrate2": ["version"],
    "level_booster2": ["level", "version"],
    "booster_type": ["version"],
    "ads_inter_rw_cnt": ["country", "version"],
    "drop_final": ["level", "version"],
    "drop_rate3": ["version"],
}
# -----------------------------------------------------------------------------
