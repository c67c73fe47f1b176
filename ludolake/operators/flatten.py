"""Raw → flat: one narrow table per event name.

Each flat table is ``filter(event_name = X)`` plus a projection of the event's
dimensions and its typed parameters. Stateless and row-wise: one map stage;
reading a raw Parquet table, the event-name filter and the column selection
reach the scan (``PushedFilters``, nested ``ReadSchema``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.params import with_params


@dataclass(frozen=True)
class P:
    """An extracted parameter: key and the value slot it is read from."""
    key: str
    slot: str


@dataclass(frozen=True)
class Lit:
    """A literal output column."""
    name: str
    value: str


DATE = "event_date"   # stands for ``date_par AS event_date``


@dataclass(frozen=True)
class FlatSpec:
    table: str
    event: str
    columns: list = field(default_factory=list)
    cluster: list = field(default_factory=list)

    def column_names(self) -> list[str]:
        out = []
        for c in self.columns:
            out.append(c.key if isinstance(c, P) else c.name if isinstance(c, Lit) else c)
        return out


# --- fixed values: the flat tables, their columns (in order) and cluster keys
_DIMS = ["user_pseudo_id", DATE, "version", "country"]
FLAT_SPECS: dict[str, FlatSpec] = {s.table: s for s in [
    FlatSpec("start_level", "start_level",
             _DIMS + ["event_timestamp", P("level", "string")],
             ["level", "version", "country"]),
    FlatSpec("revive_level", "revive_level",
             ["user_pseudo_id", DATE, P("level", "string"), P("percent", "string"),
              P("lose_type", "string")],
             ["level"]),
    FlatSpec("win_level", "win_level", _DIMS + [P("level", "string")],
             ["level", "version", "country"]),
    FlatSpec("lose_level", "lose_level", _DIMS + [P("level", "string")],
             ["level", "version", "country"]),
    FlatSpec("booster_used", "booster_used",
             _DIMS + [P("level", "int"), P("booster_type", "string")],
             ["level", "booster_type", "version", "country"]),
    FlatSpec("in_app_purchase", "in_app_purchase",
             _DIMS + [P("product_id", "string"), P("price", "int"), P("currency", "string"),
                      P("quantity", "int"), P("value", "int"), "event_value_in_usd"]),
    FlatSpec("ad_impression", "ad_impression",
             _DIMS + [P("ad_platform", "string"), P("ad_format", "string"),
                      P("value", "double"), P("ad_source", "string"), P("currency", "string")],
             ["ad_platform", "version", "country"]),
    FlatSpec("ads_reward_complete", "ads_reward_complete",
             _DIMS + [P("placement", "string")]),
    FlatSpec("first_open", "first_open", _DIMS),
    FlatSpec("session_start", "session_start",
             ["user_pseudo_id", "version", "country", DATE]),
    FlatSpec("app_remove", "app_remove",
             [Lit("event_name", "app_remove"), "user_pseudo_id", DATE]),
    FlatSpec("user_engagement", "user_engagement",
             _DIMS + [P("ga_session_id", "int"), P("engagement_time_msec", "int")]),
]}
USER_DATA_COLUMNS = ["user_pseudo_id", "event_date", "version", "country"]
# -----------------------------------------------------------------------------


def _output(c) -> tuple:
    if isinstance(c, P):
        return (c.key, c.key, c.slot)
    if isinstance(c, Lit):
        return (c.name, F.lit(c.value))
    if c == DATE:
        return ("event_date", F.col("date_par"))
    return (c, F.col(c))


def flatten(raw: DataFrame, table: str, strict: bool = True) -> DataFrame:
    """The flat table ``table`` computed from the raw event table."""
    spec = FLAT_SPECS[table]
    return with_params(raw.filter(F.col("event_name") == F.lit(spec.event)),
                       [_output(c) for c in spec.columns], strict=strict)


def user_data(raw: DataFrame) -> DataFrame:
    """Distinct (user, day, version, country) over all events.

    The cohort metric reads this table; no builder for it exists upstream, so
    this definition is ours. Partial aggregation before the shuffle bounds
    what any hot user sends to one reducer.
    """
    return (raw.select("user_pseudo_id", F.col("date_par").alias("event_date"),
                       "version", "country")
            .distinct())


# ----------------------------------------------------------- single-pass layer
FLAT_EVENTS = "flat_events"
# Sort keys inside each (day, event) partition: every flat table's cluster
# keys appear in its own order; columns another event leaves NULL cost nothing.
WIDE_SORT = ["level__string", "level__int", "booster_type__string",
             "ad_platform__string", "version", "country"]


def wide_name(p: P) -> str:
    return f"{p.key}__{p.slot}"


def _readers() -> tuple[dict[str, set], dict[P, set]]:
    plain: dict[str, set] = {}
    params: dict[P, set] = {}
    for spec in FLAT_SPECS.values():
        for c in spec.columns:
            if isinstance(c, P):
                params.setdefault(c, set()).add(spec.event)
            elif not isinstance(c, Lit) and c != DATE:
                plain.setdefault(c, set()).add(spec.event)
    return plain, params


#: Stands for the event name of rows that were kept out of the flat tables.
REJECTED = "_rejected"


def _duplicates() -> Column:
    """Per row: the parameters that its flat table reads and that occur more
    than once, with how often. A row whose keys are all distinct, as nearly
    all are, pays one ``array_distinct``."""
    keys = F.col("event_params")["key"]
    wanted = None
    for event in sorted({s.event for s in FLAT_SPECS.values()}):
        names = [F.lit(c.key) for s in FLAT_SPECS.values() if s.event == event for c in s.columns if isinstance(c, P)]
        if names:
            cond, listed = F.col("event_name") == F.lit(event), F.array(*names)
            wanted = F.when(cond, listed) if wanted is None else wanted.when(cond, listed)
    counted = F.transform(wanted, lambda k: F.struct(
        k.alias("key"), F.size(F.filter(keys, lambda x: x == k)).alias("times")))
    some = F.filter(counted, lambda c: c["times"] > 1)
    several = (F.size(keys) > 1) & (F.size(F.array_distinct(keys)) < F.size(keys))
    return F.when(several & (F.size(some) > 0), some)


def rejects_view(wide: DataFrame) -> DataFrame:
    """The rejected rows of the single-pass layer, one for each duplicated key."""
    return (wide.filter(F.col("event_name") == F.lit(REJECTED))
            .select("user_pseudo_id", F.col("rejected_event").alias("event_name"), "event_date", "event_timestamp",
                    F.explode("rejected").alias("r"))
            .select("user_pseudo_id", "event_name", "event_date", "event_timestamp", "r.key", "r.times"))


def flatten_all(raw: DataFrame, strict: bool = True, rejects: bool = False) -> DataFrame:
    """All flat tables in one pass over the raw table.

    One row per event of a flattened kind: ``event_name``, ``event_date``,
    the raw columns any flat table keeps, and one ``<key>__<slot>`` column
    per extracted parameter, filled only for the events whose table reads
    it. ``flat_view`` turns it back into each table. Reading raw once
    instead of once per table matters when raw is not sorted by event name.

    ``rejects``: a row in which a parameter that its table reads occurs more
    than once gets the event name ``REJECTED`` (so no flat table holds it), its
    own one in ``rejected_event`` and the keys in ``rejected``. The good rows
    and the bad ones are written in the same pass, and one bad row doesn't stop
    the job.
    """
    events = sorted({s.event for s in FLAT_SPECS.values()})
    name = F.col("event_name")
    plain, params = _readers()
    outputs: list[tuple] = [("event_name", name), ("event_date", F.col("date_par"))]
    for c, evs in plain.items():
        col = F.col(c) if len(evs) == len(events) else F.when(name.isin(sorted(evs)), F.col(c))
        outputs.append((c, col))
    for p, evs in params.items():
        outputs.append((wide_name(p), p.key, p.slot, name.isin(sorted(evs))))
    rows = raw.filter(name.isin(events))
    if not rejects:
        return with_params(rows, outputs, strict=strict)
    # The time tells rejected rows apart, whatever their event.
    outputs = [("event_timestamp", F.col(c)) if c == "event_timestamp" else (c, *x) for c, *x in outputs]
    bad = F.col("rejected").isNotNull()
    return (with_params(rows, [*outputs, ("rejected", _duplicates())], strict=False)
            .withColumn("rejected_event", F.when(bad, F.col("event_name")))
            .withColumn("event_name", F.when(bad, F.lit(REJECTED)).otherwise(F.col("event_name")))
            .withColumn("event_timestamp", F.when(bad | F.col("event_name").isin(sorted(plain["event_timestamp"])),
                                                  F.col("event_timestamp"))))


def flat_view(wide: DataFrame, table: str) -> DataFrame:
    """Flat table ``table`` read from the single-pass layer."""
    spec = FLAT_SPECS[table]
    cols = []
    for c in spec.columns:
        if isinstance(c, P):
            cols.append(F.col(wide_name(c)).alias(c.key))
        elif isinstance(c, Lit):
            cols.append(F.lit(c.value).alias(c.name))
        else:
            cols.append(F.col(c))
    return wide.filter(F.col("event_name") == F.lit(spec.event)).select(*cols)
