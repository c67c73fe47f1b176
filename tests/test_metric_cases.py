"""Metric semantics on hand-made flat tables (FIXTURES.md §3)."""

import datetime as dt

import pytest

from ludolake.operators import metrics as M

D = dt.date(2024, 1, 1)
DIMS = "user_pseudo_id string, event_date date, version string, country string"
START = DIMS + ", event_timestamp bigint, level string"
WINLOSE = DIMS + ", level string"
BOOSTER = DIMS + ", level bigint, booster_type string"
ENGAGE = DIMS + ", ga_session_id bigint, engagement_time_msec bigint"
ADS = (DIMS + ", ad_platform string, ad_format string, value double, ad_source string, "
       "currency string")
IAP = (DIMS + ", product_id string, price bigint, currency string, quantity bigint, "
       "value bigint, event_value_in_usd double")
SESSION = "user_pseudo_id string, version string, country string, event_date date"


def day(n):
    return D + dt.timedelta(days=n)


def df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def by(rows, *keys):
    if len(keys) == 1:
        return {r[keys[0]]: r for r in rows}
    return {tuple(r[k] for k in keys): r for r in rows}


# ----------------------------------------------------------------------- cohort
def test_cohort_day_limits_and_membership(spark):
    fo = df(spark, [("a", day(0), "1.1", "VN"), ("b", day(0), "1.1", "VN"),
                    ("b", day(2), "1.1", "VN")], DIMS)
    ud = df(spark, [("a", day(0), "1.1", "VN"), ("b", day(0), "1.1", "VN"),
                    ("b", day(0), "1.2", "VN"), ("b", day(2), "1.1", "VN")], DIMS)
    sess = df(spark, [("a", "1.1", "VN", day(-1)), ("a", "1.1", "VN", day(0)),
                      ("a", "1.1", "VN", day(30)), ("a", "1.1", "VN", day(31)),
                      ("b", "1.1", "VN", day(2))], SESSION)
    rows = M.cohort(fo, sess, ud).collect()
    got = {(r.event_date, r.version, r.days_since_first_open): (r.retained_user, r.total_users)
           for r in rows}
    assert got == {
        (day(0), "1.1", 0): (1, 2),     # a on day 0 (b had no session on day 0)
        (day(0), "1.1", 30): (1, 2),    # a on day 30; -1 and 31 are out
        (day(0), "1.1", 2): (1, 2),     # b's day-2 session counts for the day-0 cohort
        (day(0), "1.2", 2): (1, 1),     # b also counted under its second version
        (day(2), "1.1", 0): (1, 1),     # b's second first_open: a second cohort
    }
    assert all(0 <= r.retention_rate <= 100 for r in rows)


def test_cohort_drops_null_version_or_country(spark):
    fo = df(spark, [("a", day(0), None, None)], DIMS)
    ud = df(spark, [("a", day(0), None, "VN")], DIMS)
    sess = df(spark, [("a", None, "VN", day(0))], SESSION)
    assert M.cohort(fo, sess, ud).count() == 0


# ----------------------------------------------------------------- revenue/reach
def test_iap_fan_out_and_corrected(spark):
    eng = df(spark, [("a", day(0), "1.1", "VN", 1, 10)], ENGAGE)
    ads = df(spark, [("a", day(0), "1.1", "VN", "p", "REWARDED", 0.5, "s", "USD"),
                     ("a", day(0), "1.1", "VN", "p", "INTER", 0.25, "s", "USD")], ADS)
    iap = df(spark, [("a", day(0), "1.1", "VN", "x", 1000, "USD", 1, 1000, 10.0)], IAP)
    r = M.rev_iap_ads3(eng, ads, iap).first()
    assert (r.iap_rev, r.ads_rev, r.total_revenue) == (20.0, 0.75, 20.75)
    assert (r.total_user, r.ad_rw_count, r.ad_inter_count) == (1, 1, 1)
    c = M.rev_iap_ads3(eng, ads, iap, corrected=True).first()
    assert (c.iap_rev, c.ads_rev, c.total_revenue) == (10.0, 0.75, 10.75)


def test_revenue_without_engagement_is_not_counted(spark):
    eng = df(spark, [("a", day(0), "1.1", "VN", 1, 10), ("n", day(0), None, "VN", 1, 10)], ENGAGE)
    ads = df(spark, [], ADS)
    iap = df(spark, [("b", day(0), "1.1", "VN", "x", 1, "USD", 1, 1, 5.0),
                     ("n", day(0), None, "VN", "x", 1, "USD", 1, 1, 5.0)], IAP)
    rows = by(M.rev_iap_ads3(eng, ads, iap).collect(), "version")
    assert rows["1.1"].iap_rev == 0.0 and rows["1.1"].total_user == 1
    assert rows[None].iap_rev == 0.0      # NULL version never joins


def test_ads_reach_counts_each_user_once(spark):
    eng = df(spark, [("a", day(0), "1.1", "VN", 1, 10), ("a", day(0), "1.1", "VN", 2, 10),
                     ("b", day(0), "1.1", "VN", 3, 10)], ENGAGE)
    ads = df(spark, [("a", day(0), "1.1", "VN", "p", "REWARDED", 1.0, "s", "USD"),
                     ("a", day(0), "1.1", "VN", "p", "REWARDED", 1.0, "s", "USD"),
                     ("b", day(0), "1.1", "VN", "p", "BANNER", 1.0, "s", "USD")], ADS)
    r = M.ads_inter_rw_cnt(eng, ads).first()
    assert (r.total_user, r.ad_rw_count, r.ad_inter_count) == (2, 1, 0)


# --------------------------------------------------------------------- winrate
def test_winrate_win_and_loss_and_no_outcome(spark):
    fo = df(spark, [("a", day(0), "1.1", "VN"), ("b", day(0), "1.1", "VN")], DIMS)
    st = df(spark, [("a", day(0), "1.1", "VN", 1, "1"), ("b", day(0), "1.1", "VN", 2, "2"),
                    ("z", day(0), "1.1", "VN", 3, "1")], START)      # z: no first_open
    win = df(spark, [("a", day(0), "1.1", "VN", "1")], WINLOSE)
    lose = df(spark, [("a", day(0), "1.1", "VN", "1")], WINLOSE)
    rows = by(M.winrate2(st, win, lose, fo).collect(), "level")
    assert (rows[1].user_start, rows[1].event_win, rows[1].event_lose, rows[1].winrate) == (1, 1, 1, 50.0)
    assert rows[2].winrate is None and rows[2].user_start == 1


def test_level_string_forms(spark):
    fo = df(spark, [("a", day(0), "1.1", "VN")], DIMS)
    st = df(spark, [("a", day(0), "1.1", "VN", 1, "1"), ("a", day(0), "1.1", "VN", 2, "01"),
                    ("a", day(0), "1.1", "VN", 3, "x")], START)
    empty = df(spark, [], WINLOSE)
    w = M.winrate2(st, empty, empty, fo).collect()
    assert by(w, "level")[1].user_start == 2 and by(w, "level")[None].user_start == 1
    assert len(w) == 2
    lb = M.level_booster2(st, df(spark, [], BOOSTER)).collect()
    assert by(lb, "level")[1].user_start == 1 and len(lb) == 2
    with pytest.raises(Exception, match="cannot cast level"):
        M.drop_final(st).collect()
    ok = st.filter("level <> 'x'")
    d = M.drop_final(ok).collect()
    assert len(d) == 1 and d[0].user_start == 1


def test_level_booster_null_when_no_booster(spark):
    st = df(spark, [("a", day(0), "1.1", "VN", 1, "1"), ("a", day(0), "1.1", "VN", 1, "2")], START)
    bo = df(spark, [("a", day(0), "1.1", "VN", 1, "b1"), ("a", day(0), "1.1", "VN", 1, "b2"),
                    ("a", day(0), "1.1", "VN", 9, "b1")], BOOSTER)
    rows = by(M.level_booster2(st, bo).collect(), "level")
    assert rows[1].num_booster == 2 and rows[2].num_booster is None and 9 not in rows
    bt = by(M.booster_type(bo).collect(), "booster_type")
    assert bt["b1"].num_booster_used == 2 and bt["b2"].num_booster_used == 1


# ---------------------------------------------------------------------- drops
def _starts(spark, counts, version="1.1"):
    rows, i = [], 0
    for level, n in counts.items():
        for u in range(n):
            rows.append((f"u{u}", day(0), version, "VN", i, str(level)))
            i += 1
    return df(spark, rows, START)


def test_drop_clamp_gap_and_null_version(spark):
    rows = by(M.drop_final(_starts(spark, {1: 5, 2: 7, 4: 1})).collect(), "level")
    assert rows[1].user_start_next_level == 4        # 7 >= 5: clamped to 5 - 1
    assert rows[2].user_start_next_level is None     # level 3 missing: gap
    rows = by(M.drop_final(_starts(spark, {1: 1, 2: 1})).collect(), "level")
    assert rows[1].user_start_next_level == 0        # 1 >= 1: clamped to 0
    rows = by(M.drop_final(_starts(spark, {1: 5, 2: 3}, version=None)).collect(), "level")
    assert rows[1].user_start_next_level is None     # NULL version never joins


def test_drop_rate_is_user_level(spark):
    st = df(spark, [("a", day(0), "1.1", "VN", 1, "1"), ("a", day(0), "1.1", "VN", 2, "2"),
                    ("b", day(0), "1.1", "VN", 3, "1"), ("c", day(0), "1.1", "VN", 4, "2"),
                    ("a", day(0), "1.1", "VN", 5, "1")], START)
    rows = by(M.drop_rate3(st).collect(), "level")
    assert (rows[1].user_start, rows[1].user_start_next_level, rows[1].retention_rate) == (2, 1, 50.0)
    assert rows[2].user_start_next_level == 0 and rows[2].retention_rate == 0.0


# -------------------------------------------------------------- distinct counts
def test_new_user_dau_distinct_and_null_groups(spark):
    fo = df(spark, [("a", day(0), None, "VN"), ("a", day(0), None, "VN"), (None, day(0), None, "VN"),
                    ("b", day(0), "1.1", "VN")], DIMS)
    rows = by(M.new_user(fo).collect(), "version")
    assert rows[None].new_user == 1 and rows["1.1"].new_user == 1
    ss = df(spark, [("a", "1.1", "VN", day(0)), ("a", "1.1", "VN", day(0))], SESSION)
    assert M.dau(ss).first().dau == 1


def test_playtime_counts_sessions_not_per_user(spark):
    from ludolake.schemas import RAW_SCHEMA

    def ev(user, name, sid, ms):
        params = [("ga_session_id", (None, sid, None))]
        if ms is not None:
            params.append(("engagement_time_msec", (None, ms, None)))
        return (user, name, "20240101", day(0), 0, "1.1", "VN", "IOS", None, params)

    raw = spark.createDataFrame([ev("a", "user_engagement", 7, 60_000),
                                 ev("b", "user_engagement", 7, 30_000),
                                 ev("b", "screen_view", 8, 0),
                                 ev("b", "session_start", 9, None),
                                 ev("b", "win_level", 10, 1_000)], RAW_SCHEMA)
    r = M.playtime(raw, extra=True).first()
    assert r.total_sessions == 2            # ids 7 (shared) and 8; 9 has no time; win_level ignored
    assert r.avg_session_length_minutes == 0.5       # 90000 ms / 3 rows / 60000
    assert r.avg_sessions_per_user == 1.0
    assert r.avg_playtime_per_user_minutes == 0.75   # 90000 / 2 users / 60000
    assert r.cohort_size == 2
