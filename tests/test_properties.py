"""Property tests: Spark operators against brute-force Python models of the
warehouse SQL on random small inputs."""

import datetime as dt
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ludolake.functions.exact import ratio2
from ludolake.functions.params import with_params
from ludolake.operators import metrics as M

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
D0 = dt.date(2024, 1, 1)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 10**12), st.integers(0, 10**9)), min_size=1, max_size=40))
def test_ratio2_is_exact_half_up(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(ratio2("n", "d")).collect()]
    for (n, d), g in zip(pairs, got):
        if d == 0:
            assert g is None
        else:
            q = Fraction(n, d) * 100
            want = int(q + Fraction(1, 2)) / 100          # floor(q + 1/2), q >= 0
            assert g == want


KEYS = ["a", "b", "c"]
entry = st.tuples(st.sampled_from(KEYS),
                  st.tuples(st.one_of(st.none(), st.text("xyz", max_size=2)),
                            st.one_of(st.none(), st.integers(-5, 5)),
                            st.none()))


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.lists(entry, max_size=4)), min_size=1, max_size=20))
def test_param_lookup_matches_model(spark, arrays):
    rows = [(i, a) for i, a in enumerate(arrays)]
    df = spark.createDataFrame(rows, "id int, event_params array<struct<key:string, value:"
                                     "struct<string_value:string, int_value:bigint, double_value:double>>>")
    outs = [("id", df["id"])] + [(f"{k}_{s}", k, s) for k in KEYS for s in ("string", "int")]
    got = {r["id"]: r for r in with_params(df, outs, strict=False).collect()}
    for i, arr in rows:
        for k in KEYS:
            first = next((v for key, v in (arr or []) if key == k), None)
            assert got[i][f"{k}_string"] == (first[0] if first else None)
            assert got[i][f"{k}_int"] == (first[1] if first else None)


START = "user_pseudo_id string, event_date date, version string, country string, " \
        "event_timestamp bigint, level string"
start_row = st.tuples(st.sampled_from(["u1", "u2", "u3", "u4"]),
                      st.integers(0, 1),
                      st.sampled_from(["1.1", "1.2", None]),
                      st.sampled_from(["1", "2", "3", "5", "02", None]))


def _level_stats(rows):
    stats = {}
    for u, d, v, lvl in rows:
        key = (d, v, int(lvl) if lvl is not None else None)
        stats.setdefault(key, set()).add(u)
    return {k: len(s) for k, s in stats.items()}


@SETTINGS
@given(st.lists(start_row, min_size=1, max_size=30))
def test_drop_final_matches_self_join(spark, rows):
    df = spark.createDataFrame([(u, D0 + dt.timedelta(days=d), v, "VN", i, lvl)
                                for i, (u, d, v, lvl) in enumerate(rows)], START)
    got = {(r.event_date, r.version, r.level): (r.user_start, r.user_start_next_level)
           for r in M.drop_final(df).collect()}
    stats = _level_stats(rows)
    want = {}
    for (d, v, lvl), n in stats.items():
        nxt = None
        if d is not None and v is not None and lvl is not None:
            nxt = stats.get((d, v, lvl + 1))
        if nxt is not None and nxt >= n:
            nxt = n - 1
        want[(D0 + dt.timedelta(days=d), v, lvl)] = (n, nxt)
    assert got == want


@SETTINGS
@given(st.lists(start_row, min_size=1, max_size=30))
def test_drop_rate3_matches_self_join(spark, rows):
    df = spark.createDataFrame([(u, D0 + dt.timedelta(days=d), v, "VN", i, lvl)
                                for i, (u, d, v, lvl) in enumerate(rows)], START)
    got = {(r.event_date, r.version, r.level): (r.user_start, r.user_start_next_level)
           for r in M.drop_rate3(df).collect()}
    firsts = {(d, v, u, int(lvl) if lvl is not None else None) for u, d, v, lvl in rows}
    want = {}
    for (d, v, lvl), n in _level_stats(rows).items():
        cont = {u for (d2, v2, u, l2) in firsts
                if v is not None and lvl is not None and (d2, v2, l2) == (d, v, lvl + 1)
                and (d, v, u, lvl) in firsts}
        want[(D0 + dt.timedelta(days=d), v, lvl)] = (n, len(cont))
    assert got == want


DIMS = "user_pseudo_id string, event_date date, version string, country string"
SESSION = "user_pseudo_id string, version string, country string, event_date date"
users = st.sampled_from(["u1", "u2", "u3"])


@SETTINGS
@given(st.lists(st.tuples(users, st.integers(0, 3)), min_size=1, max_size=6),
       st.lists(st.tuples(users, st.integers(0, 3), st.sampled_from(["1.1", "1.2", None])),
                min_size=1, max_size=10),
       st.lists(st.tuples(users, st.integers(-1, 35)), max_size=15))
def test_cohort_matches_model(spark, fo, ud, ss):
    day = lambda n: D0 + dt.timedelta(days=n)
    first_open = spark.createDataFrame([(u, day(d), None, None) for u, d in fo], DIMS)
    user_data = spark.createDataFrame([(u, day(d), v, "VN") for u, d, v in ud], DIMS)
    sessions = spark.createDataFrame([(u, None, None, day(d)) for u, d in ss], SESSION)
    got = {(r.event_date, r.days_since_first_open, r.version, r.country):
           (r.total_users, r.retained_user) for r in M.cohort(first_open, sessions, user_data).collect()}
    members = {(u, d, v, c) for (u, d) in fo for (u2, d2, v, c) in
               [(a, b, x, "VN") for a, b, x in ud] if u2 == u and d2 == d}
    total = {}
    for u, d, v, c in members:
        total.setdefault((d, v, c), set()).add(u)
    ret = {}
    for u, d, v, c in members:
        if v is None:
            continue
        for u2, sd in ss:
            if u2 == u and 0 <= sd - d <= 30:
                ret.setdefault((d, sd - d, v, c), set()).add(u)
    want = {(day(d), k, v, c): (len(total[(d, v, c)]), len(us)) for (d, k, v, c), us in ret.items()}
    assert got == want


ENGAGE = DIMS + ", ga_session_id bigint, engagement_time_msec bigint"
ADS = DIMS + ", ad_platform string, ad_format string, value double, ad_source string, currency string"
IAP = (DIMS + ", product_id string, price bigint, currency string, quantity bigint, value bigint, "
       "event_value_in_usd double")
dims = st.tuples(users, st.integers(0, 1), st.sampled_from(["1.1", None]))


@SETTINGS
@given(st.lists(dims, min_size=1, max_size=8),
       st.lists(st.tuples(dims, st.sampled_from(["REWARDED", "INTER", "BANNER", None]),
                          st.integers(0, 300)), max_size=10),
       st.lists(st.tuples(dims, st.integers(0, 900)), max_size=6))
def test_revenue_matches_join_model(spark, eng, ads, iap):
    """The warehouse shape: distinct engagement rows LEFT JOIN per-format ad
    sums LEFT JOIN per-user purchase sums, then group; fan-out included."""
    day = lambda n: D0 + dt.timedelta(days=n)
    e_df = spark.createDataFrame([(u, day(d), v, "VN", 1, 1) for u, d, v in eng], ENGAGE)
    a_df = spark.createDataFrame([(u, day(d), v, "VN", "p", f, c / 100, "s", "USD")
                                  for (u, d, v), f, c in ads], ADS)
    i_df = spark.createDataFrame([(u, day(d), v, "VN", "x", 1, "USD", 1, 1, c / 100)
                                  for (u, d, v), c in iap], IAP)
    for corrected in (False, True):
        got = {(r.event_date, r.version): (r.iap_rev, r.ads_rev, r.total_user, r.ad_rw_count,
                                           r.ad_inter_count)
               for r in M.rev_iap_ads3(e_df, a_df, i_df, corrected=corrected).collect()}
        e_rows = {(u, d, v) for u, d, v in eng}
        a_grp, i_grp = {}, {}
        for (u, d, v), f, c in ads:
            a_grp[(u, d, v, f)] = a_grp.get((u, d, v, f), 0) + c
        for (u, d, v), c in iap:
            i_grp[(u, d, v)] = i_grp.get((u, d, v), 0) + c
        want = {}
        for (u, d, v) in e_rows:
            key = (day(d), v)
            iap_c, ads_c, users, rw, inter = want.get(key, (0, 0, set(), set(), set()))
            users.add(u)
            fmts = [(f, c) for (u2, d2, v2, f), c in a_grp.items()
                    if v is not None and (u2, d2, v2) == (u, d, v)]
            paid = i_grp.get((u, d, v), 0) if v is not None else 0
            iap_c += paid * (1 if corrected else max(1, len(fmts)))
            ads_c += sum(c for _, c in fmts)
            rw |= {u for f, _ in fmts if f == "REWARDED"}
            inter |= {u for f, _ in fmts if f == "INTER"}
            want[key] = (iap_c, ads_c, users, rw, inter)
        want = {k: (a / 100, b / 100, len(u), len(r), len(i)) for k, (a, b, u, r, i) in want.items()}
        assert got == want
