"""The versioned warehouse: changed days, dependent days, one pointer."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ludolake.operators import metrics as M
from ludolake.operators.flatten import FLAT_EVENTS, REJECTED
from ludolake.oracle import LATE_DAYS
from ludolake.plans import versions as V
from ludolake.plans.pipeline import FLAT_TABLES, METRICS, derived_sources
from ludolake.queries import arrived_late, with_duplicates
from ludolake.sources.fixture import read_raw
from ludolake.sources.tables import NULL_PARTITION, clustered, table_path, write_table
from tests.conftest import SF_SMALL

NAMES = [m for m, s in METRICS.items() if s.incremental]


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.fixture(scope="module")
def raw(spark):
    return read_raw(spark, SF_SMALL).cache()


@pytest.fixture(scope="module")
def synced(spark, raw, tmp_path_factory):
    """A warehouse synced from the early rows, then from all of them."""
    root = str(tmp_path_factory.mktemp("versions"))
    first = V.sync(spark, arrived_late(raw, before=True), root)
    second = V.sync(spark, raw, root)
    return root, first, second


@pytest.mark.parametrize("name", NAMES)
def test_late_rows_reach_every_metric(spark, raw, synced, name):
    root, first, second = synced
    want = METRICS[name].build(derived_sources(raw))
    assert rows(V.read_version(spark, root, name, columns=want.columns)) == rows(want)
    assert rows(V.read_version(spark, root, name, first, want.columns)) != rows(want)   # the early rows weren't all


@pytest.mark.parametrize("name", FLAT_TABLES)
def test_late_rows_reach_every_flat_table(spark, raw, synced, name):
    root, _, second = synced
    want = derived_sources(raw)(name)
    assert rows(V.version_sources(spark, root, second, raw)(name).select(*want.columns)) == rows(want)


def test_only_dependent_days_are_written(synced):
    _, first, second = synced
    kept = {t: {d for d, w in second.days[t].items() if first.days[t].get(d) == w} for t in NAMES}
    assert kept["dau"] == {d for d in first.days["dau"] if d not in LATE_DAYS} and kept["dau"]
    assert kept["cohort"] == set()             # all are within 30 days of a changed one
    # Days on which users of late first opens start levels, and no others.
    assert kept["winrate2"] < kept["dau"] and kept["winrate2"] != kept["drop_final"]


def test_a_second_run_changes_nothing(spark, raw, synced):
    root, _, second = synced
    again = V.sync(spark, raw, root)
    assert again == second and V.current(spark, root).number == 2
    with pytest.raises(Exception, match="(?i)exist"):
        V.publish(spark, root, V.current(spark, root, 1))       # number 2 is taken


def test_a_failed_refresh_shows_nothing(spark, raw, tmp_path, monkeypatch):
    root = str(tmp_path)
    early = arrived_late(raw, before=True)
    V.sync(spark, early, root, ["dau", "new_user"])
    before = {t: rows(V.read_version(spark, root, t)) for t in ("dau", "new_user", FLAT_EVENTS)}

    def broken(*a, **k):
        raise RuntimeError("stopped")
    with monkeypatch.context() as m:
        m.setattr(V, "publish", broken)
        with pytest.raises(RuntimeError):
            V.sync(spark, raw, root, ["dau", "new_user"])
    assert {t: rows(V.read_version(spark, root, t)) for t in before} == before
    gone = V.vacuum(spark, root, keep=1)
    assert len(gone) == 4 and {t: rows(V.read_version(spark, root, t)) for t in before} == before
    V.sync(spark, raw, root, ["dau", "new_user"])
    assert rows(V.read_version(spark, root, "dau", columns=["event_date", "country", "version", "dau"])) == rows(
        M.dau(derived_sources(raw)("session_start")))
    # The old version stays readable until its folders are removed.
    assert rows(V.read_version(spark, root, "dau", V.current(spark, root, 1))) == before["dau"]


def test_days_that_vanish_and_rows_without_a_day(spark, raw, tmp_path):
    root = str(tmp_path)
    odd = raw.withColumn("date_par", F.when(F.col("date_par") != F.lit(dt.date(2024, 1, 3)), F.col("date_par")))
    v = V.sync(spark, odd, root, ["dau"])
    assert NULL_PARTITION in v.days["dau"] and "2024-01-03" not in v.days["dau"]
    want = METRICS["dau"].build(derived_sources(odd))
    assert rows(V.read_version(spark, root, "dau", columns=want.columns)) == rows(want)
    few = odd.filter("date_par > DATE '2024-01-10'")
    v = V.sync(spark, few, root, ["dau"])
    want = METRICS["dau"].build(derived_sources(few))
    assert rows(V.read_version(spark, root, "dau", columns=want.columns)) == rows(want)
    assert NULL_PARTITION not in v.days["dau"] and min(v.days[FLAT_EVENTS]) == "2024-01-11"
    V.sync(spark, few.limit(0), root, ["dau"])
    assert V.read_version(spark, root, "dau").count() == 0


def test_listing_spares_unchanged_days(spark, raw, tmp_path, monkeypatch):
    export, root = str(tmp_path / "raw"), str(tmp_path / "wh")
    write_table(raw, export, partition="date_par", files_per_date=0)
    from ludolake.sources.tables import read_raw_table
    V.sync(spark, read_raw_table(spark, export), root, ["dau"], raw_path=export)
    asked = []
    inner = V.day_manifest
    monkeypatch.setattr(V, "day_manifest", lambda df, days=None: asked.append(days) or inner(df, days))
    V.sync(spark, read_raw_table(spark, export), root, ["dau"], raw_path=export)
    assert asked == []
    write_table(raw.filter("date_par = DATE '2024-01-04'").limit(5), export, partition="date_par", mode="append",
                files_per_date=0)
    V.sync(spark, read_raw_table(spark, export), root, ["dau"], raw_path=export)
    assert asked == [{"2024-01-04"}]


# -------------------------------------------------------------------- winrate2
def test_only_days_of_changed_users_are_looked_up(spark):
    keys = "user_pseudo_id string, event_date date, version string, country string, event_timestamp long, level string"
    day = [dt.date(2024, 1, 1 + k) for k in range(9)]
    starts = spark.createDataFrame([("a", day[1], "1", "X", 1, "1"), ("a", day[4], "1", "X", 1, "1"),
                                    ("b", day[2], "1", "X", 1, "1"), ("c", day[3], "1", "X", 1, "1")], keys)
    opens = lambda *users: spark.createDataFrame([(u, d, "1", "X", 1, "1") for u, d in users], keys)
    of = lambda first: lambda name: {"first_open": first, "start_level": starts}[name]
    changed = {str(day[0])}
    old = of(opens(("b", day[0]), ("c", day[0]), ("c", day[5])))
    # a comes, b goes, c has another first open elsewhere.
    assert V.starter_days(old, of(opens(("a", day[0]), ("c", day[5]))), changed) == {str(day[k]) for k in (1, 2, 4)}
    assert V.starter_days(old, old, changed) == set() and V.starter_days(None, old, changed) == set()


# -------------------------------------------------------------------- rejects
def test_rejects_are_kept_apart_and_limited(spark, raw, tmp_path):
    root, bad = str(tmp_path), with_duplicates(raw)
    with pytest.raises(ValueError, match="duplicated parameter"):
        V.sync(spark, bad, root, ["dau"])
    assert V.current(spark, root).number == 0
    v = V.sync(spark, bad, root, ["dau"], max_rejects=10**6)
    rejects = V.read_rejects(spark, root, v)
    n = rejects.count()
    assert n > 0 and rejects.filter("event_name != 'start_level' OR key != 'level' OR times != 2").count() == 0
    sources = V.version_sources(spark, root, v, bad)
    good = derived_sources(raw)("start_level").count()
    assert sources("start_level").count() == good - n
    wide = V.read_version(spark, root, FLAT_EVENTS, v)
    assert wide.filter(F.col("event_name") == REJECTED).count() == n
    # Without duplicates nothing is set aside, and a key that no table reads is no reason.
    extra = raw.withColumn("event_params", F.concat("event_params", F.filter("event_params", lambda p: p["key"] == "ga_session_id")))
    from ludolake.operators.flatten import flatten_all, rejects_view
    assert rejects_view(flatten_all(extra.filter("event_name = 'session_start'"), rejects=True)).count() == 0
    assert rejects_view(flatten_all(extra.filter("event_name = 'user_engagement'"), rejects=True)).count() > 0


# ----------------------------------------------------------------- clustering
def files_of(df):
    return {r[0] for r in df.select("_metadata.file_path").distinct().collect()}


def test_version_filter_skips_whole_files(spark, tmp_path):
    days = spark.range(40000).select(
        F.when(F.col("id") % 4 == 0, F.lit(dt.date(2024, 1, 2))).otherwise(F.lit(dt.date(2024, 1, 1))).alias("event_date"),
        F.when(F.col("id") % 3 == 0, F.lit("1.0")).otherwise(
            F.concat(F.lit("2."), F.col("id") % 50)).alias("version"),
        F.when(F.col("id") % 7 > 0, F.col("id")).alias("value"))
    path = table_path(str(tmp_path), "t")
    write_table(days.repartition(8), path, ["version"], rows_per_file=1000)
    table = spark.read.parquet(path)
    assert rows(table.select(*days.columns)) == rows(days)
    one = F.col("event_date") == F.lit(dt.date(2024, 1, 1))
    every = files_of(table.filter(one))
    assert 20 < len(every) < 50
    ranges = table.filter(one).groupBy("_metadata.file_path").agg(
        F.min("version").alias("a"), F.max("version").alias("b"), F.count("*").alias("n")).collect()
    hit = [r for r in ranges if r["a"] <= "2.17" <= r["b"]]
    assert len(hit) <= 2 and max(r["n"] for r in ranges) < 3500
    hot = [r for r in ranges if r["a"] <= "1.0" <= r["b"]]
    assert len(hot) >= 8                       # a third of all rows, in many files
    # Spark itself opens only those row groups.
    read = table.filter(one & (F.col("version") == "2.17"))
    assert read.count() == days.filter(one & (F.col("version") == "2.17")).count()


def test_small_partitions_share_a_task(spark):
    df = spark.range(300).select((F.col("id") % 30).cast("string").alias("p"), (F.col("id") % 7).alias("k"))
    out = clustered(df, ["p"], ["k"], 100)
    assert out.rdd.getNumPartitions() < 8 and rows(out) == rows(df)
    nothing = clustered(df.limit(0), ["p"], ["k"], 100)
    assert nothing.count() == 0


# --------------------------------------------------------------- cohort intervals
def test_a_user_of_three_thousand_days(spark):
    keys = "user_pseudo_id string, event_date date, version string, country string"
    start = dt.date(2015, 1, 1)
    days = [start + dt.timedelta(days=k) for k in range(3000)]
    frame = spark.createDataFrame([("u", d, "1", "X") for d in days], keys)
    opens = spark.createDataFrame([("u", days[k], "1", "X") for k in (0, 30, 31, 1000, 2980)], keys)
    out = M.cohort(opens, frame, frame)
    got = sorted((str(r["event_date"]), r["days_since_first_open"], r["retained_user"]) for r in out.collect())
    assert got == sorted((str(days[k]), n, 1) for k in (0, 30, 31, 1000, 2980) for n in range(31) if k + n < 3000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "interval" in plan.split("SortMergeJoin [user_pseudo_id")[1].split("]")[0]


def test_playtime_multiplies_no_raw_rows(spark, raw):
    plan = METRICS["playtime"].build(derived_sources(raw))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Generate explode") >= 1


def test_command_line_sync(spark, raw, tmp_path, monkeypatch):
    from ludolake import __main__ as cli
    export, root = str(tmp_path / "raw"), str(tmp_path / "wh")
    write_table(raw, export, partition="date_par", files_per_date=0)
    monkeypatch.setattr(cli, "configure", lambda s: spark)
    cli.main(["sync", "--raw", export, "--root", root, "--metrics", "dau", "--rows-per-file", "50"])
    cli.main(["vacuum", "--raw", export, "--root", root])
    want = METRICS["dau"].build(derived_sources(raw))
    assert rows(V.read_version(spark, root, "dau", columns=want.columns)) == rows(want)
