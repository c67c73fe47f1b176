"""Queries that read raw several times read a written export, derived once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ludolake import queries as Q
from ludolake.sources.fixture import ALL_EVENTS, read_raw

DAYS = [dt.datetime(2024, 1, d, 3, 4, 5) for d in (1, 5, 9, 15, 21, 26)]
KINDS = ["signup", "view", "click", "purchase", "error", None]


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.fixture(scope="module")
def events_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("written_raw"))
    made = [(i, DAYS[i % 6] if i % 29 else None, i % 17 if i % 23 else None, KINDS[i // 6 % 6],
             i / 8 if i % 7 else None, f'{{"k": {i % 100}}}' if i % 31 else None) for i in range(240)]
    made += made[:20]
    (spark.createDataFrame(made, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
     .coalesce(2).write.parquet(f"{d}/events.parquet"))
    return d


def seen_by(monkeypatch, module, name, at):
    """The raw rows that each call of a function was given."""
    seen, real = [], getattr(module, name)

    def call(*args, **kw):
        seen.append(args[at])
        return real(*args, **kw)
    monkeypatch.setattr(module, name, call)
    return seen


def test_batches_of_states_are_read_from_files_of_their_own(spark, events_dir, monkeypatch):
    seen = seen_by(monkeypatch, Q.states, "merge_batch", 1)
    got = Q.states_rev_iap_ads3(spark, events_dir)
    files = [{r[0] for r in b.select(F.input_file_name()).distinct().collect()} for b in seen]
    assert all(files) and len(set.union(*files)) == sum(map(len, files))
    assert all("/batch=" in f for x in files for f in x)
    assert rows(seen[0].unionByName(seen[1]).unionByName(seen[2])) == rows(read_raw(spark, events_dir))
    assert rows(got) == rows(Q.metric_query("rev_iap_ads3")(spark, events_dir))


def test_attempts_read_a_batch_once(spark, events_dir):
    raw = read_raw(spark, events_dir)
    raw.write.parquet(path := f"{events_dir}/raw")
    plan = Q.states._attempts(spark.read.schema(raw.schema).parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_each_event_has_the_rows_it_has_alone(spark, events_dir):
    raw = read_raw(spark, events_dir)
    for name in ALL_EVENTS:
        assert rows(raw.filter(F.col("event_name") == name)) == rows(read_raw(spark, events_dir, [name])), name


def test_the_lookback_reads_a_written_export(spark, events_dir, monkeypatch):
    seen = seen_by(monkeypatch, Q.refresh, "build_flat", 1)
    Q.cohort_lookback_short(spark, events_dir)
    assert all("/raw/date_par=" in f for f in seen[0].inputFiles())


@pytest.mark.parametrize("query", ["append_changed_days", "winrate2_refresh"])
def test_syncs_read_a_written_export(spark, events_dir, monkeypatch, query):
    seen = seen_by(monkeypatch, Q.versions, "sync", 1)
    Q.all_queries()[query](spark, events_dir)
    assert len(seen) == 2 and all("/raw/date_par=" in f for raw in seen for f in raw.inputFiles())
    assert rows(seen[1]) == rows(read_raw(spark, events_dir))
