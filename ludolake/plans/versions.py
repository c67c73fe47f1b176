"""A warehouse whose tables change together: staged writes and one pointer.

A refresh writes the days it recomputes into new folders that no reader knows
(``<root>/<table>/write=<id>/event_date=...``). When every table is written, one
small file, ``<root>/_versions/<number>.json``, says for each table which folder
holds each day. Readers resolve the newest such file, so they see all tables
before a refresh or all after it, never a mix, and a failed refresh leaves
nothing but folders that ``vacuum`` removes. The file grows with tables x days.

``sync`` is the scheduled job: it finds the raw days that have changed since the
current version, recomputes exactly what depends on them and publishes.

* **Changed days.** The version keeps a manifest: rows and an order-free hash
  of each raw day (and its file listing, so days whose files are the same
  aren't read at all). Late rows for a day at or below any mark change its
  hash, so a partly loaded day is completed, not lost. A day that has vanished
  from raw goes from all tables.
* **Dependent days.** Most metrics depend on their own day. A cohort depends on
  the sessions of the 30 days after it. winrate2's user filter spans all days:
  a user whose first open arrives late (or goes) changes the days they start
  levels on, found by looking up those users' start days.
* **Rejects.** Rows with a duplicated parameter key go to a partition of their
  own in the same pass; more than ``max_rejects`` of them (default: none, as
  upstream) fail the refresh before anything is published.

One writer at a time: publishing a number that is already taken is an error,
and the loser's refresh has to be run again. ``root`` needs a file system with
atomic renames.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.flatten import (FLAT_EVENTS, REJECTED, USER_DATA_COLUMNS, WIDE_SORT, flat_view, flatten_all,
                                 rejects_view, user_data)
from ..schemas import METRIC_CLUSTER
from ..sources.tables import NULL_PARTITION, PARTITION, partition_values, table_path, write_table
from .pipeline import METRIC_SHAPE, METRICS, RAW, USER_DATA, Sources

POINTER = "_versions"


@dataclass(frozen=True)
class Version:
    """What a reader needs to know; never changed, only replaced."""
    number: int = 0
    #: table -> day -> folder of the write that holds it
    days: dict[str, dict[str, str]] = field(default_factory=dict)
    #: table -> schema of its files and folders, as JSON
    schemas: dict[str, str] = field(default_factory=dict)
    #: raw day -> [rows, hash, listing]
    raw: dict[str, list] = field(default_factory=dict)
    #: stream -> number of its last batch (``streaming.states``)
    streams: dict[str, int] = field(default_factory=dict)

    def holding(self, table: str, write: str, schema: str, filled: set[str], covered: set[str]) -> Version:
        """This version with the days of a write instead of the covered ones."""
        held = {d: w for d, w in self.days.get(table, {}).items() if d not in covered}
        held |= dict.fromkeys(sorted(filled), write)
        return replace(self, days=self.days | {table: held}, schemas=self.schemas | {table: schema})


# ----------------------------------------------------------------- the pointer
def _hadoop(spark: SparkSession, path: str):
    fs = spark._jvm.org.apache.hadoop.fs
    return fs, fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, system = _hadoop(spark, root)
    found = system.globStatus(fs.Path(f"{table_path(root, POINTER)}/[0-9]*.json")) or ()
    return sorted(int(x.getPath().getName().split(".")[0]) for x in found)


def current(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The newest published version (or a given one); number 0 is empty."""
    numbers = _numbers(spark, root)
    if not numbers and number is None:
        return Version()
    at = numbers[-1] if number is None else number
    text = spark.read.text(f"{table_path(root, POINTER)}/{at:08d}.json", wholetext=True).first()[0]
    return Version(**json.loads(text))


def publish(spark: SparkSession, root: str, version: Version) -> Version:
    """Make ``version`` the newest one, in one rename."""
    fs, system = _hadoop(spark, root)
    new = replace(version, number=version.number + 1)
    part = fs.Path(f"{table_path(root, POINTER)}/.{uuid.uuid4().hex}")
    out = system.create(part)
    out.write(bytearray(json.dumps(new.__dict__, sort_keys=True).encode()))
    out.close()
    to = fs.Path(f"{table_path(root, POINTER)}/{new.number:08d}.json")
    kind = getattr(fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.NONE             # an existing target is an error
    fs.FileContext.getFileContext(system.makeQualified(to).toUri(), spark._jsc.hadoopConfiguration()).rename(
        system.makeQualified(part), system.makeQualified(to), how)
    return new


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove folders of writes that none of the last ``keep`` versions holds,
    and older versions. Not while a refresh is running."""
    fs, system = _hadoop(spark, root)
    numbers = _numbers(spark, root)
    kept = [current(spark, root, n) for n in numbers[-keep:]]
    used = {(t, w) for v in kept for t, held in v.days.items() for w in held.values()}
    gone = []
    for status in system.globStatus(fs.Path(f"{root.rstrip('/')}/*/write=*")) or ():
        path = status.getPath()
        if (path.getParent().getName(), path.getName().split("=", 1)[1]) not in used:
            system.delete(path, True)
            gone.append(path.toString())
    for n in numbers[:-keep]:
        system.delete(fs.Path(f"{table_path(root, POINTER)}/{n:08d}.json"), False)
    return gone


# ------------------------------------------------------------------- reading
def read_version(spark: SparkSession, root: str, table: str, version: Version | None = None,
                 columns: list[str] | None = None) -> DataFrame:
    """A table as of a version (the newest one), from the folders it names."""
    v = version or current(spark, root)
    if table not in v.schemas:
        raise ValueError(f"{table} has not been published under {root}")
    schema = T.StructType.fromJson(json.loads(v.schemas[table]))
    home = table_path(root, table)
    paths = [f"{home}/write={w}/{PARTITION}={d}" for d, w in sorted(v.days[table].items())]
    if not paths:
        df = spark.createDataFrame([], schema)
    else:
        # With the schema given, no file is opened to infer it.
        df = spark.read.schema(schema.add("write", "string")).option("basePath", home).parquet(*paths).drop("write")
    return df.select(*(columns or df.columns))


def version_sources(spark: SparkSession, root: str, version: Version, raw: DataFrame) -> Sources:
    """Inputs of the metrics as of a version, published or not."""
    opened: dict[str, DataFrame] = {RAW: raw}

    def get(name: str) -> DataFrame:
        table = name if name in (RAW, USER_DATA) else FLAT_EVENTS
        if table not in opened:
            opened[table] = read_version(spark, root, table, version,
                                         USER_DATA_COLUMNS if table == USER_DATA else None)
        return opened[table] if name in (RAW, USER_DATA) else flat_view(opened[table], name)
    return get


def read_rejects(spark: SparkSession, root: str, version: Version | None = None) -> DataFrame:
    """The rows that were kept out of the flat tables, and why."""
    return rejects_view(read_version(spark, root, FLAT_EVENTS, version))


# ------------------------------------------------------------- changed days
def _name(day) -> str:
    return NULL_PARTITION if day is None else str(day)


def on_days(col: str, days: set[str]) -> Column:
    """Rows of the given days; a literal list, which prunes partitions."""
    known = sorted(dt.date.fromisoformat(d) for d in days if d != NULL_PARTITION)
    cond = F.col(col).isin(known) if known else F.lit(False)
    return cond | F.col(col).isNull() if NULL_PARTITION in days else cond


def day_manifest(raw: DataFrame, days: set[str] | None = None) -> dict[str, list]:
    """Rows and order-free hash of each raw day (of ``days``). One aggregation
    with map-side sums; one row for each day comes to the driver."""
    rows = raw if days is None else raw.filter(on_days("date_par", days))
    rows = rows.select("date_par", F.xxhash64(*[c for c in raw.columns if c != "date_par"]).alias("h"))
    # The exact sum from those of the hashes' halves: a sum of decimals costs more
    # than the hashes, and halves don't overflow below 2**31 rows a day.
    found = rows.groupBy("date_par").agg(
        F.count("*").alias("n"), F.sum(F.shiftright("h", 32)).alias("high"),
        F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low")).collect()
    return {_name(r["date_par"]): [r["n"], str((r["high"] << 32) + r["low"])] for r in found}


def day_listing(spark: SparkSession, raw_path: str) -> dict[str, str]:
    """A digest of each raw day's files (names, sizes, times), by Spark's own
    listing: no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(raw_path)
    found = files.groupBy("date_par").agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).alias("h")).collect()
    return {_name(r["date_par"]): f"{r['n']}:{r['h']}" for r in found}


def changed_days(raw: DataFrame, version: Version, listing: dict[str, str] | None = None) -> tuple[set[str], dict]:
    """The raw days whose rows differ from the version's, and the new manifest."""
    if listing is None:
        now = {d: [*x, None] for d, x in day_manifest(raw).items()}
    else:
        same = {d for d, x in listing.items() if version.raw.get(d, [0, 0, None])[2] == x}
        fresh = set(listing) - same
        read = day_manifest(raw, fresh) if fresh else {}
        now = {d: version.raw[d] for d in same} | {d: [*x, listing[d]] for d, x in read.items()}
    differ = {d for d, x in now.items() if version.raw.get(d, [None, None])[:2] != x[:2]}
    return differ | (set(version.raw) - set(now)), now


# ------------------------------------------------------------ dependent days
def _before(days: set[str], back: int) -> set[str]:
    """The days and those up to ``back`` days before one of them."""
    known = {dt.date.fromisoformat(d) for d in days if d != NULL_PARTITION}
    return days | {str(d - dt.timedelta(days=k)) for d in known for k in range(1, back + 1)}


def starter_days(old: Sources | None, new: Sources, days: set[str]) -> set[str]:
    """The days on which users start levels who have a first open now and had
    none before, or the other way round; ``days``: the changed ones. The users
    stay in Spark; only days come to the driver."""
    def users(sources: Sources, only: bool) -> DataFrame:
        df = sources("first_open").filter(F.col("user_pseudo_id").isNotNull())
        return (df.filter(on_days(PARTITION, days)) if only else df).select("user_pseudo_id").distinct()

    if old is None:
        return set()
    came = users(new, True).join(users(old, False), "user_pseudo_id", "left_anti")
    went = users(old, True).join(users(new, False), "user_pseudo_id", "left_anti")
    starts = new("start_level").select("user_pseudo_id", PARTITION).distinct()
    found = starts.join(came.unionByName(went), "user_pseudo_id", "left_semi").select(PARTITION).distinct()
    return {_name(r[0]) for r in found.collect()}


# --------------------------------------------------------------- refreshing
def stage(df: DataFrame, root: str, table: str, version: Version, covered: set[str], cluster: list[str] | None = None,
          partition: list[str] | None = None, rows_per_file: int | None = None) -> Version:
    """Write ``df`` (rows of the covered days) to a new folder, and give the
    version that holds it. Nothing is published."""
    write = f"w{uuid.uuid4().hex}"
    path = f"{table_path(root, table)}/write={write}"
    write_table(df, path, cluster, partition=partition or PARTITION, rows_per_file=rows_per_file)
    filled = {v[0] for v in partition_values(df.sparkSession, path, [PARTITION], nulls=True)}
    return version.holding(table, write, df.schema.json(), filled, covered | filled)


def sync(spark: SparkSession, raw: DataFrame, root: str, metrics: list[str] | None = None, raw_path: str | None = None,
         max_rejects: int = 0, cohort_days: int = 30, rows_per_file: int | None = None) -> Version:
    """Bring all tables up to ``raw`` and publish them together.

    Only changed days of raw are flattened, only dependent days of each metric
    are recomputed. ``raw_path``, where raw is a table of files, spares reading
    days whose files haven't changed. A metric that the version doesn't hold
    yet is built for all days. Running it again changes nothing."""
    old = current(spark, root)
    names = metrics or [m for m, s in METRICS.items() if s.incremental]
    changed, manifest = changed_days(raw, old, day_listing(spark, raw_path) if raw_path else None)
    new = replace(old, raw=manifest)
    if changed:
        part = raw if changed >= set(manifest) else raw.filter(on_days("date_par", changed))
        new = stage(flatten_all(part, rejects=True), root, FLAT_EVENTS, new, changed, WIDE_SORT,
                    [PARTITION, "event_name"], rows_per_file)
        # Counted over the partitions of rejected rows alone, of these days.
        staged = read_version(spark, root, FLAT_EVENTS, new).filter(on_days(PARTITION, changed))
        n = staged.filter(F.col("event_name") == REJECTED).count()
        if n > max_rejects:
            raise ValueError(f"{n} rows have a duplicated parameter key (limit {max_rejects}); nothing was published")
        new = stage(user_data(part), root, USER_DATA, new, changed)
    before = version_sources(spark, root, old, raw) if FLAT_EVENTS in old.days else None
    sources = version_sources(spark, root, new, raw)
    known = set(new.days.get(FLAT_EVENTS, {})) | set(manifest)
    for name in names:
        days = None if name not in old.days else set(changed)
        if days:
            if name == "cohort":
                days = _before(days, cohort_days) & (known | set(old.days[name]))
            if name == "winrate2":
                days |= starter_days(before, sources, changed)
        if days is None or days:
            df = METRICS[name].build(sources, days=None if days is None or days >= known else days)
            new = stage(df, root, name, new, known | set(old.days.get(name, {})) if days is None else days,
                        METRIC_CLUSTER[METRIC_SHAPE[name]])
    return publish(spark, root, new) if new != old else old
