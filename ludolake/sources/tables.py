"""Date-partitioned Parquet tables: the flat and dashboard layers on disk.

Layout of every table: ``<root>/<name>/event_date=YYYY-MM-DD/part-*.parquet``,
rows sorted inside each file by the table's cluster keys so Parquet
row-group min/max statistics skip data for a filter on them (the
``CLUSTER BY`` of the warehouse). ``root`` must be a shared file system path
on a cluster.

Writes are by column name: ``partitionBy`` moves ``event_date`` last in the
files, so a positional insert would misplace columns; readers select the
declared column order back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce
from operator import and_
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..session import checkpoint_dir

PARTITION = "event_date"


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _layout(df: DataFrame, partitions: list[str], cluster: list[str],
            files_per_date: int | None, rows_per_file: int | None) -> DataFrame:
    if rows_per_file and cluster:
        return clustered(df, partitions, cluster, rows_per_file)
    if files_per_date:
        # Spread each partition over ``files_per_date`` tasks by a
        # deterministic row hash: a retried task sees the same rows, and no
        # single day (or hot key inside it) lands in one task.
        bucket = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_date))
        df = df.repartition(*[F.col(c) for c in partitions], bucket)
    elif files_per_date is None:
        # AQE rebalance by partition: small days are merged into one task, a
        # big or skewed day is split over several (advisory partition size),
        # so file sizes follow the data instead of the input split.
        df = df.hint("rebalance", *partitions)
    # files_per_date == 0: no shuffle; each task writes its own rows (keeps a
    # day-partitioned input day-aligned).
    return df.sortWithinPartitions(*partitions, *cluster)


def clustered(df: DataFrame, partitions: list[str], cluster: list[str], rows_per_file: int) -> DataFrame:
    """Rows laid out so that every file of a partition holds a range of the
    cluster keys: a filter on them then skips whole files by their min/max.

    The rows of each key are counted first (only partition and cluster columns
    are read for that) and put in order; a key's place among the partition's
    rows gives its file. A key with more rows than a file has several files,
    dealt by a hash of the row, so a hot key doesn't make one task. Every file
    is one task; small partitions share one. Retried tasks deal the same rows
    the same way.
    """
    keys = [*partitions, *cluster]
    checkpoint_dir(df.sparkSession)
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).checkpoint()
    order = Window.partitionBy(*partitions).orderBy(*cluster).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_n").over(order), F.lit(0).cast("long"))
    placed = counts.withColumn("_file", F.floor(start / rows_per_file)).withColumn(
        "_more", F.ceil(F.col("_n") / rows_per_file) - 1)
    # One row for each partition comes to the driver, with its files.
    each = placed.groupBy(*partitions).agg(F.sum("_n").alias("_n"), F.max(F.col("_file") + F.col("_more")).alias("_last"))
    tasks, held, base = [], 0, 0
    for r in sorted(each.collect(), key=lambda r: tuple((r[c] is not None, r[c]) for c in partitions)):
        if r["_last"] or held + r["_n"] > rows_per_file:
            base, held = base + (held > 0), 0
        tasks.append((*[r[c] for c in partitions], base))
        if r["_last"]:
            base += r["_last"] + 1
        else:
            held += r["_n"]
    total = base + 1
    kinds = [(c, df.schema[c].dataType) for c in partitions]
    of = df.sparkSession.createDataFrame(tasks, T.StructType([*[T.StructField(c, t) for c, t in kinds],
                                                              T.StructField("_base", T.LongType())]))

    def match(left: DataFrame, right: DataFrame, cols: list[str]) -> DataFrame:
        named = right.withColumnsRenamed({c: f"_on_{c}" for c in cols})
        return left.join(named, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in cols]), "left").drop(
            *[f"_on_{c}" for c in cols])

    placed = match(placed, of, partitions).select(*keys, (F.col("_base") + F.col("_file")).alias("_file"), "_more")
    spread = F.pmod(F.xxhash64(*df.columns), F.col("_more") + 1)
    return (match(df, placed, keys).repartitionById(total, (F.col("_file") + spread).cast("int"))
            .sortWithinPartitions(*partitions, *cluster).select(*df.columns))


def write_table(df: DataFrame, path: str, cluster: list[str] | None = None,
                mode: str = "overwrite", partition: str | list[str] = PARTITION,
                files_per_date: int | None = None, stale: Callable[[tuple], bool] | None = None,
                rows_per_file: int | None = None) -> None:
    """Write ``df`` partitioned by day (and more columns) and clustered by
    ``cluster``.

    ``mode="overwrite"`` replaces the whole table (a full build);
    ``mode="dynamic"`` replaces only the partitions present in ``df`` (a
    refresh); ``mode="append"`` adds rows (the scheduled increment).
    A refresh that recomputes a partition to nothing must also remove it:
    ``stale`` says of a partition's values whether the refresh covers it.
    ``files_per_date``: None rebalances by partition under AQE (default), N
    hashes each partition into N files, 0 writes without a shuffle.
    ``rows_per_file`` gives every file a range of the cluster keys instead
    (see ``clustered``).
    """
    partitions = [partition] if isinstance(partition, str) else list(partition)
    out = _layout(df, partitions, list(cluster or []), files_per_date, rows_per_file)
    writer = out.write.partitionBy(*partitions)
    if mode == "dynamic":
        # Partitions are replaced, so the write says which it has filled.
        filled = Observation()
        out = out.observe(filled, F.collect_set(F.struct(*[F.col(c).cast("string") for c in partitions])).alias("p"))
        writer = out.write.partitionBy(*partitions)
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == "overwrite":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "static")
    elif mode == "append":
        writer = writer.mode("append")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    writer.parquet(path)
    if mode == "dynamic" and stale is not None:
        fresh = {tuple(row) for row in filled.get["p"]}
        _drop(df.sparkSession, path, partitions,
              [v for v in partition_values(df.sparkSession, path, partitions) if stale(v) and v not in fresh])


def _drop(spark: SparkSession, path: str, cols: list[str], values: list[tuple]) -> None:
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for v in values:
        folder = "/".join(f"{c}={quote(x)}" for c, x in zip(cols, v))
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}"), True)


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None,
               partition: str = PARTITION, partition_type: str = "date") -> DataFrame:
    """Read a table back in its declared column order."""
    df = spark.read.parquet(path)
    df = df.withColumn(partition, F.col(partition).cast(partition_type))
    return df.select(*(columns or df.columns))


def read_raw_table(spark: SparkSession, path: str) -> DataFrame:
    """The raw event export (partitioned by ``date_par``) with the declared
    ``RAW_SCHEMA``: no schema inference over a large table's files, and the
    nested parameter type is fixed even if early files lack a slot."""
    from ..schemas import RAW_SCHEMA
    return spark.read.schema(RAW_SCHEMA).parquet(path).select(*RAW_SCHEMA.fieldNames())


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException:
        return False


#: Spark's name for the partition of a NULL value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_values(spark: SparkSession, path: str, cols: list[str], nulls: bool = False) -> set[tuple]:
    """Distinct values of the partition columns of a table written by this
    package, from its ``col=value`` directories, one level for each column.
    The listing grows with the partitions, not with the files; the partition
    of NULL is left out, as ``max`` ignores NULL, unless ``nulls`` is set."""
    jvm, found = spark._jvm, {(): path}
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for col in cols:
        below = {}
        for values, folder in found.items():
            for entry in fs.globStatus(jvm.org.apache.hadoop.fs.Path(folder, f"{col}=*")) or ():
                value = entry.getPath().getName().split("=", 1)[1]
                if nulls or value != NULL_PARTITION:
                    below[(*values, unquote(value))] = entry.getPath().toString()
        found = below
    return set(found)


def table_high_water_mark(spark: SparkSession, path: str, col: str = PARTITION,
                          by: str | None = None):
    """Latest day of a written table (per ``by`` value when given), read
    from its partition directories; None (or {}) for a missing table."""
    if by is None:
        days = [v[0] for v in partition_values(spark, path, [col])]
        return dt.date.fromisoformat(max(days)) if days else None
    marks: dict[str, dt.date] = {}
    for day, key in partition_values(spark, path, [col, by]):
        d = dt.date.fromisoformat(day)
        if key not in marks or d > marks[key]:
            marks[key] = d
    return marks


def high_water_mark(df: DataFrame, col: str = PARTITION):
    """``max(col)`` as a driver-side literal (None for an empty table).

    One small job; the literal then prunes partitions at planning time,
    where a scalar subquery would stay a runtime filter.
    """
    return df.agg(F.max(col)).first()[0]
