"""Helpers shared by the operators of this package."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, configure

#: Text held by one task at a time when documents are dealt into buckets.
BUCKET_BYTES = 8 << 20


_HOME = Path(__file__).resolve().parents[2]


def prepare(spark: SparkSession) -> None:
    """Session defaults, the checkpoint folder, and the package on the Python
    workers' path: where neither PYTHONPATH nor the working folder gives it to
    them, Spark sends it along."""
    configure(spark)
    checkpoint_dir(spark)
    context = spark.sparkContext
    given = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    if str(_HOME) not in map(os.path.abspath, given) and not getattr(context, "_ludolake_sent", False):
        folder = tempfile.mkdtemp()  # served to executors as long as the driver lives
        atexit.register(shutil.rmtree, folder, True)
        context.addPyFile(shutil.make_archive(f"{folder}/ludolake", "zip", _HOME, "ludolake"))
        context._ludolake_sent = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, with the session prepared for checkpoints."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there, so a
    lost executor never recomputes what came before."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts (one aggregation over the text column)."""
    return int(docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0)


#: Stands for a null id inside the operators; sorts before all others.
NO_ID = -(1 << 63)


def id_in(key: Column) -> Column:
    return F.coalesce(key.cast("long"), F.lit(NO_ID))


def id_out(key: Column) -> Column:
    return F.when(key != NO_ID, key)


def text_digest(text: Column) -> Column:
    """What tells rows that share an id, or have none, apart: the SHA-256 of
    the text, null as empty. With the id it names a row up to exact copies."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


#: Bytes of a column that a vectorised task holds at a time.
CHUNK_BYTES = 1 << 20


def sliced(batches, column: str, limit: int = 0):
    """The rows of ``batches`` in batches of at most ``limit`` bytes of
    ``column`` (one row at least, however long it is)."""
    limit = limit or CHUNK_BYTES
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column)
        if pa.types.is_list(values.type) or pa.types.is_large_list(values.type):
            size = pc.list_value_length(values)
            per_row = 8
        else:
            size, per_row = pc.binary_length(values), 1
        size = pc.fill_null(size, 0).to_numpy(zero_copy_only=False).astype("int64") * per_row
        begin = held = 0
        for k, n in enumerate(size):
            if k > begin and held + n > limit:
                yield _copied(batch, begin, k)
                begin, held = k, 0
            held += int(n)
        yield _copied(batch, begin, len(size))


def _copied(batch: pa.RecordBatch, begin: int, end: int) -> pa.RecordBatch:
    """Rows of a batch on their own: ``ascii_lower`` misreads an array whose
    first offset isn't 0, as a cast of a slice gives."""
    return batch.take(pa.array(range(begin, end), pa.int64()))


def free(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it
    (whatever the case of its letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(name: str) -> Column:
    """A column by its exact name, whatever signs are in it."""
    return F.col(f"`{name.replace('`', '``')}`")


def with_key(docs: DataFrame, doc_id: str, text: str, *more: str) -> tuple[DataFrame, str]:
    """``docs`` with one more column, under a free name: a struct of the id, the
    digest of the text, and more columns. It names a row up to exact copies of
    these, and clashes with no column of the table."""
    key = free(docs, "row_key")
    parts = [column(doc_id).cast("long").alias("id"), text_digest(column(text)).alias("digest"),
             *(column(m).alias(f"more_{i}") for i, m in enumerate(more))]
    return docs.withColumn(key, F.struct(*parts)), key


def without(keyed: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """Rows of ``keyed`` (``with_key``) whose key isn't among those of ``gone``
    (one struct column of the same fields), without the key."""
    other = free(keyed, "gone_key")
    return keyed.join(gone.toDF(other), F.col(key).eqNullSafe(F.col(other)), "left_anti").drop(key)


def bucket_of(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def _compress(batches):
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        body = [packer.compress((x or "").encode()) for x in batch.column("text").to_pylist()]
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, pa.field("text", pa.binary()), pa.array(body, pa.binary()))


def dealt(docs: DataFrame, n_buckets: int, by_text: bool = True) -> DataFrame:
    """``docs`` (doc_id, text, ...) with compressed texts and their bucket,
    ready to be dealt out: texts are most of what such a shuffle writes. Rows
    are dealt by id and text, so rows that share an id spread; without
    ``by_text`` by their id (``bucket_of``), and only rows without one by text."""
    key = F.struct("doc_id", "text")
    bucket = bucket_of(key, n_buckets)
    if not by_text:
        bucket = F.when(F.col("doc_id") == NO_ID, bucket).otherwise(bucket_of(F.col("doc_id"), n_buckets))
    docs = docs.withColumn("bucket", bucket)
    schema = ", ".join(f"`{f.name}` {'binary' if f.name == 'text' else f.dataType.simpleString()}"
                       for f in docs.schema)
    return docs.mapInArrow(_compress, schema)


def texts(column: pa.ChunkedArray) -> pa.Array:
    """The texts of a dealt table, as UTF-8 bytes."""
    unpacker = zstandard.ZstdDecompressor()
    return pa.array([unpacker.decompress(x) for x in column.to_pylist()], pa.large_binary())
