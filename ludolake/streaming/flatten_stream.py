"""The flat layer and metric refresh driven by Structured Streaming.

A file-source stream over the raw export replaces the scheduler's
high-water mark: the stream's checkpoint remembers which raw files were
processed, so each run sees exactly the new files, whatever days they hold
(late data included). With ``trigger(availableNow=True)`` a run processes
what is there and stops, like a scheduled batch job.

Each micro-batch only tells which days changed; the work is
``refresh_days``: the flat layer for those days is rebuilt from the raw
table and the affected metric days are recomputed, all by dynamic partition
overwrite. A replayed micro-batch therefore rewrites the same partitions
with the same rows (exactly-once results on plain Parquet).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.refresh import refresh_days
from ..schemas import RAW_SCHEMA
from ..session import checkpoint_dir
from ..sources.tables import read_raw_table


def flat_stream(spark: SparkSession, raw_path: str, root: str,
                checkpoint: str | None = None, metrics: list[str] | None = None,
                cohort_lookback: int = 30, available_now: bool = True,
                processing_time: str | None = None) -> StreamingQuery:
    """Start the stream; returns the running query (``awaitTermination``
    on it for a batch-like run).

    ``raw_path`` is the raw export, partitioned by ``date_par``. The stream
    checkpoint defaults to ``<spark.checkpoint.dir>/ludolake-flat-stream``.
    """
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/ludolake-flat-stream"
    src = spark.readStream.schema(RAW_SCHEMA).option("basePath", raw_path).parquet(raw_path)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # The days a batch touches: one value per day, not per row.
        days = [r[0] for r in batch.select("date_par").distinct().collect()]
        raw = read_raw_table(session, raw_path)
        refresh_days(session, raw, root, days, metrics=metrics,
                     cohort_lookback=cohort_lookback)

    writer = src.writeStream.foreachBatch(on_batch).option("checkpointLocation", ckpt)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
