"""Starting, finishing and watching streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillstream.session import tune

BATCH_INTERVAL = "5 seconds"

# Called with a micro-batch and its number; may be called again with the same number.
BatchWriter = Callable[[DataFrame, int], None]


def _adaptive(write: BatchWriter) -> BatchWriter:
    """Stateful queries run without adaptive execution; give it back to the batch jobs of
    their writer, which start after the micro-batch itself has been planned."""
    def run(batch: DataFrame, batch_id: int) -> None:
        conf, key = batch.sparkSession.conf, "spark.sql.adaptive.enabled"
        usual = conf.get(key)
        conf.set(key, "true")
        try:
            write(batch, batch_id)
        finally:
            conf.set(key, usual)
    return run


def staged(batch: DataFrame, folder: str, batch_id: int) -> DataFrame:
    """The micro-batch as a written table, for writers that use it more than once. Unlike a
    cache it survives the loss of an executor: the stateful operators run once per batch.
    Two folders take turns."""
    slot = f"{folder}/slot={batch_id % 2}"
    batch.write.mode("overwrite").parquet(slot)
    return batch.sparkSession.read.schema(batch.schema).parquet(slot)


def start(stream: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "append",
          drain: bool = False, name: str | None = None,
          state_partitions: int | None = None) -> StreamingQuery:
    """Start a query with one checkpoint of its own: its positions and its state commit
    together. ``drain`` stops it once the input present has been read, else a batch runs every
    five seconds. ``state_partitions`` fixes the width of the state for the checkpoint's life."""
    spark = tune(stream.sparkSession)
    writer = stream.writeStream.foreachBatch(_adaptive(write)).outputMode(mode)
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(
        processingTime=BATCH_INTERVAL)
    width = "spark.sql.shuffle.partitions"
    usual = spark.conf.get(width)
    try:
        if state_partitions:
            spark.conf.set(width, str(state_partitions))
        return writer.start()
    finally:
        spark.conf.set(width, usual)


def finish(query: StreamingQuery, seconds: int | None = None) -> StreamingQuery:
    """Wait for a draining query; with a limit, stop it and fail if it takes longer."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} still running after {seconds} s")
    return query


def discard(spark: SparkSession, *folders: str) -> None:
    """Remove folders of a finished run that its result does not read."""
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def progress(query: StreamingQuery) -> list[dict]:
    """Per source, where the last batch began and ended, as the checkpoint records it."""
    last = query.lastProgress
    if last is None:
        return []
    return [{"source": s["description"], "start": s["startOffset"], "end": s["endOffset"],
             "rows": s["numInputRows"]} for s in last["sources"]]


def observed(query: StreamingQuery) -> dict[str, dict[str, int]]:
    """Sum over the batches of the counts taken with ``DataFrame.observe`` under a name."""
    totals: dict[str, dict[str, int]] = {}
    for report in query.recentProgress:
        for name, row in (report["observedMetrics"] or {}).items():
            counts = row.asDict() if hasattr(row, "asDict") else dict(row)
            kept = totals.setdefault(name, {})
            for field, value in counts.items():
                kept[field] = kept.get(field, 0) + (value or 0)
    return totals

