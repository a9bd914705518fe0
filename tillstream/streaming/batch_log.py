"""What every micro-batch read and counted, in a table that outlives the queries.

A query's own ``recentProgress`` forgets all but the last hundred batches, and everything at a restart.
A listener on the session writes one row per batch instead, under the query's id, which a checkpoint
keeps for life; a batch that is run again replaces its row.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

_SPAN = 1000
_OFFSETS = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("source", "start", "end")]))
BATCHES = T.StructType([
    T.StructField("batch", T.LongType()), T.StructField("name", T.StringType()), T.StructField("began", T.StringType()),
    T.StructField("rows", T.LongType()), T.StructField("offsets", _OFFSETS),
    T.StructField("counts", T.MapType(T.StringType(), T.LongType()))])
_KEYS = [T.StructField("query", T.StringType()), T.StructField("span", T.LongType())]


class BatchLog(StreamingQueryListener):
    """Add it to a session with ``spark.streams.addListener``; rows go below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end_of(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress
        counts = {f"{name}.{field}": int(value) for name, row in (seen.observedMetrics or {}).items()
                  for field, value in row.asDict().items() if isinstance(value, int)}
        offsets = [{"source": s.description, "start": s.startOffset, "end": s.endOffset} for s in seen.sources]
        row = {"batch": seen.batchId, "name": seen.name, "began": seen.timestamp,
               "rows": seen.numInputRows, "offsets": offsets, "counts": counts}
        place = f"{self.folder}/query={seen.id}/span={seen.batchId // _SPAN}/batch-{seen.batchId}.json"
        # One line; a Spark job for it would cost more than the batch it tells of.
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(place)
        out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path, True)
        try:
            out.write(bytearray(json.dumps(row).encode()))
        finally:
            out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: int = 60) -> None:
        """Until the rows of a query that has ended are written; events come after the fact."""
        if not self._end_of(str(query.runId)).wait(seconds):
            raise TimeoutError(f"no end of {query.name or query.id} seen after {seconds} s")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per query and batch: rows read, offsets per source, counts by ``observation.field``."""
    rows = spark.read.schema(T.StructType([*BATCHES.fields, *_KEYS])).json(folder)
    return rows.select("query", *BATCHES.names)


def totals(spark: SparkSession, folder: str) -> DataFrame:
    """Observed counts over all batches of each query."""
    one = read(spark, folder).select("query", "name", F.explode("counts").alias("counted", "n"))
    return one.groupBy("query", "name", "counted").agg(F.sum("n").alias("n"))


def position(spark: SparkSession, folder: str, query: str) -> dict[str, dict]:
    """Per source, where the query's last batch ended."""
    last = read(spark, folder).where(F.col("query") == query).orderBy(F.desc("batch")).first()
    return {} if last is None else {o.source: json.loads(o.end) for o in last.offsets if o.end}
