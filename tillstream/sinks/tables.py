"""Table writers that may be called again with the same batch.

A table is a parquet folder of per-batch folders, ``<table>/gen=<g>/batch=<n>/``. Writing a
batch replaces its own folder only, so a batch replayed after a failure lands where it was;
nothing already stored is rewritten. A keyed table is read through "latest batch wins";
``compact`` folds the batches of one into a new generation from time to time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillstream.operators.keyed import earliest_per_key, latest_per_key, only_keys

BASE_BATCH = -1
SLOT = "slot"


def _generation(spark: SparkSession, path: str) -> int:
    """The newest generation whose base was written completely; 0 before any compaction."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    marks = fs.globStatus(jvm.org.apache.hadoop.fs.Path(path, f"gen=*/batch={BASE_BATCH}/_SUCCESS"))
    done = [int(m.getPath().getParent().getParent().getName().split("=")[1]) for m in marks or []]
    return max(done, default=0)


def _batch_folder(spark: SparkSession, path: str, batch_id: int, generation: int | None = None) -> str:
    generation = _generation(spark, path) if generation is None else generation
    return f"{path}/gen={generation}/batch={batch_id}"


def _write(rows: DataFrame, folder: str, partition: str | None) -> None:
    if partition is None:
        rows.write.mode("overwrite").parquet(folder)
        return
    # AQE sizes the files per partition value and cuts a hot day into several of them.
    rows.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition).parquet(folder)


def append_table(rows: DataFrame, path: str, batch_id: int, partition: str | None = "dt") -> None:
    """Append a batch; the same batch again replaces itself."""
    _write(rows, _batch_folder(rows.sparkSession, path, batch_id, 0), partition)


def upsert(rows: DataFrame, path: str, keys: Sequence[str], batch_id: int,
           partition: str | None = None, order: Sequence[str] = (), slots: int = 0) -> None:
    """Insert or replace by key. Within a batch the row with the largest ``order`` is kept.
    With ``partition``, that column must be one of the keys. With ``slots``, rows are dealt over as
    many folders by a hash of the first key, so that a reader of few keys opens few folders."""
    last = latest_per_key(rows, keys, order).drop(*[c for c in order if c.startswith("_")])
    if slots:
        last, partition = last.withColumn(SLOT, slot_of(F.col(keys[0]), slots)), SLOT
    _write(last, _batch_folder(rows.sparkSession, path, batch_id), partition)


def slot_of(key: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(slots)).cast("int")


def slots_of(keys: DataFrame, name: str, slots: int) -> list[int]:
    """The folders that some keys are in: at most ``slots`` numbers."""
    return [r[0] for r in keys.select(slot_of(F.col(name), slots)).distinct().collect()]


def nothing(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, and known to be none when a query is planned: what is joined to them is not shuffled."""
    return spark.createDataFrame([], schema).where(F.lit(False))


def is_nothing(rows: DataFrame) -> bool:
    """Are there no files to read?"""
    return not rows.inputFiles()


def _stored(spark: SparkSession, path: str, schema: T.StructType, generation: int) -> DataFrame:
    base = f"{path}/gen={generation}"
    with_batch = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    if not root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root):
        return nothing(spark, with_batch)
    return spark.read.schema(with_batch).parquet(base)


def read_appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _stored(spark, path, schema, 0).select(*schema.names)


def read_batches(spark: SparkSession, path: str, schema: T.StructType, before_batch: int,
                 with_batch: bool = False, slots: list[int] | None = None) -> DataFrame:
    """Rows that batches before the given one wrote to a keyed table, earlier values of a key
    included: what that batch, or a replay of it, has to see. ``slots`` opens those folders only."""
    kept = schema if slots is None else T.StructType([*schema.fields,
                                                      T.StructField(SLOT, T.IntegerType())])
    stored = _stored(spark, path, kept, _generation(spark, path))
    if slots is not None:
        stored = stored.where(F.col(SLOT).isin(slots))
    return stored.where(F.col("batch") < before_batch).select(
        *schema.names, *(["batch"] if with_batch else []))


def read_batch(spark: SparkSession, path: str, schema: T.StructType, batch_id: int) -> DataFrame:
    """The rows of one batch, for a writer that goes on from what it has stored."""
    return spark.read.schema(schema).parquet(_batch_folder(spark, path, batch_id))


def _current(stored: DataFrame, schema: T.StructType, keys: Sequence[str], earliest: Sequence[str],
             latest: Sequence[str] = ()) -> DataFrame:
    """Per key the row of the latest batch or, with ``earliest`` or ``latest``, the one smallest or
    largest by these columns."""
    if earliest:
        return earliest_per_key(stored.drop("batch"), keys, earliest).select(*schema.names)
    return latest_per_key(stored, keys, [*latest, "batch"]).select(*schema.names)


def _only_base(spark: SparkSession, path: str, generation: int) -> bool:
    """Has nothing been written since the compaction that made this generation?"""
    if not generation:
        return False
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/gen={generation}")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(root)] == [f"batch={BASE_BATCH}"]


def read_keyed(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
               only: DataFrame | None = None, earliest: Sequence[str] = (),
               latest: Sequence[str] = ()) -> DataFrame:
    """Current rows of a keyed table: per key those of the latest batch, or with ``earliest`` or
    ``latest`` the row that is smallest or largest by these columns, whichever batch it came in. ``only``, the distinct values
    of the first key that are asked for, filters the table. A table just compacted is read as it is."""
    generation = _generation(spark, path)
    stored = _stored(spark, path, schema, generation)
    if only is not None:
        stored = only_keys(stored, only, keys[0])
    if _only_base(spark, path, generation):
        return stored.select(*schema.names)
    return _current(stored, schema, keys, earliest, latest)


def compact(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
            before_batch: int, partition: str | None = None,
            keep: Callable[[DataFrame], Column] | None = None, earliest: Sequence[str] = (),
            slots: int = 0, latest: Sequence[str] = ()) -> int:
    """Fold the batches before the given one into the base of the next generation.

    Run it at the beginning of that batch: a replay of the batch folds again and still sees
    nothing of its own. A crash on the way leaves the old generation in force. ``keep`` gives
    the condition for rows worth keeping; ``earliest``, ``latest`` and
    ``slots`` are those of reader and writer. Generations older than the one replaced, which no
    reader can have open any more, are removed. Returns the new generation.
    """
    current = _generation(spark, path)
    stored = _stored(spark, path, schema, current).where(F.col("batch") < before_batch)
    rows = _current(stored, schema, keys, earliest, latest)
    if keep is not None:
        rows = rows.where(keep(rows))
    if slots:
        rows, partition = rows.withColumn(SLOT, slot_of(F.col(keys[0]), slots)), SLOT
    _write(rows, _batch_folder(spark, path, BASE_BATCH, current + 1), partition)
    for old in range(current):
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/gen={old}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return current + 1


def append_slots(rows: DataFrame, path: str, batch_id: int, slot: str = SLOT, gather: bool = True,
                 above: Sequence[str] = ()) -> None:
    """Append a batch to a table that lies in folders by ``slot``, then batch; the same batch again
    replaces itself. With ``above``, columns, there is such a table for each of their values. Without ``gather`` every task writes its rows where it stands, a file for each folder
    they belong to; otherwise the rows of a folder are brought together first."""
    tagged = rows.withColumn("batch", F.lit(batch_id).cast("long"))
    if gather:
        tagged = tagged.hint("rebalance", slot)
    (tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*above, slot, "batch").parquet(path))


def read_slots(spark: SparkSession, path: str, schema: T.StructType, slots: Sequence | None = None,
               before_batch: int | None = None, only_batch: int | None = None,
               slot: str = SLOT) -> DataFrame:
    """Rows of such a table, ``batch`` among their columns. With ``slots`` no other folder is listed,
    however many there are; ``only_batch`` lists the folders of that batch alone."""
    kind = schema[slot].dataType if slot in schema.names else T.LongType()
    whole = T.StructType([*[f for f in schema.fields if f.name != slot],
                          T.StructField(slot, kind), T.StructField("batch", T.LongType())])
    inside = "" if only_batch is None else f"/batch={only_batch}"
    folders = [path] if slots is None else [f"{path}/{slot}={n}{inside}" for n in sorted(slots)]
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    present = [f for f in folders if fs.exists(jvm.org.apache.hadoop.fs.Path(f))]
    if not present:
        return nothing(spark, whole)
    rows = spark.read.schema(whole).option("basePath", path).parquet(*present)
    return rows if before_batch is None else rows.where(F.col("batch") < before_batch)


def batches_present(spark: SparkSession, path: str, slot: str = SLOT) -> set[int]:
    """The numbers of the batches that such a table holds rows of."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, f"{slot}=*/batch=*")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {int(found.getPath().getName().split("=")[1]) for found in fs.globStatus(root) or []}


def slots_present(spark: SparkSession, path: str, slot: str = SLOT) -> list[int]:
    """The numbers of the folders of such a table, from one listing of its root."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return [int(n.split("=")[1]) for n in names if n.startswith(f"{slot}=") and n.split("=")[1].lstrip("-").isdigit()]


def jdbc_options(url: str, table: str, batch_size: int = 100, writers: int = 4,
                 **more: str) -> dict[str, str]:
    """Writer options of the wide table: rows per statement, parallel writers, no transaction."""
    return {"url": url, "dbtable": table, "batchsize": str(batch_size),
            "numPartitions": str(writers), "isolationLevel": "NONE", **more}


def append_jdbc(rows: DataFrame, options: dict[str, str]) -> None:
    """Append rows, in as many parallel writers as the options say. Pass rows of a stored table: the
    exchange in front keeps the plan behind them from being narrowed to that number of tasks. The
    database has no notion of batches, so a replayed batch is appended again (at least once)."""
    writers = int(options.get("numPartitions", 1))
    rows.repartition(writers).write.format("jdbc").options(**options).mode("append").save()


def preview(rows: DataFrame, n: int = 1000) -> None:
    """Print the first rows of a batch."""
    rows.show(n, truncate=False)
