"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# No warehouse operator carries a broadcast hint. Catalyst compares a side's estimated
# size with autoBroadcastJoinThreshold and AQE compares its measured size again at run time;
# beyond the threshold the join shuffles, and AQE splits the partitions of hot keys.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # What Python workers are handed at once; the rest of an executor's memory is the JVM's.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # What a batch stores is read a few times at most: better small than quick to unpack.
    "spark.sql.parquet.compression.codec": "zstd",
    # Split a hot partition even where that costs one more exchange behind the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

STREAM_SETTINGS = {
    # State beyond executor memory goes to local disk; only changes are uploaded per batch.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the rows of the state would cost a read for every write.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else has built."""
    for key, value in {**SETTINGS, **STREAM_SETTINGS}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# A shuffle partition per so many bytes of input files: after decompression and with the
# columns a query keeps, some hundred MB each. 100 TB make 50,000 partitions.
BYTES_PER_PARTITION = 2 << 30


def shuffle_width(input_bytes: int, cores: int) -> int:
    """``spark.sql.shuffle.partitions`` for a cluster that reads so much in a query. Whoever builds
    the session sets it once; AQE merges what turns out small and splits skewed partitions."""
    return max(cores, -(-input_bytes // BYTES_PER_PARTITION))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's, or a temporary one in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="tillstream-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run, below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
