"""Session settings and the shared folder used for materialised intermediates."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed join partitions even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Bloom filters of a join's selective side drop rows of a large other side before they are shuffled. A filter has at
    # most about 4 MB, whatever the tables; keys beyond its size only let more rows through.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "4GB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    # Whole texts go to Python workers in small batches.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    # Streaming keys live on disk, not on the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "fixtrail", master: str | None = None,
                  shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """A session with this package's settings; leave ``master`` unset under spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master may do without that setting and gets a temp folder; elsewhere each executor would write to
    its own disk and reads would find a part.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not context.getCheckpointDir():
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not context.getCheckpointDir():
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="fixtrail-"))
    return context.getCheckpointDir().rstrip("/")


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing folder below the shared one."""
    path = f"{shared_root(spark)}/fixtrail-{label}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Remove the folders that ``scratch_path`` gave out, through Spark's file systems; returns how many were there.

    Call it when no DataFrame that reads them is needed any more. Jobs do so at their end.
    """
    jvm, removed = spark.sparkContext._jvm, 0
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        removed += bool(path.getFileSystem(settings).delete(path, True))
    return removed


# Bytes of input files behind one task of a wide shuffle; shuffled rows take many times that in memory.
BYTES_PER_TASK = 4 << 20


def _input_bytes(df: DataFrame) -> int:
    """Bytes of the files a DataFrame reads; of many files from the mean of a few hundred."""
    files = sorted(df.inputFiles())
    if not files:
        return 0
    jvm, some = df.sparkSession.sparkContext._jvm, files[::max(1, len(files) // 200)]
    settings = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)) for file in some]
    known = sum(path.getFileSystem(settings).getFileStatus(path).getLen() for path in paths)
    return known * len(files) // len(some)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Laid out by ``keys`` over a number of tasks that grows with the input files.

    Adaptive execution merges small shuffle partitions by their compressed bytes. Where a join or an aggregate makes many
    rows or wide ones of few bytes, that puts too much into one task; a number given here is not merged.
    """
    spark, size = df.sparkSession, _input_bytes(df)
    if not size:
        return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys)
    return df.repartition(max(spark.sparkContext.defaultParallelism, -(-size // BYTES_PER_TASK)), *keys)


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage through a table in the shared folder, which survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
