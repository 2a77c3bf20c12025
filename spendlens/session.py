"""Session settings and the shared scratch folder."""

import re
import tempfile
import uuid
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings the jobs are written for. Partition counts stay with the cluster: AQE coalesces
# small shuffles and splits the skewed side of a join.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # stream state on disk instead of the executor heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# options of Parquet tables that are to be small: in version 2 texts take less room if their neighbours begin alike
PACKED_TABLE = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9", "parquet.writer.version": "PARQUET_2_0"}


def build_session(app_name: str = "spendlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_dir(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="spendlens-")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``."""
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    # one process, as in tests: its own folder is shared by all of its tasks
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    return _local_dir(spark.sparkContext.applicationId)


def scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/spendlens/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application once its results are saved."""
    root = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


@contextmanager
def dealt_alike(spark: SparkSession):
    """Joins that are planned and run meanwhile take sides as they are dealt, if by the same part of their keys.

    Without it they are right as well, but rows are moved again for every join.
    """
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.options(**(PACKED_TABLE if codec == "zstd" else {"compression": codec})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
