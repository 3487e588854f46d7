"""Session settings, and tables staged in the folder that all executors share."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What a large cluster needs beyond Spark's defaults. The number of shuffle partitions is an
# upper bound: adaptive execution merges small ones up to the advisory size and splits skewed ones.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "10000",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.ui.enabled": "false",
}

SHARED_DIR_KEY = "spark.checkpoint.dir"


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the cluster settings, or the local ones for a ``local[..]`` master."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    local = bool(master) and master.startswith("local")
    for key, value in {**(LOCAL_CONF if local else CLUSTER_CONF), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a local master gets a temporary one if there is none."""
    folder = spark.conf.get(SHARED_DIR_KEY, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SHARED_DIR_KEY} to a folder that every executor can reach")
    return _local_dir(spark.sparkContext.applicationId)


@functools.cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"tidemark-{application}-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under this application's part of the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/tidemark/{app}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For results that several later branches use: each branch reads its own columns from the
    files instead of repeating the joins above, all branches see the same rows, and a lost
    executor costs a re-read only.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def delete_path(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def clear_staged(spark: SparkSession) -> None:
    """Delete everything this application staged. Call it once results are written."""
    delete_path(spark, f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}")
