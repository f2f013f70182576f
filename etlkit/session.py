"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every operator relies on. All of them can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Stream state on local disk with change logs in the checkpoint, rather than all in executor memory.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


PARTITIONS = "spark.sql.shuffle.partitions"
SPARK_DEFAULT_PARTITIONS = "200"


def shuffle_partitions_for(shuffled_bytes: int, cores: int, target_bytes: int = 1 << 30, most: int = 50_000) -> int:
    """Initial shuffle partitions: about `target_bytes` each, at least one per core.

    Adaptive execution merges the ones that turn out small, but the driver keeps books of map tasks times partitions
    whatever it merges, hence `most`; beyond it partitions grow, and sorts and aggregations spill.
    """
    return max(cores, min(most, -(-shuffled_bytes // target_bytes)))


def get_session(app_name: str = "etlkit", master: str | None = None, input_bytes: int | None = None,
                **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    for key in {*RUNTIME_CONF, PARTITIONS} & set(conf):
        spark.conf.set(key, conf[key])
    if input_bytes is not None and PARTITIONS not in conf:
        spark.conf.set(PARTITIONS, shuffle_partitions_for(input_bytes, spark.sparkContext.defaultParallelism))
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built.

    The number of shuffle partitions is the cluster's to choose; only a local session that still has Spark's
    default gets one per core, since stream state opens a store for each.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if is_local(spark) and spark.conf.get(PARTITIONS) == SPARK_DEFAULT_PARTITIONS and not spark.sparkContext.getConf().contains(PARTITIONS):
        spark.conf.set(PARTITIONS, spark.sparkContext.defaultParallelism)
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir`, or a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not is_local(spark):
        raise ValueError("spark.checkpoint.dir is not set: name a folder that every executor can reach")
    folder = os.path.join(tempfile.gettempdir(), f"etlkit-{os.getpid()}")
    os.makedirs(folder, exist_ok=True)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier call has returned."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete what a `scratch_path` holds; refuses any other path."""
    if not path.startswith(f"{shared_folder(spark).rstrip('/')}/"):
        raise ValueError(f"not a scratch path: {path}")
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def staged(df, name: str = "staged"):
    """Write `df` as Parquet to the shared scratch folder and read it back, cutting its lineage.

    For results that several later steps read. The files survive the loss of executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
