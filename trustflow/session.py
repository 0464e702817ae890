"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even when the split costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A task's share is bounded, so what it sorts or hashes does not grow with the input; the number of tasks does.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.parquet.filterPushdown": "true",
    # HotSpot leaves methods above 8000 bytes uncompiled; many rules in one projection get there.
    # Spark then splits the projection into small methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def tune(spark: SparkSession) -> SparkSession:
    """Settings every job here relies on. Partition counts stay the cluster's choice."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", app: str = "trustflow", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or a temp folder when unset (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="trustflow-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "rdd-checkpoint"))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Writes an intermediate result to the shared folder and reads it back.

    For results that several branches of a plan need: each branch would otherwise prune
    its own columns and compute the whole subplan again. The copy outlives lost executors
    and tells Catalyst its size.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
