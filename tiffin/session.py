"""Session settings every job relies on, and the shared folder for durable intermediate data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. None of them changes a result, only how it is computed.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Sizes are those of compressed files and blocks. Keys and codes take thirty times as much once they are sorted or
    # hashed, so what one task gets is kept small; larger inputs make more tasks, not larger ones.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "16m",
    # One restaurant, user or item may hold a third of a fact table. Row-level look-ups keep the fact on the
    # streamed side, so the adaptive skew join may cut its hot partition into pieces; "force" lets it do so
    # even where a later aggregation then needs a shuffle of its own.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for name, value in SQL_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName("tiffin")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Column calls need not report their call site to the JVM; plans of many columns build twice as fast.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the cluster names it.

    Only a local session may go without one: there the driver's own disk is the executors' disk.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    folder = folder or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tiffin-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: what is used several times is computed once, and a
    lost executor costs a re-read instead of the joins behind it."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
