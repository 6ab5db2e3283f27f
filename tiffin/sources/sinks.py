"""Writing tables: append, month-partitioned facts, and snapshots of several tables published as one."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.functions import label_month


COMMITS = "batch string, attempt string"


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def _commits(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(COMMITS).parquet(f"{root}/commits")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def appended(spark: SparkSession, root: str, batch: str | None = None) -> bool:
    """Whether this batch (any batch) stands in the commit log."""
    log = _commits(spark, root)
    return log is not None and not (log if batch is None else log.where(F.col("batch") == batch)).isEmpty()


def append_once(spark: SparkSession, root: str, batch: str, tables: Mapping[str, DataFrame]) -> bool:
    """Append rows to several tables under ``root`` as the batch of this name, once.

    An attempt writes its rows under a name of its own; they count from the moment the attempt stands in the commit
    log, all tables at once. A batch that stands there is not run again (False). A job that dies half-way leaves rows
    nobody reads, and of two attempts that overlap and both commit, readers go by the one with the smaller name.
    """
    if appended(spark, root, batch):
        return False
    attempt = uuid.uuid4().hex
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}/batch={batch}/attempt={attempt}")
    spark.createDataFrame([(batch, attempt)], COMMITS).coalesce(1).write.mode("append").parquet(f"{root}/commits")
    return True


def read_appended(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """All committed rows of a table, with the batch they came in."""
    rows = spark.read.schema(f"{schema}, {COMMITS}").parquet(f"{root}/{name}")
    log = _commits(spark, root)
    if log is None:
        return rows.drop("attempt").limit(0)
    counted = log.groupBy("batch").agg(F.min("attempt").alias("attempt"))  # a row per batch
    return rows.join(F.broadcast(counted), ["batch", "attempt"], "left_semi").drop("attempt")


def write_by_month(df: DataFrame, path: str, time_column: str, name: str = "month") -> None:
    """Facts laid out by month, so a half-open time range reads only the months it touches.

    Rows are spread over tasks by month and time, not by month alone: a busy month becomes several files.
    """
    (
        df.withColumn(name, label_month(F.col(time_column)))
        .repartitionByRange(name, time_column)
        .write.mode("overwrite")
        .partitionBy(name)
        .parquet(path)
    )


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """A catalog table hashed and sorted by ``key``. Facts bucketed alike by order number join without a shuffle."""
    shaped = df.repartition(buckets, key)  # one file per bucket, not one per bucket and task
    shaped.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)


def published_version(spark: SparkSession, root: str) -> int:
    """Newest version whose tables are all in place; 0 if there is none."""
    try:
        log = spark.read.schema("version bigint").parquet(f"{root}/versions")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return log.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def publish(spark: SparkSession, root: str, version: int, tables: Mapping[str, DataFrame]) -> None:
    """Write several tables as one version. Readers go by the version log, which is written last, so a job that
    dies half-way leaves nothing visible; running it again overwrites its own leftovers."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/v{version}/{name}")
    log = spark.range(1).select(F.lit(version).cast("bigint").alias("version"))
    log.coalesce(1).write.mode("append").parquet(f"{root}/versions")


def read_published(spark: SparkSession, root: str, name: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{root}/v{version}/{name}")
