"""Ratings from a stream of review changes.

The running sum and count per restaurant live in the state store, after a partial aggregate in every input task.
Each micro-batch writes only the restaurants it touched, under its own number; a batch that is replayed after a
failure overwrites its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tiffin.jobs.rating import STATE, signed_changes
from tiffin.sources.sinks import publish, published_version, read_published


def start(changes: DataFrame, folder: str, **trigger) -> StreamingQuery:
    """Follow a change feed (``before`` and ``after`` as in ``tiffin.jobs.rating``) into ``folder``."""
    totals = (
        signed_changes(changes)
        .groupBy("Restaurant_ID")
        .agg(
            F.sum("stars").cast("decimal(28,4)").alias("stars"), F.sum("reviews").cast("bigint").alias("reviews")
        )
    )

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/state/epoch={number}")

    return (
        totals.writeStream.outputMode("update")
        .foreachBatch(keep)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _epochs(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{STATE}, epoch bigint").parquet(f"{folder}/state")


def _newest(written: DataFrame) -> DataFrame:
    return written.groupBy("Restaurant_ID").agg(
        F.max_by("stars", "epoch").alias("stars"), F.max_by("reviews", "epoch").alias("reviews")
    )


def state(spark: SparkSession, folder: str) -> DataFrame:
    """Newest state of every restaurant the stream has seen, in the shape of ``tiffin.jobs.rating``."""
    folded = published_version(spark, f"{folder}/folded")
    if not folded:
        return _newest(_epochs(spark, folder))
    base = read_published(spark, f"{folder}/folded", "state", folded).withColumn("epoch", F.lit(-1).cast("bigint"))
    return _newest(base.unionByName(_epochs(spark, folder).where(F.col("epoch") >= folded)))


def fold(spark: SparkSession, folder: str) -> int:
    """Fold the micro-batches written so far into one table and return how many there were. Reading then costs one
    row per restaurant plus what came since; folded micro-batches can be removed."""
    upto = _epochs(spark, folder).agg(F.max("epoch")).first()[0] + 1
    publish(spark, f"{folder}/folded", upto, {"state": state(spark, folder)})
    return upto
