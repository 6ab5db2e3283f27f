"""Wallet credits from a stream of refund changes.

A change carries the refund before (NULL for a new one) and after, as an update trigger sees it, so the step into
``Completed`` shows in the change itself and is filtered before anything is shuffled. No state is kept: a change that
is delivered again is found among the stored credits of its own day, whenever it comes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tiffin.jobs.refunds import DONE

_REFUND = "struct<Refund_ID:bigint,Wallet_ID:bigint,Refund_Amount:decimal(18,2),Refund_Status:string>"
FEED = f"before {_REFUND}, after {_REFUND}, at timestamp_ntz"
CREDITS = "Refund_ID bigint, Wallet_ID bigint, Amount decimal(18,2), at timestamp_ntz"


def due(feed: DataFrame) -> DataFrame:
    """The credits that changes make due. A refund first seen as completed earns none."""
    return feed.where((F.col("before.Refund_Status") != DONE) & (F.col("after.Refund_Status") == DONE)).select(
        "after.Refund_ID", "after.Wallet_ID", F.col("after.Refund_Amount").alias("Amount"), "at"
    )


def credits(spark: SparkSession, folder: str) -> DataFrame:
    """What the stream has written so far (``CREDITS``)."""
    return _stored(spark, folder).drop("day", "epoch")


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{CREDITS}, day date, epoch bigint").parquet(f"{folder}/credits")


def start(feed: DataFrame, folder: str, **trigger) -> StreamingQuery:
    """Write one credit per refund and time of completion into ``folder``, a partition for each day and epoch."""

    def add(batch: DataFrame, number: int) -> None:
        batch = batch.dropDuplicates(["Refund_ID", "at"]).withColumn("day", F.to_date("at")).persist()
        fresh = batch
        if number:
            days = [r["day"] for r in batch.select("day").distinct().collect()]  # as many as the calendar has
            earlier = _stored(batch.sparkSession, folder).where(F.col("epoch") < number)
            earlier = earlier.where(F.col("day").isin(days) | F.col("day").isNull())
            same = (batch["Refund_ID"] == earlier["Refund_ID"]) & batch["at"].eqNullSafe(earlier["at"])
            fresh = batch.join(earlier, same, "left_anti")
        # A micro-batch that is run again replaces what it wrote before.
        numbered = fresh.withColumn("epoch", F.lit(number).cast("bigint"))
        writer = numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("day", "epoch").parquet(f"{folder}/credits")
        batch.unpersist()

    return (
        due(feed)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
