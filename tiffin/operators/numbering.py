"""Dense, repeatable row numbers over a unique whole-number key without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.session import stage

BUCKET_ROWS = 100_000
CUTS = 32


def _before(sizes: DataFrame) -> DataFrame:
    """Rows in all buckets before each; ``sizes`` has a row per bucket."""
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))


def _sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))


def dense_numbers(df: DataFrame, key: str, name: str, start: Column | int = 1) -> DataFrame:
    """Number rows ``start, start + 1, ...`` in key order, as an auto-increment column would.

    Rows are range-partitioned by ``key``, which must be unique, and written with their partition's number when this
    is called. The running total is over one row per partition, however the keys are spread, and a re-run task finds
    the same partitions. The numbers depend on the keys only.
    """
    start = F.lit(start) if isinstance(start, int) else start
    ranged = stage(df.repartitionByRange(key).withColumn("_bucket", F.spark_partition_id()), "numbered")
    within = Window.partitionBy("_bucket").orderBy(key)
    return (
        ranged.join(_before(_sizes(ranged)).drop("_size"), "_bucket")
        .withColumn(name, (start + F.col("_before") + F.row_number().over(within) - 1).cast("bigint"))
        .drop("_bucket", "_before")
    )


def number_range(df: DataFrame, key: str, first: int, last: int, rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows whose number in key order lies in ``first .. last``, in that order. ``key`` is unique.

    A page within the first ``rows`` is read off directly. For a deeper one the keys are cut into ``CUTS`` ranges of
    about equally many rows, however the keys are spread, the rows before each cut are counted exactly, and only the
    ranges that hold the page are cut again, until they are short. Each round is a scan of the ranges left, with the
    bounds as a filter that reaches the file; the driver holds ``CUTS`` keys and counts.
    """
    before, part = 0, df
    left = None if last <= rows else df.count()
    while left is not None and left > rows and first <= last:
        shares = F.array(*[F.lit(i / CUTS) for i in range(1, CUTS)])
        cuts = sorted(set(part.agg(F.percentile_approx(key, shares, 100 * CUTS)).first()[0]))
        counts = [before, *[before + n for n in part.agg(*[F.count_if(F.col(key) < c) for c in cuts]).first()], before + left]
        low = max(i for i, n in enumerate(counts[:-1]) if n < first or i == 0)
        high = min((i for i, n in enumerate(counts) if i > low and n >= last), default=len(counts) - 1)
        if counts[high] - counts[low] == left:
            break  # not to be cut any more
        if low:
            part = part.where(F.col(key) >= cuts[low - 1])
        if high <= len(cuts):
            part = part.where(F.col(key) < cuts[high - 1])
        before, left = counts[low], counts[high] - counts[low]
    return part.orderBy(key).offset(first - before - 1).limit(max(0, last - first + 1))
