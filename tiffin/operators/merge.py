"""Keyed updates of a snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyed_update(base: DataFrame, delta: DataFrame, key: str, assign: dict[str, Column]) -> DataFrame:
    """``base`` with columns replaced where ``delta`` has the key; other rows pass unchanged.

    ``assign`` maps a column of ``base`` to its new value, written over columns of both frames; delta columns
    must not share names with ``base`` (the key aside). ``delta`` holds a key at most once.
    """
    hit = delta.withColumn("_hit", F.lit(True))
    joined = base.join(hit, key, "left")
    columns = [
        F.when(F.col("_hit"), assign[c]).otherwise(F.col(c)).cast(base.schema[c].dataType).alias(c)
        if c in assign
        else F.col(c)
        for c in base.columns
    ]
    return joined.select(*columns)
