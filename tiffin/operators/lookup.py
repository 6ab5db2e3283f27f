"""Looking up one row per key from a fact table whose keys may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(fact: DataFrame, rows: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """Join ``fact`` with a *computed* frame that has few rows per ``key`` (an aggregate or a join on that key).

    The adaptive skew join cuts a hot partition of the fact into pieces only if both inputs come straight from an
    exchange. A computed frame is already partitioned by the key and would bring none, leaving the hot key in one
    task. Joining on the key's hash as well asks for an exchange of the small side. Stored tables do not need
    this: joined directly, they are read through an exchange anyway.
    """
    columns = [key] if isinstance(key, str) else list(key)
    return (
        fact.withColumn("_hash", F.xxhash64(*columns))
        .join(rows.withColumn("_hash", F.xxhash64(*columns)), [*columns, "_hash"], how)
        .drop("_hash")
    )
