"""The difference of two snapshots of a table as a change feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _fingerprint(columns: Sequence[str]) -> Column:
    """Two hashes of a row. Hashes pass over NULLs, so which columns are NULL is hashed too."""
    of = [*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns]]
    return F.struct(F.xxhash64(*of).alias("h"), F.xxhash64(F.lit(1), *of).alias("g"))


def snapshot_changes(old: DataFrame, new: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows whose ``columns`` differ, as structs ``before`` (NULL for a new row) and ``after`` (NULL for one that has
    gone), with the key's columns beside them; rows that are alike in both snapshots are not there.

    ``key`` is unique in each snapshot and has no NULL. Each snapshot is moved once, by its key; what is joined is
    compared by 128 bits of hashes, and whole rows are carried only for the columns that are asked for. Both sides are
    joined on a unique key, so no key can be hot.
    """

    def side(snapshot: DataFrame, name: str) -> DataFrame:
        return snapshot.select(*key, F.struct(*columns).alias(name), _fingerprint(columns).alias(f"_{name}"))

    joined = side(old, "before").join(side(new, "after"), list(key), "full")
    return joined.where(~F.col("_before").eqNullSafe(F.col("_after"))).select(*key, "before", "after")
