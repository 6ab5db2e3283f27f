"""Incoming rows: defaults for omitted columns, one spelling for listed values, and the change stamp on rows that
differ from what is stored."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.sources.schema import NOW, Table


def _now(as_of: datetime | None) -> Column:
    return F.localtimestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")


def _spelled(value: Column, domain: tuple[str, ...]) -> Column:
    """The listed spelling of a value that matches it but for case and trailing blanks; other values as they are."""
    folded = F.lower(F.rtrim(value))
    listed = F.coalesce(*[F.when(folded == text.lower(), F.lit(text)) for text in domain])
    return F.coalesce(listed, value)


def fill_defaults(df: DataFrame, table: Table, as_of: datetime | None = None) -> DataFrame:
    """All columns of ``table``: an omitted or NULL value takes the declared default, if there is one, and values
    of closed lists get the listed spelling, so that later comparisons can be exact."""

    def value(column) -> Column:
        given = F.col(column.name) if column.name in df.columns else F.lit(None)
        given = given.cast(column.dtype)
        if column.domain:
            given = _spelled(given, column.domain)
        if column.default is None:
            return given.alias(column.name)
        default = _now(as_of) if column.default == NOW else F.lit(column.default).cast(column.dtype)
        return F.coalesce(given, default).alias(column.name)

    return df.select(*[value(c) for c in table.columns])


def stamp_changes(old: DataFrame, new: DataFrame, table: Table, as_of: datetime | None = None) -> DataFrame:
    """``new`` with the change stamp set on rows that differ from ``old`` and the old stamp kept on the others.

    Columns are compared NULL-safe; rows without a stored counterpart keep the stamp they came with.
    """
    stamp = table.touched
    values = F.struct(*[c.name for c in table.columns if c.name != stamp and c.name not in table.key])
    stored = old.select(*table.key, values.alias("_values"), F.col(stamp).alias("_stamp"))
    fresh = (
        F.when(F.col("_stamp").isNull(), F.col(stamp))
        .when(F.col("_values").eqNullSafe(values), F.col("_stamp"))
        .otherwise(_now(as_of))
    )
    return (
        new.join(stored, list(table.key), "left")
        .withColumn("_fresh", fresh)
        .select(*[F.col("_fresh" if c.name == stamp else c.name).alias(c.name) for c in table.columns])
    )
