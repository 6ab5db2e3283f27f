"""Pages over a unique key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.operators.numbering import number_range


def page_of(df: DataFrame, key: str, page: int, size: int) -> DataFrame:
    """The ``page``-th page (from 0). A deep page does not gather the pages before it in one place."""
    first = page * size + 1
    return number_range(df, key, first, first + size - 1)


def page_after(df: DataFrame, key: str, last_key: int | None, size: int) -> DataFrame:
    """The page that follows ``last_key``; the filter reaches the scan, so cost does not grow with the page."""
    rest = df if last_key is None else df.where(F.col(key) > last_key)
    return rest.orderBy(key).limit(size)
