"""Time ranges over facts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_period(df: DataFrame, column: str, start: datetime, end: datetime, month: str = "month") -> DataFrame:
    """Rows of ``[start, end)``. A fact laid out by month (``sinks.write_by_month``) reads only the months touched."""
    low, high = (F.lit(t).cast("timestamp_ntz") for t in (start, end))
    inside = (F.col(column) >= low) & (F.col(column) < high)
    if month in df.columns:
        inside &= F.col(month).between(f"{start:%Y-%m}", f"{end:%Y-%m}")
    return df.where(inside)
