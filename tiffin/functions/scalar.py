"""Column helpers with exact decimal, NULL and time semantics. All of them stay inside code generation."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHOLE = "decimal(38,0)"


def half_up_ratio(num: Column, den: Column, places: int, num_digits: int = 0, den_digits: int = 0) -> Column:
    """``num / den`` rounded half away from zero at ``places`` digits; NULL if ``den`` is 0 or NULL.

    ``num_digits`` and ``den_digits`` are the decimal digits the inputs carry (2 for money). The quotient is
    taken over whole numbers: decimal division would round twice and be off by one unit for large counts.
    """
    up, down = places + max(den_digits - num_digits, 0), max(num_digits - den_digits, 0)
    n = (num * 10**num_digits).cast(_WHOLE) * F.lit(10**up).cast(_WHOLE)
    d = F.nullif((den * 10**den_digits).cast(_WHOLE) * F.lit(10**down).cast(_WHOLE), F.lit(0).cast(_WHOLE))
    size = F.call_function("div", F.abs(n) * 2 + F.abs(d), F.abs(d) * 2)
    signed = F.when((n < 0) != (d < 0), -size).otherwise(size)
    return (signed.cast("decimal(20,0)") / F.lit(Decimal(10**places))).cast(f"decimal(20,{places})")


def whole_minutes(start: Column, end: Column) -> Column:
    """Full minutes between two times; 45 min 59 s is 45."""
    return F.timestamp_diff("MINUTE", start, end)


def whole_hours(start: Column, end: Column) -> Column:
    return F.timestamp_diff("HOUR", start, end)


def label_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def is_true(flag: Column) -> Column:
    """Two-valued reading of a nullable flag: NULL counts as not set."""
    return F.coalesce(flag, F.lit(False))


def sum_where(condition: Column, value: Column | int = 1) -> Column:
    """Conditional sum with 0, not NULL, for rows that do not qualify."""
    value = F.lit(value) if isinstance(value, int) else value
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def joined_sorted(value: Column, separator: str = ",") -> Column:
    """Distinct values of a group as one sorted string, never cut short; NULL if there are none."""
    return F.when(F.count(value) > 0, F.array_join(F.array_sort(F.collect_set(value)), separator))
