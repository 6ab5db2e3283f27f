"""Data-quality checks driven by the declared model: one report row per rule, violated or not.

All rules of a table that look at one row at a time share a single scan. Key and reference checks share one scan of
each table and one exchange in all: a row gives its value for every check that it takes part in, and values are counted
by check and value. A value that fills a third of a table is folded map-side before it is moved.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.sources import Marketplace
from tiffin.sources.schema import Table


def _required(table: Table) -> dict[str, Column]:
    return {c.name: F.col(c.name).isNull() for c in table.columns if c.required}


def _rules(table: Table) -> dict[str, Column]:
    return {rule: ~F.expr(rule) for rule in table.checks}


def _domains(table: Table) -> dict[str, Column]:
    return {c.name: ~F.col(c.name).isin(*c.domain) for c in table.columns if c.domain}


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _row_report(m: Marketplace, failures, label: str) -> DataFrame:
    """Count, per table and rule, the rows for which the failure condition holds; NULL is not a failure."""
    reports = []
    for name in m.names:
        tests = failures(m.model[name])
        if not tests:
            continue
        slots = {f"t{n}": text for n, text in enumerate(tests)}
        counts = m[name].agg(*[F.count_if(c).alias(s) for s, c in zip(slots, tests.values(), strict=True)])
        pairs = [F.struct(F.lit(text).alias(label), F.col(s).alias("violations")) for s, text in slots.items()]
        reports.append(
            counts.select(F.inline(F.array(*pairs))).select(F.lit(name).alias("table_name"), label, "violations")
        )
    return _union(reports)


def missing_values(m: Marketplace) -> DataFrame:
    """NULLs in columns that must have a value."""
    return _row_report(m, _required, "column_name")


def broken_rules(m: Marketplace) -> DataFrame:
    """Rows that break a declared value rule."""
    return _row_report(m, _rules, "rule")


def out_of_domain(m: Marketplace) -> DataFrame:
    """Values outside a column's closed list."""
    return _row_report(m, _domains, "column_name")


def failing_rows(m: Marketplace, name: str) -> DataFrame:
    """Key of every row of a table that fails a row-level rule, with the rules it fails."""
    table = m.model[name]
    tests = {
        **{f"{c} is missing": t for c, t in _required(table).items()},
        **_rules(table),
        **{f"{c} is not in its list": t for c, t in _domains(table).items()},
    }
    failed = F.array_compact(F.array(*[F.when(t, F.lit(text)) for text, t in tests.items()]))
    return m[name].select(*table.key, failed.alias("failed")).where(F.size("failed") > 0)


def _complete(columns: tuple[str, ...]) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def _value(table: Table, columns: tuple[str, ...]) -> list[Column]:
    """A check's value as a number and a text, so that values of all checks fit into one exchange: one whole number
    as it is, all else as text, several parts with their lengths."""
    if len(columns) == 1 and isinstance(table.by_name[columns[0]].dtype, T.IntegralType):
        return [F.col(columns[0]).cast("bigint").alias("num"), F.lit(None).cast("string").alias("text")]
    parts = [F.col(c).cast("string") for c in columns]
    whole = parts[0] if len(parts) == 1 else F.concat(*[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts])
    return [F.lit(None).cast("bigint").alias("num"), whole.alias("text")]


def _values(m: Marketplace, roles: dict[str, list[tuple[int, bool, tuple[str, ...]]]]) -> DataFrame:
    """Rows of (check, num, text, own) of all tables that have a role; ``own`` is 1 in the checked table and 0 in the
    one referred to. Values with a NULL part are left out."""
    frames = []
    for name, checks in roles.items():
        table = m.model[name]
        each = [
            F.when(
                _complete(columns),
                F.struct(F.lit(n).alias("check"), *_value(table, columns), F.lit(int(own)).alias("own")),
            )
            for n, own, columns in checks
        ]
        frames.append(m[name].select(F.inline(F.array_compact(F.array(*each)))))
    return _union(frames)


def _named(m: Marketplace, checks: list[tuple[str, ...]], names: str, found: DataFrame, counts: list[str]) -> DataFrame:
    """``found`` (check and counts) with the names of the checks; those without a finding count 0."""
    titles = m.spark.createDataFrame([(n, *c) for n, c in enumerate(checks)], f"check int, {names}")
    joined = titles.join(F.broadcast(found), "check", "left")  # at most a row per check
    return joined.select(*titles.columns[1:], *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])


def duplicate_keys(m: Marketplace) -> DataFrame:
    """Values that occur more than once in a primary or unique key. NULLs never collide."""
    checks, roles = [], {}
    for name in m.names:
        for columns in (m.model[name].key, *((u,) for u in m.model[name].unique)):
            roles.setdefault(name, []).append((len(checks), True, tuple(columns)))
            checks.append((name, ",".join(columns)))
    counted = _values(m, roles).groupBy("check", "num", "text").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    found = counted.groupBy("check").agg(
        F.count(F.lit(1)).alias("repeated_values"), F.sum(F.col("n") - 1).alias("extra_rows")
    )
    return _named(m, checks, "table_name string, key_columns string", found, ["repeated_values", "extra_rows"])


def orphan_values(m: Marketplace, name: str, reference) -> DataFrame:
    """Referencing values without a parent and the rows that carry them; a NULL part refers to nothing."""
    renames = dict(zip(reference.parent_columns, reference.columns, strict=True))
    parents = m[reference.parent].select(*[F.col(p).alias(c) for p, c in renames.items()])
    return (
        m[name]
        .where(_complete(reference.columns))
        .groupBy(*reference.columns)
        .agg(F.count(F.lit(1)).alias("n"))
        .join(parents, list(reference.columns), "left_anti")
    )


def orphan_references(m: Marketplace) -> DataFrame:
    """Per reference, the values without a parent and the rows that carry them."""
    checks, roles = [], {}
    for name in m.names:
        for reference in m.model[name].refs:
            roles.setdefault(name, []).append((len(checks), True, tuple(reference.columns)))
            roles.setdefault(reference.parent, []).append((len(checks), False, tuple(reference.parent_columns)))
            checks.append((name, ",".join(reference.columns), reference.parent))
    sides = _values(m, roles).groupBy("check", "num", "text").agg(
        F.sum("own").alias("n"), F.min("own").alias("own")
    )
    found = sides.where(F.col("own") == 1).groupBy("check").agg(
        F.count(F.lit(1)).alias("orphan_values"), F.sum("n").alias("orphan_rows")
    )
    names = "table_name string, reference_columns string, parent string"
    return _named(m, checks, names, found, ["orphan_values", "orphan_rows"])
