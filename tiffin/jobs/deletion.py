"""Deleting rows together with what depends on them.

Along a *cascade* reference the dependent rows go too, transitively; a *restrict* reference from any row to a row
that would go protects it. A requested row is deleted with everything it takes along, or not at all; requests are
judged one by one against the stored tables. The reference graph has no cycle, so the walk ends after as many
steps as it is deep, whatever the data.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.operators import attach
from tiffin.sources import Marketplace


@dataclass(frozen=True)
class Deletion:
    deleted: dict[str, DataFrame]  # keys to remove, by table
    blocked: DataFrame  # requested keys that something still needs, with the tables that do

    def apply(self, m: Marketplace) -> Marketplace:
        """The marketplace without the deleted rows."""
        kept = {n: m[n].join(keys, list(m.model[n].key), "left_anti") for n, keys in self.deleted.items()}
        return m.replace(**kept)


def _edges(m: Marketplace, parent: str, on_delete: str):
    return [
        (child, r) for child in m.names for r in m.model[child].refs if r.parent == parent and r.on_delete == on_delete
    ]


def _referring(m: Marketplace, reached: DataFrame, child: str, reference) -> DataFrame:
    """Rows of ``child`` that refer to reached parent rows, still tagged with the request they belong to."""
    targets = reached.select(
        "_request", *[F.col(p).alias(c) for p, c in zip(reference.parent_columns, reference.columns, strict=True)]
    )
    return attach(m[child], targets, list(reference.columns))


def _holders(m: Marketplace, reached: DataFrame, references: list, bits: dict[str, int]) -> list[DataFrame]:
    """Requests protected by rows that refer to reached ones, with the tables of those rows as a mask of ``bits``.

    References to the same parent columns are folded together: each value is moved once by every table that has it, and
    met with the reached rows once, however many tables may hold them.
    """
    found = []
    for parent_columns in dict.fromkeys(r.parent_columns for _, r in references):
        used = [
            m[child].select(
                *[F.col(c).alias(p) for p, c in zip(parent_columns, r.columns, strict=True)],
                F.lit(1 << bits[child]).cast("bigint").alias("_mask"),
            )
            for child, r in references
            if r.parent_columns == parent_columns
        ]
        masks = reduce(DataFrame.unionByName, used).groupBy(*parent_columns).agg(F.bit_or("_mask").alias("_mask"))
        held = reached.select("_request", *parent_columns).join(masks, list(parent_columns))
        found.append(held.select("_request", "_mask"))
    return found


def plan_deletion(m: Marketplace, name: str, keys: DataFrame) -> Deletion:
    """What deleting the rows of table ``name`` with the given primary keys does."""
    key = list(m.model[name].key)
    request = F.struct(*key).alias("_request")
    bits = {table: n for n, table in enumerate(sorted(m.names))}
    rows = m[name].join(keys.select(*key).distinct(), key, "left_semi").select("*", request)
    reached: dict[str, list[DataFrame]] = {}
    holders = []
    frontier = [(name, rows)]
    while frontier:
        table, frame = frontier.pop()
        reached.setdefault(table, []).append(frame.select("_request", *m.model[table].key))
        holders += _holders(m, frame, _edges(m, table, "restrict"), bits)
        frontier += [(child, _referring(m, frame, child, r)) for child, r in _edges(m, table, "cascade")]

    if holders:
        held = reduce(DataFrame.unionByName, holders).groupBy("_request").agg(F.bit_or("_mask").alias("_mask"))
        names = [F.when(F.getbit("_mask", F.lit(n)) == 1, table) for table, n in bits.items()]
        held = held.select("_request", F.array_compact(F.array(*names)).alias("needed_by"))
    else:
        held = rows.select("_request", F.array().cast("array<string>").alias("needed_by")).limit(0)
    deleted = {
        table: reduce(DataFrame.unionByName, frames)
        .join(held.select("_request"), "_request", "left_anti")
        .select(*m.model[table].key)
        .distinct()
        for table, frames in reached.items()
    }
    return Deletion(deleted, held.select("_request.*", "needed_by"))
