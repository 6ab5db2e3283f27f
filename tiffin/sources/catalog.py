"""A marketplace: one generation of tables, each a lazily made DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tiffin.sources.schema import GENERATIONS, Table


class Marketplace:
    """Maps table names to DataFrames. A table is only planned once a query asks for it."""

    def __init__(self, spark: SparkSession, generation: str, makers: Mapping[str, Callable[[], DataFrame]]):
        self.spark = spark
        self.generation = generation
        self.model: dict[str, Table] = GENERATIONS[generation]
        unknown = set(makers) - set(self.model)
        if unknown:
            raise KeyError(f"no such tables in {generation}: {sorted(unknown)}")
        self._makers = dict(makers)
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._makers[name]()
        return self._frames[name]

    def __contains__(self, name: str) -> bool:
        return name in self._makers

    @property
    def names(self) -> list[str]:
        return [n for n in self.model if n in self._makers]

    def replace(self, **frames: DataFrame) -> Marketplace:
        """The same marketplace with some tables swapped, e.g. for a newer snapshot."""
        makers = {**self._makers, **{n: (lambda df=df: df) for n, df in frames.items()}}
        return Marketplace(self.spark, self.generation, makers)

    def register_views(self) -> None:
        for name in self.names:
            self[name].createOrReplaceTempView(name)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, generation: str = "gen1") -> Marketplace:
        """Tables stored as ``root/<table>``; the schema is declared, so no file is opened to plan a query."""
        model = GENERATIONS[generation]

        def reader(table: Table):
            return lambda: spark.read.schema(table.struct).parquet(f"{root}/{table.name}")

        return cls(spark, generation, {n: reader(t) for n, t in model.items()})

    @classmethod
    def from_catalog(cls, spark: SparkSession, prefix: str = "", generation: str = "gen1") -> Marketplace:
        """Catalog tables named ``<prefix><table>``, which may be bucketed."""
        return cls(
            spark, generation, {n: (lambda n=n: spark.table(f"{prefix}{n}")) for n in GENERATIONS[generation]}
        )

    @classmethod
    def from_rows(
        cls, spark: SparkSession, rows: Mapping[str, Iterable[tuple]], generation: str = "gen1"
    ) -> Marketplace:
        """Literal rows in declared column order; shorter rows leave the trailing columns NULL."""
        model = GENERATIONS[generation]

        def maker(table: Table):
            width = len(table.columns)
            full = [tuple(r) + (None,) * (width - len(r)) for r in rows.get(table.name, ())]
            return lambda: spark.createDataFrame(full, table.struct)

        return cls(spark, generation, {n: maker(t) for n, t in model.items()})
