"""Independent SQL for the results of the registered queries, run by DuckDB over the same Parquet tables."""

from oracle.queries import oracle_sql

__all__ = ["oracle_sql"]
