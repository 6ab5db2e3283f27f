"""Every registered query against its SQL over the whole tables, and the table definitions against theirs."""

import pytest
from compare import connect, difference

import __spark_entry__ as registered
from oracle.tables import TABLES, with_tables
from tiffin.sources import StarSource

# The subpackage llm has tests of its own.
CORPUS, CORPUS_SQL = registered._corpus()
QUERIES = {k: v for k, v in registered.queries().items() if k not in CORPUS}
SQL = {k: v for k, v in registered.oracle_sql().items() if k not in CORPUS_SQL}


@pytest.fixture(scope="module")
def duck(medium):
    return connect(medium)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query(name, spark, medium, duck):
    assert difference(QUERIES[name](spark, medium), duck, SQL[name]) is None


@pytest.mark.parametrize("name", TABLES)
def test_table(name, spark, medium, duck):
    generation, table = name.split("_", 1)
    df = StarSource(spark, medium).marketplace({"g1": "gen1", "g2": "gen2"}[generation])[table]
    sql = with_tables(f"SELECT * FROM {name}")
    columns = [d[0] for d in duck.execute(sql).description]
    assert difference(df.select(*columns), duck, sql) is None


def test_no_query_is_empty(duck):
    empty = [n for n, sql in SQL.items() if not duck.execute(f"SELECT count(*) FROM ({sql})").fetchone()[0]]
    assert empty == []


def test_entry(spark):
    assert registered.entry(spark).count() > 0
