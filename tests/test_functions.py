from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tiffin.functions import half_up_ratio, joined_sorted, label_month, sum_where, whole_hours, whole_minutes
from tiffin.session import tune


def exact(n, d, places):
    if not d:
        return None
    scaled = Fraction(n, d) * 10**places
    whole = (abs(scaled) + Fraction(1, 2)).__floor__()
    return (Decimal(whole if scaled >= 0 else -whole) / 10**places).quantize(Decimal(1).scaleb(-places))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-(10**12), 10**12), st.integers(-(10**6), 10**6)), min_size=50, max_size=200))
def test_ratio_is_exact(spark, pairs):
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    for places in (1, 2):
        rows = df.select("n", "d", half_up_ratio(F.col("n"), F.col("d"), places).alias("q")).collect()
        assert all(r.q == exact(r.n, r.d, places) for r in rows)


def test_ratio_does_not_round_twice(spark):
    # 4 999 999 / 10 000 000 rounds to 0.5 at six digits on the way, which must not carry over.
    df = spark.createDataFrame([(14_999_999, 10_000_000)], "n bigint, d bigint")
    assert df.select(half_up_ratio(F.col("n"), F.col("d"), 0)).first()[0] == 1


@pytest.mark.parametrize("amounts", [("10.00", "10.01"), ("0.01", "0.02", "0.02"), ("1.005",)])
def test_money_average(spark, amounts):
    values = [Decimal(a).quantize(Decimal("0.01"), ROUND_HALF_UP) for a in amounts]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(10,2)")
    got = df.agg(half_up_ratio(F.sum("v"), F.count("v"), 2, num_digits=2)).first()[0]
    assert got == exact(int(sum(values) * 100), len(values) * 100, 2)


def test_money_by_money(spark):
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("3.00")), (Decimal("1.00"), Decimal("0.00"))],
                               "a decimal(8,2), b decimal(10,2)")
    rows = df.select(half_up_ratio(F.col("a") * 100, F.col("b"), 1, num_digits=2, den_digits=2)).collect()
    assert [r[0] for r in rows] == [Decimal("33.3"), None]


def test_whole_units_are_cut_off(spark):
    at = datetime(2026, 1, 1)
    rows = [(at, datetime(2026, 1, 1, 0, 45, 59)), (at, datetime(2026, 1, 1, 0, 46)), (at, datetime(2025, 12, 31, 23, 59, 30))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(whole_minutes(F.col("a"), F.col("b"))).collect()] == [45, 46, 0]
    day = spark.createDataFrame([(at, datetime(2026, 1, 2, 0, 59, 59))], "a timestamp_ntz, b timestamp_ntz")
    assert day.select(whole_hours(F.col("a"), F.col("b"))).first()[0] == 24


def test_month_label(spark):
    df = spark.createDataFrame([(datetime(2026, 3, 1),)], "t timestamp_ntz")
    assert df.select(label_month(F.col("t"))).first()[0] == "2026-03"


def test_group_helpers(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 3), (1, "b", None), (2, None, 1)], "k int, c string, v int")
    rows = df.groupBy("k").agg(
        joined_sorted(F.col("c")).alias("names"), sum_where(F.col("c") == "b").alias("n"),
        sum_where(F.col("c") == "b", F.col("v")).alias("v")
    ).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, "a,b", 2, 2), (2, None, 0, 0)]


def test_a_tuned_session_bounds_what_a_task_gets(spark):
    """Larger inputs make more tasks: files are split and blocks joined to a few MB whatever the session had."""
    names = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"]
    for name in names:
        spark.conf.set(name, "128m")
    tune(spark)
    assert [spark.conf.get(name) for name in names] == ["8m", "16m"]


def test_a_table_is_read_in_bounded_parts(spark, tmp_path):
    """A file of many row groups goes to as many tasks as its bytes ask for, not to one a core."""
    folder = str(tmp_path / "t")
    rows = spark.range(0, 4_000_000, 1, 1).select(F.xxhash64("id").alias("h"), F.xxhash64("id", F.lit(1)).alias("g"))
    rows.write.option("parquet.block.size", 2**20).option("compression", "none").parquet(folder)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        parts = tune(spark).read.schema("h bigint, g bigint").parquet(folder).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert parts >= 4  # 64 MB
