"""Plan shapes that matter at scale: hot keys are split, filters and columns reach the scan, nothing is crossed."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from tiffin.jobs import checkout
from tiffin.plans import analytics, audit, dashboard, views
from tiffin.sources import GENERATIONS, Marketplace, StarSource
from tiffin.sources.sinks import write_bucketed

ROWS = 60_000
HOT = {
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture(scope="module")
def big_data_settings(spark):
    """Treat kilobytes as a cluster would treat gigabytes: nothing is small enough to broadcast."""
    before = {k: spark.conf.get(k, None) for k in HOT}
    for k, v in HOT.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(values, key):
    """A third of the rows share one key."""
    number = F.col("id")
    return F.when(F.xxhash64(number, F.lit(key)) % 3 == 0, key).otherwise(F.abs(F.xxhash64(number)) % values)


def moment(number):
    return F.timestamp_add("MINUTE", number, F.lit("2024-01-01").cast("timestamp_ntz"))


@pytest.fixture(scope="module")
def shop(spark, big_data_settings, tmp_path_factory):
    i = F.col("id")
    ids, people, kitchens = spark.range(0, ROWS, 1, 16), spark.range(3000), spark.range(300)
    root = tmp_path_factory.mktemp("shop")
    customer = dict(UserID=i, User_Name=F.concat(F.lit("u"), "id"), Email=F.lit("e"), Phone_No=i)
    placed = dict(OrderID=i, UserID=hot(3000, 7), Date_Time=moment(i), Total_Amount=F.lit(10))
    frames = {
        "gen1": {
            "users": (people, customer),
            "user_address": (people, dict(Add_ID=i, City=F.lit("Pune"))),
            "user_has_address": (people, dict(Add_ID=i, UserID=i)),
            "restaurant": (kitchens, dict(Restaurant_ID=i, Name=F.concat(F.lit("r"), "id"))),
            "restaurant_address": (kitchens, dict(Restaurant_ID=i, City=F.lit("Pune"))),
            "orders": (ids, placed | dict(Restaurant_ID=hot(300, 9), Status=F.lit("delivered"))),
            "payment": (ids, dict(Transaction_ID=i, Order_ID=i, Amount=F.lit(10), Status=F.lit("Paid"))),
            "delivery_partner": (spark.range(200), dict(Partner_ID=i, Name=F.lit("p"))),
            "delivery": (ids, dict(Delivery_ID=i, OrderID=i, Partner_ID=hot(200, 3), Status=F.lit("Delivered"),
                                   Pickup_Time=moment(i), Delivery_Time=moment(i + 50))),
            "discount": (spark.range(100), dict(Discount_ID=i, OrderID=i, Discount_Amount=F.lit(1))),
            "complaint": (ids, dict(Complaint_ID=i, OrderID=i, Created_At=moment(i))),
            "refund": (ids, dict(Refund_ID=i, OrderID=hot(ROWS, 5), Complaint_ID=hot(ROWS, 11),
                                 Refund_Amount=F.lit(3), Refund_Status=F.lit("Pending"))),
            "cart": (spark.range(5000), dict(Cart_ID=i, UserID=i % 3000, Created_At=moment(i), Status=F.when(
                i % 2 == 0, "Active").otherwise("Abandoned"))),
            "cart_item": (ids, dict(Item_ID=hot(ROWS, 21), Cart_ID=hot(5000, 3), Quantity=F.lit(1))),
            "menu_item": (ids, dict(Item_ID=i, Is_Available=F.lit(True), Price=F.lit(2), Restaurant_ID=i % 300)),
        },
        "gen2": {
            "user": (people, customer),
            "orders": (ids, placed | dict(Order_Status=F.lit("Delivered"))),
            "wallet": (people, dict(Wallet_ID=i, UserID=i, Balance=F.lit(5))),
            "complaint": (ids, dict(Complaint_ID=i, OrderID=hot(ROWS, 5), UserID=hot(3000, 7),
                                    Status=F.lit("Pending"))),
            "cancellation": (ids, dict(Cancellation_ID=i, Order_ID=i, Cancel_At=moment(i))),
            "refund": (ids, dict(Refund_ID=i, OrderID=hot(ROWS, 5), Refund_Amount=F.lit(3))),
        },
    }
    for generation, tables in frames.items():
        for name, (base, columns) in tables.items():
            model = GENERATIONS[generation][name].columns
            values = [columns.get(c.name, F.lit(None)).cast(c.dtype).alias(c.name) for c in model]
            base.select(*values).write.parquet(f"{root}/{generation}/{name}")
    requests = dict(Request_ID=i, UserID=hot(5000, 4) % 3000, Cart_ID=hot(5000, 4))
    ids.select(*[c.cast("bigint").alias(n) for n, c in requests.items()]).write.parquet(f"{root}/requests")
    markets = {g: Marketplace.from_parquet(spark, f"{root}/{g}", g) for g in frames}
    return markets["gen1"], markets["gen2"], spark.read.parquet(f"{root}/requests")


SKEWED = {  # plan, and the join keys on which its facts are hot
    "new_vs_returning": (lambda a, b, q: analytics.new_vs_returning(a), ["UserID"]),
    "abandoned_carts": (lambda a, b, q: analytics.abandoned_carts(a), ["Cart_ID", "Item_ID"]),
    "refund_impact": (
        lambda a, b, q: analytics.refund_impact(a), ["OrderID", "OrderID", "Complaint_ID", "UserID", "Restaurant_ID"]
    ),
    "same_city_customers": (lambda a, b, q: audit.same_city_customers(a, "Pune"), ["Restaurant_ID"]),
    "slow_deliveries": (lambda a, b, q: audit.slow_deliveries(a), ["Partner_ID"]),
    "stale_refunds": (lambda a, b, q: audit.stale_refunds(a, datetime(2026, 1, 1)), ["Complaint_ID", "OrderID", "UserID"]),
    "order_summary": (lambda a, b, q: views.order_summary(a), ["UserID", "Restaurant_ID", "Partner_ID"]),
    "low_wallet_orders": (lambda a, b, q: dashboard.low_wallet_orders(b), ["UserID"]),
    "pending_complaints": (lambda a, b, q: dashboard.pending_complaints(b), ["OrderID", "UserID"]),
    "cancellations_with_refunds": (lambda a, b, q: dashboard.cancellations_with_refunds(b), ["OrderID", "UserID"]),
    "checkout": (lambda a, b, q: checkout.decide(a, q), ["Cart_ID", "Cart_ID"]),
}


@pytest.mark.parametrize("name", SKEWED)
def test_hot_keys_are_split(name, shop):
    plan, keys = SKEWED[name]
    df = plan(*shop)
    df.toPandas()  # of this very frame, so that its plan is the one that ran
    ran = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    split = re.findall(r"Join\(skew=true\) \[(\w+?)#", ran)
    for key in set(keys):
        assert split.count(key) >= keys.count(key), (key, split)


STREAMED = {n for n in registered.queries() if n.endswith("_stream")}


@pytest.mark.parametrize("name", sorted(set(registered.queries()) - STREAMED))
def test_nothing_is_crossed(name, spark, small):
    plan = registered.queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"FileScan parquet \[(.*?)\].*?PushedFilters: \[(.*?), ReadSchema", plan)


def test_scans_read_only_what_is_used(spark, small):
    m = StarSource(spark, small).marketplace("gen1")
    read = {re.sub(r"#\d+L?", "", columns) for columns, _ in scans(analytics.revenue_leaderboard(m))}
    assert read == {
        "o_orderkey",
        "o_orderkey,o_orderstatus,o_totalprice,o_orderdate",
        "s_suppkey,s_name",
    }


def test_filters_reach_the_scan(spark, tmp_path):
    for generation in ("gen1", "gen2"):
        for table in GENERATIONS[generation].values():
            spark.createDataFrame([], table.struct).write.parquet(f"{tmp_path}/{generation}/{table.name}")
    a, b = (Marketplace.from_parquet(spark, f"{tmp_path}/{g}", g) for g in ("gen1", "gen2"))

    def pushed(df):
        return " ".join(filters for _, filters in scans(df))

    assert "EqualTo(OrderID,1)" in pushed(dashboard.order_timeline(b, 1))
    assert "EqualTo(City,Pune)" in pushed(dashboard.available_partners(b, "Pune"))
    period = pushed(audit.mode_share_in_period(a, datetime(2026, 3, 1), datetime(2026, 4, 1), ("UPI",)))
    assert "GreaterThanOrEqual(Date_Time" in period and "LessThan(Date_Time" in period and "Paid" in period
    assert "GreaterThan(Close_Time,23:00:00)" in pushed(audit.late_night_restaurants(a))
    assert "EqualTo(Status,Abandoned)" in pushed(analytics.abandoned_carts(a))


def test_bucketed_facts_join_without_a_shuffle(spark, shop, tmp_path):
    stored = shop[0]
    for name, key in [("orders", "OrderID"), ("payment", "Order_ID")]:
        write_bucketed(stored[name], f"bucketed_{name}", f"{tmp_path}/{name}", key, 8)
    m = Marketplace.from_catalog(spark, "bucketed_").replace(restaurant=stored["restaurant"])
    plan = analytics.revenue_leaderboard(m)._jdf.queryExecution().executedPlan().toString()
    shuffled = re.findall(r"hashpartitioning\((\w+?)#", plan)
    assert shuffled and set(shuffled) == {"Restaurant_ID"}
    assert analytics.revenue_leaderboard(m).collect() == analytics.revenue_leaderboard(stored).collect()
