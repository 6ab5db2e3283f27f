"""Write-side jobs against plain sequential programs over the same rows."""

import random
from datetime import datetime, timedelta

import pytest
from market import at, collected, market, money, order, paid, restaurant, rows, users
from pyspark.sql import functions as F

import __spark_entry__ as registered
from tiffin.jobs import checkout, deletion, intake, ledger, quality, rating, refunds
from tiffin.operators import dense_numbers, numbering, snapshot_changes
from tiffin.operators.numbering import number_range
from tiffin.plans import audit
from tiffin.sources import Marketplace, sinks

CHANGES = "before struct<Restaurant_ID:bigint,Rating:float>, after struct<Restaurant_ID:bigint,Rating:float>"


def test_rating_follows_insert_update_move_and_delete(spark):
    m = market(
        spark,
        "gen1",
        restaurant=[restaurant(i, Rating=2.5) for i in (1, 2, 3, 4)],
        review=[dict(Review_ID=1, Restaurant_ID=1, Rating=4.0), dict(Review_ID=2, Restaurant_ID=2, Rating=3.1)],
    )
    state = rating.review_state(m["review"])

    def after(*changes):
        now = rating.apply_changes(state, spark.createDataFrame(list(changes), CHANGES))
        return {r.Restaurant_ID: round(r.Rating, 2) for r in rating.update_restaurants(m["restaurant"], now).collect()}

    assert after() == {1: 4.0, 2: 3.1, 3: 2.5, 4: 2.5}
    assert after((None, (1, 5.0))) == {1: 4.5, 2: 3.1, 3: 2.5, 4: 2.5}
    assert after(((1, 4.0), None)) == {1: 0.0, 2: 3.1, 3: 2.5, 4: 2.5}
    assert after(((2, 3.1), (3, 3.1))) == {1: 4.0, 2: 0.0, 3: 3.1, 4: 2.5}
    assert after((None, (1, 3.3)), ((1, 3.3), (1, 3.4)), ((1, 3.4), None)) == {1: 4.0, 2: 3.1, 3: 2.5, 4: 2.5}


def test_only_the_step_to_completed_earns_a_credit(spark):
    def refund(i, status):
        return dict(Refund_ID=i, Wallet_ID=1, Refund_Amount=money("10.00"), Refund_Status=status)

    old = market(spark, "gen1", refund=[refund(1, "Pending"), refund(2, "Completed"), refund(3, "Rejected"), refund(5, "Pending")])
    new = market(
        spark,
        "gen1",
        refund=[refund(1, "Completed"), refund(2, "Completed"), refund(3, "Completed"), refund(4, "Completed"), refund(5, "Rejected")],
        wallet=[dict(Wallet_ID=1, Balance=money("5.00"), UserID=1), dict(Wallet_ID=2, Balance=money("7.00"), UserID=2)],
        wallet_transaction=[dict(Transaction_ID=40, Wallet_ID=2, Type="Debit", Amount=money("1.00"))],
    )
    credits = refunds.completed_refunds(old["refund"], new["refund"])
    assert sorted(r.Refund_ID for r in credits.collect()) == [1, 3]
    wallets = {r.Wallet_ID: r.Balance for r in refunds.credit_wallets(new["wallet"], credits).collect()}
    assert wallets == {1: money("25.00"), 2: money("7.00")}
    ledger_rows = collected(refunds.credit_ledger(new["wallet_transaction"], credits, at(1)).orderBy("Transaction_ID"))
    assert ledger_rows == [(1, 41, "Credit", money("10.00"), at(1)), (1, 42, "Credit", money("10.00"), at(1))]


def fold(events):
    """Wallet events in order, one after the other."""
    balances, done = {}, {}
    for wallet, when, kind, number, cents, opening in sorted(events, key=lambda e: (e[0], e[1], e[2], e[3])):
        balance = balances.get(wallet, opening)
        covered = kind == ledger.CREDIT or balance >= cents
        if covered:
            balance += cents if kind == ledger.CREDIT else -cents
        balances[wallet], done[wallet, kind, number] = balance, (covered, balance)
    return done


@pytest.mark.parametrize("slice_rows", [37, 250, 100_000])
@pytest.mark.parametrize("opening, credit_share", [(0, 0.5), (2_000, 0.1), (10**9, 0.2), (0, 0.0)])
def test_settlement_equals_a_sequential_fold(spark, slice_rows, opening, credit_share):
    dice = random.Random(slice_rows + opening)
    start = datetime(2024, 1, 1)
    events = [
        (
            7 if dice.random() < 0.4 else dice.randrange(60),
            start + timedelta(minutes=dice.randrange(300)),
            ledger.CREDIT if dice.random() < credit_share else ledger.DEBIT,
            n,
            dice.randrange(1, 900),
            opening,
        )
        for n in range(1_500)
    ]
    settled = ledger.settle_events(spark, spark.createDataFrame(events, ledger.EVENTS), slice_rows)
    assert {(r.Wallet_ID, r.kind, r.id): (r.accepted, r.balance) for r in settled.collect()} == fold(events)


def test_rejected_debit_leaves_the_balance_for_the_next(spark):
    m = market(
        spark,
        "gen1",
        wallet=[dict(Wallet_ID=5, UserID=1, Balance=money("100.00"))],
        orders=[order(i) for i in (1, 2, 3, 4)] + [order(5, UserID=2)],
    )
    payments = rows(
        "gen1",
        "payment",
        *[paid(i, i, a, "Wallet") | dict(Paid_At=at(i)) for i, a in [(1, "80.00"), (2, "50.00"), (3, "20.00"), (5, "1.00")]],
        paid(4, 4, "1.00", "Wallet", "Pending"),
    )
    inserted = spark.createDataFrame(payments, m.model["payment"].struct)
    none = spark.createDataFrame([], "Credit_ID bigint, Wallet_ID bigint, Amount decimal(10,2), at timestamp_ntz")
    result = ledger.settle(m, inserted, none, at(9))
    decided = {r.Transaction_ID: (r.accepted, r.reason, r.balance_after) for r in result.decisions.collect()}
    assert decided == {
        1: (True, None, money("20.00")),
        2: (False, "insufficient_balance", money("20.00")),
        3: (True, None, money("0.00")),
        5: (False, "no_wallet", None),
    }
    assert [r.Balance for r in result.wallets.collect()] == [money("0.00")]
    assert sorted(collected(result.ledger))[0] == (5, 1, "Debit", money("80.00"), at(9))
    assert result.ledger.count() == 2


def carts(spark):
    return market(
        spark,
        "gen1",
        cart=[dict(Cart_ID=i, UserID=u, Status=s, Created_At=at(1)) for i, u, s in
              [(1, 1, "Active"), (2, 1, "Active"), (3, 1, "Active"), (4, 2, "Active"), (5, 1, "Abandoned")]],
        cart_item=[dict(Cart_ID=c, Item_ID=i, Quantity=q) for c, i, q in
                   [(1, 1, 2), (1, 2, 1), (2, 1, 1), (2, 3, 1), (4, 1, 1), (5, 1, 1)]],
        menu_item=[
            dict(Item_ID=1, Price=money("10.00"), Restaurant_ID=8, Is_Available=True),
            dict(Item_ID=2, Price=money("5.50"), Restaurant_ID=9, Is_Available=True),
            dict(Item_ID=3, Price=money("5.50"), Restaurant_ID=9, Is_Available=False),
        ],
        orders=[order(70)],
    )


REQUESTS = [(10, 1, 1), (11, 1, 1), (12, 1, 2), (13, 1, 3), (14, 1, 4), (15, 1, 5), (16, 1, 99), (9, 2, 1), (17, 2, 4)]
REASONS = {
    11: "no_active_cart", 12: "unavailable_item", 13: "empty_cart", 14: "no_active_cart", 15: "no_active_cart",
    16: "no_active_cart", 9: "no_active_cart",
}


def check_checkout(done):
    assert {r.Request_ID: r.reason for r in done.rejected.collect()} == REASONS
    orders = sorted((r.OrderID, r.UserID, r.Restaurant_ID, r.Status, r.Total_Amount) for r in done.orders.collect())
    assert orders == [(71, 1, 9, "pending", money("25.50")), (72, 2, 8, "pending", money("10.00"))]
    assert sorted(collected(done.order_items)) == [
        (1, 71, 2, money("10.00")), (1, 72, 1, money("10.00")), (2, 71, 1, money("5.50"))
    ]
    assert {r.Cart_ID: r.Status for r in done.carts.collect()} == {
        1: "Checked Out", 2: "Active", 3: "Active", 4: "Checked Out", 5: "Abandoned"
    }


def test_checkout_outcomes(spark):
    requests = spark.createDataFrame(REQUESTS, "Request_ID bigint, UserID bigint, Cart_ID bigint")
    check_checkout(checkout.checkout(carts(spark), requests, at(2)))


def test_checkout_is_published_as_one_version(spark, tmp_path):
    requests = spark.createDataFrame(REQUESTS, "Request_ID bigint, UserID bigint, Cart_ID bigint")
    root = str(tmp_path / "shop")
    assert sinks.published_version(spark, root) == 0
    for version in (1, 1, 2):  # a repeated run replaces what it wrote before
        check_checkout(checkout.place_orders(carts(spark), requests, root, version, at(2)))
        assert sinks.published_version(spark, root) == version


def test_numbers_are_dense_in_key_order(spark):
    keys = random.Random(3).sample(range(10_000), 500)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    numbered = dense_numbers(df, "k", "n", start=101)
    assert sorted(collected(numbered)) == [(k, n) for n, k in enumerate(sorted(keys), 101)]
    assert sorted(collected(number_range(df, "k", 90, 140, rows=64))) == [(k,) for k in sorted(keys)[89:140]]
    assert number_range(df.limit(0), "k", 1, 10).count() == 0


def test_numbers_of_sparse_keys_need_few_ranges(spark):
    df = spark.range(20_000).select(F.xxhash64("id").alias("k")).unionByName(
        spark.createDataFrame([(-(2**63),), (2**63 - 1,)], "k bigint")
    )
    keys = sorted(r.k for r in df.collect())
    assert sorted(collected(dense_numbers(df, "k", "n"))) == [(k, n) for n, k in enumerate(keys, 1)]
    assert sorted(collected(number_range(df, "k", 90, 140, rows=64))) == [(k,) for k in keys[89:140]]
    ranged = df.repartitionByRange("k").withColumn("_bucket", F.spark_partition_id())
    assert numbering._sizes(ranged).count() <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_defaults_fill_what_is_omitted(spark):
    m = market(spark, "gen1")
    given = spark.createDataFrame([(1, None), (2, "Cancelled "), (3, "eaten")], "OrderID bigint, Status string")
    filled = intake.fill_defaults(given, m.model["orders"], at(1)).orderBy("OrderID")
    assert filled.columns == [c.name for c in m.model["orders"].columns]
    assert [(r.OrderID, r.Status, r.Date_Time, r.UserID) for r in filled.collect()] == [
        (1, "pending", at(1), None), (2, "cancelled", at(1), None), (3, "eaten", at(1), None)
    ]


def test_stamp_moves_only_when_something_changed(spark):
    old = market(spark, "gen1", users=[u | dict(Updated_At=at(1)) for u in users(1, 2, 3)])
    new = old["users"].withColumn("User_Name", F.when(F.col("UserID") == 2, F.lit(None)).otherwise(F.col("User_Name")))
    extra = old["users"].limit(1).withColumn("UserID", F.lit(9).cast("bigint")).withColumn("Updated_At", F.lit(at(5)))
    stamped = intake.stamp_changes(old["users"], new.unionByName(extra), old.model["users"], at(7))
    assert {r.UserID: r.Updated_At for r in stamped.collect()} == {1: at(1), 2: at(7), 3: at(1), 9: at(5)}


def test_quality_reports_each_kind_of_fault(spark):
    m = market(
        spark,
        "gen1",
        users=users(1, 1, 2),
        orders=[order(1), order(2, UserID=7, Status="eaten", Total_Amount=money("-1.00")), order(3, UserID=None)],
        restaurant=[restaurant(1, Close_Time="09:00:00", Owner_UserID=1)],
        menu_category=[dict(Category_Name="Rice", Restaurant_ID=1)],
        menu_item=[dict(Item_ID=1, Category_Name="Rice", Restaurant_ID=1), dict(Item_ID=2, Category_Name="Rice"),
                   dict(Item_ID=3, Category_Name="Soup", Restaurant_ID=1)],
    )

    def found(report):
        return {tuple(r)[:-1]: r[-1] for r in report.collect() if r[-1]}

    missing = found(quality.missing_values(m))
    assert missing["orders", "UserID"] == 1 and ("orders", "Status") not in missing
    assert found(quality.broken_rules(m)) == {
        ("orders", "Total_Amount >= 0"): 1, ("restaurant", "Close_Time > Open_Time"): 1
    }
    assert found(quality.out_of_domain(m)) == {("orders", "Status"): 1}
    duplicates = found(quality.duplicate_keys(m))
    assert duplicates == {("users", "UserID", 1): 1, ("users", "Phone_No", 1): 1, ("users", "Email", 1): 1}
    assert found(quality.orphan_references(m)) == {
        ("orders", "UserID", "users", 1): 1, ("menu_item", "Category_Name,Restaurant_ID", "menu_category", 1): 1
    }
    to_users, _ = m.model["orders"].refs
    assert collected(quality.orphan_values(m, "orders", to_users)) == [(7, 1)]
    failing = {r.OrderID: set(r.failed) for r in quality.failing_rows(m, "orders").collect()}
    assert failing[2] >= {"Total_Amount >= 0", "Status is not in its list"} and "UserID is missing" in failing[3]


def remaining(m):
    return {n: sorted(r[0] for r in m[n].select(*m.model[n].key).collect()) for n in m.names if m[n].count()}


def test_deletion_takes_dependents_along_or_is_blocked(spark):
    m = market(
        spark,
        "gen1",
        users=users(1, 2, 3),
        cart=[dict(Cart_ID=i, UserID=u) for i, u in [(1, 1), (2, 2), (3, 2)]],
        cart_item=[dict(Cart_ID=c, Item_ID=i) for c, i in [(1, 1), (2, 1), (3, 1)]],
        wallet=[dict(Wallet_ID=i, UserID=i) for i in (1, 2, 3)],
        wallet_transaction=[dict(Transaction_ID=i, Wallet_ID=w) for i, w in [(1, 1), (2, 2)]],
        wallet_topup=[dict(Transaction_ID=2, Wallet_ID=2)],
        orders=[order(1, UserID=1)],
        refund=[dict(Refund_ID=1, OrderID=1, Wallet_ID=3)],
    )
    everyone = m["users"]
    plan = deletion.plan_deletion(m, "users", everyone)
    blocked = {r.UserID: r.needed_by for r in plan.blocked.collect()}
    assert blocked == {1: ["orders"], 3: ["refund"]}  # 3 through the wallet it would take along
    assert remaining(plan.apply(m)) == {
        "users": [1, 3], "cart": [1], "cart_item": [1], "wallet": [1, 3], "wallet_transaction": [1], "orders": [1],
        "refund": [1],
    }


def test_deletion_without_references(spark):
    m = market(spark, "gen1", cuisine=[dict(Cuisine="Thai", Restaurant_ID=1), dict(Cuisine="Cafe", Restaurant_ID=1)])
    plan = deletion.plan_deletion(m, "cuisine", m["cuisine"].where("Cuisine = 'Thai'"))
    assert plan.blocked.count() == 0
    assert [r.Cuisine for r in plan.apply(m)["cuisine"].collect()] == ["Cafe"]


def test_holders_of_a_row_are_met_in_one_join(spark):
    """Every table that holds a row is named, once, however often and by however many rows it holds it."""
    m = market(
        spark,
        "gen1",
        orders=[order(i) for i in (1, 2, 3, 4)],
        payment=[paid(1, 1), paid(2, 2), dict(paid(3, 3), Order_ID=None)],
        delivery=[dict(Delivery_ID=i, OrderID=o) for i, o in [(1, 1), (2, 4)]],
        complaint=[dict(Complaint_ID=i, OrderID=o) for i, o in [(1, 1), (2, 1), (3, None)]],
        refund=[dict(Refund_ID=1, OrderID=1)],
        order_item=[dict(OrderID=o, Item_ID=1) for o in (1, 3)],
    )
    plan = deletion.plan_deletion(m, "orders", m["orders"].where("OrderID <> 4"))
    blocked = {r.OrderID: r.needed_by for r in plan.blocked.collect()}
    assert blocked == {1: ["complaint", "delivery", "payment", "refund"], 2: ["payment"]}
    assert remaining(plan.apply(m))["order_item"] == [1]
    joins = plan.blocked._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    assert joins == 2  # the requests and what holds them, not one for each table


def test_every_payment_blocks_a_purge(spark, monkeypatch):
    """A payment that failed holds its order like any other; only the query on what is deleted is asked without them."""
    old = at(1).replace(year=1996)
    m = market(
        spark,
        "gen1",
        orders=[order(1, Date_Time=old), order(2, Date_Time=old), order(3, Date_Time=old), order(4)],
        payment=[paid(1, 1, status="Failed"), paid(2, 2), paid(3, 4, status="Failed")],
    )
    monkeypatch.setattr(registered.StarSource, "marketplace", lambda self, generation: m)
    run = lambda name: sorted(collected(registered.queries()[name](spark, "")))
    assert run("dq6_order_purge_blocked") == [(1, "payment"), (2, "payment")]
    assert run("dq6_order_purge_deleted") == [("orders", "1"), ("orders", "3")]


def test_facts_by_month_are_pruned(spark, tmp_path):
    path = str(tmp_path / "orders")
    m = market(spark, "gen1", orders=[order(i, Date_Time=at(1, month=i)) for i in (1, 2, 3)])
    sinks.write_by_month(m["orders"], path, "Date_Time")
    sinks.append(m["orders"].limit(1).withColumn("month", F.lit("2026-01")), str(tmp_path / "more"))
    one = spark.read.parquet(path).where(F.col("month") == "2026-02")
    assert "PartitionFilters: [isnotnull(month" in one._jdf.queryExecution().executedPlan().toString()
    assert [r.OrderID for r in one.collect()] == [2]


def test_period_report_reads_its_months_only(spark, tmp_path):
    root = str(tmp_path)
    m = market(spark, "gen1", orders=[order(i, Date_Time=at(1, month=i)) for i in (1, 2, 3)], payment=[paid(i, i) for i in (1, 2, 3)])
    sinks.write_by_month(m["orders"], f"{root}/orders", "Date_Time")
    sinks.append(m["payment"], f"{root}/payment")
    report = audit.mode_share_in_period(Marketplace.from_parquet(spark, root), at(1, month=2), at(1, month=3), ("UPI",))
    assert "PartitionFilters: [isnotnull(month" in report._jdf.queryExecution().executedPlan().toString()
    assert collected(report) == [("UPI", 1, money("100.00"), money("100.00"))]


def test_pages_do_not_depend_on_the_spread_of_keys(spark):
    """One key far away from all others: a deep page is found by counting, and only a short range is sorted."""
    df = spark.range(1, 20_001).toDF("k").unionByName(spark.createDataFrame([(2**62,), (-(2**62),)], "k bigint"))
    for first in (1, 2, 64, 65, 9_990, 19_990, 20_002):
        page = number_range(df, "k", first, first + 24, rows=64)
        keys = sorted([*range(1, 20_001), 2**62, -(2**62)])
        assert [r.k for r in page.collect()] == keys[first - 1 : first + 24]
        assert first <= 64 or "Filter" in page._jdf.queryExecution().optimizedPlan().toString()
    assert number_range(df, "k", 30_000, 30_010, rows=64).count() == 0
    same = spark.createDataFrame([(5,)] * 300, "k bigint")
    assert number_range(same, "k", 100, 110, rows=16).count() == 11  # keys that can't be cut


def test_snapshot_changes(spark):
    schema = "id bigint, part int, a string, b double, other int"
    old = [(1, 1, "x", 1.0, 0), (2, 1, None, 2.0, 0), (3, 1, "z", None, 0), (4, 1, "same", 4.0, 0), (4, 2, "gone", 0.0, 0), (6, 1, None, None, 0)]
    new = [(1, 1, "y", 1.0, 0), (2, 1, "", 2.0, 0), (3, 1, None, None, 0), (4, 1, "same", 4.0, 9), (5, 1, "new", 5.0, 0), (6, 1, None, None, 1)]
    a, b = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    rows = snapshot_changes(a, b, ["id", "part"], ["a", "b"]).collect()
    plain = lambda x: None if x is None else tuple(x)
    assert sorted((r.id, r.part, plain(r.before), plain(r.after)) for r in rows) == [
        (1, 1, ("x", 1.0), ("y", 1.0)), (2, 1, (None, 2.0), ("", 2.0)), (3, 1, ("z", None), (None, None)),
        (4, 2, ("gone", 0.0), None), (5, 1, None, ("new", 5.0)),
    ]
    assert snapshot_changes(a, a, ["id", "part"], ["a", "b"]).count() == 0
    assert snapshot_changes(a.limit(0), a, ["id", "part"], ["a"]).count() == len(old)


def test_appending_once(spark, tmp_path):
    root = str(tmp_path / "log")
    rows = lambda *v: {"t": spark.createDataFrame([(x,) for x in v], "v bigint"), "u": spark.createDataFrame([(-x,) for x in v], "v bigint")}
    read = lambda name: sorted((r.batch, r.v) for r in sinks.read_appended(spark, root, name, "v bigint").collect())
    assert not sinks.appended(spark, root)
    assert sinks.append_once(spark, root, "one", rows(1, 2))
    assert not sinks.append_once(spark, root, "one", rows(1, 2))
    # An attempt that died before its commit, and one that committed at the same time as the first.
    rows(7)["t"].write.parquet(f"{root}/t/batch=two/attempt=dead")
    rows(1, 2)["t"].write.parquet(f"{root}/t/batch=one/attempt=zzz")
    spark.createDataFrame([("one", "zzz")], sinks.COMMITS).write.mode("append").parquet(f"{root}/commits")
    assert read("t") == [("one", 1), ("one", 2)] and read("u") == [("one", -2), ("one", -1)]
    assert sinks.append_once(spark, root, "two", rows(3))
    assert read("t") == [("one", 1), ("one", 2), ("two", 3)]
    assert sinks.appended(spark, root, "two") and not sinks.appended(spark, root, "three")


def test_appended_checkout_runs_once_and_numbers_on(spark, tmp_path):
    requests = spark.createDataFrame(REQUESTS, "Request_ID bigint, UserID bigint, Cart_ID bigint")
    root, shop = str(tmp_path / "orders"), carts(spark)
    seen = []
    for batch in ("a", "a", "b", "a"):
        orders, lines = checkout.append_orders(shop, requests, root, batch, at(2))
        seen.append((sorted((r.batch, r.OrderID) for r in orders.collect()), lines.count()))
    assert seen[0] == seen[1] and seen[2] == seen[3]
    numbers = [n for _, n in seen[2][0]]
    assert len(set(numbers)) == len(numbers) == 2 * len(seen[0][0]) and seen[2][1] == 2 * seen[0][1]
