"""The derived tables kept up to date from changes of the base tables, without making them anew.

Changes are the difference of two snapshots (``snapshot_changes``), or whatever feed has their shape. A change costs what
it touches:

* the leaderboard is kept as totals per restaurant, which changes add to and take from. The factor by which its
  definition counts revenue once per review is applied when the view is read, so one more review of a restaurant
  changes one number, whatever the number of its orders;
* of the order summary the rows of the orders that a change touches are made anew, through its left joins, and the
  others stay as they are. A change of a user, restaurant or partner touches the orders that show it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.operators import paid_payments, snapshot_changes
from tiffin.plans.views import leaderboard_view, order_summary
from tiffin.sources import Marketplace

TOTALS = ["total_reviews", "total_orders", "paid", "cancelled_orders"]


def _reviews(review: DataFrame) -> DataFrame:
    """What reviews add to the totals of their restaurants."""
    zero = F.lit(0).cast("bigint")
    return review.select(
        "Restaurant_ID",
        F.lit(1).cast("bigint").alias("total_reviews"),
        zero.alias("total_orders"),
        F.lit(0).cast("decimal(28,2)").alias("paid"),
        zero.alias("cancelled_orders"),
    )


def _orders(orders: DataFrame, payment: DataFrame) -> DataFrame:
    """What orders add to the totals of their restaurants."""
    return orders.join(paid_payments(payment), "OrderID", "left").select(
        "Restaurant_ID",
        F.lit(0).cast("bigint").alias("total_reviews"),
        F.lit(1).cast("bigint").alias("total_orders"),
        F.coalesce("Amount", F.lit(0)).cast("decimal(28,2)").alias("paid"),
        (F.col("Status") == "cancelled").cast("bigint").alias("cancelled_orders"),
    )


def _less(rows: DataFrame) -> DataFrame:
    return rows.select("Restaurant_ID", *[(-F.col(c)).alias(c) for c in TOTALS])


def _summed(frames: list[DataFrame]) -> DataFrame:
    kinds = {c: "decimal(28,2)" if c == "paid" else "bigint" for c in TOTALS}
    rows = reduce(DataFrame.unionByName, frames)
    return rows.groupBy("Restaurant_ID").agg(*[F.sum(c).cast(k).alias(c) for c, k in kinds.items()])


def leaderboard_totals(m: Marketplace) -> DataFrame:
    """The leaderboard's state: a row per restaurant with a review or an order."""
    return _summed([_reviews(m["review"]), _orders(m["orders"], m["payment"])])


def _sides(changes: DataFrame, column: str, name: str) -> DataFrame:
    """The values of a column on both sides of changes."""
    both = F.array(F.col(f"before.{column}"), F.col(f"after.{column}"))
    return changes.select(F.explode(both).alias(name)).where(F.col(name).isNotNull())


def changed_totals(totals: DataFrame, old: Marketplace, new: Marketplace) -> DataFrame:
    """The state after the changes of reviews, orders and payments between two snapshots."""
    reviews = snapshot_changes(old["review"], new["review"], ["Review_ID"], ["Restaurant_ID"])
    orders = snapshot_changes(old["orders"], new["orders"], ["OrderID"], ["OrderID", "Restaurant_ID", "Status"])
    payments = snapshot_changes(old["payment"], new["payment"], ["Transaction_ID"], ["Order_ID", "Amount", "Status"])
    touched = _sides(orders, "OrderID", "OrderID").unionByName(_sides(payments, "Order_ID", "OrderID")).distinct()

    def of(m: Marketplace) -> DataFrame:
        mine = m["orders"].select("OrderID", "Restaurant_ID", "Status").join(touched, "OrderID", "left_semi")
        paid = m["payment"].join(touched, F.col("Order_ID") == F.col("OrderID"), "left_semi")
        return _orders(mine, paid)

    gone = _reviews(reviews.where(F.col("before").isNotNull()).select("before.*"))
    come = _reviews(reviews.where(F.col("after").isNotNull()).select("after.*"))
    return _summed([totals.select("Restaurant_ID", *TOTALS), _less(gone), come, _less(of(old)), of(new)])


def leaderboard(m: Marketplace, totals: DataFrame, corrected: bool = False) -> DataFrame:
    """The view from its state; restaurants as they are now."""
    return leaderboard_view(m["restaurant"], totals, corrected)


# What the order summary shows of each table, and how an order refers to it.
SHOWN = {
    "orders": (["OrderID"], "OrderID", ["OrderID", "Date_Time", "Status", "Total_Amount", "UserID", "Restaurant_ID"]),
    "payment": (["Transaction_ID"], "Order_ID", ["Order_ID", "Transaction_ID", "Mode", "Status", "Amount", "Paid_At"]),
    "delivery": (["Delivery_ID"], "OrderID", ["OrderID", "Delivery_ID", "Status", "Pickup_Time", "Delivery_Time", "Partner_ID"]),
    "discount": (["Discount_ID"], "OrderID", ["OrderID", "Discount_PR", "Discount_Amount"]),
}
NAMED = {
    "users": ("UserID", ["User_Name", "Email"], "orders", "OrderID"),
    "restaurant": ("Restaurant_ID", ["Name"], "orders", "OrderID"),
    "delivery_partner": ("Partner_ID", ["Name", "Phone_No"], "delivery", "OrderID"),
}


def touched_orders(old: Marketplace, new: Marketplace) -> DataFrame:
    """Numbers of the orders of which the order summary may show something else."""
    found = []
    for name, (key, order, columns) in SHOWN.items():
        found.append(_sides(snapshot_changes(old[name], new[name], key, columns), order, "OrderID"))
    for name, (key, columns, through, order) in NAMED.items():
        changed = snapshot_changes(old[name], new[name], [key], columns).select(key)
        found.append(new[through].join(changed, key, "left_semi").select(F.col(order).alias("OrderID")))
    return reduce(DataFrame.unionByName, found).distinct()


def changed_summary(summary: DataFrame, old: Marketplace, new: Marketplace) -> DataFrame:
    """The order summary after the changes between two snapshots."""
    touched = touched_orders(old, new)
    fresh = order_summary(new.replace(orders=new["orders"].join(touched, "OrderID", "left_semi")))
    return summary.join(touched, "OrderID", "left_anti").unionByName(fresh)
