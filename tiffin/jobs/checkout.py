"""Cart checkout as a batch over a table of requests (Request_ID, UserID, Cart_ID, ...).

A request succeeds if the cart is active and belongs to the user, every item is available and the cart is not
empty. All requests of a batch see the same stored carts; of several good ones for a cart the one with the
smallest number wins and the others find the cart gone, as if the requests had run one after the other.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.operators import attach, dense_numbers, keyed_update
from tiffin.session import stage
from tiffin.sources import Marketplace
from tiffin.sources.sinks import append_once, appended, publish, read_appended, read_published

NO_CART, UNAVAILABLE, EMPTY = "no_active_cart", "unavailable_item", "empty_cart"


@dataclass(frozen=True)
class Checkout:
    orders: DataFrame
    order_items: DataFrame
    carts: DataFrame
    rejected: DataFrame


def _cart_contents(m: Marketplace, carts: DataFrame) -> DataFrame:
    menu = m["menu_item"].select("Item_ID", "Price", "Restaurant_ID", "Is_Available")
    return (
        m["cart_item"]
        .join(carts.select("Cart_ID"), "Cart_ID", "left_semi")
        .join(menu, "Item_ID")
        .groupBy("Cart_ID")
        .agg(
            F.sum(F.col("Price") * F.col("Quantity")).alias("Total_Amount"),
            F.max("Restaurant_ID").alias("Restaurant_ID"),
            F.count_if(~F.col("Is_Available")).alias("unavailable"),
        )
    )


def decide(m: Marketplace, requests: DataFrame) -> DataFrame:
    """One row per request with its ``reason`` for rejection (NULL if it succeeds), total and restaurant."""
    active = m["cart"].where(F.col("Status") == "Active").select("Cart_ID", F.col("UserID").alias("owner"))
    owned = F.col("owner") == F.col("UserID")
    asked = requests.select("Request_ID", "UserID", "Cart_ID").join(active, "Cart_ID", "left")
    # Folded to one row per cart before contents are looked up, so a cart asked for many times costs one.
    first = asked.where(owned).groupBy("Cart_ID").agg(F.min("Request_ID").alias("winner"))
    carts = first.join(_cart_contents(m, first), "Cart_ID", "left")
    reason = (
        F.when(~F.coalesce(owned, F.lit(False)), NO_CART)
        .when(F.col("unavailable") > 0, UNAVAILABLE)
        .when(F.col("Total_Amount").isNull(), EMPTY)
        .when(F.col("Request_ID") != F.col("winner"), NO_CART)
    )
    return attach(asked, carts, "Cart_ID", "left").select(
        "Request_ID", "UserID", "Cart_ID", reason.alias("reason"), "Total_Amount", "Restaurant_ID"
    )


def place_orders(
    m: Marketplace, requests: DataFrame, root: str, version: int, as_of: datetime | None = None
) -> Checkout:
    """Run a checkout batch and publish its four outputs together as one version of ``root``: a batch that dies
    half-way publishes nothing."""
    done = checkout(m, requests, as_of)
    tables = {"orders": done.orders, "order_item": done.order_items, "cart": done.carts, "rejected": done.rejected}
    publish(m.spark, root, version, tables)
    return Checkout(*[read_published(m.spark, root, name, version) for name in tables])


ORDER_ROWS = (
    "OrderID bigint, Date_Time timestamp_ntz, UserID bigint, Restaurant_ID bigint, Status string, "
    "Total_Amount decimal(18,2), Updated_At timestamp_ntz"
)
LINE_ROWS = "Item_ID bigint, OrderID bigint, Quantity bigint, Unit_Price decimal(18,2)"


def append_orders(
    m: Marketplace, requests: DataFrame, root: str, batch: str, as_of: datetime | None = None
) -> tuple[DataFrame, DataFrame]:
    """Run a checkout batch and append its orders and lines to the tables under ``root``, once: a batch that is run
    again finds itself there and adds nothing. Orders are numbered on from those stored and appended before. Returns
    all appended orders and lines."""
    spark = m.spark
    if not appended(spark, root, batch):
        earlier = read_appended(spark, root, "orders", ORDER_ROWS) if appended(spark, root) else None
        done = checkout(m if earlier is None else m.replace(orders=m["orders"].unionByName(earlier, True)), requests, as_of)
        cast = lambda df, rows: df.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in rows.split(", ")])
        tables = {"orders": cast(done.orders, ORDER_ROWS), "order_item": cast(done.order_items, LINE_ROWS)}
        append_once(spark, root, batch, tables)
    return read_appended(spark, root, "orders", ORDER_ROWS), read_appended(spark, root, "order_item", LINE_ROWS)


def checkout(m: Marketplace, requests: DataFrame, as_of: datetime | None = None) -> Checkout:
    """New orders and their lines, the carts after checkout, and the rejected requests with reasons."""
    return _outcome(m, stage(decide(m, requests), "checkout"), as_of)


def _outcome(m: Marketplace, decided: DataFrame, as_of: datetime | None) -> Checkout:
    """The four outputs of decided requests. Orders are numbered on from the largest stored number in request
    order; the numbers depend on the data alone, so orders and lines agree although each is computed on its own."""
    now = F.localtimestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    last = m["orders"].agg(F.coalesce(F.max("OrderID"), F.lit(0))).scalar()
    good = decided.where(F.col("reason").isNull())
    accepted = dense_numbers(good, "Request_ID", "OrderID", start=last + 1)
    orders = accepted.select(
        "OrderID",
        now.alias("Date_Time"),
        "UserID",
        "Restaurant_ID",
        F.lit("pending").alias("Status"),
        F.col("Total_Amount").cast("decimal(18,2)").alias("Total_Amount"),
        now.alias("Updated_At"),
    )
    lines = (
        m["cart_item"]
        .join(accepted.select("Cart_ID", "OrderID"), "Cart_ID")
        .join(m["menu_item"].select("Item_ID", F.col("Price").alias("Unit_Price")), "Item_ID")
        .select("Item_ID", "OrderID", "Quantity", "Unit_Price")
    )
    carts = keyed_update(m["cart"], good.select("Cart_ID"), "Cart_ID", {"Status": F.lit("Checked Out")})
    rejected = decided.where(F.col("reason").isNotNull()).select("Request_ID", "UserID", "Cart_ID", "reason")
    return Checkout(orders, lines, carts, rejected)
