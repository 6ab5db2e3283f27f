"""Aggregates that several plans share. Each one shrinks a fact table map-side before anything is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def paid_payments(payment: DataFrame) -> DataFrame:
    """Settled amount by order; an order has at most one payment."""
    return payment.where(F.col("Status") == "Paid").select(F.col("Order_ID").alias("OrderID"), "Amount")


def complaints_per_order(complaint: DataFrame) -> DataFrame:
    return complaint.groupBy("OrderID").agg(F.count(F.lit(1)).alias("complaints"))


def cart_values(cart: DataFrame, cart_item: DataFrame, menu_item: DataFrame, where: Column) -> DataFrame:
    """Lines and current value of the carts that satisfy ``where``; empty carts drop out.

    The carts are narrowed before their lines meet the menu, so only lines of interest are moved by item.
    """
    wanted = cart.where(where).select("Cart_ID", "UserID", F.col("Created_At").alias("cart_created"))
    prices = menu_item.select("Item_ID", "Price")
    return (
        cart_item.join(wanted, "Cart_ID")
        .join(prices, "Item_ID")
        .groupBy("Cart_ID", "UserID", "cart_created")
        .agg(
            F.count(F.lit(1)).alias("items_in_cart"),
            F.sum(F.col("Price") * F.col("Quantity")).alias("cart_value"),
        )
    )


def item_sales(order_item: DataFrame, price: str = "Unit_Price") -> DataFrame:
    """Quantity, orders and revenue by item. (item, order) is the line key, so lines are distinct orders."""
    return order_item.groupBy("Item_ID").agg(
        F.sum("Quantity").alias("total_qty_sold"),
        F.count(F.lit(1)).alias("appeared_in_orders"),
        F.sum(F.col(price) * F.col("Quantity")).alias("total_revenue"),
    )
