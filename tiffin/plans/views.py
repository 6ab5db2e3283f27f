"""Derived tables that other queries read as if they were stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.operators import paid_payments
from tiffin.sources import Marketplace


def order_summary(m: Marketplace) -> DataFrame:
    """One wide row per order. Payment, delivery and discount exist at most once per order."""
    orders = m["orders"].select(
        "OrderID", "Date_Time", F.col("Status").alias("order_status"), "Total_Amount", "UserID", "Restaurant_ID"
    )
    users = m["users"].select(
        "UserID", F.col("User_Name").alias("customer_name"), F.col("Email").alias("customer_email")
    )
    payments = m["payment"].select(
        F.col("Order_ID").alias("OrderID"),
        F.col("Transaction_ID").alias("payment_id"),
        F.col("Mode").alias("payment_mode"),
        F.col("Status").alias("payment_status"),
        F.col("Amount").alias("amount_paid"),
        "Paid_At",
    )
    deliveries = m["delivery"].select(
        "OrderID", "Delivery_ID", F.col("Status").alias("delivery_status"), "Pickup_Time", "Delivery_Time", "Partner_ID"
    )
    partners = m["delivery_partner"].select(
        "Partner_ID", F.col("Name").alias("partner_name"), F.col("Phone_No").alias("partner_phone")
    )
    return (
        # The three joins by order share one partitioning of the orders.
        orders.join(payments, "OrderID", "left")
        .join(deliveries, "OrderID", "left")
        .join(m["discount"].select("OrderID", "Discount_PR", "Discount_Amount"), "OrderID", "left")
        .join(users, "UserID")
        .join(m["restaurant"].select("Restaurant_ID", F.col("Name").alias("restaurant_name")), "Restaurant_ID")
        .join(partners, "Partner_ID", "left")
        .select(
            "OrderID",
            "Date_Time",
            "order_status",
            "Total_Amount",
            "UserID",
            "customer_name",
            "customer_email",
            "Restaurant_ID",
            "restaurant_name",
            "payment_id",
            "payment_mode",
            "payment_status",
            "amount_paid",
            "Paid_At",
            "Delivery_ID",
            "delivery_status",
            "Pickup_Time",
            "Delivery_Time",
            "partner_name",
            "partner_phone",
            F.coalesce("Discount_PR", F.lit(0)).cast("float").alias("discount_pct"),
            F.coalesce("Discount_Amount", F.lit(0)).cast("decimal(18,2)").alias("discount_amount"),
        )
    )


def restaurant_leaderboard(m: Marketplace, corrected: bool = False) -> DataFrame:
    """Reviews, orders, paid revenue and cancellations by restaurant.

    By definition reviews and orders are joined at restaurant grain, so revenue counts once per review; that is
    a factor on the aggregate. ``corrected=True`` leaves the factor out.
    """
    reviews = m["review"].groupBy("Restaurant_ID").agg(F.count(F.lit(1)).alias("total_reviews"))
    orders = (
        m["orders"]
        .select("OrderID", "Restaurant_ID", "Status")
        .join(paid_payments(m["payment"]), "OrderID", "left")
        .groupBy("Restaurant_ID")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("Amount").alias("paid"),
            F.count_if(F.col("Status") == "cancelled").alias("cancelled_orders"),
        )
    )
    return leaderboard_view(m["restaurant"], reviews.join(orders, "Restaurant_ID", "full"), corrected)


def leaderboard_view(restaurant: DataFrame, totals: DataFrame, corrected: bool = False) -> DataFrame:
    """The leaderboard from reviews, orders, paid revenue and cancellations by restaurant, as far as there are any."""
    repeat = F.lit(1) if corrected else F.greatest(F.col("total_reviews"), F.lit(1))
    return (
        restaurant.join(totals, "Restaurant_ID", "left")
        .na.fill(0, ["total_reviews", "total_orders", "cancelled_orders"])
        .select(
            "Restaurant_ID",
            F.col("Name").alias("restaurant_name"),
            F.col("Rating").alias("avg_rating"),
            F.col("Restaurant_Status").alias("is_active"),
            "total_reviews",
            "total_orders",
            (F.coalesce("paid", F.lit(0)) * repeat).cast("decimal(38,2)").alias("total_revenue"),
            "cancelled_orders",
        )
        .orderBy(F.desc("avg_rating"), F.desc("total_orders"), "Restaurant_ID")
    )


def menu_with_category(m: Marketplace) -> DataFrame:
    kinds = m["menu_category"].select("Category_Name", "Restaurant_ID", F.col("Type").alias("category_type"))
    return (
        m["menu_item"]
        .join(kinds, ["Category_Name", "Restaurant_ID"])
        .select(
            "Item_ID",
            "Item_Name",
            "Description",
            "Price",
            "Preparation_Time",
            "Is_Available",
            "Category_Name",
            "category_type",
            "Restaurant_ID",
        )
        .orderBy("Restaurant_ID", "Category_Name", "Item_Name", "Item_ID")
    )


VIEWS = {
    "v_order_summary": order_summary,
    "v_restaurant_leaderboard": restaurant_leaderboard,
    "v_menu_with_category": menu_with_category,
}


def register_views(m: Marketplace) -> None:
    """Make the derived tables available to ``spark.sql`` next to the base tables."""
    m.register_views()
    for name, plan in VIEWS.items():
        plan(m).createOrReplaceTempView(name)


def orders_by_view(m: Marketplace) -> DataFrame:
    """Orders, discounts and what was paid by state of order and payment, asked of the derived table by its name."""
    register_views(m)
    return m.spark.sql(
        """SELECT order_status, payment_status, delivery_status, count(*) AS orders, sum(amount_paid) AS paid,
                  sum(discount_amount) AS discounts, count(DISTINCT Restaurant_ID) AS restaurants
           FROM v_order_summary GROUP BY order_status, payment_status, delivery_status"""
    )
