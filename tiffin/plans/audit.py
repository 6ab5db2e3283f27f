"""Audit and reconciliation questions over generation 1. The rules of ``tiffin.plans.analytics`` apply."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiffin.functions import half_up_ratio, whole_hours, whole_minutes
from tiffin.operators import attach, cart_values, in_period, item_sales
from tiffin.sources import Marketplace


def same_city_customers(m: Marketplace, city: str) -> DataFrame:
    """Customers with an address in ``city`` who ordered, in any state, from a restaurant with one there too."""
    locals_ = (
        m["user_has_address"]
        .join(m["user_address"].where(F.col("City") == city).select("Add_ID"), "Add_ID", "left_semi")
        .select("UserID")
        .distinct()
    )
    kitchens = (
        m["restaurant_address"]
        .where(F.col("City") == city)
        .select("Restaurant_ID", F.col("City").alias("restaurant_city"))
        .distinct()
        .join(m["restaurant"].select("Restaurant_ID", F.col("Name").alias("restaurant_name")), "Restaurant_ID")
    )
    # Who ordered where, once each: repeat orders fold map-side before anything else moves.
    visits = attach(m["orders"].select("UserID", "Restaurant_ID"), kitchens, "Restaurant_ID")
    pairs = visits.select("UserID", "restaurant_name", "restaurant_city").distinct()
    return (
        pairs.join(locals_, "UserID", "left_semi")
        .join(m["users"].select("UserID", "User_Name", "Email"), "UserID")
        .select("UserID", "User_Name", "Email", "restaurant_name", "restaurant_city")
        .orderBy("User_Name", "restaurant_name", "UserID")
    )


def payment_mismatches(m: Marketplace, tolerance: Decimal = Decimal("0.01")) -> DataFrame:
    """Payments, in any status, that differ from the order total after discount by more than ``tolerance``."""
    orders = m["orders"].select("OrderID", F.col("Total_Amount").alias("order_total"))
    payments = m["payment"].select(
        F.col("Order_ID").alias("OrderID"),
        F.col("Amount").alias("amount_paid"),
        F.col("Mode").alias("payment_mode"),
        F.col("Status").alias("payment_status"),
    )
    discount = F.coalesce(F.col("Discount_Amount"), F.lit(0).cast("decimal(18,2)"))
    expected = F.col("order_total") - F.col("discount_applied")
    return (
        orders.join(payments, "OrderID")
        .join(m["discount"].select("OrderID", "Discount_Amount"), "OrderID", "left")
        .withColumn("discount_applied", discount)
        .withColumn("expected_payment", expected)
        .withColumn("discrepancy", F.abs(F.col("amount_paid") - F.col("expected_payment")))
        .where(F.col("discrepancy") > F.lit(tolerance))
        .select(
            "OrderID",
            "order_total",
            "discount_applied",
            "expected_payment",
            "amount_paid",
            "payment_mode",
            "payment_status",
            "discrepancy",
        )
        .orderBy(F.desc("discrepancy"), "OrderID")
    )


def slow_deliveries(m: Marketplace, minutes: int = 45) -> DataFrame:
    """Completed deliveries whose whole minutes exceed the limit; 45 min 59 s is within 45."""
    return (
        m["delivery"]
        .where(
            (F.col("Status") == "Delivered") & F.col("Delivery_Time").isNotNull() & F.col("Pickup_Time").isNotNull()
        )
        .withColumn("transit_minutes", whole_minutes(F.col("Pickup_Time"), F.col("Delivery_Time")))
        .where(F.col("transit_minutes") > minutes)
        .join(
            m["delivery_partner"].select("Partner_ID", F.col("Name").alias("partner_name"), "Phone_No"), "Partner_ID"
        )
        .select(
            "Partner_ID",
            "partner_name",
            "Phone_No",
            "Delivery_ID",
            "OrderID",
            "Pickup_Time",
            "Delivery_Time",
            "transit_minutes",
        )
        .orderBy(F.desc("transit_minutes"), "Delivery_ID")
    )


def rated_with_open_complaints(m: Marketplace, above: float = 4.0) -> DataFrame:
    """Restaurants rated strictly above the limit that have unresolved complaints."""
    rated = (
        m["restaurant"]
        .where(F.col("Rating") > above)
        .select("Restaurant_ID", F.col("Name").alias("restaurant_name"), F.col("Rating").alias("cached_rating"))
    )
    per_order = (
        m["complaint"]
        .where(F.col("Status").isin("Open", "Under Review"))
        .groupBy("OrderID")
        .agg(F.count(F.lit(1)).alias("unresolved"))
    )
    return (
        m["orders"]
        .select("OrderID", "Restaurant_ID")
        .join(per_order, "OrderID")
        .groupBy("Restaurant_ID")
        .agg(F.sum("unresolved").alias("open_complaints"))
        .join(rated, "Restaurant_ID")
        .select("Restaurant_ID", "restaurant_name", "cached_rating", "open_complaints")
        .orderBy(F.desc("open_complaints"), F.desc("cached_rating"), "Restaurant_ID")
    )


def valuable_abandoned_carts(m: Marketplace, min_value: Decimal | int = 500) -> DataFrame:
    carts = cart_values(m["cart"], m["cart_item"], m["menu_item"], F.col("Status") == "Abandoned")
    return (
        carts.where(F.col("cart_value") > F.lit(min_value))
        .join(m["users"].select("UserID", "User_Name", "Email"), "UserID")
        .select("UserID", "User_Name", "Email", "Cart_ID", "cart_created", "cart_value")
        .orderBy(F.desc("cart_value"), "Cart_ID")
    )


def mode_share_in_period(m: Marketplace, start: datetime, end: datetime, modes: tuple[str, ...]) -> DataFrame:
    """Paid payments of orders placed in ``[start, end)`` for some modes; shares are of all modes' payments."""
    orders = in_period(m["orders"], "Date_Time", start, end).select("OrderID")
    by_mode = (
        m["payment"]
        .where(F.col("Status") == "Paid")
        .select(F.col("Order_ID").alias("OrderID"), "Mode", "Amount")
        .join(orders, "OrderID", "left_semi")
        .groupBy("Mode")
        .agg(F.count(F.lit(1)).alias("transaction_count"), F.sum("Amount").alias("total_collected"))
    )
    # The total is over the per-mode rows (five at most), before the modes are narrowed: the join runs once.
    everything = Window.partitionBy(F.lit(0))
    return (
        by_mode.withColumn("all_modes", F.sum("transaction_count").over(everything))
        .where(F.col("Mode").isin(*modes))
        .select(
            F.col("Mode").alias("payment_mode"),
            "transaction_count",
            "total_collected",
            half_up_ratio(F.col("transaction_count") * 100, F.col("all_modes"), 2).alias("pct_share"),
        )
        .orderBy(F.desc("total_collected"), "payment_mode")
    )


def demand_at_inactive_restaurants(m: Marketplace) -> DataFrame:
    closed = (
        m["restaurant"]
        .where(~F.col("Restaurant_Status"))
        .select("Restaurant_ID", F.col("Name").alias("restaurant_name"))
    )
    items = m["menu_item"].select("Item_ID", "Item_Name", "Restaurant_ID").join(closed, "Restaurant_ID")
    return (
        item_sales(m["order_item"])
        .join(items, "Item_ID")
        .select("Restaurant_ID", "restaurant_name", "Item_ID", "Item_Name", "total_qty_sold", "total_revenue")
        .orderBy(F.desc("total_qty_sold"), "Item_ID")
    )


def stale_refunds(m: Marketplace, as_of: datetime | None = None, hours: int = 24) -> DataFrame:
    """Pending refunds by age of their complaint. Whole hours above 24 means 25 hours or more."""
    now = F.localtimestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    complaints = m["complaint"].select("Complaint_ID", "Issue_Type", F.col("Created_At").alias("complaint_raised"))
    return (
        m["refund"]
        .where(F.col("Refund_Status") == "Pending")
        .select("Refund_ID", "OrderID", "Complaint_ID", "Refund_Amount")
        .join(complaints, "Complaint_ID")
        .withColumn("hours_pending", whole_hours(F.col("complaint_raised"), now))
        .where(F.col("hours_pending") > hours)
        .join(m["orders"].select("OrderID", "UserID"), "OrderID")
        .join(m["users"].select("UserID", F.col("User_Name").alias("customer")), "UserID")
        .select(
            "Refund_ID", "OrderID", "customer", "Issue_Type", "Refund_Amount", "complaint_raised", "hours_pending"
        )
        .orderBy(F.desc("hours_pending"), "Refund_ID")
    )


def vip_candidates(m: Marketplace, top: int = 3, min_orders: int = 2) -> DataFrame:
    """The ``top`` spenders with enough orders; equal spend goes to the smaller user number."""
    best = (
        m["orders"]
        .where(F.col("Status") != "cancelled")
        .groupBy("UserID")
        .agg(F.count(F.lit(1)).alias("total_orders"), F.sum("Total_Amount").alias("lifetime_spend"))
        .where(F.col("total_orders") >= min_orders)
        .orderBy(F.desc("lifetime_spend"), "UserID")
        .limit(top)
    )
    return (
        m["users"]
        .select("UserID", "User_Name", "Email")
        .join(F.broadcast(best), "UserID")  # ``top`` rows
        .select("UserID", "User_Name", "Email", "total_orders", "lifetime_spend")
        .orderBy(F.desc("lifetime_spend"), "UserID")
    )


def late_night_restaurants(m: Marketplace, after: str = "23:00:00") -> DataFrame:
    """Restaurants that close strictly later than ``after`` and have delivered something."""
    delivered = (
        m["orders"]
        .where(F.col("Status") == "delivered")
        .groupBy("Restaurant_ID")
        .agg(F.count(F.lit(1)).alias("delivered_orders"))
    )
    return (
        m["restaurant"]
        .where(F.col("Close_Time") > after)
        .select("Restaurant_ID", F.col("Name").alias("restaurant_name"), "Open_Time", "Close_Time")
        .join(delivered, "Restaurant_ID")
        .orderBy(F.desc("delivered_orders"), "Restaurant_ID")
    )
