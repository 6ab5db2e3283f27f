"""Business reports over generation 1: revenue, customers, restaurants, deliveries, menu, wallets, complaints.

Shared rules
* Facts are aggregated to the report's grain first and meet their dimension afterwards; both sides of that join
  are unique on the key, so a restaurant or user with a third of all rows costs one row there.
* Declared keys replace COUNT(DISTINCT key) by COUNT where the counted rows carry that key once
  (``tiffin.jobs.quality`` verifies the keys).
* Reports end in a sort on their own order plus a unique tie-break, so equal sort values never meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiffin.functions import half_up_ratio, joined_sorted, sum_where, whole_minutes
from tiffin.operators import attach, cart_values, complaints_per_order, item_sales, paid_payments
from tiffin.sources import Marketplace

CANCELLED = "cancelled"


def revenue_leaderboard(m: Marketplace) -> DataFrame:
    """Paid revenue by restaurant; restaurants without a paid order are left out."""
    sales = (
        m["orders"]
        .select("OrderID", "Restaurant_ID")
        .join(paid_payments(m["payment"]), "OrderID")
        .groupBy("Restaurant_ID")
        .agg(F.count(F.lit(1)).alias("total_orders"), F.sum("Amount").alias("total_revenue"))
    )
    return (
        sales.join(m["restaurant"], "Restaurant_ID")
        .select(
            "Restaurant_ID",
            F.col("Name").alias("restaurant_name"),
            F.col("Rating").alias("avg_rating"),
            "total_orders",
            "total_revenue",
            half_up_ratio(F.col("total_revenue"), F.col("total_orders"), 2, num_digits=2).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_revenue"), "Restaurant_ID")
    )


def customer_lifetime_value(m: Marketplace) -> DataFrame:
    spend = (
        m["orders"]
        .where(F.col("Status") != CANCELLED)
        .groupBy("UserID")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("Total_Amount").alias("lifetime_spend"),
            F.max("Date_Time").alias("last_order_date"),
        )
    )
    return (
        spend.join(m["users"], "UserID")
        .select(
            "UserID",
            "User_Name",
            "Email",
            "total_orders",
            "lifetime_spend",
            half_up_ratio(F.col("lifetime_spend"), F.col("total_orders"), 2, num_digits=2).alias("avg_order_value"),
            "last_order_date",
        )
        .orderBy(F.desc("lifetime_spend"), "UserID")
    )


def payment_mode_split(m: Marketplace) -> DataFrame:
    """Paid payments by mode; shares are of all payments, whatever their status."""
    paid = F.col("Status") == "Paid"
    by_mode = (
        m["payment"]
        .groupBy("Mode")
        .agg(
            F.count(F.lit(1)).alias("seen"),
            F.count_if(paid).alias("transactions"),
            F.sum(F.when(paid, F.col("Amount"))).alias("total_collected"),
        )
    )
    # One pass over the payments: the total is taken over the five per-mode rows, not over the table again.
    everything = Window.partitionBy(F.lit(0))
    return (
        by_mode.withColumn("all_seen", F.sum("seen").over(everything))
        .where(F.col("transactions") > 0)
        .select(
            F.col("Mode").alias("payment_mode"),
            "transactions",
            "total_collected",
            half_up_ratio(F.col("transactions") * 100, F.col("all_seen"), 2).alias("pct_share"),
        )
        .orderBy(F.desc("total_collected"), "payment_mode")
    )


def new_vs_returning(m: Marketplace) -> DataFrame:
    """Every order, marked new if it has the smallest order number of its user (not the earliest time)."""
    first = m["orders"].groupBy("UserID").agg(F.min("OrderID").alias("first_order"))
    # No window over a user's orders: a hot user would be one task. The per-user row is looked up instead.
    people = m["users"].select("UserID", "User_Name").join(first, "UserID")
    return (
        attach(m["orders"], people, "UserID")
        .select(
            "OrderID",
            "User_Name",
            "Date_Time",
            "Total_Amount",
            F.when(F.col("OrderID") == F.col("first_order"), "New Customer")
            .otherwise("Returning Customer")
            .alias("customer_type"),
        )
        .orderBy("Date_Time", "OrderID")
    )


def repeat_customers(m: Marketplace) -> DataFrame:
    loyal = (
        m["orders"]
        .groupBy("UserID")
        .agg(F.count(F.lit(1)).alias("order_count"), F.sum("Total_Amount").alias("total_spent"))
        .where(F.col("order_count") > 1)
    )
    return (
        loyal.join(m["users"], "UserID")
        .select("UserID", "User_Name", "Email", "Phone_No", "order_count", "total_spent")
        .orderBy(F.desc("order_count"), "UserID")
    )


def abandoned_carts(m: Marketplace) -> DataFrame:
    """Abandoned carts at current menu prices; lines are counted, not pieces."""
    carts = cart_values(m["cart"], m["cart_item"], m["menu_item"], F.col("Status") == "Abandoned")
    return (
        carts.join(m["users"].select("UserID", "User_Name", "Email"), "UserID")
        .select("UserID", "User_Name", "Email", "Cart_ID", "cart_created", "items_in_cart", "cart_value")
        .orderBy(F.desc("cart_value"), "Cart_ID")
    )


def restaurant_dashboard(m: Marketplace, corrected: bool = False) -> DataFrame:
    """Orders, cancellations, complaints and revenue by restaurant.

    The report's definition joins complaints at order grain, so an order with c complaints counts c times in
    ``delivered``, ``cancelled`` and ``total_revenue`` (but once in ``total_orders``). That is computed with a
    weight per order; the fan-out itself never exists. ``corrected=True`` counts every order once.
    """
    complaints = F.coalesce(F.col("complaints"), F.lit(0))
    weight = F.lit(1) if corrected else F.greatest(complaints, F.lit(1))
    per_order = (
        m["orders"]
        .select("OrderID", "Restaurant_ID", "Status")
        .join(paid_payments(m["payment"]), "OrderID", "left")
        .join(complaints_per_order(m["complaint"]), "OrderID", "left")
    )
    stats = per_order.groupBy("Restaurant_ID").agg(
        F.count(F.lit(1)).alias("total_orders"),
        sum_where(F.col("Status") == "delivered", weight).alias("delivered"),
        sum_where(F.col("Status") == CANCELLED, weight).alias("cancelled"),
        F.sum(complaints).alias("total_complaints"),
        F.sum(F.col("Amount") * weight).alias("total_revenue"),
    )

    def counted(name):
        return F.coalesce(F.col(name), F.lit(0)).alias(name)

    return (
        m["restaurant"]
        .join(stats, "Restaurant_ID", "left")
        .select(
            "Restaurant_ID",
            F.col("Name").alias("restaurant_name"),
            "Rating",
            counted("total_orders"),
            counted("delivered"),
            counted("cancelled"),
            F.try_divide(F.col("cancelled") * F.lit(100.0), F.col("total_orders")).alias("cancel_rate_pct"),
            counted("total_complaints"),
            "total_revenue",
        )
        .orderBy(F.desc("total_revenue"), "Restaurant_ID")
    )


def top_rated_restaurants(m: Marketplace, min_rating: float = 4.0, min_orders: int = 1) -> DataFrame:
    """Active restaurants with a good live review average, one row per city they have an address in.

    Reviews, cuisines and orders are aggregated apart. Their cross product repeats every review equally often,
    so the averages and distinct counts are the same as over the product, which is never built.
    """
    reviews = (
        m["review"]
        .groupBy("Restaurant_ID")
        .agg(
            F.sum(F.col("Rating").cast("decimal(10,4)")).alias("stars"),
            F.count("Rating").alias("reviews"),
        )
        .select(
            "Restaurant_ID",
            half_up_ratio(F.col("stars"), F.col("reviews"), 2, num_digits=4).alias("avg_review_rating"),
        )
    )
    cuisines = m["cuisine"].groupBy("Restaurant_ID").agg(joined_sorted(F.col("Cuisine")).alias("cuisines"))
    orders = m["orders"].groupBy("Restaurant_ID").agg(F.count(F.lit(1)).alias("total_orders"))
    rating = F.coalesce(F.col("avg_review_rating"), F.lit(0))
    total = F.coalesce(F.col("total_orders"), F.lit(0))
    active = m["restaurant"].where("Restaurant_Status").select("Restaurant_ID", F.col("Name").alias("restaurant_name"))
    return (
        active.join(reviews, "Restaurant_ID", "left")
        .join(orders, "Restaurant_ID", "left")
        .where((rating >= min_rating) & (total >= min_orders))
        .join(cuisines, "Restaurant_ID", "left")
        .join(m["restaurant_address"].select("Restaurant_ID", "City").distinct(), "Restaurant_ID")
        .select(
            "Restaurant_ID",
            "restaurant_name",
            rating.alias("avg_review_rating"),
            "cuisines",
            "City",
            total.alias("total_orders"),
        )
        .orderBy(F.desc("avg_review_rating"), F.desc("total_orders"), "Restaurant_ID", "City")
    )


def partner_scorecard(m: Marketplace) -> DataFrame:
    runs = (
        m["delivery"]
        .groupBy("Partner_ID")
        .agg(
            F.count(F.lit(1)).alias("total_deliveries"),
            F.count_if(F.col("Status") == "Delivered").alias("completed"),
            F.count_if(F.col("Status") == "Failed").alias("failed"),
        )
    )
    return (
        m["delivery_partner"]
        .join(runs, "Partner_ID", "left")
        .na.fill(0, ["total_deliveries", "completed", "failed"])
        .select(
            "Partner_ID",
            F.col("Name").alias("partner_name"),
            "Vehicle_No",
            "Rating",
            "total_deliveries",
            "completed",
            "failed",
            half_up_ratio(F.col("completed") * 100, F.col("total_deliveries"), 2).alias("success_rate_pct"),
        )
        .orderBy(F.desc("success_rate_pct"), F.desc("total_deliveries"), "Partner_ID")
    )


def delivery_duration(m: Marketplace) -> DataFrame:
    """Transit time by partner, in minutes cut to whole ones before they are averaged."""
    minutes = whole_minutes(F.col("Pickup_Time"), F.col("Delivery_Time"))
    runs = (
        m["delivery"]
        .where(
            (F.col("Status") == "Delivered") & F.col("Delivery_Time").isNotNull() & F.col("Pickup_Time").isNotNull()
        )
        .select("Partner_ID", minutes.alias("minutes"))
        .groupBy("Partner_ID")
        .agg(
            F.count(F.lit(1)).alias("deliveries_completed"),
            F.sum("minutes").alias("minutes"),
            F.min("minutes").alias("fastest_mins"),
            F.max("minutes").alias("slowest_mins"),
        )
    )
    return (
        runs.join(m["delivery_partner"].select("Partner_ID", F.col("Name").alias("partner_name")), "Partner_ID")
        .select(
            "Partner_ID",
            "partner_name",
            "deliveries_completed",
            half_up_ratio(F.col("minutes"), F.col("deliveries_completed"), 2).alias("avg_transit_minutes"),
            "fastest_mins",
            "slowest_mins",
        )
        .orderBy("avg_transit_minutes", "Partner_ID")
    )


def best_sellers(m: Marketplace) -> DataFrame:
    """Items by quantity sold, revenue at the price each order was placed at."""
    kinds = m["menu_category"].select("Category_Name", "Restaurant_ID", F.col("Type").alias("veg_nonveg"))
    names = m["restaurant"].select("Restaurant_ID", F.col("Name").alias("restaurant_name"))
    return (
        item_sales(m["order_item"])
        .join(m["menu_item"], "Item_ID")
        .join(kinds, ["Category_Name", "Restaurant_ID"])
        .join(names, "Restaurant_ID")
        .select(
            "Item_ID",
            "Item_Name",
            "Price",
            "veg_nonveg",
            "restaurant_name",
            "total_qty_sold",
            "appeared_in_orders",
            "total_revenue",
        )
        .orderBy(F.desc("total_qty_sold"), "Item_ID")
    )


def dead_stock(m: Marketplace) -> DataFrame:
    """Menu items that were never ordered."""
    ordered = m["order_item"].select("Item_ID").distinct()
    return (
        m["menu_item"]
        .join(ordered, "Item_ID", "left_anti")
        .join(m["restaurant"].select("Restaurant_ID", F.col("Name").alias("restaurant_name")), "Restaurant_ID")
        .select("Item_ID", "Item_Name", "Price", "Is_Available", "restaurant_name", "Category_Name")
        .orderBy("restaurant_name", "Category_Name", "Item_ID")
    )


def wallet_summary(m: Marketplace) -> DataFrame:
    credit, debit = F.col("Type") == "Credit", F.col("Type") == "Debit"
    ledger = (
        m["wallet_transaction"]
        .groupBy("Wallet_ID")
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            sum_where(credit, F.col("Amount")).alias("total_credited"),
            sum_where(debit, F.col("Amount")).alias("total_debited"),
        )
    )
    return (
        m["wallet"]
        .select("Wallet_ID", "UserID", F.col("Balance").alias("current_balance"))
        .join(m["users"].select("UserID", "User_Name", "Email"), "UserID")
        .join(ledger, "Wallet_ID", "left")
        .select(
            "Wallet_ID",
            "User_Name",
            "Email",
            "current_balance",
            *[
                F.coalesce(F.col(c), F.lit(0)).alias(c)
                for c in ("total_transactions", "total_credited", "total_debited")
            ],
        )
        .orderBy(F.desc("current_balance"), "Wallet_ID")
    )


def complaint_resolution(m: Marketplace) -> DataFrame:
    """Resolution rate by issue. A complaint under review is neither resolved nor open."""
    return (
        m["complaint"]
        .groupBy("Issue_Type")
        .agg(
            F.count(F.lit(1)).alias("total_complaints"),
            F.count_if(F.col("Status").isin("Resolved", "Closed")).alias("resolved_count"),
            F.count_if(F.col("Status") == "Open").alias("still_open"),
        )
        .select(
            "Issue_Type",
            "total_complaints",
            "resolved_count",
            half_up_ratio(F.col("resolved_count") * 100, F.col("total_complaints"), 2).alias("resolution_rate_pct"),
            "still_open",
        )
        .orderBy(F.desc("total_complaints"), "Issue_Type")
    )


def refund_impact(m: Marketplace) -> DataFrame:
    """Every refund with its order, customer, payment and complaint; refunds of unpaid orders vanish."""
    orders = m["orders"].select("OrderID", "UserID", "Restaurant_ID", F.col("Total_Amount").alias("order_amount"))
    payments = m["payment"].select(
        F.col("Order_ID").alias("OrderID"),
        F.col("Amount").alias("amount_paid"),
        F.col("Mode").alias("payment_mode"),
    )
    reasons = m["complaint"].select("Complaint_ID", F.col("Issue_Type").alias("complaint_reason"))
    refunds = m["refund"].select(
        "Refund_ID",
        "OrderID",
        "Complaint_ID",
        "Refund_Amount",
        "Refund_Status",
        F.col("Completed_At").alias("refund_completed"),
    )
    return (
        refunds.join(orders, "OrderID")
        .join(payments, "OrderID")
        .join(reasons, "Complaint_ID")
        .join(m["users"].select("UserID", F.col("User_Name").alias("customer")), "UserID")
        .join(m["restaurant"].select("Restaurant_ID", F.col("Name").alias("restaurant")), "Restaurant_ID")
        .withColumn(
            "refund_pct_of_payment",
            half_up_ratio(F.col("Refund_Amount") * 100, F.col("amount_paid"), 1, num_digits=2, den_digits=2),
        )
        .orderBy(F.desc("Refund_Amount"), "Refund_ID")
        .select(
            "OrderID",
            "customer",
            "restaurant",
            "order_amount",
            "amount_paid",
            "payment_mode",
            "complaint_reason",
            "Refund_Amount",
            "Refund_Status",
            "refund_completed",
            "refund_pct_of_payment",
        )
    )
