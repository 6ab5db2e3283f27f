"""Dashboard queries over generation 2. The rules of ``tiffin.plans.analytics`` apply."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.functions import half_up_ratio, label_month, whole_minutes
from tiffin.operators import attach
from tiffin.sources import Marketplace


def _live_orders(m: Marketplace) -> DataFrame:
    return m["orders"].where(F.col("Order_Status") != "Cancelled")


def category_price_stats(m: Marketplace, restaurant_id: int) -> DataFrame:
    here = F.col("Restaurant_ID") == restaurant_id
    categories = m["menu_category"].where(here).select("Category_Name", "Restaurant_ID")
    return (
        m["menu_item"]
        .where(here & F.col("Is_Available"))
        .join(categories, ["Category_Name", "Restaurant_ID"], "left_semi")
        .groupBy("Category_Name")
        .agg(
            F.count(F.lit(1)).alias("Item_Count"),
            F.sum("Price").alias("prices"),
            F.min("Price").alias("Min_Price"),
            F.max("Price").alias("Max_Price"),
        )
        .select(
            "Category_Name",
            "Item_Count",
            half_up_ratio(F.col("prices"), F.col("Item_Count"), 2).alias("Avg_Price"),
            "Min_Price",
            "Max_Price",
        )
        .orderBy(F.desc("Avg_Price"), "Category_Name")
    )


def payment_methods(m: Marketplace) -> DataFrame:
    return (
        m["payment"]
        .where(F.col("Status") == "Success")
        .groupBy(F.col("Mode").alias("Payment_Method"))
        .agg(F.count("Order_ID").alias("Times_Used"), F.sum("Amount").alias("Total_Revenue"))
        .orderBy(F.desc("Times_Used"), "Payment_Method")
    )


def low_wallet_orders(m: Marketplace, below: int = 500) -> DataFrame:
    poor = (
        m["wallet"]
        .where(F.col("Balance") < below)
        .select("UserID", F.col("Balance").alias("Wallet_Balance"))
        .join(m["user"].select("UserID", "User_Name"), "UserID")
    )
    orders = m["orders"].select("OrderID", "UserID", F.col("Date_Time").alias("Order_Time"), "Total_Amount")
    return (
        attach(orders, poor, "UserID")
        .select("OrderID", "User_Name", "Wallet_Balance", "Order_Time", "Total_Amount")
        .orderBy("Wallet_Balance", "OrderID")
    )


def revenue_per_restaurant(m: Marketplace) -> DataFrame:
    """Line revenue by the restaurant of the item; an order that spans restaurants counts in each.

    The average is per order line. The lines meet the menu first and the orders second, so that folding them to
    (order, restaurant) reuses the partitioning of the order join; after it the order count is a plain count.
    """
    value = F.col("Quantity") * F.col("Price")
    per_order = (
        m["order_item"]
        .select("OrderID", "Item_ID", value.alias("value"))
        .join(m["menu_item"].select("Item_ID", "Restaurant_ID"), "Item_ID")
        .join(_live_orders(m).select("OrderID"), "OrderID")
        .groupBy("OrderID", "Restaurant_ID")
        .agg(F.sum("value").alias("value"), F.count("value").alias("lines"))
    )
    return (
        per_order.groupBy("Restaurant_ID")
        .agg(
            F.sum("value").alias("Gross_Revenue"),
            F.count(F.lit(1)).alias("Total_Orders"),
            F.sum("lines").alias("lines"),
        )
        .join(m["restaurant"].select("Restaurant_ID", F.col("Resto_Name").alias("Restaurant")), "Restaurant_ID")
        .withColumn("Avg_Order_Value", half_up_ratio(F.col("Gross_Revenue"), F.col("lines"), 2))
        .orderBy(F.desc("Gross_Revenue"), "Restaurant_ID")
        .select("Restaurant", "Gross_Revenue", "Total_Orders", "Avg_Order_Value")
    )


def top_rated(m: Marketplace, top: int = 5) -> DataFrame:
    return (
        m["restaurant"]
        .where("Restaurant_Status")
        .orderBy(F.desc("Rating"), "Restaurant_ID")
        .limit(top)
        .select("Resto_Name", "Rating", "Total_Reviews", F.col("Avg_Delivery_Time").alias("Est_Delivery_Mins"))
    )


def delivery_time_per_partner(m: Marketplace) -> DataFrame:
    """Average whole minutes; a delivery without a pick-up time counts as a delivery but not in the average."""
    minutes = whole_minutes(F.col("Pickup_Time"), F.col("Delivery_Time"))
    runs = (
        m["delivery"]
        .where(F.col("Delivery_Time").isNotNull())
        .select("Partner_ID", minutes.alias("minutes"))
        .groupBy("Partner_ID")
        .agg(
            F.sum("minutes").alias("minutes"),
            F.count("minutes").alias("timed"),
            F.count(F.lit(1)).alias("Total_Deliveries"),
        )
    )
    partners = m["delivery_partner"].select(
        "Partner_ID", F.col("Name").alias("Partner_Name"), "City", F.col("Rating").alias("Partner_Rating")
    )
    return (
        runs.join(partners, "Partner_ID")
        .withColumn("Avg_Delivery_Mins", half_up_ratio(F.col("minutes"), F.col("timed"), 1))
        .orderBy("Avg_Delivery_Mins", "Partner_ID")
        .select("Partner_Name", "City", "Avg_Delivery_Mins", "Total_Deliveries", "Partner_Rating")
    )


def pending_complaints(m: Marketplace) -> DataFrame:
    """Open complaints with the user who raised them, who need not be the one who ordered."""
    return (
        m["complaint"]
        .where(F.col("Status") == "Pending")
        .select(
            "Complaint_ID",
            "Issue_Type",
            "Description",
            "OrderID",
            "UserID",
            F.col("Created_At").alias("Complaint_Time"),
        )
        .join(m["orders"].select("OrderID", F.col("Date_Time").alias("Order_Time")), "OrderID")
        .join(m["user"].select("UserID", "User_Name", "Phone_No"), "UserID")
        .orderBy("Complaint_Time", "Complaint_ID")
        .select(
            "Complaint_ID", "Issue_Type", "Description", "User_Name", "Phone_No", "Order_Time", "Complaint_Time"
        )
    )


def top_spenders(m: Marketplace) -> DataFrame:
    spend = (
        _live_orders(m)
        .groupBy("UserID")
        .agg(F.count(F.lit(1)).alias("Total_Orders"), F.sum("Total_Amount").alias("Total_Spent"))
    )
    return (
        spend.join(m["user"].select("UserID", "User_Name"), "UserID")
        .join(m["wallet"].select("UserID", F.col("Balance").alias("Current_Wallet_Balance")), "UserID")
        .orderBy(F.desc("Total_Spent"), "UserID")
        .select("User_Name", "Total_Orders", "Total_Spent", "Current_Wallet_Balance")
    )


def refund_summary(m: Marketplace) -> DataFrame:
    return (
        m["refund"]
        .groupBy("Refund_Status")
        .agg(F.count(F.lit(1)).alias("Refund_Count"), F.sum("Refund_Amount").alias("Total_Amount"))
    )


def most_ordered_items(m: Marketplace, top: int = 5) -> DataFrame:
    """Items by pieces ordered; equal counts go to the smaller item number."""
    best = (
        m["order_item"]
        .groupBy("Item_ID")
        .agg(F.sum("Quantity").alias("Total_Ordered"))
        .orderBy(F.desc("Total_Ordered"), "Item_ID")
        .limit(top)
    )
    return (
        m["menu_item"]
        .select("Item_ID", "Item_Name", "Is_Veg", "Price", F.col("Rating").alias("Item_Rating"))
        .join(F.broadcast(best), "Item_ID")  # ``top`` rows
        .orderBy(F.desc("Total_Ordered"), "Item_ID")
        .select("Item_Name", "Is_Veg", "Price", "Total_Ordered", "Item_Rating")
    )


def monthly_revenue(m: Marketplace) -> DataFrame:
    return (
        _live_orders(m)
        .groupBy(label_month(F.col("Date_Time")).alias("Month"))
        .agg(F.count(F.lit(1)).alias("Total_Orders"), F.sum("Total_Amount").alias("Total_Revenue"))
        .orderBy("Month")
    )


def veg_split(m: Marketplace) -> DataFrame:
    """Order lines by diet. Items marked non-veg and items without a mark form two rows of the same name."""
    sold = m["order_item"].groupBy("Item_ID").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("Quantity").alias("pieces")
    )
    return (
        sold.join(m["menu_item"].select("Item_ID", "Is_Veg"), "Item_ID")
        .groupBy("Is_Veg")
        .agg(F.sum("lines").alias("Items_Ordered"), F.sum("pieces").alias("Total_Quantity"))
        .select(
            F.when(F.col("Is_Veg"), "Veg").otherwise("Non-Veg").alias("Food_Type"), "Items_Ordered", "Total_Quantity"
        )
    )


def orders_by_city(m: Marketplace) -> DataFrame:
    by_address = (
        _live_orders(m)
        .where(F.col("Add_ID").isNotNull())
        .groupBy("Add_ID")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("Total_Amount").alias("amount"))
    )
    return (
        by_address.join(m["address"].select("Add_ID", "City"), "Add_ID")
        .groupBy("City")
        .agg(F.sum("orders").alias("Total_Orders"), F.sum("amount").alias("Revenue"))
        .orderBy(F.desc("Total_Orders"), "City")
    )


def coupon_usage(m: Marketplace) -> DataFrame:
    return (
        m["coupon"]
        .orderBy(F.desc("Used_Count"), "Coupon_ID")
        .select(
            "Coupon_Code",
            "Description",
            "Used_Count",
            "Max_Uses",
            half_up_ratio(F.col("Used_Count") * 100, F.col("Max_Uses"), 1).alias("Usage_Pct"),
        )
    )


def unread_notifications(m: Marketplace) -> DataFrame:
    unread = m["notification"].where(~F.col("Is_Read")).groupBy("UserID").agg(F.count(F.lit(1)).alias("Unread_Count"))
    return (
        unread.join(m["user"].select("UserID", "User_Name"), "UserID")
        .orderBy(F.desc("Unread_Count"), "UserID")
        .select("User_Name", "Unread_Count")
    )


def order_timeline(m: Marketplace, order_id: int) -> DataFrame:
    """Status changes of one order in time order; the order number is pushed to both scans."""
    one = F.col("OrderID") == order_id
    who = m["orders"].where(one).select("OrderID", "UserID").join(m["user"].select("UserID", "User_Name"), "UserID")
    return (
        m["order_status_log"]
        .where(one)
        .join(F.broadcast(who), "OrderID")  # at most one row: order and user numbers are keys
        .orderBy("Changed_At", "Log_ID")
        .select("OrderID", "User_Name", "Status", "Changed_At", "Note")
    )


def available_partners(m: Marketplace, city: str) -> DataFrame:
    return (
        m["delivery_partner"]
        .where(F.col("Is_Available") & (F.col("City") == city))
        .orderBy(F.desc("Rating"), "Partner_ID")
        .select("Partner_ID", "Name", "Phone_No", "Vehicle_No", "Rating", "Total_Deliveries")
    )


def cancellations_with_refunds(m: Marketplace) -> DataFrame:
    """One row per cancellation and refund of its order, with the user who ordered.

    The optional refunds are an inner join and an anti join put together: the skew join cannot split the optional
    side of an outer join, and a single order may have any number of refunds.
    """
    refunds = m["refund"].select("Refund_ID", "OrderID", "Refund_Amount", "Refund_Status")
    cancelled = m["cancellation"].select(
        "Cancellation_ID", F.col("Order_ID").alias("OrderID"), F.col("Reason").alias("Cancel_Reason"), "Cancel_At"
    )
    without = cancelled.join(refunds.select("OrderID").distinct(), "OrderID", "left_anti")
    rows = refunds.join(cancelled, "OrderID").unionByName(without, allowMissingColumns=True)
    return (
        rows.join(m["orders"].select("OrderID", "UserID"), "OrderID")
        .join(m["user"].select("UserID", "User_Name"), "UserID")
        .orderBy(F.desc("Cancel_At"), "Cancellation_ID", "Refund_ID")
        .select("OrderID", "User_Name", "Cancel_Reason", "Cancel_At", "Refund_Amount", "Refund_Status")
    )
