"""The marketplace tables as SQL over the star schema. Generation 1 is ``g1_*``, generation 2 ``g2_*``."""

from __future__ import annotations

import re

N = "(SELECT count(*) FROM supplier)"
ITEM = "CASE WHEN l_partkey % 10 = 3 THEN l_partkey + 1 ELSE l_partkey END"
WEEKEND = "dayofweek(o_orderdate) IN (0, 6)"
EPOCH = "TIMESTAMP '1992-01-01 00:00:00'"


def _next(expr: str, taken: int) -> str:
    return f"CASE WHEN {expr} = {taken} THEN {taken + 1} ELSE {expr} END"


def _nth(expr: str, labels: list) -> str:
    """List look-up by remainder (lists count from 1)."""
    items = ", ".join("NULL" if x is None else str(x).lower() if isinstance(x, bool) else f"'{x}'" for x in labels)
    return f"([{items}])[{expr} % {len(labels)} + 1]"


ISSUES = ["Late Delivery", "Wrong Item", "Cold Food", "Missing Item", "Quality Issue", "Packaging", "Spill", "Other"]
MODE = (
    "CASE left(o_orderpriority, 1) WHEN '1' THEN 'UPI' WHEN '2' THEN 'Card' WHEN '3' THEN 'Cash' "
    "WHEN '4' THEN 'Wallet' ELSE 'NetBanking' END"
)


def _order_state(cancelled, delivered, preparing, moving):
    return (
        f"CASE WHEN o_orderkey % 6 = 0 THEN '{cancelled}' WHEN o_orderstatus = 'F' THEN '{delivered}' "
        f"WHEN o_orderstatus = 'P' THEN '{preparing}' ELSE '{moving}' END"
    )


CANCELLED = _order_state("cancelled", "", "", "") + " = 'cancelled'"
PAY_STATE = (
    "(CASE WHEN o_orderstatus = 'P' THEN 'Pending' ELSE "
    + _nth("o_orderkey", ["Failed", "Pending", "Refunded", "Paid", "Paid", "Paid", "Paid"])
    + " END)"
)
BILLED = (
    f"CAST(o_totalprice AS DECIMAL(10, 2)) - CASE WHEN {WEEKEND} THEN 50 ELSE 0 END "
    "+ CASE WHEN o_orderkey % 13 = 0 THEN 5 ELSE 0 END"
)
CLOSE = _nth("s_suppkey", ["23:30:00", "22:00:00", "23:00:00"])
REFUND_STATE = _nth("event_id", ["Pending", "Pending", "Completed", "Completed", "Rejected"])
V1_COMPLAINT = _nth("(event_id // 8)", ["Open", "Under Review", "Resolved", "Closed"])
V2_COMPLAINT = _nth("(event_id // 8)", ["Pending", "Resolved", "Resolved", "Rejected"])
CANCELLED_BY = _nth(
    "o_orderkey", ["Customer", "Customer", "Customer", "Restaurant", "Restaurant", "System", "System"]
)

TABLES = {
    "g1_users": f"""
        SELECT c_custkey AS UserID, c_name AS User_Name, 6000000000 + c_custkey AS Phone_No,
               c_name || '@example.com' AS Email, '-' AS Password, 'customer' AS Role,
               {EPOCH} AS Created_At, {EPOCH} AS Updated_At
        FROM customer""",
    "g1_user_address": """
        SELECT c_custkey AS Add_ID, c_name AS Add_line_1, CAST(NULL AS VARCHAR) AS Add_line_2,
               c_mktsegment AS Area, n_name AS City, CAST(100000 + c_custkey % 900000 AS INTEGER) AS Pincode
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "g1_user_has_address": "SELECT c_custkey AS Add_ID, c_custkey AS UserID FROM customer",
    "g1_restaurant": f"""
        SELECT s_suppkey AS Restaurant_ID, s_name AS Name, '10:00:00' AS Open_Time, {CLOSE} AS Close_Time,
               s_suppkey % 5 <> 0 AS Restaurant_Status, 10000000000000 + s_suppkey AS FSSAI_License_No,
               7000000000 + s_suppkey AS Contact_No, CAST(3 + (s_suppkey % 9) * 0.25 AS FLOAT) AS Rating,
               s_suppkey AS Owner_UserID, {EPOCH} AS Created_At, {EPOCH} AS Updated_At
        FROM supplier""",
    "g1_restaurant_address": """
        SELECT s_suppkey AS Add_ID, s_name AS Add_line_1, CAST(NULL AS VARCHAR) AS Add_line_2, n_name AS Area,
               n_name AS City, CAST(100000 + s_suppkey % 900000 AS INTEGER) AS Pincode, s_suppkey AS Restaurant_ID
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "g1_cuisine": """
        SELECT DISTINCT p_type AS Cuisine, l_suppkey AS Restaurant_ID
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "g1_menu_category": f"""
        SELECT DISTINCT p_type AS Category_Name,
               CASE p_type WHEN 'PROMO' THEN 'Vegan' WHEN 'LARGE' THEN 'Non-Veg' WHEN 'MEDIUM' THEN 'Non-Veg'
                    ELSE 'Veg' END AS Type,
               p_partkey % {N} AS Restaurant_ID
        FROM part""",
    "g1_menu_item": f"""
        SELECT p_partkey AS Item_ID, p_name AS Item_Name, p_brand AS Description,
               CAST(p_retailprice AS DECIMAL(8, 2)) AS Price, p_size AS Preparation_Time, p_size > 5 AS Is_Available,
               p_type AS Category_Name, p_partkey % {N} AS Restaurant_ID, {EPOCH} AS Created_At, {EPOCH} AS Updated_At
        FROM part""",
    "g1_review": f"""
        SELECT event_id AS Review_ID, props AS Review,
               CAST(CASE WHEN event_id % {N} % 3 = 0 THEN 4 + user_id % 2 ELSE 1 + user_id % 5 END AS FLOAT) AS Rating,
               event_id % {N} AS Restaurant_ID, user_id AS UserID, ts AS Created_At
        FROM events WHERE event_type IN ('view', 'click')""",
    "g1_cart": f"""
        SELECT o_orderkey AS Cart_ID, o_orderdate AS Created_At,
               {_nth("o_orderkey", ["Abandoned", "Active", "Checked Out"])} AS Status, o_custkey AS UserID
        FROM orders""",
    "g1_cart_item": """
        SELECT l_partkey AS Item_ID, l_orderkey AS Cart_ID, CAST(floor(sum(l_quantity)) AS BIGINT) AS Quantity
        FROM lineitem GROUP BY ALL""",
    "g1_orders": f"""
        SELECT o_orderkey AS OrderID, o_orderdate AS Date_Time, o_custkey AS UserID,
               {_next(f"o_orderkey % {N}", 7)} AS Restaurant_ID,
               {_order_state("cancelled", "delivered", "preparing", "out_for_delivery")} AS Status,
               CAST(o_totalprice AS DECIMAL(10, 2)) AS Total_Amount, o_orderdate AS Updated_At
        FROM orders""",
    "g1_order_item": f"""
        SELECT {ITEM} AS Item_ID, l_orderkey AS OrderID, CAST(floor(sum(l_quantity)) AS BIGINT) AS Quantity,
               CAST(max(l_extendedprice) AS DECIMAL(8, 2)) AS Unit_Price
        FROM lineitem GROUP BY ALL""",
    "g1_payment": f"""
        SELECT o_orderkey + 1 AS Transaction_ID, {MODE} AS Mode, {PAY_STATE} AS Status,
               CAST({BILLED} AS DECIMAL(10, 2)) AS Amount, CAST(NULL AS VARCHAR) AS Gateway_Ref,
               CASE WHEN {PAY_STATE} = 'Paid' THEN o_orderdate END AS Paid_At, o_orderkey AS Order_ID
        FROM orders""",
    "g1_delivery_partner": f"""
        SELECT s_suppkey AS Partner_ID, s_name AS Name, 8000000000 + s_suppkey AS Phone_No,
               'V' || s_suppkey AS Vehicle_No, CAST(3 + (s_suppkey % 9) * 0.25 AS FLOAT) AS Rating,
               s_suppkey % 5 <> 0 AS Is_Active, {EPOCH} AS Created_At
        FROM supplier""",
    "g1_delivery": f"""
        SELECT event_id AS Delivery_ID, CASE WHEN event_type <> 'view' THEN ts END AS Pickup_Time,
               CASE WHEN event_type <> 'signup' THEN ts + to_seconds(CAST(floor(value * 20) AS BIGINT)) END
                   AS Delivery_Time,
               CASE event_type WHEN 'error' THEN 'Failed' WHEN 'signup' THEN 'In Transit' ELSE 'Delivered' END AS Status,
               event_id AS OrderID, {_next(f"event_id % {N}", 5)} AS Partner_ID
        FROM events""",
    "g1_wallet": f"""
        SELECT c_custkey AS Wallet_ID, CAST(CAST(c_acctbal AS DECIMAL(8, 2)) * 100 AS DECIMAL(10, 2)) AS Balance,
               {EPOCH} AS Created_At, c_custkey AS UserID
        FROM customer""",
    "g1_wallet_transaction": """
        SELECT user_id AS Wallet_ID, event_id AS Transaction_ID,
               CASE event_type WHEN 'purchase' THEN 'Debit' ELSE 'Credit' END AS Type,
               CAST(value AS DECIMAL(10, 2)) AS Amount, ts AS Date_Time
        FROM events WHERE event_type IN ('purchase', 'click')""",
    "g1_wallet_topup": f"""
        SELECT event_id AS Transaction_ID, {_nth("event_id", ["Success", "Failed", "Pending"])} AS Status,
               {_nth("event_id", ["UPI", "Card", "NetBanking"])} AS Payment_mode,
               900000000 + event_id AS Transaction_Ref, ts AS Date_Time, user_id AS Wallet_ID
        FROM events WHERE event_type = 'click'""",
    "g1_discount": f"""
        SELECT o_orderkey AS Discount_ID, CAST(10 AS FLOAT) AS Discount_PR,
               CAST(50 AS DECIMAL(8, 2)) AS Discount_Amount, o_orderkey AS OrderID
        FROM orders WHERE {WEEKEND}""",
    "g1_complaint": f"""
        SELECT event_id AS Complaint_ID, event_id * 7 % (SELECT greatest(1, count(*)) FROM orders) AS OrderID, {_nth("event_id", ISSUES)} AS Issue_Type,
               props AS Description, ts AS Created_At, {V1_COMPLAINT} AS Status,
               CASE WHEN {V1_COMPLAINT} IN ('Resolved', 'Closed') THEN ts + INTERVAL 3 HOUR END AS Resolved_At
        FROM events WHERE event_type IN ('error', 'signup')""",
    "g1_refund": f"""
        SELECT event_id AS Refund_ID, o_orderkey AS OrderID, event_id AS Complaint_ID,
               CAST(event_id % 500 AS DECIMAL(8, 2)) AS Refund_Amount, {REFUND_STATE} AS Refund_Status,
               CASE WHEN event_id % 5 IN (2, 3) THEN ts + INTERVAL 2 HOUR END AS Completed_At, o_custkey AS Wallet_ID
        FROM events JOIN orders ON o_orderkey = event_id * 7 % (SELECT greatest(1, count(*)) FROM orders) WHERE event_type = 'error'""",
    "g1_cancellation": f"""
        SELECT o_orderkey AS Cancellation_ID, {CANCELLED_BY} AS Cancelled_By, o_orderpriority AS Cancellation_Reason,
               o_orderdate + INTERVAL 1 HOUR AS Cancelled_At, o_orderkey % 4 <> 0 AS Refund_Eligible,
               CAST(o_orderkey % 3 * 10 AS DECIMAL(8, 2)) AS Penalty_Amount, o_orderkey AS OrderID
        FROM orders WHERE {CANCELLED}""",
    "g2_address": """
        SELECT c_custkey AS Add_ID, c_name AS Add_line_1, CAST(NULL AS VARCHAR) AS Add_line_2,
               c_mktsegment AS Area, n_name AS City, CAST(100000 + c_custkey % 900000 AS INTEGER) AS Pincode
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "g2_user": f"""
        SELECT c_custkey AS UserID, c_name AS User_Name, c_name || '@example.com' AS Email,
               CAST(6000000000 + c_custkey AS VARCHAR) AS Phone_No, '-' AS Password_Hash,
               CAST(NULL AS VARCHAR) AS Profile_Pic, true AS Is_Active, {EPOCH} AS Created_At
        FROM customer""",
    "g2_restaurant": f"""
        SELECT s_suppkey AS Restaurant_ID, s_name AS Resto_Name, '10:00:00' AS Open_Time, {CLOSE} AS Close_Time,
               s_suppkey % 5 <> 0 AS Restaurant_Status, 10000000000000 + s_suppkey AS FSSAI_License_No,
               CAST(7000000000 + s_suppkey AS VARCHAR) AS Contact_No, s_suppkey AS Add_ID,
               CAST((30 + s_suppkey % 20) * 0.1 AS DECIMAL(3, 1)) AS Rating, s_suppkey AS Total_Reviews,
               100 + s_suppkey % 5 * 50 AS Min_Order_Amount, 20 + s_suppkey % 30 AS Avg_Delivery_Time
        FROM supplier""",
    "g2_user_address": "SELECT c_custkey AS UserID, c_custkey AS Add_ID FROM customer",
    "g2_cuisine": """
        SELECT DISTINCT p_type AS Cuisine, l_suppkey AS Restaurant_ID
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "g2_menu_category": f"""
        SELECT DISTINCT p_type AS Category_Name, 'Food' AS Cat_Type, p_partkey % {N} AS Restaurant_ID FROM part""",
    "g2_menu_item": f"""
        SELECT p_partkey AS Item_ID, p_name AS Item_Name, CAST(floor(p_retailprice) AS BIGINT) AS Price,
               p_size > 5 AS Is_Available, {_nth("p_partkey", [None, False, False, True, True, True, True])} AS Is_Veg,
               CAST(p_size * 0.125 AS FLOAT) AS Rating, p_type AS Category_Name, p_partkey % {N} AS Restaurant_ID
        FROM part""",
    "g2_coupon": """
        SELECT p_partkey AS Coupon_ID, 'C' || p_partkey AS Coupon_Code, p_name AS Description,
               CAST(p_partkey % 50 AS BIGINT) AS Max_Uses, CAST(p_size AS BIGINT) AS Used_Count
        FROM part""",
    "g2_discount": "SELECT p_partkey AS Discount_ID, p_partkey AS Coupon_ID FROM part",
    "g2_cart": f"""
        SELECT o_orderkey AS Cart_ID, o_orderdate AS Created_At,
               {_nth("o_orderkey", ["Abandoned", "Active", "Ordered"])} AS Status, o_custkey AS UserID
        FROM orders""",
    "g2_cart_item": """
        SELECT l_orderkey AS Cart_ID, l_partkey AS Item_ID, CAST(floor(sum(l_quantity)) AS BIGINT) AS Quantity
        FROM lineitem GROUP BY ALL""",
    "g2_orders": f"""
        SELECT o_orderkey AS OrderID, o_orderdate AS Date_Time,
               {_order_state("Cancelled", "Delivered", "Preparing", "OutForDelivery")} AS Order_Status,
               CAST(floor(o_totalprice) AS BIGINT) AS Total_Amount, o_custkey AS UserID, o_custkey AS Add_ID,
               CASE WHEN {WEEKEND} THEN o_orderkey % (SELECT greatest(1, count(*)) FROM part) END AS Discount_ID
        FROM orders""",
    "g2_order_status_log": """
        SELECT event_id AS Log_ID, event_id % (SELECT greatest(1, count(*)) FROM orders) AS OrderID, event_type AS Status, ts AS Changed_At, props AS Note
        FROM events""",
    "g2_order_item": f"""
        SELECT l_orderkey AS OrderID, {ITEM} AS Item_ID, CAST(floor(sum(l_quantity)) AS BIGINT) AS Quantity,
               CAST(floor(max(l_extendedprice)) AS BIGINT) AS Price
        FROM lineitem GROUP BY ALL""",
    "g2_delivery_partner": """
        SELECT s_suppkey AS Partner_ID, s_name AS Name, CAST(8000000000 + s_suppkey AS VARCHAR) AS Phone_No,
               'V' || s_suppkey AS Vehicle_No, CAST((30 + s_suppkey % 20) * 0.1 AS DECIMAL(3, 1)) AS Rating,
               s_suppkey % 5 <> 0 AS Is_Available, n_name AS City, s_suppkey * 3 AS Total_Deliveries
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "g2_delivery": f"""
        SELECT event_id AS Delivery_ID, CASE WHEN event_type <> 'view' THEN ts END AS Pickup_Time,
               CASE WHEN event_type <> 'signup' THEN ts + to_seconds(CAST(floor(value * 20) AS BIGINT)) END
                   AS Delivery_Time,
               event_id AS OrderID, {_next(f"event_id % {N}", 5)} AS Partner_ID
        FROM events""",
    "g2_payment": f"""
        SELECT o_orderkey + 1 AS Transaction_ID, {MODE} AS Mode, CAST(floor({BILLED}) AS BIGINT) AS Amount,
               CASE {PAY_STATE} WHEN 'Paid' THEN 'Success' WHEN 'Failed' THEN 'Failed' ELSE 'Pending' END AS Status,
               o_orderkey AS Order_ID
        FROM orders""",
    "g2_review": f"""
        SELECT event_id AS Review_ID, props AS Review, CAST(1 + user_id % 5 AS DECIMAL(3, 1)) AS Rating,
               ts AS Review_Date, CASE WHEN event_type = 'view' THEN event_id % {N} END AS Restaurant_ID,
               user_id AS UserID, CASE WHEN event_type = 'click' THEN event_id % {N} END AS Partner_ID
        FROM events WHERE event_type IN ('view', 'click')""",
    "g2_cancellation": f"""
        SELECT o_orderkey AS Cancellation_ID, o_custkey AS Canceled_BY, o_orderpriority AS Reason,
               o_orderdate + INTERVAL 1 HOUR AS Cancel_At, o_orderkey AS Order_ID
        FROM orders WHERE {CANCELLED}""",
    "g2_wallet": """
        SELECT c_custkey AS Wallet_ID, CAST(floor(CAST(c_acctbal AS DECIMAL(8, 2)) * 100) AS BIGINT) AS Balance,
               c_custkey AS UserID
        FROM customer""",
    "g2_wallet_transaction": """
        SELECT event_id AS Transaction_ID, user_id AS Wallet_ID,
               CASE event_type WHEN 'purchase' THEN 'DEBIT' ELSE 'CREDIT' END AS Type,
               CAST(floor(CAST(value AS DECIMAL(10, 2))) AS BIGINT) AS Amount, ts AS Date_Time
        FROM events WHERE event_type IN ('purchase', 'click')""",
    "g2_wallet_topup": f"""
        SELECT event_id AS Transaction_ID, {_nth("event_id", ["Success", "Failed", "Pending"])} AS Status,
               {_nth("event_id", ["UPI", "Card", "NetBanking"])} AS Payment_Mode,
               900000000 + event_id AS Transaction_Ref, ts AS Date_Time
        FROM events WHERE event_type = 'click'""",
    "g2_notification": """
        SELECT event_id AS Notification_ID, user_id AS UserID, event_id % 3 <> 0 AS Is_Read FROM events""",
    "g2_complaint": f"""
        SELECT event_id AS Complaint_ID, event_id * 7 % (SELECT greatest(1, count(*)) FROM orders) AS OrderID, user_id AS UserID,
               {_nth("event_id", ISSUES)} AS Issue_Type, props AS Description, ts AS Created_At,
               {V2_COMPLAINT} AS Status
        FROM events WHERE event_type IN ('error', 'signup')""",
    "g2_refund": f"""
        SELECT event_id AS Refund_ID, o_orderkey AS OrderID, event_id AS Complaint_ID,
               event_id % 500 AS Refund_Amount, {REFUND_STATE} AS Refund_Status, o_custkey AS Wallet_ID
        FROM events JOIN orders ON o_orderkey = event_id * 7 % (SELECT greatest(1, count(*)) FROM orders) WHERE event_type = 'error'""",
}


def with_tables(body: str, recursive: str = "") -> str:
    """``body`` behind a WITH clause that defines the tables it mentions (and further ``recursive`` ones)."""
    used = set(re.findall(r"\bg[12]_\w+", body + recursive))
    parts = [f"{name} AS ({TABLES[name]})" for name in TABLES if name in used]
    if recursive:
        return f"WITH RECURSIVE {', '.join([*parts, recursive])} {body}"
    return f"WITH {', '.join(parts)} {body}" if parts else body
