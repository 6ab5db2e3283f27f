"""Expected results as SQL, written straight from the definitions: products of fan-out joins really are built here,
and counts of distinct keys are counted distinct, so the shortcuts of the Spark plans are put to the test."""

from __future__ import annotations

from oracle.tables import N, with_tables

TYPES = {"l": "BIGINT", "s": "VARCHAR", "d": "DOUBLE", "t": "TIMESTAMP", "b": "BOOLEAN"}


def _out(columns: str, body: str, recursive: str = "") -> str:
    """Query with its columns in the types the comparison uses."""
    pairs = [c.split(":") for c in columns.split()]
    casts = ", ".join(f'CAST("{name}" AS {TYPES[kind]}) AS "{name}"' for name, kind in pairs)
    return with_tables(f"SELECT {casts} FROM ({body}) AS result", recursive)


def _ratio(num: str, den: str, places: int) -> str:
    """Whole-number half-up rounding of num / den, both not negative; NULL for a zero divisor."""
    scale = 10**places
    n, d = f"CAST(({num}) * {scale} AS HUGEINT)", f"CAST(({den}) AS HUGEINT)"
    return f"CAST((2 * {n} + {d}) // nullif(2 * {d}, 0) AS DOUBLE) / {scale}"


def _average(values: str, places: int) -> str:
    return _ratio(f"sum({values})", f"count({values})", places)


MINUTES = "date_sub('minute', Pickup_Time, Delivery_Time)"
LINES = "g1_cart_item JOIN g1_menu_item USING (Item_ID)"


def _analytics() -> dict[str, str]:
    return {
        "a01_revenue_leaderboard": _out(
            "Restaurant_ID:l restaurant_name:s avg_rating:d total_orders:l total_revenue:d avg_order_value:d",
            f"""SELECT r.Restaurant_ID, r.Name AS restaurant_name, r.Rating AS avg_rating,
                       count(DISTINCT OrderID) AS total_orders, sum(Amount) AS total_revenue,
                       {_ratio("sum(Amount)", "count(DISTINCT OrderID)", 2)} AS avg_order_value
                FROM g1_payment p JOIN g1_orders o ON OrderID = Order_ID JOIN g1_restaurant r USING (Restaurant_ID)
                WHERE p.Status = 'Paid' GROUP BY 1, 2, 3""",
        ),
        "a02_customer_lifetime_value": _out(
            "UserID:l User_Name:s Email:s total_orders:l lifetime_spend:d avg_order_value:d last_order_date:t",
            f"""SELECT UserID, User_Name, Email, count(DISTINCT OrderID) AS total_orders,
                       sum(Total_Amount) AS lifetime_spend, {_average("Total_Amount", 2)} AS avg_order_value,
                       max(Date_Time) AS last_order_date
                FROM g1_orders JOIN g1_users USING (UserID) WHERE Status <> 'cancelled' GROUP BY ALL""",
        ),
        "a03_payment_mode_split": _out(
            "payment_mode:s transactions:l total_collected:d pct_share:d",
            f"""SELECT Mode AS payment_mode, count(*) AS transactions, sum(Amount) AS total_collected,
                       {_ratio("100 * count(*)", "any_value(everything)", 2)} AS pct_share
                FROM g1_payment, (SELECT count(*) AS everything FROM g1_payment)
                WHERE Status = 'Paid' GROUP BY Mode""",
        ),
        "a04_new_vs_returning": _out(
            "OrderID:l User_Name:s Date_Time:t Total_Amount:d customer_type:s",
            """SELECT OrderID, User_Name, Date_Time, Total_Amount,
                      if(row_number() OVER (PARTITION BY UserID ORDER BY OrderID) = 1,
                         'New Customer', 'Returning Customer') AS customer_type
               FROM g1_orders JOIN g1_users USING (UserID)""",
        ),
        "a05_repeat_customers": _out(
            "UserID:l User_Name:s Email:s Phone_No:l order_count:l total_spent:d",
            """SELECT * FROM (
                   SELECT UserID, User_Name, Email, Phone_No, count(OrderID) AS order_count,
                          sum(Total_Amount) AS total_spent
                   FROM g1_orders JOIN g1_users USING (UserID) GROUP BY ALL)
               WHERE order_count >= 2""",
        ),
        "a06_abandoned_carts": _out(
            "UserID:l User_Name:s Email:s Cart_ID:l cart_created:t items_in_cart:l cart_value:d",
            f"""SELECT UserID, User_Name, Email, Cart_ID, c.Created_At AS cart_created, count(*) AS items_in_cart,
                       sum(Quantity * Price) AS cart_value
                FROM {LINES} JOIN g1_cart c USING (Cart_ID) JOIN g1_users USING (UserID)
                WHERE c.Status = 'Abandoned' GROUP BY ALL""",
        ),
        "a07_restaurant_dashboard": _out(
            "Restaurant_ID:l restaurant_name:s Rating:d total_orders:l delivered:l cancelled:l cancel_rate_pct:d"
            " total_complaints:l total_revenue:d",
            """SELECT Restaurant_ID, Name AS restaurant_name, Rating, count(DISTINCT OrderID) AS total_orders,
                      count(*) FILTER (Status = 'delivered') AS delivered,
                      count(*) FILTER (Status = 'cancelled') AS cancelled,
                      CAST(100 * count(*) FILTER (Status = 'cancelled') AS DOUBLE)
                          / nullif(count(DISTINCT OrderID), 0) AS cancel_rate_pct,
                      count(DISTINCT Complaint_ID) AS total_complaints, sum(Amount) AS total_revenue
               FROM g1_restaurant
               LEFT JOIN (SELECT OrderID, Restaurant_ID, Status FROM g1_orders) USING (Restaurant_ID)
               LEFT JOIN (SELECT Order_ID AS OrderID, Amount FROM g1_payment WHERE Status = 'Paid') USING (OrderID)
               LEFT JOIN (SELECT OrderID, Complaint_ID FROM g1_complaint) USING (OrderID)
               GROUP BY 1, 2, 3""",
        ),
        "a07_restaurant_dashboard_corrected": _out(
            "Restaurant_ID:l restaurant_name:s Rating:d total_orders:l delivered:l cancelled:l cancel_rate_pct:d"
            " total_complaints:l total_revenue:d",
            """SELECT Restaurant_ID, Name AS restaurant_name, Rating, count(OrderID) AS total_orders,
                      count(*) FILTER (Status = 'delivered') AS delivered,
                      count(*) FILTER (Status = 'cancelled') AS cancelled,
                      CAST(100 * count(*) FILTER (Status = 'cancelled') AS DOUBLE)
                          / nullif(count(OrderID), 0) AS cancel_rate_pct,
                      coalesce(sum((SELECT count(*) FROM g1_complaint c WHERE c.OrderID = o.OrderID)), 0)
                          AS total_complaints,
                      sum((SELECT Amount FROM g1_payment p WHERE p.Order_ID = o.OrderID AND p.Status = 'Paid'))
                          AS total_revenue
               FROM g1_restaurant
               LEFT JOIN (SELECT OrderID, Restaurant_ID, Status FROM g1_orders) o USING (Restaurant_ID)
               GROUP BY 1, 2, 3""",
        ),
        "a08_top_rated_restaurants": _out(
            "Restaurant_ID:l restaurant_name:s avg_review_rating:d cuisines:s City:s total_orders:l",
            f"""SELECT * FROM (
                    SELECT Restaurant_ID, Name AS restaurant_name,
                           coalesce({_average("CAST(v.Rating AS DECIMAL(10, 4))", 2)}, 0) AS avg_review_rating,
                           string_agg(DISTINCT Cuisine, ',' ORDER BY Cuisine) AS cuisines, City,
                           count(DISTINCT OrderID) AS total_orders
                    FROM g1_restaurant
                    JOIN (SELECT Restaurant_ID, City FROM g1_restaurant_address) USING (Restaurant_ID)
                    LEFT JOIN (SELECT Restaurant_ID, Rating FROM g1_review) v USING (Restaurant_ID)
                    LEFT JOIN g1_cuisine USING (Restaurant_ID)
                    LEFT JOIN (SELECT Restaurant_ID, OrderID FROM g1_orders) USING (Restaurant_ID)
                    WHERE Restaurant_Status GROUP BY Restaurant_ID, Name, City)
                WHERE avg_review_rating >= 4 AND total_orders > 0""",
        ),
        "a09_partner_scorecard": _out(
            "Partner_ID:l partner_name:s Vehicle_No:s Rating:d total_deliveries:l completed:l failed:l"
            " success_rate_pct:d",
            f"""SELECT Partner_ID, Name AS partner_name, Vehicle_No, Rating, count(Delivery_ID) AS total_deliveries,
                       count(*) FILTER (Status = 'Delivered') AS completed,
                       count(*) FILTER (Status = 'Failed') AS failed,
                       {_ratio("100 * count(*) FILTER (Status = 'Delivered')", "count(Delivery_ID)", 2)}
                           AS success_rate_pct
                FROM g1_delivery_partner LEFT JOIN g1_delivery USING (Partner_ID) GROUP BY 1, 2, 3, 4""",
        ),
        "a10_delivery_duration": _out(
            "Partner_ID:l partner_name:s deliveries_completed:l avg_transit_minutes:d fastest_mins:l slowest_mins:l",
            f"""SELECT Partner_ID, Name AS partner_name, count(*) AS deliveries_completed,
                       {_average(MINUTES, 2)} AS avg_transit_minutes, min({MINUTES}) AS fastest_mins,
                       max({MINUTES}) AS slowest_mins
                FROM g1_delivery JOIN g1_delivery_partner USING (Partner_ID)
                WHERE Status = 'Delivered' AND Pickup_Time IS NOT NULL AND Delivery_Time IS NOT NULL
                GROUP BY 1, 2""",
        ),
        "a11_best_sellers": _out(
            "Item_ID:l Item_Name:s Price:d veg_nonveg:s restaurant_name:s total_qty_sold:l appeared_in_orders:l"
            " total_revenue:d",
            """SELECT Item_ID, Item_Name, Price, Type AS veg_nonveg, r.Name AS restaurant_name,
                      sum(Quantity) AS total_qty_sold, count(DISTINCT OrderID) AS appeared_in_orders,
                      sum(Quantity * Unit_Price) AS total_revenue
               FROM g1_order_item JOIN g1_menu_item USING (Item_ID)
               JOIN g1_menu_category USING (Restaurant_ID, Category_Name) JOIN g1_restaurant r USING (Restaurant_ID)
               GROUP BY ALL""",
        ),
        "a12_dead_stock": _out(
            "Item_ID:l Item_Name:s Price:d Is_Available:b restaurant_name:s Category_Name:s",
            """SELECT Item_ID, Item_Name, Price, Is_Available, r.Name AS restaurant_name, Category_Name
               FROM g1_menu_item i JOIN g1_restaurant r USING (Restaurant_ID)
               WHERE NOT EXISTS (SELECT 1 FROM g1_order_item s WHERE s.Item_ID = i.Item_ID)""",
        ),
        "a13_wallet_summary": _out(
            "Wallet_ID:l User_Name:s Email:s current_balance:d total_transactions:l total_credited:d total_debited:d",
            """SELECT Wallet_ID, User_Name, Email, Balance AS current_balance,
                      count(DISTINCT Transaction_ID) AS total_transactions,
                      coalesce(sum(Amount) FILTER (Type = 'Credit'), 0) AS total_credited,
                      coalesce(sum(Amount) FILTER (Type = 'Debit'), 0) AS total_debited
               FROM g1_wallet JOIN g1_users USING (UserID) LEFT JOIN g1_wallet_transaction USING (Wallet_ID)
               GROUP BY 1, 2, 3, 4""",
        ),
        "a14_complaint_resolution": _out(
            "Issue_Type:s total_complaints:l resolved_count:l resolution_rate_pct:d still_open:l",
            f"""SELECT Issue_Type, count(*) AS total_complaints,
                       count(*) FILTER (Status IN ('Resolved', 'Closed')) AS resolved_count,
                       {_ratio("100 * count(*) FILTER (Status IN ('Resolved', 'Closed'))", "count(*)", 2)}
                           AS resolution_rate_pct,
                       count(*) FILTER (Status = 'Open') AS still_open
                FROM g1_complaint GROUP BY Issue_Type""",
        ),
        "a15_refund_impact": _out(
            "OrderID:l customer:s restaurant:s order_amount:d amount_paid:d payment_mode:s complaint_reason:s"
            " Refund_Amount:d Refund_Status:s refund_completed:t refund_pct_of_payment:d",
            f"""SELECT f.OrderID, User_Name AS customer, r.Name AS restaurant, Total_Amount AS order_amount,
                       Amount AS amount_paid, Mode AS payment_mode, Issue_Type AS complaint_reason, Refund_Amount,
                       Refund_Status, Completed_At AS refund_completed,
                       {_ratio("100 * 100 * Refund_Amount", "100 * Amount", 1)} AS refund_pct_of_payment
                FROM g1_refund f JOIN g1_complaint c USING (Complaint_ID) JOIN g1_orders o ON f.OrderID = o.OrderID
                JOIN g1_payment ON Order_ID = f.OrderID JOIN g1_users USING (UserID)
                JOIN g1_restaurant r USING (Restaurant_ID)""",
        ),
    }


def _audit() -> dict[str, str]:
    discount = "coalesce(Discount_Amount, 0)"
    return {
        "r01_same_city_customers": _out(
            "UserID:l User_Name:s Email:s restaurant_name:s restaurant_city:s",
            """SELECT DISTINCT UserID, User_Name, Email, r.Name AS restaurant_name, k.City AS restaurant_city
               FROM g1_orders JOIN g1_users USING (UserID) JOIN g1_user_has_address h USING (UserID)
               JOIN g1_user_address a ON a.Add_ID = h.Add_ID JOIN g1_restaurant r USING (Restaurant_ID)
               JOIN g1_restaurant_address k USING (Restaurant_ID)
               WHERE a.City = k.City AND k.City = 'NATION_19'""",
        ),
        "r02_payment_mismatches": _out(
            "OrderID:l order_total:d discount_applied:d expected_payment:d amount_paid:d payment_mode:s"
            " payment_status:s discrepancy:d",
            f"""SELECT OrderID, Total_Amount AS order_total, {discount} AS discount_applied,
                       Total_Amount - {discount} AS expected_payment, Amount AS amount_paid, Mode AS payment_mode,
                       p.Status AS payment_status, abs(Total_Amount - {discount} - Amount) AS discrepancy
                FROM g1_payment p JOIN g1_orders ON OrderID = Order_ID LEFT JOIN g1_discount USING (OrderID)
                WHERE abs(Total_Amount - {discount} - Amount) > 0.01""",
        ),
        "r03_slow_deliveries": _out(
            "Partner_ID:l partner_name:s Phone_No:l Delivery_ID:l OrderID:l Pickup_Time:t Delivery_Time:t"
            " transit_minutes:l",
            f"""SELECT DISTINCT Partner_ID, Name AS partner_name, Phone_No, Delivery_ID, OrderID, Pickup_Time,
                       Delivery_Time, {MINUTES} AS transit_minutes
                FROM g1_delivery JOIN g1_delivery_partner USING (Partner_ID)
                WHERE Status = 'Delivered' AND {MINUTES} > 45""",
        ),
        "r04_rated_with_open_complaints": _out(
            "Restaurant_ID:l restaurant_name:s cached_rating:d open_complaints:l",
            """SELECT Restaurant_ID, Name AS restaurant_name, Rating AS cached_rating,
                      count(DISTINCT Complaint_ID) AS open_complaints
               FROM g1_complaint c JOIN g1_orders USING (OrderID) JOIN g1_restaurant USING (Restaurant_ID)
               WHERE c.Status IN ('Open', 'Under Review') AND Rating > 4 GROUP BY 1, 2, 3""",
        ),
        "r05_valuable_abandoned_carts": _out(
            "UserID:l User_Name:s Email:s Cart_ID:l cart_created:t cart_value:d",
            f"""SELECT * FROM (
                    SELECT UserID, User_Name, Email, Cart_ID, c.Created_At AS cart_created,
                           sum(Quantity * Price) AS cart_value
                    FROM {LINES} JOIN g1_cart c USING (Cart_ID) JOIN g1_users USING (UserID)
                    WHERE c.Status = 'Abandoned' GROUP BY ALL)
                WHERE cart_value > 100000""",
        ),
        "r06_mode_share_in_period": _out(
            "payment_mode:s transaction_count:l total_collected:d pct_share:d",
            f"""SELECT * FROM (
                    SELECT Mode AS payment_mode, count(*) AS transaction_count, sum(Amount) AS total_collected,
                           {_ratio("100 * count(*)", "sum(count(*)) OVER ()", 2)} AS pct_share
                    FROM g1_payment p JOIN g1_orders ON OrderID = Order_ID
                    WHERE p.Status = 'Paid' AND date_trunc('month', Date_Time) = DATE '1997-03-01' GROUP BY Mode)
                WHERE payment_mode IN ('UPI', 'Wallet')""",
        ),
        "r07_demand_at_inactive_restaurants": _out(
            "Restaurant_ID:l restaurant_name:s Item_ID:l Item_Name:s total_qty_sold:l total_revenue:d",
            """SELECT Restaurant_ID, Name AS restaurant_name, Item_ID, Item_Name, sum(Quantity) AS total_qty_sold,
                      sum(Quantity * Unit_Price) AS total_revenue
               FROM g1_order_item JOIN g1_menu_item USING (Item_ID) JOIN g1_restaurant USING (Restaurant_ID)
               WHERE NOT Restaurant_Status GROUP BY ALL""",
        ),
        "r08_stale_refunds": _out(
            "Refund_ID:l OrderID:l customer:s Issue_Type:s Refund_Amount:d complaint_raised:t hours_pending:l",
            """SELECT Refund_ID, f.OrderID, User_Name AS customer, Issue_Type, Refund_Amount,
                      c.Created_At AS complaint_raised,
                      date_sub('hour', c.Created_At, TIMESTAMP '2024-01-31 12:00:00') AS hours_pending
               FROM g1_refund f JOIN g1_complaint c USING (Complaint_ID) JOIN g1_orders o ON o.OrderID = f.OrderID
               JOIN g1_users USING (UserID)
               WHERE Refund_Status = 'Pending'
                 AND date_sub('hour', c.Created_At, TIMESTAMP '2024-01-31 12:00:00') >= 25""",
        ),
        "r09_vip_candidates": _out(
            "UserID:l User_Name:s Email:s total_orders:l lifetime_spend:d",
            """SELECT UserID, User_Name, Email, count(OrderID) AS total_orders, sum(Total_Amount) AS lifetime_spend
               FROM g1_orders JOIN g1_users USING (UserID) WHERE Status <> 'cancelled' GROUP BY ALL
               HAVING count(OrderID) > 1 ORDER BY lifetime_spend DESC, UserID LIMIT 3""",
        ),
        "r10_late_night_restaurants": _out(
            "Restaurant_ID:l restaurant_name:s Open_Time:s Close_Time:s delivered_orders:l",
            """SELECT Restaurant_ID, Name AS restaurant_name, Open_Time, Close_Time,
                      count(DISTINCT OrderID) AS delivered_orders
               FROM g1_orders JOIN g1_restaurant USING (Restaurant_ID)
               WHERE Status = 'delivered' AND CAST(Close_Time AS TIME) > TIME '23:00:00' GROUP BY ALL""",
        ),
    }


def _dashboard() -> dict[str, str]:
    return {
        "b01_category_price_stats": _out(
            "Category_Name:s Item_Count:l Avg_Price:d Min_Price:l Max_Price:l",
            f"""SELECT Category_Name, count(Item_ID) AS Item_Count, {_average("Price", 2)} AS Avg_Price,
                       min(Price) AS Min_Price, max(Price) AS Max_Price
                FROM g2_menu_category JOIN g2_menu_item USING (Restaurant_ID, Category_Name)
                WHERE Is_Available AND Restaurant_ID = 1 GROUP BY Category_Name""",
        ),
        "b02_payment_methods": _out(
            "Payment_Method:s Times_Used:l Total_Revenue:l",
            """SELECT Mode AS Payment_Method, count(Order_ID) AS Times_Used, sum(Amount) AS Total_Revenue
               FROM g2_payment WHERE Status = 'Success' GROUP BY Mode""",
        ),
        "b03_low_wallet_orders": _out(
            "OrderID:l User_Name:s Wallet_Balance:l Order_Time:t Total_Amount:l",
            """SELECT OrderID, User_Name, Balance AS Wallet_Balance, Date_Time AS Order_Time, Total_Amount
               FROM g2_wallet JOIN g2_user USING (UserID) JOIN g2_orders USING (UserID) WHERE Balance < 500""",
        ),
        "b04_revenue_per_restaurant": _out(
            "Restaurant:s Gross_Revenue:l Total_Orders:l Avg_Order_Value:d",
            f"""SELECT Resto_Name AS Restaurant, sum(l.Price * Quantity) AS Gross_Revenue,
                       count(DISTINCT OrderID) AS Total_Orders, {_average("l.Price * Quantity", 2)} AS Avg_Order_Value
                FROM g2_order_item l JOIN g2_orders USING (OrderID) JOIN g2_menu_item USING (Item_ID)
                JOIN g2_restaurant USING (Restaurant_ID) WHERE Order_Status <> 'Cancelled'
                GROUP BY Restaurant_ID, Resto_Name""",
        ),
        "b05_top_rated": _out(
            "Resto_Name:s Rating:d Total_Reviews:l Est_Delivery_Mins:l",
            """SELECT Resto_Name, Rating, Total_Reviews, Avg_Delivery_Time AS Est_Delivery_Mins FROM g2_restaurant
               WHERE Restaurant_Status ORDER BY Rating DESC, Restaurant_ID LIMIT 5""",
        ),
        "b06_delivery_time_per_partner": _out(
            "Partner_Name:s City:s Avg_Delivery_Mins:d Total_Deliveries:l Partner_Rating:d",
            f"""SELECT Name AS Partner_Name, City, {_average(MINUTES, 1)} AS Avg_Delivery_Mins,
                       count(Delivery_ID) AS Total_Deliveries, Rating AS Partner_Rating
                FROM g2_delivery_partner JOIN g2_delivery USING (Partner_ID) WHERE Delivery_Time IS NOT NULL
                GROUP BY Partner_ID, Name, City, Rating""",
        ),
        "b07_pending_complaints": _out(
            "Complaint_ID:l Issue_Type:s Description:s User_Name:s Phone_No:s Order_Time:t Complaint_Time:t",
            """SELECT Complaint_ID, Issue_Type, Description, User_Name, Phone_No, Date_Time AS Order_Time,
                      c.Created_At AS Complaint_Time
               FROM g2_complaint c JOIN g2_user u ON u.UserID = c.UserID JOIN g2_orders o ON o.OrderID = c.OrderID
               WHERE Status = 'Pending'""",
        ),
        "b08_top_spenders": _out(
            "User_Name:s Total_Orders:l Total_Spent:l Current_Wallet_Balance:l",
            """SELECT User_Name, count(OrderID) AS Total_Orders, sum(Total_Amount) AS Total_Spent,
                      any_value(Balance) AS Current_Wallet_Balance
               FROM g2_orders JOIN g2_wallet USING (UserID) JOIN g2_user USING (UserID)
               WHERE Order_Status <> 'Cancelled' GROUP BY UserID, User_Name""",
        ),
        "b09_refund_summary": _out(
            "Refund_Status:s Refund_Count:l Total_Amount:l",
            """SELECT Refund_Status, count(*) AS Refund_Count, sum(Refund_Amount) AS Total_Amount
               FROM g2_refund GROUP BY ALL""",
        ),
        "b10_most_ordered_items": _out(
            "Item_Name:s Is_Veg:b Price:l Total_Ordered:l Item_Rating:d",
            """SELECT Item_Name, Is_Veg, i.Price, sum(Quantity) AS Total_Ordered, any_value(Rating) AS Item_Rating
               FROM g2_menu_item i JOIN g2_order_item USING (Item_ID) GROUP BY Item_ID, Item_Name, Is_Veg, i.Price
               ORDER BY Total_Ordered DESC, Item_ID LIMIT 5""",
        ),
        "b11_monthly_revenue": _out(
            "Month:s Total_Orders:l Total_Revenue:l",
            """SELECT strftime(Date_Time, '%Y-%m') AS Month, count(*) AS Total_Orders,
                      sum(Total_Amount) AS Total_Revenue
               FROM g2_orders WHERE Order_Status <> 'Cancelled' GROUP BY 1""",
        ),
        "b12_veg_split": _out(
            "Food_Type:s Items_Ordered:l Total_Quantity:l",
            """SELECT if(coalesce(Is_Veg, false), 'Veg', 'Non-Veg') AS Food_Type, count(*) AS Items_Ordered,
                      sum(Quantity) AS Total_Quantity
               FROM g2_menu_item JOIN g2_order_item USING (Item_ID) GROUP BY Is_Veg""",
        ),
        "b13_orders_by_city": _out(
            "City:s Total_Orders:l Revenue:l",
            """SELECT City, count(*) AS Total_Orders, sum(Total_Amount) AS Revenue
               FROM g2_address JOIN g2_orders USING (Add_ID) WHERE Order_Status <> 'Cancelled' GROUP BY City""",
        ),
        "b14_coupon_usage": _out(
            "Coupon_Code:s Description:s Used_Count:l Max_Uses:l Usage_Pct:d",
            f"""SELECT Coupon_Code, Description, Used_Count, Max_Uses,
                       {_ratio("100 * Used_Count", "Max_Uses", 1)} AS Usage_Pct
                FROM g2_coupon""",
        ),
        "b15_unread_notifications": _out(
            "User_Name:s Unread_Count:l",
            """SELECT User_Name, count(*) AS Unread_Count FROM g2_user JOIN g2_notification USING (UserID)
               WHERE Is_Read = false GROUP BY UserID, User_Name""",
        ),
        "b16_order_timeline": _out(
            "OrderID:l User_Name:s Status:s Changed_At:t Note:s",
            """SELECT OrderID, User_Name, Status, Changed_At, Note
               FROM g2_orders JOIN g2_user USING (UserID) JOIN g2_order_status_log USING (OrderID)
               WHERE OrderID = 1""",
        ),
        "b17_available_partners": _out(
            "Partner_ID:l Name:s Phone_No:s Vehicle_No:s Rating:d Total_Deliveries:l",
            """SELECT Partner_ID, Name, Phone_No, Vehicle_No, Rating, Total_Deliveries FROM g2_delivery_partner
               WHERE City = 'NATION_19' AND Is_Available""",
        ),
        "b18_cancellations_with_refunds": _out(
            "OrderID:l User_Name:s Cancel_Reason:s Cancel_At:t Refund_Amount:l Refund_Status:s",
            """SELECT o.OrderID, User_Name, Reason AS Cancel_Reason, Cancel_At, Refund_Amount, Refund_Status
               FROM g2_orders o JOIN g2_cancellation c ON c.Order_ID = o.OrderID JOIN g2_user USING (UserID)
               LEFT JOIN g2_refund f ON f.OrderID = o.OrderID""",
        ),
    }


LEADERBOARD = (
    "Restaurant_ID:l restaurant_name:s avg_rating:d is_active:b total_reviews:l total_orders:l total_revenue:d"
    " cancelled_orders:l"
)


def _views() -> dict[str, str]:
    return {
        "v01_order_summary": _out(
            "OrderID:l Date_Time:t order_status:s Total_Amount:d UserID:l customer_name:s customer_email:s"
            " Restaurant_ID:l restaurant_name:s payment_id:l payment_mode:s payment_status:s amount_paid:d Paid_At:t"
            " Delivery_ID:l delivery_status:s Pickup_Time:t Delivery_Time:t partner_name:s partner_phone:l"
            " discount_pct:d discount_amount:d",
            """SELECT o.OrderID, Date_Time, o.Status AS order_status, Total_Amount, UserID,
                      User_Name AS customer_name, Email AS customer_email, Restaurant_ID, r.Name AS restaurant_name,
                      Transaction_ID AS payment_id, Mode AS payment_mode, p.Status AS payment_status,
                      Amount AS amount_paid, Paid_At, Delivery_ID, d.Status AS delivery_status, Pickup_Time,
                      Delivery_Time, w.Name AS partner_name, w.Phone_No AS partner_phone,
                      coalesce(Discount_PR, 0) AS discount_pct, coalesce(Discount_Amount, 0) AS discount_amount
               FROM g1_orders o JOIN g1_restaurant r USING (Restaurant_ID) JOIN g1_users USING (UserID)
               LEFT JOIN g1_discount x ON x.OrderID = o.OrderID LEFT JOIN g1_payment p ON p.Order_ID = o.OrderID
               LEFT JOIN g1_delivery d ON d.OrderID = o.OrderID
               LEFT JOIN g1_delivery_partner w ON w.Partner_ID = d.Partner_ID""",
        ),
        "v01_order_summary_kept": _out(
            "OrderID:l Date_Time:t order_status:s Total_Amount:d UserID:l customer_name:s customer_email:s"
            " Restaurant_ID:l restaurant_name:s payment_id:l payment_mode:s payment_status:s amount_paid:d Paid_At:t"
            " Delivery_ID:l delivery_status:s Pickup_Time:t Delivery_Time:t partner_name:s partner_phone:l"
            " discount_pct:d discount_amount:d",
            f"""SELECT o.OrderID, Date_Time, o.Status AS order_status, Total_Amount, UserID,
                      User_Name AS customer_name, Email AS customer_email, Restaurant_ID, r.Name AS restaurant_name,
                      Transaction_ID AS payment_id, Mode AS payment_mode, p.Status AS payment_status,
                      Amount AS amount_paid, Paid_At, Delivery_ID, d.Status AS delivery_status, Pickup_Time,
                      Delivery_Time, w.Name AS partner_name, w.Phone_No AS partner_phone,
                      coalesce(Discount_PR, 0) AS discount_pct, coalesce(Discount_Amount, 0) AS discount_amount
               FROM {LATER_ORDERS} o JOIN g1_restaurant r USING (Restaurant_ID) JOIN g1_users USING (UserID)
               LEFT JOIN g1_discount x ON x.OrderID = o.OrderID LEFT JOIN {LATER_PAYMENTS} p ON p.Order_ID = o.OrderID
               LEFT JOIN g1_delivery d ON d.OrderID = o.OrderID
               LEFT JOIN g1_delivery_partner w ON w.Partner_ID = d.Partner_ID""",
        ),
        "v02_restaurant_leaderboard_kept": _out(
            LEADERBOARD,
            f"""SELECT Restaurant_ID, Name AS restaurant_name, r.Rating AS avg_rating, Restaurant_Status AS is_active,
                      count(DISTINCT Review_ID) AS total_reviews, count(DISTINCT o.OrderID) AS total_orders,
                      coalesce(sum(Amount) FILTER (p.Status = 'Paid'), 0) AS total_revenue,
                      count(DISTINCT o.OrderID) FILTER (o.Status = 'cancelled') AS cancelled_orders
               FROM g1_restaurant r LEFT JOIN {LATER_ORDERS} o USING (Restaurant_ID)
               LEFT JOIN {LATER_PAYMENTS} p ON p.Order_ID = o.OrderID LEFT JOIN {LATER_REVIEWS} v USING (Restaurant_ID)
               GROUP BY 1, 2, 3, 4""",
        ),
        "v02_restaurant_leaderboard": _out(
            LEADERBOARD,
            """SELECT Restaurant_ID, Name AS restaurant_name, r.Rating AS avg_rating, Restaurant_Status AS is_active,
                      count(DISTINCT Review_ID) AS total_reviews, count(DISTINCT o.OrderID) AS total_orders,
                      coalesce(sum(Amount) FILTER (p.Status = 'Paid'), 0) AS total_revenue,
                      count(DISTINCT o.OrderID) FILTER (o.Status = 'cancelled') AS cancelled_orders
               FROM g1_restaurant r LEFT JOIN g1_orders o USING (Restaurant_ID)
               LEFT JOIN g1_payment p ON p.Order_ID = o.OrderID LEFT JOIN g1_review USING (Restaurant_ID)
               GROUP BY 1, 2, 3, 4""",
        ),
        "v02_restaurant_leaderboard_corrected": _out(
            LEADERBOARD,
            """SELECT r.Restaurant_ID, Name AS restaurant_name, Rating AS avg_rating, Restaurant_Status AS is_active,
                      (SELECT count(*) FROM g1_review v WHERE v.Restaurant_ID = r.Restaurant_ID) AS total_reviews,
                      (SELECT count(*) FROM g1_orders o WHERE o.Restaurant_ID = r.Restaurant_ID) AS total_orders,
                      (SELECT coalesce(sum(Amount), 0) FROM g1_payment p JOIN g1_orders o ON OrderID = Order_ID
                       WHERE o.Restaurant_ID = r.Restaurant_ID AND p.Status = 'Paid') AS total_revenue,
                      (SELECT count(*) FROM g1_orders o
                       WHERE o.Restaurant_ID = r.Restaurant_ID AND Status = 'cancelled') AS cancelled_orders
               FROM g1_restaurant r""",
        ),
        "v03_menu_with_category": _out(
            "Item_ID:l Item_Name:s Description:s Price:d Preparation_Time:l Is_Available:b Category_Name:s"
            " category_type:s Restaurant_ID:l",
            """SELECT Item_ID, Item_Name, Description, Price, Preparation_Time, Is_Available, Category_Name,
                      Type AS category_type, Restaurant_ID
               FROM g1_menu_category JOIN g1_menu_item USING (Category_Name, Restaurant_ID)""",
        ),
        "s03_orders_by_view": _out(
            "order_status:s payment_status:s delivery_status:s orders:l paid:d discounts:d restaurants:l",
            """SELECT o.Status AS order_status, p.Status AS payment_status, d.Status AS delivery_status,
                      count(*) AS orders, sum(Amount) AS paid, sum(coalesce(Discount_Amount, 0)) AS discounts,
                      count(DISTINCT o.Restaurant_ID) AS restaurants
               FROM g1_orders o JOIN g1_restaurant r USING (Restaurant_ID) JOIN g1_users USING (UserID)
               LEFT JOIN g1_discount x ON x.OrderID = o.OrderID LEFT JOIN g1_payment p ON p.Order_ID = o.OrderID
               LEFT JOIN g1_delivery d ON d.OrderID = o.OrderID
               GROUP BY ALL""",
        ),
        "c01_orders_page": _out(
            "OrderID:l User_Name:s Date_Time:t Status:s Total_Amount:d",
            """SELECT OrderID, User_Name, Date_Time, Status, Total_Amount
               FROM g1_orders JOIN g1_users USING (UserID) ORDER BY OrderID LIMIT 25 OFFSET 75""",
        ),
        "c02_orders_after": _out(
            "OrderID:l User_Name:s Date_Time:t Status:s Total_Amount:d",
            """SELECT OrderID, User_Name, Date_Time, Status, Total_Amount
               FROM g1_orders JOIN g1_users USING (UserID) WHERE OrderID > 74 ORDER BY OrderID LIMIT 25""",
        ),
    }


AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"

# Reviews after the change feed: clicks move on and change their mind, cheap views are withdrawn.
REVIEWS_AFTER = f"""(
    SELECT CASE WHEN event_type = 'click' AND user_id % 4 = 0 THEN (event_id + 1) % {N} ELSE event_id % {N} END
               AS Restaurant_ID,
           CASE WHEN event_type = 'click' THEN 1 + user_id % 3 ELSE Rating END AS Rating
    FROM events JOIN g1_review ON Review_ID = event_id WHERE event_type = 'click' OR value >= 5)"""

LATER_REVIEWS = f"""(
    SELECT Review_ID, CASE WHEN event_type = 'click' AND user_id % 4 = 0 THEN (event_id + 1) % {N} ELSE event_id % {N} END
               AS Restaurant_ID
    FROM events JOIN g1_review ON Review_ID = event_id WHERE event_type = 'click' OR value >= 5)"""
LATER_PAYMENTS = """(SELECT * REPLACE (CASE WHEN Status = 'Pending' AND Order_ID % 5 = 0 THEN 'Paid' ELSE Status END AS Status)
    FROM g1_payment)"""
LATER_ORDERS = """(SELECT * REPLACE (CASE WHEN Status = 'preparing' AND OrderID % 10 = 1 THEN 'cancelled' ELSE Status END AS Status)
    FROM g1_orders)"""

CREDITED = """(
    SELECT Refund_ID, Wallet_ID, Refund_Amount FROM g1_refund JOIN g1_complaint USING (Complaint_ID)
    WHERE Refund_Status = 'Completed' AND Refund_ID % 10 <> 2 AND Created_At < TIMESTAMP '2024-01-30 00:00:00')"""

# One numbered row per wallet event, then one step of recursion per row.
_FOLD = """
    numbered AS (
        SELECT Wallet_ID, kind, id, amount, opening,
               row_number() OVER (PARTITION BY Wallet_ID ORDER BY moment, kind, id) AS n
        FROM wallet_events),
    folded AS (
        SELECT Wallet_ID, kind, id, amount, n, kind = 0 OR opening >= amount AS accepted,
               CASE WHEN kind = 0 THEN opening + amount WHEN opening >= amount THEN opening - amount ELSE opening END
                   AS balance
        FROM numbered WHERE n = 1
        UNION ALL
        SELECT s.Wallet_ID, s.kind, s.id, s.amount, s.n, s.kind = 0 OR f.balance >= s.amount,
               CASE WHEN s.kind = 0 THEN f.balance + s.amount WHEN f.balance >= s.amount THEN f.balance - s.amount
                    ELSE f.balance END
        FROM folded f JOIN numbered s ON s.Wallet_ID = f.Wallet_ID AND s.n = f.n + 1)"""

FOLD_PAYMENTS = (
    """wallet_events AS (
        SELECT Wallet_ID, Paid_At AS moment, 1 AS kind, Transaction_ID AS id, CAST(Amount AS DECIMAL(18, 2)) AS amount,
               CAST(Balance AS DECIMAL(18, 2)) AS opening
        FROM g1_payment p JOIN g1_orders ON OrderID = Order_ID JOIN g1_wallet USING (UserID)
        WHERE Mode = 'Wallet' AND p.Status = 'Paid'
        UNION ALL
        SELECT Wallet_ID, Cancelled_At, 0, Cancellation_ID, CAST(Total_Amount AS DECIMAL(18, 2)),
               CAST(Balance AS DECIMAL(18, 2))
        FROM g1_cancellation JOIN g1_orders USING (OrderID) JOIN g1_wallet USING (UserID)
        WHERE Refund_Eligible),"""
    + _FOLD
)
FOLD_STREAM = (
    """wallet_events AS (
        SELECT Wallet_ID, Date_Time AS moment, CASE WHEN Type = 'Credit' THEN 0 ELSE 1 END AS kind, Transaction_ID AS id,
               CAST(Amount AS DECIMAL(18, 2)) AS amount, CAST(0 AS DECIMAL(18, 2)) AS opening
        FROM g1_wallet_transaction),"""
    + _FOLD
)

FOLD_REFUNDS = (
    """wallet_events AS (
        SELECT user_id AS Wallet_ID, ts AS moment, 1 AS kind, event_id AS id, CAST(value AS DECIMAL(18, 2)) AS amount,
               CAST(0 AS DECIMAL(18, 2)) AS opening
        FROM events WHERE event_type = 'purchase'
        UNION ALL
        SELECT Wallet_ID, Completed_At, 0, Refund_ID, CAST(Refund_Amount AS DECIMAL(18, 2)), CAST(0 AS DECIMAL(18, 2))
        FROM g1_refund WHERE Refund_Status = 'Completed'),"""
    + _FOLD
)

# Checkout requests: every cart once, some of them by somebody else, the urgent ones twice.
DECIDED = f"""
    requests AS (
        SELECT 2 * o_orderkey AS Request_ID,
               CASE WHEN o_orderpriority = '5-LOW' THEN o_custkey + 1 ELSE o_custkey END AS UserID,
               o_orderkey AS Cart_ID
        FROM orders
        UNION ALL
        SELECT 2 * o_orderkey + 1, o_custkey, o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'),
    contents AS (
        SELECT Cart_ID, sum(Price * Quantity) AS Total_Amount, max(Restaurant_ID) AS Restaurant_ID,
               bool_and(Is_Available) AS complete
        FROM {LINES} GROUP BY Cart_ID),
    judged AS (
        SELECT Request_ID, q.UserID, Cart_ID, Total_Amount, Restaurant_ID,
               CASE WHEN c.Status <> 'Active' OR c.UserID <> q.UserID THEN 'no_active_cart'
                    WHEN NOT complete THEN 'unavailable_item' WHEN complete IS NULL THEN 'empty_cart' END AS problem
        FROM requests q JOIN g1_cart c USING (Cart_ID) LEFT JOIN contents USING (Cart_ID)),
    decided AS (
        SELECT Request_ID, UserID, Cart_ID, Total_Amount, Restaurant_ID,
               CASE WHEN problem IS NULL
                         AND row_number() OVER (PARTITION BY Cart_ID, problem IS NULL ORDER BY Request_ID) > 1
                    THEN 'no_active_cart' ELSE problem END AS reason
        FROM judged),
    placed AS (
        SELECT *, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY Request_ID) AS OrderID
        FROM decided WHERE reason IS NULL)"""


def _jobs() -> dict[str, str]:
    average = _average("CAST(Rating AS DECIMAL(10, 4))", 2)
    return {
        "w01_rating_rollup": _out(
            "Restaurant_ID:l Rating:d",
            f"""SELECT Restaurant_ID, CAST(CASE WHEN seen THEN coalesce(fresh, 0) ELSE Rating END AS FLOAT) AS Rating
                FROM g1_restaurant
                LEFT JOIN (SELECT Restaurant_ID, {average} AS fresh FROM {REVIEWS_AFTER} GROUP BY 1)
                    USING (Restaurant_ID)
                LEFT JOIN (SELECT DISTINCT Restaurant_ID, true AS seen FROM (
                               SELECT Restaurant_ID FROM g1_review UNION ALL SELECT Restaurant_ID FROM {REVIEWS_AFTER}))
                    USING (Restaurant_ID)""",
        ),
        "w01_rating_stream": _out(
            "Restaurant_ID:l new_rating:d",
            f"""SELECT Restaurant_ID, CAST({average} AS FLOAT) AS new_rating FROM g1_review GROUP BY 1""",
        ),
        "w01_rating_snapshot_stream": _out(
            "Restaurant_ID:l new_rating:d",
            f"""SELECT Restaurant_ID, CAST(coalesce(fresh, 0) AS FLOAT) AS new_rating
                FROM (SELECT Restaurant_ID FROM g1_review UNION SELECT Restaurant_ID FROM {REVIEWS_AFTER})
                LEFT JOIN (SELECT Restaurant_ID, {average} AS fresh FROM {REVIEWS_AFTER} GROUP BY 1)
                    USING (Restaurant_ID)""",
        ),
        "w02_refund_credit_ledger": _out(
            "Wallet_ID:l Transaction_ID:l Type:s Amount:d Date_Time:t",
            f"""SELECT Wallet_ID, (SELECT max(Transaction_ID) FROM g1_wallet_transaction)
                           + row_number() OVER (ORDER BY Refund_ID) AS Transaction_ID,
                       'Credit' AS Type, Refund_Amount AS Amount, {AS_OF} AS Date_Time
                FROM {CREDITED}""",
        ),
        "w02_refund_credit_wallets": _out(
            "Wallet_ID:l Balance:d",
            f"""SELECT Wallet_ID, Balance + coalesce(credited, 0) AS Balance
                FROM g1_wallet
                LEFT JOIN (SELECT Wallet_ID, sum(Refund_Amount) AS credited FROM {CREDITED} GROUP BY 1)
                    USING (Wallet_ID)""",
        ),
        "w02_refund_credit_stream": _out(
            "Refund_ID:l Wallet_ID:l Amount:d at:t",
            """SELECT Refund_ID, Wallet_ID, Refund_Amount AS Amount, Completed_At AS "at" FROM g1_refund
               WHERE Refund_Status = 'Completed'""",
        ),
        "w03_wallet_debits": _out(
            "Transaction_ID:l Wallet_ID:l Amount:d accepted:b reason:s balance_after:d",
            """SELECT id AS Transaction_ID, Wallet_ID, amount AS Amount, accepted,
                      CASE WHEN NOT accepted THEN 'insufficient_balance' END AS reason, balance AS balance_after
               FROM folded WHERE kind = 1""",
            FOLD_PAYMENTS,
        ),
        "w03_wallet_balances": _out(
            "Wallet_ID:l Balance:d",
            """SELECT w.Wallet_ID, coalesce(f.balance, w.Balance) AS Balance FROM g1_wallet w
               LEFT JOIN (SELECT Wallet_ID, arg_max(balance, n) AS balance FROM folded GROUP BY 1) f USING (Wallet_ID)
            """,
            FOLD_PAYMENTS,
        ),
        "w03_wallet_ledger": _out(
            "Wallet_ID:l Transaction_ID:l Type:s Amount:d Date_Time:t",
            f"""SELECT Wallet_ID, (SELECT max(Transaction_ID) FROM g1_wallet_transaction)
                           + row_number() OVER (ORDER BY id) AS Transaction_ID,
                       'Debit' AS Type, amount AS Amount, {AS_OF} AS Date_Time
                FROM folded WHERE kind = 1 AND accepted""",
            FOLD_PAYMENTS,
        ),
        "w03_wallet_debit_stream": _out(
            "Wallet_ID:l id:l accepted:b balance:d",
            "SELECT Wallet_ID, id, accepted, 100 * balance AS balance FROM folded",
            FOLD_STREAM,
        ),
        "w03_wallet_refund_stream": _out(
            "Wallet_ID:l Balance:d",
            "SELECT Wallet_ID, arg_max(balance, n) AS Balance FROM folded GROUP BY 1",
            FOLD_REFUNDS,
        ),
        "w04_checkout_orders": _out(
            "OrderID:l Date_Time:t UserID:l Restaurant_ID:l Status:s Total_Amount:d Updated_At:t",
            f"""SELECT OrderID, {AS_OF} AS Date_Time, UserID, Restaurant_ID, 'pending' AS Status, Total_Amount,
                       {AS_OF} AS Updated_At
                FROM placed""",
            DECIDED,
        ),
        "w04_checkout_lines": _out(
            "Item_ID:l OrderID:l Quantity:l Unit_Price:d",
            f"SELECT Item_ID, OrderID, Quantity, Price AS Unit_Price FROM {LINES} JOIN placed USING (Cart_ID)",
            DECIDED,
        ),
        "w04_checkout_published": _out(
            "OrderID:l UserID:l Restaurant_ID:l Total_Amount:d n_lines:l quantity:l",
            f"""SELECT OrderID, any_value(placed.UserID) AS UserID, any_value(placed.Restaurant_ID) AS Restaurant_ID,
                       any_value(placed.Total_Amount) AS Total_Amount, count(*) AS n_lines, sum(Quantity) AS quantity
                FROM {LINES} JOIN placed USING (Cart_ID) GROUP BY OrderID""",
            DECIDED,
        ),
        "w04_checkout_carts": _out(
            "Cart_ID:l Created_At:t Status:s UserID:l",
            """SELECT Cart_ID, Created_At, CASE WHEN Cart_ID IN (SELECT Cart_ID FROM placed) THEN 'Checked Out'
                      ELSE Status END AS Status, UserID
               FROM g1_cart""",
            DECIDED,
        ),
        "w04_checkout_rejected": _out(
            "Request_ID:l UserID:l Cart_ID:l reason:s",
            "SELECT Request_ID, UserID, Cart_ID, reason FROM decided WHERE reason IS NOT NULL",
            DECIDED,
        ),
    }


def oracle_sql() -> dict[str, str]:
    from oracle.quality import quality_sql

    return {**_analytics(), **_audit(), **_dashboard(), **_views(), **_jobs(), **quality_sql()}
