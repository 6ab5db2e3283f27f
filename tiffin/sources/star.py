"""Marketplace tables as projections of a star schema (customer, supplier, part, orders, lineitem, events).

Every definition is a whole-table projection: no row is left out except where the target table has no
counterpart for it (a review is a view or click event, a complaint an error or sign-up event, and so on).
Identifier remainders only spread categories over rows. Restaurant 7 gets no orders, partner 5 no deliveries and
items whose number ends in 3 are never sold, because those cases matter to outer and anti joins; their rows go to
the next restaurant, partner or item instead of being dropped.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.sources.catalog import Marketplace
from tiffin.sources.schema import GENERATIONS

# Declared, so that no file is opened to learn a schema. Money and quantities are doubles here.
STAR = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

MODES = {"1-URGENT": "UPI", "2-HIGH": "Card", "3-MEDIUM": "Cash", "4-NOT SPECIFIED": "Wallet", "5-LOW": "NetBanking"}
ISSUES = ["Late Delivery", "Wrong Item", "Cold Food", "Missing Item", "Quality Issue", "Packaging", "Spill", "Other"]
EPOCH = "1992-01-01 00:00:00"


def _pick(number: Column, labels: list) -> Column:
    """Label by remainder: the n-th label for rows whose number leaves remainder n."""
    slot = number % len(labels)
    out = F.lit(labels[-1])
    for n, label in enumerate(labels[:-1]):
        out = F.when(slot == n, F.lit(label)).otherwise(out)
    return out


def _map(value: Column, labels: dict, default=None) -> Column:
    out = F.lit(default)
    for key, label in labels.items():
        out = F.when(value == key, F.lit(label)).otherwise(out)
    return out


def _instead(number: Column, taken: int) -> Column:
    """Give the rows of one identifier to the next one."""
    return F.when(number == taken, F.lit(taken + 1)).otherwise(number)


def _item(partkey: Column) -> Column:
    return F.when(partkey % 10 == 3, partkey + 1).otherwise(partkey)


def _rupees(value: Column) -> Column:
    return F.floor(value).cast("bigint")


def _money(value: Column) -> Column:
    return value.cast("decimal(18,2)")


def _at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def _order_state(status_names: list[str]) -> Column:
    cancelled, delivered, preparing, on_the_way = status_names
    return (
        F.when(F.col("o_orderkey") % 6 == 0, cancelled)
        .when(F.col("o_orderstatus") == "F", delivered)
        .when(F.col("o_orderstatus") == "P", preparing)
        .otherwise(on_the_way)
    )


class StarSource:
    """Reads one star-schema folder (``<root>/<table>.parquet``) and offers both marketplace generations."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(STAR[name]).parquet(f"{self.root}/{name}.parquet")

    @cached_property
    def restaurants(self) -> int:
        """Number of suppliers; answered from Parquet footers."""
        return self.raw("supplier").count()

    @cached_property
    def orders(self) -> int:
        """Number of orders, whose keys count from 0; answered from Parquet footers. 1 if there are none."""
        return max(1, self.raw("orders").count())

    @cached_property
    def items(self) -> int:
        """Number of parts, whose keys count from 0; answered from Parquet footers. 1 if there are none."""
        return max(1, self.raw("part").count())

    def marketplace(self, generation: str) -> Marketplace:
        prefix = f"_{generation}_"
        makers = {n: self._typed(generation, n, prefix) for n in GENERATIONS[generation] if hasattr(self, prefix + n)}
        return Marketplace(self.spark, generation, makers)

    def _typed(self, generation: str, name: str, prefix: str):
        table = GENERATIONS[generation][name]

        def make() -> DataFrame:
            df = getattr(self, prefix + name)()
            return df.select(*[F.col(c.name).cast(c.dtype).alias(c.name) for c in table.columns])

        return make

    # Shared shapes -----------------------------------------------------------------------------------------

    def _customer(self) -> DataFrame:
        nation = self.raw("nation").select("n_nationkey", F.col("n_name").alias("City"))
        return self.raw("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))

    def _supplier(self) -> DataFrame:
        nation = self.raw("nation").select("n_nationkey", F.col("n_name").alias("City"))
        return self.raw("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))

    def _orders(self) -> DataFrame:
        return self.raw("orders").withColumn(
            "Restaurant_ID", _instead(F.col("o_orderkey") % self.restaurants, 7)
        )

    def _lines(self) -> DataFrame:
        """One row per (order, sold item)."""
        return (
            self.raw("lineitem")
            .groupBy(F.col("l_orderkey").alias("OrderID"), _item(F.col("l_partkey")).alias("Item_ID"))
            .agg(
                F.floor(F.sum("l_quantity")).alias("Quantity"),
                _money(F.max("l_extendedprice")).alias("Unit_Price"),
            )
        )

    def _events(self, *kinds: str) -> DataFrame:
        events = self.raw("events")
        return events.where(F.col("event_type").isin(*kinds)) if kinds else events

    def _cuisine(self) -> DataFrame:
        parts = self.raw("part").select("p_partkey", "p_type")
        return (
            self.raw("lineitem")
            .select("l_partkey", "l_suppkey")
            .distinct()
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("p_type").alias("Cuisine"), F.col("l_suppkey").alias("Restaurant_ID"))
            .distinct()
        )

    def _categories(self) -> DataFrame:
        return (
            self.raw("part")
            .select(
                F.col("p_type").alias("Category_Name"),
                (F.col("p_partkey") % self.restaurants).alias("Restaurant_ID"),
            )
            .distinct()
        )

    def _delivery_times(self) -> DataFrame:
        ts, kind = F.col("ts"), F.col("event_type")
        return self._events().select(
            F.col("event_id").alias("Delivery_ID"),
            F.when(kind != "view", ts).alias("Pickup_Time"),
            F.when(kind != "signup", F.timestamp_add("SECOND", F.floor(F.col("value") * 20), ts)).alias(
                "Delivery_Time"
            ),
            kind,
            F.col("event_id").alias("OrderID"),
            _instead(F.col("event_id") % self.restaurants, 5).alias("Partner_ID"),
        )

    def _complaints(self) -> DataFrame:
        return self._events("error", "signup").withColumn("OrderID", F.col("event_id") * 7 % self.orders)

    def refunds(self, events: DataFrame | None = None) -> DataFrame:
        """Refunds of error events; also used on the event stream."""
        events = self.raw("events") if events is None else events
        owner = self.raw("orders").select(F.col("o_orderkey").alias("OrderID"), F.col("o_custkey").alias("Wallet_ID"))
        return (
            events.where(F.col("event_type") == "error")
            .withColumn("OrderID", F.col("event_id") * 7 % self.orders)
            .join(owner, "OrderID")
            .select(
                F.col("event_id").alias("Refund_ID"),
                "OrderID",
                F.col("event_id").alias("Complaint_ID"),
                (F.col("event_id") % 500).alias("Refund_Amount"),
                _pick(F.col("event_id"), ["Pending", "Pending", "Completed", "Completed", "Rejected"]).alias(
                    "Refund_Status"
                ),
                F.col("ts").alias("Initiated_At"),
                F.when(F.col("event_id") % 5 == 2, F.timestamp_add("HOUR", F.lit(2), F.col("ts")))
                .when(F.col("event_id") % 5 == 3, F.timestamp_add("HOUR", F.lit(2), F.col("ts")))
                .alias("Completed_At"),
                "Wallet_ID",
            )
        )

    # Generation 1 ------------------------------------------------------------------------------------------

    def _gen1_users(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("UserID"),
            F.col("c_name").alias("User_Name"),
            (F.lit(6000000000) + F.col("c_custkey")).alias("Phone_No"),
            F.concat("c_name", F.lit("@example.com")).alias("Email"),
            F.lit("-").alias("Password"),
            F.lit("customer").alias("Role"),
            _at(EPOCH).alias("Created_At"),
            _at(EPOCH).alias("Updated_At"),
        )

    def _gen1_user_address(self) -> DataFrame:
        return self._customer().select(
            F.col("c_custkey").alias("Add_ID"),
            F.col("c_name").alias("Add_line_1"),
            F.lit(None).alias("Add_line_2"),
            F.col("c_mktsegment").alias("Area"),
            "City",
            (100000 + F.col("c_custkey") % 900000).alias("Pincode"),
        )

    def _gen1_user_has_address(self) -> DataFrame:
        return self.raw("customer").select(F.col("c_custkey").alias("Add_ID"), F.col("c_custkey").alias("UserID"))

    def _gen1_restaurant(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.raw("supplier").select(
            key.alias("Restaurant_ID"),
            F.col("s_name").alias("Name"),
            F.lit("10:00:00").alias("Open_Time"),
            _pick(key, ["23:30:00", "22:00:00", "23:00:00"]).alias("Close_Time"),
            (key % 5 != 0).alias("Restaurant_Status"),
            (F.lit(10000000000000) + key).alias("FSSAI_License_No"),
            (F.lit(7000000000) + key).alias("Contact_No"),
            (3 + (key % 9) * 0.25).alias("Rating"),
            key.alias("Owner_UserID"),
            _at(EPOCH).alias("Created_At"),
            _at(EPOCH).alias("Updated_At"),
        )

    def _gen1_restaurant_address(self) -> DataFrame:
        return self._supplier().select(
            F.col("s_suppkey").alias("Add_ID"),
            F.col("s_name").alias("Add_line_1"),
            F.lit(None).alias("Add_line_2"),
            F.col("City").alias("Area"),
            "City",
            (100000 + F.col("s_suppkey") % 900000).alias("Pincode"),
            F.col("s_suppkey").alias("Restaurant_ID"),
        )

    def _gen1_cuisine(self) -> DataFrame:
        return self._cuisine()

    def _gen1_menu_category(self) -> DataFrame:
        kinds = {"PROMO": "Vegan", "LARGE": "Non-Veg", "MEDIUM": "Non-Veg"}
        return self._categories().withColumn("Type", _map(F.col("Category_Name"), kinds, "Veg"))

    def _gen1_menu_item(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("Item_ID"),
            F.col("p_name").alias("Item_Name"),
            F.col("p_brand").alias("Description"),
            _money(F.col("p_retailprice")).alias("Price"),
            F.col("p_size").alias("Preparation_Time"),
            (F.col("p_size") > 5).alias("Is_Available"),
            F.col("p_type").alias("Category_Name"),
            (F.col("p_partkey") % self.restaurants).alias("Restaurant_ID"),
            _at(EPOCH).alias("Created_At"),
            _at(EPOCH).alias("Updated_At"),
        )

    def review_fields(self, events: DataFrame) -> DataFrame:
        """Review rows from view and click events; also used on the event stream."""
        restaurant = F.col("event_id") % self.restaurants
        return events.where(F.col("event_type").isin("view", "click")).select(
            F.col("event_id").alias("Review_ID"),
            F.col("props").alias("Review"),
            F.when(restaurant % 3 == 0, 4 + F.col("user_id") % 2)
            .otherwise(1 + F.col("user_id") % 5)
            .cast("float")
            .alias("Rating"),
            restaurant.alias("Restaurant_ID"),
            F.col("user_id").alias("UserID"),
            F.col("ts").alias("Created_At"),
        )

    def _gen1_review(self) -> DataFrame:
        return self.review_fields(self._events())

    def _gen1_cart(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("Cart_ID"),
            F.col("o_orderdate").alias("Created_At"),
            _pick(F.col("o_orderkey"), ["Abandoned", "Active", "Checked Out"]).alias("Status"),
            F.col("o_custkey").alias("UserID"),
        )

    def _gen1_cart_item(self) -> DataFrame:
        return (
            self.raw("lineitem")
            .groupBy(F.col("l_partkey").alias("Item_ID"), F.col("l_orderkey").alias("Cart_ID"))
            .agg(F.floor(F.sum("l_quantity")).alias("Quantity"))
        )

    def _gen1_orders(self) -> DataFrame:
        return self._orders().select(
            F.col("o_orderkey").alias("OrderID"),
            F.col("o_orderdate").alias("Date_Time"),
            F.col("o_custkey").alias("UserID"),
            "Restaurant_ID",
            _order_state(["cancelled", "delivered", "preparing", "out_for_delivery"]).alias("Status"),
            F.col("o_totalprice").alias("Total_Amount"),
            F.col("o_orderdate").alias("Updated_At"),
        )

    def _gen1_order_item(self) -> DataFrame:
        return self._lines()

    def _gen1_payment(self) -> DataFrame:
        key = F.col("o_orderkey")
        billed = (
            F.col("o_totalprice").cast("decimal(18,2)")
            - F.when(_weekend(F.col("o_orderdate")), 50).otherwise(0)
            + F.when(key % 13 == 0, 5).otherwise(0)
        )
        decided = _pick(key, ["Failed", "Pending", "Refunded", "Paid", "Paid", "Paid", "Paid"])
        # An order still in preparation has not been billed yet.
        status = F.when(F.col("o_orderstatus") == "P", "Pending").otherwise(decided)
        return self.raw("orders").select(
            (key + 1).alias("Transaction_ID"),
            _map(F.col("o_orderpriority"), MODES).alias("Mode"),
            status.alias("Status"),
            billed.alias("Amount"),
            F.lit(None).alias("Gateway_Ref"),
            F.when(status == "Paid", F.col("o_orderdate")).alias("Paid_At"),
            key.alias("Order_ID"),
        )

    def _gen1_delivery_partner(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.raw("supplier").select(
            key.alias("Partner_ID"),
            F.col("s_name").alias("Name"),
            (F.lit(8000000000) + key).alias("Phone_No"),
            F.concat(F.lit("V"), key.cast("string")).alias("Vehicle_No"),
            (3 + (key % 9) * 0.25).alias("Rating"),
            (key % 5 != 0).alias("Is_Active"),
            _at(EPOCH).alias("Created_At"),
        )

    def _gen1_delivery(self) -> DataFrame:
        names = {"error": "Failed", "signup": "In Transit"}
        return self._delivery_times().withColumn("Status", _map(F.col("event_type"), names, "Delivered"))

    def _gen1_wallet(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("Wallet_ID"),
            (_money(F.col("c_acctbal")) * 100).alias("Balance"),
            _at(EPOCH).alias("Created_At"),
            F.col("c_custkey").alias("UserID"),
        )

    def _gen1_wallet_transaction(self) -> DataFrame:
        return self._events("purchase", "click").select(
            F.col("user_id").alias("Wallet_ID"),
            F.col("event_id").alias("Transaction_ID"),
            _map(F.col("event_type"), {"purchase": "Debit", "click": "Credit"}).alias("Type"),
            F.col("value").alias("Amount"),
            F.col("ts").alias("Date_Time"),
        )

    def _gen1_wallet_topup(self) -> DataFrame:
        return (
            self._events("click")
            .select(
                F.col("event_id").alias("Transaction_ID"),
                _pick(F.col("event_id"), ["Success", "Failed", "Pending"]).alias("Status"),
                _pick(F.col("event_id"), ["UPI", "Card", "NetBanking"]).alias("Payment_mode"),
                (F.lit(900000000) + F.col("event_id")).alias("Transaction_Ref"),
                F.col("ts").alias("Date_Time"),
                F.col("user_id").alias("Wallet_ID"),
            )
        )

    def _gen1_discount(self) -> DataFrame:
        return (
            self.raw("orders")
            .where(_weekend(F.col("o_orderdate")))
            .select(
                F.col("o_orderkey").alias("Discount_ID"),
                F.lit(10).alias("Discount_PR"),
                F.lit(50).alias("Discount_Amount"),
                F.col("o_orderkey").alias("OrderID"),
            )
        )

    def _gen1_complaint(self) -> DataFrame:
        state = _pick(F.call_function("div", F.col("event_id"), F.lit(8)), ["Open", "Under Review", "Resolved", "Closed"])
        return self._complaints().select(
            F.col("event_id").alias("Complaint_ID"),
            "OrderID",
            _pick(F.col("event_id"), ISSUES).alias("Issue_Type"),
            F.col("props").alias("Description"),
            F.col("ts").alias("Created_At"),
            state.alias("Status"),
            F.when(state.isin("Resolved", "Closed"), F.timestamp_add("HOUR", F.lit(3), F.col("ts"))).alias(
                "Resolved_At"
            ),
        )

    def _gen1_refund(self) -> DataFrame:
        return self.refunds()

    def _cancellations(self) -> DataFrame:
        key = F.col("o_orderkey")
        who = _pick(key, ["Customer", "Customer", "Customer", "Restaurant", "Restaurant", "System", "System"])
        return (
            self.raw("orders")
            .where(_order_state(["cancelled", "", "", ""]) == "cancelled")
            .select(
                key.alias("Cancellation_ID"),
                who.alias("Cancelled_By"),
                F.col("o_custkey").alias("Canceled_BY"),
                F.col("o_orderpriority").alias("Reason"),
                F.timestamp_add("HOUR", F.lit(1), F.col("o_orderdate")).alias("Cancel_At"),
                (key % 4 != 0).alias("Refund_Eligible"),
                (key % 3 * 10).alias("Penalty_Amount"),
                key.alias("Order_ID"),
            )
        )

    def _gen1_cancellation(self) -> DataFrame:
        return self._cancellations().select(
            "Cancellation_ID",
            "Cancelled_By",
            F.col("Reason").alias("Cancellation_Reason"),
            F.col("Cancel_At").alias("Cancelled_At"),
            "Refund_Eligible",
            "Penalty_Amount",
            F.col("Order_ID").alias("OrderID"),
        )

    # Generation 2 ------------------------------------------------------------------------------------------

    def _gen2_address(self) -> DataFrame:
        return self._gen1_user_address()

    def _gen2_user(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("UserID"),
            F.col("c_name").alias("User_Name"),
            F.concat("c_name", F.lit("@example.com")).alias("Email"),
            (F.lit(6000000000) + F.col("c_custkey")).alias("Phone_No"),
            F.lit("-").alias("Password_Hash"),
            F.lit(None).alias("Profile_Pic"),
            F.lit(True).alias("Is_Active"),
            _at(EPOCH).alias("Created_At"),
        )

    def _gen2_user_address(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("UserID"),
            F.col("c_custkey").alias("Add_ID"),
            F.lit(True).alias("Is_Default"),
            F.lit("Home").alias("Label"),
        )

    def _gen2_restaurant(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.raw("supplier").select(
            key.alias("Restaurant_ID"),
            F.col("s_name").alias("Resto_Name"),
            F.lit("10:00:00").alias("Open_Time"),
            _pick(key, ["23:30:00", "22:00:00", "23:00:00"]).alias("Close_Time"),
            (key % 5 != 0).alias("Restaurant_Status"),
            (F.lit(10000000000000) + key).alias("FSSAI_License_No"),
            (F.lit(7000000000) + key).alias("Contact_No"),
            key.alias("Add_ID"),
            ((30 + key % 20).cast("decimal(3,0)") / 10).alias("Rating"),
            key.alias("Total_Reviews"),
            (100 + key % 5 * 50).alias("Min_Order_Amount"),
            (20 + key % 30).alias("Avg_Delivery_Time"),
        )

    def _gen2_cuisine(self) -> DataFrame:
        return self._cuisine()

    def _gen2_menu_category(self) -> DataFrame:
        return self._categories().withColumn("Cat_Type", F.lit("Food"))

    def _gen2_menu_item(self) -> DataFrame:
        size = F.col("p_size")
        return self.raw("part").select(
            F.col("p_partkey").alias("Item_ID"),
            F.col("p_name").alias("Item_Name"),
            F.col("p_brand").alias("Description"),
            _rupees(F.col("p_retailprice")).alias("Price"),
            size.alias("Preparation_Time"),
            (size > 5).alias("Is_Available"),
            _pick(F.col("p_partkey"), [None, False, False, True, True, True, True]).alias("Is_Veg"),
            (size * 10).alias("Weight"),
            size.alias("Total_Rating"),
            (size * 0.125).alias("Rating"),
            (size * 20).alias("Calories"),
            size.alias("Protein"),
            size.alias("Carbs"),
            size.alias("Fat"),
            F.lit(None).alias("Image_URL"),
            F.lit(0).alias("Discount_Percentage"),
            F.col("p_type").alias("Category_Name"),
            (F.col("p_partkey") % self.restaurants).alias("Restaurant_ID"),
        )

    def _gen2_coupon(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.raw("part").select(
            key.alias("Coupon_ID"),
            F.concat(F.lit("C"), key.cast("string")).alias("Coupon_Code"),
            F.col("p_name").alias("Description"),
            (key % 30).alias("Discount_PR"),
            F.lit(50).alias("Discount_Amount"),
            F.lit(100).alias("Min_Order_Value"),
            (key % 50).alias("Max_Uses"),
            F.col("p_size").alias("Used_Count"),
            F.lit("2024-01-01").alias("Valid_From"),
            F.lit("2024-12-31").alias("Valid_Till"),
            F.lit(True).alias("Is_Active"),
        )

    def _gen2_discount(self) -> DataFrame:
        return self._gen2_coupon().select(
            F.col("Coupon_ID").alias("Discount_ID"), "Discount_PR", "Discount_Amount", "Coupon_ID"
        )

    def _gen2_cart(self) -> DataFrame:
        return self._gen1_cart().select(
            "Cart_ID",
            "Created_At",
            F.col("Created_At").alias("Updated_At"),
            F.when(F.col("Status") == "Checked Out", "Ordered").otherwise(F.col("Status")).alias("Status"),
            F.lit(0).alias("Total_Amount"),
            "UserID",
        )

    def _gen2_cart_item(self) -> DataFrame:
        return self._gen1_cart_item()

    def _gen2_orders(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("OrderID"),
            F.col("o_orderdate").alias("Date_Time"),
            _order_state(["Cancelled", "Delivered", "Preparing", "OutForDelivery"]).alias("Order_Status"),
            _rupees(F.col("o_totalprice")).alias("Total_Amount"),
            F.col("o_orderpriority").alias("Special_Instructions"),
            F.col("o_custkey").alias("UserID"),
            F.col("o_custkey").alias("Add_ID"),
            F.when(_weekend(F.col("o_orderdate")), F.col("o_orderkey") % self.items).alias("Discount_ID"),
        )

    def _gen2_order_status_log(self) -> DataFrame:
        return self._events().select(
            F.col("event_id").alias("Log_ID"),
            (F.col("event_id") % self.orders).alias("OrderID"),
            F.col("event_type").alias("Status"),
            F.col("ts").alias("Changed_At"),
            F.col("props").alias("Note"),
        )

    def _gen2_order_item(self) -> DataFrame:
        return self._lines().select("OrderID", "Item_ID", "Quantity", _rupees(F.col("Unit_Price")).alias("Price"))

    def _gen2_delivery_partner(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self._supplier().select(
            key.alias("Partner_ID"),
            F.col("s_name").alias("Name"),
            (F.lit(8000000000) + key).alias("Phone_No"),
            F.concat(F.lit("V"), key.cast("string")).alias("Vehicle_No"),
            ((30 + key % 20).cast("decimal(3,0)") / 10).alias("Rating"),
            (key % 5 != 0).alias("Is_Available"),
            "City",
            (key * 3).alias("Total_Deliveries"),
            F.lit("2024-01-01").alias("Joining_Date"),
        )

    def _gen2_delivery(self) -> DataFrame:
        names = {"error": "Failed", "signup": "InTransit"}
        return (
            self._delivery_times()
            .withColumn("Status", _map(F.col("event_type"), names, "Delivered"))
            .withColumn("Delivery_Charges", F.lit(30))
        )

    def _gen2_payment(self) -> DataFrame:
        return self._gen1_payment().select(
            "Transaction_ID",
            "Mode",
            _rupees(F.col("Amount")).alias("Amount"),
            _map(F.col("Status"), {"Paid": "Success", "Failed": "Failed"}, "Pending").alias("Status"),
            F.col("Paid_At").alias("Payment_Date"),
            "Order_ID",
        )

    def _gen2_review(self) -> DataFrame:
        subject = F.col("event_id") % self.restaurants
        return self._events("view", "click").select(
            F.col("event_id").alias("Review_ID"),
            F.col("props").alias("Review"),
            (1 + F.col("user_id") % 5).alias("Rating"),
            F.col("ts").alias("Review_Date"),
            F.when(F.col("event_type") == "view", subject).alias("Restaurant_ID"),
            F.col("user_id").alias("UserID"),
            F.when(F.col("event_type") == "click", subject).alias("Partner_ID"),
        )

    def _gen2_cancellation(self) -> DataFrame:
        return self._cancellations()

    def _gen2_wallet(self) -> DataFrame:
        return self._gen1_wallet().withColumn("Balance", _rupees(F.col("Balance")))

    def _gen2_wallet_transaction(self) -> DataFrame:
        return self._gen1_wallet_transaction().select(
            "Transaction_ID",
            "Wallet_ID",
            F.upper("Type").alias("Type"),
            _rupees(F.col("Amount")).alias("Amount"),
            F.lit(None).alias("Balance_After"),
            "Date_Time",
        )

    def _gen2_wallet_topup(self) -> DataFrame:
        return self._gen1_wallet_topup().withColumnRenamed("Payment_mode", "Payment_Mode")

    def _gen2_notification(self) -> DataFrame:
        return self._events().select(
            F.col("event_id").alias("Notification_ID"),
            F.col("user_id").alias("UserID"),
            F.col("event_type").alias("Title"),
            F.col("props").alias("Message"),
            F.col("event_type").alias("Type"),
            (F.col("event_id") % 3 != 0).alias("Is_Read"),
            F.col("ts").alias("Created_At"),
        )

    def _gen2_complaint(self) -> DataFrame:
        state = _pick(F.call_function("div", F.col("event_id"), F.lit(8)), ["Pending", "Resolved", "Resolved", "Rejected"])
        return self._complaints().select(
            F.col("event_id").alias("Complaint_ID"),
            "OrderID",
            F.col("user_id").alias("UserID"),
            _pick(F.col("event_id"), ISSUES).alias("Issue_Type"),
            F.col("props").alias("Description"),
            F.col("ts").alias("Created_At"),
            state.alias("Status"),
            F.when(state == "Resolved", F.timestamp_add("HOUR", F.lit(3), F.col("ts"))).alias("Resolved_At"),
        )

    def _gen2_refund(self) -> DataFrame:
        return self.refunds()
