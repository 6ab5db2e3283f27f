"""The marketplace data model: two generations of tables with types, keys, references and value rules.

Generation 1 ("gen1") has separate customer and restaurant addresses, decimal money and strict constraints;
generation 2 ("gen2") shares one address table, keeps money in whole rupees and adds coupons, status logs and
notifications. Integer keys are widened to 64 bits and money to 18 digits, so that a large marketplace cannot
overflow a column; wall-clock times have no zone; TIME is ``HH:mm:ss`` text (zero-padded, so text order is time
order).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LONG, INT, TEXT, FLAG, FLOAT = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType(), T.FloatType()
WHEN, DAY, RATING = T.TimestampNTZType(), T.DateType(), T.DecimalType(3, 1)
MONEY = T.DecimalType(18, 2)

NOW = "now"  # default marker: the job's own as-of time


@dataclass(frozen=True)
class Col:
    name: str
    dtype: T.DataType
    required: bool = True
    default: object = None
    domain: tuple[str, ...] = ()


@dataclass(frozen=True)
class Ref:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    on_delete: str = "restrict"


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Col, ...]
    key: tuple[str, ...]
    unique: tuple[str, ...] = ()
    refs: tuple[Ref, ...] = ()
    checks: tuple[str, ...] = ()
    touched: str | None = None  # column stamped whenever a row changes
    by_name: dict[str, Col] = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        object.__setattr__(self, "by_name", {c.name: c for c in self.columns})

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype, True) for c in self.columns])


def need(name, dtype, default=None, domain=()):
    return Col(name, dtype, True, default, tuple(domain))


def may(name, dtype, default=None):
    return Col(name, dtype, False, default)


def ref(column, parent, parent_column=None, on_delete="restrict"):
    columns = (column,) if isinstance(column, str) else tuple(column)
    parents = columns if parent_column is None else (parent_column,)
    return Ref(columns, parent, parents, on_delete)


def _index(*tables: Table) -> dict[str, Table]:
    return {t.name: t for t in tables}


# The tables, domains, defaults and value rules of generation 1.
GEN1 = _index(
    Table(
        "users",
        (
            need("UserID", LONG),
            need("User_Name", TEXT),
            need("Phone_No", LONG),
            need("Email", TEXT),
            need("Password", TEXT),
            need("Role", TEXT, "customer", ("customer", "restaurant_owner", "admin")),
            need("Created_At", WHEN, NOW),
            need("Updated_At", WHEN, NOW),
        ),
        key=("UserID",),
        unique=("Phone_No", "Email"),
        checks=("Phone_No BETWEEN 6000000000 AND 9999999999",),
        touched="Updated_At",
    ),
    Table(
        "user_address",
        (
            need("Add_ID", LONG),
            need("Add_line_1", TEXT),
            may("Add_line_2", TEXT),
            need("Area", TEXT),
            need("City", TEXT),
            need("Pincode", INT),
        ),
        key=("Add_ID",),
        checks=("Pincode BETWEEN 100000 AND 999999",),
    ),
    Table(
        "user_has_address",
        (need("Add_ID", LONG), need("UserID", LONG)),
        key=("Add_ID", "UserID"),
        refs=(ref("Add_ID", "user_address", on_delete="cascade"), ref("UserID", "users", on_delete="cascade")),
    ),
    Table(
        "restaurant",
        (
            need("Restaurant_ID", LONG),
            need("Name", TEXT),
            need("Open_Time", TEXT),
            need("Close_Time", TEXT),
            need("Restaurant_Status", FLAG, True),
            need("FSSAI_License_No", LONG),
            need("Contact_No", LONG),
            need("Rating", FLOAT, 0.0),
            need("Owner_UserID", LONG),
            need("Created_At", WHEN, NOW),
            need("Updated_At", WHEN, NOW),
        ),
        key=("Restaurant_ID",),
        unique=("FSSAI_License_No", "Contact_No"),
        refs=(ref("Owner_UserID", "users", "UserID"),),
        checks=("Rating BETWEEN 0 AND 5", "Close_Time > Open_Time"),
        touched="Updated_At",
    ),
    Table(
        "restaurant_address",
        (
            need("Add_ID", LONG),
            need("Add_line_1", TEXT),
            may("Add_line_2", TEXT),
            need("Area", TEXT),
            need("City", TEXT),
            need("Pincode", INT),
            need("Restaurant_ID", LONG),
        ),
        key=("Add_ID",),
        refs=(ref("Restaurant_ID", "restaurant", on_delete="cascade"),),
        checks=("Pincode BETWEEN 100000 AND 999999",),
    ),
    Table(
        "cuisine",
        (need("Cuisine", TEXT), need("Restaurant_ID", LONG)),
        key=("Cuisine", "Restaurant_ID"),
        refs=(ref("Restaurant_ID", "restaurant", on_delete="cascade"),),
    ),
    Table(
        "menu_category",
        (
            need("Category_Name", TEXT),
            need("Type", TEXT, "Veg", ("Veg", "Non-Veg", "Vegan")),
            need("Restaurant_ID", LONG),
        ),
        key=("Category_Name", "Restaurant_ID"),
        refs=(ref("Restaurant_ID", "restaurant", on_delete="cascade"),),
    ),
    Table(
        "menu_item",
        (
            need("Item_ID", LONG),
            need("Item_Name", TEXT),
            may("Description", TEXT),
            need("Price", MONEY),
            need("Preparation_Time", INT),
            need("Is_Available", FLAG, True),
            need("Category_Name", TEXT),
            need("Restaurant_ID", LONG),
            need("Created_At", WHEN, NOW),
            need("Updated_At", WHEN, NOW),
        ),
        key=("Item_ID",),
        refs=(ref(("Category_Name", "Restaurant_ID"), "menu_category"),),
        checks=("Price > 0", "Preparation_Time > 0"),
        touched="Updated_At",
    ),
    Table(
        "review",
        (
            need("Review_ID", LONG),
            need("Review", TEXT),
            need("Rating", FLOAT),
            need("Restaurant_ID", LONG),
            need("UserID", LONG),
            need("Created_At", WHEN, NOW),
        ),
        key=("Review_ID",),
        refs=(
            ref("Restaurant_ID", "restaurant", on_delete="cascade"),
            ref("UserID", "users", on_delete="cascade"),
        ),
        checks=("Rating BETWEEN 1 AND 5",),
    ),
    Table(
        "cart",
        (
            need("Cart_ID", LONG),
            need("Created_At", WHEN, NOW),
            need("Status", TEXT, "Active", ("Active", "Checked Out", "Abandoned")),
            need("UserID", LONG),
        ),
        key=("Cart_ID",),
        refs=(ref("UserID", "users", on_delete="cascade"),),
    ),
    Table(
        "cart_item",
        (need("Item_ID", LONG), need("Cart_ID", LONG), need("Quantity", LONG, 1)),
        key=("Item_ID", "Cart_ID"),
        refs=(ref("Item_ID", "menu_item", on_delete="cascade"), ref("Cart_ID", "cart", on_delete="cascade")),
        checks=("Quantity > 0",),
    ),
    Table(
        "orders",
        (
            need("OrderID", LONG),
            need("Date_Time", WHEN, NOW),
            need("UserID", LONG),
            need("Restaurant_ID", LONG),
            need(
                "Status",
                TEXT,
                "pending",
                ("pending", "confirmed", "preparing", "out_for_delivery", "delivered", "cancelled"),
            ),
            need("Total_Amount", MONEY),
            need("Updated_At", WHEN, NOW),
        ),
        key=("OrderID",),
        refs=(ref("UserID", "users"), ref("Restaurant_ID", "restaurant")),
        checks=("Total_Amount >= 0",),
        touched="Updated_At",
    ),
    Table(
        "order_item",
        (need("Item_ID", LONG), need("OrderID", LONG), need("Quantity", LONG, 1), need("Unit_Price", MONEY)),
        key=("Item_ID", "OrderID"),
        refs=(ref("Item_ID", "menu_item"), ref("OrderID", "orders", on_delete="cascade")),
        checks=("Quantity > 0", "Unit_Price >= 0"),
    ),
    Table(
        "payment",
        (
            need("Transaction_ID", LONG),
            need("Mode", TEXT, None, ("UPI", "Card", "Cash", "Wallet", "NetBanking")),
            need("Status", TEXT, "Pending", ("Pending", "Paid", "Failed", "Refunded")),
            need("Amount", MONEY),
            may("Gateway_Ref", TEXT),
            may("Paid_At", WHEN),
            need("Order_ID", LONG),
        ),
        key=("Transaction_ID",),
        unique=("Order_ID",),
        refs=(ref("Order_ID", "orders", "OrderID"),),
        checks=("Amount >= 0",),
    ),
    Table(
        "delivery_partner",
        (
            need("Partner_ID", LONG),
            need("Name", TEXT),
            need("Phone_No", LONG),
            need("Vehicle_No", TEXT),
            need("Rating", FLOAT, 0.0),
            need("Is_Active", FLAG, True),
            need("Created_At", WHEN, NOW),
        ),
        key=("Partner_ID",),
        unique=("Phone_No", "Vehicle_No"),
        checks=("Phone_No BETWEEN 6000000000 AND 9999999999", "Rating BETWEEN 0 AND 5"),
    ),
    Table(
        "delivery",
        (
            need("Delivery_ID", LONG),
            may("Pickup_Time", WHEN),
            may("Delivery_Time", WHEN),
            need("Status", TEXT, "Assigned", ("Assigned", "Picked Up", "In Transit", "Delivered", "Failed")),
            need("OrderID", LONG),
            need("Partner_ID", LONG),
        ),
        key=("Delivery_ID",),
        unique=("OrderID",),
        refs=(ref("OrderID", "orders"), ref("Partner_ID", "delivery_partner")),
    ),
    Table(
        "wallet",
        (need("Wallet_ID", LONG), need("Balance", MONEY, 0), need("Created_At", WHEN, NOW), need("UserID", LONG)),
        key=("Wallet_ID",),
        unique=("UserID",),
        refs=(ref("UserID", "users", on_delete="cascade"),),
        checks=("Balance >= 0",),
    ),
    Table(
        "wallet_transaction",
        (
            need("Wallet_ID", LONG),
            need("Transaction_ID", LONG),
            need("Type", TEXT, None, ("Credit", "Debit")),
            need("Amount", MONEY),
            need("Date_Time", WHEN, NOW),
        ),
        key=("Transaction_ID",),
        refs=(ref("Wallet_ID", "wallet", on_delete="cascade"),),
        checks=("Amount > 0",),
    ),
    Table(
        "wallet_topup",
        (
            need("Transaction_ID", LONG),
            need("Status", TEXT, "Pending", ("Success", "Failed", "Pending")),
            need("Payment_mode", TEXT, None, ("UPI", "Card", "NetBanking")),
            need("Transaction_Ref", LONG),
            need("Date_Time", WHEN, NOW),
            need("Wallet_ID", LONG),
        ),
        key=("Transaction_ID",),
        unique=("Transaction_Ref",),
        refs=(
            ref("Transaction_ID", "wallet_transaction", on_delete="cascade"),
            ref("Wallet_ID", "wallet", on_delete="cascade"),
        ),
    ),
    Table(
        "discount",
        (need("Discount_ID", LONG), need("Discount_PR", FLOAT), need("Discount_Amount", MONEY), need("OrderID", LONG)),
        key=("Discount_ID",),
        unique=("OrderID",),
        refs=(ref("OrderID", "orders", on_delete="cascade"),),
        checks=("Discount_PR BETWEEN 0 AND 100", "Discount_Amount >= 0"),
    ),
    Table(
        "complaint",
        (
            need("Complaint_ID", LONG),
            need("OrderID", LONG),
            need(
                "Issue_Type",
                TEXT,
                None,
                (
                    "Late Delivery",
                    "Wrong Item",
                    "Cold Food",
                    "Missing Item",
                    "Quality Issue",
                    "Packaging",
                    "Spill",
                    "Other",
                ),
            ),
            need("Description", TEXT),
            need("Created_At", WHEN, NOW),
            need("Status", TEXT, "Open", ("Open", "Under Review", "Resolved", "Closed")),
            may("Resolved_At", WHEN),
        ),
        key=("Complaint_ID",),
        refs=(ref("OrderID", "orders"),),
    ),
    Table(
        "refund",
        (
            need("Refund_ID", LONG),
            need("OrderID", LONG),
            need("Complaint_ID", LONG),
            need("Refund_Amount", MONEY),
            need("Refund_Status", TEXT, "Pending", ("Pending", "Completed", "Rejected")),
            may("Completed_At", WHEN),
            need("Wallet_ID", LONG),
        ),
        key=("Refund_ID",),
        refs=(ref("OrderID", "orders"), ref("Complaint_ID", "complaint"), ref("Wallet_ID", "wallet")),
        checks=("Refund_Amount >= 0",),
    ),
    Table(
        "cancellation",
        (
            need("Cancellation_ID", LONG),
            need("Cancelled_By", TEXT, None, ("Customer", "Restaurant", "System")),
            need("Cancellation_Reason", TEXT),
            need("Cancelled_At", WHEN, NOW),
            need("Refund_Eligible", FLAG, True),
            need("Penalty_Amount", MONEY, 0),
            need("OrderID", LONG),
        ),
        key=("Cancellation_ID",),
        unique=("OrderID",),
        refs=(ref("OrderID", "orders"),),
        checks=("Penalty_Amount >= 0",),
    ),
)

# The tables and defaults of generation 2. It declares no value rules or closed domains.
GEN2 = _index(
    Table(
        "address",
        (
            need("Add_ID", LONG),
            may("Add_line_1", TEXT),
            may("Add_line_2", TEXT),
            may("Area", TEXT),
            may("City", TEXT),
            may("Pincode", INT),
        ),
        key=("Add_ID",),
    ),
    Table(
        "user",
        (
            need("UserID", LONG),
            need("User_Name", TEXT),
            need("Email", TEXT),
            need("Phone_No", TEXT),
            need("Password_Hash", TEXT),
            may("Profile_Pic", TEXT),
            may("Is_Active", FLAG, True),
            may("Created_At", WHEN, NOW),
        ),
        key=("UserID",),
        unique=("Email", "Phone_No"),
    ),
    Table(
        "user_address",
        (need("UserID", LONG), need("Add_ID", LONG), may("Is_Default", FLAG, False), may("Label", TEXT, "Home")),
        key=("UserID", "Add_ID"),
        refs=(ref("UserID", "user"), ref("Add_ID", "address")),
    ),
    Table(
        "restaurant",
        (
            need("Restaurant_ID", LONG),
            need("Resto_Name", TEXT),
            may("Open_Time", TEXT),
            may("Close_Time", TEXT),
            may("Restaurant_Status", FLAG, True),
            may("FSSAI_License_No", LONG),
            may("Contact_No", TEXT),
            may("Add_ID", LONG),
            may("Rating", RATING, 0),
            may("Total_Reviews", LONG, 0),
            may("Min_Order_Amount", LONG, 0),
            may("Avg_Delivery_Time", LONG, 30),
        ),
        key=("Restaurant_ID",),
        unique=("FSSAI_License_No",),
        refs=(ref("Add_ID", "address"),),
    ),
    Table(
        "cuisine",
        (need("Cuisine", TEXT), need("Restaurant_ID", LONG)),
        key=("Cuisine", "Restaurant_ID"),
        refs=(ref("Restaurant_ID", "restaurant"),),
    ),
    Table(
        "menu_category",
        (need("Category_Name", TEXT), may("Cat_Type", TEXT), need("Restaurant_ID", LONG)),
        key=("Category_Name", "Restaurant_ID"),
        refs=(ref("Restaurant_ID", "restaurant"),),
    ),
    Table(
        "menu_item",
        (
            need("Item_ID", LONG),
            need("Item_Name", TEXT),
            may("Description", TEXT),
            need("Price", LONG),
            may("Preparation_Time", INT),
            may("Is_Available", FLAG, True),
            may("Is_Veg", FLAG),
            may("Weight", INT),
            may("Total_Rating", LONG, 0),
            may("Rating", FLOAT, 0.0),
            may("Calories", INT),
            may("Protein", FLOAT),
            may("Carbs", FLOAT),
            may("Fat", FLOAT),
            may("Image_URL", TEXT),
            may("Discount_Percentage", INT, 0),
            may("Category_Name", TEXT),
            may("Restaurant_ID", LONG),
        ),
        key=("Item_ID",),
        refs=(ref(("Category_Name", "Restaurant_ID"), "menu_category"),),
    ),
    Table(
        "coupon",
        (
            need("Coupon_ID", LONG),
            need("Coupon_Code", TEXT),
            may("Description", TEXT),
            may("Discount_PR", INT, 0),
            may("Discount_Amount", LONG, 0),
            may("Min_Order_Value", LONG, 0),
            may("Max_Uses", LONG, 100),
            may("Used_Count", LONG, 0),
            may("Valid_From", DAY),
            may("Valid_Till", DAY),
            may("Is_Active", FLAG, True),
        ),
        key=("Coupon_ID",),
        unique=("Coupon_Code",),
    ),
    Table(
        "discount",
        (
            need("Discount_ID", LONG),
            may("Discount_PR", INT, 0),
            may("Discount_Amount", LONG, 0),
            may("Coupon_ID", LONG),
        ),
        key=("Discount_ID",),
        refs=(ref("Coupon_ID", "coupon"),),
    ),
    Table(
        "cart",
        (
            need("Cart_ID", LONG),
            may("Created_At", WHEN),
            may("Updated_At", WHEN, NOW),
            may("Status", TEXT),
            may("Total_Amount", LONG, 0),
            may("UserID", LONG),
        ),
        key=("Cart_ID",),
        refs=(ref("UserID", "user"),),
        touched="Updated_At",
    ),
    Table(
        "cart_item",
        (need("Cart_ID", LONG), need("Item_ID", LONG), may("Quantity", LONG)),
        key=("Cart_ID", "Item_ID"),
        refs=(ref("Cart_ID", "cart"), ref("Item_ID", "menu_item")),
    ),
    Table(
        "orders",
        (
            need("OrderID", LONG),
            may("Date_Time", WHEN),
            may("Order_Status", TEXT, "Placed"),
            may("Total_Amount", LONG, 0),
            may("Special_Instructions", TEXT),
            may("UserID", LONG),
            may("Add_ID", LONG),
            may("Discount_ID", LONG),
        ),
        key=("OrderID",),
        refs=(ref("UserID", "user"), ref("Add_ID", "address"), ref("Discount_ID", "discount")),
    ),
    Table(
        "order_status_log",
        (
            need("Log_ID", LONG),
            may("OrderID", LONG),
            may("Status", TEXT),
            may("Changed_At", WHEN, NOW),
            may("Note", TEXT),
        ),
        key=("Log_ID",),
        refs=(ref("OrderID", "orders"),),
    ),
    Table(
        "order_item",
        (need("OrderID", LONG), need("Item_ID", LONG), may("Quantity", LONG), may("Price", LONG)),
        key=("OrderID", "Item_ID"),
        refs=(ref("OrderID", "orders"), ref("Item_ID", "menu_item")),
    ),
    Table(
        "delivery_partner",
        (
            need("Partner_ID", LONG),
            may("Name", TEXT),
            may("Phone_No", TEXT),
            may("Vehicle_No", TEXT),
            may("Rating", RATING, 0),
            may("Is_Available", FLAG, True),
            may("City", TEXT),
            may("Total_Deliveries", LONG, 0),
            may("Joining_Date", DAY),
        ),
        key=("Partner_ID",),
    ),
    Table(
        "delivery",
        (
            need("Delivery_ID", LONG),
            may("Pickup_Time", WHEN),
            may("Delivery_Time", WHEN),
            may("Status", TEXT),
            may("Delivery_Charges", LONG, 0),
            may("OrderID", LONG),
            may("Partner_ID", LONG),
        ),
        key=("Delivery_ID",),
        refs=(ref("OrderID", "orders"), ref("Partner_ID", "delivery_partner")),
    ),
    Table(
        "payment",
        (
            need("Transaction_ID", LONG),
            may("Mode", TEXT),
            may("Amount", LONG),
            may("Status", TEXT, "Success"),
            may("Payment_Date", WHEN),
            may("Order_ID", LONG),
        ),
        key=("Transaction_ID",),
        refs=(ref("Order_ID", "orders", "OrderID"),),
    ),
    Table(
        "review",
        (
            need("Review_ID", LONG),
            may("Review", TEXT),
            may("Rating", RATING),
            may("Review_Date", WHEN, NOW),
            may("Restaurant_ID", LONG),
            may("UserID", LONG),
            may("Partner_ID", LONG),
        ),
        key=("Review_ID",),
        refs=(ref("Restaurant_ID", "restaurant"), ref("UserID", "user"), ref("Partner_ID", "delivery_partner")),
    ),
    Table(
        "cancellation",
        (
            need("Cancellation_ID", LONG),
            may("Canceled_BY", LONG),
            may("Reason", TEXT),
            may("Cancel_At", WHEN),
            may("Refund_Eligible", FLAG),
            may("Penalty_Amount", LONG, 0),
            may("Order_ID", LONG),
        ),
        key=("Cancellation_ID",),
        refs=(ref("Canceled_BY", "user", "UserID"), ref("Order_ID", "orders", "OrderID")),
    ),
    Table(
        "wallet",
        (need("Wallet_ID", LONG), may("Balance", LONG, 0), may("Created_At", WHEN), may("UserID", LONG)),
        key=("Wallet_ID",),
        unique=("UserID",),
        refs=(ref("UserID", "user"),),
    ),
    Table(
        "wallet_transaction",
        (
            need("Transaction_ID", LONG),
            may("Wallet_ID", LONG),
            may("Type", TEXT),
            may("Amount", LONG),
            may("Balance_After", LONG),
            may("Date_Time", WHEN),
        ),
        key=("Transaction_ID",),
        refs=(ref("Wallet_ID", "wallet"),),
    ),
    Table(
        "wallet_topup",
        (
            need("Transaction_ID", LONG),
            may("Status", TEXT),
            may("Payment_Mode", TEXT),
            may("Transaction_Ref", LONG),
            may("Date_Time", WHEN),
        ),
        key=("Transaction_ID",),
        refs=(ref("Transaction_ID", "wallet_transaction"),),
    ),
    Table(
        "notification",
        (
            need("Notification_ID", LONG),
            may("UserID", LONG),
            may("Title", TEXT),
            may("Message", TEXT),
            may("Type", TEXT),
            may("Is_Read", FLAG, False),
            may("Created_At", WHEN, NOW),
        ),
        key=("Notification_ID",),
        refs=(ref("UserID", "user"),),
    ),
    Table(
        "complaint",
        (
            need("Complaint_ID", LONG),
            may("OrderID", LONG),
            may("UserID", LONG),
            may("Issue_Type", TEXT),
            may("Description", TEXT),
            may("Created_At", WHEN),
            may("Status", TEXT),
            may("Resolved_At", WHEN),
        ),
        key=("Complaint_ID",),
        refs=(ref("OrderID", "orders"), ref("UserID", "user")),
    ),
    Table(
        "refund",
        (
            need("Refund_ID", LONG),
            may("OrderID", LONG),
            may("Complaint_ID", LONG),
            may("Refund_Amount", LONG),
            may("Refund_Status", TEXT),
            may("Initiated_At", WHEN, NOW),
            may("Completed_At", WHEN),
            may("Wallet_ID", LONG),
        ),
        key=("Refund_ID",),
        refs=(ref("OrderID", "orders"), ref("Complaint_ID", "complaint"), ref("Wallet_ID", "wallet")),
    ),
)

GENERATIONS = {"gen1": GEN1, "gen2": GEN2}
