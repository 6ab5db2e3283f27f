"""A small marketplace of our own for the cases that only show on chosen rows."""

from datetime import datetime
from decimal import Decimal

from tiffin.sources import GEN1, GEN2, Marketplace


def money(text):
    return Decimal(text)


def at(day, hour=0, minute=0, second=0, month=3):
    return datetime(2026, month, day, hour, minute, second)


def rows(generation, name, *records):
    """Full-width rows from dictionaries."""
    model = {"gen1": GEN1, "gen2": GEN2}[generation][name]
    unknown = {k for r in records for k in r} - set(model.by_name)
    assert not unknown, unknown
    return [tuple(r.get(c.name) for c in model.columns) for r in records]


def market(spark, generation, **tables):
    made = {n: rows(generation, n, *records) for n, records in tables.items()}
    return Marketplace.from_rows(spark, made, generation)


def users(*ids):
    return [dict(UserID=i, User_Name=f"user{i}", Email=f"user{i}@example.com", Phone_No=6000000000 + i) for i in ids]


def restaurant(i, **more):
    base = dict(Restaurant_ID=i, Name=f"kitchen{i}", Rating=3.0, Restaurant_Status=True, Open_Time="10:00:00")
    return {**base, "Close_Time": "22:00:00", **more}


def order(i, **more):
    base = dict(OrderID=i, UserID=1, Restaurant_ID=1, Status="delivered", Total_Amount=money("100.00"))
    return {**base, "Date_Time": at(1), **more}


def paid(i, order_id, amount="100.00", mode="UPI", status="Paid"):
    return dict(Transaction_ID=i, Order_ID=order_id, Amount=money(amount), Mode=mode, Status=status)


def collected(df):
    return [tuple(r) for r in df.collect()]
