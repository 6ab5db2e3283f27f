"""Order browsing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.operators import page_after, page_of
from tiffin.sources import Marketplace


def _named(m: Marketplace, page: DataFrame) -> DataFrame:
    return (
        m["users"]
        .select("UserID", "User_Name")
        .join(F.broadcast(page), "UserID")  # one page of rows
        .select("OrderID", "User_Name", "Date_Time", "Status", "Total_Amount")
        .orderBy("OrderID")
    )


def _listed(m: Marketplace) -> DataFrame:
    return m["orders"].select("OrderID", "UserID", "Date_Time", "Status", "Total_Amount")


def orders_page(m: Marketplace, page: int, size: int) -> DataFrame:
    """Page ``page`` (from 0) of all orders by number."""
    return _named(m, page_of(_listed(m), "OrderID", page, size))


def orders_after(m: Marketplace, last_order: int | None, size: int) -> DataFrame:
    """The page after a known order: the form to use for walking through everything."""
    return _named(m, page_after(_listed(m), "OrderID", last_order, size))
