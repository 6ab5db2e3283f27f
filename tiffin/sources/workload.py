"""Inputs of the write-side jobs, derived from the star schema like the tables themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.jobs.ledger import CREDIT, DEBIT
from tiffin.sources.catalog import Marketplace
from tiffin.sources.star import STAR, StarSource
from tiffin.streaming.refunds import due

REFUND = "struct<Refund_ID:bigint,Wallet_ID:bigint,Refund_Amount:decimal(18,2),Refund_Status:string>"


def _review(restaurant, rating):
    return F.struct(restaurant.cast("bigint").alias("Restaurant_ID"), rating.cast("float").alias("Rating"))


def review_changes(source: StarSource, key: bool = False) -> DataFrame:
    """Edits of the stored reviews: clicks change their mind, some also the restaurant; cheap views are withdrawn.
    With ``key`` each change names its review."""
    events = source.raw("events")
    reviews = source.review_fields(events).select("Review_ID", "Restaurant_ID", "Rating")
    click = F.col("event_type") == "click"
    moved = F.when(F.col("user_id") % 4 == 0, (F.col("event_id") + 1) % source.restaurants)
    return (
        events.where(click | ((F.col("event_type") == "view") & (F.col("value") < 5)))
        .join(reviews, F.col("event_id") == F.col("Review_ID"))
        .select(
            *(["Review_ID"] if key else []),
            _review(F.col("Restaurant_ID"), F.col("Rating")).alias("before"),
            F.when(
                click, _review(F.coalesce(moved, F.col("Restaurant_ID")), 1 + F.col("user_id") % 3)
            ).alias("after"),
        )
    )


def reviews_after(source: StarSource) -> DataFrame:
    """The reviews after the edits of ``review_changes``, as a snapshot."""
    changes = review_changes(source, key=True)
    kept = source.marketplace("gen1")["review"].join(changes.select("Review_ID"), "Review_ID", "left_anti")
    edited = changes.where(F.col("after").isNotNull()).select("Review_ID", "after.*")
    names = ["Review_ID", "Restaurant_ID", "Rating"]
    return kept.select(*names).unionByName(edited.select(*names))


def later_marketplace(source: StarSource) -> Marketplace:
    """The marketplace some time later: reviews edited, waiting payments made, orders in preparation cancelled."""
    m = source.marketplace("gen1")
    reviews = m["review"].drop("Restaurant_ID", "Rating").join(reviews_after(source), "Review_ID")
    made = (F.col("Status") == "Pending") & (F.col("Order_ID") % 5 == 0)
    called_off = (F.col("Status") == "preparing") & (F.col("OrderID") % 10 == 1)
    return m.replace(
        review=reviews,
        payment=m["payment"].withColumn("Status", F.when(made, "Paid").otherwise(F.col("Status"))),
        orders=m["orders"].withColumn("Status", F.when(called_off, "cancelled").otherwise(F.col("Status"))),
    )


def earlier_refunds(source: StarSource, before: str) -> DataFrame:
    """The refund table as it stood: refunds raised by then, hardly any of them completed."""
    state = F.when(F.col("Refund_ID") % 10 == 2, "Completed").otherwise("Pending")
    raised = source.refunds().where(F.col("Initiated_At") < F.lit(before).cast("timestamp_ntz"))
    return raised.withColumn("Refund_Status", state)


def cancellation_credits(source: StarSource) -> DataFrame:
    """Money back to the wallet for cancelled orders that are eligible."""
    m = source.marketplace("gen1")
    orders = m["orders"].select("OrderID", "UserID", "Total_Amount")
    wallets = m["wallet"].select("Wallet_ID", "UserID")
    return (
        m["cancellation"]
        .where("Refund_Eligible")
        .join(orders, "OrderID")
        .join(wallets, "UserID")
        .select(
            F.col("Cancellation_ID").alias("Credit_ID"),
            "Wallet_ID",
            F.col("Total_Amount").alias("Amount"),
            F.col("Cancelled_At").alias("at"),
        )
    )


def checkout_requests(source: StarSource) -> DataFrame:
    """Every cart is asked for: the low-priority ones by somebody else, the urgent ones a second time."""
    key, who, priority = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority")

    def request(number, user):
        return F.struct(number.alias("Request_ID"), user.alias("UserID"), key.alias("Cart_ID"))

    first = request(key * 2, F.when(priority == "5-LOW", who + 1).otherwise(who))
    again = F.when(priority == "1-URGENT", request(key * 2 + 1, who))
    return (
        source.raw("orders")
        .select(F.explode(F.array(first, again)).alias("request"))
        .where(F.col("request").isNotNull())
        .select("request.*")
    )


def event_stream(source: StarSource, files: int = 8) -> DataFrame:
    """The events as an unbounded input: new files become new rows, ``files`` of them at a time."""
    # A pattern, because a stream source takes a plain path for a folder while the table may be a single file.
    reader = source.spark.readStream.schema(STAR["events"]).option("maxFilesPerTrigger", files)
    return reader.parquet(f"{source.root}/events.parque[t]")


def review_stream(source: StarSource) -> DataFrame:
    """New reviews as a change feed."""
    reviews = source.review_fields(event_stream(source))
    after = _review(F.col("Restaurant_ID"), F.col("Rating"))
    return reviews.select(F.lit(None).cast("struct<Restaurant_ID:bigint,Rating:float>").alias("before"), after.alias("after"))


def refund_stream(source: StarSource) -> DataFrame:
    """Refund changes: raised as pending, then decided."""

    def refund(status):
        return F.struct("Refund_ID", "Wallet_ID", "Refund_Amount", status.alias("Refund_Status")).cast(REFUND)

    pending, decided = refund(F.lit("Pending")), refund(F.col("Refund_Status"))
    raised = F.struct(
        F.lit(None).cast(REFUND).alias("before"), pending.alias("after"), F.col("Initiated_At").alias("at")
    )
    settled = F.coalesce(F.col("Completed_At"), F.col("Initiated_At"))
    closed = F.struct(pending.alias("before"), decided.alias("after"), settled.alias("at"))
    return source.refunds(event_stream(source)).select(F.inline(F.array(raised, closed)))


def _wallet_events(rows: DataFrame, wallet: str, at: str, kind: Column, number: str, amount: str) -> DataFrame:
    """Rows as wallet events (``EVENTS``); every wallet starts empty."""
    return rows.select(
        F.col(wallet).alias("Wallet_ID"),
        F.col(at).alias("at"),
        kind.cast("int").alias("kind"),
        F.col(number).alias("id"),
        (F.col(amount).cast("decimal(18,2)") * 100).cast("bigint").alias("cents"),
        F.lit(0).cast("bigint").alias("opening"),
    )


def wallet_stream(source: StarSource) -> DataFrame:
    """Wallet movements as credit and debit requests."""
    rows = event_stream(source).where(F.col("event_type").isin("purchase", "click"))
    kind = F.when(F.col("event_type") == "purchase", DEBIT).otherwise(CREDIT)
    return _wallet_events(rows, "user_id", "ts", kind, "event_id", "value")


def purchase_stream(source: StarSource) -> DataFrame:
    """Purchases as debit requests."""
    rows = event_stream(source).where(F.col("event_type") == "purchase")
    return _wallet_events(rows, "user_id", "ts", F.lit(DEBIT), "event_id", "value")


def refund_credit_stream(source: StarSource) -> DataFrame:
    """Credits that refunds earn when they are completed."""
    return _wallet_events(due(refund_stream(source)), "Wallet_ID", "at", F.lit(CREDIT), "Refund_ID", "Amount")


def event_span_hours(source: StarSource) -> int:
    """How late a file may bring an event: files are in no order, so by as much as the table spans. Refunds end two
    hours after their event."""
    first, last = source.raw("events").agg(F.min("ts"), F.max("ts")).first()
    return 3 + int((last - first).total_seconds() // 3600) if first else 3
