"""Wallet credits for refunds that reach ``Completed`` between two snapshots of the refund table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.operators import dense_numbers, keyed_update

DONE = "Completed"


def completed_refunds(old: DataFrame, new: DataFrame) -> DataFrame:
    """Refunds that were in another state before. One that is completed when first seen earns no credit."""
    waiting = old.where(F.col("Refund_Status") != DONE).select("Refund_ID")
    return (
        new.where(F.col("Refund_Status") == DONE)
        .select("Refund_ID", "Wallet_ID", F.col("Refund_Amount").alias("Amount"))
        .join(waiting, "Refund_ID", "left_semi")
    )


def credit_wallets(wallet: DataFrame, credits: DataFrame) -> DataFrame:
    per_wallet = credits.groupBy("Wallet_ID").agg(F.sum("Amount").alias("credited"))
    return keyed_update(wallet, per_wallet, "Wallet_ID", {"Balance": F.col("Balance") + F.col("credited")})


def credit_ledger(ledger: DataFrame, credits: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Ledger rows to append, numbered on from the ledger's last transaction in refund order."""
    now = F.localtimestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    last = ledger.agg(F.coalesce(F.max("Transaction_ID"), F.lit(0))).scalar()
    return dense_numbers(credits, "Refund_ID", "Transaction_ID", start=last + 1).select(
        "Wallet_ID", "Transaction_ID", F.lit("Credit").alias("Type"), "Amount", now.alias("Date_Time")
    )
