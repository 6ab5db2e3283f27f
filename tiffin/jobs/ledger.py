"""Wallet debits for payments made by wallet, with rejection of those the balance does not cover.

Events of a wallet (credits and debit requests) take effect in the order (time, credits first, number). A debit is
accepted if the balance at that moment covers it and otherwise leaves the balance alone, so the outcome of one
decides the next and no running sum can express it.

How it scales. Events are range-partitioned by (wallet, time, number) into slices of about ``SLICE_ROWS`` rows and
written to the shared folder. A wallet that fits in one slice is settled there, all slices in parallel. A wallet
that spans slices, however many events it has, is a chain. Its slices are packed in parallel into chunks of
``CHUNK_ROWS`` events, nine bytes an event, each with two numbers that tell whether it passes as a whole: an opening
balance of at least ``need`` has every debit accepted, one below ``least`` has every debit rejected, and either way the
closing balance is a sum away. One job then walks all chains, a chain in one task over an iterator of its chunks with
the balance as its only state; only chunks between the two numbers are gone through event by event. It hands on the
opening balance of each slice of a chain, with which all slices are settled in parallel. No task holds more than a
slice, the walk holds a batch of chunks, and the driver holds nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.operators import dense_numbers, keyed_update
from tiffin.session import shared_folder
from tiffin.sources import Marketplace

SLICE_ROWS = 2_000_000
CHUNK_ROWS = 1_024
CREDIT, DEBIT = 0, 1
ORDER = ["at", "kind", "id"]
EVENTS = "Wallet_ID bigint, at timestamp_ntz, kind int, id bigint, cents bigint, opening bigint"
SETTLED = "Wallet_ID bigint, at timestamp_ntz, kind int, id bigint, cents bigint, accepted boolean, balance bigint"


def _cents(column: str):
    return (F.col(column) * 100).cast("bigint")


def _rupees(column: str):
    return (F.col(column).cast("decimal(20,0)") / 100).cast("decimal(18,2)")


@dataclass(frozen=True)
class Settlement:
    """``decisions`` has one row per debit request: accepted, or rejected with a reason."""

    decisions: DataFrame
    wallets: DataFrame
    ledger: DataFrame


def wallet_requests(m: Marketplace, inserted: DataFrame) -> DataFrame:
    """Inserted payments that debit a wallet, with the wallet of the user who ordered (NULL if there is none)."""
    wallets = m["wallet"].select("Wallet_ID", "UserID", "Balance")
    return (
        inserted.where((F.col("Mode") == "Wallet") & (F.col("Status") == "Paid"))
        .select("Transaction_ID", F.col("Order_ID").alias("OrderID"), "Amount", F.col("Paid_At").alias("at"))
        .join(m["orders"].select("OrderID", "UserID"), "OrderID", "left")
        .join(wallets, "UserID", "left")
        .select("Transaction_ID", "Wallet_ID", "Amount", "at", "Balance")
    )


def _events(m: Marketplace, requests: DataFrame, credits: DataFrame) -> DataFrame:
    """Debit requests and credits (Credit_ID, Wallet_ID, Amount, at) as one frame with the opening balance."""
    debits = requests.where(F.col("Wallet_ID").isNotNull()).select(
        "Wallet_ID",
        "at",
        F.lit(DEBIT).alias("kind"),
        F.col("Transaction_ID").alias("id"),
        _cents("Amount").alias("cents"),
        _cents("Balance").alias("opening"),
    )
    topped = credits.join(m["wallet"].select("Wallet_ID", "Balance"), "Wallet_ID").select(
        "Wallet_ID",
        "at",
        F.lit(CREDIT).alias("kind"),
        F.col("Credit_ID").alias("id"),
        _cents("Amount").alias("cents"),
        _cents("Balance").alias("opening"),
    )
    return debits.unionByName(topped)


def advance(debit: np.ndarray, cents: np.ndarray, opening: int) -> tuple[np.ndarray, np.ndarray]:
    """Acceptance of consecutive events of one wallet and the balance after each."""
    signed = np.where(debit, -cents, cents)
    balance = opening + np.cumsum(signed)  # as if every debit were accepted
    accepted = np.ones(len(cents), dtype=bool)
    uncovered = np.flatnonzero(debit & (balance < 0))
    if len(uncovered):
        # From the first uncovered debit on, event by event.
        start = int(uncovered[0])
        now = int(balance[start] - signed[start])
        for n, (is_debit, amount) in enumerate(zip(debit[start:].tolist(), cents[start:].tolist(), strict=True), start):
            if not is_debit:
                now += amount
            elif now >= amount:
                now -= amount
            else:
                accepted[n] = False
            balance[n] = now
    return accepted, balance


def advance_all(
    wallet: np.ndarray, debit: np.ndarray, cents: np.ndarray, opening: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """``advance`` for many wallets: events wallet by wallet, each wallet's in order. ``opening`` is by event; the one
    at a wallet's first event counts."""
    # Running balances as if every debit were accepted.
    first = np.flatnonzero(np.r_[True, wallet[1:] != wallet[:-1]])
    member = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(wallet)]))
    signed = np.where(debit, -cents, cents)
    balance = np.cumsum(signed)
    balance += (opening[first] - balance[first] + signed[first])[member]
    accepted = np.ones(len(wallet), dtype=bool)

    # Wallets with an uncovered debit are settled from there on.
    uncovered = np.flatnonzero(debit & (balance < 0))
    broken, at = np.unique(member[uncovered], return_index=True)
    for start, end in zip(uncovered[at].tolist(), np.r_[first, len(wallet)][broken + 1].tolist(), strict=True):
        accepted[start:end], balance[start:end] = advance(
            debit[start:end], cents[start:end], int(balance[start] - signed[start])
        )
    return accepted, balance


def _settled_slice(rows: pd.DataFrame) -> pd.DataFrame:
    """All events of a slice, wallet by wallet."""
    columns = {c: rows[c].to_numpy() for c in ("Wallet_ID", *ORDER, "cents", "opening")}
    keys = [columns["Wallet_ID"], columns["at"].view("int64"), columns["kind"], columns["id"]]
    order = np.lexsort(keys[::-1])  # as Spark sorts: a missing time comes first
    columns = {c: values[order] for c, values in columns.items()}
    opening = columns.pop("opening")
    accepted, balance = advance_all(columns["Wallet_ID"], columns["kind"] == DEBIT, columns["cents"], opening)
    return pd.DataFrame({**columns, "accepted": accepted, "balance": balance})


def _slices(spark: SparkSession, events: DataFrame, folder: str, slice_rows: int) -> DataFrame:
    """Write the events once, then cut them into slices of consecutive events.

    The first write runs the joins a single time: range partitioning reads its input twice, to sample and to
    move it. The second fixes the cut, so a lost executor cannot shift it.
    """
    events.write.parquet(f"{folder}/events")
    staged = spark.read.schema(EVENTS).parquet(f"{folder}/events")
    parts = -(-staged.count() // slice_rows) or 1
    (
        staged.repartitionByRange(parts, "Wallet_ID", *ORDER)
        .withColumn("slice", F.spark_partition_id())
        .write.partitionBy("slice")
        .parquet(f"{folder}/slices")
    )
    return spark.read.schema(f"{EVENTS}, slice int").parquet(f"{folder}/slices")


CHUNKS = (
    "Wallet_ID bigint, slice int, chunk int, opening bigint, need bigint, least bigint, net bigint, credits bigint, "
    "debit binary, cents binary"
)
OPENINGS = "Wallet_ID bigint, slice int, carried bigint"
ALWAYS = -(2**63)  # a chunk without debits passes with any balance


def _chunks(rows: pa.Table) -> pa.Table:
    """One wallet's events of one slice, in order, packed and summed up."""
    at = rows.column("at").to_numpy().view("int64")
    kind, id_, cents = (rows.column(c).to_numpy() for c in ("kind", "id", "cents"))
    order = np.lexsort((id_, kind, at))
    debit, cents = (kind == DEBIT)[order], cents[order]
    parts = []
    for number, a in enumerate(range(0, len(cents), CHUNK_ROWS)):
        d, c = debit[a : a + CHUNK_ROWS], cents[a : a + CHUNK_ROWS]
        net, credits = np.cumsum(np.where(d, -c, c)), np.cumsum(np.where(d, 0, c))
        need, least = (int(-net[d].min()), int((c - credits)[d].min())) if d.any() else (ALWAYS, ALWAYS)
        parts.append((number, need, least, int(net[-1]), int(credits[-1]), d.tobytes(), c.tobytes()))
    own = {c: [rows.column(c)[0].as_py()] * len(parts) for c in ("Wallet_ID", "slice")}
    opening = [int(rows.column("opening").to_numpy().min())] * len(parts)
    columns = dict(zip(("chunk", "need", "least", "net", "credits", "debit", "cents"), zip(*parts, strict=True), strict=True))
    names = ("Wallet_ID", "slice", "chunk", "opening", "need", "least", "net", "credits", "debit", "cents")
    kinds = (pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 5, pa.binary(), pa.binary())
    values = {**own, "opening": opening, **columns}
    return pa.table({n: pa.array(values[n], t) for n, t in zip(names, kinds, strict=True)})


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chains of a partition, chunk by chunk in order: the opening balance of every slice."""
    wallet, balance = None, 0
    for batch in batches:
        numbers = zip(*(batch.column(c).to_pylist() for c in range(8)), strict=True)
        found = []
        for i, (own, part, chunk, opening, need, least, net, credits) in enumerate(numbers):
            if own != wallet:
                wallet, balance = own, opening
            if chunk == 0:
                found.append((own, part, balance))
            if balance >= need:
                balance += net
            elif balance < least:
                balance += credits
            else:
                debit = np.frombuffer(batch.column(8)[i].as_py(), bool)
                balance = int(advance(debit, np.frombuffer(batch.column(9)[i].as_py(), np.int64), balance)[1][-1])
        kinds = (pa.int64(), pa.int32(), pa.int64())
        columns = list(zip(*found, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["Wallet_ID", "slice", "carried"]
        )


def openings(sliced: DataFrame) -> DataFrame:
    """Opening balance of every slice of every wallet that spans slices (``OPENINGS``)."""
    spans = (
        sliced.groupBy("Wallet_ID")
        .agg(F.min("slice").alias("first"), F.max("slice").alias("last"))
        .where(F.col("first") < F.col("last"))
        .select("Wallet_ID")
    )
    # A slice boundary can cut one wallet only: there are fewer such wallets than slices.
    events = sliced.join(F.broadcast(spans), "Wallet_ID", "left_semi")
    packed = events.groupBy("Wallet_ID", "slice").applyInArrow(_chunks, CHUNKS)
    ordered = packed.repartition("Wallet_ID").sortWithinPartitions("Wallet_ID", "slice", "chunk")
    return ordered.mapInArrow(_walk, OPENINGS)


def settle_events(spark: SparkSession, events: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """All events with ``accepted`` and the wallet's ``balance`` after them (both in the EVENTS order)."""
    folder = f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}"
    sliced = _slices(spark, events, folder, slice_rows)
    # Fewer than two rows per slice are joined to the slices.
    known = sliced.join(F.broadcast(openings(sliced)), ["Wallet_ID", "slice"], "left")
    known = known.withColumn("opening", F.coalesce("carried", "opening")).drop("carried")
    settled = known.groupBy("slice").applyInPandas(_settled_slice, SETTLED)
    settled.write.parquet(f"{folder}/settled")
    return spark.read.schema(SETTLED).parquet(f"{folder}/settled")


def settle(
    m: Marketplace,
    inserted: DataFrame,
    credits: DataFrame,
    as_of: datetime | None = None,
    slice_rows: int = SLICE_ROWS,
) -> Settlement:
    """Apply credits and the wallet payments among ``inserted`` to the wallets of ``m``."""
    requests = wallet_requests(m, inserted)
    settled = settle_events(m.spark, _events(m, requests, credits), slice_rows)
    debits = settled.where(F.col("kind") == DEBIT)
    decisions = debits.select(
        F.col("id").alias("Transaction_ID"),
        "Wallet_ID",
        _rupees("cents").alias("Amount"),
        "accepted",
        F.when(~F.col("accepted"), "insufficient_balance").alias("reason"),
        _rupees("balance").alias("balance_after"),
    ).unionByName(
        requests.where(F.col("Wallet_ID").isNull()).select(
            "Transaction_ID",
            "Wallet_ID",
            F.col("Amount").cast("decimal(18,2)").alias("Amount"),
            F.lit(False).alias("accepted"),
            F.lit("no_wallet").alias("reason"),
            F.lit(None).cast("decimal(18,2)").alias("balance_after"),
        )
    )
    moved = F.when(F.col("kind") == CREDIT, F.col("cents")).otherwise(-F.col("cents"))
    nets = settled.where("accepted").groupBy("Wallet_ID").agg(F.sum(moved).alias("moved"))
    wallets = keyed_update(
        m["wallet"], nets, "Wallet_ID", {"Balance": F.col("Balance") + _rupees("moved")}
    )
    now = F.localtimestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    last = m["wallet_transaction"].agg(F.coalesce(F.max("Transaction_ID"), F.lit(0))).scalar()
    ledger = dense_numbers(
        decisions.where("accepted").select("Wallet_ID", F.col("Transaction_ID").alias("payment"), "Amount"),
        "payment",
        "Transaction_ID",
        start=last + 1,
    ).select("Wallet_ID", "Transaction_ID", F.lit("Debit").alias("Type"), "Amount", now.alias("Date_Time"))
    return Settlement(decisions, wallets, ledger)
