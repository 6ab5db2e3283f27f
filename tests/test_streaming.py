"""Streams fed file by file, stopped and restarted, against the batch jobs over all rows."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from tiffin.jobs import ledger, rating
from tiffin.streaming import ledger as ledger_stream
from tiffin.streaming import rating as rating_stream
from tiffin.streaming import refunds as refund_stream

START = datetime(2026, 1, 1)


def drop(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def follow(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.fixture
def folders(tmp_path):
    return str(tmp_path / "feed"), str(tmp_path / "out")


def test_ratings(spark, folders):
    feed, out = folders
    schema = "before struct<Restaurant_ID:bigint,Rating:float>, after struct<Restaurant_ID:bigint,Rating:float>"
    dice, stored, changes = random.Random(1), [], []
    for _ in range(300):
        before = stored.pop(dice.randrange(len(stored))) if stored and dice.random() < 0.4 else None
        after = (dice.randrange(8), dice.randrange(10, 51) / 10) if before is None or dice.random() < 0.5 else None
        stored += [after] if after else []
        changes.append((before, after))
    for lo, hi in [(0, 100), (100, 200), (200, 300)]:
        for part in range(lo, hi, 50):
            drop(spark, feed, changes[part : part + 50], schema)
        rating_stream.start(follow(spark, feed, schema), out).awaitTermination()
        if lo < 200:
            rating_stream.fold(spark, out)
    empty = spark.createDataFrame([], rating.STATE)
    batch = rating.apply_changes(empty, spark.createDataFrame(changes, schema))
    streamed = rating_stream.state(spark, out)
    assert {tuple(r) for r in streamed.collect()} == {tuple(r) for r in batch.collect()}


def test_refund_credits_fall_due_once(spark, folders):
    feed, out = folders

    def change(refund, before, after, hour):
        images = [None if s is None else (refund, 1, Decimal("5.00"), s) for s in (before, after)]
        return (*images, START + timedelta(hours=hour))

    done = change(1, "Pending", "Completed", 2)
    files = [
        [change(1, None, "Pending", 0), change(2, None, "Completed", 0), change(3, "Pending", "Completed", 1)],
        [done, change(2, "Completed", "Completed", 2), change(4, None, "Pending", 2)],
        [done, change(3, "Pending", "Completed", 1)],  # sent again
        [change(4, "Pending", "Rejected", 3), change(4, "Rejected", "Completed", 4)],
        [change(4, "Completed", "Pending", 5), change(4, "Pending", "Completed", 6)],
    ]
    for rows in files:
        drop(spark, feed, rows, refund_stream.FEED)
        refund_stream.start(follow(spark, feed, refund_stream.FEED), out).awaitTermination()
    credits = refund_stream.credits(spark, out).collect()
    due = sorted((r.Refund_ID, (r.at - START) // timedelta(hours=1)) for r in credits)
    assert due == [(1, 2), (3, 1), (4, 4), (4, 6)]


def wallet_events(seed, n=400, spread=0):
    """Events in about the order of their times, at most ``spread`` minutes off."""
    dice = random.Random(seed)
    events = []
    for k in range(n):
        wallet = 3 if dice.random() < 0.4 else dice.randrange(12)
        kind = ledger.CREDIT if dice.random() < 0.4 else ledger.DEBIT
        minute = max(0, k - dice.randrange(spread + 1))
        events.append((wallet, START + timedelta(minutes=minute), kind, k, dice.randrange(1, 400), 500))
    return events


def test_wallets_in_event_time_equal_the_batch_job(spark, folders):
    """Out of order within the delay, several micro-batches a run, and a restart after each run."""
    feed, out = folders
    events = wallet_events(2, spread=50)
    for lo in range(0, 400, 100):
        drop(spark, feed, events[lo : lo + 50], ledger.EVENTS)
        drop(spark, feed, events[lo + 50 : lo + 100], ledger.EVENTS)
        query = ledger_stream.start([follow(spark, feed, ledger.EVENTS)], out, "60 minutes", 7 * 60_000, stores=3)
        query.awaitTermination()
        done = ledger_stream.settled(spark, out).count()
        assert lo <= done < len(events)  # what lies behind the watermark, no more
    ledger_stream.tick(spark, out)
    ledger_stream.start([follow(spark, feed, ledger.EVENTS)], out, "60 minutes", 7 * 60_000).awaitTermination()
    streamed = ledger_stream.settled(spark, out)
    batch = ledger.settle_events(spark, spark.createDataFrame(events, ledger.EVENTS), slice_rows=30)
    assert {tuple(r) for r in streamed.collect()} == {tuple(r) for r in batch.collect()}
    assert not all(r.accepted for r in batch.collect())
    assert ledger_stream.late(spark, out).count() == 0
    last = {(r.Wallet_ID, r.balance) for r in ledger_stream.balances(spark, out).collect()}
    assert len(last) == len({e[0] for e in events}) and last <= {(r.Wallet_ID, r.balance) for r in batch.collect()}


def test_late_wallet_events_go_aside(spark, folders):
    feed, out = folders
    at = lambda hour: START + timedelta(hours=hour)
    run = lambda: ledger_stream.start([follow(spark, feed, ledger.EVENTS)], out, "1 hour", 60_000, stores=2).awaitTermination()
    drop(spark, feed, [(1, at(1), 0, 10, 50, 0), (1, at(5), 1, 11, 20, 0), (None, at(5), 0, 12, 1, 0)], ledger.EVENTS)
    run()
    drop(spark, feed, [(1, at(0), 1, 13, 50, 0), (1, None, 0, 14, 9, 0), (2, at(2), 0, 15, 9, 0), (1, at(4.5), 1, 16, 40, 0)], ledger.EVENTS)
    run()
    ledger_stream.tick(spark, out)
    run()
    late = {(r.Wallet_ID, r.at, r.id) for r in ledger_stream.late(spark, out).collect()}
    assert late == {(1, at(0), 13), (1, None, 14), (2, at(2), 15)}
    done = [(r.id, r.accepted, r.balance) for r in ledger_stream.settled(spark, out).orderBy("at").collect()]
    assert done == [(10, True, 50), (16, True, 10), (11, False, 10)]


def test_two_feeds_share_one_clock(spark, folders):
    """Credits and debits come by feeds of their own, one far behind the other; nothing is late."""
    feed, out = folders
    events = wallet_events(5)
    kinds = [[e for e in events if e[2] == kind] for kind in (ledger.CREDIT, ledger.DEBIT)]
    run = lambda: ledger_stream.start(
        [follow(spark, f"{feed}-{k}", ledger.EVENTS) for k in (0, 1)], out, "1 minute", 60_000, stores=2
    ).awaitTermination()
    drop(spark, f"{feed}-0", kinds[0], ledger.EVENTS)  # all credits before the first debit
    drop(spark, f"{feed}-1", kinds[1][:5], ledger.EVENTS)
    run()
    drop(spark, f"{feed}-1", kinds[1][5:], ledger.EVENTS)
    run()
    ledger_stream.tick(spark, out)
    run()
    batch = ledger.settle_events(spark, spark.createDataFrame(events, ledger.EVENTS))
    assert {tuple(r) for r in ledger_stream.settled(spark, out).collect()} == {tuple(r) for r in batch.collect()}
    assert ledger_stream.late(spark, out).count() == 0


def test_wallets_of_a_bucket_settle_in_one_call(spark, folders, monkeypatch):
    """However many wallets share a bucket, one call settles them and none touches another, whatever its numbers."""
    feed, out = folders
    monkeypatch.setattr(ledger_stream, "BUCKETS", 1)
    dice = random.Random(7)
    events = [
        (dice.randrange(300), START + timedelta(minutes=k), dice.randrange(2), 2**60 + k, dice.randrange(1, 400), k % 7)
        for k in range(1500)
    ]
    opening = {}
    for e in events:
        opening.setdefault(e[0], e[5])
    events = [(*e[:5], opening[e[0]]) for e in events]
    odd = [(1000, START, 0, None, 5, 0), (1001, None, 0, 1, 5, 0), (None, START, None, None, None, None)]
    drop(spark, feed, events[:700] + odd, ledger.EVENTS)
    drop(spark, feed, events[700:] + events[690:710], ledger.EVENTS)  # some are sent again
    run = lambda: ledger_stream.start([follow(spark, feed, ledger.EVENTS)], out, "2 days", 3_600_000, stores=2)
    run().awaitTermination()
    ledger_stream.tick(spark, out)
    query = run()
    query.awaitTermination()
    assert sum(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= 60  # 25 slots, one balance
    batch = {tuple(r) for r in ledger.settle_events(spark, spark.createDataFrame(events, ledger.EVENTS)).collect()}
    streamed = ledger_stream.settled(spark, out)
    assert {tuple(r) for r in streamed.where("Wallet_ID < 1000").collect()} == batch
    assert streamed.count() == len(batch) + 1
    assert [r.Wallet_ID for r in ledger_stream.late(spark, out).collect()] == [1001]


def test_a_wallet_event_without_an_amount_stops_the_stream(spark, folders):
    feed, out = folders
    drop(spark, feed, [(1, START, 0, 1, 5, 0), (2, START, 0, 2, None, 0)], ledger.EVENTS)
    with pytest.raises(Exception, match="a wallet event has no cents"):
        ledger_stream.start([follow(spark, feed, ledger.EVENTS)], out, "1 hour", 60_000, stores=1).awaitTermination()


def test_wallet_debits_do_not_depend_on_files(spark, small, tmp_path):
    """The registered stream gives the same rows from one file and from 24 files in no order."""
    import __spark_entry__ as registered

    events = spark.read.parquet(f"{small}/events.parquet")
    events.orderBy("value", "event_id").repartition(24).write.parquet(str(tmp_path / "events.parquet"))
    query = registered.queries()["w03_wallet_debit_stream"]
    one, many = (sorted(map(tuple, query(spark, d).collect())) for d in (small, str(tmp_path)))
    assert one == many
