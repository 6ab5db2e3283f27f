"""Ranked lexical search by one scan of the texts with an automaton of all items' terms; documents aren't indexed.

Terms are the maximal runs of letters, digits and everything beyond ASCII, with A-Z in lower case. The distinct terms
of all items make one Aho-Corasick automaton, each between two guards (a blank, which no term holds), so that it tells
whole terms only; text is brought into the same form, one blank for each character that is in no term. The scan gives a
document's term frequencies, and a term's output leads to the items that have it.

Two scans. The first counts documents with a term, all terms, and each item term's documents. The second scores:
with N documents, L terms of all, n terms of a document, tf and df of a term, whole numbers throughout,

* w = floor(1000 ln((2 N + 2) / (2 df + 1))), the logarithm in doubles,
* m = 100 - 50 + (50 n N) div L,
* score = sum over the item's distinct terms of w * ((1000000000 tf) div (1000 tf + 20 m)).

Scale. Only the automaton and its weights are broadcast, for a block of items whose terms take at most about
``block_bytes`` and that are at most about ``block_items``; more items are more blocks, each with scans of its own. A
task keeps the k best of each item, so a task hands on at most k rows an item, whatever it read; these are merged
first by groups of tasks, then by item. What a lost executor held is scanned again.

Items are told apart by a hash of identifier and text: a NULL identifier is one like any other, items that share an
identifier each have their own ranks from 1, and an item row that is there twice gives its rows twice. An item without
terms, or without a document that scores, has no rows; NULL and empty texts have no terms. Equal scores go by
ascending identifier, NULL last; rows that share an identifier are documents of their own. Very long texts are scanned
in pieces that end between terms. Empty tables give no rows. Columns that aren't named are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.words import utf8
from tiffin.session import stage

LONG = 64
PIECE = 1 << 20  # bytes of a text that are scanned at once, and on to the end of the term
TASKS = 256  # tasks whose best are merged first
# A byte of a term as it is, A-Z in lower case; any other byte a blank.
FORM = bytes(b | 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def formed(text: str | None) -> bytes:
    return utf8(text).translate(FORM)


def _pieces(data: bytes) -> Iterator[str]:
    """The form between guards, cut at blanks. One character a byte, so that any bytes can be told apart."""
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE) if len(data) - at > PIECE else -1
        end = len(data) if end < 0 else end
        yield f" {data[at:end].decode('latin-1')} "
        at = end


class Scan:
    """Tells the place in a list of terms of each term in a text. Terms of more than ``LONG`` bytes would make the
    automaton deep; a text's few terms of that length are looked up."""

    def __init__(self, terms: list[bytes]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.automaton.add_word("  ", -1)  # an automaton of nothing can't be used; blanks in a row tell nothing
        for i, term in enumerate(terms):
            if len(term) <= LONG:
                self.automaton.add_word(f" {term.decode('latin-1')} ", i)
        self.automaton.make_automaton()
        self.long = {term: i for i, term in enumerate(terms) if len(term) > LONG}

    def frequencies(self, text: str | None) -> tuple[int, Counter]:
        """Number of terms of a text, and how often it has each of the listed terms."""
        data = formed(text)
        found: Counter = Counter()
        for piece in _pieces(data):
            found.update([i for _, i in self.automaton.iter(piece)])
        found.pop(-1, None)
        own = data.split()
        if self.long:
            found.update([self.long[t] for t in own if len(t) > LONG and t in self.long])
        return len(own), found


class _Block:
    """Items that are searched together: their terms, and the items of each."""

    def __init__(self, rows: list[tuple[str, bytes]]):
        self.keys = sorted({k for k, _ in rows})
        self.terms = sorted({t for _, t in rows})
        place, term = ({x: i for i, x in enumerate(xs)} for xs in (self.keys, self.terms))
        pairs = np.array(sorted({(term[t], place[k]) for k, t in rows}), dtype=np.int64).reshape(-1, 2)
        self.items = pairs[:, 1]
        self.first = np.searchsorted(pairs[:, 0], np.arange(len(self.terms) + 1))


def _count(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, scan = shared.value
        holding, total, df = 0, 0, np.zeros(len(block.terms), np.int64)
        for batch in batches:
            for text in batch.column(1).to_pylist():
                n, found = scan.frequencies(text)
                holding, total = holding + (n > 0), total + n
                df[list(found)] += 1
        term = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-2, -1, *term.tolist()], pa.int64()), pa.array([holding, total, *df[term].tolist()], pa.int64())], ["term", "c"]
        )

    return run


class _Best:
    """The k best documents of each item that a task has met."""

    def __init__(self, items: int, k: int):
        self.k, self.bar = k, np.ones(items, np.int64)  # a score of 0 is none
        self.kept = [np.zeros((0, 4), np.int64)]  # item, score, NULL identifier, identifier
        self.size = 0
        self.room = max(1 << 16, 2 * k * items)

    def add(self, item: np.ndarray, score: np.ndarray, unknown: np.ndarray, id_: np.ndarray) -> None:
        self.kept.append(np.stack([item, score, unknown, id_], axis=1))
        self.size += len(item)
        if self.size > self.room:
            self.cut()

    def cut(self) -> np.ndarray:
        all_ = np.concatenate(self.kept)
        all_ = all_[np.lexsort((all_[:, 3], all_[:, 2], -all_[:, 1], all_[:, 0]))]
        first = np.searchsorted(all_[:, 0], np.arange(len(self.bar)))
        place = np.arange(len(all_)) - first[all_[:, 0]]
        last = all_[place == self.k - 1]
        self.bar[last[:, 0]] = last[:, 1]
        self.kept, self.size = [all_[place < self.k]], 0
        return self.kept[0]


def _score(shared, weights, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (block, scan), (holding, total, weight) = shared.value, weights.value
        items, degree = len(block.keys), np.diff(block.first)
        best = _Best(items, k)
        docs: list[tuple] = []
        entries = []

        def settle() -> None:
            """Scores of the documents at hand for all items at once."""
            if not entries:
                return
            doc, term, tf, m = (np.concatenate(x) for x in zip(*entries, strict=True))
            value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            times = degree[term]
            into = np.repeat(block.first[term] - (np.cumsum(times) - times), times) + np.arange(times.sum())
            cell = np.repeat(doc, times) * items + block.items[into]
            value = np.repeat(value, times)
            # Sums of doubles are exact for halves of 24 bits each.
            high, low = (np.bincount(cell, x, len(docs) * items).astype(np.int64) for x in (value >> 24, value & 0xFFFFFF))
            score = (high << 24) + low
            found = np.flatnonzero(score.reshape(len(docs), items) >= best.bar)
            of = np.array([x is None for x in docs]), np.array([x or 0 for x in docs], np.int64)
            best.add(found % items, score[found], *(x[found // items].astype(np.int64) for x in of))

        waiting = 0
        for batch in batches:
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n, found = scan.frequencies(text)
                if not found:
                    continue
                term = np.fromiter(found, np.int64, len(found))
                m = 50 + (50 * n * holding) // total
                entries.append((np.full(len(term), len(docs)), term, np.fromiter(found.values(), np.int64, len(found)), np.full(len(term), m)))
                docs.append(id_)
                waiting += int(degree[term].sum())
                if waiting >= 1 << 20 or len(docs) * items >= 1 << 21:
                    settle()
                    docs, waiting = [], 0
                    entries.clear()
        settle()
        rows, part = best.cut(), TaskContext.get().partitionId()
        for i in range(0, len(rows), 1 << 16):
            item, score, unknown, id_ = rows[i : i + (1 << 16)].T
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block.keys[x] for x in item], pa.string()),
                    pa.array(id_, pa.int64(), mask=unknown.astype(bool)),
                    pa.array(score, pa.int64()),
                    pa.array(np.full(len(item), part // TASKS), pa.int64()),
                ],
                ["key", "id", "score", "part"],
            )

    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = [sorted(set(formed(t).split())) for t in batch.column(1).to_pylist()]
        keys = [k for k, terms in zip(batch.column(0).to_pylist(), own, strict=True) for _ in terms]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([t for terms in own for t in terms], pa.binary())], ["key", "term"])


def _best_of(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = 1 << 20,
    block_items: int = 1 << 12,
) -> DataFrame:
    """item_id_col, rank (int, from 1), id_col, score (bigint): each item's k documents of the highest score above 0."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    given = items.select(F.col(item_id_col).cast("bigint").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    key = F.sha2(F.concat(F.coalesce(F.col("item").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit(""))), 256)
    keyed = given.withColumn("key", key)
    named = stage(keyed.groupBy("key").agg(F.min("item").alias("item"), F.count("*").alias("copies")), "items")
    terms = keyed.dropDuplicates(["key"]).select("key", "text").mapInArrow(_item_terms, "key string, term binary")
    terms = stage(terms, "item-terms")
    size, count = terms.agg(F.sum(F.octet_length("term") + 16), F.count_distinct("key")).first()
    blocks = min(count, max(-(-(size or 0) // block_bytes), -(-count // block_items)))
    parts = []
    for number in range(blocks):
        part = terms.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == number).collect()  # about block_bytes
        if not part:
            continue
        block = _Block([(r["key"], bytes(r["term"])) for r in part])
        shared = spark.sparkContext.broadcast((block, Scan(block.terms)))
        counts = rows.mapInArrow(_count(shared), "term bigint, c bigint").groupBy("term").agg(F.sum("c").alias("c"))
        counted = {r["term"]: r["c"] for r in counts.collect()}  # a row per term of the block
        holding, total = counted.get(-2, 0), counted.get(-1, 0)
        df = [counted.get(i, 0) for i in range(len(block.terms))]
        weight = np.array([math.floor(1000 * math.log((2 * holding + 2) / (2 * x + 1))) for x in df], np.int64)
        weights = spark.sparkContext.broadcast((holding, total, weight))
        found = rows.mapInArrow(_score(shared, weights, k), "key string, id bigint, score bigint, part bigint")
        parts.append(stage(_best_of(_best_of(found, k, "key", "part"), k, "key"), "found"))
        shared.unpersist()  # the block's result is written
        weights.unpersist()
    out = f"{item_id_col} bigint, rank int, {id_col} bigint, score bigint"
    if not parts:
        return spark.createDataFrame([], out)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return found.join(named, "key").withColumn("_copy", copies).select(
        F.col("item").alias(item_id_col), "rank", F.col("id").alias(id_col), "score"
    )
