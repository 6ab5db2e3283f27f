"""Toxicity by a factorization machine over hashed terms, trained and applied in numpy.

A term is a run of letters, digits and everything beyond ASCII, in lower case, hashed into one of ``BUCKETS``. A text
is cut evenly into windows of at most ``WINDOW`` terms; a window's features are the terms it has, however often. With a
weight and a vector for each term, a window's logit is

    offset + sum of weights + sum over pairs of terms of the product of their vectors,

so what a term means may depend on what else is there: a word that insults together with another one and is harmless
alone has a small weight and a vector that agrees with the other's. The sum over pairs is half of (square of the sum
of vectors, less the sum of their squares), linear in the number of terms. A text's score is the greatest probability
of its windows, so a passage counts in a text of any length.

Training uses a bounded sample: of each class the ``per_class`` labelled documents with the smallest hash of their
identifier and at most ``windows_per_document`` windows of each; at the defaults the driver holds under 60 MB. The
offset is then moved by the classes' shares among all labelled documents, so that scores are probabilities of the
corpus and not of the sample. Terms in fewer than ``least`` windows of the sample have neither weight nor vector, and
nor have terms that were never met or whose gradients are no more than chance. Everything else runs over all documents; the model that is broadcast is bounded by
the number of buckets.

``held_out`` documents (``crc32(identifier as text) mod folds`` equal to ``held_fold``) are never learned from. A NULL
identifier is neither held out nor learned from; labels other than 0 and 1 are passed over, and a label that is there
twice counts once. A NULL or empty text has no terms, its logit is the offset. Without labels of both classes the score
is the share of label 1 (0 without any label). Repeated rows get equal results. Language, source and identifier are
never inputs of a score. Columns that aren't named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm.language_id import fold_of
from tiffin.llm.words import utf8, word_bounds, word_hashes

BITS = 20
BUCKETS = 1 << BITS
WINDOW = 256
PIECE = 1 << 21  # bytes of texts that are worked on at once
TERM = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


@dataclass
class Windows:
    """Terms of windows one after the other; window i has ``term[first[i]:first[i + 1]]``, ascending, each once."""

    doc: np.ndarray
    first: np.ndarray
    term: np.ndarray


def _groups(texts: list[str | None]) -> Iterator[list[tuple[int, bytes]]]:
    """Texts in groups of about ``PIECE`` bytes; longer ones in pieces that end between terms."""
    group, size = [], 0
    for i, text in enumerate(texts):
        data = utf8(text and text.lower()).translate(TERM)
        at = 0
        while at < len(data) or at == 0:
            end = data.find(b" ", at + PIECE) if len(data) - at > PIECE else -1
            end = len(data) if end < 0 else end
            group.append((i, data[at:end]))
            size += end - at
            at = max(end, 1)
            if size >= PIECE:
                yield group
                group, size = [], 0
    if group:
        yield group


def windows_of(group: list[tuple[int, bytes]]) -> Windows:
    """Windows of a group's pieces; a piece without terms is a window without terms."""
    data = np.frombuffer(b" ".join([d for _, d in group]) + b" ", np.uint8)
    ends = np.cumsum([len(d) + 1 for _, d in group])
    start, end = word_bounds(data)
    piece = np.searchsorted(ends, start, "right")
    words = np.bincount(piece, minlength=len(group))
    count = np.maximum(1, -(-words // WINDOW))
    base = np.cumsum(count) - count
    place = np.arange(len(start)) - (np.cumsum(words) - words)[piece]
    window = base[piece] + place * count[piece] // np.maximum(words, 1)[piece]
    bucket = (word_hashes(data, start, end) >> np.uint64(64 - BITS)).astype(np.int64)
    own = np.unique((window << BITS) | bucket)
    first = np.searchsorted(own >> BITS, np.arange(int(count.sum()) + 1))
    return Windows(np.repeat([i for i, _ in group], count), first, (own & (BUCKETS - 1)).astype(np.int32))


@dataclass
class Machine:
    offset: float
    place: np.ndarray  # bucket -> row of weight and vectors, the last row for terms that are not known
    weight: np.ndarray
    vectors: np.ndarray

    def logits(self, w: Windows) -> np.ndarray:
        row = self.place[w.term]
        known = row < len(self.weight) - 1
        row, at = row[known], np.concatenate([[0], np.cumsum(known)])[w.first]
        linear, sums, squares = _sums(self.weight[row], self.vectors[row], at)
        return self.offset + linear + 0.5 * ((sums**2).sum(axis=1) - squares)


def _sums(weight: np.ndarray, vectors: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window: sum of weights, sum of vectors, sum of their squares."""
    n, size = len(first) - 1, vectors.shape[1]
    out = np.zeros((n, size + 2))
    full = np.flatnonzero(np.diff(first))
    if len(full):
        each = np.concatenate([weight[:, None], vectors, (vectors**2).sum(axis=1, keepdims=True)], axis=1)
        out[full] = np.add.reduceat(each, first[full], axis=0)
    return out[:, 0], out[:, 1:-1], out[:, -1]


def _probability(logit: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-logit))


def train(
    windows: list[np.ndarray],
    target: np.ndarray,
    size: int = 8,
    least: int = 8,
    epochs: int = 15,
    batch: int = 64,
    rate: float = 0.1,
    vector_rate: float = 0.05,
    shrink: float = 0.01,
    cost: float | None = None,
    seed: int = 5,
) -> Machine:
    """Fit on the cross-entropy; ``windows`` are the distinct buckets of each window.

    Weights follow the regularized leader: a term's weight is 0 until its gradients add up to more than ``cost``, which
    by default is the square root of the rarer class's windows, what chance adds up to. So a common word is no noise
    in a text of many windows. A term has a vector while its weight isn't 0; vectors are fitted by AdaGrad and shrink.
    """
    rng = np.random.default_rng(seed)
    lengths = np.array([len(w) for w in windows], np.int64)
    every = np.concatenate([np.asarray(w, np.int64) for w in windows]) if len(windows) else np.zeros(0, np.int64)
    often = np.bincount(every, minlength=BUCKETS) >= least
    n = int(often.sum())
    place = np.full(BUCKETS, n, np.int32)
    place[often] = np.arange(n)
    row, known = place[every], often[every]
    first = np.concatenate([[0], np.cumsum(known)])[np.concatenate([[0], np.cumsum(lengths)])]
    row = row[known]
    cost = np.sqrt(max(1, min(target.sum(), len(target) - target.sum()))) if cost is None else cost
    weight, pull, past = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    vectors, past_v = rng.normal(0, 0.05, (n + 1, size)), np.ones((n + 1, size))
    live = np.zeros(n + 1, bool)
    # The classes' shares to begin with, else all common words would learn them.
    offset, past_o = float(np.log((target.sum() + 1) / (len(target) - target.sum() + 1))), 1.0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for a in range(0, len(order), batch):
            own = order[a : a + batch]
            count = first[own + 1] - first[own]
            ends = np.cumsum(count)
            inside = np.repeat(first[own] - (ends - count), count) + np.arange(int(count.sum()))
            terms = row[inside]
            of = np.repeat(np.arange(len(own)), count)
            v = vectors[terms] * live[terms][:, None]
            linear, sums, squares = _sums(weight[terms], v, np.concatenate([[0], ends]))
            slope = _probability(offset + linear + 0.5 * ((sums**2).sum(axis=1) - squares)) - target[own]
            past_o += slope.sum() ** 2
            offset -= rate * slope.sum() / np.sqrt(past_o)
            met, back = np.unique(terms, return_inverse=True)
            g = slope[of]
            g_w = np.bincount(back, g, len(met))
            pull[met] += g_w - (np.sqrt(past[met] + g_w**2) - np.sqrt(past[met])) / rate * weight[met]
            past[met] += g_w**2
            over = np.sign(pull[met]) * np.maximum(np.abs(pull[met]) - cost, 0)
            weight[met] = -over / ((1 + np.sqrt(past[met])) / rate + 1)
            live[met] = over != 0
            g_v = g[:, None] * (sums[of] - v)
            g_v = np.stack([np.bincount(back, g_v[:, f], len(met)) for f in range(size)], axis=1)
            g_v = (g_v + shrink * vectors[met]) * live[met][:, None]
            past_v[met] += g_v**2
            vectors[met] -= vector_rate * g_v / np.sqrt(past_v[met])
    # What has no weight in the end is left out, so that the model is as small as what it has learned.
    kept = np.flatnonzero(live[:n])
    of_row = np.full(n + 1, len(kept), np.int32)
    of_row[kept] = np.arange(len(kept))
    rows = np.append(kept, n)
    vectors[n] = 0
    return Machine(offset, of_row[place], weight[rows].astype(np.float32), vectors[rows].astype(np.float32))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = 3,
    held_fold: int = 1,
    per_class: int = 3000,
    windows_per_document: int = 4,
) -> Machine:
    """Train on a bounded sample of labelled documents outside the held-out fold."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("mark"))
    marks = marks.where(F.col("id").isNotNull() & F.col("mark").isin(0, 1) & (fold_of(F.col("id"), folds) != held_fold)).distinct()
    counts = {r["mark"]: r["count"] for r in marks.groupBy("mark").count().collect()}
    if len(counts) < 2:
        nothing = np.zeros(BUCKETS, np.int32), np.zeros(1, np.float32), np.zeros((1, 1), np.float32)
        return Machine(np.inf if 1 in counts else -np.inf, *nothing)

    # Only identifiers whose hash lies under a bound are ordered: about four times as many as are taken, in each class.
    drawn = F.xxhash64(F.col("id").cast("string"))
    spread = F.shiftrightunsigned(drawn, 1) / F.lit(float(1 << 63))
    chosen = [
        marks.where((F.col("mark") == mark) & (spread < min(1.0, (4 * per_class + 100) / counts[mark])))
        .orderBy(drawn, "id")
        .limit(per_class)
        for mark in (0, 1)
    ]
    chosen = chosen[0].unionByName(chosen[1]).select(F.col("id").alias("_id"), "mark")
    texts = rows.join(F.broadcast(chosen), F.col("id") == F.col("_id")).select("id", "text", "mark")  # 2 per_class rows

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = (batch.column(i).to_pylist() for i in (0, 2))
            for group in _groups(batch.column(1).to_pylist()):
                w = windows_of(group)
                edge = np.flatnonzero(np.diff(w.doc, prepend=-1, append=-1))
                at = [edge[i] + np.linspace(0, b - 1, min(b, windows_per_document)).astype(int) for i, b in enumerate(np.diff(edge))]
                at = np.concatenate(at).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([str(ids[w.doc[i]]) for i in at], pa.string()),
                        pa.array([marks[w.doc[i]] for i in at], pa.int32()),
                        pa.array([w.term[w.first[i] : w.first[i + 1]].tobytes() for i in at], pa.binary()),
                    ],
                    ["id", "mark", "terms"],
                )

    # Identifiers that many rows share, or texts of many pieces, can't pass the limit either.
    sample = texts.mapInArrow(cut, "id string, mark int, terms binary").limit(2 * per_class * windows_per_document)
    found = sorted((r["id"], r["mark"], bytes(r["terms"])) for r in sample.collect())
    target = np.array([x[1] for x in found], np.float64)
    machine = train([np.frombuffer(x[2], np.int32) for x in found], target)
    ones = len({x[0] for x in found if x[1] == 1})
    zeros = len({x[0] for x in found if x[1] == 0})
    machine.offset += np.log(counts[1] / counts[0]) - np.log(max(1, ones) / max(1, zeros))
    return machine


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score: one row per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = np.full(batch.num_rows, -np.inf)
            for group in _groups(batch.column(1).to_pylist()):
                w = windows_of(group)
                np.maximum.at(most, w.doc, shared.value.logits(w))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_probability(most))], ["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, score double")


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = 3,
    held_fold: int = 1,
    threshold: float = 0.7,
) -> DataFrame:
    """Learn and score: identifier, held_out, score, predicted (1 from ``threshold`` on), one row per row of ``docs``."""
    machine = learn(docs, labels, id_col, text_col, label_col, folds, held_fold)
    held = F.coalesce(fold_of(F.col("id"), folds) == held_fold, F.lit(False))
    return score(docs, machine, id_col, text_col).select(
        F.col("id").alias(id_col), held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
