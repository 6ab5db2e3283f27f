"""Language identification by a convolutional network over bytes, trained and applied in numpy.

Network: a vector for each byte, filters of several widths with a rectifier, the maximum of each filter over a window
of fixed length, and a softmax. A text is cut into windows that together cover all of it; its prediction is the mean of
the windows' probabilities, weighted by their bytes, so a text of any length counts as a whole.

Training uses a bounded sample: the ``per_language`` documents of each language with the smallest hash of their
identifier and at most ``windows_per_document`` windows of each, for at most ``max_languages`` languages (the most
frequent). Those three parameters bound what the driver holds; at the defaults that is under 80 MB. Everything else
runs over all documents. For application the byte vectors are folded into the filters: a filter's response is a sum of
table entries for pairs of neighbouring bytes, so that a batch of windows is a few array look-ups.

``held_out`` documents (``crc32(identifier as text) mod folds`` equal to ``held_fold``) are never learned from. A NULL
identifier is neither held out nor learned from. NULL text and text without a letter are ``und`` with score 0, and so
is everything if there is nothing to learn from. The language column is read for learning only; source and identifier
are never inputs. Repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.llm.words import give_back, utf8, values

WINDOW = 256
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def windows_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Windows that cover all bytes, and the bytes each stands for. The last one is padded with zeros."""
    n = max(1, -(-len(data) // WINDOW))
    padded = np.zeros(n * WINDOW, dtype=np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    share = np.full(n, WINDOW)
    share[-1] = len(data) - (n - 1) * WINDOW
    return padded.reshape(n, WINDOW), share


@dataclass
class Network:
    labels: list[str]
    vectors: np.ndarray  # byte -> vector
    filters: dict[int, np.ndarray]  # width -> (width * vector, filters)
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def fold(self) -> list[tuple[list[np.ndarray], np.ndarray | None]]:
        """For each width: a table over byte pairs for every two places, and one over bytes for an odd last place."""
        size, out = self.vectors.shape[1], []
        for width, f in self.filters.items():
            place = [(self.vectors @ f[j * size : (j + 1) * size]).astype(np.float32) for j in range(width)]
            pairs = [(place[j + 1][:, None, :] + place[j][None, :, :]).reshape(1 << 16, -1) for j in range(0, width - 1, 2)]
            out.append((pairs, place[-1] if width % 2 else None))
        return out

    def probabilities(self, windows: np.ndarray, tables) -> np.ndarray:
        out = []
        for i in range(0, len(windows), 512):
            x = windows[i : i + 512]
            two = x[:, :-1].astype(np.int32) | (x[:, 1:].astype(np.int32) << 8)
            best = []
            for width, (pairs, last) in zip(self.filters, tables, strict=True):
                n = WINDOW - width + 1
                total = pairs[0][two[:, :n]]
                for k, table in enumerate(pairs[1:], 1):
                    total += table[two[:, 2 * k : 2 * k + n]]
                if last is not None:
                    total += last[x[:, width - 1 :]]
                best.append(total.max(axis=1))
            hidden = np.maximum(np.concatenate(best, axis=1) + self.bias, 0)
            out.append(_softmax(hidden @ self.dense + self.offset))
        return np.concatenate(out)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(
    windows: np.ndarray, target: np.ndarray, labels: list[str], widths=(2, 3, 4), filters=16, size=8, steps=400, seed=3
) -> Network:
    """Fit by Adam on the cross-entropy. The gradient of a maximum goes to the place where it was."""
    rng = np.random.default_rng(seed)
    p = {
        "vectors": rng.normal(0, 0.5, (256, size)),
        "bias": np.zeros(filters * len(widths)),
        "dense": rng.normal(0, 0.2, (filters * len(widths), len(labels))),
        "offset": np.zeros(len(labels)),
    } | {w: rng.normal(0, 0.5 / np.sqrt(w * size), (w * size, filters)) for w in widths}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step = 0
    while step < steps:
        order = rng.permutation(len(windows))
        for i in range(0, len(order), 64):
            rows = order[i : i + 64]
            x, y = windows[rows], target[rows]
            vec = p["vectors"][x]
            hidden, where = [], []
            for w in widths:
                n = WINDOW - w + 1
                response = sum(vec[:, j : j + n] @ p[w][j * size : (j + 1) * size] for j in range(w))
                at = response.argmax(axis=1)
                where.append(at)
                hidden.append(np.take_along_axis(response, at[:, None, :], axis=1)[:, 0])
            z = np.concatenate(hidden, axis=1) + p["bias"]
            h = np.maximum(z, 0)
            d_out = _softmax(h @ p["dense"] + p["offset"])
            d_out[np.arange(len(y)), y] -= 1
            d_out /= len(y)
            d_h = (d_out @ p["dense"].T) * (z > 0)
            g = {"dense": h.T @ d_out, "offset": d_out.sum(0), "bias": d_h.sum(0), "vectors": np.zeros_like(p["vectors"])}
            for k, w in enumerate(widths):
                own = d_h[:, k * filters : (k + 1) * filters]
                places = where[k][:, :, None] + np.arange(w)
                b = np.arange(len(x))[:, None, None]
                patch = vec[b, places].reshape(len(x), filters, w * size)
                g[w] = np.einsum("bf,bfd->df", own, patch)
                back = (own[:, :, None] * p[w].T[None]).reshape(len(x), filters, w, size)
                np.add.at(g["vectors"], x[b, places], back)
            step += 1
            for k in p:
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                p[k] -= 0.005 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Network(labels, p["vectors"], {w: p[w] for w in widths}, p["bias"], p["dense"], p["offset"])


def fold_of(id_: Column, folds: int) -> Column:
    return F.crc32(id_.cast("string").cast("binary")) % folds


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 3,
    held_fold: int = 1,
    per_language: int = 400,
    windows_per_document: int = 4,
    max_languages: int = 256,
) -> Network | None:
    """Train on a bounded sample of labelled documents outside the held-out fold. None if there are none."""
    # An identifier is used for drawing the sample only.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang"))
    labelled = rows.where(F.col("lang").isNotNull() & (fold_of(F.col("id"), folds) != held_fold))
    frequent = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages)
    counts = {r["lang"]: r["count"] for r in frequent.collect()}
    labels = sorted(counts)
    # Of each language only identifiers whose hash lies under a bound are ordered, about four times as many as are
    # taken, and each once: no language and no identifier is more than that to a task.
    drawn = F.xxhash64(F.col("id").cast("string"))
    bounds = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, (4 * per_language + 100) / n))])
    bound = bounds[F.col("lang")] if counts else F.lit(0.0)
    under = F.shiftrightunsigned(drawn, 1) / F.lit(float(1 << 63)) < bound
    candidates = labelled.where(F.col("lang").isin(labels) & under).select("id", "lang").distinct()
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64(F.col("id").cast("string")), "id")
    chosen = (
        candidates.select("id", "lang", F.row_number().over(by_hash).alias("n"))
        .where(F.col("n") <= per_language)
        .select(F.col("id").alias("_id"), F.col("lang").alias("_lang"))
    )
    texts = labelled.where(F.col("text").isNotNull()).join(
        F.broadcast(chosen), (F.col("id") == F.col("_id")) & (F.col("lang") == F.col("_lang"))
    )  # at most max_languages * per_language rows are broadcast

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, langs, out = [], [], []
            for id_, text, lang in zip(batch.column(0).to_pylist(), values(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                if _LETTER.search(text):
                    windows, share = windows_of(utf8(text).lower())
                    windows = windows[share >= min(64, share.max())]
                    for w in windows[np.linspace(0, len(windows) - 1, min(len(windows), windows_per_document)).astype(int)]:
                        ids.append(str(id_))
                        langs.append(lang)
                        out.append(w.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(langs, pa.string()), pa.array(out, pa.binary())], ["id", "lang", "window"])

    sample = texts.select("id", "text", "lang").mapInArrow(cut, "id string, lang string, window binary")
    limit = max(1, len(labels)) * per_language * windows_per_document  # repeated identifiers can't pass it either
    found = sorted((r["lang"], r["id"], bytes(r["window"])) for r in sample.limit(limit).collect())
    if not found:
        return None
    labels = sorted({x[0] for x in found})
    number = {x: i for i, x in enumerate(labels)}
    windows = np.stack([np.frombuffer(x[2], np.uint8) for x in found])
    return train(windows, np.array([number[x[0]] for x in found]), labels)


def predict(docs: DataFrame, network: Network | None, text_col: str = "text") -> DataFrame:
    """``docs`` with two more columns, lang_pred and score. Columns of those names must not exist."""
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(network)  # some ten thousand numbers, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        tables = net.fold() if net else None
        for batch in batches:
            pred, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            texts = enumerate(values(batch.column(names.index(text_col)))) if net else ()
            spoken = ((i, t) for i, t in texts if t and _LETTER.search(t))
            for group, own in _by_bytes(spoken):
                cut = [windows_of(utf8(t).lower()) for t in own]
                p = net.probabilities(np.concatenate([c[0] for c in cut]), tables)
                p *= np.concatenate([c[1] for c in cut])[:, None]
                first = np.cumsum([0] + [len(c[0]) for c in cut])[:-1]
                mean = np.add.reduceat(p, first, axis=0)
                mean /= mean.sum(axis=1, keepdims=True)
                for i, m in zip(group, mean, strict=True):
                    pred[i], score[i] = net.labels[int(m.argmax())], min(1.0, float(m.max()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pred, pa.string()), pa.array(score)], [*names, "lang_pred", "score"]
            )
        del tables
        give_back()

    more = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*docs.schema.fields, *more])
    return docs.mapInArrow(run, schema)


def _by_bytes(rows: Iterable[tuple[int, str]], most: int = 1 << 20) -> Iterator[tuple[list[int], list[str]]]:
    """Rows and their texts in groups of about ``most`` characters, so that arrays stay small; a longer text is a group
    of its own."""
    group, texts, size = [], [], 0
    for i, text in rows:
        if group and size + len(text) > most:
            yield group, texts
            group, texts, size = [], [], 0
        group.append(i)
        texts.append(text)
        size += len(text)
    if group:
        yield group, texts


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3, held_fold: int = 1) -> DataFrame:
    """Learn and predict: identifier, held_out, lang_pred, score, one row per row of ``docs``."""
    network = learn(docs, id_col, text_col, lang_col, folds, held_fold)
    out = predict(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), network)
    held = F.coalesce(fold_of(F.col("id"), folds) == held_fold, F.lit(False))
    return out.select(F.col("id").alias(id_col), held.alias("held_out"), "lang_pred", "score")
