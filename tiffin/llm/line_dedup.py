"""Line deduplication by a sharded minimal perfect hash.

Lines are compared by key: the line without white space at both ends and with A-Z in lower case. A key of at least
``min_chars`` code points that is found in at least ``min_docs`` documents loses all its lines except in the largest
identifier that holds it.

1. Each batch of documents gives one row per distinct key: a 128-bit hash, the number of documents and the largest
   identifier. A key that a third of the corpus holds is one row per batch. Rows are summed per hash and those with
   enough documents are written to the shared folder.
2. Hashes are dealt to shards of some 65,536 keys. Each shard gets a minimal perfect hash (bit arrays with ranks, some
   three bits a key) and, in its order, arrays of 64-bit fingerprints, counts and largest identifiers. Position and
   fingerprint come from different halves of the hash: a foreign line passes with probability 2^-64.
3. Documents probe the arrays. Keys held by more than 1/``broadcast_keys`` of all repeated lines number fewer than
   ``broadcast_keys``; their arrays (about 21 bytes a key, so bounded) are broadcast, and the hottest lines are thus
   settled where the documents are. Hashes of the other lines go to the shard that holds their array; none of those is
   hot. What a shard finds goes back by document.

A document is a row. NULL and empty text count as one empty line. A NULL identifier is below all others: its lines stay
only if no document with an identifier holds them. Rows that share an identifier all count, and all keep the line if
the identifier is the largest. Columns other than the identifier and the text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm.words import SPACES, mix, utf8
from tiffin.session import stage

SHARD_KEYS = 1 << 16
NOBODY = -(1 << 63)


def line_key(line: str, min_chars: int) -> bytes | None:
    """Hash of a line's key, None if the key is too short."""
    if len(line) < min_chars:
        return None
    key = line.strip(SPACES)
    return xxhash.xxh3_128_digest(utf8(key).lower()) if len(key) >= min_chars else None  # bytes: A-Z only


class PerfectHash:
    """Minimal perfect hash of 128-bit keys given as two arrays.

    Each level is a bit array twice as long as the keys left. A key that has a bit to itself is settled there, keys
    that meet go on to the next level. A key's number is the rank of its bit.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.base, seen = [], 0
        for words in levels:
            ranks = np.cumsum(np.bitwise_count(words), dtype=np.int64)
            self.base.append(np.concatenate(([0], ranks[:-1])) + seen)
            seen += int(ranks[-1])

    @staticmethod
    def _bit(low: np.ndarray, level: int, words: int) -> np.ndarray:
        return mix(low + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) % np.uint64(words * 64)

    @classmethod
    def build(cls, low: np.ndarray) -> PerfectHash:
        levels: list[np.ndarray] = []
        while len(low):
            words = (2 * len(low) + 63) // 64
            bit = cls._bit(low, len(levels), words)
            alone = np.bincount(bit.astype(np.int64), minlength=words * 64) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            low = low[~alone[bit]]
            if len(levels) > 100:
                raise ValueError("two keys of a shard are equal")
        return cls(levels)

    def index(self, low: np.ndarray) -> np.ndarray:
        """Number of each key; -1 where no level has its bit. Foreign keys get a number too."""
        out = np.full(len(low), -1, dtype=np.int64)
        todo = np.arange(len(low))
        for level, words in enumerate(self.levels):
            bit = self._bit(low[todo], level, len(words))
            word, place = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
            here = (words[word] >> place) & np.uint64(1) == 1
            below = words[word[here]] & ((np.uint64(1) << place[here]) - np.uint64(1))
            out[todo[here]] = self.base[level][word[here]] + np.bitwise_count(below)
            todo = todo[~here]
        return out


class Shard:
    """Arrays of one shard: fingerprints, counts and largest identifiers in the order of its perfect hash."""

    def __init__(self, hash_: PerfectHash, fingerprint: np.ndarray, count: np.ndarray, last: np.ndarray):
        self.hash, self.fingerprint, self.count, self.last = hash_, fingerprint, count, last

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray, count: np.ndarray, last: np.ndarray) -> Shard:
        hash_ = PerfectHash.build(low)
        order = np.argsort(hash_.index(low))
        return cls(hash_, high[order], np.minimum(count[order], 2**32 - 1).astype("<u4"), last[order])

    def pack(self) -> tuple[list[bytes], bytes, bytes, bytes]:
        return ([x.tobytes() for x in self.hash.levels], self.fingerprint.tobytes(), self.count.tobytes(), self.last.tobytes())

    @classmethod
    def unpack(cls, levels, fingerprint, count, last) -> Shard:
        return cls(
            PerfectHash([np.frombuffer(x, "<u8") for x in levels]),
            np.frombuffer(fingerprint, "<u8"),
            np.frombuffer(count, "<u4"),
            np.frombuffer(last, "<i8"),
        )

    def probe(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is in the shard, and the largest identifier that holds it."""
        at = self.hash.index(low)
        found = at >= 0
        found[found] = self.fingerprint[at[found]] == high[found]
        last = np.full(len(low), NOBODY, dtype=np.int64)
        last[found] = self.last[at[found]]
        return found, last


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)
    return pairs[:, 0].copy(), pairs[:, 1].copy()


def _shard_of(high: np.ndarray, shards: int) -> np.ndarray:
    return ((high >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _count_keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[bytes, list[int]] = {}
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                doc = NOBODY if doc is None else doc
                for key in {line_key(line, min_chars) for line in (text or "").split("\n")} - {None}:
                    entry = seen.setdefault(key, [0, NOBODY])
                    entry[0] += 1
                    entry[1] = max(entry[1], doc)
            if seen:
                high, low = _halves(list(seen))
                count, last = np.array(list(seen.values()), dtype=np.int64).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (high.view(np.int64), low.view(np.int64), count, last)],
                    ["high", "low", "n", "last"],
                )

    return run


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    high, low = (pdf[c].to_numpy(np.int64).view(np.uint64) for c in ("high", "low"))
    shard = Shard.build(high, low, pdf["n"].to_numpy(np.int64), pdf["last"].to_numpy(np.int64))
    return pd.DataFrame([(int(pdf["shard"].iloc[0]), *shard.pack())], columns=["shard", *ARRAYS])


ARRAYS = ["levels", "fingerprint", "count", "largest"]
_SHARD = "shard bigint, levels array<binary>, fingerprint binary, count binary, largest binary"


def _shards(keys: DataFrame, n: int) -> DataFrame:
    """One row of arrays per shard. Hashes are even, so every shard has about the same number of keys."""
    number = F.shiftright(F.shiftrightunsigned("high", 32) * n, 32)
    return keys.withColumn("shard", number).groupBy("shard").applyInPandas(_build, _SHARD)


def _probe(hot: dict[int, Shard], hot_shards: int, min_chars: int, docs: list, texts: list):
    """Per row of a batch: its lines, the places of lines with a key and, for these, the hash and the hot answer."""
    lines = [(t or "").split("\n") for t in texts]
    row, place, digests = [], [], []
    for i, own in enumerate(lines):
        for j, line in enumerate(own):
            key = line_key(line, min_chars)
            if key is not None:
                row.append(i)
                place.append(j)
                digests.append(key)
    high, low = _halves(digests)
    found, last = np.zeros(len(high), dtype=bool), np.full(len(high), NOBODY, dtype=np.int64)
    of = _shard_of(high, max(hot_shards, 1)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    cuts = np.flatnonzero(np.diff(of[order])) + 1
    for part in np.split(order, cuts):
        if len(part) and (shard := hot.get(int(of[part[0]]))):
            found[part], last[part] = shard.probe(high[part], low[part])
    own = np.array([NOBODY if d is None else d for d in docs], dtype=np.int64)[np.array(row, dtype=np.int64)]
    return lines, np.array(row, dtype=np.int64), np.array(place, dtype=np.int64), high, low, found, found & (last != own)


def deduplicate_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
    broadcast_keys: int = 1 << 18,
) -> DataFrame:
    """Documents without repeated lines: identifier, text that is left, number of lines before, number dropped, and
    the SHA-256 of the text that is left (hexadecimal). One row per row of ``docs``; no documents give no rows."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = docs.mapInArrow(_count_keys(min_chars), "high bigint, low bigint, n bigint, last bigint")
    repeated = counted.groupBy("high", "low").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    keys = stage(repeated.where(F.col("n") >= min_docs), "line-keys")
    total = keys.agg(F.sum("n")).first()[0] or 0
    bar = total // broadcast_keys + 1  # at most broadcast_keys keys have that many lines
    n_hot, n_cold = keys.agg(F.count_if(F.col("n") >= bar), F.count_if(F.col("n") < bar)).first()

    hot_shards = -(-n_hot // SHARD_KEYS)
    hot_rows = _shards(keys.where(F.col("n") >= bar), hot_shards).collect() if n_hot else []
    arrays = spark.sparkContext.broadcast({r["shard"]: tuple(r[c] for c in ARRAYS) for r in hot_rows})
    schema = "id bigint, kept string, n_lines bigint, n_dropped bigint, kept_sha256 string"
    if not n_cold:
        return docs.withColumn("cold", F.lit(None).cast("binary")).mapInArrow(
            _apply(arrays, hot_shards, min_chars), schema
        ).withColumnRenamed("id", id_col)

    cold_shards = -(-n_cold // SHARD_KEYS)
    shards = _shards(keys.where(F.col("n") < bar), cold_shards)
    # Questions carry a hash of the text: what comes back is gathered by identifier and text, and not for all rows of
    # one identifier (NULL, say) together.
    docs = docs.withColumn("uid", F.xxhash64("text"))
    asked = docs.mapInArrow(
        _ask(arrays, hot_shards, cold_shards, min_chars), "shard bigint, id bigint, uid bigint, hashes binary"
    )
    no_arrays = [F.lit(None).cast(t).alias(c) for c, t in zip(ARRAYS, ("array<binary>", *["binary"] * 3), strict=True)]
    none = [F.lit(None).cast(t).alias(c) for c, t in (("id", "bigint"), ("uid", "bigint"), ("hashes", "binary"))]
    both = shards.select("shard", *ARRAYS, *none, F.lit(0).alias("kind")).unionByName(
        asked.select("shard", *no_arrays, "id", "uid", "hashes", F.lit(1).alias("kind"))
    )
    answers = both.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(
        _answer, "id bigint, uid bigint, hashes binary"
    )
    cold = answers.groupBy(F.col("id").alias("cold_id"), F.col("uid").alias("cold_uid")).agg(
        F.array_join(F.array_distinct(F.collect_list(F.hex("hashes"))), "").alias("h")
    )
    same = docs["id"].eqNullSafe(cold["cold_id"]) & docs["uid"].eqNullSafe(cold["cold_uid"])
    joined = docs.join(cold, same, "left")
    return joined.select("id", "text", F.unhex("h").alias("cold")).mapInArrow(
        _apply(arrays, hot_shards, min_chars), schema
    ).withColumnRenamed("id", id_col)


def _opened(arrays) -> dict[int, Shard]:
    return {k: Shard.unpack(*v) for k, v in arrays.value.items()}


def _ask(arrays, hot_shards: int, cold_shards: int, min_chars: int):
    """Hashes that the hot arrays don't hold, per shard and document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = _opened(arrays)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            _, row, _, high, low, found, _ = _probe(hot, hot_shards, min_chars, docs, batch.column(1).to_pylist())
            row, high, low = row[~found], high[~found], low[~found]
            if not len(row):
                continue
            shard = _shard_of(high, cold_shards).astype(np.int64)
            order = np.lexsort((row, shard))
            row, shard, pairs = row[order], shard[order], np.stack([high[order], low[order]], axis=1)
            first = np.flatnonzero(np.concatenate(([True], (np.diff(row) != 0) | (np.diff(shard) != 0))))
            ends = np.append(first[1:], len(row))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard[first]),
                    pa.array([docs[i] for i in row[first]], pa.int64()),
                    batch.column(2).take(pa.array(row[first])),
                    pa.array([pairs[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary()),
                ],
                ["shard", "id", "uid", "hashes"],
            )

    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a shard in order: its arrays, then what documents ask. Gives the hashes whose lines have to go."""
    shard, number = None, None
    for batch in batches:
        table = {c: batch.column(c).to_pylist() for c in batch.schema.names}
        out: list[tuple] = []
        for i, at in enumerate(table["shard"]):
            if table["kind"][i] == 0:
                shard, number = Shard.unpack(*(table[c][i] for c in ARRAYS)), at
            elif at == number:
                pairs = np.frombuffer(table["hashes"][i], "<u8").reshape(-1, 2)
                found, last = shard.probe(pairs[:, 0].copy(), pairs[:, 1].copy())
                own = NOBODY if table["id"][i] is None else table["id"][i]
                if (gone := found & (last != own)).any():
                    out.append((table["id"][i], table["uid"][i], pairs[gone].tobytes()))
        if out:
            kinds = (pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "uid", "hashes"])


def _apply(arrays, hot_shards: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = _opened(arrays)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            lines, row, place, high, low, _, gone = _probe(hot, hot_shards, min_chars, docs, batch.column(1).to_pylist())
            cold = batch.column(2)
            if cold.null_count < len(cold):
                told = [frozenset() if x is None else {x[i : i + 16] for i in range(0, len(x), 16)} for x in cold.to_pylist()]
                flat = np.stack([high, low], axis=1).tobytes()
                gone |= np.fromiter((flat[16 * k : 16 * k + 16] in told[i] for k, i in enumerate(row)), bool, len(row))
            dropped: dict[int, set[int]] = {}
            for i, j in zip(row[gone].tolist(), place[gone].tolist(), strict=True):
                dropped.setdefault(i, set()).add(j)
            kept = [
                "\n".join([x for j, x in enumerate(own) if j not in dropped[i]] if i in dropped else own)
                for i, own in enumerate(lines)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(kept, pa.string()),
                    pa.array([len(x) for x in lines], pa.int64()),
                    pa.array([len(dropped.get(i, ())) for i in range(len(lines))], pa.int64()),
                    pa.array([hashlib.sha256(utf8(x)).hexdigest() for x in kept], pa.string()),
                ],
                ["id", "kept", "n_lines", "n_dropped", "kept_sha256"],
            )

    return run
