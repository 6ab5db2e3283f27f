"""Windows that repeat across a corpus: the distributed part of exact substring removal.

A window is a fixed number of consecutive tokens (words or bytes) of one document. Whoever compares windows wants equal
ones to meet, without moving the corpus around. Each window has a trigger: the smallest hash of the short grams in it.
Equal windows have equal triggers, and neighbouring windows mostly share theirs, so a document falls into segments,
runs of windows with one trigger, of which there are some ten times fewer than tokens.

1. Documents are packed into blocks of about ``BLOCK_BYTES`` and written to the shared folder. A block is the unit of
   work: everything below can be computed again from it in any attempt.
2. Blocks send each trigger once, as 40 bits and a count, to the bucket that its other bits name. The bucket answers
   with two bits for each: found once in the corpus, repeated, or hot (in more than ``HOT`` segments). A trigger that is
   found once belongs to text that is found once.
3. Segments with a repeated trigger go to shards by trigger, each distinct segment of a block once, with the first
   place where the block has it. Segments of a hot trigger go as single windows by the window's own hash, so that a
   passage that a third of all documents hold, each in words of its own, is spread over all shards. No shard gets an
   equal segment twice from one block. The shard's method (``substring_dedup``, ``suffix_dedup``) answers with one bit
   per window: whether an equal one begins earlier.
4. Blocks turn the answers into covered tokens.

Only triggers, repeated segments and answers are shuffled, and blocks where they meet answers that are too large to be
broadcast (``BROADCAST_BYTES``, measured).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm.words import TILE, mix, sliding_min, utf8, word_bounds, word_hashes
from tiffin.session import stage

BLOCK_BYTES = 2 << 20
BUCKET_TRIGGERS = 1 << 20
HOT = 1 << 13
BROADCAST_BYTES = 24 << 20
NOBODY = -(1 << 63)  # stands for a NULL identifier: before all others
LOW = np.uint64((1 << 40) - 1)


class Words:
    """A block of words. Documents are kept as their words joined by one space. ``same_document`` says whether earlier
    windows of the same document count."""

    def __init__(self, window: int, gram: int = 8, same_document: bool = True):
        self.window, self.gram, self.same_document = window, gram, same_document
        self.segment_bytes = 200  # about, for choosing the number of shards

    def pack(self, text: str | None) -> tuple[bytes, int]:
        words = utf8(text).split()
        return b" ".join(words), len(words)

    separator = b" "

    def open(self, data: bytes) -> tuple[np.ndarray, Callable[[int, int], bytes]]:
        """Hash of the gram that begins at each token, and a function for the bytes of a range of tokens."""
        array = np.frombuffer(data, np.uint8)
        start, end = word_bounds(array)
        h = word_hashes(array, start, end)
        n = max(0, len(h) - self.gram + 1)
        grams = np.zeros(n, dtype=np.uint64)
        for j in range(self.gram):
            grams = mix(grams + h[j : j + n] + np.uint64(j))
        return grams, lambda a, b: data[start[a] : end[b - 1]]

    def tokens_in(self, piece: bytes) -> int:
        return piece.count(b" ") + 1


class Bytes:
    """A block of bytes."""

    def __init__(self, window: int, gram: int = 24, same_document: bool = False):
        self.window, self.gram, self.same_document = window, gram, same_document
        self.segment_bytes = 70

    def pack(self, text: str | None) -> tuple[bytes, int]:
        data = utf8(text)
        return data, len(data)

    separator = b""

    def open(self, data: bytes) -> tuple[np.ndarray, Callable[[int, int], bytes]]:
        n = max(0, len(data) - self.gram + 1)
        eight = np.ndarray((max(0, len(data) - 7),), dtype="<u8", buffer=data, strides=(1,)) if len(data) >= 8 else None
        grams = np.zeros(n, dtype=np.uint64)
        for a in range(0, n, TILE):
            part = grams[a : a + TILE]
            for j in range(0, self.gram, 8):
                part ^= eight[a + j : a + j + len(part)]
                part *= np.uint64(0x9E3779B97F4A7C15)
                part ^= part >> np.uint64(29)
            part[:] = mix(part)
        return grams, lambda a, b: data[a:b]

    def tokens_in(self, piece: bytes) -> int:
        return len(piece)


def _blocks(unit) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        part, number = TaskContext.get().partitionId(), 0
        ids, sizes, pieces, held = [], [], [], 0

        def out() -> pa.RecordBatch:
            data = pack.compress(unit.separator.join(x for x in pieces if x))
            row = [(part << 32) + number, np.array(ids, "<i8").tobytes(), np.array(sizes, "<i8").tobytes(), data]
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in [*row, sum(sizes)]], ["block", "ids", "sizes", "data", "tokens"])

        for batch in batches:
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data, n = unit.pack(text)
                ids.append(NOBODY if id_ is None else id_)
                sizes.append(n)
                pieces.append(data)
                held += len(data) + 16
                if held >= BLOCK_BYTES:
                    yield out()
                    number += 1
                    ids, sizes, pieces, held = [], [], [], 0
        if ids:
            yield out()

    return run


@dataclass
class Block:
    """A block in memory: its documents and its segments (trigger, first window, number of windows, and how often the
    trigger's gram is in it: a segment may repeat itself)."""

    ids: np.ndarray
    first: np.ndarray  # token where each document begins, and the end of the last
    piece: Callable[[int, int], bytes]
    trigger: np.ndarray
    start: np.ndarray
    count: np.ndarray
    grams: np.ndarray

    @classmethod
    def open(cls, unit, ids: bytes, sizes: bytes, data: bytes) -> Block:
        data = zstandard.ZstdDecompressor().decompress(data)
        grams, piece = unit.open(data)
        first = np.concatenate(([0], np.cumsum(np.frombuffer(sizes, "<i8"))))
        least = sliding_min(grams, unit.window - unit.gram + 1) if first[-1] >= unit.window else np.zeros(0, np.uint64)
        # A window must end in the document where it begins.
        bad = np.zeros(len(least) + 1, dtype=np.int32)
        np.add.at(bad, np.minimum(np.maximum(first[:-1], first[1:] - unit.window + 1), len(least)), 1)
        np.add.at(bad, np.minimum(first[1:], len(least)), -1)
        good = np.cumsum(bad)[:-1] == 0
        same = np.zeros(len(least), dtype=bool)
        same[1:] = (least[1:] == least[:-1]) & good[1:] & good[:-1]
        start = np.flatnonzero(good & ~same)
        # A run ends before the next token that doesn't continue one.
        stops = np.flatnonzero(~same)
        after = np.append(stops, len(least))[np.searchsorted(stops, start, "right")]
        count, trigger = after - start, least[start]
        found = np.ones(len(start), dtype=np.int64)
        if unit.same_document and len(start):
            n = count + unit.window - unit.gram
            found = np.add.reduceat((grams[ranges(start, n)] == np.repeat(trigger, n)).astype(np.int64), np.cumsum(n) - n)
        return cls(np.frombuffer(ids, "<i8"), first, piece, trigger, start, count, found)

    def places(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Identifier of the document and place in it."""
        doc = np.searchsorted(self.first, start, "right") - 1
        return self.ids[doc], start - self.first[doc]


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of ranges, one range after the other."""
    return np.repeat(start, size) + (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))


def _keys(trigger: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket in the upper 24 bits, 40 other bits of the hash below."""
    h = mix(trigger + np.uint64(0x632BE59BD9B4E019))
    return ((((h >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)) << np.uint64(40)) | (h & LOW)


def _five(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _send_triggers(unit, buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, sizes, data in zip(*(batch.column(c).to_pylist() for c in ("block", "ids", "sizes", "data")), strict=True):
                opened = Block.open(unit, ids, sizes, data)
                keys, inverse = np.unique(_keys(opened.trigger, buckets), return_inverse=True)
                count = np.bincount(inverse, weights=opened.grams, minlength=len(keys))
                bucket = (keys >> np.uint64(40)).astype(np.int64)
                cut = np.flatnonzero(np.diff(bucket, prepend=-1))
                ends = np.append(cut[1:], len(keys))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[cut]),
                        pa.array(np.full(len(cut), block, np.int64)),
                        pa.array([_five(keys[a:b]) for a, b in zip(cut, ends, strict=True)], pa.binary()),
                        pa.array([zstandard.compress(np.minimum(count[a:b], 255).astype(np.uint8).tobytes(), 1) for a, b in zip(cut, ends, strict=True)], pa.binary()),
                    ],
                    ["bucket", "block", "keys", "counts"],
                )

    return run


def _answer_triggers(hot: int) -> Callable:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        raw = [np.frombuffer(x, np.uint8).reshape(-1, 5) for x in pdf["keys"]]
        sizes = np.array([len(x) for x in raw])
        wide = np.zeros((sizes.sum(), 8), dtype=np.uint8)
        wide[:, :5] = np.concatenate(raw)
        counts = np.frombuffer(b"".join(zstandard.decompress(x) for x in pdf["counts"]), np.uint8)
        _, inverse = np.unique(wide.view("<u8")[:, 0], return_inverse=True)
        total = np.bincount(inverse, weights=counts)
        status = ((total >= 2).astype(np.uint8) + (total >= hot))[inverse]
        out = []
        at = 0
        for block, n in zip(pdf["block"], sizes, strict=True):
            own = status[at : at + n]
            at += n
            if own.any():
                segments = int(counts[at - n : at][own > 0].sum(dtype=np.int64))
                out.append((block, int(pdf["bucket"].iloc[0]), zstandard.compress(own.tobytes(), 3), segments))
        return pd.DataFrame(out, columns=["block", "part", "bits", "segments"])

    return run


@dataclass
class Candidates:
    """Segments of a block that may have equals: every occurrence, and each distinct one once."""

    start: np.ndarray
    count: np.ndarray
    group: np.ndarray  # of each occurrence
    pieces: list[bytes]  # of each group
    doc: np.ndarray  # first place of each group
    place: np.ndarray
    windows: np.ndarray
    shard: np.ndarray


def _candidates(unit, block: Block, buckets: int, answers, shards: int) -> Candidates:
    keys, inverse = np.unique(_keys(block.trigger, buckets), return_inverse=True)
    bucket = (keys >> np.uint64(40)).astype(np.int64)
    status = np.zeros(len(keys), dtype=np.uint8)
    for a in answers or ():
        begin = np.searchsorted(bucket, a["part"])
        own = np.frombuffer(zstandard.decompress(a["bits"]), np.uint8)
        status[begin : begin + len(own)] = own
    own = status[inverse]
    start, count, route = block.start[own == 1], block.count[own == 1], keys[inverse][own == 1]
    many = np.flatnonzero(own == 2)
    if len(many):
        n = block.count[many]
        single = ranges(block.start[many], n)
        start = np.concatenate([start, single])
        count = np.concatenate([count, np.ones(len(single), dtype=count.dtype)])
        route = np.concatenate([route, np.zeros(len(single), np.uint64)])
    order = np.argsort(start, kind="stable")
    start, count, route = start[order], count[order], route[order]
    seen: dict[bytes, int] = {}
    piece, window = block.piece, unit.window
    group = np.array(
        [seen.setdefault(piece(a, b), len(seen)) for a, b in zip(start.tolist(), (start + count + window - 1).tolist(), strict=True)],
        dtype=np.int64,
    )
    pieces = list(seen)
    doc, place = block.places(start)
    first = np.lexsort((place, doc, group))
    first = first[np.flatnonzero(np.diff(group[first], prepend=-1))]
    route = route[first]
    if (own_hash := route == 0).any():
        import xxhash

        route[own_hash] = [xxhash.xxh3_64_intdigest(pieces[i]) for i in np.flatnonzero(own_hash)]
    shard = (mix(route) % np.uint64(shards)).astype(np.int64)
    return Candidates(start, count, group, pieces, doc[first], place[first], count[first], shard)


def _send_segments(unit, buckets: int, shards: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("block", "ids", "sizes", "data", "answers"))
            for number, ids, sizes, data, answers in zip(*columns, strict=True):
                c = _candidates(unit, Block.open(unit, ids, sizes, data), buckets, answers, shards)
                order = np.argsort(c.shard, kind="stable")
                out = []
                for part in np.split(order, np.flatnonzero(np.diff(c.shard[order])) + 1):
                    if len(part):
                        pieces = [c.pieces[i] for i in part]
                        head = np.array([[len(p) for p in pieces], c.doc[part], c.place[part]], dtype="<i8")
                        blob = len(pieces).to_bytes(8, "little") + head.tobytes() + b"".join(pieces)
                        out.append((int(c.shard[part[0]]), number, pack.compress(blob)))
                if out:
                    shard, block, blob = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard, pa.int64()), pa.array(block, pa.int64()), pa.array(blob, pa.binary())],
                        ["shard", "block", "blob"],
                    )

    return run


def _answer_segments(unit, earlier: Callable) -> Callable:
    """``earlier(pieces, doc, place)`` gives for all windows of all pieces whether an equal one begins earlier."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pieces, docs, places, blocks = [], [], [], []
        for blob in pdf["blob"]:
            data = zstandard.decompress(blob)
            n = int.from_bytes(data[:8], "little")
            size, doc, place = np.frombuffer(data, "<i8", 3 * n, 8).reshape(3, n)
            ends = (np.cumsum(size) + 8 + 24 * n).tolist()
            pieces += [data[a:b] for a, b in zip([8 + 24 * n, *ends[:-1]], ends, strict=True)]
            docs.append(doc)
            places.append(place)
            blocks.append(n)
        flags = earlier(pieces, np.concatenate(docs), np.concatenate(places))
        windows = np.array([unit.tokens_in(p) - unit.window + 1 for p in pieces], dtype=np.int64)
        ends = np.concatenate(([0], np.cumsum(windows)))[np.concatenate(([0], np.cumsum(blocks)))]
        out = [
            (block, int(pdf["shard"].iloc[0]), zstandard.compress(np.packbits(flags[a:b]).tobytes(), 3))
            for block, a, b in zip(pdf["block"], ends[:-1], ends[1:], strict=True)
            if flags[a:b].any()
        ]
        return pd.DataFrame(out, columns=["block", "part", "bits"])

    return run


def covered(unit, block: Block, c: Candidates, shard_answers) -> np.ndarray:
    """For every token of the block whether a window with an earlier equal covers it."""
    starts = np.concatenate(([0], np.cumsum(c.windows)))  # of each group's windows in ``flags``
    flags = np.zeros(starts[-1], dtype=bool)
    order = np.argsort(c.shard, kind="stable")
    shard = c.shard[order]
    for a in shard_answers or ():
        own = order[np.searchsorted(shard, a["part"]) : np.searchsorted(shard, a["part"], "right")]
        n = c.windows[own]
        at = ranges(starts[own], n)
        flags[at] = np.unpackbits(np.frombuffer(zstandard.decompress(a["bits"]), np.uint8), count=len(at)).astype(bool)
    doc, place = block.places(c.start)
    later = doc > c.doc[c.group]
    if unit.same_document:
        later |= (doc == c.doc[c.group]) & (place > c.place[c.group])
    n = c.count
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    hit = flags[np.repeat(starts[c.group], n) + inner] | np.repeat(later, n)
    window = (np.repeat(c.start, n) + inner)[hit]
    edge = np.zeros(int(block.first[-1]) + 1, dtype=np.int32)
    np.add.at(edge, window, 1)
    np.add.at(edge, window + unit.window, -1)
    return np.cumsum(edge)[:-1] > 0


def _finish(unit, buckets: int, shards: int, rows: Callable, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("ids", "sizes", "data", "answers", "shard_answers"))
            for ids, sizes, data, answers, shard_answers in zip(*columns, strict=True):
                block = Block.open(unit, ids, sizes, data)
                c = _candidates(unit, block, buckets, answers, shards)
                gone = covered(unit, block, c, shard_answers)
                ids_ = pa.array([None if x == NOBODY else x for x in block.ids.tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays([ids_, *rows(block, gone)], ["id", *names])

    return run


def _together(blocks: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """Blocks with their answers (NULL if there are none) as an array column."""
    size = answers.agg(F.sum(F.length("bits"))).first()[0] or 0
    of = answers.groupBy(F.col("block").alias("_b")).agg(F.collect_list(F.struct("part", "bits")).alias(name))
    of = F.broadcast(of) if size <= BROADCAST_BYTES else of
    return blocks.join(of, blocks["block"] == of["_b"], "left").drop("_b")


def remove_repeats(
    docs: DataFrame, id_col: str, text_col: str, unit, earlier: Callable, shard_bytes: int, rows: Callable, schema: str
) -> DataFrame:
    """Run the four steps; ``rows(block, gone)`` makes the result's columns after the identifier for a block."""
    # The blocks are several times smaller than what they become in memory, so few go into an Arrow batch.
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    made = texts.mapInArrow(_blocks(unit), "block bigint, ids binary, sizes binary, data binary, tokens bigint")
    blocks = stage(made, "blocks")
    tokens = blocks.agg(F.sum("tokens")).first()[0] or 0
    density = (unit.window - unit.gram + 2) / 2  # expected windows in a segment
    buckets = min(1 << 24, max(1, int(tokens / density / BUCKET_TRIGGERS) + 1))
    sent = blocks.mapInArrow(_send_triggers(unit, buckets), "bucket bigint, block bigint, keys binary, counts binary")
    answered = sent.groupBy("bucket").applyInPandas(
        _answer_triggers(HOT), "block bigint, part bigint, bits binary, segments bigint"
    )
    answers = stage(answered, "trigger-answers")
    segments = answers.agg(F.sum("segments")).first()[0] or 0
    shards = max(1, int(segments * unit.segment_bytes / shard_bytes) + 1)
    known = _together(blocks, answers, "answers")
    pieces = known.mapInArrow(_send_segments(unit, buckets, shards), "shard bigint, block bigint, blob binary")
    found = pieces.groupBy("shard").applyInPandas(_answer_segments(unit, earlier), "block bigint, part bigint, bits binary")
    found = stage(found, "segment-answers")
    names = [x.split()[0] for x in schema.split(", ")]
    return _together(known, found, "shard_answers").mapInArrow(
        _finish(unit, buckets, shards, rows, names), f"id bigint, {schema}"
    ).withColumnRenamed("id", id_col)
