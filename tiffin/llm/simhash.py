"""Near-duplicate documents by SimHash, with exact pairs from sharded vantage-point trees.

A document's words (A-Z in lower case) give shingles of ``shingle`` words, repeats included; fewer words give one
shingle, none give the fingerprint 0. A fingerprint bit is 1 if it is set in more than half of the shingles' XXH64
hashes. Fingerprints that differ in at most ``max_bits`` bits are linked, and a component is all that links reach.

1. Documents with equal fingerprints are one point: points are the distinct fingerprints with their smallest
   identifier, so thousands of copies are one row.
2. A vantage-point tree over a small sample of points cuts the space into shards: at each node points within the
   median Hamming distance of the vantage point go left, the others right. The sample shapes the tree and nothing else.
3. A point is a member of one shard and a question to every shard that its ball of radius ``max_bits`` touches: by the
   triangle inequality a neighbour at distance at most r of a point at distance d from the vantage point is at a
   distance within [d - r, d + r] of it, so a branch beyond that is pruned. Every linked pair meets in the shard where
   one of them is a member.
4. A shard builds its own tree over its members and runs all questions through it at once with the same bounds.
   Distances are exact, so are the pairs. A shard hands on only a spanning forest of the links that it found.
5. Components come from alternating star contractions on the links, written to the shared folder in each round, until
   nothing changes. Links never visit the driver.

NULL and empty text have the fingerprint 0 and are linked like any other. A NULL identifier is never a component's
name unless all its members are NULL. Repeated rows give repeated rows. An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm.words import give_back, utf8, values
from tiffin.session import stage

SHARD_POINTS = 1 << 18  # beyond SPREAD shards; the tree within a shard prunes as well as more shards would
SPREAD = 4  # binary logarithm of the shards that fewer points are spread over, for the sake of the executors' cores
SPREAD_POINTS = 1 << 12
SAMPLE = 1 << 12  # points that shape the upper tree, and SHARE times the shards if those are more
SHARE = 64
LEAF = 64
ONE = np.uint64(1)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of one text."""
    words = utf8(text).lower().split()  # bytes: A-Z only, and white space of six kinds only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, 42)], dtype=np.uint64)
    else:
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(size)
        starts = (ends - size)[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, carried: tuple[str, ...] = ()
) -> DataFrame:
    """id, fp (the 64 bits as a signed integer) and the ``carried`` 64-bit columns: one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t, shingle) for t in values(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fp.view(np.int64)), *batch.columns[2:]], ["id", "fp", *carried]
            )
        give_back()

    return docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"), *carried
    ).mapInArrow(run, ", ".join(["id bigint", "fp bigint", *[f"`{x}` bigint" for x in carried]]))


def distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


class Node:
    """Of a vantage-point tree: points within ``radius`` of ``vantage`` are on the left. A leaf has a number."""

    __slots__ = ("vantage", "radius", "left", "right", "leaf")

    def __init__(self, vantage=None, radius=0, left=None, right=None, leaf=-1):
        self.vantage, self.radius, self.left, self.right, self.leaf = vantage, radius, left, right, leaf


def _cut(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """Vantage point and radius that split ``points`` most evenly of a few candidates; None if none does."""
    best, share = None, 0.0
    for vantage in points[np.linspace(0, len(points) - 1, 5).astype(int)]:
        d = distance(points, vantage)
        median = int(np.median(d))
        for radius in (median, median - 1):
            inside = float((d <= radius).mean())
            # Few points close to the border are worth more than an even cut: those go to both sides.
            border = float((np.abs(d.astype(int) - radius) <= 1).mean())
            if (even := min(inside, 1 - inside) * (1.5 - border)) > share:
                best, share = (vantage, radius), even
    return best


def upper_tree(sample: np.ndarray, depth: int) -> tuple[Node, int]:
    """Tree of at most 2**depth leaves over a sample of points; the leaves are the shards."""
    count = 0

    def grow(points: np.ndarray, depth: int) -> Node:
        nonlocal count
        cut = _cut(points) if depth and len(points) >= 4 else None
        if cut is None:
            count += 1
            return Node(leaf=count - 1)
        inside = distance(points, cut[0]) <= cut[1]
        return Node(*cut, grow(points[inside], depth - 1), grow(points[~inside], depth - 1))

    root = grow(sample, depth)
    return root, count


def route(root: Node, points: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``points``, leaf) for every leaf that the ball of radius ``reach`` around a point touches."""
    places, leaves = [], []

    def walk(node: Node, at: np.ndarray) -> None:
        if not len(at):
            return
        if node.leaf >= 0:
            places.append(at)
            leaves.append(np.full(len(at), node.leaf, dtype=np.int64))
            return
        d = distance(points[at], node.vantage).astype(np.int64)
        walk(node.left, at[d - reach <= node.radius])
        walk(node.right, at[d + reach > node.radius])

    walk(root, np.arange(len(points)))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(leaves)


def close_pairs(members: np.ndarray, questions: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place of a member, place of a question) of all pairs at most ``reach`` bits apart, piece by piece: a
    vantage-point tree is grown over the members while the questions walk down it."""
    todo = [(np.arange(len(members)), np.arange(len(questions)))]
    while todo:
        m, q = todo.pop()
        if not len(m) or not len(q):
            continue
        cut = _cut(members[m]) if len(m) > LEAF else None
        if cut is None:
            for i in range(0, len(q), 4096):
                part = q[i : i + 4096]
                near = np.bitwise_count(members[m][:, None] ^ questions[part][None, :]) <= reach
                a, b = np.nonzero(near)
                yield m[a], part[b]
            continue
        vantage, radius = cut
        inside = distance(members[m], vantage) <= radius
        d = distance(questions[q], vantage).astype(np.int64)
        todo.append((m[inside], q[d - reach <= radius]))
        todo.append((m[~inside], q[d + reach > radius]))


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of the links a-b: (point, smallest point)."""
    points, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(points))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    other = root != np.arange(len(points))
    return points[other], points[root[other]]


def _shard_links(reach: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        points = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        member = pdf["member"].to_numpy(bool)
        members, questions = points[member], points
        left, right = [], []
        kept = 0
        for a, b in close_pairs(members, questions, reach):
            x, y = members[a], questions[b]
            other = x != y
            left.append(x[other])
            right.append(y[other])
            kept += int(other.sum())
            if kept > 1 << 20:  # keep no more than a forest of what was found
                x, y = _forest(np.concatenate(left), np.concatenate(right))
                left, right, kept = [x], [y], len(x) // 2
        x, y = _forest(np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.uint64),) * 2
        del left, right
        give_back()
        return pd.DataFrame({"a": x.view(np.int64), "b": y.view(np.int64)})

    return run


def links(points: DataFrame, reach: int) -> DataFrame:
    """a, b: fingerprints such that chains of such links join exactly what links of at most ``reach`` bits join."""
    n = points.count()
    levels = lambda size: max(0, int(np.ceil(np.log2(max(1, n / size)))))
    depth = max(levels(SHARD_POINTS), min(SPREAD, levels(SPREAD_POINTS)))
    # A sample by hash, at most one point in SHARD_POINTS / SHARE once there are many shards: the smallest hashes of
    # fingerprints, found among those under a bound that twice as many pass as are wanted.
    size, drawn = max(SAMPLE, SHARE << depth), F.xxhash64("fp")
    under = F.shiftrightunsigned(drawn, 1) / F.lit(float(1 << 63)) < min(1.0, (2 * size + 100) / max(1, n))
    sample = points.where(under).select("fp").orderBy(drawn, "fp").limit(size).collect()
    root, _ = upper_tree(np.array([r["fp"] for r in sample], dtype=np.int64).view(np.uint64), depth)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            home_at, home = route(root, fp, 0)
            at, leaf = route(root, fp, reach)
            own = np.zeros(len(fp), dtype=np.int64)
            own[home_at] = home
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf), pa.array(fp[at].view(np.int64)), pa.array(own[at] == leaf)], ["shard", "fp", "member"]
            )

    dealt = points.select("fp").mapInArrow(deal, "shard bigint, fp bigint, member boolean")
    return dealt.groupBy("shard").applyInPandas(_shard_links(reach), "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """node, root: for every node of a link the smallest node of its component (alternating large and small stars)."""
    both = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        # Large star: larger neighbours of u are linked to the smallest of u and its neighbours.
        sides = edges.select(F.explode(both).alias("e")).select("e.u", "e.v")
        least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = sides.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: smaller neighbours of u, and u, are linked to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        new = stage(small.where("a <> b").distinct(), "links")
        if _same(edges, new):
            return new.select(F.col("a").alias("node"), F.col("b").alias("root")).distinct().unionByName(
                new.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        edges = new


def _same(x: DataFrame, y: DataFrame) -> bool:
    """Whether two sets of links are equal, by number and two sums of hashes."""
    of = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.bit_xor(F.xxhash64("b", "a"))]
    return x.agg(*of).first() == y.agg(*of).first()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: identifier, fingerprint (16 hexadecimal digits), component_id (the smallest
    identifier reached), whether the row has links to other fingerprints, component (a fingerprint that names the
    component and is never NULL) and the ``carried`` 64-bit columns."""
    prints = stage(fingerprints(docs, id_col, text_col, shingle, carried), "fingerprints")
    points = stage(prints.groupBy("fp").agg(F.min("id").alias("least")), "points")
    reached = components(links(points, max_bits))
    rooted = points.join(reached, points["fp"] == reached["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id", "linked", F.col("root").alias("component"))
    return prints.join(named, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "linked",
        "component",
        *carried,
    )
