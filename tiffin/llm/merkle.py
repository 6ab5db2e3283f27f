"""Merkle manifest of a dataset by time-forward processing.

A leaf is the digest of a row. Within a group (a language, say) leaves ascend by identifier; while several nodes
remain, every ``FAN`` consecutive ones become the digest of their digests. What remains is the group's subroot; the
subroots, in the order of the groups, become the root in the same way.

Every node has a label, the last leaf below it and its level, so that a node's label comes after its children's.
Nodes are worked off in the order of labels: a node takes its children's digests from a priority queue and sends its
own to its parent's label (forward sweep). Then the labels are worked off backwards: a node takes its proof, what is
needed to come from it to the root, from the queue and sends its children theirs, each its siblings and the node's
own proof (reversed sweep). So a leaf gets its proof without asking for its ancestors one by one.

The queue is external. Its far part are tables in the shared folder: messages between blocks of ``FAN ** DEPTH``
leaves, keyed by tree and block, which Spark deals and spills. Its near part is a heap in the task that has a block:
at most a block's nodes. Each round of the forward sweep turns blocks into leaves of the round above, a 512th of
them, so three rounds do for 100 million rows of a group; the reversed sweep goes through the same tables downwards.
No task ever holds more than a block, however many rows a group has, and the driver holds one digest, the root.

Leaves are numbered by a range partitioning by group, identifier and digest and running totals over one row per
partition and group. Equal rows are told apart by a number given when leaves are written, so a hot identifier is
spread as well.

NULL groups come first, then groups in the order of their UTF-8 bytes. In a group NULL identifiers come first; rows of
one identifier follow in the order of their leaves. Equal rows are leaves of their own. An empty table has no rows and
no root. Columns that aren't named are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.session import stage

FAN, DEPTH = 8, 3
BLOCK = FAN**DEPTH
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest_of(values: Sequence[Column]) -> Column:
    """Digest of a row's values in hex: ``-`` for NULL, else the number of UTF-8 bytes, ``:`` and the value."""

    def coded(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[coded(v) for v in values]), 256)


def _join(digests: Sequence[bytes]) -> bytes:
    return hashlib.sha256("".join([d.hex() for d in digests]).encode()).digest()


def _levels(nodes: int) -> int:
    """Levels above ``nodes`` leaves of a tree, in one block at most."""
    levels = 0
    while nodes > 1 and levels < DEPTH:
        nodes, levels = -(-nodes // FAN), levels + 1
    return levels


def _label(level: int, index: int, nodes: int) -> tuple[int, int]:
    return min((index + 1) * FAN**level, nodes) - 1, level


def forward(leaves: list[bytes], first: int, nodes: int) -> dict[tuple[int, int], bytes]:
    """Digests of a block by (level, number in the level). ``first`` is its first leaf's number in the tree, which
    has ``nodes`` leaves."""
    top = _levels(nodes)
    known: dict[tuple[int, int], bytes] = {}
    queue: list[tuple[tuple[int, int], int, bytes]] = []  # label of the parent, the child's number, its digest

    def settle(level: int, index: int, digest: bytes) -> None:
        known[level, index] = digest
        if level < top:
            heapq.heappush(queue, (_label(level + 1, index // FAN, nodes), index, digest))

    for i, leaf in enumerate(leaves, first):
        settle(0, i, leaf)
        while queue and queue[0][0][0] <= i:  # the last of the node's leaves is there, and so are all its children
            label, index, digest = heapq.heappop(queue)
            children = [digest]
            while queue and queue[0][0] == label:
                children.append(heapq.heappop(queue)[2])
            settle(label[1], index // FAN, _join(children))
    return known


def backward(known: dict[tuple[int, int], bytes], first: int, nodes: int, proof: bytes) -> Iterator[tuple[int, bytes]]:
    """Each leaf of a block, the last one first, with its proof; ``proof`` is that of the block's topmost node."""
    top = _levels(nodes)
    queue = [(tuple(-x for x in _label(top, first // FAN**top, nodes)), first // FAN**top, proof)]
    while queue:
        (_, level), index, own = heapq.heappop(queue)
        level = -level
        if level == 0:
            yield index, own
            continue
        children = [i for i in range(index * FAN, (index + 1) * FAN) if (level - 1, i) in known]
        for i in children:
            siblings = [known[level - 1, j] for j in children if j != i]
            step = bytes([i - children[0], len(siblings)]) + b"".join(siblings)
            heapq.heappush(queue, (tuple(-x for x in _label(level - 1, i, nodes)), i, step + own))


def steps(proof: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """The runs of a proof from the leaf up: the place in the run and the siblings, left to right."""
    at = 0
    while at < len(proof):
        place, count = proof[at], proof[at + 1]
        body = proof[at + 2 : at + 2 + 32 * count]
        yield place, [body[i : i + 32] for i in range(0, len(body), 32)]
        at += 2 + 32 * count


def fold(leaf: bytes, proof: bytes) -> bytes:
    """The root that a leaf and its proof lead to."""
    for place, siblings in steps(proof):
        leaf = _join([*siblings[:place], leaf, *siblings[place:]])
    return leaf


def _forward_block(block: pa.Table) -> pa.Table:
    rows = sorted(zip(*(block.column(x).to_pylist() for x in ("i", "leaf", "id", "altered")), strict=True), key=lambda x: x[0])
    nodes, first = block.column("n")[0].as_py(), rows[0][0]
    leaves = [x[1] for x in rows]
    known = forward(leaves, first, nodes)
    top = _levels(nodes)
    inner = sorted(k for k in known if k[0])
    return pa.table(
        {
            "t": block.column("t").slice(0, 1),
            "b": pa.array([first // BLOCK], pa.int64()),
            "n": pa.array([nodes], pa.int64()),
            "ids": pa.array([[x[2] for x in rows]], pa.list_(pa.int64())),
            "altered": pa.array([[x[3] for x in rows]], pa.list_(pa.binary())),
            "leaves": pa.array([b"".join(leaves)], pa.binary()),
            "inner": pa.array([b"".join(known[k] for k in inner)], pa.binary()),
            "top": pa.array([known[top, first // FAN**top]], pa.binary()),
        }
    )


BLOCKS = "t bigint, b bigint, n bigint, ids array<bigint>, altered array<binary>, leaves binary, inner binary, top binary"


def _inner_of(leaves: list[bytes], first: int, nodes: int, inner: bytes) -> dict[tuple[int, int], bytes]:
    """A block's digests from the table: those above the leaves lie there level by level."""
    known = {(0, i): x for i, x in enumerate(leaves, first)}
    low, high, at = first, first + len(leaves) - 1, 0
    for level in range(1, _levels(nodes) + 1):
        low, high = low // FAN, high // FAN
        for i in range(low, high + 1):
            known[level, i] = inner[at : at + 32]
            at += 32
    return known


def _backward_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every leaf of each block: tree, number, identifier, leaf, altered leaf, subroot, proof."""
    for batch in batches:
        for row in batch.to_pylist():
            raw, first = row["leaves"], row["b"] * BLOCK
            leaves = [raw[i : i + 32] for i in range(0, len(raw), 32)]
            known = _inner_of(leaves, first, row["n"], row["inner"])
            found = sorted(backward(known, first, row["n"], row["proof"]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["t"]] * len(leaves), pa.int64()),
                    pa.array([i for i, _ in found], pa.int64()),
                    pa.array(row["ids"], pa.int64()),
                    pa.array(leaves, pa.binary()),
                    pa.array(row["altered"], pa.binary()),
                    pa.array([row["subroot"] or row["top"]] * len(leaves), pa.binary()),
                    pa.array([p for _, p in found], pa.binary()),
                ],
                ["t", "i", "id", "leaf", "altered", "subroot", "proof"],
            )


PROVED = "t bigint, i bigint, id bigint, leaf binary, altered binary, subroot binary, proof binary"


def _numbered(rows: DataFrame, group: str, order: Sequence[str], keep: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with ``m``, and a table of what to take from ``m`` for the number in the group: group, p, off, n."""
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    # The number holds the partition in its upper bits; written once, it stays whatever is run again.
    placed = stage(ranged.select(group, *keep, F.monotonically_increasing_id().alias("m")), "merkle-order")
    spans = placed.groupBy(group, F.shiftright("m", 33).alias("p")).agg(F.min("m").alias("first"), F.count("*").alias("c"))
    before = Window.partitionBy(group).orderBy("p").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = spans.select(
        group,
        "p",
        (F.col("first") - F.coalesce(F.sum("c").over(before), F.lit(0))).alias("off"),
        F.sum("c").over(Window.partitionBy(group)).alias("n"),
    )
    return placed, offsets


def _raise(leaves: DataFrame, most: int) -> list[DataFrame]:
    """Forward sweep over the trees of ``leaves`` (t, i, n, id, leaf, altered), the largest of which has ``most``
    leaves: the blocks of each round. The last round has one block per tree."""
    rounds = []
    while True:
        keyed = leaves.withColumn("b", F.floor(F.col("i") / BLOCK))
        blocks = stage(keyed.groupBy("t", "b").applyInArrow(_forward_block, BLOCKS), "merkle-blocks")
        rounds.append(blocks)
        if most <= BLOCK:
            return rounds
        most = -(-most // BLOCK)
        nothing = [F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("binary").alias("altered")]
        leaves = blocks.select("t", F.col("b").alias("i"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("leaf"), *nothing)


def _lower(rounds: list[DataFrame], proofs: DataFrame) -> DataFrame:
    """Reversed sweep: ``proofs`` has t, i = 0, subroot and proof of each tree's topmost node."""
    for number, blocks in enumerate(reversed(rounds)):
        given = proofs.select(F.col("t").alias("_t"), F.col("i").alias("_b"), "subroot", "proof")
        joined = blocks.join(given, (F.col("t") == F.col("_t")) & (F.col("b") == F.col("_b"))).drop("_t", "_b")
        proofs = joined.mapInArrow(_backward_blocks, PROVED)
        if number < len(rounds) - 1:
            proofs = stage(proofs, "merkle-proofs")
    return proofs


def manifest(docs: DataFrame, id_col: str, group_col: str, leaf: Column, altered: Column | None = None) -> DataFrame:
    """A row per row of ``docs``: id_col, leaf, altered (NULL where it isn't given), subroot, root and proof, all as
    bytes. ``leaf`` and ``altered`` are digests in hex; proofs are of the leaves and not of what is altered. ``steps``
    reads a proof and ``fold`` leads a leaf to its root."""
    other = F.lit(None).cast("string") if altered is None else altered
    rows = docs.select(
        F.col(group_col).cast("string").alias("g"),
        F.col(id_col).cast("bigint").alias("id"),
        F.unhex(leaf).alias("leaf"),
        F.unhex(other).alias("altered"),
    )
    rows = stage(rows.withColumn("tag", F.monotonically_increasing_id()), "merkle-leaves")
    placed, offsets = _numbered(rows, "g", ["id", "leaf", "tag"], ["id", "leaf", "altered"])
    offsets = stage(offsets, "merkle-offsets")

    # The groups are leaves of the tree above: numbered alike, as one group.
    groups = offsets.groupBy("g").agg(F.max("n").alias("n")).withColumn("one", F.lit(0))
    ordered, shift = _numbered(groups, "one", ["g"], ["g", "n"])
    named = ordered.join(shift.withColumnRenamed("n", "groups"), (F.shiftright("m", 33) == F.col("p")) & (ordered["one"] == shift["one"]))
    named = stage(named.select("g", (F.col("m") - F.col("off")).alias("t"), "n", "groups"), "merkle-groups")
    most, count = named.agg(F.max("n"), F.count("*")).first()
    if not count:
        return docs.sparkSession.createDataFrame([], f"{id_col} bigint, leaf binary, altered binary, subroot binary, root binary, proof binary")

    of = offsets.drop("n").join(named, offsets["g"].eqNullSafe(named["g"])).select(offsets["g"].alias("_g"), "p", "off", "t", "n")
    joined = placed.join(of, (F.shiftright("m", 33) == F.col("p")) & placed["g"].eqNullSafe(F.col("_g")))
    leaves = joined.select("t", (F.col("m") - F.col("off")).alias("i"), "n", "id", "leaf", "altered")
    below = _raise(leaves, most)

    subroots = below[-1].join(named.select("t", "groups"), "t").select(
        F.lit(0).cast("bigint").alias("t"),
        F.col("t").alias("i"),
        F.col("groups").alias("n"),
        F.lit(None).cast("bigint").alias("id"),
        F.col("top").alias("leaf"),
        F.lit(None).cast("binary").alias("altered"),
    )
    above = _raise(subroots, count)
    root = above[-1].select("top").first()["top"]
    none = F.lit(None).cast("binary").alias("subroot")
    start = above[-1].select("t", F.col("b").alias("i"), none, F.lit(b"").alias("proof"))
    reached = stage(_lower(above, start).select(F.col("i").alias("t"), F.lit(0).cast("bigint").alias("i"), F.col("leaf").alias("subroot"), "proof"), "merkle-subroots")
    proved = _lower(below, reached)
    return proved.select(F.col("id").alias(id_col), "leaf", "altered", "subroot", F.lit(bytes(root)).alias("root"), "proof")


def verify(proved: DataFrame, id_col: str) -> DataFrame:
    """``manifest``'s rows as digests in hex: the proof's digest, the root that the altered leaf (the leaf, where it
    is NULL) and the proof lead to, and whether it is the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {x: batch.column(x).to_pylist() for x in ("leaf", "altered", "subroot", "root", "proof")}
            siblings = [_join([s for _, run in steps(p) for s in run]).hex() for p in at["proof"]]
            led = [fold(x if a is None else a, p) for x, a, p in zip(at["leaf"], at["altered"], at["proof"], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    *[pa.array([d.hex() for d in at[x]], pa.string()) for x in ("leaf", "subroot", "root")],
                    pa.array(siblings, pa.string()),
                    pa.array([d.hex() for d in led], pa.string()),
                    pa.array([d == r for d, r in zip(led, at["root"], strict=True)], pa.bool_()),
                ],
                ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )

    schema = "id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return proved.withColumnRenamed(id_col, "id").mapInArrow(run, schema).withColumnRenamed("id", id_col)


def document_digests(id_col: str = "doc_id") -> tuple[Column, Column]:
    """Leaf of a document, and the leaf of what tampering makes of it: where 3 divides the CRC-32 of the identifier,
    A-Z of the text in lower case; NULL where nothing is tampered with, and for a NULL identifier."""
    values = [F.col(c) for c in (id_col, "source", "lang", "n_chars")]
    spoilt = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 0
    text = F.col("text").cast("string")
    return digest_of([*values, text]), F.when(spoilt, digest_of([*values, F.translate(text, UPPER, LOWER)]))
