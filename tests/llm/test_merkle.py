"""The Merkle manifest against trees built level by level."""

import hashlib
import random
import zlib

import pytest

from tiffin.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, t bigint, i bigint, id bigint, leaf string, b string, proof string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(leaves):
    """Root, and of every leaf the runs it is in: its place and the siblings."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i // 8 * 8 : i // 8 * 8 + 8]
            paths[k].append((i % 8, run[: i % 8] + run[i % 8 + 1 :]))
        at = [i // 8 for i in at]
        nodes = [H(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    own = []
    for g in order:
        members = sorted(((r[0] is not None, r[0] or 0, leaf_of(r[0], r[3], r[2], r[4], r[1])), r) for r in groups[g])
        own.append((members, tree([m[0][2] for m in members])))
    root, above = tree([t[0] for _, t in own]) if own else (None, [])
    out = []
    for (members, (subroot, paths)), upper in zip(own, above, strict=True):
        for ((_, _, leaf), (doc_id, text, lang, source, n)), path in zip(members, paths, strict=True):
            proof = path + upper
            led = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
                low = None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
                led = leaf_of(doc_id, source, lang, n, low)
            for place, siblings in proof:
                led = H(*siblings[:place], led, *siblings[place:])
            out.append((doc_id, leaf, subroot, root, H(*[s for _, run in proof for s in run]), led, led == root))
    return sorted(out, key=str)


def actual(spark, rows):
    data = [(*r, 5, 6, 7, "x", "y", "z") for r in rows]
    docs = spark.createDataFrame(data, SCHEMA).repartition(5)
    proved = merkle.manifest(docs, "doc_id", "lang", *merkle.document_digests())
    return sorted((tuple(r) for r in merkle.verify(proved, "doc_id").collect()), key=str)


def documents(n, langs=("en", "de", None, "é", "z")):
    rng = random.Random(n)
    rows = [(i, f"Text Number {i} ÄÖ", rng.choice(langs), rng.choice(["a", None]), i) for i in range(n)]
    rows += [(None, None, None, None, None), (None, "", "", "", 0), (3, "A", "en", "a", 1), (3, "A", "en", "a", 1), (3, "B", "en", "a", 1)]
    rows += [(n + 7, "Long " * 50_000, "one leaf", "a", 1), (-5, None, "en", None, None)]
    return rows


@pytest.mark.parametrize("n", [0, 60, 1300])
def test_trees(spark, n):
    rows = documents(n)
    assert actual(spark, rows) == expected(rows)


def test_hot_group_over_several_rounds(spark):
    rows = documents(5000, ("en",) * 30 + ("de", None))  # more than 8 blocks, the second round has a tree of its own
    assert actual(spark, rows) == expected(rows)


def test_many_groups(spark):
    rows = [(i, "x", f"g{i % 700}", "s", i) for i in range(1500)]
    assert actual(spark, rows) == expected(rows)


def test_one_document_and_none(spark):
    rows = [(1, "A b", "en", "s", 3)]
    assert actual(spark, rows) == expected(rows)
    assert actual(spark, []) == []


@pytest.mark.parametrize("nodes", [1, 2, 8, 9, 64, 65, 511, 512, 513, 4097])
def test_sweeps_of_a_block(nodes):
    """Labels ascend from children to parents, every leaf gets one proof, and each leads to the block's top."""
    for first in range(0, nodes, merkle.BLOCK):
        leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(first, min(nodes, first + merkle.BLOCK))]
        known = merkle.forward(leaves, first, nodes)
        found = list(merkle.backward(known, first, nodes, b""))
        assert [i for i, _ in found] == list(range(first + len(leaves) - 1, first - 1, -1))
        levels = max(level for level, _ in known)
        top = known[levels, first // 8**levels]
        assert {merkle.fold(leaves[i - first], proof) for i, proof in found} == {top}
        assert merkle.fold(b"\0" * 32, found[0][1]) != top
        assert all(
            merkle._label(level, i, nodes) < merkle._label(level + 1, i // 8, nodes) for level, i in known if level < levels
        )
