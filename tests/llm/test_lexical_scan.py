"""The lexical scan against scores counted term by term."""

import math
import random
import re
from collections import Counter

import pytest

from tiffin.llm import lexical_scan

DOCS = "doc_id bigint, text string, key string, id bigint, score double, rank int, part int, item bigint"
ITEMS = "item_id bigint, text string, key string, copies bigint"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, items, k):
    own = [(i, Counter(terms(t))) for i, t in docs]
    own = [(i, c, sum(c.values())) for i, c in own]
    N, L = sum(n > 0 for *_, n in own), sum(n for *_, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in own:
            score = 0
            for t in set(terms(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * (100 - 50 + (50 * n * N) // L)))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def actual(spark, docs, items, **options):
    d = spark.createDataFrame([(*x, "k", 1, 0.5, 2, 3, 4) for x in docs], DOCS).repartition(4)
    q = spark.createDataFrame([(*x, "k", 9) for x in items], ITEMS)
    return sorted((tuple(r) for r in lexical_scan.search(d, q, **options).collect()), key=str)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(2)
    words = ["the", "cat", "café", "Straße", "x1", "a", "aa", "aaa", "b-c", "日本", "it's", "İx", "́e"]

    def prose(n):
        return "".join(rng.choice(words) + rng.choice([" ", " ", "\n", ", ", "_", "\x00", "\x7f", "\x85"]) for _ in range(n))

    out = [(i, prose(rng.randint(0, 60))) for i in range(150)]
    out += [(i, out[3][1]) for i in range(150, 200)]  # equal scores
    out += [(3, out[3][1]), (3, out[3][1]), (None, out[3][1]), (None, None), (201, ""), (202, " .,"), (203, None)]
    return out + [(204, "The " * 40_000 + "cat"), (205, "q" * 150_000 + " café"), (206, "THE CAT")]


ASKED = [
    (1, "the cat"), (2, "CAFÉ café"), (3, "aa"), (4, ""), (5, None), (6, "nowhere"), (None, "x1 a"), (7, "İx 日本 b c"),
    (1, "the cat"), (1, "aaa"), (8, "it's the a aa aaa straße STRASSE"), (9, "q" * 150_000),
]


@pytest.mark.parametrize("k", [7, 500])
def test_scores(spark, docs, k):
    assert actual(spark, docs, ASKED, k=k) == expected(docs, ASKED, k)


def test_blocks_of_items(spark, docs):
    assert actual(spark, docs, ASKED, k=5, block_items=5) == expected(docs, ASKED, 5)
    assert actual(spark, docs, ASKED, k=5, block_bytes=200_000) == expected(docs, ASKED, 5)


def test_pieces_and_cuts_change_nothing(spark, docs, monkeypatch):
    best = lexical_scan._Best(2, 3)
    import numpy as np

    best.room = 4
    rng = random.Random(1)
    rows = [(rng.randint(0, 1), rng.randint(1, 9), rng.randint(0, 1), rng.randint(0, 30)) for _ in range(200)]
    for row in rows:
        best.add(*(np.array([x]) for x in row))
    want = [r for item in (0, 1) for r in sorted((r for r in rows if r[0] == item), key=lambda r: (-r[1], r[2], r[3]))[:3]]
    assert [tuple(r) for r in best.cut().tolist()] == want

    scan = lexical_scan.Scan([b"a", b"aa", "é".encode(), b"x" * 100])
    text = f"a aa a  a.aa é aé {'x' * 100} {'x' * 101} " * 50
    whole = scan.frequencies(text)
    monkeypatch.setattr(lexical_scan, "PIECE", 7)
    assert scan.frequencies(text) == whole == (9 * 50, Counter({0: 150, 1: 100, 2: 50, 3: 50}))


def test_empty_tables(spark, docs):
    assert actual(spark, [], ASKED) == []
    assert actual(spark, docs, []) == []
    assert actual(spark, [(1, None), (2, ".")], ASKED) == []
