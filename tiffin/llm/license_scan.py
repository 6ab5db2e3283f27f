"""License notices found by conditional compression.

A text is its words in lower case; lines and signs don't count, so a notice may be wrapped or stand anywhere in a line
of any length.

1. Candidate blocks. A template can be only where as many words as a notice has at most hold enough of the words that it
   uses. Such stretches are cut into overlapping blocks of bounded length, so that every notice lies whole in one.
2. Ranking. Each block is compressed with each template that can be in it as raw dictionary of zstandard, and without.
   What a template saves in bytes ranks it: the whole text of a license saves more than its first sentence.
3. Confirmation, in the order of the ranking. In a block the fewest exact differences in wording are found for every
   place (words of the template that are missing, words that are there besides). A notice is confirmed if at least
   ``least_match`` of the template's words are there in order, and no more words besides than may be missing (two at
   least). Of a short template the words that name the license (all but those of ``GENERIC``) must all be there, and
   those that follow each other must do so in the notice, so a BSD notice is no MIT notice with one word changed.
4. A confirmed notice holds its place: a template that saves less has it only where it doesn't overlap. A notice with
   differences first gives way to a template that saves at least ``RIVAL`` of what it saves and differs in fewer words,
   as licenses that share most of their text do.

The ranking decides among templates and never ends the search: every block is compared, but for those that lie in a
confirmed notice as a whole. Work grows in proportion to the text, however many notices it has.

Templates are short notices and, as files in ``licenses``, the whole texts of ten licenses.

Everything happens in the row's task; nothing is shuffled or broadcast but the templates. NULL and empty texts have no
candidates. Repeated rows give equal rows; an empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The usual short notices of licenses. Names that end in -text are added below.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction"
    ),
    "MPL-2.0": "This work is subject to the terms of the Mozilla Public License, v. 2.0.",
}
# Words of short notices that don't name a license; the others are its naming words.
GENERIC = frozenset(
    "a all an are as is it its in of on or the this to under license licence licenses licensed released distributed subject "
    "terms permitted work software program file code version v".split()
)
RIVAL = 0.8  # of the bytes saved: a template that saves as much may still be the better one
SHORT = 16  # words of a template of which the naming words must be there
# Whole licenses, one file each. The driver reads them; tasks get them with the other templates.
TEMPLATES |= {f"{p.stem}-text": p.read_text(encoding="utf-8") for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))}
_WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")
# Costs of an alignment: of equally many differences those with the fewest missing words are the least.
BESIDES, MISSING, NEVER = 1 << 13, (1 << 13) + 1, 1 << 26


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def differences(template: list[str], block: list[str]) -> tuple[list[str], list[str]]:
    """Words of the template that the block lacks, and words of the block that the template lacks, each in order: what
    a longest common subsequence leaves. Rows of the table are the template's, so it is as wide as the block."""
    table = [[0] * (len(block) + 1)]
    for t in reversed(template):
        below, row = table[-1], [0] * (len(block) + 1)
        for j in range(len(block) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if t == block[j] else max(below[j], row[j + 1])
        table.append(row)
    table.reverse()
    missing, extra, i, j = [], [], 0, 0
    while i < len(template) and j < len(block):
        if template[i] == block[j]:
            i, j = i + 1, j + 1
        elif table[i + 1][j] >= table[i][j + 1]:
            missing.append(template[i])
            i += 1
        else:
            extra.append(block[j])
            j += 1
    return missing + template[i:], extra + block[j:]


class Template:
    """Words of a template, how many of them a notice has to have and how many words it may have besides."""

    def __init__(self, text: str, least_match: float):
        self.words = words(text)
        n = len(self.words)
        self.number = {w: i for i, w in enumerate(dict.fromkeys(self.words))}
        self.ids = np.array([self.number[w] for w in self.words], dtype=np.int32)
        self.times = Counter(self.words)
        self.need = math.ceil(least_match * n - 1e-9)
        self.lack = n - self.need
        self.besides = max(2, self.lack)
        self.skip = np.full(n, MISSING, dtype=np.int32)
        self.insert = np.full(n + 1, BESIDES, dtype=np.int32)
        self.insert[0] = 0  # a notice begins anywhere
        if n <= SHORT:  # naming words can't be missing, nor can a word be between two that follow each other
            naming = np.array([w not in GENERIC for w in self.words], dtype=bool)
            self.skip[naming] = NEVER
            self.insert[1:-1][naming[:-1] & naming[1:]] = NEVER
        self.names = frozenset(w for w in self.words if n <= SHORT and w not in GENERIC)
        self.skipped = np.concatenate([[0], np.cumsum(self.skip)]).astype(np.int32)

    def possible(self, known: set[str]) -> bool:
        """Whether a text of these words can have ``need`` of the template's."""
        return self.names <= known and sum(n for w, n in self.times.items() if w in known) >= self.need

    def blocks(self, own: list[str]) -> list[tuple[int, int]]:
        """Stretches that hold every place where a notice can be: as many words as a notice has at most must have
        ``need`` words that the template uses."""
        span = len(self.words) + self.besides
        at = np.flatnonzero(np.fromiter((w in self.number for w in own), bool, len(own)))
        if len(at) < self.need:
            return []
        first, last = at[: len(at) - self.need + 1], at[self.need - 1 :]
        first = first[last - first < span]
        out: list[tuple[int, int]] = []
        for a in first.tolist():
            begin, end = max(0, a - self.besides), min(len(own), a + span)
            if out and begin <= out[-1][1]:
                out[-1] = (out[-1][0], end)
            else:
                out.append((begin, end))
        return out

    def windows(self, own: list[str]) -> Iterator[tuple[int, int]]:
        """Blocks of bounded length: a notice in a stretch of ``blocks`` lies in one of them."""
        span = len(self.words) + self.besides
        for begin, end in self.blocks(own):
            for a in range(begin, max(begin + 1, end - span), 3 * span):
                yield a, min(end, a + 4 * span)

    def _rows(self, ids: list[int]) -> Iterator[np.ndarray]:
        """After each word of a block, for each i the fewest differences of the template's first i words from words
        that end here."""
        row = self.skipped
        for x in ids:
            new = row + self.insert
            if x >= 0:
                np.minimum(new[1:], np.where(self.ids == x, row[:-1], np.iinfo(np.int32).max), out=new[1:])
            row = np.minimum.accumulate(new - self.skipped) + self.skipped
            yield row

    def _back(self, ids: list[int], block: list[str]) -> tuple[int, list[str], list[str]]:
        """Where the notice that ends with the block begins, words that it lacks and words that it has besides."""
        table = [self.skipped, *self._rows(ids)]
        missing, extra, i, j = [], [], len(self.ids), len(ids)
        while i:
            if j and self.ids[i - 1] == ids[j - 1] and table[j][i] == table[j - 1][i - 1]:
                i, j = i - 1, j - 1
            elif table[j][i] == table[j][i - 1] + self.skip[i - 1]:
                i -= 1
                missing.append(self.words[i])
            else:
                j -= 1
                extra.append(block[j])
        return j, missing[::-1], extra[::-1]

    def notices(self, block: list[str]) -> list[tuple[int, int, list[str], list[str]]]:
        """Begin, end, missing and extra words of every notice in a block; of overlapping ones that with the fewest
        differences."""
        ids = [self.number.get(w, -1) for w in block]
        costs = np.array([row[-1] for row in self._rows(ids)])
        ends = np.flatnonzero(costs <= self.lack * MISSING + self.besides * BESIDES)
        out: list[tuple[int, int, list[str], list[str]]] = []
        for end in (ends[np.argsort(costs[ends], kind="stable")] + 1).tolist():
            if any(a < end <= b for a, b, _, _ in out):
                continue
            low = max(0, end - len(self.words) - self.besides)
            begin, missing, extra = self._back(ids[low:end], block[low:end])
            if len(missing) <= self.lack and len(extra) <= self.besides and not any(a < end and low + begin < b for a, b, _, _ in out):
                out.append((low + begin, end, missing, extra))
        return out


class Spans:
    """Spans that don't overlap, in order."""

    def __init__(self):
        self.begins: list[int] = []
        self.ends: list[int] = []

    def meets(self, a: int, b: int) -> bool:
        i = bisect_left(self.begins, b) - 1
        return i >= 0 and self.ends[i] > a

    def covers(self, a: int, b: int) -> bool:
        i = bisect_right(self.begins, a) - 1
        return i >= 0 and self.ends[i] >= b

    def add(self, a: int, b: int) -> None:
        i = bisect_left(self.begins, a)
        self.begins.insert(i, a)
        self.ends.insert(i, b)


class Scanner:
    def __init__(self, templates: dict[str, str], least_match: float):
        self.templates = {k: t for k, v in templates.items() if (t := Template(v, least_match)).words}
        self.plain = zstandard.ZstdCompressor(level=3)
        self.with_ = {}
        for name, t in self.templates.items():
            data = zstandard.ZstdCompressionDict(" ".join(t.words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=3)
            self.with_[name] = zstandard.ZstdCompressor(dict_data=data)

    def sizes(self, name: str, block: list[str]) -> tuple[int, int]:
        """Bytes of a block compressed without and with a template."""
        data = " ".join(block).encode()
        return len(self.plain.compress(data)), len(self.with_[name].compress(data))

    def notices(self, own: list[str]) -> tuple[int, list[tuple[int, str, float, list[str], list[str]]]]:
        """Number of blocks compressed; place of the first word, template, share saved, missing and extra words of each
        notice, in order."""
        known, blocks = set(own), []
        for name, t in self.templates.items():
            if t.possible(known):
                for a, b in t.windows(own):
                    without, size = self.sizes(name, own[a:b])
                    blocks.append((without - size, name, a, b))
        if not blocks:
            return 0, []
        blocks.sort(key=lambda x: (-x[0], x[1], x[2]))
        near: dict[int, list[int]] = {}  # blocks by the parts of the text that they touch
        for i, (_, _, a, b) in enumerate(blocks):
            for part in range(a >> 8, ((b - 1) >> 8) + 1):
                near.setdefault(part, []).append(i)
        confirmed: dict[int, list[tuple[int, int, list[str], list[str]]]] = {}

        def confirm(i: int) -> list[tuple[int, int, list[str], list[str]]]:
            if i not in confirmed:
                _, name, a, b = blocks[i]
                confirmed[i] = [(a + x, a + y, *rest) for x, y, *rest in self.templates[name].notices(own[a:b])]
            return confirmed[i]

        held, out = Spans(), []
        for i, (saved, name, a, b) in enumerate(blocks):
            if held.covers(a, b):
                continue
            for notice in sorted(confirm(i)):
                if held.meets(*notice[:2]):
                    continue
                best = (len(notice[2]) + len(notice[3]), i, notice)
                if best[0]:
                    x, y = notice[:2]
                    rivals = {j for part in range(x >> 8, ((y - 1) >> 8) + 1) for j in near[part]}
                    for j in sorted(rivals):
                        if j != i and blocks[j][0] >= RIVAL * saved:
                            for other in confirm(j):
                                if other[0] < y and x < other[1] and not held.meets(*other[:2]):
                                    best = min(best, (len(other[2]) + len(other[3]), j, other), key=lambda z: z[:2])
                _, j, (x, y, missing, extra) = best
                held.add(x, y)
                without, size = self.sizes(blocks[j][1], own[x:y])
                out.append((x, blocks[j][1], 1 - size / without, missing, extra))
        return len(blocks), sorted(out, key=lambda x: x[0])

    def scan(self, text: str) -> tuple[str, float, list[str], list[str]] | None:
        """The first notice of a text."""
        _, found = self.notices(words(text))
        return tuple(found[0][1:]) if found else None


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, str] | None = None,
    least_match: float = 0.8,
) -> DataFrame:
    """One row per row of ``docs``: identifier, n_candidates (blocks compressed with a template), licenses (distinct names
    in order) and notices (line number of the first word, license, share of bytes saved, words missing, words besides)."""
    templates = templates or TEMPLATES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least_match)
        for batch in batches:
            count, names, found = [], [], []
            for text in batch.column(1).to_pylist():
                low = (text or "").lower()
                n, hits = scanner.notices(_WORD.findall(low))
                own = []
                if hits:
                    starts = [m.start() for m in _WORD.finditer(low)]
                    breaks = [m.start() for m in re.finditer("\n", low)]
                    own = [
                        {"line": bisect_left(breaks, starts[at]), "license": name, "saved": saved, "missing": missing, "extra": extra}
                        for at, name, saved, missing, extra in hits
                    ]
                count.append(n)
                found.append(own)
                names.append(sorted({x["license"] for x in own}))
            notice = pa.struct([("line", pa.int64()), ("license", pa.string()), ("saved", pa.float64()), ("missing", pa.list_(pa.string())), ("extra", pa.list_(pa.string()))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(found, pa.list_(notice))],
                ["id", "n_candidates", "licenses", "notices"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(
        run,
        "id bigint, n_candidates bigint, licenses array<string>, "
        "notices array<struct<line: bigint, license: string, saved: double, missing: array<string>, extra: array<string>>>",
    ).withColumnRenamed("id", id_col)
