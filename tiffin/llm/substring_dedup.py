"""Removal of repeated word sequences by suffix automata.

A window is ``window`` consecutive words of one document. Each word that is covered by a window whose words also begin
earlier, in a smaller identifier or earlier in the same document, is removed. Windows are judged on the input.

Repeated passages are dealt to shards (see ``repeats``), which are the reference: a shard builds a suffix automaton of
its passages and the documents' passages stream through it, in the order of the corpus, for matching statistics: at
each word the length of the longest earlier sequence that ends there. Where it reaches the window's length, the window
has begun before. A passage enters the automaton after it has been read, word by word, so that a sequence that repeats
within itself is found too; a passage of which all windows are known adds nothing and does not enter.

An automaton holds the passages of one shard, ``shard_bytes`` of text at most on average, so it fits into a task
whatever the corpus. It meets all passages that can match it, and no others: sending every automaton to every document
would cost the product of the two.

NULL and empty texts have no words. Rows that share an identifier count as one document for "earlier": of two equal
windows at the same place neither is earlier. A NULL identifier is smaller than all others. An empty table gives no
rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tiffin.llm.repeats import Block, Words, remove_repeats


class SuffixAutomaton:
    """Automaton of all substrings of the sequences added so far. States are numbers, 0 is the empty string."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def extend(self, last: int, token) -> int:
        """State of the sequence that ended in ``last``, with one more token."""
        next_, link, length = self.next, self.link, self.length
        if token in next_[last]:
            q = next_[last][token]
            return q if length[last] + 1 == length[q] else self._clone(last, q, token)
        new = len(next_)
        next_.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and token not in next_[p]:
            next_[p][token] = new
            p = link[p]
        if p >= 0:
            q = next_[p][token]
            link[new] = q if length[p] + 1 == length[q] else self._clone(p, q, token)
        return new

    def _clone(self, p: int, q: int, token) -> int:
        next_, link, length = self.next, self.link, self.length
        copy = len(next_)
        next_.append(dict(next_[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = copy
        while p >= 0 and next_[p].get(token) == q:
            next_[p][token] = copy
            p = link[p]
        return copy

    def step(self, state: int, matched: int, token) -> tuple[int, int]:
        """Matching statistics: longest suffix of what was read that the automaton knows, after one more token."""
        next_, link = self.next, self.link
        while state and token not in next_[state]:
            state = link[state]
            matched = self.length[state]
        if token in next_[state]:
            return next_[state][token], matched + 1
        return 0, 0

    def statistics(self, tokens: list) -> list[int]:
        state = matched = 0
        out = []
        for token in tokens:
            state, matched = self.step(state, matched, token)
            out.append(matched)
        return out

    def read(self, tokens: list) -> list[int]:
        """Statistics against everything earlier, this sequence's own beginning included; then it is known."""
        state = matched = last = 0
        out = []
        for token in tokens:
            state, matched = self.step(state, matched, token)
            out.append(matched)
            last = self.extend(last, token)
            while state and matched <= self.length[self.link[state]]:  # a clone took the shorter ones
                state = self.link[state]
        return out


def earlier_windows(window: int):
    def run(pieces: list[bytes], doc: np.ndarray, place: np.ndarray) -> np.ndarray:
        n = np.array([p.count(b" ") + 2 - window for p in pieces], dtype=np.int64)
        at = np.concatenate(([0], np.cumsum(n)))
        flags = np.zeros(at[-1], dtype=bool)
        automaton = SuffixAutomaton()
        seen: dict[bytes, tuple[int, int]] = {}
        order = np.lexsort((place, doc))
        k = 0
        while k < len(order):
            # Passages at the same place (of rows that share an identifier) are read before any of them is added.
            same = k + 1
            while same < len(order) and doc[order[same]] == doc[order[k]] and place[order[same]] == place[order[k]]:
                same += 1
            new = []
            for i in order[k:same].tolist():
                if pieces[i] in seen and seen[pieces[i]] != (doc[i], place[i]):
                    flags[at[i] : at[i + 1]] = True
                    continue
                tokens = pieces[i].split(b" ")
                matched = np.array(automaton.statistics(tokens)[window - 1 :]) >= window
                flags[at[i] : at[i + 1]] = matched
                if not matched.all():
                    new.append((i, tokens))
                seen.setdefault(pieces[i], (doc[i], place[i]))
            for j, (i, tokens) in enumerate(new):
                own = np.array(automaton.read(tokens)[window - 1 :]) >= window
                if j == 0 and len(new) == 1:
                    flags[at[i] : at[i + 1]] |= own
                elif len(set(tokens)) < len(tokens):  # only what it repeats of itself
                    flags[at[i] : at[i + 1]] |= np.array(SuffixAutomaton().read(tokens)[window - 1 :]) >= window
            k = same
        return flags

    return run


def _rows(block: Block, gone: np.ndarray) -> list[pa.Array]:
    kept, digest = [], []
    for a, b in zip(block.first[:-1].tolist(), block.first[1:].tolist(), strict=True):
        own = gone[a:b]
        if a == b or own.all():
            text = b""
        elif not own.any():
            text = block.piece(a, b)
        else:
            edge = np.flatnonzero(np.diff(np.concatenate(([True], own, [True])).astype(np.int8))).reshape(-1, 2) + a
            text = b" ".join(block.piece(x, y) for x, y in edge.tolist())
        kept.append(text)
        digest.append(hashlib.sha256(text).hexdigest())
    total = np.concatenate(([0], np.cumsum(gone)))
    return [
        pa.array(np.diff(block.first)),
        pa.array(total[block.first[1:]] - total[block.first[:-1]]),
        pa.array([x.decode("utf-8", "replace") for x in kept], pa.string()),
        pa.array(digest, pa.string()),
    ]


def remove_repeated_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, shard_bytes: int = 1 << 20
) -> DataFrame:
    """Identifier, n_words, n_removed, kept (the words left, joined by one space), kept_sha256 per row of ``docs``."""
    return remove_repeats(
        docs, id_col, text_col, Words(window, min(8, window)), earlier_windows(window), shard_bytes, _rows,
        "n_words bigint, n_removed bigint, kept string, kept_sha256 string",
    )
