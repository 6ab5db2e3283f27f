"""Exact top-k search by BM25 with block-max WAND.

Words are runs of letters and digits in lower case. A shard is a part of the documents that a task holds, at most
``shard_docs`` and about ``shard_postings``: its inverted index is built once and is a row of a table in the shared
folder. The corpus statistics (documents, mean length, documents per word) are sums over that table. Scores use the
corpus statistics, so a document has the same score in any shard and the merge, the k best of each query over all
shards, is exact however rows are dealt.

Queries stay a table: their words are joined with the documents per word and gathered by passes of about
``PASS_BLOCKS * query_block``, or ``PASS_BLOCKS * BLOCK_WORDS`` words if they are long. The queries of a pass are packed:
their distinct words, and numbers and weights as bytes, in pieces. They are broadcast; a task gets them before its first
shard, keeps them, and holds one shard at a time. The k-th best score that a query has in a task's shards so far is where
it starts in the next. Of more than ``FIRST`` shards, one of so many is asked first; the k-th best score that a query has
there is where it starts in all others. A task hands on the k best of all its shards for each query of the pass.

All queries are pruned by the greatest scores of blocks of postings. Of at most ``PIVOT_WORDS`` words, block-max WAND goes
through the documents in order. Terms are sorted by their current document; the pivot is the first
at which the sum of the terms' greatest scores passes the k-th best score. If the greatest scores of the blocks that
hold the pivot don't pass it, everything up to the end of the shortest of these blocks is skipped; else the terms are
moved to the pivot and the document is scored. Of more words, such as whole documents, the pivot would stand at nearly
every document: blocks are then about ranges of ``RANGE`` documents, the bounds of all ranges are added up in one go, and
the ranges of the greatest bounds are scored first, if a query's k-th best score isn't known; then all whose bound passes
it. ``TOGETHER`` queries do so at once, those with the most postings in the shard first, by products of matrices for words
that are frequent in queries and shard, and by lists of the words' queries for the others.
A query whose bound over the whole shard doesn't pass its k-th best score isn't looked at. The work of queries that grow
with the documents stays quadratic.

A query's key is a hash of identifier and text: queries with a NULL identifier are asked too, queries that share an
identifier each have their own ranks from 1, and a query row that is there twice gives its rows twice.

Equal scores are ordered by identifier, NULL last. A word that a query repeats counts as often. NULL and empty texts
have no words and never match; a query without words that occur has no rows. Rows that share an identifier are
documents of their own. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import re
import uuid
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.words import give_back
from tiffin.session import stage

WORD = re.compile(r"[^\W_]+")
PARTED = bytes(i if i > 127 or chr(i).isalnum() else 32 for i in range(256))  # no byte of another letter is below 128
POSTINGS = 64
K1, B = 1.2, 0.75
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
RANGE = 32  # neighbouring documents that a block is about
BLOCK_WORDS = 1 << 19  # words of queries in a block
PASS_BLOCKS = 3  # blocks of a pass, for which a shard is unpacked once
PIECE = 1 << 21  # bytes of a part of a pass's queries in a row
ROWS = 256  # texts that are Python objects at a time
PIVOT_WORDS = 8  # words up to which the pivot is moved document by document
PIVOT_POSTINGS = 256  # postings of them in a shard, of more all documents are scored sooner
SORTED = 3  # shards whose documents are put in order together
FIRST = 16  # a pass asks one shard of so many first
FIRST_TASKS = 2  # tasks a core for these
TOGETHER = 512  # longer queries whose blocks are scored together
LIST_COST = 200  # what a posting of a list costs, in multiplications of a product of matrices
FREQUENT = 1 << 11  # words of such a product at most
ADDED = 1 << 16  # postings of lists that are added up at a time


def words(text: str | None) -> list[str]:
    if not text:
        return []
    text = text.lower()
    found = text.encode("utf-8", "surrogatepass").translate(PARTED).decode("utf-8", "surrogatepass").split()
    if text.isascii():
        return found
    return [w for part in found for w in ((part,) if part.isalnum() else WORD.findall(part))]


class Postings:
    """Documents of a word in a shard, with scores and the greatest score of each block."""

    __slots__ = ("docs", "scores", "most", "ends", "best", "at")

    def __init__(self, docs: list[int], scores: list[float]):
        self.docs, self.scores, self.at = docs, scores, 0
        self.best = [max(scores[i : i + POSTINGS]) for i in range(0, len(docs), POSTINGS)]
        self.ends = [docs[min(i + POSTINGS, len(docs)) - 1] for i in range(0, len(docs), POSTINGS)]
        self.most = max(self.best)


def best_documents(lists: list[tuple[float, Postings]], k: int, order: list, doc_count: int, least: float = 0.0) -> list[tuple[float, int]]:
    """The k best (score, document) by block-max WAND. ``order`` ranks documents of equal score, ``least`` is the score
    under which they may be left out."""
    heap: list[tuple[float, tuple, int]] = []  # the worst of the best on top
    bar = least
    live = []
    for number, (times, p) in enumerate(lists):
        p.at = 0
        live.append((p.docs[0], number, times, p))
    slack = 1 + 1e-9  # bounds and scores are added in different orders
    while live:
        live.sort(key=lambda x: x[0])
        total, pivot = 0.0, -1
        for i, (_, _, times, p) in enumerate(live):
            total += times * p.most
            if total * slack >= bar:
                pivot = i
                break
        if pivot < 0:
            break
        doc = live[pivot][0]
        while pivot + 1 < len(live) and live[pivot + 1][0] == doc:
            pivot += 1
        bound, limit = 0.0, doc_count
        for _, _, times, p in live[: pivot + 1]:
            block = bisect_left(p.ends, doc, p.at // POSTINGS)
            if block < len(p.ends):
                bound += times * p.best[block]
                limit = min(limit, p.ends[block] + 1)
        if bound * slack < bar:
            if pivot + 1 < len(live):
                limit = min(limit, live[pivot + 1][0])
            target = max(limit, doc + 1)
        else:
            target = doc
            if live[0][0] == doc:
                parts = sorted((number, times * p.scores[p.at]) for at, number, times, p in live[: pivot + 1])
                score = 0.0
                for _, x in parts:  # always added in the order of the query's words, and plainly, as elsewhere
                    score += x
                entry = (score, order[doc], doc)
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
                bar = max(least, heap[0][0]) if len(heap) == k else least
                target = doc + 1
        moved = []
        for entry in live[: pivot + 1]:
            at, number, times, p = entry
            if at >= target:
                moved.append(entry)
                continue
            p.at = bisect_left(p.docs, target, p.at)
            if p.at < len(p.docs):
                moved.append((p.docs[p.at], number, times, p))
        live = moved + live[pivot + 1 :]
    return [(score, doc) for score, _, doc in sorted(heap, reverse=True)]


def _index(shard_docs: int, shard_postings: int):
    """One row per shard: documents with identifiers and lengths, and the postings in the order of words. Documents are
    ordered by their commonest word and their length, ``SORTED`` shards at a time, so that a shard's documents are alike
    (of one language, for one thing), neighbours still more so, and bounds are close to scores."""

    def pack(ids: list, lengths: np.ndarray, names: pa.Array, word: np.ndarray, times: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        order = np.argsort(word, kind="stable")
        own, sizes = np.unique(word, return_counts=True)
        arrays = [
            sizes.astype(np.int32),
            *[np.array([x or 0 for x in ids], np.int64), np.array([x is not None for x in ids], bool), lengths],
            *[doc[order], times[order]],
        ]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([uuid.uuid4().hex]),
                pa.array([len(ids)], pa.int64()),
                pa.array([int(lengths.sum())], pa.int64()),
                pa.array([" ".join(names.take(pa.array(own)).to_pylist()).encode()], pa.binary()),
                *[pa.array([x.tobytes()], pa.binary()) for x in arrays],
            ],
            INDEX_NAMES,
        )

    def cut(ids: list, lengths: array, common: list, found: list, times: array, ends: array) -> Iterator[pa.RecordBatch]:
        alike = sorted(range(len(ids)), key=lambda i: (common[i], lengths[i]))
        coded = pa.chunked_array(found).unify_dictionaries()
        terms = coded.chunk(0).dictionary
        order = pc.array_sort_indices(terms)
        place = np.empty(len(terms), np.int32)
        place[order.to_numpy()] = np.arange(len(terms), dtype=np.int32)
        terms = terms.take(order)
        word_ = place[np.concatenate([c.indices.to_numpy() for c in coded.chunks])]
        found.clear()
        del coded
        times_ = np.frombuffer(times, np.int32) if len(times) else np.zeros(0, np.int32)
        ends_, lengths_ = np.frombuffer(ends, np.int64), np.frombuffer(lengths, np.int64)
        sizes = np.diff(ends_, prepend=0)
        pa.default_memory_pool().release_unused()
        at = 0
        while at < len(alike):
            part = np.array(alike[at : at + shard_docs])
            held = np.cumsum(sizes[part])
            if 8 * held[-1] > 9 * shard_postings:  # no shard of a few documents is left
                part = part[: int(np.searchsorted(held, shard_postings)) + 1]
            at += len(part)
            own = _runs(ends_[part] - sizes[part], sizes[part])
            yield pack([ids[i] for i in part.tolist()], lengths_[part], terms, word_[own], times_[own], sizes[part])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def new():
            return [], array("q"), [], [], array("i"), array("q")

        held = ids, lengths, common, found, times, ends = new()
        for part in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            names: list[str] = []
            for id_, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                own = words(text)
                count = Counter(own)
                names += count
                times.extend(count.values())
                ends.append(len(times))
                ids.append(id_)
                lengths.append(len(own))
                common.append(max(count, key=count.__getitem__) if count else "")
                if len(ids) >= SORTED * shard_docs or len(times) >= SORTED * shard_postings:
                    found.append(pa.array(names, pa.string()).dictionary_encode())
                    yield from cut(*held)
                    held = ids, lengths, common, found, times, ends = new()
                    names = []
            found.append(pa.array(names, pa.string()).dictionary_encode())
        if ids:
            yield from cut(*held)
        held = ids = lengths = common = found = times = ends = names = None
        give_back()

    return run


INDEX = "shard string, n bigint, words bigint, terms binary, sizes binary, ids binary, known binary, lengths binary, docs binary, times binary"
INDEX_NAMES = [x.split()[0] for x in INDEX.split(", ")]


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and their numbers of documents, shard by shard."""
    for batch in batches:
        for terms, sizes in zip(batch.column(0), batch.column(1), strict=True):
            s = pa.array(np.frombuffer(sizes.as_py(), np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(terms.as_py().decode().split(), pa.string()), s], ["t", "s"])


class Shard:
    """A shard's index as a task holds it."""

    def __init__(self, row: dict, mean: float):
        terms = pa.array([bytes(row["terms"]).decode()] if len(row["terms"]) else [], pa.large_string())
        self.terms = pc.split_pattern(terms, " ").flatten()
        sizes = np.frombuffer(row["sizes"], np.int32).astype(np.int64)
        self.sizes, self.ends = sizes, np.cumsum(sizes)
        self.ids, self.lengths = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["lengths"], np.int64)
        self.known = np.frombuffer(row["known"], bool)
        self.docs, times = np.frombuffer(row["docs"], np.int32), np.frombuffer(row["times"], np.int32)
        norm = K1 * (1 - B + B * self.lengths / mean) if mean else np.zeros(len(self.ids))
        self.scores = times * (K1 + 1) / (times + norm[self.docs])
        # Rank of a document among those of equal score: the smallest identifier is best, NULL is last.
        self.rank = np.empty(len(self.ids), dtype=np.int64)
        self.rank[np.lexsort((self.ids, ~self.known))] = np.arange(len(self.ids))
        self.most = np.maximum.reduceat(self.scores, self.ends - sizes) if len(sizes) else np.zeros(0)
        self.postings: dict[int, Postings] = {}
        self.n_blocks = -(-len(self.ids) // RANGE)
        # The same postings by document, each document's in the order of words.
        by_doc = np.argsort(self.docs.astype(np.uint16) if len(self.ids) <= 1 << 16 else self.docs, kind="stable")
        self.word = np.repeat(np.arange(len(sizes)), sizes)[by_doc]
        self.score = self.scores[by_doc]
        self.doc = self.docs[by_doc].astype(np.int64)
        self.of_doc = np.append(0, np.cumsum(np.bincount(self.docs, minlength=len(self.ids))))
        self.weight = np.zeros(len(sizes))  # of the words of one query at a time
        self.skipped = 0

    @cached_property
    def place(self) -> dict[str, int]:
        return {t: i for i, t in enumerate(self.terms.to_pylist())}

    @cached_property
    def order(self) -> list[int]:
        return (-self.rank).tolist()

    def best(self, asked: list[tuple[str, float]], k: int, bar: float = 0.0) -> list[tuple[float, int]]:
        """The k best (score, document) for words with their weights, in the order of words. Documents under ``bar``,
        the k-th best score that the query has elsewhere, may be left out."""
        own = [(self.place[t], w) for t, w in asked if t in self.place]
        return self.best_of([(np.array([i for i, _ in own], np.int64), np.array([w for _, w in own], float))], k, [bar])[0]

    def best_of(self, asked: list[tuple[np.ndarray, np.ndarray]], k: int, bars: list[float]) -> list[list[tuple[float, int]]]:
        """The same for several queries, of places of words in this shard."""
        if not asked:
            return []
        words, weights = (np.concatenate(x) for x in zip(*asked, strict=True))
        found = dict(self.best_of_flat(words, weights, np.array([len(w) for w, _ in asked]), k, np.array(bars, float)))
        return [found.get(i, []) for i in range(len(asked))]

    def best_of_flat(
        self, words: np.ndarray, weights: np.ndarray, count: np.ndarray, k: int, bars: np.ndarray
    ) -> Iterator[tuple[int, list[tuple[float, int]]]]:
        """The same, of queries one after the other, each with ``count`` words: the number of each that finds something."""
        query = np.repeat(np.arange(len(count)), count)
        held = np.bincount(query, self.sizes[words], len(count))  # postings of a query's words
        # What no document of this shard passes. It is added in another order than scores.
        over = np.bincount(query, weights * self.most[words], len(count)) * (1 + 1e-9) >= bars
        self.skipped += self.n_blocks * int(np.count_nonzero(~over))
        over &= count > 0
        del query
        few = (count <= PIVOT_WORDS) & (held <= PIVOT_POSTINGS)
        end = np.cumsum(count)

        def own(i: int) -> tuple[np.ndarray, np.ndarray]:
            return words[end[i] - count[i] : end[i]], weights[end[i] - count[i] : end[i]]

        for i in np.flatnonzero(over & few).tolist():
            lists = [(w, self._postings(x)) for x, w in zip(*(x.tolist() for x in own(i)), strict=True)]
            if best := best_documents(lists, k, self.order, len(self.ids), float(bars[i])):
                yield i, best
        many = np.flatnonzero(over & ~few)
        # Queries with many postings here, such as those of the shard's language, are scored with their like.
        many = many[np.argsort(-held[many], kind="stable")]
        for part in (many[at : at + TOGETHER] for at in range(0, len(many), TOGETHER)):
            for i, best in zip(part.tolist(), self._by_blocks([own(i) for i in part.tolist()], k, bars[part]), strict=True):
                if best:
                    yield i, best

    def _postings(self, word: int) -> Postings:
        if word not in self.postings:
            x, y = int(self.ends[word] - self.sizes[word]), int(self.ends[word])
            self.postings[word] = Postings(self.docs[x:y].tolist(), self.scores[x:y].tolist())
        return self.postings[word]

    def _by_blocks(self, asked: list[tuple[np.ndarray, np.ndarray]], k: int, bar: np.ndarray) -> list[list[tuple[float, int]]]:
        """For many words a pivot would stand at nearly every document. Words are parted in two: the postings of rare
        ones are added up for all documents; of frequent ones, which have most of the postings, only the greatest scores
        of blocks are. Blocks are scored if their bound reaches the query's k-th best score, some of the greatest bounds
        first if it isn't known; a block is scored for all queries that want it in one product of matrices. These numbers are of single precision and never too small by more than ``slack``;
        documents that may be among the k best get their scores once more, in double precision."""
        count, n = len(asked), len(self.ids)
        lengths = np.array([len(w) for w, _ in asked])
        words, weights = (np.concatenate(x) for x in zip(*asked, strict=True))
        query = np.repeat(np.arange(count), lengths)
        # A product costs all queries and documents; a list costs its postings, each time it is asked for.
        cost = (self.sizes * np.bincount(words, minlength=len(self.sizes)))[words]
        frequent = np.flatnonzero(np.bincount(words, cost * LIST_COST >= count * n, len(self.sizes)))
        frequent = frequent[np.argsort(-self.sizes[frequent], kind="stable")[:FREQUENT]]
        column = np.full(len(self.sizes), -1)
        column[frequent] = np.arange(len(frequent))
        here = column[words]
        rare, here = np.flatnonzero(here < 0), np.flatnonzero(here >= 0)
        slack = (len(frequent) + int(lengths.max()) + 16) * 2.0**-22  # several times what so many additions can lose
        up, down = np.float32(1 + slack), 1 - slack

        weight = np.zeros((count, len(frequent)), np.float32)
        weight[query[here], column[words[here]]] = weights[here]
        length = self.sizes[frequent]
        at = _runs(self.ends[frequent] - length, length)
        score = np.zeros((self.n_blocks * RANGE, len(frequent)), np.float32)
        score[self.docs[at], np.repeat(np.arange(len(frequent)), length)] = self.scores[at]
        score = score.reshape(self.n_blocks, RANGE, len(frequent))
        total = self._rare(words[rare], weights[rare], query[rare], count)
        bound = score.max(axis=1) @ weight.T
        bound += total.max(axis=1)

        able: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # queries and documents that may be among the k best, with scores
        top = np.repeat(bar.astype(np.float32)[:, None], k, axis=1)
        first = min(max(2, k // RANGE + 1), self.n_blocks)  # blocks that give a k-th best score, if it isn't known
        early = np.zeros(bound.shape, bool)
        new = np.flatnonzero(bar <= 0)
        early[np.argpartition(-bound[:, new], first - 1, axis=0)[:first], new] = True
        for now in (early, ~early) if len(new) else (~early,):
            for block in range(self.n_blocks):
                reach = np.where(now[block], bound[block], 0)
                rows = np.flatnonzero((reach * up >= bar) & (reach > 0))
                self.skipped += int(np.count_nonzero(reach)) - len(rows)
                if not len(rows):
                    continue
                if 4 * len(rows) > count:  # many of these queries: without a copy of their weights
                    scored = (score[block] @ weight.T + total[block])[:, rows]
                else:
                    scored = score[block] @ weight[rows].T + total[block][:, rows]
                passes = scored.max(axis=0) * up >= bar[rows]
                better, scored = rows[passes], scored[:, passes]
                if not len(better):
                    continue
                docs, who = np.nonzero((scored * up >= bar[better]) & (scored > 0))
                able.append((better[who], docs + block * RANGE, scored[docs, who]))
                top[better] = np.partition(np.concatenate([top[better], scored.T], axis=1), RANGE, axis=1)[:, RANGE:]
                bar[better] = np.maximum(bar[better], top[better].min(axis=1).astype(float) * down)
        if not able:
            return [[] for _ in asked]
        who, docs, scored = (np.concatenate(x) for x in zip(*able, strict=True))
        left = np.flatnonzero(scored * up >= bar[who])
        left = left[np.lexsort((docs[left], who[left]))]
        docs, cut = docs[left], np.searchsorted(who[left], np.arange(count + 1)).tolist()
        return [self._exact(*asked[i], docs[cut[i] : cut[i + 1]], k) if cut[i] < cut[i + 1] else [] for i in range(count)]

    def _rare(self, words: np.ndarray, weights: np.ndarray, query: np.ndarray, count: int) -> np.ndarray:
        """Sums of the parts of words by document and query. Documents meet a word's queries, some postings at a time."""
        total = np.zeros((self.n_blocks * RANGE, count), np.float32)
        by_word = np.argsort((words & 0xFFFF).astype(np.uint16), kind="stable")  # numbers of 16 bits are sorted in few passes
        by_word = by_word[np.argsort((words[by_word] >> 16).astype(np.uint16), kind="stable")]
        pairs = _pairs(query[by_word], weights[by_word])
        asks = np.bincount(words, minlength=len(self.sizes))
        own = np.flatnonzero(asks.take(self.word))  # by document
        word = self.word.take(own)
        length = asks.take(word)
        start = (np.cumsum(asks) - asks).take(word)
        row = self.doc.take(own) * count
        score = self.score.take(own).astype(np.float32)
        done = np.cumsum(length)
        flat_total = total.reshape(-1)
        x = 0
        while x < len(own):
            z = max(x + 1, int(np.searchsorted(done, (done[x - 1] if x else 0) + ADDED, "right")))
            pair = pairs.take(_runs(start[x:z], length[x:z]))
            flat = np.repeat(row[x:z], length[x:z])
            flat += pair.view(np.int32)[::2]
            part = np.repeat(score[x:z], length[x:z])
            part *= pair.view(np.float32)[1::2]
            np.add.at(flat_total, flat, part)
            x = z
        return total.reshape(self.n_blocks, RANGE, count)

    def _exact(self, words: np.ndarray, weights: np.ndarray, docs: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The k best of some documents. The parts of a score are added in the order of the query's words."""
        self.weight[words] = weights
        cuts = zip(self.of_doc[docs].tolist(), self.of_doc[docs + 1].tolist(), strict=True)
        total = np.array([(self.weight.take(self.word[x:y]) * self.score[x:y]).cumsum()[-1] for x, y in cuts])
        self.weight[words] = 0
        chosen = np.lexsort((self.rank[docs], -total))[:k]
        return list(zip(total[chosen].tolist(), docs[chosen].tolist(), strict=True))


def _pairs(number: np.ndarray, value: np.ndarray) -> np.ndarray:
    """A number and a value of single precision in one number, which is looked up at once."""
    both = np.empty((len(number), 2), np.int32)
    both[:, 0], both[:, 1] = number, value.astype(np.float32).view(np.int32)
    return both.view(np.int64).ravel()


def _runs(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers of runs that begin at ``first``, one run after the other."""
    return np.repeat(first - (np.cumsum(length) - length), length) + np.arange(length.sum())


BLOCK = "block bigint, piece int, keys binary, vocabulary binary, ends binary, numbers binary, weights binary"
BLOCK_NAMES = [x.split()[0] for x in BLOCK.split(", ")]


def _pack(queries: pa.Table) -> pa.Table:
    """The queries of a pass: their keys, their distinct words, and each query's words by number, with weights, as bytes.
    They are cut into pieces of about ``PIECE`` bytes, each a row."""
    asked = queries.column("asked").combine_chunks()
    pairs = asked.flatten()
    coded = pc.struct_field(pairs, "t").dictionary_encode()
    ends = np.cumsum(pc.list_value_length(asked).to_numpy(), dtype=np.int64)
    weights = pc.struct_field(pairs, "w").to_numpy()
    packed = [
        " ".join(queries.column("key").to_pylist()).encode(),
        " ".join(coded.dictionary.to_pylist()).encode(),
        *[x.tobytes() for x in (ends, coded.indices.to_numpy(), weights)],
    ]
    count = max(1, -(-max(map(len, packed)) // PIECE))
    cut = [pa.array([x[len(x) * i // count : len(x) * (i + 1) // count] for i in range(count)], pa.binary()) for x in packed]
    block = pa.array(queries.column("block")[:1].to_pylist() * count, pa.int64())
    return pa.table([block, pa.array(range(count), pa.int32()), *cut], BLOCK_NAMES)


def _search(mean: float, k: int):
    """A row is a shard, or a piece of the queries to ask from the next shard on, or both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[float, bool, int]]] = {}  # each query's k best so far: score, NULL and identifier
        pieces: list[dict[str, bytes]] = []
        least: dict[str, float] = {}
        shard = None
        for batch in batches:
            at = {x: batch.column(x) for x in batch.schema.names}
            for i in range(batch.num_rows):
                if at["keys"][i].is_valid:
                    pieces.append({x: at[x][i].as_py() for x in BLOCK_NAMES[2:]})
                    if "led" in at and at["led"][i].is_valid:
                        least = dict(zip(at["led"][i].as_py().split(), at["bars"][i].as_py(), strict=True))
                if not at["shard"][i].is_valid:
                    continue
                shard = None  # one shard at a time
                pa.default_memory_pool().release_unused()
                if pieces:
                    whole = {x: b"".join(piece[x] for piece in pieces) for x in BLOCK_NAMES[2:]}
                    pieces = []
                    keys = whole["keys"].decode().split()
                    vocabulary = pc.split_pattern(pa.array([whole["vocabulary"]], pa.large_binary()).cast(pa.large_string()), " ").flatten()
                    ends, numbers, weights = (np.frombuffer(whole[x], t) for x, t in (("ends", np.int64), ("numbers", np.int32), ("weights", float)))
                    del whole
                    bars = np.array([least.get(key, 0.0) for key in keys])
                    for n, key in enumerate(keys):
                        if len(held.get(key, ())) == k:
                            bars[n] = max(bars[n], -held[key][-1][0])
                shard = Shard({x: at[x][i].as_buffer() if pa.types.is_binary(at[x].type) else at[x][i].as_py() for x in INDEX_NAMES}, mean)
                place = pc.fill_null(pc.index_in(vocabulary, shard.terms), -1).to_numpy()[numbers]
                here = np.flatnonzero(place >= 0)
                count = np.diff(np.searchsorted(here, ends), prepend=0)
                for n, found in shard.best_of_flat(place[here].astype(np.int64), weights[here], count, k, bars):
                    new = [(-score, not shard.known[doc], int(shard.ids[doc])) for score, doc in found]
                    held[keys[n]] = best = sorted(held.get(keys[n], []) + new)[:k]
                    if len(best) == k:
                        bars[n] = max(bars[n], -best[-1][0])
        shard = place = here = vocabulary = numbers = weights = None
        give_back()
        found = [(key, None if null else id_, -score) for key, best in held.items() for score, null, id_ in best]
        keys, ids, scores = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array(ids, pa.int64()), pa.array(scores, pa.float64())], ["key", "id", "score"]
        )

    return run


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
        found = [Counter(words(t)) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, f in zip(batch.column(0).to_pylist(), found, strict=True) for _ in f], pa.string()),
                pa.array([t for f in found for t in f], pa.string()),
                pa.array([n for f in found for n in f.values()], pa.int64()),
            ],
            ["key", "t", "m"],
        )


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_id_col: str = "item_id",
    query_text_col: str = "text",
    shard_docs: int = 1 << 12,
    query_block: int = 1 << 10,
    shard_postings: int = 1 << 19,
) -> DataFrame:
    """query, rank (from 1), identifier, score: the k documents with the greatest BM25 score for each query."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    index = stage(rows.mapInArrow(_index(shard_docs, shard_postings), INDEX), "index")
    n, total, shards = index.agg(F.sum("n"), F.sum("words"), F.count("*")).first()
    n, mean = n or 0, (total or 0) / n if n else 0.0
    sizes = index.select("terms", "sizes").mapInArrow(_sizes, "t string, s int")
    df = stage(sizes.groupBy("t").agg(F.sum("s").alias("df")), "frequencies")

    given = queries.select(F.col(query_id_col).cast("bigint").alias("q"), F.col(query_text_col).cast("string").alias("text"))
    # Equal rows are searched once. Identifiers may be NULL or shared: the key is a hash of identifier and text.
    key = F.sha2(F.concat(F.coalesce(F.col("q").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit(""))), 256)
    keyed = given.withColumn("key", key)
    named = stage(keyed.groupBy("key").agg(F.min("q").alias("query"), F.count("*").alias("copies")), "queries")
    asked = keyed.dropDuplicates(["key"]).select("key", "text").mapInArrow(_words, "key string, t string, m bigint")
    idf = F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = asked.join(df, "t").select("key", F.struct("t", (F.col("m") * idf).alias("w")).alias("e"))
    grouped = stage(weighted.groupBy("key").agg(F.sort_array(F.collect_list("e")).alias("asked")), "asked")
    asked_words = grouped.agg(F.sum(F.size("asked"))).first()[0] or 0
    count = max(1, -(-named.count() // (PASS_BLOCKS * query_block)), -(-asked_words // (PASS_BLOCKS * BLOCK_WORDS)))
    block = F.pmod(F.xxhash64("key"), F.lit(count)).cast("bigint").alias("block")
    blocks = stage(grouped.select(block, "key", "asked").groupBy("block").applyInArrow(_pack, BLOCK), "blocks")
    # A pass brings some blocks of queries to every shard. Its result is written, so that these are all in memory at a time.
    spark, parts = docs.sparkSession, []
    pieces = F.sort_array(F.collect_list(F.struct(*BLOCK_NAMES[1:]))).alias("pieces")
    blocks = blocks.groupBy("block").agg(pieces)
    # A task keeps the queries that come before its first shard: rows are counted in the partition that goes into Python.
    begins = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0

    def found_in(shards: DataFrame, blocks: DataFrame) -> DataFrame:
        led = [F.when(begins, F.col(x)).alias(x) for x in blocks.columns if x in ("led", "bars")]
        given = shards.crossJoin(F.broadcast(blocks)).select(*INDEX_NAMES, F.when(begins, F.col("pieces")).alias("pieces"), *led)
        given = given.withColumn("last", F.size("pieces") - 1).select("*", F.posexplode_outer("pieces").alias("at", "piece"))
        # A shard comes with the last piece, or without any.
        shard = [F.when(F.col("at").isNull() | (F.col("at") == F.col("last")), F.col(x)).alias(x) for x in INDEX_NAMES]
        led = [F.when(F.col("at") == 0, F.col(x)).alias(x) for x in blocks.columns if x in ("led", "bars")]
        given = given.select(*shard, *[F.col("piece")[x].alias(x) for x in BLOCK_NAMES[2:]], *led)
        return stage(given.mapInArrow(_search(mean, k), "key string, id bigint, score double"), "found")

    rows_at_once = spark.conf.get(BATCH)
    spark.conf.set(BATCH, "1")  # a row is a whole shard: a task gets them one by one
    try:
        for i in range(count):
            asked_now = blocks.where(F.col("block") == i)
            if shards <= FIRST:
                parts.append(found_in(index, asked_now))
                continue
            chance = F.pmod(F.xxhash64("shard"), F.lit(FIRST))
            # They go to few tasks: a task's k best of a shard are where it starts in its next.
            first = found_in(index.where(chance == 0).coalesce(FIRST_TASKS * spark.sparkContext.defaultParallelism), asked_now)
            # No document under the k-th best score that some shards give has to be looked at in the others.
            last = first.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score")))).where(F.col("rank") == k)
            bars = last.groupBy(block).agg(F.collect_list(F.struct("key", "score")).alias("e"))
            bars = bars.select("block", F.array_join("e.key", " ").alias("led"), F.col("e.score").alias("bars"))
            parts += [first, found_in(index.where(chance != 0), asked_now.join(bars, "block", "left"))]
    finally:
        spark.conf.set(BATCH, rows_at_once)
    best = Window.partitionBy("key").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    found = reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(best).cast("bigint")).where(F.col("rank") <= k)
    return (
        found.join(named, "key")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select("query", "rank", F.col("id").alias(id_col), "score")
    )
