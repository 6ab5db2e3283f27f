"""Token identifiers in flat binary files that can be mapped into memory.

Format of a folder: every partition ``NNNNN-XXXXXXXX`` (number and attempt) is a set of three files,

* ``.tok``: identifiers of all its documents one after the other, little-endian unsigned integers (16 bits if the
  vocabulary and the end mark fit, else 32);
* ``.off``: 64-bit offsets, one more than it has documents: document i has the identifiers [off[i], off[i+1]);
* ``.doc``: 64-bit document identifiers, -2^63 for NULL.

``write_tokens`` returns the manifest, one row per partition: file names, numbers of documents and identifiers, and
``base``, the number of identifiers in all partitions before it, a prefix sum. Document i of a partition starts at
base + off[i]. A window over a partition or over the whole corpus is found by two binary searches, without reading.

Documents are sorted by identifier across partitions (range partitioning, then a sort in each partition). A task
writes files under names of its own and the manifest names those of the attempt that succeeded, so a lost executor or
a second attempt leaves unnamed files at worst. The folder must be one that all executors reach; it is opened with
pyarrow's file systems, and mapped into memory where it is a mounted path.

NULL and empty texts have no identifiers but the end mark. A NULL identifier sorts first, rows with equal identifiers
follow in the order of a hash of their texts. An empty table gives an empty manifest. Other columns are ignored.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiffin.llm.words import give_back, utf8, values
from tiffin.session import shared_folder, stage

NULL_ID = -(1 << 63)
CACHED_WORDS = 1 << 18
GROUP = 1 << 21  # bytes of texts whose words are looked up at once


# A run of ASCII marks after a letter of a-z or Latin-1 and before white space: a piece of its own for a tokenizer that
# splits letters from marks, whatever else the word has.
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
_MARK = re.compile(
    rb"[!-/:-@\[-`{-~](?:(?<=[A-Za-z].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))[!-/:-@\[-`{-~]*+(?=[ \t-\r]|\Z)"
)
_PROBES = ("ab cd", "a  b\n\nc", "x\ty", "don't 12 3a", "\u00e9. \u0130 \u0301a", ". .", "## a-b\r\n(c) ")


class WordwiseEncoder:
    """The tokenizers library's identifiers of a text, looked up by word.

    For a tokenizer that splits at white space, the identifiers of a text are those of its pieces between white space,
    one after the other. Each piece is encoded once and kept, by what the library gives for this piece. Pieces are kept
    in two generations of about ``CACHED_WORDS`` / 2: when the young one is full the old one goes, but for what has been
    used since, so frequent pieces are not encoded again. What the tokenizer does is found out by trial: one that doesn't split at white space gets whole texts; A-Z are made
    lower case first and marks are cut off words only for one to which that is the same.
    """

    def __init__(self, path: str, dtype: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.dtype = Tokenizer.from_file(path), dtype
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.wordwise = all(self._plain(p) == [i for w in p.encode().split() for i in self._plain(w.decode())] for p in _PROBES)
        self.lower = self._plain("AB Cd's \u00c9B") == self._plain("ab cd's \u00c9b")
        runs = [*_MARKS, *(a + b for a in _MARKS for b in "'.#")]
        self.marks = all(self._plain(f"{w}{m} x") == self._plain(f"{w} {m} x") for w in ("ab", "'s", "3a", "\u00e9") for m in runs)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content.lower().encode() for t in added if t.content]
        # Which identifiers end a word, if the tokenizer marks the ends of words.
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = None
        if suffix and self._plain("ab cd\u00e9") == self._plain("ab") + self._plain("cd\u00e9"):
            self.ends = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, dtype=bool)
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        # Words of a-z need neither normalising nor splitting, which take longer than the encoding: the same model
        # without them, if it gives the same.
        bare = Tokenizer.from_file(path)
        bare.normalizer, bare.pre_tokenizer = None, WhitespaceSplit()
        same = all(bare.encode(p, add_special_tokens=False).ids == self._plain(p) for p in ("ab cd", "the quick brown fox zzzqx"))
        self.bare = bare if same else self.tokenizer
        # Other letters as well, once they are in lower case: tried with every one of them.
        every = " ".join(c for c in map(chr, range(128, 0x250)) if _letters(c.encode()))
        self.bare_letters = Tokenizer.from_file(path)
        self.bare_letters.normalizer = None
        self.bare_letters.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        probes = (every, "caf\u00e9 \u00dcber", "na\u00efve\u00c9 \u0160koda")
        if any(self.bare_letters.encode(p.lower(), add_special_tokens=False).ids != self._plain(p) for p in probes):
            self.bare_letters = None

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _fast(self, texts: list[bytes], tokenizer=None) -> list[list[int]]:
        """Identifiers as ``_plain`` gives them, without the places in the text."""
        strings = [t.decode("utf-8", "replace") for t in texts]
        return [e.ids for e in (tokenizer or self.tokenizer).encode_batch_fast(strings, add_special_tokens=False)]

    def _ids(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def forget(self) -> None:
        """Let go of the pieces that are known: they are most of what an encoder holds."""
        self.known, self.older = {}, {}

    def encode(self, texts: Iterable[str | bytes | None]) -> Iterator[bytes]:
        """Identifiers of each text (UTF-8 if it is bytes). Texts are split in groups of about ``GROUP`` bytes, so
        that their words take little memory and each is looked up once a group."""
        coded = (t if isinstance(t, bytes) else utf8(t) for t in texts)
        if not self.wordwise:
            yield from (self._ids(self._plain(t.decode("utf-8", "replace"))) for t in coded)
            return
        group, size = [], 0
        for text in coded:
            group.append(self._prepared(text))
            size += len(text)
            if size >= GROUP:
                yield from self._group(group)
                group, size = [], 0
        if group:
            yield from self._group(group)

    def _prepared(self, data: bytes) -> bytes:
        """The text with its pieces between white space."""
        low = data.lower()
        if any(t in low for t in self.added):  # tokens that the library finds as they are written
            return data
        data = low if self.lower else data
        return _MARK.sub(rb" \g<0>", data) if self.marks else data

    def _group(self, texts: list[bytes]) -> Iterator[bytes]:
        if len(self.known) > CACHED_WORDS // 2:
            self.known, self.older = {}, self.known
        # Only ASCII white space counts here, and bytes that aren't UTF-8 are left as they are.
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).view(pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        _, places, data = coded.dictionary.buffers()
        at = np.frombuffer(places, np.int64)[: len(coded.dictionary) + 1].tolist() if len(coded.dictionary) else [0]
        distinct = list(map((data.to_pybytes() if data else b"").__getitem__, map(slice, at[:-1], at[1:])))
        self._learn(distinct)
        ids = list(map(self.known.__getitem__, distinct))
        pool = np.frombuffer(b"".join(ids), self.dtype)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // np.dtype(self.dtype).itemsize
        codes = coded.indices.to_numpy()
        count = sizes[codes]
        ends = np.append(0, np.cumsum(count))
        found = pool[np.arange(ends[-1]) + np.repeat((np.cumsum(sizes) - sizes)[codes] - ends[:-1], count)]
        cuts = ends[lists.offsets.to_numpy()].tolist()
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            yield found[x:y].tobytes()

    def _learn(self, distinct: list[bytes]) -> None:
        """Look up the pieces that aren't known, or encode them."""
        self.known[b""] = b""
        new = set(distinct).difference(self.known)
        used = [w for w in new if w in self.older]
        self.known.update(zip(used, map(self.older.__getitem__, used), strict=True))
        rest = self._learn_letters(new.difference(used))
        for i in range(0, len(rest), 4096):
            part = rest[i : i + 4096]
            found = self._fast(part)
            every = self._ids([x for ids in found for x in ids])
            at = np.concatenate([[0], np.cumsum([len(ids) for ids in found])]) * np.dtype(self.dtype).itemsize
            self.known.update(zip(part, map(every.__getitem__, map(slice, at[:-1].tolist(), at[1:].tolist())), strict=True))

    def _learn_letters(self, new: set[bytes]) -> list[bytes]:
        """Pieces that are letters only, many in one call: a token with the end-of-word suffix ends a piece. Returns
        what is left to be encoded."""
        if self.ends is None:
            return list(new)
        simple = [w for w in new if w.isalpha() and w.islower()]  # of bytes: a-z
        letters = [w for w in new.difference(simple) if w.isalpha() or not w.isascii() and _letters(w)]
        rest = list(new.difference(simple, letters))
        width = np.dtype(self.dtype).itemsize
        for words, tokenizer in ((simple, self.bare), (letters, self.bare_letters)):
            for i in range(0, len(words), 1024):
                part = words[i : i + 1024]
                joined = b" ".join(part)
                if tokenizer is not self.bare and tokenizer:
                    joined = joined.decode("utf-8", "replace").lower().encode()
                ids = np.array(self._fast([joined], tokenizer)[0], dtype=np.int64)
                cut = (np.flatnonzero(self.ends[ids]) + 1).tolist()
                if len(cut) != len(part):
                    rest += part
                    continue
                raw, at = ids.astype(self.dtype).tobytes(), [0, *[c * width for c in cut]]
                self.known.update(zip(part, map(raw.__getitem__, map(slice, at[:-1], at[1:])), strict=True))
        return rest


def _letters(word: bytes) -> bool:
    """Whether a word stays letters when it is normalised and put in lower case: letters before U+0250, each a single
    letter in either case, but for the capital I with a dot."""
    text = word.decode("utf-8", "replace")
    return text.isalpha() and max(text) < "\u0250" and "\u0130" not in text


_ENCODERS: dict[tuple[str, str], WordwiseEncoder] = {}  # a worker process keeps its tokenizer from task to task


def _encoder(path: str, dtype: str) -> WordwiseEncoder:
    if (path, dtype) not in _ENCODERS:
        _ENCODERS[path, dtype] = WordwiseEncoder(path, dtype)
    return _ENCODERS[path, dtype]


def id_type(path: str, end_id: int) -> str:
    """Smallest unsigned type of the format that holds every identifier."""
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_file(path).get_vocab_size() - 1, end_id) < 1 << 16 else "<u4"


def _write(uri: str, path: str, end_id: int, dtype: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        fs, folder = pafs.FileSystem.from_uri(uri)
        name = f"{number:05d}-{uuid.uuid4().hex[:8]}"
        end = np.array([end_id], dtype=dtype).tobytes()
        width, docs, at = len(end), 0, 0
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        fs.create_dir(folder, recursive=True)
        streams = [fs.open_output_stream(f"{folder}/{name}.{kind}", buffer_size=1 << 20) for kind in ("tok", "off", "doc")]
        tok, off, doc = streams
        off.write(np.zeros(1, "<i8").tobytes())

        def every():
            yield first
            yield from batches

        for batch in every():
            sizes = []
            for ids in _encoder(path, dtype).encode(values(batch.column(1))):  # written as they come
                tok.write(ids)
                tok.write(end)
                sizes.append(len(ids) // width + 1)
            off.write((at + np.cumsum(sizes)).astype("<i8").tobytes())
            doc.write(np.array([NULL_ID if x is None else x for x in batch.column(0).to_pylist()], "<i8").tobytes())
            docs, at = docs + len(sizes), at + sum(sizes)
        for stream in streams:
            stream.close()
        # The tokenizer stays for the worker's next task, but idle workers hold no words beside those at work.
        _encoder(path, dtype).forget()
        give_back()
        yield pa.RecordBatch.from_arrays(
            [pa.array([x]) for x in (number, name, docs, at)], ["part", "name", "n_docs", "n_ids"]
        )

    return run


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[str, DataFrame]:
    """Encode every text with the tokenizer file at ``tokenizer``, end each document with ``end_id`` and write the
    files into ``folder`` (default: a new one in the shared folder). Returns the folder and its manifest."""
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}"
    uri = uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri
    text = F.col(text_col).cast("string").cast("binary").alias("text")  # as bytes, they needn't be decoded
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text)
    # The hash keeps many rows of one identifier from being one range; rows with equal identifiers stay adjacent.
    ordered = rows.withColumn("h", F.xxhash64("text")).repartitionByRange("id", "h").sortWithinPartitions("id", "h", "text")
    written = ordered.select("id", "text").mapInArrow(
        _write(uri, tokenizer, end_id, id_type(tokenizer, end_id)), "part bigint, name string, n_docs bigint, n_ids bigint"
    )
    parts = stage(written, "token-manifest")  # written once: the files named here are those that stay
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return uri, parts.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _open(fs: pafs.FileSystem, path: str) -> np.ndarray:
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype=np.uint8, mode="r")
    return np.frombuffer(fs.open_input_file(path).read(), dtype=np.uint8)


def _read(uri: str, dtype: str, ids_per_batch: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pafs.FileSystem.from_uri(uri)
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, off, doc = (
                    _open(fs, f"{folder}/{name}.{kind}").view(t) for kind, t in (("tok", dtype), ("off", "<i8"), ("doc", "<i8"))
                )
                a = 0
                while a < len(doc):
                    b = max(a + 1, int(np.searchsorted(off, off[a] + ids_per_batch, "right")) - 1)
                    b = min(b, len(doc), a + 10_000)
                    wide = np.asarray(ids[off[a] : off[b]]).astype("<u4")
                    cuts = (off[a : b + 1] - off[a]).tolist()
                    raw = wide.tobytes()
                    own = [raw[4 * i : 4 * j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
                    number = doc[a:b].tolist()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([None if x == NULL_ID else x for x in number], pa.int64()),
                            pa.array(np.asarray(off[a:b]) + base),
                            pa.array(np.diff(off[a : b + 1])),
                            pa.array([zlib.crc32(x) for x in own], pa.int64()),
                        ],
                        ["id", "start", "n_tokens", "ids_crc32"],
                    )
                    a = b
        give_back()

    return run


def read_tokens(
    spark: SparkSession, folder: str, manifest: DataFrame, dtype: str, id_col: str = "doc_id", ids_per_batch: int = 1 << 22
) -> DataFrame:
    """Each document of the files: identifier, number of identifiers before it, its own number with the end mark, and
    the CRC-32 of its identifiers as little-endian unsigned 32-bit integers. One task reads a partition's files."""
    rows = manifest.select("name", "base")
    files = rows.repartition(max(1, manifest.count()), "name")
    return files.mapInArrow(
        _read(folder, dtype, ids_per_batch), "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    ).withColumnRenamed("id", id_col)
