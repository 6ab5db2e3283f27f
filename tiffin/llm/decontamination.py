"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

Words are runs of letters and digits in lower case. A seed is the hash of some of the words of a window; a mask says
which places count, the others may hold any word. Windows of the benchmark items and of the documents with equal seeds
under the same mask are hits; a hit fixes a diagonal, the place in the document where the item would begin. Along a
diagonal words are compared one by one, without gaps: an item is found in a document if some ``stretch`` consecutive
aligned words of it have at least ``stretch - substitutions`` equal words.

The three masks (weight 6, span 8) are such that any stretch of 12 words with up to 2 substitutions, wherever they are,
has a window that one of them hits, so the search misses nothing that the definition asks for at the defaults
(``tests/llm`` tries all cases). For other values of ``stretch`` choose masks accordingly.

Scale. The documents are read once for hits: hashes of windows are made per document, exploded and joined with the
seeds of the items. Up to ``broadcast_seeds`` seeds (counted; 24 bytes each) are broadcast and no document row is
moved; more are joined by a shuffle that adaptive execution may split. Seeds are distinct per item and place, so copies
of items cost no more. Up to ``filter_pairs`` distinct first pairs of words of the items become a constant set, and only
windows that begin with one of them are hashed; with more, all are. Hits become distinct diagonals before anything is compared, and only documents with a hit have
their words made again.

Items shorter than ``stretch`` words can't be found. NULL and empty texts have no words. Repeated items and identifiers
of items are reported once. Rows of ``docs`` that share an identifier are judged one by one; a NULL identifier is an
identifier of its own. Empty tables give no findings. Columns of other names are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.session import stage

# Places that count in a window.
MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def once(value: Column, then) -> Column:
    """``then(value)`` with the value computed once: used in a lambda, a column's expression would run per element."""
    return F.transform(F.array(value), then)[0]


def _pair(hashes: Column, i: Column) -> Column:
    return F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1))


def _windows(rows: DataFrame, masks, pairs: list[int] | None = None) -> DataFrame:
    """All columns but the text's, and at, seed: a row for each window and mask; with ``pairs`` only for windows whose
    first two words have one of these hashes. Windows over the end of the text have fewer words; their hits are
    compared like all others."""
    hashes = F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w))
    keep = [c for c in rows.columns if c != "text"]

    def places(h: Column) -> Column:
        if pairs is None:
            return F.transform(h, lambda _, i: i)
        return F.array_compact(F.transform(h, lambda _, i: F.when(_pair(h, i).isin(pairs), i)))

    def seeds(h: Column, i: Column) -> Column:
        seed = lambda k, mask: F.xxhash64(F.lit(k), *[F.get(h, i + o) for o in mask])
        return F.array(*[F.struct(i.alias("at"), seed(k, mask).alias("seed")) for k, mask in enumerate(masks)])

    windows = once(hashes, lambda h: F.flatten(F.transform(places(h), lambda i: seeds(h, i))))
    return rows.select(*keep, F.inline(windows))


def _stretch_matches(equal: Column, stretch: int) -> Column:
    """Most equal words in ``stretch`` consecutive places, given an array of 0 and 1."""
    total = lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x)
    starts = lambda e: F.sequence(F.lit(1), F.greatest(F.size(e) - (stretch - 1), F.lit(1)))
    most = lambda e: F.array_max(F.transform(starts(e), lambda i: total(F.slice(e, i, stretch))))
    return once(equal, lambda e: F.when(F.size(e) >= stretch, most(e)).otherwise(F.lit(0)))


def find_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    stretch: int = 12,
    substitutions: int = 2,
    broadcast_seeds: int = 1 << 20,
    filter_pairs: int = 1 << 14,
    masks=MASKS,
) -> DataFrame:
    """``docs``, whose columns may not be named like this function's (``_id``, ``_hits``, ``_uid``, ``_key``, ``_doc``,
    ``_items``), with one more column, ``_found``: array of (item, matches), the items found in the document in
    ascending order, each with the most equal words in a stretch; empty if there are none."""
    known = items.select(
        F.col(item_id_col).cast("bigint").alias("item"), words_of(F.col(item_text_col).cast("string")).alias("words")
    ).where(F.size("words") >= stretch)
    known = stage(known.distinct(), "benchmark-items")
    text = known.select("item", F.size("words").alias("n"), F.array_join("words", " ").alias("text"))
    seeds = _windows(text, masks)
    seeds = stage(seeds.select("seed", "item", "at", "n").distinct(), "benchmark-seeds")
    if seeds.count() <= broadcast_seeds:
        seeds = F.broadcast(seeds)
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    first = known.select(F.explode(once(hashes, lambda h: F.transform(h, lambda _, i: _pair(h, i)))).alias("pair")).distinct()
    pairs = [r["pair"] for r in first.limit(filter_pairs + 1).collect()]
    # A set of first pairs small enough for a constant spares most windows the hashing; all masks begin with that pair.
    pairs = pairs if len(pairs) <= filter_pairs and all(m[:2] == (0, 1) for m in masks) else None

    # Hits are gathered by identifier and text, so that rows of one identifier (NULL, say) are no group: at most a
    # text's own hits come together.
    uid = F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    rows = docs.select(F.col(id_col).alias("id"), uid.alias("uid"), F.col(text_col).cast("string").alias("text"))
    windows = _windows(rows, masks, pairs).select("id", "uid", "seed", F.col("at").alias("place"))
    hits = windows.join(seeds, "seed").select("id", "uid", "item", (F.col("place") - F.col("at")).alias("shift"), "n").distinct()
    per_doc = hits.groupBy(F.col("id").alias("_id"), F.col("uid").alias("_uid")).agg(
        F.collect_list(F.struct("item", "shift", "n")).alias("_hits")
    )

    # Words of the aligned part: places of the item that lie in the document.
    keyed = docs.withColumn("_key", uid)
    joined = keyed.join(per_doc, (F.col("_key") == F.col("_uid")) & docs[id_col].eqNullSafe(per_doc["_id"]))
    columns = [F.col(f"`{c}`") for c in docs.columns]

    def part(own: Column, h: Column) -> Column:
        skip = F.greatest(F.lit(0), -h["shift"])
        words = F.slice(own, F.greatest(h["shift"], F.lit(0)) + 1, F.greatest(h["n"] - skip, F.lit(0)))
        return F.struct(h["item"].alias("item"), skip.alias("skip"), words.alias("part"))

    own_words = words_of(F.col(f"`{text_col}`").cast("string"))
    parts = once(own_words, lambda own: F.transform(F.col("_hits"), lambda h: part(own, h)))
    aligned = joined.select("_id", "_uid", F.explode(parts).alias("h")).select(
        "_id", "_uid", "h.item", "h.skip", "h.part"
    ).distinct()
    compared = aligned.join(known, "item").withColumn(
        "equal",
        F.zip_with(
            "part", F.slice("words", F.col("skip") + 1, F.size("part")), lambda a, b: F.coalesce((a == b).cast("int"), F.lit(0))
        ),
    )
    found = (
        compared.select("_id", "_uid", "item", _stretch_matches(F.col("equal"), stretch).alias("matches"))
        .where(F.col("matches") >= stretch - substitutions)
        .groupBy("_id", "_uid", "item")
        .agg(F.max("matches").alias("matches"))
        .groupBy(F.col("_id").alias("_doc"), "_uid")
        .agg(F.sort_array(F.collect_list(F.struct("item", "matches"))).alias("_items"))
    )
    found = stage(found, "benchmark-found")
    out = keyed.join(found, (F.col("_key") == found["_uid"]) & keyed[id_col].eqNullSafe(found["_doc"]), "left")
    nothing = F.array().cast("array<struct<item:bigint,matches:int>>")
    return out.select(*columns, F.coalesce("_items", nothing).alias("_found"))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per row of ``docs``: identifier, contaminated, items (identifiers, ascending), matches (the most equal
    words in a stretch, 0 if nothing was found)."""
    text_col = options.get("text_col", "text")
    found = find_items(docs.select(id_col, text_col), items, id_col, **options)
    return found.select(
        F.col(id_col),
        (F.size("_found") > 0).alias("contaminated"),
        F.col("_found.item").alias("items"),
        F.coalesce(F.array_max("_found.matches"), F.lit(0)).alias("matches"),
    )
