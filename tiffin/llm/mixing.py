"""Mixing of sources to target weights by balanced sampling (the cube method).

Targets. The size of a document is its number of words. Sources in code-point order, NULL last, weigh 3, 1, 2, 3, ...
(``weights``, repeated) and share ``share`` times the total size. A target stops at ``most`` times its source's size;
what is above goes to the others by weight. In closed form: there is a level L with target = min(most * size,
L * weight), found over the sources sorted by size / weight with running sums.

Sampling. A source's ratio r = target / size means that each of its documents is taken floor(r) times for certain and
once more with probability r - floor(r). Which documents are taken once more is drawn by the cube method: the
probabilities of three documents at a time move along the one direction that changes neither the expected number of
documents nor the expected number of words, until one of them is 0 or 1. Each such flight ends with two undecided
documents.

It runs in blocks. Documents are dealt by hash to blocks of about ``block_rows`` rows of one source, so that a source
with a third of all rows is many blocks; a block is one call and hands on its two undecided documents. These make the
next, a thousand times smaller round, until the source fits into one block. There twelve documents stay out of the
flight, and the landing decides these and the last two together: of the at most 2^14 roundings the one whose words are
nearest to what is expected, then the one whose number of documents is. The words taken from a source thus differ from
its target by a small part of one document, whatever its size.

Draws are hashes of identifier, size and seed, and blocks are sorted by them, so a second run or a second attempt of a
task gives the same rows.

NULL text has size 0; a source without words has target 0 and documents of size 0 are taken as the draw says (they
hold no words). NULL identifiers and repeated rows are documents of their own. An empty table gives an empty result.
Further columns are handed through by ``mix`` under their own names.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.session import stage

WORDS = r"[^\x20\x09-\x0D]+"
EPSILON = 1e-9
LANDING = 12  # documents besides the last two that the landing of a source decides together


def word_count(text: Column) -> Column:
    """Number of words; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)).cast("bigint"), F.lit(0))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """source, source_size, target: one row per source. ``sizes`` has source and size, one row per document."""
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # one row per source
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    s = per_source.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    s = s.withColumn("capped", F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("open", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("goal", F.sum("source_size").over(everything) * F.lit(float(share)))
    # The level if all sources before this one are capped and none after; right at the first that it doesn't cap.
    level = (F.col("goal") - F.col("capped")) / F.col("open")
    s = s.withColumn("level", F.when(level * F.col("weight") < F.col("cap"), level))
    level = F.first("level", ignorenulls=True).over(by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap")))
    return s.select("source", "source_size", target.alias("target"))


def fly(chance: np.ndarray, size: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """One flight: move the probabilities, keeping their sum and the sum of chance * size, until at most two are
    strictly between 0 and 1. ``draw`` decides in which of the two directions, with odds that keep expectations."""
    p = chance.astype(float).tolist()
    s = size.astype(float).tolist()
    u = draw.tolist()
    held: list[int] = []
    for i in range(len(p)):
        if EPSILON < p[i] < 1 - EPSILON:
            held.append(i)
        if len(held) < 3:
            continue
        a, b, c = held
        move = (s[c] - s[b], s[a] - s[c], s[b] - s[a])  # sums to 0, and so does move * size
        if not any(move):
            move = (1.0, -1.0, 0.0)  # equal sizes: any exchange will do
        forth = back = float("inf")
        for k, m in zip(held, move, strict=True):
            if m > 0:
                forth, back = min(forth, (1 - p[k]) / m), min(back, p[k] / m)
            elif m < 0:
                forth, back = min(forth, p[k] / -m), min(back, (1 - p[k]) / -m)
        step = forth if u[i] * (forth + back) < back else -back
        for k, m in zip(held, move, strict=True):
            p[k] += step * m
            p[k] = 0.0 if p[k] < EPSILON else 1.0 if p[k] > 1 - EPSILON else p[k]
        held = [k for k in held if 0 < p[k] < 1]
    return np.array(p)


def land(chance: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round the few that are left so that their words come nearest to what is expected, then their number."""
    p = chance.copy()
    left = np.flatnonzero((p > 0) & (p < 1))
    options = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    words = np.abs(options @ size[left] - p[left] @ size[left])
    number = np.abs(options.sum(axis=1) - p[left].sum())
    p[left] = options[np.lexsort((number, words))[0]]
    return p


def _flight():
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        last = int(pdf["blocks"].iloc[0]) <= 1  # a source that is one block lands, whatever the others are
        pdf = pdf.sort_values(["draw", "id", "number"], kind="stable")
        size = pdf["size"].to_numpy(float)
        draw = (pdf["draw"].to_numpy(np.int64).view(np.uint64) >> np.uint64(11)).astype(float) / 2.0**53
        p = pdf["chance"].to_numpy(float).copy()
        rest = LANDING if last else 0  # stay on the ground: with them a rounding close to the target can be found
        p[rest:] = fly(p[rest:], size[rest:], draw[rest:])
        pdf["chance"] = land(p, size) if last else p
        return pdf[COLUMNS]

    return run


COLUMNS = ["id", "source", "size", "number", "draw", "sure", "chance"]
_FLOWN = "id bigint, source string, size bigint, number int, draw bigint, sure bigint, chance double"


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    block_rows: int = 2048,
    seed: int = 7,
) -> tuple[DataFrame, DataFrame]:
    """Returns (choice, targets). ``choice`` has a row for each row of ``docs``: id, source, size, a number that tells
    rows equal in these apart, and copies, how often the mix takes it. ``targets`` has a row per source."""
    measured = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col).cast("string")).alias("size"),
    )
    # Rows that are equal in identifier, source and size are exchangeable: they are counted, then told apart by number.
    sizes = stage(measured.groupBy("id", "source", "size").agg(F.count("*").alias("times")), "mix-sizes")
    targets = stage(
        source_targets(sizes.select("source", (F.col("size") * F.col("times")).alias("size")), weights, share, most),
        "mix-targets",
    )
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    flying = (
        sizes.join(targets, sizes["source"].eqNullSafe(targets["source"]))
        .select("id", sizes["source"], "size", "times", ratio.alias("ratio"))
        .withColumn("number", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
        .withColumn("draw", F.xxhash64("id", "source", "size", "number", F.lit(seed)))
        .withColumn("sure", F.floor(F.col("ratio") + EPSILON))
        .withColumn("chance", F.greatest(F.col("ratio") - F.col("sure"), F.lit(0.0)))
        .select(*COLUMNS)
    )
    decided: list[DataFrame] = []
    while True:
        blocks = flying.groupBy("source").agg(F.ceil(F.count("*") / F.lit(block_rows)).alias("blocks"))
        blocks = stage(blocks, "mix-blocks")
        last = (blocks.agg(F.max("blocks")).first()[0] or 0) <= 1
        dealt = flying.join(blocks, flying["source"].eqNullSafe(blocks["source"])).select(
            flying["*"], "blocks", F.pmod(F.xxhash64("draw", F.lit(len(decided))), F.col("blocks")).alias("block")
        )
        flown = stage(dealt.groupBy("source", "block").applyInPandas(_flight(), _FLOWN), "mix-flight")
        if last:
            decided.append(flown)
            break
        undecided = F.col("chance").between(EPSILON, 1 - EPSILON)
        decided.append(flown.where(~undecided))
        flying = flown.where(undecided)
    drawn = reduce(DataFrame.unionByName, decided)
    copies = (F.col("sure") + F.round("chance")).cast("bigint").alias("copies")
    return drawn.select("id", "source", "size", "number", copies), targets


def mixed_rows(docs: DataFrame, choice: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"):
    """The rows of ``docs``, each as often as the mix takes it. Equal rows are told apart by number."""
    size = word_count(F.col(text_col).cast("string"))
    totals = choice.groupBy(F.col("id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size")).agg(
        F.sort_array(F.collect_list("copies")).alias("_copies")
    )
    same = Window.partitionBy("_i", "_s", "_z").orderBy(F.xxhash64(text_col))
    keyed = docs.withColumns(
        {"_i": F.col(id_col).cast("bigint"), "_s": F.col(source_col).cast("string"), "_z": size}
    ).withColumn("_n", F.row_number().over(same))
    joined = keyed.join(
        totals,
        keyed["_i"].eqNullSafe(totals["_id"]) & keyed["_s"].eqNullSafe(totals["_source"]) & (keyed["_z"] == totals["_size"]),
    )
    times = F.element_at("_copies", F.col("_n").cast("int"))
    taken = joined.where(times > 0).withColumn("_t", F.explode(F.sequence(F.lit(1), times.cast("int"))))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns])
