"""From raw documents to token files: each stage works on what the one before kept.

1. language: documents whose language can't be told (no letters, or probability under ``LEAST_SCORE``) go;
2. near_duplicates: of each SimHash component one row stays, the one with the smallest identifier;
3. decontamination: documents that hold a passage of a benchmark item go;
4. mixing: documents are repeated or left out as the balanced sample takes them;
5. tokens: what is left is encoded and written to token files; the result describes the files' documents.

Every stage but the last returns the columns of its input. NULL and empty texts go in the first stage. Rows that share
an identifier, or have none: of rows in one component that share the smallest identifier one stays, rows in different
components all stay. A NULL identifier is smallest only where a component has no other.
"""

from __future__ import annotations

import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tiffin.llm import decontamination, language_id, mixing, simhash, token_files  # noqa: E402
from tiffin.llm.queries import END_ID, table, tokenizer_path  # noqa: E402
from tiffin.session import shared_folder  # noqa: E402

LEAST_SCORE = 0.3
SHINGLE, MAX_BITS = 3, 2


class _Plain:
    """Documents under column names of our own, so that whatever they are named clashes with nothing."""

    def __init__(self, docs: DataFrame):
        self.names = docs.columns
        self.docs = docs.toDF(*[f"c{i}" for i in range(len(self.names))])
        self.id, self.text, self.lang, self.source = (f"c{self.names.index(x)}" for x in ("doc_id", "text", "lang", "source"))

    def back(self, df: DataFrame) -> DataFrame:
        return df.select(*self.docs.columns).toDF(*self.names)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is told. The network learns from the labelled documents of the input."""
    p = _Plain(docs)
    network = language_id.learn(p.docs, p.id, p.text, p.lang)
    told = language_id.predict(p.docs, network, p.text)
    return p.back(told.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each component: the one with the smallest identifier, NULL last, and of several the one with the
    smallest hash of the row. Components are told apart by fingerprint, so identifiers may be NULL or shared."""
    p = _Plain(docs)
    # Two hashes of 64 bits stand for a row. Hashes pass over NULLs, so which columns are NULL is hashed too.
    of = [*p.docs.columns, *[F.col(c).isNull() for c in p.docs.columns]]
    rows = p.docs.withColumns({"_h": F.xxhash64(*of), "_g": F.xxhash64(F.lit(1), *of)})
    classes = simhash.near_duplicates(rows, p.id, p.text, SHINGLE, MAX_BITS, carried=("_h", "_g"))
    order = F.struct(F.col(p.id).isNull(), F.col(p.id), F.col("_h").alias("_h"), F.col("_g").alias("_g"))
    chosen = classes.groupBy("component").agg(F.min(order).alias("_r")).select("_r._h", "_r._g")
    # Rows that are equal in all columns have equal hashes: one of them is enough.
    return p.back(rows.join(chosen, ["_h", "_g"], "left_semi").dropDuplicates(["_h", "_g"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents without benchmark passages."""
    p = _Plain(docs)
    found = decontamination.find_items(p.docs, table(spark, sf_dir, "benchmark"), p.id, p.text)
    return p.back(found.where(F.size("_found") == 0))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it."""
    p = _Plain(docs)
    choice, _ = mixing.mix(p.docs, p.id, p.text, p.source)
    return p.back(mixing.mixed_rows(p.docs, choice, p.id, p.text, p.source))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token files; one row per document in them."""
    path = tokenizer_path()
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    folder, manifest = token_files.write_tokens(docs, path, END_ID, folder)
    return token_files.read_tokens(spark, folder, manifest, token_files.id_type(path, END_ID))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("tokens", tokens),
]
ORACLE_SQL = {name: None for name, _ in STAGES}  # a trained network, XXH64 majorities, masks, draws and a tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents table, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
