"""The operators of this package over the given tables, with production parameters, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm import (
    decontamination,
    language_id,
    lexical_scan,
    license_scan,
    line_dedup,
    merkle,
    mixing,
    simhash,
    substring_dedup,
    suffix_dedup,
    token_files,
    topk_search,
    toxicity,
)
from tiffin.session import tune

TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicate_lines(table(spark, sf_dir, "documents")).drop("kept")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeated_words(table(spark, sf_dir, "documents")).drop("kept")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("linked", "component")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    folder, manifest = token_files.write_tokens(table(spark, sf_dir, "documents"), path, END_ID)
    return token_files.read_tokens(spark, folder, manifest, token_files.id_type(path, END_ID))


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose identifier is divisible by 50 as a query against all documents."""
    docs = table(spark, sf_dir, "documents")
    return topk_search.search(docs, docs.where("doc_id % 50 = 0"), query_id_col="doc_id")


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeated_bytes(table(spark, sf_dir, "documents")).drop("kept")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    choice, targets = mixing.mix(table(spark, sf_dir, "documents"))
    joined = choice.join(targets, choice["source"].eqNullSafe(targets["source"]))
    return joined.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.verify(merkle.manifest(docs, "doc_id", "lang", *merkle.document_digests()), "doc_id")


def op12_lexical_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_scan.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_line_dedup": op2_line_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_language_id": op4_language_id,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_token_files": op7_token_files,
    "op8_topk_search": op8_topk_search,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_source_mixing": op10_source_mixing,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_lexical_scan": op12_lexical_scan,
    "op13_toxicity": op13_toxicity,
}



def _merkle_sql(levels: int = 8, above: int = 4) -> str:
    """Trees of at most 8 ** levels leaves a language and 8 ** above languages, level by level."""
    coded = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    fields = " || ".join(coded(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    byte = "xor(c, CASE WHEN i % 8 = 0 THEN ord(substr(doc_id::VARCHAR, (i // 8 + 1)::BIGINT, 1)) ELSE 0 END)"
    crc = f"list_reduce([4294967295] || range(8 * strlen(doc_id::VARCHAR)), lambda c, i: xor({byte} >> 1, 3988292384 * ({byte} & 1)))"
    parts = [
        f"""leaves AS (
            SELECT row_number() OVER () AS r, doc_id, lang, sha256({fields} || {coded("text")}) AS leaf,
                CASE WHEN xor({crc}, 4294967295) % 3 = 0 THEN sha256({fields} || {coded(lower)}) END AS altered
            FROM documents
        )""",
        """numbered AS (
            SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree,
                row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves
        )""",
        "a0 AS (SELECT tree, i, leaf AS d FROM numbered)",
        "p0 AS (SELECT r, tree, i, '' AS proof, coalesce(altered, leaf) AS led FROM numbered)",
    ]

    def level(name: str, k: int) -> None:
        parts.append(
            f"""{name}run{k} AS (SELECT tree, i // 8 AS j, list(d ORDER BY i) AS ds,
                any_value((SELECT count(*) FROM {name}{k} o WHERE o.tree = n.tree)) AS nodes FROM {name}{k} n GROUP BY ALL)"""
        )
        parts.append(
            f"""{name}{k + 1} AS (SELECT tree, j AS i, CASE WHEN nodes > 1 THEN sha256(list_aggregate(ds, 'string_agg', '')) ELSE ds[1] END AS d
                FROM {name}run{k})"""
        )
        own = "coalesce(list_aggregate(ds[1:i % 8], 'string_agg', ''), '')"
        rest = "coalesce(list_aggregate(ds[i % 8 + 2:], 'string_agg', ''), '')"
        proof = {"a": "p", "b": "q"}[name]
        parts.append(
            f"""{proof}{k + 1} AS (SELECT r, tree, j AS i, CASE WHEN nodes > 1 THEN proof || {own} || {rest} ELSE proof END AS proof,
                CASE WHEN nodes > 1 THEN sha256({own} || led || {rest}) ELSE led END AS led
                FROM {proof}{k} JOIN {name}run{k} USING (tree) WHERE j = i // 8)"""
        )

    for k in range(levels):
        level("a", k)
    parts.append(f"b0 AS (SELECT 0 AS tree, tree - 1 AS i, d FROM a{levels})")
    parts.append(f"q0 AS (SELECT r, 0 AS tree, tree - 1 AS i, proof, led FROM p{levels})")
    for k in range(above):
        level("b", k)
    return f"""WITH {", ".join(parts)}
        SELECT doc_id, leaf, a.d AS subroot, b.d AS root, sha256(proof) AS proof_sha256, led AS folded_root, led = b.d AS verified
        FROM numbered JOIN q{above} q USING (r) JOIN a{levels} a ON a.tree = numbered.tree, b{above} b"""


# DuckDB SQL for the same rows, where SQL can express an operator.
ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": r"""
        WITH texts AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        lines AS (
            SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM texts
        ),
        keyed AS (
            SELECT *, translate(
                trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ),
        repeated AS (
            SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
            GROUP BY key HAVING count(DISTINCT r) >= 5
        ),
        judged AS (
            SELECT k.*, p.key IS NOT NULL AND k.doc_id IS DISTINCT FROM p.last AS dropped
            FROM keyed k LEFT JOIN repeated p ON k.key = p.key
        )
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
        FROM judged GROUP BY r
    """,
    "op3_substring_dedup": r"""
        WITH texts AS (
            SELECT row_number() OVER () AS r, doc_id,
                list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
            FROM documents
        ),
        words AS (SELECT r, doc_id, unnest(w) AS word, unnest(range(len(w))) AS i, len(w) AS n FROM texts),
        windows AS (
            SELECT r, doc_id, i, n, string_agg(word, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS win
            FROM words
        ),
        judged AS (
            SELECT r, doc_id, i, n, (doc_id, i) > min((doc_id, i)) OVER (PARTITION BY win) AS again
            FROM windows WHERE i + 20 <= n
        ),
        hits AS (SELECT r, i FROM judged WHERE again),
        marked AS (
            SELECT w.r, w.i, w.word,
                max(CASE WHEN h.r IS NOT NULL THEN 1 ELSE 0 END)
                    OVER (PARTITION BY w.r ORDER BY w.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) = 1 AS gone
            FROM words w LEFT JOIN hits h ON w.r = h.r AND w.i = h.i
        ),
        folded AS (
            SELECT r, count(*) AS n, count(*) FILTER (gone) AS removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
            FROM marked GROUP BY r
        )
        SELECT t.doc_id, coalesce(f.n, 0) AS n_words, coalesce(f.removed, 0) AS n_removed, sha256(coalesce(f.kept, '')) AS kept_sha256
        FROM texts t LEFT JOIN folded f ON t.r = f.r
    """,
    "op9_suffix_array_dedup": r"""
        WITH texts AS (
            SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h,
                octet_length(encode(coalesce(text, ''))) AS n FROM documents
        ),
        bytes AS (SELECT r, doc_id, n, unnest(range(n)) AS i, unnest(regexp_extract_all(h, '..')) AS b FROM texts),
        windows AS (
            SELECT r, doc_id, i, n, string_agg(b, '') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) AS win
            FROM bytes
        ),
        judged AS (SELECT r, i, doc_id > min(doc_id) OVER (PARTITION BY win) AS again FROM windows WHERE i + 50 <= n),
        hits AS (SELECT r, i FROM judged WHERE again),
        marked AS (
            SELECT w.r, w.i, w.b,
                max(CASE WHEN h.r IS NOT NULL THEN 1 ELSE 0 END)
                    OVER (PARTITION BY w.r ORDER BY w.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) = 1 AS gone
            FROM bytes w LEFT JOIN hits h ON w.r = h.r AND w.i = h.i
        ),
        edges AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY i), false) AS begins FROM marked),
        folded AS (
            SELECT r, count(*) FILTER (gone) AS removed, count(*) FILTER (begins) AS spans,
                string_agg(b, '' ORDER BY i) FILTER (NOT gone) AS kept
            FROM edges GROUP BY r
        )
        SELECT t.doc_id, t.n AS n_bytes, coalesce(f.removed, 0) AS n_removed, coalesce(f.spans, 0) AS n_spans,
            sha256(unhex(coalesce(f.kept, ''))) AS kept_sha256
        FROM texts t LEFT JOIN folded f ON t.r = f.r
    """,
    "op11_merkle_manifest": _merkle_sql(),
    "op12_lexical_scan": r"""
        WITH texts AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ),
        stats AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM texts),
        found AS (
            SELECT r, doc_id, len(terms) AS n, t.term, count(*) AS tf
            FROM texts, (SELECT unnest(terms)) AS t(term) GROUP BY ALL
        ),
        items AS (
            SELECT row_number() OVER () AS item, item_id, list_distinct(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
            FROM benchmark
        ),
        asked AS (SELECT item, item_id, t.term FROM items, (SELECT unnest(terms)) AS t(term)),
        weights AS (
            SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM found, stats GROUP BY term
        ),
        scored AS (
            SELECT item, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id,
                sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms)))))::BIGINT AS score
            FROM asked JOIN found USING (term) JOIN weights USING (term), stats GROUP BY item, r
        ),
        ranked AS (
            SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank, doc_id, score
            FROM scored WHERE score > 0
        )
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
    """,
}
