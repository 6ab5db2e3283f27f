"""The pipeline's stages against plain versions of what they decide."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_llm_operators import plain_components, plain_simhash

import corpus_pipeline as pipeline
from tiffin.llm import decontamination, language_id


@pytest.fixture(scope="module")
def docs(spark, small):
    known = spark.read.parquet(f"{small}/documents.parquet")
    odd = [(None, None), (9001, ""), (9002, "12 34"), (9003, None), (None, "some words of English text that are here")]
    rows = [(i, t, "en" if t else None, None, 0) for i, t in odd]
    extra = spark.createDataFrame(rows, known.schema)
    twice = known.where("doc_id < 3")
    return known.unionByName(extra).unionByName(twice).withColumns({"_n": F.lit(1), "c0": F.lit("x"), "score": F.lit(2)})


def bag(df):
    return Counter(map(tuple, df.collect()))


def test_stages(spark, docs, small, tmp_path):
    held = {}
    for k, (name, stage) in enumerate(pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, held[k - 1] if k else docs, small).write.parquet(path)
        held[k] = spark.read.parquet(path)
    for k in range(4):
        assert held[k].columns == docs.columns

    assert bag(held[0]) == bag(docs.where(F.col("text").rlike(r"\p{L}")))  # all of this prose has a language

    before = held[0].collect()
    prints = {r: plain_simhash(r["text"]) for r in before}
    roots = plain_components(sorted(set(prints.values())), 2)
    least = {}
    for r, p in prints.items():
        if r["doc_id"] is not None:
            least[roots[p]] = min(least.get(roots[p], r["doc_id"]), r["doc_id"])
    after = held[1].collect()
    assert sorted(r["doc_id"] for r in after if r["doc_id"] is not None) == sorted(least.values())
    assert set(after) <= set(before)

    leaked = {
        r["doc_id"] for r in decontamination.contaminated(held[1], spark.read.parquet(f"{small}/benchmark.parquet")).collect() if r["contaminated"]
    }
    assert bag(held[2]) == bag(held[1].where(~F.coalesce(F.col("doc_id"), F.lit(-1)).isin(list(leaked) or [-5])))
    assert max(bag(held[3]).values()) <= 2 and set(bag(held[3])) <= set(bag(held[2]))
    assert held[4].count() == held[3].count()
    assert Counter(r["doc_id"] for r in held[4].collect()) == Counter(r["doc_id"] for r in held[3].collect())


def test_empty(spark, docs, small):
    nothing = docs.where("false")
    for _, stage in pipeline.STAGES:
        assert stage(spark, nothing, small).count() == 0


def test_unsure_documents_go(spark, docs, small, monkeypatch):
    monkeypatch.setattr(language_id, "learn", lambda *a, **k: None)
    assert pipeline.language(spark, docs, small).count() == 0


def test_near_duplicates_keep_a_row_of_each_component(spark, docs):
    texts = [r["text"] for r in docs.where("doc_id BETWEEN 10 AND 40").orderBy("doc_id").collect()]
    roots = plain_components(sorted({plain_simhash(t) for t in texts}), 2)
    texts = list({roots[plain_simhash(t)]: t for t in texts}.values())[:8]  # no two are linked
    assert len(texts) == 8
    rows = [(None, t, "en", None, 0) for t in texts[:4]]  # unlinked, without identifiers
    rows += [(7, texts[4], "en", None, 0), (7, texts[5], "en", None, 0)]  # one identifier, two texts
    rows += [(8, texts[4], "en", None, 0), (3, texts[5], "en", None, 0)]  # the second text is another's duplicate
    rows += [(9, texts[6], "en", "a", 0), (9, texts[6], "a", "en", 0), (None, texts[6], "en", None, 0)]
    rows += [(None, texts[7], None, "a", 0), (None, texts[7], "a", None, 0), (None, texts[7], "a", None, 0)]
    given = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = pipeline.near_duplicates(spark, given, "").collect()
    want = [(None, t) for t in [*texts[:4], texts[7]]] + [(7, texts[4]), (3, texts[5]), (9, texts[6])]
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(want)
    assert {tuple(r) for r in got} <= set(rows)
