"""What a Python worker holds while it is at work and keeps when it is idle: it stays beside the others of its executor."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tiffin.llm import language_id, simhash, token_files, words
from tiffin.llm.queries import tokenizer_path

MB = 1 << 20
SIZE = 24 * MB


@pytest.fixture(scope="module")
def batch():
    texts = [f"{i} some words of a text that is long " * 340 for i in range(SIZE // (340 * 40))]
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["id", "text"])


def caught(spark):
    """A frame that gives away the function which it is to map."""
    frame = SimpleNamespace(columns=["id", "text"], schema=T.StructType(), sparkSession=spark, mapInArrow=lambda run, schema: run)
    frame.select = lambda *columns: frame
    return frame


def peak_of(run, batch):
    """MB of Python objects and arrays at most, and the batches made."""
    tracemalloc.start()
    try:
        out = list(run(iter([batch])))
        return tracemalloc.get_traced_memory()[1] / MB, out
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("kind", [pa.string(), pa.binary(), pa.large_string()])
@pytest.mark.parametrize("most", [1, 7, 1 << 22])
def test_values(kind, most):
    texts = ["a", None, "", "longer than all", "éé", None, "b"] * 3
    column = pa.array(texts, pa.string()).cast(kind)
    for part in (column, column.slice(3, 9), column.slice(0, 0), pa.nulls(4, kind)):
        assert list(words.values(part, most)) == part.to_pylist()


def test_fingerprints_hold_few_texts(spark, batch, monkeypatch):
    monkeypatch.setattr(simhash, "fingerprint", lambda text, shingle: len(text))
    peak, out = peak_of(simhash.fingerprints(caught(spark)), batch)
    assert peak < SIZE / MB / 2
    assert out[0].column(1).to_pylist() == [len(t) for t in batch.column(1).to_pylist()]


def test_predictions_hold_few_texts(spark, batch, monkeypatch):
    monkeypatch.setattr(language_id.Network, "fold", lambda net: None)
    monkeypatch.setattr(language_id.Network, "probabilities", lambda net, windows, tables: np.tile([0.25, 0.75], (len(windows), 1)))
    network = language_id.Network(["de", "en"], *[None] * 5)
    peak, out = peak_of(language_id.predict(caught(spark), network), batch)
    assert peak < SIZE / MB / 2
    assert out[0].column(2).to_pylist() == ["en"] * batch.num_rows and out[0].columns[:2] == batch.columns


def test_idle_encoder_keeps_no_words(batch, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    path = tokenizer_path()
    few = pa.RecordBatch.from_arrays([c.slice(0, 50) for c in batch.columns], ["id", "text"])
    (manifest,) = token_files._write(f"file://{tmp_path}", path, 2, "<u2")(iter([few]))
    encoder = token_files._encoder(path, "<u2")
    assert encoder.known == {} and encoder.older == {}
    want = [[*encoder._plain(t), 2] for t in few.column(1).to_pylist()]
    name = manifest.column(1)[0].as_py()
    assert np.fromfile(tmp_path / f"{name}.tok", "<u2").tolist() == [i for ids in want for i in ids]
