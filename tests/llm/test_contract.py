"""What is fixed for op3 and op10: the folds, the rows learned from, `und`, the threshold."""

import zlib

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidewatch.llm import language_id, queries, toxicity

SF = "/root/testdata/sf0.001"
ODD = [None, "", "   ", "12 34 !?", "§$% 2024-01-02", "a", "Größe 7"]


def _fold(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """The tables of SF with texts of odd kinds added."""
    path = tmp_path_factory.mktemp("contract")
    docs = pq.read_table(f"{SF}/documents.parquet")
    odd = [{"doc_id": 900_001 + i, "text": t} for i, t in enumerate(ODD)]
    odd = pa.Table.from_pylist([{**{c: None for c in docs.schema.names}, **row} for row in odd], schema=docs.schema)
    pq.write_table(pa.concat_tables([docs, odd]), path / "documents.parquet")
    pq.write_table(pq.read_table(f"{SF}/labels.parquet"), path / "labels.parquet")
    return str(path)


def _recorded(monkeypatch, module):
    seen, fit = [], module.fit
    monkeypatch.setattr(module, "fit", lambda rows, *a, **k: seen.append(rows) or fit(rows, *a, **k))
    return seen


def test_language_id_folds_and_und(spark, folder, monkeypatch):
    seen = _recorded(monkeypatch, language_id)
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op3_language_id(spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert len(seen) == 1
    assert {r.doc_id for r in seen[0].collect()} == {d for d in docs if _fold(d, 4) != 2}
    learned = {x.lang for d, x in docs.items() if _fold(d, 4) != 2 and x.lang is not None}
    for r in rows:
        text = docs[r.doc_id].text
        assert r.held_out is (_fold(r.doc_id, 4) == 2)
        assert 0 <= r.score <= 1
        if text is None or not any(c.isalpha() for c in text):
            assert r.lang_pred == "und"
        else:
            assert r.lang_pred in learned


def test_language_id_looks_at_the_text_alone(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = queries.language_model(docs)
    other = docs.selectExpr("doc_id + 10000000 AS doc_id", "text", "'zz' AS lang", "'other' AS source")
    a = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs, model).collect()}
    b = {r.doc_id - 10_000_000: (r.lang_pred, r.score) for r in language_id.identify(other, model).collect()}
    assert a == b


def test_toxicity_folds_and_threshold(spark, folder, monkeypatch):
    seen = _recorded(monkeypatch, toxicity)
    docs = {r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.op10_toxicity(spark, folder).collect()
    assert {r.doc_id for r in rows} == docs and len(rows) == len(docs)
    used = {r.doc_id: r.toxic for r in seen[0].collect()}
    assert len(seen) == 1 and used
    assert all(_fold(d, 3) != 1 and labels[d] == v for d, v in used.items())
    for r in rows:
        assert r.held_out is (_fold(r.doc_id, 3) == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
