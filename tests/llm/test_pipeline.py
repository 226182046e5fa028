"""The pipeline's stages against brute force, each on its own input."""

import os

import pytest

import corpus_pipeline as pipeline
from brute import leak_rows, simhash_rows, suffix_rows
from tapeloom.llm.queries import ORACLE, QUERIES
from tapeloom.llm.toxicity import toxicity
from tapeloom.plans.staging import stage

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    given = {"toxicity": docs}
    for (name, function), following in zip(pipeline.STAGES, [n for n, _ in pipeline.STAGES[1:]] + ["end"]):
        out = stage(function(spark, given[name], SF))
        assert following == "end" or out.columns == columns
        given[following] = out
    before = {name: rows_of(df) for name, df in given.items()}

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clean = {r.doc_id for r in toxicity(docs, labels).where("predicted = 0").collect()}
    assert {i for i, _ in before["simhash"]} == clean and len(clean) < len(before["toxicity"])

    groups = simhash_rows(before["simhash"])
    assert sorted(i for i, _ in before["suffix_array"]) == [i for i, _, c in groups if i == c]

    size, least = pipeline.PASSAGE_BYTES, pipeline.PASSAGE_WORDS
    cut = {i: n for i, _, n, _, _ in suffix_rows(before["suffix_array"], size, least)}
    texts = dict(before["suffix_array"])
    for i, t in before["decontamination"]:
        if not cut[i]:
            assert t == texts[i]
        else:
            assert 0 <= len(texts[i].encode()) - cut[i] - len(t.encode()) <= 3 * 20
    assert any(cut.values()) and len(before["decontamination"]) == len(texts)

    items = rows_of(spark.read.parquet(f"{SF}/benchmark.parquet").withColumnRenamed("item_id", "doc_id"))
    leaked = {i for i, _ in leak_rows(before["decontamination"], items)}
    left = {i for i, _ in before["decontamination"]} - leaked
    assert {i for i, _ in before["sentencepiece"]} == left and leaked
    assert {i for i, _ in before["end"]} == left
    assert all(r.parity and r.round_trip for r in given["end"].collect())

    whole = pipeline.run(spark, SF)
    assert sorted(map(str, whole.collect())) == sorted(map(str, given["end"].collect()))


def test_registered():
    import __spark_entry__ as entry

    found = entry.queries()
    assert found["pipeline"] is pipeline.run and QUERIES.items() <= found.items()
    assert [next(q for q in QUERIES if q.startswith(f"op{n}_")) for n in range(1, 14)] == list(QUERIES)
    assert set(ORACLE) <= set(QUERIES)
