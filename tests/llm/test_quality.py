from __future__ import annotations

import zlib

import numpy as np
from cases import EDGE_ROWS

from meterline.llm import quality as Q
from meterline.llm.queries import QUERIES


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for v in np.unique(score):
        rank[score == v] = rank[score == v].mean()
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = QUERIES["op9_quality"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(rows) == docs
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    label = np.array([labels[r["doc_id"]] for r in held])
    assert auc(np.array([r["score"] for r in held]), label) > 0.95
    assert np.mean([r["predicted"] == y for r, y in zip(held, label, strict=True)]) > 0.95


def test_rules_are_read_from_every_path():
    text = "Model\n  Tree 0 (weight 1.0):\n    If (feature 0 <= 2.0)\n     If (feature 0 <= 1.5)\n      Predict: 0.0\n"
    text += "     Else (feature 0 > 1.5)\n      Predict: 1.0\n    Else (feature 0 > 2.0)\n     Predict: 0.0\n"
    rules = {r.terms for r in Q.rules_of(text, ("x",))}
    assert rules == {
        (("x", False, 2.0),),
        (("x", False, 1.5),),
        (("x", False, 2.0), ("x", True, 1.5)),
        (("x", True, 2.0),),
    }


def test_nulls_ties_and_missing_labels(make_docs, spark):
    docs = make_docs(EDGE_ROWS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    scores = {r["score"] for r in Q.score(docs, Q.fit(docs, none)).collect()}
    assert scores == {0.5}
    one = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None)], "doc_id long, quality int")
    rows = Q.score(docs, Q.fit(docs, one)).collect()
    assert len(rows) == len(EDGE_ROWS) and {r["predicted"] for r in rows} == {1}
    assert "seed" in rows[0].asDict()
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert Q.score(empty, Q.fit(empty, one)).count() == 0


def test_statistics_of_small_texts(spark):
    rows = [("",), (None,), ("  \n ",), ("A b a b",), ("x!\nx!",)]
    df = spark.createDataFrame(rows, "text string").select(*Q._parts(Q.F.col("text")))
    got = df.select(*[c.alias(n) for n, c in Q.statistics().items()]).collect()
    assert tuple(got[0].asDict()) == Q.STATISTICS
    assert all(v is not None for r in got for v in r)
    assert got[3]["distinct_words"] == 0.75 and got[3]["upper"] == 1 / 7
    assert got[4]["distinct_lines"] == 0.5 and got[4]["marks"] == 2 / 5
