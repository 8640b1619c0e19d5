from __future__ import annotations

import hashlib

from cases import EDGE_ROWS

from meterline.llm import fingerprints as P
from meterline.llm.queries import QUERIES


def ordered(rows):
    return sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0))


def edited(text, following):
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def test_query_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    docs = ordered([(d["doc_id"], d["text"] or "") for d in docs])
    rows = {r["doc_id"]: r for r in QUERIES["op4_fingerprints"](spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    by_text = {}
    near, far = [], []
    for k, (i, t) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][1]
        r = rows[i]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(edited(t, following).encode()).hexdigest()
        assert by_text.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if len(t) > 1000 and t != following:
            near.append(r["near_edited"])
            far.append(r["near_next"])
    assert len(set(by_text.values())) == len(by_text)
    assert sum(near) / len(near) > 0.6 and sum(far) / len(far) < 0.2
    assert sum(a > b for a, b in zip(near, far, strict=True)) > 0.97 * len(near)


def test_edges(make_docs):
    rows = P.document_fingerprints(make_docs(EDGE_ROWS)).collect()
    assert len(rows) == len(EDGE_ROWS)
    same = [r for r in rows if r["doc_id"] in (1, 6)]
    assert len({r["fingerprint"] for r in same}) == 1
    assert {r["near_next"] for r in same if r["doc_id"] == 1} >= {1.0}
    empty = {r["doc_id"]: r for r in rows if r["doc_id"] in (2, 3)}
    assert empty[2]["fingerprint"] == empty[3]["fingerprint"] and empty[2]["near_next"] == 1.0
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[8]["edited_sha256"] == hashlib.sha256(edited(EDGE_ROWS[9][1], EDGE_ROWS[2][1]).encode()).hexdigest()


def test_one_document_is_its_own_next(make_docs):
    (r,) = P.document_fingerprints(make_docs([(4, "abcdefgh")])).collect()
    assert r["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and r["near_next"] == 1.0


def test_empty_table(spark):
    assert P.document_fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_order_does_not_matter_and_paragraphs_come_and_go(spark):
    texts = [(1, "a b c\nd e\nf"), (2, "f\na b c\nd e"), (3, "a b c\nf"), (4, "d e"), (5, "a b c\nd e\nf\nd e")]
    df = spark.createDataFrame(texts, "k long, t string")
    lanes = {r["k"]: r["lanes"] for r in P.fingerprints(df, ["k"], "t").collect()}
    assert lanes[1] == lanes[2] and lanes[1] != lanes[5] and lanes[1] != lanes[3]
    pair = spark.createDataFrame([(lanes[1], lanes[3], lanes[4])], "x array<long>, y array<long>, z array<long>")
    r = pair.select(
        P.combine(P.F.col("y"), P.F.col("z")).alias("put"), P.combine(P.F.col("x"), P.F.col("z"), -1).alias("taken")
    ).first()
    assert r["put"] == lanes[1] and r["taken"] == lanes[3]
