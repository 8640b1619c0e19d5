from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
from cases import EDGE_ROWS

from meterline.llm import windows as W
from meterline.llm.queries import QUERIES
from meterline.llm.repeats import remove_repeats


def brute(rows, width=200):
    """Row by row: (doc_id, bytes, kept, spans)."""
    data = [(i, (t or "").encode()) for i, t in rows]
    starts = Counter(hash(d[k : k + width]) for _, d in data for k in range(len(d) - width + 1))
    out = []
    for i, d in data:
        gone = np.zeros(len(d) + 1, bool)
        for k in range(len(d) - width + 1):
            if starts[hash(d[k : k + width])] > 1:
                gone[k : k + width] = True
        kept = bytes(np.frombuffer(d, np.uint8)[~gone[:-1]])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((i, len(d), len(d) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def got(df):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = brute([(d["doc_id"], d["text"]) for d in docs])
    assert got(QUERIES["op1_repeated_strings"](spark, sf_dir)) == want
    assert sum(1 for x in want if x[2]) > 5


def test_edges(make_docs):
    rng = np.random.default_rng(3)
    word = lambda n: "".join(rng.choice(list("abcdefghij "), n))
    shared, exact, short = word(333), word(200), word(199)
    rows = [
        *EDGE_ROWS,
        (20, word(150) + shared + word(90)),
        (21, shared + word(40)),
        (22, word(77) + shared[:260]),
        (23, word(61) + shared[70:] + "é" + shared[20:240]),
        (24, word(30) + exact + word(30)),
        (25, word(9) + exact),
        (26, word(30) + short + word(30)),
        (27, word(12) + short + "ü"),
        (28, "a" * 1000),
        (29, "ab" * 101),
        (30, exact[1:]),
        (31, word(130) + shared[100:310] + word(5)),
    ]
    df = remove_repeats(make_docs(rows))
    assert got(df) == brute(rows)
    for r in df.collect():
        data = r["text"].encode()
        kept, at = b"", 0
        for s in r["spans"]:
            kept, at = kept + data[at : s["start"]], s["end"]
        assert kept + data[at:] == r["kept"]


def test_many_copies_of_a_passage(make_docs):
    rng = np.random.default_rng(5)
    text = lambda n: "".join(rng.choice(list("abcdefghijklmnop "), n))
    passage = text(420)
    rows = [(i, text(rng.integers(0, 300)) + passage + text(rng.integers(0, 300))) for i in range(300)]
    assert got(remove_repeats(make_docs(rows))) == brute(rows)


def test_long_texts_are_named_in_segments(make_docs, monkeypatch):
    assert [b - a for a, b in W.segments(W.SEGMENT * 2 + 5, 200)][0] == W.SEGMENT + 199
    parts = W.segments(3 * W.SEGMENT, 200)
    firsts = [k for a, b in parts for k in (a, b - 200)]
    assert firsts[0] == 0 and firsts[-1] == 3 * W.SEGMENT - 200
    assert all(y == x + 1 for x, y in zip(firsts[1::2], firsts[2::2], strict=False))
    rng = np.random.default_rng(8)
    long = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), W.SEGMENT + 900))
    rows = [(1, long), (2, "xyz" + long[W.SEGMENT - 300 : W.SEGMENT + 300])]
    found = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in remove_repeats(make_docs(rows)).collect()}
    assert found == {1: (600, 1), 2: (600, 1)}


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(none).count() == 0
