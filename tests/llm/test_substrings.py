from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from cases import EDGE_ROWS

from meterline.llm import substrings as S
from meterline.llm import windows as W
from meterline.llm.queries import QUERIES
from meterline.llm.substrings import remove_duplicates


def brute(rows, width=20):
    docs = sorted({(i, t or "") for i, t in rows}, key=lambda x: (x[0] is not None, x[0] or 0))
    seen, gone = {}, {}
    for k, (_, t) in enumerate(docs):
        words = re.findall("[^\x20\x09-\x0d]+", t)
        out = np.zeros(len(words), bool)
        for a in range(len(words) - width + 1):
            key = tuple(words[a : a + width])
            if seen.setdefault(key, (k, a)) != (k, a):
                out[a : a + width] = True
        gone[docs[k]] = (words, out)
    res = Counter()
    for i, t in rows:
        words, out = gone[i, t or ""]
        kept = " ".join(w for w, x in zip(words, out, strict=True) if not x)
        res[i, len(words), int(out.sum()), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return res


def got(df):
    return Counter(tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept_sha256")) for r in df.collect())


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = brute([(d["doc_id"], d["text"]) for d in docs])
    assert got(QUERIES["op2_duplicate_windows"](spark, sf_dir)) == want
    assert sum(1 for x in want if x[2]) > 5


def test_edges(make_docs):
    rng = np.random.default_rng(4)
    words = lambda n: " ".join("".join(rng.choice(list("abcdef"), 3)) for _ in range(n))
    shared, just, short = words(60), words(20), words(19)
    rows = [
        *EDGE_ROWS,
        (20, words(30) + " " + shared + "\n" + words(12)),
        (21, shared),
        (22, words(9) + "\t" + " ".join(shared.split()[10:45]) + "\x0b" + words(8)),
        (23, just + " " + words(9) + " " + just),
        (24, words(3) + " " + just),
        (25, short + " q " + short),
        (26, "w " * 45),
        (27, "x y " * 30),
        (-5, " ".join(shared.split()[5:40])),
    ]
    df = remove_duplicates(make_docs(rows))
    assert got(df) == brute(rows)
    for r in df.collect():
        all_words = re.findall("[^\x20\x09-\x0d]+", r["text"])
        kept, at = [], 0
        for s in r["spans"]:
            kept, at = kept + all_words[at : s["start"]], s["end"]
        assert " ".join(kept + all_words[at:]) == r["kept"]


def test_many_copies_of_a_passage(make_docs):
    rng = np.random.default_rng(6)
    words = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 4)) for _ in range(n))
    passage = words(50)
    rows = [(i, f"{words(rng.integers(0, 40))} {passage} {words(rng.integers(0, 40))}") for i in range(300)]
    assert got(remove_duplicates(make_docs(rows))) == brute(rows)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert remove_duplicates(none).count() == 0


def test_texts_named_together_have_the_runs_of_each():
    rng = np.random.default_rng(9)
    parts = [rng.integers(0, 4, n).astype(np.uint64) for n in (0, 5, 19, 20, 21, 300, 3, 40)]
    found, part = W.runs_of_many(parts, 20, 5)
    for k, symbols in enumerate(parts):
        alone = W.runs_of(W.Names(symbols), 20, 5)
        for name in ("start", "count", "anchor", "seed", "block"):
            here = getattr(found, name)[part == k].tolist()
            assert here == (getattr(alone, name).tolist() if alone else []), (k, name)


def test_long_texts_are_cut_into_parts(make_docs, monkeypatch):
    for module in (W, S):
        monkeypatch.setattr(module, "SEGMENT", 64)
    monkeypatch.setattr(S, "TOGETHER", 100)
    rng = np.random.default_rng(10)
    texts = pa.array([" ".join(f"w{x}" for x in rng.integers(0, 50, n)) for n in (10, 500, 70, 64, 83, 84)])
    want = [S.symbols_of(S.words_of(t.as_py())) for t in texts]
    seen = []
    for rows, offsets, parts in S.together(texts):
        for row, offset, part in zip(rows, offsets, parts, strict=True):
            assert part.tolist() == want[row][offset : offset + len(part)].tolist()
            seen += [(row, offset + k) for k in range(len(part) - 19)]
    assert sorted(seen) == [(r, k) for r, w in enumerate(want) for k in range(len(w) - 19)]
