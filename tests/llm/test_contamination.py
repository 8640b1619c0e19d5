from __future__ import annotations

import re
from collections import Counter

import numpy as np
from cases import EDGE_ROWS
from pyspark.sql import functions as F

from meterline.llm import contamination as C
from meterline.llm.contamination import contamination
from meterline.llm.queries import QUERIES


def words_of(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall("[^\x20\x09-\x0d]+", t)


def grams(w, n):
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}


def brute(docs, items, share=0.8):
    out = []
    for i, t in docs:
        w = words_of(t)
        hits, most = set(), 0.0
        for item, text in items:
            v = words_of(text)
            if item is None or not v:
                continue
            n = min(5, len(v))
            s = grams(v, n)
            c = len(s & grams(w, n))
            if c >= share * len(s):
                hits.add(item)
                most = max(most, c / len(s))
        out.append((i, len(hits), tuple(sorted(hits)), round(most, 9)))
    return Counter(out)


def got(df):
    return Counter(
        (r["doc_id"], r["n_items"], tuple(r["item_ids"]), round(r["containment"], 9)) for r in df.collect()
    )


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()
    want = brute([tuple(d) for d in docs], [tuple(i) for i in items])
    rows = QUERIES["op6_decontamination"](spark, sf_dir).collect()
    have = Counter(
        (r["doc_id"], r["n_items"], tuple(map(int, filter(None, r["item_ids"].split(",")))), round(r["containment"], 9))
        for r in rows
    )
    assert have == want
    assert sum(x[1] for x in want) > 0


def test_edges(make_docs, spark):
    rng = np.random.default_rng(9)
    words = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))
    long, mid = words(60), words(24)
    most = mid.split()
    holed = " ".join(most[:10] + ["changed"] + most[10:])
    items = [
        (1, long),
        (2, mid),
        (3, mid),
        (4, "Just Three Words"),
        (5, ""),
        (6, None),
        (None, "an item that has no id at all"),
        (7, "one"),
        (8, "six words are two shingles here"),
        (8, "six words are two shingles here"),
        (9, words(300)),
    ]
    docs = [
        *EDGE_ROWS,
        (20, words(100) + " " + long.upper() + "\n" + words(50)),
        (21, words(30) + " " + " ".join(long.split()[:50])),
        (22, words(30) + " " + " ".join(long.split()[:40])),
        (23, holed + " " + words(500)),
        (24, "here are JUST three  words"),
        (25, "six words are two shingles here"),
        (26, "six words are two shingles"),
        (27, words(4000) + " " + mid + " " + words(4000) + " one"),
        (28, " ".join(items[-1][1].split()[20:280])),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = contamination(make_docs(docs), bench)
    assert got(df) == brute(docs, items)
    assert {"lang", "seed", "start"} <= set(df.columns)


def test_empty_tables(make_docs, spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "an item of more than five words")], "item_id long, text string")
    assert contamination(none, bench).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    rows = contamination(make_docs(EDGE_ROWS), empty).collect()
    assert len(rows) == len(EDGE_ROWS) and not any(r["n_items"] for r in rows)


def test_words_of_mixed_scripts(spark):
    rows = ["Plain  ASCII\tText\x0b\n", "ÀB Éa ΑΣ İI ß𝒜Z", " \x85 A\x1cB", "", " ", "A\x00B [Z]", None]
    df = spark.createDataFrame([(x,) for x in rows], "text string")
    found = [r[0] for r in df.select(C.words_of(F.col("text"))).collect()]
    assert found == [words_of(x) for x in rows]


def test_only_candidates_are_split_again(make_docs, spark):
    items = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    found = C.contained(make_docs([(1, "zero one two three four five six seven"), (2, "none of it here at all")]), items)
    assert [(r.doc, r.item_id, r.containment) for r in found.collect()] == [(1, 1, 1.0)]
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joined = next(k for k, x in enumerate(plan) if "Join LeftSemi" in x)
    assert not any("split(" in x for x in plan[joined:]), plan
