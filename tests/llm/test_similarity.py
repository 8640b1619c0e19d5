from __future__ import annotations

import itertools

import corpus_pipeline
import numpy as np
from test_near_duplicates import shingles

from meterline.llm import near_duplicates as N


def first_of_each(rows, percent):
    """The smallest doc_id of each component of links at ``percent``."""
    sets = {i: shingles(t) for i, t in rows}
    owner = {i: i for i in sets}

    def find(x):
        while owner[x] != x:
            x = owner[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        n = len(sets[a] & sets[b])
        if n * 100 >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            owner[b] = a
    return sorted({find(x) for x in sets})


def copies(words=120, groups=2, each=12):
    """Copies with 0 to 4 words of their own: similarities on both sides of 0.80 and 0.85."""
    rng, rows = np.random.default_rng(4), []
    for g in range(groups):
        for _ in range(each):
            w = [f"g{g}w{j}" for j in range(words)]
            for j in rng.choice(words, rng.integers(0, 5), replace=False):
                w[j] = f"e{rng.integers(1 << 40)}"
            rows.append((len(rows), " ".join(w)))
    base = [f"p{j}" for j in range(100)]
    rows.append((1000, " ".join(base)))
    rows.append((1001, " ".join(["x" if j in (20, 70) else w for j, w in enumerate(base)])))  # 86 of 106: 0.811
    return rows


def test_pipeline_stage_links_at_80_percent(spark, make_docs, sf_dir):
    rows = copies()
    kept = sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, make_docs(rows), sf_dir).collect())
    assert kept == first_of_each(rows, 80)
    assert 1000 in kept and 1001 not in kept


def test_operator_links_at_85_percent_unless_told(make_docs):
    rows = copies()
    docs = make_docs(rows)
    assert sorted(r["doc_id"] for r in N.near_duplicates(docs).filter("kept").collect()) == first_of_each(rows, 85)
    assert {1000, 1001} <= set(first_of_each(rows, 85))
