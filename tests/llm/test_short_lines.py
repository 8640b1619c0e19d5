from __future__ import annotations

from collections import Counter

from cases import EDGE_ROWS
from test_lines import brute, got, split

from meterline.llm.lines import dedup_lines


def brute_exact(rows):
    """Keep a line with words unless an earlier one is equal, or within one edit from five words."""
    docs = sorted({(i, t) for i, t in rows if t is not None}, key=lambda x: (x[0] is not None, x[0] or 0))
    whole, cut, texts = Counter(), Counter(), {}
    for i, t in docs:
        kept = []
        for line in t.split("\n"):
            w = split(line)
            less = {(w[:k] + w[k + 1 :], k) for k in range(len(w))} if len(w) >= 5 else set()
            hit = bool(w) and (whole[w] or any(cut[x] or whole[x[0]] * (len(x[0]) >= 5) for x in less))
            hit = hit or (len(w) >= 5 and cut[w, -1])
            whole[w] += 1
            for x in less:
                cut[x] += 1
                cut[x[0], -1] += 1
            if not hit:
                kept.append(line)
        n = len(t.split("\n"))
        texts[i, t] = ("\n".join(kept), n, n - len(kept))
    return Counter((i, *(texts[i, t] if t is not None else (None, 0, 0))) for i, t in rows)


ROWS = [
    *(r for r in EDGE_ROWS if r[0] != 5),  # brute force takes minutes for a line of 30,000 words
    (20, "All rights reserved.\none two three four five\n\n \n今日は良い天気です。"),
    (21, "one two three four\nAll  rights\treserved.\n\n今日は良い天気です。\nAll rights"),
    (22, "one two three four FIVE\nall rights reserved.\none two three four\nOne\nOne"),
]


def test_short_lines_go_if_equal(make_docs):
    docs = make_docs(ROWS)
    found = got(dedup_lines(docs, exact_words=1))
    assert found == brute_exact(ROWS)
    assert found[21, "one two three four\n\nAll rights", 5, 2] == 1
    assert got(dedup_lines(docs)) == brute(ROWS)


def test_all_lines_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert got(dedup_lines(docs, exact_words=1)) == brute_exact(rows)
