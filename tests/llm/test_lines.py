from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

from cases import EDGE_ROWS

from meterline.llm.lines import dedup_lines
from meterline.llm.queries import QUERIES


def split(line):
    return tuple(re.findall("[^\x20\x09-\x0d]+", line))


def brute(rows, least=5):
    """Keep a line unless one word's edit makes an earlier line of it."""
    docs = sorted({(i, t) for i, t in rows if t is not None}, key=lambda x: (x[0] is not None, x[0] or 0))
    whole, cut = defaultdict(int), defaultdict(int)
    texts = {}
    for i, t in docs:
        kept, gone = [], 0
        for line in t.split("\n"):
            w = split(line)
            if len(w) < least:
                kept.append(line)
                continue
            less = {(w[:k] + w[k + 1 :], k) for k in range(len(w))}
            hit = whole[w] or any(cut[x] for x in less) or any(whole[x] for x, _ in less) or cut[w, -1]
            whole[w] += 1
            for x in less:
                cut[x] += 1
                cut[x[0], -1] += 1
            gone += bool(hit)
            if not hit:
                kept.append(line)
        texts[i, t] = ("\n".join(kept), len(t.split("\n")), gone)
    return Counter((i, *(texts[i, t] if t is not None else (None, 0, 0))) for i, t in rows)


def got(df):
    return Counter((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in df.collect())


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = brute([(d["doc_id"], d["text"]) for d in docs])
    digest = Counter()
    for (i, t, n, k), c in want.items():
        digest[i, n, k, hashlib.sha256(t.encode()).hexdigest()] += c
    rows = QUERIES["op10_line_dedup"](spark, sf_dir).collect()
    assert Counter(tuple(r[c] for c in ("doc_id", "n_lines", "n_removed", "kept_sha256")) for r in rows) == digest
    assert sum(r["n_removed"] for r in rows) > 5


def test_edges(make_docs):
    base = "one two three four five six seven"
    rows = [
        *EDGE_ROWS,
        (20, base),
        (21, "one two three XXX five six seven\nnew line that stands on its own"),
        (22, "zero one two three four five six seven"),
        (23, "one two three four five six"),
        (24, "two one three four five six seven"),
        (25, "one  two\tthree four five six seven\nshort line\nshort line"),
        (26, "one two three four five six seven eight nine"),
        (27, "a a a a a a\na a a a a\nb a a a a a\na a a a a b b"),
        (28, "one two four five six seven EIGHT"),
        (29, base + "\n" + base),
        (-1, "x " + base),
    ]
    df = dedup_lines(make_docs(rows))
    assert got(df) == brute(rows)
    assert set(df.columns) >= {"lang", "source", "n_chars", "seed", "start", "removed_lines"}


def test_many_near_copies_of_a_line(make_docs):
    base = [f"w{k}" for k in range(30)]
    rows = []
    for i in range(400):
        line = list(base)
        line[i % 30] = f"x{i}"
        rows.append((i, " ".join(line) + "\n" + " ".join(base[: 5 + i % 20])))
    assert got(dedup_lines(make_docs(rows))) == brute(rows)


def test_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
