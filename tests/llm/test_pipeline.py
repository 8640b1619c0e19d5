from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
from cases import EDGE_ROWS
from test_contamination import brute as contaminated
from test_contamination import words_of
from test_lines import split
from test_near_duplicates import brute as near
from test_tokens_and_packing import WORD, check_pieces, whole

from meterline.llm.near_duplicates import one_of_each


def lines_left(rows):
    """(doc_id, text) less earlier lines within a word's edit; emptied documents go."""
    seen, cut, out = set(), set(), []
    for i, t in sorted(rows):
        kept, gone = [], 0
        for line in t.split("\n"):
            w = split(line)
            less = [(w[:k] + w[k + 1 :], k) for k in range(len(w))]
            bare = {x for x, _ in less}
            if len(w) >= 5 and (w in seen or (w, -1) in cut or any(x in cut for x in less) or bare & seen):
                gone += 1
            else:
                kept.append(line)
            if len(w) >= 5:
                seen.add(w)
                cut.update(less)
                cut.update((x, -1) for x in bare)
        text = "\n".join(kept)
        if not gone or split(text):
            out.append((i, text))
    return out


def test_stages_equal_brute_force(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        frames[name] = docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert name == "packing" or docs.columns == columns
    rows = {n: [(r["doc_id"], r["text"]) for r in d.collect()] for n, d in frames.items() if n != "packing"}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    left = {i for i, _ in rows["quality_classifier"]}
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in left for i in good) >= 0.97 * len(good)
    assert sum(i in left for i in bad) <= 0.1 * len(bad)

    assert Counter(rows["line_dedup"]) == Counter(lines_left(rows["quality_classifier"]))
    kept = {x[0] for x in near(rows["line_dedup"]) if x[3]}
    assert Counter(rows["near_dedup"]) == Counter(r for r in rows["line_dedup"] if r[0] in kept)
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {x[0] for x in contaminated(rows["near_dedup"], items) if not x[1]}
    assert Counter(rows["decontamination"]) == Counter(r for r in rows["near_dedup"] if r[0] in clean)
    want = defaultdict(list)
    for i, t in rows["decontamination"]:
        want[i].append(whole(WORD, t, 2))
    padded, used = check_pieces(frames["packing"].collect(), want)
    assert padded <= 0.01 * used
    for r in frames["line_dedup"].collect():
        assert r["n_chars"] == len(r["text"])

    piece = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    total = lambda df: df.selectExpr("sum(length)", "count(distinct doc_id)").first()
    assert total(corpus_pipeline.run(spark, sf_dir).select(*piece)) == total(frames["packing"])


def test_stages_take_nulls_and_repeated_rows(make_docs, spark, sf_dir):
    docs = make_docs([*EDGE_ROWS, (9, "Fine words make a fine text.\nFine words make a text.")])
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs, sf_dir).count() > 0


def test_one_of_each_keeps_one_of_repeated_rows(make_docs):
    rows = one_of_each(make_docs(EDGE_ROWS)).select("doc_id", "text").collect()
    by_words = defaultdict(list)
    for r in rows:
        by_words[tuple(words_of(r["text"]))].append(r["doc_id"])
    assert by_words["the", "same", "text", "twice."] == [1]
    assert sorted(by_words[()]) == [2, 3, 4]
    assert len(rows) == len(EDGE_ROWS) - 2
