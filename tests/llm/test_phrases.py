"""Phrases against a plain count in Python, and quotient filters against dictionaries."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import EDGE_ROWS

from meterline.llm import phrases
from meterline.llm.quotient_filters import Layout

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, top=2000):
    """Every row by its definition; ``rows`` are (lang, text)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = []
        often = {g: a for g, a in counts.items() if a >= least and len(g) > 1}
        for g, a in often.items():
            if any(g in (h[:2], h[1:]) and 100 * b >= 50 * a for h, b in often.items() if len(g) < len(h)):
                continue
            cuts = [(1_000_000 * a * a // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def frame(spark, rows, partitions=3):
    schema = "doc_id long, text string, lang string, block long, word string, shard long, n long, id long"
    full = [(i, t, lang, 1, "w", 2, 3, 4) for i, (lang, t) in enumerate(rows)]
    return spark.createDataFrame(full, schema).repartition(partitions)


def mined(spark, rows, **options):
    return sorted(tuple(r) for r in phrases.phrases(frame(spark, rows), **options).collect())


def test_phrases_in_several_blocks_and_shards(spark):
    rng = np.random.default_rng(7)
    names = [f"W{i}" if i % 3 else f"é{i}" for i in range(30)]
    rows = []
    for i in range(200):
        words = [names[k] for k in np.minimum(rng.zipf(1.4, 40) - 1, 29)]
        if i % 3 == 0:
            words[5:8] = ["New", "York", "City"]
        text = "".join(w + str(rng.choice([" ", "  ", "\t", ", ", ".\n", "\x0b", " ! "], p=[0.7, 0.1, 0.05, 0.05, 0.04, 0.03, 0.03])) for w in words)
        rows.append((["en", "de", None, "und"][i % 4], text))
    expected = brute(rows)
    assert any(r[2] == "new york city" for r in expected)
    assert mined(spark, rows, block_bytes=500, shard_keys=64) == expected
    assert mined(spark, rows, top=7) == brute(rows, top=7)


def test_edge_rows(spark):
    rows = [("en", t) for _, t in EDGE_ROWS] + [(None, "a b\n" * 12), ("", "c d! " * 11), ("en", "x y\x00z " * 15)]
    assert mined(spark, rows) == brute(rows)


def test_ties_are_ranked_by_count_then_bytes(spark):
    rows = [("en", f"{a} {b}") for a, b in [("p", "q"), ("ä", "z"), ("b", "c"), ("Z", "y")] for _ in range(10)]
    found = mined(spark, rows)
    assert [r[2] for r in found] == ["b c", "p q", "z y", "ä z"]
    assert found == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, None)], [("en", "")], [("en", "one two three")] * 9])
def test_nothing_to_mine(spark, rows):
    assert mined(spark, rows) == []


def test_one_text_is_a_third_of_all_rows(spark):
    rows = [("en", "the same copied text, the same copied text")] * 60 + [("en", f"w{i} x y") for i in range(120)]
    assert mined(spark, rows, block_bytes=200, shard_keys=8) == brute(rows)


def test_scores_beyond_64_bits_are_exact(spark):
    row = (3_000_000_001, 4_000_000_007, 5_000_000_029)
    df = spark.createDataFrame([row], "a long, l long, r long")
    a, l, r = row  # noqa: E741
    found = df.select(phrases._score(df.a, df.l, df.r).alias("s")).first()["s"]
    assert found == 1_000_000 * a * a // (l * r)


@pytest.mark.parametrize("bits,shard_bits", [(1, 0), (2, 3), (15, 5), (21, 7), (22, 0), (31, 12), (42, 20)])
def test_filters_lose_nothing(bits, shard_bits):
    rng = np.random.default_rng(bits)
    layout = Layout(bits, shard_bits)
    pool = rng.integers(0, 1 << bits, (400, 3), dtype=np.uint64)
    totals: Counter = Counter()
    by_shard = defaultdict(list)
    for _ in range(5):
        taken = pool[np.minimum(rng.zipf(1.2, 3000) - 1, 399)]
        totals.update(map(tuple, taken.tolist()))
        keys = layout.counted(*layout.permute(*layout.pack(*taken.T)))
        for shard, data in layout.filters(*keys):
            by_shard[shard].append(data)
    found: Counter = Counter()
    for shard, filters in by_shard.items():
        left, right, counts = layout.merged(shard, filters)
        assert (left >> np.uint64(layout.half - shard_bits) == shard).all()
        ids = layout.unpack(*layout.restore(left, right))
        found.update(dict(zip(zip(*(c.tolist() for c in ids), strict=True), counts.tolist(), strict=True)))
    assert found == totals
    assert max(totals.values()) > 255


def test_filters_are_smaller_than_their_keys():
    layout = Layout(17, 4)
    rng = np.random.default_rng(1)
    keys = layout.counted(*layout.permute(*layout.pack(*rng.integers(0, 1 << 17, (3, 50_000), dtype=np.uint64))))
    sizes = [len(f) for _, f in layout.filters(*keys)]
    assert sum(sizes) < 50_000 * 8


def test_the_permutation_is_undone():
    for bits in (1, 7, 20, 42):
        layout = Layout(bits, 0)
        left, right = np.random.default_rng(2).integers(0, 1 << layout.half, (2, 1000), dtype=np.uint64)
        back = layout.restore(*layout.permute(left, right))
        assert (back[0] == left).all() and (back[1] == right).all()
