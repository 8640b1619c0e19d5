from __future__ import annotations

import itertools
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import EDGE_ROWS
from test_contamination import grams, words_of

from meterline.llm import near_duplicates as N
from meterline.llm.components import components
from meterline.llm.queries import QUERIES


def shingles(text):
    w = words_of(text)
    return grams(w, min(5, len(w))) if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    owner = list(range(len(rows)))

    def find(x):
        while owner[x] != x:
            x = owner[x]
        return x

    index = defaultdict(set)
    for k, s in enumerate(sets):
        for x in s:
            index[x].add(k)
    pairs = {p for v in index.values() for p in itertools.combinations(sorted(v), 2)}
    for a, b in pairs:
        n = len(sets[a] & sets[b])
        if n * 100 >= 85 * (len(sets[a]) + len(sets[b]) - n):
            owner[find(b)] = find(a)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    out = Counter()
    for k, (i, _) in enumerate(rows):
        c = least[find(k)] if sets[k] else i
        out[i, len(sets[k]), c, i == c] += 1
    return out


def got(df):
    return Counter(tuple(r[c] for c in ("doc_id", "n_shingles", "component_id", "kept")) for r in df.collect())


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = brute([tuple(d) for d in docs])
    assert got(QUERIES["op5_near_duplicates"](spark, sf_dir)) == want
    assert sum(not x[3] for x in want) > 5


def test_edges(make_docs):
    base = [f"w{k}" for k in range(100)]
    text = " ".join(base)
    rows = [
        *EDGE_ROWS,
        (40, text),
        (41, text.upper() + " extra"),
        (39, text.replace(" ", "\t\n")),
        (42, " ".join(base[:90] + ["x"] + base[91:])),
        (43, " ".join(base[:50])),
        (44, "three little words"),
        (45, "Three little WORDS"),
        (None, "three little words"),
        (46, "three little"),
        (None, None),
    ]
    assert got(N.near_duplicates(make_docs(rows))) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_whose_copies_differ_from_each_other(make_docs, seed):
    """Copies with their own edits: some are linked by way of others only, some not at all."""
    rng = np.random.default_rng(seed)
    rows, k = [], 100
    for g in range(3):
        base = [f"g{g}w{j}" for j in range(120)]
        for _ in range(120):
            w = list(base)
            for j in rng.choice(120, rng.integers(0, 5), replace=False):
                w[j] = f"e{rng.integers(1 << 40)}"
            rows.append((k, " ".join(w)))
            k += 1
    drift = [f"d{j}" for j in range(150)]
    for j in range(40):  # a chain: only neighbours are similar
        drift = [*drift[2:], f"n{j}", f"m{j}"]
        rows.append((k, " ".join(drift)))
        k += 1
    assert got(N.near_duplicates(make_docs(rows))) == brute(rows)


def test_odd_sketches_estimate_high_similarities():
    rng = np.random.default_rng(7)
    for share in (0.95, 0.85, 0.75):
        n = 4000
        both = rng.integers(0, 1 << 62, n, dtype=np.uint64)
        own = int(n * (1 - share) / (1 + share))
        a, b = both[own:], both[: n - own]
        true = (n - 2 * own) / n
        x, y = (np.array(N.odd_sketch(N.signature(np.unique(s)))).view(np.uint64) for s in (a, b))
        ones = sum(int(v).bit_count() for v in x ^ y)
        got = 1 + np.log(1 - 2 * ones / N.SKETCH_BITS) * N.SKETCH_BITS / (4 * N.BANDS * N.ROWS)
        assert abs(got - true) < 0.1


def test_components_of_a_long_chain(spark):
    links = [(f"{k:04d}", f"{k + 1:04d}") for k in range(200)] + [("x1", "x2"), ("x2", "x2")]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a string, b string")).collect()))
    assert {found[f"{k:04d}"] for k in range(201)} == {"0000"}
    assert found["x2"] == found["x1"] == "x1"


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert N.near_duplicates(none).count() == 0


def templated(n, rng):
    """Texts of one template with three passages of their own out of a pool: no passage is in one
    text only; texts that share one are not yet linked."""
    base = [f"t{j}" for j in range(400)]
    pool = [[f"p{p}w{j}" for j in range(20)] for p in range(n // 2)]
    rows = []
    for k in range(n):
        one, two, three = (pool[p] for p in rng.choice(len(pool), 3, replace=False))
        rows.append((k, " ".join([*base[:130], *one, *base[130:270], *two, *base[270:], *three])))
    for k in range(6):  # links across
        rows.append((n + k, rows[7 * k][1] + " more"))
    return rows


@pytest.mark.parametrize("n", [400])
def test_a_template_is_not_compared_pair_by_pair(make_docs, monkeypatch, n):
    rows = templated(n, np.random.default_rng(n))
    compared, confirmed = [], N.confirmed

    def counting(pairs, *more):
        compared.append(pairs.count())
        return confirmed(pairs, *more)

    monkeypatch.setattr(N, "confirmed", counting)
    assert got(N.near_duplicates(make_docs(rows))) == brute(rows)
    assert len(compared) > 1 and sum(compared) < len(rows) ** 2 / 2 / 5, compared


@pytest.mark.parametrize("small", [2, 16])
def test_groups_within_groups(make_docs, monkeypatch, small):
    """Templates within a template, copies with edits in each, and chains between them."""
    monkeypatch.setattr(N, "SMALL", small)
    rng = np.random.default_rng(small)
    base, rows = [f"t{j}" for j in range(150)], []
    for g in range(6):
        inner = [f"g{g}w{j}" for j in range(rng.integers(10, 40))]
        for _ in range(25):
            own = [f"e{rng.integers(1 << 40)}" for _ in range(rng.integers(0, 14))]
            w = [*base, *inner, *own]
            for j in rng.choice(len(w), rng.integers(0, 3), replace=False):
                w[j] = f"x{rng.integers(30)}"
            rows.append((len(rows), " ".join(w)))
    assert got(N.near_duplicates(make_docs(rows))) == brute(rows)


def test_groups_of_up_to_small_are_settled_in_one_round(make_docs, monkeypatch):
    """Texts of one template, too few for a large group, are not narrowed round by round."""
    rows = templated(100, np.random.default_rng(5))
    monkeypatch.setattr(N, "_narrower", lambda *a: pytest.fail("narrowed"))
    found = got(N.near_duplicates(make_docs(rows)))
    assert found == brute(rows)


def test_many_keys_are_joined_by_a_shuffle(spark, make_docs, monkeypatch):
    rows = templated(40, np.random.default_rng(6))
    monkeypatch.setattr(N, "SENT", 3)
    assert got(N.near_duplicates(make_docs(rows))) == brute(rows)


def test_parities_drop_near_misses_and_no_link():
    rng = np.random.default_rng(11)
    for n, near, kept in ((300, 0.86, True), (300, 0.78, False), (2000, 0.86, True), (20, 0.86, True)):
        own = int(n * (1 - near) / (1 + near))
        both = rng.integers(0, 1 << 62, n + own, dtype=np.uint64)
        x, y = (N.parities(s).view(np.uint64) for s in (both[own:], both[: n]))
        ones = sum(int(v).bit_count() for v in x ^ y)
        assert ones <= 2 * own
        assert (ones * 185 <= 2 * n * 15) == kept, (n, near)


def test_a_star_takes_one_round_of_steps(spark, monkeypatch):
    from meterline.llm import components as C

    written, kept = [], C.materialised
    monkeypatch.setattr(C, "materialised", lambda df, label: written.append(label) or kept(df, label))
    links = spark.createDataFrame([("a", f"b{k:02d}") for k in range(50)], "a string, b string")
    assert {r.label for r in components(links).collect()} == {"a"}
    assert len(written) <= 3, written


def test_few_texts_are_not_shuffled_and_written_step_by_step(make_docs, monkeypatch):
    rows = templated(40, np.random.default_rng(7))
    written, kept = [], N.materialised
    monkeypatch.setattr(N, "materialised", lambda df, label: written.append(label) or kept(df, label))
    assert got(N.near_duplicates(make_docs(rows))) == brute(rows)
    assert not {"shared", "pairs", "ends", "labels", "marked", "small"}.intersection(written), written


def test_many_texts_are_joined_by_shuffles(make_docs, monkeypatch):
    from meterline import session

    for module in (session, N):
        monkeypatch.setattr(module, "SENT_BYTES", 0)
    rows = templated(40, np.random.default_rng(8))
    assert got(N.near_duplicates(make_docs(rows))) == brute(rows)


def test_signatures_hold_short_values_that_tell_similarities():
    rng = np.random.default_rng(12)
    for n, own in ((1, 0), (20, 2), (300, 33), (1000, 111)):
        shared = []
        for _ in range(200):
            both = N.mix(rng.integers(0, 1 << 62, n, dtype=np.uint64), np.full(n, 5, np.uint64))
            a, b = (N.signature(np.unique(s)) for s in (both[own:], both[: n - own]))
            assert max(a) < 1 << 32 and a.dtype == np.uint64
            shared.append(np.mean(a == b))
        true = (n - 2 * own) / n
        assert abs(np.mean(shared) - true) < 0.01, (n, true)
        assert np.std(shared) < 1.25 * (true * (1 - true) / len(a)) ** 0.5 + 1e-9, n


def test_rows_that_stay_are_not_shuffled(make_docs):
    rows = templated(40, np.random.default_rng(9))
    found = N.one_of_each(make_docs(rows).select("doc_id", "text"), 85)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Aggregate" not in plan, plan
    kept = {x[0] for x in brute(rows) if x[3]}
    assert sorted(r.doc_id for r in found.collect()) == sorted(kept) and len(kept) < len(rows)


@pytest.mark.parametrize("sent", [N.SENT, 1])
def test_one_of_repeated_and_linked_rows_stays(make_docs, monkeypatch, sent):
    text = " ".join(f"w{k}" for k in range(100))
    rows = [(1, text), (1, text), (2, text + " more"), (3, "alone"), (3, "alone"), (None, "alone"), (None, None), (None, None)]
    monkeypatch.setattr(N, "SENT", sent)
    found = N.one_of_each(make_docs([*rows, (4, "another one"), (5, "")])).select("doc_id", "text").collect()
    want = [(1, text), (3, "alone"), (4, "another one"), (5, ""), (None, None)]
    assert Counter(map(tuple, found)) == Counter(want)
