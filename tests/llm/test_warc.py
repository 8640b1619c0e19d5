from __future__ import annotations

import gzip
import hashlib
from collections import Counter

import pytest

from meterline.llm import warc
from meterline.llm.queries import QUERIES


def brute(rows):
    first = {}
    for i, h in rows:
        d = (h or "").encode()
        if i is not None and len(d) >= 100:
            first[d] = min(first.get(d, i), i)
    out = []
    for i, h in rows:
        d = (h or "").encode()
        f = first.get(d)
        n = sum((h2 or "").encode() == d for _, h2 in rows)
        revisit = f is not None and i != f and n > 1
        out.append((i, len(d), hashlib.sha256(d).hexdigest(), "revisit" if revisit else "response", f if revisit else None))
    return Counter(out)


def got(df):
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def pages_of(spark, rows):
    full = [(i, f"http://x/{i}\r\nX: y", h, "clash") for i, h in rows]
    return spark.createDataFrame(full, "page_id long, url string, html string, payload string")


EDGES = [
    (5, "same " * 30),
    (3, "same " * 30),
    (9, "same " * 30),
    (3, "same " * 30),
    (None, "same " * 30),
    (7, "short"),
    (8, "short"),
    (1, None),
    (2, ""),
    (10, "WARC/1.1\r\nWARC-Type: fake\r\n\r\n" * 9),
    (11, "é" * 60_000 + "\r\n\r\n"),
    (None, "only without id " * 9),
    (None, "only without id " * 9),
]


@pytest.mark.parametrize("split", [50, 333, 1 << 20])
def test_edges_over_byte_ranges(spark, folder, split):
    archives = warc.write_archives(pages_of(spark, EDGES).repartition(2), folder).collect()
    assert got(warc.read_archives(spark, archives, split)) == brute(EDGES)


def test_each_record_is_owned_by_one_range(spark, folder, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").coalesce(1)
    (archive,) = warc.write_archives(pages, folder).collect()
    path, size = archive["path"], archive["bytes"]
    every = [r[0] for r in warc.records_between(path, 0, size)]
    for step in (997, 10_007):
        parts = [r[0] for k in range(0, size, step) for r in warc.records_between(path, k, min(size, k + step))]
        assert parts == every
    assert gzip.decompress(open(path, "rb").read()).count(warc.VERSION) >= len(every)


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert got(QUERIES["op3_warc"](spark, sf_dir)) == brute(rows)


def test_payloads_come_back(spark, folder):
    archives = warc.write_archives(pages_of(spark, EDGES), folder).collect()
    rows = warc.read_archives(spark, archives).collect()
    have = Counter((r["page_id"], bytes(r["payload"]).decode()) for r in rows if r["record_type"] == "response")
    assert have[7, "short"] == 1 and have[1, ""] == 1 and have[3, "same " * 30] == 2


def test_damage_is_noticed(spark, folder):
    (a,) = warc.write_archives(pages_of(spark, EDGES[:1]).coalesce(1), folder).collect()
    data = warc.record(1, "u", b"x" * 200, "0" * 64, "response", None)
    open(a["path"], "wb").write(warc.gzip_member(data))
    with pytest.raises(Exception, match="damaged"):
        list(warc.records_between(a["path"], 0, 10))


def test_empty_table(spark, folder):
    archives = warc.write_archives(pages_of(spark, []), folder).collect()
    assert archives == [] and warc.read_archives(spark, archives).count() == 0
