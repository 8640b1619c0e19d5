from __future__ import annotations

import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
from cases import EDGE_ROWS
from pyspark.sql import functions as F
from test_tokens_and_packing import WORD, whole

from meterline.llm import packing


def test_pipeline_returns_the_ids(make_docs, spark, sf_dir):
    rows = [(i, t) for i, t in EDGE_ROWS if i not in (None, 1)]
    parts = defaultdict(list)
    for r in corpus_pipeline.packing_stage(spark, make_docs(rows), sf_dir).collect():
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        parts[r["doc_id"]].append((r["start"], ids.tolist()))
    assert {i: [x for _, ids in sorted(p) for x in ids] for i, p in parts.items()} == {i: whole(WORD, t, 2) for i, t in rows}


def test_op8_takes_checksums_from_the_ids(spark, sf_dir, monkeypatch):
    pack = packing.pack
    want = {(r["sequence_id"], r["offset"]): r["ids_crc32"] for r in packing.op8_packing(spark, sf_dir).collect()}
    monkeypatch.setattr(packing, "pack", lambda *a, **b: pack(*a, **b).withColumn("ids_crc32", F.lit(0).cast("long")))
    got = {(r["sequence_id"], r["offset"]): r["ids_crc32"] for r in packing.op8_packing(spark, sf_dir).collect()}
    assert got == want and any(want.values())
