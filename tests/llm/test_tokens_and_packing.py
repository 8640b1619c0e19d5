from __future__ import annotations

import functools
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import EDGE_ROWS
from tokenizers import Tokenizer

from meterline.llm import token_files, tokens
from meterline.llm.frames import FrameReader, FrameWriter
from meterline.llm.packing import pack
from meterline.llm.queries import QUERIES

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"


@functools.cache
def library(vocabulary):
    return Tokenizer.from_file(tokens.public_path(vocabulary))


def whole(vocabulary, text, end):
    return library(vocabulary).encode(text or "", add_special_tokens=False).ids + [end]


@pytest.mark.parametrize(("vocabulary", "spaced"), [(BYTE, True), (WORD, False)])
def test_cached_encoding_equals_the_library(vocabulary, spaced):
    texts = [t for _, t in EDGE_ROWS] + ["it's \n\n we'll  x\r\n", " lead", "a<|b", "x　y", "١٢ 3ab!?"]
    e = tokens.Encoder(tokens.public_path(vocabulary), spaced)
    t = Tokenizer.from_file(tokens.public_path(vocabulary))
    for _ in range(2):
        for text, ids in zip(texts, e.encode(texts), strict=True):
            assert ids.tolist() == t.encode(text or "", add_special_tokens=False).ids


def test_token_files_round_trip(make_docs, spark, folder):
    docs = make_docs(EDGE_ROWS)
    files = token_files.write_token_files(docs, folder, tokens.public_path(BYTE), end_id=0).collect()
    rows = token_files.read_token_files(spark, files, split_ids=1000).collect()
    assert len(rows) == len(EDGE_ROWS)
    rows.sort(key=lambda r: r["start"])
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    want = Counter((i, tuple(whole(BYTE, t, 0))) for i, t in EDGE_ROWS)
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4"))) for r in rows) == want
    start = 0
    for r in rows:
        assert r["start"] == start
        start += r["n_tokens"]


def test_one_document_is_read_from_its_own_frames(folder):
    w = FrameWriter(f"{folder}/a.tokens", frame_ids=100)
    docs = [np.arange(n, dtype="<u2") for n in (30, 90, 250, 0, 100)]
    for k, ids in enumerate(docs):
        w.add(k, ids)
    assert w.close() == 470
    r = FrameReader(f"{folder}/a.tokens")
    seen = []
    frame = r._frame
    r._frame = lambda k: (seen.append(k), frame(k))[1]
    assert r.ids(4).tolist() == docs[4].tolist() and seen == [5]
    for k, ids in enumerate(docs):
        assert r.ids(k).tolist() == ids.tolist()


def test_a_damaged_frame_is_noticed(folder):
    w = FrameWriter(f"{folder}/a.tokens")
    w.add(1, np.arange(500, dtype="<u2"))
    w.close()
    data = bytearray(open(f"{folder}/a.tokens", "rb").read())
    data[30] ^= 1
    open(f"{folder}/a.tokens", "wb").write(bytes(data))
    with pytest.raises(Exception, match=r"damaged|[Dd]ecompress|zstd"):
        FrameReader(f"{folder}/a.tokens").ids(0)


def check_pieces(rows, want):
    """``want``: the ids of each (doc_id, repetition)."""
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["length"] > 0
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"]].append(r)
    padded = used = 0
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 4096
        used += end
        padded += 0 if end & (end - 1) == 0 else 4096 - end
    for doc_id, copies in want.items():
        total = len(copies[0])
        cover = np.zeros(total, int)
        for r in docs[doc_id]:
            part = copies[0][r["start"] : r["start"] + r["length"]]
            assert r["doc_tokens"] == total
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4"))
            cover[r["start"] : r["start"] + r["length"]] += 1
        assert (cover == len(copies)).all()
    assert set(docs) == set(want)
    return padded, used


def test_packing_places_each_id_once(make_docs):
    rows = pack(make_docs(EDGE_ROWS), tokens.public_path(WORD), end_id=2).collect()
    want = defaultdict(list)
    for i, t in EDGE_ROWS:
        want[i].append(whole(WORD, t, 2))
    check_pieces(rows, want)
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"]


def test_packing_pads_little(spark, sf_dir):
    rows = QUERIES["op8_packing"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = defaultdict(list)
    for d in docs:
        want[d["doc_id"]].append(whole(WORD, d["text"], 2))
    padded, used = check_pieces(rows, want)
    assert padded <= 0.01 * used


def test_token_file_query(spark, sf_dir):
    rows = QUERIES["op7_token_files"](spark, sf_dir).collect()
    start = 0
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(got) == len(docs)
    for d in docs:
        ids = whole(BYTE, d["text"], 0)
        r = got[d["doc_id"]]
        assert (r["start"], r["n_tokens"]) == (start, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4"))
        start += len(ids)


def test_empty_table(make_docs, spark, folder):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pack(none, tokens.public_path(WORD), 2).count() == 0
    files = token_files.write_token_files(none, folder, tokens.public_path(BYTE), 0).collect()
    assert files == [] and token_files.read_token_files(spark, files).count() == 0
