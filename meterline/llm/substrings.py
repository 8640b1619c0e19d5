"""Operator 2: duplicate word windows by anchored hashing of blocks and windows.

A word goes if a window of ``WINDOW`` words that covers it also starts earlier: in a document
of smaller doc_id, or further ahead in the same one.

The reference is the whole corpus, cut by content into *blocks*: all windows that share their
smallest seed of ``SEED`` words, with the words they cover (``windows.runs_of_many``). The index
holds each distinct block once, where it comes first. Documents are looked up in it; no greedy parse is made:

1. Blocks whose seed occurs nowhere else match nothing.
2. A block that is indexed at an earlier place is copied whole: one long factor, however many
   windows it has.
3. Where a factor ends, the block is only partly equal to indexed ones. At these boundaries
   each window is looked up by itself among the windows of the indexed blocks with that seed;
   each match is a factor of one window. Factors that touch are joined only as removed words.

The copies of a block are settled by one row of the index, so hot passages cost one row for
each copy. All steps are aggregations with map-side combining and joins that adaptive
execution splits; block and window keys are two 64-bit names each.

Nulls and edge cases: a null text has no words; texts of fewer words than a window stay; rows
with equal doc_id are ordered by the text's hash, and repeated rows are judged once, so each is
kept like the first; null doc_ids come before all others; long texts are handled in overlapping
segments; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline import session
from meterline.llm.oracles import OP2_SQL
from meterline.llm.registry import query, table
from meterline.llm.repeats import Rows, pack_place, unpack_place
from meterline.llm.windows import SEGMENT, Names, covered, runs_of_many, segments

WINDOW, SEED = 20, 5
#: Words of neighbouring texts that are named together, as numpy is slow on short arrays.
TOGETHER = 1 << 16
#: Null ids come first.
NO_ID = -(1 << 63)

def words_of(text: str) -> list[bytes]:
    return text.encode().split()  # bytes are split at \x20 and \x09 to \x0d, and nowhere else


def symbols_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc, mark, text, doc_id): what orders documents and tells them apart, without nulls."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("mark"), text.alias("text"), "doc_id"
    )


def together(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Symbols of neighbouring texts, ``TOGETHER`` or more at a time, as (rows, offsets, parts);
    a long text is cut into overlapping parts, such that each window lies in one."""
    rows, offsets, parts, size = [], [], [], 0
    for row, text in enumerate(texts):
        symbols = symbols_of(words_of(text.as_py()))
        for a, b in segments(len(symbols), WINDOW):
            rows.append(row)
            offsets.append(a)
            parts.append(symbols[a:b])
            size += b - a
            if size >= TOGETHER:
                yield np.array(rows), np.array(offsets), parts
                rows, offsets, parts, size = [], [], [], 0
    if parts:
        yield np.array(rows), np.array(offsets), parts


def find_blocks(texts: DataFrame) -> DataFrame:
    """A row per block: seed, block (a name for its content), doc, mark, place."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(["seed", "block", "doc", "mark", "place"])
        for batch in batches:
            doc, mark = (batch.column(k).to_numpy() for k in range(2))
            for row, offset, parts in together(batch.column(2)):
                found = runs_of_many(parts, WINDOW, SEED)
                if found:
                    r, part = found
                    place = pack_place(r.start + offset[part], r.count, r.anchor)
                    rows.add(len(place), r.seed, r.block, doc[row[part]], mark[row[part]], place)
                yield from rows.take()
        yield from rows.take(1)

    kinds = "seed long, block long, doc long, mark long, place long"
    return texts.select("doc", "mark", "text").mapInArrow(emit, kinds)


def find_windows(texts: DataFrame) -> DataFrame:
    """Rows (doc, mark, text, blocks: list of (seed, place)) to a row per window of these."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(["seed", "name", "doc", "mark", "start"])
        for batch in batches:
            doc, mark = (batch.column(k).to_numpy() for k in range(2))
            of_row, (seeds, places) = listed(batch.column(3), "seed", "place")
            first_block = np.searchsorted(of_row, np.arange(len(batch) + 1))
            for row, offset, parts in together(batch.column(2)):
                some = slice(first_block[row[0]], first_block[row[-1] + 1])
                first, n, _ = unpack_place(places[some])
                start = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                of = np.repeat(of_row[some], n)
                # A window lies in its row's part that starts at the multiple of SEGMENT before it.
                known, wanted = row << 40 | offset, of << 40 | start // SEGMENT * SEGMENT
                part = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
                here = np.flatnonzero(known[part] == wanted)
                if len(here):
                    length = np.array([len(p) for p in parts])
                    at = (np.cumsum(length) - length - offset)[part[here]] + start[here]
                    name = Names(np.concatenate(parts)).of(WINDOW)[at]
                    seed = np.repeat(seeds[some], n)[here]
                    rows.add(len(here), seed, name, doc[of[here]], mark[of[here]], start[here])
                yield from rows.take()
        yield from rows.take(1)

    return texts.mapInArrow(emit, "seed long, name long, doc long, mark long, start long")


def listed(lists: pa.Array, *fields: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of a column of lists of structs: each item's row, and its ``fields``."""
    size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    items = lists.flatten()
    return np.repeat(np.arange(len(lists)), size), [items.field(f).to_numpy(zero_copy_only=False) for f in fields]


def factors(texts: DataFrame) -> DataFrame:
    """Factors copied from earlier places: doc, mark, start (first window), windows,
    and the source's ref_doc, ref_mark, ref_start. ``texts`` holds doc, mark and text."""
    kept = session.materialised
    # Blocks are found twice, which is cheaper than to keep them.
    seeds = kept(find_blocks(texts).groupBy("seed").count().filter("count > 1").select("seed"), "seeds")
    blocks = kept(find_blocks(texts).join(seeds, "seed"), "blocks")
    place = F.struct("doc", "mark", F.col("place").alias("place"))
    index = blocks.groupBy("seed", "block").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    index = kept(index, "index")
    mixed = index.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("seed")
    first_window = F.shiftright("place", 16)
    whole = (
        blocks.join(index.filter("first < last").select("seed", "block", "first"), ["seed", "block"])
        .filter(place > F.col("first"))
        .select(
            "doc",
            "mark",
            first_window.alias("start"),
            (F.shiftright("place", 8).bitwiseAND(255) + 1).alias("windows"),
            F.col("first.doc").alias("ref_doc"),
            F.col("first.mark").alias("ref_mark"),
            F.shiftright("first.place", 16).alias("ref_start"),
        )
    )
    edges = (
        index.join(mixed, "seed")
        .groupBy(F.col("first.doc").alias("doc"), F.col("first.mark").alias("mark"))
        .agg(F.collect_list(F.struct("seed", F.col("first.place").alias("place"))).alias("blocks"))
    )
    found = find_windows(texts.join(edges, ["doc", "mark"]).select("doc", "mark", "text", "blocks"))
    windows = kept(found, "windows")
    at = F.struct("doc", "mark", "start")
    sources = (
        windows.groupBy("seed", "name")
        .agg(F.min(at).alias("source"), F.max(at).alias("last"))
        .filter("source < last")
        .drop("last")
    )
    sources = kept(sources, "sources")
    partly = (
        windows.join(sources, ["seed", "name"])
        .filter(at > F.col("source"))
        .select(
            "doc",
            "mark",
            "start",
            F.lit(1).cast("long").alias("windows"),
            F.col("source.doc").alias("ref_doc"),
            F.col("source.mark").alias("ref_mark"),
            F.col("source.start").alias("ref_start"),
        )
    )
    return kept(whole.unionByName(partly), "factors")


REMOVED = (
    "doc_id long, text string, kept string, spans array<struct<start:long,end:long>>, "
    "n_words long, n_removed long, kept_sha256 string"
)


def remove_duplicates(docs: DataFrame, with_texts: bool = True) -> DataFrame:
    """Documents (doc_id, text) without words that earlier windows hold.

    Returns doc_id, the removed word spans, counts and digest of the kept words, joined by
    spaces; ``with_texts`` adds the text and the kept words themselves.
    """
    texts = keyed(docs)
    copied = F.struct("start", "windows")
    found = factors(texts).groupBy("doc", "mark").agg(F.collect_list(copied).alias("factors"))
    joined = texts.join(found, ["doc", "mark"], "left").select("doc_id", "text", "factors")
    wanted = [x for x in REMOVED.split(", ") if with_texts or x.split()[0] not in ("text", "kept")]
    names = [x.split()[0] for x in wanted]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 256):
                yield cut(batch.slice(k, 256))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        of_row, (start, windows) = listed(batch.column(2), "start", "windows")
        copied = np.stack([start, windows], 1).astype(np.int64)
        bounds = np.searchsorted(of_row, np.arange(len(batch) + 1))
        spans, kept, n_words, n_removed = [], [], [], []
        for row, text in enumerate(batch.column(1)):
            words = words_of(text.as_py())
            first, last = covered(copied[bounds[row] : bounds[row + 1]], WINDOW, len(words))
            spans.append(np.stack([first, last], 1))
            n_words.append(len(words))
            n_removed.append(int((last - first).sum()))
            if len(first):
                edges = [0, *spans[-1].ravel().tolist(), len(words)]
                words = [w for a, b in zip(edges[::2], edges[1::2], strict=True) for w in words[a:b]]
            kept.append(b" ".join(words))
        ends = np.concatenate([[0], np.cumsum([len(x) for x in spans])])
        flat = np.concatenate(spans).astype(np.int64)
        structs = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["start", "end"])
        columns = {
            "doc_id": batch.column(0),
            "spans": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs),
            "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
        }
        if with_texts:
            columns |= {"text": batch.column(1), "kept": pa.array([x.decode() for x in kept], pa.string())}
        return pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return joined.mapInArrow(emit, ", ".join(wanted))


@query("op2_duplicate_windows", OP2_SQL)
def op2_duplicate_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove from all documents every word that an earlier 20-word window covers."""
    found = remove_duplicates(table(spark, sf_dir, "documents"), with_texts=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")
