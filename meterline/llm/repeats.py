"""Operator 1: exact repeated byte strings by prefix doubling over sampled positions.

A byte goes if a string of ``WINDOW`` bytes that covers it starts at two places or more. Prefix
doubling sorts (position, rank) pairs at growing offsets and reranks until a position's string
is unique, or longer than the threshold. Doubling every byte position would shuffle several
times the input, so positions are sampled by content (``windows``): all windows around one
anchor form a run.

1. Rank 0, 48 bytes: the seeds at the runs' anchors. Runs with a unique seed are done.
2. Runs with equal content around equal seeds: all their windows repeat, and one of them stands
   for the others from here on. Runs whose seed has such equals only are done.
3. What is left are runs at the edges of repeats, and chance repeats of a seed. Their windows
   are taken in nodes of ``NODE`` that share a core of 185 bytes. Cores are ranked by doubling:
   (48 bytes, next 48) pairs, then (96 bytes, last 96) pairs; unique ones drop out each time.
4. Windows of the nodes that are left: (core's rank, 200-byte name) pairs. What occurs twice
   repeats.

Every step is an aggregation with map-side combining and a join back, so a string that a third
of all documents hold is one row in the aggregate and is split by adaptive execution in the
join. Positions are (doc_id, hash of the text, offset). Ranks are 64-bit, and each step's key
holds two of them.

Nulls and edge cases: a null text is empty; texts shorter than the window stay as they are;
repeated rows and copies repeat each other's strings; null doc_ids count as documents of their
own; texts over a megabyte are named in overlapping segments; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline import session
from meterline.llm.registry import query, table
from meterline.llm.windows import BYTE_NAMES, Names, covered, runs_of, segments

WINDOW, SEED, NODE = 200, 48, 16
CORE = WINDOW - NODE + 1
#: Rows of an output batch; texts wait until about so many are ready.
BATCH_ROWS = 1 << 16

_INT64 = pa.int64()


class Rows:
    """Collects columns of numbers and hands them out as record batches."""

    def __init__(self, names: list[str]):
        self.schema = pa.schema([(n, _INT64) for n in names])
        self.parts: list[list[np.ndarray]] = [[] for _ in names]
        self.size = 0

    def add(self, n: int, *columns) -> None:
        for part, column in zip(self.parts, columns, strict=True):
            if isinstance(column, (int, np.integer)):
                column = np.full(n, column, np.int64)
            part.append(column.view(np.int64) if column.dtype == np.uint64 else column.astype(np.int64))
        self.size += n

    def take(self, least: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
        if self.size >= max(1, least):
            arrays = [pa.array(np.concatenate(p)) for p in self.parts]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)
            self.parts, self.size = [[] for _ in self.parts], 0


def keyed(docs: DataFrame) -> DataFrame:
    """(doc, mark, text): what tells documents apart, without nulls."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.coalesce("doc_id", F.lit(0)).alias("doc"),
        F.hash(text, F.col("doc_id").isNull()).cast("long").alias("mark"),
        text.alias("text"),
        "doc_id",
    )


def sequence(text: str) -> np.ndarray:
    return BYTE_NAMES[np.frombuffer(text.encode(), np.uint8)]


# A run's place in one number: first window, windows, distance of the anchor (both below 256).
def pack_place(start: np.ndarray, count: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return (start << 16) | ((count - 1) << 8) | anchor


def unpack_place(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 16, ((place >> 8) & 255) + 1, place & 255


def find_runs(docs: DataFrame) -> DataFrame:
    """A row per run of windows: seed, block, doc, mark, place."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(["seed", "block", "doc", "mark", "place"])
        for batch in batches:
            for doc, mark, text in zip(*(batch.column(k) for k in range(3)), strict=True):
                symbols = sequence(text.as_py())
                for a, b in segments(len(symbols), WINDOW):
                    r = runs_of(Names(symbols[a:b]), WINDOW, SEED)
                    if r:
                        place = pack_place(r.start + a, r.count, r.anchor)
                        rows.add(len(place), r.seed, r.block, doc.as_py(), mark.as_py(), place)
                yield from rows.take()
        yield from rows.take(1)

    kinds = "seed long, block long, doc long, mark long, place long"
    return docs.select("doc", "mark", "text").mapInArrow(emit, kinds)


def find_nodes(texts: DataFrame) -> DataFrame:
    """Rows (doc, mark, text, places) to a row per node: its core's names and its windows."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(["rank", "next", "last", "doc", "mark", "windows"])
        for batch in batches:
            for doc, mark, text, places in zip(*(batch.column(k) for k in range(4)), strict=True):
                symbols = sequence(text.as_py())
                at = np.array(places.as_py(), np.int64)
                start, count, anchor = unpack_place(at)
                for a, b in segments(len(symbols), WINDOW):
                    here = (start >= a) & (start < a + max(1, b - a - WINDOW + 1))
                    if not here.any():
                        continue
                    names = Names(symbols[a:b])
                    n48, n96 = names.of(SEED), names.of(2 * SEED)
                    s, c, d = start[here] - a, count[here], anchor[here]
                    far, near = d, d - c + 1  # the anchor's distance from the run's windows
                    for node in range(int(near.min()) // NODE, int(far.max()) // NODE + 1):
                        low, high = node * NODE, node * NODE + NODE - 1
                        k = np.flatnonzero((near <= high) & (far >= low))
                        if not len(k):
                            continue
                        core = s[k] + d[k] - low
                        first = s[k] + d[k] - np.minimum(high, far[k])
                        n = np.minimum(high, far[k]) - np.maximum(low, near[k]) + 1
                        rows.add(
                            len(k),
                            n48[core] + np.uint64(node),  # cores at other distances are apart
                            n48[core + SEED],
                            n96[core + CORE - 2 * SEED],
                            doc.as_py(),
                            mark.as_py(),
                            ((first + a) << 8) | n,
                        )
                yield from rows.take()
        yield from rows.take(1)

    kinds = "rank long, next long, last long, doc long, mark long, windows long"
    return texts.mapInArrow(emit, kinds)


def rerank(rows: DataFrame, following: str) -> DataFrame:
    """One doubling: new ranks for equal (rank, ``following``) pairs; unique ones drop out.

    The new rank is the smallest of the pair's positions, which tells its string from others.
    """
    place = F.xxhash64("doc", "mark", "windows")
    pairs = (
        rows.groupBy("rank", following)
        .agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("new_rank"))
        .filter("n > 1")
        .drop("n")
    )
    pairs = session.materialised(pairs, "ranks")
    return rows.join(pairs, ["rank", following]).drop("rank", following).withColumnRenamed("new_rank", "rank")


def find_windows(texts: DataFrame) -> DataFrame:
    """Rows (doc, mark, text, nodes) to a row per window: its core's rank and its name."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(["rank", "name", "doc", "mark", "start"])
        for batch in batches:
            for doc, mark, text, nodes in zip(*(batch.column(k) for k in range(4)), strict=True):
                symbols = sequence(text.as_py())
                listed = nodes.as_py()
                rank = np.array([x["rank"] for x in listed], np.int64)
                where = np.array([x["windows"] for x in listed], np.int64)
                first, n = where >> 8, where & 255
                start = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                rank = np.repeat(rank, n)
                for a, b in segments(len(symbols), WINDOW):
                    here = np.flatnonzero((start >= a) & (start < a + max(1, b - a - WINDOW + 1)))
                    if len(here):
                        name = Names(symbols[a:b]).of(WINDOW)[start[here] - a]
                        rows.add(len(here), rank[here], name, doc.as_py(), mark.as_py(), start[here])
                yield from rows.take()
        yield from rows.take(1)

    kinds = "rank long, name long, doc long, mark long, start long"
    return texts.mapInArrow(emit, kinds)


def repeated_windows(texts: DataFrame) -> DataFrame:
    """(doc, mark, windows): for each text, its windows that occur elsewhere as well.

    ``texts`` holds doc, mark and text. A stretch of windows is packed as first << 8 | count-1.
    """
    kept = session.materialised
    # Rank 0. Runs are found twice, which is cheaper than to keep them.
    seeds = kept(find_runs(texts).groupBy("seed").count().filter("count > 1").select("seed"), "seeds")
    runs = kept(find_runs(texts).join(seeds, "seed"), "runs")
    blocks = runs.groupBy("seed", "block").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "mark", "place")).alias("one")
    )
    blocks = kept(blocks, "blocks")
    mixed = blocks.groupBy("seed").agg(F.count(F.lit(1)).alias("blocks")).filter("blocks > 1").select("seed")
    whole = (
        runs.join(blocks.filter("n > 1").select("seed", "block"), ["seed", "block"])
        .select("doc", "mark", F.expr("(place >> 16 << 8) | (place >> 8 & 255)").alias("windows"))
    )
    open_runs = (
        blocks.join(mixed, "seed")
        .groupBy(F.col("one.doc").alias("doc"), F.col("one.mark").alias("mark"))
        .agg(F.collect_list("one.place").alias("places"))
    )
    nodes = find_nodes(texts.join(open_runs, ["doc", "mark"]).select("doc", "mark", "text", "places"))
    nodes = kept(rerank(kept(nodes, "nodes"), "next"), "pairs")
    nodes = rerank(nodes, "last")
    listed = nodes.groupBy("doc", "mark").agg(F.collect_list(F.struct("rank", "windows")).alias("nodes"))
    windows = find_windows(texts.join(listed, ["doc", "mark"]).select("doc", "mark", "text", "nodes"))
    windows = kept(windows, "windows")
    twice = windows.groupBy("rank", "name").count().filter("count > 1").select("rank", "name")
    twice = kept(twice, "twice")
    edges = windows.join(twice, ["rank", "name"]).select("doc", "mark", F.shiftleft("start", 8).alias("windows"))
    return kept(whole.unionByName(edges), "repeats")


REMOVED = (
    "doc_id long, text string, kept binary, spans array<struct<start:long,end:long>>, "
    "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
)


def remove_repeats(docs: DataFrame, with_texts: bool = True) -> DataFrame:
    """Documents (doc_id, text) without their repeated bytes.

    Returns doc_id, the removed byte spans, counts and digest of what is left; ``with_texts``
    adds the text and what is left of it (bytes: a cut may part a character).
    """
    texts = keyed(docs)
    found = repeated_windows(texts).groupBy("doc", "mark").agg(F.collect_list("windows").alias("windows"))
    joined = texts.join(found, ["doc", "mark"], "left").select("doc_id", "text", "windows")
    names = [x.split()[0] for x in REMOVED.split(", ")]
    wanted = names if with_texts else [n for n in names if n not in ("text", "kept")]
    span = pa.list_(pa.struct([("start", _INT64), ("end", _INT64)]))
    types = dict(
        zip(names, [_INT64, pa.string(), pa.binary(), span, _INT64, _INT64, _INT64, pa.string()], strict=True)
    )
    schema = pa.schema([(n, types[n]) for n in wanted])

    def cut(doc_id: int | None, text: str, windows: list[int] | None) -> dict:
        data = text.encode()
        packed = np.array(windows or [], np.int64)
        first, last = covered(np.stack([packed >> 8, (packed & 255) + 1], 1), WINDOW, len(data))
        edges = [0, *np.stack([first, last], 1).ravel().tolist(), len(data)]
        kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
        return {
            "doc_id": doc_id,
            "text": text,
            "kept": kept,
            "spans": [{"start": a, "end": b} for a, b in zip(first.tolist(), last.tolist(), strict=True)],
            "n_bytes": len(data),
            "n_removed": len(data) - len(kept),
            "n_spans": len(first),
            "kept_sha256": hashlib.sha256(kept).hexdigest(),
        }

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 256):
                rows = [cut(*(v.as_py() for v in r)) for r in zip(*batch.slice(k, 256).columns, strict=True)]
                columns = [pa.array([r[n] for r in rows], types[n]) for n in wanted]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    chosen = ", ".join(x for x in REMOVED.split(", ") if x.split()[0] in wanted)
    return joined.mapInArrow(emit, chosen)


@query("op1_repeated_strings")
def op1_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove from all documents every byte that a repeated 200-byte string covers."""
    found = remove_repeats(table(spark, sf_dir, "documents"), with_texts=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
