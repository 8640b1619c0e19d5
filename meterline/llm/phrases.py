"""Operator 12: phrases of two or three words that belong together, mined per language.

Texts are dealt into blocks of bounded size, which a written table fixes. A task counts the words
of its blocks; words that are frequent enough get dense ids, joined back to the blocks that use
them, so that no dictionary of the whole corpus is broadcast. Each block packs its n-grams of
frequent words into keys and counts them in quotient filters (see ``quotient_filters``), one for
each shard of the permuted key space; a task per shard merges the sorted filters of all blocks.
Keys spread evenly over the shards however frequent a phrase is, and a block sends a phrase once.
Rarer words cannot be in a candidate, so leaving them out loses nothing; they count in ``n``.

Candidates are phrases that occur ``least`` times. Scores, cuts and the phrases inside longer
ones are joins and exact decimal arithmetic on the candidates.

Nulls and edge cases: a null text is empty, a null lang ``und``; a null doc_id and other columns
are not used; repeated rows count each time; a text longer than a block is a block of its own;
equal scores are ranked by count, then by phrase in UTF-8 byte order, and equal cuts go to the
smaller k; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline.llm.oracles import OP12_SQL
from meterline.llm.quotient_filters import Layout
from meterline.llm.registry import query, table
from meterline.session import materialised

LEAST, TOP = 10, 2000
#: In percent: a phrase goes if a longer candidate around it occurs in such a share of its places.
INSIDE = 50
MILLION = 1_000_000
#: Bytes of text in a block; n-grams that a shard receives on average; words in a slot of ids.
BLOCK_BYTES, SHARD_KEYS, SLOT_WORDS = 4 << 20, 1 << 20, 1 << 19

#: What ends a piece, what parts words.
ENDS, GAPS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
_TABLE = bytes.maketrans(ENDS + GAPS, b"\n" * len(ENDS) + b" " * len(GAPS))


def words_of(text: str | None) -> list[bytes]:
    """The text's words, lower-cased in A-Z, with a line feed where a piece ends."""
    data = (text or "").encode("utf-8", "replace").lower().translate(_TABLE).replace(b"\n", b" \n ")
    return [w for w in data.split(b" ") if w]


def _utf8(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.binary()).cast(pa.string())


def blocks_of(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, lang, text) of all documents, written so that a block stays what it is."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            ids = []
            for size in batch.column("size").to_pylist():
                if held and held + size > block_bytes:
                    block, held = block + 1, 0
                ids.append(block)
                held += size
            columns = [pa.array(ids, pa.int64()), batch.column("lang"), batch.column("text")]
            yield pa.RecordBatch.from_arrays(columns, ["block", "lang", "text"])

    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.coalesce("lang", F.lit("und")).alias("lang"), text.alias("text"), F.octet_length(text).alias("size")
    )
    return materialised(rows.mapInArrow(deal, "block long, lang string, text string"), "blocks")


def uses_of(blocks: DataFrame) -> DataFrame:
    """(block, lang, word, n): how often a block uses a word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple, Counter] = defaultdict(Counter)
            for block, lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found[block, lang].update(words_of(text))
            for (block, lang), counts in found.items():
                counts.pop(b"\n", None)
                n = len(counts)
                columns = [pa.array([block] * n, pa.int64()), pa.array([lang] * n, pa.string())]
                columns += [_utf8(list(counts)), pa.array(list(counts.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["block", "lang", "word", "n"])

    return materialised(blocks.mapInArrow(count, "block long, lang string, word string, n long"), "uses")


def numbered(uses: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, word, f, id) of the words that occur ``least`` times: dense ids from 1, by slots."""
    frequent = uses.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    frequent = materialised(frequent, "frequent")
    slots = max(1, math.ceil(frequent.count() / SLOT_WORDS))
    slot = F.pmod(F.xxhash64("lang", "word"), F.lit(slots))
    place = F.row_number().over(Window.partitionBy("slot").orderBy("lang", "word")).cast("long") - 1
    ids = frequent.withColumn("slot", slot).withColumn("id", place * slots + F.col("slot") + 1)
    return materialised(ids.drop("slot"), "numbered")


def counted(blocks: DataFrame, uses: DataFrame, words: DataFrame, least: int = LEAST, shard_keys: int = SHARD_KEYS):
    """(w1, w2, w3, a) of the pairs (w3 is 0) and triples of ids that occur ``least`` times."""
    top = words.agg(F.max("id")).first()[0] or 1
    total = 2 * (uses.agg(F.sum("n")).first()[0] or 1)
    bits = int(top).bit_length()
    shard_bits = min(max(0, math.ceil(math.log2(total / shard_keys))), (3 * bits + 1) // 2)
    layout = Layout(bits, shard_bits)

    def ids_of(texts: pa.Table, known: pa.Table) -> np.ndarray:
        by_lang: dict[str, dict] = defaultdict(dict)
        for lang, word, k in zip(*(known.column(c).to_pylist() for c in ("lang", "word", "id")), strict=True):
            by_lang[lang][word.encode()] = k
        out: list[int] = []
        for lang, text in zip(texts.column("lang").to_pylist(), texts.column("text").to_pylist(), strict=True):
            out.extend(map(by_lang[lang].get, words_of(text), repeat(0)))
            out.append(0)
        return np.array([*out, 0, 0], np.uint64)

    def count(texts: pa.Table, known: pa.Table) -> pa.Table:
        ids = ids_of(texts, known)
        pair = np.flatnonzero((ids[:-2] != 0) & (ids[1:-1] != 0))
        triple = pair[ids[pair + 2] != 0]
        nothing = np.zeros(len(pair), np.uint64)
        first, second = np.concatenate([ids[pair], ids[triple]]), np.concatenate([ids[pair + 1], ids[triple + 1]])
        keys = layout.permute(*layout.pack(first, second, np.concatenate([nothing, ids[triple + 2]])))
        rows = list(layout.filters(*layout.counted(*keys)))
        return pa.table(
            {"shard": pa.array([s for s, _ in rows], pa.int64()), "filter": pa.array([f for _, f in rows], pa.binary())}
        )

    def merge(filters: pa.Table) -> pa.Table:
        shard = filters.column("shard")[0].as_py()
        left, right, a = layout.merged(shard, filters.column("filter").to_pylist())
        often = a >= least
        ids = layout.unpack(*layout.restore(left[often], right[often]))
        columns = [pa.array(c.astype(np.int64)) for c in (*ids, a[often])]
        return pa.table(columns, names=["w1", "w2", "w3", "a"])

    # A word that a block names twice gets its id twice, which does no harm.
    known = uses.select("block", "lang", "word").join(words.drop("f"), ["lang", "word"])
    filters = blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(count, "shard long, filter binary")
    return materialised(filters.groupBy("shard").applyInArrow(merge, "w1 long, w2 long, w3 long, a long"), "counted")


def _score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000000 * a * a / (l * r)), exact; as l and r are at least a, it is at most a million."""
    whole = "decimal(38,0)"
    over = (a.cast("decimal(18,0)") * a.cast("decimal(18,0)")).cast("decimal(31,0)") * F.lit(MILLION).cast("decimal(7,0)")
    return F.call_function(
        "div", over.cast(whole), (l.cast("decimal(18,0)") * r.cast("decimal(18,0)")).cast(whole)
    ).cast("long")


def scored(grams: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that no longer one takes the place of."""

    def word(k: int) -> DataFrame:
        return words.select(F.col("id").alias(f"w{k}"), F.col("f").alias(f"f{k}"), F.col("word").alias(f"word{k}"))

    pairs = grams.filter("w3 = 0").select("w1", "w2", "a")
    triples = grams.filter("w3 <> 0")
    around = triples.select("w1", "w2", "a").unionByName(
        triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")
    )
    around = around.groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    outer = pairs.join(materialised(around, "around"), ["w1", "w2"], "left")
    free = outer.filter(F.col("longer").isNull() | (100 * F.col("longer") < INSIDE * F.col("a")))
    lang = words.select(F.col("id").alias("w1"), "lang")
    two = free.join(word(1), "w1").join(word(2), "w2").join(lang, "w1")
    two = two.select(
        "lang",
        F.concat_ws(" ", "word1", "word2").alias("phrase"),
        "a",
        F.col("f1").alias("l"),
        F.col("f2").alias("r"),
        _score(F.col("a"), F.col("f1"), F.col("f2")).alias("score"),
    )
    three = (
        triples.join(pairs.withColumnRenamed("a", "f12"), ["w1", "w2"])
        .join(pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23")), ["w2", "w3"])
        .join(word(1), "w1")
        .join(word(2), "w2")
        .join(word(3), "w3")
        .join(lang, "w1")
        .withColumn("first", _score(F.col("a"), F.col("f1"), F.col("f23")))
        .withColumn("second", _score(F.col("a"), F.col("f12"), F.col("f3")))
    )
    early = F.col("first") <= F.col("second")
    three = three.select(
        "lang",
        F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"),
        "a",
        F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"),
        F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"),
        F.least("first", "second").alias("score"),
    )
    return two.unionByName(three)


def phrases(docs: DataFrame, least: int = LEAST, top: int = TOP, block_bytes: int = BLOCK_BYTES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language."""
    blocks = blocks_of(docs, block_bytes)
    uses = uses_of(blocks)
    words = numbered(uses, least)
    found = scored(counted(blocks, uses, words, least, shard_keys), words)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = uses.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


@query("op12_phrases", OP12_SQL)
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of every language, over all documents."""
    return phrases(table(spark, sf_dir, "documents"))
