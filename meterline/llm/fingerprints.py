"""Operator 4: order-independent fingerprints of documents (homomorphic multiset hash).

A document is the multiset of its paragraphs (lines). A paragraph hashes to a wide vector and
a document's fingerprint is the sum of these vectors modulo a power of two per lane, so the
order of paragraphs does not matter and a paragraph is inserted or deleted by adding or
subtracting its vector (``combine``). Lanes:

* 4 check lanes, modulo 2**32: two 64-bit hashes of the paragraph, in halves. They settle
  equality.
* 62 longs of two likeness lanes, modulo 2**31 each: how many of the paragraph's pairs of
  neighbouring words set the lane's bit in a 64-bit hash of the pair, 124 lanes from two
  hashes. Centred by the number of pairs (one more lane), two documents' lanes have a cosine
  close to that of their multisets of word pairs.

Everything is DataFrame expressions. Words are exploded and summed in the task that holds the
document, behind the one shuffle that brings documents in doc_id order next to each other.

Nulls and edge cases: a null text counts as empty; an empty text has one empty paragraph; null
doc_ids come first in the order; repeated rows are kept and follow each other (ordered by the
text's hash); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline.llm.registry import query, table

CHECK_LANES, LIKE_LONGS = 4, 62
_LOW32 = 0xFFFFFFFF
_PAIR = (1 << 31) | 1  # the lowest bit of both lanes of a long
_MODULI = [1 << 32] * CHECK_LANES + [1 << 31] + [1 << 62] * LIKE_LONGS

#: Ranges of doc_id per shuffle partition: enough to even out, few enough to list in a plan.
RANGES_PER_PARTITION = 2


def fingerprints(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``lanes`` (array<long>): the fingerprint of each row's ``text``.

    Keys must tell rows apart. If ``df`` is already dealt out by some of the keys, nothing is
    shuffled.
    """
    paragraphs = df.select(*keys, F.explode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("_p"))
    words = paragraphs.select(*keys, "_p", F.split("_p", " ").alias("_w"))
    pairs = words.select(
        *keys,
        "_p",
        F.posexplode(F.arrays_zip(F.col("_w").alias("a"), F.expr("slice(_w, 2, size(_w))").alias("b"))).alias("_i", "_ab"),
    )
    first = F.col("_i") == 0
    hashed = pairs.select(
        *keys,
        F.when(first, F.xxhash64("_p")).otherwise(0).alias("_c0"),
        F.when(first, F.xxhash64(F.lit(1), "_p")).otherwise(0).alias("_c1"),
        F.xxhash64("_ab").alias("_h0"),
        F.xxhash64(F.lit(1), "_ab").alias("_h1"),
    )
    checks = [
        F.sum(part)
        for c in ("_c0", "_c1")
        for part in (F.col(c).bitwiseAND(_LOW32), F.shiftrightunsigned(c, 32))
    ]
    likes = [
        F.sum(F.shiftrightunsigned(h, k).bitwiseAND(_PAIR)) for h in ("_h0", "_h1") for k in range(31)
    ]
    sums = [*checks, F.count(F.lit(1)), *likes]
    named = [c.alias(f"_s{k}") for k, c in enumerate(sums)]
    lanes = F.array(*[F.col(f"_s{k}").bitwiseAND(m - 1) for k, m in enumerate(_MODULI)])
    return hashed.groupBy(*keys).agg(*named).select(*keys, lanes.alias("lanes"))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Lanes of the multiset sum (or, with ``sign`` -1, difference) of two fingerprints.

    Both halves of a likeness long are taken apart, so that neither borrows from the other.
    """
    moduli = F.array(*[F.lit(m - 1) for m in _MODULI])
    low = (1 << 31) - 1

    def add(x: Column, y: Column) -> Column:
        return x + y if sign > 0 else x - y

    def lane(pair: Column, mask: Column) -> Column:
        x, y = pair["a"], pair["b"]
        lower = add(x.bitwiseAND(low), y.bitwiseAND(low)).bitwiseAND(low)
        upper = add(F.shiftright(x, 31), F.shiftright(y, 31)).bitwiseAND(low)
        return F.when(
            mask > F.lit(_LOW32), F.shiftleft(upper, 31).bitwiseOR(lower)
        ).otherwise(add(x, y).bitwiseAND(mask))

    return F.zip_with(F.arrays_zip(a.alias("a"), b.alias("b")), moduli, lane)


def text_of(lanes: Column) -> Column:
    """The fingerprint as lower-case hex, 16 digits a long."""
    return F.array_join(F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def _centred(lanes: Column) -> Column:
    n = F.element_at(lanes, CHECK_LANES + 1)
    longs = F.slice(lanes, CHECK_LANES + 2, LIKE_LONGS)
    low = F.transform(longs, lambda x: (2 * x.bitwiseAND((1 << 31) - 1) - n).cast("double"))
    high = F.transform(longs, lambda x: (2 * F.shiftright(x, 31) - n).cast("double"))
    return F.concat(low, high)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _ratio(dot: Column, a2: Column, b2: Column) -> Column:
    norm = F.sqrt(a2) * F.sqrt(b2)
    return F.when(norm > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot / norm))).otherwise(0.0)


def likeness(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Adds ``out``: 1 for equal lanes, else the cosine of the centred lanes, 0 at least."""
    vectors = df.withColumn("_va", _centred(F.col(a))).withColumn("_vb", _centred(F.col(b)))
    value = _ratio(
        _dot(F.col("_va"), F.col("_vb")),
        _dot(F.col("_va"), F.col("_va")),
        _dot(F.col("_vb"), F.col("_vb")),
    )
    return vectors.withColumn(out, F.when(F.col(a) == F.col(b), 1.0).otherwise(value)).drop("_va", "_vb")


def _lit_array(values: list, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def beside_next(docs: DataFrame, ranges: int) -> tuple[DataFrame, Window]:
    """Rows (doc_id, text) with the text of the next one, ascending and cyclic; and their window.

    Rows are dealt to ranges of doc_id, whose bounds are quantiles. The first rows of a range
    go to the range before as well (``halo`` 1), so no range needs to look into another.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    quantiles = F.percentile_approx("doc_id", [k / ranges for k in range(1, ranges)] or [0.5], 10_000)
    bounds = sorted(set(rows.select(quantiles).first()[0] or []))
    # Null ids come before all bounds: comparisons with null keep none.
    own = F.size(F.filter(_lit_array(bounds, "bigint"), lambda b: b <= F.col("doc_id")))
    heads = (
        rows.select("doc_id")
        .groupBy(own.alias("range"))
        .agg(F.min(F.struct("doc_id")).alias("head"))
        .orderBy("range")
        .collect()  # a row for each range
    )
    present = [h["range"] for h in heads]
    at = F.array_position(_lit_array(present, "int"), F.col("range")).cast("int")
    head = F.element_at(_lit_array([h["head"]["doc_id"] for h in heads], "bigint"), at)
    before = F.element_at(_lit_array(present[-1:] + present[:-1], "int"), at)
    own_row = F.struct(F.col("range").alias("range"), F.lit(0).alias("halo"))
    copy = F.struct(before.alias("range"), F.lit(1).alias("halo"))
    if not present:
        places = F.array(own_row)
    else:
        places = F.when(F.col("doc_id").eqNullSafe(head), F.array(own_row, copy)).otherwise(F.array(own_row))
    dealt = rows.withColumn("range", own).select("doc_id", "text", F.inline(places))
    order = Window.partitionBy("range").orderBy("halo", F.col("doc_id").asc_nulls_first(), "tie", "text")
    ranked = dealt.withColumn("tie", F.xxhash64("text"))
    return (
        ranked.withColumn("next_text", F.lead("text").over(order)).withColumn("rank", F.row_number().over(order)),
        Window.partitionBy("range").orderBy("rank"),
    )


def edited_text(text: Column, next_text: Column) -> Column:
    """The last quarter (rounded down) of the code points replaced by the next text's first."""
    n = F.length(text)
    cut = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut), F.substring(next_text, F.lit(1), cut))


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents (doc_id, text) and of their edited texts, and likenesses."""
    ranges = RANGES_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed, by_rank = beside_next(docs, ranges)
    keys = ["range", "rank", "halo", "doc_id", "n_chars", "edited_sha256"]
    edited = placed.withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    both = edited.select(
        "range",
        "rank",
        "halo",
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.posexplode(
            F.when(F.col("halo") == 0, F.array("text", "edited")).otherwise(F.array("text"))
        ).alias("which", "body"),
    )
    lanes = fingerprints(both, [*keys, "which"], "body")
    # Both rows of a document lie in one task: the edited one follows.
    pair = Window.partitionBy("range", "rank").orderBy("which")
    texts = (
        lanes.withColumn("edited_lanes", F.lead("lanes").over(pair))
        .filter("which = 0")
        .withColumn("next_lanes", F.lead("lanes").over(by_rank))
        .filter("halo = 0")
    )
    scored = likeness(texts, "lanes", "edited_lanes", "near_edited")
    scored = likeness(scored, "lanes", "next_lanes", "near_next")
    return scored.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        text_of(F.col("lanes")).alias("fingerprint"),
        text_of(F.col("edited_lanes")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@query("op4_fingerprints")
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts."""
    return document_fingerprints(table(spark, sf_dir, "documents"))
