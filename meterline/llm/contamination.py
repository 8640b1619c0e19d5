"""Operator 6: benchmark items contained in documents, by size-partitioned MinHash search.

Test items are short and documents long, so their Jaccard similarity says little. Containment
(the share of an item's word shingles that a document has) is searched from the small side:

1. Items are partitioned by size, the number of their distinct shingles, into classes that
   double. In each class an item is sketched by ``SAMPLES`` MinHash samples: the shingles that
   are smallest under so many hash functions. A document that contains a share c of an item
   holds each sample with probability c. Items of a class of at most ``SAMPLES`` shingles are
   sketched by all of them.
2. Documents' shingles are looked up among the samples. A document and an item become a
   candidate if the document is large enough for the item's class and holds ``LEAST_SAMPLES``
   samples, which a share of 0.8 misses with probability 4e-10.
3. Candidates are verified by counting the item's shingles in the document exactly, on the
   words themselves.

All is DataFrame expressions. Documents are scanned twice and not shuffled unless the samples
or the candidates are too large for a broadcast (Spark decides by their size on disk). Each
document is handled by itself, so hot passages only add candidates.

Nulls and edge cases: an item or document without text has no shingles and is linked with
nothing; items of fewer than ``WORDS`` words are looked for as a whole; letters A-Z count as
lower case; repeated documents each get their result, repeated items count by item_id and
text, items with a null item_id are ignored; empty tables give no items, or no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline import session
from meterline.llm.registry import query, table

WORDS, SHARE = 5, 0.8
SAMPLES, LEAST_SAMPLES = 16, 2
NO_ID = -(1 << 63)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    # Texts of ASCII only need no look-up of each character.
    plain = F.octet_length(text) == F.length(text)
    lower = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.array_remove(F.split(lower, "[\\x20\\x09-\\x0D]+"), "")


def shingles(words: Column, width: int) -> Column:
    """All runs of ``width`` words, as structs."""
    n = F.greatest(F.size(words) - (width - 1), F.lit(0))
    return F.arrays_zip(*[F.slice(words, F.lit(k + 1), n).alias(f"w{k}") for k in range(width)])


def _text_of(width: int):
    return lambda s: F.concat_ws(" ", *[s[f"w{k}"] for k in range(width)])


def item_shingles(items: DataFrame) -> DataFrame:
    """item, item_id, size, width and shingle (text) of all items (item_id, text) with words."""
    worded = (
        items.filter("item_id is not null")
        .select("item_id", F.xxhash64("text").alias("mark"), words_of(F.col("text")).alias("words"))
        .withColumn("n_words", F.size("words"))
        .filter("n_words > 0")
    )
    parts = None
    for width in range(1, WORDS + 1):
        fitting = F.col("n_words") == width if width < WORDS else F.col("n_words") >= WORDS
        rows = worded.filter(fitting).select("item_id", "mark", F.explode(shingles(F.col("words"), width)).alias("s"))
        part = rows.select("item_id", "mark", F.lit(width).alias("width"), _text_of(width)(F.col("s")).alias("shingle"))
        parts = part if parts is None else parts.unionByName(part)
    distinct = parts.distinct()
    sizes = distinct.groupBy("item_id", "mark").agg(F.count(F.lit(1)).alias("size"))
    return distinct.join(sizes, ["item_id", "mark"])


def sample(shingle_rows: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """item_id, mark, size, size_class, width, shingle_hash, weight: MinHash samples of items.

    The weight is the number of hash functions under which the shingle is the smallest.
    """
    rows = shingle_rows.withColumn("size_class", F.floor(F.log2("size")).cast("int"))
    large = F.pow(F.lit(2), F.col("size_class") + 1) > samples
    keys = ["item_id", "mark", "size", "size_class", "width"]
    small = rows.filter(~large).select(*keys, "shingle", F.lit(1).alias("weight"))
    lowest = [
        F.min(F.struct(F.xxhash64(F.lit(k), "shingle").alias("h"), "shingle")).alias(f"m{k}") for k in range(samples)
    ]
    sketched = rows.filter(large).groupBy(*keys).agg(*lowest)
    sampled = sketched.select(*keys, F.explode(F.array(*[f"m{k}.shingle" for k in range(samples)])).alias("shingle"))
    sampled = sampled.groupBy(*keys, "shingle").agg(F.count(F.lit(1)).cast("int").alias("weight"))
    return small.unionByName(sampled)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("doc_mark"), "text")


def _worded(keyed: DataFrame) -> DataFrame:
    worded = keyed.select("doc", "doc_mark", words_of(F.col("text")).alias("words"))
    return worded.withColumn("n_words", F.size("words"))


def contained(docs: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """doc, doc_mark, item_id, mark, containment for all documents (doc_id, text) that hold at
    least ``share`` of the distinct shingles of an item (item_id, text)."""
    wanted = session.materialised(item_shingles(items), "items")
    samples = session.materialised(sample(wanted), "samples")
    widths = sorted(r["width"] for r in wanted.select("width").distinct().collect())  # five at most
    keys = ["doc", "doc_mark"]
    worded = _worded(_keyed(docs))
    hits = None
    for width in widths or [WORDS]:
        rows = worded.select(*keys, "n_words", F.explode(shingles(F.col("words"), width)).alias("s"))
        found = rows.select(*keys, "n_words", F.xxhash64("s").alias("shingle_hash"))
        some = samples.filter(F.col("width") == width)
        parts = F.split("shingle", " ")
        named = some.withColumn("shingle_hash", F.xxhash64(F.struct(*[parts[k].alias(f"w{k}") for k in range(width)])))
        # Smaller documents cannot hold the share of the smallest size of the class.
        fits = F.col("n_words") >= share * F.pow(F.lit(2), F.col("size_class"))
        hit = found.join(named, "shingle_hash").filter(fits).select(*keys, "item_id", "mark", "size", "shingle", "weight")
        hits = hit if hits is None else hits.unionByName(hit)
    group = [*keys, "item_id", "mark", "size"]
    held = hits.groupBy(*group, "shingle").agg(F.max("weight").alias("weight"))
    # All shingles of a small item are samples: it needs its share of them, but one will do.
    enough = F.when(F.col("size") < LEAST_SAMPLES, 1).otherwise(LEAST_SAMPLES)
    candidates = session.materialised(
        held.groupBy(*group).agg(F.sum("weight").alias("held")).filter(F.col("held") >= enough).drop("held"),
        "candidates",
    )
    sought = _worded(_keyed(docs).join(candidates.select(*keys).distinct(), keys, "left_semi"))
    counted = None
    for width in widths or [WORDS]:
        rows = sought.select(*keys, F.explode(shingles(F.col("words"), width)).alias("s"))
        rows = rows.select(*keys, _text_of(width)(F.col("s")).alias("shingle"))
        match = rows.join(wanted.filter(F.col("width") == width).select("item_id", "mark", "shingle"), "shingle")
        counted = match if counted is None else counted.unionByName(match)
    exact = counted.distinct().groupBy(*keys, "item_id", "mark").agg(F.count(F.lit(1)).alias("n"))
    shares = candidates.join(exact, [*keys, "item_id", "mark"]).withColumn("containment", F.col("n") / F.col("size"))
    return shares.filter(F.col("n") >= F.lit(share) * F.col("size")).select(*keys, "item_id", "mark", "containment")


def contamination(docs: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """``docs`` with n_items, item_ids (ascending) and containment (the largest share of the
    items found, 0 without any); these replace columns of the same names."""
    found = (
        contained(docs, items, share)
        .groupBy("doc", "doc_mark")
        .agg(F.sort_array(F.collect_set("item_id")).alias("_ids"), F.max("containment").alias("_most"))
    )
    kept = [c for c in docs.columns if c not in ("n_items", "item_ids", "containment")]
    rows = docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"),
        F.xxhash64("text").alias("doc_mark"),
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"),
    )
    joined = rows.join(found, ["doc", "doc_mark"], "left")
    ids = F.coalesce("_ids", F.array().cast("array<long>"))
    return joined.select(
        *[F.col(f"_row.`{c}`") for c in kept],
        F.size(ids).cast("long").alias("n_items"),
        ids.alias("item_ids"),
        F.coalesce("_most", F.lit(0.0)).alias("containment"),
    )


OP6_SQL = """
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
doc_shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words)),
item_words AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM benchmark),
item_shingles AS (
  SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM item_words)),
sizes AS (SELECT item_id, count(*) AS size FROM item_shingles GROUP BY item_id),
found AS (
  SELECT doc_id, item_id, count(*) / size AS containment
  FROM doc_shingles JOIN item_shingles USING (s) JOIN sizes USING (item_id)
  GROUP BY doc_id, item_id, size HAVING count(*) >= 0.8 * size)
SELECT doc_id, count(item_id) AS n_items,
  coalesce(array_to_string(list_sort(list(item_id) FILTER (item_id IS NOT NULL)), ','), '') AS item_ids,
  coalesce(max(containment), 0.0) AS containment
FROM documents LEFT JOIN found USING (doc_id) GROUP BY doc_id
"""


@query("op6_decontamination", OP6_SQL)
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_items", F.array_join("item_ids", ",").alias("item_ids"), "containment")
