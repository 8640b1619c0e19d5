"""Operator 10: near-duplicate lines by a deletion-neighbourhood join.

Lines are sequences of words (white space of any kind parts them), and the edit bound is one
word: inserted, deleted or replaced. Two lines are within it exactly if they are equal after
leaving out at most one word of each: the same remainder with the word left out at the same
place (replaced), or the other whole line (inserted or deleted). So a line's variants are
itself and itself without each of its words, and lines that share a variant are joined on the
variant's hash; the place tells a replaced word from a moved one. Bounds by word keep the
number of variants at the number of words; by character it would be the length of the corpus.

A line is removed if an earlier line (ascending doc_id, then position) is within the bound.
All judgements are made on the input. Each variant group is settled against its earliest line,
by aggregation; no pairs within a group are formed. Matches are verified on the words
themselves. Lines of fewer than ``MIN_WORDS`` words have no variants, which keeps one edit to a
similarity of 0.8 or more. Equal lines need no such bound: those of ``exact_words`` words or
more go. It is ``MIN_WORDS`` unless told, which is the definition that the query's SQL states;
1 takes every line that has a word.

The texts are split once: what follows reads the lines' hashes and places. Before variants are made, lines that can have no partner are set aside without loss: two
distinct lines within the bound share their first or last half (rounded down, of the shorter
one), so only lines whose half occurs in another line go on.

Nulls and edge cases: a null text stays null; empty lines stay; texts that are equal and have
equal doc_ids are judged as one document and all get its result; null doc_ids come first;
documents of equal doc_id are ordered by the text's hash; an empty table gives no rows; other
columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline import session
from meterline.llm.oracles import OP10_SQL
from meterline.llm.registry import query, table

MIN_WORDS = 5
NO_ID = -(1 << 63)

KEY = ["doc", "mark"]
PLACE = ["doc", "mark", "line_no"]


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("mark"), "text")


def lines_of(text: Column) -> Column:
    """The lines of ``text``, their white space as spaces."""
    white = "[\\x09\\x0B-\\x0D]"
    return F.split(F.when(text.rlike(white), F.regexp_replace(text, white, " ")).otherwise(text), "\n")


def words_of(line: Column) -> Column:
    """The words of a line of ``lines_of``. A plain space needs no pattern to split at."""
    return F.array_remove(F.split(line, " "), "")


def named_lines(texts: DataFrame, least: int, min_words: int) -> DataFrame:
    """doc, mark, line_no, two hashes and the keys of the halves (none below ``min_words``) of the
    lines of ``least`` words or more; ``texts`` as ``keyed``. Holds numbers only."""
    lines = texts.select(*KEY, F.posexplode(F.transform(lines_of(F.col("text")), words_of)).alias("line_no", "words"))
    n = F.size("words")
    return lines.filter(n >= least).select(
        *PLACE,
        F.xxhash64("words").alias("h0"),
        F.xxhash64(F.lit(1), "words").alias("h1"),
        F.when(n >= min_words, _halves()).alias("halves"),
    )


def _halves() -> Column:
    """Keys of a line's first and last words, as many as half of a line of n or n-1 words."""
    n = F.size("words")

    def both(c: Column, tag: int) -> list[Column]:
        first = F.slice("words", F.lit(1), c)
        last = F.slice("words", n - c + 1, c)
        return [F.xxhash64(F.lit(tag), c, first), F.xxhash64(F.lit(tag + 1), c, last)]

    own, shorter = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")
    return F.when(own == shorter, F.array(*both(own, 0))).otherwise(F.array(*both(own, 0), *both(shorter, 0)))


def earlier_lines(texts: DataFrame, min_words: int = MIN_WORDS, exact_words: int | None = None) -> DataFrame:
    """The lines (doc, mark, line_no) that repeat an earlier one: within the bound from
    ``min_words`` words, word for word from ``exact_words`` (None: ``min_words``)."""
    kept = session.materialised
    place = F.struct(*PLACE)
    least = min_words if exact_words is None else min(min_words, exact_words)
    named = kept(named_lines(texts, least, min_words), "named")
    distinct = named.groupBy("h0", "h1").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    distinct = kept(distinct, "lines")
    exact = (
        named.select(*PLACE, "h0", "h1")
        .join(distinct.filter("first < last").select("h0", "h1", "first"), ["h0", "h1"])
        .filter(place > F.col("first"))
        .select(*PLACE)
    )
    # Lines with a half that another line has, too; halves are told apart by distinct lines.
    halves = named.select("h0", F.explode("halves").alias("half"))
    shared = (
        halves.groupBy("half").agg(F.min("h0").alias("a"), F.max("h0").alias("b")).filter("a < b").select("half")
    )
    near = halves.join(kept(shared, "halves"), "half").select("h0").distinct()
    todo = (
        distinct.join(near, "h0")
        .groupBy(F.col("first.doc").alias("doc"), F.col("first.mark").alias("mark"))
        .agg(F.collect_set("first.line_no").alias("nos"))
    )
    candidates = (
        texts.join(todo, KEY)
        .select(*KEY, lines_of(F.col("text")).alias("lines"), "nos")
        .select(*KEY, F.explode(F.array_distinct("nos")).alias("line_no"), "lines")
        .select(*PLACE, words_of(F.element_at("lines", F.col("line_no") + 1)).alias("words"))
        .dropDuplicates(PLACE)
    )
    candidates = kept(candidates, "candidates")
    variants = _variants(candidates)
    common = kept(variants.groupBy("variant").count().filter("count > 1").select("variant"), "common")
    pairs = _earliest(kept(variants.join(common, "variant"), "variants"))
    return kept(exact.unionByName(_verified(pairs, candidates)).distinct(), "removed")


def _variants(lines: DataFrame) -> DataFrame:
    """(variant, left_out, doc, mark, line_no): each line whole (0) and without its i-th word.

    The hash of a sequence is the XOR of hashes of its (word, position) pairs, so running XORs
    from both ends give that of a line without any one word.
    """
    words = lines.select(*PLACE, F.posexplode("words").alias("i", "word"))
    hashed = words.select(
        *PLACE, "i", F.xxhash64("word", "i").alias("here"), F.xxhash64("word", F.col("i") - 1).alias("moved")
    )
    line = Window.partitionBy(*PLACE)
    upto = line.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = hashed.select(
        *PLACE,
        "i",
        "here",
        F.bit_xor("here").over(upto).alias("upto"),
        F.bit_xor("moved").over(upto).alias("moved_upto"),
        F.bit_xor("here").over(line).alias("all"),
        F.bit_xor("moved").over(line).alias("moved_all"),
    )
    without = (
        F.col("upto").bitwiseXOR(F.col("here")).bitwiseXOR(F.col("moved_all")).bitwiseXOR(F.col("moved_upto"))
    )
    whole = F.struct(F.col("all").alias("variant"), F.lit(0).alias("left_out"))
    one = F.struct(without.alias("variant"), (F.col("i") + 1).alias("left_out"))
    rows = F.when(F.col("i") == 0, F.array(whole, one)).otherwise(F.array(one))
    return running.select(*PLACE, F.inline(rows))


def _earliest(variants: DataFrame) -> DataFrame:
    """Lines with the earliest line of a shared variant: place, left_out, other, other_out."""
    place = F.struct(*PLACE)
    best = F.struct(F.struct(*PLACE).alias("other"), F.col("left_out").alias("other_out"))
    replaced = (
        variants.filter("left_out > 0")
        .groupBy("variant", "left_out")
        .agg(F.min(best).alias("best"))
    )
    replaced = session.materialised(replaced, "replaced")
    # A whole line matches others without a word, and the other way round.
    inserted = (
        variants.groupBy("variant", (F.col("left_out") == 0).alias("whole"))
        .agg(F.min(best).alias("best"))
        .select("variant", "best", (~F.col("whole")).alias("want_whole"))
    )
    inserted = session.materialised(inserted, "inserted")
    same = variants.join(replaced, ["variant", "left_out"])
    other = variants.withColumn("want_whole", F.col("left_out") == 0).join(inserted, ["variant", "want_whole"])
    both = same.unionByName(other.drop("want_whole"))
    return both.filter(place > F.col("best.other")).select(*PLACE, "left_out", "best.other", "best.other_out")


def _verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """The lines of ``pairs`` whose words equal the other's after leaving out the two places."""

    def without(words: Column, place: Column) -> Column:
        rest = F.concat(F.slice(words, F.lit(1), place - 1), F.slice(words, place + 1, F.size(words)))
        return F.when(place == 0, words).otherwise(rest)

    others = lines.select(F.struct(*PLACE).alias("other"), F.col("words").alias("other_words"))
    found = pairs.join(lines, PLACE).join(others, "other")
    equal = without(F.col("words"), F.greatest(F.col("left_out"), F.lit(0))) == without(
        F.col("other_words"), F.greatest(F.col("other_out"), F.lit(0))
    )
    return found.filter(equal).select(*PLACE)


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, exact_words: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``text`` less its repeated lines, and n_lines,
    n_removed and removed_lines (their positions, from 0); these replace columns of the name.
    ``min_words`` and ``exact_words`` as in ``earlier_lines``."""
    texts = keyed(docs)
    gone = earlier_lines(texts, min_words, exact_words).groupBy(*KEY).agg(F.sort_array(F.collect_list("line_no")).alias("gone"))
    new = ("n_lines", "n_removed", "removed_lines")
    kept = [c for c in docs.columns if c not in new]
    rows = docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("_doc"),
        F.xxhash64("text").alias("_mark"),
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"),
    )
    renamed = gone.select(F.col("doc").alias("_doc"), F.col("mark").alias("_mark"), "gone")
    lines = rows.join(renamed, ["_doc", "_mark"], "left").select(
        "_row", F.coalesce("gone", F.array().cast("array<int>")).alias("_gone"), F.split("_row.text", "\n").alias("_lines")
    )
    n = F.coalesce(F.size("_lines"), F.lit(0))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    text = F.array_join(F.transform(left, lambda i: F.element_at("_lines", i + 1)), "\n")
    whole = F.size("_gone") == 0
    return lines.select(
        *[
            F.when(whole, F.col("_row.text")).otherwise(text).alias(c) if c == "text" else F.col(f"_row.`{c}`")
            for c in kept
        ],
        F.when(F.col("_lines").isNull(), 0).otherwise(n).cast("long").alias("n_lines"),
        F.size("_gone").cast("long").alias("n_removed"),
        F.col("_gone").alias("removed_lines"),
    )


@query("op10_line_dedup", OP10_SQL)
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their lines counted and digests of what is left."""
    found = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
