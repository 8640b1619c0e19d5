"""Operator 9: quality score by a sparse rule ensemble over text statistics.

Statistics are Spark columns. A random forest of shallow trees (pyspark.ml) is fitted on
labelled documents, every tree path becomes a conjunctive rule (``statistic <= bound`` or
``> bound``), a logistic regression with an L1 penalty weighs the rules, and the rules with a
weight are compiled into one Spark column. Scoring is thus a projection of the scan: no
shuffle, no Python, no model object on the executors.

The fit uses the labelled documents with the ``max_rows`` smallest hashes of doc_id (a bounded
sample; scoring covers every document). Rows with crc32(doc_id) mod 5 = 0 are held out.

Nulls and edge cases: a null text counts as empty; labels that are null are not learnt from;
without labels of both classes the score is the same for all documents (their share of label 1,
0.5 without labels); rows with a null doc_id are scored and not held out; several labels of a
document all count; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.registry import query, table

MAX_ROWS = 20_000
THRESHOLD = 0.3
TREES, DEPTH, PENALTY = 24, 3, 0.002

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = "0123456789"
_MARKS = "!#$%&*+=<>@^_|~{}[]\\"


def _without(text: Column, letters: str) -> Column:
    """Code points of ``text`` that are among ``letters``."""
    return F.length(text) - F.length(F.translate(text, letters, ""))


def _parts(text: Column) -> list[Column]:
    """The text, its words and its lines, as columns of their own: each is computed once."""
    text = F.coalesce(text, F.lit(""))
    trimmed = F.btrim(text, F.lit(" \t\n\r\x0b\x0c"))
    words = F.split(trimmed, "[\\x20\\x09-\\x0D]+")  # one empty word if there is none
    return [text.alias("_text"), words.alias("_words"), F.split(text, "\n").alias("_lines")]


def statistics() -> dict[str, Column]:
    """Named statistics over the columns of ``_parts``; all are defined for the empty text."""
    text, words, lines = F.col("_text"), F.col("_words"), F.col("_lines")
    n_chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    n_words = F.size(words).cast("double")
    # Hashes, as distinct structs are found by comparing all with all.
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda x, y: F.xxhash64(x, y))
    return {
        "log_chars": F.log1p(F.length(text).cast("double")),
        "log_words": F.log1p(n_words),
        "word_length": n_chars / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "distinct_pairs": F.size(F.array_distinct(pairs)) / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
        "line_length": n_chars / F.size(lines),
        "upper": _without(text, _UPPER) / n_chars,
        "digits": _without(text, _DIGITS) / n_chars,
        "marks": _without(text, _MARKS) / n_chars,
        "marks_per_word": _without(text, _MARKS) / n_words,
        "stops": _without(text, ".") / n_words,
    }


STATISTICS = (
    "log_chars",
    "log_words",
    "word_length",
    "distinct_words",
    "distinct_pairs",
    "distinct_lines",
    "line_length",
    "upper",
    "digits",
    "marks",
    "marks_per_word",
    "stops",
)


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is_greater, bound)."""

    terms: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        parts = [F.col(s) > b if above else F.col(s) <= b for s, above, b in self.terms]
        return reduce(lambda x, y: x & y, parts)


def simplified(terms: Iterable[tuple[str, bool, float]]) -> Rule:
    """One bound per statistic and side: the tightest."""
    kept: dict[tuple[str, bool], float] = {}
    for name, above, bound in terms:
        old = kept.get((name, above), bound)
        kept[name, above] = max(old, bound) if above else min(old, bound)
    return Rule(tuple((n, a, b) for (n, a), b in sorted(kept.items())))


_STEP = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def rules_of(description: str, names: tuple[str, ...]) -> list[Rule]:
    """Every path of every tree from the root to a node, as rules without repetition.

    ``description`` is the forest's printed form: a line for each branch, indented by depth.
    """
    rules: dict[Rule, None] = {}
    path: list[tuple[int, tuple[str, bool, float]]] = []
    for line in description.splitlines():
        if line.lstrip().startswith("Tree "):
            path = []
        elif step := _STEP.match(line):
            depth = len(step[1])
            path = [x for x in path if x[0] < depth]
            path.append((depth, (names[int(step[3])], step[4] == ">", float(step[5]))))
            rules[simplified(t for _, t in path)] = None
    return list(rules)


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules and the score without any."""

    intercept: float
    weighted: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """Probability of label 1, over columns named like the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.weighted:
            total = total + F.when(rule.column(), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _log_odds(share: float) -> float:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return math.log(share / (1 - share))


def held_out(doc_id: Column) -> Column:
    """The remainder of crc32 of the id as text is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> RuleEnsemble:
    """Fit on documents (doc_id, text) with labels (doc_id, quality) that are not held out."""
    sample = (
        labels.select("doc_id", F.col("quality").cast("double").alias("label"))
        .filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(max_rows)
    )
    # At most max_rows ids and labels are broadcast.
    seen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    parts = seen.select("label", "doc_id", *_parts(F.col("text")))
    rows = parts.select("label", "doc_id", *[c.alias(n) for n, c in statistics().items()])
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(rows)
    train = vectors.select("label", "doc_id", *STATISTICS, "features").cache()
    try:
        found = train.agg(F.count(F.lit(1)), F.avg("label")).first()
        share = 0.5 if not found[0] else float(found[1])
        if share in (0.0, 1.0) or not found[0]:
            return RuleEnsemble(_log_odds(share), ())
        forest = RandomForestClassifier(
            numTrees=TREES, maxDepth=DEPTH, maxBins=64, seed=1, featureSubsetStrategy="onethird"
        ).fit(train)
        rules = rules_of(forest.toDebugString, STATISTICS)
        if not rules:
            return RuleEnsemble(_log_odds(share), ())
        hits = F.array(*[F.when(r.column(), 1.0).otherwise(0.0) for r in rules])
        fired = train.select("label", array_to_vector(hits).alias("features"))
        model = LogisticRegression(
            elasticNetParam=1.0, regParam=PENALTY, standardization=False, maxIter=60
        ).fit(fired)
        weights = [(r, float(w)) for r, w in zip(rules, model.coefficients, strict=True) if w]
        return RuleEnsemble(float(model.intercept), tuple(weights))
    finally:
        train.unpersist()


def score(docs: DataFrame, model: RuleEnsemble, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score and predicted; statistics replace no column of the same name."""
    parts = docs.select(F.struct("*").alias("_row"), *_parts(F.col("text")))
    with_stats = parts.select("_row", *[c.alias(n) for n, c in statistics().items()])
    scored = with_stats.select("_row", model.score().alias("_score"))
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    return scored.select(
        *[F.col(f"_row.`{c}`") for c in kept],
        F.col("_score").alias("score"),
        F.when(F.col("_score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document with rules learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )
