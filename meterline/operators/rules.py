"""Row-quality rules: independent counters over all rows, one filter, one pass.

A rule is a boolean SQL expression over the columns of the frame it is applied to.
NULL is a failure. ``warn`` rules only count; ``drop`` rules also remove the row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from meterline.contract import RESCUED_COLUMN, TableContract

WARN = "warn"
DROP = "drop"
ROWS_METRIC = "rows"


@dataclass(frozen=True)
class Rule:
    name: str
    expr: str
    severity: str = WARN

    def __post_init__(self) -> None:
        if self.severity not in (WARN, DROP):
            raise ValueError(f"rule {self.name!r}: unknown severity {self.severity!r}")
        if self.name == ROWS_METRIC:
            raise ValueError(f"rule name {ROWS_METRIC!r} is taken by the row counter")

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.expr), F.lit(False))

    def failed(self) -> Column:
        return ~self.passed()


def expect(name: str, expr: str) -> tuple[Rule, ...]:
    return (Rule(name, expr, WARN),)


def expect_all(rules: Mapping[str, str]) -> tuple[Rule, ...]:
    return tuple(Rule(name, expr, WARN) for name, expr in rules.items())


def expect_all_or_drop(rules: Mapping[str, str]) -> tuple[Rule, ...]:
    return tuple(Rule(name, expr, DROP) for name, expr in rules.items())


# The rules of the trip tables.
TRIP_DROP_RULES = expect_all_or_drop(
    {
        "total_amount_non_negative": "total_amount >= 0",
        "trip_timestamps_not_null": (
            "tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL"
        ),
        "dropoff_after_pickup": "tpep_dropoff_datetime >= tpep_pickup_datetime",
    }
)
TRIP_WARN_RULES = expect_all(
    {
        "passenger_count_in_range": "passenger_count BETWEEN 0 AND 9",
        "vendor_id_in_dictionary": "vendor_id IN (1, 2, 6, 7)",
        "pickup_month_matches_file": "pickup_year_month = file_year_month",
    }
)
TRIP_RULES = TRIP_DROP_RULES + TRIP_WARN_RULES

CAST_LOSS_RULE = expect("no_cast_loss", "NOT _cast_loss")


def raw_rules(contract: TableContract) -> tuple[Rule, ...]:
    """Warn rules of the raw table: required columns filled, nothing rescued."""
    filled = " AND ".join(f"`{c}` IS NOT NULL" for c in contract.required_columns) or "true"
    return expect("bronze_required_columns_not_null", filled) + expect(
        "bronze_no_rescued_data", f"{RESCUED_COLUMN} IS NULL"
    )


def observe_rules(df: DataFrame, rules: Iterable[Rule], observation: Observation) -> DataFrame:
    """Attach the counters to ``df``; the first action that runs it fills ``observation``.

    Counters are exact under task retries as long as the observed frame is part of the
    stage that writes the result, so put any shuffle before this call, not after it.
    """
    counters = [F.count(F.lit(1)).alias(ROWS_METRIC)]
    counters += [F.count_if(r.failed()).alias(r.name) for r in rules]
    return df.observe(observation, *counters)


def drop_failing(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Rows that pass every drop rule."""
    drops = [r.passed() for r in rules if r.severity == DROP]
    return df.filter(reduce(lambda a, b: a & b, drops)) if drops else df


def reasons(rules: Iterable[Rule]) -> Column:
    """Names of the drop rules that a row fails, in their order; empty for rows that stay."""
    named = [F.when(r.failed(), F.lit(r.name)) for r in rules if r.severity == DROP]
    if not named:
        return F.array().cast("array<string>")
    return F.filter(F.array(*named), lambda name: name.isNotNull())


def apply_rules(
    df: DataFrame, rules: Iterable[Rule], observation: Observation | None = None
) -> DataFrame:
    """Count every rule on every row, then drop; both in the pass that writes the result."""
    rules = tuple(rules)
    if observation is not None:
        df = observe_rules(df, rules, observation)
    return drop_failing(df, rules)


def rule_metrics(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """``(rule, severity, passed_records, failed_records)`` by one aggregate over ``df``."""
    rules = tuple(rules)
    counts = df.agg(
        F.count(F.lit(1)).alias(ROWS_METRIC),
        *[F.count_if(r.failed()).alias(r.name) for r in rules],
    )
    return counts.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(r.name).alias("rule"),
                        F.lit(r.severity).alias("severity"),
                        (F.col(ROWS_METRIC) - F.col(r.name)).alias("passed_records"),
                        F.col(r.name).alias("failed_records"),
                    )
                    for r in rules
                ]
            )
        ).alias("m")
    ).select("m.*")


def observed_metrics(rules: Iterable[Rule], counts: Mapping[str, int]) -> list[dict]:
    """The filled counters of :func:`observe_rules` as event details."""
    rows = int(counts.get(ROWS_METRIC) or 0)
    return [
        {
            "name": r.name,
            "severity": r.severity,
            "passed_records": rows - int(counts.get(r.name) or 0),
            "failed_records": int(counts.get(r.name) or 0),
        }
        for r in rules
    ]
