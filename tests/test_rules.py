from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from meterline.contract import TRIPS
from meterline.lake import rebalance
from meterline.operators import rules
from meterline.plans.given import silver_trips


def counts(df, rule_set):
    return {r["rule"]: r["failed_records"] for r in rules.rule_metrics(df, rule_set).collect()}


def test_null_is_a_failure_and_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(0,), (9,), (10,), (-1,), (None,)], "x int")
    assert counts(df, rules.expect("r", "x BETWEEN 0 AND 9")) == {"r": 3}


def test_rules_count_independently_and_drop_together(spark):
    df = spark.createDataFrame([(1, 1), (-1, 1), (-1, -1), (1, None)], "a int, b int")
    rule_set = rules.expect_all_or_drop({"a": "a >= 0", "b": "b >= 0"}) + rules.expect("w", "a = b")
    assert counts(df, rule_set) == {"a": 2, "b": 2, "w": 2}
    assert [tuple(r) for r in rules.drop_failing(df, rule_set).collect()] == [(1, 1)]


def test_warn_rules_keep_rows(spark):
    df = spark.range(5)
    assert rules.apply_rules(df, rules.expect("never", "id < 0")).count() == 5


def test_observed_counters_cover_dropped_rows(spark):
    rule_set = rules.expect_all_or_drop({"even": "id % 2 = 0"}) + rules.expect("small", "id < 3")
    seen = Observation()
    kept = rules.apply_rules(spark.range(10), rule_set, seen)
    kept.write.format("noop").mode("overwrite").save()
    assert kept.count() == 5
    assert rules.observed_metrics(rule_set, seen.get) == [
        {"name": "even", "severity": "drop", "passed_records": 5, "failed_records": 5},
        {"name": "small", "severity": "warn", "passed_records": 3, "failed_records": 7},
    ]


def test_observation_of_an_empty_frame_is_zero(spark):
    seen = Observation()
    rules.apply_rules(spark.range(0), rules.expect("r", "id > 0"), seen).write.format(
        "noop"
    ).mode("overwrite").save()
    assert rules.observed_metrics(rules.expect("r", "id > 0"), seen.get) == [
        {"name": "r", "severity": "warn", "passed_records": 0, "failed_records": 0}
    ]


def test_filter_stays_above_the_counters(spark):
    rule_set = rules.expect_all_or_drop({"even": "id % 2 = 0"})
    plan = rules.apply_rules(spark.range(10), rule_set, Observation())._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    assert text.index("Filter") < text.index("CollectMetrics")


def test_counters_sit_in_the_stage_that_writes(spark):
    """The shuffle comes first, so retried map tasks cannot count a row twice."""
    rows = rebalance(spark.range(10), "id")
    rule_set = rules.expect_all_or_drop({"even": "id % 2 = 0"})
    plan = rules.apply_rules(rows, rule_set, Observation())._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    assert text.index("CollectMetrics") < text.index("RebalancePartitions")


def test_unknown_severity_and_reserved_name_are_refused():
    with pytest.raises(ValueError, match="severity"):
        rules.Rule("r", "true", "fail")
    with pytest.raises(ValueError, match="taken"):
        rules.Rule("rows", "true")


def test_raw_rules_follow_the_required_columns(spark):
    required, rescued = rules.raw_rules(TRIPS)
    for column in TRIPS.required_columns:
        assert f"`{column}` IS NOT NULL" in required.expr
    assert rescued.expr == "_rescued_data IS NULL"


def test_known_trip_failures(spark):
    """Counts known for these tables at the scale they were published for."""
    silver = silver_trips(spark, "/root/testdata/sf0.01")
    got = counts(silver, rules.TRIP_RULES)
    assert got["passenger_count_in_range"] == 6219
    assert got["dropoff_after_pickup"] == 29497
    assert got["total_amount_non_negative"] == 594
    assert got["trip_timestamps_not_null"] == 584
    assert got["pickup_month_matches_file"] == 1173
    assert got["vendor_id_in_dictionary"] == 25567
    assert rules.drop_failing(silver, rules.TRIP_RULES).count() == 30230


def test_zero_amount_and_equal_times_are_kept(spark):
    df = spark.range(1).select(
        F.lit(0).cast("decimal(10,2)").alias("total_amount"),
        F.lit("2023-01-01").cast("timestamp").alias("tpep_pickup_datetime"),
        F.lit("2023-01-01").cast("timestamp").alias("tpep_dropoff_datetime"),
    )
    assert rules.drop_failing(df, rules.TRIP_DROP_RULES).count() == 1
