"""One key holds a third of all rows: results stay whole and hot groups meet no single task."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from meterline.operators import checks, marts, runs

ROWS = 300_000


def hot():
    return F.col("id") % 3 == 0


@pytest.fixture(scope="module")
def trips(spark):
    return spark.range(0, ROWS, 1, 8).select(
        F.lit("2023-01").alias("pickup_year_month"),
        (F.col("id") % 24).cast("int").alias("pickup_hour"),
        (F.col("id") % 1000 / 10).cast("decimal(10,2)").alias("total_amount"),
        F.when(hot(), 1).otherwise(F.col("id") % 5000).cast("long").alias("pickup_location_id"),
        F.when(hot(), None).otherwise(F.col("id") % 7).cast("long").alias("dropoff_location_id"),
    )


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(0, 4000).select(
        F.col("id").cast("int").alias("location_id"),
        F.concat(F.lit("B"), F.col("id") % 5).alias("borough"),
        F.concat(F.lit("Z"), F.col("id")).alias("zone"),
    )


def test_flows_count_every_trip(trips, dim):
    flows = marts.flow_matrix(trips, dim).collect()
    assert sum(r["trip_count"] for r in flows) == ROWS
    assert max(r["trip_count"] for r in flows) >= ROWS // 3


@pytest.mark.parametrize("limit", [1_000_000, 10])
def test_consumption_keeps_every_trip_broadcast_or_not(trips, dim, limit, monkeypatch, spark):
    monkeypatch.setattr(marts, "small_side", lambda d: marts.F.broadcast(d) if limit > 10 else d)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert marts.consumption(trips, dim).count() == ROWS
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pairs_are_counted_before_they_are_joined(trips, dim):
    text = marts.flow_matrix(trips, dim)._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in text.splitlines() if "Aggregate" in line or "Join" in line]
    kinds = ["A" if "Aggregate" in line else "J" for line in lines]
    assert kinds == ["A", "J", "J", "A"]


def test_orphans_of_a_hot_key(trips, dim):
    found = checks.orphan_keys(trips, "pickup_location_id", dim, "location_id")
    expected = trips.where("pickup_location_id >= 4000").count()
    assert found.agg(F.sum("n")).first()[0] == expected
    pairs = marts.location_pairs(trips)
    weighted = checks.orphan_keys(
        pairs, "pickup_location_id", dim, "location_id", weight="trips"
    )
    assert sorted(map(tuple, weighted.collect())) == sorted(map(tuple, found.collect()))


def test_a_hot_run_collapses_to_its_months(spark):
    t0 = datetime(2026, 1, 1)
    run_rows = spark.range(0, 1000).select(
        F.concat(F.lit("r"), F.col("id")).alias("run_id"),
        F.lit("j").alias("job_run_id"),
        F.lit("u").alias("job_url"),
        F.lit(t0).cast("timestamp").alias("job_start_ts"),
        F.lit(t0).cast("timestamp").alias("job_end_ts"),
        F.lit("HTTP").alias("source_mode"),
        F.lit("2023-01").alias("start_year_month"),
        F.lit("2023-12").alias("end_year_month"),
    )
    outcomes = spark.range(0, ROWS, 1, 8).select(
        F.concat(F.lit("r"), F.when(hot(), 0).otherwise(F.col("id") % 1000)).alias("run_id"),
        F.col("id").alias("seq"),
        F.concat(F.lit("2023-"), F.lpad((F.floor(F.col("id") / 3) % 12 + 1).cast("string"), 2, "0")).alias(
            "month"
        ),
        F.lit("DOWNLOADED").alias("status"),
        F.lit(1).cast("long").alias("bytes_downloaded"),
        F.lit(2).cast("long").alias("bytes_in_volume"),
        F.lit("OK").alias("probe_status"),
        F.lit(200).alias("http_code"),
    )
    collapsed = runs.collapse_runs(run_rows, outcomes)
    rows = collapsed.collect()
    assert len(rows) == 1000
    big = [r for r in rows if r["run_id"] == "r0"][0]
    assert len(big["months_downloaded"]) == 12 and big["bytes_total_in_volume"] == 24
    assert max(len(r["probe_results"]) for r in rows) <= 12
