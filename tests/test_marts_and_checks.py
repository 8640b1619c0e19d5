from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterline.operators import checks, marts
from meterline.plans.given import customer_runs, nation_locations, silver_trips, table

TRIP_DDL = (
    "pickup_year_month string, pickup_hour int, total_amount decimal(10,2), passenger_count bigint, "
    "pickup_location_id bigint, dropoff_location_id bigint"
)
DIM_DDL = "location_id int, borough string, zone string, service_zone string"


@pytest.fixture()
def dim(spark):
    return spark.createDataFrame(
        [(1, "Queens", "Astoria", "Boro"), (2, "N/A", "Unknown", "N/A")], DIM_DDL
    )


@pytest.fixture()
def trips(spark):
    rows = [
        ("2023-01", 3, Decimal("10.00"), 1, 1, 2),
        ("2023-01", 3, Decimal("10.01"), None, 1, 2),
        ("2023-01", 4, Decimal("0.00"), 2, None, 99),
        ("2023-02", 3, None, 4, 1, 1),
    ]
    return spark.createDataFrame(rows, TRIP_DDL)


def test_monthly_mean_is_trip_weighted_and_counts_all_rows(trips):
    got = [tuple(r) for r in marts.monthly_avg_total_amount(trips).collect()]
    assert got == [("2023-01", Decimal("6.670000"), 3), ("2023-02", None, 1)]


def test_hourly_mean_and_its_denominator_skip_nulls(trips):
    got = [tuple(r) for r in marts.hourly_avg_passenger_count(trips, "2023-01").collect()]
    assert got == [(3, 1.0, 1), (4, 2.0, 1)]


def test_unknown_and_null_locations_keep_the_trip(trips, dim):
    rows = marts.consumption(trips, dim).collect()
    assert len(rows) == 4
    lost = [r for r in rows if r["pickup_location_id"] is None][0]
    assert lost["pickup_borough"] is None and lost["dropoff_zone"] is None
    assert {r["dropoff_borough"] for r in rows} == {"N/A", None, "Queens"}


def test_flow_matrix_keeps_null_buckets(trips, dim):
    got = {(r[0], r[1]): (r[2], r[3]) for r in marts.flow_matrix(trips, dim).collect()}
    assert got == {
        ("Queens", "N/A"): (2, Decimal("10.005000")),
        (None, None): (1, Decimal("0.000000")),
        ("Queens", "Queens"): (1, None),
    }


def test_flow_matrix_equals_the_plain_aggregation(spark, sf_dir):
    silver = silver_trips(spark, sf_dir)
    trips = marts.trip_projection(silver)
    dim = nation_locations(spark, sf_dir)
    plain = (
        marts.consumption(trips, dim)
        .groupBy("pickup_borough", "dropoff_borough")
        .agg(F.count(F.lit(1)).alias("trip_count"), F.avg("total_amount").alias("avg_total_amount"))
    )
    ours = marts.flow_matrix(trips, dim)
    assert ours.dtypes == plain.dtypes
    assert sorted(map(repr, ours.collect())) == sorted(map(repr, plain.collect()))


def test_mean_has_the_type_and_rounding_of_avg(spark):
    rows = [(i % 7, Decimal(i * 37 % 1001) / 100) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, v decimal(10,2)")
    both = df.groupBy("k").agg(
        F.avg("v").alias("a"), F.expr(marts.decimal_mean("sum(v)", "count(v)")).alias("b")
    )
    assert all(r["a"] == r["b"] for r in both.collect())


def test_dimension_is_broadcast_only_when_proven_small(spark, trips, dim):
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    small = trips.join(marts.small_side(dim), F.col("pickup_location_id") == F.col("location_id"))
    assert "strategy=broadcast" in plan(small)
    large = trips.join(
        marts.small_side(dim, max_bytes=1), F.col("pickup_location_id") == F.col("location_id")
    )
    assert "strategy=broadcast" not in plan(large)


def test_measured_size_grows_with_rows_and_text(spark, dim):
    assert marts.measured_bytes(dim.limit(0)) == 0
    assert marts.measured_bytes(dim) == 2 * marts.ROW_BYTES + len("QueensAstoriaBoroN/AUnknownN/A")


def test_window_is_one_subquery(spark, sf_dir):
    silver = silver_trips(spark, sf_dir)
    plan = marts.in_active_window(silver, customer_runs(spark, sf_dir))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("GlobalLimit 1") == 2  # both bounds name the same subquery


def result(df):
    return [tuple(r) for r in df.collect()]


def test_column_checks(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (9, None)], "v int, s string")
    got = result(checks.column_checks(df, "t", ["v", "s"], {"v": (1, 2, 6, 7)}))
    assert got == [
        ("not_null", "t", "v", "error", 1),
        ("not_null", "t", "s", "error", 1),
        ("accepted_values", "t", "v", "error", 1),
    ]


def test_column_checks_read_the_table_once(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    df = checks.column_checks(orders, "orders", ["o_orderkey", "o_custkey"], {"o_orderstatus": "FOP"})
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1
    assert "o_orderpriority" not in text


def test_unique_and_relationships_ignore_nulls(spark, dim):
    df = spark.createDataFrame([(1,), (1,), (7,), (7,), (8,), (None,), (None,)], "k bigint")
    assert result(checks.unique_check(df, "t", "k"))[0][-1] == 2
    assert result(checks.relationships_check(df, "t", "k", dim, "location_id"))[0][-1] == 3
    assert sorted(result(checks.orphan_keys(df, "k", dim, "location_id"))) == [(7, 2), (8, 1)]


@pytest.mark.parametrize(
    ("now", "failures"),
    [("2026-01-02 00:00:00", 0), ("2026-01-02 00:00:01", 1)],
)
def test_freshness_limit(spark, now, failures):
    df = spark.sql("SELECT TIMESTAMP'2026-01-01 00:00:00' AS ts UNION ALL SELECT NULL")
    got = result(checks.freshness_check(df, "t", "ts", F.lit(now).cast("timestamp")))
    assert got == [("freshness", "t", "ts", "warn", failures)]


def test_freshness_of_an_empty_table_warns(spark):
    df = spark.sql("SELECT TIMESTAMP'2026-01-01' AS ts").limit(0)
    assert result(checks.freshness_check(df, "t", "ts"))[0][-1] == 1


def test_enforce_raises_on_errors_only(spark):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    old = spark.sql("SELECT TIMESTAMP'2020-01-01' AS ts")
    warned = checks.summarize(
        [checks.column_checks(df.na.drop(), "t", ["v"]), checks.freshness_check(old, "t", "ts")]
    )
    assert [r["status"] for r in checks.enforce(warned)] == ["pass", "warn"]
    with pytest.raises(checks.DataTestError, match=r"not_null\(t.v\): 1 failing"):
        checks.enforce(checks.summarize([checks.column_checks(df, "t", ["v"])]))
