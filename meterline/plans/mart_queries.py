"""Marts over trip rows: monthly and hourly means, flows, the active window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.months import year_month
from meterline.operators import marts, runs
from meterline.plans.given import (
    ACTIVE_SQL,
    LOCATIONS_SQL,
    RUNS_SQL,
    TRIPS_SQL,
    customer_runs,
    mean_sql,
    nation_locations,
    silver_trips,
    table,
)
from meterline.plans.registry import plain, query


@query(
    "monthly_avg_amount",
    f"""
    WITH t AS (SELECT strftime(o_orderdate, '%Y-%m') AS pickup_year_month,
                      CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount FROM orders)
    SELECT pickup_year_month, {mean_sql("total_amount")} AS avg_total_amount,
           count(*) AS trip_count
    FROM t GROUP BY 1 ORDER BY 1
    """,
)
def monthly_avg_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = table(spark, sf_dir, "orders").select(
        year_month("o_orderdate").alias("pickup_year_month"),
        F.col("o_totalprice").try_cast("decimal(10,2)").alias("total_amount"),
    )
    return plain(marts.monthly_avg_total_amount(trips))


@query(
    "hourly_avg_quantity_month",
    f"""
    WITH {TRIPS_SQL}
    SELECT CAST(hour(pickup_at) AS INT) AS pickup_hour,
           CAST(sum(passenger_count) AS DOUBLE) / count(passenger_count) AS avg_passenger_count,
           count(passenger_count) AS trip_count_with_passenger
    FROM trips
    WHERE pickup_year_month = '1997-03' AND passenger_count IS NOT NULL
    GROUP BY 1 ORDER BY 1
    """,
)
def hourly_avg_quantity_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = marts.trip_projection(silver_trips(spark, sf_dir))
    return marts.hourly_avg_passenger_count(trips, "1997-03")


FLOWS_SELECT = f"""
    SELECT pu.borough AS pickup_borough, dr.borough AS dropoff_borough,
           count(*) AS trip_count, {mean_sql("total_amount")} AS avg_total_amount
    FROM %s AS t
    LEFT JOIN dim AS pu ON t.pu_location_id = pu.location_id
    LEFT JOIN dim AS dr ON t.do_location_id = dr.location_id
    GROUP BY 1, 2 ORDER BY trip_count DESC
"""


@query("flow_matrix", f"WITH {TRIPS_SQL}, {LOCATIONS_SQL} {FLOWS_SELECT % 'trips'}")
def flow_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = marts.trip_projection(silver_trips(spark, sf_dir))
    return plain(marts.flow_matrix(trips, nation_locations(spark, sf_dir)))


@query(
    "zone_flow_matrix",
    f"""
    WITH {TRIPS_SQL},
    dim AS (SELECT n_nationkey AS location_id, n_name AS borough FROM nation
            WHERE n_nationkey < 23)
    {FLOWS_SELECT % 'trips'}
    """,
)
def zone_flow_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows at the grain of single nations: 24 x 24 groups with the NULL buckets."""
    trips = marts.trip_projection(silver_trips(spark, sf_dir))
    dim = nation_locations(spark, sf_dir).withColumn("borough", F.col("zone"))
    return plain(marts.flow_matrix(trips, dim))


@query(
    "latest_complete_run",
    f"""
    WITH {RUNS_SQL}
    SELECT run_id, pipeline_update_id, job_start_ts, start_year_month, end_year_month
    FROM runs WHERE pipeline_update_id IS NOT NULL
    ORDER BY job_start_ts DESC, run_id DESC LIMIT 1
    """,
)
def latest_complete_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.latest_complete_run(customer_runs(spark, sf_dir))
    return plain(
        found.select(
            "run_id", "pipeline_update_id", "job_start_ts", "start_year_month", "end_year_month"
        )
    )


@query(
    "first_run_guard",
    f"WITH {RUNS_SQL} SELECT count(*) AS n FROM runs WHERE pipeline_update_id IS NOT NULL",
)
def first_run_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.count_complete_runs(customer_runs(spark, sf_dir))


@query(
    "consumption_window",
    f"""
    WITH {TRIPS_SQL}, {RUNS_SQL}, {LOCATIONS_SQL}, {ACTIVE_SQL}
    SELECT vendor_id, passenger_count, CAST(total_amount AS DOUBLE) AS total_amount,
           pickup_at, dropoff_at, pickup_year_month,
           CAST(hour(pickup_at) AS INT) AS pickup_hour,
           pu_location_id AS pickup_location_id, do_location_id AS dropoff_location_id,
           pu.borough AS pickup_borough, pu.zone AS pickup_zone,
           dr.borough AS dropoff_borough, dr.zone AS dropoff_zone
    FROM in_window AS t
    LEFT JOIN dim AS pu ON t.pu_location_id = pu.location_id
    LEFT JOIN dim AS dr ON t.do_location_id = dr.location_id
    """,
)
def consumption_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = silver_trips(spark, sf_dir)
    trips = marts.trips_in_window(silver, customer_runs(spark, sf_dir))
    rows = marts.consumption(trips, nation_locations(spark, sf_dir))
    return plain(rows)


@query(
    "window_monthly_avg",
    f"""
    WITH {TRIPS_SQL}, {RUNS_SQL}, {ACTIVE_SQL}
    SELECT pickup_year_month, {mean_sql("total_amount")} AS avg_total_amount,
           count(*) AS trip_count
    FROM in_window GROUP BY 1 ORDER BY 1
    """,
)
def window_monthly_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = marts.trips_in_window(silver_trips(spark, sf_dir), customer_runs(spark, sf_dir))
    return plain(marts.monthly_avg_total_amount(trips))


@query(
    "drop_vs_keep_misdated",
    f"""
    WITH {TRIPS_SQL}, {RUNS_SQL}, {ACTIVE_SQL}
    SELECT pickup_year_month = file_year_month AS month_matches_file,
           pickup_year_month BETWEEN first_month AND last_month AS in_active_window,
           count(*) AS trip_count
    FROM trips, active GROUP BY 1, 2
    """,
)
def drop_vs_keep_misdated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late and misdated rows stay; only the window decides whether a mart shows them."""
    inside = F.col("pickup_year_month").between(
        *marts.active_window(customer_runs(spark, sf_dir))
    )
    counted = (
        silver_trips(spark, sf_dir)
        .groupBy("pickup_year_month", "file_year_month")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.groupBy(
        (F.col("pickup_year_month") == F.col("file_year_month")).alias("month_matches_file"),
        inside.alias("in_active_window"),
    ).agg(F.sum("n").alias("trip_count"))
