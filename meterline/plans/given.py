"""Trip-shaped rows, run records and dimensions derived from the given tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.contract import RESCUED_COLUMN, TRIPS
from meterline.functions.months import year_month
from meterline.operators.conform import conform


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hours(n: Column) -> Column:
    zero = F.lit(0)
    return F.make_interval(zero, zero, zero, zero, n.cast("int"), zero, zero)


def trip_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the given tables that ``raw_trips`` are made of, and their file's month:
    one row per lineitem of a known customer and supplier.

    Customers are joined to the orders, not to the lineitems.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey")
    # Once per order, of which there are fewer than lineitems.
    file_month = F.when(F.col("o_orderkey") % 50 == 0, F.lit("1999-01")).otherwise(
        year_month("o_orderdate")
    )
    orders = orders.withColumn("file_month", file_month)
    rows = (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )

    lines = ("orderkey", "partkey", "suppkey", "linenumber", "quantity", "extendedprice")
    lines += ("discount", "tax", "returnflag", "shipdate")
    return rows.select(
        *[f"l_{c}" for c in lines], "o_orderdate", "c_nationkey", "s_nationkey", "file_month"
    )


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw trip per lineitem of a known customer and supplier, under the source names
    and January types."""
    return as_raw_trips(trip_sources(spark, sf_dir))


def as_raw_trips(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw trips of ``trip_sources``, row by row, with the columns in ``keep``.

    Pickup is the order date plus some hours, dropoff the ship date; some rows lack a
    passenger count or a dropoff, have a negative amount, or lie in the wrong month's
    file. Location ids are the nations of customer and supplier.
    """
    part = F.col("l_partkey")
    price = F.col("l_extendedprice")
    file_month = F.col("file_month")
    return rows.select(
        F.col("l_linenumber").cast("long").alias("VendorID"),
        (F.col("o_orderdate") + hours(part % 24)).alias("tpep_pickup_datetime"),
        F.when(part % 101 != 3, F.col("l_shipdate")).alias("tpep_dropoff_datetime"),
        F.when(part % 40 != 0, F.col("l_quantity").cast("long") % 11)
        .cast("double")
        .alias("passenger_count"),
        F.when(F.col("l_orderkey") % 100 == 7, -price).otherwise(price).alias("total_amount"),
        F.col("l_quantity").alias("trip_distance"),
        (F.col("l_suppkey") % 6 + 1).cast("double").alias("RatecodeID"),
        F.when(F.col("l_returnflag") == "R", "Y").otherwise("N").alias("store_and_fwd_flag"),
        F.col("c_nationkey").cast("long").alias("PULocationID"),
        F.col("s_nationkey").cast("long").alias("DOLocationID"),
        (F.col("l_orderkey") % 4 + 1).alias("payment_type"),
        price.alias("fare_amount"),
        F.col("l_discount").alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        F.col("l_tax").alias("tip_amount"),
        F.when(part % 97 == 0, F.lit(1e9)).otherwise(F.col("l_discount")).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        F.lit(2.5).alias("congestion_surcharge"),
        F.when(F.col("l_suppkey") % 10 == 0, F.lit(1.25)).otherwise(F.lit(0.0)).alias(
            "airport_fee"
        ),
        F.lit(None).cast("string").alias(RESCUED_COLUMN),
        F.concat(F.lit("/landing/yellow_tripdata_"), file_month, F.lit(".parquet")).alias(
            "_source_file_path"
        ),
        F.col("o_orderdate").cast("timestamp").alias("_source_file_modification_time"),
        F.col("l_shipdate").cast("timestamp").alias("_ingestion_ts"),
        *keep,
    )


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(raw_trips(spark, sf_dir), TRIPS)


def nation_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as the location dimension; ids 23 and 24 are left out, so they are unknown."""
    nation = table(spark, sf_dir, "nation").where("n_nationkey < 23")
    region = table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.lit("any").alias("service_zone"),
    )


def customer_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ingestion run per customer with orders.

    It asks for the months from the first order on; every third run never completed.
    """
    key = F.col("o_custkey")
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    )
    seconds = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (key % 86400).cast("decimal(18,6)"))
    return per_customer.select(
        key.alias("o_custkey"),
        F.concat(F.lit("r"), key).alias("run_id"),
        F.concat(F.lit("j"), key).alias("job_run_id"),
        F.concat(F.lit("job/"), key).alias("job_url"),
        F.when(key % 3 != 0, F.concat(F.lit("u"), key)).alias("pipeline_update_id"),
        (F.col("last") + seconds).cast("timestamp").alias("job_start_ts"),
        (F.col("last") + seconds + hours(F.lit(1))).cast("timestamp").alias("job_end_ts"),
        F.when(key % 4 == 0, "VOLUME_PREEXISTING").otherwise("HTTP").alias("source_mode"),
        year_month("first").alias("start_year_month"),
        year_month(F.add_months("first", (key % 30).cast("int"))).alias("end_year_month"),
    )


# The same rows in ANSI SQL: CTEs to be put before an oracle query.
TRIPS_SQL = """
trips AS (
  SELECT CAST(l_linenumber AS BIGINT) AS vendor_id,
         o_orderdate + to_hours(CAST(l_partkey % 24 AS INT)) AS pickup_at,
         CASE WHEN l_partkey % 101 <> 3 THEN l_shipdate END AS dropoff_at,
         CASE WHEN l_partkey % 40 <> 0 THEN CAST(trunc(l_quantity) AS BIGINT) % 11 END
           AS passenger_count,
         CAST(CASE WHEN l_orderkey % 100 = 7 THEN -l_extendedprice ELSE l_extendedprice END
           AS DECIMAL(10,2)) AS total_amount,
         l_quantity AS trip_distance,
         l_suppkey % 6 + 1 AS ratecode_id,
         CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
         CAST(c_nationkey AS BIGINT) AS pu_location_id,
         CAST(s_nationkey AS BIGINT) AS do_location_id,
         l_orderkey % 4 + 1 AS payment_type,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS fare_amount,
         CAST(l_discount AS DECIMAL(10,2)) AS extra,
         CAST(0.5 AS DECIMAL(10,2)) AS mta_tax,
         CAST(l_tax AS DECIMAL(10,2)) AS tip_amount,
         CASE WHEN l_partkey % 97 <> 0 THEN CAST(l_discount AS DECIMAL(10,2)) END AS tolls_amount,
         CAST(1.0 AS DECIMAL(10,2)) AS improvement_surcharge,
         CAST(2.5 AS DECIMAL(10,2)) AS congestion_surcharge,
         CAST(CASE WHEN l_suppkey % 10 = 0 THEN 1.25 ELSE 0 END AS DECIMAL(10,2)) AS airport_fee,
         l_partkey % 97 = 0 AS cast_loss,
         l_shipdate AS ingestion_ts,
         strftime(o_orderdate + to_hours(CAST(l_partkey % 24 AS INT)), '%Y-%m')
           AS pickup_year_month,
         CASE WHEN l_orderkey % 50 = 0 THEN '1999-01' ELSE strftime(o_orderdate, '%Y-%m') END
           AS file_year_month
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

LOCATIONS_SQL = """
dim AS (
  SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE n_nationkey < 23
)"""

RUNS_SQL = """
runs AS (
  SELECT o_custkey,
         'r' || o_custkey AS run_id,
         'j' || o_custkey AS job_run_id,
         'job/' || o_custkey AS job_url,
         CASE WHEN o_custkey % 3 <> 0 THEN 'u' || o_custkey END AS pipeline_update_id,
         max(o_orderdate) + to_seconds(o_custkey % 86400) AS job_start_ts,
         max(o_orderdate) + to_seconds(o_custkey % 86400) + INTERVAL 1 HOUR AS job_end_ts,
         CASE WHEN o_custkey % 4 = 0 THEN 'VOLUME_PREEXISTING' ELSE 'HTTP' END AS source_mode,
         strftime(min(o_orderdate), '%Y-%m') AS start_year_month,
         strftime(min(o_orderdate) + to_months(CAST(o_custkey % 30 AS INT)), '%Y-%m')
           AS end_year_month
  FROM orders GROUP BY o_custkey
)"""

ACTIVE_SQL = """
active AS (
  SELECT start_year_month AS first_month, end_year_month AS last_month
  FROM runs WHERE pipeline_update_id IS NOT NULL
  ORDER BY job_start_ts DESC, run_id DESC LIMIT 1
),
in_window AS (
  SELECT trips.* FROM trips, active
  WHERE pickup_year_month BETWEEN first_month AND last_month
)"""


def mean_sql(amount: str) -> str:
    """Mean of DECIMAL(10,2) values rounded half up to six digits, from exact integers."""
    cents = f"CAST(sum({amount}) * 100 AS HUGEINT)"
    return (
        f"CAST(sign({cents}) * ((abs({cents}) * 20000 + count({amount})) "
        f"// (2 * count({amount}))) AS DOUBLE) / 1000000"
    )
