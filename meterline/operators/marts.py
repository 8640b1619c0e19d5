"""Window-filtered, dimension-enriched marts.

Each mart is one SELECT over named inputs. The functions here run it over frames; the catalog
stores the same text as a view over registered tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.operators.runs import latest_complete_run

# A dimension is broadcast only when measuring it shows that it stays below this size.
BROADCAST_BYTES = 128 << 20
ROW_BYTES = 128  # hash-table entry and fixed-width columns of one row, on the high side


# Inputs: {silver}, {trips} (the projection within the window), {pairs}, {dim}, {month}.
PROJECTION_SQL = """
SELECT vendor_id, passenger_count, total_amount, tpep_pickup_datetime AS pickup_at,
       tpep_dropoff_datetime AS dropoff_at, pickup_year_month,
       hour(tpep_pickup_datetime) AS pickup_hour,
       pu_location_id AS pickup_location_id, do_location_id AS dropoff_location_id
FROM {silver}
"""
_ROLES = """
LEFT JOIN {dim} AS origin ON pickup_location_id = CAST(origin.location_id AS BIGINT)
LEFT JOIN {dim} AS target ON dropoff_location_id = CAST(target.location_id AS BIGINT)
"""
CONSUMPTION_SQL = f"""
SELECT w.*, origin.borough AS pickup_borough, origin.zone AS pickup_zone,
       target.borough AS dropoff_borough, target.zone AS dropoff_zone
FROM {{trips}} AS w {_ROLES}
"""
MONTHLY_SQL = """
SELECT pickup_year_month, avg(total_amount) AS avg_total_amount, count(1) AS trip_count
FROM {trips} GROUP BY pickup_year_month ORDER BY pickup_year_month
"""
HOURLY_SQL = """
SELECT pickup_hour, avg(passenger_count) AS avg_passenger_count,
       count(passenger_count) AS trip_count_with_passenger
FROM {trips} WHERE passenger_count IS NOT NULL AND pickup_year_month = {month}
GROUP BY pickup_hour ORDER BY pickup_hour
"""
PAIRS_SQL = """
SELECT pickup_location_id, dropoff_location_id, count(1) AS trips, sum(total_amount) AS amount,
       count(total_amount) AS amounts
FROM {trips} GROUP BY pickup_location_id, dropoff_location_id
"""


def decimal_mean(total: str, count: str) -> str:
    """Mean of DECIMAL(10,2) values from their sum and count, typed as ``avg`` types it."""
    return f"CAST(CAST({total} AS DECIMAL(24,2)) / CAST({count} AS DECIMAL(13,0)) AS DECIMAL(14,6))"


FLOWS_SQL = f"""
SELECT origin.borough AS pickup_borough, target.borough AS dropoff_borough,
       sum(trips) AS trip_count, {decimal_mean("sum(amount)", "sum(amounts)")} AS avg_total_amount
FROM {{pairs}} AS p {_ROLES}
GROUP BY origin.borough, target.borough ORDER BY trip_count DESC
"""


def measured_bytes(dim: DataFrame) -> int:
    """Memory the rows of ``dim`` would take on an executor, by one distributed aggregate."""
    texts = [f.name for f in dim.schema.fields if f.dataType.typeName() == "string"]
    lengths = [F.coalesce(F.octet_length(name), F.lit(0)) for name in texts]
    text = reduce(lambda a, b: a + b, lengths, F.lit(0)).cast("long")
    rows, text_bytes = dim.agg(F.count(F.lit(1)), F.sum(text)).first()
    return rows * ROW_BYTES + (text_bytes or 0)


def small_side(dim: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``dim`` with a broadcast hint if it measures small, else unchanged.

    An unhinted join shuffles, and the adaptive planner splits its hot keys.
    """
    return F.broadcast(dim) if measured_bytes(dim) <= max_bytes else dim


def sized_side(dim: DataFrame, dim_bytes: int | None) -> DataFrame:
    """``small_side`` by a size that is known, so that no job runs while a plan is built."""
    if dim_bytes is None:
        return small_side(dim)
    return F.broadcast(dim) if dim_bytes <= BROADCAST_BYTES else dim


def in_active_window(facts: DataFrame, audit: DataFrame, month: str = "pickup_year_month") -> DataFrame:
    """Rows of the latest complete run's window, both ends included.

    The bounds are a scalar subquery: with ``facts`` partitioned by ``month`` it prunes
    partitions, and a view over this frame follows new runs.
    """
    first, last = active_window(audit)
    return facts.where(F.col(month).between(first, last))


def active_window(audit: DataFrame) -> tuple[Column, Column]:
    """First and last month of the latest complete run; NULL if there is none.

    Both bounds are fields of one subquery, which therefore runs once.
    """
    bounds = F.struct("start_year_month", "end_year_month").alias("bounds")
    run = latest_complete_run(audit).select(bounds).scalar()
    return run["start_year_month"], run["end_year_month"]


def trip_projection(silver: DataFrame) -> DataFrame:
    """The canonical columns the marts use, under their mart names."""
    return silver.sparkSession.sql(PROJECTION_SQL, silver=silver)


def trips_in_window(silver: DataFrame, audit: DataFrame) -> DataFrame:
    return trip_projection(in_active_window(silver, audit))


def consumption(trips: DataFrame, dim: DataFrame, dim_bytes: int | None = None) -> DataFrame:
    """Trips with pickup and dropoff borough and zone; unknown ids keep the trip, with NULLs."""
    return trips.sparkSession.sql(CONSUMPTION_SQL, trips=trips, dim=sized_side(dim, dim_bytes))


def monthly_avg_total_amount(trips: DataFrame) -> DataFrame:
    """Trip-weighted mean amount per pickup month.

    Reads the window frame without the dimension: the joins could not change it.
    """
    return trips.sparkSession.sql(MONTHLY_SQL, trips=trips)


def hourly_avg_passenger_count(trips: DataFrame, month: str) -> DataFrame:
    """Mean passengers per pickup hour of one month; unknown counts stay out of both columns."""
    return trips.sparkSession.sql(HOURLY_SQL, trips=trips, month=month)


def location_pairs(trips: DataFrame) -> DataFrame:
    """Trips and amounts per pair of location ids; a small frame that answers for all trips."""
    return trips.sparkSession.sql(PAIRS_SQL, trips=trips)


def flows_of_pairs(pairs: DataFrame, dim: DataFrame, dim_bytes: int | None = None) -> DataFrame:
    return pairs.sparkSession.sql(FLOWS_SQL, pairs=pairs, dim=sized_side(dim, dim_bytes))


def flow_matrix(trips: DataFrame, dim: DataFrame, dim_bytes: int | None = None) -> DataFrame:
    """Trips and mean amount per pickup and dropoff borough, NULL boroughs kept.

    Trips are first summed per pair of location ids, so only pairs, not trips, meet the
    dimension; the borough sums follow from the pair sums.
    """
    return flows_of_pairs(location_pairs(trips), dim, dim_bytes)
