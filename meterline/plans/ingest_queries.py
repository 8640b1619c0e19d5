"""The whole ingest path over files that Spark writes from the given tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline import lake as store
from meterline import session
from meterline.contract import TRIP_FILE_PATTERN, TRIPS, ColumnSpec, TableContract
from meterline.functions.months import expand_window, year_month
from meterline.lake import Lake
from meterline.operators import marts
from meterline.operators.drift import drift_profile as profile
from meterline.operators.rules import expect_all, expect_all_or_drop
from meterline.plans.given import (
    LOCATIONS_SQL,
    RUNS_SQL,
    TRIPS_SQL,
    as_raw_trips,
    customer_runs,
    mean_sql,
    nation_locations,
    table,
    trip_sources,
)
from meterline.plans.mart_queries import FLOWS_SELECT
from meterline.plans.quality_queries import CANONICAL_SELECT, DROPPED_SQL, LINEAGE
from meterline.plans.registry import plain, query
from meterline.sources.dims import LOCATION_DDL, read_csv_dimension
from meterline.sources.landing import file_inventory as inventory
from meterline.sources.landing import landed_files
from meterline.streaming import events as log
from meterline.streaming.ingest import IngestConfig, ingest, rebuild_silver

EVENTS_CONTRACT = TableContract(
    columns=(
        ColumnSpec("event_id", "event_id", "BIGINT", "BIGINT", required=True),
        ColumnSpec("ts", "ts", "TIMESTAMP", "TIMESTAMP_NTZ", required=True),
        ColumnSpec("user_id", "user_id", "BIGINT"),
        ColumnSpec("value", "value", "DOUBLE", recover=True),
        ColumnSpec("fee", "fee", "DECIMAL(10, 2)", "DOUBLE"),
    ),
    event_time="ts",
    file_pattern=TRIP_FILE_PATTERN,
)
EVENT_RULES = expect_all_or_drop({"ts_present": "ts IS NOT NULL"}) + expect_all(
    {
        "value_at_least_ten": "value >= 10",
        "month_matches_file": "pickup_year_month = file_year_month",
    }
)


def month_folder(landing_dir: str, month: str) -> str:
    year, number = month.split("-")
    return f"{landing_dir}/year={year}/month={number}/yellow_tripdata_{month}.parquet"


def _cents(value: Column) -> Column:
    return F.round(value * 100).cast("long")


def land_events(spark: SparkSession, sf_dir: str, landing_dir: str) -> None:
    """The events as three months of files whose columns drift.

    The second month narrows the user id, turns the value into whole cents and re-cases
    the fee; the third also re-cases the value and adds a column.
    """
    events = table(spark, sf_dir, "events")
    fee = (F.col("event_id") % 7).cast("double")
    first = ["event_id", "ts", "user_id", "value", fee.alias("fee")]
    second = [
        "event_id",
        "ts",
        F.col("user_id").cast("int").alias("user_id"),
        _cents(F.col("value")).alias("value"),
        fee.alias("Fee"),
    ]
    third = [c for c in second if c is not second[3]]
    third += [second[3].alias("Value"), F.concat(F.lit("n"), F.col("event_id")).alias("note")]
    for i, columns in enumerate((first, second, third)):
        part = events.where(F.col("event_id") % 3 == i).select(*columns)
        part.write.parquet(month_folder(landing_dir, f"2024-0{i + 1}"))


@dataclass(frozen=True)
class Ingested:
    config: IngestConfig
    landing_dir: str


_DONE: dict[tuple[str, str, str, int], Ingested] = {}
TRIP_TABLES = ("lineitem", "orders", "customer", "supplier")


def _state(spark: SparkSession, sf_dir: str, tables: Sequence[str]) -> int:
    """A number for the files of the given tables: their names, sizes and times."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    listed = files.load([f"{sf_dir}/{t}.parquet" for t in tables])
    return listed.agg(F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()[0]


def _once(spark: SparkSession, sf_dir: str, what: str, tables: Sequence[str], build) -> Ingested:
    """Ingest ``what`` once per application and state of its input; several queries read it."""
    key = (spark.sparkContext.applicationId, sf_dir, what, _state(spark, sf_dir, tables))
    if key not in _DONE:
        root = session.scratch_dir(spark, what)
        _DONE[key] = build(spark, sf_dir, root)
    return _DONE[key]


def _ingest_events(spark: SparkSession, sf_dir: str, root: str) -> Ingested:
    landing = f"{root}/landing"
    land_events(spark, sf_dir, landing)
    config = IngestConfig(landing, Lake(f"{root}/lake"), EVENTS_CONTRACT, EVENT_RULES)
    ingest(spark, config, "first")
    ingest(spark, config, "second")  # nothing new: must add no rows
    return Ingested(config, landing)


def ingested_events(spark: SparkSession, sf_dir: str) -> Ingested:
    return _once(spark, sf_dir, "events", ["events"], _ingest_events)


@query(
    "ingest_roundtrip",
    """
    SELECT event_id, ts, user_id, CASE WHEN event_id % 3 = 0 THEN value END AS value,
           CASE WHEN event_id % 3 <> 0 THEN CAST(round(value * 100) AS BIGINT) END
             AS rescued_value,
           CAST(event_id % 7 AS DOUBLE) AS fee,
           CASE WHEN event_id % 3 = 2 THEN 'n' || event_id END AS note,
           '2024-0' || (event_id % 3 + 1) AS file_year_month
    FROM events
    """,
)
def ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table after two runs: typed values, rescued values, the added column."""
    done = ingested_events(spark, sf_dir)
    rows = store.read_bronze(spark, done.config.lake)
    return rows.select(
        "event_id",
        "ts",
        "user_id",
        "value",
        F.get_json_object("_rescued_data", "$.value").cast("long").alias("rescued_value"),
        "fee",
        "note",
        F.regexp_extract("_source_file_path", TRIP_FILE_PATTERN, 1).alias("file_year_month"),
    )


RECOVERED_EVENTS_SQL = """
    SELECT event_id, ts, user_id,
           CASE WHEN event_id % 3 = 0 THEN value ELSE round(value * 100) END AS value,
           CAST(event_id % 7 AS DOUBLE) AS fee,
           strftime(ts, '%Y-%m') AS pickup_year_month,
           '2024-0' || (event_id % 3 + 1) AS file_year_month
    FROM events
"""


@query("silver_recovered", RECOVERED_EVENTS_SQL)
def silver_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical table the stream kept up to date: no value lost to the drift."""
    done = ingested_events(spark, sf_dir)
    return plain(store.read_silver(spark, done.config.lake, EVENTS_CONTRACT).drop(*LINEAGE))


@query("silver_rebuild", RECOVERED_EVENTS_SQL)
def silver_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical table recomputed from all raw rows into a new version."""
    # A lake of its own: others read the table that the stream keeps.
    done = _ingest_events(spark, sf_dir, session.scratch_dir(spark, "rebuild"))
    version = rebuild_silver(spark, done.config, "rebuild")
    silver = store.read_silver(spark, done.config.lake, EVENTS_CONTRACT, version)
    return plain(silver.drop(*LINEAGE))


@query(
    "drift_profile",
    """
    SELECT '2024-0' || (event_id % 3 + 1) AS file_year_month, count(*) AS total,
           count(*) FILTER (WHERE event_id % 3 <> 0 AND value IS NOT NULL) AS rescued,
           count(*) FILTER (WHERE value IS NULL) AS truly_null
    FROM events GROUP BY 1 ORDER BY 1
    """,
)
def drift_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = ingested_events(spark, sf_dir)
    return profile(store.read_bronze(spark, done.config.lake), EVENTS_CONTRACT, "value")


def _aged(spark: SparkSession, folder: str, days: int) -> None:
    """Set the modification time of a folder's files back by ``days``."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(path):
        fs.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


@query(
    "ingest_late_files",
    """
    SELECT event_id, ts, CAST(value AS DOUBLE) AS value,
           '2024-0' || (event_id % 3 + 1) AS file_year_month
    FROM events
    """,
)
def ingest_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table after three ingests; each month's files are weeks older than the last."""
    root = session.scratch_dir(spark, "late")
    contract = TableContract(
        columns=EVENTS_CONTRACT.columns[:2], event_time="ts", file_pattern=TRIP_FILE_PATTERN
    )
    config = IngestConfig(f"{root}/landing", Lake(f"{root}/lake"), contract, EVENT_RULES[:1])
    for i in range(3):
        folder = month_folder(config.landing_dir, f"2024-0{i + 1}")
        events = table(spark, sf_dir, "events").where(F.col("event_id") % 3 == i)
        events.select("event_id", "ts", "value").write.parquet(folder)
        _aged(spark, folder, 20 * i)
        ingest(spark, config, f"update{i}")
    rows = store.read_bronze(spark, config.lake)
    month = F.regexp_extract("_source_file_path", TRIP_FILE_PATTERN, 1).alias("file_year_month")
    return rows.select("event_id", "ts", "value", month)


@query(
    "required_columns",
    """
    SELECT DISTINCT '2024-0' || (event_id % 3 + 1) AS file_year_month,
           CASE WHEN event_id % 3 = 1 THEN 'ts' ELSE 'value' END AS missing
    FROM events WHERE event_id % 3 > 0
    """,
)
def required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required columns that landed files lack, by month, as the run events tell."""
    root = session.scratch_dir(spark, "required")
    columns = (
        ColumnSpec("event_id", "event_id", "BIGINT", "BIGINT", required=True),
        ColumnSpec("ts", "ts", "TIMESTAMP", "TIMESTAMP_NTZ", required=True),
        ColumnSpec("value", "value", "DOUBLE", required=True),
    )
    contract = TableContract(columns=columns, event_time="ts", file_pattern=TRIP_FILE_PATTERN)
    config = IngestConfig(f"{root}/landing", Lake(f"{root}/lake"), contract, EVENT_RULES[:1])
    kept = (["event_id", "ts", "value"], ["event_id", "value"], ["EVENT_ID", "Ts"])
    for i, names in enumerate(kept):
        events = table(spark, sf_dir, "events").where(F.col("event_id") % 3 == i)
        spelled = [F.col(n).alias(n) for n in names]
        events.select(*spelled).write.parquet(month_folder(config.landing_dir, f"2024-0{i + 1}"))
    ingest(spark, config, "required")
    listed = log.lacking_columns(store.read_events(spark, config.lake))
    month = F.regexp_extract("path", TRIP_FILE_PATTERN, 1).alias("file_year_month")
    return listed.select(month, "missing").distinct()


# --- trips: landing files of three schema generations, to marts -----------------------


def land_trips(spark: SparkSession, sf_dir: str, root: str, landing_dir: str) -> None:
    """Trips as monthly files of three generations of the source schema.

    The joined rows, as they are in the given tables, are clustered by month and written once;
    each generation's trips are made from there without a further shuffle. Each month is
    spread over as many files as its size asks for.
    """
    month = F.col("file_month")
    generation = F.when(month < "1997-01", 0).when(month < "1999-01", 1).otherwise(2)
    sources = trip_sources(spark, sf_dir)
    staged = store.rebalance(sources, "file_month").withColumn("generation", generation)
    store.write_by_month(staged, f"{root}/staged", ["generation", "file_month"])

    kept = [c.source for c in TRIPS.columns if c.source != "airport_fee"]
    narrowed = {
        "VendorID": "int",
        "PULocationID": "int",
        "DOLocationID": "int",
        "passenger_count": "bigint",
        "RatecodeID": "bigint",
    }
    later = [F.col(c).cast(narrowed[c]).alias(c) if c in narrowed else F.col(c) for c in kept]
    later.append(F.col("airport_fee").alias("Airport_fee"))
    generations = [
        [F.col(c.source) for c in TRIPS.columns],
        later,
        [*later, F.lit(0.75).alias("cbd_congestion_fee")],
    ]
    rows = spark.read.schema(staged.schema).parquet(f"{root}/staged")
    for i, columns in enumerate(generations):
        trips = as_raw_trips(rows.where(F.col("generation") == i), keep=("file_month",))
        files = trips.select(
            *columns,
            F.substring(month, 1, 4).alias("year"),
            F.substring(month, 6, 2).alias("month"),
            F.concat(F.lit("yellow_tripdata_"), month, F.lit(".parquet")).alias("file"),
        )
        store.write_by_month(files, landing_dir, ["year", "month", "file"], "append")


def _land_trips(spark: SparkSession, sf_dir: str, root: str) -> Ingested:
    land_trips(spark, sf_dir, root, f"{root}/landing")
    return Ingested(IngestConfig(f"{root}/landing", Lake(f"{root}/lake"), TRIPS), f"{root}/landing")


def landed_trips(spark: SparkSession, sf_dir: str) -> Ingested:
    """The landing files of the trips, for a lake that may not hold them yet."""
    return _once(spark, sf_dir, "landed", TRIP_TABLES, _land_trips)


def _ingest_trips(spark: SparkSession, sf_dir: str, root: str) -> Ingested:
    landing = landed_trips(spark, sf_dir).landing_dir
    config = IngestConfig(landing, Lake(f"{root}/lake"), TRIPS)
    ingest(spark, config, "trips")
    return Ingested(config, landing)


def ingested_trips(spark: SparkSession, sf_dir: str) -> Ingested:
    return _once(spark, sf_dir, "trips", TRIP_TABLES, _ingest_trips)


def _rebuild_trips(spark: SparkSession, sf_dir: str, root: str) -> Ingested:
    """Trips ingested, rebuilt, and read again from the start, in a lake of their own."""
    done = _ingest_trips(spark, sf_dir, root)
    rebuild_silver(spark, done.config, "rebuild")
    ingest(spark, done.config, "refresh", full_refresh=True)
    return done


def rebuilt_trips(spark: SparkSession, sf_dir: str) -> Ingested:
    return _once(spark, sf_dir, "rebuilt", TRIP_TABLES, _rebuild_trips)


def _ingested_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.read_silver(spark, ingested_trips(spark, sf_dir).config.lake, TRIPS)


def _fixed_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One complete run per order month and the months after it: the newest has 1999-2001."""
    months = table(spark, sf_dir, "orders").select(year_month("o_orderdate").alias("m")).distinct()
    return months.select(
        F.col("m").alias("start_year_month"),
        F.lit("2001-12").alias("end_year_month"),
        F.col("m").alias("run_id"),
        F.when(F.col("m") <= "1999-01", F.col("m")).alias("pipeline_update_id"),
        F.to_timestamp_ntz(F.concat("m", F.lit("-01")), F.lit("yyyy-MM-dd"))
        .cast("timestamp")
        .alias("job_start_ts"),
    )


KEPT_SQL = f"kept AS (SELECT * FROM trips WHERE {DROPPED_SQL})"
LATE_SQL = "late AS (SELECT * FROM kept WHERE pickup_year_month BETWEEN '1999-01' AND '2001-12')"


@query("pipeline_silver", f"WITH {TRIPS_SQL} {CANONICAL_SELECT} WHERE {DROPPED_SQL}")
def pipeline_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All canonical trips after landing, drift, rescue, recovery and rules."""
    return plain(_ingested_silver(spark, sf_dir).drop(*LINEAGE))


@query(
    "pipeline_monthly",
    f"""
    WITH {TRIPS_SQL}, {KEPT_SQL}, {LATE_SQL}
    SELECT pickup_year_month, {mean_sql("total_amount")} AS avg_total_amount,
           count(*) AS trip_count
    FROM late GROUP BY 1 ORDER BY 1
    """,
)
def pipeline_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window prunes the month partitions of the canonical table."""
    trips = marts.trips_in_window(_ingested_silver(spark, sf_dir), _fixed_audit(spark, sf_dir))
    return plain(marts.monthly_avg_total_amount(trips))


@query(
    "pipeline_hourly",
    f"""
    WITH {TRIPS_SQL}, {KEPT_SQL}, {LATE_SQL}
    SELECT CAST(hour(pickup_at) AS INT) AS pickup_hour,
           CAST(sum(passenger_count) AS DOUBLE) / count(passenger_count) AS avg_passenger_count,
           count(passenger_count) AS trip_count_with_passenger
    FROM late
    WHERE pickup_year_month = '2000-05' AND passenger_count IS NOT NULL
    GROUP BY 1 ORDER BY 1
    """,
)
def pipeline_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = marts.trips_in_window(_ingested_silver(spark, sf_dir), _fixed_audit(spark, sf_dir))
    return marts.hourly_avg_passenger_count(trips, "2000-05")


@query(
    "pipeline_flows",
    f"WITH {TRIPS_SQL}, {LOCATIONS_SQL}, {KEPT_SQL}, {LATE_SQL} {FLOWS_SELECT % 'late'}",
)
def pipeline_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = marts.trips_in_window(_ingested_silver(spark, sf_dir), _fixed_audit(spark, sf_dir))
    return plain(marts.flow_matrix(trips, nation_locations(spark, sf_dir)))


def _counter_sql(flow: str, rule: str, severity: str, passed: str) -> str:
    return (
        f"SELECT '{flow}' AS flow, '{rule}' AS rule, '{severity}' AS severity, "
        f"CAST(count(*) FILTER (WHERE coalesce({passed}, FALSE)) AS BIGINT) AS passed_records, "
        f"CAST(count(*) FILTER (WHERE NOT coalesce({passed}, FALSE)) AS BIGINT) "
        f"AS failed_records FROM trips"
    )


PIPELINE_COUNTERS = [
    (
        "bronze",
        "bronze_required_columns_not_null",
        "warn",
        # retyped passenger counts are NULL in the raw table until they are recovered
        "passenger_count IS NOT NULL AND dropoff_at IS NOT NULL AND file_year_month < '1997-01'",
    ),
    ("bronze", "bronze_no_rescued_data", "warn", "file_year_month < '1997-01'"),
    ("silver", "total_amount_non_negative", "drop", "total_amount >= 0"),
    (
        "silver",
        "trip_timestamps_not_null",
        "drop",
        "pickup_at IS NOT NULL AND dropoff_at IS NOT NULL",
    ),
    ("silver", "dropoff_after_pickup", "drop", "dropoff_at >= pickup_at"),
    ("silver", "passenger_count_in_range", "warn", "passenger_count BETWEEN 0 AND 9"),
    ("silver", "vendor_id_in_dictionary", "warn", "vendor_id IN (1, 2, 6, 7)"),
    ("silver", "pickup_month_matches_file", "warn", "pickup_year_month = file_year_month"),
    ("silver", "no_cast_loss", "warn", "NOT cast_loss"),
]


COUNTERS_SQL = f"WITH {TRIPS_SQL} " + " UNION ALL ".join(
    _counter_sql(*c) for c in PIPELINE_COUNTERS
)


@query("pipeline_rule_counters", COUNTERS_SQL)
def pipeline_rule_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the run events say the rules counted while the tables were written."""
    return _counters(spark, ingested_trips(spark, sf_dir).config.lake)


def _counters(spark: SparkSession, lake: Lake) -> DataFrame:
    versions = {t: store.current_version(spark, lake, t) for t in ("bronze", "silver")}
    return log.rule_counters(store.read_events(spark, lake), versions)


@query("rebuilt_rule_counters", COUNTERS_SQL)
def rebuilt_rule_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counters after a rebuild and a full refresh: each row is counted once."""
    return _counters(spark, rebuilt_trips(spark, sf_dir).config.lake)


@query("full_refresh", f"WITH {TRIPS_SQL} {CANONICAL_SELECT} WHERE {DROPPED_SQL}")
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All canonical trips after a rebuild and a full refresh."""
    lake = rebuilt_trips(spark, sf_dir).config.lake
    return plain(store.read_silver(spark, lake, TRIPS).drop(*LINEAGE))


@query(
    "pipeline_drift_profile",
    f"""
    WITH {TRIPS_SQL}
    SELECT file_year_month, count(*) AS total,
           count(*) FILTER (WHERE file_year_month >= '1997-01') AS rescued,
           count(*) FILTER (WHERE passenger_count IS NULL) AS truly_null
    FROM trips GROUP BY 1 ORDER BY 1
    """,
)
def pipeline_drift_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = ingested_trips(spark, sf_dir).config.lake
    raw = store.read_bronze(spark, lake, file_month=True)
    return profile(raw, TRIPS, "passenger_count", F.col(store.FILE_PARTITION))


@query(
    "file_inventory",
    f"""
    WITH {TRIPS_SQL}, {RUNS_SQL},
    asked AS (
      SELECT DISTINCT strftime(m, '%Y-%m') AS year_month FROM (
        SELECT unnest(generate_series(CAST(start_year_month || '-01' AS DATE),
                                      CAST(end_year_month || '-01' AS DATE) + INTERVAL 6 MONTH,
                                      INTERVAL 1 MONTH)) AS m FROM runs))
    SELECT year_month, count(t.m) > 0 AS present
    FROM asked LEFT JOIN (SELECT DISTINCT file_year_month AS m FROM trips) AS t ON year_month = t.m
    GROUP BY 1
    """,
)
def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the months any run asked for, or the half year after, have landed."""
    until = F.add_months(F.to_date(F.concat("end_year_month", F.lit("-01"))), 6)
    asked = (
        customer_runs(spark, sf_dir)
        .select(
            F.explode(expand_window("start_year_month", F.date_format(until, "yyyy-MM"))).alias(
                "year_month"
            )
        )
        .distinct()
    )
    files = landed_files(spark, landed_trips(spark, sf_dir).landing_dir)
    return inventory(files, asked).select(
        "year_month", (F.col("bytes_in_volume") > 0).alias("present")
    )


@query(
    "dim_csv",
    """
    SELECT CAST(p_partkey AS INT) AS location_id, p_brand AS borough,
           CASE WHEN p_partkey % 5 = 0 THEN 'N/A' WHEN p_partkey % 5 = 1 THEN 'Unknown'
                WHEN p_partkey % 5 = 2 THEN p_name || ', "' || p_type || '"'
                ELSE p_name END AS zone,
           p_type AS service_zone
    FROM part
    """,
)
def dim_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as a quoted CSV dimension and read back with forced types."""
    key = F.col("p_partkey")
    quoted = F.concat(F.col("p_name"), F.lit(', "'), F.col("p_type"), F.lit('"'))
    zone = (
        F.when(key % 5 == 0, "N/A")
        .when(key % 5 == 1, "Unknown")
        .when(key % 5 == 2, quoted)
        .otherwise(F.col("p_name"))
    )
    part = table(spark, sf_dir, "part").select(
        key.cast("int").alias("location_id"),
        F.col("p_brand").alias("borough"),
        zone.alias("zone"),
        F.col("p_type").alias("service_zone"),
    )
    root = session.scratch_dir(spark, "dim")
    part.write.option("header", "true").option("quoteAll", "true").option("escape", '"').csv(
        f"{root}/csv"
    )
    store.load_seed(read_csv_dimension(spark, f"{root}/csv"), f"{root}/dim")
    return spark.read.schema(LOCATION_DDL).parquet(f"{root}/dim")
