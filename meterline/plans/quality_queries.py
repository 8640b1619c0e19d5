"""Contract projection, row rules and data tests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.contract import TRIP_FILE_PATTERN, TRIPS, ColumnSpec, TableContract
from meterline.operators import checks, rules
from meterline.operators.conform import canonical_column, conform
from meterline.plans.given import (
    LOCATIONS_SQL,
    RUNS_SQL,
    TRIPS_SQL,
    customer_runs,
    nation_locations,
    raw_trips,
    silver_trips,
    table,
)
from meterline.plans.registry import plain, query

CANONICAL_SELECT = """
    SELECT vendor_id, pickup_at AS tpep_pickup_datetime, dropoff_at AS tpep_dropoff_datetime,
           passenger_count, CAST(total_amount AS DOUBLE) AS total_amount, trip_distance,
           ratecode_id, store_and_fwd_flag, pu_location_id, do_location_id, payment_type,
           CAST(fare_amount AS DOUBLE) AS fare_amount, CAST(extra AS DOUBLE) AS extra,
           CAST(mta_tax AS DOUBLE) AS mta_tax, CAST(tip_amount AS DOUBLE) AS tip_amount,
           CAST(tolls_amount AS DOUBLE) AS tolls_amount,
           CAST(improvement_surcharge AS DOUBLE) AS improvement_surcharge,
           CAST(congestion_surcharge AS DOUBLE) AS congestion_surcharge,
           CAST(airport_fee AS DOUBLE) AS airport_fee, pickup_year_month, file_year_month
    FROM trips
"""
DROPPED_SQL = """
    total_amount >= 0 AND pickup_at IS NOT NULL AND dropoff_at IS NOT NULL
    AND dropoff_at >= pickup_at
"""
LINEAGE = ("_source_file_path", "_source_file_modification_time", "_ingestion_ts")


@query("conform_project", f"WITH {TRIPS_SQL} {CANONICAL_SELECT}")
def conform_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(silver_trips(spark, sf_dir).drop(*LINEAGE))


@query(
    "rescue_recover",
    """
    SELECT event_id,
           CASE WHEN event_id % 3 = 0 THEN CAST(trunc(value) AS BIGINT)
                ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
    FROM events
    """,
)
def rescue_recover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that is typed in a third of the rows and only rescued in the others."""
    spec = ColumnSpec("k", "k", "BIGINT", recover=True)
    typed = F.when(F.col("event_id") % 3 == 0, F.col("value"))
    rescued = F.when(F.col("event_id") % 3 != 0, F.col("props"))
    bronze = table(spark, sf_dir, "events").select(
        "event_id", typed.alias("k"), rescued.alias("_rescued_data")
    )
    return bronze.select("event_id", canonical_column(bronze, spec).alias("k"))


@query("rules_drop", f"WITH {TRIPS_SQL} {CANONICAL_SELECT} WHERE {DROPPED_SQL}")
def rules_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = rules.apply_rules(silver_trips(spark, sf_dir), rules.TRIP_RULES)
    return plain(kept.drop(*LINEAGE))


def _metrics_sql(source: str, tests: list[tuple[str, str, str]]) -> str:
    selects = [
        f"""SELECT '{name}' AS rule, '{severity}' AS severity,
            CAST(count(*) FILTER (WHERE coalesce({passed}, FALSE)) AS BIGINT) AS passed_records,
            CAST(count(*) FILTER (WHERE NOT coalesce({passed}, FALSE)) AS BIGINT)
              AS failed_records FROM {source}"""
        for name, severity, passed in tests
    ]
    return " UNION ALL ".join(selects)


@query(
    "rules_metrics",
    f"WITH {TRIPS_SQL} "
    + _metrics_sql(
        "trips",
        [
            ("total_amount_non_negative", "drop", "total_amount >= 0"),
            (
                "trip_timestamps_not_null",
                "drop",
                "pickup_at IS NOT NULL AND dropoff_at IS NOT NULL",
            ),
            ("dropoff_after_pickup", "drop", "dropoff_at >= pickup_at"),
            ("passenger_count_in_range", "warn", "passenger_count BETWEEN 0 AND 9"),
            ("vendor_id_in_dictionary", "warn", "vendor_id IN (1, 2, 6, 7)"),
            ("pickup_month_matches_file", "warn", "pickup_year_month = file_year_month"),
            ("no_cast_loss", "warn", "NOT cast_loss"),
        ],
    ),
)
def rules_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conform(raw_trips(spark, sf_dir), TRIPS, track_cast_loss=True)
    return rules.rule_metrics(rows, rules.TRIP_RULES + rules.CAST_LOSS_RULE)


EVENT_RULE_CONTRACT = TableContract(
    columns=(
        ColumnSpec("event_id", "event_id", "BIGINT", required=True),
        ColumnSpec("ts", "ts", "TIMESTAMP", required=True),
        ColumnSpec("value", "value", "DOUBLE", required=True),
    ),
    event_time="ts",
    file_pattern=TRIP_FILE_PATTERN,
)


@query(
    "bronze_rules",
    "WITH b AS (SELECT event_id, ts, CASE WHEN event_id % 7 <> 0 THEN value END AS value,"
    " CASE WHEN event_type = 'error' THEN props END AS rescued FROM events) "
    + _metrics_sql(
        "b",
        [
            (
                "bronze_required_columns_not_null",
                "warn",
                "event_id IS NOT NULL AND ts IS NOT NULL AND value IS NOT NULL",
            ),
            ("bronze_no_rescued_data", "warn", "rescued IS NULL"),
        ],
    ),
)
def bronze_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("_rescued_data"),
    )
    return rules.rule_metrics(bronze, rules.raw_rules(EVENT_RULE_CONTRACT))


def _result_sql(test: str, dataset: str, column: str, failures: str, severity: str) -> str:
    return (
        f"SELECT '{test}' AS test, '{dataset}' AS dataset, '{column}' AS column_name, "
        f"'{severity}' AS severity, CAST(({failures}) AS BIGINT) AS failures"
    )


NOT_NULL_SQL = " UNION ALL ".join(
    _result_sql("not_null", "trips", c, f"SELECT count(*) FROM trips WHERE {sql} IS NULL", "error")
    for c, sql in [
        ("vendor_id", "vendor_id"),
        ("total_amount", "total_amount"),
        ("tpep_pickup_datetime", "pickup_at"),
        ("tpep_dropoff_datetime", "dropoff_at"),
        ("passenger_count", "passenger_count"),
        ("tolls_amount", "tolls_amount"),
    ]
)
ACCEPTED_SQL = _result_sql(
    "accepted_values",
    "trips",
    "vendor_id",
    "SELECT count(*) FROM trips WHERE vendor_id NOT IN (1, 2, 6, 7)",
    "error",
)
RELATIONSHIPS_SQL = " UNION ALL ".join(
    _result_sql(
        "relationships",
        "trips",
        c,
        f"SELECT count(*) FROM trips WHERE {c} IS NOT NULL "
        f"AND {c} NOT IN (SELECT location_id FROM dim)",
        "error",
    )
    for c in ("pu_location_id", "do_location_id")
)
UNIQUE_SQL = " UNION ALL ".join(
    _result_sql(
        "unique",
        t,
        c,
        f"SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL "
        f"GROUP BY {c} HAVING count(*) > 1)",
        "error",
    )
    for t, c in (("orders", "o_orderkey"), ("orders", "o_custkey"))
)
FRESHNESS_SQL = " UNION ALL ".join(
    _result_sql(
        "freshness",
        "events",
        "ts",
        f"SELECT CASE WHEN max(ts) < TIMESTAMP '{now}' - INTERVAL 24 HOUR THEN 1 ELSE 0 END "
        "FROM events",
        "warn",
    )
    for now in ("2024-01-31 12:00:00", "2024-03-01 00:00:00")
)
NOT_NULL_COLUMNS = (
    "vendor_id",
    "total_amount",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "tolls_amount",
)


@query("check_not_null", f"WITH {TRIPS_SQL} {NOT_NULL_SQL}")
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.column_checks(silver_trips(spark, sf_dir), "trips", NOT_NULL_COLUMNS)


@query("check_accepted", f"WITH {TRIPS_SQL} {ACCEPTED_SQL}")
def check_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = silver_trips(spark, sf_dir)
    return checks.column_checks(silver, "trips", accepted={"vendor_id": (1, 2, 6, 7)})


LOCATION_COLUMNS = ("pu_location_id", "do_location_id")


def _freshness(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    events = table(spark, sf_dir, "events")
    return [
        checks.freshness_check(events, "events", "ts", F.lit(now).cast("timestamp_ntz"))
        for now in ("2024-01-31 12:00:00", "2024-03-01 00:00:00")
    ]


@query("check_relationships", f"WITH {TRIPS_SQL}, {LOCATIONS_SQL} {RELATIONSHIPS_SQL}")
def check_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = nation_locations(spark, sf_dir)
    return checks.table_checks(
        silver_trips(spark, sf_dir),
        "trips",
        relationships=LOCATION_COLUMNS,
        parent=dim,
        parent_column="location_id",
    )


@query("check_unique", UNIQUE_SQL)
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return checks.unique_checks(orders, "orders", ("o_orderkey", "o_custkey"))


@query("check_freshness", FRESHNESS_SQL)
def check_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(DataFrame.unionByName, _freshness(spark, sf_dir))


@query(
    "check_summary",
    f"""
    WITH {TRIPS_SQL}, {LOCATIONS_SQL}, r AS ({NOT_NULL_SQL} UNION ALL {ACCEPTED_SQL}
      UNION ALL {RELATIONSHIPS_SQL} UNION ALL {UNIQUE_SQL} UNION ALL {FRESHNESS_SQL})
    SELECT r.*, CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status FROM r
    """,
)
def check_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test of every table; all tests of the trips share one scan."""
    trips = checks.table_checks(
        silver_trips(spark, sf_dir),
        "trips",
        NOT_NULL_COLUMNS,
        {"vendor_id": (1, 2, 6, 7)},
        LOCATION_COLUMNS,
        nation_locations(spark, sf_dir),
        "location_id",
    )
    orders = table(spark, sf_dir, "orders")
    unique = checks.unique_checks(orders, "orders", ("o_orderkey", "o_custkey"))
    return checks.summarize([trips, unique, *_freshness(spark, sf_dir)])


@query(
    "orphan_locations",
    f"""
    WITH {TRIPS_SQL}, {LOCATIONS_SQL}
    SELECT pu_location_id, count(*) AS n FROM trips
    WHERE pu_location_id IS NOT NULL AND pu_location_id NOT IN (SELECT location_id FROM dim)
    GROUP BY 1
    """,
)
def orphan_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failing keys behind a relationships test."""
    silver = silver_trips(spark, sf_dir)
    return checks.orphan_keys(
        silver, "pu_location_id", nation_locations(spark, sf_dir), "location_id"
    )


@query(
    "duplicate_run_windows",
    f"""
    WITH {RUNS_SQL}
    SELECT start_year_month, count(*) AS n FROM runs GROUP BY 1 HAVING count(*) > 1
    """,
)
def duplicate_run_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failing keys behind a unique test."""
    return checks.duplicate_keys(customer_runs(spark, sf_dir), "start_year_month")
