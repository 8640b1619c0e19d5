"""Corrections, replays, compaction, stored views and the audit table, over whole tables."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline import lake as store
from meterline import session
from meterline.contract import TRIP_FILE_PATTERN, TRIPS, TableContract
from meterline.lake import Lake
from meterline.operators import runs
from meterline.operators.rules import expect_all_or_drop
from meterline.plans import jobs
from meterline.plans.audit_queries import RUN_AUDIT_SQL, _order_outcomes, audit_as_text
from meterline.plans.given import TRIPS_SQL, customer_runs, mean_sql, table
from meterline.plans.ingest_queries import (
    EVENT_RULES,
    EVENTS_CONTRACT,
    KEPT_SQL,
    LATE_SQL,
    RECOVERED_EVENTS_SQL,
    land_events,
    land_trips,
    month_folder,
)
from meterline.plans.registry import plain, query
from meterline.sources.tables import read_table
from meterline.streaming import events as log
from meterline.streaming.compaction import compact, folders
from meterline.streaming.corrections import replace_months
from meterline.streaming.ingest import IngestConfig, ingest

PLAIN_CONTRACT = TableContract(
    columns=(*EVENTS_CONTRACT.columns[:2], replace(EVENTS_CONTRACT.columns[3], hint="DOUBLE")),
    event_time="ts",
    file_pattern=TRIP_FILE_PATTERN,
)


def _month(event_id: str = "event_id", n: int = 3):
    return F.format_string("2024-%02d", F.col(event_id) % n + 1)


def land_plain(spark: SparkSession, sf_dir: str, landing_dir: str, i: int, n: int = 3, correction: bool = False) -> None:
    """Events i, i + n, ... as the file of a month; corrected, some are gone and the values differ."""
    rows = table(spark, sf_dir, "events").where(F.col("event_id") % n == i)
    value = F.col("value")
    if correction:
        rows, value = rows.where("event_id % 5 <> 0"), value + 1
    folder = month_folder(landing_dir, f"2024-{i + 1:02d}")
    rows.select("event_id", "ts", value.alias("value")).coalesce(1).write.mode("overwrite").parquet(folder)


def replaced_month(spark: SparkSession, sf_dir: str) -> IngestConfig:
    """Three months are ingested, the second lands anew and is replaced; the stream then sees
    its new file names."""
    root = session.scratch_dir(spark, "replaced")
    config = IngestConfig(f"{root}/landing", Lake(f"{root}/lake"), PLAIN_CONTRACT, EVENT_RULES)
    for i in range(3):
        land_plain(spark, sf_dir, config.landing_dir, i)
    ingest(spark, config, "first")
    land_plain(spark, sf_dir, config.landing_dir, 1, correction=True)
    replace_months(spark, config, "correction")
    ingest(spark, config, "after")
    return config


CORRECTED_SQL = """
corrected AS (
  SELECT event_id, ts, CASE WHEN event_id % 3 = 1 THEN value + 1 ELSE value END AS value,
         strftime(ts, '%Y-%m') AS pickup_year_month, '2024-0' || (event_id % 3 + 1) AS file_year_month
  FROM events WHERE event_id % 3 <> 1 OR event_id % 5 <> 0
)"""


@query(
    "month_replaced",
    f"""
    WITH {CORRECTED_SQL}
    SELECT 'raw' AS in_table, event_id, ts, value, file_year_month FROM corrected
    UNION ALL SELECT 'canonical', event_id, ts, value, file_year_month FROM corrected
    """,
)
def month_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw and canonical rows after one of three months has been corrected."""
    config = replaced_month(spark, sf_dir)
    month = F.regexp_extract("_source_file_path", TRIP_FILE_PATTERN, 1).alias("file_year_month")
    raw = store.read_bronze(spark, config.lake)
    raw = raw.select(F.lit("raw").alias("in_table"), "event_id", "ts", "value", month)
    canonical = store.read_silver(spark, config.lake, config.contract)
    canonical = canonical.select(F.lit("canonical"), "event_id", F.col("ts").cast("timestamp_ntz"), "value", "file_year_month")
    return raw.union(canonical)


def _events_counters(rows: str, retyped: str) -> str:
    tests = (
        ("bronze", "bronze_required_columns_not_null", "warn", "TRUE"),
        ("bronze", "bronze_no_rescued_data", "warn", f"NOT ({retyped} AND value IS NOT NULL)"),
        ("silver", "ts_present", "drop", "ts IS NOT NULL"),
        ("silver", "value_at_least_ten", "warn", "value >= 10"),
        ("silver", "month_matches_file", "warn", "pickup_year_month = file_year_month"),
        ("silver", "no_cast_loss", "warn", "TRUE"),
    )
    return " UNION ALL ".join(
        f"""SELECT '{flow}' AS flow, '{rule}' AS rule, '{severity}' AS severity,
        CAST(count(*) FILTER (WHERE coalesce({passed}, FALSE)) AS BIGINT) AS passed_records,
        CAST(count(*) FILTER (WHERE NOT coalesce({passed}, FALSE)) AS BIGINT) AS failed_records FROM {rows}"""
        for flow, rule, severity, passed in tests
    )


def _counters(spark: SparkSession, lake: Lake) -> DataFrame:
    versions = {t: store.current_version(spark, lake, t) for t in ("bronze", "silver")}
    return log.rule_counters(store.read_events(spark, lake), versions)


@query("replaced_rule_counters", f"WITH {CORRECTED_SQL} {_events_counters('corrected', 'FALSE')}")
def replaced_rule_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counters after the correction: of the rows that are there now."""
    return _counters(spark, replaced_month(spark, sf_dir).lake)


RETYPED_SQL = "file_year_month > '2024-01'"


@query(
    "replayed_rule_counters",
    f"WITH recovered AS ({RECOVERED_EVENTS_SQL}) {_events_counters('recovered', RETYPED_SQL)}",
)
def replayed_rule_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters after an update that was lost between logging its batch and committing it."""
    root = session.scratch_dir(spark, "replayed")
    config = IngestConfig(f"{root}/landing", Lake(f"{root}/lake"), EVENTS_CONTRACT, EVENT_RULES)
    land_events(spark, sf_dir, config.landing_dir)
    ingest(spark, config, "lost")
    store.delete(spark, config.lake.bronze(0, "checkpoint", "commits"))
    ingest(spark, config, "replay")
    return _counters(spark, config.lake)


BATCHES = 8


@query(
    "compacted",
    f"""
    SELECT event_id, ts, value, '2024-0' || (event_id % {BATCHES} + 1) AS file_year_month,
           CAST(1 AS BIGINT) AS files_of_month
    FROM events
    """,
)
def compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical rows after batches of one file each were compacted, with the number of files
    their event month is in."""
    root = session.scratch_dir(spark, "compacted")
    config = IngestConfig(
        f"{root}/landing", Lake(f"{root}/lake"), PLAIN_CONTRACT, EVENT_RULES, max_files_per_batch=1
    )
    for i in range(BATCHES):
        land_plain(spark, sf_dir, config.landing_dir, i, BATCHES)
    ingest(spark, config, "many")
    compact(spark, config)
    rows = store.read_silver(spark, config.lake, config.contract)
    listed = folders(spark, config.lake.silver(0), config.contract.event_month)
    files = listed.groupBy(F.col("month").alias("pickup_year_month")).agg(F.sum("files").alias("files_of_month"))
    return plain(
        rows.join(F.broadcast(files), "pickup_year_month").select(
            "event_id", "ts", "value", "file_year_month", "files_of_month"
        )
    )


@query(
    "catalog_marts",
    f"""
    WITH {TRIPS_SQL}, {KEPT_SQL}, {LATE_SQL}
    SELECT pickup_year_month, {mean_sql("total_amount")} AS avg_total_amount,
           count(*) AS trip_count
    FROM late GROUP BY 1 ORDER BY 1
    """,
)
def catalog_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored mart by its three-level name, after a second ingest that nobody followed up."""
    root = session.scratch_dir(spark, "catalog")
    landing, schema = f"{root}/landing", f"marts_{uuid.uuid4().hex}"
    land_trips(spark, sf_dir, root, f"{root}/all")
    config = IngestConfig(landing, Lake(f"{root}/lake"), TRIPS, catalog=schema)
    years = store.subfolders(spark, f"{root}/all")
    for moved, (first, last) in ((years[:2], ("1995-01", "1995-12")), (years[2:], ("1999-01", "2001-12"))):
        for folder in moved:
            store.move(spark, folder, f"{landing}/{folder.rsplit('/', 1)[1]}")
        jobs.run_ingestion(spark, config, jobs.RunInfo(first, last, run_id=first, job_run_id=first))
    return plain(read_table(spark, "monthly_avg_total_amount", schema))


@query(
    "audit_roundtrip",
    f"""
    WITH a AS (SELECT * FROM ({RUN_AUDIT_SQL})),
    c AS (SELECT 'r' || o_custkey AS run_id, min_by('c' || o_orderkey, (o_orderdate, 'c' || o_orderkey)) AS filled_id
          FROM orders WHERE o_orderpriority = '2-HIGH' GROUP BY o_custkey)
    SELECT a.* REPLACE (coalesce(a.pipeline_update_id, filled_id) AS pipeline_update_id)
    FROM a LEFT JOIN c ON a.run_id = c.run_id
    """,
)
def audit_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All audit columns read back from the lake: rows and completions appended to tables that
    were created twice."""
    lake = Lake(session.scratch_dir(spark, "audit"))
    audit = customer_runs(spark, sf_dir)
    store.ensure(spark, lake)
    store.append(runs.collapse_runs(audit.drop("o_custkey"), _order_outcomes(spark, sf_dir)), lake.audit)
    done = table(spark, sf_dir, "orders").where("o_orderpriority = '2-HIGH'").join(audit, "o_custkey")
    store.append(
        done.select(
            *runs.AUDIT_KEY,
            F.concat(F.lit("c"), F.col("o_orderkey")).alias("pipeline_update_id"),
            F.col("o_orderdate").cast("timestamp").alias("completed_ts"),
        ),
        lake.completions,
    )
    store.ensure(spark, lake)
    return audit_as_text(store.read_audit(spark, lake))


@query(
    "widened_union",
    """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN value ELSE round(value * 100) END AS value,
           FALSE AS rescued
    FROM events
    """,
)
def widened_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole cents, then a month with fractions, then cents again: one column of doubles, with
    nothing rescued; the first month was written as longs."""
    root = session.scratch_dir(spark, "widened")
    config = IngestConfig(f"{root}/landing", Lake(f"{root}/lake"), EVENTS_CONTRACT, EVENT_RULES, bounds=True)
    land_events(spark, sf_dir, f"{root}/all")
    for month in ("02", "01", "03"):
        store.move(spark, f"{root}/all/year=2024/month={month}", f"{config.landing_dir}/year=2024/month={month}")
        ingest(spark, config, month)
    rows = store.read_bronze(spark, config.lake)
    return rows.select("event_id", "value", F.col("_rescued_data").isNotNull().alias("rescued"))


@query(
    "ordered_files",
    f"""
    WITH {TRIPS_SQL}, {KEPT_SQL}
    SELECT pickup_year_month, do_location_id, count(*) AS trips, sum(trip_distance) AS distance
    FROM kept WHERE pu_location_id = 7 GROUP BY 1, 2
    """,
)
def ordered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips from one location, of a table whose files were ordered by location as they were
    written and cut by ranges of it when they were compacted."""
    root = session.scratch_dir(spark, "ordered")
    order = ("pu_location_id", "do_location_id", "tpep_pickup_datetime")
    config = IngestConfig(f"{root}/landing", Lake(f"{root}/lake"), TRIPS, order=order)
    land_trips(spark, sf_dir, root, config.landing_dir)
    ingest(spark, config, "ordered")
    compact(spark, config)
    rows = store.read_silver(spark, config.lake, TRIPS).where("pu_location_id = 7")
    return rows.groupBy("pickup_year_month", "do_location_id").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("trip_distance").alias("distance")
    )


REFUSING = expect_all_or_drop({"value_at_least_ten": "value >= 10", "user_not_seventh": "user_id % 7 <> 0"})
REASONS_SQL = """
array_to_string(list_filter([
  CASE WHEN NOT coalesce(value >= 10, FALSE) THEN 'value_at_least_ten' END,
  CASE WHEN NOT coalesce(user_id % 7 <> 0, FALSE) THEN 'user_not_seventh' END], lambda x: x IS NOT NULL), ',')
"""


@query(
    "quarantined_rows",
    f"""
    WITH recovered AS ({RECOVERED_EVENTS_SQL})
    SELECT event_id, value, file_year_month, {REASONS_SQL} AS reasons FROM recovered
    """,
)
def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical rows and refused ones, each with the drop rules that it failed: all rows."""
    root = session.scratch_dir(spark, "quarantined")
    config = IngestConfig(f"{root}/landing", Lake(f"{root}/lake"), EVENTS_CONTRACT, REFUSING, quarantine=True)
    land_events(spark, sf_dir, config.landing_dir)
    ingest(spark, config, "refusing")
    kept = store.read_silver(spark, config.lake, EVENTS_CONTRACT).withColumn(store.REASONS, F.array().cast("array<string>"))
    both = kept.unionByName(store.read_refused(spark, config.lake, EVENTS_CONTRACT))
    return both.select("event_id", "value", "file_year_month", F.array_join(store.REASONS, ",").alias("reasons"))


@query(
    "quarantined_outcomes",
    """
    SELECT o_orderkey AS seq, o_orderstatus AS status,
           CASE WHEN o_orderstatus = 'O' THEN 'status: ODD' ELSE '' END
             || CASE WHEN o_orderstatus = 'O' AND o_orderkey % 5 = 0 THEN ',' ELSE '' END
             || CASE WHEN o_orderkey % 5 = 0 THEN 'probe_status: NULL' ELSE '' END AS reasons
    FROM orders
    """,
)
def quarantined_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One outcome per order, some outside their domains; both sides are written in one pass."""
    outcomes = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderstatus").alias("letter"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.when(F.col("o_orderstatus") == "O", "ODD").otherwise("DOWNLOADED").alias("status"),
        F.when(F.col("o_orderkey") % 5 != 0, "OK").alias("probe_status"),
    )
    path = session.scratch_dir(spark, "outcomes")
    judged = runs.judged_outcomes(outcomes).withColumn("_refused", F.size("_reasons") > 0)
    store.write_by_month(judged, path, ["_refused"])
    sides = spark.read.schema(judged.schema).parquet(path)
    return sides.select("seq", F.col("letter").alias("status"), F.array_join("_reasons", ",").alias("reasons"))
