"""The two jobs: ingestion (landing files to canonical table and audit) and modelling
(marts over the latest complete run, then data tests)."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from meterline import lake as store
from meterline import session
from meterline.contract import TRIP_FILE_PATTERN
from meterline.functions.months import expand_window
from meterline.functions.outcomes import classify_probe, month_outcome
from meterline.lake import Lake
from meterline.operators import checks, marts, runs
from meterline.sources.dims import LOCATION_DDL, read_csv_dimension
from meterline.sources.landing import ensure_landing, file_inventory, landed_files
from meterline.sources.tables import publish_view
from meterline.plans import catalog
from meterline.streaming import events as log
from meterline.streaming.corrections import replace_months
from meterline.streaming.ingest import IngestConfig, ingest

PROBE_LOG_DDL = (
    "month STRING, status_code INT, error_name STRING, download_ok BOOLEAN, bytes_written BIGINT"
)
INTERACTIVE = "interactive"


class LandingFailedError(RuntimeError):
    """No requested month is available, so there is nothing to ingest."""


class IncompleteIngestError(RuntimeError):
    """Files that have landed did not reach the raw table."""


def _interactive_id() -> str:
    """A key of its own for each interactive run, so that none completes another."""
    return f"{INTERACTIVE}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class RunInfo:
    start_year_month: str
    end_year_month: str
    run_id: str = field(default_factory=_interactive_id)
    job_run_id: str = field(default_factory=_interactive_id)
    job_url: str = INTERACTIVE
    source_mode: str = "HTTP"


def month_outcomes(months: DataFrame, probe_log: DataFrame, inventory: DataFrame) -> DataFrame:
    """One outcome per requested month from what the probe saw and what is on storage.

    A month the probe log lacks counts as unanswered. Where the log repeats a month, the
    caller decides which entry is the last by giving one row per month.
    """
    probe = classify_probe(
        "status_code",
        F.when(
            F.col("status_code").isNull(), F.coalesce("error_name", F.lit("NotProbed"))
        ).otherwise(F.col("error_name")),
    )
    joined = (
        months.join(
            probe_log.select(F.col("month").alias("year_month"), "*").drop("month"),
            "year_month",
            "left",
        )
        .join(inventory.select("year_month", "bytes_in_volume"), "year_month", "left")
        .withColumn("probe", probe)
    )
    outcome = month_outcome("probe.probe_status", "download_ok", "bytes_written", "bytes_in_volume")
    return joined.withColumn("outcome", outcome).select(
        F.col("year_month").alias("month"), "outcome.*", "probe.*"
    )


def audit_landing(
    spark: SparkSession,
    lake: Lake,
    run: RunInfo,
    landing_dir: str,
    probe_log: DataFrame | None = None,
    job_start_ts: datetime | None = None,
    pattern: str = TRIP_FILE_PATTERN,
) -> Row:
    """Collapse this run's months to one audit row, append it and return it."""
    started = job_start_ts or datetime.now(timezone.utc)
    months = spark.range(1).select(
        F.explode(expand_window(F.lit(run.start_year_month), F.lit(run.end_year_month))).alias(
            "year_month"
        )
    )
    log_rows = spark.createDataFrame([], PROBE_LOG_DDL) if probe_log is None else probe_log
    landed = landed_files(spark, landing_dir, pattern, window_months(run))
    inventory = file_inventory(landed, months)
    outcomes = month_outcomes(months, log_rows, inventory).select(
        F.lit(run.run_id).alias("run_id"), F.lit(0).alias("seq"), "*"
    )
    runs_row = spark.range(1).select(
        *[
            F.lit(getattr(run, name)).alias(name)
            for name in (
                "run_id",
                "job_run_id",
                "job_url",
                "source_mode",
                "start_year_month",
                "end_year_month",
            )
        ],
        F.lit(started).cast("timestamp").alias("job_start_ts"),
        F.current_timestamp().alias("job_end_ts"),
    )
    # One row per run: taken to the driver to be checked and written with its fixed schema.
    row = runs.collapse_runs(runs_row, outcomes).first()
    written = spark.createDataFrame([row.asDict(recursive=True)], runs.LANDING_AUDIT_SCHEMA)
    store.append(written.coalesce(1), lake.audit)
    return row


def complete_run(spark: SparkSession, lake: Lake, job_run_id: str) -> int:
    """Give this job run's audit rows the newest update id; returns how many rows changed."""
    newest = log.latest_update_id(store.read_events(spark, lake)).first()
    if newest is None:
        return 0
    pending = runs.pending_completion(
        store.read_audit(spark, lake), job_run_id, newest["update_id"], F.current_timestamp()
    )
    rows = pending.collect()  # the audit rows of one job run
    if rows:
        filled = spark.createDataFrame(rows, store.COMPLETION_DDL)
        store.append(filled.coalesce(1), lake.completions)
    return len(rows)


def require_ingested(spark: SparkSession, config: IngestConfig, run: RunInfo) -> None:
    """Raise if a landed file of the run's window is not in the raw table.

    A run is only complete with all the files that its audit row counts.
    """
    landed = landed_files(
        spark, config.landing_dir, config.contract.file_pattern, window_months(run)
    )
    window = landed.where(F.col("year_month").between(run.start_year_month, run.end_year_month))
    missing = window.join(store.read_ingested(spark, config.lake), "path", "left_anti")
    seen = missing.agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("first")).first()
    if seen["n"]:
        raise IncompleteIngestError(
            f"{seen['n']} landed files of the window were not ingested, such as {seen['first']}"
        )


def run_ingestion(
    spark: SparkSession,
    config: IngestConfig,
    run: RunInfo,
    probe_log: DataFrame | None = None,
    full_refresh: bool = False,
    replace_changed: bool = False,
) -> Row:
    """Audit the landing folder, ingest what is new, then complete the audit row.

    ``replace_changed`` first reads those months of the run's window again whose landed files
    have changed since they were read.

    Returns the audit row as appended. A run whose months all failed raises before
    anything is ingested; its audit row stays incomplete, so the marts ignore it.
    """
    session.pin(spark)
    lake = config.lake
    store.ensure(spark, lake)
    ensure_landing(spark, config.landing_dir)
    audit_row = audit_landing(
        spark, lake, run, config.landing_dir, probe_log, pattern=config.contract.file_pattern
    )
    if audit_row["status"] == "FAILED":
        raise LandingFailedError(audit_row["error_message"])

    update_id = uuid.uuid4().hex

    def final_state(state: str) -> None:
        done = log.event(log.PIPELINE_DONE, f"update {state}", {"state": state}, update_id)
        log.emit(spark, lake, "done", [done], update_id)

    created = log.event(
        log.CREATE_UPDATE, "update created", {"full_refresh": full_refresh}, update_id
    )
    log.emit(spark, lake, "create", [created], update_id)
    try:
        if replace_changed and not full_refresh:
            replace_months(spark, config, update_id, window_months(run))
        ingest(spark, config, update_id, full_refresh)
        require_ingested(spark, config, run)
    except Exception:
        final_state("FAILED")
        raise
    final_state("COMPLETED")
    complete_run(spark, lake, run.job_run_id)
    publish_view(log.observability(store.read_events(spark, lake)), "pipeline_observability")
    if config.catalog:
        catalog.publish(spark, config)
    return audit_row


def window_months(run: RunInfo) -> list[str]:
    """The months of a run's window."""
    first, last = (int(m[:4]) * 12 + int(m[5:7]) - 1 for m in (run.start_year_month, run.end_year_month))
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first, last + 1)]


@dataclass(frozen=True)
class Marts:
    consumption: DataFrame
    location_pairs: DataFrame
    monthly_avg_total_amount: DataFrame
    hourly_avg_passenger_count: DataFrame
    flow_matrix: DataFrame


def build_marts(
    silver: DataFrame,
    audit: DataFrame,
    dim: DataFrame,
    hourly_month: str = "2023-05",
    dim_bytes: int | None = None,
) -> Marts:
    """The marts as lazy frames over the latest complete run's window.

    ``dim_bytes`` is the dimension's size, if it is known; else it is measured here.

    Raises if no run is complete: an empty mart would look like an answer.
    """
    runs.require_complete_run(audit)
    trips = marts.trips_in_window(silver, audit)
    return Marts(
        consumption=marts.consumption(trips, dim, dim_bytes),
        location_pairs=marts.location_pairs(trips),
        monthly_avg_total_amount=marts.monthly_avg_total_amount(trips),
        hourly_avg_passenger_count=marts.hourly_avg_passenger_count(trips, hourly_month),
        flow_matrix=marts.flow_matrix(trips, dim, dim_bytes),
    )


def run_checks(
    silver: DataFrame,
    built: Marts,
    dim: DataFrame,
    now: Column | None = None,
    dim_bytes: int | None = None,
) -> list[Row]:
    """Run every data test; raises :class:`~meterline.operators.checks.DataTestError`.

    The aggregated marts are tested several times over, so they are kept while the tests
    run (a lost executor only means computing its part again). Each costs one scan of the
    window; the flows and the two relationship tests share the location pairs.
    """
    pairs = built.location_pairs.persist()
    monthly = built.monthly_avg_total_amount.persist()
    hourly = built.hourly_avg_passenger_count.persist()
    kept = (pairs, monthly, hourly)
    try:
        flows = marts.flows_of_pairs(pairs, dim, dim_bytes)
        results = checks.trip_checks(
            silver, built.consumption, pairs, monthly, hourly, flows, dim, now
        )
        return checks.enforce(checks.summarize(results))
    finally:
        for frame in kept:
            frame.unpersist()


def run_modelling(
    spark: SparkSession,
    config: IngestConfig,
    dim_csv: str,
    hourly_month: str = "2023-05",
    now: Column | None = None,
) -> tuple[Marts, list[Row]]:
    """Load the dimension, publish the marts as session views, run the data tests."""
    session.pin(spark)
    lake = config.lake
    store.ensure(spark, lake)
    store.load_seed(read_csv_dimension(spark, dim_csv), lake.locations)
    dim = spark.read.schema(LOCATION_DDL).parquet(lake.locations)
    silver = store.read_silver(spark, lake, config.contract)
    size = store.seed_bytes(spark, lake.locations)
    built = build_marts(silver, store.read_audit(spark, lake), dim, hourly_month, size)
    for name, frame in vars(built).items():
        publish_view(frame, name)
    if config.catalog:
        catalog.publish(spark, config, hourly_month)
    return built, run_checks(silver, built, dim, now, size)
