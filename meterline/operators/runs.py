"""Run audit: collapse month outcomes to one row per run, fill in late, pick the latest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.months import expand_window, is_year_month
from meterline.functions.outcomes import (
    MONTH_STATUSES,
    PROBE_STATUSES,
    SOURCE_MODES,
    in_domain,
    require_in,
)

_MONTHS = T.ArrayType(T.StringType(), containsNull=False)

PROBE_TYPE = T.StructType(
    [
        T.StructField("month", T.StringType(), False),
        T.StructField("probe_status", T.StringType(), False),
        T.StructField("http_code", T.IntegerType(), True),
    ]
)

# Columns, order and nullability of the run audit.
LANDING_AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("job_run_id", T.StringType(), False),
        T.StructField("job_url", T.StringType(), False),
        T.StructField("pipeline_update_id", T.StringType(), True),
        T.StructField("job_start_ts", T.TimestampType(), False),
        T.StructField("job_end_ts", T.TimestampType(), False),
        T.StructField("source_mode", T.StringType(), False),
        T.StructField("probe_results", T.ArrayType(PROBE_TYPE, containsNull=False), False),
        T.StructField("start_year_month", T.StringType(), False),
        T.StructField("end_year_month", T.StringType(), False),
        T.StructField("months_requested", _MONTHS, False),
        T.StructField("months_downloaded", _MONTHS, False),
        T.StructField("months_skipped", _MONTHS, False),
        T.StructField("months_failed", _MONTHS, False),
        T.StructField("bytes_downloaded", T.LongType(), False),
        T.StructField("bytes_total_in_volume", T.LongType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("error_message", T.StringType(), True),
    ]
)
LANDING_AUDIT_COLUMNS = tuple(LANDING_AUDIT_SCHEMA.fieldNames())

# The texts kept in error_message.
ALL_FAILED_TEXT = "all months failed probe/download: "
ALL_FAILED_HINT = ". outbound TLC bloqueado — vide README seção VOLUME_PREEXISTING"
SOME_FAILED_TEXT = "failed months: "


class NoCompleteRunError(RuntimeError):
    """No ingestion run has completed, so there is no active window."""


def run_status(months_failed: Column, landed_count: Column) -> Column:
    """SUCCESS without failures, FAILED when nothing landed, else PARTIAL."""
    return (
        F.when(F.size(months_failed) == 0, "SUCCESS")
        .when(landed_count == 0, "FAILED")
        .otherwise("PARTIAL")
    )


def run_message(months_failed: Column, status: Column) -> Column:
    names = F.array_join(months_failed, ", ")
    return F.when(
        status == "FAILED", F.concat(F.lit(ALL_FAILED_TEXT), names, F.lit(ALL_FAILED_HINT))
    ).when(status == "PARTIAL", F.concat(F.lit(SOME_FAILED_TEXT), names))


def judged_outcomes(outcomes: DataFrame) -> DataFrame:
    """``outcomes`` with ``_reasons``: which of their values are outside their domain.

    Rows without reasons are fit for :func:`collapse_runs`, which refuses all others by an
    error; written by ``_reasons``, both sides are kept in one pass.
    """
    tests = (
        ("status", in_domain("status", MONTH_STATUSES)),
        ("probe_status", in_domain("probe_status", PROBE_STATUSES)),
        ("month", F.coalesce(is_year_month("month"), F.lit(False))),
    )
    named = [
        F.when(~ok, F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit("NULL"))))
        for c, ok in tests
    ]
    return outcomes.withColumn("_reasons", F.filter(F.array(*named), lambda r: r.isNotNull()))


def collapse_runs(runs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One audit row per run.

    ``runs``: run_id, job_run_id, job_url, job_start_ts, job_end_ts, source_mode,
    start_year_month, end_year_month[, pipeline_update_id].
    ``outcomes``: run_id, seq, month, status, bytes_downloaded, bytes_in_volume,
    probe_status, http_code; ``seq`` orders repeated outcomes of a month, the last wins.

    Repeats are folded per (run, month) with a map-side combine, so a run holding a
    large share of the outcomes reaches its group as at most one entry per month of its
    window. Months outside the window do not count; a run without any outcome is an error.
    """
    checked = outcomes.select(
        "run_id",
        "seq",
        "month",
        require_in("status", MONTH_STATUSES, "month status").alias("status"),
        F.col("bytes_downloaded").cast("long").alias("bytes_downloaded"),
        F.col("bytes_in_volume").cast("long").alias("bytes_in_volume"),
        require_in("probe_status", PROBE_STATUSES, "probe_status").alias("probe_status"),
        F.col("http_code").cast("int").alias("http_code"),
    )
    payload = ["month", "status", "bytes_downloaded", "bytes_in_volume", "probe_status", "http_code"]
    per_month = (
        checked.groupBy("run_id", "month")
        .agg(F.max_by(F.struct(*payload), F.col("seq")).alias("o"))
        .select("run_id", "month", "o")
    )
    windows = runs.select("run_id", "start_year_month", "end_year_month")
    inside = is_year_month("month") & F.col("month").between(
        F.col("start_year_month"), F.col("end_year_month")
    )
    per_run = (
        per_month.join(windows, "run_id")
        .groupBy("run_id")
        .agg(F.array_sort(F.collect_list(F.when(inside, F.col("o")))).alias("ordered"))
    )

    def months_with(status: str) -> Column:
        picked = F.filter("ordered", lambda o: o["status"] == status)
        return F.transform(picked, lambda o: o["month"])

    def total(name: str) -> Column:
        return F.aggregate("ordered", F.lit(0).cast("long"), lambda acc, o: acc + o[name])

    update_id = (
        F.col("pipeline_update_id") if "pipeline_update_id" in runs.columns else F.lit(None)
    ).cast("string")
    found = F.when(
        F.col("ordered").isNull(),
        F.raise_error(F.concat(F.lit("a run needs at least one month outcome: "), F.col("run_id"))),
    ).otherwise(F.col("ordered"))
    collapsed = (
        runs.join(per_run, "run_id", "left")
        .withColumn("ordered", found)
        .withColumns(
            {
                "months_requested": expand_window("start_year_month", "end_year_month"),
                "months_downloaded": months_with("DOWNLOADED"),
                "months_skipped": months_with("SKIPPED_EXISTING"),
                "months_failed": months_with("FAILED"),
                "bytes_downloaded": total("bytes_downloaded"),
                "bytes_total_in_volume": total("bytes_in_volume"),
                "probe_results": F.transform(
                    "ordered",
                    lambda o: F.struct(
                        o["month"].alias("month"),
                        o["probe_status"].alias("probe_status"),
                        o["http_code"].alias("http_code"),
                    ),
                ),
                "pipeline_update_id": update_id,
                "source_mode": require_in("source_mode", SOURCE_MODES, "source_mode"),
            }
        )
        .withColumn(
            "status",
            run_status(
                F.col("months_failed"), F.size("months_downloaded") + F.size("months_skipped")
            ),
        )
        .withColumn("error_message", run_message(F.col("months_failed"), F.col("status")))
    )
    return collapsed.select(*LANDING_AUDIT_COLUMNS)


AUDIT_KEY = ("run_id", "job_run_id", "job_start_ts")


def with_completions(audit: DataFrame, completions: DataFrame) -> DataFrame:
    """The audit with late-filled update ids.

    ``completions`` is append-only: AUDIT_KEY, pipeline_update_id, completed_ts. A row
    that already has an id keeps it; otherwise its first completion counts.
    """
    first = completions.groupBy(*AUDIT_KEY).agg(
        F.min_by(
            "pipeline_update_id", F.struct("completed_ts", "pipeline_update_id")
        ).alias("_filled_id")
    )
    return (
        audit.join(first, list(AUDIT_KEY), "left")
        .withColumn("pipeline_update_id", F.coalesce("pipeline_update_id", "_filled_id"))
        .select(*audit.columns)
    )


def pending_completion(
    audit: DataFrame, job_run_id: str | Column, update_id: str | Column, completed_ts: Column
) -> DataFrame:
    """Completion rows to append for one job run: only rows that still lack an id.

    An unknown key, or a repeated call, gives no rows.
    """
    key = F.lit(job_run_id) if isinstance(job_run_id, str) else job_run_id
    value = F.lit(update_id) if isinstance(update_id, str) else update_id
    return audit.where((F.col("job_run_id") == key) & F.col("pipeline_update_id").isNull()).select(
        *AUDIT_KEY,
        value.cast("string").alias("pipeline_update_id"),
        completed_ts.alias("completed_ts"),
    )


def complete_runs(audit: DataFrame) -> DataFrame:
    return audit.where(F.col("pipeline_update_id").isNotNull())


def latest_complete_run(audit: DataFrame) -> DataFrame:
    """The most recently started complete run: one row, or none.

    ``run_id`` breaks ties so that the answer does not depend on partitioning.
    """
    return complete_runs(audit).orderBy(F.desc("job_start_ts"), F.desc("run_id")).limit(1)


def count_complete_runs(audit: DataFrame) -> DataFrame:
    return complete_runs(audit).agg(F.count(F.lit(1)).alias("n"))


def require_complete_run(audit: DataFrame) -> None:
    """Raise unless at least one run completed; reads no more than it needs to know."""
    if complete_runs(audit).limit(1).count() == 0:
        raise NoCompleteRunError(
            "the run audit has no row with a pipeline_update_id, so no ingestion run is "
            "complete: run the ingestion job first, then build the marts again"
        )
