"""The run-event log: what each update did, and the observability view over it."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.lake import Lake

CREATE_UPDATE = "create_update"
FLOW_PROGRESS = "flow_progress"
EXPECTATION_METRICS = "expectation_metrics"
PIPELINE_DONE = "pipeline_done"
COMPLETED, FAILED = "COMPLETED", "FAILED"
REQUIRED_COLUMNS = "required_columns"
# Fixed value: event types the observability view keeps.
OBSERVED_EVENTS = (FLOW_PROGRESS, EXPECTATION_METRICS, PIPELINE_DONE)


def event(event_type: str, message: str, details: dict, update_id: str) -> Column:
    """One event as a literal struct with the fields of ``EVENT_DDL``."""
    return F.struct(
        F.lit(datetime.now(timezone.utc)).cast("timestamp").alias("timestamp"),
        F.lit(event_type).alias("event_type"),
        F.lit(message).alias("message"),
        F.lit(json.dumps(details)).alias("details"),
        F.struct(F.lit(update_id).alias("update_id")).alias("origin"),
    )


def emit(
    spark: SparkSession, lake: Lake, key: str, events: Sequence[Column], update_id: str
) -> None:
    """Write a handful of events of an update under ``key``.

    The same update replaces its own events. A batch replayed by a later update is logged
    again; readers that add up take the newest event of each write (see ``settled``).
    """
    rows = spark.range(1).select(F.explode(F.array(*events)).alias("e")).select("e.*")
    rows.coalesce(1).write.mode("overwrite").parquet(
        f"{lake.events}/update_id={update_id}/key={key}"
    )


def flow_events(
    flow: str,
    version: int,
    batch_id: int | None,
    rows: int,
    metrics: list[dict],
    update_id: str,
    part: str | None = None,
    **volume: int,
) -> list[Column]:
    """Row count, input volume and rule counters of one write.

    ``part`` tells apart what one batch logs of a flow more than once, such as the rows it
    takes away (with negative counts) beside those it brings.
    """
    where = _write(flow, version, batch_id, part)
    return [
        event(
            FLOW_PROGRESS,
            f"{flow}: {rows} rows",
            {**where, "status": COMPLETED, "num_output_rows": rows, **volume},
            update_id,
        ),
        event(
            EXPECTATION_METRICS,
            f"{flow}: {len(metrics)} rules",
            {**where, "expectations": metrics},
            update_id,
        ),
    ]


def _write(flow: str, version: int, batch_id: int | None, part: str | None = None) -> dict:
    """What names a write in the details of its events."""
    named = {"flow": flow, "version": version, "batch_id": batch_id, "part": part}
    return {k: v for k, v in named.items() if v is not None}


def failure(flow: str, version: int, batch_id: int, error: Exception, update_id: str) -> Column:
    """The progress event of a write that did not end."""
    text = f"{type(error).__name__}: {error}"[:2000]
    where = _write(flow, version, batch_id)
    details = {**where, "status": FAILED, "error": text}
    return event(FLOW_PROGRESS, f"{flow}: failed", details, update_id)


def settled(events: DataFrame, event_type: str) -> DataFrame:
    """``(update_id, flow, version, batch_id, part, details)``: the newest event of each write.

    If an update is lost after it logged a batch and before the batch is committed, the next
    one writes and logs the batch again. Its data has replaced the older data, so its event
    replaces the older event. Writes that failed have no say.
    """
    of = events.where(F.col("event_type") == event_type).select(
        "timestamp",
        F.col("origin.update_id").alias("update_id"),
        "details",
        *[
            F.get_json_object("details", f"$.{k}").cast(kind).alias(k)
            for k, kind in (("flow", "string"), ("version", "int"), ("batch_id", "long"), ("part", "string"))
        ],
    )
    ended = F.coalesce(F.get_json_object("details", "$.status"), F.lit(COMPLETED)) == COMPLETED
    return (
        of.where(ended)
        .groupBy("flow", "version", "batch_id", "part")
        .agg(
            F.max_by(
                F.struct("update_id", "details"), F.struct("timestamp", "update_id", "details")
            ).alias("e")
        )
        .select("e.update_id", "flow", "version", "batch_id", "part", "e.details")
    )


def observability(events: DataFrame) -> DataFrame:
    """Flow progress, rule metrics and final states, newest first."""
    return (
        events.where(F.col("event_type").isin(*OBSERVED_EVENTS))
        .select("timestamp", "event_type", "message", "details")
        .orderBy(F.desc("timestamp"))
    )


def latest_update_id(events: DataFrame) -> DataFrame:
    """``update_id`` of the newest update: one row, or none."""
    return (
        events.where(F.col("event_type") == CREATE_UPDATE)
        .orderBy(F.desc("timestamp"), F.desc("origin.update_id"))
        .limit(1)
        .select(F.col("origin.update_id").alias("update_id"))
    )


def input_volume(events: DataFrame, flow: str) -> DataFrame:
    """Files and bytes a flow has read over all its writes, replays counted once: one row."""

    def number(name: str) -> Column:
        return F.get_json_object("details", f"$.{name}").cast("long")

    return settled(events, FLOW_PROGRESS).where(F.col("flow") == flow).agg(
        F.sum(number("num_input_files")).alias("files"),
        F.sum(number("num_input_bytes")).alias("bytes"),
    )


EXPECTATION_TYPE = (
    "ARRAY<STRUCT<name: STRING, severity: STRING, passed_records: BIGINT, failed_records: BIGINT>>"
)


def update_counters(events: DataFrame) -> DataFrame:
    """Rule counters by update and table version, each write under the update that settled it:
    ``(update_id, flow, version, rule, severity, passed_records, failed_records)``."""
    parsed = settled(events, EXPECTATION_METRICS).select(
        "update_id",
        "flow",
        "version",
        F.explode(
            F.from_json(F.get_json_object("details", "$.expectations"), EXPECTATION_TYPE)
        ).alias("m"),
    )
    keys = ["update_id", "flow", "version"]
    return parsed.groupBy(
        *keys, F.col("m.name").alias("rule"), F.col("m.severity").alias("severity")
    ).agg(
        F.sum("m.passed_records").alias("passed_records"),
        F.sum("m.failed_records").alias("failed_records"),
    )


def rule_counters(events: DataFrame, versions: Mapping[str, int]) -> DataFrame:
    """Rule counters of the given version of each flow's table, over all its updates:
    ``(flow, rule, severity, passed_records, failed_records)``.

    Versions before, or under construction, count rows of their own and are left out.
    """
    wanted = F.lit(False)
    for flow, version in versions.items():
        wanted = wanted | ((F.col("flow") == flow) & (F.col("version") == version))
    return (
        update_counters(events)
        .where(wanted)
        .groupBy("flow", "rule", "severity")
        .agg(
            F.sum("passed_records").alias("passed_records"),
            F.sum("failed_records").alias("failed_records"),
        )
    )


LACKING_TYPE = "ARRAY<STRUCT<path: STRING, missing: ARRAY<STRING>>>"


def lacking_columns(events: DataFrame) -> DataFrame:
    """``(update_id, path, missing)``: each required column that an ingested file lacked."""
    files = events.where(F.col("event_type") == REQUIRED_COLUMNS).select(
        F.col("origin.update_id").alias("update_id"),
        F.explode(
            F.from_json(F.get_json_object("details", "$.files"), LACKING_TYPE)
        ).alias("f"),
    )
    return files.select("update_id", "f.path", F.explode("f.missing").alias("missing"))
