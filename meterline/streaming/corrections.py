"""Months whose landing files have changed: read again, their old rows taken away.

The stream reads a file name once. Here the landing folder is held against the files on record
by path, length and modification time. A month is corrected if a file of it has changed, or has
gone while other files of the month are there. All its files are then read as one batch of its
own, which takes the place of everything read from the month before:

- raw rows lie in a folder per batch and file month; the month's old folders go;
- canonical rows lie by event month. A misdated row of the month may be in any, and what is
  recorded beside the table tells in which. Only those folders are read; their other rows are
  written with the new ones.

No other partition is read or written. The new batch is written aside and swapped in. Rule
counters of the rows taken away are logged as negative counts, so sums over a version's events
stay exact. If the driver is lost on the way, the month is still (or again) found corrected, and
the next call starts over.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline import lake as store
from meterline.functions.paths import extract_file_year_month
from meterline.lake import BATCH, FILE_PARTITION
from meterline.operators.conform import conform
from meterline.operators.rules import CAST_LOSS_RULE, Rule, raw_rules, rule_metrics
from meterline.sources.landing import landed_files
from meterline.sources.tables import follow
from meterline.streaming.events import emit, flow_events
from meterline.streaming.ingest import (
    IngestConfig,
    publish_batch,
    raw_entry,
    record_files,
    trips_entry,
    write_raw_batch,
    write_silver,
    write_sorted,
)


def landed_of(spark: SparkSession, config: IngestConfig, months: Iterable[str] | None) -> DataFrame:
    """``(path, length, modificationTime, year_month)`` of the files in the landing folder."""
    files = landed_files(spark, config.landing_dir, config.contract.file_pattern, months)
    month = extract_file_year_month("path", config.contract.file_pattern)
    return files.select(
        "path", "length", F.col("modification_time").alias("modificationTime"), month.alias("year_month")
    )


def corrected_months(
    spark: SparkSession, config: IngestConfig, months: Iterable[str] | None = None
) -> list[str]:
    """Months with files on record that the landing folder no longer has like this, while it has
    others of the month; of ``months`` only, if given (only their folders are listed then)."""
    here = landed_of(spark, config, months)
    known = store.read_ingested(spark, config.lake).where(F.col("year_month").isNotNull())
    if months is not None:
        known = known.where(F.col("year_month").isin(list(months)))
    same = ["path", "length", "modificationTime", "year_month"]
    known = known.withColumnRenamed("modified", "modificationTime").select(same)
    stale = known.join(here, same, "left_anti").select("year_month").distinct()
    found = stale.join(here.select("year_month").distinct(), "year_month").orderBy("year_month")
    return [r["year_month"] for r in found.collect()]


def replace_months(
    spark: SparkSession, config: IngestConfig, update_id: str, months: Iterable[str] | None = None
) -> list[str]:
    """Replace every corrected month (of ``months``, if given); returns those replaced."""
    lake = config.lake
    store.ensure(spark, lake)
    store.finish_swaps(spark, lake)
    bronze, silver = (store.current_version(spark, lake, t) for t in ("bronze", "silver"))
    corrected = corrected_months(spark, config, months)
    if not corrected:
        return []
    raw_root, root = lake.bronze(bronze, "data"), lake.silver(silver)
    batch = store.next_rewrite(spark, raw_root, root)
    files = landed_of(spark, config, months).where(F.col("year_month").isin(corrected))

    old_raw = [
        path
        for folder in store.subfolders(spark, raw_root)
        for path in (f"{folder}/{FILE_PARTITION}={m}" for m in corrected)
        if store.exists(spark, path)
    ]
    old = event_folders(spark, config, silver, corrected)
    taken = _taken_away(spark, config, bronze, silver, batch, old_raw, update_id) if old_raw else []
    events = write_raw_batch(spark, config, bronze, batch, files, update_id, staged=True)
    events += write_silver(spark, config, bronze, silver, update_id, batch, staged=True)
    if old:
        rest = store.read_silver(spark, lake, config.contract, silver, old)
        rest = rest.where(~F.coalesce(F.col(config.contract.file_month).isin(corrected), F.lit(False)))
        write_sorted(
            config,
            store.rebalance(rest, config.contract.event_month),
            f"{lake.staged('silver', silver)}/{BATCH}={batch}",
            [config.contract.event_month],
            "append",
        )
    store.write_months(spark, lake, config.contract, silver, batch, staged=True)
    emit(spark, lake, f"v{bronze}-{batch}", taken + events, update_id)
    store.swap(
        spark,
        lake,
        old_raw + old,
        [
            (f"{lake.staged('bronze', bronze)}/{BATCH}={batch}", f"{raw_root}/{BATCH}={batch}"),
            (f"{lake.staged('silver', silver)}/{BATCH}={batch}", f"{root}/{BATCH}={batch}"),
        ],
    )
    record_files(config, bronze, batch, files)
    follow(spark, raw_entry(config, bronze), raw_root, old_raw, ())
    follow(spark, trips_entry(config, silver), root, old, ())
    publish_batch(spark, config, bronze, silver, batch)
    return corrected


def event_folders(spark: SparkSession, config: IngestConfig, version: int, months: list[str]) -> list[str]:
    """Folders of the canonical table that hold rows from files of ``months``."""
    held = store.read_months(spark, config.lake, version).where(F.col("file_month").isin(months))
    pairs = held.select(BATCH, "event_month").distinct().orderBy(BATCH, "event_month").collect()
    names = [
        f"{BATCH}={r[BATCH]}/{config.contract.event_month}={r['event_month'] or '__HIVE_DEFAULT_PARTITION__'}"
        for r in pairs
    ]
    return [p for p in (config.lake.silver(version, n) for n in names) if store.exists(spark, p)]


def _taken_away(
    spark: SparkSession, config: IngestConfig, bronze: int, silver: int, batch: int, paths: list[str], update_id: str
) -> list:
    """Events with negative counts of the raw rows below ``paths``, by the rules of both tables."""
    rows = store.read_bronze(spark, config.lake, bronze, paths=paths)
    canonical = conform(rows, config.contract, track_cast_loss=True)
    out = []
    for flow, version, frame, rules in (
        ("bronze", bronze, rows, raw_rules(config.contract)),
        ("silver", silver, canonical, config.rules + CAST_LOSS_RULE),
    ):
        n, metrics = counted(frame, rules)
        negative = [
            {**m, "passed_records": -m["passed_records"], "failed_records": -m["failed_records"]} for m in metrics
        ]
        out += flow_events(flow, version, batch, -n, negative, update_id, part="removed")
    return out


def counted(df: DataFrame, rules: tuple[Rule, ...]) -> tuple[int, list[dict]]:
    """Rows of a frame and its rule counters, by one aggregate."""
    rows = rule_metrics(df, rules).collect()
    metrics = [
        {
            "name": r["rule"],
            "severity": r["severity"],
            "passed_records": r["passed_records"],
            "failed_records": r["failed_records"],
        }
        for r in rows
    ]
    return (metrics[0]["passed_records"] + metrics[0]["failed_records"] if metrics else 0), metrics
