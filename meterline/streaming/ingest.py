"""Incremental ingest: new landing files to the raw table and on to the canonical table.

One available-now stream discovers files. Its checkpoint is the only record of what has
been seen; a file name seen once is not read again (``corrections`` replaces months whose
files have changed). Each micro-batch writes its raw and its canonical rows to folders named
after the batch, so replaying a batch after a failure replaces its output and nothing is
doubled or lost.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterline import lake as store
from meterline.contract import TRIPS, SchemaContractError, TableContract
from meterline.lake import BATCH, FILE_PARTITION, Lake
from meterline.functions.paths import extract_file_year_month
from meterline.operators.conform import CAST_LOSS_COLUMN, conform
from meterline.operators.rules import (
    CAST_LOSS_RULE,
    ROWS_METRIC,
    TRIP_RULES,
    Rule,
    apply_rules,
    observe_rules,
    observed_metrics,
    raw_rules,
    reasons,
)
from meterline.sources.drifted import evolve, scan_drifted
from meterline.sources.footers import FileSchema, file_schemas
from meterline.sources.tables import follow
from meterline.streaming.events import REQUIRED_COLUMNS, emit, event, failure, flow_events

# The file source forgets files this much older than the newest one; files may come with
# their old modification times, so no file may ever be too old.
MAX_FILE_AGE = "36500d"


@dataclass(frozen=True)
class IngestConfig:
    """``max_files_per_batch`` bounds what one micro-batch plans on the driver.

    Canonical rows that are not of their file's month are rebalanced by month before they are
    written, which keeps misdated rows from leaving tails of tiny files. ``clustered_files`` leaves that shuffle out, for
    landing files known to hold the rows of few months each.

    A file without a required column is reported as an event; ``refuse_missing`` makes it
    an error.

    ``bounds`` widens unanchored columns to the least type for their own and a file's values
    (a long and a double to a double) instead of rescuing what is retyped. Batches written
    before are cast when they are read; a registered raw table cannot do that, so it is not
    for use with ``catalog`` where such columns drift after the first batch.

    ``quarantine`` keeps the rows that drop rules refuse, with their reasons, in a table beside
    the canonical one (``lake.read_refused``), written in the same pass.

    ``order`` names canonical columns by which rows are sorted inside the files of a month, so
    that a filter on them skips row groups (of ``row_group_bytes``); compaction also cuts large
    months into files by them. Put a column with many values last: it cuts the hot values of
    those before it.

    ``catalog`` names the schema under which the tables are registered, if any: batches,
    corrections and compaction then add and drop partitions there as they publish them.
    """

    landing_dir: str
    lake: Lake
    contract: TableContract = TRIPS
    rules: tuple[Rule, ...] = TRIP_RULES
    max_files_per_batch: int = 5_000
    clustered_files: bool = False
    refuse_missing: bool = False
    catalog: str | None = None
    bounds: bool = False
    quarantine: bool = False
    order: tuple[str, ...] = ()
    row_group_bytes: int = store.ROW_GROUP_BYTES


def raw_entry(config: IngestConfig, version: int) -> str | None:
    """The raw table's name in the catalog."""
    return f"{config.catalog}.raw_v{version}" if config.catalog else None


def trips_entry(config: IngestConfig, version: int) -> str | None:
    """The canonical table's name in the catalog; readers use the view ``trips`` over it."""
    return f"{config.catalog}.trips_v{version}" if config.catalog else None


def discover(spark: SparkSession, config: IngestConfig) -> DataFrame:
    """Stream of landing files not seen before: listing only, contents are never selected."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("maxFileAge", MAX_FILE_AGE)
        .option("maxFilesPerTrigger", config.max_files_per_batch)
        .load(config.landing_dir)
        .select("path", "modificationTime", "length")
    )


def write_raw_batch(
    spark: SparkSession,
    config: IngestConfig,
    version: int,
    batch_id: int,
    files: DataFrame,
    update_id: str,
    staged: bool = False,
) -> list[Column]:
    """Append one batch of files to the raw table; returns the events of the write.

    A ``staged`` batch is written aside, and its files are not recorded yet.
    """
    found = file_schemas(spark, files)
    if not found:
        return []
    lake, contract = config.lake, config.contract
    warnings = missing_required(config, found, update_id)
    anchors = contract.hint_schema()
    before = store.bronze_schema(spark, lake, version, before=batch_id)
    schema = evolve(before, anchors.fieldNames(), [f.schema for f in found], config.bounds)
    # A required column that no file has ever had leaves nothing to fill in.
    contract.validate_required_columns(schema.fieldNames(), case_sensitive=False)
    raw = scan_drifted(spark, schema, anchors.fieldNames(), found, config.bounds)
    rules = raw_rules(contract)
    seen = Observation()
    data = lake.staged("bronze", version) if staged else lake.bronze(version, "data")
    month = extract_file_year_month("_source_file_path", contract.file_pattern)
    rows = observe_rules(raw, rules, seen).withColumn(FILE_PARTITION, month)
    store.write_by_month(rows, f"{data}/{BATCH}={batch_id}", [FILE_PARTITION])
    if schema != before:  # a replay finds the same files and comes to the same schema
        store.write_bronze_schema(spark, lake, version, batch_id, schema)
    if not staged:
        record_files(config, version, batch_id, files)
    counts = seen.get
    return warnings + flow_events(
        "bronze",
        version,
        batch_id,
        counts[ROWS_METRIC],
        observed_metrics(rules, counts),
        update_id,
        num_input_files=len(found),
        num_input_bytes=sum(f.length for f in found),
    )


def record_files(config: IngestConfig, version: int, batch_id: int, files: DataFrame) -> None:
    month = extract_file_year_month("path", config.contract.file_pattern)
    store.write_ingested(config.lake, version, batch_id, files, month)


def missing_required(
    config: IngestConfig, files: list[FileSchema], update_id: str
) -> list[Column]:
    """An event that names the files of a batch that lack required columns, if any do.

    Each file's own columns count: the table's schema starts with the anchored columns and
    never shrinks, so it cannot tell.
    """
    lacking = {f.path: config.contract.missing_columns(f.schema.fieldNames()) for f in files}
    lacking = {path: names for path, names in lacking.items() if names}
    if not lacking:
        return []
    text = "; ".join(f"{path}: {', '.join(names)}" for path, names in lacking.items())
    if config.refuse_missing:
        raise SchemaContractError(f"missing required columns: {text}")
    listed = [{"path": path, "missing": list(names)} for path, names in lacking.items()]
    message = f"{len(lacking)} files lack required columns"
    return [event(REQUIRED_COLUMNS, message, {"flow": "bronze", "files": listed}, update_id)]


def write_silver(
    spark: SparkSession,
    config: IngestConfig,
    bronze_version: int,
    silver_version: int,
    update_id: str,
    batch_id: int | None = None,
    staged: bool = False,
) -> list[Column]:
    """Canonical rows of one batch, or of the whole raw table, in a single pass; returns the
    events of the write. A ``staged`` batch is read from and written aside.

    Any shuffle comes before the counters: they then sit in the stage that writes, where a
    retried task is counted once.
    """
    lake, contract = config.lake, config.contract
    # A batch's raw rows were parted just now by the month that their path tells.
    parted = batch_id is not None
    bronze = store.read_bronze(spark, lake, bronze_version, batch_id, staged, file_month=parted)
    month = F.col(FILE_PARTITION) if parted else None
    rows = conform(bronze, contract, track_cast_loss=True, keep=(BATCH,), file_month=month)
    if not config.clustered_files:
        rows = _clustered(config, rows)
    rules = config.rules + CAST_LOSS_RULE
    seen = Observation()
    keys = [contract.event_month] if batch_id is not None else [BATCH, contract.event_month]
    data = lake.staged("silver", silver_version) if staged else lake.silver(silver_version)
    target = data if batch_id is None else f"{data}/{BATCH}={batch_id}"
    if config.quarantine:
        refused = lake.refused(silver_version)
        refused = refused if batch_id is None else f"{refused}/{BATCH}={batch_id}"
        _write_sides(spark, observe_rules(rows, rules, seen), config, silver_version, keys, target, refused)
    else:
        kept = apply_rules(rows, rules, seen).drop(CAST_LOSS_COLUMN)
        kept = kept if batch_id is None else kept.drop(BATCH)
        write_sorted(config, kept, target, keys)
    if not staged:
        store.write_months(spark, lake, contract, silver_version, batch_id)
    counts = seen.get
    return flow_events(
        "silver",
        silver_version,
        batch_id,
        counts[ROWS_METRIC],
        observed_metrics(rules, counts),
        update_id,
    )


def _clustered(config: IngestConfig, rows: DataFrame) -> DataFrame:
    """Canonical rows so that a task holds few months.

    Raw files hold one file month each, so rows of their file's month are clustered already, and
    only others are shuffled. With ``order`` all are, as tasks of a file's size would spill when
    they are sorted.
    """
    keys = (BATCH, config.contract.event_month)
    if config.order:
        return store.rebalance(rows, *keys)
    month, file_month = config.contract.event_month, F.col(config.contract.file_month)
    return store.rebalance_others(rows, F.col(month) == file_month, *keys, known={month: file_month})


def write_sorted(
    config: IngestConfig, rows: DataFrame, path: str, keys: list[str], mode: str = "overwrite"
) -> None:
    """Write canonical rows by partition, in the order the config asks for."""
    store.write_by_month(rows, path, keys, mode, config.order, config.row_group_bytes)


_SIDE = "_side"


def _write_sides(
    spark: SparkSession,
    rows: DataFrame,
    config: IngestConfig,
    version: int,
    keys: list[str],
    target: str,
    refused: str,
) -> None:
    """Write rows that stay to ``target`` and others, with their reasons, to ``refused``.

    One pass writes both sides aside, by partition; their folders are then moved to their
    places. A replay does the same again.
    """
    lake, why = config.lake, reasons(config.rules)
    sides = (
        rows.withColumn(store.REASONS, why)
        .withColumn(_SIDE, F.when(F.size(store.REASONS) == 0, "kept").otherwise("refused"))
        .drop(CAST_LOSS_COLUMN)
    )
    sides = sides if BATCH in keys else sides.drop(BATCH)
    aside = f"{lake.staged('sides', version)}/{target.rsplit('/', 1)[1]}"
    write_sorted(config, sides, aside, [_SIDE, *keys])
    for side, where in (("kept", target), ("refused", refused)):
        store.delete(spark, where)
        if store.exists(spark, f"{aside}/{_SIDE}={side}"):
            store.move(spark, f"{aside}/{_SIDE}={side}", where)
        else:
            store.make_folder(spark, where)
    store.delete(spark, aside)


def ingest(
    spark: SparkSession,
    config: IngestConfig,
    update_id: str,
    full_refresh: bool = False,
) -> dict[str, int]:
    """Process the backlog once and stop; returns the table versions written to.

    ``full_refresh`` reads every file again into new table versions, under a new
    checkpoint, and publishes them when done; until then readers keep the old ones.
    """
    lake = config.lake
    store.ensure(spark, lake)
    store.finish_swaps(spark, lake)
    bronze_version = store.current_version(spark, lake, "bronze")
    silver_version = store.current_version(spark, lake, "silver")
    if full_refresh:
        bronze_version = store.start_version(spark, lake, "bronze")
        silver_version = store.start_version(spark, lake, "silver")
    store.start_bronze_schema(spark, lake, bronze_version, config.contract.hint_schema())

    def process(files: DataFrame, batch_id: int) -> None:
        files = not_corrected(spark, config, bronze_version, batch_id, files)
        done: list[Column] = []
        flow, version = "bronze", bronze_version
        try:
            done += write_raw_batch(spark, config, bronze_version, batch_id, files, update_id)
            if done:
                flow, version = "silver", silver_version
                done += write_silver(
                    spark, config, bronze_version, silver_version, update_id, batch_id
                )
                publish_batch(spark, config, bronze_version, silver_version, batch_id)
        except Exception as error:
            # A failed update leaves its progress, too; the replay's counters replace it.
            done.append(failure(flow, version, batch_id, error, update_id))
            raise
        finally:
            if done:
                emit(spark, lake, f"v{bronze_version}-{batch_id}", done, update_id)

    query = (
        discover(spark, config)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", lake.bronze(bronze_version, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if full_refresh:
        store.publish_version(spark, lake, "bronze", bronze_version)
        store.publish_version(spark, lake, "silver", silver_version)
    return {"bronze": bronze_version, "silver": silver_version}


def publish_batch(
    spark: SparkSession, config: IngestConfig, bronze_version: int, silver_version: int, batch_id: int
) -> None:
    """Add a batch's partitions to the registered tables, if there are any."""
    if not config.catalog:
        return
    for entry, root in (
        (raw_entry(config, bronze_version), config.lake.bronze(bronze_version, "data")),
        (trips_entry(config, silver_version), config.lake.silver(silver_version)),
    ):
        follow(spark, entry, root, (), store.subfolders(spark, f"{root}/{BATCH}={batch_id}"))


def not_corrected(
    spark: SparkSession, config: IngestConfig, version: int, batch_id: int, files: DataFrame
) -> DataFrame:
    """``files`` without those that a correction has read before the stream found them."""
    known = store.read_ingested(spark, config.lake, version)
    known = known.where((F.col(BATCH) >= 1 << store.REWRITE) & (F.col(BATCH) != batch_id))
    known = known.select("path", "length", F.col("modified").alias("modificationTime"))
    return files.join(known, ["path", "length", "modificationTime"], "left_anti")


def rebuild_silver(spark: SparkSession, config: IngestConfig, update_id: str) -> int:
    """Recompute the canonical table from all raw rows as a new version, then publish it."""
    lake = config.lake
    bronze_version = store.current_version(spark, lake, "bronze")
    version = store.start_version(spark, lake, "silver")
    done = write_silver(spark, config, bronze_version, version, update_id)
    emit(spark, lake, f"rebuild-v{version}", done, update_id)
    store.publish_version(spark, lake, "silver", version)
    return version

