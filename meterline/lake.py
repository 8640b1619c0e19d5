"""Where the tables live, and how a table is read back.

Everything is plain parquet below one root on a shared file system. Tables that can be
rebuilt have numbered versions; readers follow the last published one, so they never see
a half-built table. Data written per micro-batch has a folder per batch, which a replayed
batch overwrites; below it the raw table is partitioned by the month of the file and the
canonical one by the month of the event. Corrections and compaction write batches of their
own and take the folders they replace away (see ``swap``).
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.contract import LINEAGE_COLUMNS, RESCUED_COLUMN, TableContract
from meterline.operators.marts import measured_bytes
from meterline.operators.runs import LANDING_AUDIT_SCHEMA, with_completions
from meterline.sources.drifted import readable

VERSION_DDL = "table STRING, version INT, state STRING, ts TIMESTAMP"
STARTED, PUBLISHED = "started", "published"
SCHEMA_DDL = "schema STRING, batch_id LONG"
INGESTED_DDL = "path STRING, length LONG, modified TIMESTAMP, year_month STRING"
MONTHS_DDL = "event_month STRING, file_month STRING, rows LONG"
SWAP_DDL = "source STRING, target STRING"
EVENT_DDL = (
    "timestamp TIMESTAMP, event_type STRING, message STRING, details STRING, "
    "origin STRUCT<update_id: STRING>"
)
COMPLETION_DDL = (
    "run_id STRING, job_run_id STRING, job_start_ts TIMESTAMP, "
    "pipeline_update_id STRING, completed_ts TIMESTAMP"
)
BATCH = "batch_id"
#: Partition column of the raw table: the month in the file's name.
FILE_PARTITION = "_file_month"
#: A batch that rewrites data is numbered (n << REWRITE) + the last batch of the stream before it.
REWRITE = 40
#: Row groups of files whose rows are sorted; about eight to a file.
ROW_GROUP_BYTES = 16 << 20
#: Folders that a task writes to at the same time, without sorting its rows by them. They share
#: the rows of one task, so what they buffer is bounded by these.
OPEN_FILES = 100
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
#: Tasks per core into which a scan that is written is cut, where its files are large enough. Rows
#: of few bytes each make tasks of 128 MB so long that some cores wait for the last of them.
TASKS_PER_CORE = 3
_MIN_TASKS = "spark.sql.files.minPartitionNum"


@dataclass(frozen=True)
class Lake:
    root: str

    def at(self, *parts: str | int) -> str:
        return "/".join([self.root.rstrip("/"), *[str(p) for p in parts]])

    def bronze(self, version: int, *parts: str | int) -> str:
        return self.at("bronze", f"v{version}", *parts)

    def silver(self, version: int, *parts: str | int) -> str:
        return self.at("silver", f"v{version}", *parts)

    def refused(self, version: int, *parts: str | int) -> str:
        """Rows that drop rules kept out of the canonical table."""
        return self.at("refused", f"v{version}", *parts)

    @property
    def refused_outcomes(self) -> str:
        return self.at("refused_outcomes")

    def months(self, version: int) -> str:
        """Which file months are in which event months of the canonical table, by batch."""
        return self.at("silver_months", f"v{version}")

    def staged(self, table: str, version: int) -> str:
        """Where rewritten data lies until it is swapped in; readers never look here."""
        return self.at("staged", table, f"v{version}")

    @property
    def swaps(self) -> str:
        return self.at("swaps")

    @property
    def versions(self) -> str:
        return self.at("versions")

    @property
    def events(self) -> str:
        return self.at("events")

    @property
    def audit(self) -> str:
        return self.at("audit")

    @property
    def completions(self) -> str:
        return self.at("completions")

    @property
    def locations(self) -> str:
        return self.at("dim_locations")


def ensure(spark: SparkSession, lake: Lake) -> None:
    """Create the bookkeeping tables that do not exist yet; existing ones stay untouched."""

    create_empty(spark, lake.versions, VERSION_DDL)
    create_empty(spark, lake.audit, LANDING_AUDIT_SCHEMA)
    create_empty(spark, lake.completions, COMPLETION_DDL)
    create_empty(spark, f"{lake.events}/update_id=none/key=none", EVENT_DDL)


def create_empty(spark: SparkSession, path: str, schema: str | T.StructType) -> None:
    """An empty table, unless there is one."""
    fields = T.StructType.fromDDL(schema).fields if isinstance(schema, str) else schema.fields
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    spark.range(0, 0, 1, 1).select(*none).write.mode("ignore").parquet(path)


def read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def _newest(spark: SparkSession, lake: Lake, table: str, *states: str) -> int:
    versions = read(spark, lake.versions, VERSION_DDL)
    wanted = versions.where((F.col("table") == table) & F.col("state").isin(*states))
    return int(wanted.agg(F.max("version")).first()[0] or 0)


def current_version(spark: SparkSession, lake: Lake, table: str) -> int:
    """Last published version of a table; 0 before the first publication."""
    return _newest(spark, lake, table, PUBLISHED)


def start_version(spark: SparkSession, lake: Lake, table: str) -> int:
    """A version number never used before, so an abandoned build leaves nothing behind."""
    version = _newest(spark, lake, table, STARTED, PUBLISHED) + 1
    _log_version(spark, lake, table, version, STARTED)
    return version


def publish_version(spark: SparkSession, lake: Lake, table: str, version: int) -> None:
    _log_version(spark, lake, table, version, PUBLISHED)


def _log_version(spark: SparkSession, lake: Lake, table: str, version: int, state: str) -> None:
    row = spark.range(1).select(
        F.lit(table).alias("table"),
        F.lit(version).cast("int").alias("version"),
        F.lit(state).alias("state"),
        F.current_timestamp().alias("ts"),
    )
    row.write.mode("append").parquet(lake.versions)


def write_bronze_schema(
    spark: SparkSession, lake: Lake, version: int, batch_id: int, schema: T.StructType
) -> None:
    row = spark.range(1).select(F.lit(schema.json()).alias("schema"))
    row.write.mode("overwrite").parquet(lake.bronze(version, "schema", f"{BATCH}={batch_id}"))


def start_bronze_schema(
    spark: SparkSession, lake: Lake, version: int, anchors: T.StructType
) -> None:
    """Record the anchored columns as the schema before the first batch, once."""
    row = spark.range(1).select(F.lit(anchors.json()).alias("schema"))
    row.write.mode("ignore").parquet(lake.bronze(version, "schema", f"{BATCH}=-1"))


def bronze_schema(
    spark: SparkSession, lake: Lake, version: int, before: int | None = None
) -> T.StructType:
    """Source columns of the raw table after the last batch (or the last before ``before``)."""
    known = read(spark, lake.bronze(version, "schema"), SCHEMA_DDL)
    if before is not None:
        known = known.where(position(F.col(BATCH)) < position(F.lit(before).cast("long")))
    last = known.orderBy(F.desc(position(F.col(BATCH)))).first()
    return T.StructType.fromJson(json.loads(last["schema"]))


def position(batch_id: Column) -> Column:
    """Orders batches by when they were written: rewrites follow the batch they came after."""
    stream = batch_id.bitwiseAND(F.lit((1 << REWRITE) - 1))
    return F.struct(F.when(batch_id < 0, batch_id).otherwise(stream).alias("stream"), F.shiftright(batch_id, REWRITE).alias("n"))


def next_rewrite(spark: SparkSession, *tables: str) -> int:
    """A number for a batch that rewrites data of the tables below these folders."""
    taken = [int(p.rsplit("=", 1)[1]) for t in tables for p in subfolders(spark, t) if f"/{BATCH}=" in p]
    taken = [b for b in taken if b >= 0]
    last = max((b & ((1 << REWRITE) - 1) for b in taken), default=0)
    return ((max((b >> REWRITE for b in taken), default=0) + 1) << REWRITE) + last


def bronze_table_schema(source: T.StructType) -> T.StructType:
    path, modified, ingested = LINEAGE_COLUMNS
    return T.StructType(
        source.fields
        + [
            T.StructField(RESCUED_COLUMN, T.StringType()),
            T.StructField(path, T.StringType()),
            T.StructField(modified, T.TimestampType()),
            T.StructField(ingested, T.TimestampType()),
            T.StructField(BATCH, T.LongType()),
        ]
    )


def read_bronze(
    spark: SparkSession,
    lake: Lake,
    version: int | None = None,
    batch_id: int | None = None,
    staged: bool = False,
    paths: Sequence[str] | None = None,
    file_month: bool = False,
) -> DataFrame:
    """The raw table, or one batch of it, of which only the batch's own folder is listed, or
    some partitions (``paths``); with its partition column if ``file_month`` is set.

    The schema is recorded at write time, so no footers are merged here; columns older
    batches lack are NULL and narrower ones are widened by the reader. Where a column has got
    a type that the reader cannot widen to, the batches before that are a scan of their own,
    with a cast: as many scans as there were such changes."""
    version = current_version(spark, lake, "bronze") if version is None else version
    data = lake.staged("bronze", version) if staged else lake.bronze(version, "data")
    where = list(paths or [data if batch_id is None else f"{data}/{BATCH}={batch_id}"])
    schemas = _bronze_schemas(spark, lake, version)
    table = bronze_table_schema(schemas[-1][1])
    groups: dict[str, list[str]] = {table.json(): where}
    if not staged and batch_id is None and any(_unlike(s, schemas[-1][1]) for _, s in schemas):
        groups = {}
        for path in paths or subfolders(spark, data):
            batch = int(path[len(data) :].split(f"{BATCH}=", 1)[1].split("/")[0])
            then = [s for b, s in schemas if _place(b) <= _place(batch)][-1]
            read_as = {f.name.lower(): f.dataType for f in _unlike(then, schemas[-1][1])}
            fields = [T.StructField(f.name, read_as.get(f.name.lower(), f.dataType)) for f in table.fields]
            groups.setdefault(T.StructType(fields).json(), []).append(path)
    scans = []
    for text, folders in groups.items():
        schema = T.StructType.fromJson(json.loads(text)).add(FILE_PARTITION, "string")
        rows = spark.read.schema(schema).option("basePath", data).parquet(*folders)
        columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in table.fields]
        scans.append(rows.select(*columns, *([FILE_PARTITION] if file_month else [])))
    return reduce(DataFrame.unionByName, scans)


def _place(batch_id: int) -> tuple[int, int]:
    """``position`` of a batch number."""
    return (batch_id if batch_id < 0 else batch_id & ((1 << REWRITE) - 1), batch_id >> REWRITE)


def _bronze_schemas(spark: SparkSession, lake: Lake, version: int) -> list[tuple[int, T.StructType]]:
    """The raw table's schemas in order, each with the batch that brought it."""
    rows = read(spark, lake.bronze(version, "schema"), SCHEMA_DDL).collect()
    found = [(r[BATCH], T.StructType.fromJson(json.loads(r["schema"]))) for r in rows]
    return sorted(found, key=lambda x: _place(x[0]))


def _unlike(old: T.StructType, new: T.StructType) -> list[T.StructField]:
    """Columns of ``old`` that the reader cannot read with their types in ``new``."""
    types = {f.name.lower(): f.dataType for f in new.fields}
    return [f for f in old.fields if not readable(f.dataType, types[f.name.lower()], False)]


def write_ingested(lake: Lake, version: int, batch_id: int, files: DataFrame, month: Column) -> None:
    """Record a batch's files and their months."""
    rows = files.select("path", "length", F.col("modificationTime").alias("modified"), month.alias("year_month"))
    rows.coalesce(1).write.mode("overwrite").parquet(lake.bronze(version, "files", f"{BATCH}={batch_id}"))


def read_ingested(spark: SparkSession, lake: Lake, version: int | None = None) -> DataFrame:
    """``(path, length, modified, year_month, batch_id)`` of the files that the raw table holds.

    A batch that corrected a month names all files of the month; what was read of it before
    is no longer in the table."""
    version = current_version(spark, lake, "bronze") if version is None else version
    path = lake.bronze(version, "files")
    create_empty(spark, f"{path}/{BATCH}=-1", INGESTED_DDL)
    files = read(spark, path, f"{INGESTED_DDL}, {BATCH} LONG").withColumn("at", position(F.col(BATCH)))
    corrected = F.when(F.col("at.n") > 0, F.col("at"))
    # One row per file of a month, so a month's group is as large as its folder.
    last = F.max(corrected).over(Window.partitionBy("year_month"))
    kept = files.withColumn("last", last).where(F.col("last").isNull() | (F.col("at") >= F.col("last")))
    return kept.select("path", "length", "modified", "year_month", BATCH)


def write_months(
    spark: SparkSession, lake: Lake, contract: TableContract, version: int, batch_id: int | None = None,
    staged: bool = False,
) -> None:
    """Record which file months the event months of a batch (or of all batches) hold.

    Reads one column of what was just written; corrections find the folders of a month by it.
    """
    data = lake.staged("silver", version) if staged else lake.silver(version)
    columns = f"{contract.file_month} STRING, {contract.event_month} STRING, {BATCH} LONG"
    where = data if batch_id is None else f"{data}/{BATCH}={batch_id}"
    rows = spark.read.schema(columns).option("basePath", data).parquet(where)
    found = rows.groupBy(
        BATCH, F.col(contract.event_month).alias("event_month"), F.col(contract.file_month).alias("file_month")
    ).agg(F.count(F.lit(1)).alias("rows"))
    writer = found.drop(BATCH).coalesce(1).write if batch_id is not None else found.write.partitionBy(BATCH)
    target = lake.months(version)
    writer.mode("overwrite").parquet(target if batch_id is None else f"{target}/{BATCH}={batch_id}")


def read_months(spark: SparkSession, lake: Lake, version: int) -> DataFrame:
    """``(batch_id, event_month, file_month, rows)``; batches whose folders are gone may still
    be listed."""
    create_empty(spark, f"{lake.months(version)}/{BATCH}=-1", MONTHS_DDL)
    return read(spark, lake.months(version), f"{MONTHS_DDL}, {BATCH} LONG")


# --- folders -------------------------------------------------------------------------------


def _store(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """The folders right below ``path``; none if it does not exist."""
    fs, where = _store(spark, path)
    if not fs.exists(where):
        return []
    return sorted(f"{path}/{s.getPath().getName()}" for s in fs.listStatus(where) if s.isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _store(spark, path)
    return fs.exists(where)


def make_folder(spark: SparkSession, path: str) -> None:
    """Make an empty folder, unless there is one."""
    fs, where = _store(spark, path)
    fs.mkdirs(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _store(spark, path)
    fs.delete(where, True)


def swap(spark: SparkSession, lake: Lake, gone: Sequence[str], staged: Sequence[tuple[str, str]]) -> None:
    """Take folders away and move ``staged`` ones (source, target) in their place.

    What is to be done is written down first, so that a swap cut short is finished by the
    next writer (``finish_swaps``): targets are new folders, and each step may be repeated.
    A reader that listed a folder before it went is to be run again.
    """
    rows = [(None, path) for path in gone] + list(staged)
    plan = spark.createDataFrame(rows, SWAP_DDL).coalesce(1)
    plan.write.parquet(f"{lake.swaps}/swap={uuid.uuid4().hex}")
    finish_swaps(spark, lake)


def finish_swaps(spark: SparkSession, lake: Lake) -> None:
    """Carry out swaps that have been written down."""
    for todo in subfolders(spark, lake.swaps):
        if exists(spark, f"{todo}/_SUCCESS"):
            steps = read(spark, todo, SWAP_DDL).collect()
            for step in steps:
                if step["source"] is None:
                    delete(spark, step["target"])
            for step in steps:
                if step["source"] is not None and exists(spark, step["source"]):
                    delete(spark, step["target"])
                    move(spark, step["source"], step["target"])
        delete(spark, todo)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the folders above the target are made."""
    fs, old = _store(spark, source)
    _, new = _store(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"could not move {source} to {target}")


def silver_table_schema(contract: TableContract) -> T.StructType:
    columns = ", ".join(f"{c.name} {c.type}" for c in contract.columns)
    path, modified, ingested = LINEAGE_COLUMNS
    return T.StructType.fromDDL(
        f"{columns}, {contract.event_month} STRING, {contract.file_month} STRING, "
        f"{path} STRING, {modified} TIMESTAMP, {ingested} TIMESTAMP"
    )


def read_silver(
    spark: SparkSession,
    lake: Lake,
    contract: TableContract,
    version: int | None = None,
    paths: Sequence[str] | None = None,
) -> DataFrame:
    """The canonical table, partitioned by batch and event month, or some of its partitions."""
    version = current_version(spark, lake, "silver") if version is None else version
    schema = silver_table_schema(contract)
    return (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())]))
        .option("basePath", lake.silver(version))
        .parquet(*(paths or [lake.silver(version)]))
        .select(*schema.fieldNames())
    )


REASONS = "_reasons"


def read_refused(
    spark: SparkSession, lake: Lake, contract: TableContract, version: int | None = None
) -> DataFrame:
    """Rows that drop rules refused, canonical columns and ``_reasons``. What was refused of a
    month's files before the month was corrected is left out."""
    version = current_version(spark, lake, "silver") if version is None else version
    schema = silver_table_schema(contract)
    more = T.StructType.fromDDL(f"{REASONS} ARRAY<STRING>, {BATCH} BIGINT").fields
    stored = T.StructType([*schema.fields, *more])
    make_folder(spark, lake.refused(version))
    rows = read(spark, lake.refused(version), stored)
    rewritten = read_ingested(spark, lake).where(F.col(BATCH) >= 1 << REWRITE)
    corrected = rewritten.groupBy("year_month").agg(F.max(position(F.col(BATCH))).alias("last"))
    joined = rows.join(corrected, rows[contract.file_month] == corrected["year_month"], "left")
    kept = joined.where(F.col("last").isNull() | (position(F.col(BATCH)) >= F.col("last")))
    return kept.select(*schema.fieldNames(), REASONS)


def read_audit(spark: SparkSession, lake: Lake) -> DataFrame:
    """The run audit with late-filled update ids."""
    return with_completions(
        read(spark, lake.audit, LANDING_AUDIT_SCHEMA),
        read(spark, lake.completions, COMPLETION_DDL),
    )


def read_events(spark: SparkSession, lake: Lake) -> DataFrame:
    return read(spark, lake.events, EVENT_DDL)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def load_seed(dim: DataFrame, path: str) -> None:
    """Truncate and reload a dimension; repeating it changes nothing.

    What its rows take in memory is measured once and stored beside it (``seed_bytes``)."""
    dim.write.mode("overwrite").parquet(path)
    spark = dim.sparkSession
    size = measured_bytes(spark.read.schema(dim.schema).parquet(path))
    rows = spark.range(1).select(F.lit(size).cast("long").alias("bytes"))
    rows.write.mode("overwrite").parquet(f"{path}_size")


def seed_bytes(spark: SparkSession, path: str) -> int | None:
    """The measured size of a loaded dimension."""
    if not exists(spark, f"{path}_size"):
        return None
    return read(spark, f"{path}_size", "bytes LONG").first()["bytes"]


def write_by_month(
    df: DataFrame,
    path: str,
    partitions: Sequence[str],
    mode: str = "overwrite",
    order: Sequence[str] = (),
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """Write below ``path`` by partition; ``overwrite`` replaces everything there.

    A task keeps the files of up to ``OPEN_FILES`` folders open, so that its rows need not be
    sorted by folder, which held all of them in memory or spilled them; only rows of further
    folders are sorted.

    Rows of a file are sorted by ``order``, in one sort with the partition columns. Row groups
    are smaller in such files, so that their minimum and maximum leave most of them unread.
    """
    spark = df.sparkSession
    settings = {_MIN_TASKS: str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)}
    if order:
        df = df.sortWithinPartitions(*partitions, *order)
    writer = df.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(*partitions)
    if order:
        writer = writer.option("parquet.block.size", row_group_bytes)
    else:
        settings[_OPEN_FILES] = str(OPEN_FILES)
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        writer.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rebalance(df: DataFrame, *columns: str) -> DataFrame:
    """Cluster rows by ``columns`` into even, well-sized tasks.

    The adaptive planner merges small groups and splits large ones, so one month holding
    a third of all rows becomes many tasks and many files, not one.
    """
    return df.hint("rebalance", *columns)


def rebalance_others(
    df: DataFrame, here: Column, *columns: str, known: Mapping[str, Column] | None = None
) -> DataFrame:
    """``rebalance`` for the rows that are not ``here``; those that are stay in their tasks.

    ``known`` names columns of rows that are ``here`` by what they are equal to, so that they
    need not be computed once for the test and once again for the row."""
    others = df.where(~F.coalesce(here, F.lit(False)))
    return df.where(here).withColumns(dict(known or {})).unionByName(rebalance(others, *columns))


def whole_files(df: DataFrame, month: str, sizes: Mapping[str, int], target_bytes: int) -> DataFrame:
    """Cluster rows by month into as many tasks, and so files, as the month's bytes ask for.

    ``sizes`` has the bytes by the name of the month's folder. A month of up to ``target_bytes``
    is one task, however many bytes its rows take in a shuffle; a larger one is cut by a hash of
    its rows.
    """
    parts = {m: math.ceil(size / target_bytes) for m, size in sizes.items() if size > target_bytes}
    if not parts:
        return df.repartition(F.col(month))
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    row = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, nested)])
    count = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])
    folder = F.coalesce(F.col(month), F.lit("__HIVE_DEFAULT_PARTITION__"))
    return df.repartition(F.col(month), F.pmod(row, F.coalesce(F.try_element_at(count, folder), F.lit(1))))


def ranged(df: DataFrame, month: str, order: Sequence[str], sizes: Mapping[str | None, int], target_bytes: int) -> DataFrame:
    """Cluster rows by month and, within months larger than a file, by ranges of ``order``.

    ``sizes`` has the months' bytes. Files of such a month then hold ranges that hardly
    overlap, and a value that a third of the rows share is cut by the columns after it. A
    smaller month is one key, which no range boundary can cut, so it stays one file.
    """
    large = [m for m, size in sizes.items() if m is not None and size > target_bytes]
    n = max(1, math.ceil(sum(sizes.values()) / target_bytes))
    inside = [F.when(F.col(month).isin(large), F.col(c)) for c in order] if large else []
    return df.repartitionByRange(n, F.col(month), *inside)


