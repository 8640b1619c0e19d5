"""Small files of many batches, rewritten together.

Each batch writes a folder of its own, so a month that many batches add to is many small files,
and misdated rows leave a folder per batch in months long past. Folders of small files are
grouped by month and rewritten as one batch: a small month becomes one file, a large
one as many as its size on disk asks for, each with a range of the columns that the table is ordered by,
if it is. Folders whose files are large enough, and months with a single
small file, are left as they are. The rewritten batch is swapped in when it is complete.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline import lake as store
from meterline.functions.paths import extract_file_year_month
from meterline.lake import BATCH, FILE_PARTITION
from meterline.sources.tables import follow
from meterline.streaming.ingest import IngestConfig, raw_entry, trips_entry, write_sorted

TARGET_BYTES = 128 << 20
#: Folders rewritten in one call; more wait for the next, smallest files first.
MAX_FOLDERS = 20_000


def folders(spark: SparkSession, root: str, column: str) -> DataFrame:
    """``(folder, month, files, bytes)`` of a table's folders, by listing only."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select("path", "length")
    )
    folder = F.regexp_extract("path", rf"/({BATCH}=-?\d+/{column}=[^/]+)/[^/]+$", 1)
    month = F.regexp_extract(folder, rf"{column}=([^/]+)$", 1)
    rows = files.groupBy(folder.alias("folder"), month.alias("month"))
    return rows.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")).where("folder <> ''")


def worthwhile(listed: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """``(folder, month, ...)`` of small files that would be fewer if written together."""
    small = listed.where(F.col("bytes") < F.col("files") * F.lit(target_bytes) / 2)
    months = small.groupBy("month").agg(F.sum("files").alias("now"), F.sum("bytes").alias("size"))
    fewer = F.col("now") > F.greatest(F.lit(1), F.ceil(F.col("size") / F.lit(target_bytes)))
    return small.join(months.where(fewer).select("month"), "month")


def compact(spark: SparkSession, config: IngestConfig, target_bytes: int = TARGET_BYTES) -> dict[str, int]:
    """Rewrite small files of the raw and the canonical table; returns the folders taken away."""
    lake, contract = config.lake, config.contract
    store.ensure(spark, lake)
    store.finish_swaps(spark, lake)
    bronze, silver = (store.current_version(spark, lake, t) for t in ("bronze", "silver"))
    roots = {"bronze": lake.bronze(bronze, "data"), "silver": lake.silver(silver)}
    columns = {"bronze": FILE_PARTITION, "silver": contract.event_month}
    entries = {"bronze": raw_entry(config, bronze), "silver": trips_entry(config, silver)}
    out = {}
    for table, version in (("bronze", bronze), ("silver", silver)):
        root, column = roots[table], columns[table]
        if not store.exists(spark, root):
            continue
        todo = worthwhile(folders(spark, root, column), target_bytes)
        rows = todo.orderBy(F.col("bytes") / F.col("files"), "folder").limit(MAX_FOLDERS).collect()
        old = [f"{root}/{r['folder']}" for r in rows]
        out[table] = len(old)
        if not old:
            continue
        batch = store.next_rewrite(spark, *roots.values())
        if table == "bronze":
            month = extract_file_year_month("_source_file_path", contract.file_pattern)
            found = store.read_bronze(spark, lake, version, paths=old).drop(BATCH).withColumn(column, month)
        else:
            found = store.read_silver(spark, lake, contract, version, old)
        staged = f"{lake.staged(table, version)}/{BATCH}={batch}"
        sizes: dict[str, int] = {}
        for r in rows:
            sizes[r["month"]] = sizes.get(r["month"], 0) + r["bytes"]
        if table == "silver" and config.order:
            write_sorted(config, store.ranged(found, column, config.order, sizes, target_bytes), staged, [column])
        else:
            store.write_by_month(store.whole_files(found, column, sizes, target_bytes), staged, [column])
        if table == "silver":
            store.write_months(spark, lake, contract, version, batch, staged=True)
        store.swap(spark, lake, old, [(staged, f"{root}/{BATCH}={batch}")])
        follow(spark, entries[table], root, old, store.subfolders(spark, f"{root}/{BATCH}={batch}"))
    return out
