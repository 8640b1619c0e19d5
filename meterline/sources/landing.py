"""What lies in the landing folder: files, their months and sizes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.contract import TRIP_FILE_PATTERN
from meterline.functions.paths import parse_volume_object_path


def ensure_landing(spark: SparkSession, landing_dir: str) -> None:
    """Create the landing folder if it is missing; an existing one stays untouched."""
    nothing = spark.range(0, 0, 1, 1).select(F.lit("").alias("value"))
    nothing.write.mode("ignore").text(landing_dir)


def landed_files(
    spark: SparkSession,
    landing_dir: str,
    pattern: str = TRIP_FILE_PATTERN,
    months: Iterable[str] | None = None,
) -> DataFrame:
    """``(path, year_month, length, modification_time)`` of every landed parquet file.

    Only the listing is read: the file contents are not selected, hence not opened. A
    month may be one file or a folder of part files that carries the file's name;
    ``year_month`` is NULL outside the agreed layout. ``pattern`` is the contract's
    pattern of file names. With ``months`` only their folders are listed
    (``year=YYYY/month=MM``), however many others there are.
    """
    where = [landing_dir]
    if months is not None:
        base = landing_dir.rstrip("/")
        folders = (f"{base}/year={m[:4]}/month={m[5:7]}" for m in sorted(set(months)))
        where = [f for f in folders if _exists(spark, f)]
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
    )
    none = "path STRING, modificationTime TIMESTAMP, length LONG"
    listed = reader.load(where) if where else spark.createDataFrame([], none)
    files = listed.select("path", "length", F.col("modificationTime").alias("modification_time"))
    logical = F.regexp_replace(F.col("path"), r"/part-[^/]*$", "")
    logical = F.regexp_replace(logical, r"/[^/=]+=([^/]+\.parquet)$", "/$1")
    return files.select(
        "path", parse_volume_object_path(logical, pattern).alias("year_month"), "length", "modification_time"
    )


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def file_inventory(files: DataFrame, months: DataFrame) -> DataFrame:
    """Bytes on storage per requested month (column ``year_month``), 0 where nothing landed."""
    sizes = (
        files.where(F.col("year_month").isNotNull())
        .groupBy("year_month")
        .agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))
    )
    return months.join(sizes, "year_month", "left").select(
        "year_month",
        F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes_in_volume"),
        F.coalesce("files", F.lit(0)).cast("long").alias("files"),
    )
