"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import broadcast

# Runtime settings that change results: wall-clock semantics and name matching.
PINNED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
}

# Settings worth giving a cluster; they change speed and file sizes only.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def pin(spark: SparkSession) -> SparkSession:
    """Set the result-relevant settings on ``spark`` and return it."""
    for key, value in PINNED.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder below ``spark.checkpoint.dir``.

    Executors must all see the folder. A machine-local one is made only where the session
    names none and driver and executors are one process, as in tests; elsewhere the setting
    is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"meterline-{label}-")


# Deletes a query's shuffle files when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialised(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a scratch folder and read from there.

    Cuts lineage in a way that survives lost executors, gives up the shuffle files behind it,
    and lets adaptive execution see (and split) plain exchanges in later joins.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes up to which a table of known length is sent to all tasks (Spark's own bound is 10 MB).
SENT_BYTES = 8 << 20


def sent(rows: DataFrame, n: int, width: int) -> DataFrame:
    """``rows``, to be broadcast in a join if ``n`` of them with ``width`` bytes are few."""
    return broadcast(rows) if n * width <= SENT_BYTES else rows


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in Python workers, once for each application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="meterline-"), "meterline_package.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.relpath(full, os.path.dirname(package)))
        context.addPyFile(path)
        _SHIPPED.add(context.applicationId)
    return spark
