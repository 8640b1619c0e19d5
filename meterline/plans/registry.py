"""Named queries, each with the SQL another engine can answer it by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline import session

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str) -> Callable[[Query], Query]:
    """Register a query under ``name``; it runs in a session with the pinned settings."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(session.pin(spark), sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        ORACLES[name] = oracle
        return run

    return register


def plain(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE and instants as wall-clock time, so engines can be compared."""
    columns = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        c = F.col(f"`{f.name}`")
        if kind == "decimal":
            c = c.cast("double").alias(f.name)
        elif kind == "timestamp":
            c = c.cast("timestamp_ntz").alias(f.name)
        columns.append(c)
    return df.select(*columns)
