"""Dimension scans with forced types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: columns of the location dimension.
LOCATION_DDL = "location_id INT, borough STRING, zone STRING, service_zone STRING"


def read_csv_dimension(spark: SparkSession, path: str, ddl: str = LOCATION_DDL) -> DataFrame:
    """A headed CSV as exactly ``ddl``: nothing inferred, ``N/A`` stays a string.

    Doubled quotes inside a quoted field stand for one quote.
    """
    return (
        spark.read.schema(ddl)
        .option("header", "true")
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )
