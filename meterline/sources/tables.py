"""Table names and the registered (catalog) side of the lakehouse."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def table_name(model: str, schema: str, catalog: str = "spark_catalog", prefix: str = "") -> str:
    """Three-level name ``catalog.<prefix><schema>.model``."""
    return f"{catalog}.{prefix}{schema}.{model}"


def read_table(
    spark: SparkSession,
    model: str,
    schema: str,
    catalog: str = "spark_catalog",
    prefix: str = "",
) -> DataFrame:
    return spark.read.table(table_name(model, schema, catalog, prefix))


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{where}")


def ensure_table(
    spark: SparkSession, name: str, ddl: str, location: str, recursive: bool = False
) -> None:
    """External parquet table over ``location`` (and, ``recursive``, all folders below it);
    nothing happens if it exists."""
    options = "OPTIONS (recursiveFileLookup 'true') " if recursive else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet {options}LOCATION '{location}'"
    )


def follow(
    spark: SparkSession, table: str | None, root: str, gone: Iterable[str], added: Iterable[str]
) -> None:
    """Keep a registered table's partitions in step with folders below ``root`` that have come
    or gone. Nothing is listed. Without a table of that name there is nothing to do."""
    if table is None or not spark.catalog.tableExists(table):
        return
    for verb, folders in (("DROP IF EXISTS", list(gone)), ("ADD IF NOT EXISTS", list(added))):
        specs = [f"PARTITION ({_spec(f[len(root):])})" for f in folders]
        for i in range(0, len(specs), 500):
            between = ", " if verb.startswith("DROP") else " "
            spark.sql(f"ALTER TABLE {table} {verb} {between.join(specs[i : i + 500])}")
    spark.catalog.refreshTable(table)


def _spec(folder: str) -> str:
    """``/batch_id=1/month=2023-01`` as a partition specification."""
    values = (x.split("=", 1) for x in folder.strip("/").split("/"))
    return ", ".join(f"{k} = {_value(v)}" for k, v in values)


def _value(text: str) -> str:
    if text == "__HIVE_DEFAULT_PARTITION__":
        return "NULL"
    return text if text.lstrip("-").isdigit() else f"'{text}'"


def publish_view(df: DataFrame, name: str) -> None:
    """(Re)bind a session view to a lazy frame."""
    df.createOrReplaceTempView(name)
