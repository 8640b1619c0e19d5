"""Register the lake's tables and publish the marts as stored views.

Readers then use three-level names, e.g.
``read_table(spark, "monthly_avg_total_amount", schema)``. Tables are external: dropping
one leaves its files. The canonical table is reached through a view, so publishing a new
version is one replacement that no reader can see half done.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from meterline import lake as store
from meterline.lake import BATCH, FILE_PARTITION
from meterline.operators import marts, runs
from meterline.sources.dims import LOCATION_DDL
from meterline.sources.tables import ensure_schema, ensure_table
from meterline.streaming.events import OBSERVED_EVENTS
from meterline.streaming.ingest import IngestConfig


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _partitioned(
    spark: SparkSession, name: str, schema: T.StructType, partitions: list[str], location: str, anew: bool
) -> None:
    """External partitioned table; ``anew`` lists its folders, which a new entry needs, too."""
    if not anew and spark.catalog.tableExists(name):
        return
    data = [f for f in schema.fields if f.name not in partitions]
    keys = [f for f in schema.fields if f.name in partitions]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(T.StructType(data + keys))}) USING parquet "
        f"PARTITIONED BY ({', '.join(partitions)}) LOCATION '{location}'"
    )
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def _view(spark: SparkSession, name: str, query: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def register_tables(spark: SparkSession, config: IngestConfig, schema: str, anew: bool = True) -> None:
    """Raw and canonical table, dimension, audit and events under ``schema``; safe to repeat.

    Without ``anew`` the partitions of registered tables are taken to be up to date, as they
    are if ``config.catalog`` is ``schema``: every batch has added its own.
    """
    lake, contract = config.lake, config.contract
    store.ensure(spark, lake)
    ensure_schema(spark, schema, lake.at("catalog", schema))
    version = store.current_version(spark, lake, "silver")
    columns = store.silver_table_schema(contract)
    physical = f"{schema}.trips_v{version}"
    with_batch = T.StructType([*columns.fields, T.StructField(BATCH, T.LongType())])
    _partitioned(spark, physical, with_batch, [BATCH, contract.event_month], lake.silver(version), anew)
    _view(spark, f"{schema}.trips", f"SELECT {', '.join(columns.fieldNames())} FROM {physical}")

    # The raw table's schema grows; then its entry is made anew, and its files stay.
    raw_version = store.current_version(spark, lake, "bronze")
    raw = store.bronze_table_schema(store.bronze_schema(spark, lake, raw_version))
    physical = f"{schema}.raw_v{raw_version}"
    with_file = T.StructType([*raw.fields, T.StructField(FILE_PARTITION, T.StringType())])
    known = spark.table(physical).schema if spark.catalog.tableExists(physical) else None
    grown = known is None or set(known.fieldNames()) != set(with_file.fieldNames()) or any(
        known[f.name].dataType != f.dataType for f in raw.fields
    )
    if grown:
        spark.sql(f"DROP TABLE IF EXISTS {physical}")
    _partitioned(spark, physical, with_file, [BATCH, FILE_PARTITION], lake.bronze(raw_version, "data"), anew)
    _view(spark, f"{schema}.raw_trips", f"SELECT {', '.join(f'`{c}`' for c in raw.fieldNames())} FROM {physical}")

    ensure_table(spark, f"{schema}.dim_locations", LOCATION_DDL, lake.locations)
    ensure_table(
        spark, f"{schema}.landing_audit_rows", _ddl(runs.LANDING_AUDIT_SCHEMA), lake.audit
    )
    ensure_table(spark, f"{schema}.run_completions", store.COMPLETION_DDL, lake.completions)
    # Events name their update themselves, so their folders need no partitions.
    ensure_table(spark, f"{schema}.run_events", store.EVENT_DDL, lake.events, recursive=True)
    for table in ("dim_locations", "landing_audit_rows", "run_completions", "run_events"):
        spark.catalog.refreshTable(f"{schema}.{table}")
    _publish_audit(spark, schema)


def publish(spark: SparkSession, config: IngestConfig, hourly_month: str = "2023-05") -> None:
    """Tables and marts under ``config.catalog``, as the jobs leave them; marts need a complete
    run."""
    register_tables(spark, config, config.catalog, anew=False)
    audit = spark.table(f"{config.catalog}.landing_audit")
    if runs.complete_runs(audit).limit(1).count():
        publish_marts(spark, config.catalog, hourly_month)


def _publish_audit(spark: SparkSession, schema: str) -> None:
    columns = ", ".join(
        "coalesce(a.pipeline_update_id, c.first_id) AS pipeline_update_id"
        if name == "pipeline_update_id"
        else f"a.{name}"
        for name in runs.LANDING_AUDIT_COLUMNS
    )
    key = ", ".join(runs.AUDIT_KEY)
    _view(
        spark,
        f"{schema}.landing_audit",
        f"""
        SELECT {columns}
        FROM {schema}.landing_audit_rows AS a
        LEFT JOIN (
          SELECT {key}, min_by(pipeline_update_id, struct(completed_ts, pipeline_update_id))
                   AS first_id
          FROM {schema}.run_completions GROUP BY {key}
        ) AS c USING ({key})
        """,
    )
    kinds = ", ".join(f"'{kind}'" for kind in OBSERVED_EVENTS)
    _view(
        spark,
        f"{schema}.pipeline_observability",
        f"""
        SELECT timestamp, event_type, message, details FROM {schema}.run_events
        WHERE event_type IN ({kinds}) ORDER BY timestamp DESC
        """,
    )


def publish_marts(spark: SparkSession, schema: str, hourly_month: str = "2023-05") -> None:
    """Store the marts as views over the registered tables.

    The window is looked up when a view is read. Means are taken before the dimension is
    joined wherever the join cannot change them.
    """
    runs.require_complete_run(spark.table(f"{schema}.landing_audit"))
    newest = f"""
        SELECT max_by(struct(start_year_month AS lo, end_year_month AS hi),
                      struct(job_start_ts, run_id)) AS months
        FROM {schema}.landing_audit WHERE pipeline_update_id IS NOT NULL
    """
    inputs = {
        "silver": f"{schema}.trips",
        "trips": f"{schema}.window_trips",
        "pairs": f"{schema}.location_pairs",
        "dim": f"{schema}.dim_locations",
        "month": f"'{hourly_month}'",
    }
    _view(
        spark,
        f"{schema}.window_trips",
        f"""
        WITH newest AS ({newest}) {marts.PROJECTION_SQL.format(**inputs)}
        WHERE pickup_year_month >= (SELECT months.lo FROM newest)
          AND pickup_year_month <= (SELECT months.hi FROM newest)
        """,
    )
    for name, text in (
        ("consumption", marts.CONSUMPTION_SQL),
        ("monthly_avg_total_amount", marts.MONTHLY_SQL),
        ("hourly_avg_passenger_count", marts.HOURLY_SQL),
        ("location_pairs", marts.PAIRS_SQL),
        ("flow_matrix", marts.FLOWS_SQL),
    ):
        _view(spark, f"{schema}.{name}", text.format(**inputs))
