"""Columns that take the least type for all their files."""

from __future__ import annotations

import dataclasses
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_corrections import config  # noqa: F401
from test_ingest import ids

from meterline import lake as store
from meterline.contract import ColumnSpec, TableContract
from meterline.sources.drifted import evolve, scan_drifted, upper_bound
from meterline.sources.footers import file_schemas
from meterline.streaming.compaction import compact
from meterline.streaming.ingest import ingest, rebuild_silver


def kind(ddl):
    return T.StructType.fromDDL(f"a {ddl}")["a"].dataType


@pytest.mark.parametrize(
    ("a", "b", "bound"),
    [
        ("INT", "BIGINT", "bigint"),
        ("BIGINT", "DOUBLE", "double"),
        ("FLOAT", "INT", "double"),
        ("FLOAT", "DOUBLE", "double"),
        ("DATE", "TIMESTAMP_NTZ", "timestamp_ntz"),
        ("DECIMAL(5,2)", "DECIMAL(8,1)", "decimal(9,2)"),
        ("DECIMAL(5,2)", "BIGINT", "decimal(21,2)"),
        ("DECIMAL(38,2)", "DECIMAL(38,4)", None),
        ("DECIMAL(5,2)", "DOUBLE", None),
        ("STRING", "INT", None),
        ("BOOLEAN", "INT", None),
        ("ARRAY<INT>", "ARRAY<BIGINT>", None),
        ("STRING", "STRING", "string"),
    ],
)
def test_upper_bounds(a, b, bound):
    for x, y in ((a, b), (b, a)):
        got = upper_bound(kind(x), kind(y))
        assert (got.simpleString() if got else None) == bound


def test_anchored_columns_are_rescued_as_ever():
    schema = T.StructType.fromDDL
    assert evolve(schema("a BIGINT"), ["a"], [schema("A DOUBLE")], bounds=True).simpleString() == "struct<a:bigint>"
    assert evolve(schema("a BIGINT"), [], [schema("A DOUBLE")], bounds=True).simpleString() == "struct<a:double>"
    assert evolve(schema("a BIGINT"), [], [schema("A DOUBLE")]).simpleString() == "struct<a:bigint>"


@pytest.mark.parametrize(
    ("value", "table", "expected", "rescued"),
    [
        ("CAST(7 AS BIGINT)", "DOUBLE", 7.0, None),
        (f"CAST({2**53 + 1} AS BIGINT)", "DOUBLE", None, 2**53 + 1),
        ("CAST(NULL AS BIGINT)", "DOUBLE", None, None),
        ("CAST(1.25 AS DECIMAL(5,2))", "DECIMAL(9,3)", "1.250", None),
        ("DATE'2023-01-02'", "TIMESTAMP_NTZ", "2023-01-02 00:00:00", None),
        ("'x'", "DOUBLE", None, "x"),
    ],
)
def test_casts_to_the_bound_keep_values_or_rescue_them(spark, root, value, table, expected, rescued):
    spark.sql(f"SELECT {value} AS a").write.parquet(f"{root}/f")
    files = file_schemas(spark, spark.read.format("binaryFile").load(f"{root}/f/*.parquet"))
    row = scan_drifted(spark, T.StructType.fromDDL(f"a {table}"), [], files, bounds=True).first()
    assert row["a"] == expected or str(row["a"]) == expected
    saved = json.loads(row["_rescued_data"])["a"] if row["_rescued_data"] else None
    assert saved == rescued


def test_batches_written_before_the_bound_are_cast(spark, config):  # noqa: F811
    contract = TableContract(
        columns=(ColumnSpec("id", "id", "BIGINT", "BIGINT"), ColumnSpec("ts", "ts", "TIMESTAMP", "TIMESTAMP_NTZ"),
                 ColumnSpec("v", "v", "DOUBLE")),
        event_time="ts", file_pattern=config.contract.file_pattern,
    )
    wide = dataclasses.replace(config, contract=contract, rules=(), bounds=True)
    start = spark.range(3).select("id", F.lit("2023-01-05 10:00:00").cast("timestamp_ntz").alias("ts"))
    values = ("CAST(id AS INT)", "CAST(id AS BIGINT)", "id + 0.5D", "CAST(id AS BIGINT)", f"id + {2**53 + 1}L")
    for i, value in enumerate(values, 1):
        folder = f"{wide.landing_dir}/year=2023/month=0{i}/yellow_tripdata_2023-0{i}.parquet"
        start.select(F.col("id") + 10 * i, "ts", F.expr(value).alias("v")).toDF("id", "ts", "v").write.parquet(folder)
        ingest(spark, wide, f"u{i}")

    def check():
        rows = {r["id"]: (r["v"], r["_rescued_data"]) for r in store.read_bronze(spark, wide.lake).collect()}
        assert rows[11] == (1.0, None) and rows[21] == (1.0, None) and rows[31] == (1.5, None)
        assert rows[41] == (1.0, None) and rows[51] == (float(2**53 + 2), None)
        assert rows[50][0] is None and json.loads(rows[50][1])["v"] == 2**53 + 1
        assert len(rows) == 15

    check()
    rebuild_silver(spark, wide, "again")
    assert len(ids(store.read_silver(spark, wide.lake, contract))) == 15
    compact(spark, wide)
    check()
