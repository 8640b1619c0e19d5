"""A batch's canonical rows parse each row's JSON once and take the file's month as it is known."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline import lake as store
from meterline.contract import TRIPS
from meterline.operators.conform import conform
from meterline.operators.drift import drift_profile

SHOWN = "string, _source_file_modification_time timestamp, _ingestion_ts timestamp, batch_id bigint"


def _raw(spark, saved):
    columns = ", ".join(f"{c.source} {c.hint or c.type}" for c in TRIPS.columns)
    ddl = f"{columns}, _rescued_data string, _source_file_path {SHOWN}"
    n = len(TRIPS.columns)
    rows = [(*[None] * n, text, "/l/yellow_tripdata_2024-01.parquet", None, None, 0) for text in saved]
    return spark.createDataFrame(rows, ddl)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_json_is_parsed_once_for_all_recovered_columns(spark):
    plan = _plan(conform(_raw(spark, [None]), TRIPS, track_cast_loss=True))
    assert plan.count("from_json(") == 1 and "get_json_object" not in plan


def test_rescued_values_and_losses(spark):
    saved = ['{"passenger_count":3,"RatecodeID":5,"_file_path":"x"}', '{"passenger_count":"2.0"}', '{"RatecodeID":1.0}']
    saved += ['{"passenger_count":"many"}', "{}", None, "no json", '{"passenger_count":null,"RatecodeID":1e2}']
    rows = conform(_raw(spark, saved), TRIPS, track_cast_loss=True)
    got = [tuple(r) for r in rows.select("passenger_count", "ratecode_id", "_cast_loss").collect()]
    no = (None, None, False)
    assert got == [(3, 5, False), (2, None, False), (None, 1, False), (None, None, True), no, no, no, (None, 100, False)]


def test_known_month_is_not_searched_for_in_paths(spark):
    raw = _raw(spark, [None, '{"passenger_count":1}']).withColumn("_file_month", F.lit("2024-01"))
    month = F.col("_file_month")
    assert "regexp" not in _plan(conform(raw, TRIPS, file_month=month))
    known = drift_profile(raw, TRIPS, "passenger_count", month)
    assert "regexp" not in _plan(known)
    assert known.collect() == drift_profile(raw, TRIPS, "passenger_count").collect()


def test_scans_that_are_written_are_cut_into_several_tasks_per_core(spark, root):
    files = 3 * spark.sparkContext.defaultParallelism
    spark.range(0, files, 1, files).write.parquet(f"{root}/in")
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    rows = spark.read.schema("id long").parquet(f"{root}/in").withColumn("month", F.lit("2024-01"))
    store.write_by_month(rows, f"{root}/out", ["month"])
    written = spark.read.parquet(f"{root}/out")
    assert written.count() == files
    assert len(written.inputFiles()) > 2 * spark.sparkContext.defaultParallelism
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) == before


def test_rows_in_place_take_the_known_month(spark):
    rows = spark.createDataFrame([("a", "a", 1), ("b", "a", 2), (None, "a", 3), ("a", None, 4)], "m string, f string, n int")
    got = store.rebalance_others(rows, F.col("m") == F.col("f"), "m", known={"m": F.col("f")})
    assert got.columns == rows.columns and sorted(map(str, got.collect())) == sorted(map(str, rows.collect()))
