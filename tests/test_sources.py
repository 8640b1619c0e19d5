from __future__ import annotations

import os

import pytest

from meterline import session
from meterline.sources import dims, landing, tables


@pytest.fixture()
def landed(root):
    def put(path, size):
        full = f"{root}/landing/{path}"
        os.makedirs(os.path.dirname(full), exist_ok=True)
        with open(full, "wb") as f:
            f.write(b"x" * size)

    put("year=2023/month=01/yellow_tripdata_2023-01.parquet", 10)
    put("year=2023/month=02/yellow_tripdata_2023-02.parquet/part-0-a.parquet", 20)
    put("year=2023/month=02/yellow_tripdata_2023-02.parquet/part-1-b.parquet", 5)
    put("year=2023/month=03/file=yellow_tripdata_2023-03.parquet/part-0.snappy.parquet", 7)
    put("yellow_tripdata_2023-04.parquet", 99)
    put("year=2023/month=05/green_tripdata_2023-05.parquet", 99)
    put("year=2023/month=05/readme.txt", 99)
    return f"{root}/landing"


def test_inventory_sums_bytes_per_requested_month(spark, landed):
    months = spark.createDataFrame([(f"2023-0{i}",) for i in range(1, 7)], "year_month string")
    files = landing.landed_files(spark, landed)
    got = {r[0]: (r[1], r[2]) for r in landing.file_inventory(files, months).collect()}
    assert got == {
        "2023-01": (10, 1),
        "2023-02": (25, 2),
        "2023-03": (7, 1),
        "2023-04": (0, 0),
        "2023-05": (0, 0),
        "2023-06": (0, 0),
    }


def test_listing_does_not_read_contents(spark, landed):
    plan = landing.landed_files(spark, landed)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_csv_dimension_has_forced_types(spark, root):
    with open(f"{root}/dim.csv", "w") as f:
        f.write('"location_id","borough","zone","service_zone"\n')
        f.write('1,"EWR","Newark, ""Airport""","EWR"\n264,"Unknown","N/A","N/A"\n')
    df = dims.read_csv_dimension(spark, f"{root}/dim.csv")
    assert [tuple(r) for r in df.orderBy("location_id").collect()] == [
        (1, "EWR", 'Newark, "Airport"', "EWR"),
        (264, "Unknown", "N/A", "N/A"),
    ]
    with open(f"{root}/bad.csv", "w") as f:
        f.write("location_id,borough,zone,service_zone\nnot-a-number,a,b,c\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        dims.read_csv_dimension(spark, f"{root}/bad.csv").collect()


def test_catalog_tables_and_views(spark, root):
    tables.ensure_schema(spark, "dev_marts", f"{root}/db")
    for _ in range(2):
        tables.ensure_schema(spark, "dev_marts", f"{root}/db")
        tables.ensure_table(spark, "dev_marts.runs", "id BIGINT, name STRING", f"{root}/runs")
    spark.sql("INSERT INTO dev_marts.runs VALUES (1, 'a')")
    tables.ensure_table(spark, "dev_marts.runs", "id BIGINT, name STRING", f"{root}/runs")
    name = tables.table_name("runs", "marts", prefix="dev_")
    assert name == "spark_catalog.dev_marts.runs"
    assert tables.read_table(spark, "runs", "marts", prefix="dev_").count() == 1
    tables.publish_view(spark.table(name), "v")
    tables.publish_view(spark.table(name).where("id > 1"), "v")
    assert spark.table("v").count() == 0


def test_scratch_is_new_each_time_and_shared_where_configured(spark, monkeypatch):
    first, second = session.scratch_dir(spark, "x"), session.scratch_dir(spark, "x")
    assert first != second
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        assert first.startswith(base)


def test_pinned_settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    session.pin(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.caseSensitive") == "false"
