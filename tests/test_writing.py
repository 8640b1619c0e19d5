"""How rows are spread over files: by size on disk, without sorting or shuffling what lies well."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter
from test_ingest import CONTRACT, JANUARY, RULES, ids, land

from meterline import lake as store
from meterline.lake import Lake
from meterline.plans import ingest_queries
from meterline.streaming.compaction import compact, folders
from meterline.streaming.ingest import IngestConfig, ingest

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@pytest.fixture()
def tiny_shuffles(spark):
    """Adaptive execution takes every month for a large one."""
    before = spark.conf.get(ADVISORY)
    spark.conf.set(ADVISORY, "1k")
    yield
    spark.conf.set(ADVISORY, before)


def _of_one_month(spark, root):
    config = IngestConfig(f"{root}/landing", Lake(f"{root}/lake"), CONTRACT, RULES, max_files_per_batch=1)
    when = F.lit("2023-01-15 00:00:00").cast("timestamp_ntz")
    for i in range(4):
        land(spark, config.landing_dir, f"2023-0{i + 1}", JANUARY, range(3000 * i, 3000 * i + 3000), lambda df: df.withColumn("ts", when))
    ingest(spark, config, "u1")
    return config


def test_compaction_goes_by_bytes_on_disk_not_in_the_shuffle(spark, root, tiny_shuffles):
    config = _of_one_month(spark, root)
    assert compact(spark, config)["silver"] > 0
    listed = folders(spark, config.lake.silver(0), CONTRACT.event_month).collect()
    assert [(r["month"], r["files"]) for r in listed] == [("2023-01", 1)]
    assert ids(store.read_silver(spark, config.lake, CONTRACT)) == list(range(12000))


def test_a_month_larger_than_a_file_is_cut(spark):
    months = F.when(F.col("id") % 3 == 0, "2023-01").when(F.col("id") % 3 == 1, "2023-02")
    rows = spark.range(3000).select("id", months.alias("m"))
    sizes = {"2023-01": 100, "2023-02": 350, "__HIVE_DEFAULT_PARTITION__": 250}
    cut = store.whole_files(rows, "m", sizes, 100).withColumn("task", F.spark_partition_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per_task = cut.select("m", "task").distinct().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = {m: sum(r["m"] == m for r in per_task) for m in ("2023-01", "2023-02", None)}
    assert found["2023-01"] == 1 and 1 < found["2023-02"] <= 4 and 1 < found[None] <= 3
    assert cut.select("id").distinct().count() == 3000


def test_rows_are_not_sorted_by_folder_unless_an_order_is_asked_for(spark, root, monkeypatch):
    seen = []
    real = DataFrameWriter.parquet

    def parquet(self, path, *args, **kwargs):
        seen.append(int(spark.conf.get(store._OPEN_FILES, "0")))
        return real(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    rows = spark.range(400).select("id", (F.col("id") % (store.OPEN_FILES + 50)).cast("string").alias("m")).coalesce(1)
    store.write_by_month(rows, f"{root}/t", ["m"])
    store.write_by_month(rows, f"{root}/o", ["m"], order=("id",))
    assert seen == [store.OPEN_FILES, 0]
    assert int(spark.conf.get(store._OPEN_FILES, "0")) == 0
    for path in (f"{root}/t", f"{root}/o"):
        back = spark.read.schema("id LONG, m STRING").parquet(path)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_only_rows_of_other_months_are_shuffled(spark):
    rows = spark.createDataFrame([(1, "a", "a"), (2, "a", "b"), (3, None, "b"), (4, "b", None)], "id INT, e STRING, f STRING")
    spread = store.rebalance_others(rows, F.col("e") == F.col("f"), "e")
    assert sorted(r["id"] for r in spread.collect()) == [1, 2, 3, 4]
    union = spread._jdf.queryExecution().optimizedPlan()
    sides = [union.children().apply(i).toString() for i in range(2)]
    assert ["RebalancePartitions" in s for s in sides] == [False, True]


def test_the_inventory_of_landed_files_ingests_nothing(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(ingest_queries, "_DONE", {})
    monkeypatch.setattr(ingest_queries, "ingest", lambda *a, **k: pytest.fail("ingested"))
    assert ingest_queries.file_inventory(spark, sf_dir).where("present").count() > 0
