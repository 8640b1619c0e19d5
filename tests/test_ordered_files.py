"""Order inside the files of a month: how many row groups a filter on a location has to read."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F
from test_ingest import CONTRACT, JANUARY, RULES, ids, land

from meterline import lake as store
from meterline.lake import Lake
from meterline.streaming.compaction import compact
from meterline.streaming.ingest import IngestConfig, ingest, rebuild_silver

ORDER = ("zone", "id")


def scattered(df):
    return df.withColumn("zone", (F.col("id") * 7919) % 101)


def settings(root, order, **more):
    return IngestConfig(f"{root}/landing", Lake(f"{root}/lake"), CONTRACT, RULES, order=order, row_group_bytes=60_000, **more)


def spans(root, column):
    """(least, greatest) value of a column in each row group, by file."""
    out = {}
    for path in glob.glob(f"{root}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(path).metadata
        k = meta.schema.names.index(column)
        stats = [meta.row_group(i).column(k).statistics for i in range(meta.num_row_groups)]
        out[path] = [(s.min, s.max) for s in stats]
    return out


def read_for(root, column, value):
    """(row groups that may hold the value, all row groups)"""
    every = [s for file in spans(root, column).values() for s in file]
    return sum(low <= value <= high for low, high in every), len(every)


def test_a_location_is_in_few_row_groups(spark, tmp_path):
    for name, order in (("plain", ()), ("ordered", ORDER)):
        config = settings(tmp_path / name, order)
        land(spark, config.landing_dir, "2023-01", JANUARY, range(40_000), scattered)
        ingest(spark, config, "u")
    some, every = read_for(tmp_path / "plain/lake/silver/v0", "zone", 17)
    assert some == every
    some, every = read_for(config.lake.silver(0), "zone", 17)
    assert every >= 100 and some <= 4
    found = store.read_silver(spark, config.lake, CONTRACT).where("zone = 17")
    assert ids(found) == [i for i in range(40_000) if i * 7919 % 101 == 17]
    assert "EqualTo(zone,17)" in found._jdf.queryExecution().toString()
    version = rebuild_silver(spark, config, "again")
    some, every = read_for(config.lake.silver(version), "zone", 17)
    assert every >= 100 and some <= 4


def test_compaction_cuts_large_months_by_ranges_and_no_small_one(spark, tmp_path):
    """A third of the rows have one location; the next column of the order cuts it."""
    config = settings(tmp_path, ORDER, max_files_per_batch=1)
    hot = F.when(F.col("id") % 3 == 0, 50).otherwise((F.col("id") * 7919) % 101)
    late = F.when(F.col("id") % 1000 == 1, F.lit("2023-05-01 00:00:00").cast("timestamp_ntz")).otherwise(
        F.lit("2023-01-01 00:00:00").cast("timestamp_ntz")
    )
    for m in range(1, 4):
        rows = range(10_000 * m, 10_000 * (m + 1))
        land(spark, config.landing_dir, f"2023-0{m}", JANUARY, rows, lambda df: df.withColumn("zone", hot).withColumn("ts", late))
    ingest(spark, config, "u")
    before = sorted(map(repr, store.read_silver(spark, config.lake, CONTRACT).collect()))
    january = glob.glob(f"{config.lake.silver(0)}/*/pickup_year_month=2023-01/*.parquet")
    size = sum(len(open(p, "rb").read()) for p in january)
    assert compact(spark, config, target_bytes=size * 7 // 10)["silver"] == 6
    assert sorted(map(repr, store.read_silver(spark, config.lake, CONTRACT).collect())) == before
    found = spans(config.lake.silver(0), "zone")
    assert sum("pickup_year_month=2023-05" in p for p in found) == 1
    cut = sorted((s[0][0], s[-1][1]) for p, s in found.items() if "pickup_year_month=2023-01" in p)
    assert len(cut) >= 2
    assert all(a[1] <= b[0] for a, b in zip(cut, cut[1:], strict=False))
    assert compact(spark, config, target_bytes=size * 7 // 10)["silver"] == 0


def test_nulls_repeated_rows_and_an_empty_file(spark, tmp_path):
    config = settings(tmp_path, ORDER)
    land(spark, config.landing_dir, "2023-01", JANUARY, [1, 1, 2, 3], lambda df: df.withColumn("zone", F.when(F.col("id") > 1, 5)))
    land(spark, config.landing_dir, "2023-02", JANUARY, range(0))
    ingest(spark, config, "u")
    compact(spark, config)
    assert ids(store.read_silver(spark, config.lake, CONTRACT)) == [1, 1, 2, 3]
