"""Drifting files through the stream: nothing lost, nothing doubled."""

from __future__ import annotations

import dataclasses
import json
import os
import shutil

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline import lake as store
from meterline.contract import TRIP_FILE_PATTERN, ColumnSpec, TableContract
from meterline.lake import Lake
from meterline.operators.rules import expect, expect_all_or_drop
from meterline.sources.drifted import evolve, misfits, read_groups, scan_drifted
from meterline.sources.footers import FileSchema, file_schemas
from meterline.streaming import events as log
from meterline.streaming import ingest as stream
from meterline.streaming.ingest import IngestConfig, ingest, rebuild_silver

CONTRACT = TableContract(
    columns=(
        ColumnSpec("id", "id", "BIGINT", "BIGINT", required=True),
        ColumnSpec("ts", "ts", "TIMESTAMP", "TIMESTAMP_NTZ", required=True),
        ColumnSpec("zone", "zone", "BIGINT"),
        ColumnSpec("n", "n", "BIGINT", recover=True),
        ColumnSpec("fee", "fee", "DECIMAL(10, 2)", "DOUBLE"),
    ),
    event_time="ts",
    file_pattern=TRIP_FILE_PATTERN,
)
RULES = expect_all_or_drop({"positive": "n >= 0"}) + expect(
    "month_matches_file", "pickup_year_month = file_year_month"
)
JANUARY = "id BIGINT, ts TIMESTAMP_NTZ, zone BIGINT, n DOUBLE, fee DOUBLE"
FEBRUARY = "id BIGINT, ts TIMESTAMP_NTZ, zone INT, n BIGINT, Fee DOUBLE"
MARCH = FEBRUARY + ", note STRING"


def land(spark, landing, month, ddl, ids, fn=lambda df: df):
    """Write one month's file with columns typed as ``ddl``."""
    fields = T.StructType.fromDDL(ddl).fields
    base = spark.createDataFrame([(i,) for i in ids], "id BIGINT").coalesce(1)
    made = {
        "id": F.col("id"),
        "ts": F.to_timestamp_ntz(F.lit(f"{month}-03 10:00:00")),
        "zone": F.col("id") % 5,
        "n": F.col("id") % 4,
        "fee": F.col("id") / 2,
        "note": F.concat(F.lit("n"), F.col("id")),
    }
    columns = [made[f.name.lower()].cast(f.dataType).alias(f.name) for f in fields]
    year, number = month.split("-")
    path = f"{landing}/year={year}/month={number}/yellow_tripdata_{month}.parquet"
    fn(base.select(*columns)).write.parquet(path)
    return path


@pytest.fixture()
def config(root):
    return IngestConfig(f"{root}/landing", Lake(f"{root}/lake"), CONTRACT, RULES)


@pytest.fixture()
def three_months(spark, config):
    land(spark, config.landing_dir, "2023-01", JANUARY, range(0, 10))
    land(spark, config.landing_dir, "2023-02", FEBRUARY, range(10, 20))
    land(spark, config.landing_dir, "2023-03", MARCH, range(20, 30))


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_drift_is_absorbed_or_rescued(spark, config, three_months):
    ingest(spark, config, "u1")
    bronze = store.read_bronze(spark, config.lake)
    assert ids(bronze) == list(range(30))
    types = {f.name: f.dataType.simpleString() for f in bronze.schema.fields}
    assert (types["zone"], types["n"], types["fee"]) == ("bigint", "double", "double")
    assert types["ts"] == "timestamp_ntz" and "Fee" not in bronze.columns
    rows = {r["id"]: r for r in bronze.collect()}
    assert rows[3]["n"] == 3.0 and rows[3]["_rescued_data"] is None
    rescued = json.loads(rows[13]["_rescued_data"])
    assert rows[13]["n"] is None and rescued["n"] == 1
    assert set(rescued) == {"n", "_file_path"}
    assert rescued["_file_path"] == rows[13]["_source_file_path"]
    assert all(rows[i]["fee"] == i / 2 and rows[i]["zone"] == i % 5 for i in range(30))
    assert rows[3]["note"] is None and rows[23]["note"] == "n23"

    silver = {r["id"]: r for r in store.read_silver(spark, config.lake, CONTRACT).collect()}
    assert sorted(silver) == list(range(30))
    assert all(silver[i]["n"] == i % 4 for i in range(30))
    assert silver[13]["file_year_month"] == silver[13]["pickup_year_month"] == "2023-02"
    assert "note" not in store.read_silver(spark, config.lake, CONTRACT).columns


def test_second_run_reads_nothing_and_a_new_file_only_itself(spark, config, three_months):
    ingest(spark, config, "u1")
    first = store.read_bronze(spark, config.lake).agg(F.max("_ingestion_ts")).first()[0]
    ingest(spark, config, "u2")
    assert store.read_bronze(spark, config.lake).agg(F.max("_ingestion_ts")).first()[0] == first
    land(spark, config.landing_dir, "2023-04", JANUARY, range(30, 40))
    ingest(spark, config, "u3")
    bronze = store.read_bronze(spark, config.lake)
    assert ids(bronze) == list(range(40))
    assert ids(bronze.where(F.col("_ingestion_ts") > F.lit(first))) == list(range(30, 40))
    assert ids(store.read_silver(spark, config.lake, CONTRACT)) == list(range(40))


def test_overwritten_file_is_not_read_again_but_full_refresh_does(spark, config):
    path = land(spark, config.landing_dir, "2023-01", JANUARY, range(3))
    ingest(spark, config, "u1")
    [name] = [f.split("/")[-1] for f in _files(path)]
    other = land(spark, config.lake.at("elsewhere"), "2023-01", JANUARY, range(100, 103))
    shutil.copy(_files(other)[0], f"{path}/{name}")
    _drop_checksums(path)
    ingest(spark, config, "u2")
    assert ids(store.read_bronze(spark, config.lake)) == [0, 1, 2]
    versions = ingest(spark, config, "u3", full_refresh=True)
    assert versions == {"bronze": 1, "silver": 1}
    assert ids(store.read_bronze(spark, config.lake)) == [100, 101, 102]
    assert ids(store.read_silver(spark, config.lake, CONTRACT)) == [100, 101, 102]
    land(spark, config.landing_dir, "2023-02", FEBRUARY, [7])
    ingest(spark, config, "u4")
    assert ids(store.read_silver(spark, config.lake, CONTRACT)) == [7, 100, 101, 102]


def _files(path):
    import glob

    return sorted(glob.glob(f"{path}/part-*.parquet"))


def _drop_checksums(path):
    import glob
    import os

    for f in glob.glob(f"{path}/.part-*.crc"):
        os.remove(f)


@pytest.mark.parametrize("broken", ["write_silver", "emit"])
def test_a_failed_batch_is_replayed_without_doubling(spark, config, three_months, monkeypatch, broken):
    original = getattr(stream, broken)
    calls = []

    def fail_once(*args, **kwargs):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("executor lost")
        return original(*args, **kwargs)

    monkeypatch.setattr(stream, broken, fail_once)
    with pytest.raises(StreamingQueryException, match="executor lost"):
        ingest(spark, config, "u1")
    ingest(spark, config, "u2")
    assert ids(store.read_bronze(spark, config.lake)) == list(range(30))
    assert ids(store.read_silver(spark, config.lake, CONTRACT)) == list(range(30))
    counted = {
        (r["flow"], r["rule"]): r["passed_records"] + r["failed_records"]
        for r in counters(spark, config).collect()
    }
    assert set(counted.values()) == {30}


def test_a_batch_replayed_after_its_events_counts_once(spark, config, three_months, monkeypatch):
    """The update is lost after it logged the batch and before the batch is committed."""
    original = stream.emit

    def lost(*args, **kwargs):
        original(*args, **kwargs)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(stream, "emit", lost)
    with pytest.raises(StreamingQueryException, match="driver lost"):
        ingest(spark, config, "u1")
    monkeypatch.setattr(stream, "emit", original)
    ingest(spark, config, "u2")
    assert ids(store.read_silver(spark, config.lake, CONTRACT)) == list(range(30))
    events = store.read_events(spark, config.lake)
    assert {r["passed_records"] + r["failed_records"] for r in counters(spark, config).collect()} == {30}
    assert {r["update_id"] for r in log.update_counters(events).collect()} == {"u2"}
    assert log.input_volume(events, "bronze").first()["files"] == 3
    # Both updates are in the log.
    assert {r["update_id"] for r in events.select("origin.update_id").distinct().collect()} == {"u1", "u2"}


def test_a_failed_update_leaves_its_progress(spark, config, three_months, monkeypatch):
    def fail(*args, **kwargs):
        raise RuntimeError("no space left")

    original = stream.write_silver
    monkeypatch.setattr(stream, "write_silver", fail)
    with pytest.raises(StreamingQueryException, match="no space left"):
        ingest(spark, config, "u1")
    seen = log.observability(store.read_events(spark, config.lake)).collect()
    details = [json.loads(r["details"]) for r in seen if r["event_type"] == log.FLOW_PROGRESS]
    by_flow = {d["flow"]: d for d in details}
    assert by_flow["bronze"]["status"] == "COMPLETED" and by_flow["bronze"]["num_output_rows"] == 30
    assert by_flow["silver"]["status"] == "FAILED" and "no space left" in by_flow["silver"]["error"]
    monkeypatch.setattr(stream, "write_silver", original)
    ingest(spark, config, "u2")
    assert {r["passed_records"] + r["failed_records"] for r in counters(spark, config).collect()} == {30}


def test_small_batches_give_the_same_tables(spark, root, three_months, config):
    ingest(spark, config, "u1")
    single = IngestConfig(
        config.landing_dir, Lake(f"{root}/lake2"), CONTRACT, RULES, max_files_per_batch=1
    )
    ingest(spark, single, "u1")
    bronze = store.read_bronze(spark, single.lake)
    assert bronze.select("batch_id").distinct().count() == 3
    columns = ["id", "ts", "zone", "fee", "note"]
    ours = sorted(map(repr, bronze.select(*columns).collect()))
    theirs = store.read_bronze(spark, config.lake).select(*columns).collect()
    assert ours == sorted(map(repr, theirs))
    silver = [
        sorted(map(repr, store.read_silver(spark, c.lake, CONTRACT).select("id", "n").collect()))
        for c in (config, single)
    ]
    assert silver[0] == silver[1]


def test_rebuild_equals_the_incremental_table(spark, config, three_months):
    ingest(spark, config, "u1")
    land(spark, config.landing_dir, "2023-04", MARCH, range(30, 35))
    ingest(spark, config, "u2")
    before = sorted(map(repr, store.read_silver(spark, config.lake, CONTRACT).collect()))
    assert rebuild_silver(spark, config, "u3") == 1
    after = store.read_silver(spark, config.lake, CONTRACT)
    assert sorted(map(repr, after.collect())) == before
    land(spark, config.landing_dir, "2023-05", MARCH, range(35, 36))
    ingest(spark, config, "u4")
    assert ids(store.read_silver(spark, config.lake, CONTRACT)) == list(range(36))


def counters(spark, config):
    versions = {x: store.current_version(spark, config.lake, x) for x in ("bronze", "silver")}
    return log.rule_counters(store.read_events(spark, config.lake), versions)


@pytest.mark.parametrize("clustered", [True, False])
def test_rebalanced_or_not_the_table_is_the_same(spark, config, three_months, clustered):
    fixed = dataclasses.replace(config, clustered_files=clustered)
    ingest(spark, fixed, "u1")
    assert ids(store.read_silver(spark, config.lake, CONTRACT)) == list(range(30))
    counted = counters(spark, config).where("flow = 'silver'")
    assert {r["passed_records"] + r["failed_records"] for r in counted.collect()} == {30}


def test_input_volume_is_logged(spark, config, three_months):
    ingest(spark, config, "u1")
    volume = log.input_volume(store.read_events(spark, config.lake), "bronze").first()
    assert volume["files"] == 3 and volume["bytes"] > 1000


def test_schema_is_recorded_only_when_it_changes(spark, config):
    for i in (1, 2, 3):
        land(spark, config.landing_dir, f"2023-0{i}", JANUARY if i < 3 else MARCH, [i])
        ingest(spark, config, f"u{i}")
    recorded = store.read(spark, config.lake.bronze(0, "schema"), store.SCHEMA_DDL)
    assert sorted(r["batch_id"] for r in recorded.collect()) == [-1, 0, 2]
    assert ids(store.read_bronze(spark, config.lake)) == [1, 2, 3]


def test_odd_file_names_are_taken_literally(spark, config):
    path = land(spark, config.landing_dir, "2023-01", JANUARY, range(3))
    [part] = _files(path)
    shutil.move(part, f"{path}/part [a] {{b}} x.parquet")
    _drop_checksums(path)
    ingest(spark, config, "u1")
    assert ids(store.read_silver(spark, config.lake, CONTRACT)) == [0, 1, 2]


def test_rules_drop_and_count(spark, config):
    negative = lambda df: df.withColumn("n", F.when(F.col("id") < 4, -1.0).otherwise(F.col("n")))
    land(spark, config.landing_dir, "2023-01", JANUARY, range(10), negative)
    ingest(spark, config, "u1")
    assert ids(store.read_silver(spark, config.lake, CONTRACT)) == list(range(4, 10))
    counted = {
        r["rule"]: r["failed_records"]
        for r in counters(spark, config).collect()
    }
    assert counted["positive"] == 4 and counted["no_cast_loss"] == 0


def test_values_outside_their_type_become_null_and_are_counted(spark, config):
    huge = lambda df: df.withColumn("fee", F.when(F.col("id") == 1, 1e12).otherwise(F.col("fee")))
    land(spark, config.landing_dir, "2023-01", JANUARY, range(3), huge)
    ingest(spark, config, "u1")
    silver = {r["id"]: r["fee"] for r in store.read_silver(spark, config.lake, CONTRACT).collect()}
    assert silver[1] is None and len(silver) == 3
    counted = counters(spark, config).where("rule = 'no_cast_loss'")
    assert counted.first()["failed_records"] == 1


def test_missing_required_column_is_named(spark, config):
    land(spark, config.landing_dir, "2023-01", "ts TIMESTAMP_NTZ, n DOUBLE", range(3))
    contract = TableContract(
        columns=(ColumnSpec("vendor", "vendor", "INT", required=True), *CONTRACT.columns),
        event_time="ts",
        file_pattern=TRIP_FILE_PATTERN,
    )
    needy = IngestConfig(config.landing_dir, config.lake, contract, RULES)
    with pytest.raises(StreamingQueryException, match="missing required columns: vendor"):
        ingest(spark, needy, "u1")


def test_conform_names_all_absent_columns(spark, config):
    land(spark, config.landing_dir, "2023-01", "id BIGINT, ts TIMESTAMP_NTZ", range(3))
    with pytest.raises(StreamingQueryException, match="lacks contract columns: zone, n"):
        ingest(spark, config, "u1")


def test_month_partitions_are_pruned(spark, config, three_months):
    ingest(spark, config, "u1")
    silver = store.read_silver(spark, config.lake, CONTRACT)
    text = (
        silver.where("pickup_year_month = '2023-02'")
        .select("n")
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "PartitionFilters: [isnotnull(pickup_year_month" in text
    assert "ReadSchema: struct<n:bigint>" in text


# --- the schema rules by themselves ---------------------------------------------------


def schema(ddl):
    return T.StructType.fromDDL(ddl)


@pytest.mark.parametrize(
    ("table", "file", "result"),
    [
        ("a INT", "a BIGINT", "a bigint"),
        ("a BIGINT", "a INT", "a bigint"),
        ("a INT", "a DOUBLE", "a double"),
        ("a FLOAT", "a DOUBLE", "a double"),
        ("a BIGINT", "a DECIMAL(20,0)", "a decimal(20,0)"),
        ("a BIGINT", "a DOUBLE", "a bigint"),
        ("a DOUBLE", "a BIGINT", "a double"),
        ("a STRING", "a INT", "a string"),
        ("a INT", "A INT, b STRING", "a int, b string"),
    ],
)
def test_evolution(table, file, result):
    got = evolve(schema(table), [], [schema(file)])
    assert ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in got.fields) == result


def test_anchored_columns_never_change_type():
    got = evolve(schema("a INT"), ["a"], [schema("A BIGINT")])
    assert got.simpleString() == "struct<a:int>"
    assert [f.name for f in misfits(got, ["a"], schema("A BIGINT"))] == ["A"]
    assert [f.name for f in misfits(schema("a BIGINT"), ["a"], schema("a INT"))] == ["a"]
    assert misfits(schema("a BIGINT"), [], schema("a INT")) == ()


def test_new_column_with_two_types_takes_the_first_and_rescues_the_other():
    files = [schema("a INT, x STRING"), schema("a INT, x INT")]
    got = evolve(schema("a INT"), [], files)
    assert got.simpleString() == "struct<a:int,x:string>"
    assert [f.name for f in misfits(got, [], files[1])] == ["x"]


def test_groups_follow_retypings_not_files():
    table = schema("a BIGINT, b DOUBLE, c STRING")
    files = [FileSchema(f"f{i}", schema("a INT, b DOUBLE")) for i in range(50)]
    files += [FileSchema(f"g{i}", schema("A BIGINT, B DOUBLE, c STRING")) for i in range(50)]
    files += [FileSchema(f"h{i}", schema("a INT, b BIGINT")) for i in range(50)]
    groups = read_groups(table, [], files)
    assert sorted((len(g.paths), tuple(f.name for f in g.misfits)) for g in groups) == [
        (50, ("b",)),
        (100, ()),
    ]


@pytest.mark.parametrize(
    ("file_type", "table_type", "value", "expected"),
    [
        ("INT", "BIGINT", "7", 7),
        ("INT", "DOUBLE", "7", 7.0),
        ("INT", "DECIMAL(20,0)", "7", 7),
        ("INT", "DECIMAL(22,2)", "7", 7),
        ("BIGINT", "DECIMAL(20,0)", "7", 7),
        ("BIGINT", "DECIMAL(22,2)", "7", 7),
        ("FLOAT", "DOUBLE", "1.5", 1.5),
        ("TINYINT", "SMALLINT", "7", 7),
        ("TINYINT", "INT", "7", 7),
        ("TINYINT", "BIGINT", "7", 7),
        ("TINYINT", "DOUBLE", "7", 7.0),
        ("SMALLINT", "INT", "7", 7),
        ("SMALLINT", "BIGINT", "7", 7),
        ("SMALLINT", "DOUBLE", "7", 7.0),
    ],
)
def test_every_widening_reads_natively(spark, root, file_type, table_type, value, expected):
    spark.sql(f"SELECT CAST({value} AS {file_type}) AS a").write.parquet(f"{root}/f")
    files = file_schemas(spark, spark.read.format("binaryFile").load(f"{root}/f/*.parquet"))
    table = schema(f"a {table_type}")
    assert read_groups(table, [], files)[0].misfits == ()
    row = scan_drifted(spark, table, [], files).first()
    assert row["a"] == expected and row["_rescued_data"] is None


@pytest.mark.parametrize(
    ("file_value", "table_type", "expected"),
    [
        ("CAST(7 AS BIGINT)", "DOUBLE", 7),
        ("CAST(7.5 AS DOUBLE)", "BIGINT", 7.5),
        ("'x'", "INT", "x"),
        ("DATE'2023-01-02'", "BIGINT", "2023-01-02"),
        ("array(1, 2)", "INT", [1, 2]),
        ("named_struct('p', 1)", "INT", {"p": 1}),
    ],
)
def test_every_other_retyping_is_rescued(spark, root, file_value, table_type, expected):
    spark.sql(f"SELECT {file_value} AS a").write.parquet(f"{root}/f")
    files = file_schemas(spark, spark.read.format("binaryFile").load(f"{root}/f/*.parquet"))
    row = scan_drifted(spark, schema(f"a {table_type}"), [], files).first()
    assert row["a"] is None and json.loads(row["_rescued_data"])["a"] == expected


def test_null_in_a_retyped_column_rescues_nothing(spark, root):
    spark.sql("SELECT CAST(NULL AS BIGINT) AS a").write.parquet(f"{root}/f")
    files = file_schemas(spark, spark.read.format("binaryFile").load(f"{root}/f/*.parquet"))
    row = scan_drifted(spark, schema("a DOUBLE"), [], files).first()
    assert row["a"] is None and row["_rescued_data"] is None


def test_unreadable_footers_fall_back_to_spark(spark, root, monkeypatch):
    from meterline.sources import footers

    spark.range(3).write.parquet(f"{root}/f")
    files = spark.read.format("binaryFile").load(f"{root}/f/*.parquet")
    failing = files.select(
        "path", "length", F.lit(None).cast("string").alias("schema"), F.lit("no store").alias("error")
    )
    monkeypatch.setattr(footers, "read_footers", lambda _: failing)
    found = file_schemas(spark, files)
    assert {f.schema.simpleString() for f in found} == {"struct<id:bigint>"}


def test_files_older_than_all_others_are_ingested(spark, config):
    for age, i in ((0, 1), (30, 2), (400, 3)):
        path = land(spark, config.landing_dir, f"2023-0{i}", JANUARY, [i])
        past = os.path.getmtime(_files(path)[0]) - age * 86_400
        for name in _files(path):
            os.utime(name, (past, past))
        ingest(spark, config, f"u{i}")
    assert ids(store.read_bronze(spark, config.lake)) == [1, 2, 3]


def test_counters_are_those_of_the_published_version(spark, config, three_months):
    ingest(spark, config, "u1")
    before = sorted(map(tuple, counters(spark, config).collect()))
    rebuild_silver(spark, config, "u2")
    assert sorted(map(tuple, counters(spark, config).collect())) == before
    ingest(spark, config, "u3", full_refresh=True)
    assert sorted(map(tuple, counters(spark, config).collect())) == before
    each = log.update_counters(store.read_events(spark, config.lake)).where("flow = 'silver'")
    assert {(r["update_id"], r["version"]) for r in each.collect()} == {("u1", 0), ("u2", 1), ("u3", 2)}


def test_a_recased_and_retyped_column_is_recovered_or_counted_as_lost(spark, config):
    columns = (
        ColumnSpec("id", "id", "BIGINT", "BIGINT", required=True),
        ColumnSpec("ts", "ts", "TIMESTAMP", "TIMESTAMP_NTZ"),
        ColumnSpec("value", "value", "DOUBLE", recover=True),
    )
    contract = TableContract(columns=columns, event_time="ts", file_pattern=config.contract.file_pattern)
    own = IngestConfig(config.landing_dir, config.lake, contract, config.rules[:0])
    start = spark.range(3).select("id", F.lit("2023-01-05 10:00:00").cast("timestamp_ntz").alias("ts"))
    for month, value in (
        ("01", F.lit(1.5).alias("value")),
        ("02", F.lit(3).cast("bigint").alias("Value")),
        ("03", F.lit("no number").alias("VALUE")),
    ):
        folder = f"{config.landing_dir}/year=2023/month={month}/yellow_tripdata_2023-{month}.parquet"
        start.select("id", "ts", value).write.parquet(folder)
        ingest(spark, own, f"u{month}")
    values = [r["value"] for r in store.read_silver(spark, config.lake, contract).collect()]
    assert sorted(values, key=str) == [1.5] * 3 + [3.0] * 3 + [None] * 3
    lost = counters(spark, own).where("rule = 'no_cast_loss'").first()
    assert (lost["passed_records"], lost["failed_records"]) == (6, 3)


def test_files_without_required_columns_are_named_or_refused(spark, config):
    land(spark, config.landing_dir, "2023-01", JANUARY, range(3))
    bad = land(spark, config.landing_dir, "2023-02", JANUARY, range(3), lambda df: df.drop("id"))
    ingest(spark, config, "u1")
    rows = log.lacking_columns(store.read_events(spark, config.lake)).collect()
    assert [r["missing"] for r in rows] == ["id"] and bad in rows[0]["path"]
    strict = dataclasses.replace(config, lake=Lake(f"{config.lake.root}2"), refuse_missing=True)
    with pytest.raises(Exception, match="missing required columns"):
        ingest(spark, strict, "u2")


def test_a_batch_is_read_from_its_own_folder(spark, config):
    for i in (1, 2, 3):
        land(spark, config.landing_dir, f"2023-0{i}", JANUARY, [i])
        ingest(spark, config, f"u{i}")
    one = store.read_bronze(spark, config.lake, 0, 1)
    assert ids(one) == [2] and [r["batch_id"] for r in one.select("batch_id").collect()] == [1]
    assert all("batch_id=1/" in f for f in one.inputFiles())


def test_a_batch_with_misdated_rows_leaves_no_tail_of_small_files(spark, config):
    when = F.to_timestamp_ntz(F.expr("timestamp_ntz'2022-01-15 00:00:00' + make_interval(0, id % 12)"))
    for i in (1, 2, 3):
        land(spark, config.landing_dir, f"2023-0{i}", JANUARY, range(36), lambda df: df.withColumn("ts", when))
    ingest(spark, config, "u1")
    files = store.read_silver(spark, config.lake, CONTRACT).inputFiles()
    assert len(files) == 12
