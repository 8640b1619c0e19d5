"""Both jobs end to end on trips derived from the given tables."""

from __future__ import annotations

import glob
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from meterline import lake as store
from meterline.lake import Lake
from meterline.operators import checks, runs
from meterline.plans import jobs
from meterline.plans.given import raw_trips
from meterline.plans.ingest_queries import land_trips
from meterline.streaming import events as log
from meterline.streaming.ingest import IngestConfig

DIM_ROWS = [(i, f"B{i % 5}", f"Z{i}", "any") for i in range(25)]
DIM_DDL = "location_id int, borough string, zone string, service_zone string"


@pytest.fixture(scope="module")
def landed(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landed"))
    land_trips(spark, sf_dir, root, f"{root}/landing")
    return f"{root}/landing"


@pytest.fixture(scope="module")
def dim_csv(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("dim")) + "/csv"
    spark.createDataFrame(DIM_ROWS, DIM_DDL).write.option("header", "true").csv(path)
    return path


@pytest.fixture(scope="module")
def config(landed, tmp_path_factory):
    return IngestConfig(landed, Lake(str(tmp_path_factory.mktemp("lake"))))


RUN = jobs.RunInfo("1997-01", "1997-03", "run-1", "job-1", "https://jobs/1")


@pytest.fixture(scope="module")
def ingested(spark, config):
    return jobs.run_ingestion(spark, config, RUN)


def test_marts_refuse_to_build_before_the_first_run(spark, landed, dim_csv, tmp_path):
    empty = IngestConfig(landed, Lake(str(tmp_path)))
    store.ensure(spark, empty.lake)
    with pytest.raises(runs.NoCompleteRunError):
        jobs.build_marts(spark.range(0), store.read_audit(spark, empty.lake), spark.range(0))


def test_run_without_probes_uses_what_has_landed(spark, config, ingested):
    assert ingested["status"] == "SUCCESS"
    assert ingested["months_skipped"] == ["1997-01", "1997-02", "1997-03"]
    assert ingested["bytes_downloaded"] == 0 and ingested["bytes_total_in_volume"] > 0
    assert {p["probe_status"] for p in ingested["probe_results"]} == {"CONN_ERR"}


def test_run_is_completed_with_the_update_it_started(spark, config, ingested):
    audit = store.read_audit(spark, config.lake).first()
    events = store.read_events(spark, config.lake)
    assert audit["pipeline_update_id"] == log.latest_update_id(events).first()["update_id"]
    assert jobs.complete_run(spark, config.lake, RUN.job_run_id) == 0
    assert jobs.complete_run(spark, config.lake, "unknown") == 0


def test_observability_view_shows_flows_rules_and_final_state(spark, config, ingested):
    view = spark.table("pipeline_observability")
    assert view.columns == ["timestamp", "event_type", "message", "details"]
    kinds = [r["event_type"] for r in view.collect()]
    assert set(kinds) == set(log.OBSERVED_EVENTS)
    assert kinds[0] == log.PIPELINE_DONE
    stamps = [r["timestamp"] for r in view.collect()]
    assert stamps == sorted(stamps, reverse=True)


def test_modelling_builds_views_and_reports_failing_tests(spark, config, ingested, dim_csv):
    # vendors 3, 4 and 5 are outside the dictionary: exactly one error is expected
    with pytest.raises(checks.DataTestError) as caught:
        jobs.run_modelling(spark, config, dim_csv, "1997-03")
    assert str(caught.value).count("failing") == 1
    assert "accepted_values(silver.vendor_id)" in str(caught.value)
    months = [r[0] for r in spark.table("monthly_avg_total_amount").collect()]
    assert months == ["1997-01", "1997-02", "1997-03"]
    assert 20 <= spark.table("hourly_avg_passenger_count").count() <= 24
    assert spark.table("flow_matrix").agg(F.sum("trip_count")).first()[0] == (
        spark.table("consumption").count()
    )
    assert spark.table("consumption").columns == [
        "vendor_id", "passenger_count", "total_amount", "pickup_at", "dropoff_at",
        "pickup_year_month", "pickup_hour", "pickup_location_id", "dropoff_location_id",
        "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone",
    ]
    types = dict(spark.table("monthly_avg_total_amount").dtypes)
    assert types["avg_total_amount"] == "decimal(14,6)"


def test_all_declared_tests_are_there(spark, config, ingested, dim_csv):
    dim = spark.read.parquet(config.lake.locations)
    silver = store.read_silver(spark, config.lake, config.contract)
    built = jobs.build_marts(silver, store.read_audit(spark, config.lake), dim, "1997-03")
    summary = checks.summarize(checks.trip_checks(silver, *vars(built).values(), dim)).collect()
    assert spark.table("location_pairs").agg(F.sum("trips")).first()[0] == built.consumption.count()
    kinds = [r["test"] for r in summary]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 15, "unique": 2, "relationships": 2, "accepted_values": 1, "freshness": 1,
    }
    assert [r["severity"] for r in summary if r["test"] == "freshness"] == ["warn"]
    assert {r["status"] for r in summary if r["test"] != "accepted_values"} == {"pass"}


def test_no_job_runs_while_marts_of_a_measured_dimension_are_planned(spark, config, ingested, dim_csv, monkeypatch):
    from meterline.operators import marts

    store.load_seed(jobs.read_csv_dimension(spark, dim_csv), config.lake.locations)
    size = store.seed_bytes(spark, config.lake.locations)
    dim = spark.read.parquet(config.lake.locations)
    assert size == marts.measured_bytes(dim) > 0
    assert store.seed_bytes(spark, config.lake.at("nowhere")) is None
    monkeypatch.setattr(marts, "measured_bytes", lambda d: pytest.fail("measured again"))
    silver = store.read_silver(spark, config.lake, config.contract)
    audit = store.read_audit(spark, config.lake)
    for n, hints in ((size, 2), (1 << 40, 0)):
        built = jobs.build_marts(silver, audit, dim, "1997-03", n)
        text = built.consumption._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("rightHint=(strategy=broadcast)") == hints
    of_silver = checks.trip_checks(silver, *vars(built).values(), dim)[0].collect()
    assert {r["test"] for r in of_silver} == {"not_null", "accepted_values", "freshness"}


def test_window_follows_the_newest_complete_run(spark, config, ingested, dim_csv):
    jobs.run_ingestion(spark, config, jobs.RunInfo("2000-01", "2000-02", "run-2", "job-2", "url"))
    dim = spark.read.parquet(config.lake.locations)
    silver = store.read_silver(spark, config.lake, config.contract)
    built = jobs.build_marts(silver, store.read_audit(spark, config.lake), dim)
    months = [r[0] for r in built.monthly_avg_total_amount.collect()]
    assert months == ["2000-01", "2000-02"]


def test_partial_run_completes_and_a_failed_one_raises(spark, landed, tmp_path):
    config = IngestConfig(landed, Lake(str(tmp_path)))
    log_rows = spark.createDataFrame(
        [("2001-08", 200, None, True, 10), ("2030-01", None, "ReadTimeout", None, None)],
        jobs.PROBE_LOG_DDL,
    )
    with pytest.raises(jobs.LandingFailedError, match="all months failed.*2031-01, 2031-02"):
        jobs.run_ingestion(spark, config, jobs.RunInfo("2031-01", "2031-02", "f", "f", "f"))
    assert store.read_audit(spark, config.lake).first()["pipeline_update_id"] is None
    row = jobs.audit_landing(
        spark, config.lake, jobs.RunInfo("2001-08", "2001-09", "p", "p", "p"), landed, log_rows,
        datetime(2026, 1, 1),
    )
    assert row["status"] == "PARTIAL" and row["error_message"] == "failed months: 2001-09"
    assert row["months_downloaded"] == ["2001-08"] and row["bytes_downloaded"] == 10


def test_missing_landing_folder_is_a_failed_run_then_fills_up(spark, tmp_path):
    config = IngestConfig(str(tmp_path / "landing"), Lake(str(tmp_path / "lake")))
    run = jobs.RunInfo("2023-01", "2023-01", "r", "j", "u")
    with pytest.raises(jobs.LandingFailedError, match="VOLUME_PREEXISTING"):
        jobs.run_ingestion(spark, config, run)
    assert store.read_audit(spark, config.lake).first()["status"] == "FAILED"
    source = f"{tmp_path}/landing/year=2023/month=01/yellow_tripdata_2023-01.parquet"
    raw_trips(spark, "/root/testdata/sf0.001").select(
        *[c.source for c in config.contract.columns]
    ).limit(50).write.parquet(source)
    row = jobs.run_ingestion(spark, config, run)
    assert row["status"] == "SUCCESS"
    assert store.read_bronze(spark, config.lake).count() == 50
    for _ in range(2):
        jobs.ensure_landing(spark, config.landing_dir)
    assert jobs.landed_files(spark, config.landing_dir).count() >= 1


def test_failing_update_is_logged(spark, landed, tmp_path, monkeypatch):
    config = IngestConfig(landed, Lake(str(tmp_path)))
    monkeypatch.setattr(jobs, "ingest", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        jobs.run_ingestion(spark, config, RUN)
    done = store.read_events(spark, config.lake).where(F.col("event_type") == log.PIPELINE_DONE)
    assert [r["message"] for r in done.collect()] == ["update FAILED"]
    assert store.read_audit(spark, config.lake).first()["pipeline_update_id"] is None


def test_seed_reload_is_idempotent(spark, config, ingested, dim_csv):
    for _ in range(2):
        store.load_seed(jobs.read_csv_dimension(spark, dim_csv), config.lake.locations)
    assert spark.read.parquet(config.lake.locations).count() == len(DIM_ROWS)


def test_a_hot_month_is_many_tasks_and_cold_months_are_one_file(spark, tmp_path):
    """Nine rows in ten belong to one month: rebalancing splits it and merges the rest."""
    rows = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 10 > 0, "2023-01")
        .otherwise(F.concat(F.lit("2022-1"), F.col("id") % 3))
        .alias("m"),
        F.rand(1).alias("v"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "300k")
    try:
        store.write_by_month(store.rebalance(rows, "m"), str(tmp_path / "t"), ["m"])
    finally:
        spark.conf.unset(key)
    files = {m: len(glob.glob(f"{tmp_path}/t/m={m}/*.parquet")) for m in ("2023-01", "2022-10")}
    assert files["2023-01"] >= 4 and files["2022-10"] == 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


def test_registered_views_equal_the_frames(spark, config, ingested, dim_csv):
    from meterline.plans import catalog
    from meterline.sources.tables import read_table

    store.load_seed(jobs.read_csv_dimension(spark, dim_csv), config.lake.locations)
    for _ in range(2):
        catalog.register_tables(spark, config, "lab_marts")
        catalog.publish_marts(spark, "lab_marts", "2000-02")
    audit = store.read_audit(spark, config.lake)
    stored = read_table(spark, "landing_audit", "marts", prefix="lab_")
    assert stored.columns == audit.columns
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, audit.collect()))
    silver = store.read_silver(spark, config.lake, config.contract)
    built = jobs.build_marts(silver, audit, spark.read.parquet(config.lake.locations), "2000-02")
    for name, frame in vars(built).items():
        if name == "location_pairs":
            continue
        view = read_table(spark, name, "marts", prefix="lab_")
        assert view.dtypes == frame.dtypes, name
        assert sorted(map(repr, view.collect())) == sorted(map(repr, frame.collect())), name
    seen = read_table(spark, "pipeline_observability", "marts", prefix="lab_")
    expected = log.observability(store.read_events(spark, config.lake))
    assert seen.count() == expected.count() > 0
    plan = spark.table("lab_marts.monthly_avg_total_amount")._jdf.queryExecution()
    assert "PartitionFilters: [isnotnull(pickup_year_month" in plan.executedPlan().toString()


def test_registered_trips_follow_the_published_version(spark, config, ingested):
    from meterline.plans import catalog
    from meterline.streaming.ingest import rebuild_silver

    before = spark.table("lab_marts.trips").count()
    rebuild_silver(spark, config, "again")
    catalog.register_tables(spark, config, "lab_marts")
    assert spark.table("lab_marts.trips").count() == before
    assert spark.table("lab_marts.trips").inputFiles()[0].count(f"silver/v{1}/") == 1
