from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from meterline.operators import runs

RUN_DDL = (
    "run_id string, job_run_id string, job_url string, job_start_ts timestamp, "
    "job_end_ts timestamp, source_mode string, start_year_month string, end_year_month string"
)
OUTCOME_DDL = (
    "run_id string, seq int, month string, status string, bytes_downloaded bigint, "
    "bytes_in_volume bigint, probe_status string, http_code int"
)
T0 = datetime(2026, 1, 1)


def run(spark, start, end, mode="HTTP"):
    return spark.createDataFrame([("r", "j", "url", T0, T0, mode, start, end)], RUN_DDL)


def outcome(month, status="DOWNLOADED", down=0, size=0, probe="OK", code=200, seq=0):
    return ("r", seq, month, status, down, size, probe, code)


def collapse(spark, start, end, rows, mode="HTTP"):
    outcomes = spark.createDataFrame(rows, OUTCOME_DDL)
    return runs.collapse_runs(run(spark, start, end, mode), outcomes).first()


def test_columns_and_order():
    assert len(runs.LANDING_AUDIT_COLUMNS) == 18
    assert runs.LANDING_AUDIT_COLUMNS[:4] == (
        "run_id", "job_run_id", "job_url", "pipeline_update_id",
    )
    nullable = {f.name for f in runs.LANDING_AUDIT_SCHEMA.fields if f.nullable}
    assert nullable == {"pipeline_update_id", "error_message"}


def plain_fold(months, rows):
    """What the audit row says, computed month by month."""
    last = {}
    for r in sorted(rows, key=lambda r: r[1]):
        last[r[2]] = r
    seen = [last[m] for m in months if m in last]
    by = {s: [r[2] for r in seen if r[3] == s] for s in ("DOWNLOADED", "SKIPPED_EXISTING", "FAILED")}
    return {
        "months_requested": list(months),
        "months_downloaded": by["DOWNLOADED"],
        "months_skipped": by["SKIPPED_EXISTING"],
        "months_failed": by["FAILED"],
        "bytes_downloaded": sum(r[4] for r in seen if r[3] == "DOWNLOADED"),
        "bytes_total_in_volume": sum(r[5] for r in seen),
        "probe_results": [(r[2], r[6], r[7]) for r in seen],
    }


@pytest.mark.parametrize("seed", range(6))
def test_collapse_equals_a_plain_fold(spark, seed):
    rng = random.Random(seed)
    months = [f"{1888 + k // 12}-{k % 12 + 1:02d}" for k in range(7, 7 + rng.randint(1, 20))]
    kinds = [["DOWNLOADED"], ["FAILED"], ["DOWNLOADED", "SKIPPED_EXISTING", "FAILED"]][seed % 3]
    rows = []
    for m in months:
        for seq in range(rng.randint(1, 3)):
            status, size = rng.choice(kinds), rng.randint(1, 10**9)
            down = {"DOWNLOADED": size}.get(status, 0)
            held = 0 if status == "FAILED" else size
            probe = rng.choice([("OK", 207), ("TIMEOUT", None), ("CONN_ERR", None), ("HTTP_ERR", 418)])
            rows.append(outcome(m, status, down, held, *probe, seq=seq))
    rng.shuffle(rows)
    row = collapse(spark, months[0], months[-1], rows)
    want = plain_fold(months, rows)
    for name, value in want.items():
        got = row[name]
        assert ([tuple(x) for x in got] if name == "probe_results" else got) == value, name
    failed = want["months_failed"]
    status = "SUCCESS" if not failed else "FAILED" if failed == months else "PARTIAL"
    assert row["status"] == status and row["pipeline_update_id"] is None
    assert (row["error_message"] is None) == (status == "SUCCESS")
    for m in failed:
        assert m in row["error_message"]
    assert ("VOLUME_PREEXISTING" in (row["error_message"] or "")) == (status == "FAILED")


def test_last_outcome_of_a_month_wins(spark):
    rows = [outcome("1901-11", "FAILED", seq=1), outcome("1901-11", down=5, size=5, seq=2)]
    row = collapse(spark, "1901-11", "1901-11", rows[::-1])
    assert row["status"] == "SUCCESS" and row["bytes_downloaded"] == 5


def test_months_outside_the_window_do_not_count(spark):
    row = collapse(
        spark, "1901-11", "1901-12",
        [outcome("1901-11", down=1, size=1), outcome("1903-05", "FAILED"), outcome("junk", "FAILED")],
    )
    assert row["status"] == "SUCCESS" and row["months_failed"] == []
    only_outside = collapse(spark, "1901-11", "1901-12", [outcome("1903-05", "FAILED")])
    assert only_outside["status"] == "SUCCESS" and only_outside["probe_results"] == []


@pytest.mark.parametrize(
    ("rows", "mode", "text"),
    [
        ([], "HTTP", "at least one month outcome"),
        ([outcome("1901-11", "HALFWAY")], "HTTP", "invalid month status"),
        ([outcome("1901-11", probe="PERHAPS")], "HTTP", "invalid probe_status"),
        ([outcome("1901-11")], "PIGEON", "invalid source_mode"),
    ],
)
def test_bad_input_raises(spark, rows, mode, text):
    with pytest.raises(PySparkException, match=text):
        collapse(spark, "1901-11", "1901-11", rows, mode)


def test_a_run_with_many_repeats_reaches_its_group_as_one_entry_per_month(spark):
    rows = [outcome("1901-11", seq=i, down=i, size=i) for i in range(2000)]
    row = collapse(spark, "1901-11", "1901-12", rows)
    assert row["bytes_downloaded"] == 1999 and len(row["probe_results"]) == 1


AUDIT_DDL = (
    "run_id string, job_run_id string, job_start_ts timestamp, pipeline_update_id string, "
    "start_year_month string, end_year_month string"
)


@pytest.fixture()
def audit(spark):
    t = [datetime(2026, 1, d) for d in (1, 2, 3)]
    return spark.createDataFrame(
        [
            ("r1", "j1", t[0], "u1", "1996-01", "1996-05"),
            ("r2", "j2", t[1], "u2", "1997-03", "1997-03"),
            ("r3", "j3", t[2], None, "1998-01", "1998-12"),
        ],
        AUDIT_DDL,
    )


def test_latest_complete_run_ignores_incomplete_ones(audit):
    assert runs.latest_complete_run(audit).first()["run_id"] == "r2"
    assert runs.count_complete_runs(audit).first()["n"] == 2


def test_guard(audit):
    runs.require_complete_run(audit)
    with pytest.raises(runs.NoCompleteRunError, match="ingestion job"):
        runs.require_complete_run(audit.where("pipeline_update_id IS NULL"))
    with pytest.raises(runs.NoCompleteRunError):
        runs.require_complete_run(audit.limit(0))
    assert runs.latest_complete_run(audit.limit(0)).count() == 0


def test_late_fill_is_applied_once_and_only_where_empty(spark, audit):
    now = F.lit("2026-02-01").cast("timestamp")
    pending = runs.pending_completion(audit, "j3", "u9", now)
    assert pending.count() == 1
    filled = runs.with_completions(audit, pending)
    assert {r["run_id"]: r["pipeline_update_id"] for r in filled.collect()} == {
        "r1": "u1", "r2": "u2", "r3": "u9",
    }
    assert runs.pending_completion(filled, "j3", "u10", now).count() == 0
    assert runs.pending_completion(audit, "j1", "u10", now).count() == 0
    assert runs.pending_completion(audit, "nobody", "u10", now).count() == 0
    assert runs.latest_complete_run(filled).first()["run_id"] == "r3"


def test_first_of_two_completions_counts(spark, audit):
    now = F.lit("2026-02-01").cast("timestamp")
    later = F.lit("2026-02-02").cast("timestamp")
    both = runs.pending_completion(audit, "j3", "late", later).unionByName(
        runs.pending_completion(audit, "j3", "early", now)
    )
    filled = runs.with_completions(audit, both).where("run_id = 'r3'").first()
    assert filled["pipeline_update_id"] == "early"
