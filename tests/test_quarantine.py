"""Refused rows beside the canonical table."""

from __future__ import annotations

import dataclasses

import pytest
from pyspark.sql import functions as F
from test_corrections import config, reland  # noqa: F401
from test_ingest import CONTRACT, FEBRUARY, JANUARY, ids, land

from meterline import lake as store
from meterline.operators import runs
from meterline.streaming import ingest as stream
from meterline.streaming.corrections import replace_months
from meterline.streaming.ingest import ingest, rebuild_silver


def refused(spark, config):  # noqa: F811
    rows = store.read_refused(spark, config.lake, CONTRACT).collect()
    return sorted((r["id"], r["_reasons"]) for r in rows)


def test_refused_rows_are_kept_with_their_reasons(spark, config, monkeypatch):  # noqa: F811
    own = dataclasses.replace(config, quarantine=True)
    bad = lambda df: df.withColumn("n", F.when(F.col("id") % 10 > 2, F.col("n")).otherwise(-F.col("n") - 1))
    land(spark, own.landing_dir, "2023-01", JANUARY, range(10), bad)
    original = stream.record_files
    monkeypatch.setattr(stream, "record_files", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        ingest(spark, own, "u0")
    monkeypatch.setattr(stream, "record_files", original)
    ingest(spark, own, "u1")
    assert ids(store.read_silver(spark, own.lake, CONTRACT)) == list(range(3, 10))
    assert refused(spark, own) == [(i, ["positive"]) for i in range(3)]
    # A batch with nothing refused, and one with nothing kept.
    land(spark, own.landing_dir, "2023-02", FEBRUARY, range(13, 16))
    ingest(spark, own, "u2")
    land(spark, own.landing_dir, "2023-03", JANUARY, range(20, 22), bad)
    ingest(spark, own, "u3")
    assert ids(store.read_silver(spark, own.lake, CONTRACT)) == [*range(3, 10), 13, 14, 15]
    assert [i for i, _ in refused(spark, own)] == [0, 1, 2, 20, 21]
    rebuild_silver(spark, own, "u4")
    assert ids(store.read_silver(spark, own.lake, CONTRACT)) == [*range(3, 10), 13, 14, 15]
    assert [i for i, _ in refused(spark, own)] == [0, 1, 2, 20, 21]
    # A corrected month takes its refused rows away, too.
    reland(spark, own, "2023-01", JANUARY, [50])
    assert replace_months(spark, own, "fix") == ["2023-01"]
    assert ids(store.read_silver(spark, own.lake, CONTRACT)) == [13, 14, 15, 50]
    assert [i for i, _ in refused(spark, own)] == [20, 21]


def test_outcomes_outside_their_domains_are_named(spark):
    rows = [("2023-01", "DOWNLOADED", "OK"), ("2023-13", "DONE", None), (None, None, "OK")]
    df = spark.createDataFrame(rows, "month string, status string, probe_status string")
    got = [r["_reasons"] for r in runs.judged_outcomes(df).collect()]
    assert got == [[], ["status: DONE", "probe_status: NULL", "month: 2023-13"], ["status: NULL", "month: NULL"]]
