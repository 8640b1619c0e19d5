"""Every registered query against its SQL on another engine, over the same whole tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.QUERIES, entry.ORACLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    expected = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(expected.columns)
    ours = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _sorted_rows(expected.columns, expected.fetchall())
    assert ours, "no rows"
    assert ours == theirs


def test_entry_is_a_stable_frame(spark):
    df = entry.entry(spark)
    assert df.columns == ["pickup_year_month", "avg_total_amount", "trip_count"]
    assert df.count() > 0


ORDERED = {
    "monthly_avg_amount": ("pickup_year_month", False),
    "hourly_avg_quantity_month": ("pickup_hour", False),
    "flow_matrix": ("trip_count", True),
    "observability_view": ("timestamp", True),
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_marts_are_sorted(spark, sf_dir, name):
    column, descending = ORDERED[name]
    values = [r[column] for r in QUERIES[name](spark, sf_dir).collect()]
    assert values == sorted(values, reverse=descending)
