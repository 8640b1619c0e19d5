"""Queries against their SQL on another engine, over the same whole tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from meterline.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    ours = QUERIES[name](spark, sf_dir)
    theirs = duck.sql(ORACLES[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    got = rows_of(ours.columns, [tuple(r) for r in ours.collect()])
    assert got and got == rows_of(theirs.columns, theirs.fetchall())
