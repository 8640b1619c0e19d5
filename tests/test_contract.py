from __future__ import annotations

import pytest
from pyspark.sql import types as T

from meterline.contract import (
    TRIPS,
    ColumnSpec,
    SchemaContractError,
    TableContract,
    UnknownColumnError,
)


def test_rename_map_is_one_to_one_over_nineteen_columns():
    assert len(TRIPS.columns) == 19
    assert len({c.source for c in TRIPS.columns}) == len({c.name for c in TRIPS.columns}) == 19
    assert all(c.name == c.name.lower() for c in TRIPS.columns)


def test_every_type_parses_and_money_is_decimal():
    for c in TRIPS.columns:
        T.StructType.fromDDL(f"`{c.name}` {c.type}")
    money = [c.name for c in TRIPS.columns if c.type == "DECIMAL(10, 2)"]
    assert len(money) == 9 and "total_amount" in money and "trip_distance" not in money


def test_hints_cover_all_but_the_five_drifting_columns():
    hinted = {f.name for f in TRIPS.hint_schema().fields}
    assert len(hinted) == 14
    assert {c.source for c in TRIPS.columns} - hinted == {
        "VendorID",
        "passenger_count",
        "RatecodeID",
        "PULocationID",
        "DOLocationID",
    }
    assert TRIPS.schema_hints().startswith("tpep_pickup_datetime TIMESTAMP_NTZ, ")


@pytest.mark.parametrize(
    ("given", "name", "type_"),
    [
        ("VendorID", "vendor_id", "BIGINT"),
        ("vendor_id", "vendor_id", "BIGINT"),
        ("airport_fee", "airport_fee", "DECIMAL(10, 2)"),
        ("tpep_pickup_datetime", "tpep_pickup_datetime", "TIMESTAMP"),
    ],
)
def test_lookup_takes_source_and_canonical_names(given, name, type_):
    assert TRIPS.canonical_name(given) == name
    assert TRIPS.canonical_type(given) == type_


@pytest.mark.parametrize("given", ["", "vendorid", "tip", "Airport_fee"])
def test_unknown_columns_raise(given):
    with pytest.raises(UnknownColumnError):
        TRIPS.canonical_name(given)
    with pytest.raises(KeyError):
        TRIPS.canonical_type(given)


def test_required_columns_accept_exact_set_and_superset():
    TRIPS.validate_required_columns(TRIPS.required_columns)
    TRIPS.validate_required_columns([*TRIPS.required_columns, "extra", "new"])


def test_all_missing_columns_are_named_at_once():
    with pytest.raises(SchemaContractError) as caught:
        TRIPS.validate_required_columns(["VendorID", "total_amount"])
    for name in ("passenger_count", "tpep_pickup_datetime", "tpep_dropoff_datetime"):
        assert name in str(caught.value)
    with pytest.raises(SchemaContractError):
        TRIPS.validate_required_columns([])


def test_duplicate_names_are_refused():
    spec = ColumnSpec("a", "x", "INT")
    with pytest.raises(ValueError, match="unique"):
        TableContract((spec, ColumnSpec("b", "x", "INT")), event_time="x", file_pattern="")
    with pytest.raises(ValueError, match="event_time"):
        TableContract((spec,), event_time="y", file_pattern="")
