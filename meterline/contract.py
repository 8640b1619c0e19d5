"""Table contracts: which source columns a fact table has and what they become.

A contract is plain data. Every operator takes one, so the same code serves any
periodic fact table; :data:`TRIPS` is the contract of the monthly trip files.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import types as T

LINEAGE_COLUMNS = ("_source_file_path", "_source_file_modification_time", "_ingestion_ts")
RESCUED_COLUMN = "_rescued_data"


class SchemaContractError(ValueError):
    """Required columns are absent."""


class UnknownColumnError(KeyError):
    """A column is neither a source name nor a canonical name of the contract."""


@dataclass(frozen=True)
class ColumnSpec:
    """One source column.

    ``hint`` is the anchored *source-side* type: a hinted column is read as exactly
    that type or rescued. Columns without a hint may widen. ``recover`` marks columns
    whose rescued value is read back when the typed one is NULL.
    """

    source: str
    name: str
    type: str
    hint: str | None = None
    required: bool = False
    recover: bool = False


@dataclass(frozen=True)
class TableContract:
    columns: tuple[ColumnSpec, ...]
    event_time: str
    file_pattern: str
    event_month: str = "pickup_year_month"
    file_month: str = "file_year_month"
    _by_source: dict[str, ColumnSpec] = field(init=False, repr=False, compare=False)
    _by_name: dict[str, ColumnSpec] = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "_by_source", {c.source: c for c in self.columns})
        object.__setattr__(self, "_by_name", {c.name: c for c in self.columns})
        if not len(self._by_source) == len(self._by_name) == len(self.columns):
            raise ValueError("source and canonical names must each be unique")
        if self.event_time not in self._by_name:
            raise ValueError(f"event_time {self.event_time!r} is not a canonical column")

    @property
    def required_columns(self) -> tuple[str, ...]:
        return tuple(c.source for c in self.columns if c.required)

    def column(self, name: str) -> ColumnSpec:
        """Look a column up by source name, else by canonical name."""
        spec = self._by_source.get(name) or self._by_name.get(name)
        if spec is None:
            raise UnknownColumnError(f"unknown column {name!r}: not part of the table contract")
        return spec

    def canonical_name(self, name: str) -> str:
        return self.column(name).name

    def canonical_type(self, name: str) -> str:
        return self.column(name).type

    def hint_schema(self) -> T.StructType:
        """The anchored columns as a schema (all nullable)."""
        return T.StructType.fromDDL(self.schema_hints()) if self.schema_hints() else T.StructType()

    def schema_hints(self) -> str:
        """The anchored columns as a DDL column list."""
        return ", ".join(f"{c.source} {c.hint}" for c in self.columns if c.hint)

    def missing_columns(self, present: Iterable[str]) -> tuple[str, ...]:
        """Required columns that ``present`` lacks in any spelling."""
        have = {c.lower() for c in present}
        return tuple(c for c in self.required_columns if c.lower() not in have)

    def validate_required_columns(
        self, present: Iterable[str], case_sensitive: bool = True
    ) -> None:
        """Raise one error naming every required column that is absent."""

        def key(name: str) -> str:
            return name if case_sensitive else name.lower()

        have = {key(c) for c in present}
        missing = [c for c in self.required_columns if key(c) not in have]
        if missing:
            raise SchemaContractError("missing required columns: " + ", ".join(missing))


# Names, types and anchored source types of the monthly trip files.
# (source name, canonical name, canonical type, anchored source type)
TRIP_COLUMNS = (
    ("VendorID", "vendor_id", "BIGINT", None),
    ("tpep_pickup_datetime", "tpep_pickup_datetime", "TIMESTAMP", "TIMESTAMP_NTZ"),
    ("tpep_dropoff_datetime", "tpep_dropoff_datetime", "TIMESTAMP", "TIMESTAMP_NTZ"),
    ("passenger_count", "passenger_count", "BIGINT", None),
    ("total_amount", "total_amount", "DECIMAL(10, 2)", "DOUBLE"),
    ("trip_distance", "trip_distance", "DOUBLE", "DOUBLE"),
    ("RatecodeID", "ratecode_id", "BIGINT", None),
    ("store_and_fwd_flag", "store_and_fwd_flag", "STRING", "STRING"),
    ("PULocationID", "pu_location_id", "BIGINT", None),
    ("DOLocationID", "do_location_id", "BIGINT", None),
    ("payment_type", "payment_type", "BIGINT", "BIGINT"),
    ("fare_amount", "fare_amount", "DECIMAL(10, 2)", "DOUBLE"),
    ("extra", "extra", "DECIMAL(10, 2)", "DOUBLE"),
    ("mta_tax", "mta_tax", "DECIMAL(10, 2)", "DOUBLE"),
    ("tip_amount", "tip_amount", "DECIMAL(10, 2)", "DOUBLE"),
    ("tolls_amount", "tolls_amount", "DECIMAL(10, 2)", "DOUBLE"),
    ("improvement_surcharge", "improvement_surcharge", "DECIMAL(10, 2)", "DOUBLE"),
    ("congestion_surcharge", "congestion_surcharge", "DECIMAL(10, 2)", "DOUBLE"),
    ("airport_fee", "airport_fee", "DECIMAL(10, 2)", "DOUBLE"),
)
REQUIRED_TRIP_COLUMNS = (
    "VendorID",
    "passenger_count",
    "total_amount",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
)
RECOVERED_TRIP_COLUMNS = ("passenger_count", "RatecodeID")
# How monthly files are named.
TRIP_FILE_PREFIX = "yellow_tripdata_"
TRIP_FILE_PATTERN = r"yellow_tripdata_(\d{4}-(?:0[1-9]|1[0-2]))\.parquet"

TRIPS = TableContract(
    columns=tuple(
        ColumnSpec(
            source,
            name,
            type_,
            hint,
            required=source in REQUIRED_TRIP_COLUMNS,
            recover=source in RECOVERED_TRIP_COLUMNS,
        )
        for source, name, type_, hint in TRIP_COLUMNS
    ),
    event_time="tpep_pickup_datetime",
    file_pattern=TRIP_FILE_PATTERN,
)
