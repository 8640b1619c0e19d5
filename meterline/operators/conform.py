"""Raw rows to the canonical, typed projection of a contract."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.contract import (
    LINEAGE_COLUMNS,
    RESCUED_COLUMN,
    ColumnSpec,
    SchemaContractError,
    TableContract,
)
from meterline.functions.months import year_month
from meterline.functions.paths import extract_file_year_month

CAST_LOSS_COLUMN = "_cast_loss"


def rescued_text(bronze: DataFrame, spec: ColumnSpec) -> Column:
    """What was rescued of a column, as text. Keys are spelled as the raw table's columns."""
    spelled = {c.lower(): c for c in bronze.columns}
    return F.get_json_object(RESCUED_COLUMN, f"$['{spelled[spec.source.lower()]}']")


def recovered(text: Column, spec: ColumnSpec) -> Column:
    """A rescued value in its canonical type.

    Rescued numbers may be written as ``1`` or ``1.0``; integral targets accept both.
    """
    direct = text.try_cast(spec.type)
    if spec.type.upper() in ("BIGINT", "INT"):
        return F.coalesce(direct, text.try_cast("double").try_cast(spec.type))
    return direct


def canonical_column(bronze: DataFrame, spec: ColumnSpec, saved: Column | None = None) -> Column:
    """A column in its canonical type; ``saved`` is its rescued text, if that is at hand."""
    typed = F.col(spec.source).try_cast(spec.type)
    if not spec.recover:
        return typed
    return F.coalesce(typed, recovered(rescued_text(bronze, spec) if saved is None else saved, spec))


# What was rescued of the recovered columns, as texts.
_SAVED = "_saved"


def _saved(spec: ColumnSpec) -> Column:
    return F.col(f"{_SAVED}.`{spec.name}`")


def _with_saved(bronze: DataFrame, contract: TableContract) -> DataFrame:
    """Adds the texts of all recovered columns. The JSON of a row is parsed once, however many
    columns are recovered and however often they are used."""
    spelled = {c.lower(): c for c in bronze.columns}
    source = {c.name: spelled[c.source.lower()] for c in contract.columns if c.recover}
    if not source:
        return bronze
    ddl = ", ".join(f"`{name}` STRING" for name in dict.fromkeys(source.values()))
    # A projection of its own, which the optimizer does not merge with those that use it.
    parsed = bronze.withColumn("_parsed", F.from_json(RESCUED_COLUMN, ddl))
    texts = [F.col(f"_parsed.`{key}`").alias(name) for name, key in source.items()]
    return parsed.withColumn(_SAVED, F.struct(*texts)).drop("_parsed")


def conform(
    bronze: DataFrame,
    contract: TableContract,
    track_cast_loss: bool = False,
    keep: Sequence[str] = (),
    file_month: Column | None = None,
) -> DataFrame:
    """Rename, type and derive: one row out per row in, without a shuffle.

    Casts never abort the job: a value outside its canonical type becomes NULL, and
    ``track_cast_loss`` adds a flag column so that a rule can count such rows. A rescued
    value that a recovered column could not take counts as lost, too.
    Columns the contract does not know are not projected, except those in ``keep``. The month of
    a row's file is taken from its path, unless ``file_month`` already tells it.
    """
    present = {c.lower() for c in bronze.columns}
    absent = [c.source for c in contract.columns if c.source.lower() not in present]
    if absent:
        raise SchemaContractError("bronze lacks contract columns: " + ", ".join(absent))

    if file_month is None:
        file_month = extract_file_year_month("_source_file_path", contract.file_pattern)
    projection = [canonical_column(bronze, c, _saved(c)).alias(c.name) for c in contract.columns]
    event_source = contract.column(contract.event_time).source
    projection += [
        year_month(F.col(event_source).try_cast("timestamp")).alias(contract.event_month),
        file_month.alias(contract.file_month),
        *[F.col(c) for c in (*LINEAGE_COLUMNS, *keep)],
    ]
    saved_rows = _with_saved(bronze, contract)
    if not track_cast_loss:
        return saved_rows.select(*projection)

    # Sources of lossy casts ride along one projection further, so each cast runs once.
    raw = {c.name: f"_raw_{c.name}" for c in contract.columns if _may_lose(bronze, c)}
    sources = [F.col(contract.column(name).source).alias(alias) for name, alias in raw.items()]
    saved = {c.name: f"_rescued_{c.name}" for c in contract.columns if c.recover}
    sources += [
        _saved(contract.column(name)).alias(alias) for name, alias in saved.items()
    ]
    rows = saved_rows.select(*projection, *sources)
    lost = [
        F.col(alias).isNotNull() & F.col(name).isNull()
        for name, alias in (*raw.items(), *saved.items())
    ]
    flag = reduce(lambda a, b: a | b, lost, F.lit(False))
    kept = [c for c in rows.columns if c not in {*raw.values(), *saved.values()}]
    return rows.select(*kept, flag.alias(CAST_LOSS_COLUMN))


# Casts that keep every value.
LOSSLESS = {
    ("int", "bigint"),
    ("int", "double"),
    ("timestamp_ntz", "timestamp"),
}


def _may_lose(bronze: DataFrame, spec: ColumnSpec) -> bool:
    types = {f.name.lower(): f.dataType.simpleString() for f in bronze.schema.fields}
    pair = (types[spec.source.lower()], spec.type.lower().replace(" ", ""))
    return pair[0] != pair[1] and pair not in LOSSLESS
