"""Scan of parquet files whose columns drift: added, re-cased, widened or retyped.

The table schema only grows. A file column that cannot be read as the table's type is
left NULL and its values go to ``_rescued_data`` as JSON, so nothing is lost. With ``bounds``
a column takes the least type that holds both its own and the file's, where there is one, and
values are cast to it; only those that the cast would change are rescued.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.contract import LINEAGE_COLUMNS, RESCUED_COLUMN
from meterline.sources.footers import FileSchema, literal_path

# Type changes a column may make on its own (narrow -> wider).
WIDENINGS = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double", "decimal(20,0)", "decimal(22,2)"),
    "bigint": ("decimal(20,0)", "decimal(22,2)"),
    "float": ("double",),
}


def widens(narrow: T.DataType, wide: T.DataType) -> bool:
    """True if a file column of type ``narrow`` may be read as ``wide``."""
    return wide.simpleString() in WIDENINGS.get(narrow.simpleString(), ())


# Number types in order, each holding all values of those before it; a double takes
# longs, too, if it holds them exactly (checked by value).
INTEGERS = ("tinyint", "smallint", "int", "bigint")
DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
MAX_DIGITS = 38


def upper_bound(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type for the values of both, or None."""
    x, y = _plain(a), _plain(b)
    if x == y:
        return a
    pair = {x, y}
    if pair <= set(INTEGERS):
        return max(a, b, key=lambda t: INTEGERS.index(_plain(t)))
    if pair <= {*INTEGERS, "float", "double"}:
        return T.DoubleType()
    if pair == {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    if all(k in INTEGERS or isinstance(t, T.DecimalType) for k, t in ((x, a), (y, b))):
        forms = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (DIGITS[k], 0) for k, t in ((x, a), (y, b))]
        whole, scale = (max(column) for column in zip(*forms, strict=True))
        return T.DecimalType(whole + scale, scale) if whole + scale <= MAX_DIGITS else None
    return None


def castable(file_type: T.DataType, table_type: T.DataType) -> bool:
    """True if ``table_type`` is the bound of both."""
    bound = upper_bound(file_type, table_type)
    return bound is not None and _plain(bound) == _plain(table_type)


def readable(file_type: T.DataType, table_type: T.DataType, anchored: bool) -> bool:
    """Anchored columns take exactly their type; others also a narrower one."""
    if _plain(file_type) == _plain(table_type):
        return True
    return not anchored and widens(file_type, table_type)


def _plain(dtype: T.DataType) -> str:
    return dtype.simpleString().lower()


def evolve(
    table: T.StructType,
    anchors: Iterable[str],
    files: Iterable[T.StructType],
    bounds: bool = False,
) -> T.StructType:
    """``table`` plus what ``files``, in order, add to it.

    New columns are appended under the spelling of the first file that has them. An
    unanchored column widens when a file brings a wider type, and with ``bounds`` to the
    least type for both.
    """
    fixed = {a.lower() for a in anchors}
    fields = {f.name.lower(): f for f in table.fields}
    for schema in files:
        for f in schema.fields:
            key = f.name.lower()
            current = fields.get(key)
            if current is None:
                fields[key] = T.StructField(f.name, f.dataType, True)
            elif key not in fixed and widens(current.dataType, f.dataType):
                fields[key] = T.StructField(current.name, f.dataType, True)
            elif key not in fixed and bounds and not readable(f.dataType, current.dataType, False):
                bound = upper_bound(current.dataType, f.dataType)
                fields[key] = T.StructField(current.name, bound or current.dataType, True)
    return T.StructType(list(fields.values()))


def misfits(
    table: T.StructType, anchors: Iterable[str], file_schema: T.StructType
) -> tuple[T.StructField, ...]:
    """Columns of a file, as it spells and types them, that do not fit the table."""
    fixed = {a.lower() for a in anchors}
    types = {f.name.lower(): f.dataType for f in table.fields}
    return tuple(
        f
        for f in file_schema.fields
        if not readable(f.dataType, types[f.name.lower()], f.name.lower() in fixed)
    )


@dataclass(frozen=True)
class ReadGroup:
    """Files that can share one scan because the same columns do not fit."""

    paths: tuple[str, ...]
    misfits: tuple[T.StructField, ...]


def read_groups(
    table: T.StructType, anchors: Iterable[str], files: Sequence[FileSchema]
) -> list[ReadGroup]:
    """As few scans as the drift allows.

    Added, missing, re-cased and narrower columns all fit and share a single scan; only
    retyped columns split it. The number of groups follows the number of distinct
    retypings, not the number of files.
    """
    anchors = tuple(anchors)
    paths = defaultdict(list)
    fields = {}
    for f in files:
        bad = misfits(table, anchors, f.schema)
        key = tuple(sorted((c.name, c.dataType.json()) for c in bad))
        paths[key].append(f.path)
        fields.setdefault(key, tuple(sorted(bad, key=lambda c: c.name)))
    return [ReadGroup(tuple(paths[k]), fields[k]) for k in sorted(paths)]


def _cast(field: T.StructField, table_type: T.DataType) -> tuple[Column, Column]:
    """A column in the table's type, NULL where that would change the value, and what is left."""
    value = F.col(f"`{field.name}`")
    cast = value.try_cast(table_type)
    exact = cast.try_cast(field.dataType).eqNullSafe(value)
    return F.when(exact, cast), F.when(~exact, value)


def scan_group(
    spark: SparkSession,
    table: T.StructType,
    group: ReadGroup,
    anchors: Iterable[str] = (),
    bounds: bool = False,
) -> DataFrame:
    """All table columns, ``_rescued_data`` and lineage of one group of files."""
    bad = {f.name.lower(): f for f in group.misfits}
    fixed = {a.lower() for a in anchors}
    types = {f.name.lower(): f.dataType for f in table.fields}
    cast = {
        key: _cast(f, types[key])
        for key, f in bad.items()
        if bounds and key not in fixed and castable(f.dataType, types[key])
    }
    physical = T.StructType(
        [f for f in table.fields if f.name.lower() not in bad] + list(group.misfits)
    )
    rows = spark.read.schema(physical).parquet(*[literal_path(p) for p in group.paths])
    path = F.col("_metadata.file_path")

    def column(f: T.StructField) -> Column:
        key = f.name.lower()
        if key in cast:
            return cast[key][0]
        return F.lit(None).cast(f.dataType) if key in bad else F.col(f"`{f.name}`")

    columns = [column(f).alias(f.name) for f in table.fields]
    if bad:
        # Keys of the JSON are spelled as in the table, whatever the file's spelling.
        spelled = {f.name.lower(): f.name for f in table.fields}
        left = [(k, cast[k][1] if k in cast else F.col(f"`{f.name}`")) for k, f in bad.items()]
        values = [value.alias(spelled[k]) for k, value in left]
        packed = F.to_json(F.struct(*values, path.alias("_file_path")))
        rescued = F.when(reduce(lambda a, b: a | b, [v.isNotNull() for v in values]), packed)
    else:
        rescued = F.lit(None).cast("string")
    path_name, modified_name, ingested_name = LINEAGE_COLUMNS
    return rows.select(
        *columns,
        rescued.alias(RESCUED_COLUMN),
        path.alias(path_name),
        F.col("_metadata.file_modification_time").alias(modified_name),
        F.current_timestamp().alias(ingested_name),
    )


def scan_drifted(
    spark: SparkSession,
    table: T.StructType,
    anchors: Iterable[str],
    files: Sequence[FileSchema],
    bounds: bool = False,
) -> DataFrame:
    """One frame over all files, whatever their schemas; ``table`` must already cover them."""
    anchors = tuple(anchors)
    groups = read_groups(table, anchors, files)
    scans = [scan_group(spark, table, g, anchors, bounds) for g in groups]
    return reduce(DataFrame.unionByName, scans)
