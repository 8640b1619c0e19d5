"""Landing paths and source addresses as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterline.contract import TRIP_FILE_PATTERN, TRIP_FILE_PREFIX
from meterline.functions.months import _col, _invalid, is_year_month

# Where monthly files come from and how landed files are laid out.
SOURCE_BASE = "https://d37ci6vzurychx.cloudfront.net/trip-data"
LANDING_ROOT = "/Volumes/"
LANDED_FOLDER_PATTERN = r"/year=\d{4}/month=(?:0[1-9]|1[0-2])/"


def build_source_url(year_month: Column | str, base: str = SOURCE_BASE, strict: bool = True) -> Column:
    """Address of one month's source file."""
    ym = _col(year_month)
    url = F.concat(F.lit(f"{base}/{TRIP_FILE_PREFIX}"), ym, F.lit(".parquet"))
    return F.when(is_year_month(ym), url).otherwise(
        _invalid(strict, F.lit("invalid year-month, expected YYYY-MM: "), ym)
    )


def build_volume_object_path(
    base: Column | str, year_month: Column | str, root: str = LANDING_ROOT, strict: bool = True
) -> Column:
    """Where one month's file lands below ``base``; trailing slashes of ``base`` are dropped."""
    base, ym = _col(base), _col(year_month)
    trimmed = F.regexp_replace(base, "/+$", "")
    path = F.concat(
        trimmed,
        F.lit("/year="),
        F.substring(ym, 1, 4),
        F.lit("/month="),
        F.substring(ym, 6, 2),
        F.lit(f"/{TRIP_FILE_PREFIX}"),
        ym,
        F.lit(".parquet"),
    )
    return (
        F.when(
            ~F.coalesce(trimmed.startswith(root), F.lit(False)),
            _invalid(strict, F.lit(f"landing base must be a non-empty path below {root}: "), base),
        )
        .when(
            ~is_year_month(ym),
            _invalid(strict, F.lit("invalid year-month, expected YYYY-MM: "), ym),
        )
        .otherwise(path)
    )


def parse_volume_base(base: Column | str, root: str = LANDING_ROOT, strict: bool = True) -> Column:
    """``struct<catalog, schema, volume>``: the first three segments below ``root``."""
    base = _col(base)
    segments = F.filter(
        F.split(F.substring(base, len(root) + 1, 1 << 30), "/"), lambda s: s != F.lit("")
    )
    parsed = F.struct(
        F.get(segments, 0).alias("catalog"),
        F.get(segments, 1).alias("schema"),
        F.get(segments, 2).alias("volume"),
    )
    return (
        F.when(
            ~F.coalesce(base.startswith(root), F.lit(False)),
            _invalid(strict, F.lit(f"landing base must be a non-empty path below {root}: "), base),
        )
        .when(
            F.size(segments) < 3,
            _invalid(strict, F.lit("landing base must name <catalog>/<schema>/<volume>: "), base),
        )
        .otherwise(parsed)
    )


def extract_file_year_month(path: Column | str, pattern: str = TRIP_FILE_PATTERN) -> Column:
    """Month in the file name, NULL where the path holds none."""
    return F.nullif(F.regexp_extract(_col(path), pattern, 1), F.lit(""))


def parse_volume_object_path(path: Column | str, pattern: str = TRIP_FILE_PATTERN) -> Column:
    """Month of a properly landed file, else NULL. The file name wins over the folders.

    ``pattern`` matches the file name; its first group is the month.
    """
    path = _col(path)
    landed = path.rlike(f"{LANDED_FOLDER_PATTERN}{pattern}\\z")
    return F.when(landed, extract_file_year_month(path, pattern))
