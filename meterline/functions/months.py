"""``YYYY-MM`` month keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the form of a month key. (A plain $ would let a line break pass.)
YEAR_MONTH_PATTERN = r"\A(\d{4})-(0[1-9]|1[0-2])\z"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_year_month(value: Column | str) -> Column:
    """True for the strict, zero-padded form; NULL counts as not valid."""
    return F.coalesce(_col(value).rlike(YEAR_MONTH_PATTERN), F.lit(False))


def year_month(ts: Column | str) -> Column:
    """Month key of a timestamp, NULL for NULL."""
    return F.date_format(_col(ts).cast("timestamp"), "yyyy-MM")


def _part(value: Column, group: int) -> Column:
    return F.regexp_extract(value, YEAR_MONTH_PATTERN, group).try_cast("int")


def parse_year_month(value: Column | str, strict: bool = True) -> Column:
    """``struct<year int, month int>``; bad input raises, or is NULL if not ``strict``."""
    value = _col(value)
    parsed = F.struct(_part(value, 1).alias("year"), _part(value, 2).alias("month"))
    return F.when(is_year_month(value), parsed).otherwise(
        _invalid(strict, F.lit("invalid year-month, expected YYYY-MM: "), value)
    )


def expand_window(start: Column | str, end: Column | str, strict: bool = True) -> Column:
    """Every month of the inclusive window as ``array<string>``, oldest first.

    Malformed bounds and ``end < start`` raise, or give NULL if not ``strict``.
    """
    start, end = _col(start), _col(end)
    first = F.make_date(_part(start, 1), _part(start, 2), F.lit(1))
    last = F.make_date(_part(end, 1), _part(end, 2), F.lit(1))
    days = F.sequence(first, F.greatest(first, last), F.expr("interval 1 month"))
    months = F.transform(
        days,
        lambda d: F.concat(
            F.lpad(F.year(d).cast("string"), 4, "0"),
            F.lit("-"),
            F.lpad(F.month(d).cast("string"), 2, "0"),
        ),
    )
    return (
        F.when(
            ~(is_year_month(start) & is_year_month(end)),
            _invalid(strict, F.lit("invalid year-month in window: "), start, F.lit(".."), end),
        )
        .when(
            end < start,
            _invalid(strict, F.lit("window end is before its start: "), start, F.lit(".."), end),
        )
        .otherwise(months)
    )


def _invalid(strict: bool, *parts: Column) -> Column:
    if not strict:
        return F.lit(None)
    return F.raise_error(F.concat(*[F.coalesce(p, F.lit("NULL")) for p in parts]))
