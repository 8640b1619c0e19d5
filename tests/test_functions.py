"""Truth tables of the column functions."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from meterline.functions import months, outcomes, paths


def values(spark, column_of, inputs, schema="v string"):
    """One result per input, evaluated over a table."""
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(column_of("v")).collect()]


GOOD_MONTHS = [f"{year:04d}-{month:02d}" for year in (1, 476, 1815, 9999) for month in (1, 6, 12)]


def spoiled(month):
    """What is left of a month after one thing about it is made wrong."""
    year, number = month.split("-")
    yield from (month[:k] + month[k + 1 :] for k in range(len(month)))  # a character lost
    yield from (f"{year}-{n:02d}" for n in (0, 13, 47))
    yield from (f"{year}{mark}{number}" for mark in (".", " ", "--", "\u2013"))
    yield from (f"{month}\n", f"\t{month}", f"{month}-", f"{month}T", f"1{month}")
    yield from (number, "MMXV-VI", "\u0661\u0668\u0661\u0665-\u0660\u0666")


BAD_MONTHS = [*spoiled("1815-06"), None]


def test_year_month_validity(spark):
    got = values(spark, months.is_year_month, GOOD_MONTHS + BAD_MONTHS)
    assert got == [True] * len(GOOD_MONTHS) + [False] * len(BAD_MONTHS)


def test_parse_year_month(spark):
    got = values(spark, lambda c: months.parse_year_month(c), GOOD_MONTHS)
    assert [f"{r['year']:04d}-{r['month']:02d}" for r in got] == GOOD_MONTHS
    lenient = values(spark, lambda c: months.parse_year_month(c, strict=False), BAD_MONTHS)
    assert lenient == [None] * len(BAD_MONTHS)


@pytest.mark.parametrize("bad", BAD_MONTHS[7:10])
def test_parse_year_month_raises(spark, bad):
    with pytest.raises(PySparkException, match="invalid year-month"):
        values(spark, lambda c: months.parse_year_month(c), [bad])


def month_after(month, n):
    at = int(month[:4]) * 12 + int(month[5:]) - 1 + n
    return f"{at // 12:04d}-{at % 12 + 1:02d}"


@pytest.mark.parametrize("start", ["0004-02", "1582-10", "1999-12", "2040-01"])
@pytest.mark.parametrize("length", [1, 2, 13, 240])
def test_expand_window(spark, start, length):
    window = [month_after(start, k) for k in range(length)]
    row = spark.range(1).select(months.expand_window(F.lit(start), F.lit(window[-1])).alias("m"))
    assert row.first()["m"] == window


@pytest.mark.parametrize(
    ("start", "end", "text"),
    [
        ("1848-04", "1848-03", "before its start"),
        ("1848-04", "1847-12", "before its start"),
        (BAD_MONTHS[8], "1848-04", "invalid year-month"),
        ("1848-04", BAD_MONTHS[9], "invalid year-month"),
    ],
)
def test_expand_window_rejects(spark, start, end, text):
    frame = spark.createDataFrame([(start, end)], "s string, e string")
    with pytest.raises(PySparkException, match=text):
        frame.select(months.expand_window("s", "e")).collect()
    assert frame.select(months.expand_window("s", "e", strict=False)).first()[0] is None


def test_year_month_of_null_is_null(spark):
    got = spark.sql("SELECT TIMESTAMP_NTZ'2023-01-31 23:59:59' AS t UNION ALL SELECT NULL")
    assert {r[0] for r in got.select(months.year_month("t")).collect()} == {"2023-01", None}


def test_source_url(spark):
    urls = values(spark, lambda c: paths.build_source_url(c), GOOD_MONTHS)
    assert urls == [f"{paths.SOURCE_BASE}/yellow_tripdata_{m}.parquet" for m in GOOD_MONTHS]
    with pytest.raises(PySparkException, match="invalid year-month"):
        values(spark, lambda c: paths.build_source_url(c), [BAD_MONTHS[7]])


BASE = "/Volumes/harbour/arrivals/cargo"


def landed(month, folder=BASE):
    return f"{folder}/year={month[:4]}/month={month[5:]}/yellow_tripdata_{month}.parquet"


@pytest.mark.parametrize("slashes", range(4))
def test_landing_path(spark, slashes):
    base = BASE + "/" * slashes
    made = [values(spark, lambda c, m=m: paths.build_volume_object_path(c, F.lit(m)), [base]) for m in GOOD_MONTHS[:3]]
    assert made == [[landed(m)] for m in GOOD_MONTHS[:3]]


@pytest.mark.parametrize("base", [BASE[1:], BASE.lower(), BASE.replace("Volumes", "mnt"), "\t", "/", None])
def test_landing_path_rejects_base(spark, base):
    with pytest.raises(PySparkException, match="landing base"):
        values(spark, lambda c: paths.build_volume_object_path(c, F.lit("1815-06")), [base])


def test_landing_path_rejects_month(spark):
    with pytest.raises(PySparkException, match="invalid year-month"):
        values(spark, lambda c: paths.build_volume_object_path(c, F.lit(BAD_MONTHS[9])), [BASE])


def test_month_of_a_path(spark):
    month, other = "1815-06", "0476-09"
    where = landed(month)
    name = where.rsplit("/", 1)[1]
    cases = {
        where: (month, month),
        landed(month, "hdfs://host/any/where"): (month, month),
        where.replace("year=1815/month=06", f"year={other[:4]}/month={other[5:]}"): (month, month),
        where.replace("/month=06", ""): (month, None),
        where.replace("month=06", "month=6"): (month, None),
        name: (month, None),
        f"{where}/{name}.crc": (month, None),
        where.replace("yellow", "blue"): (None, None),
        where.replace("tripdata_1815-06", "tripdata_1815-14"): (None, None),
        where.replace("tripdata_1815-06", "tripdata_181506"): (None, None),
        where.replace(".parquet", ".orc"): (None, None),
        "nothing of the kind": (None, None),
    }
    inputs = [*cases, None]
    assert values(spark, paths.extract_file_year_month, inputs) == [x for x, _ in cases.values()] + [None]
    assert values(spark, paths.parse_volume_object_path, inputs) == [x for _, x in cases.values()] + [None]


def test_landed_files_of_another_contract(spark):
    pattern = r"tide_(\d{4}-\d{2})\.parquet"
    inputs = ["/x/year=1815/month=06/tide_1815-06.parquet", landed("1815-06")]
    assert values(spark, lambda c: paths.parse_volume_object_path(c, pattern), inputs) == ["1815-06", None]


def test_base_parts(spark):
    names = [("a", "b", "c"), ("harbour", "arrivals", "cargo"), ("x_1", "y-2", "z.3")]
    inputs = [f"/Volumes/{'/'.join(n)}{tail}" for n in names for tail in ("", "/", "/deeper/still")]
    got = values(spark, lambda c: paths.parse_volume_base(c), inputs)
    assert [tuple(x) for x in got] == [n for n in names for _ in range(3)]


@pytest.mark.parametrize("base", ["", "\t ", "/mnt/a/b/c", "/Volumes/a", "/Volumes/a/b//"])
def test_base_parts_rejects(spark, base):
    with pytest.raises(PySparkException):
        values(spark, lambda c: paths.parse_volume_base(c), [base])


def test_probe_response(spark):
    codes = list(range(100, 600, 7)) + [200, 299, 300]
    got = values(spark, outcomes.classify_probe_response, codes, "v int")
    assert [tuple(x) for x in got] == [("OK" if c // 100 == 2 else "HTTP_ERR", c) for c in codes]


def test_probe_exception(spark):
    late = ["Timeout", "PoolTimeout", "HandshakeTimeout"]
    other = ["BrokenPipeError", "ProtocolError", "KeyError"]
    got = values(spark, outcomes.classify_probe_exception, late + other)
    assert [tuple(x) for x in got] == [("TIMEOUT", None)] * 3 + [("CONN_ERR", None)] * 3


@pytest.mark.parametrize(
    ("probe", "ok", "written", "existing", "expected"),
    [
        ("OK", True, 100, 70, ("DOWNLOADED", 100, 100)),
        ("OK", False, 0, 70, ("SKIPPED_EXISTING", 0, 70)),
        ("OK", None, None, None, ("FAILED", 0, 0)),
        ("TIMEOUT", True, 5, 70, ("SKIPPED_EXISTING", 0, 70)),
        ("HTTP_ERR", False, 0, 0, ("FAILED", 0, 0)),
    ],
)
def test_month_outcome(spark, probe, ok, written, existing, expected):
    frame = spark.createDataFrame(
        [(probe, ok, written, existing)], "p string, ok boolean, w bigint, e bigint"
    )
    assert tuple(frame.select(outcomes.month_outcome("p", "ok", "w", "e")).first()[0]) == expected


def test_domain_checks(spark):
    assert values(spark, lambda c: outcomes.in_domain(c, ["A"]), ["A", "B", None]) == [
        True,
        False,
        False,
    ]
    for bad in ("B", None):
        with pytest.raises(PySparkException, match="invalid source_mode"):
            values(spark, lambda c: outcomes.require_in(c, ["A"], "source_mode"), [bad])
