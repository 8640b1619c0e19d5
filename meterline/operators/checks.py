"""Data tests over whole tables: failing-row counts with a severity and a verdict."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR = "error"
WARN = "warn"
FRESH_HOURS = 24
RESULT_COLUMNS = ("test", "dataset", "column_name", "severity", "failures")


class DataTestError(AssertionError):
    """At least one error-severity data test has failing rows."""


def _result(test: str, dataset: str, column: str, failures: Column, severity: str) -> Column:
    return F.struct(
        F.lit(test).alias("test"),
        F.lit(dataset).alias("dataset"),
        F.lit(column).alias("column_name"),
        F.lit(severity).alias("severity"),
        F.coalesce(failures, F.lit(0)).cast("long").alias("failures"),
    )


def column_checks(
    df: DataFrame,
    dataset: str,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Iterable] | None = None,
    severity: str = ERROR,
    weight: str | None = None,
    fresh: tuple[str, Column | None, int] | None = None,
) -> DataFrame:
    """Every not-null and accepted-values test of one table in a single aggregate.

    NULLs pass the accepted-values test; the not-null test is theirs. ``weight`` names a
    column that tells how many rows each row stands for. ``fresh`` (time column, now, hours)
    adds a freshness test to the same aggregate.
    """
    tests = [("not_null", c, F.col(c).isNull()) for c in not_null]
    tests += [
        ("accepted_values", c, ~F.col(c).isin(*values)) for c, values in (accepted or {}).items()
    ]
    rows = F.lit(1) if weight is None else F.col(weight)
    counts = [F.sum(F.when(bad, rows)).alias(f"_{i}") for i, (_, _, bad) in enumerate(tests)]
    results = [_result(t, dataset, c, F.col(f"_{i}"), severity) for i, (t, c, _) in enumerate(tests)]
    if fresh is not None:
        column, now, hours = fresh
        counts.append(F.max(column).alias("_newest"))
        results.append(_result("freshness", dataset, column, _stale(now, hours), WARN))
    return df.agg(*counts).select(F.explode(F.array(*results)).alias("r")).select("r.*")


def _stale(now: Column | None, hours: int) -> Column:
    """1 if ``_newest`` is older than so many hours, or NULL."""
    now = F.current_timestamp() if now is None else now
    limit = F.make_dt_interval(hours=F.lit(hours))
    return F.coalesce(F.col("_newest") < now - limit, F.lit(True)).cast("long")


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL keys that occur more than once, with their count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def unique_check(df: DataFrame, dataset: str, column: str, severity: str = ERROR) -> DataFrame:
    return (
        duplicate_keys(df, column)
        .agg(F.count(F.lit(1)).alias("_f"))
        .select(_result("unique", dataset, column, F.col("_f"), severity).alias("r"))
        .select("r.*")
    )


def orphan_keys(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    parent_column: str,
    weight: str | None = None,
) -> DataFrame:
    """Non-NULL child keys missing from ``parent``, with the number of child rows.

    Child rows are counted per key before the anti join, so the join sees each key once
    however often it occurs. If ``child`` is already counted, ``weight`` is its count.
    """
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    keys = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_key"))
        .agg(rows.alias("n"))
    )
    known = parent.select(F.col(parent_column).alias("_known"))
    return keys.join(known, F.col("_key") == F.col("_known"), "left_anti").select(
        F.col("_key").alias(column), "n"
    )


def relationships_check(
    child: DataFrame,
    dataset: str,
    column: str,
    parent: DataFrame,
    parent_column: str,
    severity: str = ERROR,
    weight: str | None = None,
) -> DataFrame:
    return (
        orphan_keys(child, column, parent, parent_column, weight)
        .agg(F.sum("n").alias("_f"))
        .select(_result("relationships", dataset, column, F.col("_f"), severity).alias("r"))
        .select("r.*")
    )


def table_checks(
    df: DataFrame,
    dataset: str,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Iterable] | None = None,
    relationships: Sequence[str] = (),
    parent: DataFrame | None = None,
    parent_column: str | None = None,
    severity: str = ERROR,
) -> DataFrame:
    """Column tests and relationship tests to one parent, all from a single scan of ``df``.

    Rows are counted per combination of the ``relationships`` columns first, so the joins
    with the parent see each combination once.
    """
    tests = [("not_null", c, F.col(c).isNull()) for c in not_null]
    tests += [
        ("accepted_values", c, ~F.col(c).isin(*values)) for c, values in (accepted or {}).items()
    ]
    counts = df.groupBy(*relationships).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(bad).alias(f"_{i}") for i, (_, _, bad) in enumerate(tests)],
    )
    totals = [F.sum(f"_{i}").alias(f"_{i}") for i in range(len(tests))]
    for j, column in enumerate(relationships):
        known = parent.select(F.col(parent_column).alias(f"_known{j}")).distinct()
        counts = counts.join(known, F.col(column) == F.col(f"_known{j}"), "left")
        orphan = F.col(column).isNotNull() & F.col(f"_known{j}").isNull()
        totals.append(F.sum(F.when(orphan, F.col("_n")).otherwise(0)).alias(f"_r{j}"))
    results = [_result(t, dataset, c, F.col(f"_{i}"), severity) for i, (t, c, _) in enumerate(tests)]
    results += [
        _result("relationships", dataset, c, F.col(f"_r{j}"), severity)
        for j, c in enumerate(relationships)
    ]
    return counts.agg(*totals).select(F.explode(F.array(*results)).alias("r")).select("r.*")


def unique_checks(df: DataFrame, dataset: str, columns: Sequence[str]) -> DataFrame:
    """Unique tests of several columns from one scan: each value is counted under its column."""
    values = F.explode(
        F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
    )
    repeated = (
        df.select(values.alias("x"))
        .where("x.v IS NOT NULL")
        .groupBy("x.c", "x.v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    failing = [F.count_if((F.col("c") == c) & (F.col("n") > 1)).alias(f"_{i}") for i, c in enumerate(columns)]
    results = [_result("unique", dataset, c, F.col(f"_{i}"), ERROR) for i, c in enumerate(columns)]
    return repeated.agg(*failing).select(F.explode(F.array(*results)).alias("r")).select("r.*")


def freshness_check(
    df: DataFrame,
    dataset: str,
    column: str,
    now: Column | None = None,
    warn_after_hours: int = FRESH_HOURS,
) -> DataFrame:
    """One warn failure when the newest value is older than the limit, or there is none."""
    return column_checks(df, dataset, fresh=(column, now, warn_after_hours))


def summarize(results: Iterable[DataFrame]) -> DataFrame:
    """All results with a ``status`` of pass, warn or error."""
    union = reduce(DataFrame.unionByName, results)
    return union.withColumn(
        "status", F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.col("severity"))
    )


def enforce(summary: DataFrame) -> list:
    """Run the tests, raise naming every failed error-severity test, return all results.

    The result has one row per declared test.
    """
    rows = summary.collect()
    failed = [r for r in rows if r["status"] == ERROR]
    if failed:
        raise DataTestError(
            "; ".join(
                f"{r['test']}({r['dataset']}.{r['column_name']}): {r['failures']} failing"
                for r in failed
            )
        )
    return rows


def trip_checks(
    silver: DataFrame,
    consumption: DataFrame,
    pairs: DataFrame,
    monthly: DataFrame,
    hourly: DataFrame,
    flows: DataFrame,
    dim: DataFrame,
    now: Column | None = None,
) -> list[DataFrame]:
    """The declared tests of the trip tables: 20 errors and one freshness warning.

    The canonical table is scanned once, its freshness included. The consumption view is not
    scanned: ``pairs`` counts its trips per pair of location ids, ``flows`` per pair of
    boroughs and ``monthly`` per month, and each stands in for it where nothing else matters.
    """

    def known_location(column: str) -> DataFrame:
        return relationships_check(
            pairs, "consumption", column, dim, "location_id", weight="trips"
        )

    return [
        column_checks(
            silver,
            "silver",
            ["vendor_id", "total_amount", "tpep_pickup_datetime", "tpep_dropoff_datetime"],
            {"vendor_id": (1, 2, 6, 7)},
            fresh=("_ingestion_ts", now, FRESH_HOURS),
        ),
        column_checks(monthly, "consumption", ["pickup_year_month"], weight="trip_count"),
        column_checks(
            flows, "consumption", ["pickup_borough", "dropoff_borough"], weight="trip_count"
        ),
        known_location("pickup_location_id"),
        known_location("dropoff_location_id"),
        column_checks(
            monthly,
            "monthly_avg_total_amount",
            ["pickup_year_month", "avg_total_amount", "trip_count"],
        ),
        unique_check(monthly, "monthly_avg_total_amount", "pickup_year_month"),
        column_checks(
            hourly,
            "hourly_avg_passenger_count",
            ["pickup_hour", "avg_passenger_count", "trip_count_with_passenger"],
        ),
        unique_check(hourly, "hourly_avg_passenger_count", "pickup_hour"),
        column_checks(flows, "flow_matrix", ["trip_count", "avg_total_amount"]),
    ]
