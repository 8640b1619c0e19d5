"""Profiles of drifted raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.contract import RESCUED_COLUMN, TableContract
from meterline.functions.paths import extract_file_year_month
from meterline.operators.conform import rescued_text


def drift_profile(
    bronze: DataFrame, contract: TableContract, column: str, file_month: Column | None = None
) -> DataFrame:
    """Per source-file month: rows, rescued rows, and rows with no value of ``column`` at all.

    The month is taken from each row's path, unless ``file_month`` already tells it.
    """
    spec = contract.column(column)
    if file_month is None:
        file_month = extract_file_year_month("_source_file_path", contract.file_pattern)
    rescued_value = rescued_text(bronze, spec)
    return (
        bronze.groupBy(file_month.alias(contract.file_month))
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count(RESCUED_COLUMN).alias("rescued"),
            F.count_if(F.col(spec.source).isNull() & rescued_value.isNull()).alias("truly_null"),
        )
        .orderBy(contract.file_month)
    )
