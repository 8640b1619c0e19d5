"""Source-probe and month-outcome decisions as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterline.functions.months import _col

# The status domains kept in the run audit.
PROBE_STATUSES = ("OK", "TIMEOUT", "HTTP_ERR", "CONN_ERR")
MONTH_STATUSES = ("DOWNLOADED", "SKIPPED_EXISTING", "FAILED")
SOURCE_MODES = ("HTTP", "VOLUME_PREEXISTING")


def require_in(value: Column | str, allowed: Iterable[str], label: str) -> Column:
    """``value`` itself, or an error naming ``label`` when outside ``allowed``."""
    value = _col(value)
    return F.when(value.isin(*allowed), value).otherwise(
        F.raise_error(F.concat(F.lit(f"invalid {label}: "), F.coalesce(value, F.lit("NULL"))))
    )


def in_domain(value: Column | str, allowed: Iterable[str]) -> Column:
    """Quarantine form of :func:`require_in`: a flag that is never NULL."""
    return F.coalesce(_col(value).isin(*allowed), F.lit(False))


def classify_probe_response(status_code: Column | str) -> Column:
    """``struct<probe_status, http_code>`` of an answered probe."""
    code = _col(status_code).cast("int")
    status = F.when(code.between(200, 299), "OK").otherwise("HTTP_ERR")
    return F.struct(status.alias("probe_status"), code.alias("http_code"))


def classify_probe_exception(error_name: Column | str) -> Column:
    """``struct<probe_status, http_code>`` of a probe that got no answer."""
    status = F.when(_col(error_name).contains("Timeout"), "TIMEOUT").otherwise("CONN_ERR")
    return F.struct(status.alias("probe_status"), F.lit(None).cast("int").alias("http_code"))


def classify_probe(status_code: Column | str, error_name: Column | str) -> Column:
    """Classify a probe-log row: an error name, when present, decides."""
    error_name = _col(error_name)
    return F.when(error_name.isNull(), classify_probe_response(status_code)).otherwise(
        classify_probe_exception(error_name)
    )


def month_outcome(
    probe_status: Column | str,
    download_ok: Column | str,
    bytes_written: Column | str,
    existing_bytes: Column | str,
) -> Column:
    """``struct<status, bytes_downloaded, bytes_in_volume>`` of one month.

    A file already on storage turns any failure into a skip.
    """
    written = _col(bytes_written).cast("long")
    existing = F.coalesce(_col(existing_bytes).cast("long"), F.lit(0).cast("long"))
    zero = F.lit(0).cast("long")

    def outcome(status: str, downloaded: Column, present: Column) -> Column:
        return F.struct(
            F.lit(status).alias("status"),
            downloaded.alias("bytes_downloaded"),
            present.alias("bytes_in_volume"),
        )

    landed = (_col(probe_status) == "OK") & F.coalesce(_col(download_ok), F.lit(False))
    return (
        F.when(landed, outcome("DOWNLOADED", written, written))
        .when(existing > 0, outcome("SKIPPED_EXISTING", zero, existing))
        .otherwise(outcome("FAILED", zero, zero))
    )
