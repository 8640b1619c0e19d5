"""Parquet footers of many files, read by Spark tasks, and what a reader makes of them."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FOOTER_DDL = "path string, length bigint, schema string, error string"
INFERENCE_THREADS = 16


def read_footers(files: DataFrame) -> DataFrame:
    """``(path, length, schema, error)`` per file; ``schema`` is a Spark schema as JSON.

    Only footers are fetched. A file whose store the workers cannot open, or whose types
    have no Spark counterpart, gets an ``error`` instead of a schema.
    """

    def footer_batches(batches: Iterator) -> Iterator:
        # Everything is imported here so that executors need no copy of this package.
        from urllib.parse import urlsplit

        import pandas as pd
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        def open_schema(path: str) -> str:
            scheme = urlsplit(path).scheme
            if scheme in ("", "file"):
                store, name = pafs.LocalFileSystem(), path.removeprefix("file:")
                name = "/" + name.lstrip("/")
            else:
                uri = "s3" + path[3:] if scheme == "s3a" else path
                store, name = pafs.FileSystem.from_uri(uri)
            with store.open_input_file(name) as source:
                return from_arrow_schema(
                    pq.read_schema(source), prefer_timestamp_ntz=True
                ).json()

        for batch in batches:
            rows = []
            for path, length in zip(batch["path"], batch["length"], strict=True):
                try:
                    rows.append((path, length, open_schema(path), None))
                except Exception as exc:  # reported per file, resolved by the caller
                    rows.append((path, length, None, f"{type(exc).__name__}: {exc}"))
            yield pd.DataFrame(rows, columns=["path", "length", "schema", "error"])

    return files.select("path", "length").mapInPandas(footer_batches, FOOTER_DDL)


def literal_path(path: str) -> str:
    """``path`` with glob characters escaped: it names one file, not a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


class FileSchema(NamedTuple):
    path: str
    schema: T.StructType
    length: int = 0


def file_schemas(spark: SparkSession, files: DataFrame) -> list[FileSchema]:
    """Path, schema and size of every file in ``files``, ordered by path.

    One small row per file comes to the driver, which needs the paths anyway to plan the
    scan; callers bound the number of files. Files the workers could not open are read
    by Spark's own schema inference, several at a time.
    """
    rows = read_footers(files).collect()
    texts = {r["schema"] for r in rows if r["schema"]}
    known = {text: T.StructType.fromJson(json.loads(text)) for text in texts}
    found = [FileSchema(r["path"], known[r["schema"]], r["length"]) for r in rows if r["schema"]]
    unopened = [r for r in rows if not r["schema"]]
    if unopened:
        with ThreadPoolExecutor(INFERENCE_THREADS) as pool:
            schemas = pool.map(lambda r: spark.read.parquet(literal_path(r["path"])).schema, unopened)
            found += [
                FileSchema(r["path"], schema, r["length"])
                for r, schema in zip(unopened, schemas, strict=True)
            ]
    return sorted(found, key=lambda f: f.path)
