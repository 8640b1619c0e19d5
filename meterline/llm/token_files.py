"""Operator 7: token ids of whole documents in seekable frame files, and the reader of these.

Documents are dealt by ranges of doc_id, so each task writes one file and files follow each
other in ascending order. A file is named after the task attempt that wrote it and counts only
through the row its task returns, so a lost or repeated task leaves no trace in the result.

Nulls and edge cases: a null or empty text is the end id alone; null doc_ids come first;
repeated rows and equal doc_ids are all kept, ordered by the text's hash; an empty table gives
no files and no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline import session
from meterline.llm import tokens
from meterline.llm.frames import FrameReader, FrameWriter
from meterline.llm.registry import query, table

#: Texts encoded at a time, and ids read by one task.
BATCH_TEXTS, SPLIT_IDS = 256, 1 << 24

MANIFEST = "part int, path string, docs long, ids long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids binary"


def write_token_files(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int, spaced: bool = True
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write them below ``folder``.

    Returns the manifest: a row per file, with its place in the order of doc_id.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(partitions, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .drop("tie")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part = task.partitionId()
        path = f"{folder}/part-{part:05d}-{task.taskAttemptId()}.tokens"
        encode = tokens.encoder(vocabulary, spaced).encode
        end = np.array([end_id], dtype="<u2")
        out, n = None, 0
        for batch in batches:
            ids_of, texts = batch.column(0), batch.column(1)
            for k in range(0, len(batch), BATCH_TEXTS):
                out = out or FrameWriter(path)
                found = encode(texts.slice(k, BATCH_TEXTS).to_pylist())
                for doc_id, ids in zip(ids_of.slice(k, BATCH_TEXTS).to_pylist(), found, strict=True):
                    out.add(doc_id, np.concatenate((ids, end)))
                n += len(found)
        if out:
            row = {"part": [part], "path": [path], "docs": [n], "ids": [out.close()]}
            kinds = [("part", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]
            yield pa.RecordBatch.from_pydict(row, schema=pa.schema(kinds))

    return dealt.mapInArrow(write, MANIFEST)


def read_token_files(spark: SparkSession, files: list, split_ids: int = SPLIT_IDS) -> DataFrame:
    """Every document of the manifest rows ``files``: doc_id, start, n_tokens, ids (32-bit).

    The list holds one row per file, so the driver sees no documents. A task reads a run of
    documents of one file, of about ``split_ids`` ids.
    """
    splits, before = [], 0
    for f in sorted(files, key=lambda f: f["part"]):
        pieces = max(1, min(f["docs"], -(-f["ids"] // split_ids)))
        ends = [f["docs"] * k // pieces for k in range(pieces + 1)]
        splits += [(f["path"], before, a, b) for a, b in zip(ends, ends[1:], strict=False)]
        before += f["ids"]
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for split in batch.to_pylist():
                reader, rows, held = FrameReader(split["path"]), [], 0
                for doc_id, start, ids in reader.documents(split["first"], split["last"]):
                    wide = ids.astype("<u4").tobytes()
                    rows.append((doc_id, split["before"] + start, len(ids), wide))
                    held += len(wide)
                    if held > 1 << 22:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows, strict=True), schema.types)), schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows, strict=True), schema.types)), schema=schema)
                reader.close()

    todo = spark.createDataFrame(splits, "path string, before long, first long, last long")
    return todo.repartition(max(1, len(splits))).mapInArrow(read, DOCUMENTS)


@query("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, write the files, and digest what is read back from them."""
    folder = session.scratch_dir(spark, "tokens")
    vocabulary = tokens.public_path("byte_bpe_50k.json")
    files = write_token_files(table(spark, sf_dir, "documents"), folder, vocabulary, end_id=0)
    read = read_token_files(spark, files.collect())
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def crc32(ids: np.ndarray) -> int:
    """Checksum of ids as little-endian 32-bit numbers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))
