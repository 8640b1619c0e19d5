"""Operator 8: harmonic packing of tokenised documents into sequences of fixed capacity.

Lengths fall into reciprocal-capacity classes. Class k holds pieces of exactly
``capacity // k`` tokens, and each of its sequences takes exactly k of them, so a sequence is
full without looking at any other and every task packs its own documents: no shuffle, no state
beyond one open sequence per class. A document is cut into the longest class piece that fits,
and so on for what is left; what is too short for the last class joins a stream that is cut at
every full sequence. A task ends by moving its open sequences into the stream and cutting the
last sequence into lengths that are powers of two, which need no padding.

Nulls and edge cases: a null or empty text is the end id alone; rows with equal or null doc_ids
are packed one by one; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import tokens
from meterline.llm.registry import query, table
from meterline.llm.token_files import BATCH_TEXTS, crc32

CAPACITY, CLASSES = 4096, 16

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
_KINDS = pa.schema([(x.split()[0], pa.int64()) for x in PIECES.split(", ")])
_WITH_IDS = _KINDS.append(pa.field("ids", pa.binary()))
#: Pieces in an output batch, and sequences that a task may number.
BATCH_PIECES, TASK_SEQUENCES = 4096, 1 << 36

Piece = tuple  # (doc_id, start, doc_tokens, ids)


class Packer:
    """Packs documents one after another; ``done`` holds the finished pieces."""

    def __init__(self, capacity: int, classes: int, first_sequence: int = 0):
        self.capacity, self.classes, self.sequence = capacity, classes, first_sequence
        self.open: dict[int, list[Piece]] = {k: [] for k in range(1, classes + 1)}
        self.stream: list[Piece] = []
        self.streamed = 0
        self.done: list[tuple] = []

    def _close(self, pieces: list[Piece]) -> None:
        offset = 0
        for doc_id, start, total, ids in pieces:
            self.done.append((doc_id, start, len(ids), total, self.sequence, offset, ids))
            offset += len(ids)
        self.sequence += 1

    def _append(self, piece: Piece) -> None:
        doc_id, start, total, ids = piece
        while self.streamed + len(ids) >= self.capacity:
            cut = self.capacity - self.streamed
            self._close([*self.stream, (doc_id, start, total, ids[:cut])])
            self.stream, self.streamed = [], 0
            start, ids = start + cut, ids[cut:]
        if len(ids):
            self.stream.append((doc_id, start, total, ids))
            self.streamed += len(ids)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        start, total = 0, len(ids)
        while start < total:
            left = total - start
            k = max(1, -(-self.capacity // left))  # the longest class piece that is not longer
            if k > self.classes:
                self._append((doc_id, start, total, ids[start:].copy()))
                return
            size = self.capacity // k
            self.open[k].append((doc_id, start, total, ids[start : start + size].copy()))
            if len(self.open[k]) == k:
                self._close(self.open[k])
                self.open[k] = []
            start += size

    def finish(self) -> None:
        for pieces in self.open.values():
            for piece in pieces:
                self._append(piece)
        left, rest, self.open = self.streamed, self.stream, {}
        while left:
            size = 1 << left.bit_length() - 1
            taken, room = [], size
            while room:
                doc_id, start, total, ids = rest.pop(0)
                taken.append((doc_id, start, total, ids[:room]))
                if len(ids) > room:
                    rest.insert(0, (doc_id, start + room, total, ids[room:]))
                room -= min(room, len(ids))
            self._close(taken)
            left -= size
        self.stream, self.streamed = [], 0


def pack(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    spaced: bool = False,
    capacity: int = CAPACITY,
    classes: int = CLASSES,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) with the sequence and offset where each one lies.

    ``with_ids`` adds each piece's ids (binary, little-endian 32-bit).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(vocabulary, spaced).encode
        end = np.array([end_id], dtype="<u2")
        packer = Packer(capacity, classes, TaskContext.get().partitionId() * TASK_SEQUENCES)

        def finished() -> pa.RecordBatch:
            rows, packer.done = packer.done, []
            cols = list(zip(*rows, strict=True)) or [()] * 7
            doc_id, start, length, total, sequence, offset, ids = cols
            out = [doc_id, start, length, list(map(crc32, ids)), total, sequence, offset]
            arrays = [pa.array(x, pa.int64()) for x in out]
            if with_ids:
                arrays.append(pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()))
            return pa.RecordBatch.from_arrays(arrays, schema=_WITH_IDS if with_ids else _KINDS)

        for batch in batches:
            for k in range(0, len(batch), BATCH_TEXTS):
                texts = batch.column(1).slice(k, BATCH_TEXTS).to_pylist()
                for doc_id, ids in zip(
                    batch.column(0).slice(k, BATCH_TEXTS).to_pylist(), encode(texts), strict=True
                ):
                    packer.add(doc_id, np.concatenate((ids, end)))
                if len(packer.done) >= BATCH_PIECES:
                    yield finished()
        packer.finish()
        yield finished()

    return docs.select("doc_id", "text").mapInArrow(run, PIECES + ", ids binary" * with_ids)


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens, with checksums of the ids returned."""
    vocabulary = tokens.public_path("word_bpe_49k.json")
    pieces = pack(table(spark, sf_dir, "documents"), vocabulary, end_id=2)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
