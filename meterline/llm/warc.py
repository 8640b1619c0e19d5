"""Operator 3: WARC archives, written by Spark tasks and read back in byte ranges.

Writing: each task writes one archive of gzip members, one member per record. Of records with
equal payloads the one with the smallest page_id keeps it and the others become revisits that
name it; this is decided on digests only. An archive is named after the task attempt that wrote
it and counts only through the row its task returns.

Reading: archives are cut into byte ranges. A task looks for the gzip magic in its range,
validates a candidate by decoding its start (it must inflate to a WARC version line), and owns
the records that start inside the range; the last one may end beyond. After a record its end is
known exactly, so only the first record of a range is searched for. Text in UTF-8 cannot hold
the magic, as 0x8B never follows 0x1F in it; members are always deflated, and a chance match
within deflated bytes fails to decode.

Nulls and edge cases: a null payload is empty; payloads under ``MIN_REVISIT`` bytes are always
responses; rows that share the smallest page_id of a payload are all responses; a null page_id
comes after all others and a revisit never refers to it unless all are null (then all are
responses); an empty table gives no archives and no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline import session
from meterline.llm.frames import file_system
from meterline.llm.oracles import OP3_SQL
from meterline.llm.registry import query, table

MIN_REVISIT = 100
SPLIT_BYTES, READ_BYTES = 32 << 20, 1 << 20
#: A record's first bytes must inflate to this.
VERSION = b"WARC/1.1\r\n"
MAGIC = b"\x1f\x8b\x08"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "part int, path string, bytes long, records long"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, payload binary"
)


def decide(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``pages`` (page_id, url, html) with payload, digest, record_type and refers_to."""
    rows = pages.select(
        "page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    sized = rows.filter(F.octet_length("payload") >= min_revisit)
    first = (
        sized.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_id"))
        .filter("n > 1")
        .select("digest", "first_id")
    )
    revisit = ~F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("first_id").isNotNull()
    # Written first, so that adaptive execution can split a payload that many pages share.
    first = session.materialised(first, "first")
    return (
        rows.join(first, "digest", "left")
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisit, F.col("first_id")))
        .select("page_id", "url", "payload", "digest", "record_type", "refers_to")
    )


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, to: int | None) -> bytes:
    """One record, not yet compressed. A revisit has no body but tells the payload's length."""
    body = payload if kind == "response" else b""
    head = [
        ("WARC-Type", kind if kind == "revisit" else "response"),
        ("WARC-Record-ID", f"<urn:x-page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", "".join((url or "").splitlines())),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "text/html; charset=utf-8"),
    ]
    if kind == "revisit":
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:x-page:{to}>")]
        head += [("X-Payload-Length", str(len(payload)))]
    head.append(("Content-Length", str(len(body))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return VERSION + lines.encode() + b"\r\n" + body + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write a record per page below ``folder``; returns the manifest, a row per archive."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        path = f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz"
        out, size, n = None, 0, 0
        for batch in batches:
            if not out:
                store, inner = file_system(path)
                store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                out = store.open_output_stream(inner, compression=None)
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                member = gzip_member(record(*row))
                out.write(member)
                size, n = size + len(member), n + 1
        if out:
            out.close()
            row = {"part": [task.partitionId()], "path": [path], "bytes": [size], "records": [n]}
            kinds = [("part", pa.int32()), ("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]
            yield pa.RecordBatch.from_pydict(row, schema=pa.schema(kinds))

    return decide(pages, min_revisit).mapInArrow(write, MANIFEST)


class _Range:
    """Bytes of an open file from an offset on, read forward in blocks."""

    def __init__(self, file, offset: int):
        self.file, self.base, self.data = file, offset, b""

    def fill(self, offset: int) -> bool:
        """Make a byte at ``offset`` available; what lies before it is given up."""
        if offset > self.base:
            self.data, self.base = self.data[offset - self.base :], max(offset, self.base)
        if not self.data:
            self.file.seek(self.base)
            self.data = self.file.read(READ_BYTES)
        return bool(self.data)

    def more(self) -> bool:
        self.file.seek(self.base + len(self.data))
        block = self.file.read(READ_BYTES)
        self.data += block
        return bool(block)


def _candidate(r: _Range, offset: int, end: int) -> int | None:
    """The first place from ``offset`` on, before ``end``, where a record starts."""
    while offset < end and r.fill(offset):
        k = r.data.find(MAGIC)
        if k < 0:
            # The magic may lie across two blocks.
            keep = r.base + max(0, len(r.data) - len(MAGIC) + 1)
            if not r.more():
                return None
            offset = keep
            continue
        offset = r.base + k
        if offset >= end:
            return None
        r.fill(offset)
        if _starts_record(r):
            return offset
        offset += 1
    return None


def _starts_record(r: _Range) -> bool:
    start = zlib.decompressobj(31)
    fed = 0
    try:
        head = b""
        while len(head) < len(VERSION):
            if fed >= len(r.data) and not r.more():
                return False
            head += start.decompress(r.data[fed : fed + 512], len(VERSION) - len(head))
            fed += 512
    except zlib.error:
        return False
    return head == VERSION


def _member(r: _Range, offset: int) -> tuple[bytes, int] | None:
    """The inflated member at ``offset`` and the offset behind it; None at the file's end."""
    if not r.fill(offset):
        return None
    unzip, out = zlib.decompressobj(31), []
    while True:
        out.append(unzip.decompress(r.data))
        used = len(r.data) - len(unzip.unused_data)
        offset += used
        if unzip.eof:
            r.fill(offset)
            return b"".join(out), offset
        r.fill(offset)
        if not r.data:
            raise ValueError(f"the record before byte {offset} is cut off")


def parse(data: bytes) -> tuple:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    size = int(fields["Content-Length"])
    body, kind = rest[:size], fields["WARC-Type"]
    told = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    number = lambda x: int(x) if (x := x.removeprefix("<urn:x-page:").removesuffix(">")) else None
    page_id, url = number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"]
    if kind == "revisit":
        return page_id, url, int(fields["X-Payload-Length"]), told, kind, number(fields["WARC-Refers-To"]), None
    digest = hashlib.sha256(body).hexdigest()
    if digest != told or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"record of page {page_id} is damaged")
    return page_id, url, len(body), digest, kind, None, body


def records_between(path: str, first: int, last: int) -> Iterator[tuple]:
    """The records of an archive that start at bytes first..last-1."""
    store, inner = file_system(path)
    with store.open_input_file(inner) as file:
        r = _Range(file, first)
        at = _candidate(r, first, last)
        while at is not None and at < last:
            found = _member(r, at)
            if found is None:
                return
            yield parse(found[0])
            at = found[1]


def read_archives(spark: SparkSession, archives: list, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Every record of the manifest rows ``archives``, a row per file, in byte ranges."""
    splits = [
        (a["path"], k, min(k + split_bytes, a["bytes"]))
        for a in archives
        for k in range(0, a["bytes"], split_bytes)
    ]
    names = [x.split() for x in RECORDS.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(n, types[t]) for n, t in names])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(list(map(pa.array, columns, schema.types)), schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for split in batch.to_pylist():
                rows, held = [], 0
                for row in records_between(split["path"], split["first"], split["last"]):
                    rows.append(row)
                    held += 500 + len(row[-1] or b"")
                    if held > 1 << 22:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    todo = spark.createDataFrame(splits, "path string, first long, last long")
    return todo.repartition(max(1, len(splits))).mapInArrow(read, RECORDS)


@query("op3_warc", OP3_SQL)
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages, and describe the records read back."""
    folder = session.scratch_dir(spark, "warc")
    archives = write_archives(table(spark, sf_dir, "pages"), folder).collect()
    return read_archives(spark, archives).drop("payload", "url")
