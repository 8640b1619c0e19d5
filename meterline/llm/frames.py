"""Files of token ids in independently compressed frames (public seekable Zstandard layout).

A file is a row of zstandard frames of 16-bit ids, one skippable frame with the document
index, and a trailing skippable frame with the seek table: compressed size, size and checksum
(low half of XXH64 of the content) of each frame before it. A reader loads the two tails and
then decompresses only the frames that the wanted documents touch.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import xxhash
import zstandard
from pyarrow import fs

# Fixed values of the public format.
SKIPPABLE_INDEX, SKIPPABLE_TABLE, SEEKABLE = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1
_ENTRY, _FOOTER, _HEAD = struct.Struct("<III"), struct.Struct("<IBI"), struct.Struct("<II")
_WITH_CHECKSUMS = 0x80

#: Ids of a frame; documents longer than this are cut over several frames.
FRAME_IDS = 1 << 16


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The store that holds ``path`` and the path in it; a path without scheme is local."""
    if "://" in path or path.startswith("file:"):
        scheme, _, rest = path.partition(":")
        if scheme == "file":
            return fs.LocalFileSystem(), "/" + rest.lstrip("/")
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class FrameWriter:
    """Writes documents to one file; memory holds one frame and 17 bytes a document."""

    def __init__(self, path: str, frame_ids: int = FRAME_IDS, level: int = 3):
        store, inner = file_system(path)
        store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.out = store.open_output_stream(inner, compression=None)
        self.frame_ids, self.zip = frame_ids, zstandard.ZstdCompressor(level=level)
        self.table: list[tuple[int, int, int]] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.n_waiting and self.n_waiting + len(ids) > self.frame_ids:
            self._flush()
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        for k in range(0, len(ids), self.frame_ids):
            part = ids[k : k + self.frame_ids]
            self.waiting.append(part)
            self.n_waiting += len(part)
            if self.n_waiting >= self.frame_ids:
                self._flush()

    def _flush(self) -> None:
        if self.waiting:
            raw = np.concatenate(self.waiting).astype("<u2").tobytes()
            packed = self.zip.compress(raw)
            self.out.write(packed)
            self.table.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.waiting, self.n_waiting = [], 0

    def close(self) -> int:
        """Write both tails; returns the number of ids in the file."""
        self._flush()
        known = np.array([x is not None for x in self.doc_ids], dtype="u1")
        doc_ids = np.array([x or 0 for x in self.doc_ids], dtype="<i8")
        lengths = np.array(self.lengths, dtype="<i8")
        raw = struct.pack("<Q", len(lengths)) + known.tobytes() + doc_ids.tobytes() + lengths.tobytes()
        index = self.zip.compress(raw)
        self.out.write(_HEAD.pack(SKIPPABLE_INDEX, len(index)) + index)
        entries = [*self.table, (len(index) + _HEAD.size, 0, 0)]
        body = b"".join(_ENTRY.pack(*x) for x in entries)
        body += _FOOTER.pack(len(entries), _WITH_CHECKSUMS, SEEKABLE)
        self.out.write(_HEAD.pack(SKIPPABLE_TABLE, len(body)) + body)
        self.out.close()
        return int(lengths.sum())


class FrameReader:
    """Random access to the documents of one file, by their position in it."""

    def __init__(self, path: str):
        store, inner = file_system(path)
        self.file = store.open_input_file(inner)
        size = self.file.size()
        count, flags, magic = _FOOTER.unpack(self._at(size - _FOOTER.size, _FOOTER.size))
        if magic != SEEKABLE or flags != _WITH_CHECKSUMS:
            raise ValueError(f"no seek table at the end of {path}")
        body = count * _ENTRY.size + _FOOTER.size
        entries = self._at(size - body, count * _ENTRY.size)
        *self.table, index = _ENTRY.iter_unpack(entries)
        packed = self._at(size - body - _HEAD.size - index[0], index[0])[_HEAD.size :]
        raw = zstandard.ZstdDecompressor().decompress(packed)
        (n,) = struct.unpack_from("<Q", raw)
        self.known = np.frombuffer(raw, "u1", n, 8).astype(bool)
        self.doc_ids = np.frombuffer(raw, "<i8", n, 8 + n)
        self.lengths = np.frombuffer(raw, "<i8", n, 8 + 9 * n)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))
        self.frame_at = np.concatenate(([0], np.cumsum([x[0] for x in self.table]))).astype(int)
        self.frame_start = np.concatenate(([0], np.cumsum([x[1] // 2 for x in self.table])))
        self.last: tuple[int, np.ndarray] | None = None

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def _frame(self, k: int) -> np.ndarray:
        if self.last is None or self.last[0] != k:
            packed, size, check = self.table[k]
            data = self._at(int(self.frame_at[k]), packed)
            raw = zstandard.ZstdDecompressor().decompress(data, max_output_size=size)
            if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {k} is damaged")
            self.last = k, np.frombuffer(raw, "<u2")
        return self.last[1]

    def ids(self, position: int) -> np.ndarray:
        """Ids of the document at ``position``; reads the frames it touches only."""
        start, end = int(self.starts[position]), int(self.starts[position + 1])
        k = int(np.searchsorted(self.frame_start, start, side="right")) - 1
        parts = []
        while start < end:
            base, frame = int(self.frame_start[k]), self._frame(k)
            parts.append(frame[start - base : end - base])
            start, k = base + len(frame), k + 1
        return np.concatenate(parts) if parts else np.zeros(0, "<u2")

    def documents(self, first: int, last: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, ids before it in the file, ids) of the documents at first..last-1."""
        for k in range(first, last):
            yield (int(self.doc_ids[k]) if self.known[k] else None), int(self.starts[k]), self.ids(k)

    def close(self) -> None:
        self.file.close()
