"""Counting quotient filters: compact, lossless counters of packed n-grams, kept sorted.

A key packs up to three word ids of ``bits`` bits into two halves of ``half`` bits. Four Feistel
rounds permute it invertibly, so that keys spread evenly and none is lost. Its leading bits name
a shard; within a shard the next bits are the quotient, the rest the remainder, kept in full. A
filter holds a bit per quotient (is it occupied), a bit per slot (does its run end here), the
remainders and the counts, in order of quotient and remainder. As filters are sorted, those of
several shards of the corpus merge by order, and their counts add up.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

ROUNDS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xAEF17502108EF2D9)
MULTIPLIER = np.uint64(0xFF51AFD7ED558CCD)
HEAD = struct.Struct("<QB")
#: A count of one byte; larger ones stand behind the others, in eight.
ESCAPE = 255

U = np.uint64


def _low(bits: int) -> np.uint64:
    return U((1 << bits) - 1)


@dataclass(frozen=True)
class Layout:
    """How keys of three ids of ``bits`` bits are split; there are 2 ** ``shard_bits`` shards."""

    bits: int
    shard_bits: int

    def __post_init__(self):
        if not 0 < self.bits <= 42 or not 0 <= self.shard_bits <= self.half:
            raise ValueError(f"keys of three ids of {self.bits} bits in 2^{self.shard_bits} shards")

    @property
    def half(self) -> int:
        return (3 * self.bits + 1) // 2

    # --- packing ---

    def pack(self, first: np.ndarray, second: np.ndarray, third: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The two halves of the keys of id triples (third 0: pairs)."""
        b, h = self.bits, self.half
        left = (first << U(2 * b - h)) | (second >> U(h - b))
        right = ((second << U(b)) & _low(h)) | third
        return left, right

    def unpack(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        b, h = self.bits, self.half
        second = ((right >> U(b)) | (left << U(h - b))) & _low(b)
        return left >> U(2 * b - h), second, right & _low(b)

    def _mixed(self, x: np.ndarray, key: int) -> np.ndarray:
        x = x + U(key)
        x = (x ^ (x >> U(33))) * MULTIPLIER
        return (x ^ (x >> U(29))) & _low(self.half)

    def permute(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for key in ROUNDS:
            left, right = right, left ^ self._mixed(right, key)
        return left, right

    def restore(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for key in reversed(ROUNDS):
            left, right = right ^ self._mixed(left, key), left
        return left, right

    # --- sorted runs ---

    def counted(self, left: np.ndarray, right: np.ndarray, counts: np.ndarray | None = None):
        """Permuted keys in order, each once, with the sum of its counts (one each by default)."""
        if not len(left):
            return left, right, np.zeros(0, U)
        if 2 * self.half <= 64:
            keys = (left << U(self.half)) | right
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            new = np.append(True, keys[1:] != keys[:-1])
        else:
            order = np.lexsort((right, left))
            a, b = left[order], right[order]
            new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        at = np.flatnonzero(new)
        if counts is None:
            sums = np.diff(np.append(at, len(order))).astype(U)
        else:
            sums = np.add.reduceat(counts[order], at)
        return left[order[at]], right[order[at]], sums

    # --- filters ---

    def filters(self, left: np.ndarray, right: np.ndarray, counts: np.ndarray):
        """(shard, filter) for every shard that the sorted keys touch."""
        shards = (left >> U(self.half - self.shard_bits)).astype(np.int64)
        starts = np.flatnonzero(np.append(True, shards[1:] != shards[:-1])) if len(shards) else []
        ends = np.append(starts[1:], len(shards)) if len(shards) else []
        for a, b in zip(starts, ends, strict=True):
            yield int(shards[a]), self.encode(left[a:b], right[a:b], counts[a:b])

    def encode(self, left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> bytes:
        """The filter of sorted keys of one shard."""
        n, h = len(left), self.half
        q = min(h - self.shard_bits, max(n.bit_length() - 1, 0))
        rest = h - self.shard_bits - q
        quotient = ((left >> U(rest)) & _low(q)).astype(np.int64)
        occupied = np.zeros(1 << q, bool)
        occupied[quotient] = True
        ends = np.append(quotient[1:] != quotient[:-1], True)
        high = left & _low(rest)
        words = np.stack([high >> U(64 - h), (high << U(h)) | right], axis=1).astype(">u8")
        width = (rest + h + 7) // 8
        remainders = words.view(np.uint8).reshape(n, 16)[:, 16 - width :]
        large = counts >= ESCAPE
        return b"".join(
            [
                HEAD.pack(n, q),
                np.packbits(occupied).tobytes(),
                np.packbits(ends).tobytes(),
                remainders.tobytes(),
                np.where(large, ESCAPE, counts).astype(np.uint8).tobytes(),
                counts[large].astype("<u8").tobytes(),
            ]
        )

    def decode(self, shard: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The sorted keys and counts of a filter."""
        n, q = HEAD.unpack_from(data)
        h, at = self.half, HEAD.size
        rest = h - self.shard_bits - q

        def take(size: int) -> np.ndarray:
            nonlocal at
            at += size
            return np.frombuffer(data, np.uint8, size, at - size)

        occupied = np.flatnonzero(np.unpackbits(take(((1 << q) + 7) // 8), count=1 << q))
        ends = np.unpackbits(take((n + 7) // 8), count=n)
        runs = np.cumsum(ends) - ends  # of the slots: how many runs ended before
        width = (rest + h + 7) // 8
        padded = np.zeros((n, 16), np.uint8)
        padded[:, 16 - width :] = take(n * width).reshape(n, width)
        words = padded.view(">u8").astype(U)
        right = words[:, 1] & _low(h)
        high = (words[:, 0] << U(64 - h)) | (words[:, 1] >> U(h))
        quotient = (U(shard) << U(q)) | occupied[runs].astype(U)
        counts = take(n).astype(U)
        large = counts == ESCAPE
        counts[large] = np.frombuffer(data, "<u8", int(large.sum()), at)
        return (quotient << U(rest)) | high, right, counts

    def merged(self, shard: int, filters: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys and summed counts of several filters of one shard."""
        parts = [self.decode(shard, f) for f in filters]
        return self.counted(*(np.concatenate(column) for column in zip(*parts, strict=True)))
