"""Elias-Fano code of a non-decreasing sequence, with a select structure.

n values up to u take about n * (2 + log2(u / n)) bits: the low bits are packed
as they are, the high parts are gaps in unary in a bit vector. The place of
every ``SAMPLE``-th one of that vector is stored, so one value is read by
looking at a few words, without decoding the rest and without a table of 64-bit
offsets.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 64
_HEAD = struct.Struct("<4sBxxxqqqq")  # magic, low bits, values, upper limit, bytes of low part, bytes of high part
MAGIC = b"EFv1"


class EliasFano:
    def __init__(self, low_bits: int, count: int, limit: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.low_bits, self.count, self.limit = low_bits, count, limit
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.int64)
        count = len(values)
        if count and (values[0] < 0 or (np.diff(values) < 0).any()):
            raise ValueError("the values must not decrease and not be negative")
        limit = int(values[-1]) if count else 0
        low_bits = max(0, (limit // count).bit_length() - 1) if count else 0
        spread = (values[:, None] >> np.arange(low_bits)) & 1
        low = np.packbits(spread.astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> low_bits) + np.arange(count)
        bits = np.zeros(int(ones[-1]) + 1 if count else 0, dtype=np.uint8)
        bits[ones] = 1
        return cls(low_bits, count, limit, low, np.packbits(bits, bitorder="little"), ones[::SAMPLE].astype(np.uint32))

    def select(self, i: int) -> int:
        """Place of the i-th one of the high part: from the last sample on, byte by byte."""
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        if not left:
            return place
        at = place // 8
        byte = int(self.high[at]) >> (place % 8 + 1) << (place % 8 + 1)
        while left > (ones := byte.bit_count()):
            left -= ones
            at += 1
            byte = int(self.high[at])
        for _ in range(left - 1):
            byte &= byte - 1
        return at * 8 + (byte & -byte).bit_length() - 1

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.count:
            raise IndexError(i)
        start = i * self.low_bits
        packed = int.from_bytes(self.low[start >> 3 : (start + self.low_bits + 7) >> 3].tobytes(), "little")
        low = packed >> (start & 7) & ((1 << self.low_bits) - 1)
        return (self.select(i) - i) << self.low_bits | low

    def values(self) -> np.ndarray:
        """All values at once."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.count]
        spread = np.unpackbits(self.low, bitorder="little")[: self.count * self.low_bits]
        low = spread.reshape(self.count, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return ((ones - np.arange(self.count)) << self.low_bits) + low

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(MAGIC, self.low_bits, self.count, self.limit, len(self.low), len(self.high))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        magic, low_bits, count, limit, n_low, n_high = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not an Elias-Fano sequence")
        at = _HEAD.size
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        samples = np.frombuffer(data, "<u4", -(-count // SAMPLE), at + n_low + n_high)
        return cls(low_bits, count, limit, low, high, samples)
