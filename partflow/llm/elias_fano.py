"""Elias-Fano code of a rising sequence, with samples that find the k-th value.

The low ``l`` bits of every value are packed; the rest is a bit vector in which
value ``k`` sets bit ``(value >> l) + k``: about ``2 + log2(universe / count)``
bits per value. ``select`` starts at the nearest sample and counts bits from
there, so no table of 64-bit offsets is kept.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = struct.Struct("<QQB7x")
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1)


def encode(values: np.ndarray) -> bytes:
    """``values``: rising integers, the last one bounds the universe."""
    values = np.asarray(values, np.uint64)
    count, universe = len(values), int(values[-1]) + 1 if len(values) else 1
    low_bits = max(0, (universe // max(count, 1)).bit_length() - 1)
    low = ((values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(count)
    high = np.zeros((universe >> low_bits) + count + 1, np.uint8)
    high[ones] = 1
    return b"".join(
        [
            _HEAD.pack(count, universe, low_bits),
            ones[::SAMPLE].astype("<u4").tobytes(),
            np.packbits(low.reshape(-1), bitorder="little").tobytes(),
            np.packbits(high, bitorder="little").tobytes(),
        ]
    )


class Reader:
    def __init__(self, data: bytes | memoryview):
        self.count, self.universe, self.low_bits = _HEAD.unpack_from(data)
        at = _HEAD.size
        samples = -(-self.count // SAMPLE)
        self.samples = np.frombuffer(data, "<u4", samples, at)
        at += 4 * samples
        n = -(-self.count * self.low_bits // 8)
        self.low = np.frombuffer(data, np.uint8, n, at)
        n_high = -(-((self.universe >> self.low_bits) + self.count + 1) // 8)
        self.high = np.frombuffer(data, np.uint8, n_high, at + n)
        self.size = at + n + n_high

    def _low(self, k: np.ndarray) -> np.ndarray:
        bit = k[:, None] * self.low_bits + np.arange(self.low_bits)
        bits = (self.low[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
        return (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)

    def select(self, k: int) -> int:
        """The ``k``-th value, from the sample before it."""
        if not 0 <= k < self.count:
            raise IndexError(k)
        bit = int(self.samples[k // SAMPLE])
        left = k % SAMPLE
        byte = bit >> 3
        ones = int(_ONES[self.high[byte] & (0xFF << (bit & 7) & 0xFF)])
        while ones <= left:
            left -= ones
            byte += 1
            bit = byte << 3
            ones = int(_ONES[self.high[byte]])
        inside = np.flatnonzero(np.unpackbits(self.high[byte : byte + 1], bitorder="little")[bit & 7 :])[left]
        at = (byte << 3) + (bit & 7) + int(inside)
        return ((at - k) << self.low_bits) | int(self._low(np.array([k]))[0])

    def all(self) -> np.ndarray:
        """Every value in order."""
        k = np.arange(self.count)
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.count]
        return ((ones - k).astype(np.uint64) << np.uint64(self.low_bits) | self._low(k)).astype(np.int64)
