"""Elias-Fano coding of a rising sequence, with sampled select, in numpy."""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256  # ones between two samples of select
_HEAD = struct.Struct("<QQBQQ")  # numbers, universe, low bits, bytes of the lows, bytes of the highs


def encode(values: np.ndarray) -> bytes:
    """Code rising numbers from 0 up in about 2 + log2(universe / count) bits each.

    The low bits lie packed one after the other; the high parts are a unary bit string in which
    the i-th one stands at high(i) + i; the place of every 256th one is kept for select.
    """
    v = np.asarray(values, np.uint64)
    n, universe = len(v), int(v[-1]) + 1 if len(v) else 0
    bits = max(0, (universe // n).bit_length() - 1) if n else 0
    low = (v[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    lows = np.packbits(low.astype(np.uint8).ravel(), bitorder="little").tobytes()
    ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
    plain = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    plain[ones] = 1
    highs = np.packbits(plain, bitorder="little").tobytes()
    return _HEAD.pack(n, universe, bits, len(lows), len(highs)) + lows + highs + ones[::SAMPLE].astype("<u4").tobytes()


class Reader:
    """Numbers of a coded sequence, by position, straight from its bytes."""

    def __init__(self, data: bytes, at: int = 0):
        self.n, self.universe, self.bits, lows, highs = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        self._lows = np.frombuffer(data, np.uint8, lows, at)
        self._highs = np.frombuffer(data, np.uint8, highs, at + lows)
        self._samples = np.frombuffer(data, "<u4", -(-self.n // SAMPLE), at + lows + highs)
        self.end = at + lows + highs + 4 * len(self._samples)

    def _low(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.uint64)
        for b in range(self.bits):
            at = i * self.bits + b
            out |= ((self._lows[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(b)
        return out

    def select(self, i: int) -> int:
        """The i-th number: from the nearest sample, scan the high bits to the i-th one."""
        place = int(self._samples[i // SAMPLE])
        left, byte = i % SAMPLE, place >> 3
        window = int(self._highs[byte]) >> (place & 7) << (place & 7)
        while (ones := window.bit_count()) <= left:
            left -= ones
            byte += 1
            window = int(self._highs[byte])
        for _ in range(left):
            window &= window - 1
        one = byte * 8 + (window & -window).bit_length() - 1
        return (one - i) << self.bits | int(self._low(np.array([i]))[0])

    def all(self) -> np.ndarray:
        """Every number, in one pass over the bits."""
        ones = np.flatnonzero(np.unpackbits(self._highs, bitorder="little"))[: self.n]
        i = np.arange(self.n)
        return ((ones - i).astype(np.uint64) << np.uint64(self.bits)) | self._low(i)
