"""Elias-Fano sequences in anonymous memory maps, with vectorised access."""

from __future__ import annotations

import mmap

import numpy as np

#: place of the k-th set bit in each byte
SELECT = np.array([[([i for i in range(8) if b >> i & 1] + [8] * 8)[k] for k in range(8)] for b in range(256)], np.uint8)


def mapped(values: np.ndarray) -> np.ndarray:
    """A copy of an array in an anonymous memory map."""
    if not values.nbytes:
        return values
    out = np.frombuffer(mmap.mmap(-1, values.nbytes), values.dtype, len(values))
    out[:] = values
    return out


class EliasFano:
    """A non-decreasing sequence of n values below ``bound``: about 2 + log2(bound / n) bits each."""

    def __init__(self, values: np.ndarray, bound: int) -> None:
        n = self.n = len(values)
        self.bits = max(0, (max(1, bound) // max(1, n)).bit_length() - 1)
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros(int(high[-1]) + 1 if n else 0, np.uint8)
        flags[high] = 1
        self.high = mapped(np.packbits(flags, bitorder="little"))
        # ones before each byte; one count for eight bits of about two a value
        self.before = mapped(np.concatenate([[0], np.cumsum(np.bitwise_count(self.high), dtype=np.int64)[:-1]]).astype(np.uint32)) if n else np.zeros(0, np.uint32)
        low = np.zeros((n * self.bits + 7) // 8 + 8, np.uint8)
        if self.bits:
            for at in range(0, n, 1 << 16):  # 65536 values fill whole bytes
                part = values[at: at + (1 << 16)]
                own = (part[:, None] >> np.arange(self.bits, dtype=np.uint64)) & np.uint64(1)
                packed = np.packbits(own.astype(np.uint8).reshape(-1), bitorder="little")
                low[at * self.bits // 8: at * self.bits // 8 + len(packed)] = packed
        self.low = mapped(low)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        byte = np.searchsorted(self.before, at, side="right") - 1
        place = byte * 8 + SELECT[self.high[byte], at - self.before[byte]]
        out = (place - at).astype(np.uint64) << np.uint64(self.bits)
        if self.bits:
            first = at * self.bits
            start, shift = first >> 3, (first & 7).astype(np.uint64)
            out |= self._low(start, shift)
        return out

    def _low(self, start: np.ndarray, shift: np.ndarray) -> np.ndarray:
        word = np.zeros(len(start), np.uint64)
        for k in range(8):
            word |= self.low[start + k].astype(np.uint64) << np.uint64(8 * k)
        return (word >> shift) & np.uint64((1 << self.bits) - 1)

    def successor(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """First place in [low, high) whose value is at least ``value``; high if none."""
        low, high = low.copy(), high.copy()
        todo = np.flatnonzero(low < high)
        while todo.size:
            middle = (low[todo] + high[todo]) >> 1
            less = self[middle] < value[todo]
            low[todo[less]] = middle[less] + 1
            high[todo[~less]] = middle[~less]
            todo = todo[low[todo] < high[todo]]
        return low
