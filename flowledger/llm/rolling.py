"""Hashes of many stretches of one buffer: prefix sums of weighted bytes, modulo 2^64."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PIECE = 1 << 18  # bytes of text a task hashes at a time

_BASE = 0xD1342543DE82EF95  # odd: invertible modulo 2^64


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * PIECE)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                powers = np.full(n, base, np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))
        return self.up[:n], self.down[:n]


POWERS = _Powers()


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data, offsets
