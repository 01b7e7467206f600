"""A bit table of bounded size over 64-bit keys: passes over keys that are surely not in a table, before a shuffle."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textbuf as tb

#: Bits for each key, between these powers of two (16 MB at most). A table that fills up passes over less, and loses nothing.
BITS_PER_KEY, LEAST_BITS, MOST_BITS = 32, 22, 27


class Bits:
    """Which keys may exist: two bits each."""

    def __init__(self, table: np.ndarray):
        self.table, self.shift = table, np.uint64(64 - (len(table) - 1).bit_length())

    @classmethod
    def unpack(cls, size: int, packed: bytes) -> Bits:
        return cls(np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8)).view(bool)[:size])

    def slots(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (keys >> self.shift).astype(np.int64), (tb.mix(keys) >> self.shift).astype(np.int64)

    def add(self, keys: np.ndarray) -> None:
        for at in self.slots(keys):
            self.table[at] = True

    def has(self, keys: np.ndarray) -> np.ndarray:
        a, b = self.slots(keys)
        return self.table[a] & self.table[b]


def bit_table(keys: DataFrame, n: int) -> tuple[int, bytes]:
    """(size, packed table) over the one column of keys, longs or lists of them; n: about how many. The parts come to the driver one by one."""
    size = 1 << min(MOST_BITS, max(LEAST_BITS, (n * BITS_PER_KEY).bit_length()))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = Bits(np.zeros(size, bool))
        for batch in batches:
            col = batch.column(0)
            col = col.flatten() if pa.types.is_list(col.type) or pa.types.is_large_list(col.type) else col
            bits.add(col.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(np.packbits(bits.table).tobytes(), 1)], pa.binary())], names=["bits"])

    table = np.zeros(size // 8, np.uint8)
    for r in keys.coalesce(8).mapInArrow(part, "bits binary").toLocalIterator():
        table |= np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
    return size, zlib.compress(table.tobytes(), 1)
