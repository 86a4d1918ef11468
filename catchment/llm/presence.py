"""A bounded bit map of keys, to pass rows by that a later join would drop."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: One megabyte; with many more keys the map lets everything pass, and the join still decides.
BITS = 1 << 23
SLICES = 64


def presence(keys: DataFrame) -> bytes:
    """Bits of a frame of one long column, modulo the size of the map."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(BITS // 8, np.uint8)
        for batch in batches:
            at = batch.column(0).to_numpy().astype(np.uint64) % np.uint64(BITS)
            np.bitwise_or.at(found, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        parts = [(number, zlib.compress(part.tobytes(), 1)) for number, part in enumerate(found.reshape(SLICES, -1)) if part.any()]
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.binary())], names=["slice", "bits"])

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        found = np.bitwise_or.reduce([np.frombuffer(zlib.decompress(part), np.uint8) for part in table["bits"].to_pylist()])
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([found.tobytes()], pa.binary())})

    total = np.zeros((SLICES, BITS // 8 // SLICES), np.uint8)
    for row in keys.mapInArrow(bits, "slice int, bits binary").groupBy("slice").applyInArrow(merge, "slice int, bits binary").collect():
        total[row["slice"]] = np.frombuffer(row["bits"], np.uint8)
    return total.tobytes()


def passes(bits: bytes, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be there."""
    at = keys.astype(np.uint64) % np.uint64(BITS)
    return (np.frombuffer(bits, np.uint8)[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
