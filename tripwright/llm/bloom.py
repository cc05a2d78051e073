"""A Bloom filter over a table of keys, built in tasks and bounded in size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripwright.llm.tables import spread
from tripwright.llm.words import mix

#: Bits for each key, and the bounds of a filter: 8 KiB and 64 MiB. Beyond that more keys pass.
BITS_PER_KEY, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 29
PART_BITS = 1 << 16


def places(keys: np.ndarray, bits: int) -> np.ndarray:
    """The two bits of each 64-bit key, one after the other; ``bits`` is a power of two."""
    ends = np.uint64(bits - 1)
    return np.concatenate((mix(keys) & ends, mix(keys ^ np.uint64(0xA5A5A5A5A5A5A5A5)) & ends)).astype(np.int64)


def holds(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Per key whether the filter lets it through."""
    at = places(keys, len(filter_) << 3)
    hit = (filter_[at >> 3] >> (at & 7) & 1).astype(bool)
    return hit[: len(keys)] & hit[len(keys) :]


def _fill(bits: int):
    schema = pa.schema([("part", pa.int32()), ("inner", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(places(batch.column(0).to_numpy().view(np.uint64), bits))
            part = at // PART_BITS
            edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1)) if len(at) else np.zeros(1, np.int64)
            cells = [(at[a:b] % PART_BITS).astype("<u4").tobytes() for a, b in zip(edges[:-1], edges[1:])]
            parts = part[edges[:-1]] if len(at) else []
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(cells, pa.binary())], schema=schema)

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, inner in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if part not in parts:
                parts[part] = np.zeros(PART_BITS, bool)
            parts[part][np.frombuffer(inner, "<u4")] = True
    schema = pa.schema([("part", pa.int32()), ("packed", pa.binary())])
    for part, own in parts.items():
        packed = np.packbits(own, bitorder="little").tobytes()
        yield pa.RecordBatch.from_pydict({"part": [part], "packed": [packed]}, schema=schema)


def filter_of(keys: DataFrame, count: int) -> np.ndarray:
    """The packed filter of the one column of 64-bit ``keys``; ``count`` of them, about.

    Its size follows the count up to MOST_BITS, so what comes to the driver is bounded. It
    holds every key; what else it lets through its user has to sort out.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (max(1, count * BITS_PER_KEY) - 1).bit_length()))
    local = keys.mapInArrow(_fill(bits), "part int, inner binary")
    merged = spread(local, "part").mapInArrow(_merge, "part int, packed binary")
    out = np.zeros(bits >> 3, np.uint8)
    width = PART_BITS >> 3
    for row in merged.collect():
        out[row.part * width : (row.part + 1) * width] = np.frombuffer(row.packed, np.uint8)
    return out
