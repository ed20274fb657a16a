"""Tables of counters of a fixed size: each task counts into its own, which are added up by parts."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Counters in one row on their way.
PART = 1 << 12
SCHEMA = "part int, counts binary"


def parts_of(counts: np.ndarray) -> pa.RecordBatch:
    """A task's counters in rows, without parts that are all zero."""
    parts = np.flatnonzero(counts.reshape(-1, PART).any(1)).tolist()
    return pa.RecordBatch.from_arrays(
        [pa.array(parts, pa.int32()), pa.array(
            [zlib.compress(counts[k * PART:(k + 1) * PART].tobytes(), 1) for k in parts],
            pa.binary())], ["part", "counts"])


def added(rows: DataFrame, kind: type, size: int,
          finish: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``finish`` of the sums, ``size`` counters whatever the input, on the driver.

    Counters of ``kind`` come in parts. A task adds up some parts of all, one row at a time, and
    hands on what ``finish`` makes of each.
    """
    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts")):
                counts = np.frombuffer(zlib.decompress(counts.as_buffer()), kind)
                total[part] = total.get(part, 0) + counts.astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()),
             pa.array([finish(c).tobytes() for c in total.values()], pa.binary())],
            ["part", "counts"])

    found = rows.select("part", "counts").repartition("part").mapInArrow(add, SCHEMA).toArrow()
    empty = finish(np.zeros(PART, np.int64))
    out = np.tile(empty, size // PART)
    for part, counts in zip(found.column("part").to_pylist(), found.column("counts")):
        out[part * len(empty):(part + 1) * len(empty)] = np.frombuffer(
            counts.as_buffer(), empty.dtype)
    return out
