"""Sets of hashes as bit maps of a fixed size, put together by the engine's bitmap functions.

A member is always in its map; another value may be too.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a map: 16 MiB, whatever the corpus.
MAP_BITS = 1 << 27
#: Bits in a part of a map, as the engine's bitmap functions have it.
PART_BITS = 1 << 15


def packed_map(marks: np.ndarray) -> bytes:
    """A map on its way to the tasks; a sparse one is short."""
    return zlib.compress(marks.tobytes(), 1)


def opened(marks: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(marks), np.uint8)


def bit_map(places: DataFrame) -> bytes:
    """The map, packed, with the bits of column ``bit`` set, put together where the rows are.

    At most ``MAP_BITS`` come to the driver.
    """
    parts = places.groupBy(F.expr(f"bit div {PART_BITS}").alias("part")).agg(
        F.bitmap_construct_agg(F.col("bit") % PART_BITS).alias("bits")).toArrow()
    out = np.zeros(MAP_BITS // 8, np.uint8)
    for part, bits in zip(parts.column("part").to_pylist(), parts.column("bits")):
        bits = np.frombuffer(bits.as_buffer(), np.uint8)
        out[part * PART_BITS // 8:][:len(bits)] = bits
    return packed_map(out)


def in_map(marks: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (marks[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 > 0
