"""Sharding by minimax contiguous partition over ordered atomic groups.

Equal texts form one atomic group. Groups are ordered by the hash of their text and cut into
contiguous shards so that the largest shard is as small as possible: the smallest feasible
capacity is found by binary search, each candidate checked by filling shards greedily.

The group sizes never leave the executors as a whole. The search runs over sums of hash ranges: a
capacity that works when ranges may be cut anywhere bounds the answer from below, one that works
with ranges kept whole bounds it from above. Ranges in which a cut can lie are summed again, finer,
until no cut is open. A round brings a bounded number of sums to the driver: 2^14 at first, then
2^6 for each open range, of which there are at most about 25 a shard.

Defined results: null text has no bytes and groups with the empty text; texts whose 64-bit hashes
agree share a group; repeated rows are sharded each; an empty table stays empty; with fewer groups
than shards the last shards are empty.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from credence.llm.work import table, text_of

SHARDS = 40
ROW_BYTES = 16
FIRST_BITS = 14
MORE_BITS = 6
SLOT_CELLS = 1024
BITS = 64


def reach(prefix: list[int], start: int, capacity: int, loose=None) -> int:
    """Where a shard that starts at byte ``start`` ends when filled greedily.

    ``prefix`` holds the running sums of the ranges from 0; a ``loose`` range may be cut anywhere,
    the others only at their ends.
    """
    at = bisect_right(prefix, start + capacity) - 1
    if at >= len(prefix) - 1:
        return prefix[-1]
    return start + capacity if loose and loose[at] else max(prefix[at], start)


def needed(prefix: list[int], capacity: int, most: int, start: int = 0, loose=None) -> int:
    """Shards that greedy filling needs from ``start``; more than ``most`` if it takes too many."""
    used = 0
    while start < prefix[-1] and used <= most:
        end = reach(prefix, start, capacity, loose)
        if end == start:
            return most + 1
        start, used = end, used + 1
    return used


def smallest(prefix: list[int], shards: int, loose=None) -> int:
    """Smallest capacity with which greedy filling needs no more than ``shards``."""
    low, high = -(-prefix[-1] // shards), prefix[-1]
    while low < high:
        middle = (low + high) // 2
        if needed(prefix, middle, shards, loose=loose) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def undecided(prefix: list[int], loose: list[bool], shards: int, low: int, high: int) -> list[int]:
    """Loose ranges in which a cut can lie for some capacity between the bounds."""
    early = late = 0
    found: set[int] = set()
    for _ in range(shards - 1):
        early, late = reach(prefix, early, low), reach(prefix, late, high, loose)
        first = max(bisect_right(prefix, early) - 1, 0)
        last = bisect_left(prefix, late)
        found.update(i for i in range(first, min(last, len(loose))) if loose[i])
    return sorted(found)


def balanced(prefix: list[int], capacity: int, shards: int) -> list[int]:
    """Indices into ``prefix`` of the ends of all shards but the last.

    Every shard keeps within the capacity. Where it leaves a choice (one large group sets it), each
    shard takes the even share of what is left, as long as the rest then still fits.
    """
    ends, i, n = [], 0, len(prefix) - 1
    for left in range(shards, 1, -1):
        most = bisect_right(prefix, prefix[i] + capacity) - 1
        goal = prefix[i] + (prefix[-1] - prefix[i]) / left
        j = bisect_left(prefix, goal)
        if 0 < j <= n and goal - prefix[j - 1] <= prefix[j] - goal:
            j -= 1
        j = min(max(j, min(i + 1, n)), most)
        low, high = j, most
        while low < high:
            middle = (low + high) // 2
            if needed(prefix, capacity, left - 1, prefix[middle]) <= left - 1:
                high = middle
            else:
                low = middle + 1
        i = low
        ends.append(i)
    return ends


def cell_of(bits: int) -> Column:
    """The first bits of the hash."""
    return F.shiftright("h", BITS - bits) if bits < BITS else F.col("h")


def minimax_cuts(groups: DataFrame, shards: int = SHARDS,
                 first_bits: int = FIRST_BITS) -> tuple[int, list[int]]:
    """(capacity, last hash of each shard but the last) of (h, size) rows ordered by h."""
    def summed(df: DataFrame, bits: int) -> list[tuple[int, int, int, int]]:
        """(lowest hash, highest hash, bytes, cell) of each range of hashes with equal first bits."""
        rows = df.groupBy(cell_of(bits).alias("c")).agg(
            F.min("h").alias("lo"), F.max("h").alias("hi"), F.sum("size").alias("s")).collect()
        return [(r["lo"], r["hi"], r["s"], r["c"]) for r in rows]

    bits = first_bits
    ranges = sorted(summed(groups, bits))
    if not ranges:
        return 0, []
    while True:
        prefix = [0, *accumulate(r[2] for r in ranges)]
        loose = [r[0] != r[1] for r in ranges]
        high = smallest(prefix, shards)
        open_ = set(undecided(prefix, loose, shards, smallest(prefix, shards, loose), high))
        if not open_:
            ends = balanced(prefix, high, shards)
            return high, [ranges[e - 1][1] for e in ends]
        # The bounds only close in, so what is open now is of the last, finest cut.
        cells = groups.sparkSession.createDataFrame([(ranges[i][3],) for i in open_], "c long")
        inside = groups.join(F.broadcast(cells), cell_of(bits) == F.col("c"), "left_semi")
        bits = min(BITS, bits + MORE_BITS)
        ranges = sorted([r for i, r in enumerate(ranges) if i not in open_]
                        + summed(inside, bits))


def measured(docs: DataFrame, carry: list[str]) -> DataFrame:
    body = text_of().cast("binary")
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        (F.octet_length(text_of()) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"), F.xxhash64(text_of()).alias("h"),
        F.pmod(F.xxhash64("doc_id"), F.lit(SLOT_CELLS)).cast("int").alias("cell"),
        F.col("doc_id").alias("order_id"))


def shard_documents(docs: DataFrame, carry: list[str] | None = None,
                    shards: int = SHARDS) -> DataFrame:
    """The carried columns (doc_id by default) with size, checksum, shard and slot.

    Slots are numbered in cells of the document id's hash, which also spreads the rows of a large
    group, and the cells' row counts are summed per shard. Carried columns must not have the names
    of the new ones.
    """
    carry = ["doc_id"] if carry is None else carry
    rows = table(measured(docs, ["doc_id"]), "rows")
    groups = table(rows.groupBy("h").agg(F.sum("size").alias("size")), "groups")
    _, ends = minimax_cuts(groups, shards)
    shard = sum(((F.col("h") > F.lit(e)).cast("int") for e in ends), F.lit(0))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = table(rows.withColumn("shard", shard).groupBy("shard", "cell").agg(
        F.count(F.lit(1)).alias("n")).select(
        "shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")),
        "slot_starts")
    within = Window.partitionBy("shard", "cell").orderBy("order_id", "h")
    placed = (rows if carry == ["doc_id"] else measured(docs, carry)).withColumn("shard", shard)
    return (placed.withColumn("place", F.row_number().over(within) - 1)
            .join(starts, ["shard", "cell"])
            .select(*[F.col(f"row.`{c}`").alias(c) for c in carry], "size", "text_crc32",
                    F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                    (F.col("start") + F.col("place")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
