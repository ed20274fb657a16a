"""Near-duplicates by an LSH forest.

Every distinct set of word shingles gets a MinHash signature. Each tree of the forest orders the
signatures by a sequence of their own; sets that share the tree's first ``DEPTH`` values form a
region, and inside a region the order goes on by deeper values. Candidates of a set are its
``REACH`` neighbours in that order, those with the longest common prefix. Small regions thus pair
all their sets; in larger ones the depth adapts, as the nearest neighbours agree deepest.

Candidates are confirmed on full shingle sets. Documents with equal sets are one node. All pairs of
regions within the neighbours' reach are confirmed; in larger regions, where most links lie inside
one component, each node's best candidate is. Members of larger regions that still hold several
components are joined exactly, by an index of their sets' rare shingles, so only pairs across
components that can be similar enough are ever formed (``jaccard_join``).

Defined results: null, empty and wordless texts have no shingles and are linked with nothing; a
text of fewer words than a shingle is one shingle of all its words; a null id is linked with
nothing; rows with equal ids are one node; an empty table stays empty.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credence.llm import jaccard_join
from credence.llm.components import components
from credence.llm.text_kernel import (
    binary_array,
    give_back,
    mixed,
    shingle_sets,
)
from credence.llm.work import Workspace, row_of, small_batches, table, unpacked

SHINGLE = 5
PERCENT = 80
TREES = 32
DEPTH = 4
#: Values of a signature beyond ``DEPTH`` that order a region, 16 bits of each.
DEEPER = 4
REACH = 3
HASHES = TREES * DEPTH

_rng = np.random.default_rng(7)
_TIMES = _rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Smallest value of each hash function over a set."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)[:, None]
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 256):
        np.minimum(least, (low[i:i + 256] * _TIMES + _PLUS).min(0), out=least)
    return least


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set and signature; both null without shingles."""
    def sketch(batches):
        for batch in batches:
            sizes, digests, signs = [], [], []
            for s in shingle_sets(batch.column("text"), shingle):
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                               if len(s) else None)
                signs.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.array(digests, pa.binary()), pa.array(signs, pa.binary())],
                ["doc_id", "n_shingles", "digest", "sign"])
            give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        sketch, "doc_id long, n_shingles long, digest binary, sign binary")


def labels(nodes: DataFrame) -> DataFrame:
    """Each node's place in every tree: region, deeper order, set size and id."""
    def place(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sign = np.frombuffer(b"".join(batch.column("sign").to_pylist()),
                                 np.uint32).reshape(n, HASHES).astype(np.uint64)
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            sizes = batch.column("n_shingles").to_numpy(zero_copy_only=False)
            for tree in range(TREES):
                at = tree * DEPTH
                region = np.full(n, tree, np.uint64)
                for k in range(DEPTH):
                    region = mixed(region * np.uint64(0x9E3779B97F4A7C15) + sign[:, at + k])
                deep = np.zeros(n, np.uint64)
                for k in range(DEEPER):
                    value = mixed(sign[:, (at + DEPTH + k) % HASHES]) & np.uint64(0xFFFF)
                    deep = deep << np.uint64(16) | value
                yield pa.RecordBatch.from_arrays(
                    [pa.array(region.view(np.int64)), pa.array(deep.view(np.int64)),
                     pa.array(sizes, pa.int64()), pa.array(ids, pa.int64())],
                    ["region", "deep", "n", "id"])

    return nodes.mapInArrow(place, "region long, deep long, n long, id long")


def neighbours(placed: DataFrame, percent: int, reach: int = REACH) -> DataFrame:
    """(a, b, small) for neighbours in a tree's order, and ``dense``, regions beyond the reach.

    ``small`` says that the pair's region is within the reach, so that all its pairs are given.
    Rows are dealt by ranges of the order, so a region of any size is cut into many tasks; a region
    at the edge of one counts as beyond the reach. Each partition is read in order and at most
    ``reach + 1`` rows are held.
    """
    def pairs_of(region, n, ids, size, old):
        a, b, small = [], [], []
        for k in range(1, min(reach, len(region) - 1) + 1):
            i = np.arange(max(k, old), len(region))
            j = i - k
            ok = ((region[i] == region[j]) & (ids[i] != ids[j])
                  & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])))
            i, j = i[ok], j[ok]
            a.append(np.minimum(ids[i], ids[j]))
            b.append(np.maximum(ids[i], ids[j]))
            small.append(size[i] <= reach + 1)
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        small = np.concatenate(small) if small else np.zeros(0, bool)
        dense = np.unique(region[old:][size[old:] > reach + 1])
        none, some = pa.nulls(len(dense), pa.int64()), pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array(a, pa.int64()), none]),
             pa.concat_arrays([pa.array(b, pa.int64()), none]),
             pa.concat_arrays([pa.array(small, pa.bool_()), pa.nulls(len(dense), pa.bool_())]),
             pa.concat_arrays([some, pa.array(dense, pa.int64())])],
            ["a", "b", "small", "dense"])

    def walk(batches):
        held = [np.zeros(0, np.int64)] * 3
        old = 0  # rows held only as neighbours: of a large region, already given
        edge = True  # the partition's first region may have begun before
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [np.concatenate((h, batch.column(c).to_numpy(zero_copy_only=False)))
                    for h, c in zip(held, ("region", "n", "id"))]
            region = rows[0]
            run = np.cumsum(np.append(False, region[1:] != region[:-1]))
            sizes = np.bincount(run)
            if old or edge:
                sizes[0] += reach + 1
            size = sizes[run]
            if sizes[-1] > reach + 1:
                yield pairs_of(*rows, size, old)
                keep = min(reach, int((run == run[-1]).sum()))
                old = keep
            else:
                keep = int(sizes[-1])
                done = len(region) - keep
                if done > old:
                    yield pairs_of(*(x[:done] for x in rows), size[:done], old)
                edge, old = edge and not done, 0
            held = [x[len(x) - keep:] for x in rows]
        if len(held[0]) > old:
            yield pairs_of(*held, np.full(len(held[0]), reach + 2), old)

    keys = ["region", "deep", "n", "id"]
    return (placed.repartitionByRange(*keys).sortWithinPartitions(*keys)
            .select("region", "n", "id").mapInArrow(
        walk, "a long, b long, small boolean, dense long"))


def full_sets(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """(id, shingles): the full set of each listed document, as packed 64-bit hashes."""
    def pack(batches):
        for batch in batches:
            sets = list(shingle_sets(batch.column("text"), shingle))
            ends = np.cumsum([0] + [8 * len(s) for s in sets])
            data = np.concatenate(sets).view(np.uint8) if sets else np.zeros(0, np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), binary_array(data, ends)], ["id", "shingles"])
            give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        ids, F.col("doc_id") == F.col("id"), "left_semi").mapInArrow(
        pack, "id long, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) whose full sets are similar enough."""
    def check(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])
            give_back()

    return (pairs.select("a", "b")
            .join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
            .mapInArrow(check, "a long, b long").distinct())


def best_of_each(pairs: DataFrame) -> DataFrame:
    """Each node's candidate found in most trees."""
    pick = F.struct("votes", "a", "b").alias("pick")
    return (pairs.select(F.col("a").alias("d"), pick)
            .unionAll(pairs.select(F.col("b").alias("d"), pick))
            .groupBy("d").agg(F.max("pick").alias("pick"))
            .select("pick.a", "pick.b").distinct())


def crowded(placed: DataFrame, dense: DataFrame, comps: DataFrame, space: Workspace) -> DataFrame:
    """(id, class): members of large regions that hold several components."""
    members = space.table(placed.join(dense, "region", "left_semi").select("region", "id").join(
        comps.select(F.col("node").alias("id"), F.col("component").alias("class")), "id", "left")
        .withColumn("class", F.coalesce("class", "id")), "in_dense")
    several = space.table(members.groupBy("region").agg(
        F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo <> hi").select("region"),
        "several")
    return space.table(members.join(several, "region", "left_semi").select("id", "class").distinct(),
                       "crowded")


def near_components(docs: DataFrame, sketched: DataFrame, shingle: int, percent: int,
                    space: Workspace) -> DataFrame:
    """(id, component) of every id linked to a smaller one or to its own representative."""
    known = sketched.filter("doc_id IS NOT NULL AND digest IS NOT NULL")
    # Written first: then adaptive execution splits the key of a set that very many share.
    firsts = space.table(known.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")).filter("copies > 1"),
        "firsts")
    same = space.table(known.select("digest", "doc_id").join(firsts, "digest").filter(
        "doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).distinct(),
        "copies")
    copies = space.id_list(same.select(F.col("b").alias("id")).distinct(), "copy_ids", same.count())
    nodes = known.join(copies, F.col("doc_id") == F.col("id"), "left_anti").select(
        "doc_id", "n_shingles", "sign")
    placed = space.table(labels(nodes), "labels")
    found = space.table(neighbours(placed, percent), "neighbours")
    pairs = space.table(found.filter("a IS NOT NULL").groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("votes"), F.max("small").alias("small")), "pairs")
    dense = found.filter("dense IS NOT NULL").select(F.col("dense").alias("region")).distinct()

    best = best_of_each(pairs)
    tried = space.table(best.unionAll(pairs.filter("small").select("a", "b")).distinct(), "tried")
    ids = space.id_list(tried.select(F.col("a").alias("id")).unionAll(
        tried.select(F.col("b").alias("id"))).distinct(), "set_ids", 2 * tried.count())
    sets = space.table(full_sets(docs, ids, shingle), "sets")

    links = space.table(confirmed(tried, sets, percent), "links")
    comps = space.table(components(links, space), "components")
    members = crowded(placed, dense, comps, space)
    if not members.isEmpty():
        more = space.table(jaccard_join.links_between(docs, members, shingle, percent, space),
                           "crowd_links")
        if not more.isEmpty():
            # A component's own links are the fewest; what joins components is among the new ones.
            comps = space.table(components(comps.select(
                F.col("node").alias("a"), F.col("component").alias("b")).unionAll(more), space),
                "components")
    # Copies hang on their representative; only representatives have links.
    whole = same.join(comps.withColumnRenamed("node", "a"), "a", "left").select(
        F.col("b").alias("id"), F.coalesce("component", "a").alias("component"))
    return whole.unionAll(comps.withColumnRenamed("node", "id"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per document."""
    with Workspace(docs.sparkSession) as space, small_batches(docs.sparkSession):
        sketched = table(sketches(docs, shingle), "sketches")
        comps = table(near_components(docs, sketched, shingle, percent, space).groupBy("id").agg(
            F.min("component").alias("component")), "members")
    return (sketched.select("doc_id", "n_shingles")
            .join(comps.withColumnRenamed("id", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles",
                    F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE,
                         percent: int = PERCENT) -> DataFrame:
    """One document of each group, that with the smallest id; rows without id all stay."""
    kept = near_duplicates(docs, shingle, percent).filter("kept AND doc_id IS NOT NULL").select(
        "doc_id").distinct()
    rows = docs.select(row_of(docs).alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    stay = rows.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return unpacked(stay.unionByName(rows.filter("doc_id IS NULL")), docs.columns)
