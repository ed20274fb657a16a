"""Jaccard self-join of word n-gram sets that skips by set relations.

Equal sets are one node. A node's shingles are ordered, rare ones first as far as a table of counters
of a fixed size can tell, and its first ones, the prefix, go to index lists. Two sets that are similar
enough share a shingle of their prefixes.

*Index skipping.* A list is ordered by set size and, within a size, by the shingle's position. A
position leaves only so much of a set to come, so of each block of equal sizes only the head can meet
a set, and blocks beyond the size bound none. Each set also has a few words of parities of its
shingles; where those of two sets differ in more bits than the sets may differ in shingles, the
pair is skipped as well.

*Answer skipping.* Each set's likeliest partner is verified on full sets first. Sets that are linked
so share their class, so pairs within a class need no more work. A set that is linked to a leader is
known by what it lacks and adds; its overlap with a third set is the leader's, less and plus the
overlaps of those few shingles.

Lists of up to ``REACH`` + 1 sets give all their pairs. In longer ones each set first meets its
``REACH`` neighbours; where several classes are left, sets outside the list's main class then meet
the whole list, in packed blocks. In up to ``ROUNDS`` rounds each of them tries only its nearest set
of another class, by the parities, so a large group becomes one class after a few tries a set. Pairs
of sets in one class are never formed there; pairs of classes that are left apart are, as far as the
skips leave them.

Defined results: null, empty and wordless texts have no shingles and are linked with nothing, also
where another row has their id; a text of fewer words than a shingle is one shingle of all its words;
a null id is linked with nothing; other rows with equal ids are one node; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
from itertools import count as counting

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credence.llm import counters
from credence.llm.components import components
from credence.llm.text_kernel import binary_array, give_back, shingle_sets
from credence.llm.work import Workspace, small_batches, table

SHINGLE, PERCENT = 3, 90
#: Counters that order shingles by rarity; a byte each goes to the tasks, whatever the corpus.
COUNTERS = 1 << 22
REACH = 4
#: Rounds in which sets of long lists try their nearest set of another class; one in which fewer
#: sets have any to try is the last.
ROUNDS, FEW = 4, 1000
#: Sets in a packed block of a long list, and members of a family verified in one row.
BLOCK, FAMILY = 256, 512
#: Words of 64 parities that a set has.
PARITIES = 8
MARKS = [f"m{i}" for i in range(PARITIES)]
ENTRY = np.dtype([("size", "i4"), ("pos", "i4"), ("node", "i8"), ("class", "i8"),
                  ("marks", "u8", (PARITIES,))])


def needed(x, y, percent: int):
    """Overlap that sets of these sizes need."""
    return (percent * (x + y) + 99 + percent) // (100 + percent)


def prefix_of(size, percent: int):
    """Length of the prefix of a set."""
    return size - (percent * size + 99) // 100 + 1


def node_of(shingles: np.ndarray, seed: int) -> tuple[int, int]:
    """Two independent 64-bit names of a set."""
    name = hashlib.blake2b(shingles.tobytes(), digest_size=16, salt=seed.to_bytes(8, "little"))
    a, b = np.frombuffer(name.digest(), np.int64)
    return int(a), int(b)


def parities(shingles: np.ndarray) -> np.ndarray:
    """For each value of some bits, whether an odd number of the shingles has it.

    Two sets' parities differ in at most as many bits as the sets differ in shingles.
    """
    odd = np.bincount((shingles >> np.uint64(40)).astype(np.int64) % (64 * PARITIES),
                      minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def ided(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def scanned(docs: DataFrame, shingle: int, seed: int) -> DataFrame:
    """A row per document with its set's size and names, and rows with parts of the counters."""
    def scan(batches):
        counts, seen = np.zeros(COUNTERS, np.uint32), set()
        for batch in batches:
            sizes, nodes, checks, marks = [], [], [], []
            for s in shingle_sets(batch.column("text"), shingle):
                node, check = node_of(s, seed) if len(s) else (None, None)
                marks.append(parities(s))
                sizes.append(len(s))
                nodes.append(node)
                checks.append(check)
                if node is not None and node not in seen:
                    seen.add(node)
                    np.add.at(counts, s & np.uint64(COUNTERS - 1), 1)
            n = batch.num_rows
            columns = np.ascontiguousarray(np.array(marks, np.int64).reshape(n, PARITIES).T)
            yield rows(batch.column("doc_id"), sizes, nodes, checks, [None] * n, [None] * n,
                       *columns)
            give_back()
        packed_counts = counters.parts_of(counts)
        none = [None] * packed_counts.num_rows
        yield rows(none, none, none, none, *packed_counts.columns, *[none] * PARITIES)

    def rows(*columns):
        kinds = [pa.int64()] * 4 + [pa.int32(), pa.binary()] + [pa.int64()] * PARITIES
        return pa.RecordBatch.from_arrays(
            [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)],
            ["doc_id", "n", "node", "other", "part", "counts", *MARKS])

    return ided(docs).mapInArrow(
        scan, "doc_id long, n long, node long, other long, part int, counts binary, "
        + ", ".join(f"{m} long" for m in MARKS))


def rarity(scan: DataFrame) -> np.ndarray:
    """A byte per counter, larger for shingles seen more often."""
    return counters.added(scan.filter("part IS NOT NULL"), np.uint32, COUNTERS, lambda c: np.minimum(
        255, 8 * np.log2(1.0 + c)).astype(np.uint8))


def index_entries(docs: DataFrame, shingle: int, percent: int, seed: int,
                  level: np.ndarray) -> DataFrame:
    """(token, size, pos, node) for the prefix of every set."""
    def index(batches):
        seen = set()
        for batch in batches:
            tokens, sizes, lengths, nodes = [np.zeros(0, np.uint64)], [], [], []
            for s in shingle_sets(batch.column("text"), shingle):
                if not len(s):
                    continue
                node, _ = node_of(s, seed)
                if node in seen:
                    continue
                seen.add(node)
                rank = level[s & np.uint64(COUNTERS - 1)].astype(np.uint64)
                # Stable over sorted shingles: the same order of shingles in every set.
                order = np.argsort(rank << np.uint64(56) | s >> np.uint64(8), kind="stable")
                tokens.append(s[order[:prefix_of(len(s), percent)]])
                sizes.append(len(s))
                lengths.append(len(tokens[-1]))
                nodes.append(node)
            lengths = np.array(lengths, np.int64)
            total = int(lengths.sum())
            starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(tokens).view(np.int64)),
                 pa.array(np.repeat(np.array(sizes, np.int32), lengths)),
                 pa.array((np.arange(total) - starts).astype(np.int32)),
                 pa.array(np.repeat(np.array(nodes, np.int64), lengths))],
                ["token", "size", "pos", "node"])
            give_back()

    return ided(docs).filter("doc_id IS NOT NULL").select("text").mapInArrow(
        index, "token long, size int, pos int, node long")


def may_link(size, pos, i, j, percent: int) -> np.ndarray:
    """Whether entries of one list can link, if theirs is the first shingle they share."""
    need = needed(size[i], size[j], percent)
    return np.minimum(size[i] - pos[i], size[j] - pos[j]) >= need


def walked(entries: DataFrame, percent: int, reach: int = REACH) -> DataFrame:
    """Pairs (a, b, na, nb, first) of near entries, and the entries of longer lists.

    ``first`` says that the shingle can be the first one the two share. A partition is read in
    order; of a list at most ``reach + 1`` entries are held.
    """
    def given(rows, long_, old):
        token, size, pos, node = rows
        pairs, first = [[np.zeros(0, np.int64)] for _ in range(4)], [np.zeros(0, bool)]
        for k in range(1, min(reach, len(token) - 1) + 1):
            i = np.arange(max(k, old), len(token))
            j = i - k
            ok = ((token[i] == token[j]) & (100 * np.minimum(size[i], size[j])
                                            >= percent * np.maximum(size[i], size[j])))
            i, j = i[ok], j[ok]
            first.append(may_link(size, pos, i, j, percent))
            a, b = np.where(node[i] < node[j], i, j), np.where(node[i] < node[j], j, i)
            for out, column in zip(pairs, (node[a], node[b], size[a], size[b])):
                out.append(column)
        pairs = [np.concatenate(p) for p in pairs]
        n, rest = len(pairs[0]), np.flatnonzero(long_[old:]) + old
        none = pa.nulls(n, pa.int64())
        more = pa.nulls(len(rest), pa.int64())
        both = [pa.concat_arrays([pa.array(p, pa.int64()), more]) for p in pairs]
        tail = [pa.concat_arrays([none, pa.array(x[rest], pa.int64())])
                for x in (token, size, pos, node)]
        first = pa.concat_arrays([pa.array(np.concatenate(first)), pa.nulls(len(rest), pa.bool_())])
        return pa.RecordBatch.from_arrays(
            [*both, first, *tail],
            ["a", "b", "na", "nb", "first", "token", "size", "pos", "node"])

    def walk(batches):
        held, old = [np.zeros(0, np.int64)] * 4, 0  # old: entries of a long list given before
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [np.concatenate((h, batch.column(c).to_numpy().astype(np.int64)))
                    for h, c in zip(held, ("token", "size", "pos", "node"))]
            token, node = rows[0], rows[3]
            # Tasks may have seen one set each; equal entries are neighbours.
            fresh = np.append(True, (token[1:] != token[:-1]) | (node[1:] != node[:-1]))
            rows = [x[fresh] for x in rows]
            run = np.cumsum(np.append(False, rows[0][1:] != rows[0][:-1]))
            sizes = np.bincount(run)
            if old:
                sizes[0] += reach + 1
            long_ = (sizes > reach + 1)[run]
            if long_[-1]:
                yield given(rows, long_, old)
                old = keep = min(reach, int((run == run[-1]).sum()))
            else:
                keep = int(sizes[-1])
                done = len(run) - keep
                if done > old:
                    yield given([x[:done] for x in rows], long_[:done], old)
                old = 0
            held = [x[len(x) - keep:] for x in rows]
        if len(held[0]) > old:
            yield given(held, np.zeros(len(held[0]), bool), old)

    keys = ["token", "size", "pos", "node"]
    return entries.repartition("token").sortWithinPartitions(*keys).mapInArrow(
        walk, "a long, b long, na long, nb long, first boolean, "
        "token long, size long, pos long, node long")


def may_differ_so(percent: int) -> Column:
    """Whether sets of sizes ``na`` and ``nb`` may link, by the parities of both."""
    need = F.expr(f"({percent} * (na + nb) + 99 + {percent}) div {100 + percent}")
    off = sum((F.bit_count(F.col(f"{m}a").bitwiseXOR(F.col(f"{m}b"))) for m in MARKS), F.lit(0))
    return off <= F.col("na") + F.col("nb") - 2 * need


def marked(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs with both sets' parities."""
    for side in "ab":
        pairs = pairs.join(nodes.select(F.col("node").alias(side), *[
            F.col(m).alias(m + side) for m in MARKS]), side)
    return pairs


def best_of_each(pairs: DataFrame) -> DataFrame:
    """Each set's partner of most shared shingles."""
    pick = F.struct("votes", "a", "b", "na", "nb").alias("pick")
    sides = pairs.select(F.col("a").alias("d"), pick).unionAll(
        pairs.select(F.col("b").alias("d"), pick))
    return sides.groupBy("d").agg(F.max("pick").alias("pick")).select(
        "pick.a", "pick.b", "pick.na", "pick.nb").distinct()


def full_sets(docs: DataFrame, ids: DataFrame, shingle: int, seed: int) -> DataFrame:
    """(node, shingles): the full set of each listed document."""
    def pack(batches):
        seen = set()
        for batch in batches:
            nodes, sets = [], []
            for s in shingle_sets(batch.column("text"), shingle):
                node = node_of(s, seed)[0]
                if len(s) and node not in seen:
                    seen.add(node)
                    nodes.append(node)
                    sets.append(s)
            ends = np.cumsum([0] + [8 * len(s) for s in sets])
            data = np.concatenate(sets).view(np.uint8) if sets else np.zeros(0, np.uint8)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), binary_array(data, ends)], ["node", "shingles"])
            give_back()

    return ided(docs).join(ids, "doc_id", "left_semi").select("text").mapInArrow(
        pack, "node long, shingles binary")


def as_set(value) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint64)


def shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which members of a set are in another, both sorted."""
    if not len(y):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return y[at] == x


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) with what only a and only b has, by full sets."""
    def check(batches):
        for batch in batches:
            keep, only_a, only_b = [], [], []
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
                x, y = as_set(x), as_set(y)
                both = shared(x, y)
                n = int(both.sum())
                if n >= needed(len(x), len(y), percent):
                    keep.append(i)
                    only_a.append(x[~both].tobytes())
                    only_b.append(y[~shared(y, x)].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b", "na", "nb")]
                + [pa.array(v, pa.binary()) for v in (only_a, only_b)],
                ["a", "b", "na", "nb", "only_a", "only_b"])
            give_back()

    return (pairs.select("a", "b", "na", "nb")
            .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
            .mapInArrow(check, "a long, b long, na long, nb long, only_a binary, only_b binary")
            .dropDuplicates(["a", "b"]))


def families(links: DataFrame, space: Workspace) -> DataFrame:
    """(x, lead, nx, lacks, adds, parts): sets known by their difference to a linked leader.

    A set follows its linked neighbour of most links, if that one follows none itself.
    """
    sides = links.select(F.col("a").alias("x"), F.col("b").alias("lead"), F.col("na").alias("nx"),
                         F.col("only_b").alias("lacks"), F.col("only_a").alias("adds")).unionAll(
        links.select(F.col("b").alias("x"), F.col("a").alias("lead"), F.col("nb").alias("nx"),
                     F.col("only_a").alias("lacks"), F.col("only_b").alias("adds")))
    degrees = sides.groupBy(F.col("x").alias("node")).agg(F.count(F.lit(1)).alias("degree"))
    wishes = (sides.select("x", "lead")
              .join(degrees.select(F.col("node").alias("x"), F.col("degree").alias("own")), "x")
              .join(degrees.select(F.col("node").alias("lead"), "degree"), "lead")
              .filter(F.struct("degree", "lead") > F.struct("own", "x"))
              .groupBy("x").agg(F.max(F.struct("degree", "lead")).alias("best"))
              .select("x", "best.lead"))
    wishes = space.table(wishes, "wishes")
    led = wishes.join(wishes.select(F.col("x").alias("lead")).distinct(), "lead", "left_anti")
    sizes = led.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / FAMILY).alias("parts"))
    return space.table(sides.join(led, ["x", "lead"]).join(sizes, "lead"), "followers")


def derived(asked: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b): each family's overlap with a third set is counted once and adjusted."""
    member = F.struct(F.col("a").alias("x"), F.coalesce("nx", "na").alias("n"), "lacks", "adds")
    grouped = asked.groupBy("lead", "b", F.pmod(F.xxhash64("a"), F.coalesce("parts", F.lit(1))))
    rows = grouped.agg(F.collect_list(member).alias("members")).select("lead", "b", "members")

    def check(batches):
        for batch in batches:
            a, b = [], []
            for members, other, x, y in zip(batch.column("members"), batch.column("b").to_pylist(),
                                            batch.column("x"), batch.column("y")):
                lead, third = as_set(x), as_set(y)
                both = int(shared(lead, third).sum())
                for m in members:
                    overlap = both
                    if m["lacks"].is_valid:
                        overlap += int(shared(as_set(m["adds"]), third).sum())
                        overlap -= int(shared(as_set(m["lacks"]), third).sum())
                    if overlap >= needed(m["n"].as_py(), len(third), percent):
                        a.append(m["x"].as_py())
                        b.append(other)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            give_back()

    return (rows.join(sets.select(F.col("node").alias("lead"), F.col("shingles").alias("x")), "lead")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
            .mapInArrow(check, "a long, b long").distinct())


def apart(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose sets are not known to be in one class."""
    a, b = (classes.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
            for c in "ab")
    return pairs.join(a, "a", "left").join(b, "b", "left").filter(
        F.coalesce("ca", "a") != F.coalesce("cb", "b")).select(*pairs.columns)


def packed(entries: DataFrame) -> DataFrame:
    """Blocks (token, low, high, data) of up to ``BLOCK`` entries of a list, in the lists' order."""
    def pack(batches):
        for batch in batches:
            token = batch.column("token").to_numpy()
            rows = np.empty(len(token), ENTRY)
            for name in ENTRY.names[:4]:
                rows[name] = batch.column(name).to_numpy()
            for i, name in enumerate(MARKS):
                rows["marks"][:, i] = batch.column(name).to_numpy().view(np.uint64)
            cuts = [0]
            ends = np.append(np.flatnonzero(token[1:] != token[:-1]) + 1, len(token))
            for end in ends.tolist() if len(token) else []:
                cuts += [*range(cuts[-1] + BLOCK, end, BLOCK), end]
            spans = list(zip(cuts, cuts[1:]))
            first = [i for i, _ in spans]
            yield pa.RecordBatch.from_arrays(
                [pa.array(token[first]), pa.array(rows["size"][first]),
                 pa.array(rows["size"][[j - 1 for _, j in spans]]),
                 pa.array([rows[i:j].tobytes() for i, j in spans], pa.binary())],
                ["token", "low", "high", "data"])

    keys = ["token", "size", "pos", "node"]
    return entries.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        *keys, "class", *MARKS).mapInArrow(pack, "token long, low int, high int, data binary")


def nearest(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Of each set asking (the first column) the row of least ``over``, then of smallest partner."""
    order = np.lexsort((columns[1], columns[4], columns[0]))
    asker = columns[0][order]
    return [c[order[np.append(True, asker[1:] != asker[:-1])[:len(order)]]] for c in columns]


def met(asking: DataFrame, lists: DataFrame, percent: int, all_pairs: bool) -> DataFrame:
    """(a, b, na, nb, over) of sets asking, a, and sets of another class, b.

    Once or more for each shared list; if not ``all_pairs``, only the nearest ones a batch has.
    ``over`` is the number of bits that differ beyond, or below, that of shingles that may. Blocks
    of equal size are met by their heads: entries whose position leaves enough to come.
    """
    def meet(batches):
        none = [np.zeros(0, np.int64)] * 5
        for batch in batches:
            best = none
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), ENTRY) for v in (x, y))
                out = [none]
                for s in np.unique(x["size"]).tolist():
                    mine = x[x["size"] == s]
                    for t in np.unique(y["size"]).tolist():
                        need = needed(s, t, percent)
                        if need > min(s, t):
                            continue
                        theirs = y[y["size"] == t]
                        ask = mine[:np.searchsorted(mine["pos"], s - need, "right")]
                        head = theirs[:np.searchsorted(theirs["pos"], t - need, "right")]
                        i, j = np.nonzero(ask["class"][:, None] != head["class"][None, :])
                        off = np.bitwise_count(ask["marks"][i] ^ head["marks"][j]).sum(
                            1, dtype=np.int64) - (s + t - 2 * need)
                        near = off <= 0
                        i, j, off = i[near], j[near], off[near]
                        out.append([ask["node"][i], head["node"][j], np.full(len(i), s),
                                    np.full(len(i), t), off])
                found = [np.concatenate(c) for c in zip(*out)]
                if all_pairs:
                    yield told(found)
                else:
                    best = nearest([np.concatenate(c) for c in zip(best, found)])
            if not all_pairs:
                yield told(best)
            give_back()

    def told(columns):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                          ["a", "b", "na", "nb", "over"])

    ask, all_ = (d.select("token", *[F.col(c).alias(c + k) for c in ("low", "high")],
                          F.col("data").alias(k)) for d, k in ((asking, "x"), (lists, "y")))
    near = (f"100 * highx >= {percent} * lowy AND 100 * highy >= {percent} * lowx")
    return ask.join(all_, "token").filter(near).select("token", "x", "y").mapInArrow(
        meet, "a long, b long, na long, nb long, over long")


def long_list_pairs(rest: DataFrame, nodes: DataFrame, classes: DataFrame, percent: int,
                    space: Workspace, all_pairs: bool = True) -> DataFrame:
    """(a, b, na, nb) of sets in different classes that longer lists hold, a < b.

    If not ``all_pairs``, of each set outside its list's main class only the nearest one.
    """
    members = space.table(rest.join(classes.select("node", F.col("component").alias("class")),
                                    "node", "left").withColumn("class", F.coalesce("class", "node")),
                          "members")
    mixed = members.groupBy("token", "class").agg(F.count(F.lit(1)).alias("k")).groupBy(
        "token").agg(F.max(F.struct("k", "class")).alias("most"),
                     F.count(F.lit(1)).alias("classes")).filter("classes > 1").select(
        "token", F.col("most.class").alias("main"))
    lists = space.table(members.join(space.table(mixed, "mixed"), "token").join(
        nodes.select("node", *MARKS), "node"), "lists")
    found = met(packed(lists.filter("class <> main")), packed(lists), percent, all_pairs)
    if not all_pairs:
        found = found.groupBy("a").agg(F.min(F.struct("over", "b", "na", "nb")).alias("best")).select(
            "a", "best.*")
    swap = F.col("a") > F.col("b")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                        F.when(swap, F.col("nb")).otherwise(F.col("na")).alias("na"),
                        F.when(swap, F.col("na")).otherwise(F.col("nb")).alias("nb"))


def sets_of(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, shingle: int, seed: int, name: str,
            space: Workspace) -> DataFrame:
    """The full sets of the nodes in pairs, each from its document of smallest id."""
    ends = pairs.select(F.explode(F.array(*[c for c in ("a", "b", "lead") if c in pairs.columns]))
                        .alias("node")).distinct()
    ids = space.id_list(nodes.select("node", F.col("rep").alias("doc_id")).join(
        ends, "node", "left_semi").select("doc_id").distinct(), name + "_ids", 3 * pairs.count())
    return space.table(full_sets(docs, ids, shingle, seed), name)


def linked(docs: DataFrame, nodes: DataFrame, entries: DataFrame, shingle: int, percent: int,
           seed: int, space: Workspace, known: DataFrame | None = None) -> DataFrame:
    """Links (a, b) between nodes that, with the ``known`` ones, join all classes.

    Known links go from a class's first node to its others.
    """
    found = space.table(walked(entries, percent), "walked")
    rest = found.filter("token IS NOT NULL").select("token", "size", "pos", "node")
    told = found.filter("a IS NOT NULL").groupBy("a", "b", "na", "nb").agg(
        F.count(F.lit(1)).alias("votes"), F.max("first").alias("first")).filter("first")
    pairs = space.table(marked(told, nodes).filter(may_differ_so(percent)).select(
        "a", "b", "na", "nb", "votes"), "pairs")

    first = pairs
    if known is not None:
        first = apart(pairs, known.select(F.col("b").alias("node"), F.col("a").alias("component")))
    tried = space.table(best_of_each(first), "tried")
    links = space.table(verified(tried, sets_of(tried, docs, nodes, shingle, seed, "sets", space),
                                 percent), "links")
    ends = links.select("a", "b")
    classes = space.table(components(ends if known is None else known.unionAll(ends), space),
                          "classes")

    many = not rest.isEmpty()
    for _ in range(ROUNDS if many else 0):
        near = space.table(long_list_pairs(rest, nodes, classes, percent, space, all_pairs=False)
                           .distinct().join(tried.select("a", "b"), ["a", "b"], "left_anti"), "near")
        tries = near.count()
        if not tries:
            break
        more = space.table(verified(near, sets_of(near, docs, nodes, shingle, seed, "near_sets",
                                                  space), percent), "near_links")
        tried, links = tried.unionByName(near), links.unionByName(more)
        ends = links.select("a", "b")
        classes = space.table(components(classes.select(
            F.col("node").alias("a"), F.col("component").alias("b")).unionAll(
            more.select("a", "b")), space), "classes")
        if tries < FEW:
            break

    others = apart(pairs.select("a", "b", "na", "nb"), classes)
    if many:
        others = others.unionByName(long_list_pairs(rest, nodes, classes, percent, space)).distinct()
    others = others.join(tried.select("a", "b"), ["a", "b"], "left_anti")
    others = space.table(others.join(families(links, space).withColumnRenamed("x", "a"), "a", "left")
                         .withColumn("lead", F.coalesce("lead", "a")), "others")
    if known is None:  # the classes' own links are the fewest
        ends = classes.select(F.col("node").alias("a"), F.col("component").alias("b")).filter("a <> b")
    if others.isEmpty():
        return ends
    more = sets_of(others, docs, nodes, shingle, seed, "more_sets", space)
    return ends.unionAll(space.table(derived(others, more, percent), "more_links"))


def classed(docs: DataFrame, scan: DataFrame, shingle: int, percent: int, seed: int,
            nodes: DataFrame, space: Workspace) -> DataFrame:
    """(node, component_id): the smallest id that is reachable from every node."""
    known = scan.filter("doc_id IS NOT NULL AND node IS NOT NULL").select("doc_id", "node")
    entries = index_entries(docs, shingle, percent, seed, rarity(scan))
    links = linked(docs, nodes, entries, shingle, percent, seed, space)
    twice = space.table(known.groupBy("doc_id").agg(
        F.min("node").alias("a"), F.max("node").alias("hi")).filter("a <> hi").drop("hi"), "twice")
    same = known.join(twice, "doc_id").filter("a <> node").select("a", F.col("node").alias("b"))
    classes = space.table(components(links.unionAll(same), space), "all_classes")
    placed = space.table(nodes.select("node", "rep").join(classes, "node", "left").withColumn(
        "component", F.coalesce("component", "node")), "placed")
    least = space.table(placed.groupBy("component").agg(F.min("rep").alias("component_id")), "least")
    return placed.join(least, "component").select("node", "component_id")


def told_apart(docs: DataFrame, shingle: int, write) -> tuple[DataFrame, DataFrame, int]:
    """The scan, its sets' names with their smallest ids, and the seed that tells all sets apart."""
    for seed in counting():
        scan = write(scanned(docs, shingle, seed), "scan")
        nodes = write(scan.filter("doc_id IS NOT NULL AND node IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("rep"), F.min("other").alias("lo"), F.max("other").alias("hi"),
            *[F.min(m).alias(m) for m in MARKS]), "nodes")
        if nodes.filter("lo <> hi").isEmpty():
            return scan, nodes.select("node", "rep", *MARKS), seed


def links_between(docs: DataFrame, members: DataFrame, shingle: int, percent: int,
                  space: Workspace) -> DataFrame:
    """Links (a, b) of ids that join the classes of ``members`` (id, class) as far as they link."""
    ids = space.id_list(members.select(F.col("id").alias("doc_id")).distinct(), "member_ids",
                        members.count())
    part = ided(docs).join(ids, "doc_id", "left_semi")
    scan, nodes, seed = told_apart(part, shingle, space.table)
    placed = space.table(scan.filter("node IS NOT NULL").select("doc_id", "node").join(
        members.withColumnRenamed("id", "doc_id"), "doc_id").select("node", "class").distinct(),
        "placed")
    firsts = space.table(placed.groupBy("class").agg(F.min("node").alias("a")), "class_firsts")
    known = space.table(placed.join(firsts, "class").filter("a <> node").select(
        "a", F.col("node").alias("b")), "known")
    entries = index_entries(part, shingle, percent, seed, rarity(scan))
    links = linked(part, nodes, entries, shingle, percent, seed, space, known)
    a, b = (nodes.select(F.col("node").alias(c), F.col("rep").alias(f"r{c}")) for c in "ab")
    return links.join(a, "a").join(b, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))


def jaccard_classes(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id, one row per document."""
    with Workspace(docs.sparkSession) as space, small_batches(docs.sparkSession):
        scan, nodes, seed = told_apart(docs, shingle, table)
        roots = table(classed(docs, scan, shingle, percent, seed, nodes, space), "roots")
    return (scan.filter("part IS NULL").join(roots, "node", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(),
                           F.coalesce("component_id", "doc_id")).alias("component_id")))
