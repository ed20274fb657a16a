"""Phrases whose words keep company, counted in HAT-tries.

Each task counts phrases in a shallow trie over word ids whose leaves are hash containers. A
container that grows too large bursts into one container per next word; when the trie outgrows its
budget, its largest subtrees leave whole, as sorted runs. A run is cut by a hash of the first words
into prefix partitions of bounded size, a packed row for each, and each partition's runs are merged.

A phrase is never more frequent than its parts. So words are counted first, then pairs of words that
are frequent enough, then longer phrases all of whose pairs are; what is known to be too rare does
not enter a trie. Before pairs and longer phrases enter tries, pairs and triples are counted by hash
in tables of a fixed size, whose sums are never below the truth. Tasks know all this as bit maps of a
fixed size. A bit set by another phrase lets a rare one be counted in vain, never the reverse; in
a corpus of many times the table's size more are.

Word ids are 64-bit hashes. All words are also counted as strings; where two words of a language
share an id, everything is counted again with another hash.

Defined results: null texts are empty; a null language is ``und``, an empty one its own; repeated
rows and ids count each time; empty tables, and languages without a frequent phrase, give no rows.
"""

from __future__ import annotations

import zlib
from itertools import count as counting
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from credence.llm import counters
from credence.llm.bitmaps import MAP_BITS, bit_map, in_map, opened, packed_map
from credence.llm.text_kernel import blocks, mixed, text_buffer, word_bounds, word_hashes
from credence.llm.work import Workspace, small_batches, table

LONGEST, LEAST, TOP = 5, 100, 2000
#: Counters of pairs or triples by hash: a byte each leaves a task, a bit each comes back.
COUNTERS = 1 << 24
#: Phrases a trie holds before subtrees leave it, a container before it bursts, and a run's piece.
TRIE_ENTRIES, CONTAINER_ENTRIES, RUN_ROWS = 1_500_000, 4_096, 500_000
#: Bytes of a prefix partition if no phrase of the corpus occurred twice, and words of a prefix.
PARTITION_BYTES, PREFIX = 32 << 20, 3
#: Different words a task counts before it hands them on.
WORD_ENTRIES = 400_000
#: Words on a path of the trie, the first one included.
TRIE_DEPTH = 2

_BREAKS = np.isin(np.arange(256), [ord(c) for c in ".,;:!?\n\x0b\x0c\r"])
_APART = _BREAKS | np.isin(np.arange(256), [0x20, 0x09])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)])
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def letters(seed: int) -> np.ndarray:
    """Hash values of the bytes, capital letters as small ones."""
    rng = np.random.default_rng([40961, seed])
    return (rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[_LOWER]


def groups(keys: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of the runs of equal keys."""
    edges = (np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()
    return list(zip([0, *edges], [*edges, len(keys)])) if len(keys) else []


def joined_rows(rows: list[np.ndarray]) -> np.ndarray:
    """Sorted rows of words with a count each, equal ones as one."""
    rows = np.concatenate(rows)  # a copy
    rows = rows[np.lexsort(rows.T[-2::-1])]
    at = np.flatnonzero(np.append(True, (rows[1:, :-1] != rows[:-1, :-1]).any(1)))
    counts = np.add.reduceat(rows[:, -1], at)
    rows = rows[at]
    rows[:, -1] = counts
    return rows


class Node:
    """A place in the trie: a container of what may follow, or nodes by next word once it burst.

    A container takes rows of words and a count as they come, and joins equal ones when it is full.
    Rows stay whole, so that a subtree leaves without putting phrases together again; at ``depth``
    so many words of all rows are equal.
    """

    __slots__ = ("held", "below", "size", "limit")

    def __init__(self):
        self.held, self.below, self.size, self.limit = [], None, 0, CONTAINER_ENTRIES

    def add(self, rows: np.ndarray, depth: int) -> int:
        """Takes sorted rows; returns how many entries more the node holds."""
        before = self.size
        if self.below is not None:
            self.size += self.deal(rows, depth)
            return self.size - before
        self.held.append(rows.copy())
        self.size += len(rows)
        if self.size > self.limit:
            self.held = [joined_rows(self.held)]
            self.size = len(self.held[0])
            self.limit = max(CONTAINER_ENTRIES, 2 * self.size)
            if self.size > CONTAINER_ENTRIES and depth < TRIE_DEPTH < rows.shape[1] - 1:
                (packed,), self.held, self.below = self.held, [], {}  # bursts
                self.size = self.deal(packed, depth)
        return self.size - before

    def deal(self, rows: np.ndarray, depth: int) -> int:
        """Hands rows to one node per next word."""
        more = 0
        for i, j in groups(rows[:, depth]):
            node = self.below.get(rows[i, depth])
            if node is None:
                node = self.below[rows[i, depth]] = Node()
            more += node.add(rows[i:j], depth + 1)
        return more

    def rows(self):
        """All rows here and below."""
        yield from self.held
        for node in (self.below or {}).values():
            yield from node.rows()


class HatTrie:
    """Counts of phrases, in subtrees by language, length and first word."""

    def __init__(self, entries: int = TRIE_ENTRIES):
        self.entries, self.size, self.trees = entries, 0, {}

    def add(self, lang: str, rows: np.ndarray) -> None:
        """Takes phrases of one length, words and a count a row; equal beginnings are neighbours."""
        for i, j in groups(rows[:, 0]):
            key = lang, rows.shape[1], rows[i, 0]
            tree = self.trees.get(key)
            if tree is None:
                tree = self.trees[key] = Node()
            self.size += tree.add(rows[i:j], 1)

    def leaving(self, all_: bool = False):
        """(lang, rows) runs of the largest subtrees, until half the budget is free."""
        if not all_ and self.size <= self.entries:
            return
        aim, keys, size = self.entries // 2, [], self.size
        for key in sorted(self.trees, key=lambda k: -self.trees[k].size):
            if size <= aim and not all_:
                break
            size -= self.trees[key].size
            keys.append(key)
        for (lang, _), same in groupby(sorted(keys), key=lambda k: k[:2]):
            run, rows = [], 0
            for key in same:
                tree = self.trees.pop(key)
                self.size -= tree.size
                run += tree.rows()
                rows += tree.size
                if rows > RUN_ROWS:
                    yield lang, joined_rows(run)
                    run, rows = [], 0
            if run:
                yield lang, joined_rows(run)


PACKED = "part int, lang string, k int, data binary"


def run_batch(lang: str, rows: np.ndarray, parts: int) -> pa.RecordBatch:
    """A run cut into prefix partitions: rows of words and a count, packed."""
    k = rows.shape[1] - 1
    prefix = bit_of(*(np.ascontiguousarray(rows[:, i]) for i in range(min(k, PREFIX))),
                    code=np.uint64(zlib.crc32(lang.encode())), bits=1 << 62)
    part = (prefix % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = groups(part[order])
    return pa.RecordBatch.from_arrays(
        [pa.array([int(part[order[i]]) for i, _ in cuts], pa.int32()),
         pa.array([lang] * len(cuts), pa.string()), pa.array([k] * len(cuts), pa.int32()),
         pa.array([rows[order[i:j]].tobytes() for i, j in cuts], pa.binary())],
        ["part", "lang", "k", "data"])


def phrase_batch(lang: str, rows: np.ndarray, longest: int) -> pa.RecordBatch:
    """Columns lang, k, w1 .. and f; words beyond the phrase's end are 0."""
    n, k = len(rows), rows.shape[1] - 1
    none = np.zeros(n, np.int64)
    columns = np.ascontiguousarray(rows.T).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * n, pa.string()), pa.array(np.full(n, k, np.int32)),
         *[pa.array(columns[i] if i < k else none) for i in range(longest)],
         pa.array(columns[k])],
        ["lang", "k", *word_columns(longest), "f"])


def word_columns(longest: int) -> list[str]:
    return [f"w{i + 1}" for i in range(longest)]


def run_schema(longest: int) -> str:
    return "lang string, k int, " + ", ".join(
        f"{w} long" for w in word_columns(longest)) + ", f long"


def texts(docs: DataFrame) -> DataFrame:
    """lang, a code of it, and text; other columns do not matter."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), F.xxhash64(lang).alias("code"),
                       F.coalesce("text", F.lit("")).alias("text"))


def by_language(batch: pa.RecordBatch):
    """(lang, code, texts) of a batch, one language at a time."""
    names = batch.column("lang").dictionary_encode()
    which = names.indices.to_numpy()
    for i, lang in enumerate(names.dictionary.to_pylist()):
        rows = pa.array(np.flatnonzero(which == i))
        code = batch.column("code")[rows[0].as_py()].as_py()
        yield lang, np.uint64(code % (1 << 64)), batch.column("text").take(rows)


def words_in(column: pa.Array):
    """(bytes, word starts, word ends, joined) per block.

    ``joined`` tells of each word whether the next one follows in the same piece.
    """
    data, offsets = text_buffer(column)
    for a, b in blocks(offsets):
        part = data[offsets[a]:offsets[b]]
        starts, ends, first = word_bounds(part, offsets[a:b + 1] - offsets[a], _APART)
        if not len(starts):
            continue
        piece = np.cumsum(_BREAKS[part], dtype=np.int32)[starts]
        joined = np.append(piece[1:] == piece[:-1], False)
        last = first[1:-1]
        joined[last[(last > 0) & (last < len(starts))] - 1] = False
        yield part, starts, ends, joined


def count_words(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, id, word, f) of all words."""
    first, second = letters(2 * seed), letters(2 * seed + 1)

    def rows(found):
        keys = list(found)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()),
             pa.array(np.array([k[1] for k in keys], np.uint64).view(np.int64)),
             pa.array([k[2].decode() for k in keys], pa.string()),
             pa.array(list(found.values()), pa.int64())], ["lang", "id", "word", "f"])

    def tally(batches):
        found = {}
        for batch in batches:
            for lang, _, column in by_language(batch):
                for part, starts, ends, _ in words_in(column):
                    ids = word_hashes(part, starts, ends, first)
                    other = word_hashes(part, starts, ends, second)
                    order = np.lexsort((other, ids))
                    new = np.append(True, (np.diff(ids[order]) != 0) | (np.diff(other[order]) != 0))
                    at = np.flatnonzero(new)
                    here = order[at]
                    for i, s, e, n in zip(ids[here].tolist(), starts[here].tolist(),
                                          ends[here].tolist(),
                                          np.diff(np.append(at, len(order))).tolist()):
                        key = (lang, i, part[s:e].tobytes().lower())
                        found[key] = found.get(key, 0) + n
                if len(found) > WORD_ENTRIES:
                    yield rows(found)
                    found = {}
        yield rows(found)

    return texts(docs).mapInArrow(tally, "lang string, id long, word string, f long").groupBy(
        "lang", "id", "word").agg(F.sum("f").alias("f"))


def bit_of(*words: np.ndarray, code: np.uint64, bits: int = MAP_BITS) -> np.ndarray:
    """Place of a word or several words in a map of so many bits."""
    h = words[0] ^ code
    for w in words[1:]:
        h = mixed(h * _PAIR + w)
    return mixed(h) & np.uint64(bits - 1)


def with_bits(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The place of each row's words in the map, as column ``bit``."""
    def places(batches):
        for batch in batches:
            words = [batch.column(c).to_numpy().view(np.uint64) for c in columns]
            code = batch.column("code").to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bit_of(*words, code=code).astype(np.int64))], ["bit"])

    return rows.select(F.xxhash64("lang").alias("code"), *columns).mapInArrow(places, "bit long")


def frequent_windows(ids: np.ndarray, joined: np.ndarray, code: np.uint64,
                     gates: dict[int, np.ndarray], longest: int):
    """(size, first words) of the windows, up to a size, that pass the maps of all their parts.

    ``joined`` words may share a window with the next one; ``gates`` are maps by size.
    """
    known = in_map(gates[1], bit_of(ids, code=code))
    here = np.flatnonzero(joined[:-1] & known[:-1] & known[1:])
    for k in range(2, longest + 1):
        if k in gates and len(here):
            places = bit_of(*(ids[here + i] for i in range(k)), code=code,
                            bits=8 * len(gates[k]))
            here = here[in_map(gates[k], places)]
        yield k, here
        # The next size takes two such windows that lie one word apart.
        here = here[:-1][here[1:] == here[:-1] + 1]


def distinct_windows(ids: np.ndarray, windows, sizes: range):
    """Rows of words and a count for the distinct windows of each size.

    Windows that begin alike are neighbours.
    """
    dense = np.unique(ids, return_inverse=True)[1].astype(np.uint64)
    run = dense.copy()  # number of the window that starts at a word
    for k, here in windows:
        if not len(here):
            return
        keys = run[here] << np.uint64(32) | dense[here + k - 1]
        _, at, number, many = np.unique(keys, return_index=True, return_inverse=True,
                                        return_counts=True)
        run[here] = number
        if k in sizes:
            yield np.column_stack([*(ids[here[at] + i] for i in range(k)), many.astype(np.uint64)])


def sketched(docs: DataFrame, size: int, seed: int, gates: dict[int, bytes],
             least: int) -> bytes:
    """A map of the windows of a size that may occur ``least`` times, from counters by hash."""
    values, top = letters(2 * seed), max(255, least)

    def tally(batches):
        counts = np.zeros(COUNTERS, np.uint32)
        maps = {k: opened(m) for k, m in gates.items()}
        for batch in batches:
            for _, code, column in by_language(batch):
                for part, starts, ends, joined in words_in(column):
                    ids = word_hashes(part, starts, ends, values)
                    for k, here in frequent_windows(ids, joined, code, maps, size):
                        if k == size and len(here):
                            np.add.at(counts, bit_of(*(ids[here + i] for i in range(k)),
                                                     code=code, bits=COUNTERS), 1)
        # Beyond what matters counts need not be told apart.
        yield counters.parts_of(np.minimum(counts, top).astype(np.min_scalar_type(top)))

    return packed_map(counters.added(
        texts(docs).mapInArrow(tally, counters.SCHEMA), np.min_scalar_type(top), COUNTERS,
        lambda c: np.packbits(c >= least, bitorder="little")))


def count_phrases(docs: DataFrame, sizes: range, seed: int, gates: dict[int, bytes],
                  parts: int, entries: int = TRIE_ENTRIES) -> DataFrame:
    """Sorted runs, cut, of the phrases of these sizes whose parts may all be frequent."""
    longest, values = sizes[-1], letters(2 * seed)

    def tally(batches):
        trie, maps = HatTrie(entries), {k: opened(m) for k, m in gates.items()}
        for batch in batches:
            for lang, code, column in by_language(batch):
                for part, starts, ends, joined in words_in(column):
                    ids = word_hashes(part, starts, ends, values)
                    windows = frequent_windows(ids, joined, code, maps, longest)
                    for found in distinct_windows(ids, windows, sizes):
                        trie.add(lang, found)
                    for run in trie.leaving():
                        yield run_batch(*run, parts)
        for run in trie.leaving(True):
            yield run_batch(*run, parts)

    return texts(docs).mapInArrow(tally, PACKED)


def merged(runs: DataFrame, longest: int, least: int) -> DataFrame:
    """Phrases that occur ``least`` times, from the runs of each prefix partition."""
    def phrases(held: dict):
        for (lang, k), data in held.items():
            rows = joined_rows([np.frombuffer(d, np.uint64).reshape(-1, k + 1) for d in data])
            yield phrase_batch(lang, rows[rows[:, -1] >= least], longest)

    def merge(batches):
        part, held = None, {}
        for batch in batches:
            for p, lang, k, data in zip(*(batch.column(c).to_pylist()
                                          for c in ("part", "lang", "k", "data"))):
                if p != part:
                    yield from phrases(held)
                    part, held = p, {}
                held.setdefault((lang, k), []).append(data)
        yield from phrases(held)

    return runs.repartition("part").sortWithinPartitions("part").mapInArrow(
        merge, run_schema(longest))


def counted_words(docs: DataFrame, space: Workspace) -> tuple[DataFrame, int]:
    """All words with ids that tell them apart, and the seed of those ids."""
    for seed in counting():
        words = space.table(count_words(docs, seed), "words")
        shared = words.groupBy("lang", "id").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
        if shared.isEmpty():
            return words, seed


def as_phrases(runs: DataFrame, longest: int) -> DataFrame:
    ids = F.slice(F.array(*word_columns(longest)), F.lit(1), F.col("k"))
    return runs.select("lang", ids.alias("ids"), "f")


def weakest_cuts(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, ids, a, l, r, n, score) of every phrase of two words or more.

    Each cut looks up its two parts, which are frequent phrases themselves.
    """
    candidates = phrases.filter(F.size("ids") > 1)
    cuts = candidates.withColumnRenamed("f", "a").withColumn(
        "cut", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)))
    cuts = cuts.withColumn("left", F.slice("ids", F.lit(1), F.col("cut"))).withColumn(
        "right", F.slice("ids", F.col("cut") + 1, F.size("ids") - F.col("cut")))

    def counts(part: str, name: str) -> DataFrame:
        return phrases.select("lang", F.col("ids").alias(part), F.col("f").alias(name))

    whole = {c: F.col(c).cast("decimal(19,0)") for c in "alrn"}
    thousand = F.lit(1000).cast("decimal(4,0)")
    rows = (cuts.join(counts("left", "l"), ["lang", "left"])
            .join(counts("right", "r"), ["lang", "right"]).join(totals, "lang"))
    rows = rows.withColumn("up", whole["a"] * whole["n"] * thousand).withColumn(
        "down", whole["l"] * whole["r"]).withColumn("score", F.expr("up div down"))
    return rows.groupBy("lang", "ids", "a", "n").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("cut")).select(
        "lang", "ids", "a", "cut.l", "cut.r", "n", "cut.score")


def inside_longer(phrases: DataFrame) -> DataFrame:
    """(lang, ids, longer): how often a phrase's most frequent extension by one word occurs.

    A longer phrase that holds it as often holds it through such an extension.
    """
    size = F.size("ids")
    parts = F.array(F.slice("ids", F.lit(1), size - 1), F.slice("ids", F.lit(2), size - 1))
    return phrases.filter(size > 2).select("lang", F.explode(parts).alias("ids"), "f").groupBy(
        "lang", "ids").agg(F.max("f").alias("longer"))


def spelled(rows: DataFrame, words: DataFrame) -> DataFrame:
    """The phrase of each row's ids."""
    places = rows.select("lang", "ids", F.posexplode("ids").alias("pos", "id"))
    names = places.join(words.select("lang", "id", "word"), ["lang", "id"]).groupBy(
        "lang", "ids").agg(F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("w"))
    return rows.join(names, ["lang", "ids"]).withColumn(
        "phrase", F.array_join("w.word", " ")).drop("w")


def leaders(rows: DataFrame, order: list[Column], how, top: int) -> DataFrame:
    """The first rows of each language; Spark keeps only such of each partition before it shuffles."""
    return rows.withColumn("rank", how().over(
        Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP,
                 entries: int = TRIE_ENTRIES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: each language's strongest phrases."""
    with Workspace(docs.sparkSession) as space, small_batches(docs.sparkSession):
        words, seed = counted_words(docs, space)
        totals = space.table(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
        total = totals.agg(F.sum("n")).first()[0] or 0
        parts = max(24, -(-24 * total // PARTITION_BYTES))
        often = words.filter(F.col("f") >= least)
        gates = {1: bit_map(with_bits(often, ["id"]))}
        may = sketched(docs, 2, seed, gates, least)
        pairs = space.table(merged(count_phrases(docs, range(2, 3), seed, gates | {2: may},
                                                 parts, entries), 2, least), "pairs")
        phrases = [often.select("lang", F.array("id").alias("ids"), "f"), as_phrases(pairs, 2)]
        if longest > 2:
            gates[2] = bit_map(with_bits(pairs, word_columns(2)))
            gates[3] = sketched(docs, 3, seed, gates, least)
            runs = count_phrases(docs, range(3, longest + 1), seed, gates, parts, entries)
            phrases.append(as_phrases(merged(runs, longest, least), longest))
        every = phrases[0]
        for more in phrases[1:]:
            every = every.unionAll(more)
        every = space.table(every, "phrases")
        inner = space.table(inside_longer(every), "inside")
        scored = weakest_cuts(every, totals).join(inner, ["lang", "ids"], "left").filter(
            F.coalesce(F.col("longer") < F.col("a"), F.lit(True))).drop("longer")
        best = [F.desc("score"), F.desc("a")]
        # Ties at the end stay until the words decide.
        first = space.table(leaders(scored, best, F.rank, top).drop("rank"), "leaders")
        named = leaders(spelled(first, often), [*best, F.asc("phrase")], F.row_number, top)
        return table(named.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"),
                     "collocations")


ORACLE = rf"""
WITH t AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')),
                                      '[^\x20\x09]+') AS words FROM t),
n AS (SELECT lang, sum(len(words))::BIGINT AS n FROM p GROUP BY lang),
w AS (SELECT lang, k, words, unnest(range(1, len(words) - k + 2)) AS i
      FROM p, (SELECT unnest(range(1, {LONGEST + 1})) AS k) WHERE len(words) >= k),
f AS (SELECT lang, k, words[i:i + k - 1] AS words, count(*) AS f FROM w
      GROUP BY ALL HAVING count(*) >= {LEAST}),
c AS (SELECT lang, words, k, f AS a, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
s AS (SELECT c.lang, c.words, c.k, a, cut, l.f AS l, r.f AS r, n.n,
             ((1000::HUGEINT * a * n.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
      FROM c JOIN n ON n.lang = c.lang
      JOIN f AS l ON l.lang = c.lang AND l.words = c.words[:cut]
      JOIN f AS r ON r.lang = c.lang AND r.words = c.words[cut + 1:]),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, cut) = 1),
x AS (SELECT f.lang, f.words[i:i + j - 1] AS words, max(f.f) AS longer
      FROM (SELECT *, unnest(range(1, k - j + 2)) AS i
            FROM (SELECT *, unnest(range(2, k)) AS j FROM f WHERE k > 2)) AS f GROUP BY 1, 2),
y AS (SELECT m.*, array_to_string(m.words, ' ') AS phrase FROM m
      LEFT JOIN x ON x.lang = m.lang AND x.words = m.words
      WHERE x.longer IS NULL OR 100 * x.longer < 100 * m.a),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
      FROM y)
SELECT lang, rank, phrase, a, l, r, n, score FROM z WHERE rank <= {TOP}
"""
