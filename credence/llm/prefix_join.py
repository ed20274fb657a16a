"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item's windows are runs of ``WINDOW`` words (a shorter item is one window). A window is
seen as its set of word shingles, ordered by rarity in the corpus. A text that holds the whole
window holds all its shingles, so the necessary prefix is one shingle: the rarest. Windows, shingles
and counts are tables; documents give the places of shingles that may be prefixes, each with the
words around it, and are joined to the windows on the prefix. A match fixes where the window would
lie, which must be inside those words (positional and length bounds); then all its words are
compared.

Which shingles matter is told to the tasks as bit maps of a fixed size, so neither the benchmark
nor its counts pass the driver. A document is known by its id and a hash of its text.

Defined results: null and wordless texts have no words and no hits; wordless items have no window;
an item without id counts for hits but not among the items; items with equal ids are one item;
repeated documents are judged each; empty tables give no hits or no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credence.llm.bitmaps import MAP_BITS, bit_map, in_map, opened
from credence.llm.text_kernel import (
    NOT_ALNUM,
    blocks,
    shingle_hashes,
    text_buffer,
    word_bounds,
    word_hashes,
)
from credence.llm.work import BROADCAST_IDS, Workspace, row_of, table, text_of, unpacked

WINDOW = 13
SHINGLE = 3
#: A document is contaminated when this percentage of its words is hit.
MIN_PERCENT = 5


def texts_of(column: pa.Array):
    """(first row, last row, data, word starts, word ends, word hashes, first words) per block."""
    data, offsets = text_buffer(column)
    for a, b in blocks(offsets):
        part = data[offsets[a]:offsets[b]]
        starts, ends, bounds = word_bounds(part, offsets[a:b + 1] - offsets[a], NOT_ALNUM)
        yield a, b, part, starts, ends, word_hashes(part, starts, ends), bounds


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a mark of the text: rows alike in both are judged alike."""
    text = text_of().cast("string")
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("mark"))


def item_windows(benchmark: DataFrame, window: int, shingle: int) -> DataFrame:
    """(item, win, n, size, grams): every window's words, their number and its shingles in order."""
    def cut(batches):
        for batch in batches:
            items, wins, counts, sizes, grams = [], [], [], [], []
            names = batch.column("item").to_pylist()
            for a, b, data, starts, ends, words, bounds in texts_of(batch.column("text")):
                lower = [data[s:e].tobytes().lower() for s, e in zip(starts, ends)]
                for row in range(b - a):
                    first, last = int(bounds[row]), int(bounds[row + 1])
                    n = min(window, last - first)
                    size = min(shingle, n)
                    own = shingle_hashes(words[first:last], size) if n else None
                    for i in range(last - first - n + 1 if n else 0):
                        items.append(names[a + row])
                        wins.append(b" ".join(lower[first + i:first + i + n]).decode())
                        counts.append(n)
                        sizes.append(size)
                        grams.append(own[i:i + n - size + 1].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(wins, pa.string()),
                 pa.array(counts, pa.int32()), pa.array(sizes, pa.int32()),
                 pa.array(grams, pa.list_(pa.int64()))], ["item", "win", "n", "size", "grams"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item"),
                             F.col("text").cast("string").alias("text")).distinct()
    return items.mapInArrow(cut, "item string, win string, n int, size int, grams array<long>")


def map_of(grams: DataFrame) -> bytes:
    return bit_map(grams.select(F.col("h").bitwiseAND(F.lit(MAP_BITS - 1)).alias("bit")))


def places(words: np.ndarray, size: int, marks: np.ndarray):
    """(first word, hash) of the shingles of a size that may be in the map."""
    h = shingle_hashes(words, size)
    at = np.flatnonzero(in_map(marks, h & np.uint64(MAP_BITS - 1)))
    return at, h[at]


def corpus_counts(docs: DataFrame, packed: bytes, sizes: list[int]) -> DataFrame:
    """(h, count) of the shingles in the map over all documents, summed in each task first."""
    def count(batches):
        totals: dict[int, int] = {}
        marks = opened(packed)
        for batch in batches:
            for *_, words, _ in texts_of(batch.column("text")):
                for size in sizes:
                    found, many = np.unique(places(words, size, marks)[1], return_counts=True)
                    for h, n in zip(found.view(np.int64).tolist(), many.tolist()):
                        totals[h] = totals.get(h, 0) + n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int64()), pa.array(list(totals.values()), pa.int64())],
            ["h", "count"])

    return docs.select("text").mapInArrow(count, "h long, count long").groupBy("h").agg(
        F.sum("count").alias("count"))


def seen_places(docs: DataFrame, packed: bytes, sizes: list[int], window: int) -> DataFrame:
    """A row per document with its words, and rows with places of shingles that may be prefixes.

    ``words`` are those that a window around the place can have; the place is word ``back`` of them
    and word ``at`` of the document.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, mark long, n_words long, h long, size int, at int, back int, "
              "words string")

    def look(batches):
        marks = opened(packed)
        for batch in batches:
            rows, found = [], []
            counts = np.zeros(batch.num_rows, np.int64)
            for a, b, data, starts, ends, words, bounds in texts_of(batch.column("text")):
                counts[a:b] = np.diff(bounds)
                for size in sizes:
                    at, hashes = places(words, size, marks)
                    own = np.searchsorted(bounds, at, "right") - 1
                    inside = at + size <= bounds[own + 1]
                    for p, h, doc in zip(at[inside].tolist(), hashes[inside].view(
                            np.int64).tolist(), own[inside].tolist()):
                        first, last = int(bounds[doc]), int(bounds[doc + 1])
                        begin = max(first, p - window + size)
                        end = min(last, p + window)
                        rows.append(a + doc)
                        found.append((h, size, p - first, p - begin, b" ".join(
                            data[s:e].tobytes().lower() for s, e in
                            zip(starts[begin:end], ends[begin:end])).decode()))
            n = batch.num_rows
            where = pa.array([*range(n), *rows], pa.int64())
            columns = list(zip(*found)) if found else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(where), batch.column("mark").take(where),
                 pa.array([*counts.tolist(), *[None] * len(found)], pa.int64()),
                 *[pa.array([None] * n + list(c), k) for c, k in zip(columns, kinds)]],
                [f.split()[0] for f in schema.split(", ")])

    return docs.select("doc_id", "mark", "text").mapInArrow(look, schema)


def found_in(hits: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, mark, runs, items): the hit runs of words and the items of each document with hits."""
    owners = items.filter("item IS NOT NULL").select("win", "item").distinct()
    run = F.struct("s", (F.col("s") + F.col("n")).alias("e"))
    runs = hits.select("doc_id", "mark", run.alias("run"),
                       F.lit(None).cast("string").alias("item")).distinct()
    named = hits.select("doc_id", "mark", "win").distinct().join(owners, "win").select(
        "doc_id", "mark", F.lit(None).cast(runs.schema["run"].dataType).alias("run"),
        "item").distinct()
    return runs.unionAll(named).groupBy("doc_id", "mark").agg(
        F.collect_list("run").alias("runs"), F.collect_list("item").alias("items"))


def judged(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
           shingle: int = SHINGLE) -> DataFrame:
    """doc_id, mark, n_words, n_hit and the sorted items found, one row per document."""
    texts = keyed(docs)
    with Workspace(docs.sparkSession) as space:
        items = space.table(item_windows(benchmark, window, shingle), "item_windows")
        windows = space.table(items.drop("item").dropDuplicates(["win"]), "windows")
        sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())
        grams = windows.select("win", "size", F.posexplode("grams").alias("place", "h"))
        counts = space.table(corpus_counts(texts, map_of(grams), sizes), "counts")
        # The prefix of a window is its rarest shingle; ties go to the smaller hash, then place.
        rarest = grams.join(counts, "h", "left").groupBy("win").agg(F.min(F.struct(
            F.coalesce("count", F.lit(0)).alias("count"), "h", "place", "size")).alias("p"))
        prefixes = space.table(rarest.join(windows.select("win", "n"), "win").select(
            "win", "n", "p.h", "p.place", "p.size"), "prefixes")
        seen = table(seen_places(texts, map_of(prefixes), sizes, window), "seen")
        own = F.slice("around", F.col("begin") + 1, F.col("n"))
        hits = (seen.filter("h IS NOT NULL").drop("n_words").join(prefixes, ["h", "size"])
                .withColumns({"around": F.split("words", " "),
                              "begin": F.col("back") - F.col("place")})
                .filter((F.col("begin") >= 0)
                        & (F.col("begin") + F.col("n") <= F.size("around")))
                .filter(F.array_join(own, " ") == F.col("win"))
                .select("doc_id", "mark", "win", (F.col("at") - F.col("place")).alias("s"), "n"))
        found = table(found_in(space.table(hits.distinct(), "hits"), items), "found")
    covered = F.aggregate(
        F.array_sort("runs"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to")),
        lambda acc, r: F.struct(
            (acc["n"] + F.greatest(r["e"] - F.greatest(r["s"], acc["to"]), F.lit(0)))
            .alias("n"), F.greatest(acc["to"], r["e"]).alias("to")), lambda acc: acc["n"])
    found = found.select(F.col("doc_id").alias("id"), F.col("mark").alias("of"),
                         covered.alias("hit"), F.array_sort("items").alias("named"))
    return (seen.filter("h IS NULL").select("doc_id", "mark", "n_words")
            .join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("of")),
                  "left")
            .select("doc_id", "mark", "n_words",
                    F.coalesce("hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("named", F.array().cast("array<string>")).alias("items")))


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= MIN_PERCENT * F.col("n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: its words, the hit ones, the items found and the verdict."""
    return judged(docs, benchmark, **options).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    bad = table(judged(docs, benchmark, **options).filter(contaminated()).select(
        F.col("doc_id").alias("id"), F.col("mark").alias("of")).distinct(), "contaminated")
    bad = F.broadcast(bad) if bad.count() <= BROADCAST_IDS else bad
    rows = docs.select(row_of(docs).alias("row"), "doc_id",
                       F.xxhash64(text_of().cast("string")).alias("mark"))
    stay = rows.join(bad, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("of")),
                     "left_anti")
    return unpacked(stay, docs.columns)


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', " \
         r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
b AS (SELECT item_id::VARCHAR AS item, words, least(len(words), {WINDOW}) AS n
      FROM (SELECT item_id, {_WORDS} AS words FROM benchmark) WHERE len(words) > 0),
bw AS (SELECT DISTINCT item, n, array_to_string(words[i:i + n - 1], ' ') AS win
       FROM (SELECT item, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM b)),
dw AS (SELECT r, i, n, array_to_string(words[i:i + n - 1], ' ') AS win
       FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS i
             FROM d, (SELECT DISTINCT n FROM b) WHERE len(words) >= n)),
o AS (SELECT r, i, dw.n, item FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
h AS (SELECT r, count(DISTINCT p) AS n_hit
      FROM (SELECT r, unnest(range(i, i + n)) AS p FROM o) GROUP BY r),
t AS (SELECT r, count(DISTINCT item) AS n_items,
             array_to_string(list_sort(list_distinct(list(item))), ',') AS items
      FROM o GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""
