"""Mixing sources to target weights by capped water-filling.

A source's target is its weight's share of the mix, clamped at ``max_epochs`` times its size; the
excess goes to the other sources by weight, again until none is above. The water level is found by
raising it until no further source clamps: each step is one aggregate over the table of sources.
Every document is then taken the whole number of times its source's rate says, and once more if
its seeded hash lies under the source's cut, which is placed so that the words taken come within
one document of the target.

Defined results: null text has size 0; a null source is a source of its own, last in order; sources
of size 0 get target 0; repeated rows share their document's fate; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from credence.llm.work import (
    Workspace,
    key_of,
    row_of,
    table,
    text_of,
    unpacked,
    words_of,
)

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
CELL_DIGITS = 3


def draw() -> Column:
    """Seeded hash of a document's id, as hex text that sorts like a uniform draw."""
    return F.md5(F.concat_ws(":", F.lit(SEED), F.col("doc_id").cast("string")).cast("binary"))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and draw of every document."""
    return docs.select("doc_id", F.col("source").alias("src"), key_of("source").alias("src_key"),
                       F.size(words_of(text_of())).cast("long").alias("size"),
                       draw().alias("draw"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(src_key, source_size, target): one row per source. Only scalars reach the driver.

    Ranking the sources by name is one window over the table of sources, not of documents.
    """
    rank = F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), rank % len(weights))
    sources = table(sizes.groupBy("src", "src_key").agg(F.sum("size").alias("source_size"))
                    .withColumn("weight", weight)
                    .withColumn("cap", max_epochs * F.col("source_size").cast("double")),
                    "sources")
    total, weight_sum = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level = share * (total or 0) / (weight_sum or 1.0)
    clamped = -1
    while True:
        above = F.col("weight") * F.lit(level) > F.col("cap")
        n, full, free = sources.agg(
            F.count_if(above), F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0))).first()
        if n == clamped or free == 0:
            break
        clamped, level = n, (share * total - full) / free if total else 0.0
    return sources.select("src_key", "source_size",
                          F.least(F.col("cap"), F.col("weight") * F.lit(level)).alias("target"))


def source_cuts(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(src_key, source_size, target, whole, cut).

    The cut is searched first among cells of the draw (sums of bounded number), then among the
    documents of the one cell it falls into, so no source is sorted as a whole.
    """
    cell = F.substring("draw", 1, CELL_DIGITS)
    whole = F.when(F.col("source_size") > 0,
                   F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = targets.withColumn("whole", whole).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size"))
    up_to = Window.partitionBy("src_key").orderBy("cell").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    cells = (sizes.groupBy("src_key", cell.alias("cell")).agg(F.sum("size").alias("cell_size"))
             .withColumn("upto", F.sum("cell_size").over(up_to)))
    edges = table(cells.join(plan, "src_key").filter("rest > 0 AND upto >= rest")
                  .groupBy("src_key").agg(F.min(F.struct("cell", "upto", "cell_size", "rest"))
                                          .alias("e"))
                  .select("src_key", F.col("e.cell").alias("cell"),
                          (F.col("e.rest") - F.col("e.upto") + F.col("e.cell_size"))
                          .alias("room")), "edges")
    within = Window.partitionBy("src_key").orderBy("draw")
    inside = (sizes.select("src_key", "draw", "size", cell.alias("cell"))
              .join(edges, ["src_key", "cell"])
              .withColumn("running", F.sum("size").over(within))
              .filter(F.col("running") - F.col("size") / 2 <= F.col("room"))
              .groupBy("src_key").agg(F.max("draw").alias("last")))
    return table(plan.join(edges.select("src_key", "cell"), "src_key", "left")
                 .join(inside, "src_key", "left")
                 .select("src_key", "source_size", "target", "whole",
                         F.coalesce("last", "cell", F.lit("")).alias("cut")), "cuts")


def copies() -> Column:
    """Times a document is taken, from its draw and its source's plan."""
    return F.col("whole") + (F.col("draw") <= F.col("cut")).cast("long")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE,
        max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per document with its source's target and the words the mix takes of it."""
    sizes = table(sized(docs), "sizes")
    cuts = source_cuts(sizes, source_targets(sizes, weights, share, max_epochs))
    return sizes.join(cuts, "src_key").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies()).alias("taken"),
        copies().alias("copies"))


def take_mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE,
             max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself: each document repeated as often as it is taken."""
    with Workspace(docs.sparkSession) as space:
        sizes = space.table(sized(docs), "sizes")
        cuts = source_cuts(sizes, source_targets(sizes, weights, share, max_epochs))
    rows = docs.select(row_of(docs).alias("row"), key_of("source").alias("src_key"),
                       draw().alias("draw")).join(cuts, "src_key")
    times = F.sequence(F.lit(1), copies().cast("int"))
    return unpacked(rows.filter(copies() > 0).select("row", F.explode(times)), docs.columns)


_CAPS = "2.0 * source_size"
ORACLE = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, md5('{SEED}' || coalesce(':' || doc_id, '')) AS draw,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE
               AS weight FROM d GROUP BY source),
t AS (SELECT {SHARE} * sum(source_size)::DOUBLE AS total, sum(weight) AS weights FROM s),
level(step, lam, n) AS (
  SELECT 0, total / weights, -1::BIGINT FROM t
  UNION ALL
  SELECT step + 1, (total - full_) / free, n2 FROM (
    SELECT l.step, l.n, t.total, count(*) FILTER (s.weight * l.lam > {_CAPS}) AS n2,
           coalesce(sum({_CAPS}) FILTER (s.weight * l.lam > {_CAPS}), 0) AS full_,
           coalesce(sum(s.weight) FILTER (s.weight * l.lam <= {_CAPS}), 0) AS free
    FROM level l, s, t GROUP BY l.step, l.lam, l.n, t.total) WHERE n2 <> n AND free > 0),
lam AS (SELECT lam FROM level ORDER BY step DESC LIMIT 1),
p AS (SELECT source, source_size, least({_CAPS}, weight * lam)::DOUBLE AS target FROM s, lam),
q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT
               AS whole FROM p),
r AS (SELECT *, target - whole * source_size AS rest FROM q),
k AS (SELECT source, draw, size,
             sum(size) OVER (PARTITION BY source, substr(draw, 1, {CELL_DIGITS}) ORDER BY draw)
               AS running FROM d),
c AS (SELECT source, cell, cell_size,
             sum(cell_size) OVER (PARTITION BY source ORDER BY cell) AS upto
      FROM (SELECT source, substr(draw, 1, {CELL_DIGITS}) AS cell, sum(size) AS cell_size
            FROM d GROUP BY 1, 2)),
e AS (SELECT c.source, min(cell) AS cell, arg_min(rest - upto + cell_size, cell) AS room
      FROM c JOIN r ON c.source IS NOT DISTINCT FROM r.source
      WHERE rest > 0 AND upto >= rest GROUP BY 1),
i AS (SELECT k.source, max(draw) AS last FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source
        AND substr(k.draw, 1, {CELL_DIGITS}) = e.cell
      WHERE running - size / 2 <= room GROUP BY 1)
SELECT d.doc_id, d.size, r.source_size, r.target,
       (d.size * (r.whole + (d.draw <= coalesce(i.last, e.cell, ''))::BIGINT))::BIGINT AS taken,
       (r.whole + (d.draw <= coalesce(i.last, e.cell, ''))::BIGINT)::BIGINT AS copies
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
LEFT JOIN e ON d.source IS NOT DISTINCT FROM e.source
LEFT JOIN i ON d.source IS NOT DISTINCT FROM i.source
"""
