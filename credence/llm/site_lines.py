"""Line dedup by site-relative frequency.

Per host, the pages that contain a line are divided by the host's pages; a line above the ratio
is boilerplate there and is dropped from the host's pages.

Defined results: lines are compared without blanks at their ends; blank lines are neither counted
nor dropped; a null host is a host of its own; null text is the empty text; repeated rows are pages
of their own; an empty table stays empty. A line that stands on one page only is never dropped, so
that hosts of few pages keep the text of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credence.llm.work import key_of, let, table, text_of

MAX_RATIO = 0.1
MIN_PAGES = 2
_ENDS = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"


def line_key(line: Column) -> Column:
    """64-bit hash of the line without outer blanks; null for a blank line."""
    bare = F.regexp_replace(line, _ENDS, "")
    return F.when(bare != "", F.xxhash64(bare))


def boilerplate(docs: DataFrame, host: str = "source", max_ratio: float = MAX_RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """(host_key, bad): the hashes of each host's boilerplate lines.

    Both counts combine on the map side. A host has at most its mean lines per page divided by
    ``max_ratio`` such lines, so the array stays small whatever the host's size.
    """
    pages = docs.select(key_of(host).alias("host_key"), F.array_distinct(F.filter(
        F.transform(F.split(text_of(), "\n"), line_key), lambda k: k.isNotNull())).alias("keys"))
    totals = table(docs.groupBy(key_of(host).alias("host_key")).agg(
        F.count(F.lit(1)).alias("pages")), "host_pages")
    counts = (pages.select("host_key", F.explode("keys").alias("key"))
              .groupBy("host_key", "key").agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") >= min_pages))
    return table(counts.join(totals, "host_key")
                 .filter(F.col("n") > F.lit(max_ratio) * F.col("pages"))
                 .groupBy("host_key").agg(F.collect_set("key").alias("bad")), "boilerplate")


def drop_lines(docs: DataFrame, host: str = "source", max_ratio: float = MAX_RATIO,
               min_pages: int = MIN_PAGES) -> DataFrame:
    """doc_id, n_lines, n_dropped and the cleaned text of every document."""
    bad = boilerplate(docs, host, max_ratio, min_pages)
    lines = docs.select("doc_id", key_of(host).alias("host_key"), text_of().alias("text"))

    def cleaned(parts: Column) -> Column:
        kept = F.filter(parts, lambda x: F.col("bad").isNull()
                        | F.coalesce(~F.array_contains("bad", line_key(x)), F.lit(True)))
        return F.struct(
            F.size(F.filter(parts, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))).cast("long")
            .alias("n_lines"), (F.size(parts) - F.size(kept)).cast("long").alias("n_dropped"),
            F.array_join(kept, "\n").alias("text"))

    return (lines.join(bad, "host_key", "left")
            .select("doc_id", let(F.split(F.col("text"), "\n"), cleaned).alias("c"))
            .select("doc_id", "c.*"))


def line_digest(docs: DataFrame) -> DataFrame:
    """Per document the line counts, and length and SHA-256 of the cleaned text."""
    return drop_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("kept_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source,
                  string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, source, i, regexp_replace(lines[i], '{_ENDS}', '', 'g') AS bare, lines[i] AS line
      FROM (SELECT r, source, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)),
n AS (SELECT source, count(*) AS pages FROM d GROUP BY source),
bad AS (SELECT l.source, bare FROM l JOIN n ON l.source IS NOT DISTINCT FROM n.source
        WHERE bare <> '' GROUP BY l.source, bare, pages
        HAVING count(DISTINCT r) >= {MIN_PAGES} AND count(DISTINCT r) > {MAX_RATIO} * pages),
m AS (SELECT l.*, bad.bare IS NOT NULL AS drop_it FROM l
      LEFT JOIN bad ON l.source IS NOT DISTINCT FROM bad.source AND l.bare = bad.bare),
g AS (SELECT r, count(*) FILTER (bare <> '') AS n_lines, count(*) FILTER (drop_it) AS n_dropped,
             coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT drop_it), '') AS kept
      FROM m GROUP BY r)
SELECT doc_id, n_lines::BIGINT AS n_lines, n_dropped::BIGINT AS n_dropped,
       length(kept)::BIGINT AS kept_chars, sha256(kept) AS kept_sha256
FROM g JOIN d USING (r)
"""
