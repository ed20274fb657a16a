"""Quality rules judged per document and per host.

Each rule's failures are counted by host. A host's failure rate is shrunk towards the mean of all
hosts by a beta prior whose strength is estimated from the hosts themselves (method of moments),
so a host with few documents is not condemned by one of them. Documents of a host whose shrunk
rate exceeds a rule's limit are rejected with it.

Defined results: null text has no words and fails the base rule; a null host is a host of its own;
an empty table gives an empty result; repeated rows count and are judged each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credence.llm.work import key_of, let, table, text_of, unpacked, words_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
HOST_LIMIT = 0.75
STRONGEST_PRIOR = 1e6

RULES = ("few_words", "repeats", "symbols", "dup_lines")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")


def repeat_words(words: Column) -> Column:
    """Words covered by three-word windows that occur twice or more.

    Windows are sorted by a 64-bit hash; equal neighbours are repeats. n log n, no shuffle.
    """
    def windows(w):
        return F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(
            F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))))

    def hash_at(s, k):
        return F.get(s, k).getField("h")

    def repeated(s):
        hits = F.filter(s, lambda x, k: F.coalesce(hash_at(s, k + 1) == x["h"], F.lit(False))
                        | F.coalesce(hash_at(s, k - 1) == x["h"], F.lit(False)))
        return F.sort_array(F.transform(hits, lambda x: x["i"]))

    def covered(p):
        widths = F.transform(p, lambda x, k: F.least(
            F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(widths, F.lit(0), lambda a, b: a + b).cast("long")

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(
        let(let(windows(words), repeated), covered))


def measures(text: Column) -> Column:
    """Struct of MEASURES for one text."""
    def of_words(w):
        return F.struct(F.size(w).cast("long").alias("n_words"),
                        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        repeat_words(w).alias("n_repeat_words"))

    def of_lines(lines):
        return F.struct(F.size(lines).cast("long").alias("n_lines"),
                        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")
                        .alias("n_dup_lines"))

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    symbols = F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))
    return F.struct(let(words_of(text), of_words).alias("words"),
                    let(lines, of_lines).alias("lines"),
                    symbols.cast("long").alias("n_symbols"))


def failures() -> dict[str, Column]:
    """Each rule as a condition on a row of measures."""
    return {
        "few_words": F.col("n_words") < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"),
        "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"),
    }


def host_verdicts(measured: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """(host_key, host_failed): one row per host. Only the prior's scalars reach the driver."""
    rules = failures()
    hosts = table(measured.groupBy("host_key").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(rules[r].cast("long")).alias(r) for r in RULES]), "hosts")
    rate = {r: F.col(r) / F.col("n") for r in RULES}
    moments = hosts.agg(*[F.avg(rate[r]).alias(f"{r}_mean") for r in RULES],
                        *[F.var_pop(rate[r]).alias(f"{r}_var") for r in RULES]).first()
    failed = F.lit(False)
    for r in RULES:
        mean, var = moments[f"{r}_mean"] or 0.0, moments[f"{r}_var"] or 0.0
        strength = STRONGEST_PRIOR if var == 0 else max(0.0, mean * (1 - mean) / var - 1)
        failed = failed | ((F.col(r) + mean * strength) / (F.col("n") + strength) > limit)
    return table(hosts.select("host_key", failed.alias("host_failed")), "host_verdicts")


def judge(docs: DataFrame, carry: list[str], host: str = "source",
          limit: float = HOST_LIMIT) -> DataFrame:
    """Struct ``row`` of the carried columns, the measures, base_failed, host_failed and kept.

    Texts are measured once; hosts are judged from the measures and joined back by host. The
    verdict table's size is known when the join is planned, so it is broadcast only if small, and
    otherwise a skewed host is split.
    """
    measured = table(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        key_of(host).alias("host_key"), measures(text_of()).alias("m")).select(
        "row", "host_key", "m.words.*", "m.lines.*", "m.n_symbols"), "measured")
    rules = failures()
    return (measured.join(host_verdicts(measured, limit), "host_key", "left")
            .withColumn("base_failed", rules["few_words"] | rules["repeats"])
            .withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed")))


def host_rules(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """One row of measures and verdicts per document."""
    return judge(docs, ["doc_id"], limit=limit).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "host_failed")


def keep_good(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """The documents kept, with their own columns."""
    return unpacked(judge(docs, docs.columns, limit=limit).filter("kept"), docs.columns)


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text
           FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)),
                         lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
        FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM win)
        WHERE c > 1),
cov AS (SELECT r, count(DISTINCT i + o) AS n
        FROM rep, (SELECT unnest([0, 1, 2]) AS o) GROUP BY r),
m AS (SELECT w.r, doc_id, source, len(words)::BIGINT AS n_words,
             length(array_to_string(words, ''))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT
               AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             len(lines) AS n_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN cov ON w.r = cov.r),
f AS (SELECT *, (n_words < {MIN_WORDS})::INT AS few_words,
             (100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)::INT AS repeats,
             (100 * n_symbols > {MAX_SYMBOL_PERCENT} * word_chars)::INT AS symbols,
             (100 * n_dup_lines > {MAX_DUP_LINE_PERCENT} * n_lines)::INT AS dup_lines FROM m),
h AS (SELECT source, count(*) AS n, sum(few_words) AS few_words, sum(repeats) AS repeats,
             sum(symbols) AS symbols, sum(dup_lines) AS dup_lines FROM f GROUP BY source),
p AS (SELECT {", ".join(f"avg({r} / n) AS {r}_m, CASE WHEN var_pop({r} / n) = 0 THEN {STRONGEST_PRIOR} ELSE greatest(0, avg({r} / n) * (1 - avg({r} / n)) / var_pop({r} / n) - 1) END AS {r}_s" for r in RULES)} FROM h),
v AS (SELECT source, {" OR ".join(f"(h.{r} + {r}_m * {r}_s) / (n + {r}_s) > {HOST_LIMIT}" for r in RULES)} AS host_failed FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       few_words + repeats > 0 AS base_failed,
       few_words + repeats = 0 AND NOT host_failed AS kept, host_failed
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""
