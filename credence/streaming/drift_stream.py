"""PSI of each time window of a live stream against a fixed baseline.

The stream is binned with the baseline's edges and counted per (window, feature, bin). Each batch
writes the counts it changed; a window's score always comes from its latest counts, so open windows
are reported too. ``final`` marks windows that the watermark has passed: no later row can change
them.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from credence.fixed_values import PSI_BUCKETS
from credence.operators.drift import binned, classify, inner_edges, psi_term
from credence.sources.staging import drop_folder, folder_names, path_exists

KEYS = ["window_start", "window_end", "feature", "type"]
COUNTS = ("window_start timestamp, window_end timestamp, feature string, type string, "
          "bin string, actual long, latest timestamp")
#: Batches between two snapshots of a stream's counts.
COMPACT_EVERY = 100
#: Parts a window's bins are dealt to where they meet the window's total.
SALTS = 32


@dataclass(frozen=True)
class Baseline:
    """Bin edges and per-bin counts of the population a stream is compared with."""

    edges: Mapping[str, list[float] | None]
    categorical: Sequence[str]
    counts: DataFrame
    version: str

    @classmethod
    def of(cls, rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
           path: str, buckets: int = PSI_BUCKETS) -> Baseline:
        """The profile of ``rows`` among those kept below ``path``, made if it is not there yet.

        A profile's folder bears a fingerprint of the rows and of what is profiled, and holds edges,
        counts and totals together. So other rows never meet edges or counts that are not theirs,
        and no profile that others may be reading is written again.
        """
        spark, columns = rows.sparkSession, [*numeric, *categorical]
        version = _fingerprint(rows, columns, [list(numeric), list(categorical), buckets])
        folder = f"{path}/{version}"
        if not path_exists(spark, f"{folder}/profile/_SUCCESS"):
            edges = inner_edges(rows, numeric, buckets)
            binned(rows, edges, categorical).groupBy("feature", "type", "bin").agg(
                F.count(F.lit(1)).alias("expected")).write.mode("overwrite").parquet(
                f"{folder}/counts")
            facts = {"version": version, "edges": edges, "categorical": list(categorical),
                     "rows": _total(spark.read.parquet(f"{folder}/counts"))}
            # Last, so that a profile with this part is whole.
            spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.mode(
                "overwrite").text(f"{folder}/profile")
        return cls.load(spark, folder)

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Baseline:
        """A stored profile; its counts must be the ones it was stored with."""
        facts = json.loads(spark.read.text(f"{folder}/profile").first().value)
        counts = spark.read.parquet(f"{folder}/counts")
        if _total(counts) != facts["rows"]:
            raise ValueError(f"the counts at {folder} are not those of its profile")
        return cls(facts["edges"], tuple(facts["categorical"]), counts, facts["version"])


def _total(counts: DataFrame) -> int:
    return counts.agg(F.sum("expected")).first()[0] or 0


def _fingerprint(rows: DataFrame, columns: list[str], facts: list) -> str:
    """Changes with the rows, whatever their order, and with ``facts``."""
    mark = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in columns])
    found = rows.select(mark.alias("mark")).agg(
        F.count(F.lit(1)), F.sum(F.col("mark").cast("decimal(38,0)")), F.bit_xor("mark")).first()
    return hashlib.sha256(json.dumps([*map(str, found), facts]).encode()).hexdigest()[:24]


def window_counts(rows: DataFrame, baseline: Baseline, time: str, width: str) -> DataFrame:
    """(window, feature, type, bin, actual, latest time) of a batch or stream."""
    long = binned(rows, baseline.edges, baseline.categorical, [time])
    counts = long.groupBy(F.window(time, width), "feature", "type", "bin").agg(
        F.count(F.lit(1)).alias("actual"), F.max(time).alias("latest"))
    return counts.select(F.col("window.start").alias("window_start"),
                         F.col("window.end").alias("window_end"),
                         "feature", "type", "bin", "actual", "latest")


def score_windows(counts: DataFrame, baseline: Baseline) -> DataFrame:
    """PSI per window and feature from window counts.

    Baseline bins that a window never saw count too. Their terms are the same for every window, so
    they are summed once per feature; a window adds, for the bins it has, the difference between
    their terms and the ones already in that sum. Windows never meet the whole baseline. A window
    with very many bins is dealt to ``SALTS`` tasks where its bins meet their total. Terms are summed
    as decimals, so the sums are the same in any order and equal ones cancel.
    """
    def exact(term):
        return term.cast("decimal(30,18)")

    own = ["feature", "type"]
    totals = baseline.counts.groupBy(*own).agg(F.sum("expected").alias("expected_total"))
    shares = baseline.counts.join(F.broadcast(totals), own).withColumn(
        "absent", psi_term(F.col("expected") / F.col("expected_total"), F.lit(0.0)))
    profile = shares.groupBy(*own).agg(F.first("expected_total").alias("expected_total"),
                                       F.sum(exact(F.col("absent"))).alias("all_absent"))
    window_totals = counts.groupBy(*KEYS).agg(F.sum("actual").alias("actual_total")).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = counts.withColumn("salt", F.pmod(F.xxhash64("bin"), F.lit(SALTS)).cast("int"))
    share = F.coalesce(F.col("expected"), F.lit(0)) / F.col("expected_total")
    gain = (exact(psi_term(share, F.col("actual") / F.col("actual_total")))
            - exact(F.coalesce("absent", F.lit(0.0))))
    return (salted.join(window_totals, [*KEYS, "salt"])
            .join(shares.select(*own, "bin", "expected", "absent"), [*own, "bin"], "left")
            .join(F.broadcast(profile), own, "left")
            .groupBy(*KEYS).agg(
                (F.sum(gain) + F.first("all_absent")).cast("double").alias("psi"))
            .withColumn("status", classify(F.col("psi"))))


def start_drift_stream(stream: DataFrame, baseline: Baseline, output: str, checkpoint: str,
                       time: str = "ts", width: str = "1 day", late_by: str = "1 day",
                       once: bool = False, compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Writes the counts each batch changed under ``output``.

    A batch overwrites its own folder, so a batch replayed after a failure leaves no duplicates.
    Every ``compact_every`` batches a snapshot takes their place. An output holds bins of one
    baseline: another one is refused.
    """
    spark, pinned = stream.sparkSession, f"{output}/baseline"
    if not path_exists(spark, f"{pinned}/_SUCCESS"):
        spark.createDataFrame([(baseline.version,)], "value string").coalesce(1).write.mode(
            "overwrite").text(pinned)
    version = spark.read.text(pinned).first().value
    if version != baseline.version:
        raise ValueError(f"{output} holds counts by baseline {version}, not {baseline.version}")
    counts = window_counts(stream.withWatermark(time, late_by), baseline, time, width)

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{output}/batch={batch}")
        if (batch + 1) % compact_every == 0:
            compact(spark, output, batch)

    writer = counts.writeStream.outputMode("update").foreachBatch(write).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _whole(spark: SparkSession, output: str, kind: str) -> list[int]:
    """Numbers of the completely written folders of a kind, in order."""
    numbers = [int(name.partition("=")[2]) for name in folder_names(spark, output)
               if name.startswith(f"{kind}=")]
    return sorted(n for n in numbers if path_exists(spark, f"{output}/{kind}={n}/_SUCCESS"))


def read_counts(spark: SparkSession, output: str, before: int | None = None) -> DataFrame:
    """The latest counts of every window: those of the last snapshot and of the batches since.

    ``before`` leaves out snapshots from that batch on. An output without batches has no rows.
    """
    covered = [n for n in _whole(spark, output, "snapshot") if before is None or n < before]
    since = [n for n in _whole(spark, output, "batch") if not covered or n > covered[-1]]
    rows = spark.createDataFrame([], COUNTS + ", batch long")
    if covered:
        rows = rows.unionAll(spark.read.schema(COUNTS).parquet(
            f"{output}/snapshot={covered[-1]}").withColumn("batch", F.lit(covered[-1])))
    if since:
        rows = rows.unionAll(spark.read.schema(COUNTS + ", batch long").option(
            "basePath", output).parquet(*[f"{output}/batch={n}" for n in since]))
    return rows.groupBy(*KEYS, "bin").agg(
        F.max_by("actual", "batch").alias("actual"), F.max("latest").alias("latest"))


def compact(spark: SparkSession, output: str, batch: int) -> None:
    """Writes the latest counts up to ``batch`` as a snapshot and drops what the last one covers.

    A snapshot counts once it is whole. Batches it covers stay until the next one, so who reads the
    older snapshot, or replays ``batch``, still finds them.
    """
    read_counts(spark, output, before=batch).write.mode("overwrite").parquet(
        f"{output}/snapshot={batch}")
    older = [n for n in _whole(spark, output, "snapshot") if n < batch]
    for n in older[:-1]:
        drop_folder(spark, f"{output}/snapshot={n}")
    for n in _whole(spark, output, "batch"):
        if older and n <= older[-1]:
            drop_folder(spark, f"{output}/batch={n}")


def read_drift(spark: SparkSession, output: str, baseline: Baseline,
               late_by: str = "1 day") -> DataFrame:
    """The score of every window so far, and whether it is final."""
    counts = read_counts(spark, output)
    latest = counts.agg(F.max("latest")).first()[0]
    closed = F.lit(latest).cast("timestamp") - F.expr(f"INTERVAL {late_by}")
    return score_windows(counts.drop("latest"), baseline).withColumn(
        "final", F.coalesce(F.col("window_end") <= closed, F.lit(False)))
