import re
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from credence.operators import drift
from credence.session import settings
from credence.streaming import drift_stream as live


def frame(spark, kind=None, **columns):
    kinds = {k: kind or ("string" if any(isinstance(x, str) for x in v) else "double")
             for k, v in columns.items()}
    rows = list(zip(*[[x if isinstance(x, str) or x is None else float(x) for x in v]
                      for v in columns.values()]))
    return spark.createDataFrame(rows, ", ".join(f"{k} {t}" for k, t in kinds.items()))


def psi(spark, expected, actual):
    numeric = not any(isinstance(x, str) for x in expected)
    kind = "double" if numeric else "string"
    report = drift.psi_report(frame(spark, kind, x=expected), frame(spark, kind, x=actual),
                              ["x"] if numeric else [], [] if numeric else ["x"])
    row = report.first()
    return row.psi, row.status


def pandas_psi(expected, actual, buckets=10):
    edges = np.unique(np.quantile(expected, np.linspace(0, 1, buckets + 1)))
    edges[0], edges[-1] = -np.inf, np.inf

    def share(values):
        counts = pd.cut(pd.Series(values), edges).value_counts(sort=False)
        return (counts / len(values)).clip(lower=1e-6)

    e, a = share(expected), share(actual)
    return float(((a - e) * np.log(a / e)).sum())


def test_numeric_against_pandas(spark):
    rng = np.random.default_rng(42)
    base = rng.normal(650, 40, 1500)
    for other in (rng.normal(650, 40, 1500), rng.normal(600, 40, 900),
                  np.round(base[:700], -1)):
        assert psi(spark, base, other)[0] == pytest.approx(pandas_psi(base, other))
    assert psi(spark, base, rng.normal(650, 40, 1500))[1] == "stable"
    assert psi(spark, base, rng.normal(600, 40, 1500))[1] == "significant_shift"


def test_repeated_values_and_nulls(spark):
    base = [1, 2, 3, 4, 5, None] * 100
    assert psi(spark, base, base) == (0.0, "stable")
    rng = np.random.default_rng(3)
    a, b = rng.poisson(0.8, 800), rng.poisson(1.1, 800)
    assert psi(spark, a, b)[0] == pytest.approx(pandas_psi(a, b))


def test_flat_baseline_scores_zero(spark):
    assert psi(spark, [5] * 100, [5, 6, 7] * 30) == (0.0, "stable")


def test_empty_side(spark):
    assert psi(spark, [1, 2, 3], [None, None]) == (None, "insufficient_data")
    assert psi(spark, ["a", "b"], [None, None]) == (None, "insufficient_data")


def test_categorical(spark):
    flipped = psi(spark, ["A"] * 800 + ["B"] * 200, ["A"] * 200 + ["B"] * 800)
    assert flipped == (pytest.approx(2 * 0.6 * np.log(4)), "significant_shift")
    unseen, _ = psi(spark, ["A"] * 500 + ["B"] * 500, ["A"] * 400 + ["B"] * 400 + ["C"] * 200)
    expected = 2 * (0.4 - 0.5) * np.log(0.8) + (0.2 - 1e-6) * np.log(0.2 / 1e-6)
    assert unseen == pytest.approx(expected)


def test_classes(spark):
    values = frame(spark, psi=[0.05, 0.10, 0.15, 0.25, 0.30, None])
    got = [r[0] for r in values.select(drift.classify(F.col("psi"))).collect()]
    assert got == ["stable", "moderate_shift", "moderate_shift", "significant_shift",
                   "significant_shift", "insufficient_data"]


def test_report_order_and_summary(spark):
    rng = np.random.default_rng(3)
    base = frame(spark, a=rng.normal(0, 1, 500), b=rng.normal(0, 1, 500), c=["x", "y"] * 250)
    now = frame(spark, a=rng.normal(0, 1, 500), b=rng.normal(5, 1, 500), c=["x", "y"] * 250)
    report = drift.psi_report(base, now, ["a", "b"], ["c"])
    rows = report.collect()
    assert [r.feature for r in rows] == ["b", "a", "c"]
    assert [r.type for r in rows] == ["numeric", "numeric", "categorical"]
    summary = {r.status: (r.features, r.feature_list)
               for r in drift.status_summary(report).collect()}
    assert summary["significant_shift"] == (1, "b")
    again = drift.psi_report(base.repartition(17), now.repartition(1), ["a", "b"], ["c"])
    assert [(r.feature, round(r.psi, 12)) for r in again.collect()] == [
        (r.feature, round(r.psi, 12)) for r in rows]


def test_stream_equals_batch(spark, tmp_path):
    """Ten files whose rows are up to half a day out of order, one file per micro-batch."""
    rng = np.random.default_rng(11)
    n = 2000
    seconds = np.sort(rng.integers(0, 8 * 86400, n)) + rng.integers(0, 43200, n)
    times = pd.Timestamp("2024-03-01") + pd.to_timedelta(seconds, unit="s")
    rows = pd.DataFrame({"ts": times, "value": rng.normal(seconds / 86400, 2, n),
                         "kind": rng.choice(["a", "b", "c"], n)})
    incoming = str(tmp_path / "in")
    for i, part in enumerate(np.array_split(np.arange(n), 10)):
        spark.createDataFrame(rows.iloc[part]).coalesce(1).write.mode("append").parquet(
            f"{incoming}/part={i}")
    events = spark.read.parquet(incoming).drop("part")
    known = events.filter("ts < '2024-03-03'")
    baseline = live.Baseline.of(known, ["value"], ["kind"], str(tmp_path / "baseline"))
    stream = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
              .parquet(f"{incoming}/*"))
    output, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):  # the second run finds nothing new and must change nothing
        live.start_drift_stream(stream, baseline, output, state, once=True).awaitTermination()
    streamed = live.read_drift(spark, output, baseline)
    counts = live.window_counts(events, baseline, "ts", "1 day").drop("latest").cache()
    batch = live.score_windows(counts, baseline)

    def table(df):
        return sorted((r.window_start, r.feature, round(r.psi, 9), r.status)
                      for r in df.collect())

    assert table(streamed) == table(batch)
    assert len(table(streamed)) == 18
    last = events.agg(F.max("ts")).first()[0] - pd.Timedelta(days=1)
    assert all(r.final == (r.window_end <= last) for r in streamed.collect())
    # A batch that runs again overwrites its own folder.
    first = spark.read.parquet(f"{output}/batch=0")
    rows_again = first.collect()
    spark.createDataFrame(rows_again, first.schema).write.mode("overwrite").parquet(
        f"{output}/batch=0")
    assert table(live.read_drift(spark, output, baseline)) == table(batch)


def test_window_score_against_every_bin(spark, tmp_path):
    """The sum over absent bins gives what pairing each window with each baseline bin gives."""
    rng = np.random.default_rng(4)
    rows = pd.DataFrame({"ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(
        rng.integers(0, 6, 900), unit="D"), "kind": rng.choice(list("abcdefgh"), 900)})
    rows.loc[rows.ts.dt.day == 4, "kind"] = "new"
    events = spark.createDataFrame(rows)
    known = events.filter("ts < '2024-01-03'")
    baseline = live.Baseline.of(known, [], ["kind"], str(tmp_path / "baseline"))
    counts = live.window_counts(events, baseline, "ts", "1 day")
    scores = {r.window_start.day: r.psi for r in live.score_windows(counts, baseline).collect()}
    expected = rows[rows.ts < "2024-01-03"].kind.value_counts(normalize=True)
    for day, part in rows.groupby(rows.ts.dt.day):
        seen = part.kind.value_counts(normalize=True)
        bins = expected.index.union(seen.index)
        e, a = (x.reindex(bins, fill_value=0).clip(lower=drift.fixed.PSI_FLOOR)
                for x in (expected, seen))
        assert scores[day] == pytest.approx(((a - e) * np.log(a / e)).sum())


def profile(spark, rows, path, **options):
    return live.Baseline.of(rows, ["value"], ["kind"], str(path), **options)


@pytest.fixture
def population(spark):
    rng = np.random.default_rng(9)
    return spark.createDataFrame(pd.DataFrame({
        "value": rng.normal(100, 9, 500), "kind": rng.choice(["a", "b", None], 500)}))


def test_baselines_are_told_apart_by_their_rows(spark, population, tmp_path):
    """Same path, other rows: edges and counts both are of the rows given."""
    first = profile(spark, population, tmp_path)
    other = profile(spark, population.withColumn("value", F.col("value") * 100), tmp_path)
    assert first.version != other.version
    assert max(first.edges["value"]) < 200 < min(other.edges["value"])
    again = profile(spark, population.repartition(7), tmp_path)
    assert again.version == first.version and again.edges == first.edges
    assert sorted(again.counts.collect()) == sorted(first.counts.collect())
    assert profile(spark, population, tmp_path, buckets=4).version != first.version
    without = population.withColumn("kind", F.coalesce("kind", F.lit("")))
    assert profile(spark, without, tmp_path).version != first.version
    assert len(list(tmp_path.glob("*/profile/_SUCCESS"))) == 4


def test_unfinished_and_foreign_counts_are_not_used(spark, population, tmp_path):
    first = profile(spark, population, tmp_path)
    folder = tmp_path / first.version
    (folder / "profile" / "_SUCCESS").unlink()  # as if the driver had died before
    assert profile(spark, population, tmp_path).edges == first.edges
    spark.createDataFrame([("kind", "categorical", "a", 3)], first.counts.schema).write.mode(
        "overwrite").parquet(str(folder / "counts"))
    with pytest.raises(ValueError, match="not those of its profile"):
        profile(spark, population, tmp_path)


def test_stream_refuses_another_baseline(spark, population, tmp_path):
    rows = population.withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    places = str(tmp_path / "out"), str(tmp_path / "state")
    mine = profile(spark, population, tmp_path / "p")
    live.start_drift_stream(stream, mine, *places, once=True).awaitTermination()
    other = profile(spark, population.limit(400), tmp_path / "p")
    with pytest.raises(ValueError, match="holds counts by baseline"):
        live.start_drift_stream(stream, other, *places, once=True)


def batch_rows(spark, batch, days=5):
    """Counts of a batch: the window of its day, and one bin of an older window again."""
    first, day = datetime(2024, 1, 1), timedelta(days=1)
    rows = [(first + d * day, first + (d + 1) * day, "kind", "categorical", b, 10 * batch + d,
             first + d * day + timedelta(hours=batch % 24))
            for d, b in ((batch % days, "a"), (batch % days, f"b{batch % 3}"), (0, "a"))]
    return spark.createDataFrame(list(dict.fromkeys(rows)), live.COUNTS)


def test_snapshots_bound_the_folders_read(spark, tmp_path, monkeypatch):
    output, every, read = str(tmp_path), 4, []
    latest = {}
    whole = live._whole

    def seen(*given):
        read.append(len(found := whole(*given)))
        return found

    monkeypatch.setattr(live, "_whole", seen)
    for batch in range(21):
        rows = batch_rows(spark, batch)
        rows.write.mode("overwrite").parquet(f"{output}/batch={batch}")
        if (batch + 1) % every == 0:
            live.compact(spark, output, batch)
            if batch == 11:  # the batch runs again, its snapshot too
                rows.write.mode("overwrite").parquet(f"{output}/batch={batch}")
                live.compact(spark, output, batch)
        for r in rows.collect():
            latest[r.window_start, r.bin] = r.actual
    assert {(r.window_start, r.bin): r.actual
            for r in live.read_counts(spark, output).collect()} == latest
    assert max(read) <= 2 * every
    assert len(list(tmp_path.glob("snapshot=*"))) == 2
    # A snapshot that is not whole does not count.
    (tmp_path / "snapshot=19" / "_SUCCESS").unlink()
    assert {(r.window_start, r.bin): r.actual
            for r in live.read_counts(spark, output).collect()} == latest


def test_output_without_batches(spark, population, tmp_path):
    baseline = profile(spark, population, tmp_path / "p")
    assert live.read_drift(spark, str(tmp_path / "none"), baseline).collect() == []


def test_stream_compacts_while_it_runs(spark, tmp_path):
    rows = spark.range(60).select(
        (F.lit("2024-05-01").cast("timestamp") + F.make_dt_interval(hours=F.col("id"))).alias("ts"),
        F.concat(F.lit("k"), F.col("id") % 4).alias("kind"))
    for i in range(6):
        rows.filter(f"pmod(hash(ts), 6) = {i}").coalesce(1).write.parquet(
            f"{tmp_path}/in/part={i}")
    baseline = live.Baseline.of(rows, [], ["kind"], str(tmp_path / "p"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(
        f"{tmp_path}/in/*")
    output = str(tmp_path / "out")
    live.start_drift_stream(stream, baseline, output, str(tmp_path / "state"), late_by="9 days",
                            once=True, compact_every=2).awaitTermination()
    assert len(list((tmp_path / "out").glob("snapshot=*"))) == 2
    assert live.read_counts(spark, output).agg(F.sum("actual")).first()[0] == 60


def test_hot_window_is_dealt_to_many_tasks(spark):
    """A window that holds nearly all bins meets its total in parts, not in one task."""
    counts = spark.range(4000).select(
        F.lit("2024-01-01").cast("timestamp").alias("window_start"),
        F.lit("2024-01-02").cast("timestamp").alias("window_end"), F.lit("kind").alias("feature"),
        F.lit("categorical").alias("type"), F.concat(F.lit("b"), "id").alias("bin"),
        F.lit(1).cast("long").alias("actual"))
    expected = counts.select("feature", "type", "bin", F.col("actual").alias("expected"))
    baseline = live.Baseline({}, ("kind",), expected, "")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1",
                          "spark.sql.adaptive.enabled": "false",
                          "spark.sql.shuffle.partitions": "16"}):
        plan = live.score_windows(counts, baseline)
        assert plan.first().psi == 0
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"hashpartitioning\(window_start#\d+, window_end#\d+, feature#\d+, "
                         r"type#\d+, salt#\d+", text)
        salted = counts.withColumn("salt", F.pmod(F.xxhash64("bin"), F.lit(live.SALTS)))
        sizes = salted.repartition(16, *live.KEYS, "salt").groupBy(
            F.spark_partition_id()).count().collect()
        assert len(sizes) > 8 and max(r["count"] for r in sizes) < 1000


def test_wide_categories_do_not_meet_on_the_feature(spark):
    """Many categories: no sort-merge join on the feature, no window of rows in one task."""
    rows = spark.range(20000).select(F.concat(F.lit("c"), F.col("id")).alias("k"))
    text = drift.psi_report(rows, rows, [], ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text and text.count("Scan ") + text.count("Range (") <= 6


def test_batch_twin_reads_after_the_stream_ran(spark):
    """Both use one stored baseline; neither rewrites it under the other."""
    from credence.plans.registry import QUERIES
    sf = "/root/testdata/sf0.001"
    batch = QUERIES["psi_windowed"](spark, sf)
    stream = QUERIES["psi_stream"](spark, sf)
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect()))
