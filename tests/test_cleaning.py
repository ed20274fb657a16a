import contextlib
import datetime
import functools
import gzip
import time
import uuid

import pandas as pd
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credence.fixed_values import NA_TOKENS
from credence.functions import parsing
from credence.operators import cleaning
from credence.plans import ingestion, registry
from credence.plans import loans as tables
from credence.plans.ingestion import run_ingestion, write_demo_sample
from credence.session import settings, work_folder
from credence.sources.csv_loans import IngestionError, load_raw
from credence.sources.headers import files_by_header
from credence.sources.loan_store import load_loans, read_loans, write_loans
from credence.sources.run_log import read_log
from credence.sources.staging import (
    StagedTables,
    WorkTables,
    drop_files,
    folder_names,
    path_exists,
    stage_path,
    staged,
    write_parts,
)


def parsed(spark, expression, values, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


def test_term(spark):
    assert parsed(spark, parsing.first_number, [" 36 months", " 60 months", "none", None]) == [
        36.0, 60.0, None, None]


def test_percent_text_and_number(spark):
    assert parsed(spark, parsing.percent_fraction, ["13.56%", " 9.00% ", "x", None]) == [
        pytest.approx(0.1356), pytest.approx(0.09), None, None]
    assert parsed(spark, parsing.percent_fraction, [13.56], "double") == [pytest.approx(0.1356)]


def test_text_that_reads_as_not_a_number_is_missing(spark):
    texts = ["nan%", "NaN %", " nan ", "NaN", "7%"]
    assert parsed(spark, parsing.percent_fraction, texts) == [None] * 4 + [pytest.approx(0.07)]
    assert parsed(spark, parsing.number, ["nan", "NaN", "1.5"]) == [None, None, 1.5]


def test_employment_years(spark):
    texts = ["10+ years", "< 1 year", "5 years", "n/a", "", "unknown", None]
    assert parsed(spark, parsing.employment_years, texts) == [10, 0, 5, None, None, None, None]


def test_month_text(spark):
    texts = ["Jan-2018", "DEC-1999", "Foo-2018", "Jan-18", "an -2018", "2018-01", "", None]
    dates = parsed(spark, parsing.month_date, texts)
    assert [d and d.isoformat() for d in dates] == ["2018-01-01", "1999-12-01", *[None] * 6]


def test_only_listed_tokens_are_missing(spark):
    values = [*NA_TOKENS, "NONE", "none", " n/a"]
    kept = parsed(spark, parsing.blank_missing, values)
    assert kept == [None] * len(NA_TOKENS) + ["NONE", "none", " n/a"]


def test_missing_file(spark, tmp_path):
    with pytest.raises(IngestionError, match="not found"):
        load_raw(spark, str(tmp_path / "absent.csv"))


def test_several_files_are_matched_by_header(spark, raw_csv, tmp_path):
    frame = pd.read_csv(raw_csv, dtype=str, keep_default_na=False)
    folder = tmp_path / "parts"
    folder.mkdir()
    frame.iloc[:6].to_csv(folder / "a.csv", index=False)
    frame.iloc[6:, ::-1].to_csv(folder / "b.csv", index=False)
    whole = load_raw(spark, raw_csv)
    for pattern in (f"{folder}/*.csv", f"{folder}/[ab].csv"):
        assert load_raw(spark, pattern).select(whole.columns).exceptAll(whole).isEmpty()
        assert load_raw(spark, pattern).count() == whole.count()


def test_folders_of_mixed_headers_are_read_by_name(spark, raw_csv, tmp_path):
    """A folder, a glob and the one file give the same rows, whatever files and names hold."""
    frame = pd.read_csv(raw_csv, dtype=str, keep_default_na=False)
    folder = tmp_path / "years" / "2014 [a]"
    folder.mkdir(parents=True)
    frame.iloc[:3].to_csv(folder / "x, {1}.csv", index=False)
    frame.iloc[3:5, ::-1].to_csv(folder / "y 100%.csv", index=False)
    frame.iloc[5:9].to_csv(tmp_path / "years" / "quoted.csv", index=False, quoting=1)
    (tmp_path / "years" / "late.csv").write_text(
        "\n \n" + frame.iloc[9:].to_csv(index=False))
    (tmp_path / "years" / "empty.csv").write_text("")
    (tmp_path / "years" / "_ignored.csv").write_text("no,loans")
    frame.iloc[:0].to_csv(tmp_path / "years" / "header_only.csv", index=False)
    whole = load_raw(spark, raw_csv)
    for place in ("years", "yea*", "years/*"):
        rows = load_raw(spark, str(tmp_path / place)).select(whole.columns)
        assert rows.exceptAll(whole).isEmpty() and rows.count() == whole.count()


def test_headers_of_many_files_cost_one_job(spark, tmp_path):
    for i in range(45):
        (tmp_path / f"{i:03}.csv").write_text(f"a,{'b' if i % 3 else 'c'}\n" + "1,2\n" * 2000)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        found = files_by_header(spark, [str(tmp_path)])
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert sorted(map(len, found.values())) == [15, 30] and set(found) == {"a,b", "a,c"}
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("headers")]
    reading = [j for j in jobs if sum(tracker.getStageInfo(s).numTasks for s in j.stageIds) > 0]
    assert len(reading) <= 2  # beyond 32 paths Spark lists them in a job of its own


def test_headers_read_no_more_than_the_beginning(spark, tmp_path):
    """No task goes through a file for its header; packed files have one as well."""
    (tmp_path / "a.csv").write_text("\ufeff\n \na,b\n" + "1,2\n" * 1_000_000)
    with gzip.open(tmp_path / "b.csv.gz", "wt") as packed:
        packed.write("a,b\r\n" + "1,2\r\n" * 1000)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("beginnings", "beginnings")
    try:
        found = files_by_header(spark, [str(tmp_path)])
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert list(found) == ["a,b"] and len(found["a,b"]) == 2
    assert not tracker.getJobIdsForGroup("beginnings")


def test_export_without_any_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    with pytest.raises(IngestionError, match="no header"):
        load_raw(spark, str(tmp_path))


def test_headers_with_line_breaks(spark, raw_csv, tmp_path):
    """Headers that differ after their first line only are different headers."""
    frame = pd.read_csv(raw_csv, dtype=str, keep_default_na=False)
    frame.insert(0, "two\nlines", "x")
    folder = tmp_path / "wide"
    folder.mkdir()
    frame.to_csv(folder / "a.csv", index=False)
    frame[[frame.columns[0], *frame.columns[:0:-1]]].to_csv(folder / "b.csv", index=False)
    rows = load_raw(spark, str(folder), multiline=True)
    assert rows.count() == 20 and rows.dropDuplicates().count() == 10


def test_quoted_line_breaks(spark, raw_csv, tmp_path):
    frame = pd.read_csv(raw_csv, dtype=str, keep_default_na=False)
    frame["note"] = "line one\nline two"
    path = str(tmp_path / "notes.csv")
    frame.to_csv(path, index=False)
    rows = load_raw(spark, path, multiline=True)
    assert rows.count() == len(frame)
    assert {r.note for r in rows.collect()} == {"line one\nline two"}


def test_missing_columns(spark, tmp_path):
    path = tmp_path / "bad.csv"
    pd.DataFrame({"grade": ["C"]}).to_csv(path, index=False)
    with pytest.raises(IngestionError, match="missing required columns.*loan_amnt"):
        load_raw(spark, str(path))


def test_ingestion_keeps_quoted_line_breaks(spark, raw_csv, tmp_path):
    frame = pd.read_csv(raw_csv, dtype=str, keep_default_na=False)
    frame["note"] = "line one\n7200, 36 months"
    path = str(tmp_path / "notes.csv")
    frame.to_csv(path, index=False)
    loans = run_ingestion(spark, path, str(tmp_path / "clean"), str(tmp_path / "log"), True)
    assert loans.count() == 4 and {r.note for r in loans.collect()} == {frame.note[0]}
    assert read_log(spark, str(tmp_path / "log")).filter("step = 'load_raw'").first().rows_in == 10


def test_ingestion_parses_the_export_once(spark, raw_csv, tmp_path, monkeypatch):
    """Every pass over the raw rows leaves a mark; there is one, and no work table stays."""
    marks, raw = tmp_path / "marks", load_raw(spark, raw_csv).coalesce(1)
    marks.mkdir()

    def marked(batches):
        (marks / uuid.uuid4().hex).touch()
        yield from batches

    monkeypatch.setattr(ingestion, "load_raw", lambda *_: raw.mapInArrow(marked, raw.schema))
    assert run_ingestion(spark, raw_csv, str(tmp_path / "c"), str(tmp_path / "l")).count() == 4
    assert len(list(marks.iterdir())) == 1
    assert folder_names(spark, f"{work_folder(spark)}/credence-work") == []


@pytest.mark.parametrize("limit", [cleaning.BROADCAST_FINGERPRINTS, 0])
def test_fingerprint_dedupe_equals_plain_dedupe(spark, raw_csv, limit):
    raw = load_raw(spark, raw_csv)
    zero = raw.limit(2).withColumn("dti", F.lit("0")).withColumn("note", F.lit("z"))
    raw = raw.unionByName(raw.withColumn("purpose", F.lit(None).cast("string"))).unionByName(
        raw.withColumn("loan_amnt", F.concat("loan_amnt", F.lit(".0")))).unionByName(
        zero, True).unionByName(zero.withColumn("dti", F.lit("-0.0")), True)
    with WorkTables(spark) as space:
        rows = space.table(raw.select(*[v.alias(c) for c, v in cleaning.typed(
            raw.columns).items()]), "rows")
        plain, found = cleaning.deduped(raw), cleaning.without_copies(rows, space, limit)
        assert found.count() == plain.count() == 22
        assert found.exceptAll(plain.select(found.columns)).isEmpty()


def test_equal_fingerprints_of_different_rows_stay(spark):
    """Hashes skip nulls, so these rows share both fingerprints."""
    rows = [("a", None, "b"), (None, "a", "b"), ("a", "b", None), ("a", None, "b")]
    with WorkTables(spark) as space:
        df = space.table(spark.createDataFrame(rows, "x string, y string, z string"), "rows")
        found = cleaning.without_copies(df, space)
        assert sorted(map(str, found.collect())) == sorted(
            map(str, df.dropDuplicates().collect()))
        assert found.count() == 3


def test_only_copies_travel_whole(spark, loans, tmp_path):
    """Whole rows pass no exchange unless their fingerprint repeats."""
    with WorkTables(spark) as space:
        rows = space.table(loans.unionAll(loans.limit(3)), "rows")
        found = cleaning.without_copies(rows, space)
        assert found.count() == 420
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "LeftAnti, BuildRight" in plan and "LeftSemi, BuildRight" in plan
        assert "SortMergeJoin" not in plan


def test_many_repeated_fingerprints_do_not_move_all_rows(spark, tmp_path):
    """Beyond the limit of the list a bitmap tells which rows are compared in full."""
    with WorkTables(spark) as space:
        once = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("x").alias("x"))
        rows = space.table(once.unionAll(once.filter("k < 'k2'")), "rows")
        found = cleaning.without_copies(rows, space, 0)
        assert found.count() == 3000 and found.exceptAll(once).isEmpty()
        text = found._jdf.queryExecution().executedPlan().toString()
        assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text


@pytest.mark.parametrize("low", [0, 1000])
def test_bitmap_knows_every_mark(spark, low):
    marks = spark.range(low, low + 5000, 7).select((F.col("id") - 2500).alias("m"))
    bits = cleaning._bitmap(marks, "m")
    every = spark.range(low - 2500, low + 2500).withColumnRenamed("id", "m")
    told = every.withColumn("_row", F.floor(cleaning._bit_of("m") / cleaning.BITMAP_ROW)).join(
        bits, "_row", "left").filter(cleaning._bit_is_set(F.col("_bits"), "m"))
    assert {r.m for r in told.collect()} == {r.m for r in marks.collect()}


def test_staged_cleaning_equals_the_lazy_one(spark, raw_csv, tmp_path):
    raw = load_raw(spark, raw_csv)
    raw = raw.unionByName(raw)
    plain = cleaning.clean_loans(raw)
    space = StagedTables(spark, "staged_cleaning", uuid.uuid4().hex, 100 << 20)
    found = cleaning.clean_loans(raw, space)
    assert found.count() == plain.count() == 4 and found.exceptAll(plain).isEmpty()
    seen = []
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    staged(spark, "many", space.fingerprint, lambda: seen.append(
        spark.conf.get("spark.sql.shuffle.partitions")) or raw, input_bytes=100 << 20)
    assert seen == ["13"] and spark.conf.get("spark.sql.shuffle.partitions") == partitions


def test_files_of_the_clean_table_are_of_advisory_size(spark, loans, tmp_path):
    wide = loans.withColumn("issue_year", F.year(F.to_date("issue_d", "MMM-yyyy")))
    write_loans(wide.repartition(20), str(tmp_path / "few"))
    files = spark.read.parquet(str(tmp_path / "few")).inputFiles()
    years = wide.select("issue_year").distinct().count()
    assert years <= len(files) <= 2 * years
    hot = wide.withColumn("issue_year", F.lit(2014)).crossJoin(spark.range(400))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    with settings(spark, {size: "200KB"}):
        write_loans(hot, str(tmp_path / "hot"))
    hot_files = spark.read.parquet(str(tmp_path / "hot")).inputFiles()
    assert len(hot_files) > 3  # one year is not one task's


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager() \
        .diskBlockManager().getAllFiles()
    return {name for name in (found.apply(i).getName() for i in range(found.size()))
            if name.startswith("shuffle") and name.endswith(".data")}


def no_new_shuffle_files(spark, before):
    for _ in range(50):  # they go in the background
        if not shuffle_files(spark) - before:
            return True
        time.sleep(0.2)
    return False


@pytest.mark.parametrize("copies", [1, ingestion.PART_COPIES])
def test_ingestion_in_parts_equals_the_whole(spark, raw_csv, tmp_path, monkeypatch, copies):
    """Parts shuffle by turns, a part's files of the work table go with it, copies meet across parts."""
    frame = pd.read_csv(raw_csv, dtype=str, keep_default_na=False)
    frame = pd.concat([frame, frame.assign(loan_amnt="1"), frame.assign(addr_state="TX")])
    (tmp_path / "raw").mkdir()
    for i, some in enumerate([frame, frame[:10].assign(dti="1"), frame[5:25], frame[10:]]):
        some.to_csv(tmp_path / "raw" / f"{i}.csv", index=False)
    expected = run_ingestion(spark, str(tmp_path / "raw"), str(tmp_path / "whole"),
                             str(tmp_path / "l1"))
    dropped, shuffled = [], []

    def drop(spark, files):
        dropped.extend(files)
        shuffled.append(no_new_shuffle_files(spark, before))
        drop_files(spark, files)

    monkeypatch.setattr(ingestion, "PART_BYTES", 1)
    monkeypatch.setattr(ingestion, "CORE_BYTES", 0)
    monkeypatch.setattr(ingestion, "PART_COPIES", copies)
    monkeypatch.setattr(ingestion, "drop_files", drop)
    with settings(spark, {"spark.sql.files.openCostInBytes": str(1 << 30)}):  # a file is a task
        before = shuffle_files(spark)
        found = run_ingestion(spark, str(tmp_path / "raw"), str(tmp_path / "parts"),
                              str(tmp_path / "l2"))
    assert len(dropped) == len(set(dropped)) == len(shuffled) == 4 and all(shuffled)
    assert expected.count() == found.count() == 16 and found.schema == expected.schema
    assert found.exceptAll(expected).isEmpty()
    assert (tmp_path / "parts" / "_SUCCESS").exists()
    steps = [read_log(spark, str(tmp_path / log)).orderBy("timestamp").select(
        "step", "rows_in", "rows_out").collect() for log in ("l1", "l2")]
    assert steps[0] == steps[1]


@pytest.mark.parametrize("limit", [cleaning.BROADCAST_FINGERPRINTS, 0])
def test_copies_are_told_in_any_part(spark, limit):
    rows = [(i % 30, "x" if i % 2 else None, 0.0 if i % 3 else -0.0) for i in range(50)]
    with WorkTables(spark) as space:
        df = space.table(spark.createDataFrame(rows, "a long, b string, c double"), "rows")
        copies = cleaning.Copies(df, space, limit)
        shares = list(copies.distinct(df, 3))
        halves = [copies.sides(df.filter(half))[0] for half in ("a % 2 = 0", "a % 2 = 1")]
        assert copies.count == 20 and len(shares) == 7
        assert sum(share.count() for share in shares) == 20
        assert sum(half.count() for half in halves) == 10
        found = functools.reduce(DataFrame.unionAll, shares + halves)
        assert found.exceptAll(df.dropDuplicates()).isEmpty()


def test_export_leaves_no_more_than_packed_files(spark, tmp_path, monkeypatch):
    """Neither a second copy of the rows nor shuffle files lie beside the export; nulls change nothing."""
    day, n = datetime.datetime(1997, 3, 1), 200
    lines = [(i % 60 or None, i % 37 if i % 41 else None, i % 9, i % 7, float(i % 50), 4000.0 * i,
              i % 10 / 100, i % 5 / 100, "NAR"[i % 3] if i % 43 else None) for i in range(n)]
    orders = [(k or None, k % 8, "OFP"[k % 3], "2-HIGH", day) for k in range(60)]
    people = [(k, k % 25, 100.0 * k, "BUILDING") for k in range(7)]
    for name, rows, schema in (
            ("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
             "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
             "l_returnflag string"),
            ("orders", orders, "o_orderkey int, o_custkey long, o_orderstatus string, "
             "o_orderpriority string, o_orderdate timestamp"),
            ("customer", people, "c_custkey long, c_nationkey int, c_acctbal double, "
             "c_mktsegment string")):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    monkeypatch.setattr(tables, "SHARE_BYTES", 1)
    mark, before = tables.mark(spark, str(tmp_path)), shuffle_files(spark)
    found = tables.raw_csv(spark, str(tmp_path))
    assert no_new_shuffle_files(spark, before)
    assert all(name.endswith(".csv.gz") for name in found.inputFiles())
    assert not path_exists(spark, stage_path(spark, "raw_loans", mark))
    log = registry.ingest_log(spark, str(tmp_path)).orderBy("step_no").collect()
    raw = tables.raw(spark, str(tmp_path))
    assert found.count() == raw.count() > 100
    for c in ("loan_id", "annual_inc", "loan_status", "issue_d", "last_pymnt_d", "term"):
        same = raw.select(F.col(c).cast("string"))
        assert found.select(c).exceptAll(same).isEmpty() and same.exceptAll(found.select(c)).isEmpty()
    assert log == registry.ingest_funnel(spark, str(tmp_path)).orderBy("step_no").collect()
    assert log[0].rows_in == raw.count() and log[-1].rows_out > 0


def test_failed_parts_leave_nothing(spark, tmp_path):
    """A folder of parts is whole and marked so, or not there."""
    def parts(broken):
        yield spark.range(3)
        assert not (tmp_path / "t" / "_SUCCESS").exists()
        yield spark.range(4).select(F.raise_error(F.lit("broken")) if broken else "id")

    for broken in (False, True):
        with pytest.raises(Exception, match="broken") if broken else contextlib.nullcontext():
            write_parts(spark, parts(broken), str(tmp_path / "t"), lambda df: df.write, "parquet")
        assert (tmp_path / "t" / "_SUCCESS").exists() != broken
        assert broken or spark.read.parquet(str(tmp_path / "t")).count() == 7
    assert not (tmp_path / "t").exists()


def test_clean_rows(spark, raw_csv):
    rows = cleaning.clean_loans(load_raw(spark, raw_csv)).orderBy("issue_date").collect()
    assert [r.issue_d for r in rows] == ["Jul-2013", "Aug-2014", "Nov-2015", "Feb-2016"]
    assert [r.defaulted for r in rows] == [0, 0, 1, 1]
    second = rows[1]
    assert (second.months_on_book, second.fico_avg, second.issue_year) == (30, 704.0, 2014)
    assert (second.emp_length_years, second.int_rate_frac) == (3.0, pytest.approx(0.1299))
    assert (rows[3].home_ownership, rows[3].months_on_book) == ("NONE", 0)


def test_funnel_matches_step_by_step_counts(spark, raw_csv):
    raw = load_raw(spark, raw_csv)
    raw = raw.unionByName(raw)
    expected, before = [], raw.count()
    for steps, (name, _) in enumerate(cleaning.FUNNEL, 1):
        after = cleaning.scoped(raw, steps).count()
        expected.append((steps, name, before, after))
        before = after
    expected.append((6, "dedupe", before, cleaning.clean_loans(raw).count()))
    rows = [tuple(r) for r in cleaning.funnel(raw).orderBy("step_no").collect()]
    assert rows == expected
    assert rows[-1][2:] == (8, 4)


def test_dedupe_treats_equal_numbers_and_nulls_as_equal(spark, raw_csv):
    raw = load_raw(spark, raw_csv).withColumn("purpose", F.lit(None).cast("string"))
    again = raw.withColumn("loan_amnt", F.concat("loan_amnt", F.lit(".0")))
    assert cleaning.clean_loans(raw.unionByName(again)).count() == 4


def test_ingestion_writes_table_and_log(spark, raw_csv, tmp_path):
    clean, log = str(tmp_path / "clean"), str(tmp_path / "log")
    loans = run_ingestion(spark, raw_csv, clean, log)
    assert loans.count() == 4
    assert (tmp_path / "clean" / "issue_year=2016").exists()
    before = cleaning.clean_loans(load_raw(spark, raw_csv))
    assert read_loans(spark, clean).select(before.columns).exceptAll(before).isEmpty()
    events = {r.step: r for r in read_log(spark, log).collect()}
    assert events["load_raw"].rows_in == 10
    assert (events["filter_grade"].rows_in, events["filter_grade"].rows_out) == (10, 9)
    assert (events["dedupe"].rows_in, events["dedupe"].rows_out) == (4, 4)
    assert events["write_processed"].detail["path"] == clean
    run_ingestion(spark, raw_csv, clean, log)
    assert read_log(spark, log).filter("step = 'dedupe'").count() == 2


def test_failed_ingestion_is_logged(spark, tmp_path):
    log = str(tmp_path / "log")
    with pytest.raises(IngestionError):
        run_ingestion(spark, str(tmp_path / "absent.csv"), str(tmp_path / "clean"), log)
    event = read_log(spark, log).first()
    assert event.step == "ingestion_failed" and "not found" in event.detail["error"]


def test_any_failure_is_logged_after_the_steps_before_it(spark, raw_csv, tmp_path):
    blocked, log = tmp_path / "file", str(tmp_path / "log")
    blocked.write_text("in the way")
    with pytest.raises(Exception, match="file"):
        run_ingestion(spark, raw_csv, str(blocked / "clean"), log)
    steps = {r.step for r in read_log(spark, log).collect()}
    assert {"load_raw", "filter_grade", "ingestion_failed"} <= steps


def test_full_table_before_sample(spark, raw_csv, tmp_path):
    full, sample = str(tmp_path / "full"), str(tmp_path / "sample")
    with pytest.raises(FileNotFoundError):
        load_loans(spark, full, sample)
    run_ingestion(spark, raw_csv, full, str(tmp_path / "log"))
    loans = read_loans(spark, full).withColumn("loan_id", F.monotonically_increasing_id())
    loans.write.partitionBy("issue_year").parquet(str(tmp_path / "keyed"))
    assert write_demo_sample(spark, str(tmp_path / "keyed"), sample, 2).count() == 2
    assert load_loans(spark, full, sample).first().is_sample is False
    assert load_loans(spark, str(tmp_path / "absent"), sample).first().is_sample is True
