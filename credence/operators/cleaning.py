"""Scope, parse, label and dedupe raw loan records."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credence import fixed_values as fixed
from credence.functions import parsing
from credence.functions.counting import count_where
from credence.sources.staging import StagedTables, WorkTables

#: Fingerprints of repeated rows that are broadcast, 8 bytes each; more are told by a bitmap.
BROADCAST_FINGERPRINTS = 1_000_000
_MARK = "_mark"
#: Bits of that bitmap, 16 MB in rows of 4 KB.
BITMAP_BITS, BITMAP_ROW = 1 << 27, 1 << 15
NUMBER_COLUMNS = [
    "loan_amnt", "annual_inc", "dti", "fico_range_low", "fico_range_high", "delinq_2yrs",
    "open_acc", "pub_rec", "inq_last_6mths", "mort_acc", "total_acc",
]


def in_scope_grade() -> Column:
    return F.col("grade").isin(fixed.SCOPED_GRADES)


def has_known_outcome() -> Column:
    return F.col("loan_status").isin(fixed.GOOD_STATUSES + fixed.BAD_STATUSES)


def from_mature_years(min_year: int = fixed.MIN_ISSUE_YEAR) -> Column:
    return parsing.month_number(F.col("issue_d")) >= 12 * min_year


def derived_columns() -> dict[str, Column]:
    """The columns a clean record adds to a raw one, except the FICO average."""
    return {
        "term_months": parsing.first_number(F.col("term")),
        "int_rate_frac": parsing.percent_fraction(F.col("int_rate")),
        "emp_length_years": parsing.employment_years(F.col("emp_length")),
        "revol_util_frac": parsing.percent_fraction(F.col("revol_util")),
        "months_on_book": (
            parsing.month_number(F.col("last_pymnt_d"))
            - parsing.month_number(F.col("issue_d"))),
        "defaulted": F.when(F.col("loan_status").isin(fixed.BAD_STATUSES), 1).otherwise(0),
    }


def has_valid_months() -> Column:
    return derived_columns()["months_on_book"] >= 0


def is_complete() -> Column:
    """Every key field is present and parses."""
    derived = derived_columns()
    condition = F.lit(True)
    for name in fixed.KEY_FIELDS:
        value = derived[name] if name in derived else parsing.number(F.col(name))
        condition = condition & value.isNotNull()
    return condition


FUNNEL = [
    ("filter_grade", in_scope_grade),
    ("filter_loan_status", has_known_outcome),
    ("filter_platform_maturity", from_mature_years),
    ("filter_invalid_months_on_book", has_valid_months),
    ("drop_incomplete_rows", is_complete),
]


def scoped(raw: DataFrame, steps: int = len(FUNNEL)) -> DataFrame:
    """Raw rows that pass the first ``steps`` filters; Catalyst merges them into one."""
    for _, condition in FUNNEL[:steps]:
        raw = raw.filter(condition())
    return raw


def typed(columns: list[str]) -> dict[str, Column]:
    """Raw columns, numbers as numbers."""
    return {c: parsing.number(F.col(c)) if c in NUMBER_COLUMNS else F.col(f"`{c}`")
            for c in columns}


def deduped(rows: DataFrame, space: WorkTables | StagedTables | None = None) -> DataFrame:
    """Distinct rows, number columns typed; nulls count as equal.

    With a ``space`` for tables only repeated rows of a stored table are shuffled whole.
    """
    rows = rows.withColumns({name: parsing.number(F.col(name)) for name in NUMBER_COLUMNS})
    return without_copies(rows, space) if space else rows.dropDuplicates()


def without_copies(rows: DataFrame, space: WorkTables | StagedTables,
                   limit: int = BROADCAST_FINGERPRINTS) -> DataFrame:
    """Distinct rows of a stored table; only rows whose fingerprint repeats are shuffled whole.

    Fingerprints, hashes of 64 bits, are grouped first. Rows that share one are compared in full, so
    equal fingerprints of different rows do no harm. More than ``limit`` repeated fingerprints are
    not broadcast but marked in a bitmap of fixed size; the few rows that meet a bit by chance are
    compared as well.
    """
    once, more = Copies(rows, space, limit).sides(rows)
    return once.unionByName(more.dropDuplicates())


class Copies:
    """Knows which rows of a stored table may be copies, see ``without_copies``."""

    def __init__(self, rows: DataFrame, space: WorkTables | StagedTables,
                 limit: int = BROADCAST_FINGERPRINTS):
        self.repeated = space.table(_marked(rows).select(_MARK).groupBy(_MARK).agg(
            F.count(F.lit(1)).alias("copies")).filter("copies > 1").drop("copies"), "repeated")
        self.count = self.repeated.count()
        self.bitmap = (space.table(_bitmap(self.repeated, _MARK), "repeated_bits")
                       if self.count > limit else None)

    def sides(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Of any rows of the table, those that have no copy in all of it, and the others."""
        marked = _marked(rows)
        if self.bitmap is None:
            once, more = (marked.join(F.broadcast(self.repeated), _MARK, how).drop(_MARK)
                          for how in ("left_anti", "left_semi"))
            return once, more
        told = marked.withColumn("_row", F.floor(_bit_of(_MARK) / BITMAP_ROW)).join(
            F.broadcast(self.bitmap), "_row", "left").withColumn(
            "_set", F.coalesce(_bit_is_set(F.col("_bits"), _MARK), F.lit(False)))
        once, more = (told.filter(side).select(*[f"`{c}`" for c in rows.columns])
                      for side in (~F.col("_set"), F.col("_set")))
        return once, more

    def distinct(self, rows: DataFrame, most: int) -> Iterator[DataFrame]:
        """The distinct rows among those with copies, in shares of ``most`` fingerprints or so."""
        shares = max(1, -(-self.count // most))
        for share in range(shares):
            own = rows if shares == 1 else rows.filter(
                F.pmod(_fingerprint(rows), F.lit(shares)) == share)
            yield self.sides(own)[1].dropDuplicates()


def _fingerprint(rows: DataFrame) -> Column:
    return F.xxhash64(*[
        F.when(F.col(f"`{c}`") == 0, F.lit(0.0)).otherwise(F.col(f"`{c}`"))
        if kind == "double" else F.col(f"`{c}`") for c, kind in rows.dtypes])


def _marked(rows: DataFrame) -> DataFrame:
    return rows.withColumn(_MARK, _fingerprint(rows))


def _bit_of(mark: str) -> Column:
    return F.pmod(F.col(mark), F.lit(BITMAP_BITS))


def _bitmap(marks: DataFrame, mark: str) -> DataFrame:
    """(_row, _bits): a bit for every mark, in rows of bits; its size does not depend on the input."""
    bit = _bit_of(mark)
    return marks.groupBy(F.floor(bit / BITMAP_ROW).alias("_row")).agg(
        F.bitmap_construct_agg(bit % BITMAP_ROW).alias("_bits"))


def _bit_is_set(bits: Column, mark: str) -> Column:
    place = (_bit_of(mark) % BITMAP_ROW).cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("long"), place % 8) == 1


def with_derived(rows: DataFrame) -> DataFrame:
    """Parsed columns, label, FICO average, issue date and issue year."""
    issued = F.col("issue_d")
    return rows.withColumns({
        **derived_columns(),
        "fico_avg": (F.col("fico_range_low") + F.col("fico_range_high")) / 2,
        "issue_date": parsing.month_date(issued),
        "issue_year": parsing.year_of(parsing.month_number(issued)),
    })


def clean_loans(raw: DataFrame, space: WorkTables | StagedTables | None = None) -> DataFrame:
    """Filters, full-row dedupe, then derived columns.

    Derived columns depend on the raw row alone, so raw rows are deduped before they widen: what is
    shuffled carries only raw columns, and copies collapse on the map side first. Numbers are
    typed before that, so '5000' and '5000.0' are one value. With a ``space`` for tables the rows
    in scope are stored there, so they are filtered once, and only repeated ones are shuffled whole.
    """
    rows = scoped(raw)
    return with_derived(deduped(space.table(rows, "scoped") if space else rows, space))


def level_of() -> Column:
    """How many of the filters, taken in order, a raw row passes; none is tried after a failed one."""
    level = F.lit(len(FUNNEL))
    for i, (_, condition) in reversed(list(enumerate(FUNNEL))):
        level = F.when(~F.coalesce(condition(), F.lit(False)), i).otherwise(level)
    return level


def leveled(raw: DataFrame) -> DataFrame:
    """``_level`` and, of rows that pass every filter, the typed columns.

    Written once, it gives both the funnel's counts and the rows to clean.
    """
    complete = F.col("_level") == len(FUNNEL)
    return raw.withColumn("_level", level_of()).select(
        "_level", *[F.when(complete, value).alias(c) for c, value in typed(raw.columns).items()])


def passed(rows: DataFrame) -> DataFrame:
    """The rows of a leveled table that pass every filter."""
    return rows.filter(F.col("_level") == len(FUNNEL)).drop("_level")


def filter_counts(rows: DataFrame) -> DataFrame:
    """One row over a leveled table: all rows, then rows left after each filter."""
    return rows.agg(F.count(F.lit(1)).alias("raw"), *[
        count_where(F.col("_level") > i).alias(name) for i, (name, _) in enumerate(FUNNEL)])


def funnel(raw: DataFrame) -> DataFrame:
    """(step_no, step, rows_in, rows_out) for the five filters and the dedupe, in one job.

    A row that fails is reduced to the number of filters it passed, so map-side aggregation leaves
    a handful of such rows; only rows that pass everything travel whole to the dedupe.
    """
    columns = [value.alias(c) for c, value in typed(raw.columns).items()]
    complete = F.col("level") == len(FUNNEL)
    copies = raw.withColumn("level", level_of()).groupBy(
        "level", F.when(complete, F.struct(*columns)).alias("record")).agg(
        F.count(F.lit(1)).alias("copies"))
    sums = copies.agg(
        F.sum("copies").alias("raw"),
        *[F.sum(F.when(F.col("level") >= i + 1, F.col("copies")).otherwise(0)).alias(name)
          for i, (name, _) in enumerate(FUNNEL)],
        count_where(complete).alias("dedupe"))
    names = ["raw", *[name for name, _ in FUNNEL], "dedupe"]
    steps = [F.struct(F.lit(i).alias("step_no"), F.lit(names[i]).alias("step"),
                      F.coalesce(F.col(names[i - 1]), F.lit(0)).alias("rows_in"),
                      F.coalesce(F.col(names[i]), F.lit(0)).alias("rows_out"))
             for i in range(1, len(names))]
    return sums.select(F.inline(F.array(*steps)))
