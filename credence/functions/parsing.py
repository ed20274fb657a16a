"""Column expressions that turn export text into numbers and dates. Bad text becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from credence.fixed_values import NA_TOKENS

MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"


def blank_missing(value: Column) -> Column:
    """Null where the cell holds one of the missing-value tokens."""
    return F.when(~value.isin(NA_TOKENS), value)


def number(value: Column) -> Column:
    """The number a cell holds; text that reads as not-a-number is missing."""
    parsed = value.try_cast("double")
    return F.when(~F.isnan(parsed), parsed)


def first_number(text: Column) -> Column:
    """First run of digits: ' 36 months' gives 36.0."""
    return F.regexp_substr(text.cast("string"), F.lit("[0-9]+")).try_cast("double")


def percent_fraction(value: Column) -> Column:
    """'13.56%' or 13.56 gives 0.1356."""
    bare = F.trim(F.replace(value.cast("string"), F.lit("%"), F.lit("")))
    return number(bare) / 100.0


def employment_years(text: Column) -> Column:
    """'10+ years' gives 10, '< 1 year' gives 0, missing markers give null."""
    return F.when(F.trim(text).startswith("<"), 0.0).otherwise(first_number(text))


def month_number(text: Column) -> Column:
    """'Jan-2018' gives 12 * 2018 + 0: months since year 0, null unless the text is MMM-yyyy.

    String arithmetic costs a fraction of a date formatter, and the filters need only months.
    """
    name = F.substring(text, 1, 3)
    usual = F.instr(F.lit(MONTHS.title()), name)  # spares most rows the lower-casing
    month = F.when(usual % 4 == 1, usual).otherwise(F.instr(F.lit(MONTHS), F.lower(name)))
    year = F.substring(text, 5, 4).try_cast("int")
    well_formed = (F.length(text) == 8) & (F.substring(text, 4, 1) == "-") & (month % 4 == 1)
    return F.when(well_formed, year * 12 + F.floor(month / 4).cast("int"))


def month_date(text: Column) -> Column:
    """'Jan-2018' gives the first of that month."""
    months = month_number(text)
    return F.make_date(year_of(months), months % 12 + 1, F.lit(1))


def year_of(months: Column) -> Column:
    return F.floor(months / 12).cast("int")
