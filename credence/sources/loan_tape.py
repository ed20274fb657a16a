"""A raw loan export derived from the lineitem, orders and customer tables.

Every lineitem becomes one loan application record in the shape of a lender's CSV export: text
terms and rates, month names, missing markers, open loans, impossible dates and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_GRADES = list("ABCCDDDEEFG")
_OWNERSHIP = ["RENT", "MORTGAGE", "OWN", "ANY", "NONE"]
_STATES = ("CA TX NY FL IL GA NC OH PA MI WA OR AZ NV CO UT NJ VA MA MN WI MO TN AL SC").split()
_EMPLOYMENT = ["< 1 year", "1 year", *[f"{n} years" for n in range(2, 10)], "10+ years", "n/a"]
_PURPOSES = {
    "MACHINERY": "small_business", "FURNITURE": "home_improvement",
    "BUILDING": "debt_consolidation", "AUTOMOBILE": "car", "HOUSEHOLD": "credit_card",
}


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), index.cast("int") + 1)


def _month_text(months: Column) -> Column:
    """Months since year 0 as 'Jan-2018'."""
    name = _pick("Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split(), months % 12)
    return F.concat(name, F.lit("-"), F.floor(months / 12).cast("string"))


def _nearest(value: Column) -> Column:
    """Nearest whole number of a positive double; cheaper than decimal rounding."""
    return F.floor(value + 0.5)


def raw_loans(spark: SparkSession, sf_dir: str, share: int = 0, shares: int = 1) -> DataFrame:
    """Raw loan records, text columns as text; of several shares, those of one share's orders.

    Orders meet customers first, so the widest table, lineitem, is shuffled once. It always takes
    a sort-merge join, which spills, and whose skewed keys adaptive execution splits; the smaller
    join is left to Spark's own size check.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        F.col("o_orderdate").cast("date").alias("ordered"))
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").alias("ok"), F.col("l_partkey").alias("pk"),
        F.col("l_suppkey").alias("sk"), F.col("l_linenumber").cast("long").alias("ln"),
        F.col("l_quantity").cast("int").alias("q"), "l_returnflag",
        _nearest(F.col("l_extendedprice") * 100).alias("cents"),
        _nearest(F.col("l_discount") * 100).cast("int").alias("d"),
        _nearest(F.col("l_tax") * 100).cast("int").alias("t"))
    if shares > 1:
        orders, lineitem = (
            df.filter(F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(shares)) == share)
            for df, key in ((orders, "o_orderkey"), (lineitem, "ok")))
    borrowers = orders.join(customer, orders.o_custkey == customer.c_custkey)
    lines = lineitem.hint("merge").join(borrowers, lineitem.ok == borrowers.o_orderkey)

    c = F.col
    keyed = lines.select(
        "*",
        F.expr("(ok * 7919 + pk * 104729 + sk * 1299709 + ln * 15485863) % 1000").alias("h"),
        F.expr("cast((7 * pk + 3 * sk + ok) % 61 as int)").alias("k"),
        F.expr("(3 * pk + ok) % 1000").alias("u"),
        F.expr("700 + 150 * d + 25 * t").alias("rate"),
        F.expr("660 + 5 * ((31 * c_custkey + 17 * pk + 7 * ok) % 38)").alias("low"),
        F.expr("(year(ordered) + 16) * 12 + month(ordered) - 1").alias("issued"),
        F.expr("explode(if(ok % 50 = 0, array(1, 2), array(1)))").alias("copy"))
    grade = _pick(_GRADES, c("d"))
    status = (
        F.when((c("o_orderstatus") == "P") & (c("pk") % 4 == 0), "Current")
        .when((c("o_orderstatus") == "O") & (c("pk") % 29 == 0), "Late (31-120 days)")
        .when(c("h") < 350 - (c("low") - 660) + 10 * c("d"),
              F.when(c("h") % 10 == 0, "Default").otherwise("Charged Off"))
        .otherwise("Fully Paid"))
    months_paid = F.when(c("k") == 59, -1).when(c("k") < 59, c("k"))
    purposes = F.create_map(*[F.lit(x) for pair in _PURPOSES.items() for x in pair])
    return keyed.select(
        F.concat_ws("-", "ok", "ln", "pk", "sk", "cents").alias("loan_id"),
        F.expr("cast(cents div 400 as double)").alias("loan_amnt"),
        F.when((c("pk") + c("ln")) % 3 == 0, " 60 months").otherwise(" 36 months").alias("term"),
        F.concat(F.expr("cast(rate div 100 as string)"), F.lit("."),
                 F.lpad((c("rate") % 100).cast("string"), 2, "0"), F.lit("%")).alias("int_rate"),
        grade.alias("grade"),
        F.concat(grade, (c("t") % 5 + 1).cast("string")).alias("sub_grade"),
        _pick(_EMPLOYMENT, c("q") % 12).alias("emp_length"),
        F.when(c("ok") % 97 != 0, F.round(20000 + 10 * (c("c_acctbal") + 1000), 2))
        .alias("annual_inc"),
        (((13 * c("pk") + 7 * c("sk") + c("ok")) % 2500
          + F.when(c("ordered") >= F.lit("1999-01-01").cast("date"), 800).otherwise(0))
         .cast("double") / 100).alias("dti"),
        status.alias("loan_status"),
        F.when(c("pk") % 211 != 0, F.element_at(purposes, c("c_mktsegment"))).alias("purpose"),
        c("low").cast("double").alias("fico_range_low"),
        (c("low") + 4).cast("double").alias("fico_range_high"),
        _month_text(c("issued")).alias("issue_d"),
        F.concat(F.expr("cast(u div 10 as string)"), F.lit("."),
                 (c("u") % 10).cast("string"), F.lit("%")).alias("revol_util_text"),
        (c("u") % 89 == 0).alias("revol_util_missing"),
        ((c("pk") + c("sk")) % 4).cast("double").alias("delinq_2yrs"),
        (2 + c("pk") % 18).cast("double").alias("open_acc"),
        F.when(c("sk") % 9 == 0, 1.0).otherwise(0.0).alias("pub_rec"),
        ((c("ok") + c("ln")) % 4).cast("double").alias("inq_last_6mths"),
        _pick(_OWNERSHIP, F.substring("o_orderpriority", 1, 1).cast("int") - 1)
        .alias("home_ownership"),
        F.when(c("l_returnflag") == "R", "Verified").when(c("l_returnflag") == "A", "Not Verified")
        .otherwise("Source Verified").alias("verification_status"),
        (c("ln") % 4).cast("double").alias("mort_acc"),
        (5 + c("pk") % 30).cast("double").alias("total_acc"),
        _month_text(c("issued") + months_paid).alias("last_pymnt_d"),
        _pick(_STATES, c("c_nationkey")).alias("addr_state"),
    ).withColumn("revol_util", F.when(~c("revol_util_missing"), c("revol_util_text"))
                 ).drop("revol_util_text", "revol_util_missing")
