"""Loan economics as column expressions.

RAROC under any cost assumptions depends on five sums over the approved loans, so every report
aggregates those sums once and does the rest as arithmetic on the small result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from credence.fixed_values import CAPITAL_RATE, LGD, OPEX_RATE, TARGET

MEASURES = ["n", "lent", "yearly_interest", "yearly_defaulted", "defaulted_amount"]


def lifetime_interest(amount: Column, yearly_rate: Column, months: Column) -> Column:
    """Interest paid over the whole term of a level-payment loan.

    0 where the formula has no value: at a zero rate, at one too small to tell from zero, and at a
    term of no months.
    """
    monthly = yearly_rate / 12
    share = 1 - F.pow(1 + monthly, -months)
    return F.when((yearly_rate == 0) | (months <= 0) | (share == 0), 0.0).otherwise(
        amount * (F.try_divide(monthly * months, share) - 1))


def loan_measures() -> dict[str, Column]:
    """Per-loan terms whose sums over the approved loans are the MEASURES."""
    amount, months = F.col("loan_amnt").cast("double"), F.col("term_months").cast("double")
    years = months / 12
    interest = lifetime_interest(amount, F.col("int_rate_frac"), months)
    return {
        "n": F.lit(1).cast("long"),
        "lent": amount,
        "yearly_interest": F.try_divide(interest, years),
        "yearly_defaulted": F.try_divide(amount * F.col(TARGET), years),
        "defaulted_amount": amount * F.col(TARGET),
    }


def raroc_metrics(total_loans: Column, lgd: Column | float = LGD,
                  opex_rate: Column | float = OPEX_RATE,
                  capital_rate: Column | float = CAPITAL_RATE) -> dict[str, Column]:
    """P&L waterfall from the MEASURES columns; all zero where nothing is approved."""
    lgd, opex_rate, capital_rate = (
        x if isinstance(x, Column) else F.lit(float(x)) for x in (lgd, opex_rate, capital_rate))
    approved = F.col("n") > 0
    revenue = F.col("yearly_interest")
    loss = lgd * F.col("yearly_defaulted")
    opex = opex_rate * F.col("lent")
    capital = capital_rate * F.col("lent")
    net = revenue - loss - opex

    def zero_if_empty(value: Column) -> Column:
        return F.when(approved, value).otherwise(0.0)

    return {
        "n": F.col("n"),
        "approval_rate": zero_if_empty(F.col("n") / total_loans),
        "revenue": zero_if_empty(revenue),
        "actual_loss": zero_if_empty(loss),
        "opex": zero_if_empty(opex),
        "capital": zero_if_empty(capital),
        "net_income": zero_if_empty(net),
        "raroc": F.when(approved & (capital > 0), net / capital).otherwise(0.0),
        "loss_rate": F.when(approved & (F.col("lent") > 0),
                            lgd * F.col("defaulted_amount") / F.col("lent")).otherwise(0.0),
    }
