"""Mapping of wide, sparse statements to the fixed report columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom import model
from stockloom.functions.columns import amount, field_ref, find_header, first_amount

KEYS = ("stock_code", "year", "quarter")


def income_measures(income: DataFrame) -> dict[str, Column]:
    zero = F.lit(0)

    def or_zero(header: str) -> Column:
        return F.coalesce(amount(income, header, 0), zero)

    # Banks report no net revenue: interest plus fee income stands in for it.
    bank_revenue = or_zero(model.NET_INTEREST_INCOME) + or_zero(model.NET_FEE_INCOME)
    # Costs are landed as negative numbers. A missing column counts as zero, while a
    # null inside a present column leaves the sum unknown.
    derived_gross = amount(income, model.NET_REVENUE, 0) + amount(income, model.COST_OF_GOODS, 0)
    return {
        "revenue": first_amount(
            income, [model.NET_REVENUE, model.GROSS_REVENUE], bank_revenue
        ),
        "gross_profit": first_amount(income, [model.GROSS_PROFIT], derived_gross),
        "operating_profit": first_amount(income, model.OPERATING_PROFIT_HEADERS),
        "net_profit": first_amount(income, model.NET_PROFIT_HEADERS, zero),
    }


def balance_measures(balance: DataFrame) -> dict[str, Column]:
    return {m: amount(balance, header) for m, header in model.BALANCE_HEADERS.items()}


def statement_income(income: DataFrame) -> DataFrame:
    return _report_rows(income, model.INCOME_TAG, income_measures(income))


def statement_balance(balance: DataFrame) -> DataFrame:
    return _report_rows(balance, model.BALANCE_TAG, balance_measures(balance))


def financial_report(income: DataFrame, balance: DataFrame) -> DataFrame:
    """One row per statement; measures of the other statement are null."""
    return statement_income(income).unionByName(statement_balance(balance))


def merged_report(report: DataFrame) -> DataFrame:
    """One row per company and quarter, joining both statements into it."""
    measures = model.INCOME_MEASURES + model.BALANCE_MEASURES
    return report.groupBy(*KEYS).agg(*[F.max(m).alias(m) for m in measures])


def outstanding_shares(balance: DataFrame) -> DataFrame:
    """Shares at a par value of 10000, from contributed capital."""
    if find_header(balance, [model.CONTRIBUTED_CAPITAL]) is None:
        raise ValueError(f"balance table lacks the column {model.CONTRIBUTED_CAPITAL!r}")
    shares = (amount(balance, model.CONTRIBUTED_CAPITAL) / 10000).try_cast("long").alias("outstanding_shares")
    return balance.select(*[field_ref(k) for k in KEYS], shares)


def _report_rows(df: DataFrame, tag: str, measures: dict[str, Column]) -> DataFrame:
    columns = [
        measures.get(m, F.lit(None)).try_cast(model.MONEY).alias(m)
        for m in model.INCOME_MEASURES + model.BALANCE_MEASURES
    ]
    return df.select(*[field_ref(k) for k in KEYS], F.lit(tag).alias("report_type"), *columns)
