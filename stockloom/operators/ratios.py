"""Valuation and profitability ratios per report row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom import model
from stockloom.functions.columns import period_label, safe_div
from stockloom.operators.prices import quarter_end_price
from stockloom.operators.statements import KEYS, merged_report

MARGIN = ("net_margin",)
RETURNS = ("roe", "roa")
PER_SHARE = ("eps", "book_value")
VALUATION = ("pe", "pb")
ALL_RATIOS = MARGIN + RETURNS + PER_SHARE + VALUATION


def ratio_columns(names: tuple[str, ...] = ALL_RATIOS) -> list:
    """Ratio expressions over a report row that carries its quarter-end price."""
    profit, revenue = F.col("net_profit"), F.col("revenue")
    equity, assets = F.col("total_equity"), F.col("total_assets")
    close, market_cap = F.col("close_price"), F.col("market_cap")
    shares = safe_div(market_cap, close)
    earnings = safe_div(profit, shares)  # unrounded, as pe needs it
    formulas = {
        "net_margin": (safe_div(profit, revenue), model.RATE),
        "roe": (safe_div(profit, equity), model.RATE),
        "roa": (safe_div(profit, assets), model.RATE),
        "eps": (earnings, model.PRICE),
        "book_value": (safe_div(equity, shares), model.PRICE),
        "pe": (safe_div(close, earnings), model.MULTIPLE),
        "pb": (safe_div(market_cap, equity), model.MULTIPLE),
    }
    return [formulas[n][0].try_cast(formulas[n][1]).alias(n) for n in names]


def financial_ratio(
    report: DataFrame, price_fact: DataFrame, names: tuple[str, ...] = ALL_RATIOS
) -> DataFrame:
    """Ratios of every report row.

    Income and balance rows stay apart, so measures that need both are null; pass
    ``merged_report(report)`` to get one complete row per quarter. Prices are read only
    for ratios that depend on them: with one price row per quarter, the join neither
    drops nor repeats report rows.
    """
    if set(names).isdisjoint(PER_SHARE + VALUATION):
        priced = report.withColumns({c: F.lit(None) for c in ("close_price", "market_cap")})
    else:
        priced = report.join(quarter_end_price(price_fact), list(KEYS), "left")
    label = period_label(F.col("year"), F.col("quarter")).alias("report_period")
    return priced.select(*KEYS, label, *ratio_columns(names))


def financial_ratio_merged(report: DataFrame, price_fact: DataFrame) -> DataFrame:
    return financial_ratio(merged_report(report), price_fact)
