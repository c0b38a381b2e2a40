"""Daily price fact and its quarter-end view."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom import model
from stockloom.functions.columns import find_header
from stockloom.operators.normalize import with_quarter
from stockloom.operators.statements import KEYS, outstanding_shares


def price_history(
    prices: DataFrame, balance: DataFrame | None, require_capital: bool = True
) -> DataFrame:
    """Price fact with the market capitalisation of each day.

    A quarter without a balance row counts zero shares. Without any source of shares
    (no balance table, or one that lacks contributed capital while
    ``require_capital`` is off) the capitalisation is null.
    """
    prices = with_quarter(prices)
    has_capital = balance is not None and (
        require_capital or find_header(balance, [model.CONTRIBUTED_CAPITAL]) is not None
    )
    if has_capital:
        # One share count per company and quarter against some sixty trading days: the
        # small side is broadcast if its measured size allows, else both are hashed.
        prices = prices.join(outstanding_shares(balance), list(KEYS), "left")
        market_cap = F.col("close") * F.coalesce("outstanding_shares", F.lit(0))
    else:
        market_cap = F.lit(None)
    return prices.select(
        "stock_code",
        "trade_date",
        *[F.col(c).try_cast(model.PRICE).alias(c) for c in ("open", "high", "low", "close")],
        F.col("volume").try_cast("long").alias("volume"),
        market_cap.try_cast(model.MONEY).alias("market_cap"),
    )


def quarter_end_price(price_fact: DataFrame) -> DataFrame:
    """Close and capitalisation of the last trading day of each quarter.

    An aggregate rather than a ranked window: every task reduces its rows to one per
    company and quarter before the shuffle, by hashing, and nothing is sorted. Days are
    unique per company in a sound price fact; of clashing rows the one with the highest
    close is taken, and rows of one quarter with equal closes have equal capitalisations.
    """
    # Day and close in one number, so that the order is total and the aggregate still hashes.
    day = F.unix_date("trade_date").cast("decimal(10,0)") * F.lit(Decimal(10**14))
    order = (day + F.coalesce(F.col("close").try_cast(model.PRICE), F.lit(-1))).cast("decimal(38,2)")
    return (
        with_quarter(price_fact.where(F.col("trade_date").isNotNull()))
        .groupBy(*KEYS)
        .agg(
            F.max_by("close", order).alias("close_price"),
            F.max_by("market_cap", order).alias("market_cap"),
        )
    )
