"""Cleaning of landed statement and price tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom import model
from stockloom.functions.columns import amount, field_ref, find_header, whole_number


def nonnull_counts(df: DataFrame) -> DataFrame:
    """One row with the number of non-null values of every column."""
    return df.agg(*[F.count(field_ref(c)).alias(c) for c in df.columns])


def empty_columns(df: DataFrame, probe_rows: int = 1_000) -> list[str]:
    """Columns without any value.

    A few rows, fetched as flags from as few files as needed, prove most columns
    filled. Only the undecided ones are then searched over the whole table, so a
    columnar scan does not touch the others.
    """
    flags = [field_ref(c).isNotNull().alias(f"c{i}") for i, c in enumerate(df.columns)]
    probe = df.select(*flags).head(probe_rows)
    undecided = [c for i, c in enumerate(df.columns) if not any(row[i] for row in probe)]
    if not undecided:
        return []
    found = df.agg(*[F.count(field_ref(c)).alias(f"c{i}") for i, c in enumerate(undecided)]).first()
    return [c for i, c in enumerate(undecided) if found[i] == 0]


def drop_empty_columns(df: DataFrame) -> DataFrame:
    empty = set(empty_columns(df))
    return df.select(*[field_ref(c) for c in df.columns if c not in empty])


def adopt_alias(
    df: DataFrame, target: str, aliases: Sequence[str], drop_rest: bool = False
) -> DataFrame:
    """Rename the first alias present to ``target``; optionally drop the other aliases."""
    chosen = find_header(df, aliases)
    if chosen is None:
        return df
    if drop_rest:
        others = [find_header(df, [a]) for a in aliases]
        df = df.drop(*[field_ref(o) for o in others if o is not None and o != chosen])
    return df.withColumnRenamed(chosen, target)


def normalize_statement(df: DataFrame, drop_empty: bool = True) -> DataFrame:
    """Landed income or balance table → columns keyed by stock_code, year, quarter."""
    if drop_empty:
        df = drop_empty_columns(df)
    df = adopt_alias(df, "stock_code", model.SYMBOL_HEADERS, drop_rest=True)
    df = adopt_alias(df, "year", model.YEAR_HEADERS)
    df = adopt_alias(df, "quarter", model.QUARTER_HEADERS)
    return df.withColumns({c: whole_number(df, c) for c in ("year", "quarter")})


def normalize_prices(df: DataFrame) -> DataFrame:
    """Landed daily quotes, in thousands → typed prices in units, with year and quarter."""
    df = adopt_alias(df, "stock_code", model.SYMBOL_HEADERS, drop_rest=True)
    if "trade_date" not in df.columns:
        df = adopt_alias(df, "trade_date", model.TRADE_DATE_HEADERS)
    quotes = [
        (amount(df, c) * 1000).try_cast(model.PRICE).alias(c)
        for c in ("open", "high", "low", "close")
    ]
    typed = df.select(
        field_ref("stock_code"),
        field_ref("trade_date").try_cast("date").alias("trade_date"),
        *quotes,
        amount(df, "volume").try_cast("long").alias("volume"),
    )
    return with_quarter(typed)


def with_quarter(df: DataFrame, date: str = "trade_date") -> DataFrame:
    return df.withColumns({"year": F.year(date), "quarter": F.quarter(date)})
