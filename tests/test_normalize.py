from datetime import date
from decimal import Decimal

from stockloom.operators import normalize as n


def test_nonnull_counts_quotes_dotted_headers(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, `b.c` int")
    assert n.nonnull_counts(df).first().asDict() == {"a": 2, "b.c": 0}


def test_drop_empty_columns(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "x")], "a int, `b.c` int, d string")
    once = n.drop_empty_columns(df)
    assert once.columns == ["a", "d"]
    assert n.drop_empty_columns(once).columns == once.columns


def test_a_value_after_the_probed_rows_keeps_its_column(spark):
    df = spark.range(5_000).selectExpr("id", "IF(id = 4999, 'late', NULL) AS late", "NULL AS never")
    assert n.empty_columns(df, probe_rows=10) == ["never"]


def test_table_without_rows_has_only_empty_columns(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert n.empty_columns(df) == ["a", "b"]


def test_symbol_from_ticker_wins_and_drops_the_other(spark):
    df = spark.createDataFrame([("ACB", "X", "2024.0", "1")], ["ticker", "CP", "Năm", "Kỳ"])
    out = n.normalize_statement(df)
    assert out.columns == ["stock_code", "year", "quarter"]
    assert tuple(out.first()) == ("ACB", 2024, 1)


def test_symbol_from_short_header_alone(spark):
    df = spark.createDataFrame([("ACB", 2024, 1)], ["CP", "Năm", "Kỳ"])
    assert n.normalize_statement(df).columns == ["stock_code", "year", "quarter"]


def test_bad_period_becomes_null(spark):
    df = spark.createDataFrame([("ACB", "n/a", "2")], ["CP", "Năm", "Kỳ"])
    assert tuple(n.normalize_statement(df).first()) == ("ACB", None, 2)


def test_prices_are_scaled_and_typed(spark):
    df = spark.createDataFrame(
        [("ACB", "2024-05-06", "25.35", "26", "25", "25.4", "1200")],
        ["ticker", "tradingDate", "open", "high", "low", "close", "volume"],
    )
    out = n.normalize_prices(df)
    assert dict(out.dtypes)["open"] == "decimal(15,2)" and dict(out.dtypes)["volume"] == "bigint"
    row = out.first()
    assert (row.trade_date, row.open, row.close) == (
        date(2024, 5, 6), Decimal("25350.00"), Decimal("25400.00"),
    )
    assert (row.volume, row.year, row.quarter) == (1200, 2024, 2)


def test_first_date_alias_wins(spark):
    df = spark.createDataFrame(
        [("ACB", "2024-05-06", "2023-01-01", 1.0, 1.0, 1.0, 1.0, 1)],
        ["ticker", "time", "tradingDate", "open", "high", "low", "close", "volume"],
    )
    assert n.normalize_prices(df).first().trade_date == date(2024, 5, 6)


def test_unreadable_cells_become_null(spark):
    df = spark.createDataFrame(
        [("ACB", "31/02/2024", "x", None, "1e20", "1", "")],
        "ticker string, time string, open string, high string, low string, close string, volume string",
    )
    row = n.normalize_prices(df).first()
    assert (row.trade_date, row.open, row.high, row.low, row.volume) == (None,) * 5
    assert row.close == Decimal("1000.00")
