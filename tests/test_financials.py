from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from stockloom import model
from stockloom.operators import prices as p
from stockloom.operators import ratios as r
from stockloom.operators import statements as s

KEY = "stock_code string, year int, quarter int"


def income(spark, header_values, *more):
    names = list(header_values)
    schema = KEY + "".join(f", `{h}` double" for h in names)
    return spark.createDataFrame([("ACB", 2024, 1, *header_values.values()), *more], schema)



def first_income(spark, header_values):
    return s.statement_income(income(spark, header_values)).first()


def test_revenue_falls_back_in_order(spark):
    net, gross = model.NET_REVENUE, model.GROSS_REVENUE
    interest, fees = model.NET_INTEREST_INCOME, model.NET_FEE_INCOME
    every = {net: 1.0, gross: 2.0, interest: 3.0, fees: 4.0}
    assert first_income(spark, every).revenue == D("1.00")
    assert first_income(spark, every | {net: None}).revenue == D("2.00")
    assert first_income(spark, every | {net: None, gross: None}).revenue == D("7.00")
    assert first_income(spark, {interest: 3.0}).revenue == D("3.00")
    assert first_income(spark, {interest: None, fees: 4.0}).revenue == D("4.00")
    assert first_income(spark, {"khác": 1.0}).revenue == D("0.00")


def test_gross_profit_rules(spark):
    net, cost, gross = model.NET_REVENUE, model.COST_OF_GOODS, model.GROSS_PROFIT
    assert first_income(spark, {gross: 5.0, net: 9.0, cost: -1.0}).gross_profit == D("5.00")
    assert first_income(spark, {gross: None, net: 9.0, cost: -1.0}).gross_profit == D("8.00")
    assert first_income(spark, {net: 9.0}).gross_profit == D("9.00")
    assert first_income(spark, {net: 9.0, cost: None}).gross_profit is None
    assert first_income(spark, {"khác": 1.0}).gross_profit == D("0.00")


def test_operating_and_net_profit(spark):
    first, second = model.OPERATING_PROFIT_HEADERS
    assert first_income(spark, {first: None, second: 2.0}).operating_profit == D("2.00")
    assert first_income(spark, {"khác": 1.0}).operating_profit is None
    headers = model.NET_PROFIT_HEADERS
    assert first_income(spark, {headers[3]: -3.0, headers[1]: None}).net_profit == D("-3.00")
    assert first_income(spark, {headers[1]: 4.0, headers[3]: -3.0}).net_profit == D("4.00")
    assert first_income(spark, {headers[0]: None}).net_profit == D("0.00")


def test_text_measures_are_read_as_numbers(spark):
    df = spark.createDataFrame(
        [("ACB", 2024, 1, "1.5E3", "oops")],
        f"{KEY}, `{model.NET_REVENUE}` string, `{model.GROSS_PROFIT}` string",
    )
    row = s.statement_income(df).first()
    assert (row.revenue, row.gross_profit) == (D("1500.00"), D("1500.00"))


def balance(spark, rows, headers=None):
    headers = headers or [*model.BALANCE_HEADERS.values(), model.CONTRIBUTED_CAPITAL]
    return spark.createDataFrame(rows, KEY + "".join(f", `{h}` double" for h in headers))


def test_report_shape(spark):
    inc = income(spark, {model.NET_REVENUE: 10.0})
    bal = balance(spark, [("ACB", 2024, 1, 100.0, 40.0, 60.0, 5.0, None, 10_000.0)])
    report = s.financial_report(inc, bal)
    assert report.columns == [
        "stock_code", "year", "quarter", "report_type",
        *model.INCOME_MEASURES, *model.BALANCE_MEASURES,
    ]
    assert {t for n, t in report.dtypes if n in model.INCOME_MEASURES} == {"decimal(20,2)"}
    by_type = {row.report_type: row for row in report.collect()}
    assert by_type["BalanceSheet"].net_profit is None
    assert by_type["BalanceSheet"].total_equity == D("40.00")
    assert by_type["IncomeStatement"].total_assets is None
    merged = s.merged_report(report).collect()
    assert len(merged) == 1 and merged[0].revenue == D("10.00") and merged[0].total_assets == D("100.00")


def test_absent_balance_header_is_null(spark):
    bal = balance(spark, [("ACB", 2024, 1, 7.0)], [model.CONTRIBUTED_CAPITAL])
    assert s.statement_balance(bal).first().total_assets is None


def test_shares_are_truncated(spark):
    bal = balance(spark, [("ACB", 2024, 1, 19_999.0)], [model.CONTRIBUTED_CAPITAL])
    assert s.outstanding_shares(bal).first().outstanding_shares == 1


def test_missing_capital_header_is_named(spark):
    bal = balance(spark, [("ACB", 2024, 1, 1.0)], ["khác"])
    with pytest.raises(ValueError, match="Vốn góp"):
        s.outstanding_shares(bal)


def quotes(spark, rows):
    schema = (
        "stock_code string, trade_date date, open decimal(15,2), high decimal(15,2), "
        "low decimal(15,2), close decimal(15,2), volume bigint"
    )
    return spark.createDataFrame([(c, d, v, v, v, v, 1) for c, d, v in rows], schema)


def test_market_cap(spark):
    bal = balance(spark, [("ACB", 2024, 1, 30_000.0)], [model.CONTRIBUTED_CAPITAL])
    fact = p.price_history(
        quotes(spark, [("ACB", date(2024, 3, 29), D(10)), ("ACB", date(2024, 4, 1), D(11))]), bal
    )
    caps = {row.trade_date.month: row.market_cap for row in fact.collect()}
    assert caps == {3: D("30.00"), 4: D("0.00")}  # no balance row for the second quarter
    assert fact.columns == [f.name for f in model.FACT_PRICE.fields if not f.surrogate]


def test_market_cap_without_any_shares(spark):
    days = quotes(spark, [("ACB", date(2024, 3, 29), D(10))])
    assert p.price_history(days, None).first().market_cap is None
    lacking = balance(spark, [("ACB", 2024, 1, 1.0)], ["khác"])
    assert p.price_history(days, lacking, require_capital=False).first().market_cap is None
    with pytest.raises(ValueError):
        p.price_history(days, lacking)


def priced(spark, rows):
    schema = "stock_code string, trade_date date, close decimal(15,2), market_cap decimal(20,2)"
    return spark.createDataFrame(rows, schema)


def test_quarter_end_takes_the_last_day(spark):
    fact = priced(
        spark,
        [
            ("ACB", date(2024, 1, 5), D(1), D(10)),
            ("ACB", date(2024, 3, 28), D(3), None),
            ("ACB", date(2024, 2, 9), D(2), D(20)),
            ("ACB", date(2024, 4, 1), D(4), D(40)),
            ("ACB", None, D(9), D(90)),
        ],
    )
    got = {(r.year, r.quarter): (r.close_price, r.market_cap) for r in p.quarter_end_price(fact).collect()}
    assert got == {(2024, 1): (D("3.00"), None), (2024, 2): (D("4.00"), D("40.00"))}


def report(spark, rows):
    names = model.INCOME_MEASURES + model.BALANCE_MEASURES
    schema = KEY + ", report_type string" + "".join(f", {n} decimal(20,2)" for n in names)
    full = [
        (*key, kind, *[None if vals.get(n) is None else D(vals[n]) for n in names])
        for key, kind, vals in rows
    ]
    return spark.createDataFrame(full, schema)


ACB = ("ACB", 2024, 1)


def ratio_row(spark, values, close=D(20), cap=D(2000), key=ACB):
    prices = priced(spark, [("ACB", date(2024, 3, 29), close, cap)])
    return r.financial_ratio(report(spark, [(key, "any", values)]), prices).first()


def test_all_ratios(spark):
    row = ratio_row(
        spark, {"net_profit": 300, "revenue": 900, "total_equity": 1200, "total_assets": 2400}
    )
    assert row.report_period == "Q1/2024"
    assert (row.net_margin, row.roe, row.roa) == (D("0.3333"), D("0.2500"), D("0.1250"))
    assert (row.eps, row.book_value) == (D("3.00"), D("12.00"))  # 100 implied shares
    assert (row.pe, row.pb) == (D("6.67"), D("1.67"))


def test_rows_of_one_statement_only(spark):
    row = ratio_row(spark, {"net_profit": None, "revenue": None, "total_equity": 1000})
    assert (row.net_margin, row.eps, row.pe, row.roe) == (None,) * 4
    assert (row.book_value, row.pb) == (D("10.00"), D("2.00"))
    row = ratio_row(spark, {"net_profit": 100, "revenue": 1000})
    assert (row.pb, row.book_value, row.roe, row.roa) == (None,) * 4


def test_zero_profit(spark):
    row = ratio_row(spark, {"net_profit": 0, "revenue": 100})
    assert (row.net_margin, row.eps, row.pe) == (D("0.0000"), D("0.00"), None)
    assert ratio_row(spark, {"net_profit": 0, "revenue": 0}).net_margin is None


def test_no_shares(spark):
    row = ratio_row(spark, {"net_profit": 5, "revenue": 10, "total_equity": 7}, cap=D(0))
    assert (row.eps, row.book_value, row.pe) == (None,) * 3
    assert row.pb == D("0.00")


def test_quarter_without_price_keeps_the_row(spark):
    row = ratio_row(spark, {"net_profit": 5, "revenue": 10}, key=("ACB", 2023, 4))
    assert row.net_margin == D("0.5000") and row.eps is None and row.pb is None


def test_ratio_out_of_range_is_null(spark):
    row = ratio_row(spark, {"net_profit": 10**12, "revenue": 1, "total_equity": 10**12})
    assert row.net_margin is None and row.roe == D("1.0000")


def test_unmerged_report_gives_two_rows_per_quarter(spark):
    both = report(
        spark,
        [
            (ACB, "IncomeStatement", {"net_profit": 300, "revenue": 900}),
            (ACB, "BalanceSheet", {"total_equity": 1200, "total_assets": 2400}),
        ],
    )
    prices = priced(spark, [("ACB", date(2024, 3, 29), D(20), D(2000))])
    apart = r.financial_ratio(both, prices)
    assert apart.count() == 2 and apart.where(F.col("roe").isNotNull()).count() == 0
    merged = r.financial_ratio_merged(both, prices).collect()
    assert len(merged) == 1 and merged[0].roe == D("0.2500")


def test_long_amounts_keep_every_digit(spark):
    from decimal import Decimal

    from stockloom.functions.columns import amount

    df = spark.createDataFrame([("12345678901234567",), ("123456789012345678",), ("1.5E3",), ("x",)], "v string")
    got = [r[0] for r in df.select(amount(df, "v").try_cast("decimal(20,2)")).collect()]
    assert got == [Decimal("12345678901234567.00"), Decimal("123456789012345678.00"), Decimal("1500.00"), None]


def test_clashing_days_give_one_quarter_end(spark):
    from stockloom.operators.prices import quarter_end_price

    data = [("A", "2024-03-29", 1.0, 5.0), ("A", "2024-03-29", 2.0, 4.0), ("A", "2024-03-28", 9.0, 9.0)]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "stock_code string, trade_date string, close double, market_cap double")
        row = quarter_end_price(df.withColumn("trade_date", df.trade_date.cast("date"))).first()
        assert (row.close_price, row.market_cap) == (2.0, 4.0)
