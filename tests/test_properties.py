import unicodedata
from datetime import date, timedelta
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockloom import model
from stockloom.functions.columns import safe_div
from stockloom.functions.diacritics import strip_diacritics
from stockloom.operators.normalize import drop_empty_columns
from stockloom.operators.prices import quarter_end_price
from stockloom.operators.statements import financial_report

few = settings(
    max_examples=6, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
money = st.decimals(-10**15, 10**15, places=2, allow_nan=False)


@few
@given(st.lists(st.tuples(st.none() | money, st.none() | money), min_size=1, max_size=30))
def test_safe_div_never_raises(spark, pairs):
    df = spark.createDataFrame(pairs, "a decimal(20,2), b decimal(20,2)")
    out = df.select("a", "b", safe_div(F.col("a"), F.col("b")).try_cast(model.RATE).alias("q")).collect()
    for r in out:
        if r.a is None or not r.b:
            assert r.q is None
        elif r.q is not None:
            assert abs(r.q - r.a / r.b) <= Decimal("0.00006")


@few
@given(st.lists(st.tuples(*[st.none() | st.integers(0, 3)] * 4), max_size=8))
def test_drop_empty_columns_is_idempotent(spark, data):
    df = spark.createDataFrame(data, "a int, `b.c` int, d int, e int")
    once = drop_empty_columns(df)
    kept = [c for i, c in enumerate(df.columns) if any(row[i] is not None for row in data)]
    assert once.columns == kept and drop_empty_columns(once).columns == kept


@few
@given(st.integers(0, 5), st.integers(0, 5))
def test_report_rows_add_up(spark, n_income, n_balance):
    schema = "stock_code string, year int, quarter int"
    frames = [spark.createDataFrame([("A", 2024, 1)] * n, schema) for n in (n_income, n_balance)]
    assert financial_report(*frames).count() == n_income + n_balance


@few
@given(st.sets(st.tuples(st.sampled_from("AB"), st.integers(0, 400)), min_size=1, max_size=40))
def test_quarter_end_has_the_latest_day_of_each_quarter(spark, days):
    start = date(2023, 11, 1)
    data = [(code, start + timedelta(offset), Decimal(offset), Decimal(1)) for code, offset in days]
    df = spark.createDataFrame(
        data, "stock_code string, trade_date date, close decimal(15,2), market_cap decimal(20,2)"
    )
    expected = {}
    for code, day, close, _ in data:
        key = (code, day.year, (day.month + 2) // 3)
        expected[key] = max(expected.get(key, Decimal(-1)), close)
    got = quarter_end_price(df).collect()
    assert {(r.stock_code, r.year, r.quarter): r.close_price for r in got} == expected
    assert len(got) == len(expected)


@few
@given(st.lists(st.text(alphabet="aăâđĐêôơưÁệỗ Dd-é", max_size=20), min_size=1, max_size=20))
def test_stripping_marks_is_idempotent_and_complete(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    once = df.select("t", strip_diacritics(F.col("t")).alias("v"))
    both = once.select("t", "v", strip_diacritics(F.col("v")).alias("w")).collect()
    for r in both:
        marks = [c for c in unicodedata.normalize("NFD", r.t) if unicodedata.category(c) != "Mn"]
        assert r.v == r.w == "".join(marks).translate(str.maketrans("Đđ", "Dd"))
