import unicodedata
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockloom.functions import columns as c
from stockloom.functions.diacritics import strip_diacritics


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first().v


@pytest.mark.parametrize(
    "numerator, denominator, expected",
    [(6.0, 3.0, 2.0), (1.0, 0.0, None), (1.0, None, None), (None, 2.0, None), (0.0, 5.0, 0.0)],
)
def test_safe_div(spark, numerator, denominator, expected):
    quotient = c.safe_div(F.lit(numerator).cast("double"), F.lit(denominator).cast("double"))
    assert one(spark, quotient) == expected


def test_safe_div_keeps_decimals(spark):
    quotient = c.safe_div(
        F.lit(Decimal("1.00")).cast("decimal(20,2)"), F.lit(Decimal("3.00")).cast("decimal(20,2)")
    )
    assert one(spark, quotient.cast("decimal(10,4)")) == Decimal("0.3333")


def test_headers_match_in_composed_form_and_exact_case(spark):
    decomposed = unicodedata.normalize("NFD", "Doanh thu thuần")
    df = spark.createDataFrame([("1.5", "x")], [decomposed, "lãi gộp"])
    assert c.find_header(df, ["Doanh thu thuần"]) == decomposed
    assert c.find_header(df, ["Lãi gộp"]) is None
    assert df.select(c.amount(df, "Doanh thu thuần").alias("v")).first().v == 1.5
    assert df.select(c.amount(df, "Lãi gộp", 0).alias("v")).first().v == 0


def test_field_ref_quotes_awkward_names(spark):
    df = spark.createDataFrame([(1, 2)], ["a.b (đồng)", "tick`s"])
    assert tuple(df.select(c.field_ref("a.b (đồng)"), c.field_ref("tick`s")).first()) == (1, 2)


def test_whole_number_reads_float_text(spark):
    df = spark.createDataFrame([("2024.0",), ("2024",), ("x",), (None,)], "y string")
    assert [r[0] for r in df.select(c.whole_number(df, "y")).collect()] == [2024, 2024, None, None]


def test_period_label_and_weekend(spark):
    assert one(spark, c.period_label(F.lit(2024), F.lit(3))) == "Q3/2024"
    assert one(spark, c.period_label(F.lit(2024), F.lit(None).cast("int"))) is None
    days = spark.createDataFrame([("2024-03-02",), ("2024-03-03",), ("2024-03-04",)], ["d"])
    flags = days.select(c.is_weekend(F.col("d").cast("date"))).collect()
    assert [r[0] for r in flags] == [True, True, False]


def test_usable_key(spark):
    df = spark.createDataFrame([("0301",), ("nan",), ("",), (None,)], "k string")
    assert [r.k for r in df.where(c.usable_key(F.col("k"))).collect()] == ["0301"]


def test_digit_predicates(spark):
    df = spark.createDataFrame([("0620",), ("62",), ("06a0",), ("06201",)], "k string")
    flags = df.select(c.all_digits(F.col("k")), c.four_digits(F.col("k"))).collect()
    assert [tuple(r) for r in flags] == [(True, True), (True, False), (False, False), (True, False)]


def test_strip_diacritics(spark):
    cases = {
        "Đỗ Năm đồng": "Do Nam dong",
        "plain": "plain",
        "": "",
        "Ångström ça": "Angstrom ca",
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = df.select("t", strip_diacritics(F.col("t")).alias("v")).collect()
    assert {r.t: r.v for r in got} == cases


def test_strip_space_removes_line_breaks(spark):
    assert one(spark, c.strip_space(F.lit(" \n\t a b \r\n"))) == "a b"
