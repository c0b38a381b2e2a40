from datetime import date

import pytest

from stockloom import model
from stockloom.operators import quality as q

OWNERSHIP = (
    "stock_code string, holder_id string, position string, shares_count bigint, "
    "ownership_ratio double, report_date date"
)


def ownership(spark):
    return spark.createDataFrame(
        [
            ("ACB", "ACB_1", "CEO", 1, 0.5, None),
            (None, "ACB_1", "x" * 256, 1, 10_000.0, None),
            ("LONGERTHANTEN", None, None, 1, None, None),
        ],
        OWNERSHIP,
    )


def test_not_null(spark, rows):
    assert rows(q.check_not_null(ownership(spark), model.FACT_OWNERSHIP)) == [
        ("fact_ownership", "holder_id", 1), ("fact_ownership", "stock_code", 1),
    ]


def test_lengths(spark, rows):
    assert rows(q.check_lengths(ownership(spark), model.FACT_OWNERSHIP)) == [
        ("fact_ownership", "holder_id", 50, 0),
        ("fact_ownership", "position", 255, 1),
        ("fact_ownership", "stock_code", 10, 1),
    ]


def test_decimal_range_of_numbers_and_text(spark, rows):
    assert rows(q.check_decimal_range(ownership(spark), model.FACT_OWNERSHIP)) == [
        ("fact_ownership", "ownership_ratio", "decimal(10,6)", 1)
    ]
    text = spark.createDataFrame([("1.5",), ("12345678901",), ("abc",), (None,)], "ownership_ratio string")
    assert rows(q.check_decimal_range(text, model.FACT_OWNERSHIP))[0][3] == 2


def test_unique_keys(spark, rows):
    day = date(2024, 1, 2)
    df = spark.createDataFrame(
        [("ACB", day), ("ACB", day), ("ACB", day), ("GAS", day), (None, day), (None, day)],
        "stock_code string, trade_date date",
    )
    assert rows(q.check_unique_keys(df, model.FACT_PRICE)) == [
        ("fact_price_history", "stock_code,trade_date", 1, 2)
    ]
    assert rows(q.duplicate_keys(df, ["stock_code", "trade_date"])) == [("ACB", day, 3)]


def test_unique_keys_without_clash(spark, rows):
    df = spark.createDataFrame([("ACB",), ("GAS",)], ["stock_code"])
    assert rows(q.check_unique_keys(df, model.DIM_ENTERPRISE)) == [("dim_enterprise", "stock_code", 0, 0)]


def test_foreign_keys(spark, rows):
    parents = {
        "dim_enterprise": spark.createDataFrame([("ACB",)], ["stock_code"]),
        "dim_holder_info": spark.createDataFrame([("ACB_1",)], ["holder_id"]),
    }
    child = spark.createDataFrame(
        [("ACB", "ACB_1"), ("GAS", "ACB_1"), ("GAS", "Z"), (None, "Z")],
        "stock_code string, holder_id string",
    )
    got = rows(q.check_foreign_keys(child, "fact_ownership", model.FACT_OWNERSHIP.references, parents))
    assert got == [
        ("fact_ownership", "holder_id", "dim_holder_info", "Z", 2),
        ("fact_ownership", "stock_code", "dim_enterprise", "GAS", 2),
    ]
    with pytest.raises(ValueError):
        q.check_foreign_keys(child, "dim_date", (), parents)


def test_contract_has_nine_tables():
    assert len(model.WAREHOUSE) == 9
    assert sum(len(t.references) for t in model.WAREHOUSE.values()) == 7
    assert [t.surrogate.name for t in model.WAREHOUSE.values() if t.surrogate] == [
        "price_id", "ratio_id", "report_id", "ownership_id", "sub_id",
    ]
