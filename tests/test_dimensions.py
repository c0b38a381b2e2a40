from datetime import date

import pytest

from stockloom import model
from stockloom.operators import dimensions as d
from stockloom.operators import universe as u
from stockloom.operators.unions import tag_from_path, union_tagged

LEADER = (
    "stock_code string, id string, officer_name string, officer_position string, "
    "quantity bigint, officer_own_percent double, update_date date"
)


def basic(spark, rows):
    schema = "code string, tax_code string, company_name string, listing_date string"
    return spark.createDataFrame(rows, schema)


def test_enterprise_join_and_dates(spark):
    companies = basic(
        spark,
        [
            ("ACB", "0301", "Á Châu", "21/11/2006"),
            ("GAS", "0350", "Khí", "31/02/2024"),
            ("XXX", "0999", "unmapped", ""),
            ("YYY", "0001", "wrong tax", "01/01/2020"),
            ("ZZZ", "0002", None, None),
        ],
    )
    mapping = spark.createDataFrame(
        [("ACB", "0301", "6419"), ("GAS", "0350", "0620"), ("YYY", "1", "1"), ("ZZZ", "0002", "9")],
        ["code", "tax_code", "industry_code"],
    )
    got = {r.stock_code: r for r in d.enterprise_enriched(companies, mapping).collect()}
    assert set(got) == {"ACB", "GAS", "ZZZ"}
    assert got["ACB"].listing_date == date(2006, 11, 21)
    assert got["GAS"].listing_date is None and got["GAS"].industry_code == "0620"


def test_code_defaults_to_stock_code(spark):
    companies = basic(spark, [("ACB", "1", "n", None)]).withColumnRenamed("code", "stock_code")
    mapping = spark.createDataFrame([("ACB", "1", "2")], ["code", "tax_code", "industry_code"])
    out = d.enterprise_enriched(companies, mapping)
    assert out.columns.count("stock_code") == 1 and out.first().stock_code == "ACB"


def leaders(spark):
    return spark.createDataFrame(
        [
            ("ACB", "1", "old name", "CEO", 5, 0.1, date(2023, 1, 1)),
            ("ACB", "1", "new name", "Chair", 7, 0.25, date(2024, 1, 1)),
            ("ACB", "1", "a tie", "CEO", 7, 0.25, date(2024, 1, 1)),
            ("ACB", "1", "no date", "CEO", 7, 99999.0, None),
            ("GAS", "1", "other firm", "CEO", None, None, None),
            ("GAS", None, "no id", "CEO", 1, 0.0, None),
        ],
        LEADER,
    )


def test_holder_survivor_is_the_latest_then_first_by_name(spark, rows):
    got = rows(d.dim_holder(leaders(spark)), "holder_id", "full_name", "is_organization", "updated_at")
    assert got == [
        ("ACB_1", "a tie", False, date(2024, 1, 1)),
        ("GAS_1", "other firm", False, None),
        (None, "no id", False, None),
    ]


def test_shareholders_may_flag_organisations(spark):
    holders = leaders(spark).limit(0).union(
        spark.createDataFrame([("ACB", "S9", "Fund", None, 10, 0.5, date(2024, 2, 2))], LEADER)
    ).selectExpr("*", "true AS is_organization")
    got = {r.holder_id: r.is_organization for r in d.dim_holder(leaders(spark), holders).collect()}
    assert got["ACB_S9"] is True and got["ACB_1"] is False
    assert d.fact_ownership(leaders(spark), holders).count() == 7


def test_ownership_keeps_every_row_and_types(spark):
    fact = d.fact_ownership(leaders(spark))
    assert dict(fact.dtypes) == {
        "stock_code": "string", "holder_id": "string", "position": "string",
        "shares_count": "bigint", "ownership_ratio": "decimal(10,6)", "report_date": "date",
    }
    assert fact.count() == 6
    assert fact.where("position = 'CEO' AND shares_count = 7 AND ownership_ratio IS NULL").count() == 1


def test_subsidiary_type_map(spark):
    raw = spark.createDataFrame(
        [("FPT", "a", "sub"), ("FPT", "b", "aff"), ("FPT", "c", None), ("FPT", "d", "?")],
        "stock_code string, comp_name string, comp_type string",
    )
    out = d.fact_subsidiary(raw)
    assert out.columns == ["parent_stock_code", "subsidiary_name", "subsidiary_type"]
    assert [r.subsidiary_type for r in out.orderBy("subsidiary_name").collect()] == [
        "Subsidiary", "Affiliate", "Subsidiary", "Subsidiary",
    ]


def test_dim_date(spark):
    days = spark.createDataFrame(
        [(date(2024, 3, 4),), (date(2024, 3, 2),), (date(2024, 3, 4),), (None,)], "trade_date date"
    )
    got = [tuple(r) for r in d.dim_date(days).collect()]
    assert got == [
        (date(2024, 3, 2), 2, 3, 1, 2024, True, "Saturday"),
        (date(2024, 3, 4), 4, 3, 1, 2024, False, "Monday"),
    ]
    assert d.dim_date(days, fill_gaps=True).count() == 3


def test_default_universe(spark):
    codes = [r.stock_code for r in u.default_universe(spark).collect()]
    assert len(codes) == 50 and codes == sorted(set(codes))
    assert set(model.LARGE_CAPS) < set(codes)


def test_filter_universe(spark, rows):
    df = spark.createDataFrame([("A", 1), ("B", 2), ("A", 3), (None, 4)], "code string, v int")
    assert u.filter_universe(df, None, "code").count() == 4
    assert u.filter_universe(df, [], "code").count() == 4
    assert rows(u.filter_universe(df, ["A"], "code")) == [("A", 1), ("A", 3)]
    listed = u.code_list(spark, ["A", "A", "Z"])
    assert rows(u.filter_universe(df, listed, "code")) == [("A", 1), ("A", 3)]


def test_take_until_found_stops_after_the_page_that_completes_the_list(spark):
    pages = [(1, "A"), (1, "x"), (2, "B"), (2, "A"), (3, "C"), (4, "A")]
    df = spark.createDataFrame(pages, "page int, code string")
    codes = u.code_list(spark, ["A", "B", "C"])
    kept = u.take_until_found(df, codes, "code", "page").orderBy("page", "code").collect()
    assert [(r.page, r.code) for r in kept] == [(1, "A"), (2, "A"), (2, "B")]
    short = u.take_until_found(df, u.code_list(spark, ["C", "D"]), "code", "page", max_pages=2)
    assert short.count() == 0
    assert u.take_until_found(df, None, "code", "page", max_pages=2).count() == 4
    assert u.take_until_found(df, [], "code", "page").count() == 2


def test_page_zero_and_rows_without_a_page(spark, rows):
    df = spark.createDataFrame([(0, "A"), (1, "B"), (None, "C"), (2, "A")], "page int, code string")
    assert u.take_until_found(df, None, "code", "page").count() == 4
    assert rows(u.take_until_found(df, [], "code", "page"), "page", "code") == [(0, "A")]
    assert rows(u.take_until_found(df, ["A"], "code", "page"), "page", "code") == [(0, "A")]
    assert rows(u.take_until_found(df, ["C", "X"], "code", "page"), "page", "code") == [(None, "C")]


def test_pages_beyond_the_first_ranges_are_read(spark, rows):
    df = spark.createDataFrame([(p, c) for p in (83, 84, 85, 90, 4000) for c in "AB"], "page int, code string")
    assert u.take_until_found(df, None, "code", "page").count() == 10
    many = u.code_list(spark, ["A"] * 5)
    assert rows(u.take_until_found(df, many, "code", "page"), "page", "code") == [(p, "A") for p in (4000, 83, 84, 85, 90)]
    for n, last in ((1, 83), (3, 85), (4, 90)):
        kept = u.take_until_found(df, u.code_list(spark, ["A"] * n), "code", "page").collect()
        assert max(r.page for r in kept) == last and len(kept) == n
    nothing = u.code_list(spark, [])
    first = spark.createDataFrame([(1, "A"), (2, "A")], "page int, code string")
    for empty in ([], nothing):
        assert rows(u.take_until_found(first, empty, "code", "page"), "page", "code") == [(1, "A")]
        assert u.filter_universe(first, empty, "code").count() == 2
    plan = u.take_until_found(df, many, "code", "page")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == 1


def test_union_of_differing_sources(spark, rows):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, "y")], "id int, b string")
    nothing = spark.createDataFrame([], "id int, extra string")
    sources = {"a": a, "none": None, "empty": nothing, "b": b}
    assert set(union_tagged(sources, "ticker").columns) == {"id", "a", "b", "extra", "ticker"}
    out = union_tagged(sources, "ticker", skip_empty=True)
    assert set(out.columns) == {"id", "a", "b", "ticker"}
    assert rows(out, "id", "a", "b", "ticker") == [(1, "x", None, "a"), (2, None, "y", "b")]
    with pytest.raises(ValueError):
        union_tagged({"none": None, "empty": nothing}, "ticker", skip_empty=True)


def test_tag_from_path(spark, tmp_path):
    for code in ("ACB", "FPT"):
        spark.range(2).write.parquet(f"{tmp_path}/{code}.parquet")
    df = spark.read.parquet(f"{tmp_path}/ACB.parquet", f"{tmp_path}/FPT.parquet")
    got = df.select("id", tag_from_path(r"([A-Z]+)\.parquet").alias("ticker"))
    assert sorted({r.ticker for r in got.collect()}) == ["ACB", "FPT"]
