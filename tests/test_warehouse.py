import json
from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stockloom import model
from stockloom.operators import gate, quality
from stockloom.plans import jobs
from stockloom.sources import raw
from stockloom.sources import warehouse as w
from stockloom.sources.landing import LandingZone
from stockloom.sources.scratch import scratch_root


class Recorder:
    """Stands in for a DataFrame writer and records what would reach the database."""

    def __init__(self, fail=False):
        self.calls, self.fail = {}, fail

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **options):
        self.calls["options"] = options
        return self

    def mode(self, mode):
        self.calls["mode"] = mode
        return self

    def save(self):
        if self.fail:
            raise OSError("connection refused")


@pytest.fixture
def recorded(monkeypatch, spark):
    def record(fail=False):
        recorder = Recorder(fail)

        class Rows:
            def repartition(self, n):
                recorder.calls["tasks"] = n
                return self

            def observe(self, observation, count):
                return self

            write = recorder

        class Counted:
            get = {"rows": 7}

        monkeypatch.setattr(w, "shape_for", lambda df, table: Rows())
        monkeypatch.setattr(w, "Observation", Counted)
        return recorder

    return record


SINK = w.JdbcSink("jdbc:postgresql://host:5432/db", "me", "secret", max_connections=4)


def test_postgres_address():
    assert w.JdbcSink.postgres_url("db", 5432, "mart") == "jdbc:postgresql://db:5432/mart"


def test_jdbc_append(recorded):
    recorder = recorded()
    assert SINK.write(None, "dim_industry") == 7
    options = recorder.calls["options"]
    assert recorder.calls["format"] == "jdbc" and recorder.calls["mode"] == "append"
    assert options["dbtable"] == "dim_industry" and options["driver"] == "org.postgresql.Driver"
    assert options["truncate"] == "false" and recorder.calls["tasks"] == 4


def test_jdbc_overwrite_keeps_the_table_and_takes_options(recorded):
    recorder = recorded()
    SINK.write(None, "dim_date", "overwrite", isolationLevel="NONE")
    assert recorder.calls["options"]["truncate"] == "true"
    assert recorder.calls["options"]["isolationLevel"] == "NONE"


def test_jdbc_error_names_the_table(recorded):
    recorded(fail=True)
    with pytest.raises(RuntimeError, match="dim_date.*refused"):
        SINK.write(None, "dim_date")


def test_shape_for_fills_defaults(spark):
    df = spark.createDataFrame([("ACB_1", None)], "holder_id string, is_organization boolean")
    row = w.shape_for(df, model.DIM_HOLDER).first()
    assert row.is_organization is False and row.updated_at == date.today() and row.full_name is None
    industry = w.shape_for(spark.createDataFrame([("0620",)], ["industry_code"]), model.DIM_INDUSTRY)
    assert industry.columns == ["industry_code", "industry_group", "industry_name", "created_at"]
    assert industry.first().created_at is not None


RAW = {
    "industries": "industry_group,industry_code,industry_name\nK,6419,Ngân hàng\nB,0620,Khí\n",
    "enterprise": (
        "code,company_name,company_eng_name,tax_code,address,email,website,listing_date\n"
        'ACB,Á Châu,Asia,0301452948,"442, Q3",a@b.vn,b.vn,21/11/2006\n'
        "GAS,Khí,Gas,3500102710,HCM,,,31/02/2012\n"
        "NON,None,None,1,HCM,,,\n"
    ),
    "subsidiaries": "stock_code,comp_name,comp_type,charter_capital,ownership_ratio\nACB,ACBS,sub,1500.5,100\nGAS,X,aff,,25.5\n",
    "leadership": (
        "id,officer_name,officer_position,quantity,officer_own_percent,update_date,stock_code,extra\n"
        "1,Hùng,Chair,100,0.0343,2024-06-30,ACB,x\n1,Huy,Chair,,,2023-06-30,ACB,x\n2,Sơn,CEO,5,0.1,,GAS,x\n"
    ),
    "income": (
        f"ticker,CP,Năm,Kỳ,report_type,{model.NET_INTEREST_INCOME},{model.NET_FEE_INCOME},{model.NET_REVENUE},{model.NET_PROFIT_HEADERS[0]},Trống\n"
        "ACB,ACB,2024,1,income_statement,700,200,,300,\nGAS,GAS,2024,1,income_statement,,,1000,-50,\n"
    ),
    "balance": (
        f"ticker,Năm,Kỳ,{model.BALANCE_HEADERS['total_assets']},{model.BALANCE_HEADERS['total_equity']},{model.CONTRIBUTED_CAPITAL}\n"
        "ACB,2024,1,9000,1200,1000000\n"
    ),
    "prices": (
        "time,open,high,low,close,volume,ticker\n2024-03-28,0.02,0.02,0.02,0.02,10,ACB\n"
        "2024-03-01,0.01,0.01,0.01,0.01,10,ACB\n2024-03-29,1,1,1,1,10,GAS\n"
    ),
}


SIZES = {
    "dim_industry": 2, "dim_enterprise": 2, "dim_holder_info": 2, "dim_date": 3,
    "fact_price_history": 3, "fact_financial_ratio": 2, "fact_financial_report": 3,
    "fact_ownership": 3, "fact_subsidiary": 2,
}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    for name, text in {**{model.LANDED_PATHS[k]: v for k, v in RAW.items()},
                       jobs.MAP_PATH: "code,tax_code,industry_code\nACB,0301452948,6419\nGAS,3500102710,0620\n"}.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text, encoding="utf-8")
    sink = replace(jobs.scratch_warehouse(spark), dense_ids=True)
    zone = LandingZone(spark, str(root))
    before = staged_folders(spark)
    report = jobs.load_warehouse(zone, sink)
    assert staged_folders(spark) == before  # what was staged is gone
    assert report.rows == SIZES and report.rejects == {} and report.violations == []
    return zone, sink


def staged_folders(spark):
    root = Path(scratch_root(spark).removeprefix("file:")) / "stockloom"
    return sorted(p.name for p in root.iterdir()) if root.exists() else []


def test_nine_tables_are_loaded(loaded):
    assert {name: loaded[1].read(name).count() for name in model.WAREHOUSE} == SIZES
    for name, table in model.WAREHOUSE.items():
        read = loaded[1].read(name).schema
        assert [(f.name, f.dataType) for f in read] == [(f.name, f.dataType) for f in table.schema()]


def test_loaded_values(loaded):
    zone, sink = loaded
    codes = {r.stock_code: r.industry_code for r in sink.read("dim_enterprise").collect()}
    assert codes == {"ACB": "6419", "GAS": "0620"}
    acb = sink.read("fact_financial_ratio").where("stock_code = 'ACB'").first()
    assert (float(acb.net_margin), float(acb.roe), float(acb.eps)) == (0.3333, 0.25, 3.0)
    assert acb.report_period == "Q1/2024"
    ids = sorted(r.price_id for r in sink.read("fact_price_history").collect())
    assert ids == [1, 2, 3]


def test_loaded_tables_satisfy_the_contract(loaded):
    tables = {name: loaded[1].read(name) for name in model.WAREHOUSE}
    assert quality.warehouse_violations(tables).count() == 0


def test_seeded_faults_are_reported(loaded, rows):
    tables = {name: loaded[1].read(name) for name in model.WAREHOUSE}
    price = tables["fact_price_history"]
    bad = price.where("price_id = 1")
    tables["fact_price_history"] = price.union(bad).union(bad.withColumn("stock_code", F.lit("UNKNOWN_CODE")))
    assert rows(quality.warehouse_violations(tables)) == [
        ("length", "fact_price_history", "stock_code", 1),
        ("reference", "fact_price_history", "stock_code", 1),
        ("unique", "fact_price_history", "stock_code,trade_date", 1),
    ]


def test_repeated_loads(loaded):
    zone, sink = loaded
    jobs.load_financials(zone, sink, merge_ratios=False)  # overwrites, and keeps both rows of a quarter
    assert sink.read("fact_financial_ratio").count() == 3
    assert sink.read("fact_price_history").count() == 3
    before = {t: sorted(map(tuple, sink.read(t).drop("updated_at", "created_at").collect())) for t in ("fact_subsidiary", "dim_industry")}
    jobs.load_subsidiaries(zone, sink)  # the same files: the load replaces itself
    jobs.load_industry(zone, sink)
    after = {t: sorted(map(tuple, sink.read(t).drop("updated_at", "created_at").collect())) for t in before}
    assert after == before
    other = sink.read("fact_subsidiary").drop("sub_id")
    sink.write(other, "fact_subsidiary")  # a load of its own: appends, ids go on
    assert sorted(r.sub_id for r in sink.read("fact_subsidiary").collect()) == [1, 2, 3, 4]
    sparse = replace(sink, dense_ids=False)
    sparse.write(other.limit(2), "fact_subsidiary")
    ids = [r.sub_id for r in sink.read("fact_subsidiary").collect()]
    assert len(ids) == len(set(ids)) == 6 and min(sorted(ids)[4:]) > 4
    sink.initialise()
    assert sink.read("fact_subsidiary").count() == 0


def test_documents_are_landed_for_the_load_jobs(spark, tmp_path, rows):
    zone = LandingZone(spark, str(tmp_path))
    table = "<table><tr><td>A</td><td></td><td></td><td>0111</td><td></td><td>Lúa</td></tr></table>"
    jobs.land_industries(zone, spark.createDataFrame([(1, table)], "page_id bigint, html string"))
    profile = '<h1 class="h1-title">Á Châu (ACB)</h1><div id="thanh-lap-cong-ty"><table><tr><td>• Mã số thuế</td><td>03</td></tr></table></div>'
    jobs.land_enterprises(zone, spark.createDataFrame([("ACB", profile)], "code string, html string"))
    reply = '{"Success": true, "Data": {"Subsidiaries": [{"Name": "ACBS", "TotalCapital": 5, "OwnershipRate": 100}]}}'
    jobs.land_subsidiaries(zone, spark.createDataFrame([("ACB", reply)], "symbol string, json string"))
    scans = {
        "industries": raw.read_industries(zone),
        "enterprise": raw.read_enterprises(zone),
        "subsidiaries": raw.read_subsidiaries(zone),
    }
    assert rows(scans["industries"]) == [("A", "0111", "Lúa")]
    assert rows(scans["enterprise"], "code", "company_name", "tax_code") == [("ACB", "Á Châu", "03")]
    assert rows(scans["subsidiaries"], "stock_code", "comp_name", "comp_type") == [("ACB", "ACBS", "sub")]


def test_texts_of_pages_survive_landing(spark, tmp_path, rows):
    zone = LandingZone(spark, str(tmp_path))
    address = "12 Lane\n\"Hanoi\", Đống Đa"
    profile = f'<h1 class="h1-title">A (ACB)</h1><div id="thanh-lap-cong-ty"><table><tr><td>• Địa chỉ</td><td>{address}</td></tr></table></div>'
    jobs.land_enterprises(zone, spark.createDataFrame([("ACB", profile)], "code string, html string"))
    assert rows(raw.read_enterprises(zone), "code", "address") == [("ACB", address)]


def test_every_fault_is_rejected_or_reported(spark, tmp_path):
    zone = LandingZone(spark, str(tmp_path))
    officers = (
        "id,officer_name,officer_position,quantity,officer_own_percent,update_date,stock_code\n"
        f"1,A,Chair,100,0.5,2024-06-30,ACB\n2,B,{'x' * 300},1,0.5,2024-06-30,ACB\n3,C,Chair,many,0.5,2024-13-01,ACB\n"
        ",D,Chair,1,0.5,2024-06-30,ACB\n5,E,Chair,1,99999.5,2024-06-30,GAS\n6,F,Chair,1,0.5,2024-06-30,A_CODE_TOO_LONG\n"
        "1,A,Chair,100,0.5,2024-06-30,ACB\n"
    )
    path = tmp_path / model.LANDED_PATHS["leadership"]
    path.parent.mkdir(parents=True)
    path.write_text(officers, encoding="utf-8")
    sink = jobs.scratch_warehouse(spark)
    companies = spark.createDataFrame([("ACB",), ("GAS",)], ["stock_code"])
    sink.write(companies, "dim_enterprise")
    report = jobs.load_leadership(zone, sink)
    assert report.rows == {"dim_holder_info": 5, "fact_ownership": 3}
    assert report.rejects == {"dim_holder_info": 1, "fact_ownership": 4}
    assert report.unreadable == {("leadership", "quantity"): 1, ("leadership", "update_date"): 1}
    kept = zone.read_dataframe("rejects", "fact_ownership", "json").collect()
    assert sorted(r.faults for r in kept) == [
        "holder_id: missing", "ownership_ratio: out of range", "position: too long", "stock_code: too long",
    ]
    assert json.loads(next(r.record for r in kept if r.faults.startswith("own")))["stock_code"] == "GAS"
    tables = {name: sink.read(name) for name in model.WAREHOUSE}
    assert quality.warehouse_violations(tables).collect() == []

    # Rejects are kept per load: another load adds its own, the same one replaces them, a clean one removes none.
    path.write_text(officers + "7,G,Chair,1,0.5,2024-06-30,NONE\n", encoding="utf-8")
    for _ in range(2):
        report = jobs.load_leadership(zone, sink)
        assert report.rejects == {"dim_holder_info": 6, "fact_ownership": 5}  # holders are known, NONE is no company
    path.write_text("id,officer_name,officer_position,quantity,officer_own_percent,update_date,stock_code\n9,Z,CEO,1,0.5,2024-06-30,GAS\n")
    assert jobs.load_leadership(zone, sink).rejects == {}
    kept = zone.read_dataframe("rejects", "fact_ownership", "json").collect()
    assert len(kept) == 9 and len({r.load_id for r in kept}) == 2
    assert [json.loads(r.record)["holder_id"] for r in kept if r.faults == "stock_code: not in dim_enterprise"] == ["NONE_7"]
    assert sink.read("fact_ownership").where("stock_code = 'NONE'").isEmpty()


def test_keys_are_unique_in_the_batch_and_against_the_table(spark):
    sink = jobs.scratch_warehouse(spark)
    schema = "industry_code string, industry_group string, industry_name string"
    first = [("1", "A", "x"), ("1", "A", "w"), ("1", "A", "w"), ("2", "B", None), (None, "C", "y"), ("3", None, "z")]
    checked = gate.gated(spark.createDataFrame(first, schema), model.DIM_INDUSTRY, {}).collect()
    assert sorted((r.industry_code or "", r.industry_name or "", *r.faults) for r in checked) == [
        ("", "y", "industry_code: missing"), ("1", "w"), ("1", "w", "industry_code: repeated"),
        ("1", "x", "industry_code: repeated"), ("2", ""), ("3", "z"),
    ]
    good = [r for r in checked if not r.faults]
    sink.write(spark.createDataFrame(good, schema + ", faults array<string>"), "dim_industry", load_id="first")
    second = spark.createDataFrame([("3", "q", "q"), ("4", "q", "q"), ("4", "p", "q")], schema)
    checked = gate.gated(second, model.DIM_INDUSTRY, {}, sink.others("dim_industry", "second")).collect()
    assert sorted((r.industry_code, r.industry_group, *r.faults) for r in checked) == [
        ("3", "q", "industry_code: already loaded"), ("4", "p"), ("4", "q", "industry_code: repeated"),
    ]
    nothing = second.limit(0)
    assert gate.gated(nothing, model.DIM_INDUSTRY, {}, sink.read("dim_industry")).collect() == []


def test_null_keys_never_clash(spark):
    rows = spark.createDataFrame([("A", None, 1), ("A", None, 1), ("A", 2020, 1), ("A", 2020, 1)], "stock_code string, year int, quarter int")
    checked = gate.gated(rows, model.FACT_RATIO, {"dim_enterprise": rows.select("stock_code")}).collect()
    assert sorted(len(r.faults) for r in checked) == [0, 0, 0, 1]


def test_a_hot_key_is_ranked_by_partial_minima(spark):
    """A third of the rows share a key; no window ranks them in one task."""
    rows = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, 'HOT', concat('C', id)) AS industry_code", "'G' AS industry_group", "cast(id AS string) AS industry_name"
    )
    checked = gate.gated(rows, model.DIM_INDUSTRY, {})
    assert "Window" not in checked._jdf.queryExecution().executedPlan().toString()
    assert checked.where("size(faults) = 0").count() == 20_001
    assert checked.where("size(faults) = 0 and industry_code = 'HOT'").first().industry_name == "0"


def test_a_write_that_dies_leaves_the_rows_of_before(spark, loaded_folder):
    sink = jobs.scratch_warehouse(spark)
    schema = "industry_code string, industry_name string"
    sink.write(spark.createDataFrame([("1", "a")], schema), "dim_industry", "overwrite")
    broken = spark.range(100, numPartitions=4).selectExpr("cast(id AS string) AS industry_code", "if(id = 99, raise_error('lost'), 'x') AS industry_name")
    with pytest.raises(RuntimeError, match="dim_industry"):
        sink.write(broken, "dim_industry", "overwrite")
    assert [r.industry_code for r in sink.read("dim_industry").collect()] == ["1"]
    for n in ("2", "3", "4"):  # versions that nothing points to are pruned
        sink.write(spark.createDataFrame([(n, "a")], schema), "dim_industry", "overwrite")
    assert [r.industry_code for r in sink.read("dim_industry").collect()] == ["4"]
    assert len(list(Path(f"{sink.location}/dim_industry".removeprefix("file:")).glob("all-*"))) == 2


def test_ids_survive_a_reload(spark):
    sink = replace(jobs.scratch_warehouse(spark), dense_ids=True)
    schema = "stock_code string, year int, quarter int, pe double"
    sink.write(spark.createDataFrame([("A", 2020, 1, 1.0), ("B", 2020, 1, 1.0), ("C", None, 1, 1.0)], schema), "fact_financial_ratio", "overwrite")
    ids = {r.stock_code: r.ratio_id for r in sink.read("fact_financial_ratio").collect()}
    sink.write(spark.createDataFrame([("B", 2020, 1, 9.0), ("0", 2020, 1, 9.0)], schema), "fact_financial_ratio", "overwrite")
    sink.write(spark.createDataFrame([("A", 2020, 1, 9.0), ("B", 2020, 1, 7.0), ("0", 2020, 1, 7.0)], schema), "fact_financial_ratio", "overwrite")
    again = {r.stock_code: r.ratio_id for r in sink.read("fact_financial_ratio").collect()}
    assert again == {"A": ids["A"], "B": ids["B"], "0": 4} and sorted(ids.values()) == [1, 2, 3]


@pytest.fixture
def loaded_folder(spark, tmp_path):
    for name, text in {**{model.LANDED_PATHS[k]: v for k, v in RAW.items()},
                       jobs.MAP_PATH: "code,tax_code,industry_code\nACB,0301452948,6419\nGAS,3500102710,0620\n"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text, encoding="utf-8")
    return tmp_path


def test_a_failed_branch_alone_is_repeated(spark, loaded_folder):
    zone, sink = LandingZone(spark, str(loaded_folder)), jobs.scratch_warehouse(spark)
    enterprise = loaded_folder / model.LANDED_PATHS["enterprise"]
    held = enterprise.read_text(encoding="utf-8")
    enterprise.unlink()
    with pytest.raises(Exception):
        jobs.load_warehouse(zone, sink)
    assert sink.read("dim_industry").count() == 2 and sink.read("dim_date").count() == 3  # they don't wait for companies
    assert sink.read("fact_subsidiary").count() == 0
    enterprise.write_text(held, encoding="utf-8")
    report = jobs.load_warehouse(zone, sink, resume=True)
    assert report.skipped == ["industry"] and "dim_industry" not in report.rows
    assert {name: sink.read(name).count() for name in model.WAREHOUSE} == SIZES and report.violations == []
    report = jobs.load_warehouse(zone, sink, resume=True)
    assert sorted(report.skipped) == sorted(jobs.JOBS) and report.rows == {}
    assert sink.spark.table(sink.qualified("load_ledger")).count() == 8  # one line per file read
