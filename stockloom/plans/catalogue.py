"""Registered queries: every one reads whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom import model
from stockloom.functions.columns import safe_div, usable_key
from stockloom.functions.diacritics import strip_diacritics
from stockloom.model import DIM_ENTERPRISE, FACT_OWNERSHIP, FACT_PRICE, Reference
from stockloom.operators import dimensions, extract, gate, prices, quality, ratios, statements, unions
from stockloom.operators import normalize, universe
from stockloom.operators.carry import carry_forward
from stockloom.operators.surrogate import with_surrogate_keys
from stockloom.plans import jobs, shapes
from stockloom.plans.shapes import table
from stockloom.sources.landing import LandingZone, scan_csv
from stockloom.sources.raw import scan_landed
from stockloom.sources.scan import Scan, scan_files
from stockloom.sources.scratch import scratch_path
from stockloom.sources.warehouse import CatalogSink

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- prices, statements, ratios -------------------------------------------------


class _Financials:
    """Raw inputs cut from one pass over the line items, staged where prices need it again."""

    def __init__(self, spark: SparkSession, sf_dir: str, staged: bool = True):
        self.spark, self.sf_dir = spark, sf_dir
        sales = (shapes.staged_sales if staged else shapes.quarterly_sales)(spark, sf_dir)
        self.income = normalize.normalize_statement(shapes.raw_income(sales), drop_empty=False)
        self.balance = normalize.normalize_statement(shapes.raw_balance(sales), drop_empty=False)

    def report(self) -> DataFrame:
        return statements.financial_report(self.income, self.balance)

    def price_fact(self) -> DataFrame:
        quotes = normalize.normalize_prices(shapes.raw_prices(self.spark, self.sf_dir))
        return prices.price_history(quotes, self.balance)

    def merged(self, names: tuple[str, ...] = ratios.ALL_RATIOS) -> DataFrame:
        report = statements.merged_report(self.report())
        return ratios.financial_ratio(report, self.price_fact(), names)


@query
def fact_financial_ratio(spark, sf_dir):
    inputs = _Financials(spark, sf_dir)
    return ratios.financial_ratio(inputs.report(), inputs.price_fact())


@query
def fact_financial_ratio_merged(spark, sf_dir):
    return _Financials(spark, sf_dir).merged()


@query
def ratio_net_margin(spark, sf_dir):
    return _Financials(spark, sf_dir, staged=False).merged(ratios.MARGIN)


@query
def ratio_returns(spark, sf_dir):
    return _Financials(spark, sf_dir, staged=False).merged(ratios.RETURNS)


@query
def ratio_per_share(spark, sf_dir):
    return _Financials(spark, sf_dir).merged(ratios.PER_SHARE)


@query
def ratio_valuation(spark, sf_dir):
    return _Financials(spark, sf_dir).merged(ratios.VALUATION)


@query
def safe_division(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    key = F.col("l_partkey")
    weight = F.when(key % 7 == 0, F.lit(0.0)).when(key % 11 != 0, F.col("l_quantity"))
    return line.select(
        "l_orderkey", "l_partkey", "l_suppkey",
        safe_div(F.col("l_extendedprice"), weight).alias("quotient"),
    )


@query
def fact_price_history(spark, sf_dir):
    return _Financials(spark, sf_dir).price_fact()


@query
def outstanding_shares(spark, sf_dir):
    sales = shapes.quarterly_sales(spark, sf_dir)
    balance = normalize.normalize_statement(shapes.raw_balance(sales), drop_empty=False)
    return statements.outstanding_shares(balance)


@query
def price_normalized(spark, sf_dir):
    return normalize.normalize_prices(shapes.raw_prices(spark, sf_dir))


@query
def quarter_end_price(spark, sf_dir):
    return prices.quarter_end_price(_Financials(spark, sf_dir).price_fact())


@query
def income_normalized(spark, sf_dir):
    return normalize.normalize_statement(shapes.raw_income(shapes.staged_sales(spark, sf_dir)))


@query
def balance_normalized(spark, sf_dir):
    return normalize.normalize_statement(shapes.raw_balance(shapes.staged_sales(spark, sf_dir)))


@query
def statement_income(spark, sf_dir):
    sales = shapes.quarterly_sales(spark, sf_dir)
    return statements.statement_income(
        normalize.normalize_statement(shapes.raw_income(sales), drop_empty=False)
    )


@query
def statement_balance(spark, sf_dir):
    sales = shapes.quarterly_sales(spark, sf_dir)
    return statements.statement_balance(
        normalize.normalize_statement(shapes.raw_balance(sales), drop_empty=False)
    )


@query
def fact_financial_report(spark, sf_dir):
    return _Financials(spark, sf_dir).report()


@query
def drop_empty_columns(spark, sf_dir):
    return normalize.drop_empty_columns(shapes.raw_balance(shapes.staged_sales(spark, sf_dir)))


@query
def nonnull_counts(spark, sf_dir):
    counts = normalize.nonnull_counts(shapes.raw_balance(shapes.quarterly_sales(spark, sf_dir)))
    return counts.toDF(*[c.replace(".", "_") for c in counts.columns])


# --- dimensions -----------------------------------------------------------------


@query
def dim_date(spark, sf_dir):
    days = F.col("o_orderdate").cast("date").alias("trade_date")
    return dimensions.dim_date(table(spark, sf_dir, "orders").select(days))


@query
def scan_industry(spark, sf_dir):
    zone = LandingZone(spark, scratch_path(spark, "industry"))
    path = zone.save_dataframe(
        shapes.industries(spark, sf_dir), "industries", "industries_list", "csv"
    )
    return scan_csv(spark, path, model.RAW_INDUSTRY)


@query
def enterprise_enriched(spark, sf_dir):
    return dimensions.enterprise_enriched(
        shapes.enterprise(spark, sf_dir), shapes.industry_map(spark, sf_dir)
    )


@query
def dim_holder(spark, sf_dir):
    return dimensions.dim_holder(shapes.leadership(spark, sf_dir))


@query
def fact_ownership(spark, sf_dir):
    return dimensions.fact_ownership(shapes.leadership(spark, sf_dir))


@query
def fact_subsidiary(spark, sf_dir):
    return dimensions.fact_subsidiary(shapes.subsidiaries(spark, sf_dir))


# --- lists, unions, keys --------------------------------------------------------


@query
def ticker_universe(spark, sf_dir):
    names = table(spark, sf_dir, "nation").select(F.col("n_name").alias("stock_code"))
    segments = table(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    return universe.ticker_universe([names, segments])


@query
def filter_universe(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").where("n_regionkey IN (1, 3)").select("n_nationkey")
    return universe.filter_universe(table(spark, sf_dir, "customer"), nations, "c_nationkey")


@query
def filter_universe_limit(spark, sf_dir):
    """Orders as a listing of a hundred pages; stops once enough listed customers came up."""
    listed = table(spark, sf_dir, "customer").where("c_mktsegment = 'MACHINERY'").select("c_custkey")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", (F.col("o_orderkey") % 100 + 1).alias("page")
    )
    return universe.take_until_found(rows, listed, "o_custkey", "page")


@query
def union_tagged_sources(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderpriority").alias("priority"),
    )
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), "value", "event_type", "user_id"
    )
    empty = spark.createDataFrame([], orders.schema)
    sources = {"orders": orders, "events": events, "none": None, "empty": empty}
    return unions.union_tagged(sources, "source")


@query
def clean_keys(spark, sf_dir):
    key = F.col("c_custkey")
    code = F.when(key % 6 == 0, "nan").when(key % 6 != 1, F.col("c_name"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", code.alias("tax_code"))
    return customers.where(usable_key(F.col("tax_code")))


@query
def forward_fill_label(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id",
        "event_id",
        F.when(F.col("event_type") == "signup", F.get_json_object("props", "$.k")).alias("label"),
    )
    return carry_forward(events, "label", "group_label", ["user_id"], "event_id")


@query
def surrogate_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return with_surrogate_keys(orders, "order_id", ["o_orderkey"])


# --- quality --------------------------------------------------------------------


@query
def check_not_null(spark, sf_dir):
    return quality.check_not_null(shapes.ownership_with_faults(spark, sf_dir), FACT_OWNERSHIP)


@query
def check_lengths(spark, sf_dir):
    return quality.check_lengths(shapes.ownership_with_faults(spark, sf_dir), FACT_OWNERSHIP)


@query
def check_decimal_range(spark, sf_dir):
    return quality.check_decimal_range(shapes.ownership_with_faults(spark, sf_dir), FACT_OWNERSHIP)


@query
def check_unique_keys(spark, sf_dir):
    """Trade days per customer group: several orders share a day, so the key clashes."""
    trades = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_custkey") % 23 != 0, F.concat(F.lit("C"), (F.col("o_custkey") % 40).cast("string")))
        .alias("stock_code"),
        F.col("o_orderdate").cast("date").alias("trade_date"),
    )
    companies = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("stock_code"))
    return quality.check_unique_keys(trades, FACT_PRICE).unionByName(
        quality.check_unique_keys(companies, DIM_ENTERPRISE)
    )


@query
def duplicate_line_keys(spark, sf_dir):
    return quality.duplicate_keys(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query
def check_foreign_keys(spark, sf_dir):
    """Orders and suppliers against their parents, with a seeded set of orphans."""
    key = F.col("o_custkey")
    orders = table(spark, sf_dir, "orders").select(
        F.when(key % 97 == 0, key + 1_000_000_000_000).otherwise(key).alias("o_custkey")
    )
    nation = F.col("s_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select(
        F.when(F.col("s_suppkey") % 8 == 3, nation + 100).when(F.col("s_suppkey") % 8 != 4, nation)
        .alias("s_nationkey")
    )
    parents = {
        "customer": table(spark, sf_dir, "customer"),
        "nation": table(spark, sf_dir, "nation"),
    }
    return quality.check_foreign_keys(
        orders, "orders", [Reference("o_custkey", "customer", "c_custkey")], parents
    ).unionByName(
        quality.check_foreign_keys(
            suppliers, "supplier", [Reference("s_nationkey", "nation", "n_nationkey")], parents
        )
    )


# --- pages and payloads ---------------------------------------------------------


@query
def industry_rows(spark, sf_dir):
    return extract.industry_rows(shapes.classification_pages(spark, sf_dir))


@query
def page_profile(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    titled = extract.page_titles(pages, title=("h1", None), english=("title", None))
    return titled.select("page_id", "company_name", "company_eng_name")


@query
def page_links(spark, sf_dir):
    return extract.company_links(shapes.listing_pages(spark, sf_dir))


@query
def kv_section(spark, sf_dir):
    return extract.key_value_profile(shapes.profile_pages(spark, sf_dir)).drop("html")


@query
def enterprise_profile(spark, sf_dir):
    code = F.concat_ws("-", "conv_id", "turn").alias("code")
    return extract.enterprise_profile(shapes.profile_pages(spark, sf_dir).select(code, "html"))


@query
def subsidiary_rows(spark, sf_dir):
    return extract.subsidiary_rows(shapes.payloads(spark, sf_dir), contributed=True)


@query
def list_with_fallback(spark, sf_dir):
    return extract.second_cells(shapes.code_list_pages(spark, sf_dir))


@query
def extract_code(spark, sf_dir):
    coded = extract.classification_code(shapes.tax_pages(spark, sf_dir), "tax_code")
    return coded.select("page_id", "tax_code", "industry_code")


def _plain_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", strip_diacritics(F.col("text")).alias("plain")
    )


QUERIES["strip_diacritics"] = _plain_text


# --- landing and warehouse ------------------------------------------------------


def _roundtrip(spark: SparkSession, sf_dir: str, file_format: str, partitioned: bool = False):
    orders = table(spark, sf_dir, "orders")
    zone = LandingZone(spark, scratch_path(spark, f"landing-{file_format}"))
    if partitioned:
        zone.save_dataframe(orders, "raw/orders", partition_cols=["o_orderstatus"])
        return zone.read_dataframe("raw/orders").select(*orders.columns)
    zone.save_dataframe(orders, "raw/orders", "orders", file_format)
    return zone.read_dataframe("raw/orders", "orders", file_format, orders.schema)


@query
def landing_roundtrip_parquet(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "parquet", partitioned=True)


@query
def landing_roundtrip_csv(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "csv")


@query
def landing_roundtrip_json(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "json")


def _landed_texts(spark: SparkSession, sf_dir: str, file_format: str) -> DataFrame:
    """Turns with line breaks and outer blanks, some empty or null, and times to the microsecond."""
    key = F.col("conv_id") * 1000 + F.col("turn")
    text = F.when(key % 7 == 0, "").when(key % 11 != 0, F.concat(F.lit(" "), "text", F.lit("\n ")))
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", text.alias("text"), F.timestamp_micros(key * 1_234_567).cast("timestamp_ntz").alias("at")
    )
    zone = LandingZone(spark, scratch_path(spark, f"landing-{file_format}"))
    zone.save_dataframe(turns, "raw/turns", "turns", file_format)
    return zone.read_dataframe("raw/turns", "turns", file_format, turns.schema, multiline=True)


@query
def landing_roundtrip_csv_text(spark, sf_dir):
    return _landed_texts(spark, sf_dir, "csv")


@query
def landing_roundtrip_json_text(spark, sf_dir):
    return _landed_texts(spark, sf_dir, "json")


@query
def landing_roundtrip_partition_keys(spark, sf_dir):
    code = F.lpad(F.col("s_nationkey").cast("string"), 4, "0")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", code.alias("nation_code"))
    zone = LandingZone(spark, scratch_path(spark, "landing-keys"))
    zone.save_dataframe(suppliers, "raw/suppliers", partition_cols=["nation_code"])
    return zone.read_dataframe("raw/suppliers")


@query
def landed_enterprise_profile(spark, sf_dir):
    """Profiles of pages, landed and read again: equal to those extracted."""
    zone = LandingZone(spark, scratch_path(spark, "landing-pages"))
    code = F.concat_ws("-", "conv_id", "turn").alias("code")
    jobs.land_enterprises(zone, shapes.profile_pages(spark, sf_dir).select(code, "html"))
    return scan_landed(zone, "enterprise")


@query
def load_rejects(spark, sf_dir):
    """Rows that the contract refuses, by what is wrong with them."""
    bad = quality.rejected(shapes.ownership_with_faults(spark, sf_dir), FACT_OWNERSHIP)
    return bad.groupBy("table_name", "faults").agg(F.count("*").alias("rejected"))


def _ragged(spark: SparkSession, sf_dir: str) -> Scan:
    path = scratch_path(spark, "ragged")
    shapes.write_lines(shapes.ragged_orders(spark, sf_dir), path)
    return scan_files(spark, path)


@query
def scan_rejects(spark, sf_dir):
    """Records with more or fewer cells than their header."""
    return _ragged(spark, sf_dir).rejects().select("record", "expected", "found")


@query
def scan_sound_rows(spark, sf_dir):
    """The other records of the same files."""
    return _ragged(spark, sf_dir).rows()


@query
def scan_mixed_headers(spark, sf_dir):
    """Files with their columns in another order, and one column less, as one table with a tag from the path."""
    zone = LandingZone(spark, scratch_path(spark, "mixed"))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    zone.save_dataframe(suppliers.where("s_suppkey % 2 = 0"), "raw", "EVEN", "csv")
    zone.save_dataframe(suppliers.where("s_suppkey % 2 = 1").select("s_name", "s_suppkey"), "raw", "ODD", "csv")
    found = scan_files(spark, [zone.path("raw/EVEN.csv"), zone.path("raw/ODD.csv")], tags={"source": r"/([A-Z]+)\.csv/"})
    return found.rows()


@query
def load_key_rejects(spark, sf_dir):
    """Prices that repeat a key of their batch or of the loaded table."""
    batch, existing = shapes.price_batches(spark, sf_dir)
    return _refused(gate.gated(batch, model.FACT_PRICE, {}, existing), "stock_code", "trade_date", "volume")


@query
def load_orphan_rejects(spark, sf_dir):
    """Ownership rows of unknown companies or holders."""
    rows, companies, holders = shapes.stakes_with_orphans(spark, sf_dir)
    parents = {"dim_enterprise": companies, "dim_holder_info": holders}
    return _refused(gate.gated(rows, FACT_OWNERSHIP, parents), "stock_code", "holder_id", "shares_count")


def _refused(checked: DataFrame, *columns: str) -> DataFrame:
    return checked.where(F.size("faults") > 0).select(*columns, F.array_join("faults", "; ").alias("faults"))


def _loaded(spark: SparkSession, sf_dir: str, names: list[str], times: int = 1, **options) -> CatalogSink:
    """A warehouse loaded from landed copies of the shapes, by these jobs, anew for each query.

    The shapes' codes come from tables that don't refer to each other, so references aren't enforced here.
    """
    zone = LandingZone(spark, scratch_path(spark, "lake"))
    jobs.land_shapes(zone, sf_dir, names)
    sink = jobs.scratch_warehouse(spark)
    for _ in range(times):
        jobs.load_warehouse(zone, sink, jobs=names, references=False, **options)
    return sink


def _contract_columns(name: str) -> list[str]:
    """Columns of a table without surrogate ids and load times."""
    return [f.name for f in model.WAREHOUSE[name].fields if not f.surrogate and f.default not in ("now", "today")]


def _register_loaded(name: str) -> None:
    """A query for a loaded table, by the job that loads it."""
    names, columns = [jobs.job_of(name)], _contract_columns(name)
    QUERIES[f"loaded_{name}"] = lambda spark, sf_dir: (
        _loaded(spark, sf_dir, names, verify=False, tables=[name]).read(name).select(*columns)
    )


for _name in model.WAREHOUSE:
    _register_loaded(_name)


@query
def loaded_twice_dim_industry(spark, sf_dir):
    """A load that is repeated for the same files."""
    sink = _loaded(spark, sf_dir, ["industry"], times=2, verify=False)
    return sink.read("dim_industry").select(*_contract_columns("dim_industry"))


@query
def surrogate_keys_reloaded(spark, sf_dir):
    """Ids of prices that are loaded, and loaded again with other measures and further keys."""
    sink = replace(jobs.scratch_warehouse(spark), dense_ids=True)
    first, second = shapes.price_reload(spark, sf_dir)
    sink.write(first, "fact_price_history", "overwrite")
    sink.write(second, "fact_price_history", "overwrite")
    return sink.read("fact_price_history").select("price_id", "stock_code", "trade_date", "volume")


@query
def warehouse_tables(spark, sf_dir):
    """All load jobs on landed copies of the shapes; rows and columns of each table."""
    sink = _loaded(spark, sf_dir, list(jobs.JOBS))
    lines = [
        sink.read(name).agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"),
            F.lit(len(contract.fields)).alias("column_count"),
            "row_count",
        )
        for name, contract in model.WAREHOUSE.items()
    ]
    result = lines[0]
    for line in lines[1:]:
        result = result.unionByName(line)
    return result
