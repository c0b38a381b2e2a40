"""Driver tables reshaped like the raw inputs of the warehouse.

Each function reads whole tables. Facts are reduced to one row per supplier and
quarter, or per nation and day, before they meet the next table.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom import model
from stockloom.sources.scratch import stage

BLANK_HEADER = "Ghi chú.trống"  # an always empty column, with a dot in its name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily quotes, in thousands, of each nation's orders."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("time")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    daily = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "time")
        .agg(
            F.min_by("o_totalprice", "o_orderkey").alias("open"),
            F.max("o_totalprice").alias("high"),
            F.min("o_totalprice").alias("low"),
            F.max_by("o_totalprice", "o_orderkey").alias("close"),
            F.count("*").alias("volume"),
        )
    )
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("ticker")
    )
    return daily.join(nations, "c_nationkey").select(
        "ticker",
        "time",
        *[(F.col(c) / 1000).alias(c) for c in ("open", "high", "low", "close")],
        "volume",
    )


def quarterly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact sums of line items per nation and ship quarter.

    Money is added up in whole cents, and net sales in hundredths of a cent, per
    supplier and quarter; decimals take over where suppliers are added up. A bigint
    holds over twenty billion average line items of one supplier and quarter, and a
    sum beyond it fails instead of wrapping around.
    """
    cents = F.rint(F.col("l_extendedprice") * 100).cast("long")
    line = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.year("l_shipdate").alias("year"),
        F.quarter("l_shipdate").alias("quarter"),
        cents.alias("cents"),
        (cents * (100 - F.rint(F.col("l_discount") * 100).cast("long"))).alias("net"),
        F.rint(F.col("l_quantity") * 100).cast("long").alias("quantity"),
        "l_returnflag",
        "l_linestatus",
    )

    def where(column: str, value: str) -> Column:
        return F.sum(F.when(F.col(column) == value, F.col("cents")).otherwise(0))

    per_supplier = line.groupBy("l_suppkey", "year", "quarter").agg(
        F.sum("net").alias("net_sales"),
        F.sum("cents").alias("gross_sales"),
        F.sum("quantity").alias("units"),
        where("l_returnflag", "A").alias("flag_a"),
        where("l_returnflag", "R").alias("flag_r"),
        where("l_linestatus", "O").alias("status_o"),
        where("l_linestatus", "F").alias("status_f"),
    )
    units = {c: "0.01" for c in ("gross_sales", "units", "flag_a", "flag_r", "status_o", "status_f")}
    units["net_sales"] = "0.0001"

    def total(name: str, unit: str) -> Column:
        whole = F.sum(F.col(name).cast("decimal(20,0)"))
        return (whole * F.lit(Decimal(unit))).cast(model.MONEY).alias(name)

    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    per_nation = (
        per_supplier.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", "year", "quarter")
        .agg(*[total(name, unit) for name, unit in units.items()])
    )
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("ticker")
    )
    return per_nation.join(nations, "s_nationkey").withColumnRenamed("s_nationkey", "nation")


def raw_income(sales: DataFrame) -> DataFrame:
    """Income statements: banks, gross-only companies and gaps included."""
    nation = F.col("nation")
    bank, gross_only = nation % 5 == 0, nation % 5 == 1
    result = F.col("flag_a") - F.col("flag_r")
    operating = F.col("status_o") - F.col("status_f")
    headers = {
        model.NET_REVENUE: F.when(~bank & ~gross_only, F.col("net_sales")),
        model.GROSS_REVENUE: F.when(gross_only, F.col("gross_sales")),
        model.NET_INTEREST_INCOME: F.when(bank, F.col("net_sales")),
        model.NET_FEE_INCOME: F.when(bank & (nation % 2 == 0), F.col("units")),
        model.COST_OF_GOODS: -F.col("status_f"),
        model.GROSS_PROFIT: F.when(nation % 2 == 0, F.col("status_o")),
        model.OPERATING_PROFIT_HEADERS[0]: F.when(nation % 3 == 0, operating),
        model.OPERATING_PROFIT_HEADERS[1]: F.when(nation % 3 == 1, operating),
        model.NET_PROFIT_HEADERS[0]: F.when(nation % 4 == 0, result),
        model.NET_PROFIT_HEADERS[2]: F.when(nation % 4 == 1, result),
        model.NET_PROFIT_HEADERS[3]: F.when(nation % 4 == 2, result),
    }
    return sales.select(
        "ticker",
        F.col("ticker").alias("CP"),
        F.col("year").alias("Năm"),
        F.col("quarter").alias("Kỳ"),
        F.lit("income_statement").alias("report_type"),
        *[value.alias(header) for header, value in headers.items()],
        F.lit(None).cast("double").alias(BLANK_HEADER),
    )


def raw_balance(sales: DataFrame) -> DataFrame:
    """Balance sheets; every seventh nation files none in its second quarters."""
    nation = F.col("nation")
    values = {
        "total_assets": F.col("gross_sales"),
        "total_equity": F.when(nation % 9 != 4, F.col("flag_a")),
        "total_liabilities": F.col("flag_r"),
        "short_term_debt": F.col("status_o"),
        "long_term_debt": F.col("status_f"),
    }
    filed = sales.where(~((nation % 7 == 0) & (F.col("quarter") == 2)))
    return filed.select(
        F.col("ticker").alias("CP"),
        F.col("year").cast("string").alias("Năm"),
        F.col("quarter").cast("string").alias("Kỳ"),
        F.lit("balance_sheet").alias("report_type"),
        *[values[m].alias(header) for m, header in model.BALANCE_HEADERS.items()],
        (F.col("units") * 10000).cast(model.MONEY).alias(model.CONTRIBUTED_CAPITAL),
        F.lit(None).cast("double").alias(BLANK_HEADER),
    )


def staged_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly sums, written once: several statements are cut from them."""
    return stage(quarterly_sales(spark, sf_dir), "sales")


def leadership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Officer rows: many reports per person, some without a date."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("stock_code")
    )
    people = customers.join(nations, "c_nationkey")
    reports = orders.join(people, F.col("o_custkey") == F.col("c_custkey"))
    dated = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderdate").cast("date"))
    return reports.select(
        "stock_code",
        F.col("c_custkey").cast("string").alias("id"),
        F.concat_ws(" ", "c_name", "o_orderpriority").alias("officer_name"),
        F.col("o_orderpriority").alias("officer_position"),
        F.col("o_orderkey").alias("quantity"),
        (F.col("o_totalprice") / 10000).alias("officer_own_percent"),
        dated.alias("update_date"),
    )


def _padded(key: Column, width: int = 10) -> Column:
    text = key.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def enterprise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company profiles keyed by supplier, some with unusable listing dates."""
    key = F.col("s_suppkey")
    day = F.date_add(F.lit("2000-01-01").cast("date"), (key % 3000).cast("int"))
    printed = (
        F.when(key % 13 == 0, "31/02/2024")
        .when(key % 17 == 0, "")
        .when(key % 19 != 0, F.date_format(day, "dd/MM/yyyy"))
    )
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), key.cast("string")).alias("code"),
        F.col("s_name").alias("company_name"),
        F.upper("s_name").alias("company_eng_name"),
        _padded(key).alias("tax_code"),
        F.concat(F.lit("No. "), key.cast("string"), F.lit(", Hà Nội")).alias("address"),
        F.concat(F.lit("info@s"), key.cast("string"), F.lit(".example")).alias("email"),
        F.concat(F.lit("https://s"), key.cast("string"), F.lit(".example")).alias("website"),
        printed.alias("listing_date"),
    )


def industry_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Industry of nine suppliers in ten."""
    key = F.col("s_suppkey")
    return (
        table(spark, sf_dir, "supplier")
        .where(key % 10 != 9)
        .select(
            F.concat(F.lit("S"), key.cast("string")).alias("code"),
            _padded(key).alias("tax_code"),
            _padded(F.col("s_nationkey"), 4).alias("industry_code"),
        )
    )


def industries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification list with zero-padded codes."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("G"), F.col("s_nationkey").cast("string")).alias("industry_group"),
        _padded(key, 7).alias("industry_code"),
        F.concat_ws(", ", "s_name", F.lit('"branch"')).alias("industry_name"),
    )


def subsidiaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("p_size") % 3 == 0, "sub").when(F.col("p_size") % 3 == 1, "aff")
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("stock_code"),
        F.col("p_name").alias("comp_name"),
        kind.alias("comp_type"),
        (F.col("p_retailprice") * 1000).cast(model.MONEY).alias("charter_capital"),
        F.col("p_size").cast(model.MULTIPLE).alias("ownership_ratio"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON reply per part; some unsuccessful, some with a missing or null list."""
    key, size = F.col("p_partkey"), F.col("p_size")

    def company(name: Column, rate: Column) -> Column:
        return F.struct(
            name.alias("Name"),
            F.col("p_retailprice").alias("TotalCapital"),
            (F.col("p_retailprice") / 2).alias("SharedCapital"),
            rate.cast("double").alias("OwnershipRate"),
        )

    own = company(F.col("p_name"), size)
    twin = company(F.concat_ws(" ", "p_type", "p_name"), size + 1)
    subsidiary = F.when(size % 4 != 0, F.when(size % 4 == 1, F.array(own, twin)).otherwise(F.array(own)))
    associated = F.when(size % 3 == 0, F.array(twin))
    reply = F.to_json(
        F.struct(
            (key % 10 != 0).alias("Success"),
            F.struct(
                subsidiary.alias("Subsidiaries"), associated.alias("AssociatedCompanies")
            ).alias("Data"),
        )
    )
    broken = F.when(key % 50 == 7, F.substring(reply, 1, 20)).otherwise(reply)
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("symbol"), broken.alias("json"))


def page_anchor_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets and texts of the plain links of each page, in page order."""
    pattern = F.lit('<a href="([^"]*)">([^<]*)</a>')
    return table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        F.regexp_extract_all("html", pattern, F.lit(1)).alias("hrefs"),
        F.regexp_extract_all("html", pattern, F.lit(2)).alias("texts"),
    )


def _rows_of(make) -> Column:
    """Concatenate ``make(text, href, index)`` over the links of a page."""
    linked = F.transform(
        F.arrays_zip("texts", "hrefs"), lambda a, i: make(a["texts"], a["hrefs"], i)
    )
    return F.concat_ws("\n", linked)


def classification_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A classification table per page: one row per link, label in some first cells."""
    def row(text: Column, href: Column, i: Column) -> Column:
        label = F.when(i == 1, "STT").when(i % 3 == 0, F.concat(F.lit(" G"), i.cast("string")))
        code = F.when(i % 4 == 3, "n/a").otherwise((i + F.col("page_id") * 100).cast("string"))
        full = F.concat(
            F.lit("<tr><td>"), F.coalesce(label, F.lit("\n")), F.lit("</td><td>-<td>-</td><td> "),
            code, F.lit(" </td><td></td><td>"), text, F.lit("</td></tr>"),
        )
        return F.when(i % 5 == 4, F.concat(F.lit("<tr><td>G9<td>"), text, F.lit("</tr>"))).otherwise(full)

    lists = page_anchor_lists(spark, sf_dir)
    return lists.select(
        "page_id", F.concat(F.lit("<div><table>"), _rows_of(row), F.lit("</table></div>")).alias("html")
    )


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A company listing per page: some rows lack the link."""
    def row(text: Column, href: Column, i: Column) -> Column:
        linked = F.concat(F.lit('<a href="'), href, F.lit('">'), text, F.lit("</a>"))
        cell = F.when(i % 5 == 3, text).otherwise(linked)
        return F.concat(
            F.lit("<tr><td>"), cell, F.lit("</td><td> Name "), i.cast("string"),
            F.lit("</td><td>-</td><td>EX"), (i % 3).cast("string"), F.lit("</td></tr>"),
        )

    lists = page_anchor_lists(spark, sf_dir)
    head = '<table><tr><td>other</td></tr></table><table class="big table-data-business">'
    return lists.select(
        "page_id",
        F.concat(
            F.lit(head), F.lit("<tr><th>Code</th></tr>"), _rows_of(row), F.lit("</table>")
        ).alias("html"),
    )


def code_list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of codes per page, in the second column; every fifth page has no table."""
    def row(text: Column, href: Column, i: Column) -> Column:
        return F.concat(F.lit("<tr><td>"), i.cast("string"), F.lit("</td><td>"), text, F.lit("</td></tr>"))

    body = F.concat(
        F.lit("<table><tr><td>No</td><td>Code</td></tr>"), _rows_of(row), F.lit("</table>")
    )
    none = F.lit("<p>nothing here</p>")
    return page_anchor_lists(spark, sf_dir).select(
        "page_id", F.when(F.col("page_id") % 5 == 0, none).otherwise(body).alias("html")
    )


def tax_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry pages around the given ones: code in a cell, in the text, or nowhere."""
    page, kind = F.col("page_id"), F.col("page_id") % 4
    code = F.lpad((page % 10000).cast("string"), 4, "0")
    extra = (
        F.when(kind == 0, F.concat(
            F.lit('<div class="row col-md-2">12</div><p class="col-md-2"> '), code, F.lit(" </p>")))
        .when(kind == 1, F.concat(F.lit("<b>Mã ngành</b>\n<span>"), code, F.lit("</span>")))
        .otherwise("")
    )
    key = F.when(page % 9 == 0, "nan").when(page % 9 != 1, page.cast("string"))
    return table(spark, sf_dir, "pages").select(
        "page_id", key.alias("tax_code"), F.concat("html", extra).alias("html")
    )


def profile_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile page per conversation turn, its text in a two-cell row."""
    def escaped(text: Column) -> Column:
        text = F.replace(text, F.lit("&"), F.lit("&amp;"))
        return F.replace(F.replace(text, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    def pair(key: str, value: Column) -> Column:
        return F.concat(F.lit(f"<tr><td> {key}</td><td>"), value, F.lit("</td></tr>"))

    conv, turn = F.col("conv_id").cast("string"), F.col("turn")
    bold = F.concat(F.lit('<h1 class="h1-title">Firm: <b> '), F.col("role"), F.lit(" <i>& co</i></b> (X)</h1>"))
    plain = F.concat(
        F.lit('<h1 class="big h1-title">'), F.col("role"), F.lit(' (X: HOSE)</h1><h2 class="title-2"> No. '),
        turn.cast("string"), F.lit(" </h2>"),
    )
    date = F.when(turn % 3 != 2, pair("Ngày giao dịch đầu tiên:", F.concat(conv, F.lit("/01/2020"))))
    info = F.concat(
        pair("• Mã số thuế", conv),
        pair("• Địa chỉ", escaped(F.col("text"))),
        pair("Email", F.lit("first@x.example")),
        pair("Email", F.concat(F.lit("<a href='#'>"), F.col("role"), F.lit("</a>"))),
        F.lit("<tr><td>Website</td><td>three</td><td>cells</td></tr>"),
    )
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.concat(
            F.when(turn % 2 == 0, bold).otherwise(plain),
            F.lit('<div id="niem-yet"><div id="inner"><table><tbody>'),
            F.coalesce(date, F.lit("")),
            F.lit('</tbody></table></div></div><div id="thanh-lap-cong-ty"><div><table>'),
            info,
            F.lit("</table></div></div>"),
        ).alias("html"),
    )


def ownership_with_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ownership rows with null keys, over-long positions and ratios out of range."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.when(key % 101 != 0, F.concat(F.lit("C"), (key % 40).cast("string"))).alias("stock_code"),
        F.when(key % 211 != 0, F.concat_ws("_", F.col("o_custkey"), "o_orderstatus")).alias("holder_id"),
        F.when(key % 97 == 0, F.repeat("o_orderpriority", 60))
        .otherwise(F.col("o_orderpriority"))
        .alias("position"),
        key.alias("shares_count"),
        (F.col("o_totalprice") / 30).alias("ownership_ratio"),
        F.col("o_orderdate").cast("date").alias("report_date"),
    )


def _orders_as_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey") % 50).alias("stock_code"),
        F.col("o_orderdate").cast("date").alias("trade_date"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("close"),
        F.col("o_orderkey").alias("volume"),
    )


def price_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two thirds of the orders as a batch of prices with repeated keys, and the others as loaded ones."""
    prices = _orders_as_prices(spark, sf_dir)
    return prices.where(F.col("volume") % 3 != 0), prices.where(F.col("volume") % 3 == 0)


def price_reload(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """One price per key: those of two thirds of the orders, then those of all orders."""
    prices = _orders_as_prices(spark, sf_dir)

    def by_key(rows: DataFrame) -> DataFrame:
        return rows.groupBy("stock_code", "trade_date").agg(F.sum("volume").alias("volume"))

    return by_key(prices.where(F.col("volume") % 3 != 0)), by_key(prices)


def stakes_with_orphans(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Line items as stakes of parts in suppliers, and nine suppliers and six parts in seven or so that are known."""
    code, holder = (lambda c: F.concat(F.lit("S"), c)), (lambda c: F.concat(F.lit("H"), c))
    rows = table(spark, sf_dir, "lineitem").select(
        code(F.col("l_suppkey")).alias("stock_code"),
        holder(F.col("l_partkey")).alias("holder_id"),
        F.col("l_orderkey").alias("shares_count"),
    )
    suppliers = table(spark, sf_dir, "supplier").where("s_suppkey % 10 <> 9")
    parts = table(spark, sf_dir, "part").where("p_partkey % 7 <> 3")
    return (
        rows,
        suppliers.select(code(F.col("s_suppkey")).alias("stock_code")),
        parts.select(holder(F.col("p_partkey")).alias("holder_id")),
    )


def ragged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a CSV file under the header o_orderkey,o_orderstatus,o_custkey, some with a cell more or less."""
    key = F.col("o_orderkey")
    quoted = F.concat(F.lit('"'), "o_orderstatus", F.lit(', as ""is"""'))
    line = (
        F.when(key % 7 == 0, F.concat_ws(",", key, quoted, "o_custkey", F.lit("EXTRA")))
        .when(key % 11 == 0, F.concat_ws(",", key, "o_orderstatus"))
        .otherwise(F.concat_ws(",", key, quoted, "o_custkey"))
    )
    return table(spark, sf_dir, "orders").select(line.alias("o_orderkey,o_orderstatus,o_custkey"))


def write_lines(lines: DataFrame, path: str) -> None:
    """Write ready lines, each file headed by the column's name."""
    lines.write.options(header="true", sep="\u0002", quote="", escapeQuotes="false").csv(path)
