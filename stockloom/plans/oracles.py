"""DuckDB statements that define the expected result of each registered query.

Ratios are computed on whole numbers (cents), because DuckDB divides decimals as
doubles: ``_ratio`` rounds half away from zero at a given number of digits.
"""

from __future__ import annotations

from stockloom import model


def _ratio(numerator: str, denominator: str, digits: int) -> str:
    n, d = f"({numerator})", f"({denominator})"
    return (
        f"(CASE WHEN {n} IS NULL OR {d} IS NULL OR {d} = 0 THEN NULL ELSE "
        f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END)::HUGEINT * "
        f"((2 * abs({n}) * {10**digits}::HUGEINT + abs({d})) // (2 * abs({d}))) END)"
    )


def _decimal(value: str, precision: int, scale: int) -> str:
    unit = "1" if scale == 0 else "0." + "0" * (scale - 1) + "1"
    return f"TRY_CAST(CAST({value} AS BIGINT) * {unit} AS DECIMAL({precision},{scale}))"


def _money(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(20,2))"


_PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"

_SALES = f"""
sales AS (
  SELECT s_nationkey AS nation, n_name AS ticker,
         CAST(year(l_shipdate) AS INTEGER) AS "year",
         CAST(quarter(l_shipdate) AS INTEGER) AS "quarter",
         {_money(f"sum({_PRICE} * (1 - CAST(l_discount AS DECIMAL(3,2))))")} AS net_sales,
         {_money(f"sum({_PRICE})")} AS gross_sales,
         {_money("sum(CAST(l_quantity AS DECIMAL(12,2)))")} AS units,
         {_money(f"coalesce(sum({_PRICE}) FILTER (l_returnflag = 'A'), 0)")} AS flag_a,
         {_money(f"coalesce(sum({_PRICE}) FILTER (l_returnflag = 'R'), 0)")} AS flag_r,
         {_money(f"coalesce(sum({_PRICE}) FILTER (l_linestatus = 'O'), 0)")} AS status_o,
         {_money(f"coalesce(sum({_PRICE}) FILTER (l_linestatus = 'F'), 0)")} AS status_f
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY ALL
)"""

_INCOME = f"""
income AS (
  SELECT ticker AS stock_code, "year", "quarter", 'income_statement' AS report_type,
         CASE WHEN nation % 5 NOT IN (0, 1) THEN net_sales END AS "{model.NET_REVENUE}",
         CASE WHEN nation % 5 = 1 THEN gross_sales END AS "{model.GROSS_REVENUE}",
         CASE WHEN nation % 5 = 0 THEN net_sales END AS "{model.NET_INTEREST_INCOME}",
         CASE WHEN nation % 5 = 0 AND nation % 2 = 0 THEN units END AS "{model.NET_FEE_INCOME}",
         CAST(-status_f AS DECIMAL(20,2)) AS "{model.COST_OF_GOODS}",
         CASE WHEN nation % 2 = 0 THEN status_o END AS "{model.GROSS_PROFIT}",
         CASE WHEN nation % 3 = 0 THEN CAST(status_o - status_f AS DECIMAL(21,2)) END AS "{model.OPERATING_PROFIT_HEADERS[0]}",
         CASE WHEN nation % 3 = 1 THEN CAST(status_o - status_f AS DECIMAL(21,2)) END AS "{model.OPERATING_PROFIT_HEADERS[1]}",
         CASE WHEN nation % 4 = 0 THEN CAST(flag_a - flag_r AS DECIMAL(21,2)) END AS "{model.NET_PROFIT_HEADERS[0]}",
         CASE WHEN nation % 4 = 1 THEN CAST(flag_a - flag_r AS DECIMAL(21,2)) END AS "{model.NET_PROFIT_HEADERS[2]}",
         CASE WHEN nation % 4 = 2 THEN CAST(flag_a - flag_r AS DECIMAL(21,2)) END AS "{model.NET_PROFIT_HEADERS[3]}"
  FROM sales
)"""

_BALANCE = f"""
balance AS (
  SELECT ticker AS stock_code, "year", "quarter", 'balance_sheet' AS report_type,
         gross_sales AS "{model.BALANCE_HEADERS['total_assets']}",
         CASE WHEN nation % 9 <> 4 THEN flag_a END AS "{model.BALANCE_HEADERS['total_equity']}",
         flag_r AS "{model.BALANCE_HEADERS['total_liabilities']}",
         status_o AS "{model.BALANCE_HEADERS['short_term_debt']}",
         status_f AS "{model.BALANCE_HEADERS['long_term_debt']}",
         CAST(units * 10000 AS DECIMAL(20,2)) AS "{model.CONTRIBUTED_CAPITAL}"
  FROM sales WHERE NOT (nation % 7 = 0 AND "quarter" = 2)
)"""

_SHARES = f"""
shares AS (
  SELECT stock_code, "year", "quarter",
         CAST(CAST("{model.CONTRIBUTED_CAPITAL}" * 100 AS HUGEINT) // 1000000 AS BIGINT) AS outstanding_shares
  FROM balance
)"""

_NULL_MONEY = "CAST(NULL AS DECIMAL(20,2))"


def _statement_columns(values: dict[str, str]) -> str:
    return ", ".join(
        f"{_money(values[m]) if m in values else _NULL_MONEY} AS {m}"
        for m in model.INCOME_MEASURES + model.BALANCE_MEASURES
    )


def _quoted(names) -> str:
    return ", ".join(f'"{n}"' for n in names)


_INCOME_REPORT = f"""
SELECT stock_code, "year", "quarter", '{model.INCOME_TAG}' AS report_type,
       {_statement_columns({
           "revenue": f'coalesce("{model.NET_REVENUE}", "{model.GROSS_REVENUE}", '
                      f'coalesce("{model.NET_INTEREST_INCOME}", 0) + coalesce("{model.NET_FEE_INCOME}", 0))',
           "gross_profit": f'coalesce("{model.GROSS_PROFIT}", "{model.NET_REVENUE}" + "{model.COST_OF_GOODS}")',
           "operating_profit": f"coalesce({_quoted(model.OPERATING_PROFIT_HEADERS)})",
           "net_profit": f"coalesce({_quoted([model.NET_PROFIT_HEADERS[i] for i in (0, 2, 3)])}, 0)",
       })}
FROM income"""

_BALANCE_REPORT = f"""
SELECT stock_code, "year", "quarter", '{model.BALANCE_TAG}' AS report_type,
       {_statement_columns({m: f'"{h}"' for m, h in model.BALANCE_HEADERS.items()})}
FROM balance"""

_REPORT = f"report AS ({_INCOME_REPORT} UNION ALL {_BALANCE_REPORT})"

_MERGED = f"""
merged AS (
  SELECT stock_code, "year", "quarter",
         {", ".join(f"max({m}) AS {m}" for m in model.INCOME_MEASURES + model.BALANCE_MEASURES)}
  FROM report GROUP BY ALL
)"""


def _quote(expression: str, name: str) -> str:
    return f"CAST(({expression}) / 1000 * 1000 AS DECIMAL(15,2)) AS {name}"


_PRICES = f"""
quotes AS (
  SELECT n_name AS stock_code, CAST(o_orderdate AS DATE) AS trade_date,
         {_quote("min_by(o_totalprice, o_orderkey)", "open")},
         {_quote("max(o_totalprice)", "high")},
         {_quote("min(o_totalprice)", "low")},
         {_quote("max_by(o_totalprice, o_orderkey)", '"close"')},
         CAST(count(*) AS BIGINT) AS volume
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL
),
prices AS (
  SELECT *, CAST(year(trade_date) AS INTEGER) AS "year",
         CAST(quarter(trade_date) AS INTEGER) AS "quarter"
  FROM quotes
)"""

_PRICE_FACT = f"""
price_fact AS (
  SELECT p.stock_code, trade_date, open, high, low, "close", volume,
         {_money('"close" * coalesce(outstanding_shares, 0)')} AS market_cap, p."year", p."quarter"
  FROM prices p LEFT JOIN shares s
    ON p.stock_code = s.stock_code AND p."year" = s."year" AND p."quarter" = s."quarter"
),
quarter_end AS (
  SELECT stock_code, "year", "quarter", "close" AS close_price, market_cap
  FROM price_fact
  QUALIFY row_number() OVER (PARTITION BY stock_code, "year", "quarter" ORDER BY trade_date DESC) = 1
)"""

_BASE = ",".join([_SALES, _INCOME, _BALANCE, _SHARES, _REPORT, _MERGED, _PRICES, _PRICE_FACT])


def _ratios(source: str, names: tuple[str, ...]) -> str:
    formulas = {
        "net_margin": _decimal(_ratio("np", "rev", 4), 10, 4),
        "roe": _decimal(_ratio("np", "eq", 4), 10, 4),
        "roa": _decimal(_ratio("np", "assets", 4), 10, 4),
        "eps": _decimal(_ratio("eps6", "10000::HUGEINT", 0), 15, 2),
        "book_value": _decimal(_ratio("bv6", "10000::HUGEINT", 0), 15, 2),
        "pe": _decimal(_ratio("close_c * 10000", "eps6", 2), 10, 2),
        "pb": _decimal(_ratio("mc", "eq", 2), 10, 2),
    }

    def cents(column: str, name: str) -> str:
        return f"CAST({column} * 100 AS HUGEINT) AS {name}"

    return f"""
WITH {_BASE},
cents AS (
  SELECT r.stock_code, r."year", r."quarter",
         {cents("net_profit", "np")}, {cents("revenue", "rev")}, {cents("total_equity", "eq")},
         {cents("total_assets", "assets")}, {cents("close_price", "close_c")}, {cents("market_cap", "mc")}
  FROM {source} r LEFT JOIN quarter_end q
    ON r.stock_code = q.stock_code AND r."year" = q."year" AND r."quarter" = q."quarter"
),
implied AS (SELECT *, CASE WHEN close_c <> 0 THEN mc // close_c END AS n_shares FROM cents),
per_share AS (
  SELECT *, {_ratio("np", "n_shares", 4)} AS eps6, {_ratio("eq", "n_shares", 4)} AS bv6 FROM implied
)
SELECT stock_code, "year", "quarter", 'Q' || "quarter" || '/' || "year" AS report_period,
       {", ".join(f"{formulas[n]} AS {n}" for n in names)}
FROM per_share"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + select


_ALL = ("net_margin", "roe", "roa", "eps", "book_value", "pe", "pb")

_LEADERS = """
leaders AS (
  SELECT n_name AS stock_code, CAST(c_custkey AS VARCHAR) AS id,
         c_name || ' ' || o_orderpriority AS officer_name, o_orderpriority AS officer_position,
         o_orderkey AS quantity, o_totalprice / 10000 AS pct,
         CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS update_date
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

_HOLDERS = """
SELECT holder_id, full_name, FALSE AS is_organization, updated_at FROM (
  SELECT stock_code || '_' || id AS holder_id, officer_name AS full_name, update_date AS updated_at
  FROM leaders)
QUALIFY row_number() OVER (PARTITION BY holder_id ORDER BY updated_at DESC NULLS LAST, full_name) = 1"""

_FAULTS = """
faults AS (
  SELECT CASE WHEN o_orderkey % 101 <> 0 THEN 'C' || (o_orderkey % 40) END AS stock_code,
         CASE WHEN o_orderkey % 211 <> 0 THEN o_custkey || '_' || o_orderstatus END AS holder_id,
         CASE WHEN o_orderkey % 97 = 0 THEN repeat(o_orderpriority, 60) ELSE o_orderpriority END AS "position",
         o_totalprice / 30 AS ownership_ratio
  FROM orders
)"""

_TURNS = """
SELECT conv_id, turn,
       CASE WHEN k % 7 = 0 THEN '' WHEN k % 11 <> 0 THEN ' ' || text || chr(10) || ' ' END AS text,
       make_timestamp(k * 1234567) AS at
FROM (SELECT *, conv_id * 1000 + turn AS k FROM conversations)"""

_ANCHORS = """
anchors AS (
  SELECT page_id, unnest(hrefs) AS href, unnest(texts) AS txt,
         unnest(range(0, len(hrefs)::BIGINT)) AS i
  FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs,
               regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS texts FROM pages)
)"""


def _unescape(text: str) -> str:
    """Decode the character references the pages use; their semicolon is optional."""
    for name, char in (
        ("quot", '"'), ("middot", "·"), ("copy", "©"), ("lt", "<"), ("gt", ">"), ("amp", "&"),
    ):
        text = f"regexp_replace({text}, '&{name};?', '{char}', 'g')"
    return text


def _stripped(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


_SUPPLIER_MAP = """
listed AS (
  SELECT 'S' || s_suppkey AS stock_code, lpad(CAST(s_suppkey AS VARCHAR), greatest(10, length(CAST(s_suppkey AS VARCHAR)))::INTEGER, '0') AS tax_code,
         s_name AS company_name, upper(s_name) AS company_eng_name,
         'No. ' || s_suppkey || ', Hà Nội' AS address, 'info@s' || s_suppkey || '.example' AS email,
         'https://s' || s_suppkey || '.example' AS website,
         CASE WHEN s_suppkey % 13 = 0 THEN NULL WHEN s_suppkey % 17 = 0 THEN NULL
              WHEN s_suppkey % 19 <> 0 THEN CAST(DATE '2000-01-01' + CAST(s_suppkey % 3000 AS INTEGER) AS DATE)
         END AS listing_date,
         lpad(CAST(s_nationkey AS VARCHAR), 4, '0') AS industry_code
  FROM supplier WHERE s_suppkey % 10 <> 9
)"""

_FALLBACK = ", ".join(f"'{c}'" for c in model.LARGE_CAPS)

ORACLES: dict[str, str] = {
    "fact_financial_ratio": _ratios("report", _ALL),
    "fact_financial_ratio_merged": _ratios("merged", _ALL),
    "ratio_net_margin": _ratios("merged", ("net_margin",)),
    "ratio_returns": _ratios("merged", ("roe", "roa")),
    "ratio_per_share": _ratios("merged", ("eps", "book_value")),
    "ratio_valuation": _ratios("merged", ("pe", "pb")),
    "safe_division": """
SELECT l_orderkey, l_partkey, l_suppkey,
       CASE WHEN l_partkey % 7 = 0 OR l_partkey % 11 = 0 OR l_quantity = 0 THEN NULL
            ELSE l_extendedprice / l_quantity END AS quotient
FROM lineitem""",
    "fact_price_history": _with(
        _SALES, _BALANCE, _SHARES, _PRICES, _PRICE_FACT,
        select='\nSELECT stock_code, trade_date, open, high, low, "close", volume, market_cap FROM price_fact',
    ),
    "outstanding_shares": _with(_SALES, _BALANCE, _SHARES, select="\nSELECT * FROM shares"),
    "price_normalized": _with(_PRICES, select="\nSELECT * FROM prices"),
    "quarter_end_price": _with(
        _SALES, _BALANCE, _SHARES, _PRICES, _PRICE_FACT, select="\nSELECT * FROM quarter_end"
    ),
    "income_normalized": _with(_SALES, _INCOME, select="\nSELECT * FROM income"),
    "balance_normalized": _with(_SALES, _BALANCE, select="\nSELECT * FROM balance"),
    "statement_income": _with(_SALES, _INCOME, select=_INCOME_REPORT),
    "statement_balance": _with(_SALES, _BALANCE, select=_BALANCE_REPORT),
    "fact_financial_report": _with(
        _SALES, _INCOME, _BALANCE, _REPORT, select="\nSELECT * FROM report"
    ),
    "drop_empty_columns": _with(
        _SALES, _BALANCE,
        select="""
SELECT stock_code AS "CP", CAST("year" AS VARCHAR) AS "Năm", CAST("quarter" AS VARCHAR) AS "Kỳ",
       * EXCLUDE (stock_code, "year", "quarter") FROM balance""",
    ),
    "nonnull_counts": _with(
        _SALES, _BALANCE,
        select=f"""
SELECT count(*) AS "CP", count(*) AS "Năm", count(*) AS "Kỳ", count(*) AS report_type,
       {", ".join(f'count("{h}") AS "{h}"' for h in (*model.BALANCE_HEADERS.values(), model.CONTRIBUTED_CAPITAL))},
       CAST(0 AS BIGINT) AS "Ghi chú_trống"
FROM balance""",
    ),
    "dim_date": """
SELECT date_id, CAST(day(date_id) AS INTEGER) AS "day", CAST(month(date_id) AS INTEGER) AS "month",
       CAST(quarter(date_id) AS INTEGER) AS "quarter", CAST(year(date_id) AS INTEGER) AS "year",
       dayofweek(date_id) IN (0, 6) AS is_weekend, dayname(date_id) AS day_of_week
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date_id FROM orders)""",
    "scan_industry": """
SELECT 'G' || s_nationkey AS industry_group,
       lpad(CAST(s_suppkey AS VARCHAR), greatest(7, length(CAST(s_suppkey AS VARCHAR)))::INTEGER, '0') AS industry_code,
       s_name || ', "branch"' AS industry_name
FROM supplier""",
    "enterprise_enriched": _with(_SUPPLIER_MAP, select="\nSELECT * FROM listed"),
    "dim_holder": _with(_LEADERS, select=_HOLDERS),
    "fact_ownership": _with(
        _LEADERS,
        select="""
SELECT stock_code, stock_code || '_' || id AS holder_id, officer_position AS "position",
       quantity AS shares_count, CAST(pct AS DECIMAL(10,6)) AS ownership_ratio, update_date AS report_date
FROM leaders""",
    ),
    "fact_subsidiary": """
SELECT p_brand AS parent_stock_code, p_name AS subsidiary_name,
       CASE WHEN p_size % 3 = 1 THEN 'Affiliate' ELSE 'Subsidiary' END AS subsidiary_type,
       CAST(p_retailprice * 1000 AS DECIMAL(20,2)) AS charter_capital,
       CAST(p_size AS DECIMAL(10,2)) AS ownership_ratio
FROM part""",
    "ticker_universe": """
SELECT n_name AS stock_code FROM nation UNION SELECT c_mktsegment FROM customer ORDER BY 1""",
    "filter_universe": """
SELECT * FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (1, 3))""",
    "filter_universe_limit": """
WITH listed AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY'),
kept AS (
  SELECT o_orderkey, o_custkey, o_orderkey % 100 + 1 AS page FROM orders
  WHERE o_custkey IN (SELECT c_custkey FROM listed)
),
pages AS (
  SELECT page, coalesce(sum(n) OVER (ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM (SELECT page, count(*) AS n FROM kept GROUP BY page)
)
SELECT o_orderkey, o_custkey, page FROM kept
WHERE page IN (SELECT page FROM pages WHERE before < (SELECT count(*) FROM listed))""",
    "union_tagged_sources": """
SELECT o_orderkey AS id, o_totalprice AS value, o_orderpriority AS priority, 'orders' AS source FROM orders
UNION ALL BY NAME
SELECT event_id AS id, value, event_type, user_id, 'events' AS source FROM events""",
    "clean_keys": """
SELECT c_custkey, c_name AS tax_code FROM customer WHERE c_custkey % 6 NOT IN (0, 1)""",
    "forward_fill_label": """
SELECT user_id, event_id, label,
       last_value(label IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS group_label
FROM (SELECT user_id, event_id,
             CASE WHEN event_type = 'signup' THEN json_extract_string(props, '$.k') END AS label FROM events)""",
    "surrogate_keys": """
SELECT row_number() OVER (ORDER BY o_orderkey) AS order_id, o_orderkey, o_custkey, o_totalprice FROM orders""",
    "check_not_null": _with(
        _FAULTS,
        select="""
SELECT 'fact_ownership' AS table_name, 'stock_code' AS column_name, count(*) - count(stock_code) AS violations FROM faults
UNION ALL SELECT 'fact_ownership', 'holder_id', count(*) - count(holder_id) FROM faults""",
    ),
    "check_lengths": _with(
        _FAULTS,
        select="".join(
            f"""{' UNION ALL' if i else ''}
SELECT 'fact_ownership' AS table_name, '{c}' AS column_name, CAST({n} AS INTEGER) AS max_length,
       count(*) FILTER (length("{c}") > {n}) AS violations FROM faults"""
            for i, (c, n) in enumerate((("stock_code", 10), ("holder_id", 50), ("position", 255)))
        ),
    ),
    "check_decimal_range": _with(
        _FAULTS,
        select="""
SELECT 'fact_ownership' AS table_name, 'ownership_ratio' AS column_name, 'decimal(10,6)' AS decimal_type,
       count(*) FILTER (ownership_ratio IS NOT NULL AND TRY_CAST(ownership_ratio AS DECIMAL(10,6)) IS NULL) AS violations
FROM faults""",
    ),
    "check_unique_keys": """
WITH trades AS (
  SELECT 'C' || (o_custkey % 40) AS stock_code, CAST(o_orderdate AS DATE) AS trade_date FROM orders WHERE o_custkey % 23 <> 0
),
clashes AS (SELECT count(*) AS copies FROM trades GROUP BY stock_code, trade_date HAVING count(*) > 1),
names AS (SELECT count(*) AS copies FROM supplier GROUP BY s_name HAVING count(*) > 1)
SELECT 'fact_price_history' AS table_name, 'stock_code,trade_date' AS key_columns, count(*) AS duplicated_keys,
       CAST(coalesce(sum(copies - 1), 0) AS BIGINT) AS surplus_rows FROM clashes
UNION ALL
SELECT 'dim_enterprise', 'stock_code', count(*), CAST(coalesce(sum(copies - 1), 0) AS BIGINT) FROM names""",
    "duplicate_line_keys": """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "check_foreign_keys": """
WITH o AS (SELECT CASE WHEN o_custkey % 97 = 0 THEN o_custkey + 1000000000000 ELSE o_custkey END AS k FROM orders),
s AS (SELECT CASE WHEN s_suppkey % 8 = 3 THEN s_nationkey + 100 WHEN s_suppkey % 8 <> 4 THEN s_nationkey END AS k FROM supplier)
SELECT 'orders' AS child_table, 'o_custkey' AS child_column, 'customer' AS parent_table,
       CAST(k AS VARCHAR) AS missing_key, count(*) AS child_rows
FROM o WHERE k NOT IN (SELECT c_custkey FROM customer) GROUP BY ALL
UNION ALL
SELECT 'supplier', 's_nationkey', 'nation', CAST(k AS VARCHAR), count(*)
FROM s WHERE k IS NOT NULL AND k NOT IN (SELECT n_nationkey FROM nation) GROUP BY ALL""",
    "industry_rows": _with(
        _ANCHORS,
        select=f"""
SELECT page_id, industry_group, CAST(i + page_id * 100 AS VARCHAR) AS industry_code,
       {_stripped(_unescape("txt"))} AS industry_name
FROM (SELECT *, last_value(CASE WHEN i % 3 = 0 THEN 'G' || i END IGNORE NULLS) OVER (
                PARTITION BY page_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS industry_group
      FROM anchors WHERE i % 5 <> 4)
WHERE i % 4 <> 3""",
    ),
    "page_profile": f"""
SELECT page_id, split_part({_stripped(_unescape("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"))}, ' (', 1) AS company_name,
       {_stripped(_unescape("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"))} AS company_eng_name
FROM pages""",
    "page_links": _with(
        _ANCHORS,
        select=f"""
SELECT page_id, {_stripped(_unescape("txt"))} AS code, 'Name ' || i AS name, 'EX' || (i % 3) AS exchange,
       CASE WHEN i % 5 <> 3 THEN {_unescape("href")} END AS url
FROM anchors""",
    ),
    "kv_section": rf"""
SELECT conv_id, turn, CAST(conv_id AS VARCHAR) AS tax_code, {_stripped("text")} AS address,
       CAST(NULL AS VARCHAR) AS phone_number, role AS email, CAST(NULL AS VARCHAR) AS website,
       CASE WHEN turn % 3 <> 2 THEN conv_id || '/01/2020' END AS listing_date
FROM conversations""",
    "enterprise_profile": rf"""
SELECT conv_id || '-' || turn AS code,
       CASE WHEN turn % 2 = 0 THEN role || '& co' ELSE role END AS company_name,
       CASE WHEN turn % 2 = 1 THEN 'No. ' || turn END AS company_eng_name,
       CAST(conv_id AS VARCHAR) AS tax_code, {_stripped("text")} AS address, role AS email,
       CAST(NULL AS VARCHAR) AS website,
       CASE WHEN turn % 3 <> 2 THEN conv_id || '/01/2020' END AS listing_date
FROM conversations""",
    "subsidiary_rows": """
WITH replies AS (SELECT * FROM part WHERE p_partkey % 10 <> 0 AND p_partkey % 50 <> 7),
items AS (
  SELECT *, p_name AS comp_name, 'sub' AS comp_type, p_size AS rate FROM replies WHERE p_size % 4 <> 0
  UNION ALL SELECT *, p_type || ' ' || p_name, 'sub', p_size + 1 FROM replies WHERE p_size % 4 = 1
  UNION ALL SELECT *, p_type || ' ' || p_name, 'aff', p_size + 1 FROM replies WHERE p_size % 3 = 0
)
SELECT p_brand AS stock_code, comp_name, comp_type, p_retailprice AS charter_capital,
       p_retailprice / 2 AS contributed_capital, CAST(rate AS DOUBLE) AS ownership_ratio
FROM items""",
    "list_with_fallback": _with(
        _ANCHORS,
        select=f"""
SELECT page_id, {_stripped(_unescape("txt"))} AS stock_code FROM anchors WHERE page_id % 5 <> 0
UNION ALL
SELECT page_id, unnest([{_FALLBACK}]) FROM pages WHERE page_id % 5 = 0""",
    ),
    "extract_code": r"""
SELECT page_id, CASE WHEN page_id % 9 = 0 THEN 'nan' WHEN page_id % 9 <> 1 THEN CAST(page_id AS VARCHAR) END AS tax_code,
       CASE WHEN page_id % 9 IN (0, 1) THEN NULL
            WHEN page_id % 4 <= 1 THEN right('000' || (page_id % 10000), 4) ELSE 'Not Found' END AS industry_code
FROM pages""",
    "strip_diacritics": """
SELECT doc_id, translate(strip_accents(text), 'Đđ', 'Dd') AS plain FROM documents""",
    "landing_roundtrip_parquet": "SELECT * FROM orders",
    "landing_roundtrip_csv": "SELECT * FROM orders",
    "landing_roundtrip_json": "SELECT * FROM orders",
    "warehouse_tables": _with(
        _LEADERS,
        select="""
SELECT 'dim_industry' AS table_name, CAST(4 AS INTEGER) AS column_count, (SELECT count(*) FROM supplier) AS row_count
UNION ALL SELECT 'dim_enterprise', 10, (SELECT count(*) FROM supplier WHERE s_suppkey % 10 <> 9)
UNION ALL SELECT 'dim_holder_info', 4, (SELECT count(DISTINCT stock_code || '_' || id) FROM leaders)
UNION ALL SELECT 'dim_date', 7, (SELECT count(DISTINCT CAST(o_orderdate AS DATE)) FROM leaders JOIN orders ON quantity = o_orderkey)
UNION ALL SELECT 'fact_price_history', 9, (SELECT count(*) FROM (SELECT DISTINCT stock_code, CAST(o_orderdate AS DATE) FROM leaders JOIN orders ON quantity = o_orderkey))
UNION ALL SELECT 'fact_financial_ratio', 12, (SELECT count(*) FROM statements)
UNION ALL SELECT 'fact_financial_report', 14, (SELECT sum(n)::BIGINT FROM statements)
UNION ALL SELECT 'fact_ownership', 7, (SELECT count(*) FROM leaders)
UNION ALL SELECT 'fact_subsidiary', 7, (SELECT count(*) FROM part)""",
    ).replace(
        "\nSELECT 'dim_industry'",
        """, statements AS (
  SELECT CASE WHEN s_nationkey % 7 = 0 AND quarter(d) = 2 THEN 1 ELSE 2 END AS n
  FROM (SELECT DISTINCT s_nationkey, date_trunc('quarter', l_shipdate) AS d
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
)
SELECT 'dim_industry'""",
    ),
    "landing_roundtrip_csv_text": _TURNS,
    "landing_roundtrip_json_text": _TURNS,
    "landing_roundtrip_partition_keys": """
SELECT s_suppkey, s_name, lpad(CAST(s_nationkey AS VARCHAR), 4, '0') AS nation_code FROM supplier""",
    "load_rejects": _with(
        _FAULTS,
        select="""
SELECT 'fact_ownership' AS table_name, faults, count(*) AS rejected FROM (
  SELECT concat_ws('; ',
    CASE WHEN stock_code IS NULL THEN 'stock_code: missing' END,
    CASE WHEN holder_id IS NULL THEN 'holder_id: missing' END,
    CASE WHEN length("position") > 255 THEN 'position: too long' END,
    CASE WHEN TRY_CAST(ownership_ratio AS DECIMAL(10,6)) IS NULL THEN 'ownership_ratio: out of range' END) AS faults
  FROM faults)
WHERE faults <> '' GROUP BY faults""",
    ),
    "scan_rejects": """
SELECT CASE WHEN o_orderkey % 7 = 0
            THEN concat_ws(',', o_orderkey, '"' || o_orderstatus || ', as ""is""' || '"', o_custkey, 'EXTRA')
            ELSE concat_ws(',', o_orderkey, o_orderstatus) END AS record,
       CAST(3 AS INTEGER) AS expected, CAST(CASE WHEN o_orderkey % 7 = 0 THEN 4 ELSE 2 END AS INTEGER) AS found
FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0""",
    "scan_sound_rows": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus || ', as "is"' AS o_orderstatus,
       CAST(o_custkey AS VARCHAR) AS o_custkey
FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0""",
    "scan_mixed_headers": """
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name,
       CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_nationkey AS VARCHAR) END AS s_nationkey,
       CASE WHEN s_suppkey % 2 = 0 THEN 'EVEN' ELSE 'ODD' END AS source
FROM supplier""",
    "load_key_rejects": """
WITH prices AS (
  SELECT 'C' || (o_custkey % 50) AS stock_code, CAST(o_orderdate AS DATE) AS trade_date,
         CAST(o_totalprice AS DECIMAL(15,2)) AS close, o_orderkey AS volume FROM orders
), batch AS (
  SELECT *, row_number() OVER (PARTITION BY stock_code, trade_date ORDER BY close, volume) AS place
  FROM prices WHERE volume % 3 <> 0
), checked AS (
  SELECT *, (stock_code, trade_date) IN (SELECT (stock_code, trade_date) FROM prices WHERE volume % 3 = 0) AS taken FROM batch
)
SELECT stock_code, trade_date, volume,
       'stock_code,trade_date: ' || CASE WHEN taken THEN 'already loaded' ELSE 'repeated' END AS faults
FROM checked WHERE taken OR place > 1""",
    "load_orphan_rejects": """
SELECT 'S' || l_suppkey AS stock_code, 'H' || l_partkey AS holder_id, l_orderkey AS shares_count,
       CASE WHEN l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 10 <> 9)
            THEN 'stock_code: not in dim_enterprise' ELSE 'holder_id: not in dim_holder_info' END AS faults
FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 10 <> 9)
   OR l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 7 <> 3)""",
    "surrogate_keys_reloaded": """
WITH prices AS (
  SELECT 'C' || (o_custkey % 50) AS stock_code, CAST(o_orderdate AS DATE) AS trade_date, sum(o_orderkey)::BIGINT AS volume,
         bool_or(o_orderkey % 3 <> 0) AS early
  FROM orders GROUP BY ALL
)
SELECT row_number() OVER (ORDER BY early DESC, stock_code, trade_date) AS price_id, stock_code, trade_date, volume FROM prices""",
}

_LOADED = {
    "dim_industry": ORACLES["scan_industry"],
    "dim_enterprise": ORACLES["enterprise_enriched"],
    "dim_holder_info": f"SELECT holder_id, full_name, is_organization FROM ({ORACLES['dim_holder']})",
    "dim_date": ORACLES["dim_date"].replace(
        "FROM orders)", "FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"
    ),
    "fact_price_history": ORACLES["fact_price_history"],
    "fact_financial_ratio": ORACLES["fact_financial_ratio_merged"],
    "fact_financial_report": ORACLES["fact_financial_report"],
    "fact_ownership": ORACLES["fact_ownership"],
    "fact_subsidiary": ORACLES["fact_subsidiary"],
}
ORACLES |= {f"loaded_{name}": sql for name, sql in _LOADED.items()}
ORACLES["loaded_twice_dim_industry"] = ORACLES["loaded_dim_industry"]
ORACLES["landed_enterprise_profile"] = ORACLES["enterprise_profile"]
