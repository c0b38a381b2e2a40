"""Rows from raw pages and JSON payloads.

Inputs are tables of documents; each job adds columns to a document or unfolds it into
rows. Everything about one document happens inside its own record, so none of these
jobs shuffles pages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom import model
from stockloom.functions import html as markup
from stockloom.functions.columns import all_digits, four_digits, usable_key
from stockloom.operators.carry import group_label
from stockloom.operators.universe import filter_universe

# Labels, section ids and classes of the source pages.
LISTING_DATE_LABEL = "Ngày giao dịch đầu tiên"
LISTING_SECTION = "niem-yet"
PROFILE_SECTION = "thanh-lap-cong-ty"
PROFILE_KEYS = {
    "tax_code": "Mã số thuế",
    "address": "Địa chỉ",
    "phone_number": "Điện thoại",
    "email": "Email",
    "website": "Website",
}
GROUP_STOP_WORDS = ("Cấp 1", "STT")
COMPANY_TABLE_CLASS = "table-data-business"
CODE_CELL_CLASS = "col-md-2"
CODE_PATTERN = r"(?s)Mã ngành.*?>(\d{4})<"
NOT_FOUND = "Not Found"
BULLET = "• "

_ITEM = "struct<Name:string,TotalCapital:double,SharedCapital:double,OwnershipRate:double>"
PAYLOAD = (
    "struct<Success:boolean,Data:struct<"
    f"Subsidiaries:array<{_ITEM}>,AssociatedCompanies:array<{_ITEM}>>>"
)


def industry_rows(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """(group, code, name) of a classification page, group label carried down.

    The label is carried inside the record, so two records with one id don't mix.
    """
    wide = F.filter(markup.table_rows(F.col(html)), lambda row: F.size(row["cells"]) >= 6)
    labelled = F.transform(
        wide,
        lambda row: F.struct(
            group_label(row["cells"][0]["text"], GROUP_STOP_WORDS).alias("label"),
            row["cells"][3]["text"].alias("code"),
            row["cells"][5]["text"].alias("name"),
        ),
    )
    # The page is cut where a label stands, and each part unfolds with its label alone. A part is as
    # long as its rows, so the work grows with the page. Exploding one struct keeps the arrays from being computed anew in each part.
    once = pages.select(page_id, F.explode(F.array(F.struct(labelled.alias("rows")))).alias("t"))
    marks = F.filter(
        F.transform(F.col("t.rows"), lambda row, i: F.when((i == 0) | row["label"].isNotNull(), i)), lambda i: i.isNotNull()
    )
    cut = once.select(page_id, F.explode(F.array(F.struct("t.rows", marks.alias("marks")))).alias("t"))
    rows, starts = F.col("t.rows"), F.col("t.marks")

    def part(start: Column, i: Column) -> Column:
        end = F.coalesce(F.get(starts, i + 1), F.size(rows))
        return F.struct(F.get(rows, start)["label"].alias("label"), F.slice(rows, start + 1, end - start).alias("rows"))

    parts = cut.select(page_id, F.explode_outer(F.transform(starts, part)).alias("part"))
    return (
        parts.select(page_id, F.col("part.label").alias("industry_group"), F.explode_outer("part.rows").alias("row"))
        .where(all_digits(F.col("row.code")))
        .select(
            page_id,
            "industry_group",
            F.col("row.code").alias("industry_code"),
            F.col("row.name").alias("industry_name"),
        )
    )


def company_name(title: Column) -> Column:
    """Bold part of a title, else the title up to the bracketed ticker."""
    return F.coalesce(title["bold"], F.substring_index(title["bare"], " (", 1))


def page_titles(
    pages: DataFrame,
    html: str = "html",
    title: tuple[str, str | None] = ("h1", "h1-title"),
    english: tuple[str, str | None] = ("h2", "title-2"),
) -> DataFrame:
    """Adds company_name and company_eng_name; each selector is (tag, class or None)."""
    blocks = F.col("__blocks")

    def first(selector: tuple[str, str | None]) -> Column:
        tag, css = selector

        def wanted(block: Column) -> Column:
            match = block["tag"] == tag
            return match if css is None else match & markup.has_class(block["css"], css)

        return F.get(F.filter(blocks, wanted), F.lit(0))

    read = pages.withColumn("__blocks", markup.headings(F.col(html), title[0], english[0]))
    return read.select(
        *pages.columns,
        company_name(first(title)).alias("company_name"),
        first(english)["bare"].alias("company_eng_name"),
    )


def section_pairs(rows: Column, section: str) -> Column:
    """Two-cell rows of a section as (key, value) structs, bullets removed from keys."""
    pairs = F.filter(
        rows, lambda r: F.array_contains(r["sections"], section) & (F.size(r["cells"]) == 2)
    )
    return F.transform(
        pairs,
        lambda r: F.struct(
            F.replace(r["cells"][0]["bare"], F.lit(BULLET), F.lit("")).alias("key"),
            r["cells"][1]["bare"].alias("value"),
        ),
    )


def lookup(pairs: Column, key: str) -> Column:
    """Value of a key, null if missing; the last one wins, as in a dictionary."""
    hits = F.filter(pairs, lambda p: p["key"] == key)
    return F.try_element_at(hits, F.lit(-1))["value"]


def first_labelled(rows: Column, section: str, phrase: str) -> Column:
    """Second cell of the first row of a section whose label contains a phrase."""
    hits = F.filter(
        rows,
        lambda r: F.array_contains(r["sections"], section)
        & (F.size(r["cells"]) >= 2)
        & r["cells"][0]["bare"].contains(phrase),
    )
    return F.get(hits, F.lit(0))["cells"][1]["bare"]


def key_value_profile(
    pages: DataFrame,
    html: str = "html",
    keys: dict[str, str] = PROFILE_KEYS,
    section: str = PROFILE_SECTION,
    date_section: str = LISTING_SECTION,
    date_label: str = LISTING_DATE_LABEL,
) -> DataFrame:
    """Adds one column per profile key, plus the listing date as printed on the page."""
    read = pages.withColumn("__rows", markup.table_rows(F.col(html), section, date_section))
    read = read.withColumn("__pairs", section_pairs(F.col("__rows"), section))
    return read.select(
        *pages.columns,
        *[lookup(F.col("__pairs"), key).alias(name) for name, key in keys.items()],
        first_labelled(F.col("__rows"), date_section, date_label).alias("listing_date"),
    )


def enterprise_profile(pages: DataFrame, html: str = "html") -> DataFrame:
    """Raw enterprise table from profile pages with a ``code`` column."""
    profile = key_value_profile(page_titles(pages, html), html)
    return profile.select(*[f.name for f in model.RAW_ENTERPRISE])


def company_links(
    pages: DataFrame,
    codes: DataFrame | Sequence[str] | None = None,
    page_id: str = "page_id",
    html: str = "html",
    table_class: str = COMPANY_TABLE_CLASS,
) -> DataFrame:
    """(code, name, exchange, url) of listing rows; the url of a row without link is null."""
    def of_class(row: Column) -> Column:
        return markup.has_class(row["table_class"], table_class)

    # Steps of their own, so that neither the page nor the row list is read twice.
    read = pages.select(page_id, markup.table_rows(F.col(html), table_class).alias("__rows"))
    matching = read.select(page_id, F.filter("__rows", of_class).alias("__matching"))
    first = F.get("__matching", F.lit(0))["table_no"]
    of_first = F.filter(
        "__matching", lambda r: (r["table_no"] == first) & (F.size(r["cells"]) > 0)
    )
    cells = F.col("row.cells")
    links = matching.select(page_id, F.explode(of_first).alias("row")).select(
        page_id,
        F.get(cells, F.lit(0))["bare"].alias("code"),
        F.get(cells, F.lit(1))["bare"].alias("name"),
        F.get(cells, F.lit(3))["bare"].alias("exchange"),
        F.get(cells, F.lit(0))["href"].alias("url"),
    )
    return filter_universe(links, codes, "code").select(
        page_id, "code", "name", "exchange", "url"
    )


def second_cells(
    pages: DataFrame,
    fallback: Sequence[str] = model.LARGE_CAPS,
    page_id: str = "page_id",
    html: str = "html",
) -> DataFrame:
    """Second cell of every row of the first table, heading skipped.

    A page without any table gives the fallback list instead.
    """
    rows = F.col("__rows")
    usable = F.filter(
        rows, lambda r: (r["table_no"] == 0) & (F.size(r["cells"]) > 1)
    )
    codes = F.transform(usable, lambda r: r["cells"][1]["bare"])
    body = F.slice(codes, F.lit(2), F.greatest(F.size(codes), F.lit(1)))
    constant = F.array(*[F.lit(c) for c in fallback])
    read = pages.select(page_id, markup.table_rows(F.col(html)).alias("__rows"))
    return read.select(
        page_id, F.explode(F.when(rows.isNull(), constant).otherwise(body)).alias("stock_code")
    )


def classification_code(
    pages: DataFrame, key: str, html: str = "html", output: str = "industry_code"
) -> DataFrame:
    """Adds the four-digit code of a page: from a marked cell, else from the text.

    Rows without a usable key get null, pages without any match get ``Not Found``.
    """
    page = F.col(html)
    usable = usable_key(F.col(key).cast("string"))
    cells = F.transform(markup.marked(F.when(usable, page), CODE_CELL_CLASS), lambda b: b["bare"])
    from_cell = F.get(F.filter(cells, four_digits), F.lit(0))
    from_text = F.nullif(F.regexp_extract(page, CODE_PATTERN, 1), F.lit(""))
    code = F.coalesce(from_cell, from_text, F.lit(NOT_FOUND))
    return pages.withColumn(output, F.when(usable, code))


def subsidiary_rows(
    payloads: DataFrame, symbol: str = "symbol", json: str = "json", contributed: bool = False
) -> DataFrame:
    """Subsidiary and affiliate rows of successful payloads.

    Both arrays are tagged and joined inside the record, so a payload is parsed once.
    """
    data = F.col("__payload.Data")

    def tagged(items: Column, code: str) -> Column:
        rows = F.transform(items, lambda i: F.struct(F.lit(code).alias("type"), i.alias("item")))
        return F.coalesce(rows, F.array().cast(f"array<struct<type:string,item:{_ITEM}>>"))

    parsed = payloads.select(
        F.col(symbol).alias("stock_code"), F.from_json(json, PAYLOAD).alias("__payload")
    )
    entries = F.concat(
        tagged(data["Subsidiaries"], "sub"), tagged(data["AssociatedCompanies"], "aff")
    )
    # Tested here and not in a filter, which would parse the payload a second time.
    successful = F.when(F.col("__payload.Success"), entries)
    unfolded = parsed.select("stock_code", F.explode(successful).alias("e"))
    extra = [F.col("e.item.SharedCapital").alias("contributed_capital")] if contributed else []
    return unfolded.select(
        "stock_code",
        F.col("e.item.Name").alias("comp_name"),
        F.col("e.type").alias("comp_type"),
        F.col("e.item.TotalCapital").alias("charter_capital"),
        *extra,
        F.col("e.item.OwnershipRate").alias("ownership_ratio"),
    )

