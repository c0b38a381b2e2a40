"""Table contracts of the warehouse and the shapes of the raw inputs.

A contract carries everything the loaders and the quality checks need: column
types, required columns, text lengths, keys, references and column defaults.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE = T.DecimalType(15, 2)
MONEY = T.DecimalType(20, 2)
RATE = T.DecimalType(10, 4)
MULTIPLE = T.DecimalType(10, 2)
STAKE = T.DecimalType(10, 6)

TEXT = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()
DATE = T.DateType()
FLAG = T.BooleanType()
STAMP = T.TimestampType()


@dataclass(frozen=True)
class Field:
    name: str
    dtype: T.DataType
    required: bool = False
    max_length: int | None = None
    default: Any = None  # "now", "today" or a literal
    surrogate: bool = False

    def default_column(self) -> Column | None:
        if self.default is None:
            return None
        if self.default == "now":
            return F.current_timestamp()
        if self.default == "today":
            return F.current_date()
        return F.lit(self.default)


@dataclass(frozen=True)
class Reference:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Table:
    name: str
    fields: tuple[Field, ...]
    primary_key: tuple[str, ...]
    unique: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    # order in which surrogate ids are handed out
    natural_order: tuple[str, ...] = ()

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dtype, True) for f in self.fields])

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)

    @property
    def surrogate(self) -> Field | None:
        return next((f for f in self.fields if f.surrogate), None)

    def keys(self) -> list[tuple[str, ...]]:
        """Keys that data (not the loader) must keep unique."""
        keys = [] if self.surrogate else [self.primary_key]
        return keys + ([self.unique] if self.unique else [])


def _text(name: str, length: int | None = None, required: bool = False) -> Field:
    return Field(name, TEXT, required, length)


def _serial(name: str) -> Field:
    return Field(name, LONG, required=True, surrogate=True)


_TO_ENTERPRISE = Reference("stock_code", "dim_enterprise", "stock_code")

DIM_INDUSTRY = Table(
    "dim_industry",
    (
        _text("industry_code", 20, required=True),
        _text("industry_group", 10),
        _text("industry_name", 255),
        Field("created_at", STAMP, default="now"),
    ),
    primary_key=("industry_code",),
)

DIM_ENTERPRISE = Table(
    "dim_enterprise",
    (
        _text("stock_code", 10, required=True),
        _text("company_name", 255),
        _text("company_eng_name", 255),
        _text("tax_code", 20),
        Field("listing_date", DATE),
        _text("address"),
        _text("website", 255),
        _text("email", 100),
        _text("industry_code", 20),
        Field("updated_at", STAMP, default="now"),
    ),
    primary_key=("stock_code",),
    references=(Reference("industry_code", "dim_industry", "industry_code"),),
)

DIM_HOLDER = Table(
    "dim_holder_info",
    (
        _text("holder_id", 50, required=True),
        _text("full_name", 255),
        Field("is_organization", FLAG, default=False),
        Field("updated_at", DATE, default="today"),
    ),
    primary_key=("holder_id",),
)

DIM_DATE = Table(
    "dim_date",
    (
        Field("date_id", DATE, required=True),
        Field("day", INT),
        Field("month", INT),
        Field("quarter", INT),
        Field("year", INT),
        Field("is_weekend", FLAG),
        _text("day_of_week", 10),
    ),
    primary_key=("date_id",),
)

FACT_PRICE = Table(
    "fact_price_history",
    (
        _serial("price_id"),
        _text("stock_code", 10, required=True),
        Field("trade_date", DATE, required=True),
        Field("open", PRICE),
        Field("high", PRICE),
        Field("low", PRICE),
        Field("close", PRICE),
        Field("volume", LONG),
        Field("market_cap", MONEY),
    ),
    primary_key=("price_id",),
    unique=("stock_code", "trade_date"),
    references=(_TO_ENTERPRISE,),
    natural_order=("stock_code", "trade_date"),
)

FACT_RATIO = Table(
    "fact_financial_ratio",
    (
        _serial("ratio_id"),
        _text("stock_code", 10, required=True),
        _text("report_period", 20),
        Field("year", INT),
        Field("quarter", INT),
        Field("pe", MULTIPLE),
        Field("pb", MULTIPLE),
        Field("roe", RATE),
        Field("roa", RATE),
        Field("eps", PRICE),
        Field("net_margin", RATE),
        Field("book_value", PRICE),
    ),
    primary_key=("ratio_id",),
    unique=("stock_code", "year", "quarter"),
    references=(_TO_ENTERPRISE,),
    natural_order=("stock_code", "year", "quarter"),
)

INCOME_MEASURES = ("revenue", "gross_profit", "operating_profit", "net_profit")
BALANCE_MEASURES = (
    "total_assets",
    "total_equity",
    "total_liabilities",
    "short_term_debt",
    "long_term_debt",
)

FACT_REPORT = Table(
    "fact_financial_report",
    (
        _serial("report_id"),
        _text("stock_code", 10, required=True),
        _text("report_type", 20, required=True),
        Field("year", INT),
        Field("quarter", INT),
        *(Field(m, MONEY) for m in INCOME_MEASURES + BALANCE_MEASURES),
    ),
    primary_key=("report_id",),
    unique=("stock_code", "report_type", "year", "quarter"),
    references=(_TO_ENTERPRISE,),
    natural_order=("stock_code", "year", "quarter", "report_type"),
)

FACT_OWNERSHIP = Table(
    "fact_ownership",
    (
        _serial("ownership_id"),
        _text("stock_code", 10, required=True),
        _text("holder_id", 50, required=True),
        _text("position", 255),
        Field("shares_count", LONG),
        Field("ownership_ratio", STAKE),
        Field("report_date", DATE),
    ),
    primary_key=("ownership_id",),
    references=(_TO_ENTERPRISE, Reference("holder_id", "dim_holder_info", "holder_id")),
    natural_order=("stock_code", "holder_id", "report_date", "position", "shares_count"),
)

FACT_SUBSIDIARY = Table(
    "fact_subsidiary",
    (
        _serial("sub_id"),
        _text("parent_stock_code", 10, required=True),
        _text("subsidiary_name", 255),
        _text("subsidiary_type", 50),
        Field("ownership_ratio", MULTIPLE),
        Field("charter_capital", MONEY),
        Field("updated_at", STAMP, default="now"),
    ),
    primary_key=("sub_id",),
    references=(Reference("parent_stock_code", "dim_enterprise", "stock_code"),),
    natural_order=("parent_stock_code", "subsidiary_name", "subsidiary_type"),
)

WAREHOUSE: dict[str, Table] = {
    t.name: t
    for t in (
        DIM_INDUSTRY,
        DIM_ENTERPRISE,
        DIM_HOLDER,
        DIM_DATE,
        FACT_PRICE,
        FACT_RATIO,
        FACT_REPORT,
        FACT_OWNERSHIP,
        FACT_SUBSIDIARY,
    )
}


def _shape(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


# Identifiers stay text everywhere, so that codes such as 0620 keep their zeros.
RAW_INDUSTRY = _shape(industry_group=TEXT, industry_code=TEXT, industry_name=TEXT)
RAW_ENTERPRISE = _shape(
    code=TEXT,
    company_name=TEXT,
    company_eng_name=TEXT,
    tax_code=TEXT,
    address=TEXT,
    email=TEXT,
    website=TEXT,
    listing_date=TEXT,
)
RAW_INDUSTRY_MAP = _shape(code=TEXT, tax_code=TEXT, industry_code=TEXT)
RAW_LEADERSHIP = _shape(
    stock_code=TEXT,
    id=TEXT,
    officer_name=TEXT,
    officer_position=TEXT,
    quantity=LONG,
    officer_own_percent=T.DoubleType(),
    update_date=DATE,
)
RAW_SUBSIDIARY = _shape(
    stock_code=TEXT,
    comp_name=TEXT,
    comp_type=TEXT,
    charter_capital=MONEY,
    ownership_ratio=MULTIPLE,
)

# Where each raw table is landed below the landing root.
LANDED_PATHS = {
    "industries": "industries/industries_list.csv",
    "enterprise": "enterprise/enterprise_basic_info.csv",
    "subsidiaries": "subsidiaries/subs_comp.csv",
    "leadership": "profile/leadership.csv",
    "income": "financial/income/income_data.csv",
    "balance": "financial/balance/balance_data.csv",
    "prices": "market/prices/stock_price.csv",
}

# Headers of the landed files, most preferred first.
SYMBOL_HEADERS = ("ticker", "CP")
YEAR_HEADERS = ("Năm",)
QUARTER_HEADERS = ("Kỳ",)
TRADE_DATE_HEADERS = ("time", "tradingDate")
NET_REVENUE = "Doanh thu thuần"
GROSS_REVENUE = "Doanh thu (đồng)"
NET_INTEREST_INCOME = "Thu nhập lãi thuần"
NET_FEE_INCOME = "Lãi thuần từ hoạt động dịch vụ"
GROSS_PROFIT = "Lãi gộp"
COST_OF_GOODS = "Giá vốn hàng bán"
OPERATING_PROFIT_HEADERS = ("Lãi/Lỗ từ hoạt động kinh doanh", "Lợi nhuận thuần")
NET_PROFIT_HEADERS = (
    "Lợi nhuận sau thuế của Cổ đông công ty mẹ (đồng)",
    "Lợi nhuận sau thuế của Cổ đông công ty mẹ",
    "Cổ đông của Công ty mẹ",
    "Lợi nhuận sau thuế",
)
BALANCE_HEADERS = {
    "total_assets": "TỔNG CỘNG TÀI SẢN (đồng)",
    "total_equity": "VỐN CHỦ SỞ HỮU (đồng)",
    "total_liabilities": "NỢ PHẢI TRẢ (đồng)",
    "short_term_debt": "Vay và nợ thuê tài chính ngắn hạn (đồng)",
    "long_term_debt": "Vay và nợ thuê tài chính dài hạn (đồng)",
}
CONTRIBUTED_CAPITAL = "Vốn góp của chủ sở hữu (đồng)"
INCOME_TAG = "IncomeStatement"
BALANCE_TAG = "BalanceSheet"

# The ticker universe.
LARGE_CAPS = (
    "ACB", "BCM", "BID", "BVH", "CTG", "FPT", "GAS", "GVR", "HDB", "HPG",
    "MBB", "MSN", "MWG", "PLX", "POW", "SAB", "SHB", "SSB", "SSI", "STB",
    "TCB", "TPB", "VCB", "VHM", "VIB", "VIC", "VJC", "VNM", "VPB", "VRE",
)
CHALLENGERS = (
    "DGC", "LPB", "EIB", "PNJ", "REE", "VIX", "VND", "HCM", "VCI", "KBC",
    "KDH", "NLG", "PDR", "DIG", "DXG", "GEX", "GMD", "VHC", "FRT", "DPM",
)
