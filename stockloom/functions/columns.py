"""Column expressions shared by the operators. All of them stay inside codegen."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def field_ref(name: str) -> Column:
    """Reference a top-level column whose name may hold dots, spaces or back-ticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def nfc(text: str) -> str:
    """Composed form, so that headers typed with combining marks still match."""
    return unicodedata.normalize("NFC", text)


def find_header(df: DataFrame, names: Iterable[str]) -> str | None:
    """The column of ``df`` whose composed name equals the first name that matches."""
    by_name = {nfc(c): c for c in reversed(df.columns)}
    return next((by_name[nfc(n)] for n in names if nfc(n) in by_name), None)


def amount(df: DataFrame, header: str, default: float | None = None) -> Column:
    """Numeric value of an optional column; a literal where the column is absent.

    Text columns are read as wide decimals, so that long amounts keep every digit; exponents
    are understood as well.
    """
    found = find_header(df, [header])
    if found is None:
        return F.lit(default)
    value = field_ref(found)
    if isinstance(df.schema[found].dataType, T.StringType):
        value = value.try_cast("decimal(38,6)")
    return value


def first_amount(df: DataFrame, headers: Iterable[str], *fallbacks: Column) -> Column:
    """First non-null value among optional columns, then the fallbacks."""
    return F.coalesce(*[amount(df, h) for h in headers], *fallbacks)


def whole_number(df: DataFrame, name: str) -> Column:
    """Integer value of a column; text such as ``2024.0`` counts as 2024."""
    value = field_ref(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        value = value.try_cast("double")
    return value.try_cast("int")


def safe_div(numerator: Column, denominator: Column) -> Column:
    """Quotient, null where the denominator is zero or null or the result overflows."""
    return F.try_divide(numerator, denominator)


def period_label(year: Column, quarter: Column) -> Column:
    return F.concat(F.lit("Q"), quarter.cast("string"), F.lit("/"), year.cast("string"))


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)  # Sunday, Saturday


def usable_key(key: Column) -> Column:
    """True unless the key is null, empty or the text a missing float turns into."""
    return key.isNotNull() & (key != "") & (key != "nan")


def strip_space(value: Column) -> Column:
    """Trim every kind of white space, line breaks included."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def all_digits(value: Column) -> Column:
    return value.rlike(r"^[0-9]+$")


def four_digits(value: Column) -> Column:
    return value.rlike(r"^[0-9]{4}$")
