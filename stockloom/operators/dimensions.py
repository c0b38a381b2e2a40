"""Company, holder, date and subsidiary tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom import model
from stockloom.functions.columns import field_ref, is_weekend


def enterprise_enriched(basic: DataFrame, industry_map: DataFrame) -> DataFrame:
    """Companies with their industry; companies absent from the map are left out.

    The optimizer broadcasts the map when its measured size allows, else both sides
    are hashed on (code, tax_code).
    """
    if "code" not in basic.columns and "stock_code" in basic.columns:
        basic = basic.withColumn("code", F.col("stock_code")).drop("stock_code")
    listed = basic.withColumn("listing_date", F.try_to_date("listing_date", "dd/MM/yyyy"))
    keyed = listed.join(industry_map, ["code", "tax_code"], "inner")
    return keyed.withColumnRenamed("code", "stock_code")


def holder_key() -> Column:
    """Company code and person id; null as soon as one of them is."""
    return F.concat(F.col("stock_code").cast("string"), F.lit("_"), F.col("id").cast("string"))


def combined_holders(officers: DataFrame, shareholders: DataFrame | None = None) -> DataFrame:
    """Officers, plus an optional second source whose rows may flag organisations."""
    if shareholders is None:
        rows = officers
    else:
        rows = officers.unionByName(shareholders, allowMissingColumns=True)
    flag = F.col("is_organization") if "is_organization" in rows.columns else F.lit(None)
    return rows.withColumns(
        {
            "holder_id": holder_key(),
            "is_organization": F.coalesce(flag.cast("boolean"), F.lit(False)),
        }
    )


def dim_holder(officers: DataFrame, shareholders: DataFrame | None = None) -> DataFrame:
    """One row per holder: the latest, then the first name in order.

    Each task keeps one row per holder before the shuffle (the rank filter is pushed
    into the window), so a holder with very many rows costs no more than others.
    """
    rows = combined_holders(officers, shareholders).select(
        "holder_id",
        F.col("officer_name").alias("full_name"),
        "is_organization",
        F.col("update_date").try_cast("date").alias("updated_at"),
    )
    newest_first = Window.partitionBy("holder_id").orderBy(
        F.desc_nulls_last("updated_at"), F.asc_nulls_last("full_name"), F.desc("is_organization")
    )
    ranked = rows.withColumn("__rank", F.row_number().over(newest_first))
    return ranked.where(F.col("__rank") == 1).drop("__rank")


def fact_ownership(
    officers: DataFrame, shareholders: DataFrame | None = None, typed: bool = True
) -> DataFrame:
    """Stakes of holders; not ``typed``, values stay as they come, for a check before the cast."""

    def value(name: str, dtype) -> Column:
        return F.col(name).try_cast(dtype) if typed else F.col(name)

    return combined_holders(officers, shareholders).select(
        "stock_code",
        "holder_id",
        F.col("officer_position").alias("position"),
        value("quantity", "long").alias("shares_count"),
        value("officer_own_percent", model.STAKE).alias("ownership_ratio"),
        value("update_date", "date").alias("report_date"),
    )


def fact_subsidiary(raw: DataFrame) -> DataFrame:
    """Rename to warehouse names and spell out the type; anything but ``aff`` is a subsidiary."""
    renamed = raw.withColumnsRenamed(
        {
            "stock_code": "parent_stock_code",
            "comp_name": "subsidiary_name",
            "comp_type": "subsidiary_type",
        }
    )
    affiliate = F.col("subsidiary_type") == "aff"
    return renamed.withColumn(
        "subsidiary_type", F.when(affiliate, "Affiliate").otherwise("Subsidiary")
    )


def dim_date(prices: DataFrame, fill_gaps: bool = False) -> DataFrame:
    """Calendar rows of the trading days, in order.

    ``fill_gaps`` lists every day between the first and the last one instead.
    """
    if fill_gaps:
        span = prices.agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"))
        days = span.select(F.explode(F.sequence("lo", "hi")).alias("date_id"))
    else:
        days = prices.select(field_ref("trade_date").alias("date_id")).distinct()
        days = days.where(F.col("date_id").isNotNull())
    day = F.col("date_id")
    return days.select(
        day,
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        is_weekend(day).alias("is_weekend"),
        F.date_format(day, "EEEE").alias("day_of_week"),
    ).orderBy("date_id")
