"""Ticker universe and filters by a list of codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockloom import model
from stockloom.sources.scratch import stage

PAGE_RANGE = 1000  # pages whose counts are summed before single pages are looked at


def code_list(spark: SparkSession, codes: Sequence[str], name: str = "stock_code") -> DataFrame:
    return spark.createDataFrame([(c,) for c in codes], f"`{name}` string")


def ticker_universe(lists: Sequence[DataFrame]) -> DataFrame:
    """Set union of one-column code lists, sorted. The first list names the column."""
    union = lists[0]
    for codes in lists[1:]:
        union = union.union(codes)
    return union.distinct().orderBy(union.columns[0])


def default_universe(spark: SparkSession) -> DataFrame:
    return ticker_universe(
        [code_list(spark, model.LARGE_CAPS), code_list(spark, model.CHALLENGERS)]
    )


def filter_universe(
    rows: DataFrame,
    codes: DataFrame | Sequence[str] | None,
    column: str,
    code_column: str | None = None,
) -> DataFrame:
    """Keep rows whose code is listed; without a list, or with an empty one, keep all."""
    listed = _listed(rows, codes)
    if listed is None:
        return rows
    # A semi-join needs no distinct list. Without that step both sides come straight from
    # a shuffle, so adaptive execution can split the rows of a very frequent code.
    listed = listed.select(F.col(code_column or listed.columns[0]).alias(column))
    return rows.join(listed, column, "left_semi")


def _listed(rows: DataFrame, codes: DataFrame | Sequence[str] | None) -> DataFrame | None:
    """The list as a table; none if it is absent or empty, in either form."""
    if codes is None:
        return None
    if isinstance(codes, DataFrame):
        return None if codes.isEmpty() else codes
    return code_list(rows.sparkSession, codes) if codes else None


def take_until_found(
    rows: DataFrame,
    codes: DataFrame | Sequence[str] | None,
    column: str,
    page: str,
    max_pages: int | None = None,
) -> DataFrame:
    """Rows of a paged listing up to the page where enough listed codes were seen.

    Pages are read in order. Reading stops after the page on which the number of
    kept rows reaches the number of listed codes, and after page ``max_pages`` if given. With
    an empty list there is nothing to find and the first page is read; without a list, all are.
    Rows without a page belong to no page in that order: they are kept where all pages are read.

    The pages read are a prefix, so one number, found first, cuts the rows. They are kept
    once, written, and then counted by ranges of pages and inside one range only.
    """
    visited = rows if max_pages is None else rows.where(F.col(page) <= max_pages)
    if codes is None:
        return visited
    listed = _listed(rows, codes)
    if listed is None:
        first = visited.agg(F.min(page)).first()[0]
        return visited.where(F.col(page) == F.lit(first))
    kept = stage(filter_universe(visited, listed, column), "listing")
    last = _last_page(kept.select(F.col(page).alias("page")), listed.count())
    return kept if last is None else kept.where(F.col(page) <= last)


def _last_page(pages: DataFrame, wanted: int) -> int | None:
    """The page on which the running count of rows reaches ``wanted``; none if it never does."""
    pages = pages.where("page is not null")
    by_range = F.floor(F.col("page") / PAGE_RANGE)
    found = _reaching(pages.select(by_range.alias("at")), wanted)
    if found is None:
        return None
    inside = pages.where(by_range == found[0]).select(F.col("page").alias("at"))
    return _reaching(inside, wanted - found[1])[0]


def _reaching(places: DataFrame, wanted: int) -> tuple[int, int] | None:
    """First place where the running count reaches ``wanted``, and the count before it."""
    # One row per range of pages, or per page of one range, after the partial counts.
    counts = places.groupBy("at").agg(F.count("*").alias("n"))
    so_far = F.sum("n").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    reached = counts.withColumn("sum", so_far).where(F.col("sum") >= wanted)
    first = reached.agg(F.min(F.struct("at", (F.col("sum") - F.col("n")).alias("before"))).alias("r")).first()
    return first.r and (first.r.at, first.r.before)
