"""Carry the last label down the rows of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.functions.columns import strip_space

_STRETCH = "__stretch"
_SEED = "__seed"


def group_label(text: Column, stop_words: Sequence[str] = ()) -> Column:
    """The stripped text, or null where it is blank or a heading word."""
    label = strip_space(text)
    return F.when((label != "") & ~label.isin(*stop_words), label)


def carry_forward(
    df: DataFrame,
    label: str,
    output: str,
    group_by: Sequence[str],
    position: str,
    chunk_rows: int | None = 1_000_000,
) -> DataFrame:
    """Fill ``output`` with the last non-null ``label`` at or before each row.

    ``position`` is an integer, unique within a group. Groups are cut into stretches of
    ``chunk_rows`` positions, so no window holds more rows than that, however large a
    group is. What a stretch inherits comes from a second, small table with the last
    label of every stretch. Pass ``chunk_rows=None`` when groups are known to be small,
    such as the rows of one document.
    """
    last_label = F.last(label, ignorenulls=True)
    if chunk_rows is None:
        running = Window.partitionBy(*group_by).orderBy(position)
        rows_so_far = running.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(output, last_label.over(rows_so_far))

    start = F.col(position) - F.pmod(F.col(position), F.lit(chunk_rows))
    cut = df.withColumn(_STRETCH, start.cast("long"))
    # Partial aggregation leaves one row per stretch and task before the shuffle, and a
    # group of n positions has n / chunk_rows stretches to run through here.
    ends = cut.groupBy(*group_by, _STRETCH).agg(
        F.max_by(label, F.when(F.col(label).isNotNull(), F.col(position))).alias(label)
    )
    earlier = (
        Window.partitionBy(*group_by)
        .orderBy(_STRETCH)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inherited = ends.withColumn(label, F.last(label, ignorenulls=True).over(earlier))
    # The inherited label goes in front of its stretch as a row of its own, so the big
    # table is shuffled once and meets no join.
    seeds = inherited.where(F.col(label).isNotNull()).withColumn(_SEED, F.lit(True))
    seeded = cut.withColumn(_SEED, F.lit(False)).unionByName(seeds, allowMissingColumns=True)
    stretch = Window.partitionBy(*group_by, _STRETCH).orderBy(F.desc(_SEED), position)
    rows_so_far = stretch.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = seeded.withColumn(output, last_label.over(rows_so_far))
    return filled.where(~F.col(_SEED)).select(*df.columns, output)
