"""Running totals within groups of any size, without sorting a group in one task."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.sources.scratch import stage

#: Fixed values of a multiplicative hash modulo 2**64.
FACTOR, MODULUS = 2862933555777941757, 1 << 64


def _whole(value: int) -> Column:
    return F.lit(Decimal(value))


def unsigned(key: Column | str) -> Column:
    """A long as an unsigned decimal; null counts as 0."""
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.coalesce(key, F.lit(0)).cast("decimal(20,0)"), _whole(MODULUS))


def times_factor(key: Column, plus: int = 0) -> Column:
    """``key * FACTOR + plus`` modulo 2**64, in decimals since a long would overflow."""
    wide = key.cast("decimal(20,0)") * _whole(FACTOR) + F.lit(plus)
    return (wide % _whole(MODULUS)).cast("decimal(20,0)")


def whole_part(key: Column, divisor: int) -> Column:
    return F.call_function("div", key, _whole(divisor))


def scattered(key: Column | str, cells: int) -> Column:
    """A cell from 0 to ``cells - 1`` for a long, evenly filled by consecutive keys as well."""
    return F.pmod(whole_part(times_factor(unsigned(key)), 1 << 32), F.lit(cells)).cast("int")


def running_total(
    rows: DataFrame, group: str, cell: str, order: list[Column], amount: str, out: str, label: str
) -> DataFrame:
    """``rows`` with ``out``: the sum of ``amount`` over the rows of its group before it.

    Rows stand in the order of ``cell``, then ``order``; rows that tie throughout stand in any order.
    A group is cut into cells, rows are summed within cells, and the totals of the cells (one
    row each) are summed in front of them. A task sorts one cell at a time, never a group.
    ``group`` and ``cell`` aren't null; nulls of ``amount`` count as nothing.
    """
    before = (Window.unboundedPreceding, -1)
    within = Window.partitionBy(group, cell).orderBy(*order).rowsBetween(*before)
    staged = stage(rows.withColumn(out, F.coalesce(F.sum(amount).over(within), F.lit(0))), label)
    totals = staged.groupBy(group, cell).agg(F.sum(amount).alias("__total"))
    across = Window.partitionBy(group).orderBy(cell).rowsBetween(*before)
    offsets = totals.select(group, cell, F.coalesce(F.sum("__total").over(across), F.lit(0)).alias("__offset"))
    return staged.join(offsets, [group, cell]).withColumn(out, F.col(out) + F.col("__offset")).drop("__offset")
