"""Surrogate keys without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom.sources.scratch import stage

_PART = "__part"
_SLOT = "__slot"
_FILE = "__file"
_ROW = "__row"
_SLOT_BITS = (1 << 33) - 1  # low bits of monotonically_increasing_id


def with_surrogate_keys(
    df: DataFrame, name: str, order_by: Sequence[str], start: int = 0, unique: bool = True
) -> DataFrame:
    """Number the rows ``start + 1 .. start + n`` in the order of ``order_by``.

    The range sort spreads even a hot leading key over many tasks, because the whole
    key is compared. Each row then keeps its partition and its slot inside it; both
    are written down once, since a second run of the range sampling could cut the
    partitions elsewhere. Partition sizes are one row per partition, so their running
    sum is small whatever the table holds.

    Pass ``unique=False`` where many rows may share one key: they are then written
    first and told apart by their place in the files, so that copies, too, spread over
    the tasks, and in the same way if a task runs again.
    """
    rows, order = df, [F.col(c) for c in order_by]
    if not unique:
        rows = stage(df, "unordered").select(
            "*",
            F.col("_metadata.file_name").alias(_FILE),
            F.col("_metadata.row_index").alias(_ROW),
        )
        order += [F.col(_FILE), F.col(_ROW)]
    slotted = rows.orderBy(*order).select(
        *df.columns,
        F.spark_partition_id().alias(_PART),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_SLOT_BITS)).alias(_SLOT),
    )
    staged = stage(slotted, "surrogate")
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy(_PART)
        .agg(F.count("*").alias("__rows"))
        .select(_PART, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    )
    # One row per partition of the sort: a bounded side, whatever size the planner assumes.
    numbered = staged.join(F.broadcast(offsets), _PART)
    key = F.col("__offset") + F.col(_SLOT) + F.lit(start + 1)
    return numbered.select(key.cast("long").alias(name), *df.columns)


def with_sparse_keys(df: DataFrame, name: str, start: int = 0) -> DataFrame:
    """Unique ids above ``start``, with gaps and in no order, without any shuffle.

    The ids of a row depend on the run, so write the result once and read it back.
    """
    return df.select((F.monotonically_increasing_id() + F.lit(start + 1)).alias(name), "*")
