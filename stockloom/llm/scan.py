"""What lies before or behind each node of a sequence, by a tree of bounded fan-out.

A sequence is cut into nodes that each carry a small list of integers. ``combine`` is associative.
Nodes are combined in groups of ``FAN``, these groups again, until every sequence is one node; then
every node learns, group by group on the way down, what is combined in front of it (or behind it).
No task holds more than ``FAN`` nodes of a sequence at once, and rounds grow with the logarithm
of the longest one.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from stockloom.sources.scratch import stage

FAN = 64
_LONGS = ArrayType(LongType())
_PLACED = ArrayType(StructType([StructField("idx", LongType()), StructField("before", _LONGS)]))
_ARROW = pa.list_(pa.struct({"idx": pa.int64(), "before": pa.list_(pa.int64())}))


def _children(nodes: DataFrame) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("idx", "value")))
    return nodes.groupBy("k", F.expr(f"idx div {FAN}").alias("up")).agg(parts.alias("parts"))


def scanned(
    nodes: DataFrame, combine: Callable[[list, list], list], identity: list[int], label: str, behind: bool = False
) -> DataFrame:
    """``k``, ``idx``, ``before``: the values of the same ``k`` at smaller ``idx``, combined in order.

    ``nodes`` has ``k`` (not null), ``idx`` (at least 0, unique within ``k``) and ``value`` (longs). With
    ``behind`` those at larger ``idx`` are combined, still in rising order.
    """

    @F.arrow_udf(_LONGS)
    def together(parts: pa.Array) -> pa.Array:
        out = []
        for group in parts.to_pylist():
            value = group[0]["value"]
            for part in group[1:]:
                value = combine(value, part["value"])
            out.append(value)
        return pa.array(out, pa.list_(pa.int64()))

    @F.arrow_udf(_PLACED)
    def apart(parts: pa.Array, outer: pa.Array) -> pa.Array:
        out = []
        for group, value in zip(parts.to_pylist(), outer.to_pylist()):
            placed = []
            for part in reversed(group) if behind else group:
                placed.append({"idx": part["idx"], "before": value})
                value = combine(part["value"], value) if behind else combine(value, part["value"])
            out.append(placed)
        return pa.array(out, _ARROW)

    levels = []
    while True:
        grouped = stage(_children(nodes), label)
        levels.append(grouped)
        nodes = grouped.select("k", F.col("up").alias("idx"), together("parts").alias("value"))
        crowded = grouped.groupBy("k").count().where("count > 1")
        if crowded.isEmpty():
            break
    start = F.array(*(F.lit(v).cast("long") for v in identity))
    outer = levels[-1].select("k", F.col("up").alias("idx"), start.alias("before"))
    for grouped in reversed(levels):
        met = grouped.join(outer.select("k", F.col("idx").alias("up"), "before"), ["k", "up"])
        placed = F.explode(apart("parts", "before"))
        outer = stage(met.select("k", placed.alias("p")).select("k", "p.idx", "p.before"), label)
    return outer
