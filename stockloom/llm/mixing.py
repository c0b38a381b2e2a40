"""A training mix of sources by a time-varying curriculum.

Sources share the words of all texts by weight. A source is taken at most ``MOST`` times; what
it can't give is shared again by weight among the others, until none is above its limit. In
closed form: sources in the order of limit / weight are at their limit up to some place, and
all behind it share the rest.

A source's weight changes while training runs from 0 to 1: it starts at ``1 - tilt`` times
its share and ends at ``1 + tilt`` times, so its integral stays the share. A document at some
place of its source's words is due when the integral reaches that place; a source that is
taken more than once starts over. Documents are range-sorted by that time.

A null text has no words. Null sources form one source, the last in order. Documents of a
source stand in an order mixed by a hash of their id. Rows equal in id, source and
size are told apart in any order, so reruns give the same rows. Empty tables give no rows,
and sources without words get nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom.llm.rows import ROW, with_row
from stockloom.llm.running import running_total, scattered
from stockloom.sources.scratch import stage

WEIGHTS = (5, 2, 1)  #: by place of the source in code-point order, again and again
TILTS = (-0.5, 0.0, 0.5)  #: change of weight over time, by place in the same way
MOST = 3
CELLS = 4096  #: cells of a source, each put in order by itself
WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size``, the words of the text; a column of that name is replaced."""
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint"))


def targets(
    rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, tilts: tuple[float, ...] = TILTS, most: int = MOST
) -> DataFrame:
    """One row per source: ``__source``, source, source_size, weight, tilt, target (words as double).

    The windows run over one row per source.
    """
    totals = rows.groupBy("__source").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1

    def cycled(values):
        return F.element_at(F.array(*map(F.lit, values)), place % len(values) + 1)

    weighed = totals.withColumns({"weight": cycled(weights), "tilt": cycled(tilts)})
    limit = F.col("source_size") * most
    order = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()
    nothing = F.lit(0)
    left = F.sum("source_size").over(everyone) - F.coalesce(F.sum(limit).over(before), nothing)
    sharing = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), nothing)
    # the level at which this source and all behind it would share what is left
    leveled = weighed.withColumn("__level", left.cast("double") / sharing)
    level = F.max(F.when(F.col("__level") * F.col("weight") <= limit, F.col("__level"))).over(everyone)
    return leveled.withColumn(
        "target", F.least(limit.cast("double"), F.coalesce(level * F.col("weight"), limit.cast("double")))
    ).drop("__level")


def due(x, tilt):
    """Time at which a source has given the share ``x`` of its target."""
    lead = 1 - tilt
    return 2 * x / (lead + F.sqrt(lead * lead + 4 * tilt * x))


def mixed(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, tilts: tuple[float, ...] = TILTS, most: int = MOST
) -> DataFrame:
    """``docs``, which have ``size``, with source_size, target, taken, tilt and offset.

    ``offset`` counts the words of the source before the document. ``taken`` counts the words that the
    mix takes of it, repeats included: the last document of a source is taken in part, so
    that a source gives its target to the word. Columns of these names are replaced.
    """
    names = ["source_size", "target", "taken", "tilt", "offset"]
    plain = docs.drop(*names)
    keyed = plain.withColumns(
        {
            "__source": F.coalesce(F.concat(F.lit("="), "source"), F.lit("")),
            "__cell": scattered("doc_id", CELLS),
        }
    )
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "size")]
    placed = running_total(keyed, "__source", "__cell", order, "size", "offset", "mixing")
    goals = stage(targets(placed.select("__source", "source", "size"), weights, tilts, most), "mixing-targets")
    rows = placed.join(goals.select("__source", "source_size", "target", "tilt"), "__source")
    rounds, rest = F.expr("quota div source_size"), F.expr("quota % source_size")
    taken = rounds * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("offset")))
    return (
        rows.withColumn("quota", F.round("target").cast("bigint"))
        .withColumn("taken", F.when(F.col("source_size") > 0, taken).otherwise(F.lit(0)).cast("bigint"))
        .select(*plain.columns, *names)
    )


def positions(mix: DataFrame) -> DataFrame:
    """One row per document and time it is read, with ``position``, its place in the order of training.

    A document is read once more if at least half of it is still wanted; then it is read whole.
    """
    left = F.col("taken") - F.col("size") * F.floor(F.col("taken") / F.col("size"))
    times = F.floor(F.col("taken") / F.col("size")) + F.when(2 * left >= F.col("size"), 1).otherwise(0)
    again = mix.where("taken > 0").withColumn("times", times.cast("int")).where("times > 0")
    share = (F.col("offset") + F.col("round") * F.col("source_size")) / F.col("target")
    return (
        again.withColumn("round", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
        .withColumn("position", due(F.least(share, F.lit(1.0)), F.col("tilt")))
        .drop("times", "round")
    )


def in_training_order(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as they are read, in the order of training, with the columns of ``docs``.

    Places are found for ids, sources, sizes and a 128-bit hash of each row; texts join them once, at the end.
    Rows equal throughout share that hash, so one copy of them stands for all.
    """
    marked = with_row(docs)
    mix = mixed(sized(marked.select("doc_id", "source", "text", *ROW)).drop("text"))
    times = positions(mix).select(F.col("position").alias("__position"), F.col("doc_id").alias("__id"), *ROW)
    whole = marked.dropDuplicates(ROW).join(times, ROW)
    return whole.orderBy("__position", "__id", *ROW).select(*docs.columns)
