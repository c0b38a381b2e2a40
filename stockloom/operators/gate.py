"""Refusal of rows before they are written: row checks, references and keys of a table's contract.

References are checked first, all those of a table in one plan on distinct keys; then keys, among the
rows that are left. Both look for the few values that are at fault and join only those back, so a clean batch is
read by narrow aggregates and joined with nothing. As in a database, a key that holds a null never
clashes, and a null reference refers to nothing.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.functions.columns import field_ref
from stockloom.model import Reference, Table
from stockloom.operators.quality import row_faults
from stockloom.sources.scratch import stage

ROW, FAULTS = "__row", "__faults"


def checked(df: DataFrame, table: Table) -> DataFrame:
    """``df``, staged, with an id per row and what the contract refuses in the row itself."""
    return stage(
        df.select(F.monotonically_increasing_id().alias(ROW), row_faults(df, table).alias(FAULTS), *map(field_ref, df.columns)),
        "gate",
    )


def gated(df: DataFrame, table: Table, parents: Mapping[str, DataFrame], existing: DataFrame | None = None) -> DataFrame:
    """The columns of ``df`` and ``faults``, empty for rows that may be written.

    ``parents`` has the referred tables by name; references to others aren't checked. ``existing`` has the rows
    that stay in the target. Of rows of the batch with one key the least stays, by all columns in their order.
    """
    rows = checked(df, table)
    rows = _with_orphans(rows, table.references, parents)
    for keys in table.keys():
        rows = _with_clashes(rows, df.columns, table, keys, existing)
    return rows.select(*map(field_ref, df.columns), F.col(FAULTS).alias("faults"))


def _sound(rows: DataFrame) -> DataFrame:
    return rows.where(F.size(FAULTS) == 0)


def _key(rows: DataFrame, table: Table, column: str) -> Column:
    """A column in the contract's type; null where the batch lacks it."""
    value = field_ref(column) if column in rows.columns else F.lit(None)
    return value.try_cast(table.field(column).dtype)


def _fault(rows: DataFrame, bad: Column, reason: str) -> Column:
    """The faults of a row, with ``reason`` if the row was sound and is bad."""
    return F.when((F.size(FAULTS) == 0) & F.coalesce(bad, F.lit(False)), F.array(F.lit(reason))).otherwise(F.col(FAULTS))


def missing_keys(rows: DataFrame, references: list[Reference], parents: Mapping[str, DataFrame]) -> DataFrame:
    """(ref, key): distinct values of the n-th reference that its parent lacks, for all references in one plan."""
    used = F.explode(
        F.array(*(F.struct(F.lit(i).alias("ref"), field_ref(r.column).cast("string").alias("key")) for i, r in enumerate(references)))
    )
    wanted = rows.select(used.alias("u")).select("u.ref", "u.key").where("key is not null").distinct()
    known = [
        parents[r.parent].select(F.lit(i).alias("ref"), field_ref(r.parent_column).cast("string").alias("key"))
        for i, r in enumerate(references)
    ]
    return wanted.join(reduce(DataFrame.union, known), ["ref", "key"], "left_anti")


def _with_orphans(rows: DataFrame, references: tuple[Reference, ...], parents: Mapping[str, DataFrame]) -> DataFrame:
    references = [r for r in references if r.parent in parents and r.column in rows.columns]
    if not references:
        return rows
    missing = missing_keys(_sound(rows), references, parents)
    if missing.isEmpty():
        return rows
    missing = stage(missing, "gate-orphans")
    for i, r in enumerate(references):
        lost = missing.where(F.col("ref") == i).select(F.col("key").alias("__key"), F.lit(True).alias("__lost"))
        met = rows.join(lost, field_ref(r.column).cast("string") == F.col("__key"), "left")
        reason = f"{r.column}: not in {r.parent}"
        rows = met.withColumn(FAULTS, _fault(met, F.col("__lost"), reason)).drop("__key", "__lost")
    return rows


def _with_clashes(
    rows: DataFrame, columns: list[str], table: Table, keys: tuple[str, ...], existing: DataFrame | None
) -> DataFrame:
    names = [f"__k{i}" for i in range(len(keys))]
    keyed = rows.withColumns({n: _key(rows, table, k) for n, k in zip(names, keys)})
    whole = _sound(keyed).dropna(subset=names)
    copies = whole.groupBy(*names).agg(F.count("*").alias("copies"))
    crowded = copies.where("copies > 1").select(*names)
    found = crowded.select(*names, F.lit(False).alias("__taken"))
    if existing is not None:
        held = existing.select(*(field_ref(k).alias(n) for n, k in zip(names, keys)))
        held = _within(held, whole, names).join(copies.select(*names), names, "left_semi").distinct()
        found = found.unionByName(held.select(*names, F.lit(True).alias("__taken")))
    if found.isEmpty():
        return rows
    # Only rows of clashing keys are compared, as whole rows; partial minima leave one row per key and task.
    found = stage(found.groupBy(*names).agg(F.max("__taken").alias("__taken")), "gate-keys")
    rivals = whole.join(found.where("not __taken").select(*names), names)
    least = rivals.groupBy(*names).agg(F.min(F.struct(*map(field_ref, columns), ROW)).alias("__least"))
    verdict = stage(
        found.join(least.select(*names, F.col(f"__least.{ROW}").alias("__stays")), names, "left"), "gate-verdict"
    )
    met = keyed.join(verdict, names, "left")
    subject = ",".join(keys)
    met = met.withColumn(FAULTS, _fault(met, F.col("__taken"), f"{subject}: already loaded"))
    met = met.withColumn(FAULTS, _fault(met, F.col("__stays") != F.col(ROW), f"{subject}: repeated"))
    return met.drop(*names, "__taken", "__stays")


def _within(held: DataFrame, whole: DataFrame, names: list[str]) -> DataFrame:
    """Rows of ``held`` between the least and the greatest key of the batch, column by column.

    The bounds reach the scan, which skips files and row groups outside them; the semi join behind gets Spark's own Bloom filter where it is worth it.
    """
    bounds = whole.agg(*(f(n).alias(f"{f.__name__}{n}") for n in names for f in (F.min, F.max))).first()
    for n in names:
        low, high = bounds[f"min{n}"], bounds[f"max{n}"]
        if low is None:
            return held.limit(0)
        held = held.where(F.col(n).between(F.lit(low), F.lit(high)))
    return held
