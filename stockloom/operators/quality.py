"""Data-quality checks derived from the table contracts.

Row checks read the table once and return one line per checked column. Key checks
aggregate before they shuffle or join, so one frequent key does not weigh on a task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.functions.columns import field_ref
from stockloom.model import WAREHOUSE, Field, Reference, Table


def _count_per_field(
    df: DataFrame, table: Table, checks: Iterable[tuple[Field, Column]], detail: str | None = None
) -> DataFrame:
    """One pass over ``df``; a line (table, column[, detail], violations) per check."""
    checks = list(checks)
    counts = df.agg(*[F.count_if(bad).alias(f"v{i}") for i, (_, bad) in enumerate(checks)])
    lines = []
    for i, (f, _) in enumerate(checks):
        parts = [F.lit(table.name).alias("table_name"), F.lit(f.name).alias("column_name")]
        if detail == "max_length":
            parts.append(F.lit(f.max_length).alias("max_length"))
        elif detail == "decimal_type":
            parts.append(F.lit(f.dtype.simpleString()).alias("decimal_type"))
        parts.append(F.col(f"v{i}").alias("violations"))
        lines.append(F.struct(*parts))
    return counts.select(F.inline(F.array(*lines)))


def check_not_null(df: DataFrame, table: Table) -> DataFrame:
    return _count_per_field(
        df,
        table,
        [
            (f, field_ref(f.name).isNull())
            for f in table.fields
            if f.required and f.name in df.columns
        ],
    )


def check_lengths(df: DataFrame, table: Table) -> DataFrame:
    return _count_per_field(
        df,
        table,
        [
            (f, F.length(field_ref(f.name)) > f.max_length)
            for f in table.fields
            if f.max_length and f.name in df.columns
        ],
        detail="max_length",
    )


def check_decimal_range(df: DataFrame, table: Table) -> DataFrame:
    """Values, of any numeric or text type, that do not fit the column's decimal type."""
    return _count_per_field(
        df,
        table,
        [
            (f, field_ref(f.name).isNotNull() & field_ref(f.name).try_cast(f.dtype).isNull())
            for f in table.fields
            if isinstance(f.dtype, T.DecimalType) and f.name in df.columns
        ],
        detail="decimal_type",
    )


def row_faults(df: DataFrame, table: Table) -> Column:
    """What the contract refuses in a row: an array of ``column: reason``, empty for a sound row.

    Looks at the values as they come, before they are cast to the contract's types.
    """
    faults = []
    for f in table.fields:
        if f.surrogate:
            continue
        reason = None
        if f.name in df.columns:
            value = field_ref(f.name)
            exact = isinstance(f.dtype, T.DecimalType)
            misfit = value.isNotNull() & value.try_cast(f.dtype).isNull()
            reason = F.when(misfit, "out of range" if exact else "unreadable")
            if f.max_length:
                reason = F.coalesce(reason, F.when(F.length(value) > f.max_length, "too long"))
        if f.required and f.default is None:
            absent = field_ref(f.name).isNull() if f.name in df.columns else F.lit(True)
            missing = F.when(absent, "missing")
            reason = missing if reason is None else F.coalesce(missing, reason)
        if reason is not None:
            faults.append(F.concat(F.lit(f"{f.name}: "), reason))
    return F.array_compact(F.array(*faults)) if faults else F.array().cast("array<string>")


def with_faults(df: DataFrame, table: Table) -> DataFrame:
    return df.withColumn("faults", row_faults(df, table))


def reject_lines(bad: DataFrame, table: str, columns: Iterable[str]) -> DataFrame:
    """Refused rows, with their ``faults``, as they are kept: table_name, faults, record (JSON)."""
    return bad.select(
        F.lit(table).alias("table_name"),
        F.array_join("faults", "; ").alias("faults"),
        F.to_json(F.struct(*map(field_ref, columns))).alias("record"),
    )


def rejected(df: DataFrame, table: Table) -> DataFrame:
    """The rows that the contract refuses for themselves: table_name, faults, record (JSON)."""
    return reject_lines(with_faults(df, table).where(F.size("faults") > 0), table.name, df.columns)


def unreadable_cells(text: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """(table_name, column_name, violations > 0): text cells that don't fit the type of their column."""
    typed = [f for f in schema if f.name in text.columns and not isinstance(f.dataType, T.StringType)]
    if not typed:
        return text.sparkSession.createDataFrame([], "table_name string, column_name string, violations long")
    bad = {
        f.name: (F.trim(field_ref(f.name)) != "") & field_ref(f.name).try_cast(f.dataType).isNull() for f in typed
    }
    counts = text.agg(*[F.count_if(b).alias(f"v{i}") for i, b in enumerate(bad.values())])
    lines = [
        F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.col(f"v{i}").alias("violations"))
        for i, c in enumerate(bad)
    ]
    return counts.select(F.inline(F.array(*lines))).where("violations > 0")


def duplicate_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows.

    As in a database, keys holding a null never clash.
    """
    keys = list(keys)
    complete = df.dropna(subset=keys)
    return complete.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def check_unique_keys(df: DataFrame, table: Table) -> DataFrame:
    """One line per key of the contract: clashing key values and surplus rows."""
    lines = []
    for keys in table.keys():
        clashes = duplicate_keys(df, keys)
        lines.append(
            clashes.agg(
                F.count("*").alias("duplicated_keys"),
                F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus_rows"),
            ).select(
                F.lit(table.name).alias("table_name"),
                F.lit(",".join(keys)).alias("key_columns"),
                "duplicated_keys",
                "surplus_rows",
            )
        )
    result = lines[0]
    for line in lines[1:]:
        result = result.unionByName(line)
    return result


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child key values without a parent, with the number of rows that hold them.

    The child is reduced to its distinct keys first; only those meet the parent table.
    """
    used = (
        child.where(field_ref(column).isNotNull())
        .groupBy(field_ref(column).alias("missing_key"))
        .agg(F.count("*").alias("child_rows"))
    )
    known = parent.select(field_ref(parent_column).alias("missing_key"))
    return used.join(known, "missing_key", "left_anti")


def check_foreign_keys(
    child: DataFrame, table: str, references: Iterable[Reference], parents: Mapping[str, DataFrame]
) -> DataFrame:
    result = None
    for ref in references:
        lines = orphans(child, ref.column, parents[ref.parent], ref.parent_column).select(
            F.lit(table).alias("child_table"),
            F.lit(ref.column).alias("child_column"),
            F.lit(ref.parent).alias("parent_table"),
            F.col("missing_key").cast("string").alias("missing_key"),
            "child_rows",
        )
        result = lines if result is None else result.unionByName(lines)
    if result is None:
        raise ValueError(f"table {table} has no references")
    return result


def warehouse_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every check of every loaded table: (check, table_name, subject, violations > 0)."""
    def tagged(df: DataFrame, check: str, subject: str, count: str) -> DataFrame:
        return df.select(
            F.lit(check).alias("check"),
            "table_name",
            F.col(subject).alias("subject"),
            F.col(count).alias("violations"),
        )

    parts = []
    for name, df in tables.items():
        table = WAREHOUSE[name]
        parts.append(tagged(check_not_null(df, table), "not_null", "column_name", "violations"))
        if any(f.max_length for f in table.fields):
            parts.append(tagged(check_lengths(df, table), "length", "column_name", "violations"))
        if any(isinstance(f.dtype, T.DecimalType) for f in table.fields):
            parts.append(
                tagged(check_decimal_range(df, table), "decimal", "column_name", "violations")
            )
        if table.keys():
            parts.append(
                tagged(check_unique_keys(df, table), "unique", "key_columns", "surplus_rows")
            )
        if table.references:
            missing = check_foreign_keys(df, name, table.references, tables)
            counted = missing.groupBy(
                F.col("child_table").alias("table_name"), F.col("child_column").alias("subject")
            ).agg(F.sum("child_rows").alias("violations"))
            parts.append(tagged(counted, "reference", "subject", "violations"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.where("violations > 0")
