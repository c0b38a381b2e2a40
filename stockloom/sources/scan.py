"""CSV files whose headers differ, and records that don't fit them.

The first line of every file is read in tasks, a task per file that stops behind it. Files with the same header are scanned together
and the scans are united by column name, so a column may stand anywhere and may be absent. A
record with more or fewer cells than its header is kept as a reject, with its file and text, and isn't among the rows.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.functions.columns import field_ref
from stockloom.sources.landing import CSV, EMPTY, MARK, conform

FILE, RECORD, EXPECTED, FILLED = "__file", "__record", "__expected", "__filled"
_WHOLE = str(1 << 50)  # more than any file has bytes
# Asking for the filled cells has all of them parsed: a record isn't judged by the columns that a query happens to read.
_WHOLE_RECORDS = f"{FILLED} >= 0"


def headers(spark: SparkSession, path: str | Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by their column names. Empty files have none and are left out.

    One line per file reaches the driver, which lists the files for a scan in any case.
    """
    own = spark.newSession()  # settings of this read only: a partition per file
    own.conf.set("spark.sql.files.maxPartitionBytes", _WHOLE)
    own.conf.set("spark.sql.files.openCostInBytes", _WHOLE)
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.slice(0, 1)
            return

    lines = own.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    found: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(lines.mapInArrow(first, "file string, value string").collect()):
        names = next(csv.reader([row.value.removeprefix("\ufeff")]), [])
        found.setdefault(_distinct(names), []).append(row.file)
    return found


def _distinct(names: list[str]) -> tuple[str, ...]:
    """Names told apart by their place where one is empty or repeated."""
    return tuple(n if n and names.count(n) == 1 else f"{n or '_c'}{i}" for i, n in enumerate(names))


@dataclass(frozen=True)
class Scan:
    """Cells as text, with the file and, of a malformed record, its text and the number of cells its header has."""

    cells: DataFrame

    def rows(self, schema: T.StructType | None = None) -> DataFrame:
        """Sound records; with ``schema`` its columns, cast softly."""
        text = self.cells.where(f"{RECORD} is null and {_WHOLE_RECORDS}").drop(FILE, RECORD, EXPECTED, FILLED, MARK)
        return text if schema is None else conform(text, schema)

    def rejects(self) -> DataFrame:
        """file, expected and found number of cells, record."""
        bare = F.regexp_replace(RECORD, r'(?s)"[^"]*"', "")  # separators within quotes are text
        return self.cells.where(f"{RECORD} is not null and {_WHOLE_RECORDS}").select(
            F.col(FILE).alias("file"),
            F.col(EXPECTED).alias("expected"),
            (F.regexp_count(bare, F.lit(",")) + 1).cast("int").alias("found"),
            F.col(RECORD).alias("record"),
        )


def scan_files(
    spark: SparkSession, path: str | Sequence[str], multiline: bool = False, tags: Mapping[str, str] | None = None
) -> Scan:
    """Scan all CSV files below ``path``. ``tags`` names columns to be taken from the file's path by a pattern's first group.

    ``multiline`` allows line breaks inside quoted cells; such files aren't split.
    """
    reader = spark.read.options(**CSV, emptyValue=EMPTY, columnPruning="false", columnNameOfCorruptRecord=RECORD)
    reader = reader.option("multiLine", multiline)

    def group(names: tuple[str, ...], files: list[str]) -> DataFrame:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, RECORD)])
        cells = reader.schema(schema).csv(files)
        origin = F.col("_metadata.file_path")
        return cells.select(
            *(F.when(field_ref(n) != EMPTY, field_ref(n)).when(field_ref(n) == EMPTY, "").alias(n) for n in names),
            *(F.regexp_extract(origin, p, 1).alias(t) for t, p in (tags or {}).items()),
            origin.alias(FILE),
            RECORD,
            F.lit(len(names)).alias(EXPECTED),
            reduce(Column.__add__, (field_ref(n).isNotNull().cast("int") for n in names)).alias(FILLED),
        )

    groups = [group(names, files) for names, files in headers(spark, path).items()]
    if not groups:
        names = [*(tags or {}), FILE, RECORD]
        fields = [T.StructField(n, T.StringType()) for n in names] + [T.StructField(n, T.IntegerType()) for n in (EXPECTED, FILLED)]
        return Scan(spark.createDataFrame([], T.StructType(fields)))
    return Scan(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups))
