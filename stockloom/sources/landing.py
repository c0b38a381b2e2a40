"""Landing zone: raw tables as CSV, JSON lines or parquet below one root folder.

The root may be any URI Spark can reach (object store, HDFS, local path).
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.functions.columns import field_ref
from stockloom.sources.scratch import folder_names

FORMATS = ("parquet", "csv", "json")

# Quotes are doubled inside quoted cells, as spreadsheet tools and pandas write them.
CSV = {"header": "true", "sep": ",", "quote": '"', "escape": '"'}
# Times keep their microseconds, texts their outer blanks; an empty text is quoted, a null isn't.
_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
_CSV_WRITER = {
    **CSV,
    **_TIMES,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "emptyValue": '""',
}
EMPTY = "\u0001empty\u0001"  # stands for a quoted empty cell while a file is parsed
MARK = "__row"  # a second column of tables with one: a null alone would be a blank line, which isn't a record


def scan_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Scan CSV files by header name, without a type-inference pass.

    Only the header line is read up front. Every file must carry that header, or the
    scan fails: matching by position would silently mix columns. With a ``schema`` the
    known columns are cast (a bad cell becomes null) and missing ones are null;
    unknown columns are never parsed. Without one, all columns are text. A quoted empty
    cell is an empty text, an unquoted one is null.

    ``multiline`` allows line breaks inside quoted cells; such files cannot be split,
    so keep it off for big files.
    """
    reader = spark.read.options(**CSV, emptyValue=EMPTY).option("multiLine", multiline)
    header = reader.csv(path).columns
    as_text = T.StructType([T.StructField(name, T.StringType()) for name in header])
    cells = reader.option("enforceSchema", False).schema(as_text).csv(path)
    rows = cells.select(
        *[
            F.when(field_ref(c) != EMPTY, field_ref(c)).when(field_ref(c) == EMPTY, "").alias(c)
            for c in header
            if c != MARK
        ]
    )
    return rows if schema is None else conform(rows, schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` by name, cast softly, null where absent."""
    present = set(df.columns)
    return df.select(
        *[
            (field_ref(f.name) if f.name in present else F.lit(None))
            .try_cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )


class LandingZone:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, relative: str) -> str:
        return f"{self.root}/{relative}"

    def files(self, *relative: str) -> DataFrame:
        """path, length, modified of the files of landed tables; their contents aren't read."""
        paths = [r if "://" in r or r.startswith("/") else self.path(r) for r in relative]
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
        return listed.select("path", "length", F.col("modificationTime").alias("modified"))

    def fingerprint(self, files: DataFrame) -> str:
        """The same text for the same files with the same lengths and times; their list stays in Spark."""
        seen = F.xxhash64("path", "length", "modified")
        print_ = F.concat(F.hex(F.count("*")), F.lit("-"), F.hex(F.bit_xor(seen)))
        return files.agg(F.lower(print_)).first()[0]

    def save_dataframe(
        self,
        df: DataFrame | None,
        folder: str,
        file_name: str | None = None,
        file_format: str = "parquet",
        partition_cols: Sequence[str] = (),
        when_empty: str = "skip",
        **options: str,
    ) -> Landed | None:
        """Write a table and return its path, with the number of rows as ``rows``.

        An absent table is skipped: the result is null and an earlier load stays in place.
        So is an empty one, unless ``when_empty`` says ``"fail"`` (raise) or ``"write"``
        (replace what is there by an empty table). The test for rows fetches one row. A plan
        that shuffles would run up to its last shuffle for it, so pass such a table staged.

        A partitioned parquet table lives in ``folder`` itself and only the partitions
        present in ``df`` are replaced, so a repeated load gives the same files. Its types are
        written down beside it, so that text keys of partitions come back as text.
        """
        if when_empty not in ("skip", "fail", "write"):
            raise ValueError(f"when_empty {when_empty!r} is not one of skip, fail, write")
        file_format = file_format.lower()
        if file_format not in FORMATS:
            raise ValueError(f"format {file_format!r} is not one of {FORMATS}")
        if df is None:
            return None
        if when_empty != "write" and df.isEmpty():
            if when_empty == "fail":
                raise ValueError(f"no rows for {folder}")
            return None
        name = file_name or self._free_name(folder, file_format)
        if file_format == "csv" and len(df.columns) == 1:
            df = df.withColumn(MARK, F.lit(1))
        counted = Observation()
        writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        target = self.path(f"{folder}/{name}.{file_format}")
        if file_format == "parquet":
            writer = writer.option("compression", "snappy")
            if partition_cols:
                target = self.path(folder)
                writer = writer.partitionBy(*partition_cols).option(
                    "partitionOverwriteMode", "dynamic"
                )
                types = self.spark.createDataFrame([(df.schema.json(),)], "value string")
                types.coalesce(1).write.mode("overwrite").text(f"{target}.schema")
            writer.options(**options).parquet(target)
        elif file_format == "csv":
            writer.options(**_CSV_WRITER | options).csv(target)
        else:
            writer.options(**{"ignoreNullFields": "false"} | _TIMES | options).json(target)
        return Landed(target, counted.get["rows"])

    def _free_name(self, folder: str, file_format: str) -> str:
        """The default name, with a number behind it if that second has a table already."""
        taken, name = folder_names(self.spark, self.path(folder)), default_name()
        numbers = itertools.chain([""], (f"_{n}" for n in itertools.count(2)))
        return next(name + n for n in numbers if f"{name}{n}.{file_format}" not in taken)

    def read_dataframe(
        self,
        folder: str,
        file_name: str | None = None,
        file_format: str = "parquet",
        schema: T.StructType | None = None,
        multiline: bool = False,
    ) -> DataFrame:
        """Read a landed table. Without ``file_name``: the partitioned folder.

        ``multiline`` reads line breaks inside the quoted cells of CSV files, which then
        aren't split. JSON lines and parquet hold them in any case.
        """
        file_format = file_format.lower()
        if file_format not in FORMATS:
            raise ValueError(f"format {file_format!r} is not one of {FORMATS}")
        relative = folder if file_name is None else f"{folder}/{file_name}.{file_format}"
        path = self.path(relative)
        try:
            if file_format == "csv":
                return scan_csv(self.spark, path, schema, multiline)
            if schema is None and file_name is None:
                schema = self._types(path)
            reader = self.spark.read if schema is None else self.spark.read.schema(schema)
            if file_format == "json":
                reader = reader.options(**_TIMES)
            found = reader.format(file_format).load(path)
            return found if schema is None else found.select(*map(field_ref, schema.names))
        except AnalysisException as error:
            raise FileNotFoundError(f"cannot read {path}: {error}") from error

    def _types(self, path: str) -> T.StructType | None:
        """Types written down beside a partitioned table, if any."""
        try:
            held = self.spark.read.text(f"{path}.schema").first()
        except AnalysisException:
            return None
        return T.StructType.fromJson(json.loads(held.value))


class Landed(str):
    """Path of a landed table, with its number of rows."""

    rows: int

    def __new__(cls, path: str, rows: int):
        landed = super().__new__(cls, path)
        landed.rows = rows
        return landed


def default_name(now: datetime | None = None) -> str:
    return "data_" + (now or datetime.now()).strftime("%Y%m%d_%H%M%S")
