"""Concatenation of tables from several sources."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_tagged(
    sources: Mapping[str, DataFrame | None], tag: str, skip_empty: bool = False
) -> DataFrame:
    """Stack tables with differing columns and tag each row with its source.

    Columns a source lacks are null. Absent sources are skipped. With ``skip_empty`` empty ones
    are, too, and add no columns; the test fetches one row of each source, so pass sources
    that shuffle staged.
    """
    kept = [
        df.withColumn(tag, F.lit(name))
        for name, df in sources.items()
        if df is not None and not (skip_empty and df.isEmpty())
    ]
    if not kept:
        raise ValueError("there is no source")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kept)


def tag_from_path(pattern: str) -> Column:
    """Source tag cut out of the path of the file a row was scanned from."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
