"""Readers of the landed raw tables, ready for the transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stockloom import model
from stockloom.operators.normalize import normalize_prices, normalize_statement
from stockloom.sources.landing import LandingZone, scan_csv
from stockloom.sources.scan import Scan, scan_files
from stockloom.sources.scratch import stage

WITH_TEXTS = ("industries", "enterprise", "leadership", "subsidiaries")


def scan(zone: LandingZone, name: str) -> Scan:
    """Scan one of the raw tables named in ``model.LANDED_PATHS``, whose files may have differing headers.

    The texts of pages and replies may hold line breaks; these tables, with a few rows per
    company, are read with them. Statements and prices hold none, and their files are split.
    """
    return scan_files(zone.spark, zone.path(model.LANDED_PATHS[name]), name in WITH_TEXTS)


def scan_landed(zone: LandingZone, name: str, schema: T.StructType | None = None) -> DataFrame:
    """The sound records of a raw table."""
    return scan(zone, name).rows(schema)


def read_industries(zone: LandingZone) -> DataFrame:
    return scan_landed(zone, "industries", model.RAW_INDUSTRY)


def read_enterprises(zone: LandingZone) -> DataFrame:
    return scan_landed(zone, "enterprise", model.RAW_ENTERPRISE)


def read_industry_map(zone: LandingZone, path: str) -> DataFrame:
    """Mapping of companies to industries; the path must be visible to every executor."""
    return scan_csv(zone.spark, path, model.RAW_INDUSTRY_MAP)


def read_leadership(zone: LandingZone) -> DataFrame:
    return scan_landed(zone, "leadership", model.RAW_LEADERSHIP)


def read_subsidiaries(zone: LandingZone) -> DataFrame:
    return scan_landed(zone, "subsidiaries", model.RAW_SUBSIDIARY)


# The readers below take the text of a table that is already scanned, or scan it themselves.


def read_income(zone: LandingZone, text: DataFrame | None = None) -> DataFrame:
    return _read_statement(zone, "income", text)


def read_balance(zone: LandingZone, text: DataFrame | None = None) -> DataFrame:
    return _read_statement(zone, "balance", text)


def read_prices(zone: LandingZone, text: DataFrame | None = None) -> DataFrame:
    return normalize_prices(scan_landed(zone, "prices") if text is None else text)


def _read_statement(zone: LandingZone, name: str, text: DataFrame | None) -> DataFrame:
    # Staged: the search for empty columns and all later actions then read
    # single columns of parquet files instead of parsing the text again.
    return normalize_statement(stage(scan_landed(zone, name), name) if text is None else text)
