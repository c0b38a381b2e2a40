"""Queries against their oracles on tables where one key holds a third of the rows.

The driver tables are copied with hot customers, suppliers, parts, brands and users, and
with some null keys. Broadcasts are off and partitions small, as for big tables.
"""

import sys
from pathlib import Path

import pytest
from test_plans import NO_BROADCAST, SMALL_PARTITIONS, settings

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import compare

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are absent")

CHANGES = {
    "orders": """* REPLACE (
        CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 50 <> 49 THEN o_custkey END AS o_custkey)""",
    "lineitem": """* REPLACE (
        CASE WHEN l_orderkey % 3 = 0 THEN 3 WHEN l_orderkey % 50 <> 49 THEN l_suppkey END AS l_suppkey,
        CASE WHEN l_orderkey % 3 = 1 THEN 5 ELSE l_partkey END AS l_partkey,
        CASE WHEN l_orderkey % 70 <> 69 THEN l_shipdate END AS l_shipdate)""",
    "events": """* REPLACE (
        CASE WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 40 <> 39 THEN user_id END AS user_id)""",
    "part": "* REPLACE (CASE WHEN p_partkey % 3 = 0 THEN 'Brand#1' ELSE p_brand END AS p_brand)",
    "customer": "* REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 4 ELSE c_nationkey END AS c_nationkey)",
}

QUERIES = [
    "fact_financial_ratio",
    "fact_financial_ratio_merged",
    "fact_price_history",
    "quarter_end_price",
    "fact_financial_report",
    "balance_normalized",
    "dim_holder",
    "fact_ownership",
    "fact_subsidiary",
    "subsidiary_rows",
    "filter_universe",
    "filter_universe_limit",
    "forward_fill_label",
    "surrogate_keys",
    "check_unique_keys",
    "check_foreign_keys",
    "duplicate_line_keys",
    "safe_division",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    db = compare.connect(SF_DIR)
    for name in compare.TABLES:
        db.execute(
            f"COPY (SELECT {CHANGES.get(name, '*')} FROM {name}) TO '{folder}/{name}.parquet' (FORMAT parquet)"
        )
    return folder, compare.connect(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle_under_skew(spark, skewed, name):
    folder, db = skewed
    with settings(spark, **NO_BROADCAST, **SMALL_PARTITIONS):
        good, note = compare.compare(spark, db, folder, name)
    assert good, note
