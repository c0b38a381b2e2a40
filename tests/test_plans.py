"""Shapes of physical plans that matter at scale."""

import re
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stockloom.operators.dimensions import dim_holder
from stockloom.operators.prices import quarter_end_price
from stockloom.operators.quality import orphans
from stockloom.operators.surrogate import with_surrogate_keys
from stockloom.operators.universe import filter_universe
from stockloom.plans import shapes
from stockloom.plans.catalogue import QUERIES

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are absent")


@contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}


@needs_tables
@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n != "warehouse_tables" and not n.startswith("loaded_")))
def test_no_query_pairs_all_rows(spark, name):
    with settings(spark, **NO_BROADCAST):
        text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@needs_tables
@pytest.mark.parametrize(
    "name", ["industry_rows", "page_profile", "page_links", "kv_section", "list_with_fallback", "extract_code", "strip_diacritics"]
)
def test_pages_are_read_once_in_python(spark, name):
    assert len(re.findall(r"ArrowEvalPython", plan(QUERIES[name](spark, SF_DIR)))) == 1


@needs_tables
@pytest.mark.parametrize("name", ["page_profile", "page_links", "kv_section", "list_with_fallback", "extract_code", "subsidiary_rows", "safe_division", "fact_subsidiary", "union_tagged_sources"])
def test_row_local_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(QUERIES[name](spark, SF_DIR))


@needs_tables
def test_line_items_are_scanned_once_for_the_ratios(spark):
    text = plan(QUERIES["fact_financial_ratio"](spark, SF_DIR))
    assert "lineitem" not in text  # read from the staged quarterly sums


@needs_tables
def test_columns_are_pruned(spark):
    text = plan(QUERIES["dim_date"](spark, SF_DIR))
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in text


@needs_tables
def test_survivors_are_limited_before_the_shuffle(spark):
    text = plan(dim_holder(shapes.leadership(spark, SF_DIR)))
    assert re.search(r"WindowGroupLimit.*Final[\s\S]*Exchange[\s\S]*WindowGroupLimit.*Partial", text)


def test_quarter_end_is_hashed_not_sorted(spark):
    fact = spark.range(10).select(
        F.lit("A").alias("stock_code"),
        F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("trade_date"),
        F.lit(1).cast("decimal(15,2)").alias("close"),
        F.lit(1).cast("decimal(20,2)").alias("market_cap"),
    )
    text = plan(quarter_end_price(fact))
    assert "partial_max_by" in text and "Sort" not in text


SMALL_PARTITIONS = {
    "spark__sql__shuffle__partitions": "16",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "40KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
}


def hot_rows(spark, path, n=60_000):
    """Rows of which a third hold the code 7."""
    spark.range(0, n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5_000).alias("code"),
        F.rand(1).alias("value"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_a_frequent_code_is_split_in_the_list_filter(spark, tmp_path):
    rows = hot_rows(spark, f"{tmp_path}/rows.parquet")
    listed = spark.range(5_000).where("id % 2 = 1").select(F.col("id").alias("code"))
    with settings(spark, **NO_BROADCAST, **SMALL_PARTITIONS):
        kept = filter_universe(rows, listed, "code")
        expected = sum(1 for i in range(60_000) if (7 if i % 3 == 0 else i % 5_000) % 2 == 1)
        assert len(kept.collect()) == expected
        assert "SortMergeJoin(skew=true)" in plan(kept)


def test_foreign_keys_meet_the_parent_as_distinct_keys(spark, tmp_path):
    child = hot_rows(spark, f"{tmp_path}/child.parquet", 6_000)
    parent = spark.range(3_000).select(F.col("id").alias("pk"))
    with settings(spark, **NO_BROADCAST):
        text = plan(orphans(child, "code", parent, "pk"))
    assert re.search(r"SortMergeJoin.*LeftAnti[\s\S]*HashAggregate[\s\S]*partial_count", text)


def test_a_hot_join_key_is_split(spark, tmp_path):
    """A third of the orders belong to one customer; its join partition is cut up."""
    orders = spark.range(0, 60_000, numPartitions=8).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5_000).alias("o_custkey"),
        (F.rand(1) * 100_000).alias("o_totalprice"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("o_orderdate"),
    )
    customers = spark.range(5_000).select(
        F.col("id").alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey")
    )
    nations = spark.range(25).select(
        F.col("id").cast("int").alias("n_nationkey"),
        F.concat(F.lit("N"), F.col("id").cast("string")).alias("n_name"),
    )
    for name, df in (("orders", orders), ("customer", customers), ("nation", nations)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    with settings(spark, **NO_BROADCAST, **SMALL_PARTITIONS):
        daily = shapes.raw_prices(spark, str(tmp_path))
        assert sum(r.volume for r in daily.collect()) == 60_000
        assert "SortMergeJoin(skew=true)" in plan(daily)


def test_surrogate_offsets_do_not_shuffle_the_rows(spark):
    static_off = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}
    with settings(spark, **static_off):
        numbered = with_surrogate_keys(spark.range(1000).withColumn("v", F.col("id") % 7), "sid", ["id"])
        text = plan(numbered)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    # the only exchanges belong to the offsets, one row per partition
    rows = text[: text.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in rows
