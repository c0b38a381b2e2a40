import random

import pytest
from pyspark.sql import functions as F

from stockloom.operators.carry import carry_forward, group_label
from stockloom.operators.surrogate import with_surrogate_keys


def brute_force(data):
    last, out = {}, {}
    for group, position, label in sorted(data, key=lambda r: r[1]):
        last[group] = label if label is not None else last.get(group)
        out[(group, position)] = last[group]
    return out


@pytest.mark.parametrize("chunk_rows", [1, 7, 100, 1_000_000, None])
def test_carry_forward_equals_brute_force(spark, chunk_rows):
    rng = random.Random(3)
    groups = ["hot"] * 6 + ["b", "c", None]
    data, used = [], set()
    while len(data) < 600:
        key = (rng.choice(groups), rng.randrange(0, 900))
        if key not in used:
            used.add(key)
            data.append((*key, rng.choice([None, None, None, None, "x", "y", "z"])))
    df = spark.createDataFrame(data, "g string, pos bigint, label string")
    out = carry_forward(df, "label", "filled", ["g"], "pos", chunk_rows)
    assert out.columns == ["g", "pos", "label", "filled"]
    assert {(r.g, r.pos): r.filled for r in out.collect()} == brute_force(data)
    assert out.count() == len(data)


def test_labels_before_the_first_group_are_null(spark):
    df = spark.createDataFrame([(0, None), (1, "a"), (2, None)], "pos int, label string")
    out = carry_forward(df.withColumn("g", F.lit(1)), "label", "filled", ["g"], "pos", 2)
    assert [r.filled for r in out.orderBy("pos").collect()] == [None, "a", "a"]


def test_group_label_drops_blanks_and_stop_words(spark):
    df = spark.createDataFrame([(" A ",), ("  \n",), ("STT",), (None,)], "t string")
    got = df.select(group_label(F.col("t"), ("STT",)).alias("v")).collect()
    assert [r.v for r in got] == ["A", None, None, None]


def test_surrogate_keys_are_dense_and_ordered(spark):
    df = spark.range(0, 5_000, numPartitions=7).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("code"),
        ((F.col("id") * 7919) % 5_003).alias("day"),
    )
    got = with_surrogate_keys(df, "sid", ["code", "day"]).orderBy("sid").collect()
    assert [r.sid for r in got] == list(range(1, 5_001))
    assert [(r.code, r.day) for r in got] == sorted((r.code, r.day) for r in got)


def test_surrogate_keys_continue_from_a_start(spark):
    got = with_surrogate_keys(spark.range(3), "sid", ["id"], start=40).orderBy("id").collect()
    assert [r.sid for r in got] == [41, 42, 43]


def test_surrogate_keys_of_nothing(spark):
    assert with_surrogate_keys(spark.range(0), "sid", ["id"]).count() == 0


def test_copies_of_one_key_spread_over_partitions(spark):
    df = spark.range(0, 8_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("code")
    )
    setting = "spark.sql.adaptive.coalescePartitions.enabled"  # keep the few rows apart
    spark.conf.set(setting, "false")
    try:
        got = with_surrogate_keys(df, "sid", ["code"], unique=False)
    finally:
        spark.conf.unset(setting)
    ordered = got.orderBy("sid").collect()
    assert [r.sid for r in ordered] == list(range(1, 8_001))
    assert [r.code for r in ordered] == sorted(r.code for r in ordered)
    files = spark.read.parquet(*got.inputFiles())
    assert files.where("code = 'hot'").select("__part").distinct().count() > 1
