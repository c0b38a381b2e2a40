import brute
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from stockloom.llm import mixing, sharding
from stockloom.llm.queries import QUERIES
from stockloom.llm.running import running_total


def test_jump_is_the_known_walk_and_grows_into_the_new_shard_only(spark):
    keys = [0, 1, 2, 255, 10**12, -1, -(2**63), 2**63 - 1, *range(1000, 1200)]
    rows = spark.createDataFrame([(k,) for k in keys], "doc_id long")
    for shards in (1, 2, 40, 41, 500):
        found = {r.doc_id: r.shard for r in sharding.with_shard(rows, shards).collect()}
        assert found == {k: brute.jump(k, shards) for k in keys}
    small, grown = ({k: brute.jump(k, n) for k in keys} for n in (40, 41))
    assert all(grown[k] in (small[k], 40) for k in keys)


def test_shards_of_odd_rows(odd_docs, no_docs):
    got = sharding.sharded(odd_docs, 3).collect()
    assert len(got) == odd_docs.count()
    for shard in range(3):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} >= {(3, 16, 0), (4, 16, 0), (None, 16, 0)}
    assert all(r.shard == brute.jump(r.doc_id or 0, 3) and r.grown_shard in (r.shard, 3) for r in got)
    assert sharding.sharded(no_docs, 3).collect() == []
    with_shard = sharding.with_shard(odd_docs, 3)
    assert sorted(with_shard.columns) == sorted(odd_docs.columns)
    with pytest.raises(ValueError):
        sharding.with_shard(odd_docs, 0)


def test_shards_of_text_keys(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "key string")
    assert all(0 <= r.shard < 7 for r in sharding.with_shard(rows, 7, key="key").collect())


def test_running_total_in_a_hot_group(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise("rest").alias("g"), (F.col("id") % 64).alias("c"), "id"
    )
    got = running_total(rows, "g", "c", [F.col("id")], "id", "before", "test").collect()
    for g in ("hot", "rest"):
        total = 0
        for r in sorted((r for r in got if r.g == g), key=lambda r: (r.c, r.id)):
            assert r.before == total
            total += r.id


def sized(rows):
    return [(r.doc_id, r.source, len((r.text or "").split())) for r in rows]


@pytest.mark.parametrize("which", ["odd", "driver"])
def test_mix_equals_plain_version(odd_docs, documents, which):
    docs = odd_docs if which == "odd" else documents
    got = mixing.mixed(mixing.sized(docs)).collect()
    wanted = brute.mix(sized(docs.collect()))
    pick = lambda r: (r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken, r.offset)
    key = lambda r: tuple((v is not None, v or 0) for v in r)
    assert sorted(map(pick, got), key=key) == sorted(
        ((i, n, s, round(t, 6), k, o) for i, n, s, t, k, o, _ in wanted), key=key
    )
    by = {}
    for r in got:
        assert r.taken <= 3 * r.size
        by.setdefault(r.source, [0, r.target])[0] += r.taken
    assert all(abs(taken - target) <= 0.5 for taken, target in by.values())


def test_mix_of_nothing(no_docs):
    assert mixing.mixed(mixing.sized(no_docs)).collect() == []
    assert mixing.in_training_order(no_docs).collect() == []


def test_due_inverts_the_integral():
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    for tilt in (-0.9, -0.5, 0.0, 0.5, 0.9):
        rows = spark.range(11).select((F.col("id") / 10).alias("x"))
        for x, t in rows.select("x", mixing.due(F.col("x"), F.lit(tilt))).collect():
            assert abs(t + tilt * (t * t - t) - x) < 1e-12


def test_training_order_keeps_columns_and_repeats(odd_docs):
    got = mixing.in_training_order(odd_docs)
    assert got.columns == odd_docs.columns
    assert {r["size"] for r in got.collect()} == {1}


def test_tilt_moves_words(spark):
    QUERIES["op6_curriculum_mix"](spark, SF_DIR).createOrReplaceTempView("mixed")
    first = spark.sql("SELECT avg(position) FROM mixed").first()[0]
    assert 0 < first < 1
