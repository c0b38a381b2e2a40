import hashlib
import random

import brute
from conftest import SF_DIR
from pyspark.sql import functions as F

from stockloom.llm import exact, simhash
from stockloom.llm.components import components
from stockloom.llm.queries import QUERIES


def test_components_equal_plain_union_find(spark):
    drawn = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(0, i) for i in range(1, 40)]
    noise = [(drawn.randrange(200, 400), drawn.randrange(200, 400)) for _ in range(120)]
    links = [*chain, *star, *noise, (7, 7), (None, 3), (100, 101)]
    drawn.shuffle(links)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == brute.components(real, {n for link in real for n in link})
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def test_query_equals_plain_version(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    wanted = brute.simhash_components(texts)
    got = QUERIES["op9_simhash_near_copies"](spark, SF_DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.fingerprint == format(brute.fingerprint(texts[r.doc_id]), "016x")
        assert r.component_id == wanted[r.doc_id]


def test_links_of_crowded_buckets_keep_the_same_components(spark):
    drawn, values = random.Random(5), set()
    for _ in range(3):
        base = drawn.getrandbits(64)
        for _ in range(40):
            value = base
            for b in drawn.sample(range(64), drawn.randrange(0, 6)):
                value ^= 1 << b
            values.add(value - (1 << 64) if value >> 63 else value)
    values |= {0, -1, 1, 3, 7, 15, 31}
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    near = [(a, b) for a in values for b in values if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4]
    wanted = brute.components(near, values)
    for bucket in (512, 4, 1):
        got = [tuple(r) for r in simhash.links(fps, bucket=bucket).collect()]
        assert set(got) <= set(near)
        assert brute.components(got, values) == wanted
        if bucket == 512:
            assert set(got) == set(near)


def test_tables_that_explode_are_never_broadcast(spark, monkeypatch):
    made, stage = [], simhash.stage
    monkeypatch.setattr(simhash, "stage", lambda df, label: made.append(df) or stage(df, label))
    fps = spark.range(600).select(F.col("id").alias("fp"))  # Spark knows its size, and takes it for small once exploded
    made.append(simhash.links(fps, bucket=4))
    for df in made:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_blocks_of_text_give_the_same_fingerprint(monkeypatch):
    from stockloom.llm import words

    text = " ".join(f"Wört{i % 37}\t{'x' * (i % 50)}" for i in range(3000))
    whole = simhash.fingerprint(text)
    assert whole == brute.fingerprint(text)
    blocks = words.word_blocks
    monkeypatch.setattr(simhash, "word_blocks", lambda t: blocks(t, 64))
    assert simhash.fingerprint(text) == whole
    assert simhash.fingerprint("One two") == brute.fingerprint("one TWO") != 0
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def test_near_copies_of_odd_rows(odd_docs, no_docs):
    got = simhash.grouped(odd_docs.select("doc_id", "text", "fp")).collect()
    assert len(got) == odd_docs.count()
    of = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert of[1] == of[2] == 1 and of[3] == of[4] == of[5] == 3 and of[6] == of[7] == 6
    left = simhash.drop_near_copies(odd_docs)
    assert left.columns == odd_docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [-10, 1, 3, 6, 8, 9]
    assert simhash.grouped(no_docs).collect() == simhash.drop_near_copies(no_docs).collect() == []


def test_polynomial_hashes_combine_in_any_grouping():
    drawn = random.Random(1)
    data = drawn.randbytes(3000)
    for field in exact.FIELDS:
        whole = exact.chunk_hash(data, field)
        for _ in range(20):
            i, j = sorted((drawn.randrange(3001), drawn.randrange(3001)))
            parts = [data[:i], data[i:j], data[j:]]
            a, b, c = (exact.chunk_hash(p, field) for p in parts)
            left = exact.combined(exact.combined(a, b, j - i, field), c, 3000 - j, field)
            right = exact.combined(a, exact.combined(b, c, 3000 - j, field), 3000 - i, field)
            assert left == right == whole
    long = drawn.randbytes(exact.CHUNK * 2 + 5)
    assert exact.fingerprint(long) != exact.fingerprint(long[1:] + long[:1])


def test_exact_copies_of_odd_rows_and_collisions(odd_docs, no_docs):
    rows = odd_docs.collect()
    for fields in (exact.FIELDS, ((3, 2), (5, 2))):  # the second collides all the time
        got = exact.duplicates(odd_docs, fields).collect()
        assert len(got) == len(rows)
        groups = {}
        for r in rows:
            groups.setdefault(r.text or "", []).append(r.doc_id)
        for r in got:
            text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
            ids = [i for i in groups[text] if i is not None]
            assert (r.keep_id, r.group_size) == (max(ids, default=None), len(groups[text]))
        kept = [r for r in got if r.kept]
        assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    assert exact.duplicates(no_docs).collect() == []


def test_unequal_texts_of_one_class_are_told_apart_by_chunks(spark):
    size = exact.CHUNK
    texts = ["a" * size + "b" * size, "b" * size + "a" * size, "a" * size + "b" * size]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.keep_id for r in exact.duplicates(docs, ((2, 1), (2, 1))).collect()}
    assert got == {0: 2, 1: 1, 2: 2}


def test_hot_copies(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(F.col("id").cast("string")).alias("text")
    )
    got = exact.duplicates(docs)
    assert got.where("group_size = 1000 and keep_id = 2997").count() == 1000
    assert got.where("kept").count() == 2001
