"""Near copies by SimHash: fingerprints of word shingles, linked at a small Hamming distance.

Links are found by pigeonhole blocks. A fingerprint is cut into ``distance + 3`` blocks; two
fingerprints that differ in at most ``distance`` bits agree on at least three whole blocks,
so a join on every choice of three blocks meets each close pair. Candidates are then checked
by their exact distance. Agreement on three blocks is 27 bits or more, so that few pairs meet
by chance.

A bucket with more than ``BUCKET`` fingerprints isn't paired up. Its fingerprints are
linked through midpoints instead, which is exact as well: two of them differ in at most
2r bits if and only if some value lies within r bits of both. Each lists the values near it,
and all that list the same value are linked to the smallest of them. That work grows with
the number of fingerprints, not with its square.

Texts that are null, empty or blank have fingerprint zero and are linked like any other.
Equal fingerprints are merged before links are searched, so a group of copies of any size is
one node. Rows without ``doc_id`` are fingerprinted and linked too; a component takes the
smallest id that isn't null, and null if all are. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stockloom.llm.components import components
from stockloom.llm.rows import ROW, with_row
from stockloom.llm.words import word_blocks
from stockloom.sources.scratch import stage

BITS = 64
SHINGLE = 4
DISTANCE = 4
SEED = 42
BUCKET = 512  #: fingerprints of a bucket that are still compared pair by pair


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint: a bit is 1 if more than half of the shingle hashes have it."""
    ones, total, carry = np.zeros(BITS, np.int64), 0, []
    for block in word_blocks(text):
        words = carry + block
        if len(words) >= shingle:
            hashes = _hashes(words, shingle)
            total += len(hashes)
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
                0, dtype=np.int64
            )
        carry = words[-(shingle - 1) :] if shingle > 1 else []
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(carry), SEED) if carry else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _hashes(words: list[bytes], shingle: int) -> np.ndarray:
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    return np.array([digest(joined[i:j], SEED) for i, j in zip(starts, ends[shingle - 1 :].tolist())], "<u8")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``fp`` (the fingerprint's bits as a signed long)."""
    kept = [f for f in docs.schema.fields if f.name not in (text, "fp")]

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(0)], "<u8")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(bits.view("<i8"))], [*batch.schema.names[1:], "fp"]
            )

    schema = StructType([*kept, StructField("fp", LongType(), False)])
    return docs.select(text, *(f.name for f in kept)).mapInArrow(add, schema)


def _masks(distance: int) -> list[int]:
    """Masks of every choice of three out of ``distance + 3`` blocks, as signed longs."""
    blocks = distance + 3
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [(1 << hi) - (1 << lo) for lo, hi in itertools.pairwise(edges)]
    return [_signed(sum(chosen)) for chosen in itertools.combinations(parts, 3)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def links(fps: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Links (``a`` < ``b``) that join the distinct values ``fp`` exactly as far as distance reaches.

    Pairs of small buckets are all there; of a large bucket there are as many links as keep
    its values connected, each of them within ``distance``. ``distance`` is even.
    """
    masks = _masks(distance)
    keys = F.explode(
        F.array(*(F.struct(F.lit(i).cast("byte").alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits"))
                  for i, m in enumerate(masks)))
    )
    keyed = fps.select("fp", keys.alias("k")).select("k.part", "k.bits", "fp")
    met = keyed.groupBy("part", "bits").agg(F.count("*").alias("n")).where("n > 1")
    # merged by hint here and below: Spark takes an exploded table for as small as it was before, and would broadcast it
    shared = stage(keyed.join(met.hint("merge"), ["part", "bits"]), "simhash-buckets")

    small = shared.where(F.col("n") <= bucket)
    left = small.select("part", "bits", F.col("fp").alias("a"))
    right = small.select("part", "bits", F.col("fp").alias("b"))
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    same = (left["part"] == right["part"]) & (left["bits"] == right["bits"])
    pairs = left.join(right.hint("merge"), same & close).select("a", "b")

    crowded = shared.where(F.col("n") > bucket).select("fp").distinct()
    near = crowded.withColumn("mid", F.col("fp"))
    for _ in range(distance // 2):  # one bit more is turned, or none
        turned = F.expr("explode(transform(sequence(0, 64), b -> if(b = 64, 0L, shiftleft(1L, b))))")
        near = near.withColumn("turned", turned).select("fp", F.expr("mid ^ turned").alias("mid")).distinct()
    least = near.groupBy("mid").agg(F.min("fp").alias("a"), F.max("fp").alias("most")).where("a < most")
    stars = near.join(least.select("mid", "a").hint("merge"), "mid").where("a < fp").select("a", F.col("fp").alias("b"))
    return pairs.union(stars).distinct()


def grouped(docs: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without text, with ``fp`` and ``component_id`` (smallest ``doc_id`` reachable)."""
    marked = stage(fingerprints(docs, shingle), "simhash")
    nodes = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "simhash-nodes")
    roots = components(links(nodes.select("fp"), distance, bucket), "a", "b", "simhash-links")
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    classes = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_fp = named.select("fp", "root").join(classes, "root").select("fp", "component_id")
    return marked.drop("component_id").join(by_fp, "fp")


def drop_near_copies(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """The columns and rows of ``docs``, of each component only the row with the smallest id.

    Among rows with that id one stays, picked by a 128-bit hash of all columns, and of rows
    that are equal throughout one copy. A component without any id keeps one row as well.
    """
    plain = with_row(docs)
    seen = grouped(plain.select("doc_id", "text", *ROW), distance)
    best = seen.groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *ROW)).alias("best")
    )
    ids = stage(best.select(*(f"best.{c}" for c in ROW)), "simhash-kept")
    return plain.join(ids, ROW).dropDuplicates(ROW).select(*docs.columns)
