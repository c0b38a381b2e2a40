"""Exact copies by composable polynomial fingerprints.

A text's bytes are the digits of a number in a fixed base, taken modulo two primes. The bytes
are hashed in chunks of ``CHUNK``, and chunk hashes are put together by shifting: the hash of
a text followed by n more bytes is ``hash * base**n + hash of these``. So a text of any length
is hashed piece by piece, in any grouping of its pieces, with a chunk in memory at a time.

Rows with equal length and fingerprint form a class. Fingerprints can collide, so the texts
of every class with two rows or more are compared, chunk by chunk: the least and the
greatest text of each chunk are aggregated, before the shuffle already, and differ if and
only if the class holds unequal texts. No text is brought together with all its copies,
however many there are. A class that holds unequal texts is split by SHA-256 and compared again.

A null text counts as empty. Of equal texts the row with the largest ``doc_id`` stays, of several
rows with it one; rows without an id come last. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stockloom.llm.bits import bit_table, holds
from stockloom.llm.tokens import mixed
from stockloom.sources.scratch import stage

CHUNK = 1 << 16  #: bytes
#: Prime and base of each half of a fingerprint.
FIELDS = ((2147483647, 1103515245), (2147483629, 69069069))
CLASS = ["bytes", "print", "split"]


@functools.lru_cache(maxsize=16)
def _powers(prime: int, base: int, size: int) -> np.ndarray:
    """base**(size - 1) ... base**0."""
    powers = [1]
    for _ in range(size - 1):
        powers.append(powers[-1] * base % prime)
    return np.array(powers[::-1], np.uint64)


def chunk_hash(chunk: bytes, field: tuple[int, int]) -> int:
    digits = np.frombuffer(chunk, np.uint8).astype(np.uint64) + np.uint64(1)
    return int(np.dot(digits, _powers(*field, CHUNK)[CHUNK - len(chunk) :])) % field[0]


def combined(left: int, right: int, length: int, field: tuple[int, int]) -> int:
    """Hash of a text of hash ``left`` followed by ``length`` bytes of hash ``right``."""
    prime, base = field
    return (left * pow(base, length, prime) + right) % prime


def fingerprint(data: bytes, fields=FIELDS) -> int:
    halves = []
    for field in fields:
        total = 0
        for at in range(0, len(data), CHUNK):
            chunk = data[at : at + CHUNK]
            total = combined(total, chunk_hash(chunk, field), len(chunk), field)
        halves.append(total)
    return halves[0] << 31 | halves[1]


def _marked(docs: DataFrame, fields) -> DataFrame:
    kept = [f for f in docs.schema.fields if f.name not in ("text", "bytes", "print", "text_sha256")]
    names = [f.name for f in kept]

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, prints, hashes = [], [], []
            for text in batch.column(0):
                data = (text.as_py() or "").encode()
                lengths.append(len(data))
                prints.append(fingerprint(data, fields))
                hashes.append(hashlib.sha256(data).hexdigest())
            added = [pa.array(lengths, pa.int64()), pa.array(prints, pa.int64()), pa.array(hashes, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *added], [*names, "bytes", "print", "text_sha256"]
            )

    added = [StructField("bytes", LongType()), StructField("print", LongType()), StructField("text_sha256", StringType())]
    return docs.select("text", *names).mapInArrow(add, StructType([*kept, *added]))


def _chunks(docs: DataFrame, fields, table: np.ndarray) -> DataFrame:
    """bytes, print, text_sha256, number, chunk: of texts whose class may have two rows."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for text in batch.column(0):
                data = (text.as_py() or "").encode()
                value = fingerprint(data, fields)
                if not holds(table, _spread(len(data), value))[0]:
                    continue
                digest = hashlib.sha256(data).hexdigest()
                for number, at in enumerate(range(0, len(data), CHUNK)):
                    rows.append((len(data), value, digest, number, data[at : at + CHUNK]))
                    size += CHUNK
                    if size > 64 * CHUNK:
                        yield _batch(rows)
                        rows, size = [], 0
            yield _batch(rows)

    return docs.select("text").mapInArrow(
        cut, "bytes bigint, print bigint, text_sha256 string, number bigint, chunk binary"
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds)], ["bytes", "print", "text_sha256", "number", "chunk"]
    )


def _spread(length: int, value: int) -> np.ndarray:
    return mixed(np.array([value ^ length << 1], np.uint64))


def _spread_table(classes: DataFrame) -> np.ndarray:
    """Bit table of classes, by the hash that ``_spread`` takes."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, values = (c.to_numpy().astype(np.uint64) for c in batch.columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array(mixed(values ^ (lengths << np.uint64(1))).view(np.int64))], ["hash"]
            )

    return bit_table(classes.select("bytes", "print").mapInArrow(add, "hash bigint"))


def classes(docs: DataFrame, fields=FIELDS) -> DataFrame:
    """``docs`` without text, with text_sha256, the class of equal texts (``CLASS``) and ``__at``, a row number."""
    marked = stage(_marked(docs, fields).withColumn("__at", F.monotonically_increasing_id()), "fingerprints")
    several = marked.groupBy("bytes", "print").count().where("count > 1")
    table = _spread_table(several)
    chunks = _chunks(docs, fields, table)
    unequal = stage(_unequal(chunks, ["bytes", "print"]), "collisions")
    split = F.when(F.col("collides"), F.col("text_sha256")).otherwise(F.lit(""))
    collides = unequal.withColumn("collides", F.lit(True))
    if not unequal.isEmpty() and not _unequal(
        chunks.join(unequal, ["bytes", "print"]), ["bytes", "print", "text_sha256"]
    ).isEmpty():
        raise ValueError("two unequal texts share their SHA-256")
    return marked.join(collides, ["bytes", "print"], "left").withColumn("split", split).drop("collides")


def _unequal(chunks: DataFrame, key: list[str]) -> DataFrame:
    ends = chunks.groupBy(*key, "number").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
    return ends.where("low <> high").select(*key).distinct()


def duplicates(docs: DataFrame, fields=FIELDS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of ``docs``."""
    rows = stage(classes(docs.select("doc_id", "text"), fields), "classes")
    groups = rows.groupBy(*CLASS).agg(
        F.max(F.struct("doc_id", "__at")).alias("best"), F.count("*").alias("group_size")
    )
    return rows.join(groups, CLASS).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("__at") == F.col("best.__at")).alias("kept"),
        "text_sha256",
    )
