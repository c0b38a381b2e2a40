"""Language of a text by multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; every run of 1 to ``GRAMS`` characters is hashed to one of ``SLOTS``
slots. Training counts slots per language over all labelled texts, in tasks and then by Spark; only
the counts, ``languages * SLOTS`` at most, reach the driver. They become a matrix of
log-probabilities that is broadcast. A text is scored from its sparse slot counts.

A null text, or one without a letter, is ``und`` with score 0. Rows without a language teach
nothing. With no labelled row at all every text is ``und``. An empty text has no letter.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

GRAMS = 3
SLOTS = 1 << 16
SMOOTHING = 0.1
UNKNOWN = "und"
REJECT = 0.5  #: documents with a lower score are rejected as well
BLOCK = 1 << 18  #: characters

_LETTER = re.compile(r"[^\W\d_]")
_PRIMES = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)


def slots(text: str) -> np.ndarray:
    """Slots of all n-grams of a piece of lower-cased text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    parts, value = [], np.zeros(len(codes) + 1, np.uint32)
    for n in range(GRAMS):
        if len(codes) <= n:
            break
        value = (value[: len(codes) - n] ^ codes[n:]) * np.uint32(_PRIMES[n % len(_PRIMES)])
        value ^= value >> np.uint32(15)
        parts.append((value + np.uint32(n)) * np.uint32(0x9E3779B1) >> np.uint32(16))
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots that occur in a text, and how often; whole texts, block by block."""
    low, total = text.lower(), None
    for at in range(0, len(low), BLOCK):
        piece = low[max(0, at - GRAMS + 1) : at + BLOCK]
        found = slots(piece)
        if at:  # the grams that lie in the repeated characters came with the last block
            again = np.bincount(slots(low[max(0, at - GRAMS + 1) : at]), minlength=SLOTS)
            total -= again
        total = np.bincount(found, minlength=SLOTS) + (0 if total is None else total)
    if total is None:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    which = np.flatnonzero(total)
    return which, total[which]


def train(docs: DataFrame, lang: str = "lang", text: str = "text") -> dict:
    """Model of the labelled rows: languages, log-probabilities and log-priors."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, body in zip(batch.column(0), batch.column(1)):
                own = totals.setdefault(name.as_py(), np.zeros(SLOTS + 1, np.int64))
                which, n = counts(body.as_py() or "")
                own[which] += n
                own[SLOTS] += 1
        for name, own in totals.items():
            which = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(which), pa.string()), pa.array(which), pa.array(own[which])],
                ["lang", "slot", "n"],
            )

    labelled = docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    parts = labelled.mapInArrow(count, "lang string, slot bigint, n bigint")
    sums = parts.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(sums.column(0).to_pylist()))
    table = np.zeros((len(names), SLOTS + 1))
    rows = np.searchsorted(np.array(names), sums.column(0).to_numpy(zero_copy_only=False)) if names else []
    table[rows, sums.column(1).to_numpy()] = sums.column(2).to_numpy()
    grams = table[:, :SLOTS] + SMOOTHING
    prior = np.log(table[:, SLOTS] / max(1.0, table[:, SLOTS].sum()))
    return {"langs": names, "matrix": np.log(grams / grams.sum(1, keepdims=True)).astype(np.float32), "prior": prior}


def score(text: str | None, langs: list[str], matrix: np.ndarray, prior: np.ndarray) -> tuple[str, float]:
    """Language and its probability among the known ones."""
    if not text or not langs or not _LETTER.search(text):
        return UNKNOWN, 0.0
    which, n = counts(text)
    logs = prior + matrix[:, which].astype(np.float64) @ n
    odds = np.exp(logs - logs.max())
    best = int(np.argmax(odds))
    return langs[best], float(odds[best] / odds.sum())


def identified(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model["langs"], model["matrix"], model["prior"]))
    plain = docs.drop("lang_pred", "score")
    at = plain.columns.index(text)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [score(t.as_py(), *shared.value) for t in batch.column(at)]
            names, scores = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names, "lang_pred", "score"],
            )

    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    return plain.mapInArrow(add, StructType([*plain.schema.fields, *added]))


def held_out(doc_id: str, parts: int, part: int) -> Column:
    """Whether a row is kept from training, by its id's checksum; rows without an id aren't."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def accepted(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of ``REJECT`` or more."""
    found = identified(docs.withColumnsRenamed({"lang_pred": "__pred", "score": "__score"}), model)
    kept = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= REJECT)).drop("lang_pred", "score")
    return kept.withColumnsRenamed({"__pred": "lang_pred", "__score": "score"}).select(*docs.columns)
