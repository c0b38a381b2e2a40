"""Toxicity by two Kneser-Ney models of words, one of toxic and one of ordinary texts.

A class c gives a word w behind v the probability

    p_c(w | v) = (1 - r2) * (C_c(v, w) - d2)+ / sum over w of (C_c(v, w) - d2)+  +  r2 * p_c(w)
    p_c(w)     = (1 - r1) * (N_c(w) - d1)+ / sum (N_c - d1)+  +  r1 * p(w)
    p(w)       = classes(w) / sum classes

C_c(v, w) is the number of texts of the class with the pair (a text over ``tokens.BLOCK`` bytes counts once a
block), N_c(w) the number of distinct words before w, so a passage that is copied a thousand times
counts once there, and classes(w) the number of classes that know w. The discounts come from the counts of counts of both
classes together, d = n1 / (n1 + 2 n2), and so do the shares r1 and r2 of the backoff, which both classes
have in common. Rare expressions are left to it: a pair in fewer than
``LEAST`` texts of both classes, or behind a word that only one class knows, is as likely as its word; a word with fewer
than ``LEAST`` distinct predecessors is as likely in one class as in the other.

The difference of the log-likelihoods is then a sum of gains: that of each word, and what a known pair
adds to it. Gains below ``SLIGHT`` are left out of the table. A text is compared by three
numbers: ``mean``, all its gains by its words, that is its length-normalised log-likelihoods; ``peak``, the largest mean of
the gains of ``WINDOW`` words in a row (a shorter text is taken as one with ``WINDOW`` words), since a mean over
a long text drowns a few words; and ``phrase``, the largest gain of a pair, apart from the peak since
copied passages count in pairs. A logistic curve of the three, fitted to a histogram, gives a score from 0 to 1.
The curve learns from a quarter of the labelled texts, by their checksum, the models from the
others, as texts that a model has seen look clearer to it than new ones.

Pairs are counted over whole texts; words are told by 64-bit hashes, predecessors of one word by 32
bits. They are shuffled packed, in ``BUCKETS`` buckets by word and part of the predecessors, each word once for all its
pairs of a bucket. The table of gains grows with the corpus. Up to ``HELD`` entries (17 bytes each) every task holds; a larger
one comes to it in pieces of ``PIECE`` entries, one at a time, and meets there what a bit table lets through of ``MET`` keys
or words in a row. Nothing is shuffled. Gains are multiples of 2**-10, so both ways give the same sums.

Null and empty texts have no words: the three are 0. Rows without a label teach
nothing; a document with several labels teaches each. With one class missing there are no gains, and all scores are
the share of toxic labels, 0 without any label. If the curve's quarter lacks a class, it learns from all labelled texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stockloom.llm.bits import among, bit_table, holds
from stockloom.llm.tokens import mixed, token_blocks
from stockloom.sources.scratch import stage

LEAST = 5
SLIGHT = 0.3
WINDOW = 2  #: words of an expression
HELD = 1 << 22  #: entries of a table of gains that a task holds
PIECE = 1 << 21  #: entries that it holds at a time of a larger one
MET = 1 << 21  #: keys or words that meet the pieces together
FILTER_BITS = 25
THRESHOLD = 0.3
PAIRS = 1 << 21  #: words whose pairs are counted at a time
BUCKETS = 1 << 12  #: buckets of all pairs
PARTS = 64  #: buckets of one word, which may be in a third of all pairs

_START = np.uint64(0x5851F42D4C957F2D)
# lowest, highest and number of bins of the histogram
_BINS = {"mean": (-4.0, 4.0, 81), "peak": (-10.0, 10.0, 201), "phrase": (-10.0, 10.0, 41)}
NUMBERS = list(_BINS)
_OWN = ("__row", "__n", "__found", "__top", "__windows", "__total", "__best", "__pairs")
_ONE = 1024.0


class Curve(NamedTuple):
    mean: float
    peak: float
    phrase: float
    offset: float


class Gains(NamedTuple):
    table: DataFrame  #: key, gain, pair (or else a word)
    n: int


def _hash_blocks(text: str | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (word hashes, hashes of the words before); a text begins with a start mark."""
    last = _START
    for found in token_blocks(text):
        words = found.hashes
        before = np.concatenate(([last], words[:-1]))
        last = words[-1]
        yield before, words


def _short(before: np.ndarray) -> np.ndarray:
    return (mixed(before) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _pair_keys(short: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mixed(words + mixed(short.view(np.uint32).astype(np.uint64) + np.uint64(1)))


def _pairs(known: DataFrame) -> DataFrame:
    """What ``_judged`` says of all pairs: rows of words (``before`` is null), to be summed, and of pairs that aren't rare."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1)):
                for before, words in _hash_blocks(text.as_py()):
                    pairs = _unique(words, _short(before))[:2]
                    of = np.full(len(pairs[0]), toxic.as_py(), np.int64)
                    held.append((*pairs, of, 1 - of))
                    size += len(of)
                    if size > PAIRS:
                        yield _packed(*_summed(held))
                        held, size = [], 0
        if held:
            yield _packed(*_summed(held))

    def put_together(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for row in zip(*batch.columns):
                bucket, words, pairs, data = (v.as_py() for v in row)
                if size > PAIRS and bucket != last:
                    yield _judged(*_summed(held))
                    held, size = [], 0
                held.append(_unpacked(words, pairs, data))
                size, last = size + pairs, bucket
        if held:
            yield _judged(*_summed(held))

    columns = known.select(F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic"))
    packed = columns.mapInArrow(count, "bucket int, words int, pairs int, data binary")
    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        put_together, ", ".join(f"{c} {'int' if c == 'before' else 'bigint'}" for c in _JUDGED)
    )


def _unique(words: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, the order that sorts them and where each begins in it."""
    order = np.lexsort((before, words))
    words, before = words[order], before[order]
    new = np.ones(len(words), bool)
    new[1:] = (words[1:] != words[:-1]) | (before[1:] != before[:-1])
    first = np.flatnonzero(new)
    return words[first], before[first], order, first


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of runs that begin at ``first``."""
    return np.add.reduceat(values.astype(np.int64), first) if len(first) else np.empty(0, np.int64)


def _summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Distinct pairs of parts (words, before, toxic, plain) in order, their numbers summed."""
    words, before, toxic, plain = (np.concatenate(p) for p in zip(*parts))
    keys, shorts, order, first = _unique(words, before)
    return keys, shorts, _sums(toxic[order], first), _sums(plain[order], first)


def _runs(words: np.ndarray) -> np.ndarray:
    """Where each of the sorted words begins."""
    new = np.ones(len(words), bool)
    new[1:] = words[1:] != words[:-1]
    return np.flatnonzero(new)


def _packed(words: np.ndarray, before: np.ndarray, toxic: np.ndarray, plain: np.ndarray) -> pa.RecordBatch:
    """Pairs in order by bucket: words once, what stands before them, and how many; a word has ``PARTS`` buckets."""
    part = (before.view(np.uint32) % np.uint32(PARTS)).astype(np.uint64)
    bucket = (mixed(words + part) % np.uint64(BUCKETS)).astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    bucket, words, before, toxic, plain = (c[order] for c in (bucket, words, before, toxic, plain))
    edges = np.append(_runs(bucket), len(bucket))
    rows = []
    for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
        first = _runs(words[i:j])
        numbers = [np.diff(np.append(first, j - i)), toxic[i:j], plain[i:j]]
        numbers = pa.compress(b"".join(n.astype(np.int64).tobytes() for n in numbers), codec="zstd", asbytes=True)
        rows.append((bucket[i], len(first), j - i, words[i:j][first].tobytes() + before[i:j].tobytes() + numbers))
    columns = list(zip(*rows)) or [()] * 4
    types = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["bucket", "words", "pairs", "data"])


def _unpacked(words: int, pairs: int, data: bytes) -> tuple[np.ndarray, ...]:
    at = 8 * words + 4 * pairs
    numbers = pa.decompress(data[at:], 8 * (words + 2 * pairs), codec="zstd", asbytes=True)
    numbers = np.frombuffer(numbers, np.int64)
    n, toxic, plain = np.split(numbers, [words, words + pairs])
    return np.repeat(np.frombuffer(data, np.uint64, words), n), np.frombuffer(data, np.int32, pairs, 8 * words), toxic, plain


#: of a pair ``n`` texts, ``toxic`` and ``plain`` ones; of a word ``n`` distinct predecessors, those of each class, and of
#: its pairs how many are in one text, in two, and the ``texts`` of all
_JUDGED = ("word", "before", "toxic", "plain", "n", "ones", "twos", "texts")


def _judged(words: np.ndarray, before: np.ndarray, toxic: np.ndarray, plain: np.ndarray) -> pa.RecordBatch:
    """Rows of the words, ``before`` null, and of the pairs in ``LEAST`` texts or more; pairs are distinct and in order."""
    first, n = _runs(words), toxic + plain
    own = np.flatnonzero(n >= LEAST)
    of_words = (_sums(c, first) for c in (toxic > 0, plain > 0, n > 0, n == 1, n == 2, n))
    of_pairs = (toxic[own], plain[own], n[own], *[np.zeros(len(own), np.int64)] * 3)
    none = pa.nulls(len(first), pa.int32())
    columns = [
        pa.array(np.concatenate((words[first], words[own])).view(np.int64)),
        pa.concat_arrays([none, pa.array(before[own], pa.int32())]),
        *(pa.array(np.concatenate(c)) for c in zip(of_words, of_pairs)),
    ]
    return pa.RecordBatch.from_arrays(columns, list(_JUDGED))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (text, toxic) of the documents that have a label; other texts aren't shuffled."""
    known = labels.where("toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    some = docs.where(among(F.xxhash64("doc_id"), known.select(F.xxhash64("doc_id"))))
    # labels grow with the documents, so the join is the same shuffle at every size
    return some.select("doc_id", "text").join(known.hint("merge"), "doc_id").select("text", "toxic")


def for_curve(text: Column) -> Column:
    """Whether the curve learns from a text, and not the models."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")) % 4 == 0


def _discount(counts: tuple) -> tuple[float, float]:
    """Discount and share of the backoff, from sums over the counts of both classes, as ``_counts`` has them."""
    ones, twos, own, own_n, total = (float(v or 0) for v in counts)
    discount = min(1.0, max(0.1, ones / (ones + 2 * twos) if ones else 0.5))
    return discount, (total - own_n + own * discount) / max(total, 1.0)


def _counts(n: Column) -> list[Column]:
    """How many are 1, 2, and ``LEAST`` or more, the sum of these and that of all."""
    known = n >= LEAST
    return [F.sum(c) for c in ((n == 1).cast("long"), (n == 2).cast("long"), known.cast("long"), F.when(known, n), n)]


def _rounded(value: Column) -> Column:
    return F.round(value * _ONE) / _ONE


def train(known: DataFrame) -> Gains:
    """Gains (key of a word or a pair, toxic less ordinary log-probability) of rows (text, toxic)."""
    judged = stage(_pairs(known.where("toxic in (0, 1)")), "toxicity-pairs")
    is_word = F.col("before").isNull()
    pairs = judged.where(~is_word).select("word", "before", "toxic", "plain")
    words = judged.where(is_word).groupBy("word").agg(*(F.sum(c).alias(c) for c in ("n", "toxic", "plain")))
    words = stage(words, "toxicity-words")
    d1, r1 = _discount(words.agg(*_counts(F.col("n"))).first())
    own_pairs = (F.sum(F.when(~is_word, c)) for c in (F.lit(1), F.col("n")))
    d2, r2 = _discount(judged.agg(F.sum("ones"), F.sum("twos"), *own_pairs, F.sum("texts")).first())

    def over(c: str, discount: float) -> Column:
        return F.greatest(F.col(c) - discount, F.lit(0.0))

    own = words.where(F.col("n") >= LEAST)
    sums = own.agg(*(F.sum(over(c, d1)) for c in ("toxic", "plain"))).first()
    classes = (F.col("toxic") > 0).cast("int") + (F.col("plain") > 0).cast("int")
    all_classes = words.agg(F.sum(classes)).first()[0] or 1
    toxic, plain = (v or 0.0 for v in sums)
    if not (toxic and plain):
        return Gains(words.select(F.col("word").alias("key"), F.lit(0.0).alias("gain"), F.lit(True).alias("pair")).where("false"), 0)

    def level(c: str, total: float) -> Column:
        return (1 - r1) * over(c, d1) / total + r1 * classes / all_classes

    likely = words.select("word", "n", level("toxic", toxic).alias("p_toxic"), level("plain", plain).alias("p_plain"))
    gain = _rounded(F.log("p_toxic") - F.log("p_plain"))
    of_words = likely.where(F.col("n") >= LEAST).select(F.col("word").alias("key"), gain.alias("gain"))

    behind = pairs.groupBy("before").agg(
        *(F.sum(over(c, d2)).alias(f"all_{c}") for c in ("toxic", "plain"))
    ).where("all_toxic > 0 and all_plain > 0")
    shared = r1 * classes / all_classes
    rare = F.col("n") < LEAST
    base = words.select(
        "word",
        *(F.when(rare, shared).otherwise(level(c, t)).alias(f"p_{c}") for c, t in (("toxic", toxic), ("plain", plain))),
    )
    both = pairs.join(behind, "before").join(base, "word")

    def pair_level(c: str) -> Column:
        return (1 - r2) * over(c, d2) / F.col(f"all_{c}") + r2 * F.col(f"p_{c}")

    more = _rounded(F.log(pair_level("toxic")) - F.log(pair_level("plain"))) - gain
    of_pairs = both.select("word", "before", more.alias("gain")).where(F.abs("gain") >= SLIGHT)

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, before = (batch.column(i).to_numpy() for i in (0, 1))
            keys = _pair_keys(before, words.view(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column(2)], ["key", "gain"])

    of_pairs = of_pairs.mapInArrow(keyed, "key bigint, gain double")
    table = of_words.where(F.abs("gain") >= SLIGHT).withColumn("pair", F.lit(False))
    table = table.union(of_pairs.withColumn("pair", F.lit(True)))
    # two expressions with one hash share a gain
    table = table.groupBy("key").agg(F.sum("gain").alias("gain"), F.min("pair").alias("pair"))
    table = stage(table, "toxicity-gains")
    return Gains(table, table.count())


def _found(text: str | None, bits: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of a text: place of the first word, words, and places and keys that the bit table holds."""
    at = 0
    for before, words in _hash_blocks(text):
        keys = np.concatenate((words, _pair_keys(_short(before), words)))
        some = np.flatnonzero(holds(bits, keys))
        yield at, len(words), some % len(words), keys[some].view(np.int64)
        at += len(words)


class _Numbers:
    """mean, peak and phrase of a text, whose blocks are added in order."""

    def __init__(self):
        self.total, self.n, self.peak, self.phrase, self.carry = 0.0, 0, -math.inf, -math.inf, np.empty(0)

    def add(self, size: int, places: np.ndarray, gains: np.ndarray, pair: np.ndarray) -> None:
        """A block of ``size`` words, some of whose places have gains of words and of pairs."""
        words, pairs = (np.bincount(places[k], gains[k], size) for k in (~pair, pair))
        self.total, self.n = self.total + float(words.sum() + pairs.sum()), self.n + size
        self.phrase = max(self.phrase, float(pairs.max()))
        words = np.concatenate((self.carry, words))
        if len(words) >= WINDOW:
            self.peak = max(self.peak, float(np.convolve(words, np.ones(WINDOW), "valid").max()))
        self.carry = words[-(WINDOW - 1) :]

    def all(self) -> tuple[float, float, float]:
        if not self.n:
            return 0.0, 0.0, 0.0
        return self.total / self.n, (self.peak if self.n >= WINDOW else float(self.carry.sum())) / WINDOW, self.phrase


def _met(keys: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``found`` are among the sorted keys, and where."""
    at = np.searchsorted(keys, found)
    known = at < len(keys)
    known[known] = keys[at[known]] == found[known]
    return known, at[known]


def compared_text(
    text: str | None, bits: np.ndarray, keys: np.ndarray, gains: np.ndarray, pair: np.ndarray
) -> tuple[float, float, float]:
    """(mean, peak, phrase) of a text; ``keys`` are sorted."""
    numbers = _Numbers()
    for _, size, places, found in _found(text, bits):
        known, at = _met(keys, found)
        numbers.add(size, places[known], gains[at], pair[at])
    return numbers.all()


def compared_in_pieces(
    texts: Iterable[str | None], bits: np.ndarray, pieces: list[Broadcast], most: int = MET
) -> list[tuple[float, float, float]]:
    """(mean, peak, phrase) of each text; the pieces have one range of sorted keys after another."""
    numbers, held, size = [], [], 0
    for text in texts:
        numbers.append(_Numbers())
        for _, words, places, found in _found(text, bits):
            held.append((numbers[-1], words, places, found))
            size += max(words, len(found))
            if size > most:
                _settle(held, pieces)
                held, size = [], 0
    _settle(held, pieces)
    return [n.all() for n in numbers]


def _settle(held: list[tuple], pieces: list[Broadcast]) -> None:
    """Adds the held blocks (numbers, words, places, found) to their texts; every piece is read once."""
    if not held:
        return
    found = np.concatenate([h[3] for h in held])
    order = np.argsort(found)
    found = found[order]
    known, gains, pair = np.zeros(len(found), bool), np.zeros(len(found)), np.zeros(len(found), bool)
    for piece in pieces:
        keys, own, of_pair = piece.value
        vars(piece).pop("_value", None)  # else it stays when the next one is read
        if len(keys):
            low, high = np.searchsorted(found, keys[0]), np.searchsorted(found, keys[-1], "right")
            here, at = _met(keys, found[low:high])
            here = order[low:high][here]
            known[here], gains[here], pair[here] = True, own[at], of_pair[at]
    end = 0
    for numbers, words, places, some in held:
        here = end + np.flatnonzero(known[end : end + len(some)])
        numbers.add(words, places[here - end], gains[here], pair[here])
        end += len(some)


def compared(docs: DataFrame, gains: Gains, held: int = HELD) -> DataFrame:
    """``docs`` without text, with ``mean``, ``peak`` and ``phrase``; columns of these names are replaced.

    Columns named as in ``_OWN`` are left out; all others stay.
    """
    context = docs.sparkSession.sparkContext
    bits = context.broadcast(bit_table(gains.table.select("key"), FILTER_BITS))
    names = [c for c in docs.columns if c.lower() not in ("text", *NUMBERS, *_OWN)]
    docs = docs.select("text", *names)
    schema = StructType([*docs.schema.fields[1:], *(StructField(c, DoubleType()) for c in NUMBERS)])
    whole = gains.n <= held
    pieces = [context.broadcast(_columns(part)) for part in _parts(gains, 1 if whole else -(-gains.n // PIECE))]

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t.as_py() for t in batch.column(0))
            if whole:
                found = [compared_text(t, bits.value, *pieces[0].value) for t in texts]
            else:
                found = compared_in_pieces(texts, bits.value, pieces)
            values = np.array(found, float).reshape(-1, 3)
            added = [pa.array(values[:, i]) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *added], schema.names)

    return docs.mapInArrow(add, schema)


def _parts(gains: Gains, n: int) -> Iterator[DataFrame]:
    """The table in ``n`` ranges of keys, which are hashes and so spread evenly."""
    edges = [(i << 64) // n - (1 << 63) for i in range(n + 1)] if n else []
    for low, high in zip(edges, edges[1:]):
        yield gains.table.where(F.col("key").between(low, high - 1))


def _columns(part: DataFrame) -> tuple[np.ndarray, ...]:
    """Sorted keys, gains, and which are pairs."""
    table = part.select("key", "gain", "pair").toArrow()
    columns = [table.column(c).to_numpy(zero_copy_only=False) for c in ("key", "gain", "pair")]
    order = np.argsort(columns[0])
    return tuple(c[order] for c in columns)


def _bin(value: str, low: float, high: float, bins: int) -> Column:
    inside = F.greatest(F.lit(low), F.least(F.lit(high), value))
    return F.floor((inside - low) * (bins - 1) / (high - low) + 0.5)


def _logistic(x: np.ndarray, n: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    total, weights = n.sum(), np.zeros(x.shape[1])
    for _ in range(100):  # Newton steps with a slight pull to zero, so that separable texts have a fit
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (n * (toxic - p)) / total - 1e-4 * weights
        hessian = (x.T * (n * p * (1 - p))) @ x / total + 1e-4 * np.eye(len(weights))
        step = np.linalg.solve(hessian, gradient)
        weights += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return weights


def fitted(known: DataFrame) -> Curve:
    """Curve of rows (mean, peak, phrase, toxic, apart), from a histogram; ``apart`` marks the rows it learns from."""
    counted = known.where("toxic in (0, 1)").groupBy(
        "toxic", "apart", *(_bin(c, *bins).alias(c) for c, bins in _BINS.items())
    )
    cells = np.array([tuple(map(float, r)) for r in counted.count().collect()]).reshape(-1, 6)
    own = cells[cells[:, 1] == 1]
    if len(np.unique(own[:, 0])) == 2:
        cells = own
    toxic, n = cells[:, 0], cells[:, -1]
    total, share = n.sum(), (n * toxic).sum() / max(1.0, n.sum())
    if not 0 < share < 1:
        edge = 1e-9 if share == 0 else 1 - 1e-9
        return Curve(0.0, 0.0, 0.0, math.log(edge / (1 - edge)))
    scaled = [low + cells[:, 2 + i] * (high - low) / (bins - 1) for i, (low, high, bins) in enumerate(_BINS.values())]
    x = np.stack([*scaled, np.ones(len(cells))], 1)
    used = np.ones(4, bool)
    while True:
        weights = np.zeros(4)
        weights[used] = _logistic(x[:, used], n, toxic)
        against = used & (weights < 0) & (np.arange(4) < 3)  # no number speaks against toxicity the more toxic it is
        if not against.any():
            break
        used[against] = False
    return Curve(*map(float, weights))


def score(curve: Curve) -> Column:
    """Score of the columns ``mean``, ``peak`` and ``phrase``."""
    return 1 / (1 + F.exp(-sum((F.lit(w) * F.col(c) for w, c in zip(curve, NUMBERS)), F.lit(curve.offset))))


def predicted(score: Column, threshold: float = THRESHOLD) -> Column:
    return (score >= threshold).cast("int")
