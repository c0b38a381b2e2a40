"""Near-duplicate lines by MinHash: one line of each group stays in the corpus.

A line's features are its runs of ``SHINGLE`` characters (UTF-16 units; a shorter line is one
run). Each is hashed once; ``BANDS * ROWS`` odd factors give as many orders, and a line's signature
is its least hash in each. Lines that agree on all rows of a band are candidates: with p = 0.8**4
for a band, a pair at Jaccard similarity 0.8 is met with probability 1 - (1 - p)**14 = 0.9993,
one at 0.85 with 0.99996, at 0.9 with 0.9999996.
One bit of each least hash makes a sketch. Candidates whose sketches differ in more than ``FAR`` of 56 bits go no
further (at 0.8 that happens with probability 1e-7, at higher similarities less). The others are verified by their exact
Jaccard similarity, verified pairs are united, and of each component the first line stays, by ``doc_id`` and place.

Equal lines are one line with several places, told by a 64-bit hash (of 10**9 different lines some
pair collides with probability 0.03). A band's bucket with up to ``BUCKET`` lines is compared pair by pair.
In a larger one every line is compared with ``HUBS`` hubs, those with the most places. What that unites into one
component needs no more comparing: a large bucket of copies of one line takes time in proportion to its lines.
All pairs of a large bucket whose lines are of different components are compared as well, block against block
of up to about ``BLOCK`` lines. So every pair that agrees in a band is compared or joined by others, however large
the bucket. Only a large bucket of many components takes time with the square of its lines.

Lines are the text between line feeds. Blank lines are no candidates and always stay. A null
text has no lines, an empty one a blank line. An empty table gives no rows. Signatures and similarities are
computed by numpy over Arrow batches, in pieces and blocks of bounded size; joins, buckets and components are built-in functions.
"""

from __future__ import annotations

import functools
import random
from collections.abc import Container, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.llm.bits import among
from stockloom.llm.components import components
from stockloom.sources.scratch import stage

SHINGLE = 8
SIMILARITY = 0.8
BANDS = 14
ROWS = 4
FAR = 20  #: bits of two sketches that differ in no candidates
BUCKET = 64
HUBS = 64
BLOCK = 512  #: lines of a block
BLOCK_UNITS = 1 << 19  #: characters of a block
PIECE = 1 << 16  #: shingles that are hashed at a time
HELD = 1 << 21  #: hashes of lines that a task keeps while it compares pairs
COLUMNS = 1 << 12  #: shingles that two blocks share, counted at a time

_BLANK = " \t\n\x0b\f\r"  #: what a blank line is made of
_KEYS = [f"k{b}" for b in range(BANDS)]
_SIGNED = "id long, sketch long, " + ", ".join(f"{k} long" for k in _KEYS)
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _factors() -> np.ndarray:
    drawn = random.Random(7)
    return np.array([drawn.getrandbits(32) | 1 for _ in range(BANDS * ROWS)], np.uint32)


def _lines(docs: DataFrame) -> DataFrame:
    """__at (row), doc_id, pos, line, id (null for blank lines)."""
    numbered = docs.select("doc_id", "text").withColumn("__at", F.monotonically_increasing_id())
    cut = numbered.select("__at", "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return cut.withColumn("id", F.when(F.ltrim("line", F.lit(_BLANK)) != "", F.xxhash64("line")))


def _units(line: str) -> bytes:
    """A line in units, filled up to one shingle."""
    return line.encode("utf-16-le").ljust(2 * SHINGLE, b"\0")


def _hashes(units: bytes) -> np.ndarray:
    """64-bit hashes of the shingles at every place of ``units``."""
    n = len(units) // 2 - SHINGLE + 1
    first = np.ndarray(n + 4, "<u8", units, strides=(2,))  # four units each, so two make a shingle
    h = first[:n] * _MIX[0]
    h ^= h >> np.uint64(29)
    h += first[4:]
    h *= _MIX[1]
    h ^= h >> np.uint64(32)
    h *= _MIX[0]
    return h


def _blocks(lines: Iterable[str]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Numbers of lines and their units, a long line in several pieces, in blocks of about ``PIECE`` shingles."""
    owners, pieces, held = [], [], 0
    for i, line in enumerate(lines):
        units = _units(line)
        for at in range(0, len(units) // 2 - SHINGLE + 1, PIECE):
            piece = units[2 * at : 2 * (at + PIECE + SHINGLE - 1)]
            owners.append(i)
            pieces.append(piece)
            held += len(piece) // 2
            if held >= PIECE:
                yield owners, pieces
                owners, pieces, held = [], [], 0
    if pieces:
        yield owners, pieces


def _least(lines: list[str], factors: np.ndarray) -> np.ndarray:
    """Signatures of lines: a row per factor, a column per line."""
    least = np.full((len(factors), len(lines)), 0xFFFFFFFF, np.uint32)
    for owners, pieces in _blocks(lines):
        h = (_hashes(b"".join(pieces)) >> np.uint64(32)).astype(np.uint32)
        ends = np.cumsum([len(p) // 2 for p in pieces])
        starts = np.concatenate(([0], ends[:-1]))
        # What runs over the border of two pieces is taken for the first shingle of the earlier, which alters no minimum.
        h[ends[:-1, None] - np.arange(1, SHINGLE)] = h[starts[:-1], None]
        product = np.empty_like(h)
        # Lines of a block follow each other, each with one piece: a full piece ends its block.
        for row, factor in zip(least[:, owners[0] : owners[-1] + 1], factors):
            np.multiply(h, factor, out=product)
            np.minimum(row, np.minimum.reduceat(product, starts), out=row)
    return least


def _sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    factors = _factors()
    names = ["id", "sketch", *_KEYS]
    for batch in batches:
        least = _least(batch.column(1).to_pylist(), factors)
        sketch = np.zeros(batch.num_rows, np.uint64)
        for k in range(len(factors)):
            sketch |= ((least[k] >> np.uint32(7)) & np.uint32(1)).astype(np.uint64) << np.uint64(k)
        keys = []
        for band in range(BANDS):
            key = np.full(batch.num_rows, band + 1, np.uint64)
            for row in least[ROWS * band : ROWS * (band + 1)]:
                key = (key ^ row) * _MIX[0]
                key ^= key >> np.uint64(31)
            keys.append(key)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c.view(np.int64)) for c in (sketch, *keys))], names)


def signatures(lines: DataFrame) -> DataFrame:
    """id, sketch and the key of each band (k0, k1, ...) of each distinct line (id, line)."""
    signed = lines.select("id", "line").mapInArrow(_sign, _SIGNED)
    return signed.groupBy("id").agg(*(F.min(c).alias(c) for c in ("sketch", *_KEYS)))


def _buckets(signed: DataFrame) -> DataFrame:
    """key, id, sketch, n: the buckets of at least two lines.

    Most keys are of one line, so only keys and ids are shuffled, and sketches join what is left.
    """
    keyed = signed.select("id", F.explode(F.array(*_KEYS)).alias("key")).repartition("key")
    met = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return keyed.join(met.hint("shuffle_hash"), "key").join(signed.select("id", "sketch"), "id")


def _once(hashes: np.ndarray) -> np.ndarray:
    """Distinct hashes, sorted; sorts ``hashes`` in place."""
    hashes.sort()
    new = np.ones(hashes.size, bool)
    np.not_equal(hashes[1:], hashes[:-1], out=new[1:])
    return hashes[new]


def _distinct(lines: list[bytes]) -> Iterator[np.ndarray]:
    """Hashes of the distinct shingles of each line (its units), sorted."""
    h, at = _hashes(b"".join(lines)), 0
    for units in lines:
        end = at + len(units) // 2
        yield _once(h[at : end - SHINGLE + 1])
        at = end


def _runs(line: str) -> np.ndarray:
    """Hashes of the distinct shingles of a line, sorted."""
    return next(_distinct([_units(line)]))


def _runs_of(lines: Iterable[str]) -> Iterator[np.ndarray]:
    """``_runs`` of each line; lines are hashed together, about ``PIECE`` shingles at a time."""
    some, held = [], 0
    for line in lines:
        some.append(_units(line))
        held += len(some[-1]) // 2
        if held >= PIECE:
            yield from _distinct(some)
            some, held = [], 0
    if some:
        yield from _distinct(some)


def similarity(one: np.ndarray, other: np.ndarray) -> float:
    """Jaccard similarity of two lines by their ``_runs``."""
    h = np.concatenate((one, other))
    h.sort()
    both = np.count_nonzero(h[1:] == h[:-1])
    return both / (h.size - both)


def _similar(one: np.ndarray, other: np.ndarray, similar: float) -> bool:
    small, large = sorted((one.size, other.size))
    return small >= similar * large and similarity(one, other) >= similar


def _portions(batch: pa.RecordBatch, known: Container[int]) -> Iterator[tuple[list[tuple[int, int]], dict[int, str]]]:
    """Pairs (a, b) of a, b, line_a, line_b in order, with those of their lines that aren't known, about ``PIECE`` characters at a time."""
    a, b, line_a, line_b = batch.columns
    pairs, fresh, held = [], {}, 0
    for i, pair in enumerate(zip(a.to_pylist(), b.to_pylist())):
        pairs.append(pair)
        for key, line in zip(pair, (line_a, line_b)):
            if key not in known and key not in fresh:
                fresh[key] = line[i].as_py()
                held += len(fresh[key])
        if held >= PIECE:
            yield pairs, fresh
            pairs, fresh, held = [], {}, 0
    yield pairs, fresh


def _verify(batches: Iterable[pa.RecordBatch], similar: float) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of a, b, line_a, line_b that are similar. Runs of up to ``HELD`` shingles are kept for further pairs."""
    known: dict[int, np.ndarray] = {}
    held = 0
    for batch in batches:
        close: list[bool] = []
        for pairs, fresh in _portions(batch, known):
            known.update(zip(fresh, _runs_of(fresh.values())))
            held += sum(known[key].size for key in fresh)
            close += [_similar(known[one], known[other], similar) for one, other in pairs]
            if held > HELD:
                known.clear()
                held = 0
        mask = pa.array(close, pa.bool_())
        yield pa.RecordBatch.from_arrays([c.filter(mask) for c in batch.columns[:2]], ["a", "b"])


def _verified(pairs: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b, sketch_a, sketch_b) of lines that are similar, as (a, b). Sketches are compared first, so few texts are shuffled."""
    near = pairs.where(F.bit_count(F.col("sketch_a").bitwiseXOR(F.col("sketch_b"))) <= FAR)
    ordered = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # Pairs are narrow but dear to compare: a stated number of partitions isn't merged into a few tasks.
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    likely = ordered.repartition(tasks, "a", "b").distinct()
    left = texts.select(F.col("id").alias("a"), F.col("line").alias("line_a"))
    right = texts.select(F.col("id").alias("b"), F.col("line").alias("line_b"))
    both = likely.join(left, "a").join(right, "b").select("a", "b", "line_a", "line_b")
    return both.mapInArrow(functools.partial(_verify, similar=similar), "a long, b long")


def _sides(rows: DataFrame, *on: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, sketch, ...) twice, to be joined with each other: columns but ``on`` named by side."""
    names = [c for c in rows.columns if c not in on]
    one, other = (
        rows.select(*on, *(F.col(c).alias(side if c == "id" else f"{c}_{side}") for c in names)) for side in "ab"
    )
    return one, other


def _blocks_of(n: Column, units: Column) -> Column:
    """Into how many blocks ``n`` lines of ``units`` characters together go."""
    return F.ceil(F.greatest(n / BLOCK, units / BLOCK_UNITS)).cast("int")


def _hub_blocks(crowds: DataFrame, places: DataFrame) -> DataFrame:
    """key, x, y, at, id, root: the lines of large buckets (key, id, units) in blocks, and the hubs of a bucket (block -1) with each."""
    order = Window.partitionBy("key").orderBy(F.desc("count"), "id")
    total = crowds.groupBy("key").agg(_blocks_of(F.count("*"), F.sum("units")).alias("blocks"))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    lines = crowds.join(total, "key").select("key", block.alias("y"), block.alias("at"), "id")
    ranked = crowds.join(places, "id").withColumn("rank", F.row_number().over(order))
    hubs = ranked.where(F.col("rank") <= HUBS).join(total, "key").select(
        "key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("y"), F.lit(-1).alias("at"), "id"
    )
    return lines.union(hubs).select("key", F.lit(-1).alias("x"), "y", "at", "id", F.col("id").alias("root"))


def _block_pairs(crowds: DataFrame, roots: DataFrame) -> DataFrame:
    """key, x, y, at, id, root: each line of the large buckets (key, id, units) of several components, once for each pair (x, y) of blocks to compare.

    ``at`` is the line's own block, one of x and y. Lines of a bucket's largest component are in blocks below zero,
    which aren't compared with each other.
    """
    rooted = crowds.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    parts = rooted.groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("units").alias("units"))
    total = parts.groupBy("key").agg(
        F.max(F.struct("n", "root", "units")).alias("main"), F.sum("n").alias("n"), F.sum("units").alias("units"), F.min("root").alias("low"),
        F.max("root").alias("high"),
    )
    mixed = total.where("low < high").select(
        "key",
        F.col("main.root").alias("main"),
        _blocks_of(F.col("main.n"), F.col("main.units")).alias("mains"),
        _blocks_of(F.col("n") - F.col("main.n"), F.col("units") - F.col("main.units")).alias("others"),
    )
    own = F.col("root") == F.col("main")
    block = F.pmod(F.xxhash64("id"), F.when(own, F.col("mains")).otherwise(F.col("others"))).cast("int")
    at = rooted.join(mixed, "key").withColumn("at", F.when(own, -1 - block).otherwise(block))
    every = F.sequence(F.lit(0), F.col("others") - 1)
    # An array of blocks, those that a line's own block is compared with.
    against = F.when(own, every).otherwise(F.concat(F.sequence(-F.col("mains"), F.lit(-1)), every))
    met = at.select("key", "at", "id", "root", F.explode(against).alias("with"))
    return met.select("key", F.least("at", "with").alias("x"), F.greatest("at", "with").alias("y"), "at", "id", "root")


def _shared(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """Numbers of shingles that each of ``one`` shares with each of ``other`` (``_runs``)."""
    both = np.concatenate([_once(np.concatenate(side)) for side in (one, other)])
    both.sort()
    both = both[1:][both[1:] == both[:-1]]
    counts = np.zeros((len(one), len(other)), np.int64)
    if not both.size:
        return counts
    places = [_places_of(both, side) for side in (one, other)]
    for at in range(0, both.size, COLUMNS):
        marks = []
        for side, (lines, columns) in zip((one, other), places):
            some = slice(*np.searchsorted(columns, (at, at + COLUMNS)))
            marks.append(np.zeros((len(side), min(COLUMNS, both.size - at)), np.float32))
            marks[-1][lines[some], columns[some] - at] = 1
        counts += (marks[0] @ marks[1].T).astype(np.int64)
    return counts


def _places_of(shingles: np.ndarray, lines: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Where ``lines`` (``_runs``) hold ``shingles``: numbers of lines and of shingles, by shingle."""
    every = np.concatenate(lines)
    column = np.minimum(np.searchsorted(shingles, every), shingles.size - 1)
    held = shingles[column] == every
    line, column = np.repeat(np.arange(len(lines)), [r.size for r in lines])[held], column[held]
    order = np.argsort(column, kind="stable")
    return line[order], column[order]


def _compare(group: pa.Table, similar: float) -> pa.Table:
    """Links (a, b) between lines of two blocks (of one with itself if x = y): as many as join all that are similar."""
    x, y, at, ids, roots = (group.column(c).to_numpy() for c in ("x", "y", "at", "id", "root"))
    runs = list(_runs_of(group.column("line").to_pylist()))
    left, right = np.flatnonzero(at == x), np.flatnonzero(at == y)
    found: list[tuple[int, int]] = []
    if left.size and right.size:
        sizes = np.array([r.size for r in runs])
        both = _shared([runs[i] for i in left], [runs[i] for i in right])
        near = both / (sizes[left][:, None] + sizes[right] - both) >= similar
        near &= roots[left][:, None] != roots[right]
        over = {root: root for root in roots.tolist()}

        def top(root: int) -> int:
            while over[root] != root:
                over[root] = root = over[over[root]]
            return root

        for i, j in zip(*(side.tolist() for side in np.nonzero(near))):
            one, other = top(roots[left[i]]), top(roots[right[j]])
            if one != other:
                over[one] = other
                found.append((ids[left[i]], ids[right[j]]))
    return pa.table([pa.array(c, pa.int64()) for c in (zip(*found) if found else ([], []))], ["a", "b"])


def _links(blocks: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """Links (a, b) between similar lines of two blocks (key, x, y, at, id, root)."""

    def compare(group: pa.Table) -> pa.Table:
        return _compare(group, similar)

    named = blocks.join(texts.select("id", "line"), "id")
    return named.groupBy("key", "x", "y").applyInArrow(compare, "a long, b long")


def similar_pairs(buckets: DataFrame, texts: DataFrame, places: DataFrame, similar: float) -> DataFrame:
    """Links (a, b) that join all similar lines of each bucket (key, id, sketch, n); ``places``: id, count of its places."""
    one, other = _sides(buckets.where(F.col("n") <= BUCKET).select("key", "id", "sketch"), "key")
    close = _verified(one.join(other, "key").where("a < b"), texts, similar)
    crowds = buckets.where(F.col("n") > BUCKET).select("key", "id")
    if crowds.isEmpty():
        return close
    crowds = stage(crowds.join(texts.select("id", F.length("line").alias("units")), "id"), "line-crowds")
    near = close.union(_links(_hub_blocks(crowds, places), texts, similar))
    roots = components(near, "a", "b", "line-roots").withColumnRenamed("node", "id")
    across = _links(_block_pairs(crowds, roots), texts, similar)
    return roots.select(F.col("id").alias("a"), F.col("root").alias("b")).union(across)


def places(docs: DataFrame, similar: float = SIMILARITY) -> DataFrame:
    """__at, doc_id, pos, id, component, kept: one row per line of ``docs``.

    ``id`` and ``component`` are null for blank lines, which are kept.
    """
    lines = _lines(docs)
    where = stage(lines.drop("line"), "line-places")
    counts = stage(
        where.where("id is not null")
        .groupBy("id")
        .agg(F.count("*").alias("count"), F.min(F.struct("doc_id", "__at", "pos")).alias("first")),
        "line-counts",
    )
    signed = stage(signatures(lines.where("id is not null").select("id", "line")), "line-signatures")
    buckets = stage(_buckets(signed), "line-buckets")
    candidates = stage(buckets.select("id").distinct(), "line-candidates")
    likely = lines.select("id", "line").where(among(F.col("id"), candidates))
    texts = stage(likely.dropDuplicates(["id"]).join(candidates, "id"), "line-texts")
    pairs = similar_pairs(buckets, texts, counts.select("id", "count"), similar)
    roots = components(pairs, "a", "b", "line-links").withColumnsRenamed({"node": "id", "root": "component"})
    named = counts.join(roots, "id", "left").withColumn("component", F.coalesce("component", "id"))
    firsts = named.groupBy("component").agg(F.min("first").alias("keep"), F.sum("count").alias("size"))
    several = stage(
        named.select("id", "component").join(firsts.where("size > 1"), "component").select("id", "component", "keep"),
        "line-classes",
    )
    return where.join(several, "id", "left").select(
        "__at",
        "doc_id",
        "pos",
        "id",
        F.coalesce("component", "id").alias("component"),
        F.coalesce(
            (F.col("__at") == F.col("keep.__at")) & (F.col("pos") == F.col("keep.pos")), F.lit(True)
        ).alias("kept"),
    )


def documents(docs: DataFrame, similar: float = SIMILARITY) -> DataFrame:
    """doc_id, lines, kept_lines, dropped (places of the lines that go): one row per row of ``docs``."""
    found = places(docs, similar)
    per = found.groupBy("__at").agg(
        F.first("doc_id").alias("doc_id"),
        F.count("*").alias("lines"),
        F.sum(F.col("kept").cast("bigint")).alias("kept_lines"),
        F.array_sort(F.collect_list(F.when(~F.col("kept"), F.col("pos")))).alias("dropped"),
    )
    none = docs.where("text is null").select(
        "doc_id", F.lit(0).cast("bigint").alias("lines"), F.lit(0).cast("bigint").alias("kept_lines"),
        F.array().cast("array<int>").alias("dropped"),
    )
    return per.drop("__at").union(none)


def without_copies(docs: DataFrame, similar: float = SIMILARITY) -> DataFrame:
    """``docs`` with the lines taken out of their texts; rows and other columns stay.

    Rows are met again by their number in ``docs``, so ``docs`` is written and read back first.
    """
    held = stage(docs, "line-docs")
    gone = places(held.select("doc_id", "text"), similar).where("not kept")
    per = gone.groupBy("__at").agg(F.collect_set("pos").alias("__gone"))
    rows = held.withColumn("__at", F.monotonically_increasing_id()).join(per, "__at", "left")
    left = F.filter(F.split("text", "\n"), lambda _, i: ~F.coalesce(F.array_contains("__gone", i), F.lit(False)))
    text = F.when(F.col("__gone").isNotNull(), F.array_join(left, "\n")).otherwise(F.col("text"))
    return rows.withColumn("text", text).select(*docs.columns)
