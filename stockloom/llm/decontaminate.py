"""Benchmark decontamination by templates.

Texts become templates: numbers, quantities, units and names turn into typed placeholders, all
other tokens stay, lower-cased. Windows of a template are hashed, and windows of documents
are joined with windows of benchmark items by hash. Every window has a second hash, of its lower-cased tokens as they are, so that copies
that differ in capitals only are met as well. Hits of a document and an item on one alignment, and those in one stretch of the document as long as the item,
are put together: each value of the item's placeholders must have become one value of the document
("7" always "9", never "9" and "4"; "7" and "8" may both have become "9") in ``CONSISTENT`` of the
placeholders, and the windows must cover ``COVER`` of the item's tokens. So a copied question is found, one with other names and
figures as well, and one with a word put in or left out.

A name is a capitalised token; one that begins a sentence is a name unless the benchmark has the word without a capital as well
(by a bit table of fixed size, which may rarely take a name for such a word). A window without any plain word says nothing as a
template and has its second hash only.
Items of fewer than ``WINDOW + 1`` tokens get windows one token shorter than the item.

Before the join, document windows are tested against a bit table of the benchmark's windows. Its
size is fixed, whatever the tables hold; it lets through every window that can match, and
the join stays exact. Null and empty texts have no windows; an empty table on either side
gives no rows. Repeated items are separate items. Items without ``item_id`` are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.llm.bits import bit_table, holds
from stockloom.llm.rows import ROW, with_row
from stockloom.llm.tokens import Tokens, mixed, token_blocks, tokens
from stockloom.sources.scratch import stage

WINDOW = 8
COVER = 0.8
CONSISTENT = 0.9
#: Units of measure that follow a number.
UNITS = """
    mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg lb lbs pound pounds oz ounce
    ounces ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute
    minutes h hr hour hours day days week weeks month months year years percent dollar dollars cent cents
    euro euros usd eur gbp hz khz mhz ghz w kw kwh v volt volts amp amps mph kmh kph degree degrees
    meter meters metre metres kilometer kilometers kilogram kilograms gram grams
""".split()

_MARKS = np.frombuffer(b"<number><amount><unit  ><name  >", "<u8")  # any four distinct values
_QUERY = 0x2545F4914F6CDD1D


def _unit_hashes() -> np.ndarray:
    text = " ".join(UNITS).encode()
    return np.unique(tokens(text, text).hashes)


def template(found: Tokens, units: np.ndarray, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Template codes of tokens, and which of them are placeholders. ``common``: bit table of words that are no names."""
    number = found.number
    usual = found.opening.copy() if common is None else np.zeros(len(number), bool)
    if common is not None:
        first = np.flatnonzero(found.opening & found.capital)
        usual[first] = holds(common, found.hashes[first])
    name = found.capital & ~usual
    unit = np.isin(found.hashes, units)
    unit[1:] &= number[:-1]
    unit[:1] = False
    codes = found.hashes.copy()
    for mask, mark in zip((name, unit, found.measure, number), (3, 2, 1, 0)):
        codes[mask] = _MARKS[mark]
    return codes, number | found.measure | unit | name


def common_words(items: DataFrame) -> np.ndarray:
    """Bit table of the words that the items have without a capital."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                for found in token_blocks(text.as_py()):
                    words = np.unique(found.hashes[~found.capital])
                    yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64))], ["word"])

    return bit_table(items.select("text").mapInArrow(cut, "word bigint").distinct())


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """A hash for each window of ``size`` values."""
    count = len(values) - size + 1
    if count < 1:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total = total * np.uint64(_QUERY) + values[k : k + count]
    return mixed(total ^ np.uint64(size))


def _windows(text: str | None, sizes: list[int], units: np.ndarray, common: np.ndarray):
    """Blocks of (size, first position, hashes, which to use, token hashes, placeholders), windows whole.

    Each comes by template, then by tokens as they are, where that differs; these have no placeholders.
    """
    carry, at, most = None, 0, max(sizes) - 1
    for found in token_blocks(text):
        codes, slot = template(found, units, common)
        parts = (codes, found.hashes, slot)
        before = len(carry[0]) if carry else 0
        if carry:
            parts = tuple(map(np.concatenate, zip(carry, parts)))
        for size in sizes:  # windows that lie in the carried part came with the last block
            skip = max(0, before - size + 1)
            codes, raw, slot = (p[skip:] for p in parts)
            if len(codes) < size:
                continue
            sums = np.concatenate(([0], np.cumsum(slot)))
            slots = sums[size:] - sums[:-size]
            first = at - before + skip
            yield size, first, window_hashes(codes, size), slots < size, raw, slot
            yield size, first, window_hashes(raw, size), slots > 0, raw, np.zeros(len(slot), bool)
        at += len(found.hashes)
        carry = tuple(p[len(p) - min(most, len(p)) :] for p in parts) if most else None


def _sizes(count: int, window: int) -> int:
    return min(window, max(1, count - 1))


def _item_windows(items: DataFrame, window: int, common: np.ndarray) -> DataFrame:
    """item_id, copy, item_tokens, size, position, hash, slots (position and token of each placeholder)."""
    units = _unit_hashes()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, copy, text in zip(*(c.to_pylist() for c in batch.columns)):
                count = sum(len(b.hashes) for b in token_blocks(text))
                size = _sizes(count, window)
                for _, first, hashes, use, raw, slot in _windows(text, [size], units, common):
                    rows += _rows([item, copy, count], size, first, hashes, raw, slot, np.flatnonzero(use))
            yield _batch(rows, ["item_id", "copy", "item_tokens"], [batch.schema.field(0).type, pa.int64(), pa.int64()])

    kind = dict(items.dtypes)["item_id"]
    numbered = items.where("item_id is not null").select(
        "item_id", F.monotonically_increasing_id().alias("copy"), "text"
    )
    return numbered.mapInArrow(
        cut, f"item_id {kind}, copy bigint, item_tokens bigint, size int, position bigint, hash bigint, {_SLOTS}"
    )


_SLOTS = "slots array<struct<at:bigint,value:bigint>>"
_SLOT_TYPE = pa.list_(pa.struct([("at", pa.int64()), ("value", pa.int64())]))


def _rows(head, size, first, hashes, raw, slot, which) -> list[tuple]:
    signed, values = hashes.view(np.int64), raw.view(np.int64)
    return [
        (
            *head,
            size,
            first + int(i),
            int(signed[i]),
            [{"at": int(k), "value": int(values[i + k])} for k in np.flatnonzero(slot[i : i + size])],
        )
        for i in which
    ]


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    names = [*names, "size", "position", "hash", "slots"]
    types = [*types, pa.int32(), pa.int64(), pa.int64(), _SLOT_TYPE]
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)


def _doc_windows(docs: DataFrame, sizes: list[int], table: np.ndarray, common: np.ndarray) -> DataFrame:
    """Row hash, size, position, hash and slots of the windows that the bit table lets through."""
    units = _unit_hashes()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row, row2, text in zip(batch.column(0), batch.column(1), batch.column(2)):
                for size, first, hashes, use, raw, slot in _windows(text.as_py(), sizes, units, common):
                    which = np.flatnonzero(holds(table, hashes) & use)
                    if len(which):
                        rows += _rows([row.as_py(), row2.as_py()], size, first, hashes, raw, slot, which)
                if len(rows) > 20_000:
                    yield _batch(rows, ROW, [pa.int64()] * 2)
                    rows = []
            yield _batch(rows, ROW, [pa.int64()] * 2)

    return docs.select(*ROW, "text").mapInArrow(
        cut, f"__row bigint, __row2 bigint, size int, position bigint, hash bigint, {_SLOTS}"
    )


def matches(rows: DataFrame, items: DataFrame, window: int = WINDOW, cover: float = COVER) -> DataFrame:
    """One row per document row (``ROW``) and item that it holds, by ``rows`` with ``ROW`` and text.

    Columns: item_id, covered (share of the item's tokens), slots (placeholders compared) and
    changed (placeholders filled differently; 0: copied as it is).
    """
    common = common_words(items.where("item_id is not null"))
    known = stage(_item_windows(items, window, common), "benchmark-windows")
    sizes = sorted(r[0] for r in known.select("size").distinct().collect())  # at most ``window`` of them
    if not sizes:
        sizes = [window]
    table = bit_table(known.select("hash"))
    hits = _doc_windows(rows, sizes, table, common).withColumnsRenamed({"position": "at", "slots": "filled"})
    met = hits.join(known, ["size", "hash"])
    pairs = F.arrays_zip(F.col("slots"), F.col("filled"))
    key = [*ROW, "item_id", "copy", "stretch"]
    shift, length = F.col("at") - F.col("position"), F.col("item_tokens")
    # Each alignment by itself, since items that repeat a pattern also meet themselves shifted; then stretches as long as the
    # item, and those half a length on: what lies close together shares one of them.
    stretches = F.array(3 * shift, 3 * F.floor(shift / length) + 1, 3 * F.floor(shift / length + 0.5) + 2)
    aligned = met.select(
        *ROW, "item_id", "copy", "item_tokens", "size", "position",
        F.explode(stretches).alias("stretch"),
        F.transform(
            pairs,
            lambda p: F.struct(
                (F.col("position") + p["slots"]["at"]).alias("at"),
                p["slots"]["value"].alias("mine"),
                p["filled"]["value"].alias("theirs"),
            ),
        ).alias("pairs"),
    )
    # a stretch holds at most as many alignments as the item has tokens
    runs = aligned.groupBy(*key, "item_tokens").agg(
        F.sort_array(F.collect_set(F.struct("position", "size"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
    )
    start = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("sum"))
    covered = F.aggregate(
        "spans",
        start,
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["position"] + s["size"]).alias("end"),
            (
                acc["sum"]
                + F.greatest(F.lit(0), s["position"] + s["size"] - F.greatest(acc["end"], s["position"]))
            ).alias("sum"),
        ),
        lambda acc: acc["sum"],
    )

    def held(counted: Column) -> Column:
        """Placeholders that hold what their item's value mostly became."""
        most = F.transform(
            F.array_distinct(F.transform("pairs", lambda p: p["mine"])),
            lambda m: F.array_max(F.transform(F.filter(counted, lambda c: c["mine"] == m), lambda c: c["n"])),
        )
        return F.aggregate(most, F.lit(0), lambda a, b: a + b)

    values = F.transform(
        F.array_distinct(F.transform("pairs", lambda p: F.struct(p["mine"].alias("mine"), p["theirs"].alias("theirs")))),
        lambda v: F.struct(
            v["mine"].alias("mine"),
            F.size(
                F.filter("pairs", lambda p: (p["mine"] == v["mine"]) & (p["theirs"] == v["theirs"]))
            ).alias("n"),
        ),
    )
    agreeing = F.element_at(F.transform(F.array(values), held), 1)
    full = runs.select(*key, (covered / F.col("item_tokens")).alias("covered"), "pairs").where(F.col("covered") >= cover)
    judged = full.where(agreeing >= CONSISTENT * F.size("pairs")).select(
        *key,
        "covered",
        F.size("pairs").alias("slots"),
        F.size(F.filter("pairs", lambda p: p["mine"] != p["theirs"])).alias("changed"),
    )
    best = Window.partitionBy(*ROW, "item_id").orderBy(F.desc("covered"), "changed", "stretch", "copy")
    return judged.withColumn("n", F.row_number().over(best)).where("n = 1").drop("n", "copy", "stretch")


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, cover: float = COVER) -> DataFrame:
    """doc_id, item_id, covered, slots, changed: one row per document row and item that it holds."""
    rows = with_row(docs.select("doc_id", "text"))
    found = stage(matches(rows, items, window, cover), "contaminated")
    return rows.drop("text").join(found, ROW).drop(*ROW)


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, cover: float = COVER) -> DataFrame:
    """The rows of ``docs`` that hold no item, with the columns of ``docs``."""
    rows = with_row(docs)
    found = stage(matches(rows, items, window, cover).select(*ROW).distinct(), "contaminated")
    return rows.join(found, ROW, "left_anti").select(*docs.columns)
