"""Repair of the structure of conversations, as a shortest path found by auction.

A sound conversation has the role initials ``(s?(ua)+)?``. Reading a conversation row by row, the state is
what the repaired rows so far end with: nothing (0), a system row (1), a user row (2), an assistant row (3).
Rows by states form a lattice whose arcs are edits with whole costs: keep a row, give it another role, delete
it, or insert an empty row in front of it. The cheapest repair is a shortest path to the end.

It is found by auction. Nodes have prices, which begin at a lower bound of their distance (what each row
costs in any case). A path grows from the start: where its last node's price is below its cheapest arc plus the
price behind it, the price rises to that and the path contracts by a node; else the path is extended along that arc, until it reaches the end.
The prices are then an optimal dual solution, so the shortest paths are those along tight arcs, whose cost equals
the difference of prices. Of these the one whose edits' initials are least in ASCII is traced: each edit
leads from a node to one other node, so taking the least edit that still reaches the end is exact.

A conversation is cut into pieces of ``CHUNK`` rows. For most, that is one piece. Others first get
the cost of each piece from every state to every state, also by auction; combined over the pieces behind (``scan``),
they give the price of each state at a piece's end. The pieces are then solved by themselves between their borders.
So a conversation with a third of all rows is spread over the cluster. Only its checksum, which can't be computed in parts, and
its one string of edits are put together in one task, as a stream of rows.

Rows are taken by turn, nulls first, then by role, the first characters of the text, and a hash of it. A null role or
text is one blank. Rows without ``conv_id`` are one conversation, returned with a null. Repeated rows are
duplicates of the first. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from stockloom.llm.scan import scanned
from stockloom.operators.surrogate import with_surrogate_keys
from stockloom.sources.scratch import stage

CHUNK = 64
HEAD = 64  #: characters of a text that decide the order of rows with equal turns and roles
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
STATES = 4
FAR = 1 << 40  #: no path
NEXT = (2, 2, 3, 2)  #: state after a row whose role follows
LETTER = {2: "u", 3: "a"}
ROLE = {"u": "user", "a": "assistant"}
END = [0, 2 * INSERT, INSERT, 0]  #: cost from a state behind the last row: rows that are inserted there
TAIL = ("", "ua", "a", "")
# One character per row: its role's initial, in capitals if it is truncated, as a digit if it has to go.
GONE = {"0": "s", "1": "u", "2": "a", "3": "x"}
BLANK = " \t\n\x0b\x0c\r"


# --- one piece, from a string of codes --------------------------------------------


def initial(code: str) -> str:
    return GONE.get(code) or code.lower()


def arcs_of(codes: str, ends: list[int]) -> list[list[tuple[str, int, int]]]:
    """Per node (row * STATES + state; the last one is the end) its arcs as (edit, cost, to).

    Only nodes from which the end is reached have arcs, and arcs lead to such nodes only.
    """
    n = len(codes)
    goal = (n + 1) * STATES
    arcs: list[list[tuple[str, int, int]]] = [[] for _ in range(goal + 1)]
    for state in range(STATES):
        if ends[state] < FAR:
            arcs[n * STATES + state].append(("", ends[state], goal))
    for row in range(n - 1, -1, -1):
        code, here, there = codes[row], row * STATES, (row + 1) * STATES
        plain = initial(code)
        more = TRUNCATED if code.isupper() else 0
        for state in range(STATES):
            found = [("D", DELETE, there + state)]
            if code not in GONE:
                if plain == "s" and state == 0:
                    found.append(("K", KEEP + more, there + 1))
                elif plain == LETTER[NEXT[state]]:
                    found.append(("K", KEEP + more, there + NEXT[state]))
                found.append(("R", REROLE + more, there + NEXT[state]))
            arcs[here + state] = [a for a in found if arcs[a[2]]]
        # Inserting goes from 0, 1 and 3 to 2, and between 2 and 3.
        if arcs[here + 2] or arcs[here + 3]:
            inserts = [(state, ("I", INSERT, here + NEXT[state])) for state in range(STATES)]
            inserts.sort(key=lambda found: found[0] != (3 if arcs[here + 2] else 2))
            for state, arc in inserts:
                if arcs[arc[2]]:
                    arcs[here + state].append(arc)
    return arcs


def floor_prices(codes: str, ends: list[int]) -> list[int]:
    """Prices that no path undercuts: what the rows behind a node cost in any case, and the cheapest end."""
    price = [min(ends)] * STATES + [0]
    for code in reversed(codes):
        least = DELETE if code in GONE else min(DELETE, TRUNCATED) if code.isupper() else 0
        price = [price[0] + least] * STATES + price
    return price


def auction(arcs: list[list[tuple[str, int, int]]], price: list[int], start: int) -> int:
    """Raise ``price`` until the path from ``start`` reaches the last node; its cost, or FAR without any path."""
    goal = len(arcs) - 1
    if not arcs[start]:
        return FAR
    path = [start]
    while path[-1] != goal:
        node = path[-1]
        best, onward = FAR, goal
        for _, cost, to in arcs[node]:
            if cost + price[to] < best:
                best, onward = cost + price[to], to
        if price[node] < best:
            price[node] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(onward)
    return price[start] - price[goal]


def tight(arcs: list[list[tuple[str, int, int]]], price: list[int]) -> list[dict[str, int]]:
    """Per node the tight arcs (edit to node) from which the end is reached along tight arcs."""
    found: list[dict[str, int]] = [{} for _ in arcs]
    goal = len(arcs) - 1
    good = {goal}
    for first in range(goal - STATES, -1, -STATES):
        level = range(first, first + STATES)
        for _ in range(STATES):  # inserts stay on their level
            for node in level:
                for edit, cost, to in arcs[node]:
                    if to in good and price[node] == cost + price[to]:
                        found[node][edit] = to
                        good.add(node)
    return found


def trace(codes: str, found: list[dict[str, int]], start: int) -> tuple[list[str], int]:
    """Per row its edits, inserted roles in front, and the state behind the last row."""
    goal = len(found) - 1
    node, rows, inserted = start, [], ""
    while True:
        edit = min(found[node])
        to = found[node][edit]
        if to == goal:
            return rows, node % STATES
        if edit == "I":
            inserted += LETTER[to % STATES]
        else:
            rows.append(inserted + (LETTER[to % STATES].upper() if edit == "R" else edit))
            inserted = ""
        node = to


def solved(codes: str, ends: list[int], start: int) -> tuple[list[str], int, int]:
    """Edits per row, state at the end, and cost of the rows, from a state in front of them."""
    arcs, price = arcs_of(codes, ends), floor_prices(codes, ends)
    cost = auction(arcs, price, start)
    rows, last = trace(codes, tight(arcs, price), start)
    return rows, last, cost - ends[last]


def crossing(codes: str) -> list[int]:
    """Costs from every state in front of the rows to every state behind them, row by row of the matrix."""
    out = [FAR] * (STATES * STATES)
    for last in range(STATES):
        ends = [0 if state == last else FAR for state in range(STATES)]
        arcs, price = arcs_of(codes, ends), floor_prices(codes, ends)
        for start in range(STATES):
            out[start * STATES + last] = auction(arcs, price, start)
    return out


def times(a: list[int], b: list[int]) -> list[int]:
    """Product of two matrices over (min, +)."""
    span = range(STATES)
    return [min(FAR, *(a[i * STATES + k] + b[k * STATES + j] for k in span)) for i in span for j in span]


def exits(codes: str, ends: list[int]) -> list[int]:
    """The state behind the rows for every state in front of them."""
    arcs, price = arcs_of(codes, ends), floor_prices(codes, ends)
    for start in range(STATES):
        auction(arcs, price, start)
    found = tight(arcs, price)
    return [trace(codes, found, start)[1] for start in range(STATES)]


def after(first: list[int], then: list[int]) -> list[int]:
    return [then[state] for state in first]


UNIT = [0 if i == j else FAR for i in range(STATES) for j in range(STATES)]

_LONGS, _longs = ArrayType(LongType()), pa.list_(pa.int64())


@F.arrow_udf(_LONGS)
def _crossing(codes: pa.Array) -> pa.Array:
    return pa.array([crossing(c) for c in codes.to_pylist()], _longs)


@F.arrow_udf(_LONGS)
def _ends(behind: pa.Array) -> pa.Array:
    """Price of each state at the end of a piece, from the matrix of all pieces behind it."""
    span = range(STATES)
    return pa.array([[min(m[i * STATES + j] + END[j] for j in span) for i in span] for m in behind.to_pylist()], _longs)


@F.arrow_udf(_LONGS)
def _exits(codes: pa.Array, ends: pa.Array) -> pa.Array:
    return pa.array([exits(c, e) for c, e in zip(codes.to_pylist(), ends.to_pylist())], _longs)


_SOLVED = StructType([StructField("edits", StringType()), StructField("last", LongType()), StructField("cost", LongType())])


@F.arrow_udf(_SOLVED)
def _solved(codes: pa.Array, ends: pa.Array, start: pa.Array) -> pa.Array:
    out, known = [], {}
    for key in zip(codes.to_pylist(), map(tuple, ends.to_pylist()), start.to_pylist()):
        if key not in known:  # short conversations are often alike
            rows, last, cost = solved(key[0], list(key[1]), key[2])
            known[key] = {"edits": " ".join(rows), "last": last, "cost": cost}
        out.append(known[key])
    return pa.array(out, pa.struct({"edits": pa.string(), "last": pa.int64(), "cost": pa.int64()}))


# --- tables -----------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults that follow from a checksum of the row's ids; nulls are one blank there."""
    blank = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)
    )
    fault = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    worse = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return conversations.where(fault != 0).select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        worse.alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with ``k``, a key that isn't null, and what decides their order: turn, role, head, t1, t2."""
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv_id",
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("k"),
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.substring(text, 1, HEAD).alias("head"),
        F.xxhash64(text).alias("t1"),
        F.xxhash64(F.lit(1), text).alias("t2"),
        text.alias("text"),
    )


ORDER = ["turn", "role", "head", "t1", "t2"]


def faults(rows: DataFrame) -> DataFrame:
    """Rows by order (``at``), without texts, with ``fault`` (blank, duplicate, truncated or null) and ``first``, their role's initial."""
    kept = F.rtrim(F.col("text"), F.lit(BLANK))
    narrow = _keyed(rows).select(
        "conv_id", "k", *ORDER,
        (kept == "").alias("blank"),
        (~F.substring(kept, -1, 1).isin(".", "!", "?")).alias("open"),
    )
    numbered = stage(with_surrogate_keys(narrow, "at", ["conv_id", *ORDER], unique=False), "repair-rows")
    same = ["k", "role", "t1", "t2"]
    # Only texts that recur meet their rows again; they are few unless texts do recur.
    seen = numbered.groupBy(*same).agg(F.min("at").alias("first_at"), F.count("*").alias("n")).where("n > 1")
    met = numbered.join(seen.drop("n"), same, "left")
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("at") > F.col("first_at"), "duplicate").when(F.col("open"), "truncated")
    )
    mark = F.substring("role", 1, 1)
    return met.select(
        "conv_id", "k", *ORDER, "at", fault.alias("fault"), F.when(mark.isin("s", "u", "a"), mark).otherwise("x").alias("first")
    )


def _pieces(found: DataFrame) -> DataFrame:
    """One row per piece of a conversation: k, idx, codes, and the order of its first row."""
    gone = F.element_at(F.create_map(*(F.lit(v) for c, f in GONE.items() for v in (f, c))), F.col("first"))
    code = (
        F.when(F.col("fault").isin("blank", "duplicate"), gone)
        .when(F.col("fault") == "truncated", F.upper("first"))
        .otherwise(F.col("first"))
    )
    listed = F.array_sort(F.collect_list(F.struct("at", code.alias("code"))))
    return found.groupBy("k", F.expr(f"at div {CHUNK}").alias("idx")).agg(
        F.first("conv_id").alias("conv_id"),
        F.array_join(F.transform(listed, lambda x: x["code"]), "").alias("codes"),
        F.min(F.struct(*ORDER)).alias("head_row"),
    )


def edits(found: DataFrame) -> DataFrame:
    """One row per piece: k, idx, conv_id, codes, head_row, edits (of its rows, apart by blanks), last, cost, final."""
    pieces = stage(_pieces(found), "repair-pieces")
    spans = pieces.groupBy("k").agg(F.min("idx").alias("lo"), F.max("idx").alias("hi"))
    placed = pieces.join(spans, "k")
    end = F.array(*(F.lit(c).cast("long") for c in END))
    alone = placed.where("lo = hi").withColumn("s", _solved("codes", end, F.lit(0).cast("long")))
    columns = ["k", "idx", "conv_id", "codes", "head_row", "s.edits", "s.last", "s.cost", (F.col("idx") == F.col("hi")).alias("final")]
    several = placed.where("lo < hi")
    if not several.isEmpty():
        several = stage(several, "repair-several")
        matrices = several.select("k", "idx", _crossing("codes").alias("value"))
        behind = scanned(matrices, times, UNIT, "repair-behind", behind=True)
        priced = stage(several.join(behind, ["k", "idx"]).withColumn("ends", _ends("before")).drop("before"), "repair-priced")
        ways = priced.select("k", "idx", _exits("codes", "ends").alias("value"))
        entries = scanned(ways, after, list(range(STATES)), "repair-entries")
        several = priced.join(entries, ["k", "idx"]).withColumn("s", _solved("codes", "ends", F.col("before")[0]))
        alone = alone.select(*columns).unionByName(several.select(*columns))
        return alone
    return alone.select(*columns)


_RESULT = "illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _written(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """conv_id, illegal, cost, audit, repaired_sha256 of each conversation with rows.

    Each task gets its conversations in order, pieces before their rows, and hashes them as a stream.
    """
    kind = dict(rows.dtypes)["conv_id"]
    nothing = F.lit(None)
    texts = _keyed(rows).withColumns(
        {"kind": F.lit(1), "idx": F.lit(0).cast("long"), "codes": nothing.cast("string"), "edits": nothing.cast("string"),
         "last": nothing.cast("long"), "cost": nothing.cast("long"), "final": nothing.cast("boolean")}
    )
    plans = pieces.select(
        "conv_id", "k", *(F.col(f"head_row.{c}").alias(c) for c in ORDER), nothing.cast("string").alias("text"),
        F.lit(0).alias("kind"), "idx", "codes", "edits", "last", "cost", "final",
    )
    names = ["conv_id", "k", "kind", "codes", "edits", "last", "cost", "final", "role", "text"]

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = None
        for batch in batches:
            done = []
            columns = [c.to_pylist() for c in batch.columns]
            for conv_id, k, kind, codes, plan, last, cost, final, role, text in zip(*columns):
                if one is None or one.k != k:
                    if one is not None:
                        done.append(one.row())
                    one = _Writer(conv_id, k)
                if kind == 0:
                    one.piece(codes, plan, last, cost, final)
                else:
                    one.line(role, text)
            if done:
                yield _batch(done, batch.schema.field(0).type)
            type_ = batch.schema.field(0).type
        if one is not None:
            yield _batch([one.row()], type_)

    ordered = texts.unionByName(plans).repartition("k").sortWithinPartitions("k", *ORDER, "kind", "idx")
    return ordered.select(*names).mapInArrow(write, f"conv_id {kind}, {_RESULT}")


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = [kind, pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["conv_id", "illegal", "cost", "audit", "repaired_sha256"]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)


class _Writer:
    """The repaired conversation, as far as it has been read."""

    def __init__(self, conv_id, k: str):
        self.conv_id, self.k = conv_id, k
        self.digest, self.empty = hashlib.sha256(), True
        self.audit: list[str] = []
        self.waiting: list[str] = []  # edits of rows to come, the next one last
        self.tail, self.cost, self.illegal, self.before = "", 0, 0, None

    def piece(self, codes: str, plan: str, last: int, cost: int, final: bool) -> None:
        rows = plan.split(" ")
        self.waiting = rows[::-1] + self.waiting
        self.audit += [e[:-1].replace("u", "I").replace("a", "I") + e[-1].replace("U", "R").replace("A", "R") for e in rows]
        for now in map(initial, codes):
            self.illegal += self.before is not None and self.before + now not in ("su", "ua", "au")
            self.before = now
        self.cost += cost + (END[last] if final else 0)
        self.tail = TAIL[last] if final else ""

    def line(self, role: str, text: str) -> None:
        edit = self.waiting.pop()
        for letter in edit[:-1]:
            self.put(ROLE[letter], "")
        if edit[-1] != "D":
            self.put(role if edit[-1] == "K" else ROLE[edit[-1].lower()], text)

    def put(self, role: str, text: str) -> None:
        if not self.empty:
            self.digest.update(b"\n")
        self.empty = False
        self.digest.update(f"{role}:".encode())
        self.digest.update(text.encode())

    def row(self) -> tuple:
        for letter in self.tail:
            self.put(ROLE[letter], "")
        audit = "".join(self.audit) + "I" * len(self.tail)
        return self.conv_id, self.illegal, self.cost, audit, self.digest.hexdigest()


def repaired(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text), and of those that ``conversations`` has besides.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. Other columns are left out.
    """
    rows = rows.select("conv_id", "turn", "role", "text")
    found = stage(faults(rows), "repair-faults")

    def number(fault: str):
        return F.sum((F.coalesce("fault", F.lit("")) == fault).cast("long")).alias(fault)

    turns = found.groupBy("conv_id", "turn").agg(*map(number, ("blank", "duplicate", "truncated")))
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    counts = turns.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *(F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated"))
    )
    written = _written(rows, stage(edits(found), "repair-edits"))
    parts = counts.unionByName(written, allowMissingColumns=True)
    if conversations is not None:
        parts = parts.unionByName(conversations.select("conv_id"), allowMissingColumns=True)
    nothing = hashlib.sha256().hexdigest()
    sums = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return parts.groupBy("conv_id").agg(
        *(F.coalesce(F.max(c), F.lit(0)).alias(c) for c in sums),
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(nothing)).alias("repaired_sha256"),
    )
