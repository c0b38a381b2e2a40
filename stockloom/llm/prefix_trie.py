"""The trie of conversations that begin alike, with totals of its subtrees by depth-band rollup.

Turns stand in order of turn (null first), then of role, of the first characters of the text and of a hash of it;
a null role or text is empty. A node is a distinct sequence of first turns. It is known by its depth and
128 bits, the exclusive-or of one hash per turn of role, text and place. Such hashes of all prefixes are
running aggregates, cut into cells of ``CELL`` turns, so a conversation of any length spreads over tasks.

Subtree totals are rolled up in bands of ``HEIGHT`` depths. Each node adds its values to its ancestors in its own band
only. The tops of the bands then form a tree of their own, of a depth ``HEIGHT`` times smaller, and are rolled up in the same way; when no
more than one band is left, totals are complete. On the way back each finished band top adds its total to its ancestors in the
band above. So a node is exploded to at most ``HEIGHT`` rows a round, and rounds grow with the
logarithm of the depth. Ancestors are found along the path of a node's smallest member, by a join on conversation and band
of at most ``HEIGHT`` rows a side, whatever the number of members or children; totals are pre-aggregated in every task.

Rows without ``conv_id`` are left out. Rows that are equal throughout are turns of their own. Columns besides conv_id, turn, role, text are ignored.
An empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.operators.surrogate import with_surrogate_keys
from stockloom.sources.scratch import stage

HEIGHT = 8
CELL = 64
HEAD = 64  #: characters of a text that decide the order of rows with equal turns and roles
PIECE = 1024  #: ids that are joined to one text before they are hashed
SIBLINGS, SHARED = 5, 9  #: conversations that share an opening, and one more than the turns it may have
NODE = ["depth", "p1", "p2"]


def _hash(salt: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(salt), *columns)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, idx (from 0), t1, t2, bytes: the turns in order, their texts as hashes and lengths."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = conversations.where("conv_id is not null").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    narrow = whole.select(
        "conv_id", "turn", "role", F.substring("text", 1, HEAD).alias("head"), _hash(1, "role", "text").alias("t1"),
        _hash(2, "role", "text").alias("t2"), F.octet_length("text").cast("bigint").alias("bytes"),
    )
    order = ["conv_id", "turn", "role", "head", "t1", "t2"]
    numbered = with_surrogate_keys(narrow, "at", order, unique=False).select("conv_id", "at", "t1", "t2", "bytes")
    staged = stage(numbered, "trie-turns")
    firsts = staged.groupBy("conv_id").agg(F.min("at").alias("first_at"))
    return staged.join(firsts, "conv_id").select("conv_id", (F.col("at") - F.col("first_at")).alias("idx"), "t1", "t2", "bytes")


def rebuilt(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, length) and their turns (conv_id, depth from 1, t1, t2, bytes) with shared openings.

    Conversation c takes the first crc32(c) % 9 turns of c - c % 5 in place of its own; ``%`` keeps the sign.
    """
    own = found.groupBy("conv_id").agg(F.count("*").alias("n"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).alias("h")
    plan = own.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % SIBLINGS).alias("base"), h)
    bases = own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = plan.join(bases, "base", "left").withColumn("m", F.least("h", F.coalesce("base_n", F.lit(0))))
    plan = stage(plan.select("conv_id", "n", "base", "h", "m"), "trie-plan")
    columns = ["conv_id", "depth", "t1", "t2", "bytes"]
    kept = found.join(plan.select("conv_id", "h", "m"), "conv_id").where("idx >= h")
    kept = kept.withColumn("depth", F.col("m") + F.col("idx") - F.col("h") + 1)
    shared = found.where(F.col("idx") < SHARED - 1).withColumnRenamed("conv_id", "base")
    shared = shared.join(plan.select("conv_id", "base", "m"), "base").where("idx < m").withColumn("depth", F.col("idx") + 1)
    length = F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return plan.select("conv_id", length.alias("length")), kept.select(*columns).unionByName(shared.select(*columns))


def paths(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """conv_id, depth, p1, p2, q1, q2, bytes, last: the node of every prefix of every conversation, q its parent's.

    ``last`` tells where the conversation ends. Each conversation has a row of depth 0, the root.
    """
    tagged = rows.select(
        "conv_id", "depth", "bytes", _hash(3, "depth", "t1", "t2").alias("x1"), _hash(4, "depth", "t1", "t2").alias("x2"),
        F.expr(f"(depth - 1) div {CELL}").alias("cell"),
    )
    within = Window.partitionBy("conv_id", "cell").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = stage(tagged.withColumns({"r1": F.bit_xor("x1").over(within), "r2": F.bit_xor("x2").over(within)}), "trie-cells")
    # Cells before a turn's own: one row per CELL turns; most conversations have one cell, hence none.
    totals = running.groupBy("conv_id", "cell").agg(F.bit_xor("x1").alias("c1"), F.bit_xor("x2").alias("c2"))
    before = Window.partitionBy("conv_id").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    front = totals.select(
        "conv_id", "cell", F.bit_xor("c1").over(before).alias("f1"), F.bit_xor("c2").over(before).alias("f2")
    ).where("cell > 0")
    met = running.join(front, ["conv_id", "cell"], "left")

    def xor(a: str, b: str) -> Column:
        return F.col(a).bitwiseXOR(F.coalesce(F.col(b), F.lit(0).cast("bigint")))

    inner = met.withColumns({"p1": xor("r1", "f1"), "p2": xor("r2", "f2")}).withColumns(
        {"q1": xor("p1", "x1"), "q2": xor("p2", "x2")}
    )
    ended = inner.join(convs, "conv_id").withColumn("last", F.col("depth") == F.col("length"))
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    roots = convs.select(
        "conv_id", zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), none.alias("q1"), none.alias("q2"),
        zero.alias("bytes"), (F.col("length") == 0).alias("last"),
    )
    names = roots.columns
    return stage(ended.withColumn("depth", F.col("depth").cast("bigint")).select(*names).unionByName(roots), "trie-paths")


def rolled_up(nodes: DataFrame, path: DataFrame, values: list[str], height: int = HEIGHT) -> DataFrame:
    """depth, p1, p2 and ``values`` summed over the subtree of each node.

    ``nodes`` has these and conv_id, the smallest member; ``path`` has the nodes (depth, p1, p2) that each conv_id passes.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = [F.sum(v).alias(v) for v in values]

    def banded(df: DataFrame, size: int, at: str = "band") -> DataFrame:
        return df.withColumn(at, F.expr(f"depth div {size}"))

    def spread(lower: DataFrame, upper: DataFrame, size: int) -> DataFrame:
        """Values of ``lower`` (with band) summed by the nodes of ``upper`` in that band and not below them."""
        up = banded(upper, size).select("conv_id", "band", *NODE)
        low = lower.select("conv_id", "band", F.col("depth").alias("low"), *values)
        return up.join(low, ["conv_id", "band"]).where("depth <= low").groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), *sums)

    step, levels, now = 1, [], nodes.select("conv_id", *NODE, *values)
    while True:
        size = step * height
        now = stage(spread(banded(now, size), path.where(F.col("depth") % step == 0), size), "trie-up")
        levels.append((step, now))
        if size > deepest:
            break
        now, step = now.where(F.col("depth") % size == 0), size
    done = levels.pop()[1]
    for step, partial in reversed(levels):
        size = step * height
        above = path.where((F.col("depth") % step == 0) & (F.col("depth") % size != 0))
        tops = done.where("depth > 0").withColumn("band", F.expr(f"depth div {size} - 1"))
        inner = partial.where(F.col("depth") % size != 0).unionByName(spread(tops, above, size))
        finished = inner.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), *sums)
        done = stage(done.unionByName(finished), "trie-down")
    return done.select(*NODE, *values)


def endings(path: DataFrame) -> DataFrame:
    """depth, p1, p2, ends_sha256 of the ids, in rising order, of the conversations that end at a node.

    Ids are sorted by range and joined in texts of at most ``PIECE``; a task hashes these as a stream, however many end there.
    """
    ended = path.where("last").select(*NODE, "conv_id")
    numbered = with_surrogate_keys(ended, "at", [*NODE, "conv_id"])
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    pieces = numbered.groupBy(*NODE, F.expr(f"at div {PIECE}").alias("piece")).agg(F.array_join(ids, ",").alias("ids"))

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        kinds = [pa.int64()] * len(NODE) + [pa.string()]

        def rows(finished: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(list(c), t) for c, t in zip(zip(*finished), kinds)]
            return pa.RecordBatch.from_arrays(columns, [*NODE, "ends_sha256"])

        for batch in batches:
            finished = []
            for *key, _, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key == node:
                    digest.update(b"," + text.encode())
                    continue
                if node is not None:
                    finished.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(text.encode())
            if finished:
                yield rows(finished)
        if node is not None:
            yield rows([(*node, digest.hexdigest())])

    ordered = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece")
    return ordered.select(*NODE, "piece", "ids").mapInArrow(digests, "depth bigint, p1 bigint, p2 bigint, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    convs, rows = rebuilt(stage(turns(conversations), "trie-ordered"))
    return nodes_of(paths(convs, rows))


def nodes_of(path: DataFrame, height: int = HEIGHT) -> DataFrame:
    members = path.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.max("bytes").alias("bytes"), F.max("q1").alias("q1"), F.max("q2").alias("q2"),
    )
    members = stage(members, "trie-nodes")
    parent = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")]
    children = members.where("depth > 0").groupBy(*parent).agg(F.count("*").alias("n_children"))
    nodes = members.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("bigint"))
    nodes = stage(
        nodes.withColumns(
            {
                "n_leaves": (F.col("n_children") == 0).cast("bigint"),
                "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes"),
            }
        ),
        "trie-valued",
    )
    totals = rolled_up(nodes, path, ["n_leaves", "saved_tokens"], height)
    above = members.select(
        F.col("depth").alias("above"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id")
    )
    whole = nodes.drop("n_leaves", "saved_tokens").join(totals, NODE).join(endings(path), NODE, "left")
    whole = whole.withColumn("above", F.col("depth") - 1).join(above, ["above", "q1", "q2"], "left")
    nothing = hashlib.sha256().hexdigest()
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
