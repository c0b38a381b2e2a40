"""Roles of raw transcripts by a hidden Markov model, and their canonical rendering.

A transcript is a sequence of lines without roles, in pieces (``conv_id``, ``seq``, ``text``).
A line either begins a turn of some role or goes on with it, so there are two states for each
role. What is seen of a line is the speaker marker it begins with, whether it is blank or follows a
blank line, its length, and whether it asks. Probabilities are counted from labelled
lines; the most likely states are found by Viterbi.

Viterbi's step is a product of matrices over (max, +), which may be grouped freely. A
transcript is cut into chunks of ``CHUNK`` pieces. Each chunk becomes one matrix: the best score from any
state before it to any state at its end. The matrices of a transcript are walked through to fix
the states at the chunk borders, then every chunk finds its own states between its borders. So
a transcript with a third of all lines is spread over the cluster; one task reads just a
small matrix per chunk of it, as a stream.

Turns are rendered as ``<|role|>``, their lines without markers and outer blank lines, and
``<|end|>``. A null text counts as an empty line; pieces without ``conv_id`` or ``seq`` are left out.
Pieces that share both are read in the order of their text. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom.sources.scratch import stage

ROLES = ("system", "user", "assistant")
CHUNK = 32
STATES = 2 * len(ROLES)  #: 2 * role begins a turn, 2 * role + 1 goes on with it
MARKERS = {
    "system": "system|instructions?|context",
    "user": "user|human|customer|question|q",
    "assistant": "assistant|ai|bot|model|answer|a",
}
_NAMES = "|".join(f"(?P<{role}>{words})" for role, words in MARKERS.items())
_MARKER = re.compile(rf"\s*(?:<\|)?(?:#+\s*|\*\*|\[)?(?:{_NAMES})(?:\|>|\*\*:?|\]:?|\s*:|(?=\s*$))\s*", re.IGNORECASE)
SEEN = (len(ROLES) + 1, 3, 5, 2)  #: values of each feature: marker, blank, length, question


class Model(NamedTuple):
    start: np.ndarray  #: [state]
    step: np.ndarray  #: [from, to]
    seen: list[np.ndarray]  #: by feature: [state, value]


def features(lines: list[str]) -> np.ndarray:
    """[line, feature] of consecutive lines."""
    out = np.zeros((len(lines), len(SEEN)), np.int64)
    for i, line in enumerate(lines):
        match = _MARKER.match(line)
        out[i, 0] = ROLES.index(match.lastgroup) + 1 if match else 0
        out[i, 1] = 2 if not line.strip() else int(i > 0 and not lines[i - 1].strip())
        out[i, 2] = min(4, len(line).bit_length() // 2)
        out[i, 3] = line.rstrip().endswith("?")
    return out


def bare(line: str) -> str:
    """A line without its speaker marker."""
    match = _MARKER.match(line)
    return line[match.end() :] if match else line


def _split(text: str | None) -> list[str]:
    return (text or "").split("\n")


def train(labelled: DataFrame) -> Model:
    """Model of pieces (conv_id, seq, text, role), each of which is one turn.

    Every task counts its own pieces; steps between pieces are counted from pairs of neighbours.
    The counts, of a fixed number, are summed by Spark.
    """
    known = labelled.where(F.col("role").isin(*ROLES) & F.col("conv_id").isNotNull() & F.col("seq").isNotNull())
    order = Window.partitionBy("conv_id", F.floor(F.col("seq") / CHUNK)).orderBy("seq", "text")
    pairs = known.select("text", "role", F.lag("role").over(order).alias("before"), "seq")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple[str, int, int], int] = {}
        for batch in batches:
            for text, role, before, seq in zip(*(c.to_pylist() for c in batch.columns)):
                begin = 2 * ROLES.index(role)
                seen = features(_split(text))
                keys = [("step", 2 * ROLES.index(before) + k, begin) for k in (0, 1)] if before else []
                keys += [("start", 0, begin)] if not before and seq == 0 else []
                keys += [("step", begin + min(i - 1, 1), begin + 1) for i in range(1, len(seen))]
                for i, row in enumerate(seen):
                    keys += [(f"seen{f}", begin + min(i, 1), int(v)) for f, v in enumerate(row)]
                for key in keys:
                    n[key] = n.get(key, 0) + 1
        columns = list(zip(*((*k, v) for k, v in n.items()))) or [[]] * 4
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, kinds)], ["kind", "a", "b", "n"]
        )

    sums = pairs.mapInArrow(count, "kind string, a int, b int, n bigint").groupBy("kind", "a", "b").agg(F.sum("n"))
    tables = {"start": np.ones((1, STATES)), "step": np.ones((STATES, STATES))}
    tables["start"][:, 1::2] = 1e-6  # no transcript begins inside a turn,
    for role in range(len(ROLES)):  # and none goes on with another role's turn
        tables["step"][:, 2 * role + 1] = 1e-6
        tables["step"][2 * role : 2 * role + 2, 2 * role + 1] = 1
    tables |= {f"seen{f}": np.full((STATES, size), 0.1) for f, size in enumerate(SEEN)}
    for kind, a, b, n in sums.collect():
        tables[kind][a, b] += n
    logs = {k: np.log(t / t.sum(1, keepdims=True)) for k, t in tables.items()}
    return Model(logs["start"][0], logs["step"], [logs[f"seen{f}"] for f in range(len(SEEN))])


def _scores(lines: list[str], model: Model) -> np.ndarray:
    """[line, state] log-probabilities of what is seen."""
    seen = features(lines)
    return sum(table[:, seen[:, f]] for f, table in enumerate(model.seen)).T


def _first_step(model: Model, opens: bool) -> np.ndarray:
    """[state before, first state]; the first line of a transcript has no state before."""
    return np.repeat(model.start[None, :], STATES, 0) if opens else model.step


def chunk_matrix(lines: list[str], model: Model, opens: bool) -> np.ndarray:
    """[state before, last state]: score of the best path through the lines."""
    scores = _scores(lines, model)
    best = _first_step(model, opens) + scores[0]
    for row in scores[1:]:
        best = (best[:, :, None] + model.step[None]).max(1) + row
    return best


def chunk_path(lines: list[str], model: Model, opens: bool, before: int, last: int) -> list[int]:
    """Best states of the lines between the given border states."""
    scores = _scores(lines, model)
    best, back = _first_step(model, opens)[before] + scores[0], []
    for row in scores[1:]:
        steps = best[:, None] + model.step
        back.append(steps.argmax(0))
        best = steps.max(0) + row
    path = [last]
    for came in reversed(back):
        path.append(int(came[path[-1]]))
    return path[::-1]


def _borders(matrices: DataFrame) -> DataFrame:
    """conv_id, chunk, before, last: states at the borders of chunks; chunks come sorted, as a stream."""

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, best, back, chunks, ids = None, None, [], [], None

        def done() -> pa.RecordBatch:
            path = [int(best.argmax())]
            for came in reversed(back):
                path.append(int(came[path[-1]]))
            path = path[::-1]
            return pa.RecordBatch.from_arrays(
                [ids.slice(0, 1).take(pa.array([0] * len(chunks), pa.int64())), pa.array(chunks, pa.int64()),
                 pa.array([0, *path[:-1]], pa.int32()), pa.array(path, pa.int32())],
                ["conv_id", "chunk", "before", "last"],
            )

        for batch in batches:
            keys = batch.column(0).to_pylist()
            tables = batch.column(2).flatten().to_numpy().reshape(-1, STATES, STATES)
            for i, (key, chunk) in enumerate(zip(keys, batch.column(1).to_pylist())):
                if key != conv or best is None:
                    if best is not None:
                        yield done()
                    conv, best, back, chunks, ids = key, tables[i][0], [], [chunk], batch.column(0).slice(i, 1)
                else:
                    steps = best[:, None] + tables[i]
                    back.append(steps.argmax(0).astype(np.int8))
                    best = steps.max(0)
                    chunks.append(chunk)
        if best is not None:
            yield done()

    kind = dict(matrices.dtypes)["conv_id"]
    sorted_ = matrices.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return sorted_.mapInArrow(walk, f"conv_id {kind}, chunk bigint, before int, last int")


def lines_with_roles(pieces: DataFrame, model: Model) -> DataFrame:
    """conv_id, chunk, at, seq, role, begins, line: every line of the transcripts (conv_id, seq, text).

    ``at`` numbers the lines of a chunk; the other columns of ``pieces`` are left out.
    """
    kind = dict(pieces.dtypes)["conv_id"]
    cut = stage(
        pieces.where("conv_id is not null and seq is not null").select(
            "conv_id", F.floor(F.col("seq") / CHUNK).cast("bigint").alias("chunk"), F.col("seq").cast("bigint").alias("seq"), "text"
        ),
        "chat-pieces",
    )
    firsts = cut.groupBy("conv_id").agg(F.min("chunk").alias("first"))
    shared = pieces.sparkSession.sparkContext.broadcast(model)

    def ordered(rows: pd.DataFrame) -> tuple[list[str], list[int]]:
        rows = rows.fillna({"text": ""}).sort_values(["seq", "text"])
        found = [(line, seq) for seq, text in zip(rows["seq"], rows["text"]) for line in _split(text)]
        return [f[0] for f in found], [f[1] for f in found]

    def measure(rows: pd.DataFrame) -> pd.DataFrame:
        lines, _ = ordered(rows)
        matrix = chunk_matrix(lines, shared.value, bool(rows["first"].iloc[0] == rows["chunk"].iloc[0]))
        return pd.DataFrame({"conv_id": rows["conv_id"][:1], "chunk": rows["chunk"][:1], "matrix": [matrix.ravel()]})

    def decode(rows: pd.DataFrame) -> pd.DataFrame:
        lines, seqs = ordered(rows)
        one = rows.iloc[0]
        path = np.array(chunk_path(lines, shared.value, one["first"] == one["chunk"], one["before"], one["last"]))
        return pd.DataFrame(
            {
                "conv_id": one["conv_id"],
                "chunk": one["chunk"],
                "at": np.arange(len(lines)),
                "seq": seqs,
                "role": np.array(ROLES)[path // 2],
                "begins": path % 2 == 0,
                "line": lines,
            }
        )

    placed = cut.join(firsts, "conv_id")
    matrices = placed.groupBy("conv_id", "chunk").applyInPandas(
        measure, f"conv_id {kind}, chunk bigint, matrix array<double>"
    )
    borders = stage(_borders(stage(matrices, "chat-matrices")), "chat-borders")
    return (
        placed.join(borders, ["conv_id", "chunk"])
        .groupBy("conv_id", "chunk")
        .applyInPandas(
            decode, f"conv_id {kind}, chunk bigint, at bigint, seq bigint, role string, begins boolean, line string"
        )
    )


def turns(pieces: DataFrame, model: Model) -> DataFrame:
    """conv_id, turn, role, first_seq, lines, rendered: the turns of the transcripts, numbered from 0.

    Turns are numbered within chunks first and then by the counts of the chunks before. A turn's
    lines are put together from at most the chunks that it spans.
    """
    lines = stage(lines_with_roles(pieces, model), "chat-lines")
    counts = lines.groupBy("conv_id", "chunk").agg(F.sum(F.col("begins").cast("bigint")).alias("n"))
    across = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("conv_id", "chunk", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("offset"))
    within = Window.partitionBy("conv_id", "chunk").orderBy("at")
    numbered = lines.join(offsets, ["conv_id", "chunk"]).withColumn(
        "turn", F.col("offset") + F.sum(F.col("begins").cast("bigint")).over(within) - 1
    )
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "at", "line"))), lambda x: x["line"]), "\n")
    together = numbered.groupBy("conv_id", "turn").agg(
        F.first("role").alias("role"), F.min("seq").alias("first_seq"), F.count("*").alias("lines"), body.alias("body")
    )

    def render(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                f"<|{role}|>\n{rendered(body)}\n<|end|>"
                for role, body in zip(batch.column(2).to_pylist(), batch.column(5).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(texts, pa.string())], names)

    names = ["conv_id", "turn", "role", "first_seq", "lines", "rendered"]
    kind = dict(pieces.dtypes)["conv_id"]
    return together.mapInArrow(
        render, f"conv_id {kind}, turn bigint, role string, first_seq bigint, lines bigint, rendered string"
    )


def rendered(body: str) -> str:
    """The text of a turn: no marker, no blank lines around it."""
    first, _, rest = body.lstrip("\n").partition("\n")
    return "\n".join([bare(first), rest] if rest else [bare(first)]).strip("\n")
