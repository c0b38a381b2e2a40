"""Main texts of web pages by a linear-chain conditional random field over the leaf blocks of their trees.

A page is read into leaf blocks: stretches of text between borders of block elements, each with the elements around it. Scripts, styles,
heads, templates, buttons and fields hold no blocks. What is seen of a block are the names, classes, ids and roles of the elements
around it (parts of words apart), and of its text the length, share of linked characters, last character, digits and a few telling words. The
blocks of a page are a chain with two labels, main text or not. Weights of what is seen and of
neighbouring labels are fitted to labelled pages (``layouts``) by maximum likelihood: gradients by forward and backward sums, in
numpy. The most likely labels are found by Viterbi.

The labelled pages number ``PAGES`` at any size of input; weights are a table of fixed size that every task gets. Each page is read by
itself, in one pass without a shuffle.

A null or empty page, or one without main text, gives an empty text. Repeated rows are read alike. Unclosed elements
and broken markup are read as far as they go.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stockloom.llm.layouts import MAIN, label_of, labelled_pages, unmarked

PAGES, SEED = 1000, 12  #: labelled pages
SLOTS = 1 << 14  #: hashed features
ROUNDS, PENALTY = 120, 1e-4
LABELS = 2

# Fixed names of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template head title textarea select option button svg math iframe object canvas audio video datalist".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: An element of the left ends when one of the right begins in it.
ENDS = {
    "p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
    "tr": {"tr"},
}
SCOPES = frozenset("table ul ol dl".split())  #: borders that such an implied end doesn't cross
CUES = frozenset(
    "cookie cookies copyright rights reserved privacy subscribe newsletter comment comments reply share tweet login search "
    "advertisement sponsored related sign menu home contact terms posted".split()
)
_BLANK = re.compile(r"\s+")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Block(NamedTuple):
    text: str
    seen: tuple[str, ...]  #: features of the elements around it, each once
    nearest: tuple[str, ...]  #: the innermost one or two of them
    linked: int  #: characters of the text within links


class _Reader(HTMLParser):
    """Blocks of a page in order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, tuple[str, ...], tuple[str, ...]]] = []
        self.pieces: list[str] = []
        self.linked, self.links, self.muted = 0, 0, 0

    def flush(self) -> None:
        if self.pieces:
            text = _BLANK.sub(" ", "".join(self.pieces)).strip()
            if text:
                seen, nearest = self.open[-1][1:] if self.open else ((), ())
                self.blocks.append(Block(text, seen, nearest, self.linked))
        self.pieces, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "br":
                self.pieces.append(" ")
            elif tag in BLOCKS:
                self.flush()
            return
        if tag in BLOCKS:
            self.flush()
            self.imply(tag)
        self.muted += tag in SILENT
        self.links += tag == "a"
        seen, nearest = self.open[-1][1:] if self.open else ((), ())
        found = _features(tag, _named(attrs))
        if found:
            seen += tuple(f for f in found if f not in seen)
            nearest = (nearest + tuple(f for f in found if f.startswith("<")))[-2:]
        self.open.append((tag, seen, nearest))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in SILENT:  # a closing slash means nothing on other elements
            self.handle_endtag(tag)

    def imply(self, tag: str) -> None:
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name in ENDS and tag in ENDS[name]:
                self.close_from(at)
                return
            if name in SCOPES or (name in BLOCKS and name not in ENDS):
                return

    def handle_endtag(self, tag):
        if tag == "br":
            self.pieces.append(" ")
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                if tag in BLOCKS:
                    self.flush()
                self.close_from(at)
                return
            if tag not in BLOCKS and self.open[at][0] in BLOCKS:
                return  # a stray end of an inline element
            if tag in BLOCKS and self.open[at][0] in SCOPES and tag not in SCOPES and tag in ENDS:
                return
        if tag in BLOCKS:
            self.flush()

    def close_from(self, at: int) -> None:
        for name, *_ in self.open[at:]:
            self.muted -= name in SILENT
            self.links -= name == "a"
        del self.open[at:]

    def handle_data(self, data):
        if not self.muted:
            self.pieces.append(data)
            if self.links:
                self.linked += len(data)

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # an unknown section is skipped like a comment
            return self.parse_bogus_comment(i)


def _named(attrs: list[tuple[str, str | None]]) -> tuple[tuple[str, str], ...]:
    kept = [(k, v or "") for k, v in attrs if k in ("class", "id", "role", "hidden", "itemprop", "aria-hidden", "style")]
    return tuple((k, v) for k, v in kept if k != "style" or "none" in v)


@lru_cache(maxsize=4096)
def _features(tag: str, attrs: tuple[tuple[str, str], ...]) -> tuple[str, ...]:
    found = [f"<{tag}"] if tag in BLOCKS or attrs or tag == "a" else []
    for name, value in attrs:
        if name in ("hidden", "style") or (name == "aria-hidden" and value == "true"):
            found.append("hidden")
        else:
            found += [f".{p.lower()}" for p in _PART.findall(value)]
    return tuple(dict.fromkeys(found))


def blocks(html: str | None) -> list[Block]:
    if not html:
        return []
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader.blocks


def features(chain: list[Block]) -> list[list[int]]:
    """Slots of each block's features, repeated ones once."""
    out = []
    for i, block in enumerate(chain):
        text = block.text
        n = len(text)
        words = text.split(" ") if n < 200 else []
        seen = {f"in {s}" for s in block.seen}
        seen |= {f"own {s}" for s in block.nearest[-1:]} | {f"above {s}" for s in block.nearest[-2:-1]}
        seen |= {
            "any",
            f"length {min(9, n.bit_length())}",
            f"links {0 if not block.linked else 1 + min(2, 3 * block.linked // max(1, n))}",
            f"ends {text[-1] if text[-1] in '.!?:…' else 'other'}",
            f"length {min(9, n.bit_length())} ends {text[-1] in '.!?'} links {2 * block.linked > n}",
        }
        seen |= {f"word {w}" for w in (x.strip(".,:!?()").lower() for x in words) if w in CUES}
        if "©" in text:
            seen.add("sign")
        if 3 * sum(map(str.isdigit, text[:200])) > min(n, 200):
            seen.add("digits")
        if i == 0:
            seen.add("first")
        if i == len(chain) - 1:
            seen.add("last")
        out.append(sorted(_slot(s) for s in seen))
    return out


@lru_cache(maxsize=1 << 16)
def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % SLOTS


class Model(NamedTuple):
    weight: np.ndarray  #: [slot, label]
    step: np.ndarray  #: [label before, label]


def scores(chain: list[list[int]], model: Model) -> np.ndarray:
    """[block, label]"""
    sizes = np.fromiter(map(len, chain), np.int64, len(chain))
    flat = np.fromiter((s for slots in chain for s in slots), np.int64, int(sizes.sum()))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return np.add.reduceat(model.weight[flat], starts, axis=0)


def viterbi(score: np.ndarray, step: np.ndarray) -> list[int]:
    best, back = score[0], []
    for row in score[1:]:
        ways = best[:, None] + step
        back.append(ways.argmax(0))
        best = ways.max(0) + row
    path = [int(best.argmax())]
    for came in reversed(back):
        path.append(int(came[path[-1]]))
    return path[::-1]


def likelihood(weight: np.ndarray, step: np.ndarray, data: Padded) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean log-likelihood of the labels of a chain, and its gradients."""
    chains, length = data.labels.shape
    score = np.zeros((chains, length, LABELS))
    score[data.alive] = np.add.reduceat(weight[data.slot], data.start, axis=0)
    alive = data.alive[:, :, None]
    alpha, beta = np.zeros_like(score), np.zeros_like(score)
    alpha[:, 0] = score[:, 0]
    for t in range(1, length):
        moved = np.logaddexp.reduce(alpha[:, t - 1, :, None] + step[None], 1) + score[:, t]
        alpha[:, t] = np.where(alive[:, t], moved, alpha[:, t - 1])
    for t in range(length - 2, -1, -1):
        moved = np.logaddexp.reduce(step[None] + (score[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        beta[:, t] = np.where(alive[:, t + 1], moved, 0)
    total = np.logaddexp.reduce(alpha[:, -1], 1)
    chance = np.exp(alpha + beta - total[:, None, None]) * alive
    pairs = np.exp(
        alpha[:, :-1, :, None] + step[None, None] + (score + beta)[:, 1:, None, :] - total[:, None, None, None]
    ) * alive[:, 1:, :, None]
    real = np.eye(LABELS)[data.labels] * alive
    real_pairs = real[:, :-1, :, None] * real[:, 1:, None, :]
    value = ((score * real).sum() + (real_pairs * step).sum() - total.sum()) / chains
    gap = (real - chance) / chains
    each = np.repeat(gap[data.alive], np.diff(data.start, append=len(data.slot)), axis=0)
    slope = np.stack([np.bincount(data.slot, each[:, label], SLOTS) for label in range(LABELS)], 1)
    return value, slope, (real_pairs - pairs).sum((0, 1)) / chains


class Padded(NamedTuple):
    """Chains as one table: their labels, which places hold a block, and the slots of all blocks' features in order."""

    labels: np.ndarray
    alive: np.ndarray
    slot: np.ndarray
    start: np.ndarray  #: where a block's slots begin


def padded(chains: list[tuple[list[list[int]], list[int]]]) -> Padded:
    longest = max(len(labels) for _, labels in chains)
    labels, alive = np.zeros((len(chains), longest), np.int64), np.zeros((len(chains), longest), bool)
    for c, (_, known) in enumerate(chains):
        labels[c, : len(known)], alive[c, : len(known)] = known, True
    slots = [s for seen, _ in chains for s in seen]
    starts = np.concatenate([[0], np.cumsum([len(s) for s in slots])[:-1]]).astype(np.int64)
    return Padded(labels, alive, np.array([s for found in slots for s in found], np.int64), starts)


def labelled_chains(n: int, seed: int) -> list[tuple[list[list[int]], list[int]]]:
    out = []
    for page in labelled_pages(n, seed):
        marked = [(b, label_of(b.text)) for b in blocks(page)]
        known = [(b, label) for b, label in marked if label is not None and unmarked(b.text)]
        if known:
            plain = [b._replace(text=unmarked(b.text)) for b, _ in known]
            out.append((features(plain), [label for _, label in known]))
    return out


@lru_cache(maxsize=2)
def train(pages: int = PAGES, seed: int = SEED) -> Model:
    """Weights fitted by steps whose length adapts to each weight's gradients so far; the same for the same arguments."""
    data = padded(labelled_chains(pages, seed))
    weight, step = np.zeros((SLOTS, LABELS)), np.zeros((LABELS, LABELS))
    sums = [np.zeros_like(weight), np.zeros_like(step)]
    for _ in range(ROUNDS):
        _, *slopes = likelihood(weight, step, data)
        for table, slope, past in zip((weight, step), slopes, sums):
            slope -= PENALTY * table
            past += slope * slope
            table += 0.5 * slope / np.sqrt(past + 1e-8)
    return Model(weight, step)


def main_text(html: str | None, model: Model) -> str:
    chain = blocks(html)
    if not chain:
        return ""
    path = viterbi(scores(features(chain), model), model.step)
    return "\n".join(b.text for b, label in zip(chain, path) if label == MAIN)


def extracted(pages: DataFrame, model: Model, html: str = "html") -> DataFrame:
    """``pages`` without its html, with ``text`` and ``n_chars``; columns of these names are replaced."""
    kept = [f for f in pages.schema.fields if f.name not in (html, "text", "n_chars")]
    shared = pages.sparkSession.sparkContext.broadcast(model)
    names = [*(f.name for f in kept), "text", "n_chars"]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), shared.value) for page in batch.column(0)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string()), sizes], names)

    schema = StructType([*kept, StructField("text", StringType(), False), StructField("n_chars", LongType(), False)])
    return pages.select(html, *(f.name for f in kept)).mapInArrow(read, schema)
