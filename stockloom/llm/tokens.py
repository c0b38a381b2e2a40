"""Tokens of texts as numpy arrays: places, kinds and 64-bit hashes, in blocks of bounded size.

A token is a run of letters and digits, with dots and commas between digits kept inside.
Bytes from 0x80 on count as letters. Hashes are those of the lower-cased token.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

BLOCK = 1 << 20  #: bytes that are split at a time

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_STEP = 0xD6E8FEB86659FD93
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


class Tokens(NamedTuple):
    hashes: np.ndarray
    number: np.ndarray  #: digits, dots and commas only
    measure: np.ndarray  #: a digit first, letters behind
    capital: np.ndarray  #: the first letter is a capital, the second isn't
    opening: np.ndarray  #: first of a text or sentence


def _table(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


_DIGIT = _table((0x30, 0x39))
_WORD = _table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_POINT = _table((0x2C, 0x2C), (0x2E, 0x2E))
_END = _table((0x0A, 0x0A), (0x0D, 0x0D), (0x21, 0x21), (0x2E, 0x2E), (0x3A, 0x3B), (0x3F, 0x3F))
_UPPER = _table((0x41, 0x5A))


@functools.lru_cache(maxsize=8)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(_STEP)
    return values ^ (values >> np.uint64(29))


def tokens(data: bytes, lowered: bytes, opening: bool = True) -> Tokens:
    """Tokens of a block; ``lowered`` has the same length. ``opening``: a sentence begins here."""
    raw, low = np.frombuffer(data, np.uint8), np.frombuffer(lowered, np.uint8)
    word, digit = _WORD[raw], _DIGIT[raw]
    point = np.zeros(len(raw), bool)
    point[1:-1] = _POINT[raw[1:-1]] & digit[:-2] & digit[2:]
    word |= point
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    up, down = _powers(1 << max(10, int(len(raw)).bit_length()))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[: len(low)], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts])
    digits = np.concatenate(([0], np.cumsum(digit | point)))
    stops = np.concatenate(([0], np.cumsum(_END[raw] & ~point)))
    first = raw[starts]
    following = raw[np.minimum(starts + 1, len(raw) - 1)] if len(raw) else raw
    capital = (_UPPER[first] & ~_UPPER[following]) | (
        ((first == 0xC3) & (following >= 0x80) & (following <= 0x9E))
        | ((first == 0xD0) & (following >= 0x80) & (following <= 0xAF))
    )
    number = digits[ends] - digits[starts] == ends - starts
    begins = np.ones(len(starts), bool)
    begins[1:] = stops[starts[1:]] > stops[ends[:-1]]
    if len(begins):
        begins[0] = opening or stops[starts[0]] > 0
    return Tokens(hashes, number, digit[starts] & ~number, capital, begins)


def token_blocks(text: str | None, block: int = BLOCK) -> Iterator[Tokens]:
    """Tokens of a whole text, block after block. Blocks end at blanks. Null and empty texts give none."""
    if not text:
        return
    data = text.encode()
    lowered = text.lower().encode()
    if len(lowered) != len(data):
        lowered = data.lower()
    at, opening = 0, True
    while at < len(data):
        end = at + block
        if end < len(data):
            space = _SPACE.search(data, end)
            end = space.end() if space else len(data)
        found = tokens(data[at:end], lowered[at:end], opening)
        if len(found.hashes):
            yield found
        tail = data[at:end].rstrip(b" \t\x0b\x0c")
        opening = not len(tail) or bool(_END[tail[-1]])
        at = end
