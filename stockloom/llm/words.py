"""Words of whole texts in blocks of bounded size, for Arrow functions."""

from __future__ import annotations

import re
from collections.abc import Iterator

BLOCK = 1 << 20  #: bytes of text that are split at a time

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_blocks(text: str | None, block: int = BLOCK) -> Iterator[list[bytes]]:
    """Lists of the words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z lower-cased, in order.

    The lists together hold every word once; a word longer than a block stays whole.
    Null and empty texts give none.
    """
    data = (text or "").encode().lower()
    at = 0
    while at < len(data):
        end = at + block
        if end < len(data):
            space = _SPACE.search(data, end)
            end = space.start() if space else len(data)
        words = data[at:end].split()
        if words:
            yield words
        at = end
