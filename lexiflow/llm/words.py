"""Cutting texts into independent words, and tables of what is known of a word."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

#: A blank before something that is no white space: no pre-token of the byte-level BPE
#: pattern reaches over it from the left.
BLANK = re.compile(r" (?=\S)")
#: The same, with no blank before it: no piece of a sentence model reaches over it either.
LONE_BLANK = re.compile(r"(?<! ) (?=\S)")


class WordTable(dict):
    """What is known of each word; forgotten as a whole when the words and values take
    more than ``max_bytes`` (as counted by the caller), so a worker's memory is bounded
    in bytes whatever the words look like."""

    def __init__(self, max_bytes: int):
        super().__init__()
        self.max_bytes, self.bytes = max_bytes, 0

    def make_room(self) -> bool:
        """Forget everything if over the bound; true if that was so."""
        if self.bytes <= self.max_bytes:
            return False
        self.clear()
        self.bytes = 0
        return True


def runs(column: pa.Array, max_bytes: int = 1 << 20) -> Iterator[pa.Array]:
    """An Arrow column of texts in runs of about ``max_bytes`` at most, a longer text alone:
    what a worker holds in Python objects does not grow with a batch."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and held + n > max_bytes:
            yield column.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield column.slice(start)


def short_runs(column: pa.Array, max_bytes: int = 1 << 20) -> Iterator[list[str]]:
    """The texts of ``runs`` (null: empty)."""
    for part in runs(column, max_bytes):
        yield [t or "" for t in part.to_pylist()]
