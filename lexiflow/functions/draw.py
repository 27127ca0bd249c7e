"""Portable, partition-independent random draws.

A draw is a pure function of (seed, row key, tag, indexes): the md5 of those
parts joined by ``|``. Each md5 yields four unsigned 32-bit numbers (hex
digits 1-8, 9-16, 17-24, 25-32). The same value comes out of Spark, of DuckDB
and of Python's hashlib, so results do not depend on partitioning, task
retries or executor loss, and can be checked by SQL.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 1 << 32


def _as_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(str(x))


def draw_hash(seed: int, key, tag: str, *parts) -> Column:
    """md5 hex of ``seed|key|tag|parts...`` (all rendered as strings)."""
    cols = [F.lit(str(seed)), _as_col(key), F.lit(tag)] + [
        _as_col(p).cast("string") for p in parts
    ]
    return F.md5(F.concat_ws("|", *cols))


def word32(h: Column, k: int = 0) -> Column:
    """k-th unsigned 32-bit word (0..3) of an md5 hex digest, as bigint."""
    return F.conv(F.substring(h, 8 * k + 1, 8), 16, 10).cast("bigint")


def scaled(u: Column, n) -> Column:
    """Map a 32-bit draw to 0..n-1 by multiply-shift (exact integer math)."""
    return F.shiftright(u * (n if isinstance(n, Column) else F.lit(int(n))), 32)


def threshold(p: float) -> int:
    """Integer cut so that ``u < threshold(p)`` has probability p."""
    if not 0.0 <= p <= 1.0:
        raise ValueError("probability must be in [0, 1]")
    return int(p * TWO_32)


def py_word32(seed: int, key: str, tag: str, *parts, k: int = 0) -> int:
    """Driver-side twin of ``word32(draw_hash(...))`` for tiny fixed sets."""
    text = "|".join([str(seed), str(key), tag] + [str(p) for p in parts])
    return int(hashlib.md5(text.encode("utf-8")).hexdigest()[8 * k: 8 * k + 8], 16)
