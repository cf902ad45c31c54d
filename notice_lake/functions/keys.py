"""Surrogate keys over natural-key columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _length_prefixed(value: Column) -> Column:
    """``<length>:<text>`` or ``n`` for NULL, so no two column lists encode alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("n"))


def surrogate_key(*columns: str | Column, algo: str = "hash") -> Column:
    """Deterministic key of ``columns``.

    ``hash`` is the table contract (32-bit Murmur3) and ``xxhash64`` its 64-bit
    sibling; both skip NULLs, so (NULL, 'a') and ('a', NULL) share a key.
    ``sha256`` is collision-resistant and tells NULL positions apart.
    """
    cols = [_column(c) for c in columns]
    if algo == "hash":
        return F.hash(*cols)
    if algo == "xxhash64":
        return F.xxhash64(*cols)
    if algo == "sha256":
        return F.sha2(F.concat(*[_length_prefixed(c) for c in cols]), 256)
    raise ValueError(f"unknown key algorithm {algo!r}")
