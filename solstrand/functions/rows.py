"""Fingerprints of whole rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_fingerprint(columns: Iterable[str]) -> Column:
    """128-bit fingerprint of the named columns as a struct of two BIGINTs.

    `xxhash64` skips NULLs, so `(NULL, 'a')` and `('a', NULL)` would collide; the NULL flags are
    hashed along.  Two differently seeded 64-bit halves keep accidental equality out of reach even
    over 10^12 rows.  Map columns cannot be hashed: turn them into sorted entries first.
    """
    parts: list[Column] = []
    for name in columns:
        parts += [F.col(f"`{name}`"), F.col(f"`{name}`").isNull()]
    return F.struct(
        F.xxhash64(F.lit("a"), *parts).alias("high"), F.xxhash64(F.lit("b"), *parts).alias("low")
    )
