"""Repeatable pseudo-random choices derived from a row key.

A choice depends on key, seed and slot only, so a retried task, another
partitioning or another engine draws the same value.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def digest(key: Column, seed: int | str, salt: int | str = "") -> Column:
    """32 hex digits for the key."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}|{salt}")).cast("binary"))


def slot(digest_hex: Column, index: int) -> Column:
    """One of the four 32-bit integers in a digest, as BIGINT."""
    return F.conv(F.substr(digest_hex, F.lit(8 * index + 1), F.lit(8)), 16, 10).cast("bigint")


def order_key(key: Column, seed: int | str) -> Column:
    """Text that sorts a unique key into a seeded random order."""
    return F.concat(digest(key, seed), F.lit(":"), key.cast("string"))
