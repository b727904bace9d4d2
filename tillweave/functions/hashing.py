"""Keyed-hash randomness: a repeatable number or order for a key, equal in any engine with MD5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digest(seed: int, *keys: Column | str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys)).cast("binary"))


def uniform(seed: int, *keys: Column | str) -> Column:
    """A double in [0, 1) that depends on seed and keys only."""
    return F.conv(F.substring(_digest(seed, *keys), 1, 8), 16, 10).cast("double") / 4294967296.0


def shuffle_key(seed: int, *keys: Column | str) -> Column:
    """A string whose order is a random order of the keys."""
    return _digest(seed, *keys)
