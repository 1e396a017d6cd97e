"""Seeded order and split: pure functions of the row key.

Each use of the seed has a tag of its own. With one hash for both, the
smallest hashes would form the sample and all of them fall in one split.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_hash(key: Column, seed: int, tag: str, *more: Column) -> Column:
    """md5 of `seed:tag[:more]:key`, 32 hex characters."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(tag), *more, key.cast("string")))


def in_fraction(hash_col: Column, fraction: float) -> Column:
    """True for about `fraction` of the hashes; compares the first 32 bits as hex text."""
    if fraction >= 1:
        return F.lit(True)
    return F.substring(hash_col, 1, 8) < F.lit(format(math.ceil(fraction * 2**32), "08x"))


def split_label(key: Column, test_size: float, seed: int) -> Column:
    """`validation` for about `test_size` of the keys, else `train`."""
    held_out = in_fraction(order_hash(key, seed, "split"), test_size)
    return F.when(held_out, "validation").otherwise("train")
