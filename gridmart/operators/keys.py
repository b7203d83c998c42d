"""Joins on keys that may be null: a null batch key is a key like any other."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null equals null; the key columns are the left side's.

    The first key is a hash of all of them: where a sort has to bring the sides
    together, it compares one number, not texts that share their first letters.
    """
    kinds = {k: left.schema[k].dataType for k in keys}
    renamed = right.select(*[F.col(k).cast(kinds[k]).alias(f"_right_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    hashed = F.xxhash64(*[F.col(k) for k in keys]) == F.xxhash64(*[F.col(f"_right_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys], hashed)
    joined = left.join(renamed, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{k}" for k in keys])
