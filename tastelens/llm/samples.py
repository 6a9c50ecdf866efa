"""Bounded, reproducible training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def share(key: str, seed: int) -> Column:
    """A number in [0, 1) that depends on the key only; rows without a key get none."""
    spread = F.xxhash64(F.col(key), F.lit(seed)).bitwiseAND(F.lit((1 << 40) - 1))
    return F.when(F.col(key).isNotNull(), spread / float(1 << 40))


def thinned(df: DataFrame, key: str, group: str, sizes: dict, most: int, seed: int = 7) -> DataFrame:
    """Rows whose share lies under what keeps about ``most`` rows of each group; ``sizes`` are
    the rows per group."""
    rate = F.lit(0.0)
    for name, size in sizes.items():
        rate = F.when(F.col(group) == name, most / max(1, size)).otherwise(rate)
    return df.filter(share(key, seed) < rate)


def with_content(content: DataFrame, sample: DataFrame, key: str) -> DataFrame:
    """A bounded sample of keys with one content row each.

    The sample is sent to every task, so that the contents stay where they are; a key that holds
    many rows is cut to one before the shuffle.
    """
    return content.join(F.broadcast(sample), key).dropDuplicates([key])
