"""Row-wise columns that are evaluated once, and rows dealt out evenly."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add costly columns so that later filters and expressions read the finished value.

    A plain projection is copied into every filter pushed below it and into every expression
    above it. The one-row generator used here is not, while filters on other columns still pass
    through it to the scan.
    """
    record = F.struct(*(c.alias(name) for name, c in columns.items()))
    return df.select("*", F.inline(F.array(record)))


# Rows of a part that a learner holds: with 200 trees on rows about 1 KB each in its cache.
PART_ROWS = 100_000
# Boosted trees keep one binned row and a few numbers of it. Every level of every tree is a task a
# part, and a block of the cache is sized up anew as it grows, so small parts cost more than rows.
BOOSTED_ROWS = 1_000_000


def dealt(df: DataFrame, key: str, n: int, part_rows: int = PART_ROWS) -> DataFrame:
    """The rows in even parts, more of them the larger ``n``, about the number of rows, is.

    The planner joins parts by their bytes as shuffled, which says nothing of what a later step
    makes of a row. Parts of a given number are left as they are. All cores get equally many.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * max(1, math.ceil(n / (cores * part_rows))), key)
