"""Exact ranks and running totals without putting a whole table or a hot group into one task.

Rows are first spread over ordered slots. Each slot is ranked on its own, and what lies in the
slots before it is added from a small table of slot totals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _group_key(groups: Sequence[str]) -> Column:
    """One never-missing text key for the group columns.

    Window, aggregate and join then share one hash partitioning by (key, slot): the rows are
    shuffled once and only the small table of slot totals moves to meet them.
    """
    parts = [F.coalesce(F.col(g).cast("string"), F.lit("\u0000")) for g in groups]
    return F.concat_ws("\u0001", *parts) if parts else F.lit("")


def hashed_row_number(
    df: DataFrame,
    strata: Sequence[str],
    key: str,
    seed: int | str,
    out: str = "_row",
    digits: int = 3,
) -> DataFrame:
    """Row number per stratum in the order of md5(seed:key), plus the stratum size.

    The first hex digits of the digest are the slot: 16**digits even parts per stratum, however
    large a stratum is. The slot table has strata x 16**digits rows at most.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    keyed = df.withColumns({"_digest": digest, "_group": _group_key(strata)}).withColumn(
        "_slot", F.left("_digest", F.lit(digits))
    )
    whole = Window.partitionBy("_group")
    before = whole.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    sizes = keyed.groupBy("_group", "_slot").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_group",
        "_slot",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias(f"{out}_of"),
    )
    within = Window.partitionBy("_group", "_slot").orderBy("_digest", key)
    ranked = keyed.withColumn("_within", F.row_number().over(within))
    joined = ranked.join(offsets, ["_group", "_slot"])
    return joined.withColumn(out, F.col("_before") + F.col("_within")).drop(
        "_digest", "_slot", "_within", "_before", "_group"
    )


def running_totals(
    df: DataFrame,
    value: str,
    measures: Mapping[str, str],
    groups: Sequence[str] = (),
    descending: bool = False,
    slots: int | None = None,
) -> DataFrame:
    """Running sums in the order of ``value``, one input row per (group, value).

    ``measures`` maps an input column to its output: the sum up to and including the row. Each
    output comes with ``<output>_all``, the sum over the group. Slots are cut at quantiles of the
    distinct values, so they stay even whatever the distribution; by default there are as many
    as shuffle partitions, 16 at least.
    """
    if slots is None:
        slots = max(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = [i / slots for i in range(1, slots)]
    bounds = df.agg(F.percentile_approx(value, F.lit(cuts), F.lit(10_000)).alias("b")).scalar()
    slot = F.size(F.filter("_bounds", lambda b: b < F.col(value)))
    spread = (
        df.withColumns({"_bounds": bounds, "_group": _group_key(groups)})
        .withColumn("_slot", F.coalesce(slot, F.lit(0)))
        .drop("_bounds")
    )

    def order(column: str) -> Column:
        return F.desc(column) if descending else F.asc(column)

    totals = spread.groupBy("_group", "_slot").agg(
        *(F.sum(m).alias(f"_t_{o}") for m, o in measures.items())
    )
    whole = Window.partitionBy("_group")
    before = whole.orderBy(order("_slot")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_group",
        "_slot",
        *(
            F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0)).alias(f"_b_{o}")
            for o in measures.values()
        ),
        *(F.sum(f"_t_{o}").over(whole).alias(f"{o}_all") for o in measures.values()),
    )
    within = Window.partitionBy("_group", "_slot").orderBy(order(value)).rowsBetween(
        Window.unboundedPreceding, 0
    )
    local = spread.withColumns({o: F.sum(m).over(within) for m, o in measures.items()})
    joined = local.join(offsets, ["_group", "_slot"])
    return joined.withColumns(
        {o: F.col(o) + F.col(f"_b_{o}") for o in measures.values()}
    ).drop("_slot", "_group", *(f"_b_{o}" for o in measures.values()))


def quantiles(
    df: DataFrame,
    value: str,
    probabilities: Mapping[str, float],
    groups: Sequence[str] = (),
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group.

    Works on counts per distinct value and reads the two neighbours of each position from their
    running totals, so no group is ever held in one aggregation buffer.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(
        F.count(F.lit(1)).alias("_n")
    )
    placed = running_totals(counts, value, {"_n": "_upto"}, groups)
    first = F.col("_upto") - F.col("_n")

    def pick(position: Column) -> Column:
        here = (first <= position) & (position < F.col("_upto"))
        return F.max(F.when(here, F.col(value).cast("double")))

    picks, result = [], []
    for name, p in probabilities.items():
        position = (F.col("_upto_all") - 1) * F.lit(float(p))
        picks += [
            pick(F.floor(position)).alias(f"_{name}_lo"),
            pick(F.ceil(position)).alias(f"_{name}_hi"),
            F.max(position - F.floor(position)).alias(f"_{name}_part"),
        ]
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        result.append((low + (high - low) * F.col(f"_{name}_part")).alias(name))
    size = F.max("_upto_all").alias("_size")
    return placed.groupBy(*groups).agg(size, *picks).select(
        *groups, F.col("_size").cast("bigint").alias("n"), *result
    )
