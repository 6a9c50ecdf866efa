"""Permutation importance without moving a column through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastelens import fixed_values as fv
from tastelens.functions.scalar import half_even
from tastelens.operators.metrics import per_class
from tastelens.operators.ranking import hashed_row_number
from tastelens.operators.rows import dealt


def with_shuffled(df: DataFrame, key: str, columns: Sequence[str], seed: str) -> DataFrame:
    """``df`` with ``_new_<column>`` dealt out anew: the row ranked n by one hash takes the values
    of the row ranked n by another."""
    takers = hashed_row_number(df, [], key, f"{seed}-to", "_n").drop("_n_of")
    givers = hashed_row_number(df.select(key, *columns), [], key, f"{seed}-from", "_n").select(
        "_n", *(F.col(c).alias(f"_new_{c}") for c in columns)
    )
    return takers.join(givers, "_n").drop("_n")


def permutation_importance(
    model: Model,
    df: DataFrame,
    key: str,
    label: str,
    columns: Sequence[str],
    repeats: int = fv.IMPORTANCE_REPEATS,
    seed: int = fv.SEED,
) -> DataFrame:
    """(feature, importance_mean, importance_std): drop in macro F1 when a column is shuffled.

    One reordering per repeat serves all columns, each of which is shuffled in a copy of its own;
    all copies are scored by one pass of the model, in parts that do not grow with the table.
    """
    n = df.count()

    def copies(turn: int) -> DataFrame:
        # each row is scored once for every column
        shuffled = dealt(with_shuffled(df, key, columns, f"{seed}-{turn}"), key, n * len(columns))
        mixed = shuffled.withColumn("_feature", F.explode(F.lit(list(columns))))
        replaced = {
            c: F.when(F.col("_feature") == c, F.col(f"_new_{c}")).otherwise(F.col(c))
            for c in columns
        }
        return mixed.withColumns({**replaced, "_turn": F.lit(turn)}).select(
            *df.columns, "_feature", "_turn"
        )

    everything = df.withColumns({"_feature": F.lit(""), "_turn": F.lit(0)})
    for turn in range(repeats):
        everything = everything.unionByName(copies(turn))
    scored = model.transform(everything).withColumn("_actual", F.col(label).cast("double"))
    f1 = per_class(scored, "_actual", "prediction", ["_feature", "_turn"]).groupBy(
        "_feature", "_turn"
    ).agg(F.avg("f1").alias("f1"))
    # a row per (column, repeat), and the unshuffled row on every one of them
    base = F.max(F.when(F.col("_feature") == "", F.col("f1"))).over(Window.partitionBy())
    drop = f1.withColumn("drop", base - F.col("f1")).filter(F.col("_feature") != "")
    return drop.groupBy(F.col("_feature").alias("feature")).agg(
        half_even(F.avg("drop"), 6).alias("importance_mean"),
        half_even(F.stddev_pop("drop"), 6).alias("importance_std"),
    )


def most_important(importance: DataFrame, n: int = fv.TOP_IMPORTANCE) -> DataFrame:
    """The n largest, then in ascending order for a horizontal chart."""
    top = importance.orderBy(F.desc("importance_mean"), F.asc("feature")).limit(n)
    return top.orderBy(F.asc("importance_mean"), F.desc("feature"))
