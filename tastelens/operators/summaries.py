"""Grouped summaries behind the exploratory tables and charts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastelens import fixed_values as fv
from tastelens.functions.scalar import half_even, relabel, safe_div
from tastelens.operators.ranking import quantiles


def rows(name: str = "count") -> Column:
    return F.count(F.lit(1)).alias(name)


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """Rows per value; a missing value is not counted."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(rows(name))


def full_counts(df: DataFrame, column: str, classes: Sequence[str], zero: bool) -> DataFrame:
    """Counts for a fixed list of classes; an absent class gives 0 or missing."""
    spark = df.sparkSession
    fixed = spark.createDataFrame(
        [(i, c) for i, c in enumerate(classes)], f"position int, {column} string"
    )
    wanted = df.filter(F.col(column).isin(list(classes)))
    counted = fixed.join(value_counts(wanted, column), column, "left")
    return counted.withColumn("count", F.coalesce("count", F.lit(0))) if zero else counted


def reviews_per_restaurant(reviews: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Review count per restaurant with its name and price range."""
    key = "restaurant_entity_id"
    counts = reviews.filter(F.col(key).isNotNull()).groupBy(key).agg(rows("review_count"))
    info = restaurants.select(fv.PLACE_ID, "name", "price_range")
    return counts.join(info, counts[key] == info[fv.PLACE_ID], "left")


def mean_by(
    df: DataFrame, key: str, columns: Sequence[str], digits: int | None = None
) -> DataFrame:
    def mean(c: str) -> Column:
        return (F.avg(c) if digits is None else half_even(F.avg(c), digits)).alias(c)

    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*(mean(c) for c in columns))


def trip_type_summary(df: DataFrame) -> DataFrame:
    return df.groupBy(F.coalesce("trip_type", F.lit("Unknown")).alias("trip_type_clean")).agg(
        F.avg("rating").alias("avg_rating"), F.count("review_id").alias("review_count")
    )


def price_range_summary(
    df: DataFrame, order: Sequence[str] = fv.PRICE_ORDER
) -> DataFrame:
    """Rating and five-star rate per price range; a range outside the order becomes missing."""
    price = F.coalesce("price_range", F.lit("Unknown"))
    grouped = df.groupBy(price.alias("price_range_clean")).agg(
        F.avg("rating").alias("avg_rating"),
        F.count("review_id").alias("review_count"),
        F.avg("target_five_star").alias("five_star_rate"),
    )
    rank = F.nullif(
        F.array_position(F.lit(list(order)), F.col("price_range_clean")), F.lit(0)
    )
    return grouped.withColumn("price_rank", rank.cast("bigint")).withColumn(
        "price_range_clean", F.when(rank.isNotNull(), F.col("price_range_clean"))
    )


def recent_quality(df: DataFrame, years: Sequence[int] = fv.RECENT_YEARS) -> DataFrame:
    return df.filter(F.col("review_year").isin(*years)).groupBy("review_year").agg(
        F.count("review_id").alias("review_count"),
        F.avg("rating").alias("avg_rating"),
        F.avg("target_five_star").alias("five_star_rate"),
        F.avg(F.col("trip_type").isNull().cast("double")).alias("trip_type_missing_rate"),
    )


def sentiment_by_rating(df: DataFrame) -> DataFrame:
    means = {
        "avg_lexicon_score": "lexicon_sentiment_score",
        "avg_vader_compound": "vader_compound",
        "avg_positive_count": "lexicon_positive_count",
        "avg_negative_count": "lexicon_negative_count",
    }
    present = {name: c for name, c in means.items() if c in df.columns}
    return df.filter(F.col("rating").isNotNull()).groupBy("rating").agg(
        F.count("review_id").alias("review_count"),
        *(half_even(F.avg(c), 4).alias(name) for name, c in present.items()),
    )


def sentiment_overview(df: DataFrame) -> DataFrame:
    def share(label: str) -> Column:
        return F.avg((F.col("lexicon_sentiment_label") == label).cast("int"))

    return df.agg(
        rows("reviews"),
        half_even(F.avg("lexicon_sentiment_score"), 4).alias("mean_score"),
        half_even(share("positive"), 4).alias("positive_share"),
        half_even(share("negative"), 4).alias("negative_share"),
    )


def label_mix(
    df: DataFrame,
    by: str = "rating",
    label: str = "lexicon_sentiment_label",
    labels: Sequence[str] = ("negative", "neutral", "positive"),
) -> DataFrame:
    """Cross-table of label shares per group, in a fixed label order, absent ones 0."""
    counted = df.filter(F.col(by).isNotNull() & F.col(label).isNotNull())
    wide = counted.groupBy(by).pivot(label, list(labels)).agg(F.count(F.lit(1)))
    counts = {x: F.coalesce(F.col(x), F.lit(0)) for x in labels}
    total = sum(counts.values(), F.lit(0))
    return wide.select(by, *(safe_div(c, total).alias(x) for x, c in counts.items()))


def melt(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    name: str,
    value: str,
    labels: Mapping[str, str] | None = None,
    label: str | None = None,
) -> DataFrame:
    """Wide to long, optionally with a display label for the former column name."""
    long = df.unpivot(list(ids), list(values), name, value)
    return long.withColumn(label, relabel(F.col(name), labels)) if labels else long


def correlations(
    df: DataFrame, targets: Sequence[str], features: Sequence[str], digits: int = 4
) -> DataFrame:
    """Pearson correlation of every target with every feature, one row per target.

    One pass; a pair counts where both values are present; a constant column gives null. Columns
    that cannot be missing need no masking per pair and share their deviations.
    """
    may_miss = {f.name: f.nullable for f in df.schema.fields}

    def pearson(a: str, b: str) -> Column:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        if may_miss[a] or may_miss[b]:
            both = x.isNotNull() & y.isNotNull()
            x, y = F.when(both, x), F.when(both, y)
        spread = F.stddev_pop(x) * F.stddev_pop(y)
        ratio = F.try_divide(F.covar_pop(x, y), spread)
        return F.when(spread > 1e-14, half_even(ratio, digits))

    cells = df.agg(
        *(pearson(t, f).alias(f"{t}__{f}") for t in targets for f in features)
    )
    lines = [
        F.struct(F.lit(t).alias("target"), *(F.col(f"{t}__{f}").alias(f) for f in features))
        for t in targets
    ]
    return cells.select(F.inline(F.array(*lines)))


def box_plot(df: DataFrame, by: str, value: str) -> DataFrame:
    """Quartiles and whisker ends (furthest values within 1.5 IQR of the box) per group."""
    data = df.filter(F.col(by).isNotNull() & F.col(value).isNotNull())
    box = quantiles(data, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [by])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    fenced = box.withColumns({"_low": F.col("q1") - reach, "_high": F.col("q3") + reach})
    distinct = data.groupBy(by, value).agg(rows("_n"))
    inside = distinct.join(fenced, by).filter(F.col(value).between(F.col("_low"), F.col("_high")))
    return inside.groupBy(by).agg(
        *(F.max(c).alias(c) for c in ("n", "q1", "median", "q3")),
        F.min(value).alias("whisker_low"),
        F.max(value).alias("whisker_high"),
    )


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between the extremes; the maximum belongs to the last bin."""
    data = df.filter(F.col(value).isNotNull())
    ends = data.agg(
        F.struct(
            F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high")
        ).alias("ends")
    ).scalar()
    width = (ends.high - ends.low) / bins
    place = F.coalesce(F.floor(F.try_divide(F.col(value) - ends.low, width)), F.lit(0))
    binned = data.groupBy(F.least(place, F.lit(bins - 1)).cast("bigint").alias("bin")).agg(rows())
    spark = df.sparkSession
    every_bin = spark.range(bins).select(F.col("id").alias("bin"))
    return every_bin.join(binned, "bin", "left").select(
        "bin",
        half_even(ends.low + F.col("bin") * width, 6).alias("bin_start"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def zscore(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``<column>_z`` with the population deviation; a constant column gives 0.

    Missing and NaN values stay out of the moments; what is no finite number in the end is 0.
    """

    def present(c: str) -> Column:
        return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))

    moments = df.agg(
        F.struct(
            *(F.avg(present(c)).alias(f"{c}_mean") for c in columns),
            *(F.stddev_pop(present(c)).alias(f"{c}_dev") for c in columns),
        ).alias("m")
    ).scalar()
    return df.withColumns(
        {
            f"{c}_z": safe_div(F.col(c) - moments[f"{c}_mean"], moments[f"{c}_dev"])
            for c in columns
        }
    )
