"""Data audit: counts, duplicates, missing values, distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastelens import fixed_values as fv
from tastelens.operators.prepare import fit_condition, join_restaurants


def overview(reviews: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Restaurants, reviews and distinct reviewers in one row."""
    places = restaurants.agg(F.count(F.lit(1)).alias("n")).scalar()
    return reviews.agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count_distinct("reviewer_id").alias("unique_reviewers"),
    ).select(places.alias("restaurants"), "reviews", "unique_reviewers")


def cap_hits(
    reviews: DataFrame, key: str = "restaurant_entity_id", cap: int = fv.REVIEW_CAP
) -> DataFrame:
    """Groups holding exactly ``cap`` rows, and all groups."""
    sizes = reviews.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("n")
    )
    return sizes.agg(
        F.count_if(F.col("n") == cap).alias("at_cap"), F.count(F.lit(1)).alias("groups")
    )


# Registers of a sketch, as a power of two, and the standard error of a count that follows.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def distinct_sketches(
    df: DataFrame, columns: Sequence[str], groups: Sequence[str] = (), bits: int = SKETCH_BITS
) -> DataFrame:
    """(groups, name, sketch, filled): a HyperLogLog sketch of every column per group.

    One scan and one shuffle of sketches of fixed size, however many values there are. Sketches of
    days, files or groups can be stored and merged later by :func:`distinct_counts` without reading
    the rows again. Missing values are left out; ``filled`` counts the others.
    """
    value = {c: F.col(c).cast("string") for c in columns}
    made = df.groupBy(*groups).agg(
        *(F.hll_sketch_agg(v, F.lit(bits)).alias(f"_s{i}") for i, v in enumerate(value.values())),
        *(F.count(v).alias(f"_n{i}") for i, v in enumerate(value.values())),
    )
    each = F.array(
        *(
            F.struct(F.lit(c).alias("name"), F.col(f"_s{i}").alias("sketch"), F.col(f"_n{i}").alias("filled"))
            for i, c in enumerate(columns)
        )
    )
    return made.select(*groups, F.inline(each))


def distinct_counts(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, name, distinct_about, filled): merged sketches, read off. Two of three counts lie
    within SKETCH_ERROR of the exact one, nearly all within three times that."""
    merged = sketches.groupBy(*by, "name").agg(
        F.hll_union_agg("sketch").alias("sketch"), F.sum("filled").alias("filled")
    )
    return merged.select(*by, "name", F.hll_sketch_estimate("sketch").alias("distinct_about"), "filled")


# What is counted per distinct value, with the columns that make the value.
REPEATS = {
    "duplicate_review_id": ["review_id"],
    "duplicate_review_link": ["review_link"],
    "duplicate_title_text": ["title", "text"],
}


def counts_by_value(
    reviews: DataFrame, kinds: Mapping[str, Sequence[str] | Column]
) -> DataFrame:
    """(kind, value, n): rows per distinct value of columns or an expression, from one scan.

    Missing equals missing. Values of more than one column are compared by 256-bit digests; the
    counts combine before the shuffle, so a value held by many rows does no harm.
    """

    def value(columns: Sequence[str] | Column) -> Column:
        if isinstance(columns, Column):
            return columns.cast("string")
        if len(columns) == 1:
            return F.col(columns[0]).cast("string")
        parts = (F.coalesce(F.sha2(F.col(c), 256), F.lit("-")) for c in columns)
        return F.concat_ws(" ", *parts)

    each = [
        F.struct(F.lit(kind).alias("kind"), value(columns).alias("value"))
        for kind, columns in kinds.items()
    ]
    return reviews.select(F.inline(F.array(*each))).groupBy("kind", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


def _repeats() -> list[Column]:
    """Rows beyond the first of each distinct value."""
    return [
        F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n") - 1)), F.lit(0)).alias(kind)
        for kind in REPEATS
    ]


def duplicates(reviews: DataFrame) -> DataFrame:
    """Duplicate ids, links and (title, text) pairs in one row."""
    return counts_by_value(reviews, REPEATS).agg(*_repeats())


def missing(reviews: DataFrame, columns: Sequence[str]) -> DataFrame:
    return reviews.agg(
        *(F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns)
    )


def text_quality(featured: DataFrame) -> DataFrame:
    return featured.agg(
        F.count_if(F.col("combined_ascii_ratio") < 1).alias("non_ascii"),
        F.count_if("has_chinese").alias("with_chinese"),
        F.count_if("is_original_english").alias("original_english"),
        F.count_if(fit_condition()).alias("kept_for_modeling"),
    )


def _as_metrics(section: str, row: DataFrame) -> DataFrame:
    """One-row table to (section, metric, value)."""
    counts = row.select(*(F.col(c).cast("bigint").alias(c) for c in row.columns))
    return counts.unpivot([], list(row.columns), "metric", "value").select(
        F.lit(section).alias("section"), "metric", "value"
    )


def _text_facts(featured: DataFrame, copies: DataFrame) -> DataFrame:
    """Everything that needs cleaned text, as (section, metric, value) from one pass over it.

    The pass counts per (rating, classes), a handful of rows, which are then read as the raw and
    the modelling distributions. A review counts for modelling once per matching restaurant row
    (``copies``), as the joined modelling table would hold it.
    """
    rows = join_restaurants(featured, copies)
    labels = ["rating", "rating_3class", "target_five_star_label"]
    kept = F.sum(F.when(fit_condition(), F.coalesce("_copies", F.lit(1))).otherwise(0))
    text = {
        "non_ascii": F.count_if(F.col("combined_ascii_ratio") < 1),
        "with_chinese": F.count_if("has_chinese"),
        "original_english": F.count_if("is_original_english"),
        "kept_for_modeling": kept,
    }
    cells = rows.groupBy(*labels).agg(
        F.count(F.lit(1)).alias("n"), *(c.alias(name) for name, c in text.items())
    )

    def fact(section: str, metric: Column, value: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"), metric.cast("string").alias("metric"),
            value.cast("bigint").alias("value"),
        )

    facts = [fact("text", F.lit(name), F.col(name)) for name in text]
    for name, count in (("raw", "n"), ("modeling", "kept_for_modeling")):
        present = F.when(F.col(count) > 0, F.col(count))
        whole = F.when(
            F.col("rating") == F.floor("rating"), F.floor("rating").cast("string")
        ).otherwise(F.col("rating").cast("string"))
        facts += [
            fact(f"{name}_rating", whole, present),
            fact(f"{name}_3class", F.col("rating_3class"), F.col(count)),
            fact(f"{name}_binary", F.col("target_five_star_label"), present),
        ]
    counted = cells.select(F.inline(F.array(*facts))).filter(F.col("metric").isNotNull())
    # classes that never occur: 0 for the ordered classes, missing for the two labels
    fixed = [
        (f"{name}_{kind}", c, zero)
        for name in ("raw", "modeling")
        for kind, classes, zero in (
            ("3class", fv.RATING_CLASSES, 0), ("binary", fv.BINARY_CLASSES, None)
        )
        for c in classes
    ]
    fixed += [("text", name, 0) for name in text]
    seeds = featured.sparkSession.createDataFrame(
        fixed, "section string, metric string, value bigint"
    )
    sums = counted.unionByName(seeds).groupBy("section", "metric").agg(
        F.sum("value").alias("value")
    )
    return sums.filter(~F.endswith("section", F.lit("_rating")) | F.col("value").isNotNull())


def audit_summary(
    reviews: DataFrame, restaurants: DataFrame, featured: DataFrame, cap: int = fv.REVIEW_CAP
) -> DataFrame:
    """The whole audit as one long table (section, metric, value).

    The reviews are read twice: once for everything counted per distinct value, once for
    everything counted on cleaned text.
    """
    copies = restaurants.groupBy("restaurant_entity_id").agg(F.count(F.lit(1)).alias("_copies"))
    gaps = {f"missing_{c}": F.col(c).isNull() for c in ("trip_type", "title", "stay_date")}
    kinds = {**REPEATS, **gaps, "reviewer": ["reviewer_id"], "place": ["restaurant_entity_id"]}
    known = F.col("value").isNotNull()
    reviewer, place = F.col("kind") == "reviewer", F.col("kind") == "place"
    whole = counts_by_value(reviews, kinds).agg(
        F.coalesce(F.sum(F.when(place, F.col("n"))), F.lit(0)).alias("reviews"),
        F.count_if(reviewer & known).alias("unique_reviewers"),
        F.count_if(place & known & (F.col("n") == cap)).alias("at_cap"),
        F.count_if(place & known).alias("groups"),
        *_repeats(),
        *(
            F.coalesce(
                F.sum(F.when((F.col("kind") == c) & (F.col("value") == "true"), F.col("n"))),
                F.lit(0),
            ).alias(c)
            for c in gaps
        ),
    )
    places = copies.agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("restaurants"))
    overall = ["reviews", "unique_reviewers", "at_cap", "groups"]
    sections = F.when(F.col("metric").isin(overall), "overview").otherwise("quality")
    result = _text_facts(featured, copies)
    return result.unionByName(_as_metrics("overview", places)).unionByName(
        _as_metrics("", whole).withColumn("section", sections)
    )
