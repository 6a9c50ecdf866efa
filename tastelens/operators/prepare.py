"""From raw reviews and restaurants to the descriptive and the modelling table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastelens import fixed_values as fv
from tastelens.functions import scalar as S
from tastelens.functions import text as X
from tastelens.operators.rows import compute_once

RESTAURANT_RENAMES = {
    fv.PLACE_ID: "restaurant_entity_id",
    "name": "restaurant_name_from_restaurants",
}
RESTAURANT_KEPT = (
    fv.PLACE_ID, "name", "price_range", "address", "latitude", "longitude",
    "has_reservation", "featured_image", "phone",
)


def with_clean_text(reviews: DataFrame) -> DataFrame:
    """Filled title and text, their cleaned forms, and both combined."""
    filled = reviews.na.fill("", ["title", "text"])
    unified = filled.withColumns(
        {"_title": X.nfkc(F.col("title")), "_text": X.nfkc(F.col("text"))}
    )
    tidied = compute_once(
        unified, {"title_clean": X.tidy(F.col("_title")), "text_clean": X.tidy(F.col("_text"))}
    ).drop("_title", "_text")
    combined = X.combine_title_text(F.col("title_clean"), F.col("text_clean"), stripped=True)
    return tidied.withColumn("combined_text", combined)


def with_text_quality(df: DataFrame, script: str = fv.CJK_CLASS) -> DataFrame:
    """Lengths, ASCII shares and quality flags of cleaned text."""
    flags = {
        "title_len": F.length("title_clean").cast("bigint"),
        "text_len": F.length("text_clean").cast("bigint"),
        "combined_len": F.length("combined_text").cast("bigint"),
        "title_has_chinese": X.has_script(F.col("title_clean"), script),
        "text_has_chinese": X.has_script(F.col("text_clean"), script),
        "title_ascii_ratio": X.ascii_ratio(F.col("title_clean")),
        "text_ascii_ratio": X.ascii_ratio(F.col("text_clean")),
        "combined_ascii_ratio": X.ascii_ratio(F.col("combined_text")),
        "has_replacement_char": F.contains(F.col("title"), F.lit("\ufffd"))
        | F.contains(F.col("text"), F.lit("\ufffd")),
    }
    return df.withColumns(flags).withColumns(
        {
            "has_chinese": F.col("title_has_chinese") | F.col("text_has_chinese"),
            "is_text_long_enough": F.col("text_len") >= fv.MIN_TEXT_LENGTH,
            "is_mostly_ascii": F.col("combined_ascii_ratio") >= fv.MIN_ASCII_RATIO,
        }
    )


def with_language_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_original_english": S.equals_or_false(F.col("original_language"), "en"),
            "is_language_en": S.equals_or_false(F.col("language"), "en"),
        }
    )


def with_labels(df: DataFrame) -> DataFrame:
    """Three-class and five-star labels of the rating."""
    rating = F.col("rating")
    label = S.rating_class(rating)
    target = S.five_star(rating)
    return df.withColumns(
        {
            "rating_3class": label,
            "rating_3class_code": S.class_code(label),
            "target_five_star": target,
            "target_five_star_label": F.when(target == 1, fv.BINARY_CLASSES[1]).otherwise(
                fv.BINARY_CLASSES[0]
            ),
        }
    )


def with_dates(df: DataFrame, fmt: str = "yyyy-MM-dd") -> DataFrame:
    columns = ("published_at_date", "created_at_date", "stay_date")
    text = [c for c in columns if dict(df.dtypes)[c] == "string"]
    parsed = df.withColumns({c: S.parse_date(F.col(c), fmt) for c in text}) if text else df
    return parsed.withColumns(
        {
            "review_year": S.year_of(F.col("published_at_date")),
            "review_month": S.month_of(F.col("published_at_date")),
            "stay_year": S.year_of(F.col("stay_date")),
            "stay_month": S.month_of(F.col("stay_date")),
        }
    )


def with_log_counts(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            f"{c}_log1p": S.log_count(F.col(c))
            for c in ("reviewer_contribution_count", "like_count")
        }
    )


def review_features(reviews: DataFrame, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """All derived review columns; every step is a projection, so nothing is shuffled."""
    df = with_text_quality(with_clean_text(reviews))
    return with_log_counts(with_dates(with_labels(with_language_flags(df)), date_format))


def restaurant_features(restaurants: DataFrame) -> DataFrame:
    return restaurants.select(
        *(F.col(c).alias(RESTAURANT_RENAMES.get(c, c)) for c in RESTAURANT_KEPT)
    )


def join_restaurants(reviews: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Reviews with their restaurant; missing ids meet missing ids, repeated ids fan out.

    No broadcast is forced: the planner broadcasts restaurants while their size is below its
    threshold and otherwise sorts and merges, splitting ids that hold too many reviews.
    """
    key = "restaurant_entity_id"
    right = restaurants.withColumnRenamed(key, "_restaurant_key")
    return reviews.join(right, F.col(key).eqNullSafe(F.col("_restaurant_key")), "left").drop(
        "_restaurant_key"
    )


def descriptive_table(review_df: DataFrame, restaurant_df: DataFrame) -> DataFrame:
    return join_restaurants(review_df, restaurant_df).withColumn(
        "keep_for_descriptive", F.lit(True)
    )


def fit_condition() -> Column:
    """English, without the excluded script, long enough, mostly ASCII."""
    return (
        F.col("is_original_english")
        & ~F.col("has_chinese")
        & F.col("is_text_long_enough")
        & F.col("is_mostly_ascii")
    )


def fit_for_modelling(df: DataFrame) -> DataFrame:
    """The language is also compared plainly, which a Parquet scan can skip row groups by."""
    return df.filter((F.col("original_language") == "en") & fit_condition())


def modelling_table(review_df: DataFrame, restaurant_df: DataFrame) -> DataFrame:
    """English, long enough, mostly ASCII reviews with the columns a model may see.

    The filter reads review columns only, so it runs before the join.
    """
    kept = join_restaurants(fit_for_modelling(review_df), restaurant_df)
    return kept.select(*fv.SAFE_COLUMNS)


def in_review_order(df: DataFrame) -> DataFrame:
    return df.orderBy(F.asc_nulls_last("published_at_date"), F.asc_nulls_last("review_id"))


def request_filter(
    reviews: DataFrame,
    lang: str | None = None,
    rating_is: int | None = None,
    since=None,
    traveler_type: str | None = None,
    keyword: str | None = None,
) -> DataFrame:
    """The optional conditions of a review request, as filters that reach the scan."""
    if lang is not None:
        reviews = reviews.filter(F.col("original_language") == lang)
    if rating_is is not None:
        reviews = reviews.filter(F.col("rating") == rating_is)
    if since is not None:
        reviews = reviews.filter(F.col("published_at_date") >= F.lit(since))
    if traveler_type is not None:
        reviews = reviews.filter(F.lower("trip_type") == traveler_type.lower())
    if keyword is not None:
        reviews = reviews.filter(F.contains(F.lower("text"), F.lit(keyword.lower())))
    return reviews


def rated_at_least(restaurants: DataFrame, min_rating: float) -> DataFrame:
    return restaurants.filter(F.col("rating") >= min_rating)


def sorted_reviews(reviews: DataFrame, by: str = "most_recent") -> DataFrame:
    """``most_recent`` by date, ``detailed_reviews`` by text length; ids break ties."""
    first = {
        "most_recent": F.desc_nulls_last("published_at_date"),
        "detailed_reviews": F.desc_nulls_last(F.length("text")),
    }[by]
    return reviews.orderBy(first, F.asc_nulls_last("review_id"))
