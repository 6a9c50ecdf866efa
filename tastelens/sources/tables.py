"""The benchmark tables read as reviews and restaurants."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastelens import fixed_values as fv
from tastelens.functions.text import tokenize
from tastelens.operators import prepare, sentiment
from tastelens.functions import lexicon as L
from tastelens.functions.scalar import half_even
from tastelens.sources.lexicons import Lexicons

# Frequent words of the generated prose, so that every lexicon path has hits.
PROSE_LEXICONS = Lexicons(
    positive=("the", "best", "it", "is"),
    negative=("was", "by", "it", "from"),
    negations=("no", "of", "and"),
    intensifiers=("that", "are", "so", "very"),
    emotions={
        "joy": ("the", "with"), "anger": ("was", "with"), "sadness": ("from",), "fear": ("by",),
        "surprise": ("is",), "trust": ("for",), "positive": ("the", "best"),
        "negative": ("was",), "anticipation": ("to",), "disgust": ("not",),
    },
    valence={"the": 1.5, "best": 3.0, "is": 0.5, "was": -2.0, "from": -1.0, "by": -0.5},
)


class Tables:
    """Scans and review-shaped views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, df: DataFrame, key: str) -> DataFrame:
        """Rows of a table that is a single file over all cores.

        Such a file is one task, however costly its rows. Tables of many files have splits
        enough and are left where they are.
        """
        if len(df.inputFiles()) > 1:
            return df
        return df.repartition(self.spark.sparkContext.defaultParallelism, key)

    def documents(self) -> DataFrame:
        return self.spread(self.read("documents"), "doc_id")

    # --- orders and customers as reviews and restaurants ---

    def order_reviews(self) -> DataFrame:
        """Reviews without restaurant columns."""
        return self.read("orders").select(
            F.col("o_orderkey").alias("review_id"),
            F.col("o_custkey").alias("restaurant_entity_id"),
            F.left("o_orderpriority", F.lit(1)).cast("int").alias("rating"),
            F.col("o_orderdate").alias("published_at_date"),
            F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("trip_type"),
            F.floor(F.col("o_totalprice") / 1000).alias("like_count"),
        )

    def customer_places(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").alias(fv.PLACE_ID),
            F.col("c_name").alias("name"),
            F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE")).alias("price_range"),
            F.col("c_nationkey").cast("string").alias("address"),
            F.col("c_acctbal").alias("latitude"),
            F.col("c_nationkey").cast("double").alias("longitude"),
            (F.col("c_acctbal") > 0).alias("has_reservation"),
            F.lit(None).cast("string").alias("featured_image"),
            F.lit(None).cast("string").alias("phone"),
        )

    def reviews_meta(self) -> DataFrame:
        joined = prepare.join_restaurants(
            self.order_reviews(), prepare.restaurant_features(self.customer_places())
        )
        return prepare.with_labels(joined).withColumn(
            "review_year", F.year("published_at_date").cast("bigint")
        )

    def scored(self) -> DataFrame:
        """A 0/1 target with a coarse, tie-rich score."""
        reviews = self.order_reviews()
        return reviews.select(
            "review_id",
            (F.col("rating") == 5).cast("int").alias("y"),
            F.col("like_count").cast("double").alias("score"),
        )

    # --- documents and suppliers as reviews and restaurants ---

    def doc_reviews(self) -> DataFrame:
        title = F.substring_index("text", "\n", 1)
        day = F.date_add(F.lit("2021-01-01").cast("date"), (F.col("doc_id") % 1900).cast("int"))
        place = F.substr("source", F.lit(4)).cast("bigint")
        return self.documents().select(
            place.alias("restaurant_entity_id"),
            F.col("source").alias("restaurant_name"),
            F.col("doc_id").alias("review_id"),
            F.concat(F.lit("/ShowUserReviews-d"), place, F.lit("-r"), F.length("text")).alias(
                "review_link"
            ),
            F.nullif(title, F.col("text")).alias("title"),
            "text",
            (F.col("doc_id") % 5 + 1).cast("int").alias("rating"),
            F.col("lang").alias("language"),
            F.nullif(F.col("lang"), F.lit("de")).alias("original_language"),
            F.when(F.col("lang") == "es", "n/a").otherwise(F.col("n_chars").cast("string")).alias(
                "like_count"
            ),
            F.nullif(F.col("lang"), F.lit("fr")).alias("trip_type"),
            F.when(F.col("doc_id") % 7 == 0, "2024-02-30").otherwise(day.cast("string")).alias(
                "stay_date"
            ),
            F.when(F.col("doc_id") % 5 == 0, "bad").otherwise(day.cast("string")).alias(
                "created_at_date"
            ),
            day.cast("string").alias("published_at_date"),
            F.concat(F.lit("u"), F.col("doc_id") % 97).alias("reviewer_id"),
            (F.col("n_chars") % 100).cast("string").alias("reviewer_contribution_count"),
        )

    def supplier_places(self) -> DataFrame:
        return self.read("supplier").select(
            F.col("s_suppkey").alias(fv.PLACE_ID),
            F.col("s_name").alias("name"),
            F.when(F.col("s_suppkey") % 4 == 0, "$")
            .when(F.col("s_suppkey") % 4 == 1, "$$ - $$$")
            .when(F.col("s_suppkey") % 4 == 2, "$$$$")
            .alias("price_range"),
            F.col("s_name").alias("address"),
            F.nullif(F.col("s_acctbal"), F.lit(0.0)).alias("latitude"),
            F.col("s_nationkey").cast("double").alias("longitude"),
            (F.col("s_acctbal") > 0).alias("has_reservation"),
            F.lit(None).cast("string").alias("featured_image"),
            F.lit(None).cast("string").alias("phone"),
        )

    def places(self) -> DataFrame:
        return prepare.restaurant_features(self.supplier_places())

    def review_features(self) -> DataFrame:
        return prepare.review_features(self.doc_reviews())

    @cached_property
    def lexicons(self) -> Lexicons:
        return PROSE_LEXICONS

    def sentiments(self) -> DataFrame:
        """One row per document: rating, target, counts, lexicon and emotion features, and the
        compound of the plain valence sum as ``vader_compound``."""
        docs = self.documents().select(
            F.col("doc_id").alias("review_id"), "text", (F.col("doc_id") % 5 + 1).alias("rating")
        )
        base = docs.withColumn("target_five_star", (F.col("rating") == 5).cast("int"))
        total = L.valence_sum(tokenize(F.col("text")), self.lexicons.valence)
        scored = sentiment.with_text_features(base, self.lexicons, "text", valence=False)
        return scored.withColumn("valence_sum", total).withColumn(
            "vader_compound", half_even(L.compound(F.col("valence_sum")), 4)
        ).drop("text")
