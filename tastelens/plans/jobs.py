"""The batch steps from landed pages to model results. Each reads and writes whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastelens import fixed_values as fv
from tastelens import schemas
from tastelens.functions.scalar import half_even
from tastelens.operators import audit, dedup, experiments, importance, prepare, sentiment
from tastelens.operators import metrics as M
from tastelens.operators import summaries as E
from tastelens.sources import files
from tastelens.sources.lexicons import Lexicons, LexiconTables


def _store(df: DataFrame, path: str, csv: bool = False) -> DataFrame:
    """Write a table and go on from the written files."""
    df.write.mode("overwrite").parquet(path)
    stored = df.sparkSession.read.parquet(path)
    if csv:
        files.write_csv(stored, path + "_csv", byte_order_mark=True)
    return stored


def sections(parts: Mapping[str, tuple[DataFrame, Sequence]]) -> DataFrame:
    """Report tables one after the other as (section_no, line_no, line)."""
    result = None
    for number, (title, (table, order)) in enumerate(parts.items()):
        spark = table.sparkSession
        head = spark.createDataFrame([(0, f"## {title}")], "line_no bigint, line string")
        lines = head.unionByName(files.markdown_table(table, order)).withColumn(
            "section_no", F.lit(number)
        )
        result = lines if result is None else result.unionByName(lines)
    return result


# --- landing ----------------------------------------------------------------------------------------


def ingest(
    spark: SparkSession, restaurant_pages: str, review_pages: str, out: str, csv: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Landed result pages to flat tables, each restaurant and review kept once.

    Pages are JSON lines; a review page also names its restaurant. Arrival is the order of the
    file names, then of the pages in a file, then of the entries of a page.
    """
    def first(df: DataFrame, identifier: str, link: str) -> DataFrame:
        key = dedup.id_or_link(F.col(identifier), F.col(link))
        return dedup.keep_first(df, key, [F.asc(c) for c in files.ORIGIN]).drop(*files.ORIGIN)

    places = files.read_result_pages(spark, restaurant_pages, schemas.RESTAURANT_ITEM)
    restaurants = first(files.flatten_restaurants(places), fv.PLACE_ID, "link")
    carry = {
        "restaurant_entity_id": schemas.LONG, "restaurant_name": schemas.TEXT,
        "restaurant_link": schemas.TEXT,
    }
    entries = files.read_result_pages(spark, review_pages, schemas.REVIEW_ITEM, carry)
    reviews = first(files.flatten_reviews(entries), "review_id", "review_link")
    return _store(restaurants, f"{out}/restaurants", csv), _store(reviews, f"{out}/reviews", csv)


# --- cleaning and audit ---------------------------------------------------------------------------


def prepare_tables(
    reviews: DataFrame, restaurants: DataFrame, out: str, csv: bool = False,
    date_format: str = "yyyy-MM-dd",
) -> tuple[DataFrame, DataFrame]:
    """Descriptive table, modelling table and audit. Text is cleaned once and stored; the
    modelling table and the audit read the stored columns."""
    places = prepare.restaurant_features(restaurants)
    featured = _store(
        prepare.review_features(reviews, date_format), f"{out}/review_features"
    )
    descriptive = _store(
        prepare.descriptive_table(featured, places), f"{out}/reviews_descriptive", csv
    )
    modelling = _store(
        prepare.in_review_order(prepare.modelling_table(featured, places)),
        f"{out}/reviews_modeling", csv,
    )
    summary = audit.audit_summary(reviews, places, featured)
    files.write_markdown(
        sections({"Data Audit Summary": (summary, [F.col("section"), F.col("metric")])}),
        f"{out}/data_audit_summary",
    )
    return descriptive, modelling


# --- exploration -------------------------------------------------------------------------------------


def exploration(
    descriptive: DataFrame, modelling: DataFrame, restaurants: DataFrame
) -> dict[str, DataFrame]:
    """Every table behind the exploratory report and its charts."""
    years = descriptive.withColumn("year", F.year("published_at_date").cast("bigint"))
    per_place = E.reviews_per_restaurant(descriptive, restaurants)
    trips = modelling.select(F.coalesce("trip_type", F.lit("Unknown")).alias("trip_type"))
    return {
        "rating_counts": E.value_counts(descriptive, "rating").orderBy("rating"),
        "binary_counts": E.value_counts(modelling, "target_five_star_label"),
        "reviews_per_restaurant": per_place,
        "reviews_per_restaurant_histogram": E.histogram(per_place, "review_count", 20),
        "year_counts": E.value_counts(years, "year").orderBy("year"),
        "avg_rating_by_year": E.mean_by(years, "year", ["rating"]),
        "trip_type_counts": E.value_counts(trips, "trip_type"),
        "trip_type_summary": E.trip_type_summary(modelling),
        "price_range_summary": E.price_range_summary(modelling),
        "text_length_by_rating": E.box_plot(modelling, "rating", "text_len"),
        "recent_quality": E.recent_quality(modelling),
    }


def write_exploration(tables: Mapping[str, DataFrame], out: str) -> None:
    def rounded(name: str, digits: int) -> DataFrame:
        table = tables[name]
        real = [c for c, kind in table.dtypes if kind == "double"]
        return table.withColumns({c: half_even(F.col(c), digits) for c in real})

    report = {
        "Review Counts per Rating": (tables["rating_counts"], [F.col("rating")]),
        "Review Count by Year": (tables["year_counts"], [F.col("year")]),
        "Trip Type Summary": (rounded("trip_type_summary", 3), [F.desc("avg_rating")]),
        "Price Range Summary": (
            rounded("price_range_summary", 3), [F.asc_nulls_last("price_rank")]
        ),
        "Recent-Year Quality Checks": (rounded("recent_quality", 4), [F.col("review_year")]),
    }
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{out}/{name}")
    files.write_markdown(sections(report), f"{out}/eda_summary")


# --- text features -------------------------------------------------------------------------------------


def text_feature_table(
    modelling: DataFrame, lexicons: Lexicons | LexiconTables, out: str, csv: bool = False
) -> DataFrame:
    """Modelling rows with text features, stored once, then with the two z-scores."""
    enriched = _store(
        sentiment.with_text_features(modelling, lexicons), f"{out}/text_features"
    )
    scored = E.zscore(enriched, ["lexicon_sentiment_score", "vader_compound"])
    return _store(scored, f"{out}/reviews_modeling_features", csv)


def sentiment_tables(features: DataFrame) -> dict[str, DataFrame]:
    """Every table behind the sentiment report and its charts."""
    ratios = list(fv.EMOTION_LABELS)
    scores = list(fv.METRIC_LABELS)
    by_rating = E.mean_by(features, "rating", ratios)
    by_label = E.mean_by(features, "target_five_star_label", ratios)
    return {
        "overview": E.sentiment_overview(features),
        "sentiment_by_rating": E.sentiment_by_rating(features),
        "emotion_by_rating": E.mean_by(features, "rating", ratios, digits=4),
        "label_mix": E.label_mix(features),
        "dominant_emotions": E.value_counts(features, "dominant_emotion"),
        "correlations": E.correlations(
            features, fv.CORRELATION_TARGETS, fv.CORRELATION_FEATURES
        ),
        "score_by_rating_long": E.melt(
            E.mean_by(features, "rating", scores), ["rating"], scores, "metric", "score",
            fv.METRIC_LABELS, "metric_label",
        ),
        "score_spread_by_rating": E.box_plot(features, "rating", "lexicon_sentiment_score"),
        "emotion_by_rating_long": E.melt(
            by_rating, ["rating"], ratios, "emotion", "ratio", fv.EMOTION_LABELS, "emotion_label"
        ),
        "emotion_by_label_long": E.melt(
            by_label, ["target_five_star_label"], ratios, "emotion", "ratio", fv.EMOTION_LABELS,
            "emotion_label",
        ),
    }


def write_sentiment(tables: Mapping[str, DataFrame], out: str) -> None:
    order = {
        "sentiment_by_rating": [F.col("rating")],
        "emotion_by_rating": [F.col("rating")],
        "label_mix": [F.col("rating")],
        "dominant_emotions": [F.desc("count"), F.col("dominant_emotion")],
        "correlations": [F.col("target")],
    }
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{out}/{name}")
    files.write_markdown(
        sections({name: (tables[name], keys) for name, keys in order.items()}),
        f"{out}/sentiment_emotion_summary",
    )


# --- models ----------------------------------------------------------------------------------------------


def train(
    features: DataFrame,
    out: str,
    specs: Sequence[experiments.Experiment] | None = None,
    **settings,
) -> dict:
    """Run the experiments and write leaderboard, reports, searches and the best model's curves,
    confusion matrix and permutation importance."""
    result = experiments.run_experiments(features, experiments=specs, **settings)
    board = _store(result["leaderboard"], f"{out}/model_results", csv=True)
    best = board.orderBy(F.desc("f1_macro"), F.desc("accuracy"), F.asc("experiment")).first()
    name = best["experiment"]
    for experiment, report in result["reports"].items():
        files.write_json(report, f"{out}/reports/experiment={experiment}")
    files.write_json(result["searches"], f"{out}/searches")
    files.write_markdown(
        sections({"Experiments": (board, [F.desc("f1_macro"), F.desc("accuracy")])}),
        f"{out}/model_summary",
    )
    mine = result["predictions"].filter(F.col("experiment") == name)
    tables = {
        "confusion_matrix": M.confusion_matrix(mine, "actual", "prediction"),
        "roc_curve": M.roc_curve(mine, "actual", "score"),
        "pr_curve": M.pr_curve(mine, "actual", "score"),
    }
    spec = next(s for s in (specs or experiments.all_experiments()) if s.name == name)
    columns = [*spec.numeric, *spec.categorical, *([spec.text] if spec.text else [])]
    key = settings.get("key", "review_id")
    label = settings.get("label", "target_five_star")
    tables["permutation_importance"] = importance.most_important(
        importance.permutation_importance(
            result["models"][name], result["test"], key, label, columns
        )
    )
    for table, df in tables.items():
        df.write.mode("overwrite").parquet(f"{out}/best_model/{table}")
    return result
