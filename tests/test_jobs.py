"""Whole steps from landed pages to model results, on small inputs."""

import json

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tastelens import fixed_values as fv
from tastelens import schemas
from tastelens.operators import experiments, features, importance, learning, split
from tastelens.plans import jobs
from tastelens.session import cut
from tastelens.sources.tables import PROSE_LEXICONS, Tables
from tastelens.streaming import reviews as streaming


@pytest.fixture(scope="module")
def prepared(spark, folder, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("job"))
    t = Tables(spark, folder)
    descriptive, modelling = jobs.prepare_tables(
        t.doc_reviews(), t.supplier_places(), out, csv=True
    )
    table = jobs.text_feature_table(modelling, PROSE_LEXICONS, out)
    return t, out, descriptive, modelling, table


def test_ingest_keeps_first_arrivals(spark, tmp_path):
    places = [{"results": [{fv.PLACE_ID: 1, "name": "first"},
                           {fv.PLACE_ID: 2, "name": "b"}]},
              {"results": [{fv.PLACE_ID: 1, "name": "again"}, {"name": "no key"}]}]
    (tmp_path / "places.json").write_text("\n".join(map(json.dumps, places)))
    entry = {"review_id": 5, "text": "one", "trip": {"trip_type": "SOLO"},
             "reviewer": {"reviewer_id": "u", "hometown": {"location_name_detailed": "x"}}}
    for number, text in enumerate(("one", "two")):
        page = {"restaurant_entity_id": number, "restaurant_name": "r", "restaurant_link": "l",
                "results": [{**entry, "text": text}, {"review_link": f"/{number}"}]}
        (tmp_path / f"reviews-{number}.json").write_text(json.dumps(page))
    restaurants, reviews = jobs.ingest(
        spark, str(tmp_path / "places.json"), str(tmp_path / "reviews-*.json"), str(tmp_path / "o")
    )
    assert restaurants.columns == schemas.RESTAURANTS.fieldNames()
    assert sorted(r.name for r in restaurants.collect()) == ["b", "first"]
    got = {r.review_id or r.review_link: r for r in reviews.collect()}
    assert set(got) == {5, "/0", "/1"}
    assert (got[5].text, got[5].restaurant_entity_id, got[5].trip_type) == ("one", 0, "SOLO")


def test_prepare_tables(spark, prepared):
    t, out, descriptive, modelling, table = prepared
    assert descriptive.count() == t.read("documents").count()
    assert modelling.columns == fv.SAFE_COLUMNS
    assert 0 < modelling.count() < descriptive.count()
    lines = [r.value for r in spark.read.text(f"{out}/data_audit_summary").collect()]
    assert any(line.startswith("| text | kept_for_modeling |") for line in lines)


def test_feature_table(prepared):
    table = prepared[-1]
    assert len(table.columns) == 61
    row = table.agg(F.avg("vader_compound_z").alias("m"), F.stddev_pop("vader_compound_z").alias("s"))
    mean, dev = row.first()
    assert abs(mean) < 1e-9 and abs(dev - 1) < 1e-9


def test_reports(spark, prepared):
    t, out, descriptive, modelling, table = prepared
    jobs.write_exploration(
        jobs.exploration(descriptive, modelling, t.supplier_places()), f"{out}/eda"
    )
    jobs.write_sentiment(jobs.sentiment_tables(table), f"{out}/sentiment")
    assert spark.read.parquet(f"{out}/eda/text_length_by_rating").count() == 5
    lines = [r.value for r in spark.read.text(f"{out}/sentiment/sentiment_emotion_summary").collect()]
    assert "## correlations" in lines


def test_stream_equals_batch(spark, prepared, tmp_path):
    t = prepared[0]
    source = str(tmp_path / "landed")
    t.doc_reviews().repartition(4).write.parquet(source)
    t.doc_reviews().limit(20).write.mode("append").parquet(source)
    stream = streaming.read_stream(spark, source, t.doc_reviews().schema, files_per_trigger=2)
    unique = streaming.first_arrivals(stream)
    query = streaming.write_stream(
        streaming.enrich(unique, PROSE_LEXICONS), str(tmp_path / "out"), str(tmp_path / "check")
    )
    query.awaitTermination()
    columns = ["review_id", "lexicon_sentiment_score", "vader_compound", "text_len"]
    got = spark.read.parquet(str(tmp_path / "out")).select(columns)
    expected = streaming.enrich(t.doc_reviews(), PROSE_LEXICONS).select(columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


# --- learning ---------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def separable(spark):
    """The label follows one number and one word."""
    df = spark.range(400).select(
        F.col("id").alias("review_id"),
        F.pmod(F.xxhash64("id"), F.lit(100)).cast("double").alias("x"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)).cast("double").alias("noise"),
        F.when(F.col("id") % 9 != 0, F.concat(F.lit("k"), F.col("id") % 3)).alias("kind"),
    )
    label = (F.col("x") > 60).cast("int")
    words = F.when(label == 1, "lovely tasty food here").otherwise("cold bland food there")
    return df.withColumns({"target_five_star": label, "combined_text": words}).withColumn(
        "x", F.when(F.col("review_id") % 11 != 0, F.col("x"))
    )


def test_encoder_matches_relational_form(spark, separable):
    model = learning.TableEncoder(["x", "noise"], ["kind"], "f").fit(separable)
    assert model.names() == ["x", "noise", "kind=k0", "kind=k1", "kind=k2"]
    got = {r.review_id: r.f for r in model.transform(separable).select(
        "review_id", vector_to_array("f").alias("f")).collect()}
    plain = features.standard_scale(features.impute_median(separable, ["x"]), ["x", "noise"])
    for r in plain.collect():
        assert got[r.review_id][:2] == pytest.approx([r.x, r.noise])


def test_text_components(spark, separable):
    fitted = learning.TextComponents("combined_text", components=3, min_df=2).fit(separable)
    v = fitted.directions
    assert np.abs(v.T @ v - np.eye(v.shape[1])).max() < 1e-9
    out = fitted.transform(separable).select(vector_to_array("words").alias("w"))
    assert out.count() == 400 and len(out.first().w) == v.shape[1]


SPECS = [
    experiments.Experiment("knn", "knn", {"k": (5,), "weights": ("uniform", "distance")}, ["x", "noise"]),
    experiments.Experiment("rf", "rf", {"trees": (5,), "depth": (None, 3), "leaf": (1,)}, ["x"], ["kind"]),
    experiments.Experiment("text", "knn", {"k": (5,), "ngram": (1,)}, text="combined_text", components=0),
    experiments.Experiment(
        "both", "xgb",
        {"components": (2,), "trees": (3,), "depth": (2,), "leaf": (1, 3), "rate": (0.1,),
         "row_share": (0.8, 1.0), "column_share": (0.8,)},
        ["x", "noise"], ["kind"], text="combined_text", draws=2,
    ),
    experiments.Experiment(
        "hgb", "hgb", {"rate": (0.1,), "depth": (None,), "leaves": (4,), "leaf": (5,)}, ["x"],
    ),
]


def test_train_job(spark, separable, tmp_path):
    out = str(tmp_path)
    result = jobs.train(separable, out, SPECS, folds=2)
    board = {r.experiment: r for r in spark.read.parquet(f"{out}/model_results").collect()}
    assert set(board) == {s.name for s in SPECS}
    # far better than the larger class alone
    assert board["rf"].f1_macro > 0.85 and board["text"].accuracy > 0.95
    assert board["hgb"].roc_auc > 0.8
    tested = result["predictions"].filter("experiment = 'rf'").count()
    assert tested == result["test"].count()
    for name in ("confusion_matrix", "roc_curve", "pr_curve", "permutation_importance"):
        assert spark.read.parquet(f"{out}/best_model/{name}").count() > 0


def test_permutation_importance_finds_the_signal(spark, separable):
    rows = cut(split.stratified_split(separable, "review_id", "target_five_star"))
    train = features.with_class_weight(rows.filter("NOT is_test"), "target_five_star")
    model = Pipeline(stages=[
        learning.TableEncoder(["x", "noise"], []),
        VectorAssembler(inputCols=["table"], outputCol="features"),
        learning.forest("target_five_star", numTrees=5, maxDepth=4),
    ]).fit(train)
    got = importance.permutation_importance(
        model, rows.filter("is_test"), "review_id", "target_five_star", ["x", "noise"], repeats=2
    )
    drop = {r.feature: r.importance_mean for r in got.collect()}
    assert drop["x"] > 0.2 and abs(drop["noise"]) < 0.1


def test_shuffled_keeps_the_values(spark, separable):
    mixed = importance.with_shuffled(separable, "review_id", ["noise"], "s").collect()
    assert sorted(r._new_noise for r in mixed) == sorted(r.noise for r in mixed)
    assert len(mixed) == 400 and sum(r._new_noise != r.noise for r in mixed) > 300


def test_experiment_matrix():
    specs = experiments.all_experiments()
    assert len(specs) == 10
    sizes = [
        len(experiments.sampled_points(s.grid, s.draws) if s.draws else experiments.grid_points(s.grid))
        for s in specs
    ]
    assert sizes == [8, 12, 16, 8, 12, 16, 24, 10, 16, 4]
    assert (experiments.tree_depth(None), experiments.tree_depth(None, 31)) == (30, 5)


def test_first_arrivals_within_a_watermark(spark, tmp_path):
    from tastelens.streaming.reviews import first_arrivals, read_stream, write_stream

    rows = [(1, "a", "2024-01-01"), (1, "a", "2024-01-02"), (2, "b", "2024-01-02"), (None, "c", "2024-01-03"), (None, None, "2024-01-03")]
    df = spark.createDataFrame(rows, "review_id bigint, review_link string, day string")
    df = df.selectExpr("review_id", "review_link", "to_timestamp(day) AS at")
    df.write.parquet(str(tmp_path / "in"))
    stream = read_stream(spark, str(tmp_path / "in"), df.schema)
    write_stream(
        first_arrivals(stream, "at", "3 days"), str(tmp_path / "out"), str(tmp_path / "state")
    ).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["review_id"] or 0, r["review_link"]) for r in got.collect()) == [(0, "c"), (1, "a"), (2, "b")]
