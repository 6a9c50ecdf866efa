"""Operators on small fixtures, brute force and properties."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tastelens import fixed_values as fv
from tastelens import schemas, session
from tastelens.operators import audit, dedup, experiments, features, learning, metrics, neighbours, prepare, sentiment, split, tiles
from tastelens.operators import summaries as E
from tastelens.operators.ranking import hashed_row_number, quantiles, running_totals
from tastelens.sources import csv_ranges, files, lexicons


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- sources --------------------------------------------------------------------------------------


def test_csv_round_trip(spark, tmp_path):
    text = 'two\nlines, "quoted" and ünï 好'
    df = spark.createDataFrame(
        [(1, text, 4.5, True), (2, None, None, False), (3, "none", 1.0, None), (4, " pad ", 0.0, None)],
        "id bigint, text string, rating double, flag boolean",
    )
    path = str(tmp_path / "t")
    files.write_csv(df, path, byte_order_mark=True)
    raw = b"".join(p.read_bytes() for p in (tmp_path / "t").glob("*.csv"))
    assert raw.startswith("\ufeffid,".encode())
    schema = schemas.record(id=schemas.LONG, text=schemas.TEXT, rating=schemas.DOUBLE, flag=schemas.FLAG)
    assert rows(files.read_csv(spark, path, schema)) == rows(df)


def test_csv_null_spellings_and_bad_values(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "\ufeffid,name,score\n1,NA,1.5\nx,n/a,oops\n3,none,nan\n4,\"a\nb\",2\n", encoding="utf-8"
    )
    schema = schemas.record(id=schemas.LONG, name=schemas.TEXT, score=schemas.DOUBLE)
    got = files.read_csv(spark, str(tmp_path / "a.csv"), schema).collect()
    assert [tuple(r) for r in got] == [
        (1, None, 1.5), (None, None, None), (3, "none", None), (4, "a\nb", 2.0),
    ]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("broadcast", [True, False])
def test_csv_by_byte_ranges(spark, tmp_path, monkeypatch, end, broadcast):
    """Ranges of a few bytes cut records, quotes and line breaks anywhere; rows as in one piece."""
    draw = random.Random(3)
    parts = ["a", " ", '""', ",", "好", "\n", "\n\n", "\r\n", "NA", "word "]
    (tmp_path / "t").mkdir()
    for name in ("a", "b"):
        lines = ["\ufeffid,text,score"]
        for i in range(150):
            text = "".join(draw.choice(parts) for _ in range(draw.randrange(60 if i % 50 else 800)))
            lines.append(draw.choice([f'{i},"{text}",{i / 4}', f"{i},plain,", "", f'{i},"",x']))
        (tmp_path / "t" / f"{name}.csv").write_bytes(end.join(lines).encode() + end.encode() * (name == "a"))
    (tmp_path / "t" / "empty.csv").write_bytes(b"")
    schema = schemas.record(id=schemas.LONG, text=schemas.TEXT, score=schemas.DOUBLE)
    path = str(tmp_path / "t")
    if not broadcast:
        monkeypatch.setattr(csv_ranges, "MOST_RANGES", 0)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100b")
    try:
        got = csv_ranges.read_csv_ranges(spark, path, schema).collect()
        ranges = csv_ranges._ranges(csv_ranges._lines(spark, path)).count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    wanted = files.read_csv(spark, path, schema).collect()
    assert ranges > 50
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))


def test_json_pages(spark, tmp_path):
    good = {fv.PLACE_ID: 7, "name": "A", "address": {"city": "HK"}, "reviews": 3,
            "coordinates": {"latitude": 1.5}, "parent_location": {fv.PLACE_ID: 9}}
    linked = {fv.PLACE_ID: 0, "link": "/x-d55-y", "address": "not a record"}
    pages = [{"results": [good, linked]}, {"other": 1}, {"results": []}]
    path = tmp_path / "p.json"
    path.write_text("\n".join(json.dumps(p) for p in pages))
    items = files.read_result_pages(spark, str(path), schemas.RESTAURANT_ITEM)
    flat = files.flatten_restaurants(items).drop(*files.ORIGIN)
    assert flat.columns == schemas.RESTAURANTS.fieldNames()
    got = {r[fv.PLACE_ID]: r for r in flat.collect()}
    assert set(got) == {7, 55}
    assert (got[7].city, got[7].latitude, got[7].parent_location_id, got[7].reviews_count) == (
        "HK", 1.5, 9, 3,
    )
    assert got[55].city is None


def test_lexicon_files(spark, tmp_path):
    polarity = tmp_path / "p.tff"
    polarity.write_text(
        "type=weaksubj len=1 word1=Abandoned pos1=adj stemmed1=n priorpolarity=negative\n\n"
        "word1=fine priorpolarity=both\nword1=x word1=nice priorpolarity=positive\nlen=1\n"
        "word1=flat priorpolarity=neutral\n"
    )
    emotion = tmp_path / "e.txt"
    emotion.write_text("Happy\tjoy\t1\nhappy\ttrust\t1\nhappy\tfear\t0\nbroken line\n")
    negation = tmp_path / "n.csv"
    negation.write_text("Not\n no \n\nnot\n")
    valence = tmp_path / "v.txt"
    valence.write_text("good\t1.9\t0.9\nbad\t-2.5\nbroken\n")
    lex = lexicons.load_lexicons(spark, *map(str, (polarity, emotion, negation, valence)))
    assert (lex.positive, lex.negative) == (["fine", "nice"], ["abandoned", "fine"])
    assert lex.emotions["joy"] == lex.emotions["trust"] == ["happy"] and lex.emotions["fear"] == []
    assert lex.negations == ["no", "not"] and lex.valence == {"good": 1.9, "bad": -2.5}


def test_builtin_list_sizes():
    sizes = [len(x) for x in (fv.POSITIVE_WORDS, fv.NEGATIVE_WORDS, fv.NEGATIONS, fv.INTENSIFIERS)]
    assert sizes == [67, 63, 25, 17]
    assert len(fv.EMOTION_WORDS) == 5 and len(fv.SAFE_COLUMNS) == 31
    assert len(fv.FALLBACK_NEGATIONS) == 20


def test_markdown(spark):
    df = spark.createDataFrame([("b", 2), ("a", None)], "k string, n int")
    lines = [r.line for r in files.markdown_table(df, [F.col("k")]).orderBy("line_no").collect()]
    assert lines == ["| k | n |", "| --- | --- |", "| a | nan |", "| b | 2 |"]


# --- preparation ----------------------------------------------------------------------------------


def raw_review(**given):
    base = dict.fromkeys(schemas.REVIEWS.fieldNames())
    return tuple({**base, **given}[c] for c in base)


LONG_TEXT = "A long enough review of a very nice place."


def test_review_features(spark):
    data = [
        raw_review(review_id=1, title="Nice", text=LONG_TEXT, rating=5.0, original_language="en",
                   language="en", published_at_date="2024-03-01", stay_date="bad",
                   like_count="3", restaurant_entity_id=1),
        raw_review(review_id=2, text="好吃 " + LONG_TEXT, rating=3.0, original_language="en"),
        raw_review(review_id=3, title="short �", rating=None, original_language=None),
    ]
    df = prepare.review_features(spark.createDataFrame(data, schemas.REVIEWS))
    assert len(df.columns) == 48
    one, two, three = df.orderBy("review_id").collect()
    assert one.combined_text == "Nice " + LONG_TEXT and one.review_year == 2024
    assert one.stay_date is None and one.target_five_star_label == "five_star"
    assert one.like_count_log1p == pytest.approx(math.log(4))
    assert one.reviewer_contribution_count_log1p == 0.0
    assert (two.has_chinese, two.rating_3class, two.is_language_en) == (True, "neutral", False)
    assert (three.has_replacement_char, three.title_clean, three.text_len) == (True, "short", 0)
    assert (three.rating_3class_code, three.is_original_english) == (-1, False)


def test_modelling_table(spark):
    data = [
        raw_review(review_id=i, text=t, rating=5.0, original_language=lang, restaurant_entity_id=p,
                   published_at_date=d)
        for i, (t, lang, p, d) in enumerate(
            [(LONG_TEXT, "en", 1, "2024-01-02"), (LONG_TEXT, "de", 1, "2024-01-01"),
             ("short", "en", 1, "2024-01-01"), ("é" * 40, "en", 1, "2024-01-01"),
             (LONG_TEXT, "en", None, None), (LONG_TEXT, "en", 2, "2023-01-01")]
        )
    ]
    places = spark.createDataFrame(
        [(1, "A", "$"), (1, "A again", "$$$$"), (None, "no id", "$")],
        f"{fv.PLACE_ID} bigint, name string, price_range string",
    )
    for c in prepare.RESTAURANT_KEPT:
        if c not in places.columns:
            places = places.withColumn(c, F.lit(None).cast("string"))
    reviews = prepare.review_features(spark.createDataFrame(data, schemas.REVIEWS))
    featured = prepare.restaurant_features(places)
    table = prepare.in_review_order(prepare.modelling_table(reviews, featured))
    assert table.columns == fv.SAFE_COLUMNS
    got = [(r.review_id, r.price_range) for r in table.collect()]
    # repeated restaurants fan out, missing ids meet, missing dates come last
    assert got[0] == (5, None) and sorted(got[1:3]) == [(0, "$"), (0, "$$$$")]
    assert got[3] == (4, "$") and len(got) == 4
    summary = {(r.section, r.metric): r.value
               for r in audit.audit_summary(
                   spark.createDataFrame(data, schemas.REVIEWS), featured, reviews).collect()}
    assert summary[("text", "kept_for_modeling")] == 4
    assert summary[("modeling_rating", "5")] == 4 and summary[("raw_rating", "5")] == 6
    assert summary[("raw_3class", "neutral")] == 0
    assert summary[("raw_binary", "non_five_star")] is None


def test_cleaning_is_planned_once(spark):
    data = [raw_review(review_id=1, text=LONG_TEXT, original_language="en")]
    reviews = spark.createDataFrame(data, schemas.REVIEWS).repartition(2)
    kept = prepare.fit_for_modelling(prepare.review_features(reviews)).select("combined_text")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("1F300") == 2  # title and text, once each


def test_tokens_are_planned_once(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    scored = sentiment.with_text_features(docs, lexicons.Lexicons(), "text", valence=False)
    plan = scored.filter("lexicon_sentiment_score > 0")._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("regexp_extract_all") == 1


def test_request_filter_reaches_the_scan(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(
        F.col("o_orderkey").alias("review_id"), F.col("o_orderstatus").alias("original_language"),
        F.col("o_totalprice").alias("rating"),
    )
    found = prepare.request_filter(orders, lang="F", rating_is=5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan


# --- dedup ----------------------------------------------------------------------------------------


def test_keep_first(spark):
    df = spark.createDataFrame(
        [(0, 5, "a"), (1, 5, "b"), (2, 0, "l"), (3, None, "l"), (4, None, ""), (5, None, None)],
        "n int, id bigint, link string",
    )
    key = dedup.id_or_link(F.col("id"), F.col("link"))
    assert [r.n for r in dedup.keep_first(df, key, [F.asc("n")]).orderBy("n").collect()] == [0, 2]


def test_top_per_key_cuts_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 2)
    top = dedup.top_per_key(df, ["k"], [F.asc("id")], 2)
    assert [r.id for r in top.orderBy("id").collect()] == [0, 1, 2, 3]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize(
    "places, expected",
    [
        ([(0, "Kowloon", "CITY", 5), (3, "Big Hong Kong", "city", 7)], 7),
        ([(0, "x", "y", 0), (1, "Hong Kong Bar", "RESTAURANT", 5)], 5),
        ([], 294217),
    ],
)
def test_pick_place(spark, places, expected):
    df = spark.createDataFrame(
        places, "position int, name string, place_type string, entity_id bigint"
    )
    assert dedup.pick_place(df).first()[0] == expected


def test_repeated_counts_missing_as_equal(spark):
    df = spark.createDataFrame(
        [(None, None), (None, None), ("a", "b"), ("a", "b"), ("a", None)], "t string, u string"
    )
    counts = audit.counts_by_value(df, {"pair": ["t", "u"], "one": ["t"], "gap": F.col("u").isNull()})
    beyond = counts.groupBy("kind").agg(F.sum(F.col("n") - 1)).collect()
    assert dict(map(tuple, beyond))["pair"] == 2


def test_audit_reads_the_reviews_twice(spark, folder):
    from tastelens.sources.tables import Tables

    t = Tables(spark, folder)
    summary = audit.audit_summary(t.doc_reviews(), t.places(), t.review_features())
    plan = summary._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [doc_id") == 2


# --- ranks and quantiles ----------------------------------------------------------------------------


def test_hashed_row_number_is_complete(spark):
    df = spark.range(1000).withColumn("y", F.when(F.col("id") % 3 == 0, F.col("id") % 2))
    ranked = hashed_row_number(df, ["y"], "id", 1)
    for y in (0, 1, None):
        got = sorted(r._row for r in ranked.filter(F.col("y").eqNullSafe(F.lit(y))).collect())
        assert got == list(range(1, len(got) + 1))
    assert ranked.count() == 1000


def test_running_totals(spark):
    values = random.Random(1).sample(range(10_000), 500)
    df = spark.createDataFrame([(float(v), v % 7) for v in values], "v double, m bigint")
    for down in (False, True):
        got = {r.v: r.t for r in running_totals(df, "v", {"m": "t"}, descending=down).collect()}
        total = 0
        for v in sorted(values, reverse=down):
            total += v % 7
            assert got[float(v)] == total


def test_quantiles(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 10, 11.5)], "x double")
    got = quantiles(df, "x", {"a": 0.25, "b": 0.5, "c": 0.75}).first()
    assert (got.n, got.a, got.b, got.c) == (6, 2.25, 3.5, 8.5)


def test_box_plot_hides_far_values(spark):
    data = [("a", v) for v in (1, 2, 3, 4, 100)] + [("b", 7)] * 3 + [(None, 1)]
    got = rows(E.box_plot(spark.createDataFrame(data, "k string, v int"), "k", "v"))
    assert got == [("a", 5, 2.0, 3.0, 4.0, 1, 4), ("b", 3, 7.0, 7.0, 7.0, 7, 7)]


def test_histogram_puts_the_maximum_in_the_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (9.9,), (10.0,)], "x double")
    counts = {r.bin: r["count"] for r in E.histogram(df, "x").collect()}
    assert len(counts) == 20 and (counts[0], counts[1], counts[19]) == (1, 1, 2)
    constant = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert {r.bin: r["count"] for r in E.histogram(constant, "x").collect()}[0] == 2


def test_zscore_and_correlation_of_a_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1), (1.0, 4.0, 2), (1.0, 6.0, 3), (1.0, None, 9)],
                               "c double, x double, t int")
    assert [r.c_z for r in E.zscore(df, ["c"]).collect()] == [0.0] * 4
    got = E.correlations(df, ["t"], ["c", "x"]).first()
    assert (got.c, got.x) == (None, 1.0)


def test_melt_and_label_mix(spark):
    df = spark.createDataFrame([(1, "positive"), (1, "negative"), (2, "positive")],
                               "rating int, lexicon_sentiment_label string")
    assert rows(E.label_mix(df)) == [(1, 0.5, 0.0, 0.5), (2, 0.0, 0.0, 1.0)]
    wide = spark.createDataFrame([(1, 0.5, 0.25)], "k int, a double, b double")
    long = E.melt(wide, ["k"], ["a", "b"], "m", "v", {"a": "A"}, "l")
    assert rows(long) == [(1, "a", 0.5, "A"), (1, "b", 0.25, "b")]


# --- features --------------------------------------------------------------------------------------------


def test_imputation_and_scaling(spark):
    df = spark.createDataFrame([(1.0, "b"), (None, "a"), (4.0, None), (2.0, None)],
                               "x double, k string")
    assert sorted(r.x for r in features.impute_median(df, ["x"]).collect()) == [1.0, 2.0, 2.0, 4.0]
    assert sorted(r.k for r in features.impute_mode(df, ["k"]).collect()) == ["a", "a", "a", "b"]
    scaled = features.standard_scale(
        spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double"), ["x"]
    ).collect()
    assert sorted(r.x for r in scaled)[2] == pytest.approx((4 - 7 / 3) / 1.247219, abs=1e-6)


def test_one_hot_unknown(spark):
    df = spark.createDataFrame([("a",), ("zz",), (None,)], "k string")
    got = features.one_hot(df, "k", ["a", "b", "c"]).select("k_a", "k_b", "k_c")
    assert [tuple(r) for r in got.collect()] == [(1, 0, 0), (0, 0, 0), (0, 0, 0)]


def test_tfidf_like_the_formula(spark):
    texts = ["good food good", "bad food", "good good day"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    vocab = features.vocabulary(df, "text", n_max=1, min_df=1, max_features=3)
    assert [r.term for r in vocab.orderBy("term_id").collect()] == ["bad", "food", "good"]
    got = {(r.id, r.term): r.weight
           for r in features.tfidf(df, "id", "text", vocab, 3, n_max=1).collect()}
    idf = {t: math.log(4 / (1 + n)) + 1 for t, n in (("bad", 1), ("food", 2), ("good", 2))}
    norm = math.hypot(2 * idf["good"], idf["food"])
    assert got[(0, "good")] == pytest.approx(2 * idf["good"] / norm)
    assert got[(2, "good")] == pytest.approx(1.0)


def test_large_lexicon_path_gives_the_same(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    lex = lexicons.Lexicons(positive=["the", "it", "is"], negative=["was", "it"], negations=["of", "and"])
    joined = sentiment.score_by_join(docs, lexicons.lexicon_table(spark, lex), "doc_id", "text")
    inline = sentiment.with_text_features(docs, lex, "text", valence=False)
    columns = ["doc_id", *sentiment.polarity_columns()]
    assert rows(joined.select(*columns)) == rows(inline.select(*columns))
    table = lexicons.lexicon_table(spark, lex)
    matched = sentiment.match_tokens(docs, table, "doc_id", "text")
    assert "BuildRight" in matched._jdf.queryExecution().executedPlan().toString()
    tables = lexicons.as_tables(spark, lex)
    want = rows(sentiment.with_text_features(docs, lex, "text"))
    assert rows(sentiment.with_text_features(docs, tables, "text")) == want
    monkeypatch.setattr(lexicons, "MAX_BROADCAST_WORDS", 2)
    assert not lexicons.fits_broadcast(table)
    assert rows(sentiment.score_by_join(docs, table, "doc_id", "text")) == rows(joined)
    assert rows(sentiment.with_text_features(docs, tables, "text")) == want


def test_joined_features_of_odd_rows(spark):
    lex = lexicons.Lexicons(
        positive=["good"], negative=["bad"], negations=["not"],
        valence={"good": 2.0, "bad": -2.0, "kind": 1.5},
    )
    texts = ["not good", "not good", None, "", "so GOOD but bad!!", "that was kind of good", "x" * 9000,
             "we are kind of good", "a kind man", "good bad " * 3000]
    df = spark.createDataFrame([(None if i == 1 else i % 3, t) for i, t in enumerate(texts)],
                               "id int, combined_text string")
    inline = sentiment.with_text_features(df, lex)
    joined = sentiment.with_text_features(df, lexicons.as_tables(spark, lex))
    assert joined.columns == inline.columns
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, inline.collect()))
    score = {r.combined_text: r.vader_compound for r in joined.collect()}
    assert score["that was kind of good"] == pytest.approx(round(1.707 / math.sqrt(1.707**2 + 15), 4))
    assert score["a kind man"] > 0
    empty = sentiment.with_text_features(df.limit(0), lexicons.as_tables(spark, lex))
    assert empty.count() == 0


def test_loaded_tables_equal_loaded_lists(spark, tmp_path):
    (tmp_path / "p").write_text("type=x word1=good priorpolarity=positive\nword1=good priorpolarity=both\n")
    (tmp_path / "n").write_text("not\nno,x\n")
    paths = {"polarity_path": str(tmp_path / "p"), "negation_path": str(tmp_path / "n")}
    df = spark.createDataFrame([("not good but no delight",)], "combined_text string")
    lists, tables = lexicons.load_lexicons(spark, **paths), lexicons.load_tables(spark, **paths)
    a, b = (sentiment.with_text_features(df, x, valence=False).first() for x in (lists, tables))
    assert a == b


# --- splits, metrics, neighbours -----------------------------------------------------------------------


def test_split_and_folds(spark):
    df = spark.range(103).withColumn("y", (F.col("id") % 4 == 0).cast("int"))
    test = split.stratified_split(df, "id", "y")
    counts = {(r.y, r.is_test): r["count"] for r in test.groupBy("y", "is_test").count().collect()}
    n = {0: 77, 1: 26}
    assert all(counts[(y, True)] == math.ceil(0.2 * n[y]) for y in n)
    folds = split.stratified_folds(df, "id", "y").groupBy("y", "fold").count().collect()
    assert len(folds) == 10
    for y in n:
        sizes = [r["count"] for r in folds if r.y == y]
        assert max(sizes) - min(sizes) <= 1


def test_curve_measures(spark):
    df = spark.createDataFrame([(3.0, 1), (2.0, 0), (1.0, 1)], "s double, y int")
    assert metrics.average_precision(df, "y", "s").first()[0] == 0.833333
    assert metrics.roc_auc(df, "y", "s").first()[0] == 0.5
    one_class = df.filter("y = 1")
    assert metrics.roc_auc(one_class, "y", "s").first()[0] is None


def test_roc_auc_by_pairs(spark):
    pick = random.Random(3)
    data = [(float(pick.randint(0, 20)), pick.randint(0, 1)) for _ in range(300)]
    pos = [s for s, y in data if y]
    neg = [s for s, y in data if not y]
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)
    df = spark.createDataFrame(data, "s double, y int")
    assert metrics.roc_auc(df, "y", "s").first()[0] == pytest.approx(wins, abs=1e-6)


def test_metrics_where_a_class_is_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (1, 0)], "y int, p int")
    got = metrics.classification_metrics(df, "y", "p").first()
    assert (got.accuracy, got.precision_macro, got.recall_macro) == (0.3333, 0.1667, 0.5)
    assert rows(metrics.confusion_matrix(df, "y", "p")) == [(0, 0, 1), (0, 1, 0), (1, 0, 2), (1, 1, 0)]


@pytest.mark.parametrize("block_rows", [7, 40, 1000])
@pytest.mark.parametrize("same", [True, False])
def test_nearest_equals_brute_force(spark, block_rows, same):
    pick = random.Random(5)
    vecs = [[pick.gauss(c, 1) for c in (pick.choice((-3, 3)), 0, 1)] for _ in range(120)]
    vecs[3] = vecs[4] = vecs[5]
    vecs[7] = [0.0, 0.0, 0.0]
    # a third of all points are copies of one
    vecs += [vecs[0]] * 60
    df = spark.createDataFrame(list(enumerate(vecs)), "id bigint, vec array<double>")
    k = 9

    def distance(a, b):
        na, nb = math.hypot(*a), math.hypot(*b)
        cos = sum(x * y for x, y in zip(a, b)) / (na * nb) if na and nb else 0.0
        return round(1 - cos, 12) + 0.0

    got = {}
    found = neighbours.nearest(df, df, k, same_table=same, block_rows=block_rows)
    for r in found.collect():
        got.setdefault(r.query_id, []).append((r.distance, r.point_id))
    for q, vec in enumerate(vecs):
        all_pairs = sorted((distance(vec, v), i) for i, v in enumerate(vecs) if not (same and i == q))
        mine = sorted(got[q])
        assert [i for _, i in mine] == [i for _, i in all_pairs[:k]]
        assert all(abs(a - b) < 1e-9 for (a, _), (b, _) in zip(mine, all_pairs))


def test_nearest_reads_sparse_vectors_and_copies_by_blocks(spark):
    pick = random.Random(8)
    dense = [
        (i, Vectors.dense([pick.random() if pick.random() < 0.3 else 0.0 for _ in range(12)]))
        for i in range(90)
    ]
    sparse = [
        (i, Vectors.sparse(12, {j: x for j, x in enumerate(v) if x})) for i, v in dense
    ]
    found = []
    for side in (dense, sparse):
        df = spark.createDataFrame(side, ["id", "vec"])
        found.append(sorted(map(tuple, neighbours.nearest(df, df, 4, block_rows=20).collect())))
    assert found[0] == found[1]

    points = neighbours.with_parts(df, "id", "vec", "point_id")
    asked = neighbours.with_parts(df.filter("id < 40"), "id", "vec", "query_id")
    left, right = neighbours.paired(
        asked, points, neighbours.blocks_of(asked, 20), neighbours.blocks_of(points, 20)
    )
    assert (left.count(), right.count()) == (40 * 5, 90 * 2)


@pytest.mark.parametrize("signs", [(1,), (1, -1)])
def test_tiles_of_sparse_points_are_passed_over_without_loss(signs):
    """Texts of 20 topics with copies, ties and empty rows: few products, the same neighbours."""
    draw, width, k = np.random.default_rng(3), 2_000, 5
    rows = []
    for i in range(3_000):
        topic = i % 20
        own = topic * 90 + draw.choice(90, 12, replace=False)
        terms = np.unique(np.append(own, 1_800 + draw.choice(200, 3)))
        weights = np.where(terms < 1_800, 2.0, 0.2) * draw.uniform(0.5, 1.5, len(terms))
        rows.append((terms, weights * draw.choice(signs, len(terms))))
    for copy in range(0, 300, 3):
        rows[copy + 1_000] = rows[copy]
    rows[7] = rows[2_900] = (np.array([], dtype=int), np.array([]))
    rows[8] = (None, None)
    unit = tiles.UnitRows(*zip(*rows))
    column = np.arange(width)
    dense = unit.dense(np.arange(len(rows)), column, width)
    names = np.arange(len(rows))
    query, point, far, taken = tiles.nearest_rows(unit, unit, k, width, 12, (names, names))
    wanted = np.round(1 - dense @ dense.T, 12) + 0.0
    np.fill_diagonal(wanted, np.inf)
    best = np.argsort(wanted, axis=1, kind="stable")[:, :k]
    got = {}
    for q, p, d in zip(query, point, far):
        got.setdefault(q, []).append((d, p))
    for q in range(len(rows)):
        mine = sorted(got[q])
        assert np.allclose([d for d, _ in mine], wanted[q, best[q]], atol=1e-9)
        assert [p for _, p in mine] == best[q].tolist()
    assert taken < 0.35 * len(rows) ** 2


def test_tiles_of_nothing():
    none, some = tiles.UnitRows([], []), tiles.UnitRows([[1]], [[2.0]])
    for queries, points in ((none, some), (some, none), (none, none)):
        assert tiles.nearest_rows(queries, points, 3, 4, 12)[3] == 0
    query, point, far, _ = tiles.nearest_rows(some, some, 3, 4, 12)
    assert (query.tolist(), point.tolist(), far.tolist()) == ([0], [0], [0.0])


def test_modes_of_many_categories(spark):
    df = spark.range(30_000).select(
        F.concat(F.lit("c"), F.col("id") % 15_000).alias("wide"),
        F.when(F.col("id") % 3 == 0, "b").when(F.col("id") % 3 == 1, "a").alias("tied"),
    )
    assert dict(map(tuple, features.modes(df, ["wide", "tied"]).collect())) == {
        "wide": "c0", "tied": "a",
    }
    fitted = learning.TableEncoder([], ["wide"], "f").fit(df)
    assert len(fitted.names()) == 15_000
    first = fitted.transform(df.limit(1)).first()["f"]
    assert (first.size, first.numNonzeros()) == (15_000, 1)


def test_vote(spark):
    near = spark.createDataFrame(
        [(1, 10, 0.5), (1, 11, 0.1), (1, 12, 0.5), (2, 10, 0.0), (2, 11, 0.1), (2, 12, 0.1)],
        "query_id int, point_id int, distance double",
    )
    labels = spark.createDataFrame([(10, 0), (11, 1), (12, 0)], "id int, label int")
    uniform = {r.query_id: r.prediction for r in neighbours.vote(near, labels).collect()}
    weighted = {r.query_id: r for r in neighbours.vote(near, labels, "distance").collect()}
    assert uniform == {1: 0, 2: 0}
    assert weighted[1].prediction == 1 and weighted[2].prediction == 0
    assert weighted[2].share == 1.0


def test_zscore_with_gaps(spark):
    from tastelens.operators.summaries import zscore

    rows = [(1.0, 1.0), (3.0, float("inf")), (float("nan"), 2.0), (None, None)]
    got = [tuple(r) for r in zscore(spark.createDataFrame(rows, "a double, b double"), ["a", "b"]).select("a_z", "b_z").collect()]
    assert got == [(-1.0, 0.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0)]


def test_joined_scores_of_repeated_words_and_keys(spark):
    from tastelens.functions import lexicon as L
    from tastelens.functions.text import tokenize
    from tastelens.operators.sentiment import emotions_by_join, score_by_join

    words = [("good", True, False, False), ("good", True, False, False), ("bad", False, True, False), ("not", False, False, True)]
    kinds = "word string, is_pos boolean, is_neg boolean, is_negation boolean"
    rows = [(1, "good food bad"), (1, "food not"), (1, "good"), (None, "good good"), (None, "not bad"), (2, "good"), (2, "good"), (3, None)]
    df = spark.createDataFrame(rows, "k int, t string")
    joined = score_by_join(df, spark.createDataFrame(words, kinds), "k", "t")
    score = L.lexicon_sentiment(tokenize(F.coalesce("t", F.lit(""))), ["good"], ["bad"], ["not"])
    inside = df.select("k", score.alias("s")).select("k", "s.*")
    assert sorted(map(str, joined.collect())) == sorted(map(str, inside.collect()))
    table = spark.createDataFrame([("good", ["joy"]), ("good", ["joy", "trust"])], "word string, emotions array<string>")
    found = emotions_by_join(df, table, "k", "t")
    assert found.count() == len(rows)
    assert sorted(r["happy_count"] for r in found.collect()) == [0, 0, 0, 1, 1, 1, 1, 2]


class _Named:
    """A session of which only the settings are asked."""

    def __init__(self, master, folder=None):
        self.sparkContext = type("Context", (), {"master": master})()
        known = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "/house/"}
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, *_: known[key])})()


def test_shared_folder_is_named_on_clusters():
    from tastelens.session import shared_root

    assert shared_root(_Named("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    assert shared_root(_Named("local[4]")) == shared_root(_Named("local")) == "/house/_scratch"
    for master in ("yarn", "spark://h:1", "local-cluster[3,2,1024]", "k8s://x"):
        with pytest.raises(ValueError):
            shared_root(_Named(master))


def test_sketches_merge_and_count(spark):
    from pyspark.sql import functions as F

    from tastelens.operators import audit

    rows = spark.range(60_000).select(
        (F.col("id") % 3).alias("day"), (F.col("id") % 20_000).alias("many"), F.lit("x").alias("one"),
        F.when(F.col("id") % 2 == 0, F.col("id") % 7).alias("few"), F.lit(None).cast("string").alias("none"),
    )
    columns = ["many", "one", "few", "none"]
    sketches = audit.distinct_sketches(rows, columns, ["day"])
    assert sketches.count() == 12
    merged = {r["name"]: r for r in audit.distinct_counts(sketches).collect()}
    whole = {r["name"]: r for r in audit.distinct_counts(audit.distinct_sketches(rows, columns)).collect()}
    assert merged == whole
    assert abs(merged["many"]["distinct_about"] - 20_000) <= 3 * audit.SKETCH_ERROR * 20_000
    assert [merged[c]["distinct_about"] for c in columns[1:]] == [1, 7, 0]
    assert [merged[c]["filled"] for c in columns] == [60_000, 60_000, 30_000, 0]
    per_day = audit.distinct_counts(sketches, ["day"])
    assert per_day.count() == 12
    assert audit.distinct_counts(audit.distinct_sketches(rows.limit(0), columns, ["day"]), ["day"]).count() == 0


@pytest.mark.parametrize("width,tile_rows", [(4, 16), (40, 64)])
def test_boxes_of_dense_points_are_passed_over_without_loss(width, tile_rows):
    """Points on a thin curve with copies, ties, zero rows and a limit from other points."""
    draw, k = np.random.default_rng(9), 6
    turn = np.sort(draw.uniform(0, 3, 2_500))
    rows = np.zeros((2_500, width))
    rows[:, :3] = np.stack([np.cos(turn), np.sin(turn), 0.01 * draw.standard_normal(2_500)], axis=1)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    rows[500:560] = rows[100]
    rows[7] = rows[2_400] = 0.0
    names = np.arange(len(rows))
    query, point, far, taken = tiles.nearest_dense(
        rows, rows, k, 12, (names, names), tile_rows=tile_rows
    )
    wanted = np.round(1 - rows @ rows.T, 12) + 0.0
    np.fill_diagonal(wanted, np.inf)
    best = np.argsort(wanted, axis=1, kind="stable")[:, :k]
    order = np.lexsort((point, far, query))
    assert np.array_equal(point[order].reshape(-1, k), best)
    assert np.allclose(far[order].reshape(-1, k), np.take_along_axis(wanted, best, axis=1))
    assert taken < 0.6 * len(rows) ** 2
    # within a limit nothing is lost, beyond it nothing is needed
    limit = np.take_along_axis(wanted, best, axis=1)[:, 2]
    query, point, far, fewer = tiles.nearest_dense(
        rows, rows, k, 12, (names, names), limit=limit, tile_rows=tile_rows
    )
    within = np.argwhere(np.take_along_axis(wanted, best, axis=1) <= limit[:, None])
    assert set(zip(query, point)) >= {(q, best[q, nth]) for q, nth in within}
    assert fewer <= taken


def test_nearest_shuffles_no_vector_for_a_further_block(spark):
    """Blocks are stored once; only the k best rows of a query are shuffled after that."""
    df = spark.range(60).select("id", F.array(F.lit(1.0), F.col("id") + 0.5).alias("vec"))
    found = neighbours.nearest(df, df, 3, same_table=True, block_rows=10)
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" in plan and "Generate explode" not in plan
    assert found.count() == 180


def test_tfidf_counts_terms_in_the_row_and_shuffles_none(spark):
    texts = [(1, "one two two"), (2, "two three"), (3, None), (4, "nothing known"), (1, "one")]
    df = spark.createDataFrame(texts, "id bigint, text string")
    vocab = spark.createDataFrame(
        [("one", 2, 0), ("two", 2, 1)], "term string, doc_freq bigint, term_id int"
    )
    n = df.agg(F.count_distinct("id")).scalar()
    found = features.tfidf(df, "id", "text", vocab, n, n_max=1)
    got = {(r.id, r.term, r.term_id): r.weight for r in found.collect()}
    # rows of one key are one document
    assert set(got) == {(1, "one", 0), (1, "two", 1), (2, "two", 1)}
    assert got[1, "one", 0] == pytest.approx(math.sqrt(0.5)) and got[2, "two", 1] == 1.0
    single = features.tfidf(df.filter("id > 1"), "id", "text", vocab, 4, n_max=1)
    plan = single._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and single.count() == 1
    none = features.tfidf(df, "id", "text", vocab.limit(0), 4, n_max=1)
    assert none.count() == 0 and none.columns == ["id", "term", "term_id", "weight"]


def test_parts_of_learners_grow_in_number_and_not_in_size(spark):
    from tastelens.operators.rows import dealt

    cores = spark.sparkContext.defaultParallelism
    for n in (0, 500, 20_000):
        parts = dealt(spark.range(n), "id", n, 1_000).rdd.glom().map(len).collect()
        assert len(parts) == max(cores, n // 1_000)
        assert sum(parts) == n and max(parts) < 1_300


def test_all_cores_get_equally_many_parts(spark):
    from tastelens.operators.rows import dealt

    cores = spark.sparkContext.defaultParallelism
    n = 1_000 * cores + 1
    parts = dealt(spark.range(n), "id", n, 1_000).rdd.glom().map(len).collect()
    # not one more part than cores, which a single core would be left to do
    assert len(parts) == 2 * cores and sum(parts) == n


@pytest.mark.parametrize(
    "name, most", [("gbt_weighted", 1_000_000), ("gbt_predict", 1_000_000), ("rf_predict", 100_000)]
)
def test_parts_follow_what_a_learner_keeps_of_a_row(spark, folder, monkeypatch, name, most):
    """Rounds of boosting are not cut into the small parts that the rows of a forest need."""
    import __spark_entry__ as entry
    from tastelens.operators import rows
    from tastelens.plans import queries_model

    class Dealt(Exception):
        pass

    def large(df, key, n, *part_rows):
        raise Dealt(rows.dealt(df, key, 100 * most, *part_rows).rdd.getNumPartitions())

    monkeypatch.setattr(queries_model, "dealt", large)
    with pytest.raises(Dealt) as found:
        entry.queries()[name](spark, folder)
    assert found.value.args == (100,)


def test_nearest_of_missing_vectors_and_text_ids(spark):
    rows = [("a", [1.0, 0.0]), ("b", [0.9, 0.1]), ("c", None), ("d", [0.0, 1.0]), ("e", [0.0, 2.0])]
    df = spark.createDataFrame(rows, "id string, vec array<double>")
    for block_rows in (None, 2):
        found = neighbours.nearest(df, df, 1, same_table=True, block_rows=block_rows)
        nearest = {r.query_id: (r.point_id, r.distance) for r in found.collect()}
        assert nearest["d"] == ("e", 0.0) and nearest["e"] == ("d", 0.0)
        assert nearest["a"][0] == "b" and nearest["c"] == ("a", 1.0)
    assert neighbours.nearest(df.limit(0), df, 2).count() == 0
    assert neighbours.nearest(df, df.limit(0), 2).count() == 0


def test_hits_are_folded_across_batches(spark):
    """Texts of many batches, copies of a hit, and words of both kinds at their places."""
    neg, up = sentiment.NEGATION, sentiment.POSITIVE
    hits = [(b"a", i, up, None) for i in range(30)] + [(b"a", 30, neg, None), (b"a", 31, up, None)]
    hits += [(b"b", 2, up | sentiment.EMOTION, None)] * 3 + [(b"b", -1, 0, 1.5), (b"b", -4, 0, -2.0)]
    hits += [(b"c", 5, up | neg, None), (b"c", 9, up, None), (b"c", 8, sentiment.NEGATIVE, None)]
    df = spark.createDataFrame(hits, "_row binary, at int, flags int, valence double")
    want = {
        b"a": (30, 1, 1, 0, []), b"b": (1, 0, 0, 1, [(0, 1.5), (3, -2.0)]), b"c": (3, 0, 1, 0, []),
    }
    first = f"_{fv.EMOTION_CLASSES[0]}"
    for size in (1, 7, 10000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            found = sentiment.fold_hits(df, 3).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert len(found) == 3 and want == {
            bytes(r["_row"]): (r.up, r.down, r.turned, r[first], [tuple(v) for v in r["_valued"]])
            for r in found
        }


def test_search_stores_only_its_rows(spark, monkeypatch):
    """Feature vectors of a fold stay with the tasks and are let go after it."""
    stored = []
    monkeypatch.setattr(experiments, "cut", lambda df: stored.append(df.columns) or session.cut(df))
    df = spark.createDataFrame([(i, i % 2, float(i % 2 * 5 + i % 3)) for i in range(80)],
                               "id int, y int, x double")
    spec = experiments.Experiment("t", "rf", {"trees": (1, 2), "depth": (1,), "leaf": (1,)}, ["x"])
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    fitted = experiments.Search(spec, "id", "y").fit(df, folds=2)
    assert fitted.avgMetrics == [1.0, 1.0] and len(stored) == 1
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= held


@pytest.mark.parametrize("region_rows", [40, 5_000])
def test_nearest_by_regions_equals_brute_force(spark, monkeypatch, region_rows):
    """Vectors of few columns, with copies, zero vectors, a hot vector and empty regions."""
    from tastelens.operators import regions

    monkeypatch.setattr(neighbours, "REGION_PAIRS", 1)
    monkeypatch.setattr(regions, "REGION_ROWS", region_rows)
    monkeypatch.setattr(regions, "ASKED_AT_ONCE", 100)
    rng = np.random.default_rng(3)
    rows = np.round(rng.normal(size=(900, 5)), 1)
    rows[100:400] = rows[0]
    rows[400:440] = rows[rng.integers(500, 900, 40)]
    rows[450:455] = 0
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "id long, vec array<double>")
    unit = rows / np.where((rows == 0).all(axis=1), 1, np.sqrt((rows**2).sum(axis=1)))[:, None]
    far = np.round(1 - unit @ unit.T, 12) + 0.0
    for same, mine, theirs in ((True, range(900), range(900)), (False, range(0, 900, 3), range(50, 800))):
        found = neighbours.nearest(
            df.filter(F.col("id").isin(list(mine))), df.filter(F.col("id").isin(list(theirs))), 7,
            same_table=same,
        )
        assert found.columns == ["query_id", "point_id", "distance"]
        got: dict = {}
        for r in found.collect():
            got.setdefault(r.query_id, []).append((r.distance, r.point_id))
        for q in mine:
            want = sorted((far[q, p], p) for p in theirs if not (same and p == q))[:7]
            assert sorted(got[q]) == want


def test_votes_of_lists_are_those_of_rows(spark):
    """All settings from one list a query, as voted one by one; a query without points has none."""
    near = [(q, p, float(d)) for q in range(40) for p, d in
            enumerate(np.sort(np.random.default_rng(q).integers(0 if q % 4 == 0 else 1, 6, 9) / 8))]
    found = spark.createDataFrame(near, "query_id long, point_id long, distance double")
    labels = spark.createDataFrame([(p, p * 7 % 3) for p in range(9)], "id long, label int")
    settings = [(k, w) for k in (1, 4, 9) for w in ("uniform", "distance")]
    lists = spark.range(41).withColumnRenamed("id", "query_id").join(
        neighbours.listed(found, labels), "query_id", "left"
    )
    got = {r.query_id: r.v for r in lists.select(
        "query_id", neighbours.votes_of(F.col("near"), settings).alias("v")).collect()}
    assert len(got) == 41 and got[40] == [None] * 6
    for at, (k, weights) in enumerate(settings):
        want = neighbours.vote(found.filter(F.col("point_id") < k), labels, weights).collect()
        assert {r.query_id: r.prediction for r in want} == {q: got[q][at] for q in range(40)}
