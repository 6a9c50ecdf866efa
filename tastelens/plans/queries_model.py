"""Queries on feature engineering, splits, metrics, neighbours and learners."""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastelens import fixed_values as fv
from tastelens.functions import scalar as S
from tastelens.operators import experiments as X
from tastelens.operators import features as G
from tastelens.operators import importance, learning, metrics, neighbours, split
from tastelens.operators.rows import BOOSTED_ROWS, PART_ROWS, compute_once, dealt
from tastelens.plans.registry import META, SCORED, query, r, with_
from tastelens.session import cut
from tastelens.sources.tables import Tables

ASCII_WORDS = "[a-z]{2,}"

# --- features --------------------------------------------------------------------------------------


@query(
    "impute_median",
    sql=f"""WITH x AS (SELECT o_orderkey AS review_id,
                              CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
                              CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS place
                       FROM orders)
    SELECT review_id, {r('coalesce(price, (SELECT median(price) FROM x))')} AS price,
           {r('coalesce(place, (SELECT median(place) FROM x))')} AS place FROM x""",
)
def _(t: Tables) -> DataFrame:
    holes = t.read("orders").select(
        F.col("o_orderkey").alias("review_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_custkey")).alias("place"),
    )
    full = G.impute_median(holes, ["price", "place"])
    return full.withColumns({c: S.half_even(F.col(c), 6) for c in ("price", "place")})


@query(
    "impute_mode",
    sql=with_(META) + """, m AS (SELECT price_range FROM meta WHERE price_range IS NOT NULL
      GROUP BY 1 ORDER BY count(*) DESC, price_range LIMIT 1),
    n AS (SELECT trip_type FROM meta WHERE trip_type IS NOT NULL
      GROUP BY 1 ORDER BY count(*) DESC, trip_type LIMIT 1)
    SELECT review_id, coalesce(price_range, (SELECT price_range FROM m)) AS price_range,
           coalesce(trip_type, (SELECT trip_type FROM n)) AS trip_type FROM meta""",
)
def _(t: Tables) -> DataFrame:
    data = t.reviews_meta().select("review_id", "price_range", "trip_type")
    return G.impute_mode(data, ["price_range", "trip_type"])


@query(
    "standard_scale",
    sql=f"""SELECT c_custkey,
      {r('(c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER ()', 5)} AS c_acctbal,
      {r('(c_nationkey - avg(c_nationkey) OVER ()) / stddev_pop(c_nationkey) OVER ()', 5)}
        AS c_nationkey, CAST(0 AS DOUBLE) AS constant
    FROM customer""",
)
def _(t: Tables) -> DataFrame:
    data = t.read("customer").select(
        "c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("c_nationkey"),
        F.lit(7.0).alias("constant"),
    )
    scaled = G.standard_scale(data, ["c_acctbal", "c_nationkey", "constant"])
    return scaled.withColumns(
        {c: S.half_even(F.col(c), 5) for c in ("c_acctbal", "c_nationkey")}
    )


@query(
    "one_hot",
    sql=with_(META) + "SELECT review_id, " + ", ".join(
        f"CAST(coalesce(price_range = '{c}', false) AS INTEGER) AS price_range_{c}"
        for c in ("AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY")
    ) + " FROM meta",
)
def _(t: Tables) -> DataFrame:
    known = G.categories_of(t.reviews_meta(), "price_range")
    data = t.reviews_meta().select("review_id", "price_range")
    return G.one_hot(data, "price_range", known).drop("price_range")


TERMS = """
w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]{2,}') AS ws FROM documents),
terms AS (
  SELECT doc_id, unnest(ws) AS term FROM w
  UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))
  FROM w)
"""

VOCABULARY = TERMS + """,
counted AS (SELECT term, count(DISTINCT doc_id) AS doc_freq, count(*) AS term_count
            FROM terms GROUP BY term),
kept AS (SELECT * FROM counted WHERE doc_freq >= 5 ORDER BY term_count DESC, term LIMIT 4000),
vocab AS (SELECT *, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_id FROM kept)
"""


@query(
    "ngrams",
    sql="WITH " + TERMS + """SELECT doc_id, count(*) AS terms, count(DISTINCT term) AS distinct_terms,
      min(term) AS first_term, max(term) AS last_term FROM terms GROUP BY doc_id""",
)
def _(t: Tables) -> DataFrame:
    """Words and pairs of every document, summarised in the row."""
    docs = t.documents().select("doc_id", "text")
    terms = compute_once(docs, {"w": G.terms(F.col("text"), 2, ASCII_WORDS)})
    return terms.filter(F.size("w") > 0).select(
        "doc_id",
        F.size("w").cast("bigint").alias("terms"),
        F.size(F.array_distinct("w")).cast("bigint").alias("distinct_terms"),
        F.array_min("w").alias("first_term"),
        F.array_max("w").alias("last_term"),
    )


@query("vocabulary", sql="WITH " + VOCABULARY + "SELECT * FROM vocab")
def _(t: Tables) -> DataFrame:
    return G.vocabulary(t.documents(), "text", pattern=ASCII_WORDS)


@query(
    "tfidf",
    sql="WITH " + VOCABULARY + f""",
    tf AS (SELECT doc_id, term, term_id, count(*) * (ln((1 + (SELECT count(*) FROM documents))
             / CAST(1 + doc_freq AS DOUBLE)) + 1) AS raw
           FROM terms JOIN vocab USING (term) GROUP BY doc_id, term, term_id, doc_freq)
    SELECT doc_id, term, term_id, {r('raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id))')}
             AS weight FROM tf""",
)
def _(t: Tables) -> DataFrame:
    docs = t.documents()
    vocab = G.vocabulary(docs, "text", pattern=ASCII_WORDS)
    n = t.read("documents").agg(F.count(F.lit(1))).scalar()
    weights = G.tfidf(docs, "doc_id", "text", vocab, n, pattern=ASCII_WORDS)
    return weights.withColumn("weight", S.half_even(F.col("weight"), 6))


@query(
    "class_weights",
    sql=with_(META) + f"""
    SELECT target_five_star, count(*) AS n,
           {r('(SELECT count(*) FROM meta) / (2.0 * count(*))')} AS weight,
           {r('(SELECT count(*) FILTER (target_five_star = 0) / CAST(count(*) FILTER (target_five_star = 1) AS DOUBLE) FROM meta)')}
             AS neg_pos_ratio
    FROM meta GROUP BY target_five_star""",
)
def _(t: Tables) -> DataFrame:
    table = G.class_weights(t.reviews_meta(), "target_five_star")
    return table.withColumns(
        {c: S.half_even(F.col(c), 6) for c in ("weight", "neg_pos_ratio")}
    )


META_NUMERIC = ["like_count", "latitude", "longitude", "review_year"]
META_CATEGORICAL = ["trip_type", "price_range", "has_reservation"]


def _model_rows(t: Tables) -> DataFrame:
    return X.filled(
        t.reviews_meta().select(
            "review_id", "rating", "target_five_star", *META_NUMERIC, *META_CATEGORICAL
        )
    )


_ONE_HOTS = {
    "trip_type": ("F", "O", "Unknown"),
    "price_range": ("AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY", "Unknown"),
    "has_reservation": ("False", "True"),
}


def _scaled(column: str) -> str:
    return r(f"({column} - avg({column}) OVER ()) / stddev_pop({column}) OVER ()", 5)


@query(
    "assemble_features",
    sql="""WITH x AS (
      SELECT o_orderkey AS review_id, floor(o_totalprice / 1000) AS like_count,
             CASE WHEN o_orderstatus = 'F' THEN NULL ELSE c_acctbal END AS latitude,
             c_nationkey AS longitude, year(o_orderdate) AS review_year,
             CASE o_orderstatus WHEN 'P' THEN 'Unknown' ELSE o_orderstatus END AS trip_type,
             CASE c_mktsegment WHEN 'FURNITURE' THEN 'Unknown' ELSE c_mktsegment END AS price_range,
             CASE WHEN c_acctbal > 0 THEN 'True' ELSE 'False' END AS has_reservation
      FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
    y AS (SELECT * REPLACE (coalesce(latitude, (SELECT median(latitude) FROM x)) AS latitude) FROM x)
    SELECT review_id, """
    + ", ".join(f"{_scaled(c)} AS {c}" for c in META_NUMERIC) + ", "
    + ", ".join(
        f"CAST(CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS DOUBLE) AS {c}_{v}"
        for c, values in _ONE_HOTS.items() for v in values
    ) + " FROM y",
)
def _(t: Tables) -> DataFrame:
    """Imputed, scaled and one-hot columns as one vector, unpacked again for comparison."""
    rows = _model_rows(t).withColumn(
        "latitude", F.when(F.col("trip_type") != "F", F.col("latitude"))
    )
    encoder = learning.TableEncoder(META_NUMERIC, META_CATEGORICAL, "features").fit(rows)
    vectors = encoder.transform(rows).select("review_id", vector_to_array("features").alias("f"))
    return vectors.select(
        "review_id",
        *(
            S.half_even(F.col("f")[i], 5).alias(name.replace("=", "_"))
            for i, name in enumerate(encoder.names())
        ),
    )


@query(
    "svd_features",
    sql="""SELECT CAST(unnest(range(80)) AS BIGINT) AS component, CAST(1 AS DOUBLE) AS length,
      CAST(0 AS DOUBLE) AS overlap, CAST(0 AS DOUBLE) AS mean, CAST(1 AS DOUBLE) AS deviation,
      (SELECT count(*) FROM documents) AS documents""",
)
def _(t: Tables) -> DataFrame:
    """Text components: TF-IDF, leading singular directions, scaled. One row per component with
    the facts that hold for any text: orthonormal directions, centred and scaled columns."""
    docs = t.documents().select("doc_id", "text")
    fitted = learning.TextComponents("text", components=80).fit(docs)
    angles = np.abs(fitted.directions.T @ fitted.directions)
    lengths = np.sqrt(np.diag(angles))
    overlaps = (angles - np.diag(np.diag(angles))).max(axis=1)
    rows = [
        (i, float(a), float(b)) for i, (a, b) in enumerate(zip(lengths, overlaps))
    ]
    sides = t.spark.createDataFrame(rows, "component bigint, length double, overlap double")
    values = fitted.transform(docs).select(F.posexplode(vector_to_array("words")).alias("i", "x"))
    moments = values.groupBy(F.col("i").cast("bigint").alias("component")).agg(
        F.avg("x").alias("mean"), F.stddev_pop("x").alias("deviation"),
        F.count(F.lit(1)).alias("documents"),
    )
    found = sides.join(moments, "component")
    # + 0.0 turns a negative zero into a plain one
    return found.withColumns(
        {
            c: S.half_even(F.col(c), 6) + F.lit(0.0)
            for c in ("length", "overlap", "mean", "deviation")
        }
    )


# --- split and folds ----------------------------------------------------------------------------------


@query(
    "stratified_split",
    sql=with_(SCORED) + """, ranked AS (
      SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5('42:' || review_id), review_id) AS k,
             count(*) OVER (PARTITION BY y) AS n FROM scored)
    SELECT review_id, y, k <= ceil(n * 0.2) AS is_test FROM ranked""",
)
def _(t: Tables) -> DataFrame:
    return split.stratified_split(t.scored().drop("score"), "review_id", "y")


@query(
    "stratified_folds",
    sql=with_(SCORED) + """
    SELECT review_id, y, CAST((row_number() OVER (PARTITION BY y
             ORDER BY md5('fold42:' || review_id), review_id) - 1) % 5 AS INTEGER) AS fold
    FROM scored""",
)
def _(t: Tables) -> DataFrame:
    return split.stratified_folds(t.scored().drop("score"), "review_id", "y")


# --- metrics ---------------------------------------------------------------------------------------------

PREDICTED = SCORED.replace(" FROM orders)", " FROM orders),") + """
pred AS (SELECT *, CAST(score > 300 AS INTEGER) AS p FROM scored),
side AS (
  SELECT label, count(*) FILTER (y = label) AS support, count(*) FILTER (p = label) AS claimed,
         count(*) FILTER (y = label AND p = label) AS hits
  FROM pred, (SELECT unnest([0, 1]) AS label) GROUP BY label),
classes AS (
  SELECT label, support, hits,
         CASE WHEN claimed = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / claimed END AS precision,
         CASE WHEN support = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / support END AS recall,
         CASE WHEN claimed + support = 0 THEN 0.0
              ELSE CAST(2 * hits AS DOUBLE) / (claimed + support) END AS f1
  FROM side)
"""


def _predicted(t: Tables) -> DataFrame:
    return t.scored().withColumn("p", (F.col("score") > 300).cast("int"))


@query(
    "confusion_matrix",
    sql=with_(PREDICTED) + """
    SELECT a.label AS actual, b.label AS predicted,
           (SELECT count(*) FROM pred WHERE y = a.label AND p = b.label) AS n
    FROM classes a, classes b""",
)
def _(t: Tables) -> DataFrame:
    return metrics.confusion_matrix(_predicted(t), "y", "p")


@query(
    "classification_metrics",
    sql=with_(PREDICTED) + f"""
    SELECT {r('sum(hits) / CAST(sum(support) AS DOUBLE)', 4)} AS accuracy,
           {r('avg(precision)', 4)} AS precision_macro, {r('avg(recall)', 4)} AS recall_macro,
           {r('avg(f1)', 4)} AS f1_macro FROM classes""",
)
def _(t: Tables) -> DataFrame:
    return metrics.classification_metrics(_predicted(t), "y", "p")


def _weighted(m: str) -> str:
    return r(f"sum({m} * support) / sum(support)") + f" AS {m}"


@query(
    "classification_report",
    sql=with_(PREDICTED) + f"""
    SELECT CAST(label AS VARCHAR) AS label, {r('precision')} AS precision, {r('recall')} AS recall,
           {r('f1')} AS f1, support FROM classes
    UNION ALL SELECT 'accuracy', {', '.join([r('sum(hits) / CAST(sum(support) AS DOUBLE)')] * 3)},
           CAST(sum(support) AS BIGINT) FROM classes
    UNION ALL SELECT 'macro avg', {r('avg(precision)')}, {r('avg(recall)')}, {r('avg(f1)')},
           CAST(sum(support) AS BIGINT) FROM classes
    UNION ALL SELECT 'weighted avg', {_weighted('precision')}, {_weighted('recall')},
           {_weighted('f1')}, CAST(sum(support) AS BIGINT) FROM classes""",
)
def _(t: Tables) -> DataFrame:
    return metrics.classification_report(_predicted(t), "y", "p")


STEPS = SCORED.replace(" FROM orders)", " FROM orders),") + """
steps AS (
  SELECT score AS threshold, sum(y) AS pos, count(*) - sum(y) AS neg FROM scored GROUP BY score),
cum AS (
  SELECT *, sum(pos) OVER (ORDER BY threshold DESC) AS tp,
         sum(neg) OVER (ORDER BY threshold DESC) AS fp,
         sum(pos) OVER () AS p_all, sum(neg) OVER () AS n_all FROM steps)
"""


@query(
    "roc_auc",
    sql=with_(SCORED) + f""", ranked AS (
      SELECT y, (count(*) OVER (ORDER BY score) - count(*) OVER (PARTITION BY score))
                + (count(*) OVER (PARTITION BY score) + 1) / 2.0 AS rank FROM scored)
    SELECT {r('''(sum(rank) FILTER (y = 1) - CAST(sum(y) AS DOUBLE) * (sum(y) + 1) / 2)
                 / (CAST(sum(y) AS DOUBLE) * (count(*) - sum(y)))''')} AS roc_auc
    FROM ranked""",
)
def _(t: Tables) -> DataFrame:
    return metrics.roc_auc(t.scored(), "y", "score")


@query(
    "average_precision",
    sql=with_(STEPS) + f"""
    SELECT {r('sum((pos / CAST(p_all AS DOUBLE)) * (tp / CAST(tp + fp AS DOUBLE)))')}
             AS average_precision FROM cum""",
)
def _(t: Tables) -> DataFrame:
    return metrics.average_precision(t.scored(), "y", "score")


@query(
    "roc_curve",
    sql=with_(STEPS) + f"""
    SELECT threshold, {r('fp / CAST(n_all AS DOUBLE)')} AS fpr,
           {r('tp / CAST(p_all AS DOUBLE)')} AS tpr FROM cum
    UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""",
)
def _(t: Tables) -> DataFrame:
    return metrics.roc_curve(t.scored(), "y", "score")


@query(
    "pr_curve",
    sql=with_(STEPS) + f"""
    SELECT threshold, {r('tp / CAST(tp + fp AS DOUBLE)')} AS precision,
           {r('tp / CAST(p_all AS DOUBLE)')} AS recall FROM cum
    UNION ALL SELECT CAST('inf' AS DOUBLE), 1.0, 0.0""",
)
def _(t: Tables) -> DataFrame:
    return metrics.pr_curve(t.scored(), "y", "score")


LEVELS = (100, 200, 300, 400)


@query(
    "leaderboard",
    sql=with_(SCORED) + f""", runs AS (
      SELECT 'over_' || level AS experiment, y, score, CAST(score > level AS INTEGER) AS p
      FROM scored, (SELECT unnest({list(LEVELS)}) AS level)),
    side AS (SELECT experiment, label, count(*) FILTER (y = label) AS support,
                    count(*) FILTER (p = label) AS claimed,
                    count(*) FILTER (y = label AND p = label) AS hits
             FROM runs, (SELECT unnest([0, 1]) AS label) GROUP BY ALL),
    steps AS (SELECT experiment, score, sum(y) AS pos, count(*) - sum(y) AS neg FROM runs
              GROUP BY ALL),
    cum AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
                   sum(pos) OVER (PARTITION BY experiment) AS pa,
                   sum(neg) OVER (PARTITION BY experiment) AS na
            FROM steps WINDOW w AS (PARTITION BY experiment ORDER BY score DESC)),
    curves AS (SELECT experiment,
                      {r('sum(pos * (na - fp + neg / 2.0)) / (CAST(max(pa) AS DOUBLE) * max(na))', 4)}
                        AS roc_auc,
                      {r('sum((pos / CAST(pa AS DOUBLE)) * (tp / CAST(tp + fp AS DOUBLE)))', 4)}
                        AS average_precision
               FROM cum GROUP BY experiment)
    SELECT experiment, {r('sum(hits) / CAST(sum(support) AS DOUBLE)', 4)} AS accuracy,
           {r('avg(CASE WHEN claimed = 0 THEN 0.0 ELSE hits / CAST(claimed AS DOUBLE) END)', 4)}
             AS precision_macro,
           {r('avg(CASE WHEN support = 0 THEN 0.0 ELSE hits / CAST(support AS DOUBLE) END)', 4)}
             AS recall_macro,
           {r('avg(2.0 * hits / CAST(claimed + support AS DOUBLE))', 4)} AS f1_macro,
           any_value(roc_auc) AS roc_auc, any_value(average_precision) AS average_precision
    FROM side JOIN curves USING (experiment) GROUP BY experiment
    ORDER BY f1_macro DESC, accuracy DESC, experiment""",
)
def _(t: Tables) -> DataFrame:
    """Several fixed classifiers ranked against each other."""
    runs = t.scored().withColumn("level", F.explode(F.lit(list(LEVELS)))).select(
        F.concat(F.lit("over_"), "level").alias("experiment"), "y", "score",
        (F.col("score") > F.col("level")).cast("int").alias("p"),
    )
    return metrics.leaderboard(runs, "experiment", "y", "p", "score")


@query(
    "top_importance",
    sql=f"""WITH x AS (SELECT label, unnest(embedding) AS v,
                              generate_subscripts(embedding, 1) - 1 AS d FROM embeddings),
    imp AS (SELECT 'dim_' || d AS feature, {r('abs(corr(label, CAST(v AS DOUBLE)))')}
              AS importance_mean FROM x GROUP BY d)
    SELECT * FROM (SELECT * FROM imp ORDER BY importance_mean DESC, feature LIMIT 15)
    ORDER BY importance_mean, feature DESC""",
)
def _(t: Tables) -> DataFrame:
    """Vector dimensions by the strength of their correlation with the label."""
    long = t.read("embeddings").select(F.col("label"), F.posexplode("embedding").alias("d", "v"))
    strength = long.groupBy(F.concat(F.lit("dim_"), "d").alias("feature")).agg(
        S.half_even(F.abs(F.corr("label", F.col("v").cast("double"))), 6).alias("importance_mean")
    )
    return importance.most_important(strength)


# --- neighbours -----------------------------------------------------------------------------------------

NEAREST = """
near AS (
  SELECT a.vec_id AS query_id, b.vec_id AS point_id, b.label AS label,
         round(1 - list_cosine_similarity(CAST(a.embedding AS DOUBLE[]),
                                          CAST(b.embedding AS DOUBLE[])), 12) AS distance
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
  QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY distance, b.vec_id) <= 15)
"""


def _vectors(t: Tables) -> DataFrame:
    return t.read("embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label"
    )


def _nearest(t: Tables) -> DataFrame:
    vectors = _vectors(t)
    return neighbours.nearest(vectors, vectors, 15, same_table=True)


@query(
    "knn_cosine",
    sql=with_(NEAREST) + f"SELECT query_id, point_id, {r('distance')} AS distance FROM near",
)
def _(t: Tables) -> DataFrame:
    return _nearest(t).withColumn("distance", S.half_even(F.col("distance"), 6))


@query(
    "knn_text",
    sql="WITH " + VOCABULARY + f""",
    tf AS (SELECT doc_id, term_id, count(*) * (ln((1 + (SELECT count(*) FROM documents))
             / CAST(1 + doc_freq AS DOUBLE)) + 1) AS raw
           FROM terms JOIN vocab USING (term) GROUP BY doc_id, term_id, doc_freq),
    unit AS (SELECT doc_id, term_id, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS w
             FROM tf),
    meeting AS (SELECT a.doc_id AS query_id, b.doc_id AS point_id, sum(a.w * b.w) AS cosine
                FROM unit a JOIN unit b USING (term_id) GROUP BY ALL),
    ids AS (SELECT DISTINCT doc_id FROM unit),
    pairs AS (SELECT a.doc_id AS query_id, b.doc_id AS point_id,
                     round(1 - coalesce(cosine, 0), 12) AS distance
              FROM ids a JOIN ids b ON a.doc_id <> b.doc_id
              LEFT JOIN meeting m ON m.query_id = a.doc_id AND m.point_id = b.doc_id)
    SELECT query_id, point_id, {r('distance')} AS distance FROM pairs
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, point_id) <= 15""",
)
def _(t: Tables) -> DataFrame:
    """The 15 nearest documents by TF-IDF of every document that holds a term."""
    docs = t.documents()
    vocab = cut(G.vocabulary(docs, "text", pattern=ASCII_WORDS))
    n = t.read("documents").agg(F.count(F.lit(1))).scalar()
    weights = G.tfidf(docs, "doc_id", "text", vocab, n, pattern=ASCII_WORDS)
    # at most max_features terms a document
    entries = F.sort_array(F.collect_list(F.struct("term_id", "weight")))
    vectors = weights.groupBy("doc_id").agg(entries.alias("e")).select(
        "doc_id",
        F.struct(
            F.lit(fv.MAX_FEATURES).alias("width"), F.col("e.term_id").alias("indices"),
            F.col("e.weight").alias("values"),
        ).alias("vec"),
    )
    vectors = cut(vectors)
    near = neighbours.nearest(vectors, vectors, 15, key="doc_id", same_table=True)
    return near.withColumn("distance", S.half_even(F.col("distance"), 6))


@query(
    "knn_vote",
    sql=with_(NEAREST) + f""", uniform AS (
      SELECT query_id, label, CAST(count(*) AS DOUBLE) AS w FROM near GROUP BY ALL),
    zeroed AS (SELECT *, max(CAST(distance <= 0 AS INTEGER)) OVER (PARTITION BY query_id) AS z
               FROM near),
    near_w AS (
      SELECT query_id, label, sum(CASE WHEN z = 1 THEN CAST(distance <= 0 AS INTEGER)
                                       ELSE 1 / distance END) AS w
      FROM zeroed GROUP BY ALL),
    votes AS (SELECT 'uniform' AS weights, * FROM uniform
              UNION ALL SELECT 'distance', * FROM near_w)
    SELECT weights, query_id, label AS prediction,
           {r('w / sum(w) OVER (PARTITION BY weights, query_id)')} AS share
    FROM votes QUALIFY row_number() OVER (PARTITION BY weights, query_id
                                          ORDER BY round(w, 9) DESC, label) = 1""",
)
def _(t: Tables) -> DataFrame:
    vectors, found = _vectors(t), _nearest(t)
    result = None
    for weights in ("uniform", "distance"):
        votes = neighbours.vote(found, vectors, weights).select(
            F.lit(weights).alias("weights"), "query_id", "prediction",
            S.half_even(F.col("share"), 6).alias("share"),
        )
        result = votes if result is None else result.unionByName(votes)
    return result


# Settings of the registered learners: see "Open" in the README.
RF_TREES, RF_DEPTH = 200, 8

# --- learners --------------------------------------------------------------------------------------------


def _prepared(t: Tables, part_rows: int = PART_ROWS) -> tuple[DataFrame, DataFrame, list]:
    parted = split.stratified_split(_model_rows(t), "review_id", "target_five_star")
    rows = cut(dealt(parted, "review_id", t.read("orders").count(), part_rows))
    weighted = G.with_class_weight(rows.filter(~F.col("is_test")), "target_five_star").withColumn(
        "is_validation", F.pmod(F.xxhash64("review_id"), F.lit(10)) == 0
    )
    stages = [
        learning.TableEncoder(META_NUMERIC, META_CATEGORICAL),
        VectorAssembler(inputCols=["table"], outputCol="features"),
    ]
    return weighted, rows.filter("is_test"), stages


# The rows that the split keeps for the test, and what must hold for every answer on them.
TESTED = with_(SCORED) + """, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5('42:' || review_id), review_id) AS k,
         count(*) OVER (PARTITION BY y) AS n FROM scored)
SELECT review_id, y AS target_five_star, true AS score_in_range, true AS score_agrees
FROM ranked WHERE k <= ceil(n * 0.2)"""


def _answers(t: Tables, model, part_rows: int = PART_ROWS) -> DataFrame:
    train, test, stages = _prepared(t, part_rows)
    fitted = Pipeline(stages=[*stages, model]).fit(train)
    answers = learning.positive_score(fitted.transform(test))
    return answers.select(
        "review_id", "target_five_star",
        F.col("score").between(0, 1).alias("score_in_range"),
        # the class with the larger score is the one predicted
        (F.col("prediction") == (F.col("score") > 0.5).cast("double")).alias("score_agrees"),
    )


@query("rf_predict", sql=TESTED)
def _(t: Tables) -> DataFrame:
    return _answers(t, learning.forest("target_five_star", numTrees=RF_TREES, maxDepth=RF_DEPTH))


@query("gbt_predict", sql=TESTED)
def _(t: Tables) -> DataFrame:
    model = learning.boosted("target_five_star", validation="is_validation")
    return _answers(t, model, BOOSTED_ROWS)


@query("gbt_weighted", sql=TESTED)
def _(t: Tables) -> DataFrame:
    model = learning.boosted(
        "target_five_star", maxIter=200, maxDepth=4, subsamplingRate=0.8,
        featureSubsetStrategy="0.8",
    )
    return _answers(t, model, BOOSTED_ROWS)


def _grid_sql(name: str, grid: dict, folds: int) -> str:
    """Every grid point with its folds; the best of them is the maximum."""
    points = [json.dumps(p, sort_keys=True) for p in X.grid_points(grid)]
    rows = ", ".join(f"('{name}', '{p}', {folds}, true)" for p in points)
    return f"SELECT * FROM (VALUES {rows}) AS v(experiment, params, folds, score_in_range)"


def _searched(t: Tables, spec: X.Experiment, folds: int) -> DataFrame:
    search = X.Search(spec, "review_id", "target_five_star")
    fitted = search.fit(_model_rows(t), folds=folds)
    return search.results(t.spark, fitted)


TABLE_KNN = X.Experiment("table_knn", "knn", fv.KNN_GRID, META_NUMERIC, META_CATEGORICAL)


@query("grid_search", sql=_grid_sql("table_knn", fv.KNN_GRID, fv.CV_FOLDS))
def _(t: Tables) -> DataFrame:
    """The whole neighbour grid over all folds."""
    found = _searched(t, TABLE_KNN, fv.CV_FOLDS)
    return found.select(
        "experiment", "params", "folds", F.col("f1_macro").between(0, 1).alias("score_in_range")
    )


@query(
    "random_search",
    sql=f"SELECT 'table_rf' AS experiment, {fv.CV_FOLDS} AS folds, CAST(10 AS BIGINT) AS points, "
        "CAST(10 AS BIGINT) AS distinct_points, CAST(10 AS BIGINT) AS of_the_grid, "
        "true AS score_in_range",
)
def _(t: Tables) -> DataFrame:
    """Ten draws from the grid, none twice, over all folds."""
    spec = X.Experiment(
        "table_rf", "rf", fv.FOREST_GRID, META_NUMERIC, META_CATEGORICAL, draws=10
    )
    known = [json.dumps(p, sort_keys=True) for p in X.grid_points(fv.FOREST_GRID)]
    return _searched(t, spec, fv.CV_FOLDS).groupBy("experiment", "folds").agg(
        F.count(F.lit(1)).alias("points"), F.count_distinct("params").alias("distinct_points"),
        F.count_if(F.col("params").isin(known)).alias("of_the_grid"),
        F.bool_and(F.col("f1_macro").between(0, 1)).alias("score_in_range"),
    )


_USED = [*META_NUMERIC, *META_CATEGORICAL]


@query(
    "permutation_importance",
    sql="SELECT * FROM (VALUES " + ", ".join(
        f"('{c}', true, {'true' if c == 'rating' else 'NULL'})" for c in [*_USED, "rating"]
    ) + ") AS v(feature, in_range, nothing_lost)",
)
def _(t: Tables) -> DataFrame:
    """Every column of the model, and one that it does not read and so loses nothing by."""
    train, test, stages = _prepared(t)
    model = learning.forest("target_five_star", numTrees=RF_TREES, maxDepth=RF_DEPTH)
    fitted = Pipeline(stages=[*stages, model]).fit(train)
    lost = importance.permutation_importance(
        fitted, test, "review_id", "target_five_star", [*_USED, "rating"]
    )
    zero = (F.col("importance_mean") == 0) & (F.col("importance_std") == 0)
    return lost.select(
        "feature", F.col("importance_mean").between(-1, 1).alias("in_range"),
        F.when(F.col("feature") == "rating", zero).alias("nothing_lost"),
    )
