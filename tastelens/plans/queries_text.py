"""Queries on lexicon sentiment, emotions, valence and their summaries."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastelens import fixed_values as fv
from tastelens.functions import lexicon as L
from tastelens.functions import text as X
from tastelens.operators import sentiment
from tastelens.operators import summaries as E
from tastelens.plans.registry import FEATURES, HITS, LEX, TOKENS, query, r, with_, words
from tastelens.session import cut, scratch_path
from tastelens.sources.lexicons import LexiconTables, as_tables, builtin_table, lexicon_table, one_row_per_word
from tastelens.sources.tables import Tables
from tastelens.streaming import reviews as streaming

POLARITY = ", ".join(sentiment.polarity_columns())
SHORT = list(fv.SHORT_EMOTIONS.values())
RATIOS = [f"{e}_ratio" for e in SHORT]
EMOTIONS = ", ".join(
    ["dominant_emotion"] + [f"nrc_{c}_count" for c in fv.SIDE_CLASSES]
    + [f"{e}_count" for e in SHORT] + RATIOS
)


@query("lexicon_features", sql=with_(FEATURES) + f"SELECT review_id, {POLARITY} FROM feat")
def lexicon_features(t: Tables) -> DataFrame:
    """Negation-aware lexicon sentiment of every document."""
    lex = t.lexicons
    scored = t.documents().select(
        F.col("doc_id").alias("review_id"),
        L.lexicon_sentiment(
            X.tokenize(F.col("text")), lex.positive, lex.negative, lex.negations
        ).alias("s"),
    )
    return scored.select("review_id", "s.*")


@query(
    "lexicon_features_joined",
    sql=with_(FEATURES) + f"SELECT review_id, {POLARITY} FROM feat",
)
def _(t: Tables) -> DataFrame:
    """The same through a join, as used for lexicons too large to inline."""
    docs = t.documents().withColumnRenamed("doc_id", "review_id")
    return sentiment.score_by_join(docs, lexicon_table(t.spark, t.lexicons), "review_id", "text")


@query("emotion_features", sql=with_(FEATURES) + f"SELECT review_id, {EMOTIONS} FROM feat")
def _(t: Tables) -> DataFrame:
    found = t.documents().select(
        F.col("doc_id").alias("review_id"),
        L.emotion_profile(X.tokenize(F.col("text")), t.lexicons.emotions).alias("e"),
    )
    return found.select("review_id", "e.*")


@query("emotion_features_joined", sql=with_(FEATURES) + f"SELECT review_id, {EMOTIONS} FROM feat")
def _(t: Tables) -> DataFrame:
    docs = t.documents().withColumnRenamed("doc_id", "review_id")
    pairs = [(w, c) for c, ws in t.lexicons.emotions.items() for w in ws]
    lexicon = t.spark.createDataFrame(pairs, "word string, emotion string").groupBy("word").agg(
        F.collect_set("emotion").alias("emotions")
    )
    return sentiment.emotions_by_join(docs, lexicon, "review_id", "text")


@query(
    "dominant_emotion",
    sql=with_(FEATURES) + """SELECT dominant_emotion, count(*) AS count FROM feat GROUP BY 1
                             ORDER BY count DESC, dominant_emotion""",
)
def _(t: Tables) -> DataFrame:
    found = t.documents().select(
        L.emotion_profile(X.tokenize(F.col("text")), t.lexicons.emotions)[
            "dominant_emotion"
        ].alias("dominant_emotion")
    )
    return E.value_counts(found, "dominant_emotion").orderBy(F.desc("count"), "dominant_emotion")


@query(
    "text_features_inline",
    sql=with_(FEATURES) + f"""SELECT review_id, token_count, unique_token_count, {POLARITY},
                              {EMOTIONS} FROM feat""",
)
def _(t: Tables) -> DataFrame:
    """Short lists compiled into the row."""
    docs = t.documents().select(F.col("doc_id").alias("review_id"), "text")
    return sentiment.with_text_features(docs, t.lexicons, "text", valence=False).drop("text")


_TABLE_WORDS = words(LEX.valence)
_VALENCE_OF = (
    "CASE low " + " ".join(f"WHEN '{w}' THEN CAST({v} AS DOUBLE)" for w, v in LEX.valence.items())
    + " END"
)
_PUNCTUATION = string.punctuation.replace("'", "''")


def _look_back(source: str, back: int, damping: float) -> str:
    """SQL for one step of looking ``back`` words behind a scored word."""
    push = (
        f"CASE WHEN low{back} IN {words(LEX.intensifiers)} THEN 0.293 "
        f"WHEN low{back} IN {words(fv.DAMPENERS)} THEN -0.293 END"
    )
    between = [f"low{b}" for b in range(1, back)]
    so = " OR ".join(f"coalesce({b} IN ('so', 'this'), false)" for b in between) or "false"
    doubt = " OR ".join(f"coalesce({b} = 'doubt', false)" for b in between) or "false"
    sign = "CASE WHEN v < 0 THEN -1 ELSE 1 END"
    return f"""
    step{back}a AS (
      SELECT *, v + coalesce({push} * ({sign})
               + CASE WHEN mixed AND loud{back} THEN 0.733 * ({sign}) ELSE 0 END, 0) * {damping}
               AS pushed,
             low{back} IS NOT NULL AND low{back} NOT IN {_TABLE_WORDS} AS plain FROM {source}),
    step{back} AS (
      SELECT * EXCLUDE (v, pushed, plain),
             CASE WHEN NOT plain THEN v
                  WHEN low{back} = 'never' AND ({so}) THEN pushed * 1.25
                  WHEN low{back} = 'without' AND ({doubt}) THEN pushed
                  WHEN low{back} IN {words(LEX.negations)} OR low{back} LIKE '%n''t'
                    THEN pushed * -0.74
                  ELSE pushed END AS v
      FROM step{back}a)"""


VALENCE_SQL = f"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '') AS ws
  FROM documents),
word AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM split),
cut AS (SELECT doc_id, pos, CASE WHEN length(trim(w, '{_PUNCTUATION}')) <= 2 THEN w
                                 ELSE trim(w, '{_PUNCTUATION}') END AS w FROM word),
cased AS (SELECT *, lower(w) AS low, w = upper(w) AND w <> lower(w) AS loud FROM cut),
seen AS (
  SELECT *, {", ".join(f"lag(low, {b}) OVER d AS low{b}, lag(loud, {b}) OVER d AS loud{b}" for b in (1, 2, 3))},
         bool_or(loud) OVER (PARTITION BY doc_id) AND bool_or(NOT loud) OVER (PARTITION BY doc_id)
           AS mixed,
         coalesce(low || ' ' || lead(low) OVER d, '') AS opens,
         min(CASE WHEN low = 'but' THEN pos END) OVER (PARTITION BY doc_id) AS but_at
  FROM cased WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
step0 AS (
  SELECT *, {_VALENCE_OF} + CASE WHEN mixed AND loud
              THEN 0.733 * CASE WHEN {_VALENCE_OF} < 0 THEN -1 ELSE 1 END ELSE 0 END AS v
  FROM seen),
{_look_back("step0", 1, 1.0)},{_look_back("step1", 2, 0.95)},{_look_back("step2", 3, 0.9)},
scored AS (
  SELECT doc_id, CASE WHEN v IS NULL OR low IN {words([*LEX.intensifiers, *fv.DAMPENERS])}
                       OR opens IN {words(fv.DAMPENING_PHRASES)} THEN 0
         ELSE (v + CASE WHEN low3 IS NOT NULL AND low3 NOT IN {_TABLE_WORDS}
                        THEN -0.293 * (CAST(low3 || ' ' || low2 IN {words(fv.DAMPENING_PHRASES)} AS INTEGER)
                             + CAST(low2 || ' ' || low1 IN {words(fv.DAMPENING_PHRASES)} AS INTEGER))
                        ELSE 0 END) * CASE WHEN low1 = 'least' AND coalesce(low2, '') NOT IN ('at', 'very') THEN -0.74
                       ELSE 1 END
                * CASE WHEN but_at IS NULL OR pos = but_at THEN 1 WHEN pos < but_at THEN 0.5
                       ELSE 1.5 END END AS s
  FROM step3),
marks AS (
  SELECT doc_id, least(length(text) - length(replace(text, '!', '')), 4) * 0.292
           + CASE WHEN length(text) - length(replace(text, '?', '')) > 3 THEN 0.96
                  WHEN length(text) - length(replace(text, '?', '')) > 1
                    THEN (length(text) - length(replace(text, '?', ''))) * 0.18
                  ELSE 0 END AS mark FROM documents),
sums AS (
  SELECT doc_id, any_value(mark) AS mark, coalesce(sum(s), 0) AS total, count(s) AS n,
         coalesce(sum(s + 1) FILTER (s > 0), 0) AS up, coalesce(sum(1 - s) FILTER (s < 0), 0) AS down,
         count(*) FILTER (s = 0) AS flat
  FROM marks LEFT JOIN scored USING (doc_id) GROUP BY doc_id),
raised AS (
  SELECT doc_id, n, total + CASE WHEN total > 0 THEN mark WHEN total < 0 THEN -mark ELSE 0 END AS t,
         up + CASE WHEN up > down THEN mark ELSE 0 END AS up,
         down + CASE WHEN down > up THEN mark ELSE 0 END AS down, flat FROM sums)
SELECT doc_id AS review_id,
       {r("CASE WHEN n = 0 THEN 0 ELSE t / sqrt(t * t + 15) END", 4)} AS vader_compound,
       {r("CASE WHEN n = 0 THEN 0 ELSE down / (up + down + flat) END", 3)} AS vader_neg,
       {r("CASE WHEN n = 0 THEN 0 ELSE flat / (up + down + flat) END", 3)} AS vader_neu,
       {r("CASE WHEN n = 0 THEN 0 ELSE up / (up + down + flat) END", 3)} AS vader_pos
FROM raised"""


VALENCE = "vader_compound, vader_neg, vader_neu, vader_pos"


@query("valence_features_inline", sql=VALENCE_SQL)
def _(t: Tables) -> DataFrame:
    """The full valence rules, the table compiled into the row."""
    lex = t.lexicons
    scored = t.documents().select(
        F.col("doc_id").alias("review_id"),
        L.valence_profile(F.col("text"), lex.valence, lex.negations, lex.intensifiers).alias("v"),
    )
    return scored.select("review_id", "v.*")


@query(
    "text_features",
    sql=with_(FEATURES) + f"""SELECT review_id, token_count, unique_token_count, {VALENCE},
      {POLARITY}, {EMOTIONS} FROM feat_text JOIN ({VALENCE_SQL}) USING (review_id)""".replace(
        "feat_text", f"(SELECT review_id, token_count, unique_token_count, {POLARITY}, {EMOTIONS} FROM feat)"
    ),
)
def _(t: Tables) -> DataFrame:
    """All text features, lexicons and valences joined as tables."""
    docs = t.documents().select(F.col("doc_id").alias("review_id"), "text")
    tables = as_tables(t.spark, t.lexicons)
    return sentiment.with_text_features(docs, tables, "text").drop("text")


@query("valence_features", sql=VALENCE_SQL)
def _(t: Tables) -> DataFrame:
    """The full valence rules with the valences as a table."""
    docs = t.documents().select(F.col("doc_id").alias("review_id"), "text")
    tables = as_tables(t.spark, t.lexicons)
    return sentiment.valence_by_join(docs, tables, "text").drop("text")


LARGE_LEXICON = TOKENS + """,
word AS (SELECT DISTINCT unnest(tokens) AS word FROM tok),
lexicon AS (
  SELECT word, length(word) % 2 = 0 AS up, length(word) % 3 = 0 AS down, length(word) = 2 AS turns
  FROM (SELECT word FROM word UNION ALL
        SELECT word || n FROM word, (SELECT unnest(range(2)) AS n))),
spot AS (SELECT review_id, unnest(tokens) AS word, generate_subscripts(tokens, 1) AS pos FROM tok),
hit AS (
  SELECT *, coalesce(pos - max(CASE WHEN turns THEN pos END) OVER (PARTITION BY review_id
             ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 3, false) AS flip
  FROM spot JOIN lexicon USING (word)),
counted AS (
  SELECT review_id, count(*) FILTER (CASE WHEN flip THEN down ELSE up END) AS p,
         count(*) FILTER (CASE WHEN flip THEN up ELSE down END) AS n,
         count(*) FILTER (flip AND (up OR down)) AS turned
  FROM hit GROUP BY review_id)
"""


@query(
    "large_lexicon",
    sql="WITH " + LARGE_LEXICON + """
    SELECT CASE WHEN review_id % 7 = 0 THEN NULL ELSE review_id % 50 END AS place,
           (SELECT count(*) FROM lexicon) AS words, coalesce(p, 0) AS lexicon_positive_count,
           coalesce(n, 0) AS lexicon_negative_count, coalesce(turned, 0) AS lexicon_negated_hits
    FROM tok LEFT JOIN counted USING (review_id)""",
)
def _(t: Tables) -> DataFrame:
    """A lexicon beyond any broadcast, with repeated words, on rows whose keys repeat or miss."""
    docs = t.documents()
    found = docs.select(F.explode(X.tokenize(F.col("text"))).alias("word")).distinct()
    endings = F.explode(F.sequence(F.lit(0), F.lit(1)))
    made = found.select("word", endings.alias("n")).select(F.concat("word", "n").alias("word"))
    # every found word is in it twice, its two flags in different rows
    length, no = F.length("word"), F.lit(False)
    rows = [
        (length % 2 == 0, no, no), (no, length % 3 == 0, length == 2),
    ]
    every = found.unionByName(made)
    lexicon = None
    for up, down, turns in rows:
        part = every.select(
            "word", up.alias("is_pos"), down.alias("is_neg"), turns.alias("is_negation"),
            F.lit(None).cast("array<string>").alias("emotions"),
        )
        lexicon = part if lexicon is None else lexicon.unionByName(part)
    # read three times below
    words_table = cut(one_row_per_word(lexicon))
    keyed = docs.select(
        F.when(F.col("doc_id") % 7 != 0, F.col("doc_id") % 50).alias("place"), "text"
    )
    tables = LexiconTables(words_table, as_tables(t.spark, t.lexicons).valence)
    scored = sentiment.with_text_features(keyed, tables, "text", valence=False)
    size = words_table.agg(F.count(F.lit(1))).scalar()
    return scored.select(
        "place", size.alias("words"), "lexicon_positive_count", "lexicon_negative_count",
        "lexicon_negated_hits",
    )


@query(
    "valence_core",
    sql=with_(FEATURES) + """SELECT review_id, valence_sum, vader_compound FROM feat""",
)
def _(t: Tables) -> DataFrame:
    """Plain valence sum and its compound, without the context rules."""
    total = L.valence_sum(X.tokenize(F.col("text")), t.lexicons.valence)
    summed = t.documents().select(F.col("doc_id").alias("review_id"), total.alias("valence_sum"))
    return summed.withColumn(
        "vader_compound", F.bround(L.compound(F.col("valence_sum")), 4) + F.lit(0.0)
    )


@query(
    "intensifier_count",
    sql=with_(TOKENS) + f"""
    SELECT review_id, len(list_filter(tokens, lambda w: w IN {words(LEX.intensifiers)}))
             AS intensifiers FROM tok""",
)
def _(t: Tables) -> DataFrame:
    return t.documents().select(
        F.col("doc_id").alias("review_id"),
        L.intensifier_count(X.tokenize(F.col("text")), t.lexicons.intensifiers).alias(
            "intensifiers"
        ),
    )


@query(
    "token_lexicon_join",
    sql=with_(HITS) + f"""
    SELECT token, up, down, token IN {words(LEX.negations)} AS is_negation, count(*) AS hits,
           count(DISTINCT review_id) AS reviews
    FROM flagged WHERE up OR down OR token IN {words(LEX.negations)} GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    hits = sentiment.match_tokens(
        t.documents(), lexicon_table(t.spark, t.lexicons), "doc_id", "text"
    )
    # one row per (token, document) first: frequent words shrink before they are counted
    slim = hits.groupBy("token", "is_pos", "is_neg", "is_negation", "doc_id").agg(E.rows("n"))
    return slim.groupBy(
        "token", F.col("is_pos").alias("up"), F.col("is_neg").alias("down"), "is_negation"
    ).agg(F.sum("n").alias("hits"), E.rows("reviews"))


_BUILTIN_LISTS = {
    "positive": fv.POSITIVE_WORDS, "negative": fv.NEGATIVE_WORDS, "negation": fv.NEGATIONS,
    "intensifier": fv.INTENSIFIERS, **fv.EMOTION_WORDS,
}
_BUILTIN_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS list, unnest(["
    + ", ".join("'" + w.replace("'", "''") + "'" for w in ws)
    + "]) AS word"
    for name, ws in _BUILTIN_LISTS.items()
)


@query(
    "builtin_lexicons",
    sql=with_(TOKENS) + f""", lists AS ({_BUILTIN_ROWS}),
    seen AS (SELECT unnest(tokens) AS word FROM tok)
    SELECT list, count(DISTINCT lists.word) AS words, count(seen.word) AS hits,
           count(DISTINCT seen.word) AS words_seen
    FROM lists LEFT JOIN seen USING (word) GROUP BY list""",
)
def _(t: Tables) -> DataFrame:
    """Size of every built-in list and its hits in the documents."""
    return sentiment.list_hits(t.documents(), builtin_table(t.spark), "doc_id", "text")


@query("stream_features", sql=with_(FEATURES) + f"SELECT review_id, {POLARITY} FROM feat")
def _(t: Tables) -> DataFrame:
    """The flagship on a stream of document files, run until all of them are read."""
    path = scratch_path(t.spark, "stream")
    arriving = streaming.read_stream(
        t.spark, f"{t.folder}/documents*.parquet", t.read("documents").schema
    )
    lex = t.lexicons
    scored = arriving.select(
        F.col("doc_id").alias("review_id"),
        L.lexicon_sentiment(
            X.tokenize(F.col("text")), lex.positive, lex.negative, lex.negations
        ).alias("s"),
    ).select("review_id", "s.*")
    streaming.write_stream(scored, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return t.spark.read.schema(scored.schema).parquet(f"{path}/rows")


# --- summaries -------------------------------------------------------------------------------------


@query(
    "sentiment_by_rating",
    sql=with_(FEATURES) + f"""
    SELECT rating, count(review_id) AS review_count,
           {r('avg(lexicon_sentiment_score)', 4)} AS avg_lexicon_score,
           {r('avg(vader_compound)', 4)} AS avg_vader_compound,
           {r('avg(lexicon_positive_count)', 4)} AS avg_positive_count,
           {r('avg(lexicon_negative_count)', 4)} AS avg_negative_count
    FROM feat GROUP BY rating""",
)
def sentiment_by_rating(t: Tables) -> DataFrame:
    return E.sentiment_by_rating(t.sentiments())


def _means(keys: str, digits: int = 4) -> str:
    return f"SELECT {keys}, " + ", ".join(f"{r(f'avg({c})', digits)} AS {c}" for c in RATIOS)


@query("emotion_by_rating", sql=with_(FEATURES) + _means("rating") + " FROM feat GROUP BY rating")
def _(t: Tables) -> DataFrame:
    return E.mean_by(t.sentiments(), "rating", RATIOS, digits=4)


@query(
    "emotion_by_target",
    sql=with_(FEATURES) + _means("target_five_star", 6) + " FROM feat GROUP BY target_five_star",
)
def _(t: Tables) -> DataFrame:
    return E.mean_by(t.sentiments(), "target_five_star", RATIOS, digits=6)


@query(
    "sentiment_overview",
    sql=with_(FEATURES) + f"""
    SELECT count(*) AS reviews, {r('avg(lexicon_sentiment_score)', 4)} AS mean_score,
           {r("avg(CAST(lexicon_sentiment_label = 'positive' AS INTEGER))", 4)} AS positive_share,
           {r("avg(CAST(lexicon_sentiment_label = 'negative' AS INTEGER))", 4)} AS negative_share
    FROM feat""",
)
def _(t: Tables) -> DataFrame:
    return E.sentiment_overview(t.sentiments())


@query(
    "corr_targets",
    sql=with_(FEATURES)
    + " UNION ALL ".join(
        f"SELECT '{target}' AS target, "
        + ", ".join(
            f"{r(f'corr({target}, {c})', 4)} AS {c}" for c in fv.CORRELATION_FEATURES
        )
        + ", CAST(NULL AS DOUBLE) AS constant FROM feat"
        for target in fv.CORRELATION_TARGETS
    ),
)
def _(t: Tables) -> DataFrame:
    """Correlation of both targets with every feature and with a constant."""
    data = t.sentiments().withColumn("constant", F.lit(1.0))
    return E.correlations(
        data, fv.CORRELATION_TARGETS, [*fv.CORRELATION_FEATURES, "constant"]
    )


@query(
    "label_mix_by_rating",
    sql=with_(FEATURES) + "SELECT rating, " + ", ".join(
        f"{r(f'''count(*) FILTER (lexicon_sentiment_label = '{x}') / CAST(count(*) AS DOUBLE)''')}"
        f" AS {x}" for x in ("negative", "neutral", "positive")
    ) + " FROM feat GROUP BY rating",
)
def _(t: Tables) -> DataFrame:
    mix = E.label_mix(t.sentiments())
    return mix.select(
        "rating",
        *((F.bround(x, 6) + F.lit(0.0)).alias(x) for x in ("negative", "neutral", "positive")),
    )


@query(
    "boxplot_score_by_rating",
    sql=with_(FEATURES) + f""",
    box AS (SELECT rating, count(*) AS n, quantile_cont(lexicon_sentiment_score, 0.25) AS q1,
                   quantile_cont(lexicon_sentiment_score, 0.5) AS median,
                   quantile_cont(lexicon_sentiment_score, 0.75) AS q3 FROM feat GROUP BY rating)
    SELECT rating, n, {r('q1')} AS q1, {r('median')} AS median, {r('q3')} AS q3,
           min(lexicon_sentiment_score) AS whisker_low, max(lexicon_sentiment_score) AS whisker_high
    FROM feat JOIN box USING (rating)
    WHERE lexicon_sentiment_score BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
    GROUP BY rating, n, q1, median, q3""",
)
def _(t: Tables) -> DataFrame:
    """Spread of the sentiment score per rating."""
    box = E.box_plot(t.sentiments(), "rating", "lexicon_sentiment_score")
    return box.withColumns(
        {c: F.bround(c, 6) + F.lit(0.0) for c in ("q1", "median", "q3")}
    )


def _melted(keys: str, columns, labels, name: str, value: str, label: str, digits: int) -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}, '{c}' AS {name}, {r(f'avg({c})', digits)} AS {value}, "
        f"'{labels[c]}' AS {label} FROM feat GROUP BY {keys}"
        for c in columns
    )


@query(
    "melt_sentiment",
    sql=with_(FEATURES)
    + _melted("rating", fv.METRIC_LABELS, fv.METRIC_LABELS, "metric", "score", "metric_label", 12),
)
def _(t: Tables) -> DataFrame:
    wide = E.mean_by(t.sentiments(), "rating", list(fv.METRIC_LABELS), digits=12)
    return E.melt(
        wide, ["rating"], list(fv.METRIC_LABELS), "metric", "score", fv.METRIC_LABELS,
        "metric_label",
    )


@query(
    "melt_emotion",
    sql=with_(FEATURES)
    + _melted("rating", RATIOS, fv.EMOTION_LABELS, "emotion", "ratio", "emotion_label", 6),
)
def _(t: Tables) -> DataFrame:
    wide = E.mean_by(t.sentiments(), "rating", RATIOS, digits=6)
    return E.melt(
        wide, ["rating"], RATIOS, "emotion", "ratio", fv.EMOTION_LABELS, "emotion_label"
    )


@query(
    "melt_emotion_by_target",
    sql=with_(FEATURES)
    + _melted("target_five_star", RATIOS, fv.EMOTION_LABELS, "emotion", "ratio", "emotion_label",
              6),
)
def _(t: Tables) -> DataFrame:
    wide = E.mean_by(t.sentiments(), "target_five_star", RATIOS, digits=6)
    return E.melt(
        wide, ["target_five_star"], RATIOS, "emotion", "ratio", fv.EMOTION_LABELS, "emotion_label"
    )


