"""Registered queries: a Spark function and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tastelens.sources.tables import PROSE_LEXICONS, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(tables)`` under a name, with its SQL."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(spark, folder))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return build

    return register


def r(expression: str, digits: int = 6) -> str:
    """SQL for rounding half to even without negative zeros."""
    return f"(round_even(CAST({expression} AS DOUBLE), {digits}) + 0.0)"


def words(items) -> str:
    return "(" + ", ".join(f"'{w}'" for w in items) + ")"


LEX = PROSE_LEXICONS

META = """
meta AS (
  SELECT o_orderkey AS review_id, o_custkey AS restaurant_entity_id,
         CAST(left(o_orderpriority, 1) AS INTEGER) AS rating, o_orderdate AS published_at_date,
         CAST(year(o_orderdate) AS BIGINT) AS review_year,
         nullif(o_orderstatus, 'P') AS trip_type,
         CAST(floor(o_totalprice / 1000) AS BIGINT) AS like_count,
         c_name AS restaurant_name_from_restaurants,
         nullif(c_mktsegment, 'FURNITURE') AS price_range,
         CAST(left(o_orderpriority, 1) = '5' AS INTEGER) AS target_five_star,
         CASE WHEN left(o_orderpriority, 1) = '5' THEN 'five_star' ELSE 'non_five_star' END
           AS target_five_star_label,
         CASE WHEN left(o_orderpriority, 1) IN ('1', '2') THEN 'negative'
              WHEN left(o_orderpriority, 1) = '3' THEN 'neutral' ELSE 'positive' END
           AS rating_3class
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)
"""

DOCS = """
docs AS (
  SELECT CAST(substr(source, 4) AS BIGINT) AS restaurant_entity_id, source AS restaurant_name,
         doc_id AS review_id,
         '/ShowUserReviews-d' || substr(source, 4) || '-r' || length(text) AS review_link,
         nullif(split_part(text, chr(10), 1), text) AS title, text,
         CAST(doc_id % 5 + 1 AS INTEGER) AS rating, lang AS language,
         nullif(lang, 'de') AS original_language,
         CASE WHEN lang = 'es' THEN 'n/a' ELSE CAST(n_chars AS VARCHAR) END AS like_count,
         nullif(lang, 'fr') AS trip_type,
         CASE WHEN doc_id % 7 = 0 THEN '2024-02-30'
              ELSE CAST(DATE '2021-01-01' + CAST(doc_id % 1900 AS INTEGER) AS VARCHAR) END
           AS stay_date,
         CASE WHEN doc_id % 5 = 0 THEN 'bad'
              ELSE CAST(DATE '2021-01-01' + CAST(doc_id % 1900 AS INTEGER) AS VARCHAR) END
           AS created_at_date,
         CAST(DATE '2021-01-01' + CAST(doc_id % 1900 AS INTEGER) AS VARCHAR) AS published_at_date,
         'u' || (doc_id % 97) AS reviewer_id,
         CAST(n_chars % 100 AS VARCHAR) AS reviewer_contribution_count
  FROM documents)
"""

SQUEEZE = r"trim(regexp_replace(nfc_normalize(coalesce({0}, '')), '[\s\v]+', ' ', 'g'))"

CLEAN = (
    DOCS
    + f""",
cleaned AS (
  SELECT * , {SQUEEZE.format('title')} AS title_clean, {SQUEEZE.format('text')} AS text_clean
  FROM docs),
clean AS (
  SELECT *, CASE WHEN title_clean = '' THEN text_clean
                 WHEN text_clean = '' THEN title_clean
                 WHEN lower(title_clean) = lower(text_clean) THEN text_clean
                 WHEN starts_with(lower(text_clean), lower(title_clean)) THEN text_clean
                 ELSE title_clean || ' ' || text_clean END AS combined_text
  FROM cleaned)
"""
)


def ascii_share(column: str) -> str:
    return (
        f"CASE WHEN length({column}) = 0 THEN 0.0 ELSE CAST(length(regexp_replace({column}, "
        f"'[^\\x00-\\x7F]', '', 'g')) AS DOUBLE) / length({column}) END"
    )


QUALITY = (
    CLEAN
    + f""",
quality AS (
  SELECT *, length(title_clean) AS title_len, length(text_clean) AS text_len,
         length(combined_text) AS combined_len,
         {ascii_share('title_clean')} AS title_ascii_ratio,
         {ascii_share('text_clean')} AS text_ascii_ratio,
         {ascii_share('combined_text')} AS combined_ascii_ratio,
         regexp_matches(title_clean, '[\\x{{4e00}}-\\x{{9fff}}]')
           OR regexp_matches(text_clean, '[\\x{{4e00}}-\\x{{9fff}}]') AS has_chinese,
         coalesce(original_language = 'en', false) AS is_original_english,
         coalesce(language = 'en', false) AS is_language_en,
         contains(coalesce(title, ''), chr(65533)) OR contains(coalesce(text, ''), chr(65533))
           AS has_replacement_char
  FROM clean)
"""
)

KEPT = """is_original_english AND NOT has_chinese AND text_len >= 30
          AND combined_ascii_ratio >= 0.95"""

TOKENS = """
tok AS (
  SELECT doc_id AS review_id, doc_id % 5 + 1 AS rating,
         regexp_extract_all(lower(text), '[a-z]+(?:''[a-z]+)?') AS tokens
  FROM documents)
"""

HITS = (
    TOKENS
    + f""",
tokpos AS (
  SELECT review_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM tok),
flagged AS (
  SELECT *, token IN {words(LEX.positive)} AS up, token IN {words(LEX.negative)} AS down,
         coalesce(max(CASE WHEN token IN {words(LEX.negations)} THEN 1 ELSE 0 END) OVER (
           PARTITION BY review_id ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 0) = 1
           AS negated
  FROM tokpos)
"""
)

_VALENCE = "CASE token " + " ".join(
    f"WHEN '{w}' THEN CAST({v} AS DOUBLE)" for w, v in LEX.valence.items()
) + " ELSE CAST(0 AS DOUBLE) END"

_EMOTIONS = ", ".join(
    f"count(*) FILTER (token IN {words(LEX.emotions[c])}) AS {c}" for c in LEX.emotions
)

FEATURES = (
    HITS
    + f""",
per_doc AS (
  SELECT review_id,
         count(*) FILTER ((up AND NOT negated) OR (down AND negated)) AS p,
         count(*) FILTER ((down AND NOT negated) OR (up AND negated)) AS n,
         count(*) FILTER ((up OR down) AND negated) AS turned,
         sum({_VALENCE}) AS valence_sum, {_EMOTIONS}
  FROM flagged GROUP BY review_id),
feat0 AS (
  SELECT tok.review_id, rating, CAST(rating = 5 AS INTEGER) AS target_five_star,
         len(tokens) AS token_count, len(list_distinct(tokens)) AS unique_token_count,
         coalesce(p, 0) AS lexicon_positive_count, coalesce(n, 0) AS lexicon_negative_count,
         coalesce(turned, 0) AS lexicon_negated_hits,
         coalesce(p, 0) + coalesce(n, 0) AS lexicon_sentiment_total,
         CASE WHEN coalesce(p, 0) + coalesce(n, 0) = 0 THEN 0.0
              ELSE {r('CAST(p - n AS DOUBLE) / (p + n)')} END AS lexicon_sentiment_score,
         CASE WHEN p > n THEN 'positive' WHEN p < n THEN 'negative' ELSE 'neutral' END
           AS lexicon_sentiment_label,
         coalesce(valence_sum, 0) AS valence_sum,
         coalesce(joy, 0) AS happy_count, coalesce(anger, 0) AS anger_count,
         coalesce(sadness, 0) AS sad_count, coalesce(fear, 0) AS fear_count,
         coalesce(surprise, 0) AS surprise_count, coalesce(positive, 0) AS nrc_positive_count,
         coalesce(negative, 0) AS nrc_negative_count, coalesce(trust, 0) AS nrc_trust_count,
         coalesce(anticipation, 0) AS nrc_anticipation_count,
         coalesce(disgust, 0) AS nrc_disgust_count
  FROM tok LEFT JOIN per_doc USING (review_id)),
feat AS (
  SELECT *, {r('valence_sum / sqrt(valence_sum * valence_sum + 15)', 4)} AS vader_compound,
         {', '.join(f"{r(f'CAST({e}_count AS DOUBLE) / greatest(token_count, 1)')} AS {e}_ratio"
                    for e in ('happy', 'anger', 'sad', 'fear', 'surprise'))},
         CASE greatest(happy_count, anger_count, sad_count, fear_count, surprise_count)
              WHEN 0 THEN 'none' WHEN happy_count THEN 'happy' WHEN anger_count THEN 'anger'
              WHEN sad_count THEN 'sad' WHEN fear_count THEN 'fear' ELSE 'surprise' END
           AS dominant_emotion
  FROM feat0)
"""
)

SCORED = """
scored AS (
  SELECT o_orderkey AS review_id, CAST(left(o_orderpriority, 1) = '5' AS INTEGER) AS y,
         CAST(floor(o_totalprice / 1000) AS DOUBLE) AS score FROM orders)
"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts) + "\n"
