"""Queries on sources, cleaning, flags, labels, joins, filters and order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tastelens import fixed_values as fv
from tastelens import schemas
from tastelens.functions import scalar as S
from tastelens.functions import text as X
from tastelens.operators import dedup, prepare
from tastelens.plans.registry import (
    CLEAN, DOCS, HITS, KEPT, META, QUALITY, TOKENS, ascii_share, query, r, with_,
)
from tastelens.session import cut, scratch_path
from tastelens.sources import csv_ranges, files, lexicons
from tastelens.sources.tables import Tables

DOCUMENT_SCHEMA = schemas.record(
    doc_id=schemas.LONG, text=schemas.TEXT, lang=schemas.TEXT, source=schemas.TEXT,
    n_chars=schemas.LONG,
)


# --- sources and sinks ----------------------------------------------------------------------------


@query("scan_csv", sql="SELECT doc_id, text, lang, source, n_chars FROM documents")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "documents-csv")
    files.write_csv(t.documents(), path, byte_order_mark=True)
    return files.read_csv(t.spark, path, DOCUMENT_SCHEMA)


@query("scan_csv_ranges", sql="SELECT doc_id, text, lang, source, n_chars FROM documents")
def _(t: Tables) -> DataFrame:
    """The same file, cut into byte ranges whatever its quoted line breaks."""
    path = scratch_path(t.spark, "documents-csv")
    files.write_csv(t.documents(), path, byte_order_mark=True)
    return csv_ranges.read_csv_ranges(t.spark, path, DOCUMENT_SCHEMA)


@query(
    "json_explode",
    sql="""SELECT user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n
           FROM events GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    """Result pages of one user's events, exploded back to records."""
    page = schemas.record(results=ArrayType(schemas.record(k=schemas.LONG)))
    pages = t.read("events").select(
        "user_id",
        files.parse_json(F.concat(F.lit('{"results": ['), "props", F.lit("]}")), page).alias("p"),
    )
    rows = files.explode_results(pages.select("user_id", "p.results"), ["user_id"])
    return rows.groupBy("user_id", F.col("item.k").alias("k")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "json_flatten",
    sql=f"""SELECT event_id AS {fv.PLACE_ID}, event_type AS name,
                  CAST(json_extract(props, '$.k') AS VARCHAR) AS city, value AS latitude,
                  user_id AS parent_location_id
           FROM events""",
)
def _(t: Tables) -> DataFrame:
    """Nested restaurant records written as JSON text and flattened again."""
    nested = t.read("events").select(
        F.to_json(
            F.struct(
                F.col("event_id").alias(fv.PLACE_ID),
                F.concat(F.lit("/x-d"), "event_id", F.lit("-y")).alias("link"),
                F.col("event_type").alias("name"),
                F.struct(F.get_json_object("props", "$.k").alias("city")).alias("address"),
                F.struct(F.col("value").alias("latitude")).alias("coordinates"),
                F.struct(F.col("user_id").alias(fv.PLACE_ID)).alias("parent_location"),
            )
        ).alias("json")
    )
    items = nested.select(files.parse_json(F.col("json"), schemas.RESTAURANT_ITEM).alias("item"))
    return files.flatten_restaurants(items).select(
        fv.PLACE_ID, "name", "city", "latitude", "parent_location_id"
    )


@query(
    "json_flatten_child",
    sql="""SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS restaurant_entity_id,
                  event_id AS review_id, event_type AS trip_type, 'u' || user_id AS reviewer_id,
                  event_type || '-town' AS reviewer_hometown
           FROM events""",
)
def _(t: Tables) -> DataFrame:
    """Nested review records under their restaurant, flattened with its keys."""
    review = F.struct(
        F.col("event_id").alias("review_id"),
        F.struct(F.col("event_type").alias("trip_type")).alias("trip"),
        F.struct(
            F.concat(F.lit("u"), "user_id").alias("reviewer_id"),
            F.struct(F.concat("event_type", F.lit("-town")).alias("location_name_detailed")).alias(
                "hometown"
            ),
        ).alias("reviewer"),
    )
    page = schemas.record(results=ArrayType(schemas.REVIEW_ITEM))
    pages = t.read("events").select(
        F.get_json_object("props", "$.k").cast("bigint").alias("restaurant_entity_id"),
        F.lit(None).cast("string").alias("restaurant_name"),
        F.lit(None).cast("string").alias("restaurant_link"),
        files.parse_json(F.to_json(F.struct(F.array(review).alias("results"))), page).alias("p"),
    )
    carry = ["restaurant_entity_id", "restaurant_name", "restaurant_link"]
    items = files.explode_results(pages.select(*carry, "p.results"), carry)
    return files.flatten_reviews(items).select(
        "restaurant_entity_id", "review_id", "trip_type", "reviewer_id", "reviewer_hometown"
    )


@query(
    "json_roundtrip",
    sql="SELECT conv_id, turn, role, text, length(text) AS chars FROM conversations",
)
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "conversations-json")
    nested = t.read("conversations").select(
        "conv_id", "turn", F.struct("role", "text", F.length("text").alias("chars")).alias("body")
    )
    files.write_json(nested, path)
    schema = "conv_id bigint, turn bigint, body struct<role:string,text:string,chars:bigint>"
    return t.spark.read.schema(schema).json(path).select("conv_id", "turn", "body.*")


@query(
    "markdown_rows",
    sql="""SELECT CAST(1 AS BIGINT) AS line_no, '| n_regionkey | nations |' AS line
           UNION ALL SELECT 2, '| --- | --- |'
           UNION ALL SELECT 2 + row_number() OVER (ORDER BY n_regionkey),
                  '| ' || n_regionkey || ' | ' || count(*) || ' |'
           FROM nation GROUP BY n_regionkey""",
)
def _(t: Tables) -> DataFrame:
    table = t.read("nation").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("nations"))
    return files.markdown_table(table, [F.col("n_regionkey")])


@query(
    "load_polarity_lexicon",
    sql=with_(TOKENS) + """
    SELECT DISTINCT token AS word, left(token, 1) IN ('a', 'b', 'c', 't') AS is_pos,
           left(token, 1) IN ('c', 't', 'w') AS is_neg
    FROM (SELECT unnest(tokens) AS token FROM tok)""",
)
def _(t: Tables) -> DataFrame:
    """A polarity file for every word of the documents, parsed back."""
    first = F.left("w", F.lit(1))
    polarity = (
        F.when(first.isin("a", "b"), "positive").when(first.isin("c", "t"), "both")
        .when(first == "w", "negative").otherwise("neutral")
    )
    lines = _all_words(t).select(
        F.concat(
            F.lit("type=weaksubj len=1 word1="), F.upper("w"),
            F.lit(" pos1=adj stemmed1=n priorpolarity="), polarity,
        ).alias("value")
    )
    return lexicons.parse_polarity(lines)


@query(
    "load_emotion_lexicon",
    sql=with_(TOKENS) + """, w AS (SELECT DISTINCT unnest(tokens) AS token FROM tok)
    SELECT token AS word, CASE WHEN length(token) % 2 = 0 THEN 'fear,joy' ELSE 'joy' END
             AS emotions
    FROM w WHERE left(token, 1) <> 'z'""",
)
def _(t: Tables) -> DataFrame:
    word = F.col("w")
    flags = F.array(
        F.concat(word, F.lit("\tjoy\t"), F.when(F.left("w", F.lit(1)) == "z", "0").otherwise("1")),
        F.concat(
            word, F.lit("\tfear\t"),
            F.when((F.length("w") % 2 == 0) & (F.left("w", F.lit(1)) != "z"), "1").otherwise("0"),
        ),
        F.concat(word, F.lit("\tbroken line")),
    )
    lines = _all_words(t).select(F.explode(flags).alias("value"))
    return lexicons.parse_emotions(lines).select(
        "word", F.array_join("emotions", ",").alias("emotions")
    )


@query(
    "load_negations",
    sql=with_(TOKENS) + "SELECT DISTINCT unnest(tokens) AS word FROM tok",
)
def _(t: Tables) -> DataFrame:
    lines = _all_words(t).select(F.concat(F.lit(" "), F.upper("w"), F.lit(" ,x")).alias("value"))
    return lexicons.parse_negations(lines)


def _all_words(t: Tables) -> DataFrame:
    return t.documents().select(
        F.explode(F.array_distinct(X.tokenize(F.col("text")))).alias("w")
    ).distinct()


# --- projections and flags --------------------------------------------------------------------------


@query(
    "project_rename",
    sql="""SELECT c_custkey AS restaurant_entity_id, c_name AS restaurant_name_from_restaurants,
                  nullif(c_mktsegment, 'FURNITURE') AS price_range,
                  CAST(c_nationkey AS VARCHAR) AS address, c_acctbal AS latitude,
                  CAST(c_nationkey AS DOUBLE) AS longitude, c_acctbal > 0 AS has_reservation
           FROM customer""",
)
def _(t: Tables) -> DataFrame:
    return prepare.restaurant_features(t.customer_places()).drop("featured_image", "phone")


SAFE_SQL = (
    with_(QUALITY)
    + f""", stamped AS (
      SELECT *, try_strptime(published_at_date, '%Y-%m-%d') AS pub,
             try_strptime(created_at_date, '%Y-%m-%d') AS cre,
             try_strptime(stay_date, '%Y-%m-%d') AS sta FROM quality WHERE {KEPT})
    SELECT restaurant_entity_id, restaurant_name, review_id, review_link, title_clean, text_clean,
           combined_text, rating,
           CASE WHEN rating <= 2 THEN 'negative' WHEN rating <= 3 THEN 'neutral'
                ELSE 'positive' END AS rating_3class,
           CASE WHEN rating <= 2 THEN 0 WHEN rating <= 3 THEN 1 ELSE 2 END AS rating_3class_code,
           CAST(rating = 5 AS INTEGER) AS target_five_star,
           CASE WHEN rating = 5 THEN 'five_star' ELSE 'non_five_star' END
             AS target_five_star_label,
           trip_type, like_count, reviewer_contribution_count,
           strftime(pub, '%Y-%m-%d') AS published_at_date,
           strftime(cre, '%Y-%m-%d') AS created_at_date, strftime(sta, '%Y-%m-%d') AS stay_date,
           CAST(year(pub) AS BIGINT) AS review_year, CAST(month(pub) AS BIGINT) AS review_month,
           CAST(year(sta) AS BIGINT) AS stay_year, CAST(month(sta) AS BIGINT) AS stay_month,
           text_len, combined_len, {r('combined_ascii_ratio')} AS combined_ascii_ratio,
           {r("ln(1 + coalesce(try_cast(like_count AS DOUBLE), 0))")} AS like_count_log1p,
           {r("ln(1 + coalesce(try_cast(reviewer_contribution_count AS DOUBLE), 0))")}
             AS reviewer_contribution_count_log1p,
           CASE s_suppkey % 4 WHEN 0 THEN '$' WHEN 1 THEN '$$ - $$$' WHEN 2 THEN '$$$$' END
             AS price_range,
           nullif(s_acctbal, 0) AS latitude, CAST(s_nationkey AS DOUBLE) AS longitude,
           s_acctbal > 0 AS has_reservation
    FROM stamped LEFT JOIN supplier ON restaurant_entity_id = s_suppkey"""
)


def _plain(df: DataFrame) -> DataFrame:
    """Dates as text and ratios rounded, for comparison."""
    dates = {
        c: F.date_format(c, "yyyy-MM-dd")
        for c in ("published_at_date", "created_at_date", "stay_date")
    }
    rounded = {
        c: S.half_even(F.col(c), 6)
        for c in ("combined_ascii_ratio", "like_count_log1p", "reviewer_contribution_count_log1p")
    }
    return df.withColumns({**dates, **rounded})


@query("project_safe", sql=SAFE_SQL)
def _(t: Tables) -> DataFrame:
    return _plain(prepare.modelling_table(t.review_features(), t.places()))


@query("modeling_sorted", sql=SAFE_SQL + " ORDER BY pub NULLS LAST, review_id NULLS LAST")
def _(t: Tables) -> DataFrame:
    # a range sort samples its input first: the cleaned rows are stored and read twice instead
    stored = cut(prepare.modelling_table(t.review_features(), t.places()))
    return _plain(prepare.in_review_order(stored))


@query(
    "quality_flags",
    sql=with_(QUALITY) + """
    SELECT review_id, is_original_english, is_language_en, has_chinese, has_replacement_char,
           text_len >= 30 AS is_text_long_enough,
           combined_ascii_ratio >= 0.95 AS is_mostly_ascii FROM quality""",
)
def _(t: Tables) -> DataFrame:
    return t.review_features().select(
        "review_id", "is_original_english", "is_language_en", "has_chinese",
        "has_replacement_char", "is_text_long_enough", "is_mostly_ascii",
    )


@query(
    "script_flag",
    sql=with_(CLEAN) + r"""
    SELECT review_id,
           regexp_matches(title_clean, '[\x{4e00}-\x{9fff}]')
             OR regexp_matches(text_clean, '[\x{4e00}-\x{9fff}]') AS has_chinese,
           regexp_matches(title_clean, '[à-ÿ]') OR regexp_matches(text_clean, '[à-ÿ]')
             AS has_accented FROM clean""",
)
def _(t: Tables) -> DataFrame:
    clean = prepare.with_clean_text(t.doc_reviews())
    both = [F.col("title_clean"), F.col("text_clean")]
    return clean.select(
        "review_id",
        (X.has_script(both[0]) | X.has_script(both[1])).alias("has_chinese"),
        (X.has_script(both[0], "[à-ÿ]") | X.has_script(both[1], "[à-ÿ]")).alias("has_accented"),
    )


@query(
    "modeling_filter",
    sql=with_(QUALITY) + f"SELECT review_id, combined_text FROM quality WHERE {KEPT}",
)
def _(t: Tables) -> DataFrame:
    return prepare.fit_for_modelling(t.review_features()).select("review_id", "combined_text")


@query(
    "fill_defaults",
    sql=with_(META, DOCS) + """
    SELECT review_id, coalesce(trip_type, 'Unknown') AS trip_type,
           coalesce(price_range, 'Unknown') AS price_range, '' AS title FROM meta
    UNION ALL
    SELECT review_id, coalesce(trip_type, 'Unknown'), 'Unknown', coalesce(title, '') FROM docs""",
)
def _(t: Tables) -> DataFrame:
    meta = t.reviews_meta().select("review_id", "trip_type", "price_range")
    docs = t.doc_reviews().select("review_id", "trip_type", "title")
    both = meta.unionByName(docs, allowMissingColumns=True)
    return both.na.fill({"trip_type": "Unknown", "price_range": "Unknown", "title": ""})


@query(
    "numeric_coerce",
    sql=with_(DOCS) + """
    SELECT review_id, coalesce(try_cast(like_count AS DOUBLE), 0) AS like_count,
           coalesce(try_cast(trip_type AS DOUBLE), 0) AS not_a_number,
           0.0::DOUBLE AS suffixed, 0.0::DOUBLE AS hexadecimal FROM docs""",
)
def _(t: Tables) -> DataFrame:
    return t.doc_reviews().select(
        "review_id",
        S.to_number(F.col("like_count")).alias("like_count"),
        S.to_number(F.col("trip_type")).alias("not_a_number"),
        S.to_number(
            F.concat("review_id", F.when(F.col("review_id") % 2 == 0, "d").otherwise("F"))
        ).alias("suffixed"),
        S.to_number(F.concat(F.lit("0x"), F.col("review_id"), F.lit("p3"))).alias("hexadecimal"),
    )


@query(
    "review_filter",
    sql=with_(DOCS) + """
    SELECT review_id, published_at_date FROM docs
    WHERE original_language = 'en' AND rating = 4 AND published_at_date >= '2022-01-01'
      AND lower(trip_type) = 'en' AND contains(lower(text), 'the')
    UNION ALL SELECT o_orderkey, '' FROM orders
    WHERE left(o_orderpriority, 1) = '3' AND o_orderdate >= TIMESTAMP '1999-01-01'
      AND lower(o_orderstatus) = 'o'
    UNION ALL SELECT s_suppkey, 'place' FROM supplier WHERE s_acctbal >= 4500""",
)
def _(t: Tables) -> DataFrame:
    docs = prepare.request_filter(
        t.doc_reviews(), lang="en", rating_is=4, since="2022-01-01", traveler_type="EN",
        keyword="The",
    ).select("review_id", "published_at_date")
    orders = prepare.request_filter(
        t.order_reviews(), rating_is=3, since="1999-01-01", traveler_type="O"
    ).select("review_id", F.lit("").alias("published_at_date"))
    places = t.read("supplier").withColumn("rating", F.col("s_acctbal"))
    rated = prepare.rated_at_least(places, 4500).select(
        F.col("s_suppkey").alias("review_id"), F.lit("place").alias("published_at_date")
    )
    return docs.unionByName(orders).unionByName(rated)


@query(
    "relabel",
    sql=with_(META) + """
    SELECT target_five_star_label, CASE rating_3class WHEN 'negative' THEN 'Negative'
             WHEN 'neutral' THEN 'Neutral' ELSE 'Positive' END AS class_label,
           CASE trip_type WHEN 'F' THEN 'Family' WHEN 'O' THEN 'Other' ELSE trip_type END
             AS trip_label, count(*) AS n FROM meta GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    return (
        t.reviews_meta()
        .groupBy(
            "target_five_star_label",
            S.capitalise(F.col("rating_3class")).alias("class_label"),
            S.relabel(F.col("trip_type"), {"F": "Family", "O": "Other"}).alias("trip_label"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- joins ------------------------------------------------------------------------------------------


@query(
    "build_descriptive",
    sql=with_(META) + """
    SELECT review_id, restaurant_entity_id, rating, target_five_star_label, rating_3class,
           strftime(published_at_date, '%Y-%m-%d') AS published_at_date,
           restaurant_name_from_restaurants, price_range, true AS keep_for_descriptive FROM meta""",
)
def _(t: Tables) -> DataFrame:
    reviews = prepare.with_labels(t.order_reviews())
    places = prepare.restaurant_features(t.customer_places())
    return prepare.descriptive_table(reviews, places).select(
        "review_id", "restaurant_entity_id", "rating", "target_five_star_label", "rating_3class",
        F.date_format("published_at_date", "yyyy-MM-dd").alias("published_at_date"),
        "restaurant_name_from_restaurants", "price_range", "keep_for_descriptive",
    )


@query(
    "join_null_safe",
    sql=with_(META) + """, info AS (
      SELECT CASE WHEN n_nationkey = 0 THEN NULL ELSE chr(CAST(64 + n_nationkey AS INTEGER)) END
               AS trip, n_name FROM nation)
    SELECT review_id, trip_type, n_name FROM meta
    LEFT JOIN info ON trip_type IS NOT DISTINCT FROM trip""",
)
def _(t: Tables) -> DataFrame:
    info = t.read("nation").select(
        F.when(F.col("n_nationkey") != 0, F.char(64 + F.col("n_nationkey"))).alias(
            "restaurant_entity_id"
        ),
        "n_name",
    )
    reviews = t.order_reviews().select(
        "review_id", F.col("trip_type").alias("restaurant_entity_id")
    )
    return prepare.join_restaurants(reviews, info).withColumnRenamed(
        "restaurant_entity_id", "trip_type"
    )


# --- order, dedup, caps -------------------------------------------------------------------------------


@query(
    "dedup_keep_first",
    sql="""SELECT doc_id, n_chars FROM documents
           QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
)
def _(t: Tables) -> DataFrame:
    slim = t.documents().select("doc_id", "n_chars", "text")
    return dedup.keep_first_text(slim, "text", [F.asc("doc_id")]).drop("text")


@query(
    "dedup_by_id_or_link",
    sql=with_(DOCS) + """, keyed AS (
      SELECT review_id, review_link, coalesce(nullif(CAST(review_id % 50 AS VARCHAR), '0'),
             nullif(nullif(review_link, ''), '0')) AS k FROM docs)
    SELECT review_id, review_link FROM keyed WHERE k IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY k ORDER BY review_id) = 1""",
)
def _(t: Tables) -> DataFrame:
    """Rows keyed by an id, or by their link where the id is 0."""
    docs = t.doc_reviews().select("review_id", "review_link")
    key = dedup.id_or_link(F.col("review_id") % 50, F.col("review_link"))
    return dedup.keep_first(docs, key, [F.asc("review_id")])


@query(
    "cap_per_restaurant",
    sql=with_(META) + """
    SELECT restaurant_entity_id, review_id FROM meta
    QUALIFY row_number() OVER (PARTITION BY restaurant_entity_id
                               ORDER BY published_at_date DESC, review_id) <= 5""",
)
def _(t: Tables) -> DataFrame:
    capped = dedup.top_per_key(
        t.order_reviews(), ["restaurant_entity_id"],
        [F.desc("published_at_date"), F.asc("review_id")], 5,
    )
    return capped.select("restaurant_entity_id", "review_id")


@query(
    "pick_entity",
    sql="""SELECT coalesce(
             (SELECT c_custkey FROM customer WHERE c_custkey <> 0
                AND contains(lower(c_name), '99') AND c_mktsegment = 'BUILDING'
              ORDER BY c_custkey LIMIT 1),
             (SELECT c_custkey FROM customer WHERE c_custkey <> 0 ORDER BY c_custkey LIMIT 1),
             294217) AS entity_id""",
)
def _(t: Tables) -> DataFrame:
    places = t.read("customer").select(
        F.col("c_custkey").alias("position"), F.col("c_name").alias("name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "city").otherwise("x").alias("place_type"),
        F.col("c_custkey").alias("entity_id"),
    )
    return dedup.pick_place(places, name_part="99")


@query(
    "reviews_sorted",
    sql=with_(DOCS) + """
    SELECT review_id, published_at_date, length(text) AS chars FROM docs
    ORDER BY published_at_date DESC, review_id""",
)
def _(t: Tables) -> DataFrame:
    return prepare.sorted_reviews(t.doc_reviews()).select(
        "review_id", "published_at_date", F.length("text").cast("bigint").alias("chars")
    )


@query(
    "reviews_sorted_detailed",
    sql="""SELECT doc_id AS review_id, length(text) AS chars FROM documents
           ORDER BY length(text) DESC, doc_id""",
)
def _(t: Tables) -> DataFrame:
    return prepare.sorted_reviews(t.doc_reviews(), "detailed_reviews").select(
        "review_id", F.length("text").cast("bigint").alias("chars")
    )


@query(
    "union_pages",
    sql="""SELECT doc_id AS id, 'documents' AS part, length(text) AS chars FROM documents
           UNION ALL SELECT page_id, 'pages', length(html) FROM pages
           UNION ALL SELECT conv_id, 'conversations', length(text) FROM conversations""",
)
def _(t: Tables) -> DataFrame:
    def part(name: str, key: str, text: str) -> DataFrame:
        return t.read(name).select(
            F.col(key).alias("id"), F.lit(name).alias("part"),
            F.length(text).cast("bigint").alias("chars"),
        )

    return (
        part("documents", "doc_id", "text")
        .unionByName(part("pages", "page_id", "html"))
        .unionByName(part("conversations", "conv_id", "text"))
    )


# --- scalar functions -----------------------------------------------------------------------------------


@query(
    "normalize_text",
    sql=with_(CLEAN) + "SELECT review_id, title_clean, text_clean FROM clean",
)
def _(t: Tables) -> DataFrame:
    return prepare.with_clean_text(t.doc_reviews()).select(
        "review_id", "title_clean", "text_clean"
    )


@query("combine_title_text", sql=with_(CLEAN) + "SELECT review_id, combined_text FROM clean")
def _(t: Tables) -> DataFrame:
    return prepare.with_clean_text(t.doc_reviews()).select("review_id", "combined_text")


@query(
    "ascii_ratio",
    sql=f"SELECT doc_id, {r(ascii_share('text'))} AS ascii_ratio FROM documents",
)
def _(t: Tables) -> DataFrame:
    return t.documents().select(
        "doc_id", S.half_even(X.ascii_ratio(F.col("text")), 6).alias("ascii_ratio")
    )


@query(
    "text_lengths",
    sql=with_(QUALITY) + "SELECT review_id, title_len, text_len, combined_len FROM quality",
)
def _(t: Tables) -> DataFrame:
    return t.review_features().select("review_id", "title_len", "text_len", "combined_len")


@query(
    "extract_entity_id",
    sql=r"""SELECT page_id, try_cast(nullif(regexp_extract(url, '/(\d+)', 1), '') AS BIGINT)
              AS entity_id FROM pages""",
)
def _(t: Tables) -> DataFrame:
    return t.read("pages").select(
        "page_id", S.entity_id(F.col("url"), r"/(\d+)").alias("entity_id")
    )


@query(
    "tokenize",
    sql=with_(TOKENS) + """SELECT review_id AS doc_id, array_to_string(tokens, ' ') AS tokens
                           FROM tok""",
)
def _(t: Tables) -> DataFrame:
    return t.documents().select(
        "doc_id", F.array_join(X.tokenize(F.col("text")), " ").alias("tokens")
    )


@query(
    "token_counts",
    sql=with_(TOKENS) + """SELECT review_id AS doc_id, len(tokens) AS token_count,
                                  len(list_distinct(tokens)) AS unique_token_count FROM tok""",
)
def _(t: Tables) -> DataFrame:
    counted = t.documents().select(
        "doc_id",
        X.bind(
            X.tokenize(F.col("text")),
            lambda w: F.struct(
                F.size(w).cast("bigint").alias("token_count"),
                F.size(F.array_distinct(w)).cast("bigint").alias("unique_token_count"),
            ),
        ).alias("c"),
    )
    return counted.select("doc_id", "c.*")


@query(
    "parse_dates",
    sql=with_(DOCS) + """
    SELECT review_id, strftime(try_strptime(stay_date, '%Y-%m-%d'), '%Y-%m-%d') AS stay_date,
           strftime(try_strptime(created_at_date, '%Y-%m-%d'), '%Y-%m-%d') AS created_at_date
    FROM docs""",
)
def _(t: Tables) -> DataFrame:
    return t.doc_reviews().select(
        "review_id",
        F.date_format(S.parse_date(F.col("stay_date")), "yyyy-MM-dd").alias("stay_date"),
        F.date_format(S.parse_date(F.col("created_at_date")), "yyyy-MM-dd").alias(
            "created_at_date"
        ),
    )


@query(
    "date_parts",
    sql="""SELECT o_orderkey AS review_id, CAST(year(o_orderdate) AS BIGINT) AS review_year,
                  CAST(month(o_orderdate) AS BIGINT) AS review_month FROM orders""",
)
def _(t: Tables) -> DataFrame:
    date = F.col("published_at_date")
    return t.order_reviews().select(
        "review_id", S.year_of(date).alias("review_year"), S.month_of(date).alias("review_month")
    )


@query(
    "log_counts",
    sql=with_(META, DOCS) + f"""
    SELECT review_id, {r('ln(1 + like_count)')} AS like_count_log1p FROM meta
    UNION ALL SELECT review_id, {r('ln(1 + coalesce(try_cast(like_count AS DOUBLE), 0))')}
    FROM docs""",
)
def _(t: Tables) -> DataFrame:
    def logged(df: DataFrame) -> DataFrame:
        return df.select(
            "review_id",
            S.half_even(S.log_count(F.col("like_count")), 6).alias("like_count_log1p"),
        )

    return logged(t.order_reviews()).unionByName(logged(t.doc_reviews()))


@query(
    "rating_class",
    sql="""WITH x AS (SELECT event_id, CASE WHEN user_id % 10 = 7 THEN NULL ELSE value / 10 END
                      AS rating FROM events)
    SELECT event_id, CASE WHEN rating >= 0 AND rating <= 2 THEN 'negative'
                          WHEN rating > 2 AND rating <= 3 THEN 'neutral'
                          WHEN rating > 3 AND rating <= 5 THEN 'positive' END AS rating_3class,
           CASE WHEN rating >= 0 AND rating <= 2 THEN 0 WHEN rating > 2 AND rating <= 3 THEN 1
                WHEN rating > 3 AND rating <= 5 THEN 2 ELSE -1 END AS rating_3class_code,
           CASE WHEN rating = 5 THEN 1 ELSE 0 END AS target_five_star,
           CASE WHEN rating = 5 THEN 'five_star' ELSE 'non_five_star' END
             AS target_five_star_label FROM x""",
)
def _(t: Tables) -> DataFrame:
    """Real-valued ratings, some missing, some above the scale."""
    ratings = t.read("events").select(
        "event_id", F.when(F.col("user_id") % 10 != 7, F.col("value") / 10).alias("rating")
    )
    return prepare.with_labels(ratings).drop("rating")


# --- word positions --------------------------------------------------------------------------------------


@query(
    "negation_window",
    sql=with_(HITS) + """
    SELECT review_id, CAST(pos - 1 AS BIGINT) AS position, token, up, down, negated
    FROM flagged WHERE up OR down""",
)
def _(t: Tables) -> DataFrame:
    from tastelens.functions.lexicon import sentiment_hits

    lex = t.lexicons
    hits = sentiment_hits(X.tokenize(F.col("text")), lex.positive, lex.negative, lex.negations)
    return t.documents().select(
        F.col("doc_id").alias("review_id"), F.explode(hits).alias("h")
    ).select("review_id", "h.*")
