"""Queries on audits and exploratory summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastelens import fixed_values as fv
from tastelens.functions import scalar as S
from tastelens.operators import audit, prepare
from tastelens.operators import summaries as E
from tastelens.plans.registry import DOCS, KEPT, META, QUALITY, query, r, with_
from tastelens.session import scratch_path
from tastelens.sources.tables import Tables

# --- audit ---------------------------------------------------------------------------------------


@query(
    "audit_overview",
    sql=with_(DOCS) + """
    SELECT (SELECT count(*) FROM supplier) AS restaurants, count(*) AS reviews,
           count(DISTINCT reviewer_id) AS unique_reviewers FROM docs""",
)
def _(t: Tables) -> DataFrame:
    return audit.overview(t.doc_reviews(), t.supplier_places())


@query(
    "cap_audit",
    sql="""WITH sizes AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
           SELECT count(*) FILTER (n = 10) AS at_cap, count(*) AS groups FROM sizes""",
)
def _(t: Tables) -> DataFrame:
    return audit.cap_hits(t.order_reviews(), cap=10)


_SKETCHED = ("l_orderkey", "l_partkey", "l_suppkey")


@query(
    "distinct_sketches",
    sql=" UNION ALL ".join(
        f"""SELECT {flag} AS flag, '{c}' AS name, count(DISTINCT {c}) AS exact, count({c}) AS filled,
            true AS near FROM lineitem{group}"""
        for c in _SKETCHED
        for flag, group in (("l_returnflag", " GROUP BY l_returnflag"), ("'all'", ""))
    ),
)
def _(t: Tables) -> DataFrame:
    """Distinct counts from stored sketches, per group and merged over the groups, next to the
    exact ones: near means within three standard errors."""
    lines = t.read("lineitem").withColumnRenamed("l_returnflag", "flag")
    path = scratch_path(t.spark, "sketches")
    audit.distinct_sketches(lines, _SKETCHED, ["flag"]).write.parquet(path)
    sketches = t.spark.read.parquet(path)
    every = F.lit("all").alias("flag")
    about = audit.distinct_counts(sketches, ["flag"]).unionByName(
        audit.distinct_counts(sketches).withColumn("flag", every)
    )
    # the exact counts, each value once per group before it is counted
    values = lines.select("flag", F.explode(F.array(*(
        F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in _SKETCHED
    ))).alias("v")).select("flag", "v.*").filter("value IS NOT NULL").distinct()
    exact = values.groupBy("flag", "name").agg(E.rows("exact")).unionByName(
        values.select("name", "value").distinct().groupBy("name").agg(E.rows("exact")).withColumn("flag", every)
    )
    off = F.abs(F.col("distinct_about") - F.col("exact")) / F.col("exact")
    return about.join(exact, ["flag", "name"]).select(
        "flag", "name", "exact", "filled", (off <= 3 * audit.SKETCH_ERROR).alias("near")
    )


@query(
    "audit_duplicates",
    sql=with_(DOCS) + """
    SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT review_id FROM docs))
             AS duplicate_review_id,
           count(*) - (SELECT count(*) FROM (SELECT DISTINCT review_link FROM docs))
             AS duplicate_review_link,
           count(*) - (SELECT count(*) FROM (SELECT DISTINCT title, text FROM docs))
             AS duplicate_title_text FROM docs""",
)
def _(t: Tables) -> DataFrame:
    return audit.duplicates(t.doc_reviews())


@query(
    "audit_missing",
    sql=with_(DOCS) + """
    SELECT count(*) FILTER (trip_type IS NULL) AS missing_trip_type,
           count(*) FILTER (title IS NULL) AS missing_title,
           count(*) FILTER (try_strptime(stay_date, '%Y-%m-%d') IS NULL) AS missing_stay_date
    FROM docs""",
)
def _(t: Tables) -> DataFrame:
    dated = t.doc_reviews().withColumn("stay_date", S.parse_date(F.col("stay_date")))
    return audit.missing(dated, ["trip_type", "title", "stay_date"])


TEXT_QUALITY = f"""
    SELECT count(*) FILTER (combined_ascii_ratio < 1) AS non_ascii,
           count(*) FILTER (has_chinese) AS with_chinese,
           count(*) FILTER (is_original_english) AS original_english,
           count(*) FILTER ({KEPT}) AS kept_for_modeling FROM quality"""


@query("audit_text_quality", sql=with_(QUALITY) + TEXT_QUALITY)
def _(t: Tables) -> DataFrame:
    return audit.text_quality(t.review_features())


def _distributions(name: str, source: str) -> str:
    three = """CASE WHEN rating <= 2 THEN 'negative' WHEN rating <= 3 THEN 'neutral'
               ELSE 'positive' END"""
    binary = "CASE WHEN rating = 5 THEN 'five_star' ELSE 'non_five_star' END"
    return f"""
    UNION ALL SELECT '{name}_rating', CAST(rating AS VARCHAR), count(*) FROM {source} GROUP BY rating
    UNION ALL SELECT '{name}_3class', {three}, count(*) FROM {source} GROUP BY ALL
    UNION ALL SELECT '{name}_binary', {binary}, count(*) FROM {source} GROUP BY ALL"""


@query(
    "audit_summary",
    sql=with_(QUALITY) + f""",
    kept AS (SELECT * FROM quality WHERE {KEPT}),
    sizes AS (SELECT restaurant_entity_id, count(*) AS n FROM docs GROUP BY 1),
    facts AS (
      SELECT 'overview' AS section, 'restaurants' AS metric,
             (SELECT count(*) FROM supplier) AS value
      UNION ALL SELECT 'overview', 'reviews', count(*) FROM docs
      UNION ALL SELECT 'overview', 'unique_reviewers', count(DISTINCT reviewer_id) FROM docs
      UNION ALL SELECT 'overview', 'at_cap', count(*) FILTER (n = 120) FROM sizes
      UNION ALL SELECT 'overview', 'groups', count(*) FROM sizes
      UNION ALL SELECT 'quality', 'duplicate_review_id', count(*) - count(DISTINCT review_id)
        FROM docs
      UNION ALL SELECT 'quality', 'duplicate_review_link', count(*) - count(DISTINCT review_link)
        FROM docs
      UNION ALL SELECT 'quality', 'duplicate_title_text', (SELECT count(*) FROM docs)
        - (SELECT count(*) FROM (SELECT DISTINCT title, text FROM docs))
      UNION ALL SELECT 'quality', 'missing_trip_type', count(*) FILTER (trip_type IS NULL)
        FROM docs
      UNION ALL SELECT 'quality', 'missing_title', count(*) FILTER (title IS NULL) FROM docs
      UNION ALL SELECT 'quality', 'missing_stay_date', count(*) FILTER (stay_date IS NULL)
        FROM docs
      UNION ALL SELECT 'text', 'non_ascii', count(*) FILTER (combined_ascii_ratio < 1)
        FROM quality
      UNION ALL SELECT 'text', 'with_chinese', count(*) FILTER (has_chinese) FROM quality
      UNION ALL SELECT 'text', 'original_english', count(*) FILTER (is_original_english)
        FROM quality
      UNION ALL SELECT 'text', 'kept_for_modeling', count(*) FROM kept
      {_distributions('raw', 'docs')}
      {_distributions('modeling', 'kept')})
    SELECT * FROM facts""",
)
def _(t: Tables) -> DataFrame:
    return audit.audit_summary(t.doc_reviews(), t.places(), t.review_features())


# --- counts ---------------------------------------------------------------------------------------


@query(
    "rating_counts",
    sql=with_(META) + "SELECT rating, count(*) AS count FROM meta GROUP BY 1 ORDER BY 1",
)
def _(t: Tables) -> DataFrame:
    return E.value_counts(t.order_reviews(), "rating").orderBy("rating")


@query(
    "year_counts",
    sql="""SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS count FROM orders
           GROUP BY 1 ORDER BY 1""",
)
def _(t: Tables) -> DataFrame:
    years = t.order_reviews().select(S.year_of(F.col("published_at_date")).alias("year"))
    return E.value_counts(years, "year").orderBy("year")


@query(
    "trip_type_counts",
    sql=with_(META) + """SELECT trip_type, count(*) AS count FROM meta
    WHERE trip_type IS NOT NULL GROUP BY 1 ORDER BY count DESC, trip_type""",
)
def _(t: Tables) -> DataFrame:
    return E.value_counts(t.order_reviews(), "trip_type").orderBy(F.desc("count"), "trip_type")


@query(
    "class_counts_full",
    sql="""WITH fixed AS (
      SELECT unnest([0, 1, 2]) AS position, unnest(['BUILDING', 'GARDEN', 'MACHINERY']) AS segment)
    SELECT position, segment, count(c_custkey) AS count
    FROM fixed LEFT JOIN customer ON segment = c_mktsegment GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    """Counts on a fixed list of classes, one of which never occurs."""
    customers = t.read("customer").select(F.col("c_mktsegment").alias("segment"))
    return E.full_counts(customers, "segment", ["BUILDING", "GARDEN", "MACHINERY"], zero=True)


@query(
    "reviews_per_restaurant",
    sql=f"""SELECT o_custkey AS restaurant_entity_id, count(*) AS review_count,
                  c_custkey AS {fv.PLACE_ID}, c_name AS name,
                  nullif(c_mktsegment, 'FURNITURE') AS price_range
           FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    return E.reviews_per_restaurant(t.order_reviews(), t.customer_places())


@query(
    "binary_label_counts",
    sql=with_(META) + """SELECT target_five_star_label AS label, count(*) AS count FROM meta
    GROUP BY 1 ORDER BY count DESC, label""",
)
def _(t: Tables) -> DataFrame:
    labels = prepare.with_labels(t.order_reviews()).select(
        F.col("target_five_star_label").alias("label")
    )
    return E.value_counts(labels, "label").orderBy(F.desc("count"), "label")


@query(
    "hist_reviews_per_restaurant",
    sql=f"""WITH sizes AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1),
    ends AS (SELECT CAST(min(n) AS DOUBLE) AS lo, CAST(max(n) AS DOUBLE) AS hi FROM sizes),
    binned AS (SELECT least(CAST(floor((n - lo) / ((hi - lo) / 20)) AS BIGINT), 19) AS bin
               FROM sizes, ends),
    bins AS (SELECT range AS bin FROM range(20))
    SELECT bins.bin, {r('lo + bins.bin * ((hi - lo) / 20)')} AS bin_start,
           count(binned.bin) AS count
    FROM ends, bins LEFT JOIN binned ON bins.bin = binned.bin GROUP BY bins.bin, lo, hi""",
)
def _(t: Tables) -> DataFrame:
    sizes = t.order_reviews().groupBy("restaurant_entity_id").agg(E.rows("n"))
    return E.histogram(sizes, "n", 20)


# --- means ----------------------------------------------------------------------------------------


@query(
    "avg_rating_by_year",
    sql=f"""SELECT CAST(year(o_orderdate) AS BIGINT) AS published_year,
                   {r("avg(CAST(left(o_orderpriority, 1) AS INTEGER))")} AS rating
            FROM orders GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    years = t.order_reviews().withColumn(
        "published_year", S.year_of(F.col("published_at_date"))
    )
    return E.mean_by(years, "published_year", ["rating"], digits=6)


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: S.half_even(F.col(c), digits) for c in columns})


@query(
    "trip_type_summary",
    sql=with_(META) + f"""
    SELECT coalesce(trip_type, 'Unknown') AS trip_type_clean, {r('avg(rating)')} AS avg_rating,
           count(review_id) AS review_count FROM meta GROUP BY 1
    ORDER BY avg_rating DESC, trip_type_clean""",
)
def _(t: Tables) -> DataFrame:
    table = _rounded(E.trip_type_summary(t.order_reviews()), "avg_rating")
    return table.orderBy(F.desc("avg_rating"), "trip_type_clean")


@query(
    "price_range_summary",
    sql=with_(META) + f"""
    SELECT CASE WHEN coalesce(price_range, 'Unknown') <> 'BUILDING'
                THEN coalesce(price_range, 'Unknown') END AS price_range_clean,
           {r('avg(rating)')} AS avg_rating, count(review_id) AS review_count,
           {r('avg(target_five_star)')} AS five_star_rate,
           CAST(CASE coalesce(price_range, 'Unknown') WHEN 'HOUSEHOLD' THEN 1
                WHEN 'MACHINERY' THEN 2 WHEN 'AUTOMOBILE' THEN 3 WHEN 'Unknown' THEN 4 END
                AS BIGINT) AS price_rank
    FROM meta GROUP BY price_range ORDER BY price_rank NULLS LAST""",
)
def _(t: Tables) -> DataFrame:
    order = ["HOUSEHOLD", "MACHINERY", "AUTOMOBILE", "Unknown"]
    table = _rounded(
        E.price_range_summary(t.reviews_meta(), order), "avg_rating", "five_star_rate"
    )
    return table.orderBy(F.asc_nulls_last("price_rank"))


@query(
    "recent_quality",
    sql=with_(META) + f"""
    SELECT review_year, count(review_id) AS review_count, {r('avg(rating)')} AS avg_rating,
           {r('avg(target_five_star)')} AS five_star_rate,
           {r('avg(CASE WHEN trip_type IS NULL THEN 1.0 ELSE 0.0 END)')} AS trip_type_missing_rate
    FROM meta WHERE review_year IN (1998, 1999, 2000, 2001) GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    table = E.recent_quality(
        prepare.with_labels(t.order_reviews()).withColumn(
            "review_year", S.year_of(F.col("published_at_date"))
        ),
        (1998, 1999, 2000, 2001),
    )
    return _rounded(table, "avg_rating", "five_star_rate", "trip_type_missing_rate")


@query(
    "boxplot_len_by_rating",
    sql=f"""WITH x AS (SELECT doc_id % 5 + 1 AS rating, length(text) AS text_len FROM documents),
    box AS (SELECT rating, count(*) AS n, quantile_cont(text_len, 0.25) AS q1,
                   quantile_cont(text_len, 0.5) AS median, quantile_cont(text_len, 0.75) AS q3
            FROM x GROUP BY rating)
    SELECT rating, n, {r('q1')} AS q1, {r('median')} AS median, {r('q3')} AS q3,
           min(text_len) AS whisker_low, max(text_len) AS whisker_high
    FROM x JOIN box USING (rating)
    WHERE text_len BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
    GROUP BY rating, n, q1, median, q3""",
)
def _(t: Tables) -> DataFrame:
    lengths = t.read("documents").select(
        (F.col("doc_id") % 5 + 1).alias("rating"),
        F.length("text").cast("bigint").alias("text_len"),
    )
    return _rounded(E.box_plot(lengths, "rating", "text_len"), "q1", "median", "q3")


@query(
    "zscore",
    sql=f"""SELECT o_orderkey AS review_id,
      {r('(o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER ()', 5)}
        AS price_z, CAST(0 AS DOUBLE) AS constant_z,
      CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE
      {r("""(o_totalprice - avg(o_totalprice) FILTER (o_orderkey % 7 <> 0) OVER ())
         / stddev_pop(o_totalprice) FILTER (o_orderkey % 7 <> 0) OVER ()""", 5)} END AS holed_z
    FROM orders""",
)
def _(t: Tables) -> DataFrame:
    prices = t.read("orders").select(
        F.col("o_orderkey").alias("review_id"), F.col("o_totalprice").alias("price"),
        F.lit(3.0).alias("constant"),
        F.when(F.col("o_orderkey") % 7 == 0, float("nan")).otherwise(F.col("o_totalprice")).alias(
            "holed"
        ),
    )
    scored = E.zscore(prices, ["price", "constant", "holed"])
    return _rounded(scored, "price_z", "holed_z", digits=5).select(
        "review_id", "price_z", "constant_z", "holed_z"
    )




@query(
    "eda_tables",
    sql=with_(QUALITY) + f""",
    kept AS (
      SELECT *, CAST(left(published_at_date, 4) AS BIGINT) AS y, CAST(rating = 5 AS INTEGER) AS t
      FROM quality WHERE {KEPT})
    SELECT 'recent' AS part, CAST(y AS VARCHAR) AS key, count(*) AS n, {r('avg(rating)', 4)} AS avg_rating,
           {r('avg(t)', 4)} AS five_star_rate FROM kept WHERE y IN {fv.RECENT_YEARS} GROUP BY y
    UNION ALL
    SELECT 'price', coalesce(CASE s_suppkey % 4 WHEN 0 THEN '$' WHEN 1 THEN '$$ - $$$'
             WHEN 2 THEN '$$$$' END, 'Unknown') AS p, count(*), {r('avg(rating)', 4)},
           {r('avg(t)', 4)}
    FROM kept LEFT JOIN supplier ON restaurant_entity_id = s_suppkey GROUP BY p""",
)
def _(t: Tables) -> DataFrame:
    """Recent-year and price-range tables of the modelling rows."""
    rows = prepare.modelling_table(t.review_features(), t.places())

    def slim(df: DataFrame, part: str, key: str) -> DataFrame:
        return _rounded(df, "avg_rating", "five_star_rate", digits=4).select(
            F.lit(part).alias("part"), F.col(key).cast("string").alias("key"),
            F.col("review_count").alias("n"), "avg_rating", "five_star_rate",
        )

    recent = slim(E.recent_quality(rows), "recent", "review_year")
    return recent.unionByName(slim(E.price_range_summary(rows), "price", "price_range_clean"))
