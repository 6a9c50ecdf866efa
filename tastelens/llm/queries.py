"""The registered queries over the given tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastelens.llm import (
    alignment,
    bpe,
    decontamination,
    language,
    packing,
    quality,
    runs,
    secret_scan,
    simhash,
    token_counts,
    tool_calls,
    top_k,
    toxicity,
)
from tastelens.llm.batches import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
TOKEN_LIMIT = 1_024
NEAR_WORDS, NEAR_BITS = 4, 4
NEIGHBOURS = 5
GOOD, TOXIC = 0.7, 0.5
SEQUENCE, END = 2_048, 0


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_decontamination")
def op1(spark, folder):
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontamination.leaks(docs, items)


@query("op2_token_counts")
def op2(spark, folder):
    path = public_tokenizers.path(VOCABULARY)
    return token_counts.count_tokens(table(spark, folder, "documents"), path, TOKEN_LIMIT)


# The transcripts hold no tool calls, so turns stand for them: what user and system say is a
# call with its text and size as arguments, the assistant's next turn is its result, and a call
# needs the call two turns before it.
TOOLS = {
    "setup": '{"type":"object","required":["text","turn","words"],"properties":'
    '{"text":{"type":"string","minLength":1},"turn":{"type":"integer","maximum":0},'
    '"words":{"type":"integer","maximum":40}},"additionalProperties":false}',
    "ask": '{"type":"object","required":["text","turn","words"],"properties":'
    '{"text":{"type":"string","minLength":1,"maxLength":200},"turn":{"type":"integer"},'
    '"words":{"type":"integer","minimum":3}},"additionalProperties":false}',
}


@query(
    "op3_tool_calls",
    """
    WITH said AS (
      SELECT *, conv_id || ':' || turn AS id,
             len(string_split_regex(text, ' +')) AS words FROM conversations),
    call AS (SELECT * FROM said WHERE role IN ('user', 'system')),
    results AS (
      SELECT conv_id || ':' || (turn - 1) AS id, count(*) AS n_results, min(text) AS content
      FROM said WHERE role = 'assistant' GROUP BY 1),
    calls AS (
      SELECT id, min(conv_id) AS conv_id, min(turn) AS turn, count(*) AS n_calls,
             min(CASE role WHEN 'user' THEN 'ask' ELSE 'setup' END) AS name,
             min(text) AS text, min(words) AS words
      FROM call GROUP BY id),
    chain AS (
      SELECT *, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS run
      FROM calls),
    levels AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, run ORDER BY turn) - 1 AS level
      FROM chain)
    SELECT coalesce(c.id, r.id) AS call_id, c.conv_id, c.turn, c.name,
           coalesce(c.n_calls, 0) AS n_calls, coalesce(r.n_results, 0) AS n_results,
           CASE WHEN c.id IS NULL THEN 'orphan' WHEN r.id IS NULL THEN 'unanswered'
                ELSE 'answered' END AS status,
           CAST(c.level AS INTEGER) AS level,
           CASE WHEN c.turn >= 2 AND b.id IS NULL THEN 1 ELSE 0 END AS missing,
           CASE WHEN c.id IS NULL THEN 'no call' ELSE concat_ws(';',
             CASE WHEN c.name = 'ask' AND length(c.text) > 200 THEN '$.text: maxLength' END,
             CASE WHEN c.name = 'setup' AND c.turn > 0 THEN '$.turn: maximum' END,
             CASE WHEN c.name = 'ask' AND c.words < 3 THEN '$.words: minimum' END,
             CASE WHEN c.name = 'setup' AND c.words > 40 THEN '$.words: maximum' END) END
             AS errors,
           CASE WHEN c.id IS NULL THEN '{"id":"' || r.id || '","result":' || to_json(r.content) || '}'
                ELSE '{"arguments":{"text":' || to_json(c.text) || ',"turn":' || c.turn
                  || ',"words":' || c.words || '},"id":"' || c.id || '","name":"' || c.name
                  || '","result":' || coalesce(CAST(to_json(r.content) AS VARCHAR), 'null') || '}'
                END AS record
    FROM levels c FULL JOIN results r ON c.id = r.id
    LEFT JOIN calls b ON b.id = c.conv_id || ':' || (c.turn - 2)
    """,
)
def op3(spark, folder):
    said = table(spark, folder, "conversations")
    call_id = F.concat_ws(":", "conv_id", "turn")
    words = F.size(F.split("text", " +"))
    calls = said.filter(F.col("role").isin("user", "system")).select(
        call_id.alias("call_id"),
        "conv_id",
        "turn",
        F.when(F.col("role") == "user", "ask").otherwise("setup").alias("name"),
        F.to_json(F.struct(words.alias("words"), "turn", "text")).alias("arguments"),
        F.when(F.col("turn") >= 2, F.array(F.concat_ws(":", "conv_id", F.col("turn") - 2))).alias(
            "depends_on"
        ),
    )
    results = said.filter(F.col("role") == "assistant").select(
        F.concat_ws(":", "conv_id", F.col("turn") - 1).alias("call_id"),
        "turn",
        F.col("text").alias("content"),
    )
    schemas = spark.createDataFrame(list(TOOLS.items()), "name string, schema string")
    linked = tool_calls.link_calls(calls, results, schemas)
    return linked.withColumn("errors", F.array_join("errors", ";"))


@query("op4_simhash")
def op4(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"), NEAR_WORDS, NEAR_BITS)


@query(
    "op5_top_k",
    f"""
    WITH v AS (
      SELECT vec_id, list_transform(embedding,
               lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
      WHERE q.vec_id % 50 = 0),
    ranked AS (
      SELECT *, CAST(row_number() OVER (
               PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
      FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {NEIGHBOURS}
    """,
)
def op5(spark, folder):
    return top_k.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, NEIGHBOURS)


@query("op6_bpe")
def op6(spark, folder):
    path = public_tokenizers.path(VOCABULARY)
    whole = bpe.encode_and_decode(table(spark, folder, "documents"), path)
    return whole.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op7_language")
def op7(spark, folder):
    docs = table(spark, folder, "documents")
    model = language.fit(docs, fold("doc_id", 5) != 0)
    found = language.predict(docs, model)
    return found.select("doc_id", _held("doc_id", 5, 0), "lang_pred", "score")


def _held(key: str, folds: int, held: int):
    return F.coalesce(fold(key, folds) == held, F.lit(False)).alias("held_out")


_KINDS = {r.kind: i for i, r in enumerate(secret_scan.RULES)}


def _secret_sql() -> str:
    def literal(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    found = []
    for rule in secret_scan.RULES:
        pattern = literal(rule.java)
        found.append(
            f"""SELECT row, '{rule.kind}' AS kind, {_KINDS[rule.kind]} AS place,
                string_split_regex(text, {pattern}) AS a, regexp_extract_all(text, {pattern}) AS m,
                regexp_extract_all(text, {pattern}, {rule.group}) AS g, {rule.least} AS least
              FROM docs"""
        )
    base = ", ".join(f"'{r.kind}'" for r in secret_scan.BASE)
    listed = "string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, place)"
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
    cuts AS ({" UNION ALL ".join(found)}),
    matches AS (
      SELECT row, kind, place, least, unnest(list_transform(m, lambda x: length(x))) AS m,
             unnest(list_transform(g, lambda x: length(x))) AS g,
             unnest(list_transform(a[1:len(m)], lambda x: length(x))) AS a,
             generate_subscripts(m, 1) AS i
      FROM cuts WHERE len(m) > 0),
    placed AS (
      SELECT *, CAST(sum(a + m) OVER (PARTITION BY row, kind ORDER BY i) AS BIGINT) AS e
      FROM matches),
    kept AS (SELECT *, e - m AS b FROM placed WHERE g >= least),
    per AS (
      SELECT row, count(*) FILTER (kind = 'assign') AS n_assign,
             count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
             {listed} FILTER (kind IN ({base})) AS base, {listed} AS spans
      FROM kept GROUP BY row)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
           coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
           coalesce(spans, '') AS spans
    FROM docs LEFT JOIN per USING (row)
    """


@query("op8_secret_scan", _secret_sql())
def op8(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secret_scan.with_secrets(docs).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s["kind"].isin([r.kind for r in secret_scan.BASE]))

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *(count(r.kind).alias(f"n_{r.kind}") for r in secret_scan.BASE),
        F.sha2(secret_scan.written(base), 256).alias("base_sha256"),
        secret_scan.written(F.col("secrets")).alias("spans"),
    )


@query("op9_quality")
def op9(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.fit(docs, labels, fold("doc_id", 4) != 2)
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id", _held("doc_id", 4, 2), "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


@query("op10_toxicity")
def op10(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(docs, labels, fold("doc_id", 5) != 0)
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", _held("doc_id", 5, 0), "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
    )


@query("op11_packing")
def op11(spark, folder):
    path = public_tokenizers.path(VOCABULARY)
    return packing.pack(table(spark, folder, "documents"), path, SEQUENCE, END)


def repeated_words(text, key):
    """The text, or where crc32(key) ends in 0, its words from one place on repeated with a period;
    both follow from the key."""
    h = F.crc32(key.cast("string"))
    g = F.floor(h / 10)

    def repeat(words):
        n = F.size(words)
        a = (g % n).cast("int")
        left = n - a
        p = (1 + F.floor(left / (3 + g % 8))).cast("int")
        times = F.floor(left / p).cast("int") + 1
        again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), times))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), left)), " ")

    word = F.lit(r"[^\x20\x09-\x0D]+")
    words = F.regexp_extract_all(text, word, F.lit(0))
    made = F.get(F.transform(F.array(words), repeat), F.lit(0))
    return F.when((h % 10 == 0) & F.regexp_like(text, word), made).otherwise(text)


@query("op12_runs")
def op12(spark, folder):
    docs = table(spark, folder, "documents")
    docs = docs.select("doc_id", repeated_words(F.col("text"), F.col("doc_id")).alias("text"))
    found = runs.find_runs(docs)
    longest = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"]))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length, period = -longest["less"], longest["period"]
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        longest["start"].alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_alignment")
def op13(spark, folder):
    docs = table(spark, folder, "documents")
    return alignment.align_tokens(
        docs, public_tokenizers.path(VOCABULARY), public_tokenizers.path(PIECES)
    )
