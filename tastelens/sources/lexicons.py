"""Word lexicons: parsed as tables that are joined, or as short lists compiled into expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastelens import fixed_values as fv

# Up to this many words a lexicon is sent to the tasks; beyond it, the same join shuffles.
MAX_BROADCAST_WORDS = 50_000


@dataclass(frozen=True)
class Lexicons:
    positive: Sequence[str] = tuple(fv.POSITIVE_WORDS)
    negative: Sequence[str] = tuple(fv.NEGATIVE_WORDS)
    negations: Sequence[str] = tuple(fv.FALLBACK_NEGATIONS)
    intensifiers: Sequence[str] = tuple(fv.INTENSIFIERS)
    emotions: Mapping[str, Sequence[str]] = field(
        default_factory=lambda: {
            cls: fv.EMOTION_WORDS[name] for cls, name in fv.SHORT_EMOTIONS.items()
        }
    )
    valence: Mapping[str, float] = field(
        default_factory=lambda: {w: 2.0 for w in fv.POSITIVE_WORDS}
        | {w: -2.0 for w in fv.NEGATIVE_WORDS}
    )


def parse_polarity(lines: DataFrame) -> DataFrame:
    """``key=value`` lines to (word, is_pos, is_neg); polarity ``both`` sets both flags."""
    pairs = F.filter(F.split(F.trim("value"), r"\s+"), lambda p: F.contains(p, F.lit("=")))
    parsed = lines.select(
        _last_value(pairs, "word1").alias("word"),
        _last_value(pairs, "priorpolarity").alias("polarity"),
    )
    return (
        parsed.filter(F.col("word") != "")
        .groupBy("word")
        .agg(
            F.bool_or(F.coalesce(F.col("polarity").isin("positive", "both"), F.lit(False))).alias(
                "is_pos"
            ),
            F.bool_or(F.coalesce(F.col("polarity").isin("negative", "both"), F.lit(False))).alias(
                "is_neg"
            ),
        )
    )


def _last_value(pairs, key: str):
    """Value of the last ``key=value`` pair with this key, lower-cased."""
    mine = F.filter(pairs, lambda p: F.startswith(p, F.lit(key + "=")))
    return F.lower(F.substr(F.try_element_at(mine, F.lit(-1)), F.lit(len(key) + 2)))


def parse_emotions(lines: DataFrame) -> DataFrame:
    """``word<TAB>class<TAB>flag`` lines to (word, emotions); only flag 1 counts."""
    parts = F.split(F.trim("value"), "\t")
    return (
        lines.select(parts.alias("parts"))
        .filter((F.size("parts") == 3) & (F.col("parts")[2] == "1"))
        .groupBy(F.lower(F.col("parts")[0]).alias("word"))
        .agg(F.sort_array(F.collect_set(F.lower(F.col("parts")[1]))).alias("emotions"))
    )


def parse_negations(lines: DataFrame) -> DataFrame:
    """First comma-separated field of each line, trimmed, lower-cased, without repeats."""
    word = F.lower(F.trim(F.trim(F.split("value", ",")[0]), F.lit('"')))
    return lines.select(word.alias("word")).filter("word <> ''").distinct()


def parse_valence(lines: DataFrame) -> DataFrame:
    """``word<TAB>valence[...]`` lines to (word, valence)."""
    parts = F.split(F.col("value"), "\t")
    return lines.select(
        F.trim(parts[0]).alias("word"), F.get(parts, F.lit(1)).try_cast("double").alias("valence")
    ).filter("word <> '' AND valence IS NOT NULL")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def fits_broadcast(lexicon: DataFrame) -> bool:
    """Few enough words to be sent to every task? Counts no further than the bound."""
    return lexicon.limit(MAX_BROADCAST_WORDS + 1).count() <= MAX_BROADCAST_WORDS


@dataclass(frozen=True)
class LexiconTables:
    """Lexicons of any size: ``words`` (word, is_pos, is_neg, is_negation, emotions) and
    ``valence`` (word, valence), and the short lists of the valence rules."""

    words: DataFrame
    valence: DataFrame
    negations: Sequence[str] = tuple(fv.NEGATIONS)
    boosters: Sequence[str] = tuple(fv.INTENSIFIERS)
    dampeners: Sequence[str] = tuple(fv.DAMPENERS)
    phrases: Sequence[str] = tuple(fv.DAMPENING_PHRASES)


def load_tables(
    spark: SparkSession,
    polarity_path: str | None = None,
    emotion_path: str | None = None,
    negation_path: str | None = None,
    valence_path: str | None = None,
) -> LexiconTables:
    """Lexicons from files as tables, the built-in lists where no file is given."""
    built = as_tables(spark, Lexicons())
    parts = {
        "polarity": built.words.select("word", "is_pos", "is_neg"),
        "emotion": built.words.select("word", "emotions"),
        "negation": built.words.filter("is_negation").select("word"),
    }
    if polarity_path:
        parts["polarity"] = parse_polarity(read_lines(spark, polarity_path))
    if emotion_path:
        parts["emotion"] = parse_emotions(read_lines(spark, emotion_path))
    if negation_path:
        parts["negation"] = parse_negations(read_lines(spark, negation_path))
    valence = parse_valence(read_lines(spark, valence_path)) if valence_path else built.valence
    negated = parts["negation"].withColumn("is_negation", F.lit(True))
    rows = (
        parts["polarity"]
        .unionByName(parts["emotion"], allowMissingColumns=True)
        .unionByName(negated, allowMissingColumns=True)
    )
    return LexiconTables(one_row_per_word(rows), valence)


def one_row_per_word(rows: DataFrame) -> DataFrame:
    """(word, is_pos, is_neg, is_negation, emotions): a repeated word has the flags and emotions
    of all its rows, missing ones count as false and none."""
    flags = ("is_pos", "is_neg", "is_negation")
    merged = rows.groupBy("word").agg(
        *(F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in flags),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("emotions")))).alias("emotions"),
    )
    return merged.filter(F.col("word").isNotNull())


def as_tables(spark: SparkSession, lexicons: Lexicons) -> LexiconTables:
    """Lists given as Python values, as tables."""
    by_word: dict[str, list[str]] = {}
    for cls, words in lexicons.emotions.items():
        for word in words:
            by_word.setdefault(word, []).append(cls)
    felt = spark.createDataFrame(list(by_word.items()), "word string, emotions array<string>")
    rows = lexicon_table(spark, lexicons).unionByName(felt, allowMissingColumns=True)
    valence = spark.createDataFrame(
        [(w, float(v)) for w, v in lexicons.valence.items()], "word string, valence double"
    )
    return LexiconTables(
        one_row_per_word(rows), valence, lexicons.negations, lexicons.intensifiers
    )


def load_lexicons(
    spark: SparkSession,
    polarity_path: str | None = None,
    emotion_path: str | None = None,
    negation_path: str | None = None,
    valence_path: str | None = None,
) -> Lexicons:
    """Short lexicons from files as lists for the in-row form, the built-in lists where no file
    is given. Files of any size are read by :func:`load_tables`."""
    changed: dict = {}
    if polarity_path:
        rows = parse_polarity(read_lines(spark, polarity_path)).collect()
        changed["positive"] = sorted(r.word for r in rows if r.is_pos)
        changed["negative"] = sorted(r.word for r in rows if r.is_neg)
    if emotion_path:
        rows = parse_emotions(read_lines(spark, emotion_path)).collect()
        changed["emotions"] = {
            cls: sorted(r.word for r in rows if cls in r.emotions) for cls in fv.EMOTION_CLASSES
        }
    if negation_path:
        rows = parse_negations(read_lines(spark, negation_path)).collect()
        changed["negations"] = sorted(r.word for r in rows)
    if valence_path:
        rows = parse_valence(read_lines(spark, valence_path)).collect()
        changed["valence"] = {r.word: r.valence for r in rows}
    return Lexicons(**changed)


def lexicon_table(spark: SparkSession, lexicons: Lexicons) -> DataFrame:
    """(word, is_pos, is_neg, is_negation) rows of the built-in or loaded lists."""
    up, down, turn = map(set, (lexicons.positive, lexicons.negative, lexicons.negations))
    return spark.createDataFrame(
        [(w, w in up, w in down, w in turn) for w in sorted(up | down | turn)],
        "word string, is_pos boolean, is_neg boolean, is_negation boolean",
    )


def builtin_table(spark: SparkSession) -> DataFrame:
    """(list, word) rows of every built-in list."""
    lists = {
        "positive": fv.POSITIVE_WORDS,
        "negative": fv.NEGATIVE_WORDS,
        "negation": fv.NEGATIONS,
        "intensifier": fv.INTENSIFIERS,
        **fv.EMOTION_WORDS,
    }
    return spark.createDataFrame(
        [(name, word) for name, words in lists.items() for word in words],
        "list string, word string",
    )
