"""Text features per review, through joins with lexicon tables or, for short lists, in the row."""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastelens import fixed_values as fv
from tastelens.functions import lexicon as L
from tastelens.functions.scalar import half_even, safe_div
from tastelens.functions.text import bind, tokenize
from tastelens.operators.rows import compute_once
from tastelens.sources.lexicons import Lexicons, LexiconTables, fits_broadcast


def with_text_features(
    df: DataFrame,
    lexicons: Lexicons | LexiconTables,
    text: str = "combined_text",
    valence: bool = True,
) -> DataFrame:
    """Token counts, lexicon sentiment, emotions and valence as extra columns of the same row.

    Tables are joined, lists are compiled into the row; both give the same.
    """
    if isinstance(lexicons, LexiconTables):
        return features_by_join(df, lexicons, text, valence)
    source = F.coalesce(F.col(text), F.lit(""))

    def features(tokens):
        return F.struct(
            F.size(tokens).cast("bigint").alias("token_count"),
            F.size(F.array_distinct(tokens)).cast("bigint").alias("unique_token_count"),
            L.lexicon_sentiment(
                tokens, lexicons.positive, lexicons.negative, lexicons.negations
            ).alias("lexicon"),
            L.emotion_profile(tokens, lexicons.emotions).alias("emotion"),
        )

    wide = compute_once(df, {"_tok": bind(tokenize(source), features)})
    parts = ["_tok.token_count", "_tok.unique_token_count", "_tok.lexicon.*", "_tok.emotion.*"]
    if valence:
        rules = L.valence_profile(
            source, lexicons.valence, lexicons.negations, lexicons.intensifiers
        )
        wide = compute_once(wide, {"_val": rules})
        parts.insert(2, "_val.*")
    return wide.select(*df.columns, *parts)


def tokens_by_row(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, position, token), 0-based positions."""
    return df.select(
        key, F.posexplode(tokenize(F.coalesce(F.col(text), F.lit(""))))
    ).select(key, F.col("pos").cast("bigint").alias("position"), F.col("col").alias("token"))


def match_tokens(df: DataFrame, lexicon: DataFrame, key: str, text: str) -> DataFrame:
    """Tokens found in the lexicon, with the lexicon columns.

    The lexicon is broadcast after its size is checked, otherwise tokens and words are merged and
    hot tokens split by AQE. Only matches survive, so whatever is shuffled later is the hits and
    not the text.
    """
    words = lexicon.withColumnRenamed("word", "token")
    side = F.broadcast(words) if fits_broadcast(lexicon) else words
    return tokens_by_row(df, key, text).join(side, "token", "inner")


def _with_row(df: DataFrame, key: str, text: str) -> DataFrame:
    """Adds ``_row``, a digest of key and text.

    Rows with one key but different texts, and rows without a key, stay apart; rows that are equal
    have equal hits, which are counted once and given to each.
    """
    named = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("n"))
    digest = F.md5(F.concat(named, F.lit("\u0000"), F.coalesce(F.col(text), F.lit(""))))
    return df.select(key, text, digest.alias("_row"))


def score_by_join(
    df: DataFrame, lexicon: DataFrame, key: str, text: str, window: int = fv.NEGATION_WINDOW
) -> DataFrame:
    """Lexicon sentiment for lexicons of any size, one row per row of ``df``.

    ``lexicon`` has word, is_pos, is_neg, is_negation; a repeated word has the flags of all its
    rows. Gives the rows of the in-row form.
    """
    words = lexicon.groupBy("word").agg(
        *(F.bool_or(c).alias(c) for c in ("is_pos", "is_neg", "is_negation"))
    )
    rows = _with_row(df, key, text)
    hits = match_tokens(rows, words, "_row", text).distinct()
    earlier = Window.partitionBy("_row").orderBy("position").rowsBetween(
        Window.unboundedPreceding, -1
    )
    last_negation = F.max(F.when(F.col("is_negation"), F.col("position"))).over(earlier)
    near = F.coalesce(F.col("position") - last_negation <= window, F.lit(False))
    scored = hits.withColumn("negated", near).filter("is_pos OR is_neg")
    counts = scored.groupBy("_row").agg(
        F.count_if(F.when(F.col("negated"), F.col("is_neg")).otherwise(F.col("is_pos"))).alias(
            "up"
        ),
        F.count_if(F.when(F.col("negated"), F.col("is_pos")).otherwise(F.col("is_neg"))).alias(
            "down"
        ),
        F.count_if("negated").alias("turned"),
    )
    filled = rows.select(key, "_row").join(counts, "_row", "left").na.fill(0, ["up", "down", "turned"])
    return filled.select(
        key, *L.sentiment_from_counts(F.col("up"), F.col("down"), F.col("turned"))
    )


def emotions_by_join(df: DataFrame, lexicon: DataFrame, key: str, text: str) -> DataFrame:
    """Emotion counts and ratios for lexicons of any size, one row per row of ``df``.

    ``lexicon`` has word, emotions; a repeated word has the emotions of all its rows.
    """
    short = list(fv.SHORT_EMOTIONS.items())
    words = lexicon.select("word", F.explode("emotions").alias("emotion")).groupBy("word").agg(
        F.array_sort(F.collect_set("emotion")).alias("emotions")
    )
    rows = _with_row(df, key, text)
    matched = match_tokens(rows, words, "_row", text).distinct()
    counts = matched.groupBy("_row").agg(
        *(
            F.count_if(F.array_contains("emotions", cls)).alias(f"_{cls}")
            for cls in fv.EMOTION_CLASSES
        )
    )
    source = F.coalesce(F.col(text), F.lit(""))
    sized = rows.select(key, "_row", F.size(tokenize(source)).alias("_tokens"))
    filled = sized.join(counts, "_row", "left").na.fill(
        0, ["_tokens", *(f"_{cls}" for cls in fv.EMOTION_CLASSES)]
    )
    total = F.greatest(F.col("_tokens"), F.lit(1))
    return filled.select(
        key,
        L.dominant_emotion({name: F.col(f"_{cls}") for cls, name in short}).alias(
            "dominant_emotion"
        ),
        *(F.col(f"_{cls}").alias(f"nrc_{cls}_count") for cls in fv.SIDE_CLASSES),
        *(F.col(f"_{cls}").alias(f"{name}_count") for cls, name in short),
        *(
            half_even(safe_div(F.col(f"_{cls}"), total), 6).alias(f"{name}_ratio")
            for cls, name in short
        ),
    )


# Bits of a word in the table of hits; emotions take the bits from EMOTION on, one per class.
POSITIVE, NEGATIVE, NEGATION, EMOTION = 1, 2, 4, 8


def hit_table(words: DataFrame | None, valence: DataFrame | None) -> DataFrame:
    """(word, flags, valence): all lexicons as one, a repeated word with all its flags and the
    largest of its valences."""

    def bit(test: Column, value: int) -> Column:
        return F.when(test, value).otherwise(0)

    parts = []
    if words is not None:
        flags = bit(F.col("is_pos"), POSITIVE) + bit(F.col("is_neg"), NEGATIVE)
        flags = flags + bit(F.col("is_negation"), NEGATION)
        for place, cls in enumerate(fv.EMOTION_CLASSES):
            flags = flags + bit(F.array_contains("emotions", cls), EMOTION << place)
        parts.append(words.select("word", flags.alias("flags"), F.lit(None).cast("double").alias("valence")))
    if valence is not None:
        parts.append(valence.select("word", F.lit(0).alias("flags"), F.col("valence").cast("double")))
    every = reduce(DataFrame.union, parts)
    return every.groupBy("word").agg(F.bit_or("flags").alias("flags"), F.max("valence").alias("valence"))


def fold_hits(hits: DataFrame, window: int) -> DataFrame:
    """One row per ``_row`` of hits (_row, at, flags, valence): up, down and turned, a count per
    emotion class, and ``valued`` (at, valence) in the order of the places.

    Places from 0 on are those of tokens, negative ones those of valence words, -1 the first. A hit
    with a negation among the ``window`` tokens before counts for the other side. Hits of one text
    come together sorted and are summed a batch at a time; copies of a hit count once.
    """
    classes = len(fv.EMOTION_CLASSES)
    bits = (POSITIVE, NEGATIVE, NEGATION, EMOTION)

    def fold(batches):
        positive, negative, negation, emotion = bits
        held = []
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                if not batch.num_rows:
                    continue
                ends = {batch.column(0)[n].as_py() for n in (0, -1)}
                if held and ends == {held[0].column(0)[0].as_py()}:
                    # nothing but more of the text that is held
                    held.append(batch)
                    continue
                held.append(batch)
            elif not held:
                return
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
            row = whole.column(0).dictionary_encode()
            text = row.indices.to_numpy()
            if batch is not None:
                # the last text may go on in the next batch
                last = int(np.searchsorted(text, text[-1]))
                held = [whole.slice(last)]
                if not last:
                    continue
                whole, text = whole.slice(0, last), text[:last]
            at = whole.column(1).to_numpy().astype(np.int64)
            once = np.ones(len(at), bool)
            once[1:] = (np.diff(text) != 0) | (np.diff(at) != 0)
            flags = whole.column(2).to_numpy()
            count = int(text[-1]) + 1

            def summed(test):
                return pa.array(np.bincount(text[test], minlength=count))

            token = once & (at >= 0)
            place = text * (np.int64(1) << 33) + at
            # sorted by place within the tokens of a text; far before the first is near to none
            turning = np.where(token & (flags & negation != 0), place, -(np.int64(1) << 40))
            before = np.maximum.accumulate(np.append(-(np.int64(1) << 40), turning[:-1]))
            near = token & (place - before <= window)
            up, down = flags & positive != 0, flags & negative != 0
            columns = [
                summed(token & np.where(near, down, up)), summed(token & np.where(near, up, down)),
                summed(near & (up | down)),
                *(summed(token & (flags & (emotion << n) != 0)) for n in range(classes)),
            ]
            valued = np.flatnonzero(once & (at < 0))[::-1]
            valued = valued[np.argsort(text[valued], kind="stable")]
            sizes = np.bincount(text[valued], minlength=count)
            pairs = pa.StructArray.from_arrays(
                [
                    pa.array((-1 - at[valued]).astype(np.int32)),
                    whole.column(3).take(pa.array(valued)),
                ],
                names=["at", "valence"],
            )
            bounds = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [row.dictionary.slice(0, count), *columns, pa.ListArray.from_arrays(bounds, pairs)],
                names=names,
            )

    counts = ["up", "down", "turned", *(f"_{cls}" for cls in fv.EMOTION_CLASSES)]
    names = ["_row", *counts, "_valued"]
    schema = ", ".join(f"{c} bigint" for c in counts)
    ordered = hits.select("_row", "at", "flags", "valence").repartition("_row")
    return ordered.sortWithinPartitions("_row", "at").mapInArrow(
        fold, f"_row binary, {schema}, _valued array<struct<at:int,valence:double>>"
    )


def _with_hits(
    rows: DataFrame, table: DataFrame, source: Column, polar: bool, valence: bool,
    window: int = fv.NEGATION_WINDOW,
) -> DataFrame:
    """Adds the columns of :func:`fold_hits` to ``rows``, whose texts are named by their digest
    ``_row``; they are null for a text without hits.

    Tokens and valence words of a text are spread once, meet the table once, and what matches is
    folded into one short row per distinct text; the texts themselves are not shuffled for it.
    """
    none = F.array().cast("array<string>")
    tokens = tokenize(source) if polar else none
    others = F.transform(L.valence_words(source), lambda w: F.lower(w)) if valence else none
    spread = bind(
        tokens, lambda t: F.struct(F.size(t).alias("n"), F.concat(t, others).alias("words"))
    )
    # positions from n on are those of the valence words
    spots = compute_once(rows, {"_spread": spread}).select(
        "_row", F.col("_spread.n").alias("n"), F.posexplode("_spread.words").alias("at", "word")
    ).select(
        "_row", "word",
        F.when(F.col("at") < F.col("n"), F.col("at")).otherwise(F.col("n") - F.col("at") - 1).alias("at"),
    )
    side = F.broadcast(table) if fits_broadcast(table) else table
    hits = spots.join(side, "word").filter(
        F.when(F.col("at") >= 0, F.col("flags") != 0).otherwise(F.col("valence").isNotNull())
    )
    return rows.join(fold_hits(hits, window), "_row", "left")


def _valence_of_hits(source: Column, hits: Column, lexicons: LexiconTables) -> Column:
    """Struct (compound, neg, neu, pos) of a text and the places of its scored words."""

    def scored(cased: Column, ordered: Column) -> Column:
        def score(hit: Column, number: Column) -> Column:
            def carries(back: Column) -> Column:
                nearest = (F.get(ordered, number - b)["at"] for b in (1, 2, 3))
                return reduce(
                    lambda a, b: a | b,
                    (F.coalesce(n == hit["at"] - back, F.lit(False)) for n in nearest),
                )

            return bind(
                L.in_context(cased, hit["at"]),
                lambda h: L.word_score(
                    h, hit.valence, carries, lexicons.negations, lexicons.boosters,
                    lexicons.dampeners, lexicons.phrases,
                ),
            )

        return F.transform(ordered, score)

    def shares(words: Column) -> Column:
        scores = bind(
            F.struct(L.cased_words(words).alias("c"), F.array_sort(hits).alias("o")),
            lambda s: scored(s.c, s.o),
        )
        some = F.when(F.size(hits) > 0, scores).otherwise(F.array().cast("array<double>"))
        return L.valence_shares(some, F.size(words), L.valence_emphasis(source))

    return bind(L.valence_words(source), shares)


def valence_by_join(df: DataFrame, lexicons: LexiconTables, text: str = "combined_text") -> DataFrame:
    """The valence columns of :func:`with_text_features` alone."""
    source = F.coalesce(F.col(text), F.lit(""))
    rows = df.withColumn("_row", F.unhex(F.md5(source)))
    wide = _with_hits(rows, hit_table(None, lexicons.valence), source, False, True)
    hits = F.coalesce("_valued", F.array().cast("array<struct<at:int,valence:double>>"))
    return compute_once(wide, {"_val": _valence_of_hits(source, hits, lexicons)}).select(
        *df.columns, "_val.*"
    )


def features_by_join(
    df: DataFrame,
    lexicons: LexiconTables,
    text: str = "combined_text",
    valence: bool = True,
    window: int = fv.NEGATION_WINDOW,
) -> DataFrame:
    """The columns of :func:`with_text_features` with lexicons of any size.

    Features depend on the text alone, so hits are kept once per digest of a text, however many
    rows repeat it, and given to each of them. A missing text counts as empty.
    """
    source = F.coalesce(F.col(text), F.lit(""))
    rows = df.withColumn("_row", F.unhex(F.md5(source)))
    table = hit_table(lexicons.words, lexicons.valence if valence else None)
    counts = ["up", "down", "turned", *(f"_{cls}" for cls in fv.EMOTION_CLASSES)]
    wide = _with_hits(rows, table, source, True, valence, window)
    facts = {
        "_size": bind(
            tokenize(source),
            lambda t: F.struct(
                F.size(t).cast("bigint").alias("token_count"),
                F.size(F.array_distinct(t)).cast("bigint").alias("unique_token_count"),
            ),
        ),
        "_found": F.struct(*(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts)),
    }
    if valence:
        valued = F.coalesce("_valued", F.array().cast("array<struct<at:int,valence:double>>"))
        facts["_val"] = _valence_of_hits(source, valued, lexicons)
    wide = compute_once(wide, facts)
    short = list(fv.SHORT_EMOTIONS.items())
    total = F.greatest(F.col("_size.token_count"), F.lit(1))
    return wide.select(
        *df.columns,
        "_size.token_count",
        "_size.unique_token_count",
        *(["_val.*"] if valence else []),
        *L.sentiment_from_counts(F.col("_found.up"), F.col("_found.down"), F.col("_found.turned")),
        L.dominant_emotion({name: F.col(f"_found._{cls}") for cls, name in short}).alias(
            "dominant_emotion"
        ),
        *(F.col(f"_found._{cls}").alias(f"nrc_{cls}_count") for cls in fv.SIDE_CLASSES),
        *(F.col(f"_found._{cls}").alias(f"{name}_count") for cls, name in short),
        *(
            half_even(safe_div(F.col(f"_found._{cls}"), total), 6).alias(f"{name}_ratio")
            for cls, name in short
        ),
    )


def list_hits(df: DataFrame, lists: DataFrame, key: str, text: str) -> DataFrame:
    """Hits per word list; ``lists`` has list, word."""
    hits = match_tokens(df, lists, key, text)
    counted = hits.groupBy("list").agg(
        F.count(F.lit(1)).alias("hits"), F.count_distinct("token").alias("words_seen")
    )
    sizes = lists.groupBy("list").agg(F.count(F.lit(1)).alias("words"))
    return sizes.join(counted, "list", "left").na.fill(0, ["hits", "words_seen"])


def polarity_columns() -> Sequence[str]:
    return (
        "lexicon_positive_count", "lexicon_negative_count", "lexicon_negated_hits",
        "lexicon_sentiment_total", "lexicon_sentiment_score", "lexicon_sentiment_label",
    )
