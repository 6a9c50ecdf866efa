"""In-row lexicon scoring of token arrays: no shuffle, no Python.

Word lists are literals, so membership is one hash lookup per token. Lexicons too large for a
literal go through :mod:`tastelens.operators.sentiment`, which joins instead.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tastelens import fixed_values as fv
from tastelens.functions.scalar import half_even, safe_div
from tastelens.functions.text import bind



def _count(items: Column, test) -> Column:
    return F.size(F.filter(items, test)).cast("bigint")


def _in_words(words: Sequence[str]):
    return lambda token: token.isin(list(words))


def _preceded_by(tokens: Column, position: Column, words: Sequence[str], window: int) -> Column:
    """Is one of ``words`` among the ``window`` tokens before the 0-based position?"""
    start = F.greatest(position - window + 1, F.lit(1))
    before = F.slice(tokens, start, F.least(position, F.lit(window)))
    return F.exists(before, lambda t: t.isin(list(words)))


def sentiment_hits(
    tokens: Column,
    positive: Sequence[str],
    negative: Sequence[str],
    negations: Sequence[str],
    window: int = fv.NEGATION_WINDOW,
) -> Column:
    """One struct (position, token, up, down, negated) per token found in either list."""
    either = sorted(set(positive) | set(negative))

    def hits(toks: Column) -> Column:
        def hit(token: Column, position: Column) -> Column:
            return F.when(
                token.isin(either),
                F.struct(
                    position.cast("bigint").alias("position"),
                    token.alias("token"),
                    token.isin(list(positive)).alias("up"),
                    token.isin(list(negative)).alias("down"),
                    _preceded_by(toks, position, negations, window).alias("negated"),
                ),
            )

        return F.filter(F.transform(toks, hit), lambda h: h.isNotNull())

    return bind(tokens, hits)


def sentiment_from_counts(up: Column, down: Column, negated: Column) -> list[Column]:
    """The six lexicon columns; the label follows the sign of the unrounded score."""
    score = safe_div(up - down, up + down)
    label = F.when(up > down, "positive").when(up < down, "negative").otherwise("neutral")
    return [
        up.alias("lexicon_positive_count"),
        down.alias("lexicon_negative_count"),
        negated.alias("lexicon_negated_hits"),
        (up + down).alias("lexicon_sentiment_total"),
        half_even(score, 6).alias("lexicon_sentiment_score"),
        label.alias("lexicon_sentiment_label"),
    ]


def lexicon_sentiment(
    tokens: Column,
    positive: Sequence[str],
    negative: Sequence[str],
    negations: Sequence[str],
    window: int = fv.NEGATION_WINDOW,
) -> Column:
    """Negation-aware polarity of one text as a struct of the six lexicon columns."""

    def summarise(hits: Column) -> Column:
        counts = F.struct(
            _count(hits, lambda h: F.when(h.negated, h.down).otherwise(h.up)).alias("up"),
            _count(hits, lambda h: F.when(h.negated, h.up).otherwise(h.down)).alias("down"),
            _count(hits, lambda h: h.negated).alias("negated"),
        )
        return bind(counts, lambda c: F.struct(*sentiment_from_counts(c.up, c.down, c.negated)))

    return bind(sentiment_hits(tokens, positive, negative, negations, window), summarise)


def emotion_profile(tokens: Column, emotions: Mapping[str, Sequence[str]]) -> Column:
    """Counts, ratios and the dominant emotion of one text as a struct.

    ``emotions`` maps a class name (``joy``, ``trust``, ...) to its words; a word may be in many.
    """
    known = sorted({w for words in emotions.values() for w in words})
    short = list(fv.SHORT_EMOTIONS.values())

    def counted(toks: Column) -> Column:
        def per_class(hits: Column) -> Column:
            return F.struct(
                F.size(toks).alias("tokens"),
                *(
                    _count(hits, _in_words(emotions.get(cls, ()))).alias(cls)
                    for cls in fv.EMOTION_CLASSES
                ),
            )

        return bind(F.filter(toks, lambda t: t.isin(known)), per_class)

    def describe(c: Column) -> Column:
        total = F.greatest(c.tokens, F.lit(1))
        counts = {name: c[cls] for cls, name in fv.SHORT_EMOTIONS.items()}
        return F.struct(
            dominant_emotion(counts).alias("dominant_emotion"),
            *(c[cls].alias(f"nrc_{cls}_count") for cls in fv.SIDE_CLASSES),
            *(counts[name].alias(f"{name}_count") for name in short),
            *(
                half_even(safe_div(counts[name], total), 6).alias(f"{name}_ratio")
                for name in short
            ),
        )

    return bind(bind(tokens, counted), describe)


def dominant_emotion(counts: Mapping[str, Column]) -> Column:
    """Name of the largest count, the earlier name on ties, ``none`` when all are 0."""
    largest = F.greatest(*counts.values())
    choice = F.when(largest == 0, "none")
    for name, count in counts.items():
        choice = choice.when(count == largest, name)
    return choice


def intensifier_count(tokens: Column, words: Sequence[str] = fv.INTENSIFIERS) -> Column:
    return _count(tokens, lambda t: t.isin(list(words)))


# --- valence ---------------------------------------------------------------------------------


def valence_words(text: Column) -> Column:
    """White-space words without outer punctuation; very short ones (``:)``) stay as they are."""

    def strip_punctuation(word: Column) -> Column:
        bare = F.trim(word, F.lit(string.punctuation))
        return F.when(F.length(bare) <= 2, word).otherwise(bare)

    return F.transform(F.filter(F.split(text, r"\s+"), lambda w: w != ""), strip_punctuation)


def _lookup(word: Column, table: Mapping[str, float]) -> Column:
    """Valence of a word: one lookup for a miss, then one per distinct valence for a hit."""
    by_value: dict[float, list[str]] = defaultdict(list)
    for key, value in table.items():
        by_value[float(value)].append(key)
    if not by_value:
        return F.lit(None).cast("double")
    found = F
    for value, words in by_value.items():  # one flat CASE, however many valences there are
        found = found.when(word.isin(words), F.lit(value))
    return F.when(word.isin(list(table)), found)


def _sign(value: Column) -> Column:
    return F.when(value < 0, -1.0).otherwise(1.0)


def compound(total: Column) -> Column:
    """Squash a valence sum into (-1, 1)."""
    return total / F.sqrt(total * total + fv.COMPOUND_ALPHA)


def valence_sum(tokens: Column, table: Mapping[str, float]) -> Column:
    return F.aggregate(
        F.transform(tokens, lambda t: F.coalesce(_lookup(t, table), F.lit(0.0))),
        F.lit(0.0),
        lambda total, v: total + v,
    )


def cased_words(words: Column) -> Column:
    """Struct of the words in lower case, which of them are ``loud`` (capitals), mixed_case of the
    text and the position of its first *but*."""
    cased = F.struct(
        F.transform(words, lambda w: F.lower(w)).alias("lower"),
        # most words are lower case already and are not compared any further
        F.transform(words, lambda w: (w != F.lower(w)) & (w == F.upper(w))).alias("loud"),
    )

    def described(c: Column) -> Column:
        return F.struct(
            c.lower.alias("lower"),
            c.loud.alias("loud"),
            (F.exists(c.loud, lambda x: x) & F.exists(c.loud, lambda x: ~x)).alias("mixed_case"),
            (F.array_position(c.lower, F.lit("but")) - 1).alias("but_at"),
        )

    return bind(cased, described)


def in_context(cased: Column, position: Column, *more: Column) -> Column:
    """Struct of one word of :func:`cased_words`: position, word, the words ``before`` it (itself
    at 0), which of them are ``loud``, the next word, mixed_case and but_at of the text, and
    ``more``."""

    def back(items: Column) -> Column:
        """The item at a 0-based position and the three before it, null before the first."""
        return F.array(*(F.get(items, F.when(position >= b, position - b)) for b in range(4)))

    return F.struct(
        position.alias("position"),
        F.get(cased.lower, position).alias("word"),
        back(cased.lower).alias("before"),
        back(cased.loud).alias("loud"),
        F.get(cased.lower, position + 1).alias("next"),
        cased.mixed_case.alias("mixed_case"),
        cased.but_at.alias("but_at"),
        *more,
    )


def valence_words_in_context(text: Column) -> Column:
    """One struct per word, see :func:`in_context`."""
    return bind(
        cased_words(valence_words(text)),
        lambda c: F.transform(c.lower, lambda _, position: in_context(c, position)),
    )


def word_score(
    hit: Column,
    valence: Column,
    carries: Callable[[Column], Column],
    negations: Sequence[str] = fv.NEGATIONS,
    boosters: Sequence[str] = fv.INTENSIFIERS,
    dampeners: Sequence[str] = fv.DAMPENERS,
    phrases: Sequence[str] = fv.DAMPENING_PHRASES,
) -> Column:
    """Valence of one word in its context, see :func:`valence_words_in_context`.

    ``carries`` tells of the word so many places back whether it has a valence of its own.
    """
    strengthen = {w: fv.BOOST for w in boosters} | {w: -fv.BOOST for w in dampeners}

    def word_back(back: Column | int) -> Column:
        return F.get(hit.before, F.lit(back) if isinstance(back, int) else back)

    def emphasised(back: Column) -> Column:
        """A word in capitals in a text that is not all capitals."""
        return hit.mixed_case & F.coalesce(F.get(hit.loud, back), F.lit(False))

    def between(back: Column, test) -> Column:
        nearer = F.sequence(F.lit(1), F.greatest(back - 1, F.lit(1)))
        return F.coalesce(
            F.exists(nearer, lambda b: (b < back) & test(word_back(b))), F.lit(False)
        )

    def step(value: Column, back: Column) -> Column:
        previous = word_back(back)
        push = _lookup(previous, strengthen) * _sign(value) + F.when(
            emphasised(back), fv.CAPS_BOOST * _sign(value)
        ).otherwise(0.0)
        damping = F.element_at(F.lit(list(fv.LOOKBACK_DAMPING)), back)
        pushed = value + F.coalesce(push, F.lit(0.0)) * damping
        turned = (
            F.when((previous == "never") & between(back, lambda w: w.isin("so", "this")),
                   pushed * fv.NEVER_SO_FACTOR)
            .when((previous == "without") & between(back, lambda w: w == "doubt"), pushed)
            .when(
                previous.isin(list(negations)) | F.endswith(previous, F.lit("n't")),
                pushed * fv.NEGATED_FACTOR,
            )
            .otherwise(pushed)
        )
        # a previous word that itself carries valence neither pushes nor negates
        plain = previous.isNotNull() & ~carries(back)
        return F.when(plain, turned).otherwise(value)

    raised = valence + F.when(
        emphasised(F.lit(0)), fv.CAPS_BOOST * _sign(valence)
    ).otherwise(0.0)
    value = F.aggregate(F.array(F.lit(1), F.lit(2), F.lit(3)), raised, step)

    def phrase(first: Column, second: Column) -> Column:
        found = F.concat_ws(" ", first, second).isin(list(phrases))
        return F.when(found, -fv.BOOST).otherwise(0.0)

    # phrases are looked for only where the third word back exists and has no valence
    reached = word_back(3).isNotNull() & ~carries(F.lit(3))
    value = value + F.when(
        reached,
        phrase(word_back(3), word_back(2)) + phrase(word_back(2), word_back(1)),
    ).otherwise(0.0)
    least = (word_back(1) == "least") & ~F.coalesce(
        word_back(2).isin("at", "very"), F.lit(False)
    )
    value = F.when(F.coalesce(least, F.lit(False)), value * fv.NEGATED_FACTOR).otherwise(value)
    around_but = (
        F.when(hit.but_at < 0, 1.0)
        .when(hit.position < hit.but_at, fv.BUT_BEFORE)
        .when(hit.position > hit.but_at, fv.BUT_AFTER)
        .otherwise(1.0)
    )
    opens_phrase = F.coalesce(
        F.concat_ws(" ", hit.word, hit.next).isin(list(phrases)), F.lit(False)
    )
    booster = hit.word.isin(list(strengthen)) | opens_phrase
    return F.when(valence.isNull() | booster, 0.0).otherwise(value * around_but)


def valence_emphasis(text: Column) -> Column:
    """What exclamation and question marks add."""
    exclamations = F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))
    questions = F.length(text) - F.length(F.replace(text, F.lit("?"), F.lit("")))
    return F.least(exclamations, F.lit(fv.EXCLAMATION_MAX)) * fv.EXCLAMATION_STEP + (
        F.when(questions > 3, fv.QUESTION_FULL)
        .when(questions > 1, questions * fv.QUESTION_STEP)
        .otherwise(0.0)
    )


def valence_shares(scores: Column, words: Column, emphasis: Column) -> Column:
    """Struct (compound, neg, neu, pos) from the scores of a text of so many words; scores of
    zero may be left out."""

    def shares(s: Column) -> Column:
        def total(test, gain):
            return F.aggregate(
                F.filter(s.scores, test), F.lit(0.0), lambda acc, v: acc + v + gain
            )

        def finish(t: Column) -> Column:
            raised = (
                F.when(t.total > 0, t.total + s.emphasis)
                .when(t.total < 0, t.total - s.emphasis)
                .otherwise(t.total)
            )
            up = t.up + F.when(t.up > t.down, s.emphasis).otherwise(0.0)
            down = t.down + F.when(t.down > t.up, s.emphasis).otherwise(0.0)
            whole = up + down + t.flat
            return F.struct(
                F.when(s.words == 0, 0.0).otherwise(half_even(compound(raised), 4)).alias(
                    "vader_compound"
                ),
                half_even(safe_div(down, whole), 3).alias("vader_neg"),
                half_even(safe_div(t.flat, whole), 3).alias("vader_neu"),
                half_even(safe_div(up, whole), 3).alias("vader_pos"),
            )

        return bind(
            F.struct(
                F.aggregate(s.scores, F.lit(0.0), lambda acc, v: acc + v).alias("total"),
                total(lambda v: v > 0, 1.0).alias("up"),
                (-total(lambda v: v < 0, -1.0)).alias("down"),
                (s.words - F.size(F.filter(s.scores, lambda v: v != 0))).cast("double").alias(
                    "flat"
                ),
            ),
            finish,
        )

    return bind(
        F.struct(scores.alias("scores"), words.alias("words"), emphasis.alias("emphasis")), shares
    )


def valence_profile(
    text: Column,
    table: Mapping[str, float],
    negations: Sequence[str] = fv.NEGATIONS,
    boosters: Sequence[str] = fv.INTENSIFIERS,
    dampeners: Sequence[str] = fv.DAMPENERS,
    phrases: Sequence[str] = fv.DAMPENING_PHRASES,
) -> Column:
    """Struct (compound, neg, neu, pos) by the rules of the valence paper.

    Each word of the table scores its valence, changed by capitals, by boosters, dampening phrases
    and negations up to three words back and by a following or preceding *but*; punctuation adds
    emphasis. The table is compiled into the row; see ``features_by_join`` for tables.
    """

    def scored(hit: Column) -> Column:
        return word_score(
            hit, _lookup(hit.word, table),
            lambda back: F.get(hit.before, back).isin(list(table)),
            negations, boosters, dampeners, phrases,
        )

    hits = bind(
        valence_words_in_context(text),
        lambda items: F.struct(
            F.transform(F.filter(items, lambda h: h.word.isin(list(table))), scored).alias(
                "scores"
            ),
            F.size(items).alias("words"),
        ),
    )
    emphasis = valence_emphasis(text)
    return bind(hits, lambda h: valence_shares(h.scores, h.words, emphasis))
