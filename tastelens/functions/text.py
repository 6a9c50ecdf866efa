"""Column expressions on text: cleaning, quality measures, tokens, n-grams."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tastelens import fixed_values as fv

# White space as Unicode sees it; the Java class \s covers only the ASCII part.
SPACE = (
    r"\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
EMOJI_AND_BROKEN = r"\x{1F300}-\x{1FAFF}\x{FFFD}"
# Control, ASCII and precomposed Latin-1 letters never change under NFKC.
UNSTABLE_UNDER_NFKC = r"[^\x{00}-\x{9F}\x{C0}-\x{FF}]"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times inside ``body``.

    A projected expression used inside a lambda is copied into every use by the optimiser;
    a lambda variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


@F.pandas_udf(StringType())
def _nfkc(text: pd.Series) -> pd.Series:
    return text.str.normalize("NFKC") if text.notna().any() else text


def nfkc(text: Column) -> Column:
    """Unicode NFKC. Only text that can change is sent to Python, the rest travels as null."""
    return F.coalesce(_nfkc(F.when(text.rlike(UNSTABLE_UNDER_NFKC), text)), text)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{SPACE}]+|[{SPACE}]+$", "")


def tidy(text: Column) -> Column:
    """Plain quotes, dashes and dots; emoji and broken characters out; single spaces."""
    plain = F.translate(text, "‘’“”–—＆", "''\"\"--&")
    plain = F.replace(plain, F.lit("…"), F.lit("..."))
    return F.trim(F.regexp_replace(plain, f"[{EMOJI_AND_BROKEN}{SPACE}]+", " "))


def normalize_text(text: Column) -> Column:
    return tidy(nfkc(text))


def combine_title_text(title: Column, text: Column, stripped: bool = False) -> Column:
    """Title before text, unless one is empty or the text already opens with the title."""
    head, body = (title, text) if stripped else (strip(title), strip(text))
    return (
        F.when(body == "", head)
        .when(F.startswith(F.lower(body), F.lower(head)), body)
        .otherwise(F.concat(head, F.lit(" "), body))
    )


def ascii_ratio(text: Column) -> Column:
    """Share of code points below 128; 0 for empty text."""
    ascii_only = F.length(F.regexp_replace(text, r"[^\x00-\x7F]", ""))
    return (
        F.when(F.length(text) == 0, 0.0)
        .when(F.octet_length(text) == F.length(text), 1.0)
        .otherwise(ascii_only / F.length(text))
    )


def has_script(text: Column, char_class: str = fv.CJK_CLASS) -> Column:
    return text.rlike(char_class)


def tokenize(text: Column, pattern: str = fv.TOKEN_PATTERN) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def words_and_pairs(words: Column, n_max: int = 2) -> Column:
    """The words, followed (for ``n_max`` 2) by every pair of neighbours joined by a space."""
    if n_max == 1:
        return words
    return bind(
        words,
        lambda w: F.concat(
            w,
            F.zip_with(
                F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))),
                F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))),
                lambda a, b: F.concat(a, F.lit(" "), b),
            ),
        ),
    )
