"""Feature engineering as relational operators; fitted statistics are single small rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastelens import fixed_values as fv
from tastelens.functions.text import words_and_pairs
from tastelens.operators.ranking import quantiles

# Words of two or more letters, digits or underscores, in any script.
WORD_PATTERN = r"(?U)\b\w\w+\b"


# --- numbers and categories ----------------------------------------------------------------------


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(name, median) of several numeric columns from one pass over counts per value."""
    numbers = df.select(*(F.col(c).cast("double").alias(c) for c in columns))
    long = numbers.unpivot([], list(columns), "name", "value")
    return quantiles(long, "value", {"median": 0.5}, ["name"]).select("name", "median")


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing numbers become the exact median of their column."""
    if not columns:
        return df
    found = medians(df, columns).agg(
        F.map_from_entries(F.collect_list(F.struct("name", "median")))
    ).scalar()
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.try_element_at(found, F.lit(c))) for c in columns}
    )


def mode_of(df: DataFrame, column: str) -> DataFrame:
    """Most frequent value, the smallest on ties, as a one-row table."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return counts.orderBy(F.desc("_n"), F.asc(column)).limit(1).select(column)


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(F.col(c), mode_of(df.select(c), c).scalar()) for c in columns}
    )


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zero mean, unit population deviation; a constant column is only centred."""
    moments = df.agg(
        F.struct(
            *(F.avg(c).alias(f"{c}_mean") for c in columns),
            *(F.stddev_pop(c).alias(f"{c}_dev") for c in columns),
        )
    ).scalar()

    def scaled(c: str) -> Column:
        dev = moments[f"{c}_dev"]
        return (F.col(c) - moments[f"{c}_mean"]) / F.when(dev > 0, dev).otherwise(1.0)

    return df.withColumns({c: scaled(c) for c in columns})


def categories_of(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values, one output column each in :func:`one_hot`."""
    found = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return sorted(r[0] for r in found.collect())


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(name, mode) of several categorical columns, the smallest value on ties."""
    texts = df.select(*(F.col(c).cast("string").alias(c) for c in columns))
    counts = (
        texts.unpivot([], list(columns), "name", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    first = F.min(F.struct((-F.col("n")).alias("minus"), "value"))
    return counts.groupBy("name").agg(first.alias("f")).select("name", F.col("f.value").alias("mode"))


def one_hot(df: DataFrame, column: str, categories: Sequence[str]) -> DataFrame:
    """0/1 column per category; unknown and missing values give zeros everywhere."""
    return df.withColumns(
        {
            f"{column}_{c}": F.coalesce((F.col(column) == F.lit(c)).cast("int"), F.lit(0))
            for c in categories
        }
    )


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """Balanced weight n / (classes * n_class) per class, and the negative/positive ratio."""
    counts = df.filter(F.col(target).isNotNull()).groupBy(target).agg(
        F.count(F.lit(1)).alias("n")
    )
    total = counts.agg(
        F.struct(
            F.sum("n").alias("rows"),
            F.count(F.lit(1)).alias("classes"),
            F.try_divide(
                F.sum(F.when(F.col(target) == 0, F.col("n"))),
                F.sum(F.when(F.col(target) == 1, F.col("n"))),
            ).alias("ratio"),
        )
    ).scalar()
    return counts.select(
        target,
        "n",
        (total.rows / (total.classes * F.col("n"))).alias("weight"),
        total.ratio.alias("neg_pos_ratio"),
    )


def with_class_weight(df: DataFrame, target: str, out: str = "weight") -> DataFrame:
    """Balanced class weight on every row of a 0/1 target."""
    share = df.agg(F.avg(F.col(target).cast("double"))).scalar()
    mine = F.when(F.col(target) == 1, share).otherwise(1 - share)
    return df.withColumn(out, F.lit(0.5) / mine)


# --- words ------------------------------------------------------------------------------------------


def terms(text: Column, n_max: int = 2, pattern: str = WORD_PATTERN) -> Column:
    words = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))
    return words_and_pairs(words, n_max)


def ngrams(
    df: DataFrame, key: str, text: str, n_max: int = 2, pattern: str = WORD_PATTERN
) -> DataFrame:
    """(key, term), one row per occurrence."""
    return df.select(key, F.explode(terms(F.col(text), n_max, pattern)).alias("term"))


def term_counts(df: DataFrame, text: str, n_max: int, pattern: str = WORD_PATTERN) -> DataFrame:
    """(term, doc_freq, term_count) in one shuffle by term.

    The terms of a batch of texts are numbered, sorted and counted there, so pairs are joined once
    per batch and what Spark adds up are counts per batch and term.
    """

    def tally(keys, rows, count):
        """Distinct keys, the rows that hold them and their occurrences."""
        placed = np.sort(keys * count + rows)
        found = placed // count
        starts = np.flatnonzero(np.diff(found, prepend=-1))
        new = np.diff(placed, prepend=-1) != 0
        return found[starts], np.add.reduceat(new, starts, dtype=np.int64), np.diff(starts, append=len(found))

    def counted(batches):
        for batch in batches:
            # numbers of pairs and rows fit 63 bits in slices of this size
            for at in range(0, batch.num_rows, 4096):
                words = batch.column(0).slice(at, 4096)
                flat = words.flatten().dictionary_encode()
                known, keys = flat.dictionary, flat.indices.to_numpy().astype(np.int64)
                if not len(keys):
                    continue
                size, count = len(known), len(words)
                rows = np.repeat(np.arange(count), pc.list_value_length(words).to_numpy())
                if n_max > 1:
                    near = np.flatnonzero(rows[1:] == rows[:-1])
                    keys = np.concatenate([keys, size + keys[near] * size + keys[near + 1]])
                    rows = np.concatenate([rows, rows[near]])
                found, documents, times = tally(keys, rows, count)
                pairs = np.divmod(found[np.searchsorted(found, size) :] - size, size)
                first, second = (known.take(pa.array(n)) for n in pairs)
                joined = pc.binary_join_element_wise(first, second, " ")
                names = pa.concat_arrays([known.take(pa.array(found[found < size])), joined])
                if pc.any(pc.match_substring(known, " ")).as_py():
                    # such a word may be a pair, too
                    again = names.dictionary_encode()
                    number = again.indices.to_numpy().astype(np.int64)
                    found, documents, times = tally(
                        number[np.searchsorted(found, keys)], rows, count
                    )
                    names = again.dictionary.take(pa.array(found))
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(documents), pa.array(times)],
                    names=["term", "doc_freq", "term_count"],
                )

    words = df.select(F.coalesce(terms(F.col(text), 1, pattern), F.array()).alias("w"))
    parts = words.mapInArrow(counted, "term string, doc_freq bigint, term_count bigint")
    return parts.groupBy("term").agg(
        F.sum("doc_freq").alias("doc_freq"), F.sum("term_count").alias("term_count")
    )


def vocabulary(
    df: DataFrame,
    text: str,
    n_max: int = 2,
    min_df: int = fv.MIN_DOC_FREQ,
    max_features: int = fv.MAX_FEATURES,
    pattern: str = WORD_PATTERN,
) -> DataFrame:
    """The most frequent terms found in enough documents, numbered in alphabetical order."""
    kept = (
        term_counts(df, text, n_max, pattern)
        .filter(F.col("doc_freq") >= min_df)
        .orderBy(F.desc("term_count"), F.asc("term"))
        .limit(max_features)
    )
    # at most max_features rows are left to number
    number = F.row_number().over(Window.orderBy("term")) - 1
    return kept.withColumn("term_id", number)


def tfidf(
    df: DataFrame,
    key: str,
    text: str,
    vocab: DataFrame,
    documents: int | Column,
    n_max: int = 2,
    pattern: str = WORD_PATTERN,
) -> DataFrame:
    """(key, term, term_id, weight): tf * (ln((1+N)/(1+df)) + 1), unit length per document.

    The vocabulary is limited to ``max_features`` rows and sent to every task. Terms are counted
    and weighed in the row of their document, so no term is shuffled; only rows that share a key
    are brought together first.
    """
    n = documents
    if isinstance(documents, Column):
        n = df.sparkSession.range(1).select(documents.alias("n")).first()["n"]
    held = vocab.select("term", "term_id", "doc_freq").orderBy("term_id").collect()
    known = df.sparkSession.createDataFrame(
        [(place, r.term, r.term_id) for place, r in enumerate(held)],
        "_place int, term string, term_id int",
    )
    words = df.select(
        key, F.coalesce(terms(F.col(text), n_max, pattern), F.array()).alias("_terms")
    )
    if not df.groupBy(key).count().filter(F.col("count") > 1).isEmpty():
        words = words.groupBy(key).agg(F.flatten(F.collect_list("_terms")).alias("_terms"))
    stages = [
        CountVectorizerModel.from_vocabulary(
            [r.term for r in held] or [""], inputCol="_terms", outputCol="_tf"
        ),
        ElementwiseProduct(
            scalingVec=Vectors.dense(
                [math.log((n + 1) / (r.doc_freq + 1)) + 1 for r in held] or [1.0]
            ),
            inputCol="_tf", outputCol="_raw",
        ),
        Normalizer(p=2.0, inputCol="_raw", outputCol="_unit"),
    ]
    for stage in stages:
        words = stage.transform(words)
    plain = F.unwrap_udt(F.col("_unit"))
    entries = F.arrays_zip(plain["indices"].alias("_place"), plain["values"].alias("weight"))
    found = words.select(key, F.inline(entries))
    return found.join(F.broadcast(known), "_place").select(key, "term", "term_id", "weight")
