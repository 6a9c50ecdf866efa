"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives, other texts are unlabelled and hold toxic ones at the
rate of the class prior. The risk of a linear classifier over word presence is the prior times
the positives' loss plus what the unlabelled texts lose as negatives, less the prior times what
the positives would; that second part is an estimate of a loss and is kept from going negative.
Every word that is commoner or rarer among the positives than chance allows is a feature, and the
weight of the squared penalty is that with the least risk on a fourth of the texts left aside.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastelens.llm.batches import map_texts
from tastelens.llm.samples import thinned, with_content
from tastelens.session import cut

# Documented bounds of the fit: texts of each kind, words that are features.
POSITIVES, UNLABELLED, FEATURES = 6_000, 18_000, 65_536
# A feature's shares among the two kinds differ by so many standard deviations of chance, and its
# word occurs in so many texts of the sample.
SIGMAS, LEAST_TEXTS = 4.0, 5
STEPS, RATE = 800, 0.1
# Tried weights of the squared penalty, the strongest first, and the steps of a trial.
DECAYS, TRIAL_STEPS = (1e-4, 3e-5, 1e-5), 400

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Distinct lower-cased words; null counts as empty."""
    return list(set(_WORD.findall((text or "").lower())))


def with_words(df: DataFrame, text: str, keep) -> DataFrame:
    def start():
        def compute(texts):
            return [pa.array([words_of(t) for t in texts], pa.list_(pa.string()))]

        return compute

    return map_texts(df, text, keep, "words array<string>", start)


class WordModel:
    """Weights of words and a bias."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias

    def score(self, text: str | None) -> float:
        get = self.weights.get
        total = self.bias + sum(get(w, 0.0) for w in words_of(text))
        return float(1.0 / (1.0 + np.exp(-np.clip(total, -60, 60))))


class Rows:
    """Word presence of a set of texts: one entry per (text, feature)."""

    def __init__(self, lists: list, count: int):
        self.n, self.count = len(lists), count
        sizes = [len(x) for x in lists]
        self.row = np.repeat(np.arange(len(lists)), sizes)
        self.column = np.concatenate([np.asarray(x, np.int64) for x in lists] or [[]]).astype(int)

    def margins(self, weights: np.ndarray, bias: float) -> np.ndarray:
        return bias + np.bincount(self.row, weights[self.column], self.n)

    def pull(self, slope: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, slope[self.row], self.count)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def risk(p: np.ndarray, u: np.ndarray, prior: float) -> float:
    """The non-negative risk of margins with the logistic loss."""
    as_negative = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
    return float(prior * np.logaddexp(0, -p).mean() + max(0.0, as_negative))


def train(
    positive: Rows, unlabelled: Rows, prior: float, decay: float = 3e-5, steps: int = STEPS
) -> tuple[np.ndarray, float]:
    """Adam on the non-negative risk with the logistic loss and a squared penalty."""
    weights, bias = np.zeros(positive.count), float(np.log(prior / (1 - prior)))
    moment, square = np.zeros(positive.count + 1), np.zeros(positive.count + 1)
    for step in range(1, steps + 1):
        p, u = positive.margins(weights, bias), unlabelled.margins(weights, bias)
        as_negative = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
        up_p, up_u = _sigmoid(p) / positive.n, _sigmoid(u) / unlabelled.n
        if as_negative >= 0:
            slope_p, slope_u = -prior * (1 - _sigmoid(p)) / positive.n - prior * up_p, up_u
        else:  # the estimate has been overfitted: walk it back
            slope_p, slope_u = prior * up_p, -up_u
        slope = np.append(
            positive.pull(slope_p) + unlabelled.pull(slope_u) + decay * weights,
            slope_p.sum() + slope_u.sum(),
        )
        moment = 0.9 * moment + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        change = RATE * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - change[:-1], bias - float(change[-1])
    return weights, bias


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learnable: Column,
    prior: float | None = None,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> WordModel:
    """Learns from confirmed toxic rows and unlabelled text where ``learnable`` holds.

    ``learnable`` is a condition on the key, the same for labels and documents. Bounds of the fit:
    about POSITIVES and UNLABELLED texts chosen by a hash of the key, and of the words that differ
    by chance's SIGMAS the FEATURES that tell the two samples apart best. ``prior`` is the share of toxic texts; by default that among
    the labelled rows. Null labels are left out, repeated label rows count once. Without a
    confirmed text, every score is the prior (or 0).
    """
    marked = labels.filter(learnable & F.col(label).isin(0, 1)).select(
        F.col(key).alias("key"), (F.col(label) == 1).alias("positive")
    ).distinct()
    sizes = dict(marked.groupBy("positive").count().collect())
    if prior is None:
        prior = sizes.get(True, 0) / max(1, sum(sizes.values()))
    rest = 1e-6
    prior = float(np.clip(prior, rest, 1 - rest))
    base = float(np.log(prior / (1 - prior)))
    if not sizes.get(True):
        return WordModel({}, base)
    content = docs.filter(learnable & F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias("content")
    )
    confirmed = thinned(marked.filter("positive"), "key", "positive", {True: sizes[True]}, POSITIVES)
    confirmed = with_content(content, confirmed.select("key"), "key")
    others = content.withColumn("kind", F.lit(0))
    others = thinned(others, "key", "kind", {0: content.count()}, UNLABELLED)
    sample = confirmed.select(F.lit(1).alias("kind"), "content").union(
        others.dropDuplicates(["key"]).select("kind", "content")
    )
    # copies of a text lie on one side
    aside = F.pmod(F.xxhash64("content"), F.lit(4)) == 0
    sample = with_words(sample.withColumn("aside", aside), "content", ["kind", "aside"])
    sample = cut(sample.withColumn("row", F.monotonically_increasing_id()))
    sizes = {tuple(r)[:2]: r["n"] for r in sample.groupBy("kind", "aside").agg(F.count(F.lit(1)).alias("n")).collect()}
    whole = [sum(n for (kind, _), n in sizes.items() if kind == k) for k in (1, 0)]
    if not all(whole):
        return WordModel({}, base)
    fitting = [sizes.get((k, False), 0) for k in (1, 0)]
    spread = sample.select("row", "kind", "aside", F.explode("words").alias("word"))
    counts = spread.groupBy("word").agg(
        *(F.count_if(F.col("kind") == k).alias(f"n{k}") for k in (1, 0)),
        *(F.count_if((F.col("kind") == k) & ~F.col("aside")).alias(f"f{k}") for k in (1, 0)),
    ).select(
        "word", apart(F.col("n1"), F.col("n0"), *whole).alias("all"),
        apart(F.col("f1"), F.col("f0"), *fitting).alias("fit"),
    )
    strongest = F.greatest("all", "fit")
    chosen = counts.filter(strongest >= SIGMAS).orderBy(F.desc(strongest), "word").limit(FEATURES)
    words = cut(chosen).toPandas()
    if words.empty:
        return WordModel({}, base)
    names = words["word"].tolist()
    places = sample.sparkSession.createDataFrame(list(enumerate(names)), "place int, word string")
    held = spread.join(F.broadcast(places), "word").groupBy("row").agg(
        F.collect_list("place").alias("places")
    )
    data = sample.select("row", "kind", "aside").join(held, "row", "left").orderBy("row").toPandas()
    data["places"] = [np.sort(x) if isinstance(x, (list, np.ndarray)) else [] for x in data["places"]]

    def rows(kind: int, usable: np.ndarray, aside: bool | None = None) -> Rows:
        part = data[(data["kind"] == kind) & ((data["aside"] == aside) if aside is not None else True)]
        lists = [[i for i in x if usable[i]] for x in part["places"]]
        return Rows(lists, len(names))

    decay = DECAYS[0]
    if all(fitting) and all(sizes.get((k, True)) for k in (1, 0)):
        usable = (words["fit"] >= SIGMAS).to_numpy()
        learn, asked = ([rows(k, usable, aside) for k in (1, 0)] for aside in (False, True))
        losses = []
        for tried in DECAYS:
            fitted = train(*learn, prior, tried, TRIAL_STEPS)
            losses.append(risk(*(x.margins(*fitted) for x in asked), prior))
        decay = DECAYS[int(np.argmin(losses))]
    usable = (words["all"] >= SIGMAS).to_numpy()
    weights, bias = train(rows(1, usable), rows(0, usable), prior, decay)
    return WordModel({w: float(x) for w, x, u in zip(names, weights, usable) if u}, bias)


def apart(ones: Column, zeros: Column, n_ones: int, n_zeros: int) -> Column:
    """By how many standard deviations of chance a word's two shares differ; 0 for rare words."""
    if not n_ones or not n_zeros:
        return F.lit(0.0)
    pooled = (ones + zeros) / F.lit(n_ones + n_zeros)
    chance = F.sqrt(pooled * (1 - pooled) * F.lit(1 / n_ones + 1 / n_zeros))
    sigmas = F.try_divide(F.abs(ones / F.lit(n_ones) - zeros / F.lit(n_zeros)), chance)
    return F.when(ones + zeros >= LEAST_TEXTS, F.coalesce(sigmas, F.lit(0.0))).otherwise(0.0)


def score(df: DataFrame, model: WordModel, text: str = "text", keep=("doc_id",), out: str = "score") -> DataFrame:
    """Adds ``out``, the likelihood (0 to 1) that a whole text is toxic.

    Null texts count as empty. Repeated rows stay, an empty table gives an empty one, only
    ``keep`` columns are passed on.
    """
    broadcast = df.sparkSession.sparkContext.broadcast(model)

    def start():
        fitted = broadcast.value

        def compute(texts):
            return [pa.array([fitted.score(t) for t in texts], pa.float64())]

        return compute

    return map_texts(df, text, keep, f"`{out}` double", start)
