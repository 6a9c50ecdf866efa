"""Quality scores by histogram gradient-boosted trees over document statistics.

Trees are grown level by level on binned statistics and kept as flat arrays: node i of a tree has
the children 2i + 1 and 2i + 2, so a batch of documents walks down all trees by numpy indexing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastelens.llm.batches import list_array, map_texts
from tastelens.llm.samples import thinned, with_content

# Documented bound of the fit: about so many labelled rows of each class.
PER_CLASS = 8_000
TREES, DEPTH, BINS, RATE, RIDGE, LEAST_ROWS = 120, 4, 64, 0.15, 1.0, 10

STATISTICS = (
    "log_bytes log_words mean_word longest_word distinct_words distinct_lines words_per_line "
    "upper digit punctuation space line_end symbol pipe non_ascii sentence_end comma "
    "upper_words first_upper ends_in_stop top_word repeated_pairs bytes_kinds entropy"
).split()

_LOWER = np.array([97 <= b <= 122 for b in range(256)])
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_PUNCTUATION = np.array([b in b".,;:!?'\"()-" for b in range(256)])
_SYMBOL = np.array([b in b"#$%&*+/<=>@[]^_`{|}~\\" for b in range(256)])


def statistics(text: str | None) -> list[float]:
    """The STATISTICS of a whole text; a null text counts as empty."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    size = max(1, len(raw))
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    share = kinds[kinds > 0] / size
    counts: dict[str, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    pairs = set(zip(words, words[1:]))
    return [
        float(np.log1p(len(raw))),
        float(np.log1p(len(words))),
        sum(map(len, words)) / n,
        float(max(map(len, words), default=0)),
        len(counts) / n,
        len(set(lines)) / len(lines),
        float(np.log1p(len(words) / len(lines))),
        kinds[_UPPER].sum() / size,
        kinds[_DIGIT].sum() / size,
        kinds[_PUNCTUATION].sum() / size,
        kinds[32] / size,
        kinds[10] / size,
        kinds[_SYMBOL].sum() / size,
        kinds[124] / size,
        kinds[128:].sum() / size,
        (kinds[46] + kinds[33] + kinds[63]) / n,
        kinds[44] / n,
        sum(map(str.isupper, words)) / n,
        sum(w[0].isupper() for w in words) / n,
        float(text.rstrip()[-1:] in ".!?"),
        max(counts.values(), default=0) / n,
        len(pairs) / max(1, len(words) - 1),
        float((kinds > 0).sum()),
        float(-(share * np.log(share)).sum()),
    ]


def with_statistics(df: DataFrame, text: str, keep) -> DataFrame:
    """Adds the array ``statistics``."""

    def start():
        def compute(texts):
            flat = np.array([statistics(t) for t in texts], dtype=np.float64)
            sizes = np.full(len(texts), len(STATISTICS))
            return [list_array(flat.ravel(), sizes, pa.float64())]

        return compute

    return map_texts(df, text, keep, "statistics array<double>", start)


class Trees:
    """Boosted trees as arrays: (tree, inner node) features and thresholds, (tree, leaf) values."""

    def __init__(self, feature, threshold, value, base):
        self.feature, self.threshold, self.value, self.base = feature, threshold, value, base

    def margins(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(DEPTH):
                right = rows[every, feature[node]] > threshold[node]
                node = 2 * node + 1 + right
            total += value[node - len(feature)]
        return total

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margins(rows)))


def grow(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> Trees:
    """Logistic boosting; each level takes its splits from histograms of gradients."""
    inner, leaves, columns = 2**DEPTH - 1, 2**DEPTH, rows.shape[1]
    cuts = [
        np.unique(np.quantile(rows[:, c], np.linspace(0, 1, BINS + 1)[1:-1]))
        for c in range(columns)
    ]
    bins = np.stack(
        [np.searchsorted(cuts[c], rows[:, c], side="left") for c in range(columns)], axis=1
    )
    rate = float(np.clip(np.average(labels, weights=weights), 1e-3, 1 - 1e-3))
    base = float(np.log(rate / (1 - rate)))
    margin = np.full(len(rows), base)
    all_feature, all_threshold, all_value = [], [], []
    offset = np.arange(columns) * BINS
    for _ in range(TREES):
        p = 1.0 / (1.0 + np.exp(-margin))
        gradient, hessian = weights * (p - labels), weights * p * (1 - p)
        feature = np.zeros(inner, dtype=np.int64)
        threshold = np.full(inner, np.inf)
        at = np.zeros(len(rows), dtype=np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            slot = ((at - first)[:, None] * columns * BINS + offset + bins).ravel()
            shape = (width, columns, BINS)
            size = width * columns * BINS
            g, h, n = (
                np.bincount(slot, np.repeat(x, columns), size).reshape(shape).cumsum(axis=2)
                for x in (gradient, hessian, np.ones(len(rows)))
            )
            gt, ht, nt = g[:, :, -1:], h[:, :, -1:], n[:, :, -1:]
            gain = g**2 / (h + RIDGE) + (gt - g) ** 2 / (ht - h + RIDGE) - gt**2 / (ht + RIDGE)
            gain[(n < LEAST_ROWS) | (nt - n < LEAST_ROWS)] = 0
            flat = gain.reshape(width, -1)
            best = flat.argmax(axis=1)
            for node in np.flatnonzero(flat[np.arange(width), best] > 1e-9):
                column, cell = divmod(int(best[node]), BINS)
                if cell < len(cuts[column]):
                    feature[first + node] = column
                    threshold[first + node] = cuts[column][cell]
            right = rows[np.arange(len(rows)), feature[at]] > threshold[at]
            at = 2 * at + 1 + right
        leaf = at - inner
        total = np.bincount(leaf, gradient, leaves)
        value = -RATE * total / (np.bincount(leaf, hessian, leaves) + RIDGE)
        margin += value[leaf]
        all_feature.append(feature)
        all_threshold.append(threshold)
        all_value.append(value)
    return Trees(np.array(all_feature), np.array(all_threshold), np.array(all_value), base)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learnable: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> Trees | None:
    """Learns from labelled rows where ``learnable`` (on the key of ``labels``) holds.

    Bound of the fit: about PER_CLASS rows of each class, chosen by a hash of the key and weighted
    back to the shares of the classes. Labels that are null or neither 0 nor 1 are left out, a
    repeated label row counts once. Without labelled texts there is no model.
    """
    marked = labels.filter(learnable & F.col(label).isin(0, 1)).select(
        F.col(key).alias("key"), F.col(label).cast("int").alias("label")
    ).distinct()
    sizes = dict(marked.groupBy("label").count().collect())
    sample = thinned(marked, "key", "label", sizes, PER_CLASS)
    content = docs.select(F.col(key).alias("key"), F.col(text).alias("content"))
    sample = with_content(content, sample, "key")
    data = with_statistics(sample, "content", ["label"]).toPandas()
    if not len(data):
        return None
    rows, found = np.stack(data["statistics"].to_numpy()), data["label"].to_numpy()
    weights = np.array([sizes[x] for x in found.tolist()], dtype=float)
    weights /= np.bincount(found, minlength=2)[found]
    return grow(rows, found.astype(float), weights / weights.mean())


def score(df: DataFrame, model: Trees | None, text: str = "text", keep=("doc_id",), out: str = "score") -> DataFrame:
    """Adds ``out``, the likelihood (0 to 1) of label 1, for every whole text.

    Null texts count as empty. Without a model every score is 0.5. Repeated rows stay, an empty
    table gives an empty one, only ``keep`` columns are passed on.
    """
    broadcast = df.sparkSession.sparkContext.broadcast(model)

    def start():
        trees = broadcast.value

        def compute(texts):
            if trees is None:
                return [pa.array([0.5] * len(texts), pa.float64())]
            rows = np.array([statistics(t) for t in texts])
            return [pa.array(trees.scores(rows), pa.float64())]

        return compute

    return map_texts(df, text, keep, f"`{out}` double", start)
