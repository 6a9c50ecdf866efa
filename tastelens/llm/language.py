"""Language identification with a blended-spectrum string kernel.

The kernel of two texts counts the character n-grams, of one to ``LONGEST`` characters, present in
both, divided by the root of the product of their own counts. A few landmark texts per language
give Nyström features; one-versus-rest kernel ridge regression on them is solved in closed form.
Texts are scored in batches by matrix products with the landmarks.
"""

from __future__ import annotations

import sys
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastelens.llm.batches import map_texts
from tastelens.llm.samples import share

LONGEST = 3
# n-grams are told apart by this many hashed bits.
SLOT_BITS = 16
# Documented bounds of the fit: training texts and landmarks per language, and of all languages
# together; a language keeps LEAST_TEXTS texts, however many languages there are.
PER_LANGUAGE, LANDMARKS = 1_000, 24
ALL_TEXTS, ALL_LANDMARKS, LEAST_TEXTS = 64_000, 1_536, 40
RIDGE = 1e-2
UNKNOWN = "und"

_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64
)


def letter_table() -> np.ndarray:
    """Each code point as itself if it is a letter, else a space."""
    return np.array(
        [c if chr(c).isalpha() else 32 for c in range(sys.maxunicode + 1)], dtype=np.uint32
    )


def presence(text: str, table: np.ndarray, row: np.ndarray) -> bool:
    """Marks the slots of the n-grams of a text; whether it has a letter."""
    raw = text.lower().encode("utf-32-le", "surrogatepass")
    codes = table[np.frombuffer(raw, dtype=np.uint32)]
    if not len(codes) or not (codes != 32).any():
        return False
    # runs of other characters count as one space, with one at each end
    blank = codes == 32
    codes = codes[~blank | np.concatenate([[True], ~blank[:-1]])]
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint64)
    for n in range(1, LONGEST + 1):
        size = len(codes) - n + 1
        if size < 1:
            break
        mixed = np.full(size, n, dtype=np.uint64)
        for i in range(n):
            mixed = mixed * _FACTORS[0] + codes[i : i + size] * _FACTORS[i]
            mixed ^= mixed >> np.uint64(29)
        row[(mixed * _FACTORS[1]) >> np.uint64(64 - SLOT_BITS)] = 1
    return True


def presences(texts: list, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows = np.zeros((len(texts), 1 << SLOT_BITS), dtype=np.uint8)
    known = [presence(t, table, rows[i]) if t else False for i, t in enumerate(texts)]
    return rows, np.array(known, dtype=bool)


class Landmarks:
    """Kernel values of texts against the landmarks."""

    def __init__(self, rows: np.ndarray):
        sizes = np.maximum(rows.sum(axis=1, dtype=np.int64), 1)
        self.slots = np.flatnonzero(rows.any(axis=0))
        self.rows = (rows[:, self.slots] / np.sqrt(sizes)[:, None]).astype(np.float32)

    def kernel(self, rows: np.ndarray) -> np.ndarray:
        sizes = np.maximum(rows.sum(axis=1, dtype=np.int64), 1)
        shared = rows[:, self.slots].astype(np.float32) @ self.rows.T
        return shared / np.sqrt(sizes)[:, None].astype(np.float32)


def _kernel_rows(df: DataFrame, landmarks: Landmarks, text: str, keep) -> DataFrame:
    def start():
        table = letter_table()

        def compute(texts):
            values = [np.zeros((0, len(landmarks.rows)), np.float32)]
            for at in range(0, len(texts), 128):
                values.append(landmarks.kernel(presences(texts[at : at + 128], table)[0]))
            made = np.concatenate(values)
            flat = pa.array(made.ravel(), pa.float32())
            return [pa.FixedSizeListArray.from_arrays(flat, made.shape[1]).cast(pa.list_(pa.float32()))]

        return compute

    return map_texts(df, text, keep, "kernel array<float>", start)


class LanguageModel:
    """Landmarks and one column of weights per language."""

    def __init__(self, languages: list[str], landmarks: Landmarks | None, weights: np.ndarray):
        self.languages, self.landmarks, self.weights = languages, landmarks, weights


def fit(
    docs: DataFrame, learnable: Column, key: str = "doc_id", text: str = "text", label: str = "lang"
) -> LanguageModel:
    """Learns from the rows where ``learnable`` holds and label and text are present.

    Every label is learned. Bounds of the fit: about PER_LANGUAGE texts and LANDMARKS landmarks of
    each label, fewer where ALL_TEXTS and ALL_LANDMARKS, shared evenly, give less. Without such
    rows the model knows no language.
    """
    rows = docs.filter(learnable & F.col(label).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias("content"), F.col(label).alias("label")
    ).filter(F.col("content").rlike(r"\p{L}"))
    counts = rows.groupBy("label").count()
    sizes = sorted((str(r["label"]), r["count"]) for r in counts.collect())
    if not sizes:
        return LanguageModel([], None, np.zeros((0, 0)))
    known = F.broadcast(rows.sparkSession.createDataFrame(sizes, "label string, size bigint"))

    def sample(most: float, seed: int) -> DataFrame:
        drawn = rows.withColumn("label", F.col("label").cast("string")).join(known, "label")
        drawn = drawn.filter(share("key", seed) < F.lit(float(most)) / F.col("size"))
        return drawn.drop("size").dropDuplicates(["key"])

    each = min(LANDMARKS, ALL_LANDMARKS / len(sizes))
    texts = min(PER_LANGUAGE, max(LEAST_TEXTS, ALL_TEXTS // len(sizes)))
    marks = sample(each, 1).select("content").limit(2 * ceil(each * len(sizes))).collect()
    if not marks:
        marks = rows.select("content").limit(LANDMARKS).collect()
    table = letter_table()
    landmarks = Landmarks(presences([m[0] for m in marks], table)[0])
    data = _kernel_rows(sample(texts, 2), landmarks, "content", ["label"]).toPandas()
    languages = [name for name, _ in sizes]
    if not len(data):
        data = _kernel_rows(rows.limit(LANDMARKS), landmarks, "content", ["label"]).toPandas()
    kernel = np.stack(data["kernel"].to_numpy()).astype(np.float64)
    place = {name: i for i, name in enumerate(languages)}
    labels = np.array([place[str(x)] for x in data["label"]], dtype=np.int64)
    own = (landmarks.rows @ landmarks.rows.T).astype(np.float64)
    # Nyström features: the kernel times the inverse root of the landmarks' own kernel
    values, vectors = np.linalg.eigh(own)
    root = vectors / np.sqrt(np.maximum(values, 1e-6))
    features = np.hstack([kernel @ root, np.ones((len(kernel), 1))])
    # each language weighs the same, however many of its texts were drawn
    weight = 1.0 / np.bincount(labels, minlength=len(languages))[labels]
    weight = weight / weight.sum() * len(weight)
    weighted = features * weight[:, None]
    gram = features.T @ weighted + RIDGE * np.eye(features.shape[1])
    # the targets are 1 for a text's own language and -1 for all others
    own_sums = np.zeros((len(languages), features.shape[1]))
    np.add.at(own_sums, labels, weighted)
    solved = np.linalg.solve(gram, 2 * own_sums.T - weighted.sum(axis=0)[:, None])
    return LanguageModel(languages, landmarks, np.vstack([root @ solved[:-1], solved[-1:]]))


def predict(df: DataFrame, model: LanguageModel, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (0 to 1) for every whole text.

    A text that is null or has no letter, and every text under a model without languages, is
    ``und`` with score 0. Repeated rows stay; only ``keep`` columns are passed on.
    """
    broadcast = df.sparkSession.sparkContext.broadcast(model)

    def start():
        table, fitted = letter_table(), broadcast.value

        def compute(texts):
            names, scores = [], []
            for at in range(0, len(texts), 128):
                rows, known = presences(texts[at : at + 128], table)
                if not fitted.languages:
                    names += [UNKNOWN] * len(rows)
                    scores += [0.0] * len(rows)
                    continue
                values = fitted.landmarks.kernel(rows) @ fitted.weights[:-1] + fitted.weights[-1]
                best = values.argmax(axis=1)
                sure = np.clip((values[np.arange(len(rows)), best] + 1) / 2, 0, 1)
                names += [fitted.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
                scores += np.where(known, sure, 0.0).tolist()
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

        return compute

    return map_texts(df, text, keep, "lang_pred string, score double", start)
