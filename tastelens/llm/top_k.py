"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Vectors are dealt into blocks. In a block every component is quantised to an impact, and the
vectors with one impact in one dimension form a posting segment. A query takes the segments of all
dimensions by descending contribution and adds them to accumulators. What is still to come, plus
the quantisation error, bounds how far an accumulator can be from the score: the query stops when
this proves that few vectors can still be members, and those are scored exactly.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastelens.session import cut

# Rows of one block of candidates and of one block of queries.
CANDIDATES, QUERIES = 8_192, 4_096
# Impacts run from minus to plus this many steps.
LEVELS = 12
# Parts of the postings after which a query asks whether it may stop.
BANDS = 8


class ImpactIndex:
    """Posting segments of one block of integer vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        size = np.abs(vectors).max(initial=0)
        self.step = max(1, -(-int(size) // LEVELS))
        impact = np.rint(vectors / self.step).astype(np.int64)
        self.error = np.abs(vectors - impact * self.step).max(axis=0, initial=0)
        self.rows, self.dimension, self.impact = [], [], []
        for d in range(vectors.shape[1]):
            order = np.argsort(impact[:, d], kind="stable").astype(np.int32)
            levels, starts = np.unique(impact[order, d], return_index=True)
            for level, rows in zip(levels.tolist(), np.split(order, starts[1:])):
                if level:
                    self.rows.append(rows)
                    self.dimension.append(d)
                    self.impact.append(level * self.step)
        self.dimension = np.array(self.dimension, dtype=np.int64)
        self.impact = np.array(self.impact, dtype=np.int64)
        self.sizes = np.array([len(r) for r in self.rows], dtype=np.int64)

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows with another id, ties to smaller ids."""
        others = self.ids != own
        k = min(k, int(others.sum()))
        if k == 0:
            return self.ids[:0], np.zeros(0, np.int64)
        gain = query[self.dimension] * self.impact
        order = np.argsort(-np.abs(gain), kind="stable")
        order = order[gain[order] != 0]
        done = np.cumsum(self.sizes[order])
        total = int(done[-1]) if len(done) else 0
        ends = np.unique(np.searchsorted(done, total * np.arange(1, BANDS + 1) / BANDS) + 1)
        ends = np.minimum(ends, len(order))
        error = float((np.abs(query) * self.error).sum())
        sums = np.zeros(len(self.ids))
        begin, members = 0, others.copy()
        for end in ends.tolist() if total else []:
            part = order[begin:end]
            rows = np.concatenate([self.rows[i] for i in part])
            sums += np.bincount(rows, np.repeat(gain[part], self.sizes[part]), len(sums))
            begin = end
            rest = np.zeros(len(query))
            left = order[end:]
            np.maximum.at(rest, self.dimension[left], np.abs(gain[left]))
            bound = error + rest.sum()
            least = np.partition(sums[others], -k)[-k]
            members = others & (sums >= least - 2 * bound)
            if members.sum() <= 4 * k:
                break
        rows = np.flatnonzero(members)
        scores = self.vectors[rows] @ query
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[best]], scores[best]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(len(column), -1) if len(column) else flat


def _usable(vector: str) -> Column:
    whole = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return F.col(vector).isNotNull() & whole


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``key`` and ``score`` of the k best rows for each query.

    Components become floor(scale * x); the score is the integer inner product, ties go to the
    smaller key. The rows where ``queries`` holds ask, every row with another key answers. Vectors
    that are null or hold null or non-finite components, rows without a key, and pairs of vectors
    of different length take no part. A query row that is repeated is asked once; repeated
    candidates answer each for themselves. An empty table gives no rows; extra columns are ignored.
    """
    whole = vectors.filter(_usable(vector) & F.col(key).isNotNull()).select(
        F.col(key).alias("key"),
        queries.alias("asks"),
        F.transform(vector, lambda x: F.floor(scale * x.cast("double"))).alias("vector"),
    )
    whole = cut(whole)
    asking = whole.filter("asks").select("key", "vector").distinct()
    asked, rows = asking.count(), whole.count()
    across, down = max(1, ceil(asked / QUERIES)), max(1, ceil(rows / CANDIDATES))
    serial = F.monotonically_increasing_id()
    block = F.pmod(F.xxhash64("key", "vector"), F.lit(across)).cast("int")
    left = asking.select(
        F.col("key").alias("query"), F.col("vector"), F.size("vector").alias("n"),
        block.alias("q"), F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("c"),
    )
    right = whole.select(
        "key", "vector", F.size("vector").alias("n"), F.pmod(serial, F.lit(down)).cast("int").alias("c"),
    ).select("key", "vector", "n", "c", F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("q"))
    keys = ["n", "q", "c"]

    def search(asked, answering):
        schema = pa.schema(
            [("query_id", pa.int64()), ("form", pa.int64()), ("key", pa.int64()), ("score", pa.int64())]
        )
        if not asked.num_rows or not answering.num_rows:
            return schema.empty_table()
        index = ImpactIndex(
            answering.column("key").to_numpy(), _matrix(answering.column("vector"))
        )
        names = asked.column("query").to_numpy()
        forms = asked.column("form").to_numpy()
        found = [index.search(n, q, k) for n, q in zip(names, _matrix(asked.column("vector")))]
        sizes = [len(f[0]) for f in found]
        return pa.table(
            [np.repeat(names, sizes), np.repeat(forms, sizes)]
            + [np.concatenate([f[i] for f in found]) for i in (0, 1)],
            schema=schema,
        )

    left = left.withColumn("form", F.xxhash64("vector"))
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        search, "query_id bigint, form bigint, key bigint, score bigint"
    )
    best = Window.partitionBy("query_id", "form").orderBy(F.desc("score"), "key")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("key").alias(key), "score"
    )
