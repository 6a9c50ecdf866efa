"""Alignment of the tokens of two tokenizers over each distinct text, with corpus-wide counts.

Rows are shuffled by their full text, so that every distinct text is tokenised and aligned once,
however many documents hold it. Counts of token pairs weight each text by its documents; what is
measured of a text is joined to all its documents.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastelens.llm.batches import (
    fields_of, list_array, quoted, row_of, run_starts, slices, take_runs, without,
)
from tastelens.llm.bpe import vocabulary_of
from tastelens.llm.libraries import byte_level, piece_level, piece_strings
from tastelens.session import scratch_path

# Characters of text aligned at once; a longer text makes a slice of its own.
SLICE_CHARS = 500_000
# Pairs with their counts, 24 bytes each, up to which they are sent to every task; more are joined
# by a shuffle.
MOST_SENT = 2_000_000
# Rows of pairs told apart by the second id.
_SECOND = 1 << 32


class _Strings:
    """The byte strings of a vocabulary, and its ids written in decimal with what may follow."""

    def __init__(self, strings: list[bytes], inner: bytes, last: bytes):
        self.count = len(strings)
        self.lengths = np.array([len(s) for s in strings], dtype=np.int64)
        self.starts = run_starts(self.lengths)
        self.flat = np.frombuffer(b"".join(strings), dtype=np.uint8)
        self.written = [str(i).encode() + m for m in (inner, last) for i in range(len(strings))]

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return take_runs(self.flat, self.starts, self.lengths, ids)


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str):
    """A function of texts; once per worker process."""
    encode_a, encode_b = byte_level(path_a, False), piece_level(path_b)
    a_side = _Strings(vocabulary_of(path_a).strings, b",", b"|")
    b_side = _Strings(piece_strings(path_b), b",", b";")

    def ends_of(side: _Strings, ids, sizes):
        """(byte end of every token, bytes per text)."""
        ends = np.cumsum(side.lengths[ids])
        upto = np.concatenate([[0], ends])
        return ends, np.diff(upto[np.concatenate([[0], np.cumsum(sizes)])])

    def kept(ids, sizes, fits):
        return ids[np.repeat(fits, sizes)], np.where(fits, sizes, 0)

    def align(texts: list[str]) -> dict[str, np.ndarray]:
        """Tokens per text (none where the bytes of a side are not those of the text), and the
        links of all texts in a row."""
        raw = [b" " + t.encode() for t in texts]
        wanted = np.array([len(r) for r in raw], dtype=np.int64)
        ids_a, sizes_a = encode_a([" " + t for t in texts])
        ids_b, sizes_b = encode_b(texts)
        ids_a, ids_b = ids_a.astype(np.int64), ids_b.astype(np.int64)
        fits = np.ones(len(texts), dtype=bool)
        flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
        # what differs in size is left out before the bytes are compared side by side
        for side, ids, sizes in ((a_side, ids_a, sizes_a), (b_side, ids_b, sizes_b)):
            fits &= ends_of(side, ids, sizes)[1] == wanted
        for side, ids, sizes in ((a_side, ids_a, sizes_a), (b_side, ids_b, sizes_b)):
            even = np.repeat(fits, wanted)
            other = side.joined(kept(ids, sizes, fits)[0]) != flat[even]
            row = np.repeat(np.arange(len(texts)), wanted)[even][other]
            fits[row] = False
        ids_a, sizes_a = kept(ids_a, sizes_a, fits)
        ids_b, sizes_b = kept(ids_b, sizes_b, fits)
        ends_a, bytes_a = ends_of(a_side, ids_a, sizes_a)
        ends_b, _ = ends_of(b_side, ids_b, sizes_b)
        # which sides have a token that ends at a byte; the stretch after the end before it lies in
        # one token of each side: one link
        ending = np.zeros(int(bytes_a.sum()), np.int8)
        ending[ends_a - 1] = 1
        ending[ends_b - 1] |= 2
        stops = np.flatnonzero(ending)
        sides = ending[stops]
        in_a, in_b = sides & 1 > 0, sides & 2 > 0
        at_a, at_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        text_of_byte = np.repeat(np.arange(len(texts)), bytes_a)
        owner = text_of_byte[stops]
        return {
            "n_a": sizes_a,
            "n_b": sizes_b,
            "n_groups": np.bincount(owner[sides == 3], minlength=len(texts)),
            "n_links": np.bincount(owner, minlength=len(texts)),
            "owner": owner,
            "pair": ids_a[at_a] * _SECOND + ids_b[at_b],
            "a": ids_a,
            "b": ids_b,
            "last_a": ending[ends_a - 1] == 3,
            "last_b": ending[ends_b - 1] == 3,
        }

    marked = np.array([*a_side.written, *b_side.written], dtype=object)

    def written(found: dict[str, np.ndarray]) -> list[str]:
        """The groups of every text as ``a1,a2|b1;a3|b2,b3``."""
        last_a, last_b = found["last_a"], found["last_b"]
        # before a token stand those of its own side and of the other side's earlier groups, for
        # the second side also of the same group
        upto_a = np.concatenate([[0], np.flatnonzero(last_a) + 1])
        upto_b = np.concatenate([[0], np.flatnonzero(last_b) + 1])
        place_a = np.arange(len(last_a)) + upto_b[np.cumsum(last_a) - last_a]
        place_b = np.arange(len(last_b)) + upto_a[np.cumsum(last_b) - last_b + 1] if len(last_b) else upto_b[:0]
        codes = np.empty(len(last_a) + len(last_b), np.int64)
        codes[place_a] = found["a"] + a_side.count * last_a
        codes[place_b] = found["b"] + b_side.count * last_b + 2 * a_side.count
        ordered = marked[codes].tolist()
        ends = np.cumsum(found["n_a"] + found["n_b"]).tolist()
        return [b"".join(ordered[b:e])[:-1].decode() for b, e in zip([0, *ends], ends)]

    return align, written


def _distinct_pairs(owner: np.ndarray, pair: np.ndarray, texts: int):
    """(pairs per text, distinct pairs of all texts in a row, how often each occurs)."""
    order = np.lexsort((pair, owner))
    owner, pair = owner[order], pair[order]
    new = np.ones(len(pair), dtype=bool)
    new[1:] = (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.concatenate([first, [len(pair)]]))
    return np.bincount(owner[first], minlength=texts), pair[first], times


def aligned_texts(texts: DataFrame, path_a: str, path_b: str, groups: bool = False) -> DataFrame:
    """One row per row of ``texts`` (text, copies), which holds no null and no empty text: text_id,
    text_sha256, copies, n_a, n_b, n_groups, n_links, groups_sha256 (or the groups themselves in
    ``groups``), pairs (first id * 2**32 + second id, each distinct pair once) and times."""
    out = (
        "text_id bigint, text_sha256 string, copies bigint, n_a bigint, n_b bigint, n_groups bigint,"
        f" n_links bigint, {'groups' if groups else 'groups_sha256'} string, pairs array<bigint>,"
        " times array<int>"
    )
    names = [part.split()[0] for part in out.split(", ")]

    def run(batches):
        align, written = aligner(path_a, path_b)
        # ids that no other task gives
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, part in slices(batch.column(0), SLICE_CHARS):
                found = align(part)
                size, pair, times = _distinct_pairs(found["owner"], found["pair"], len(part))
                said = written(found)
                if not groups:
                    said = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in said]
                rows = batch.slice(first, len(part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(number, number + len(part))), rows.column(2), rows.column(1)]
                    + [pa.array(found[n], pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")]
                    + [pa.array(said, pa.string()), list_array(pair, size, pa.int64())]
                    + [list_array(times, size)],
                    names=names,
                )
                number += len(part)

    return texts.select("text", "copies", F.sha2("text", 256)).mapInArrow(run, out)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): in how many documents a pair is linked, and whether no pair of its
    first id is linked in more."""
    pairs = aligned.select("copies", F.explode("pairs").alias("pair"))
    counts = pairs.groupBy("pair").agg(F.sum("copies").alias("count"))
    first = F.shiftright("pair", 32)
    highest = counts.groupBy(first.alias("first")).agg(F.max("count").alias("highest"))
    joined = counts.join(highest, first == F.col("first"))
    return joined.select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def _sums_sent(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Sums per text by a table of counts that every task holds."""
    rows = counts.sort("pair").toPandas()
    spark = aligned.sparkSession
    table = spark.sparkContext.broadcast(
        (rows["pair"].to_numpy(np.int64), rows["count"].to_numpy(np.int64), rows["best"].to_numpy(bool))
    )

    def run(batches):
        known, count, best = table.value
        for batch in batches:
            pairs, times = batch.column(1), batch.column(2)
            at = np.searchsorted(known, pairs.flatten().to_numpy(zero_copy_only=False))
            weight = times.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(pairs.value_lengths().to_numpy(zero_copy_only=False))
            begins = np.concatenate([[0], ends])[:-1]

            def per_text(values):
                upto = np.concatenate([[0], np.cumsum(values)])
                return pa.array(upto[ends] - upto[begins], pa.int64())

            yield pa.RecordBatch.from_arrays(
                [batch.column(0), per_text(weight * best[at]), per_text(weight * count[at])],
                names=["text_id", "n_best", "count_sum"],
            )

    source = aligned.select("text_id", "pairs", "times")
    return source.mapInArrow(run, "text_id bigint, n_best bigint, count_sum bigint")


def _sums_joined(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Sums per text by a shuffled join of its pairs with their counts."""
    links = aligned.select("text_id", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    links = links.select("text_id", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    return (
        links.join(counts, "pair")
        .groupBy("text_id")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("bigint").alias("n_best"),
            F.sum(F.col("times") * F.col("count")).alias("count_sum"),
        )
    )


MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def align_tokens(
    df: DataFrame,
    path_a: str,
    path_b: str,
    text: str = "text",
    keep=("doc_id",),
    groups: bool = False,
    most_sent: int = MOST_SENT,
) -> DataFrame:
    """Adds n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 (or groups) to
    ``keep`` for every row.

    ``path_a``: a byte-level vocabulary file, used on a space and the text; ``path_b``: a
    sentencepiece model, which adds that space; strings of special tokens are plain text. Groups
    are cut where tokens of both sides end; links are the pairs of tokens that share bytes. A pair
    of ids counts once per document that holds it linked; ``n_best`` are the links whose count is
    the highest of their first id, ties included, ``count_sum`` the counts of all links.

    Texts that are null, empty or not restored by the tokens of either side have no tokens: zeros
    and ''. Repeated rows are documents of their own in the counts; very long texts are aligned
    whole; an empty table gives an empty one. Kept columns with the name of a new one give way.
    Texts are told apart in full by the shuffle; measures find their rows by the text's SHA-256.
    Up to ``most_sent`` pairs are sent to the tasks with their counts, more are joined.
    """
    spark = df.sparkSession
    last = "groups" if groups else "groups_sha256"
    kept = without(keep, (*MEASURES, last))
    content = quoted(text)
    filled = content.isNotNull() & (content != "")
    distinct = df.filter(filled).groupBy(content.alias("text")).agg(F.count(F.lit(1)).alias("copies"))
    path = scratch_path(spark, "aligned")
    made = aligned_texts(distinct, path_a, path_b, groups)
    made.write.option("compression", "zstd").parquet(path)
    aligned = spark.read.parquet(path)
    counts_path = scratch_path(spark, "pair_counts")
    pair_counts(aligned).write.parquet(counts_path)
    counts = spark.read.parquet(counts_path)
    few = counts.count() <= most_sent
    sums = (_sums_sent if few else _sums_joined)(aligned, counts)
    of_text = aligned.select("text_id", "text_sha256", *MEASURES[:4], last)
    measured = of_text.join(sums, "text_id", "left")
    # rows without text keep away from the join
    row = row_of(kept).alias("row")
    some = df.filter(filled).select(row, F.sha2(content, 256).alias("text_sha256"))
    some = some.join(measured, "text_sha256", "left")
    zero = F.lit(0).cast("bigint")
    none = df.filter(~F.coalesce(filled, F.lit(False))).select(
        row, *(zero.alias(m) for m in MEASURES), F.lit("").alias(last)
    )
    both = some.select("row", *(F.coalesce(m, zero).alias(m) for m in MEASURES), last).union(none)
    return both.select(*fields_of("row", kept), *MEASURES, last)
