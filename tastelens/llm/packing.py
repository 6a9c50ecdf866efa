"""Best-two-fit packing of token sequences.

A sequence is filled greedily, the longest piece that fits first. Where two unpacked pieces fill
the gap that its smallest piece would leave more tightly than that piece does, they take its place.

Which pieces share a sequence depends on their lengths alone, and there are no more lengths than
the limit. So the lengths are counted over all rows, the packing is worked out on these counts,
equal sequences at once, and every piece finds its place by its number among those of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from tastelens.llm.batches import fields_of, list_array, quoted, row_of, slices, without
from tastelens.llm.libraries import byte_level
from tastelens.session import scratch_path

# A packed sequence and how often it occurs: (times, [(length, pieces of this length)]).
Pattern = tuple[int, list[tuple[int, int]]]


def _largest(left: np.ndarray) -> np.ndarray:
    """The largest length that is left, up to every length; 0 if there is none."""
    return np.maximum.accumulate(np.where(left > 0, np.arange(len(left)), 0))


def _two_for(left: np.ndarray, room: int, least: int) -> tuple[int, int] | None:
    """The two pieces left that fill ``room`` best, if they fill more than ``least``."""
    low = _largest(left)
    one = np.arange(1, room)
    two = np.minimum(low[room - one], one)
    # a length of which one piece is left cannot be both of the two
    lone = (two == one) & (left[one] < 2)
    two = np.where((left[two] > 0) & ~lone, two, low[np.maximum(two - 1, 0)])
    total = np.where((left[one] > 0) & (two > 0), one + two, 0)
    best = int(total.max(initial=0))
    if best <= least:
        return None
    longest = int(one[total == best].max())
    return longest, best - longest


def best_two_fit(counts: Sequence[int], limit: int) -> list[Pattern]:
    """Patterns that pack ``counts[length]`` pieces of every length, none above ``limit``.

    As many sequences in a row as come out alike are packed at once. Every pattern leaves fewer
    pieces of some length than it takes, so the patterns are bounded by the limit, whatever the
    counts are.
    """
    left = np.array(counts, dtype=np.int64)
    made: list[Pattern] = []
    while left.any():
        low, gap, size = _largest(left), limit, limit
        taken: dict[int, int] = {}
        while size := int(low[min(gap, size)]):
            taken[size] = min(int(left[size]), gap // size)
            gap -= size * taken[size]
            size -= 1
        first = dict(taken)
        if sum(taken.values()) > 1:
            smallest = min(taken)
            rest = left.copy()
            for length, n in taken.items():
                rest[length] -= n
            pair = _two_for(rest, gap + smallest, smallest)
            if pair:
                taken[smallest] -= 1
                for length in pair:
                    taken[length] = taken.get(length, 0) + 1
        uses = [(length, n) for length, n in sorted(taken.items(), reverse=True) if n]
        times = min((int(left[s]) - max(n, first.get(s, 0))) // n + 1 for s, n in uses)
        for length, n in uses:
            left[length] -= times * n
        made.append((times, uses))
    return made


def places(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, in the order of their numbers: one row for every
    length of every pattern, sorted by length and first number."""
    rows, used, sequence = [], {}, 0
    for times, uses in patterns:
        at = 0
        for length, n in uses:
            rows.append((length, used.get(length, 0), n, sequence, at))
            used[length] = used.get(length, 0) + n * times
            at += length * n
        sequence += times
    names = ("length", "first", "each", "sequence", "offset")
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, len(names))
    return dict(zip(names, table.T))


def cut_points(sizes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of the pieces: only longer documents are cut, the first piece is
    the shorter one."""
    pieces = -(-sizes // limit)
    owner = np.repeat(np.arange(len(sizes)), pieces)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = sizes - (pieces - 1) * limit
    start = np.where(number > 0, first[owner] + (number - 1) * limit, 0)
    return owner, start, np.where(number > 0, limit, first[owner])


PLACED = ("piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids")


def _long(schema: StructType, *names: str) -> StructType:
    for name in names:
        schema = schema.add(name, LongType())
    return schema


def token_pieces(
    df: DataFrame, path: str, limit: int, end: int, text: str, keep: Sequence[str], ids: bool
) -> DataFrame:
    """The pieces of all texts, the ``keep`` columns in ``row``, with ``part`` and ``nth``: the
    pieces of one part and length are numbered from 0."""
    source = df.select(row_of(keep).alias("row"), quoted(text).alias("text"))
    schema = _long(source.select("row").schema, "piece", "start", "length", "ids_crc32", "part", "nth")
    schema = schema.add("ids", ArrayType(IntegerType())) if ids else schema

    def run(batches) -> Iterator[pa.RecordBatch]:
        encode = byte_level(path, True)
        seen = np.zeros(limit + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                flat, sizes = encode([t or "" for t in texts])
                flat = np.insert(flat, np.cumsum(sizes), end).astype("<u4")
                sizes = sizes + 1
                owner, start, length = cut_points(sizes, limit)
                at = (np.cumsum(sizes) - sizes)[owner] + start
                raw = memoryview(flat.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
                order = np.argsort(length, kind="stable")
                ranked = length[order]
                begin = np.searchsorted(ranked, ranked)
                nth = np.empty(len(order), np.int64)
                nth[order] = seen[ranked] + np.arange(len(order)) - begin
                seen += np.bincount(length, minlength=limit + 1)
                piece = np.arange(len(owner)) - np.searchsorted(owner, owner)
                rows = batch.column(0).slice(first, len(texts)).take(pa.array(owner))
                made = [piece, start, length, crc, np.full(len(owner), part), nth]
                columns = [rows, *(pa.array(m, pa.int64()) for m in made)]
                if ids:
                    columns.append(list_array(flat.astype(np.int32), length))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(run, schema)


def pack(
    df: DataFrame,
    path: str,
    limit: int = 2_048,
    end: int = 0,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    ids: bool = False,
) -> DataFrame:
    """Every text as token ids and ``end``, packed into sequences of at most ``limit`` tokens.

    One row per piece: ``keep``, piece, start (ids of its document before it), length, ids_crc32
    (of the ids as little-endian unsigned 32-bit numbers), sequence_id, offset (the place in its
    sequence, without gaps from 0) and, on request, the ids. Only documents of more than ``limit``
    ids are cut, into pieces of ``limit`` of which the first may be shorter.

    A null or empty text is ``end`` alone; very long texts are encoded whole; repeated rows are
    packed each; rows without a key are packed as well; an empty table gives an empty one. Kept
    columns with the name of a returned one give way; other columns are ignored. Which of equally
    long pieces takes which place follows the order of the rows in the input's partitions.

    The pieces are stored once, without their ids unless asked for. The driver sees one count per
    length, ``limit`` at most, and sends one row per length of each pattern.
    """
    spark = df.sparkSession
    keep = without(keep, PLACED)
    path_of_pieces = scratch_path(spark, "pieces")
    token_pieces(df, path, limit, end, text, keep, ids).write.parquet(path_of_pieces)
    stored = spark.read.parquet(path_of_pieces)
    per_part = stored.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(limit + 1, np.int64)
    for row in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    table = places(best_two_fit(counts, limit))
    # number of a piece among all of its length: those of the parts before, then its own
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")
    numbered = stored.join(per_part.select("length", "part", earlier), ["length", "part"])
    sent = spark.sparkContext.broadcast(table)
    last = ["ids"] if ids else []
    source = numbered.select(
        "row", "piece", "start", "length", "ids_crc32",
        (F.col("earlier") + F.col("nth")).alias("number"), *last,
    )
    schema = _long(stored.select("row").schema, *PLACED[:-1])
    schema = schema.add("ids", ArrayType(IntegerType())) if ids else schema

    def run(batches) -> Iterator[pa.RecordBatch]:
        t = sent.value
        starts = np.searchsorted(t["length"], np.arange(limit + 2))
        # numbers of one length lie apart from those of the next
        span = int(t["first"].max(initial=0)) + 1
        keys = t["length"] * span + t["first"]
        for batch in batches:
            length, number = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            row = np.searchsorted(keys, length * span + np.minimum(number, span - 1), "right") - 1
            row = np.clip(row, starts[length], starts[length + 1] - 1)
            within = number - t["first"][row]
            each = t["each"][row]
            made = [t["sequence"][row] + within // each, t["offset"][row] + within % each * length]
            columns = [*batch.columns[:5], *(pa.array(m, pa.int64()) for m in made)]
            yield pa.RecordBatch.from_arrays(columns + batch.columns[6:], names=schema.names)

    return source.mapInArrow(run, schema).select(*fields_of("row", keep), *PLACED[:6], *last)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed token ids: sequence_id, n_tokens and ids, pieces joined by their offsets.

    ``packed`` holds the ids (``ids=True``); a sequence is bounded by its limit.
    """
    pieces = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.flatten(F.transform(pieces, lambda p: p["ids"]))
    made = packed.groupBy("sequence_id").agg(ids.alias("ids"))
    return made.select("sequence_id", F.size("ids").alias("n_tokens"), "ids")
