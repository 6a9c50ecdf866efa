"""Near-duplicates by 64-bit SimHash and meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` bits have a common variant within half the radius of each.
Every distinct fingerprint emits its variants; equal variants meet, and by the triangle inequality
whatever meets is within the radius, which is checked all the same. The variant space is dealt out
by its leading bits: a fingerprint goes once to each prefix that some of its variants have, and
the task that owns the prefix completes the variants nibble by nibble, dropping those that no
other fingerprint shares so far. Inside a task, what meets in one variant is linked to its first
member only, and only a spanning forest of these links leaves the task, so a group of copies costs
as many links as it has members.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastelens.llm.batches import fields_of, map_texts, quoted, row_of
from tastelens.llm.components import connected
from tastelens.session import cut, scratch_path

BITS = 64
# Fingerprints that one prefix should receive on average.
PER_PREFIX = 40_000
# A prefix with more members is dealt again by so many further bits; the prefixes to deal again
# are sent to every task up to MOST_HEAVY, beyond that they are joined by a shuffle.
MOST_IN_PREFIX = 400_000
FURTHER = 8
MOST_HEAVY = 100_000
# Partial variants worked on at once in a task.
AT_ONCE = 300_000


def fingerprints_of(texts: list, words: int, seed: int) -> np.ndarray:
    """Fingerprints of texts as uint64."""
    hashes, sizes = [], []
    digest = xxhash.xxh64_intdigest
    for text in texts:
        tokens = (text or "").encode().lower().split()
        line = b" ".join(tokens)
        ends = np.cumsum([len(t) + 1 for t in tokens], dtype=np.int64) - 1
        if len(tokens) > words:
            starts = np.concatenate([[0], ends[:-words] + 1]).tolist()
            found = [digest(line[s:e], seed) for s, e in zip(starts, ends[words - 1 :].tolist())]
        else:
            found = [digest(line, seed)] if tokens else []
        hashes.append(np.array(found, dtype=np.uint64))
        sizes.append(len(found))
    made = np.zeros(len(texts), dtype=np.uint64)
    flat = np.concatenate(hashes) if hashes else made
    sizes = np.array(sizes, dtype=np.int64)
    counts = np.zeros((len(texts), BITS), dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    for at in range(0, len(flat), 65_536):
        part = flat[at : at + 65_536]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        rows = owner[at : at + 65_536]
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        counts[rows[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    over = 2 * counts > sizes[:, None]
    packed = np.packbits(over, axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64).ravel()


def fingerprints(
    df: DataFrame, words: int, seed: int = 42, text: str = "text", keep=("doc_id",), out: str = "bits"
) -> DataFrame:
    """Adds ``out``, the SimHash of a text's word shingles as a long (the bits unsigned).

    Letters A-Z are lower-cased, words are runs without ASCII white space. A text of at most
    ``words`` words is one shingle; a null text or one without words has fingerprint zero.
    """

    def start():
        def compute(texts):
            return [pa.array(fingerprints_of(texts, words, seed).view(np.int64))]

        return compute

    return map_texts(df, text, keep, f"`{out}` bigint", start)


def ball(bits: int, flips: int) -> int:
    return sum(comb(bits, i) for i in range(flips + 1))


def masks(bits: int, flips: int) -> list[int]:
    return [
        sum(1 << b for b in chosen)
        for count in range(flips + 1)
        for chosen in combinations(range(bits), count)
    ]


def prefix_bits(fingerprint_count: int, flips: int) -> int:
    """Leading bits that deal out the variants, so that a prefix has PER_PREFIX members."""
    for bits in range(8, 32, 4):
        if fingerprint_count * ball(bits, flips) <= PER_PREFIX * 2**bits:
            return bits
    return 32


_POPULATION = np.array([bin(w).count("1") for w in range(16)], dtype=np.int8)


def forest(values: np.ndarray, spare: np.ndarray, bits: int, radius: int):
    """Links (value, root) of fingerprints that share a variant with the same leading bits.

    ``spare`` is how many flips each has left for the other ``bits`` bits.
    """
    parent = np.arange(len(values))

    def unite(key: np.ndarray, member: np.ndarray) -> None:
        first = np.concatenate([[True], key[1:] != key[:-1]])
        head = member[first][np.cumsum(first) - 1]
        pairs = np.unique(head * len(values) + member)
        a, b = pairs // len(values), pairs % len(values)
        near = np.bitwise_count(values[a] ^ values[b]) <= radius
        a, b = a[near & (a != b)], b[near & (a != b)]
        while len(a):
            ra, rb = parent[a], parent[b]
            np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                jumped = parent[parent]
                if (jumped == parent).all():
                    break
                parent[:] = jumped
            still = parent[a] != parent[b]
            a, b = a[still], b[still]

    def expand(key: np.ndarray, member: np.ndarray, left: np.ndarray, bit: int) -> None:
        order = np.argsort(key, kind="stable")
        key, member, left = key[order], member[order], left[order]
        same = key[1:] == key[:-1]
        shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        key, member, left = key[shared], member[shared], left[shared]
        if not len(key):
            return
        if bit == 0:
            unite(key, member)
            return
        # parts of whole keys; one key alone may be larger and is split by its next nibble
        edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        group = np.searchsorted(edges, np.arange(0, len(key), AT_ONCE), side="right") - 1
        starts = [*np.unique(edges[group]).tolist(), len(key)]
        for begin, end in zip(starts, starts[1:]):
            k, m, s = key[begin:end], member[begin:end], left[begin:end]
            nibble = ((values[m] >> np.uint64(bit - 4)) & np.uint64(15)).astype(np.int64)
            made = [[], [], []]
            for w in range(16):
                rest = s - _POPULATION[nibble ^ w]
                fits = rest >= 0
                made[0].append((k[fits] << np.uint64(4)) | np.uint64(w))
                made[1].append(m[fits])
                made[2].append(rest[fits])
            if len(starts) == 2 and len(k) > AT_ONCE:
                for parts in zip(*made):
                    expand(*parts, bit - 4)
            else:
                expand(*(np.concatenate(x) for x in made), bit - 4)

    member = np.arange(len(values))
    expand(np.zeros(len(values), dtype=np.uint64), member, spare, bits)
    linked = parent != member
    return values[linked], values[parent[linked]]


def _deal(rows: DataFrame, lead: int, further: int, flips: int) -> DataFrame:
    """(bits, prefix): every member of a prefix of ``lead`` bits, dealt by ``further`` bits more.

    A member goes to each longer prefix within the flips that the shorter one left it.
    """
    own = F.shiftrightunsigned("bits", BITS - lead)
    used = F.bit_count(own.bitwiseXOR(F.col("prefix"))).cast("int")
    longer = F.shiftrightunsigned("bits", BITS - lead - further).bitwiseAND(F.lit(2**further - 1))
    choices = [
        F.when(F.lit(bin(m).count("1")) + F.col("used") <= flips, F.lit(m)) for m in masks(further, flips)
    ]
    change = F.explode(F.array_compact(F.array(*choices)))
    return (
        rows.withColumn("used", used)
        .select("bits", "prefix", change.alias("change"))
        .select(
            "bits",
            F.shiftleft("prefix", further).bitwiseOR(longer.bitwiseXOR(F.col("change"))).alias("prefix"),
        )
    )


def links(distinct: DataFrame, radius: int, count: int, bits: str = "bits") -> DataFrame:
    """(a, b): a spanning forest, per prefix, of the links between distinct fingerprints.

    The members of every prefix are counted first; a prefix with more than MOST_IN_PREFIX is
    dealt again by FURTHER more bits, until none is left or the prefix is a whole variant, which
    has no more members than there are fingerprints within half the radius of it.
    """
    flips = (radius + 1) // 2
    lead = prefix_bits(count, flips)
    changes = F.explode(F.array(*(F.lit(m) for m in masks(lead, flips))))
    own = F.shiftrightunsigned(bits, BITS - lead)
    dealt = distinct.select(F.col(bits).alias("bits"), changes.alias("change")).select(
        "bits", own.bitwiseXOR(F.col("change")).alias("prefix")
    )
    parts = []
    while lead < BITS:
        large = dealt.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
        large = cut(large.filter(F.col("n") > MOST_IN_PREFIX).select("prefix"))
        heavy = large.count()
        if not heavy:
            break
        large = F.broadcast(large) if heavy <= MOST_HEAVY else large
        parts.append(dealt.join(large, "prefix", "left_anti").withColumn("lead", F.lit(lead)))
        further = min(FURTHER, BITS - lead)
        again = _deal(dealt.join(large, "prefix", "left_semi"), lead, further, flips)
        dealt, lead = cut(again), lead + further
    parts.append(dealt.withColumn("lead", F.lit(lead)))

    def meet(key, table):
        values = np.sort(table.column("bits").to_numpy().view(np.uint64))
        prefix, rest = np.uint64(key[0].as_py() % 2**BITS), BITS - key[1].as_py()
        used = np.bitwise_count((values >> np.uint64(rest)) ^ prefix)
        spare = np.int8(flips) - used.astype(np.int8)
        a, b = forest(values, spare, rest, radius)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    members = parts[0]
    for part in parts[1:]:
        members = members.union(part)
    return members.groupBy("prefix", "lead").applyInArrow(meet, "a bigint, b bigint")


def _rooted(distinct: DataFrame, radius: int) -> DataFrame:
    """``distinct`` fingerprints with ``root``, the same for all of a component."""
    nodes = connected(links(distinct, radius, distinct.count()), "a", "b")
    return distinct.join(nodes, F.col("bits") == F.col("node"), "left").select(
        *distinct.columns, F.coalesce("component", "bits").alias("root")
    )


def near_duplicates(
    df: DataFrame,
    words: int,
    radius: int,
    seed: int = 42,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    Rows whose fingerprints differ in at most ``radius`` bits are linked, and the component is the
    smallest key reachable, its own included; null keys never name a component, one of null keys
    only has a null id. Null and empty texts share fingerprint zero and are linked like any other.
    Repeated rows and repeated keys stay, an empty table gives an empty one, other columns are
    ignored.
    """
    rows = df.select(quoted(key).alias("key"), quoted(text).alias("content"))
    rows = cut(fingerprints(rows, words, seed, "content", ["key"]))
    distinct = cut(rows.groupBy("bits").agg(F.min("key").alias("least")))
    classes = _rooted(distinct, radius)
    named = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = classes.join(named, "root").select("bits", "component_id")
    return rows.join(classes, "bits").select(
        F.col("key").alias(key),
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def first_rows(
    df: DataFrame,
    words: int,
    radius: int,
    seed: int = 42,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One whole row of every component: the smallest key, null keys last.

    Rows that share a key, or have none, are told apart by a number of their own, which is written
    with them; among such rows any one may be the first. An empty table gives an empty one.
    """
    path = scratch_path(df.sparkSession, "fingerprints")
    numbered = df.select(
        row_of(df.columns).alias("row"), quoted(key).alias("key"), quoted(text).alias("content"),
        F.monotonically_increasing_id().alias("number"),
    )
    fingerprints(numbered, words, seed, "content", ["row", "key", "number"]).write.parquet(path)
    whole = df.sparkSession.read.parquet(path)
    rows = whole.select(
        "bits", F.struct(F.col("key").isNull().alias("none"), "key", "number").alias("place")
    )
    distinct = cut(rows.groupBy("bits").agg(F.min("place").alias("least")))
    classes = _rooted(distinct, radius)
    firsts = classes.groupBy("root").agg(F.min("least").alias("first"))
    firsts = classes.join(firsts, "root").select("bits", F.col("first.number").alias("first"))
    others = rows.join(firsts, "bits").filter(F.col("place.number") != F.col("first"))
    others = others.select(F.col("place.number").alias("number"))
    return whole.join(others, "number", "left_anti").select(*fields_of("row", df.columns))
