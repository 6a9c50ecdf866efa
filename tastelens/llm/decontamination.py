"""Benchmark decontamination by rare n-gram seeds and Smith-Waterman alignment.

The n-grams of the test items are counted over all passages. Those of an item that fewest passages
hold are its rare seeds: where a passage meets one, the words around it are aligned with the item
by Smith-Waterman, so that edited and paraphrased copies score as well. Where that leaves a passage
undecided, every other n-gram of the item is a seed too: frequency alone cannot tell chance from
many copies edited alike. Windows that share too few words to reach the wanted score are skipped.
"""

from __future__ import annotations

import re
from itertools import repeat
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastelens.llm.batches import fields_of, map_texts, quoted, row_of, slices, without
from tastelens.session import cut

_WORD = re.compile(r"\w+")
# Alignment scores of equal words, other words and skipped words.
MATCH, MISMATCH, GAP = 1.0, -1.0, -1.0
# Words of an item that start one window of the alignment, and pairs aligned at once.
BIN, AT_ONCE = 16, 2_048
# Share of an item's n-grams, the rarest ones, that are its first seeds.
RARE_SHARE = 0.25
# Places of seeds in items, and words of windows, looked at in one go.
SEEDS_AT_ONCE, WORDS_AT_ONCE = 1_000_000, 1_000_000
# Characters of test items sent to the tasks at once; more items make more passes.
BLOCK_CHARS = 8_000_000


def lowered(text: str | None) -> str:
    """Lower case of the same length, so that places are those of the text itself."""
    text = text or ""
    made = text.lower()
    if len(made) == len(text):
        return made
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(lowered(text))


class Items:
    """The words, n-grams and seeds of one block of test items.

    An n-gram is numbered by the pair of its first n - 1 words and its last, so n may be any
    length. Items of fewer than n words have no n-gram and are looked up as a whole.
    """

    def __init__(self, rows: list[tuple], n: int):
        self.n, self.ids, self.vocabulary, self.items = n, [], {}, []
        number = self.vocabulary
        for item, text in rows:
            codes = [number.setdefault(w, len(number)) for w in words_of(text)]
            if codes:
                self.ids.append(item)
                self.items.append(np.array(codes, dtype=np.int64))
        self.base, self.sizes = max(1, len(number)), np.array([len(c) for c in self.items], dtype=np.int64)
        self.known: list[np.ndarray] = []
        self.short: dict[int, list[tuple[int, int]]] = {}
        grams = self.items
        for length in range(1, n + 1):
            if length > 1:
                keys = [g[:-1] * self.base + c[length - 1 :] for g, c in zip(grams, self.items)]
                flat = np.concatenate([*keys, np.zeros(0, np.int64)])
                self.known.append(np.unique(flat))
                grams = [np.searchsorted(self.known[-1], k) for k in keys]
            if length < n:
                whole = [(int(g[0]), i) for i, g in enumerate(grams) if self.sizes[i] == length]
                self.short.update({length: whole} if whole else {})
        sizes = [len(g) for g in grams]
        flat = np.concatenate([*grams, np.zeros(0, np.int64)]).astype(np.int64)
        # where items hold a seed, ordered by its number
        order = np.argsort(flat, kind="stable")
        self.seeds = int(flat.max(initial=-1)) + 1
        self.seed_owner = np.repeat(np.arange(len(grams)), sizes)[order]
        offset = np.concatenate([*(np.arange(s) for s in sizes), np.zeros(0, np.int64)]).astype(np.int64)
        self.seed_offset = offset[order]
        self.seed_bounds = np.searchsorted(flat[order], np.arange(self.seeds + 1))
        self.rare = np.ones(len(flat), dtype=bool)
        # how often each item has each of its words
        words = np.concatenate([*self.items, np.zeros(0, np.int64)])
        owner = np.repeat(np.arange(len(self.items)), self.sizes)
        self.bag, self.bag_counts = np.unique(owner * self.base + words, return_counts=True)

    def keep_rare(self, passages: np.ndarray):
        """Marks the rare seeds of every item by how many passages hold each seed."""
        held = passages[np.repeat(np.arange(self.seeds), np.diff(self.seed_bounds))]
        order = np.lexsort((held, self.seed_owner))
        counts = np.bincount(self.seed_owner, minlength=len(self.items))
        last = np.cumsum(counts) - counts + np.ceil(counts * RARE_SHARE).astype(np.int64) - 1
        limit = held[order][np.maximum(last, 0)] if len(order) else np.zeros(len(counts), np.int64)
        self.rare = held <= limit[self.seed_owner]

    def codes(self, words: list[str]) -> np.ndarray:
        numbers = map(self.vocabulary.get, words, repeat(-1))
        return np.fromiter(numbers, np.int64, len(words))

    def levels(self, codes: np.ndarray):
        """For lengths 1 to n: the number of the run of words at every place, -1 if in no item."""
        grams = codes
        yield 1, grams
        for length, known in enumerate(self.known, 2):
            grams, last = grams[:-1], codes[length - 1 :]
            keys = np.where((grams >= 0) & (last >= 0), grams * self.base + last, -1)
            at = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
            grams = np.where(known[at] == keys, at, -1) if len(known) else np.full(len(keys), -1)
            yield length, grams

    def look(self, codes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """(seed at every place or -1, whole short items as (item, first word, end))."""
        grams, found = codes, []
        for length, grams in self.levels(codes):
            for number, item in self.short.get(length, ()):
                places = np.flatnonzero(grams == number)
                if len(places):
                    found.append((item, int(places[0]), int(places[0]) + length))
        return grams, found

    def may_reach(self, codes, owner, first, end, least: float) -> np.ndarray:
        """Whether windows share enough words with their items, repeats counted, for ``least``;
        no alignment scores more than one for each shared word."""
        sizes = end - first
        pair = np.repeat(np.arange(len(owner)), sizes)
        places = np.arange(len(pair)) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)
        words = codes[places]
        pair, words = pair[words >= 0], words[words >= 0]
        keys = owner[pair] * self.base + words
        at = np.minimum(np.searchsorted(self.bag, keys), len(self.bag) - 1)
        hit = self.bag[at] == keys
        met, counts = np.unique(pair[hit] * len(self.bag) + at[hit], return_counts=True)
        shared = np.minimum(counts, self.bag_counts[met % len(self.bag)])
        total = np.bincount(met // len(self.bag), shared, len(owner))
        return total >= least * self.sizes[owner]


def align(items: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment score of each row pair and where it ends in item and window.

    Rows are padded with -3 (items) and -2 (windows), which match nothing.
    """
    count, width = windows.shape
    along = -GAP * np.arange(width)
    above = np.zeros((count, width + 1))
    best = np.zeros(count)
    item_end, window_end = np.zeros(count, np.int64), np.zeros(count, np.int64)
    for i in range(items.shape[1]):
        same = windows == items[:, i : i + 1]
        here = np.maximum(above[:, :-1] + np.where(same, MATCH, MISMATCH), above[:, 1:] + GAP)
        # skipping words of the window: the best start to the left, less the words skipped
        here = np.maximum.accumulate(np.maximum(here, 0) + along, axis=1) - along
        top = here.argmax(axis=1)
        value = here[np.arange(count), top]
        better = value > best
        best[better], item_end[better], window_end[better] = value[better], i, top[better]
        above[:, 1:] = here
    return best, item_end, window_end


def _padded(rows: list[np.ndarray], fill: int) -> np.ndarray:
    made = np.full((len(rows), max(map(len, rows))), fill, dtype=np.int64)
    for i, row in enumerate(rows):
        made[i, : len(row)] = row
    return made


def _parts(sizes: np.ndarray, most: int):
    """Slices of about ``most`` in total, of at least one entry each."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    begin = 0
    while begin < len(sizes):
        end = int(np.searchsorted(total, total[begin] + most, side="right")) - 1
        end = max(begin + 1, end)
        yield slice(begin, end)
        begin = end


def _candidates(
    items: Items, codes: np.ndarray, grams: np.ndarray, least: float, rare: bool, decided=()
) -> set[tuple[int, int, int]]:
    """(item, first word, end) of the windows around the seeds of one text that may reach
    ``least``; only around rare seeds if wanted, and not for items that are decided."""
    every = np.flatnonzero(grams >= 0)
    seeds = grams[every]
    begins = items.seed_bounds[seeds]
    counts = items.seed_bounds[seeds + 1] - begins
    skipped = np.zeros(len(items.items), dtype=bool)
    skipped[list(decided)] = True
    found = set()
    for part in _parts(counts, SEEDS_AT_ONCE):
        places, begin, sizes = every[part], begins[part], counts[part]
        rows = np.arange(sizes.sum()) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
        lead = np.repeat(places, sizes) - items.seed_offset[rows]
        wanted = ~skipped[items.seed_owner[rows]] & (items.rare[rows] if rare else True)
        rows, lead = rows[wanted], lead[wanted]
        # the block is at least -(longest item) // BIN, so that the pairs fit one number
        span = len(codes) // BIN + 2 + int(items.sizes.max()) // BIN
        low = -(int(items.sizes.max()) // BIN + 1)
        pairs = np.unique(items.seed_owner[rows] * span + lead // BIN - low)
        owner, block = pairs // span, pairs % span + low
        size = items.sizes[owner]
        slack = size // 2 + BIN
        first = np.maximum(0, block * BIN - slack)
        end = np.minimum(len(codes), (block + 1) * BIN + size + slack)
        for some in _parts(end - first, WORDS_AT_ONCE):
            window = owner[some], first[some], end[some]
            fits = items.may_reach(codes, *window, least)
            found.update(zip(*(w[fits].tolist() for w in window)))
    return found


def _aligned(items: Items, coded: list, wanted: list, least: float, best: dict) -> None:
    """Aligns (row, item, first word, end) and keeps in ``best`` what reaches ``least``."""
    wanted = sorted(wanted, key=lambda w: (w[3] - w[2], w))
    for at in range(0, len(wanted), AT_ONCE):
        part = wanted[at : at + AT_ONCE]
        left = [items.items[i] for _, i, _, _ in part]
        right = [coded[row][first:end] for row, _, first, end in part]
        score, item_end, window_end = align(_padded(left, -3), _padded(right, -2))
        good = [
            n for n, (_, i, _, _) in enumerate(part) if score[n] >= least * len(items.items[i])
        ]
        if not good:
            continue
        # aligned backwards from the end, the best alignment ends where it began
        back = align(
            _padded([left[n][: item_end[n] + 1][::-1] for n in good], -3),
            _padded([right[n][: window_end[n] + 1][::-1] for n in good], -2),
        )
        for k, n in enumerate(good):
            row, item, first, _ = part[n]
            share = float(score[n]) / len(left[n])
            stop = first + int(window_end[n])
            found = (share, -(stop - int(back[2][k])), stop)
            best[row, item] = max(best.get((row, item), found), found)


def leaks_of(texts: list, items: Items, least: float) -> list[list[dict]]:
    """The best alignment of each text with each item that reaches ``least``."""
    coded = [items.codes(words_of(t)) for t in texts]
    looked = [items.look(codes) for codes in coded]
    best: dict[tuple[int, int], tuple] = {}
    for row, (_, whole) in enumerate(looked):
        best.update({(row, item): (1.0, -first, end - 1) for item, first, end in whole})
    for rare in (True, False):
        decided: dict[int, list[int]] = {}
        for row, item in best:
            decided.setdefault(row, []).append(item)
        wanted = [
            (row, *window)
            for row, (codes, (grams, _)) in enumerate(zip(coded, looked))
            for window in _candidates(items, codes, grams, least, rare, decided.get(row, ()))
        ]
        _aligned(items, coded, wanted, least, best)
    result: list[list[dict]] = [[] for _ in texts]
    spans: dict[int, list] = {}
    for (row, item), (share, start, stop) in sorted(best.items()):
        if row not in spans:
            spans[row] = [m.span() for m in _WORD.finditer(lowered(texts[row]))]
        result[row].append(
            {
                "item_id": items.ids[item],
                "similarity": share,
                "begin": spans[row][-start][0],
                "end": spans[row][stop][1],
            }
        )
    return result


def _passages_by_seed(docs: DataFrame, items: Items, sent) -> np.ndarray:
    """How many rows hold each seed of a block; partial counts per slice of a task."""

    def run(batches):
        held = sent.value
        for batch in batches:
            for _, part in slices(batch.column(0)):
                grams = (held.look(held.codes(words_of(t)))[0] for t in part)
                seeds = [np.unique(g[g >= 0]) for g in grams]
                number, n = np.unique(np.concatenate([*seeds, np.zeros(0, np.int64)]), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number, pa.int64()), pa.array(n, pa.int64())], names=["seed", "n"]
                )

    counted = docs.select("content").mapInArrow(run, "seed bigint, n bigint")
    rows = counted.groupBy("seed").agg(F.sum("n").alias("n")).toPandas()
    passages = np.zeros(items.seeds, np.int64)
    passages[rows["seed"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return passages


def with_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    keep=("doc_id",),
    n: int = 3,
    least: float = 0.5,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    out: str = "leaks",
) -> DataFrame:
    """Adds the array ``out`` of (item_id, similarity, begin, end) for every whole text.

    ``similarity`` is the alignment score over that of a full copy of the item, at least ``least``;
    ``begin`` and ``end`` are code points of the aligned passage. Items of fewer than ``n`` words
    are found where all their words stand in a row; ids may be of any type. The items are sent to
    the tasks in blocks of at most about BLOCK_CHARS characters, one block at a time, each in one
    pass that counts its seeds and one that aligns; the counts, one per n-gram of the block, are
    all that the driver receives.

    Null texts, items without an id and items without words match nothing; items repeated with one
    id and text count once; repeated documents stay; empty tables give empty arrays or an empty
    table. Only ``keep`` columns are passed on, and one named like ``out`` gives way to it.
    """
    session = docs.sparkSession
    items = benchmark.select(quoted(item).alias("item"), quoted(item_text).alias("content"))
    items = items.filter("item IS NOT NULL AND content IS NOT NULL").distinct()
    total = items.agg(F.sum(F.length("content"))).first()[0] or 0
    blocks = max(1, ceil(total / BLOCK_CHARS))
    kind = items.schema["item"].dataType.simpleString()
    arrow = items.select("item").limit(0).toArrow().schema.field(0).type
    found_type = f"array<struct<item_id:{kind},similarity:double,begin:bigint,end:bigint>>"
    fields = [("item_id", arrow), ("similarity", pa.float64()), ("begin", pa.int64()), ("end", pa.int64())]
    arrow_type = pa.list_(pa.struct(fields))
    kept = without(keep, [out])
    none = F.array().cast(found_type)
    made = docs.select(row_of(kept).alias("row"), quoted(text).alias("content"), none.alias("found"))
    for number in range(blocks):
        mine = F.pmod(F.xxhash64(F.col("item").cast("string"), "content"), F.lit(blocks)) == number
        rows = sorted(((r["item"], r["content"]) for r in items.filter(mine).collect()), key=repr)
        block = Items(rows, n)
        if block.seeds:
            sent = session.sparkContext.broadcast(block)
            block.keep_rare(_passages_by_seed(made, block, sent))
            sent.destroy()
        seeded = session.sparkContext.broadcast(block)

        def start(seeded=seeded):
            return lambda texts: [pa.array(leaks_of(texts, seeded.value, least), arrow_type)]

        made = map_texts(made, "content", ["row", "content", "found"], f"new {found_type}", start)
        made = made.select("row", "content", F.concat("found", "new").alias("found"))
        if number + 1 < blocks:
            # the next block finds this one gone from the tasks
            made = cut(made)
            seeded.destroy()
    return made.select(*fields_of("row", kept), F.col("found").alias(out))


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """One row per document and test item found in it: key, item_id, similarity, begin, end."""
    found = with_leaks(docs, benchmark, [key], out="_leaks", **options)
    return found.select(quoted(key), F.inline("_leaks"))
