"""Runs of words: stretches that repeat with a period and cannot be made longer.

Internal pattern matching. Blocks of 4, 8, 16, ... words at dyadic places ask where they occur
again in the window of words after them that a run of their size would need. The words' substrings
of dyadic lengths are ranked by prefix doubling, so that the places of equal blocks lie side by
side in the suffix array, and a wavelet tree over that array answers with the next places at or
after the window's begin. The occurrences in one window form a progression; its members are the
candidate periods, and every candidate is verified by extending the repetition to both sides.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tastelens.llm.batches import Numbering, list_array, map_texts

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Length of the smallest blocks, and how far apart these lie. A run of 12 words or more whose
# period is 14 at most holds such a block, with what follows it a period later.
BLOCK, STEP, SMALL = 4, 2, 14
# Candidates that are verified at once.
AT_ONCE = 1_000_000


class Wavelet:
    """A wavelet tree over distinct numbers below ``2**bits``, one bit vector per level, most
    significant first; all queries go down the levels together."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.zeros, self.before = bits, [], []
        for bit in range(bits - 1, -1, -1):
            ones = (values >> bit) & 1
            self.before.append(np.concatenate([[0], np.cumsum(1 - ones)]))
            self.zeros.append(int(self.before[-1][-1]))
            order = ones.astype(bool)
            values = np.concatenate([values[~order], values[order]])

    def below(self, begin: np.ndarray, end: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many numbers at the places [begin, end) are smaller than ``bound``."""
        over = bound >= 1 << self.bits
        bound = np.where(over, 0, bound)
        found = np.where(over, end - begin, 0)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            before, zeros = self.before[level], self.zeros[level]
            left, right = before[begin], before[end]
            one = (bound >> bit & 1).astype(bool)
            found += np.where(one, right - left, 0)
            begin = np.where(one, zeros + begin - left, left)
            end = np.where(one, zeros + end - right, right)
        return found

    def smallest(self, begin: np.ndarray, end: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The nth smallest number (from 0) at the places [begin, end), which hold more."""
        found = np.zeros(len(begin), np.int64)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            before, zeros = self.before[level], self.zeros[level]
            left, right = before[begin], before[end]
            one = nth >= right - left
            nth = np.where(one, nth - (right - left), nth)
            found |= one.astype(np.int64) << bit
            begin = np.where(one, zeros + begin - left, left)
            end = np.where(one, zeros + end - right, right)
        return found


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, rank of every key, how often it occurs); the rank is the first place in the order."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    first = np.flatnonzero(new)
    sizes = np.diff(np.concatenate([first, [len(keys)]]))
    which = np.cumsum(new) - 1
    rank, size = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
    rank[order], size[order] = first[which], sizes[which]
    return order, rank, size


class Substrings:
    """Ranks of the substrings of 1, 2, 4, ... numbers of a sequence, up to the length from which
    no two are equal, and the suffix array of the places whose block of BLOCK occurs again.

    The sequence ends with, and holds between its parts, numbers that occur once. ``ranks[k]``
    tells substrings of 2**k numbers apart; a substring that occurs once has a negative number of
    its own.
    """

    def __init__(self, numbers: np.ndarray):
        self.size = n = len(numbers)
        single = -1 - np.arange(n, dtype=np.int64)

        def doubled(ranks: np.ndarray, length: int, places: np.ndarray) -> np.ndarray:
            """Ranks of twice the length from places whose halves both occur again."""
            fits = places[places + length < n]
            fits = fits[ranks[fits + length] >= 0]
            made = single.copy()
            if len(fits):
                _, rank, size = _ranked(ranks[fits] * n + ranks[fits + length])
                again = size > 1
                made[fits[again]] = rank[again]
            return made

        _, rank, size = _ranked(numbers)
        self.ranks = [np.where(size > 1, rank, single)]
        length = 1
        while length < BLOCK:
            places = np.flatnonzero(self.ranks[-1] >= 0)
            self.ranks.append(doubled(self.ranks[-1], length, places))
            length *= 2
        # from here on groups of equal substrings are split in place, which sorts the suffixes
        ranks = self.ranks.pop()
        places = np.flatnonzero(ranks >= 0)
        order, rank, size = _ranked(ranks[places])
        self.suffixes = places[order]
        self.groups: list[tuple[np.ndarray, np.ndarray]] = []
        while len(places):
            full, many = single.copy(), np.zeros(n, np.int64)
            again = size > 1
            full[places[again]], many[places[again]] = rank[again], size[again]
            self.ranks.append(full)
            self.groups.append((full, many))
            places, old = places[again], rank[again]
            after = places + length
            follow = np.where(after < n, full[np.minimum(after, n - 1)], -1 - after)
            by = np.lexsort((follow, old))
            places, old, follow = places[by], old[by], follow[by]
            group = np.concatenate([[True], old[1:] != old[:-1]])[: len(old)]
            part = group | np.concatenate([[True], follow[1:] != follow[:-1]])[: len(old)]
            at = np.arange(len(old))
            slot = old + at - at[group][np.cumsum(group) - 1] if len(old) else old
            self.suffixes[slot] = places
            first = np.flatnonzero(part)
            size = np.diff(np.concatenate([first, [len(old)]]))[np.cumsum(part) - 1]
            rank = slot[first][np.cumsum(part) - 1]
            length *= 2

    def same(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the substrings of 2**level from two places inside the sequence are equal."""
        ranks = self.ranks[level]
        return ranks[a] == ranks[b]

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers from a and from b (a < b) on are equal."""
        found = np.zeros(len(a), np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            # longer repetitions than the table knows by its top level go on with that level
            todo = np.arange(len(a))
            while len(todo):
                at = b[todo] + found[todo]
                todo, at = todo[at < self.size], at[at < self.size]
                hit = self.same(level, a[todo] + found[todo], at)
                todo = todo[hit]
                found[todo] += 1 << level
                if level < len(self.ranks) - 1:
                    break
        return found

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers before a and before b (a < b) are equal."""
        found = np.zeros(len(a), np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            step, todo = 1 << level, np.arange(len(a))
            while len(todo):
                at = a[todo] - found[todo] - step
                todo, at = todo[at >= 0], at[at >= 0]
                todo = todo[self.same(level, at, at + (b - a)[todo])]
                found[todo] += step
                if level < len(self.ranks) - 1:
                    break
        return found


def _windows(block: int) -> list[tuple[int, int]]:
    """Distances, first and last, at which blocks of one length look for themselves; each window
    is no longer than the block, so that what it holds is one progression."""
    begin, end = (1, SMALL) if block == BLOCK else (2 * block - 1, 4 * block - 2)
    return [(at, min(at + block - 1, end)) for at in range(begin, end + 1, block)]


def _candidates(words: Substrings, tree: Wavelet, level: int):
    """Yields (place, distance) arrays: blocks of 2**level and where they occur again."""
    ranks, sizes = words.groups[level - BLOCK.bit_length() + 1]
    block = 1 << level
    step = STEP if block == BLOCK else block
    places = np.arange(0, words.size - block + 1, step)
    places = places[ranks[places] >= 0]
    begin, many = ranks[places], sizes[places]
    edges: dict[int, np.ndarray] = {}

    def below(distance: int) -> np.ndarray:
        if distance not in edges:
            edges[distance] = tree.below(begin, begin + many, places + distance)
        return edges[distance]

    for first, last in _windows(block):
        low = below(first)
        count = below(last + 1) - low
        hit = np.flatnonzero(count)
        if not len(hit):
            continue
        at, count, low = places[hit], count[hit], low[hit]
        slot = begin[hit], begin[hit] + many[hit]
        one = tree.smallest(*slot, low)
        gap = np.zeros(len(hit), np.int64)
        more = np.flatnonzero(count > 1)
        gap[more] = tree.smallest(slot[0][more], slot[1][more], low[more] + 1) - one[more]
        # three occurrences: the gap is the block's own period. If that goes on from the block to
        # the occurrences, their distances are multiples of it, and only itself is a new period
        triple = np.flatnonzero(count > 2)
        if len(triple):
            reach = at[triple] + block + _period_reach(words, at[triple], gap[triple], block)
            inside = reach >= one[triple] + block
            own = one[triple] - at[triple] == gap[triple]
            count[triple[inside]] = own[inside]
        total = np.concatenate([[0], np.cumsum(count)])
        begin_at = 0
        while begin_at < len(count):
            stop = int(np.searchsorted(total, total[begin_at] + AT_ONCE, "right")) - 1
            stop = max(stop, begin_at + 1)
            part = slice(begin_at, stop)
            row = np.repeat(np.arange(begin_at, stop), count[part])
            nth = np.arange(len(row)) - np.repeat(total[part] - total[begin_at], count[part])
            yield at[row], one[row] - at[row] + nth * gap[row]
            begin_at = stop


def _period_reach(words: Substrings, at, period, block: int) -> np.ndarray:
    """How many numbers after the block its period goes on for."""
    return np.maximum(words.right(at, at + period) + period - block, 0)


def runs_of(numbers: np.ndarray, least: int = 12) -> np.ndarray:
    """Rows (start, length, period) of the runs of at least ``least`` (12 or more) numbers and two
    periods, by start, then period. Numbers that occur once may separate several sequences."""
    none = np.zeros((0, 3), np.int64)
    if len(numbers) < least:
        return none
    words = Substrings(numbers)
    if not words.groups:
        return none
    tree = Wavelet(words.suffixes, max(1, int(words.size - 1).bit_length()))
    found = [none]
    for offset in range(len(words.groups)):
        level = BLOCK.bit_length() - 1 + offset
        step = STEP if offset == 0 else 1 << level
        for at, period in _candidates(words, tree, level):
            # the first block of a run finds it; the block before it would have found it as well
            before = at - step
            known = (before >= 0) & words.same(step.bit_length() - 1, before, before + period)
            at, period = at[~known], period[~known]
            start = at - words.left(at, at + period)
            end = at + period + words.right(at, at + period)
            fits = end - start >= np.maximum(least, 2 * period)
            found.append(np.stack([start, end - start, period], 1)[fits])
    rows = np.concatenate(found)
    # of equal stretches that with the smallest period
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    same = (rows[1:, 0] == rows[:-1, 0]) & (rows[1:, 1] == rows[:-1, 1])
    rows = rows[np.concatenate([[True], ~same])[: len(rows)]]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _numbers(per_text: Sequence[list[str]]) -> np.ndarray:
    """One number per word, others in every text, and one that occurs once after each text."""
    index: Numbering = Numbering()
    codes: list[int] = []
    sizes = np.array([len(words) for words in per_text], dtype=np.int64)
    for words in per_text:
        codes += map(index.__getitem__, words)
    width = len(index) + 1
    owner = np.repeat(np.arange(len(sizes)), sizes)
    mixed = np.array(codes, dtype=np.int64) + owner * width
    return np.insert(mixed, np.cumsum(sizes), np.arange(len(sizes)) * width + width - 1)


def compute_runs(texts: list, least: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """(words per text, runs per text, runs of all texts in a row, collapsed texts)."""
    per_text = [_WORD.findall(t) if t else [] for t in texts]
    sizes = np.array([len(words) for words in per_text], dtype=np.int64)
    rows = runs_of(_numbers(per_text), least)
    # every text is followed by a number of its own
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    owner = np.searchsorted(begin, rows[:, 0], "right") - 1
    counts = np.bincount(owner, minlength=len(texts))
    change = np.zeros(int((sizes + 1).sum()) + 1, np.int64)
    np.add.at(change, rows[:, 0] + rows[:, 2], 1)
    np.add.at(change, rows[:, 0] + rows[:, 1], -1)
    dropped = np.cumsum(change) > 0
    collapsed = []
    for text, words in enumerate(per_text):
        if counts[text]:
            gone = dropped[begin[text] : begin[text] + len(words)].tolist()
            words = [w for w, out in zip(words, gone) if not out]
        collapsed.append(" ".join(words))
    rows[:, 0] -= begin[owner]
    return sizes, counts, rows, collapsed


def find_runs(
    df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), least: int = 12
) -> DataFrame:
    """Adds n_words, runs and collapsed to ``keep``.

    Words are what white space (space and the characters 9 to 13) leaves between it, numbered from
    0. ``runs`` is an array of (start, length, period), by start, then period: stretches in which
    words one period apart are equal, the period the smallest such, at least ``least`` words (12 or
    more) and two periods long, that no neighbouring word extends. ``collapsed`` holds, joined by
    one space, the words that no run contains after its first period.

    A null or empty text has no words, no runs and the empty text; texts are worked on whole, many
    short ones or a long one at a time; repeated rows stay; an empty table gives an empty one. Kept
    columns named like a new one give way; others are ignored.
    """
    if least < 12:
        raise ValueError("runs of fewer than 12 words are not looked for")

    def start():
        def compute(texts):
            sizes, counts, rows, collapsed = compute_runs(texts, least)
            parts = [pa.array(rows[:, i], pa.int64()) for i in range(3)]
            kinds = pa.StructArray.from_arrays(parts, ["start", "length", "period"])
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(offsets), kinds)
            return [pa.array(sizes, pa.int64()), found, pa.array(collapsed, pa.string())]

        return compute

    fields = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return map_texts(df, text, keep, fields, start)
