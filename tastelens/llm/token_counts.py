"""Token counts of every prefix, so that truncation and budget questions need no re-encoding.

Within a piece of text, dynamic programming over its bytes finds the last token of the encoding of
every prefix: the one vocabulary string ending there whose left neighbour, the last token of the
remaining prefix, stays apart from it when the two are merged. Its count is that neighbour's plus
one. A document's counts are those of its pieces on top of the totals before them.
"""

from __future__ import annotations

from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tastelens.llm.batches import Numbering, list_array, map_texts, run_starts, take_runs
from tastelens.llm.bpe import REMEMBERED, Recent, vocabulary_of

# Pieces that a shorter prefix cuts differently: the quote stands alone until the last letter.
_LATE = ("'re", "'ve", "'ll")

_BLANK = frozenset(regex.findall(r"\s", "".join(map(chr, range(0x3100)))))


class PrefixCounts:
    """Token counts of every code-point prefix of a text."""

    def __init__(self, path: str):
        self.vocabulary = v = vocabulary_of(path)
        self._piece = Recent(self._count_piece)
        self._apart: dict[int, bool] = {}
        self._raw, self._last, self._counts = b"", [-1], [0]
        self._whole = Recent(lambda token: v.merge(v.strings[token]) == [token])
        self._made_by = dict(zip(v.made, range(len(v.made))))
        self._edges = Recent(self._edge_symbols)

    def _edge_symbols(self, token: int) -> tuple[list, list]:
        """Symbols at the right and at the left edge of a token while it is put together, each
        with the rank of the merge that uses it up."""
        found = []
        for side in (1, 0):
            spine, symbol, end = [], token, len(self.vocabulary.made)
            while True:
                spine.append((symbol, end))
                end = self._made_by.get(symbol)
                if end is None:
                    break
                symbol = self.vocabulary.parents[end][side]
            found.append(spine)
        return found[0], found[1]

    def _stay_apart(self, pair: int) -> bool:
        """No merge across the border of two tokens comes before those inside them.

        Of equal ranks the leftmost merge comes first: one inside the left token is earlier, one
        inside the right token later than that across the border.
        """
        rank = self.vocabulary.rank
        lefts, rights = self._edges(pair >> 32)[0], self._edges(pair & 0xFFFFFFFF)[1]
        for x, x_ends in lefts:
            for y, y_ends in rights:
                across = rank.get(x << 32 | y)
                if across is not None and across < x_ends and across <= y_ends:
                    return False
        return True

    def _raw_counts(self, raw: bytes) -> list[int]:
        """Counts after 0, 1, ... bytes; what the piece before shares with this one is kept."""
        find, longest = self.vocabulary.ids.get, self.vocabulary.longest
        whole, apart, last, counts = self._whole, self._apart, self._last, self._counts
        if len(apart) > 4 * REMEMBERED:
            apart.clear()
        same, most = 0, min(len(raw), len(self._raw))
        while same < most and raw[same] == self._raw[same]:
            same += 1
        self._raw = raw
        del last[same + 1 :], counts[same + 1 :]
        for end in range(same + 1, len(raw) + 1):
            for begin in range(end - 1, max(-1, end - longest - 1), -1):
                token = find(raw[begin:end])
                if token is None:
                    continue
                if begin:
                    pair = last[begin] << 32 | token
                    fits = apart.get(pair)
                    if fits is None:
                        fits = apart[pair] = self._stay_apart(pair)
                else:
                    fits = whole(token)
                if fits:
                    last.append(token)
                    counts.append(counts[begin] + 1)
                    break
        return counts[:]

    def _count_piece(self, piece: str) -> bytes:
        """Counts after 1, 2, ... code points as packed int32."""
        raw = piece.encode()
        counts = self._raw_counts(raw)
        if piece in _LATE:
            counts[2] = counts[1] + self._raw_counts(raw[1:2])[1]
        if len(raw) > len(piece):
            counts = [c for c, follow in zip(counts, [*raw, 0]) if follow & 0xC0 != 0x80]
        return array("i", counts[1:]).tobytes()

    def ordinary(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Counts after every code point of texts without added tokens, all in a row; the count
        of each whole text."""
        index, codes, per_text = Numbering(), [], []
        for text in texts:
            pieces = self.vocabulary.pieces(text)
            codes += map(index.__getitem__, pieces)
            per_text.append(len(pieces))
        known = list(index)
        runs = self._piece.many(known)
        lengths = np.array([len(r) // 4 for r in runs], dtype=np.int64)
        flat = np.frombuffer(b"".join(runs), dtype=np.int32)
        starts = run_starts(lengths)
        codes = np.array(codes, dtype=np.int64)
        per_text = np.array(per_text, dtype=np.int64)
        totals = flat[starts + lengths - 1][codes].astype(np.int64) if len(codes) else codes
        running = np.concatenate([[0], np.cumsum(totals)])
        first = run_starts(per_text)
        base = running[:-1] - np.repeat(running[first], per_text)
        sizes = lengths[codes]
        counts = take_runs(flat, starts, lengths, codes) + np.repeat(base, sizes)
        # white space up to its last character: the prefix that ends with that character is still
        # one piece, only what follows takes the character away
        ends_blank = np.array([p[-1] in _BLANK for p in known], dtype=bool)
        begins_blank = np.array([p[0] in _BLANK for p in known], dtype=bool)
        same = np.diff(np.repeat(np.arange(len(per_text)), per_text)) == 0
        cut = np.flatnonzero(same & ends_blank[codes[:-1]] & begins_blank[codes[1:]])
        place = np.cumsum(sizes)
        for at in cut.tolist():
            run = known[codes[at]] + known[codes[at + 1]][0]
            counts[place[at]] = base[at] + np.frombuffer(self._piece(run), dtype=np.int32)[-1]
        return counts, running[first + per_text] - running[first]

    def of(self, text: str) -> np.ndarray:
        """Counts of the prefixes of 0, 1, ... code points."""
        parts = self.vocabulary.parts(text)
        found, total = [np.zeros(1, np.int64)], 0
        for place in range(0, len(parts), 2):
            special = parts[place + 1] if place + 1 < len(parts) else ""
            # until its last letter an added token is ordinary text
            counts, _ = self.ordinary([parts[place] + special[:-1]])
            found.append(counts + total)
            if special:
                total += int(self.ordinary([parts[place]])[1][0]) + 1
                found.append(np.array([total]))
        return np.concatenate(found)

    def many(self, texts: list) -> list[np.ndarray]:
        texts = [t or "" for t in texts]
        plain = [i for i, t in enumerate(texts) if len(self.vocabulary.parts(t)) == 1]
        counts, _ = self.ordinary([texts[i] for i in plain])
        ends = np.cumsum([len(texts[i]) for i in plain])
        zero = np.zeros(1, np.int64)
        result: list = [None] * len(texts)
        for i, end in zip(plain, ends.tolist()):
            result[i] = np.concatenate([zero, counts[end - len(texts[i]) : end]])
        for i, found in enumerate(result):
            if found is None:
                result[i] = self.of(texts[i])
        return result


@lru_cache(maxsize=2)
def counter_of(path: str) -> PrefixCounts:
    """Made once per worker process, which runs many tasks."""
    return PrefixCounts(path)


def prefix_counts(
    df: DataFrame, path: str, text: str = "text", keep=("doc_id",), out: str = "counts"
) -> DataFrame:
    """Adds an int array: element i (from 0) is the token count of the first i code points.

    A null or empty text gives ``[0]``. Texts are never cut, repeated rows stay, an empty table
    gives an empty one, and only ``keep`` columns are passed on.
    """

    def start():
        counter = counter_of(path)

        def compute(texts):
            found = counter.many(texts)
            flat = np.concatenate(found) if found else np.zeros(0, np.int64)
            return [list_array(flat.astype(np.int32), np.array([len(f) for f in found]))]

        return compute

    return map_texts(df, text, keep, f"`{out}` array<int>", start)


def count_tokens(
    df: DataFrame, path: str, limit: int, text: str = "text", keep=("doc_id",)
) -> DataFrame:
    """Answers from the prefix counts, which stay in the task: ``n_bytes`` (UTF-8), ``n_tokens``
    of the whole text, ``over_limit`` (more than ``limit`` tokens) and ``fit_chars``, the code
    points of the longest prefix of at most ``limit`` tokens. A longer prefix can have fewer
    tokens than a shorter one, which is why every prefix counts. Null texts count as empty.
    """

    def start():
        counter = counter_of(path)

        def compute(texts):
            found = counter.many(texts)
            tokens = [int(f[-1]) for f in found]
            fit = [int(np.flatnonzero(f <= limit)[-1]) for f in found]
            sizes = [len((t or "").encode()) for t in texts]
            return [
                pa.array(sizes, pa.int64()),
                pa.array(tokens, pa.int64()),
                pa.array([t > limit for t in tokens], pa.bool_()),
                pa.array(fit, pa.int64()),
            ]

        return compute

    fields = "n_bytes bigint, n_tokens bigint, over_limit boolean, fit_chars bigint"
    return map_texts(df, text, keep, fields, start)
