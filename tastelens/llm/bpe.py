"""BPE encoding and decoding from a public vocabulary file.

Encoding: text is cut into pieces by the vocabulary's pattern; within a piece the symbols form a
doubly linked list, and a priority queue holds the merge ranks of neighbouring symbols. The lowest
rank is merged first, the leftmost first among equals; queue entries whose symbols have changed
meanwhile are stale and skipped. Decoding concatenates the byte strings of the vocabulary.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tastelens.llm.batches import Numbering, list_array, map_texts, run_starts, take_runs

# Fixed value: the pattern that cuts text into pieces for this family of byte-level vocabularies.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The same for ASCII text, where the letter and number classes are plain ranges.
ASCII_PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
)

# Pieces remembered per task; twice as many are held at most.
REMEMBERED = 150_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in plain]
    letters.update({chr(256 + i): b for i, b in enumerate(others)})
    return letters


class Recent:
    """A memory of bounded size: what was not asked for during two generations is forgotten."""

    def __init__(self, make, most: int = REMEMBERED):
        self.make, self.most, self.new, self.old = make, most, {}, {}

    def __call__(self, key):
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is None:
                found = self.make(key)
            if len(self.new) >= self.most:
                self.old, self.new = self.new, {}
            self.new[key] = found
        return found

    def many(self, keys: list) -> list:
        """Values of distinct keys; those not remembered are made in the order of the keys."""
        recent, older = self.new, self.old
        found, missing = {}, []
        for key in keys:
            value = recent.get(key)
            if value is None:
                value = older.get(key)
                if value is None:
                    missing.append(key)
                else:
                    recent[key] = value
            found[key] = value
        for key in sorted(missing):
            found[key] = self(key)
        return list(found.values())


class Vocabulary:
    """Byte strings, merge ranks and added tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, letters = data["model"], byte_letters()

        def raw(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        self.ids = {raw(token): number for token, number in model["vocab"].items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        # rank of a pair of ids, the two packed into one number; ids made and merged by rank
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        self.parents: list[tuple[int, int]] = []
        for rank, (left, right) in enumerate(pairs):
            a, b = raw(left), raw(right)
            self.rank.setdefault(self.ids[a] << 32 | self.ids[b], rank)
            self.made.append(self.ids[a + b])
            self.parents.append((self.ids[a], self.ids[b]))
        added = {t["content"]: t["id"] for t in data.get("added_tokens", ())}
        self.added = added
        size = 1 + max([*self.ids.values(), *added.values()])
        self.strings = [b""] * size
        for text, number in self.ids.items():
            self.strings[number] = text
        for text, number in added.items():
            self.strings[number] = text.encode()
        self.longest = max(map(len, self.ids))
        self.of_byte = [self.ids[bytes([b])] for b in range(256)]
        cut = "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True))
        self._added = re.compile(f"({cut})") if cut else None
        self._pieces = regex.compile(PIECES)
        self._ascii = re.compile(ASCII_PIECES, re.ASCII)
        # ranks of two bytes side by side
        self._byte_rank = [
            self.rank.get(a << 32 | b, -1) for a in self.of_byte for b in self.of_byte
        ]

    def parts(self, text: str) -> list[str]:
        """Ordinary text at even places, added tokens between them."""
        return self._added.split(text) if self._added else [text]

    def pieces(self, ordinary: str) -> list[str]:
        return (self._ascii if ordinary.isascii() else self._pieces).findall(ordinary)

    def merge(self, raw: bytes) -> list[int]:
        """Token ids of one piece."""
        rank, made = self.rank, self.made
        symbols = [self.of_byte[b] for b in raw]
        size = len(symbols)
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        # the rank of each symbol with its right neighbour: an entry of another rank is stale
        first = self._byte_rank
        ranks = [first[a << 8 | b] for a, b in zip(raw, raw[1:])]
        ranks.append(-1)
        queue = [r << 32 | at for at, r in enumerate(ranks) if r >= 0]
        heapify(queue)
        while queue:
            entry = heappop(queue)
            lowest, at = entry >> 32, entry & 0xFFFFFFFF
            if ranks[at] != lowest:
                continue
            gone = after[at]
            symbols[at], symbols[gone], ranks[gone] = made[lowest], -1, -1
            after[at] = end = after[gone]
            ranks[at] = -1
            if end < size:
                before[end] = at
                found = rank.get(symbols[at] << 32 | symbols[end], -1)
                if found >= 0:
                    ranks[at] = found
                    heappush(queue, found << 32 | at)
            start = before[at]
            if start >= 0:
                found = rank.get(symbols[start] << 32 | symbols[at], -1)
                ranks[start] = found
                if found >= 0:
                    heappush(queue, found << 32 | start)
        return [s for s in symbols if s >= 0]


@lru_cache(maxsize=2)
def vocabulary_of(path: str) -> Vocabulary:
    """Read once per worker process, which runs many tasks."""
    return Vocabulary(path)


@lru_cache(maxsize=2)
def encoder(path: str):
    """Texts to (ids of all texts in a row, ids per text); once per worker process."""
    vocabulary = vocabulary_of(path)
    added = {t: np.int32(n).tobytes() for t, n in vocabulary.added.items()}
    packed = Recent(lambda p: array("i", vocabulary.merge(p.encode())).tobytes())

    def encode(texts: list) -> tuple[np.ndarray, np.ndarray]:
        index, codes, per_text = Numbering(), [], []
        for text in texts:
            before = len(codes)
            for place, part in enumerate(vocabulary.parts(text or "")):
                # an added token is kept apart from the same letters as ordinary text
                if place % 2:
                    codes.append(index[(part,)])
                else:
                    codes += map(index.__getitem__, vocabulary.pieces(part))
            per_text.append(len(codes) - before)
        ordinary = iter(packed.many([p for p in index if not isinstance(p, tuple)]))
        runs = [added[p[0]] if isinstance(p, tuple) else next(ordinary) for p in index]
        lengths = np.array([len(r) // 4 for r in runs], dtype=np.int64)
        flat = np.frombuffer(b"".join(runs), dtype=np.int32)
        codes = np.array(codes, dtype=np.int64)
        ids = take_runs(flat, run_starts(lengths), lengths, codes)
        upto = np.concatenate([[0], np.cumsum(lengths[codes])])
        ends = np.cumsum(per_text)
        return ids, np.diff(np.concatenate([[0], upto[ends]]))

    return encode


def encode(
    df: DataFrame, path: str, text: str = "text", keep=("doc_id",), out: str = "ids"
) -> DataFrame:
    """Adds the token ids of each whole text as an int array.

    The ids are those of the vocabulary's own library without begin or end tokens, truncation or
    padding; strings of added tokens inside a text become those tokens. A null text counts as
    empty and gives an empty array; very long texts are encoded whole; repeated rows stay; an
    empty table gives an empty one. Only ``keep`` columns are passed on; one named like ``out``
    gives way to it.
    """

    def start():
        run = encoder(path)

        def compute(texts):
            ids, sizes = run(texts)
            return [list_array(ids, sizes)]

        return compute

    return map_texts(df, text, keep, f"`{out}` array<int>", start)


@lru_cache(maxsize=2)
def decoder(path: str):
    """(ids of all texts in a row, ids per text) to texts; once per worker process."""
    strings = vocabulary_of(path).strings
    lengths = np.array([len(s) for s in strings], dtype=np.int64)
    flat, starts = np.frombuffer(b"".join(strings), dtype=np.uint8), run_starts(lengths)

    def decode(ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        known = (ids >= 0) & (ids < len(lengths))
        row = np.repeat(np.arange(len(sizes)), sizes)[known]
        ids = ids[known]
        raw = take_runs(flat, starts, lengths, ids).tobytes()
        per_row = np.bincount(row, weights=lengths[ids], minlength=len(sizes))
        ends = np.cumsum(per_row).astype(np.int64).tolist()
        return [raw[b:e].decode("utf-8", "replace") for b, e in zip([0, *ends], ends)]

    return decode


def decode(
    df: DataFrame, path: str, ids: str = "ids", keep=("doc_id",), out: str = "decoded"
) -> DataFrame:
    """Adds the text that a token id array stands for, added tokens included.

    Bytes that are not UTF-8, possible for arrays cut inside a character, become U+FFFD. A null
    array gives a null text, an empty one the empty text; ids outside the vocabulary are skipped.
    """
    kept = [c for c in keep if c != out]
    schema = df.select(*kept).schema.add(out, "string")

    def run(batches):
        texts_of = decoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                column = part.column(len(kept))
                sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                codes = column.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                missing = column.is_null().to_pylist()
                texts = [None if m else t for m, t in zip(missing, texts_of(codes, sizes))]
                columns = [part.column(i) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays(
                    columns + [pa.array(texts, pa.string())], names=kept + [out]
                )

    return df.select(*kept, df[ids]).mapInArrow(run, schema)


def encode_and_decode(
    df: DataFrame, path: str, text: str = "text", keep=("doc_id",)
) -> DataFrame:
    """Adds ``ids`` as ``encode`` does and ``decoded``, the text that these ids stand for, in one
    pass with one Python worker per task."""

    def start():
        run, back = encoder(path), decoder(path)

        def compute(texts):
            ids, sizes = run(texts)
            return [list_array(ids, sizes), pa.array(back(ids, sizes), pa.string())]

        return compute

    return map_texts(df, text, keep, "ids array<int>, decoded string", start)
