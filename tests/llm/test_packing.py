"""Best-two-fit packing against one sequence at a time, and its pieces against the library."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tastelens.llm import libraries, packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
DATA = "/root/testdata/sf0.01"


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def one_at_a_time(counts, limit):
    left, made = np.array(counts), []
    while left.any():
        gap, taken = limit, []
        while fits := [s for s in range(gap, 0, -1) if left[s] > 0]:
            taken.append(fits[0])
            left[fits[0]] -= 1
            gap -= fits[0]
        if len(taken) > 1:
            least = min(taken)
            best = (least, 0, 0)
            for a in range(limit, 0, -1):
                for b in range(a, 0, -1):
                    if left[a] > 0 and left[b] > (a == b) and best[0] < a + b <= gap + least:
                        best = (a + b, a, b)
            if best[1]:
                taken.remove(least)
                left[least] += 1
                for s in best[1:]:
                    left[s] -= 1
                    taken.append(s)
        made.append(sorted(taken, reverse=True))
    return made


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=30))
def test_counts_pack_like_single_sequences(counts):
    limit = len(counts)
    counts = np.array([0, *counts])
    patterns = packing.best_two_fit(counts, limit)
    made = [[s for s, n in uses for _ in range(n)] for times, uses in patterns for _ in range(times)]
    assert made == one_at_a_time(counts, limit)


def test_patterns_do_not_grow_with_the_rows():
    draw = np.random.default_rng(4)
    sizes = np.clip(draw.lognormal(6, 1, 200_000).astype(int), 1, 2_048)
    counts = np.bincount(sizes, minlength=2_049)
    few, many = (packing.best_two_fit(counts * n, 2_048) for n in (1, 100_000))
    # ln 2048 * 2048: what a length is taken at most, over all lengths
    assert max(len(few), len(many)) < 15_700
    used = sum(times for times, _ in many)
    assert used <= 1.001 * (np.arange(2_049) * counts).sum() * 100_000 / 2_048


def checked(rows, texts, limit, end):
    """Pieces hold their ids and lie in their sequences without gaps or overlaps."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for key, text in texts.items():
        ids, at = [*ids_of(text), end], 0
        pieces = sorted(by_doc.pop(key), key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(-(-len(ids) // limit)))
        for n, r in enumerate(pieces):
            assert r["start"] == at and (r["length"] == limit or n == 0)
            part = np.array(ids[at : at + r["length"]], dtype="<u4")
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
            at += r["length"]
        assert at == len(ids)
    assert not by_doc
    for places in by_sequence.values():
        upto = 0
        for offset, length in sorted(places):
            assert offset == upto
            upto += length
        assert upto <= limit
    return len(by_sequence)


def test_query(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    rows = queries.QUERIES["op11_packing"](spark, DATA).collect()
    used = checked(rows, texts, 2_048, 0)
    sizes = np.bincount([r["length"] for r in rows], minlength=2_049)
    assert used == sum(times for times, _ in packing.best_two_fit(sizes, 2_048))
    assert used <= -(-sum(r["length"] for r in rows) // 2_048) * 1.01 + 1


@pytest.mark.parametrize("ids", [False, True])
def test_odd_rows(spark, ids):
    draw = random.Random(5)
    texts = [None, "", "a", "<|endoftext|> it's é😀", "x y " * 3_000, " " * 300_000]
    texts += ["same text"] * 40 + [" ".join("ab"[: draw.randint(1, 2)] for _ in range(draw.randint(1, 60))) for _ in range(150)]
    kinds = "doc_id bigint, text string, part string, `LENGTH` string, `a.b` string, _text string"
    rows = [(i, t, "p", "q", "r", "s") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, kinds).repartition(7)
    packed = packing.pack(df, PATH, 64, 9, keep=["doc_id", "part", "LENGTH", "a.b", "_text"], ids=ids)
    found = packed.collect()
    assert packed.columns[:4] == ["doc_id", "part", "a.b", "_text"]
    used = checked(found, dict(enumerate(texts)), 64, 9)
    if ids:
        whole = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
        assert len(whole) == used
        for r in found:
            part = whole[r["sequence_id"]]["ids"][r["offset"] : r["offset"] + r["length"]]
            assert part == r["ids"]


def test_repeated_keys_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "one two")] * 30 + [(None, "three")] * 5, "doc_id bigint, text string")
    found = packing.pack(df, PATH, 8).collect()
    assert len(found) == 35 and len({(r["sequence_id"], r["offset"]) for r in found}) == 35
    assert packing.pack(df.limit(0), PATH, 8).collect() == []


def test_library_ids_of_odd_texts():
    texts = ["", " ", " " * 200_000, "\n \t" * 70_000, "a" * 50_000, "<|endoftext|>x", "it's 'll\x00 ½ é"]
    ids, sizes = libraries.byte_level(PATH, True)(texts)
    for text, end, size in zip(texts, np.cumsum(sizes), sizes):
        assert ids[end - size : end].tolist() == ids_of(text)
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    ids, _ = libraries.byte_level(PATH, False)(["a<|endoftext|>b"])
    assert ids.tolist() == plain.encode("a<|endoftext|>b", add_special_tokens=False).ids
