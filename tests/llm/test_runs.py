"""Runs of words against a plain search over all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tastelens.llm import queries, runs

DATA = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, least=12):
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        at = 0
        while at + q < n:
            begin = at
            while at + q < n and words[at] == words[at + q]:
                at += 1
            if at > begin and at + q - begin >= max(least, 2 * q):
                found.setdefault((begin, at + q), q)
            at += at == begin
    return sorted(((b, e - b, q) for (b, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def drawn(draw, kind, size):
    letters = lambda abc: [draw.choice(abc) for _ in range(size)]
    if kind == "two":
        return letters("ab")
    if kind == "three":
        return letters("abc")
    if kind == "broken":
        made = ([draw.choice("ab") for _ in range(draw.randint(1, 30))] * 200)[:size]
        for _ in range(draw.randint(0, 3)):
            if made:
                made[draw.randrange(len(made))] = draw.choice("abc")
        return made
    if kind == "fibonacci":
        one, two = ["a"], ["b"]
        while len(one) < size:
            one, two = one + two, one
        return one[:size]
    made = []
    while len(made) < size:
        made += ["a"] * draw.randint(1, 20) + ["b"] * draw.randint(0, 2)
    return made


@pytest.mark.parametrize("kind", ["two", "three", "broken", "fibonacci", "blocks"])
def test_runs_are_those_of_all_periods(kind):
    draw = random.Random(kind)
    for _ in range(60):
        per_text = [drawn(draw, kind, draw.randint(0, 150)) for _ in range(draw.randint(1, 4))]
        _, counts, rows, collapsed = runs.compute_runs([" ".join(w) for w in per_text])
        at = 0
        for words, count, left in zip(per_text, counts, collapsed):
            found = [tuple(r) for r in rows[at : at + count].tolist()]
            at += count
            assert found == brute_runs(words), words
            assert left == brute_collapsed(words, found)


def test_wavelet_tree():
    draw = np.random.default_rng(2)
    values = draw.permutation(300)[:200]
    tree = runs.Wavelet(values, 9)
    for _ in range(200):
        begin = int(draw.integers(0, 199))
        end = int(draw.integers(begin + 1, 201))
        bound, part = int(draw.integers(0, 600)), sorted(values[begin:end].tolist())
        one = (np.array([begin]), np.array([end]))
        assert tree.below(*one, np.array([bound]))[0] == sum(v < bound for v in part)
        nth = int(draw.integers(0, len(part)))
        assert tree.smallest(*one, np.array([nth]))[0] == part[nth]


def test_long_texts_end():
    words = ["a"] * 150_000
    assert runs.compute_runs([" ".join(words)])[2].tolist() == [[0, 150_000, 1]]
    words = (["a"] * 50 + ["b"]) * 3_000
    found = runs.compute_runs([" ".join(words)])[2].tolist()
    assert [0, len(words), 51] in found and len(found) == 3_001


def plain_query(key, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(key).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    start, length, q = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{m},{p}\n" for s, m, p in found)
    return (
        key, len(found), start, length, q, 1000 * length // q if q else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(brute_collapsed(words, found).encode()).hexdigest(),
    )


def test_query(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in queries.QUERIES["op12_runs"](spark, DATA).collect()}
    assert len(got) == len(docs)
    short = [r for r in docs if len(r["text"] or "") < 12_000]
    assert len(short) > 0.9 * len(docs)
    for r in short:
        assert got[r["doc_id"]] == plain_query(r["doc_id"], r["text"]), r["doc_id"]
    assert sum(r[1] > 0 for r in got.values()) > len(docs) / 20


def test_query_on_odd_rows(spark, tmp_path):
    texts = [None, "", " \t\r\n", "a", "a " * 30, "x\x85y\x1cz " * 13, "é 日\x00 " * 20, "b c d"]
    rows = [(k, texts[k % len(texts)], "n", "r") for k in range(120)]
    spark.createDataFrame(rows, "doc_id bigint, text string, n_words string, runs string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    got = {r["doc_id"]: tuple(r) for r in queries.QUERIES["op12_runs"](spark, str(tmp_path)).collect()}
    assert got == {k: plain_query(k, t) for k, t, _, _ in rows}


def test_repeated_empty_and_clashing(spark):
    df = spark.createDataFrame([(1, "a " * 12, "z")] * 3 + [(None, None, "y")], "doc_id int, text string, RUNS string")
    found = runs.find_runs(df, keep=["doc_id", "RUNS"])
    rows = found.collect()
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    assert sorted((r["n_words"], r["collapsed"]) for r in rows) == [(0, ""), *[(12, "a")] * 3]
    assert runs.find_runs(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        runs.find_runs(df, least=5)
