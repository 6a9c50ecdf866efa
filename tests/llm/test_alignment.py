"""Aligned tokens and their counts against a plain version over all token pairs."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tastelens.llm import alignment, libraries, queries
from tastelens.llm.bpe import byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DATA = "/root/testdata/sf0.01"
FIRST, SECOND = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
FIRST.encode_special_tokens = True
LETTERS = byte_letters()


def second_bytes(number):
    piece = SECOND.id_to_piece(number)
    if SECOND.is_byte(number):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def spans(tokens):
    at, made = 0, []
    for token, raw in tokens:
        made.append((token, at, at + len(raw)))
        at += len(raw)
    return made


def plain(texts):
    """Per row (n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
    known, counts = {}, Counter()
    for text in texts:
        if text not in known:
            known[text] = one_text(text)
        counts.update(set(known[text][1]))
    highest = defaultdict(int)
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    rows = []
    for text in texts:
        measures, links, groups = known[text]
        best = sum(counts[p] == highest[p[0]] for p in links)
        rows.append((*measures, len(links), best, sum(counts[p] for p in links), groups))
    return rows


def one_text(text):
    ids_a = FIRST.encode(" " + (text or ""), add_special_tokens=False).ids
    ids_b = SECOND.encode(text or "")
    a = [(i, bytes(LETTERS[c] for c in FIRST.id_to_token(i))) for i in ids_a if i != 50256]
    b = [(i, second_bytes(i)) for i in ids_b]
    wanted = b" " + (text or "").encode()
    if not text or any(b"".join(raw for _, raw in side) != wanted for side in (a, b)):
        return (0, 0, 0), [], ""
    a, b = spans(a), spans(b)
    links, low = [], 0
    for token, begin, end in a:
        while b[low][2] <= begin:
            low += 1
        links += [(token, t) for t, b_begin, b_end in b[low : low + end - begin] if b_begin < end and b_end > begin]
    cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
    groups, x, y = [], 0, 0
    for cut in cuts:
        left, right = [], []
        while x < len(a) and a[x][2] <= cut:
            left.append(str(a[x][0]))
            x += 1
        while y < len(b) and b[y][2] <= cut:
            right.append(str(b[y][0]))
            y += 1
        groups.append(",".join(left) + "|" + ",".join(right))
    return (len(a), len(b), len(cuts)), links, ";".join(groups)


def digest(groups):
    return hashlib.sha256(groups.encode()).hexdigest() if groups else ""


def test_query(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op13_alignment"](spark, DATA).collect()}
    rows = plain([r["text"] for r in docs])
    assert got == {d["doc_id"]: (*row[:6], digest(row[6])) for d, row in zip(docs, rows)}


ODD = [
    None, "", "a", "a", "a", " ", "   ", "a  b", "▁x", "x ▁", "<s> </s> <unk> <0x41>", "<|endoftext|> it's",
    "\x00\x01", "é😀 日本語", "ﬁ ² ½ \x85", "\n\n\ta\r", "one two three " * 4_000, "a", "It's 1234.5", "One two, three!",
]


@pytest.mark.parametrize("sent", [alignment.MOST_SENT, 0])
def test_odd_rows(spark, sent):
    kinds = "doc_id int, text string, row string, `a.b` string, N_A string, text_sha256 string"
    df = spark.createDataFrame([(i, t, "r", "x", "n", "t") for i, t in enumerate(ODD)], kinds).repartition(3)
    found = alignment.align_tokens(
        df, A, B, keep=["doc_id", "a.b", "row", "N_A", "text_sha256"], groups=True, most_sent=sent
    )
    assert found.columns[:4] == ["doc_id", "a.b", "row", "text_sha256"]
    got = {r["doc_id"]: tuple(r[c] for c in (*alignment.MEASURES, "groups")) for r in found.collect()}
    assert got == dict(enumerate(plain(ODD)))
    assert all(set(got[i][:6]) == {0} for i in (0, 1, 8))


def test_rows_without_key_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], "doc_id bigint, text string")
    got = sorted(tuple(r)[1:] for r in alignment.align_tokens(df, A, B).collect())
    rows = plain(["a b", "a b", None])
    assert got == sorted((*r[:6], digest(r[6])) for r in rows)
    assert alignment.align_tokens(df.limit(0), A, B).collect() == []


def test_bytes_of_pieces():
    strings = libraries.piece_strings(B)
    assert strings == [second_bytes(i) for i in range(len(strings))]
