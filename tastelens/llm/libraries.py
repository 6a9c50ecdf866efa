"""Token ids of whole texts by the tokenizers' own libraries, all texts of a slice in a row."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np

from tastelens.llm.bpe import PIECES, vocabulary_of

# Texts to (ids of all texts in a row, ids per text).
Encode = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


@lru_cache(maxsize=4)
def byte_level(path: str, specials: bool) -> Encode:
    """A byte-level vocabulary file; once per worker process.

    The ranks of the file are run by ``tiktoken``, which gives the ids of ``tokenizers`` several
    times faster; texts that its pattern matcher refuses (very long white space) and files whose
    merges are not in the order of their ids go to ``tokenizers`` itself. With ``specials``
    strings of added tokens become these tokens, else they are ordinary text.
    """
    import tiktoken
    from tokenizers import Tokenizer

    vocabulary = vocabulary_of(path)
    ordered = all(a < b for a, b in zip(vocabulary.made, vocabulary.made[1:]))
    fast = tiktoken.Encoding(
        "file", pat_str=PIECES, mergeable_ranks=vocabulary.ids, special_tokens=vocabulary.added
    )
    allowed = "all" if specials else set()
    library: list[Tokenizer] = []

    def slow(text: str) -> np.ndarray:
        if not library:
            library.append(Tokenizer.from_file(path))
            library[0].no_truncation()
            library[0].no_padding()
            library[0].encode_special_tokens = not specials
        return np.array(library[0].encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def one(text: str) -> np.ndarray:
        if not ordered:
            return slow(text)
        try:
            return fast.encode_to_numpy(text, allowed_special=allowed, disallowed_special=())
        except ValueError:
            return slow(text)

    return lambda texts: _in_a_row([one(t) for t in texts])


@lru_cache(maxsize=2)
def piece_level(path: str) -> Encode:
    """A sentencepiece model, which puts a space before the text itself; once per worker process."""
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=path)

    def encode(texts):
        found = library.encode(texts, num_threads=1)
        return _in_a_row([np.array(f, dtype=np.uint32) for f in found])

    return encode


def _in_a_row(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(f) for f in found], dtype=np.int64)
    return np.concatenate([*found, np.zeros(0, np.uint32)]), sizes


@lru_cache(maxsize=2)
def piece_strings(path: str) -> list[bytes]:
    """The bytes of every piece: U+2581 is a space, <0xHH> the byte HH."""
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=path)
    numbers = range(library.get_piece_size())
    pieces = map(library.id_to_piece, numbers)
    return [
        bytes([int(p[3:5], 16)]) if library.is_byte(i) else p.replace("▁", " ").encode()
        for i, p in zip(numbers, pieces)
    ]
