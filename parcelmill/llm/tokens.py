"""Token ids of many texts, encoded word by word.

The tokenizers used here never make a token of two words, so the ids of a text are those of its words one after another.
Words repeat: a worker keeps the ids of up to `KNOWN` words that it has met, first of all those met again, and encodes only the others. Texts are taken in
portions of about `PORTION` characters, and a longer text in several, cut at spaces; so what is held at once does not grow
with a text, a table or a vocabulary.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

PORTION = 1 << 20  # characters
KNOWN = 300_000  # words
_LONG = 64  # longer words are not kept
_CUT = re.compile(r"(?<=\S) (?=\S)")


class Words:
    """What `encode` makes of words; it gets a list of words and returns a list of values, none of them None.

    The values of words met lately are held in two dictionaries: once the one in use is full, it becomes the old one, of which
    a word is taken over when it is met again.
    """

    def __init__(self, encode: Callable[[list[str]], list], known: int = KNOWN):
        self.encode, self.most, self.known, self.old = encode, known // 2, {}, {}

    def __call__(self, words: list[str]) -> list:
        """The values of some different words."""
        out = list(map(self.known.get, words))
        gaps = [i for i, value in enumerate(out) if value is None]
        new = []
        for i in gaps:
            out[i] = self.old.get(words[i])
            if out[i] is None:
                new.append(i)
        for i, value in zip(new, self.encode([words[i] for i in new])):
            out[i] = value
        for i in gaps:
            if len(words[i]) <= _LONG:
                self.known[words[i]] = out[i]
        if len(self.known) > self.most:
            self.known, self.old = {}, self.known
        return out


def numbered(lists: pa.ListArray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(different words, place of each word among them, first word of each list and at last their number)."""
    coded = lists.flatten().dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()


def gathered(values: list[bytes], index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of values[i] for each i, one after another; where each begins, and at last their number). Four bytes an id."""
    lengths = np.array([len(v) for v in values], np.int64) >> 2
    starts, n = np.cumsum(lengths) - lengths, lengths[index]
    ends = np.cumsum(n)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[index] - (ends - n), n)
    return np.frombuffer(b"".join(values), np.uint32)[at], np.append(0, ends)


_kept: dict = {}


def once(make: Callable, *key):
    """make(*key), made once in a Python worker: the next task of the worker knows the words of the last."""
    if (make, key) not in _kept:
        _kept.clear()
        _kept[make, key] = make(*key)
    return _kept[make, key]


def parts(text: str, size: int = PORTION) -> Iterator[str]:
    """A text in parts of at least `size` characters, cut at spaces beside which there is no other white space; these go."""
    start = 0
    while cut := _CUT.search(text, start + size):
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:]


def portions(texts: pa.Array, size: int = PORTION) -> Iterator[list[tuple[int, str, bool]]]:
    """Lists of (row, text or part of it, whether the text ends there) of about `size` characters; null is empty."""
    held, n = [], 0
    for row, value in enumerate(texts):
        text = value.as_py() or ""
        pieces = [text] if len(text) <= size else list(parts(text, size))
        for i, piece in enumerate(pieces):
            held.append((row, piece, i == len(pieces) - 1))
            n += len(piece)
            if n >= size:
                yield held
                held, n = [], 0
    if held:
        yield held


def library_tokenizer(path: str, special: bool):
    """A tokenizer of the `tokenizers` library, in one thread; special: the names of special tokens are found in texts."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not special
    return tokenizer
