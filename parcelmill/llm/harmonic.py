"""Harmonic packing of documents into training sequences.

A piece of n tokens is of class j = capacity // n, so j pieces of the class always fit into one sequence: class by class, a
sequence is closed when it holds j pieces, and nothing is ever compared or sorted. Each task fills sequences of its own, so there
is no shuffle, and a task that runs again after a lost executor makes the same sequences from the same rows.

What a class of this kind wastes is the gap between the piece and capacity / j. Documents may be cut, so each is cut to little
waste: into full sequences, and the rest into a few pieces that lie close under reciprocals of the capacity
(`split_table`, by the length of the rest alone). When a task's rows end, at most one open sequence a class is left;
their pieces are laid end to end and cut at the capacity, and the last stretch at powers of two, which need no padding.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from parcelmill.llm.tokens import KNOWN, Words, gathered, library_tokenizer, numbered, once, portions

CAPACITY = 4096  # tokens
END = 2  # the id after each document
LEAST = 64  # a rest is not cut into pieces shorter than this
CUT = 2.0  # tokens of padding that one cut less is worth
_FLUSH = 1 << 20  # tokens in a batch of results
_PORTION = 1 << 22  # characters that are encoded at once


def waste(n: np.ndarray, capacity: int) -> np.ndarray:
    """The tokens of padding for each piece of n tokens, in a full sequence of its class."""
    return capacity / (capacity // n) - n


def split_table(capacity: int = CAPACITY, least: int = LEAST) -> np.ndarray:
    """For each length of a rest, 0 to capacity: the length of its first piece; what remains is looked up again.

    A rest is one piece, or a reciprocal of the capacity and a shorter rest: what costs least, waste and `CUT` for each cut.
    """
    first = np.arange(capacity + 1)
    cost = np.zeros(capacity + 1)
    cost[1:] = waste(first[1:], capacity)
    cuts = np.unique(capacity // np.arange(1, max(1, capacity // least) + 1))
    gaps = waste(cuts, capacity) + CUT
    for n in range(2 * least, capacity + 1):
        able = cuts <= n - least
        if able.any():
            costs = gaps[able] + cost[n - cuts[able]]
            if costs.min() < cost[n]:
                cost[n], first[n] = costs.min(), cuts[able][costs.argmin()]
    return first


def cut(n: int, capacity: int, first: np.ndarray) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens."""
    out = [(start, capacity) for start in range(0, n - capacity + 1, capacity)]
    start = len(out) * capacity
    while start < n:
        out.append((start, int(first[n - start])))
        start += out[-1][1]
    return out


class Sequences:
    """The sequences of one task: pieces go in with `add` and `end`, rows (piece ..., sequence, offset) are in `rows`."""

    def __init__(self, capacity: int):
        self.capacity, self.open, self.rows, self.number = capacity, {}, [], 0

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for piece in pieces:
            self.rows.append((*piece, self.number, offset))
            offset += len(piece[2]) // 4
        self.number += 1

    def add(self, document, start: int, ids: bytes, tokens: int) -> None:
        """ids: four bytes a token."""
        kind = self.capacity // (len(ids) // 4)
        pieces = self.open.setdefault(kind, [])
        pieces.append((document, start, ids, tokens))
        if len(pieces) == kind:
            self._close(self.open.pop(kind))

    def end(self) -> None:
        """Close what is open: its pieces end to end, cut at the capacity and at last at powers of two."""
        left = [piece for kind in sorted(self.open) for piece in self.open[kind]]
        total = sum(len(piece[2]) // 4 for piece in left)
        self.open, held, room = {}, [], 0
        for document, start, ids, tokens in left:
            while ids:
                if not room:
                    if held:
                        self._close(held)
                    held, room = [], min(self.capacity, 1 << total.bit_length() - 1) if total < self.capacity else self.capacity
                    total -= room
                held.append((document, start, ids[: 4 * room], tokens))
                n = len(held[-1][2]) // 4
                start, ids, room = start + n, ids[4 * n :], room - n
        if held:
            self._close(held)


class Encoder:
    """The ids of texts by a tokenizer that drops white space and ends each run of letters or signs with a token of its own kind.

    Words that are new are parted before signs that follow an ASCII letter, as the tokenizer does, and ASCII letters become small ones, as there; runs of letters are encoded
    many at once, in one text.
    """

    _SIGNS = ".,;:!?%#"

    def __init__(self, path: str):
        self.library = library_tokenizer(path, special=True)
        ids = self.library.get_vocab()
        self.ends = np.zeros(max(ids.values()) + 1, bool)
        self.ends[[i for piece, i in ids.items() if piece.endswith("</w>")]] = True
        self.runs, self.words = Words(self._runs, 2 * KNOWN), Words(self._words, 2 * KNOWN)

    def _runs(self, runs: list[str]) -> list[bytes]:
        known = {}
        letters = [run for run in runs if run.isalpha()]
        if letters:
            ids = np.array(self.library.encode_batch_fast([" ".join(letters)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(letters):  # else a letter becomes a letter and a sign in lower case
                known = {run: ids[s:e].tobytes() for run, s, e in zip(letters, [0, *ends.tolist()], ends.tolist())}
        rest = [run for run in runs if run not in known]
        found = self.library.encode_batch_fast(rest, add_special_tokens=False)
        known |= {run: array("I", e.ids).tobytes() for run, e in zip(rest, found)}
        return [known[run] for run in runs]

    def _words(self, words: list[str]) -> list[bytes]:
        parted = []
        for word in words:
            stem = word.rstrip(self._SIGNS)
            if stem.isascii() and stem.isalpha():
                parted.append([stem.lower(), word[len(stem) :]] if len(stem) < len(word) else [stem.lower()])
            elif len(stem) < len(word) and stem[-1:].isascii() and stem[-1:].isalpha():
                parted.append([stem, word[len(stem) :]])
            else:
                parted.append([word])
        different = list({part for each in parted for part in each})
        known = dict(zip(different, self.runs(different)))
        return [b"".join([known[part] for part in each]) for each in parted]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Four bytes an id, little-endian."""
        words, index, first = numbered(pc.split_pattern(pa.array([text.replace("\n", " ") for text in texts], pa.string()), " "))
        ids, ends = gathered(self.words(words), index)
        return [ids[s:e].tobytes() for s, e in zip(ends[first[:-1]].tolist(), ends[first[1:]].tolist())]


def pack_tokens(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END,
    numbers: int = 1 << 40,
) -> DataFrame:
    """(document, start, length, ids, doc_tokens, sequence_id, offset): a row for each piece of each document.

    A document is the ids of its text by the tokenizer file and the id `end`; a null or empty text is `end` alone. Each id lies in
    exactly one piece; ids holds a piece's as little-endian unsigned 32-bit numbers, start is the number of its document's
    ids before it and offset its place in the sequence. A sequence holds at most `capacity` tokens. sequence_id counts within a task,
    plus the task times `numbers`; repeated rows and null ids are documents of their own. A table without rows gives none.
    Other columns are not read. A very long text is encoded in parts; its ids are held until it is cut.
    """
    schema = T.StructType([
        T.StructField("document", docs.schema[id_col].dataType), *(T.StructField(c, T.LongType()) for c in ("start", "length")),
        T.StructField("ids", T.BinaryType()), *(T.StructField(c, T.LongType()) for c in ("doc_tokens", "sequence_id", "offset")),
    ])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, first = once(Encoder, tokenizer), split_table(capacity)
        sequences, tail = Sequences(capacity), array("I", [end]).tobytes()
        base = TaskContext.get().partitionId() * numbers
        names = None

        def flushed() -> pa.RecordBatch:
            rows, sequences.rows = sequences.rows, []
            columns = [list(c) for c in zip(*rows)] or [[] for _ in range(6)]
            document, start, ids, tokens, number, offset = columns
            longs = lambda x: pa.array(x, pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(document, names), longs(start), longs([len(x) // 4 for x in ids]), pa.array(ids, pa.binary()), longs(tokens),
                 longs([base + n for n in number]), longs(offset)], schema.fieldNames())

        for batch in batches:
            documents, texts = batch.columns
            names, documents, held, n = documents.type, documents.to_pylist(), [], 0
            for portion in portions(texts, _PORTION):
                for (row, _, ends), ids in zip(portion, encode([piece for _, piece, _ in portion])):
                    held.append(ids)
                    if not ends:
                        continue
                    all_ids = b"".join(held) + tail
                    held = []
                    for start, length in cut(len(all_ids) // 4, capacity, first):
                        sequences.add(documents[row], start, all_ids[4 * start : 4 * (start + length)], len(all_ids) // 4)
                        n += length
                if n >= _FLUSH:
                    yield flushed()
                    n = 0
            yield flushed()
        sequences.end()
        if names is not None:
            yield flushed()

    if os.sys.byteorder != "little":
        raise RuntimeError("ids are written as this machine's integers, which must be little-endian")
    return docs.select(F.col(id_col).alias("document"), F.col(text).cast("string").alias("text")).mapInArrow(fill, schema)
