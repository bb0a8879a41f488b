"""Alignment of two tokenizations of the same texts.

The byte offsets at which a token of A and a token of B both end cut them into groups; each token of A in a group is linked
with each token of B there. `lockstep` finds the cuts of many documents at once: one numpy state holds an A pointer and a B pointer
for each document, every step advances in all of them the pointer whose token ends first (both where they end together, which is a
cut), and documents that are finished leave the state. A long document enters as several lanes that begin at cuts, so the number
of steps does not grow with a text.

How many documents hold a pair of ids linked is counted in blocks of documents. A block lists its distinct pairs once; each of
its documents refers to them by place. Pairs of all blocks are summed by a grouped aggregate, and the sums go back to the blocks: one row
a block and pair moves, however many documents hold it, so a pair that occurs everywhere is no hot key.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from parcelmill.functions.patterns import BLANKS
from parcelmill.llm.scratch import new_folder, stored
from parcelmill.llm.tokens import Words, gathered, library_tokenizer, numbered, once, portions

LANE = 1024  # tokens of A in a lane, about
STEP_TOKENS = 1 << 20  # tokens of A and B that are aligned at once, about
STEP_ROWS = 1 << 14  # documents that are aligned at once, at most
BLOCK_TOKENS = 1 << 21  # tokens of A and B in a block, about
PRODUCT = 1024  # a group of more links is counted by its distinct ids
# a text with one of these is parted with care: a space beside other white space, or at an end
_ODD = r"^ | $|  |[{0}] [{0}]".format("".join(map(re.escape, BLANKS)))


def byte_level_pieces(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level BPE file of the `tokenizers` library."""
    # fixed values of byte-level BPE: printable bytes stand for themselves, the others for the characters from U+0100 on, in order
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in shown]
    of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(other)}
    with open(path, encoding="utf-8") as file:
        read = json.load(file)
    ids = dict(read["model"]["vocab"]) | {t["content"]: t["id"] for t in read["added_tokens"]}
    out = [b""] * (max(ids.values()) + 1)
    for piece, i in ids.items():
        out[i] = bytes(of[c] for c in piece)
    return out


# fixed value: how byte-level BPE parts a text before it merges
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_level_encoder(path: str, pieces: list[bytes]) -> Callable[[str], list[int]]:
    """Ids of a text without special tokens, by a byte-level BPE file.

    Where the ids count the merges in order they are ranks, and `tiktoken` merges by them, several times faster on single words.
    """
    with open(path, encoding="utf-8") as file:
        read = json.load(file)
    ids, merges = read["model"]["vocab"], [m if isinstance(m, list) else m.split(" ") for m in read["model"]["merges"]]
    step = read["pre_tokenizer"] or {}
    plain = not read["normalizer"] and step.get("type") == "ByteLevel" and step.get("use_regex", True) and not step.get("add_prefix_space")
    if plain and len(ids) == 256 + len(merges) and all(ids["".join(m)] == 256 + i for i, m in enumerate(merges)):
        ranks = {pieces[i]: i for i in ids.values()}
        return tiktoken.Encoding("ranks", pat_str=_PARTS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    library = library_tokenizer(path, special=False)
    return lambda text: library.encode(text, add_special_tokens=False).ids


def sentence_pieces(processor) -> list[bytes]:
    """The bytes of each id of a sentencepiece model."""
    out = []
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if processor.is_byte(i) else piece.replace("\u2581", " ").encode())
    return out


def words_of(text: str) -> list[str]:
    """The text parted at single spaces, but not at one between other white space, where tokens of A may span it."""
    words = text.split(" ")
    out = words[:1]
    for word in words[1:]:
        before, after = out[-1][-1:], word[:1]
        if before in ("", " ") or not after or (before.isspace() and after.isspace()):
            out[-1] += " " + word
        else:
            out.append(word)
    return out


class Encoder:
    """The ids of A and B of words, as they are after a space; none where either loses or changes bytes."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_pieces, self.b_pieces = byte_level_pieces(a_path), sentence_pieces(self.b)
        self.a = byte_level_encoder(a_path, self.a_pieces)
        self.words = Words(self._encode, 500_000)

    def _encode(self, words: list[str]) -> list[tuple]:
        out, a_pieces, b_pieces = [], self.a_pieces, self.b_pieces
        for word, b in zip(words, self.b.encode(words, num_threads=1)):
            spaced = " " + word
            a, raw = self.a(spaced), spaced.encode()
            same = b"".join([a_pieces[i] for i in a]) == raw == b"".join([b_pieces[i] for i in b])
            out.append((array("i", a).tobytes(), array("i", b).tobytes()) if same else ())
        return out

    def _ids(self, pieces: list[str]) -> list[tuple[bytes, bytes] | tuple]:
        """The ids of A and B of each piece, or nothing."""
        column = pa.array(pieces, pa.string())
        odd = pc.match_substring_regex(column, _ODD).to_pylist()
        if any(odd):
            words = [words_of(piece) if strange else piece.split(" ") for piece, strange in zip(pieces, odd)]
            lists = pa.array(words, pa.list_(pa.string()))
        else:
            lists = pc.split_pattern(column, " ")
        words, index, first = numbered(lists)
        values = self.words(words)
        lost = np.append(0, np.cumsum(np.array([not v for v in values], bool)[index]))
        values = [v or (b"", b"") for v in values]
        (a, ends_a), (b, ends_b) = (gathered([v[i] for v in values], index) for i in (0, 1))
        return [
            () if lost[e] > lost[s] else (a[ends_a[s] : ends_a[e]].tobytes(), b[ends_b[s] : ends_b[e]].tobytes())
            for s, e in zip(first[:-1].tolist(), first[1:].tolist())
        ]

    def __call__(self, texts: pa.Array) -> Iterator[tuple[int, bytes, bytes]]:
        """(row, ids of A, ids of B) of each text; none where the joined bytes are not those of a space and the text."""
        held: list = []
        for portion in portions(texts):
            for (row, piece, ends), ids in zip(portion, self._ids([piece for _, piece, _ in portion])):
                held.append(ids if piece else ())
                if ends:
                    a, b = zip(*held) if () not in held else ((), ())
                    yield row, b"".join(a), b"".join(b)
                    held = []


def lanes(ends_a: np.ndarray, ends_b: np.ndarray, starts_a: np.ndarray, size: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """(first token of A, first token of B) of each lane: documents, cut at common ends after about `size` tokens of A.

    The ends are counted over all documents; starts_a: the first token of each document, and at last their number.
    """
    at = []
    for first, last in zip(starts_a[:-1].tolist(), starts_a[1:].tolist()):
        if first == last:
            continue
        at.append(first)
        while last - at[-1] > size:
            where, width = at[-1] + size - 1, 64
            while where < last - 1:
                window = ends_a[where : min(where + width, last - 1)]
                hit = np.flatnonzero(ends_b[np.searchsorted(ends_b, window)] == window)
                if len(hit):
                    break
                where, width = where + len(window), 2 * width
            if where >= last - 1:
                break
            at.append(where + int(hit[0]) + 1)
    a = np.array(at, np.int64)
    return a, np.where(a > 0, np.searchsorted(ends_b, ends_a[a - 1], side="right"), 0) if len(a) else a


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, from_a: np.ndarray, from_b: np.ndarray) -> np.ndarray:
    """Rows (first token of A, last + 1, first token of B, last + 1) of the groups, in order. from_*: first tokens of the lanes."""
    # state: pointers, begin of the open group, end of the lane
    a, b, stop = from_a.copy(), from_b.copy(), np.append(from_a[1:], len(ends_a))
    group_a, group_b = a.copy(), b.copy()
    out = [np.zeros((0, 4), np.int64)]
    while len(a):
        end_a, end_b = ends_a[a], ends_b[b]
        a += end_a <= end_b
        b += end_b <= end_a
        cut = np.flatnonzero(end_a == end_b)
        if len(cut):
            next_a, next_b = a[cut], b[cut]
            out.append(np.stack([group_a[cut], next_a, group_b[cut], next_b], axis=1))
            group_a[cut], group_b[cut] = next_a, next_b
            if (next_a == stop[cut]).any():
                going = a < stop
                a, b, stop, group_a, group_b = a[going], b[going], stop[going], group_a[going], group_b[going]
    groups = np.concatenate(out)
    return groups[np.argsort(groups[:, 0], kind="stable")]


def linked(groups: np.ndarray, a: np.ndarray, b: np.ndarray, owner: np.ndarray, size_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair of ids, links) of the linked pairs, each once a document; owner: the document of each group."""
    m, n = groups[:, 1] - groups[:, 0], groups[:, 3] - groups[:, 2]
    small = m * n <= PRODUCT
    g, per, wide = groups[small], (m * n)[small], n[small]
    which = np.repeat(np.arange(len(g)), per)
    k = np.arange(len(which)) - np.repeat(np.cumsum(per) - per, per)
    pairs = [a[g[which, 0] + k // wide[which]].astype(np.int64) * size_b + b[g[which, 2] + k % wide[which]]]
    documents, links = [owner[small][which]], [np.ones(len(which), np.int64)]
    for i in np.flatnonzero(~small).tolist():
        (x, nx), (y, ny) = (np.unique(t[s:e], return_counts=True) for t, s, e in ((a, *groups[i, :2]), (b, *groups[i, 2:])))
        pairs.append((x.astype(np.int64)[:, None] * size_b + y[None, :]).ravel())
        links.append((nx[:, None] * ny[None, :]).ravel())
        documents.append(np.full(len(x) * len(y), owner[i]))
    document, pair, count = (np.concatenate(x) for x in (documents, pairs, links))
    order = np.lexsort((pair, document))
    document, pair, count = document[order], pair[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (document[1:] != document[:-1])])) if len(pair) else np.zeros(0, np.int64)
    return document[first], pair[first], np.add.reduceat(count, first) if len(first) else count


def listed(groups: np.ndarray, a: np.ndarray, b: np.ndarray, names: list[str], first_b: int) -> list[str]:
    """The tokens in the order of the groups, A before B, each with the sign after it: `,` or at a group's end `|` after A, `;` after B."""
    last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    last_a[groups[:, 1] - 1] = 1
    last_b[groups[:, 3] - 1] = 1
    out = np.empty(len(a) + len(b), np.int64)
    out[np.arange(len(a)) + np.repeat(groups[:, 2], groups[:, 1] - groups[:, 0])] = 2 * a + last_a
    out[np.arange(len(b)) + np.repeat(groups[:, 1], groups[:, 3] - groups[:, 2])] = first_b + 2 * b + last_b
    return list(map(names.__getitem__, out.tolist()))


def _short(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative numbers as bytes; 255 means that one more number, in the second list, is to be added."""
    return np.minimum(values, 255).astype(np.uint8), (values[values >= 255] - 255).astype(np.uint32)


def _long(short: bytes, more: bytes) -> np.ndarray:
    values = np.frombuffer(short, np.uint8).astype(np.int64)
    values[values == 255] += np.frombuffer(more, np.uint32)
    return values


#: Of a document: gaps between the places of its pairs in the block's list, and links beyond the first. Of a block: its pairs.
_REFERENCES = ("gap", "more_gap", "link", "more_link")


def encoded(docs: DataFrame, a_path: str, b_path: str, id_col: str, text: str) -> DataFrame:
    """A row for each document with its groups, and a row for each block with its pairs and how many of its documents hold each."""
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("of_block", T.BooleanType()), T.StructField("document", docs.schema[id_col].dataType),
        *(T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")), T.StructField("groups", T.StringType()),
        *(T.StructField(c, T.BinaryType()) for c in _REFERENCES),
        T.StructField("pair", T.ArrayType(T.LongType())), T.StructField("held", T.ArrayType(T.LongType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once(Encoder, a_path, b_path)
        length_a, length_b = (np.array([len(p) for p in pieces], np.int64) for pieces in (encoder.a_pieces, encoder.b_pieces))
        names = [f"{i}{sign}" for i in range(len(length_a)) for sign in ",|"] + [f"{i}{sign}" for i in range(len(length_b)) for sign in ",;"]
        size_b = len(length_b)
        block, kind = TaskContext.get().partitionId() << 32, None
        waiting, done = [], []  # documents not aligned yet; what is aligned in this block

        def aligned(texts: list[tuple]) -> dict:
            """The groups and pairs of some documents (id, ids of A, ids of B)."""
            a, b = (np.frombuffer(b"".join(t[i] for t in texts), np.int32).astype(np.int64) for i in (1, 2))
            starts_a, starts_b = (np.cumsum([0, *(len(t[i]) // 4 for t in texts)]) for i in (1, 2))
            ends_a, ends_b = np.cumsum(length_a[a]), np.cumsum(length_b[b])
            groups = lockstep(ends_a, ends_b, *lanes(ends_a, ends_b, starts_a))
            owner = np.searchsorted(starts_a, groups[:, 0], side="right") - 1
            sizes = (groups[:, 1] - groups[:, 0]) * (groups[:, 3] - groups[:, 2])
            bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
            tokens, at = listed(groups, a, b, names, 2 * len(length_a)), starts_a + starts_b
            return {
                "id": [t[0] for t in texts], "n_a": np.diff(starts_a), "n_b": np.diff(starts_b),
                "n_groups": np.diff(bounds), "n_links": np.diff(np.append(0, np.cumsum(sizes))[bounds]),
                "groups": ["".join(tokens[s:e])[:-1] for s, e in zip(at[:-1].tolist(), at[1:].tolist())],
                "linked": linked(groups, a, b, owner, size_b),
            }

        def emitted() -> pa.RecordBatch:
            """The documents of a block and the block itself."""
            pairs, held = np.unique(np.concatenate([d["linked"][1] for d in done]), return_counts=True)
            order = np.argsort(-held, kind="stable")  # pairs that many documents hold lie close together
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            rows: dict[str, list] = {c: [] for c in schema.fieldNames()}
            for d in done:
                document, pair, links = d["linked"]
                where = place[np.searchsorted(pairs, pair)]
                by = np.lexsort((where, document))
                bounds = np.searchsorted(document, np.arange(len(d["id"]) + 1)).tolist()
                where, links = where[by], links[by]
                for s, e in zip(bounds, bounds[1:]):
                    for c, x in zip(_REFERENCES, (*_short(np.diff(where[s:e], prepend=0)), *_short(links[s:e] - 1))):
                        rows[c].append(x.tobytes())
                rows["document"] += d["id"]
                rows["groups"] += d["groups"]
                for c in ("n_a", "n_b", "n_groups", "n_links"):
                    rows[c] += d[c].tolist()
            n = len(rows["document"])
            rows |= {"block": [block] * (n + 1), "of_block": [False] * n + [True], "pair": [None] * n + [pairs[order]], "held": [None] * n + [held[order]]}
            arrays = []
            for field in schema.fields:
                values = rows[field.name] + [None] * (n + 1 - len(rows[field.name]))
                arrays.append(pa.array(values, kind if field.name == "document" else _ARROW[field.dataType.simpleString()]))
            return pa.RecordBatch.from_arrays(arrays, schema.fieldNames())

        new = held = 0  # tokens waiting, tokens in this block
        for batch in batches:
            kind, ids = batch.column(0).type, batch.column(0).to_pylist()
            for row, a, b in encoder(batch.column(1)):
                waiting.append((ids[row], a, b))
                new += (len(a) + len(b)) // 4
                if new >= STEP_TOKENS or len(waiting) >= STEP_ROWS:
                    done.append(aligned(waiting))
                    waiting, new, held = [], 0, held + new
                    if held >= BLOCK_TOKENS or len(done) >= BLOCK_TOKENS // STEP_TOKENS:
                        yield emitted()
                        done, held, block = [], 0, block + 1
        if waiting:
            done.append(aligned(waiting))
        if done:
            yield emitted()

    return docs.select(F.col(id_col).alias("document"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


_ARROW = {"bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(document, n_a, n_b, n_groups, n_links, groups): the groups of each text, as in `links`, without counts."""
    return encoded(docs, a_path, b_path, id_col, text).filter(~F.col("of_block")).select("document", "n_a", "n_b", "n_groups", "n_links", "groups")


def links(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """(document, n_a, n_b, n_groups, n_links, n_best, count_sum, groups): the alignment of each text and how common its links are.

    a_path: a byte-level BPE file of the `tokenizers` library, which reads a space and the text; b_path: a sentencepiece model,
    which adds that space itself. groups lists the ids, `a1,a2|b1;a3|b2,b3`. The count of a pair of ids is the number of rows that hold it linked;
    count_sum adds the counts of all links, n_best is the number of links whose count is the highest of their A id, ties included. Null and
    empty texts, and those whose joined bytes of A or B are not a space and the text, have no tokens: zeros and ''. Repeated
    rows and null ids are documents of their own; an empty table gives no rows; other columns are not read. `keep` replaces the column
    groups by expressions over it, for who wants a digest of it only.
    """
    keep = keep or {"groups": F.col("groups")}
    path = new_folder(docs.sparkSession, "aligned")
    rows = encoded(docs, a_path, b_path, id_col, text).withColumns(keep)
    rows = rows if "groups" in keep else rows.drop("groups")
    rows.write.option("compression", "zstd").parquet(path)
    table = docs.sparkSession.read.schema(rows.schema)

    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    pairs = table.parquet(path).filter("of_block").select("block", F.posexplode(F.arrays_zip("pair", "held")).alias("place", "x")).select("block", "place", "x.pair", "x.held")
    counts = stored(pairs.groupBy("pair").agg(F.sum("held").alias("n")), "pairs")
    highest = counts.groupBy(F.floor(F.col("pair") / size_b).alias("a")).agg(F.max("n").alias("highest"))  # a row for each id of A at most
    flagged = counts.withColumn("a", F.floor(F.col("pair") / size_b)).join(F.broadcast(highest), "a")
    # the count, doubled, and one more if it is the highest of its A id
    back = pairs.join(flagged.select("pair", (2 * F.col("n") + (F.col("n") == F.col("highest")).cast("long")).alias("mark")), "pair").select("block", "place", "mark")
    documents = table.parquet(path).filter(~F.col("of_block")).drop("of_block", "pair", "held")
    schema = T.StructType([f for f in documents.schema.fields if f.name not in ("block", *_REFERENCES)] + [T.StructField(c, T.LongType()) for c in ("n_best", "count_sum")])

    def sums(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        marks = np.zeros(len(theirs) + 1, np.int64)
        marks[theirs["place"].to_numpy()] = theirs["mark"].to_numpy()
        best, total = [], []
        for gap, more_gap, link, more_link in zip(*(mine[c].to_pylist() for c in _REFERENCES)):
            mark, n = marks[np.cumsum(_long(gap, more_gap))], _long(link, more_link) + 1
            best.append(int((mark & 1) @ n))
            total.append(int((mark >> 1) @ n))
        out = mine.drop_columns(["block", *_REFERENCES])
        return out.append_column("n_best", pa.array(best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))

    return documents.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(sums, schema)
