"""Packing by tokens, hard negatives and tokenizer alignment against brute force."""

import hashlib
import json
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcelmill.llm import align, fagin, harmonic, tokens
from parcelmill.llm.queries import QUERIES
from tables import documents, hard_rows

SF = "/root/testdata/sf0.001"
WORD, A, B = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))

ODD = [
    " ", " a", "a ", "a  b", "a\nb", "a \nb", "a\n b", "a \n b", "a\n \nb", "a\t \tb c", "x\n\n y", "é é ﬁ", "日本語 テキスト 中文。",
    "<|endoftext|> <|startoftext|> <s> </s> <unk>", "a▁b", "\x00 \x1c x", "　x y", "🙂🙂 ok", "don't can't I'll. Don't!", "1234567890 " * 4 + "9",
    "a" * 5000, "ab" * 3000 + " " + "=" * 4000, "\r\n x\r\ny", "x y z", "\u0085 x", "a\x1c \x1db", "İstanbul. ΣΑΣ ΟΔΟΣ, ẞ", "word. " * 50000 + "end",
    "  " * 2000 + "x", "A" * 100 + " " + "-" * 300, "word.́ a.b,c 3.14 x...y",
]


def odd_texts(n=300, seed=5):
    draw = random.Random(seed)
    letters = "ab c\n\t 日é1'.,-▁  \x1c🙂#%!"
    return ODD + ["".join(draw.choice(letters) for _ in range(draw.randint(1, 40))) for _ in range(n)]


def table_of(spark, rows, parts=3):
    return documents(spark, rows).repartition(parts)


# --- packing ---


def expected_ids(text):
    return np.array([*Tokenizer.from_file(WORD).encode(text or "", add_special_tokens=False).ids, harmonic.END], "<u4")


def check_packing(rows, texts, capacity=harmonic.CAPACITY):
    """Every id in one piece, sequences without gaps; returns the lengths of the sequences."""
    ids = {i: expected_ids(t) for i, t in texts.items()}
    at, filled = Counter(), Counter()
    for r in sorted(rows, key=lambda r: (r.document, r.start)):
        own = ids[r.document]
        assert r.start == at[r.document] and r.doc_tokens == len(own) and r.length > 0
        assert bytes(r.ids) == own[r.start : r.start + r.length].tobytes()
        at[r.document] += r.length
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled[r.sequence_id]
        filled[r.sequence_id] += r.length
    assert at == {i: len(x) for i, x in ids.items()} and max(filled.values()) <= capacity
    return list(filled.values())


def padding(lengths, capacity=harmonic.CAPACITY):
    return sum(0 if n & (n - 1) == 0 else capacity - n for n in lengths)


@pytest.mark.parametrize("capacity", [64, harmonic.CAPACITY])
def test_odd_texts_are_packed_whole(spark, capacity):
    texts = dict(enumerate([None, "", *odd_texts(60)]))
    found = harmonic.pack_tokens(table_of(spark, texts.items()), WORD, capacity=capacity).collect()
    check_packing(found, texts, capacity)


def test_repeated_rows_and_null_ids_are_documents(spark):
    rows = [r for r in hard_rows()]
    found = harmonic.pack_tokens(table_of(spark, rows, 2), WORD).collect()
    assert Counter(r.document for r in found if r.start == 0) == Counter(i for i, _ in rows)
    assert sum(r.length for r in found) == sum(len(expected_ids(t)) for _, t in rows)
    assert harmonic.pack_tokens(documents(spark, []), WORD).count() == 0


def test_packing_query_wastes_little(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    lengths = check_packing(harmonic.pack_tokens(spark.read.parquet(f"{SF}/documents.parquet"), WORD).collect(), docs)
    assert padding(lengths) < 0.002 * sum(lengths)
    got = {(r.doc_id, r.start): r for r in QUERIES["op11_harmonic_packing"](spark, SF).collect()}
    some = got[5, 0]
    assert some.ids_crc32 == zlib.crc32(expected_ids(docs[5])[: some.length].tobytes())


def test_classes_are_filled_by_count():
    first = harmonic.split_table()
    draw, sequences = random.Random(3), harmonic.Sequences(harmonic.CAPACITY)
    for document in range(20000):
        n = draw.choice([1, 2, 63, 64, 100, 1365, 1366, 2049, 4095, 4096, 9000, draw.randint(1, 6000)])
        pieces = harmonic.cut(n, harmonic.CAPACITY, first)
        assert [s for s, _ in pieces] == [sum(k for _, k in pieces[:i]) for i in range(len(pieces))] and sum(k for _, k in pieces) == n
        assert all(k >= min(n, harmonic.LEAST) or s % harmonic.CAPACITY == 0 for s, k in pieces)
        for start, length in pieces:
            sequences.add(document, start, b"\0" * 4 * length, n)
    whole = Counter(r[4] for r in sequences.rows)
    kinds = {r[4]: harmonic.CAPACITY // (len(r[2]) // 4) for r in sequences.rows}
    assert all(whole[s] == kind for s, kind in kinds.items())  # as many pieces as the class says
    sequences.end()
    filled = Counter()
    for r in sequences.rows:
        assert r[5] == filled[r[4]]
        filled[r[4]] += len(r[2]) // 4
    assert padding(filled.values()) < 0.002 * sum(filled.values())


# --- hard negatives ---


def brute_negatives(rows, k=5, m=3):
    kept = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        new = (label, [int(np.floor(256 * float(x))) for x in v])
        kept[i] = min(kept.get(i, new), new)
    out = []
    for a, (label, v) in kept.items():
        if a % 50:
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in kept.items() if i != a and len(w) == len(v)}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if kept[i][0] == label][:k]:
            fits = [i for i in order if kept[i][0] != label and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out += [(a, p, rank, i, score[p], score[i]) for rank, i in enumerate(fits[:m], 1)]
    return sorted(out)


def mined(spark, rows, parts=3):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<float>, score string, slice int").repartition(parts)
    return sorted(tuple(r) for r in fagin.hard_negatives(table, F.col("vec_id") % 50 == 0).collect())


def vectors(seed, n, d, ties):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(4, d)) * 0.4
    rows = []
    for i in range(n):
        label = int(draw.integers(0, 4))
        v = centres[label if draw.random() < 0.6 else int(draw.integers(0, 4))] + draw.normal(size=d) * 0.2
        rows.append((i, label, (np.round(v * 4) / 4 if ties else v).astype(np.float32).tolist()))
    return rows


@pytest.mark.parametrize("ties", [False, True])
def test_negatives_equal_brute_force(spark, ties, monkeypatch):
    monkeypatch.setattr(fagin, "SLICE", 150)
    rows = vectors(2, 800, 12, ties)
    assert mined(spark, rows) == brute_negatives(rows)


def test_negatives_of_odd_rows(spark):
    rows = vectors(4, 260, 6, True)
    rows += [(i, i % 3, [0.0] * 6) for i in range(300, 306)] + [(350, 1, [0.0] * 6), (400, 0, [-x for x in rows[0][2]]), (450, 2, [])]
    rows += [(None, 1, rows[1][2]), (500, None, rows[1][2]), (550, 1, None), (600, 1, [None] * 6), (650, 1, [float("nan")] * 6), (700, 1, [float("inf"), *[0.0] * 5])]
    rows += [rows[3], rows[3], (50, 0, rows[7][2]), (750, 1, [0.5, 0.25]), (751, 1, [0.5, 0.5]), (752, 2, [0.25, 0.25]), (753, 2, [])]
    assert mined(spark, rows) == brute_negatives(rows)
    assert mined(spark, []) == []


def test_hot_vector_ties_go_to_smaller_ids(spark):
    one = [0.5, -0.25, 0.125]
    rows = [(i, i % 2, one) for i in range(400)] + [(400 + i, i % 3, [0.45, -0.2, 0.1 + i / 1000]) for i in range(60)]
    assert mined(spark, rows) == brute_negatives(rows)


def test_threshold_stops_early_and_strictly():
    draw = np.random.default_rng(1)
    rows = draw.integers(-20, 20, size=(5000, 3))
    rows[17] = [60, 60, 60]
    lists = fagin.Lists(np.arange(5000), np.zeros(5000, np.int64), rows)
    met = []
    for at, scores, threshold in lists.met(np.array([3, 2, 1])):
        met += at.tolist()
        assert (scores == rows[at] @ [3, 2, 1]).all()
        others = np.setdiff1d(np.arange(5000), met)
        if threshold is not None:
            assert (rows[others] @ [3, 2, 1] <= threshold).all()
        if 17 in met and threshold is not None and threshold < 360:
            break
    assert len(met) < 1000
    best = fagin.best_positives(lists, -1, 0, np.array([3, 2, 1]), 1)
    assert best.at.tolist() == [17]


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="CAST_OVERFLOW|too large"):
        mined(spark, [(0, 1, [1e30]), (1, 1, [1e30])])


# --- alignment ---


class Pair:
    """Both tokenizers, token by token."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        self.pieces = align.byte_level_pieces(A)

    def groups(self, text):
        if not text:
            return []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        raw_a = [self.pieces[i] for i in a]
        raw_b = [bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(raw_a) == (" " + text).encode() == b"".join(raw_b):
            return []
        ends_a, ends_b = (np.cumsum([len(x) for x in raw]).tolist() for raw in (raw_a, raw_b))
        out, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            i2, j2 = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            out.append((a[i:i2], b[j:j2]))
            i, j = i2, j2
        return out


def brute_links(rows):
    pair = Pair()
    found = [(i, pair.groups(t)) for i, t in rows]
    linked = [[(x, y) for a, b in groups for x in a for y in b] for _, groups in found]
    count = Counter(p for each in linked for p in set(each))
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    return [
        (i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(each), sum(count[p] == best[p[0]] for p in each),
         sum(count[p] for p in each), ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups))
        for (i, groups), each in zip(found, linked)
    ]


COLUMNS = ["document", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def test_links_equal_brute_force(spark):
    rows = [*enumerate([None, "", *odd_texts()]), *hard_rows(), (None, "null id"), (7, "a\nb")]
    found = align.links(table_of(spark, rows), A, B).select(COLUMNS).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute_links(rows)))


def test_large_groups_are_counted_by_distinct_ids(monkeypatch):
    draw = np.random.default_rng(2)
    bounds_a, bounds_b = (np.append(0, np.cumsum(draw.integers(1, 9, 50))) for _ in range(2))
    groups = np.stack([bounds_a[:-1], bounds_a[1:], bounds_b[:-1], bounds_b[1:]], axis=1)
    a, b = draw.integers(0, 5, bounds_a[-1]), draw.integers(0, 6, bounds_b[-1])
    owner = np.arange(50) // 7
    direct = align.linked(groups, a, b, owner, 10)
    monkeypatch.setattr(align, "PRODUCT", 3)
    assert all((x == y).all() for x, y in zip(direct, align.linked(groups, a, b, owner, 10)))


def test_alignment_query_and_groups(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = {r[0]: (*r[1:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in brute_links(docs)}
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op13_cross_tokenizer_alignment"](spark, SF).collect()}
    assert got == want
    own = {r.document: r.groups for r in align.align(spark.read.parquet(f"{SF}/documents.parquet").limit(20), A, B).collect()}
    assert all(hashlib.sha256(g.encode()).hexdigest() == want[i][-1] for i, g in own.items())
    assert align.links(documents(spark, []), A, B).count() == 0


def test_lanes_begin_at_cuts_and_bound_the_steps():
    draw = np.random.default_rng(9)
    lengths = [draw.integers(1, 4, 4000), draw.integers(1, 5, 4000)]
    total = min(x.sum() for x in lengths)
    ends = [np.unique(np.append(np.cumsum(x)[np.cumsum(x) < total], total)) for x in lengths]
    want = np.intersect1d(*ends)
    starts = np.array([0, len(ends[0])])
    from_a, from_b = align.lanes(*ends, starts, 50)
    assert len(from_a) > 20 and np.diff(from_a).max() < 150
    groups = align.lockstep(*ends, from_a, from_b)
    assert (ends[0][groups[:, 1] - 1] == want).all() and (ends[1][groups[:, 3] - 1] == want).all()
    assert (groups[1:, 0] == groups[:-1, 1]).all() and (groups[1:, 2] == groups[:-1, 3]).all()


def test_ranks_merge_as_the_file_does():
    pieces = align.byte_level_pieces(A)
    fast, library = align.byte_level_encoder(A, pieces), tokens.library_tokenizer(A, special=False)
    texts = [" " + t for t in odd_texts(400, 11) if len(t) < 20000]
    for piece in pieces[:50256]:
        try:
            texts.append(piece.decode())
        except UnicodeDecodeError:
            continue
    assert [fast(t) for t in texts] == [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]


def test_tables_of_pieces_cover_the_vocabularies():
    vocabulary = json.load(open(A, encoding="utf-8"))["model"]["vocab"]
    pieces = align.byte_level_pieces(A)
    assert len(pieces) == len(vocabulary) + 1 or len(pieces) == len(vocabulary)
    assert sorted(p for p in pieces if len(p) == 1) == [bytes([b]) for b in range(256)]
    own = align.sentence_pieces(sentencepiece.SentencePieceProcessor(model_file=B))
    assert {bytes([b]) for b in range(256)} <= set(own)


def test_words_are_encoded_once_while_they_are_met():
    calls = []
    words = tokens.Words(lambda new: [calls.append(w) or w.upper() for w in new], known=4)
    assert words(["a", "b"]) == ["A", "B"] and words(["d", "a", "c"]) == ["D", "A", "C"]  # full: these four are the old ones
    calls.clear()
    assert words(["a", "e", "f"]) == ["A", "E", "F"] and calls == ["e", "f"]
    assert words(["a", "x" * 100, "b"]) == ["A", "X" * 100, "B"] and "b" in calls
    assert "x" * 100 not in words.known and len(words.known) + len(words.old) <= 8
