"""Decontamination, near-duplicates, repeated strings, personal data and packing against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from parcelmill.llm import components, decontam, minhash, packing, pii, suffix_dedup
from tables import documents, hard_rows, prose

UP = {i: i + 32 for i in range(65, 91)}


def windows(words, n):
    k = min(n, len(words))
    return [tuple(words[i : i + k]) for i in range(len(words) - k + 1)] if k else []


# --- benchmark decontamination ---

ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(rows, items):
    table = defaultdict(set)
    for item, text in items:
        if item is not None and text is not None:
            for w in windows(ITEM.findall(text.translate(UP)), 10):
                table[w].add(item)
    out = []
    for doc, text in rows:
        words = ITEM.findall((text or "").translate(UP))
        hit, found = set(), set()
        for k in {len(w) for w in table}:
            for i in range(len(words) - k + 1):
                if of := table.get(tuple(words[i : i + k])):
                    hit.update(range(i, i + k))
                    found |= of
        out.append((doc, len(words), len(hit), tuple(sorted(found))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("slice_mb", [16, 0.002])
def test_hits_equal_brute_force(spark, slice_mb):
    text = prose(1, 60)
    items = [(1, " ".join(text.split()[5:30])), (2, "word"), (2, "word"), (3, None), (None, text), (4, ""), (5, "Two, WORDS!"), (6, " ".join(text.split()[5:30]))]
    rows = hard_rows() + [(20, f"{prose(9, 20)} {items[0][1].upper()} {prose(8, 20)} word")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.hits(documents(spark, rows), benchmark, slice_mb=slice_mb).withColumn("n_hit", decontam.n_hit())
    got = [(r[0], r[1], r[2], tuple(sorted(r[3]))) for r in found.select("row.doc_id", "n_words", "n_hit", "items").collect()]
    assert sorted(got, key=repr) == brute_hits(rows, items)


def test_decontaminate_cuts_passages_and_drops_copies_of_items(spark):
    passage = prose(5, 12)
    rows = [(1, f"before it. {prose(6, 30)}\n{passage} after it"), (2, passage), (3, prose(7, 30)), (4, None), (5, "")]
    benchmark = spark.createDataFrame([(1, passage)], "item_id long, text string")
    docs = documents(spark, rows)
    clean = decontam.decontaminate(docs, benchmark)
    assert clean.columns == docs.columns
    assert {r.doc_id: r.text for r in clean.collect()} == {1: f"before it. {prose(6, 30)} after it", 3: rows[2][1], 4: None, 5: ""}


def test_decontaminate_with_empty_tables(spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    docs = documents(spark, hard_rows())
    assert decontam.decontaminate(docs, benchmark).count() == docs.count()
    assert decontam.decontaminate(docs.limit(0), benchmark).count() == 0


# --- near-duplicates ---

SHINGLE = re.compile(r"[^\x20\x09-\x0D]+")


def brute_components(rows, k):
    sets = [(i, frozenset(windows(SHINGLE.findall((t or "").translate(UP)), k))) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if i is not None and j is not None and x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    return sorted([(i, len(s), root(i) if i is not None else None) for i, s in sets], key=repr)


def near_rows():
    """Chains of edits, copies and texts that share half of their words."""
    draw, rows = random.Random(4), hard_rows()
    for family in range(6):
        words = prose(100 + family, 80).split()
        for step in range(12):
            rows.append((1000 * family + step + 100, " ".join(words)))
            words[draw.randrange(len(words))] = f"edit{family}{step}"
    shared = prose(55, 50)
    return rows + [(9000 + i, f"{shared} {prose(300 + i, 50)}") for i in range(30)]


@pytest.mark.parametrize("block", [1024, 4])
def test_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = near_rows()
    found = minhash.near_duplicates(documents(spark, rows), k=4)
    assert sorted([tuple(r) for r in found.select("id", "n_shingles", "component").collect()], key=repr) == brute_components(rows, 4)


def test_deduplicate_keeps_one_of_each_group(spark):
    rows = hard_rows()
    docs = documents(spark, rows)
    kept = minhash.deduplicate(docs)
    assert kept.columns == docs.columns
    want = {i for i, _, c in brute_components(rows, 5) if i is not None and i == c}
    got = [r.doc_id for r in kept.collect()]
    assert Counter(got) == Counter({i: 1 for i in want} | {None: 2})
    assert minhash.deduplicate(docs.limit(0)).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    draw = random.Random(2)
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(300, 300), (None, 5), (7, 8), (8, 7)]
    edges += [(draw.randrange(1000, 1100), draw.randrange(1000, 1100)) for _ in range(60)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            p, q = root(a), root(b)
            parent[max(p, q)] = min(p, q)
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == {x: root(x) for x in list(parent)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- repeated strings ---


def brute_repeats(rows):
    """Per row the kept bytes and the spans; equal starts of one document are not earlier than each other."""
    first = {}
    for i, text in rows:
        raw = (text or "").encode()
        if i is not None:
            for j in range(len(raw) - 99):
                w = raw[j : j + 100]
                first[w] = min(first.get(w, (i, j)), (i, j))
    out = []
    for i, text in rows:
        raw = (text or "").encode()
        cover = bytearray(len(raw))
        if i is not None:
            for j in range(len(raw) - 99):
                if first[raw[j : j + 100]] < (i, j):
                    cover[j : j + 100] = b"\1" * 100
        kept = bytes(b for b, c in zip(raw, cover) if not c)
        out.append((i, len(raw), [m.span() for m in re.finditer(b"\1+", bytes(cover))], hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def repeat_rows():
    passage = prose(70, 40)
    rows = [(i, t if t is None or len(t) < 20000 else t[:20000]) for i, t in hard_rows()]
    rows += [(200 + i, f"{prose(400 + i, 30)} {passage[: 90 + i]} {prose(500 + i, 9)}") for i in range(40)]
    return rows + [(300, "ab" * 300), (301, "x" * 5000), (302, passage * 3), (303, "é" * 200), (304, "a" + "é" * 99)]


@pytest.mark.parametrize("part, piece", [(2048, 1 << 21), (2, 700)])
def test_repeats_equal_brute_force(spark, monkeypatch, part, piece):
    monkeypatch.setattr(suffix_dedup, "PART", part)
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    rows = repeat_rows()
    found = suffix_dedup.remove_repeats(documents(spark, rows)).select("id", "n_bytes", "spans", "kept_sha256").collect()
    assert sorted([(r[0], r[1], [(s["start"], s["end"]) for s in r[2]], r[3]) for r in found], key=repr) == brute_repeats(rows)


def test_runs_of_one_document_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART", 50)
    size = 60000
    wanted = [{"start": i, "size": size} for i in range(size)]
    schema = "id long, tk long, text string, wanted array<struct<start:int,size:int>>"
    padding = suffix_dedup._shared_runs(spark.createDataFrame([(1, 2, "x" * size, wanted)], schema)).collect()
    assert sum(r.string is not None for r in padding) == 1 and len(padding) == 2
    runs = suffix_dedup._shared_runs(spark.createDataFrame([(1, 2, prose(7, 12000)[:size], wanted)], schema)).filter("string is not null")
    assert runs.select("part").distinct().count() > 300


def test_texts_move_once(spark, monkeypatch, capsys):
    """Texts are most of what the job could keep on disk: one exchange may carry them, all later steps take them from there."""
    plans = []

    def seen(keep):
        def write(df, *args):
            df.explain("formatted")
            plans.append(capsys.readouterr().out)
            return keep(df, *args)

        return write

    for name in ("stored", "bucketed"):
        if hasattr(suffix_dedup, name):
            monkeypatch.setattr(suffix_dedup, name, seen(getattr(suffix_dedup, name)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        suffix_dedup.remove_repeats(documents(spark, repeat_rows())).explain("formatted")
        plans.append(capsys.readouterr().out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moves = [len(re.findall(r"\) Exchange\nInput \[\d+\]: \[.*\btext#", plan)) for plan in plans]
    assert sum("SortMergeJoin" in plan for plan in plans) > 2 and sum(moves) == 1
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("parcelmill_")]


def test_packed_texts_come_back_slice_by_slice(spark, monkeypatch):
    texts = ["", "é" * 150, prose(1, 40), "x" * 5000, "", "a\0b", prose(2, 30)]
    schema = "id long, tk long, text string"
    packed = suffix_dedup._packed(spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], schema).coalesce(1)).toArrow()
    column = packed.sort_by("id").column("text").combine_chunks()
    monkeypatch.setattr(suffix_dedup.bytetext, "SLICE_BYTES", 400)
    for first in (0, 2):
        slices = list(suffix_dedup._slices(column[first:]))
        assert len(slices) > 2 and [row for row, _, _ in slices] == [0, *accumulate(len(at) - 1 for _, at, _ in slices)][:-1]
        assert [data[a:b].tobytes().decode() for _, at, data in slices for a, b in zip(at[:-1], at[1:])] == texts[first:]
    assert list(suffix_dedup._slices(column[:0])) == []


def test_repeats_of_an_empty_table(spark):
    assert suffix_dedup.remove_repeats(documents(spark, []), "doc_id").count() == 0


# --- personal data ---

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_pii(text):
    def valid(number):
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(number))]
        return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and valid(digits(m))]
    return sorted(out + [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15])


def test_base_spans_equal_the_plain_patterns():
    draw = random.Random(3)
    parts = ["a@b.c", "@", "1", "2", "0", "55", ".", "-", " ", "+", "(", "x", "é", "4111111111111111", "192.168", "\n", "😀"]
    for _ in range(20000):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(25)))
        assert [s for s in sorted(pii.proposals(text)) if s[1] < 4] == brute_pii(text)


def test_checksums_and_context():
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE88370400440532013000")
    kinds = lambda text: [s["kind"] for s in pii.spans(text)]
    assert kinds("account DE89 3704 0044 0532 0130 00") == ["iban"]
    assert kinds("account DE88 3704 0044 0532 0130 00") == []
    assert kinds("SSN 123-45-6789") == ["ssn"] and kinds("part 123-45-6789") == []
    assert pii.spans("card 4111111111111111")[0]["score"] > pii.spans("4111111111111111")[0]["score"]


def test_ibans_end_before_following_tokens():
    found = lambda text: [text[s["start"] : s["end"]] for s in pii.spans(text) if s["kind"] == "iban"]
    for code in ("DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947", "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "ZZ22 3704 0044 0532 0130 00"):
        for rest in ("", " BIC COBADEFFXXX", " EUR 500", " 500", " 1 234 567 890 123 456 789", " A", " and more", ", EUR", " " + "X" * 60):
            assert found(f"IBAN {code}{rest}") == [code], (code, rest)
    assert found("IBAN DE89370400440532013000 GB82WEST12345698765432 EUR 5") == ["DE89370400440532013000", "GB82WEST12345698765432"]
    assert found("IBAN DE88 3704 0044 0532 0130 00 EUR 5") == [] and found("IBAN DE89370400440532013000x") == []
    pii.spans("DE89 " * 60000)


@pytest.mark.parametrize("text", ["1" * 300000, "a." * 150000 + "@", "+1 " * 100000, "@a." * 100000, "1-" * 150000])
def test_long_runs_take_linear_time(text):
    pii.spans(text)


def test_redact_masks_and_keeps_rows(spark):
    rows = [(1, "write to a.b@c.org or +1 (555) 555-0100"), (2, None), (3, ""), (4, "é😀 10.0.0.1"), (4, "é😀 10.0.0.1")]
    docs = documents(spark, rows)
    clean = pii.redact(docs)
    assert clean.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in clean.collect()], key=repr) == sorted(
        [(1, "write to <EMAIL> or <PHONE>"), (2, None), (3, ""), (4, "é😀 <IP>"), (4, "é😀 <IP>")], key=repr
    )
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_cutting_and_masking_take_one_python_pass(spark):
    docs = documents(spark, [(1, f"{prose(5, 12)} {prose(6, 30)}"), (2, "a.b@c.org")])
    benchmark = spark.createDataFrame([(1, prose(5, 12))], "item_id long, text string")
    for clean in (decontam.decontaminate(docs, benchmark), pii.redact(docs)):
        plan = clean._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan


# --- packing ---


def brute_pack(items, capacity):
    bins, out = [], []
    for length, source, cluster in items:
        fit = [
            (room, i) for i, (room, s, c) in enumerate(bins)
            if room >= length and (not source or source not in s) and (not cluster or cluster not in c)
        ]
        i = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append((capacity, set(), set()))
        room, s, c = bins[i]
        bins[i] = (room - length, s | {source}, c | {cluster})
        out.append(i)
    return out


def test_best_fit_equals_brute_force():
    draw = random.Random(6)
    for _ in range(200):
        items = [(draw.randrange(1, 30), draw.randrange(4), draw.randrange(6)) for _ in range(draw.randrange(60))]
        assert packing.pack(items, 40) == brute_pack(items, 40)


def test_packing_covers_all_words_without_conflicts(spark):
    rows = hard_rows() + [(i, prose(i % 40, i % 90)) for i in range(100, 400)]
    packed = packing.pack_documents(documents(spark, rows), capacity=256, shard=100).collect()
    want = Counter((i, len(SHINGLE.findall(t or ""))) for i, t in rows)
    words, pieces = Counter(), defaultdict(list)
    for r in packed:
        pieces[r.doc_id].append((r.first_word, r.n_words))
        words[r.doc_id] += r.n_words
    assert words == sum((Counter({i: n * k}) for (i, n), k in want.items()), Counter()) + Counter()
    bins = defaultdict(list)
    for r in packed:
        assert (r.bin_id is None) == (r.n_words == 0)
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    for some in bins.values():
        assert sum(r.n_words for r in some) <= 256
        assert len({r.source for r in some}) == len({r.cluster for r in some}) == len(some)
    assert packing.pack_documents(documents(spark, [])).count() == 0
