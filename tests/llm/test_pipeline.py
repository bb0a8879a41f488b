"""The registered queries against their oracles, and the pipeline stage by stage against brute force."""

import hashlib
import re
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from oracle_check import compare
from parcelmill.llm.oracle import ORACLE
from parcelmill.llm.queries import QUERIES
from parcelmill.llm import minhash, pii
from parcelmill.llm.scratch import stored
from tables import documents, hard_rows, prose
from test_text_operators import SHINGLE, UP, ITEM, brute_components, brute_hits, brute_pii

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, name):
    assert compare(spark, SF, name, entry.queries()[name], ORACLE[name]) is None


def test_every_operator_has_a_query():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_covers_its_table(spark, name):
    rows = QUERIES[name](spark, SF)
    key = next(c for c in ("doc_id", "page_id", "query_id") if c in rows.columns)
    of = {"doc_id": "documents", "page_id": "pages", "query_id": "embeddings"}[key]
    want = spark.read.parquet(f"{SF}/{of}.parquet").filter("vec_id % 50 = 0" if of == "embeddings" else "true").count()
    assert len({r[key] for r in rows.collect()}) == want


def test_personal_data_of_the_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    for r in QUERIES["op4_pii"](spark, SF).collect():
        want = brute_pii(texts[r.doc_id])
        listed = ",".join(f"{pii.KINDS[kind]}:{start}:{end}" for start, kind, end in want)
        assert [r[f"n_{kind}"] for kind in pii.BASE] == [sum(x[1] == i for x in want) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and set(listed.split(",")) - {""} <= set(r.spans.split(","))


def _texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_equal_brute_force(spark):
    """On the documents of the smallest tables and on hard rows: each stage is held against its own input."""
    source = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    added = [(10000 + (i or 0), t) if i is not None else (None, t) for i, t in hard_rows() if t is None or len(t) < 20000]
    added += [(20000, f"{prose(71, 40)} {items[0][1]} {prose(72, 40)}"), (20001, items[1][1]), (20002, f"{prose(73, 30)} a.b@c.org")]
    docs = stored(source.unionByName(documents(spark, added, clash=False).select(*source.columns)), "documents")

    kept = stored(corpus_pipeline.language_id(spark, docs, SF), "language_id")
    before, after = Counter(_texts(docs)), Counter(_texts(kept))
    assert not after - before
    assert all(i is None or i >= 10000 for i, _ in before - after)  # the documents of the table stay
    assert all(t and t.strip() for _, t in after)

    rows = _texts(kept)
    unique = stored(corpus_pipeline.near_dedup(spark, kept, SF), "near_dedup")
    want = {i for i, _, c in brute_components(rows, 5) if i is not None and i == c}
    assert Counter(i for i, _ in _texts(unique) if i is not None) == Counter({i: 1 for i in want})

    rows = _texts(unique)
    clean = stored(corpus_pipeline.decontamination(spark, unique, SF), "decontamination")
    hit = {(i, n): h for i, n, h, _ in brute_hits(rows, items)}
    words = lambda t: len(ITEM.findall((t or "").translate(UP)))
    share = {i: (hit[i, words(t)], words(t)) for i, t in rows}
    got = dict(_texts(clean))
    assert set(got) == {i for i, (h, n) in share.items() if h <= 0.5 * n}
    assert all(words(got[i]) == share[i][1] - share[i][0] for i in got)
    assert all(got[i] == t for i, t in rows if i in got and not share[i][0])
    assert 20001 not in got and 20000 in got

    masked = stored(corpus_pipeline.mask_pii(spark, clean, SF), "pii")
    for r in masked.collect():
        assert not pii.spans(r.text or "") and (r.n_chars == len(r.text) if r.text is not None else r.n_chars is None)
        assert r.text == got[r.doc_id] if not pii.spans(got[r.doc_id] or "") else "<" in r.text

    packed = corpus_pipeline.pack(spark, masked, SF).collect()
    placed = Counter()
    for r in packed:
        placed[r.doc_id] += r.n_words
    assert placed == Counter({i: len(SHINGLE.findall(t or "")) for i, t in _texts(masked)})
    for name, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs.limit(0), SF).columns == docs.columns, name


def test_empty_tables_go_through(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "stage")
    assert docs.count() == 0


def test_of_rows_with_one_id_the_smallest_text_stays(spark):
    rows = [(1, "b b b", "x"), (1, "a a a", "y"), (1, "a a a", "z"), (2, None, "x"), (2, "c", "x"), (None, "n", "x"), (None, "n", "x")]
    for parts in (1, 4):
        table = spark.createDataFrame(rows, "doc_id long, text string, id string").repartition(parts)
        got = sorted((tuple(r) for r in minhash.deduplicate(table).collect()), key=repr)
        assert [(r[0], r[1]) for r in got] == [(1, "a a a"), (2, None), (None, "n"), (None, "n")]
        assert got == (first := got if parts == 1 else first)
