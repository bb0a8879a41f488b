import random
import re

import pytest

import parcelmill as pm
from parcelmill.operators import pages as page_ops, segmentation
from parcelmill.operators.segmentation import continuation_pages

TRACKED = re.compile(r"\b1Z[0-9A-Z]{8,18}\b")
NOISE = re.compile(r"rechnung|invoice|ups|kunden-nr|lieferant|dachser|(seite|page)\s+\d", re.I)

PIECES = [
    "1ZAAAAAAAA0001 WW Express", "x 1Z12345678 y", "1ZSHORT", "x1Z123456789", "1Z12345678ä", "Transport 1,00 2,00",
    "Rechnung 1Z99999999 2025", "Seite 3", "  Page   12 ", "Startups", " kept ", "", "   ", "Maut\t", "page one",
]


def plain_blocks(pages):
    """Blocks of one invoice, by looking at every line with what is open before it."""
    done, start = [], None
    for number, text in sorted(pages):
        if TRACKED.search(text):
            start = None
        for line in filter(None, (line.strip() for line in text.split("\n"))):
            if NOISE.search(line):
                continue
            if TRACKED.search(line):
                start = (number, [])
                done.append(start)
            if start:
                start[1].append(line)
    ordinals, keyed = {}, []
    for number, lines in done:
        ordinals[number] = ordinals.get(number, 0) + 1
        keyed.append((number, ordinals[number], "\n".join(lines)))
    return keyed


def random_invoices(count, seed, longest=9):
    rng = random.Random(seed)
    invoices = {}
    for n in range(count):
        numbers = sorted(rng.sample(range(1, 40), rng.randint(1, longest)))
        invoices[f"I{n}"] = [(p, "\n".join(rng.choices(PIECES, k=rng.randint(0, 7)))) for p in numbers]
    return invoices


def as_table(spark, invoices):
    rows = [(name, number, text) for name, pages in invoices.items() for number, text in pages]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "invoice_id string, page_num int, text string").repartition(5)


@pytest.mark.parametrize("pages_per_chunk", [4096, 2])
def test_blocks_equal_a_plain_pass_over_the_lines(spark, monkeypatch, pages_per_chunk):
    monkeypatch.setattr(page_ops, "PAGES_PER_CHUNK", pages_per_chunk)
    invoices = random_invoices(250, pages_per_chunk)
    found = {}
    for row in pm.segment(as_table(spark, invoices)).collect():
        found.setdefault(row.invoice_id, []).append((row.invoice_page, row.page_block, row.text))
    for name, pages in invoices.items():
        assert sorted(found.get(name, [])) == plain_blocks(pages), name


def test_one_invoice_with_most_pages_spreads_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(page_ops, "PAGES_PER_CHUNK", 8)
    pages = [(n, "1Z00000000A start" if n in (1, 500, 501) else f"line {n}") for n in range(1, 1001)]
    table = as_table(spark, {"HOT": pages, "other": [(1, "line"), (2, "1Z00000000B")]})
    homes = {row.page_num: row.home_page for row in continuation_pages(table).filter("invoice_id = 'HOT'").collect()}
    assert homes == {n: 1 if n < 500 else 501 for n in range(2, 1001) if n not in (500, 501)}
    blocks = pm.segment(table).filter("invoice_id = 'HOT'").orderBy("invoice_page").collect()
    assert [(b.invoice_page, len(b.text.split("\n"))) for b in blocks] == [(1, 499), (500, 1), (501, 500)]


def test_lines_before_the_first_start_of_a_page_are_lost(spark):
    pages = [(1, "1Z00000001A"), (2, "Gesamtkosten CHF 3,00\n1Z00000002A"), (3, "Rechnung 1Z00000003A\nlost"), (4, "lost")]
    blocks = pm.segment(as_table(spark, {"I": pages})).orderBy("invoice_page").collect()
    assert [(b.invoice_page, b.text) for b in blocks] == [(1, "1Z00000001A"), (2, "1Z00000002A")]


def test_page_lines_number_and_flag(spark):
    rows = pm.page_lines(as_table(spark, {"I": [(1, " a \n\n UPS 1Z12345678 \n1Z12345678")]})).collect()
    assert sorted(tuple(r)[2:] for r in rows) == [
        (1, "a", False, False), (2, "UPS 1Z12345678", True, False), (3, "1Z12345678", False, True),
    ]


def test_year_comes_from_the_lowest_page_with_one(spark, monkeypatch):
    monkeypatch.setattr(page_ops, "PAGES_PER_CHUNK", 2)
    table = as_table(spark, {"I": [(9, "2021"), (3, "x2020 20201 2024."), (1, "none"), (4, "2022")], "J": [(1, "1999")]})
    assert {r.invoice_id: r.invoice_year for r in pm.invoice_year(table).collect()} == {"I": 2024, "J": None}
    keyed = {(r.invoice_id, r.page_chunk): r.invoice_year for r in page_ops.chunk_year(table).collect()}
    assert keyed == {("I", 0): 2024, ("I", 1): 2024, ("I", 2): 2024, ("I", 4): 2024, ("J", 0): None}


def test_texts_after_a_page_without_a_start_are_not_moved(spark):
    rows = [("A", 1, "Rechnung zu 1Z12345678"), *[("A", i, f"appendix {i}") for i in range(2, 9)], ("A", 9, "1Z87654321"), ("A", 10, "more")]
    pages = spark.createDataFrame(rows, "invoice_id string, page_num int, text string")
    assert [(r.invoice_page, r.text) for r in pm.segment(pages).collect()] == [(9, "1Z87654321\nmore")]
    moved = segmentation._tails(pages).collect()
    assert [(r.page_num, r.tail) for r in moved] == [(9, "more")]


def test_pages_without_an_invoice_are_one_invoice(spark):
    rows = [(None, 0, "1Z12345678 2024"), (None, 1, "goes on"), (None, 2, "1Z87654321")]
    pages = pm.sources.pages.as_pages(spark.createDataFrame(rows, "invoice_id string, page_num int, text string"))
    assert sorted((r.invoice_page, r.text) for r in pm.segment(pages).collect()) == [(0, "1Z12345678 2024\ngoes on"), (2, "1Z87654321")]
    assert [tuple(r) for r in pm.invoice_year(pages).collect()] == [("", 2024)]
    assert pm.invoice_json_lines(pm.extract_shipments(pages)).count() == 2


def test_pages_without_a_number_are_an_error(spark):
    rows = [("I", 1, "1Z12345678"), ("I", None, "1Z87654321"), ("I", None, "1Z87654320")]
    pages = pm.sources.pages.as_pages(spark.createDataFrame(rows, "invoice_id string, page_num int, text string"))
    with pytest.raises(Exception, match="a page without a number, of invoice I"):
        pm.segment(pages).collect()
    assert pages.select("text").count() == 3


def test_line_breaks_blanks_and_folded_case_of_whole_pages(spark):
    # The fold of a page is cut into the same lines as the page, whatever letters get longer or shorter by it.
    text = " İSTANBUL\r\nReChnung ſ\rInvoiCe \n \n 1Z0000000000000001 ΑΣ\nKUNDEN-NR\nSEITE  7\nSEITE x\r\n\tLUPſ\n"
    pages = pm.sources.pages.as_pages(spark.createDataFrame([("A", 1, text)], "invoice_id string, page_num int, text string"))
    assert [r.text for r in pm.segment(pages).collect()] == ["1Z0000000000000001 ΑΣ\nSEITE x"]
