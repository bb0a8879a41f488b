import datetime
import glob
import json
import os
import random

import pyarrow as pa
import pytest
from dateutil import parser
from pyspark.sql import Row

import parcelmill as pm
from parcelmill.functions.registry import ISO_CODES, Country, iso_countries, read_registry, runtime_countries
from parcelmill.plans.shipments import RECORD
from parcelmill.sources import invoice_json
from test_similarity import partial_ratio, ratio

PAGES = [
    ("A.pdf", 1, "Rechnung 2025\n27.Nov 1Z8028100495457854 WW Express Saver 1 2,0\nEmpfänger: 33900 HONG KONG\n"
                 "Dritte Partei Transport 244,25 122,15 122,10\nGesamtkosten CHF 122,10"),
    ("A.pdf", 2, "1Z0000000001A\n1Z0000000002B"),
    ("B", 1, None),
    ("C", 1, "x\r\n1Z0000000003C\ry"),
]


@pytest.fixture
def page_rows(spark):
    return spark.createDataFrame(PAGES, "invoice_id string, page_num int, text string")


@pytest.mark.parametrize("format", ["parquet", "orc", "json", "csv"])
def test_read_pages_from_tables(spark, page_rows, tmp_path, format):
    writer = page_rows.coalesce(1).write.option("header", True).option("escape", '"')
    writer.format(format).save(str(tmp_path / "pages"))
    rows = pm.read_pages(spark, str(tmp_path / "pages"), format).orderBy("invoice_id", "page_num").collect()
    assert [(r.invoice_id, r.page_num) for r in rows] == [p[:2] for p in PAGES]
    assert rows[2].text == "" and rows[3].text.replace("\r", "\n") == "x\n1Z0000000003C\ny"


def test_read_pages_from_text_files(spark, tmp_path):
    (tmp_path / "Invoice 7+8.pdf.txt").write_text("one\r\ntwo\fthree", encoding="utf-8")
    rows = pm.read_pages(spark, str(tmp_path), "text").orderBy("page_num").collect()
    assert [tuple(r) for r in rows] == [("Invoice 7+8", 1, "one\ntwo"), ("Invoice 7+8", 2, "three")]


@pytest.mark.parametrize("part_bytes", ["4k", "128m"])
def test_a_long_text_file_is_read_in_parts(spark, tmp_path, part_bytes):
    draw = random.Random(3)
    texts = {f"I {i}.txt": [f"page {n} é " + "x" * draw.choice([0, 10, 300, 9000]) + "\nend" for n in range(draw.randint(1, 60))] for i in range(7)}
    texts["empty pages.txt"] = ["a", "", "", "b"]
    for name, pages in texts.items():
        (tmp_path / name).write_text("\f".join(pages), encoding="utf-8")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", part_bytes)
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        if part_bytes == "4k":
            assert spark.read.text(str(tmp_path), lineSep="\f").rdd.getNumPartitions() > 50
        rows = pm.read_pages(spark, str(tmp_path), "text").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = sorted((name[:-4], n, text) for name, pages in texts.items() for n, text in enumerate(pages, 1))
    assert sorted(tuple(r) for r in rows) == want


def test_extract_shipments(spark, page_rows):
    rows = pm.extract_shipments(pm.sources.pages.as_pages(page_rows)).orderBy("invoice_id", "invoice_page", "page_block").collect()
    first = rows[0].asDict(recursive=True)
    assert list(first)[2:] == RECORD
    assert first == {
        "invoice_id": "A.pdf", "page_block": 1, "identifier": "1Z8028100495457854", "invoice_page": 1,
        "shipment_date": datetime.date(2025, 11, 27), "shipment_type": "Express", "currency_shipment": "CHF",
        "origin_country": None, "origin_city": None, "origin_zipcode": None, "destination_country": "HK",
        "destination_city": "HONG KONG", "destination_zipcode": "33900", "gross_weight": 2.0, "chargeable_weight": None,
        "loading_meter": None, "cubic_meter": None, "pallet_amount": 1,
        "cost_items": [{
            "extracted_category": "Freight", "total_cost_in_shipment_currency": 122.1, "currency": "CHF",
            "mention": "Dritte Partei Transport 244,25 122,15 122,10",
        }],
    }
    assert [(r.invoice_id, r.invoice_page, r.page_block) for r in rows] == [
        ("A.pdf", 1, 1), ("A.pdf", 2, 1), ("A.pdf", 2, 2), ("C", 1, 1),
    ]


def test_invoice_json_files_hold_one_array_per_invoice(spark, page_rows, tmp_path):
    pm.write_invoice_json(pm.extract_shipments(pm.sources.pages.as_pages(page_rows)), str(tmp_path / "out"))
    folders = {p.name: p for p in (tmp_path / "out").iterdir() if p.is_dir()}
    assert set(folders) == {"document=A_extracted.json", "document=C_extracted.json"}
    records = read_array(folders["document=A_extracted.json"])
    assert [r["identifier"] for r in records] == ["1Z8028100495457854", "1Z0000000001A", "1Z0000000002B"]
    assert list(records[0]) == RECORD and records[0]["origin_city"] is None
    assert records[0]["shipment_date"] == "2025-11-27" and records[1]["cost_items"] == []


def read_array(folder):
    return json.loads("".join(p.read_text(encoding="utf-8") for p in sorted(folder.glob("part-*"))))


def test_a_long_invoice_is_split_into_ordered_files(spark, tmp_path):
    pages = spark.range(3000).selectExpr("'HOT' as invoice_id", "cast(id + 1 as int) as page_num", "concat('1Z', lpad(id, 10, '0')) as text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pm.write_invoice_json(pm.extract_shipments(pages), str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    folder = tmp_path / "out" / "document=HOT_extracted.json"
    assert len(list(folder.glob("part-*"))) > 1
    assert [r["invoice_page"] for r in read_array(folder)] == list(range(1, 3001))


def test_normalize_values(spark):
    raw = spark.createDataFrame(
        [Row(n=1, shipment_date="27.11.2025", origin_country=" Germany ", origin_city=" ", gross_weight="1,5", pallet_amount="3.7", note=" x "),
         Row(n=2, shipment_date="27 Nov 2025", origin_country="Atlantis", origin_city="0", gross_weight="1.5d", pallet_amount=" 4 ", note="y"),
         Row(n=3, shipment_date="11/27/2025", origin_country="", origin_city=None, gross_weight="1e3", pallet_amount="-5", note=""),
         Row(n=4, shipment_date="2025-1-5", origin_country="usa", origin_city=" a", gross_weight="", pallet_amount=None, note=None),
         Row(n=5, shipment_date="soon", origin_country=None, origin_city="b", gross_weight=None, pallet_amount="x", note=None)]
    )
    day = datetime.date(2025, 11, 27)
    assert [tuple(r)[1:] for r in pm.normalize(raw).orderBy("n").collect()] == [
        (day, "DE", None, 1.5, None, " x "),
        (day, "ATLANTIS", "0", None, 4, "y"),
        (day, None, None, 1000.0, -5, ""),
        (datetime.date(2025, 1, 5), "US", "a", None, None, None),
        (None, None, "b", None, None, None),
    ]


def test_normalize_leaves_extracted_records_as_they_are(spark, page_rows):
    records = pm.extract_shipments(pm.sources.pages.as_pages(page_rows))
    assert sorted(map(repr, pm.normalize(records).collect())) == sorted(map(repr, records.collect()))


def test_registry_can_be_passed(spark):
    raw = spark.createDataFrame([("756",), ("Swiss Confederation",), ("de",)], "origin_country string")
    registry = [Country("CH", "CHE", "756", "Switzerland", None, "Swiss Confederation")]
    assert [r[0] for r in pm.normalize(raw, registry).collect()] == ["CH", "CH", "DE"]
    assert [r[0] for r in pm.normalize(raw, registry * 1001).collect()] == ["CH", "CH", "DE"]
    codes = {c.alpha_2: c for c in iso_countries(spark)}
    assert codes["CH"][:2] == ("CH", "CHE") and codes["TR"].name == "Türkiye" and len(codes) > 240


def test_registry_fields_and_files(spark, tmp_path):
    spelt = ["276", "Vietnam", "taiwan", "Bolivia", "Federal Republic of Germany", "United States of America", "Cabo Verde", "nowhere"]
    raw = spark.createDataFrame([(i, s) for i, s in enumerate(spelt)], "i int, origin_country string")
    found = {r.i: r.origin_country for r in pm.normalize(raw).collect()}
    assert [found[i] for i in range(len(spelt))] == ["DE", "VN", "TW", "BO", "DE", "US", "CV", "NOWHERE"]
    file = tmp_path / "countries.csv"
    file.write_text("alpha_2,alpha_3,numeric,name,common_name,official_name\nXY,XYZ,999,Nowhere,,\n", encoding="utf-8")
    assert read_registry(str(file)) == [Country("XY", "XYZ", "999", "Nowhere", None, None)]


def test_short_years_times_and_grouped_digits(spark):
    spelt = {
        "27.11.25": "2025-11-27", "27/11/25": "2025-11-27", "27-11-25": "2025-11-27", "27 Nov 25": "2025-11-27", "11/27/25": "2025-11-27",
        "2025-11-27 10:00:00": "2025-11-27", "2025-11-27T10:00": "2025-11-27", "27.11.80": "1980-11-27", "29.02.96": "1996-02-29",
        "31.02.25": None, "2025-11-27 25:00": None,
    }
    dates = pm.normalize(spark.createDataFrame([(s, s) for s in spelt], "raw string, shipment_date string")).collect()
    assert {r.raw: r.shipment_date and str(r.shipment_date) for r in dates} == spelt
    counts = {"1_000": 1000, "1__0": None, "_1": None, "1_": None, "+12": 12}
    numbers = pm.normalize(spark.createDataFrame([(s, s) for s in counts], "raw string, pallet_amount string")).collect()
    assert {r.raw: r.pallet_amount for r in numbers} == counts


def test_invoices_of_one_document_name_share_its_array(spark, tmp_path):
    rows = [(name, page, f"1Z000000000{page}{name[0]}\nTransport 1,00 2,00") for name in ("A", "A.pdf", "B.pdf") for page in (1, 2)]
    pages = pm.sources.pages.as_pages(spark.createDataFrame(rows, "invoice_id string, page_num int, text string"))
    pm.write_invoice_json(pm.extract_shipments(pages), str(tmp_path / "json"), str(tmp_path / "records"))
    folders = sorted(p for p in (tmp_path / "json").iterdir() if p.is_dir())
    assert [f.name for f in folders] == ["document=A_extracted.json", "document=B_extracted.json"]
    read = [json.loads("".join(p.read_text(encoding="utf-8") for p in sorted(f.glob("part-*")))) for f in folders]
    assert [[r["invoice_page"] for r in records] for records in read] == [[1, 2, 1, 2], [1, 2]]


@pytest.mark.parametrize("through_arrow", [True, False])
def test_documents_are_written_and_read_without_listing_all_of_them(spark, tmp_path, monkeypatch, through_arrow):
    top = tmp_path / "a b%c"
    names = [f"inv {i}" for i in range(60)] + ["x/y=1 %2F#?[é]", "a:b\"c'd\\e", "HOT"]
    rows = [(name, page, f"1Z{page:09}A\nTransport 1,00 2,00") for name in names for page in range(1, 400 if name == "HOT" else 3)]
    records = pm.extract_shipments(pm.sources.pages.as_pages(spark.createDataFrame(rows, "invoice_id string, page_num int, text string")))
    located = invoice_json._located
    if not through_arrow:
        monkeypatch.setattr(invoice_json, "_located", lambda spark, path: (path, None))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pm.write_invoice_json(records, str(top / "out"), str(top / "records"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert (top / "out" / "_SUCCESS").exists()
    small = [list(p.iterdir()) for p in (top / "out").iterdir() if p.name.startswith("document=inv")]
    assert len(small) == 60 and (not through_arrow or all(len(files) < 3 for files in small))  # no side files
    documents = spark.read.parquet(str(top / "records")).select(invoice_json.document_name().alias("document"))
    read = lambda documents: sorted(map(tuple, pm.read_invoice_files(spark, str(top / "out"), documents).collect()))
    want = sorted((r.document, r.line) for r in invoice_json._document_lines(records).collect())
    assert len(want) == 399 + 2 * 62 and read(documents) == want
    one = spark.createDataFrame([("HOT_extracted.json",), ("none",), (None,)], "document string")
    assert read(one) == [x for x in want if x[0] == "HOT_extracted.json"]
    assert sorted(map(tuple, spark.read.text(str(top / "out")).select("document", "value").collect())) == want
    with pytest.raises(Exception, match="exist"):
        pm.write_invoice_json(records, str(top / "out"))
    monkeypatch.setattr(invoice_json, "_located", located)
    pm.write_invoice_json(records.limit(0), f"file://{tmp_path}/empty")
    assert pm.read_invoice_files(spark, f"file://{tmp_path}/empty", documents).count() == 0


def test_dict_match_takes_keys_of_any_length_and_tables(spark):
    draw = random.Random(8)
    key = "".join(draw.choice("abcde ") for _ in range(200))
    texts = ["".join(c for c in key if draw.random() > 0.1), "x" + key[20:190], key[:90], "none of it", "", key + key]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    entries = [(key, "long", 1), ("none", "short", 2), (key, "again", 3)]
    table = spark.createDataFrame(entries, "key string, value string, ord int")
    for score, plain in (("ratio", ratio), ("partial", partial_ratio)):
        want = {}
        for i, t in enumerate(texts):
            scored = [(plain(k, t), v) for k, v in ((key, "long"), ("none", "short"))]
            best = max(s for s, _ in scored)
            want[i] = next(v for s, v in scored if s == best) if best >= 70 else None
        for dictionary in ({key: "long", "none": "short"}, table):
            assert {r.i: r.match for r in pm.dict_match(frame, "t", dictionary, score, 70.0).collect()} == want


SPELT = {
    "2025-11-27T10:00:00Z": "2025-11-27", "2025-11-27T10:00:00+01:00": "2025-11-27", "Thu 27 Nov 2025": "2025-11-27", "27th November 2025": "2025-11-27",
    "20251127T1000": "2025-11-27", "27.11.2025 10:15 AM": "2025-11-27", "10:15 AM 27.11.2025": "2025-11-27", "2025-05-04T10:00": "2025-05-04",
    "20251127100000": "2025-11-27", "2025-13-05": "2025-05-13", "99/11/27": "1999-11-27", "27 Nov '25": "2025-11-27", "Sept 5 2025": "2025-09-05",
    "2025-11-27T10:00:00 x y": None, "27 Nov": None, "Nov 2025": None, "2025": None, "32.1.2025": None, "13/13/2025": None, "27112025": None,
    "1.2.3.2025": None, "Smarch 5 2025": None, "27.11.2025 25:00": None, "1" * 100: None, "Nov Nov 2025": None, "": None, " ": None, None: None,
}


def test_dates_as_they_are_spelt(spark):
    rows = spark.createDataFrame([(s, s) for s in SPELT], "raw string, shipment_date string")
    assert {r.raw: r.shipment_date and str(r.shipment_date) for r in pm.normalize(rows).collect()} == SPELT


def test_spelt_dates_equal_a_free_parser(spark):
    draw = random.Random(12)
    days = ["%-d.%-m.%Y", "%d/%m/%Y", "%d-%m-%Y", "%d.%m.%y", "%-d %b %Y", "%-d. %B %Y", "%b %-d, %Y", "%B %-d %Y", "%a %-d %b %Y", "%A, %B %-d, %Y", "%d-%b-%y", "%Y %b %d", "%d %m %Y"]
    year_first = ["%Y-%m-%d", "%Y/%m/%d", "%Y%m%d", "%Y.%m.%d"]
    times = ["", " %H:%M", " %H:%M:%S", " %I:%M %p", " at %I:%M%p", " %H:%M UTC", " %H:%M:%S+02:00", ", %H:%M"]
    zoned = ["T%H:%M:%SZ", "T%H:%M", "T%H:%M:%S.%f+01:00", "T%H%M"]
    rows = {}
    for _ in range(1500):
        when = datetime.datetime(draw.randint(1980, 2069), draw.randint(1, 12), draw.randint(1, 28), draw.randint(0, 23), draw.randint(0, 59), draw.randint(0, 59))
        first = draw.random() < 0.3
        text = when.strftime(draw.choice(year_first if first else days) + draw.choice(times + zoned if first else times))
        if text[:1].isdigit() and text[1:4] == "th ":
            continue
        rows[text] = str(parser.parse(text, dayfirst=not first).date())
    table = spark.createDataFrame([(s, s) for s in rows], "raw string, shipment_date string")
    got = {r.raw: r.shipment_date and str(r.shipment_date) for r in pm.normalize(table).collect()}
    assert {s: (got[s], d) for s, d in rows.items() if got[s] != d} == {}


def test_every_field_of_the_registry_resolves(spark):
    if not os.path.exists(ISO_CODES):
        pytest.skip("the iso-codes package is not installed")
    countries = read_registry(ISO_CODES)
    rows = [(value.lower(), c.alpha_2) for c in countries for value in c if value]
    found = pm.normalize(spark.createDataFrame([(s, s, c) for s, c in rows], "raw string, origin_country string, code string")).collect()
    assert len(countries) == 249 and [r.raw for r in found if r.origin_country != r.code] == []
    spelt = ["008", "404", "Republic of Kenya", "türkiye"]
    found = pm.normalize(spark.createDataFrame([(s, s) for s in spelt], "raw string, origin_country string")).collect()
    assert {r.raw: r.origin_country for r in found} == dict(zip(spelt, ["AL", "KE", "KE", "TR"]))
    assert len(runtime_countries(spark)) > 240


def test_packed_json_holds_the_arrays_of_the_files(spark, tmp_path, monkeypatch):
    rows = [("long", page, f"1Z{page:010}\nTransport 1,00 2,00\n" * 3) for page in range(1, 60)]
    rows += [(f"small {i}.pdf", 1, f"1Z000000{i:04}") for i in range(200)]
    pages = pm.sources.pages.as_pages(spark.createDataFrame(rows, "invoice_id string, page_num int, text string"))
    records = pm.extract_shipments(pages)
    pm.pack_invoice_json(records, str(tmp_path / "packed"), str(tmp_path / "records"))
    assert len(list((tmp_path / "packed").glob("*.parquet"))) < 20
    got = {r.document: json.loads(r.json) for r in pm.read_invoice_json(spark, str(tmp_path / "packed")).collect()}
    assert len(got) == 201 and [r["invoice_page"] for r in got["long_extracted.json"]] == sorted([*range(1, 60)] * 3)
    assert [r["identifier"] for r in got["small 7_extracted.json"]] == ["1Z0000000007"]
    one = pm.read_invoice_json(spark, str(tmp_path / "packed"), ["small 8_extracted.json", "none"])
    assert [json.loads(r.json)[0]["identifier"] for r in one.collect()] == ["1Z0000000008"]
    pm.pack_invoice_json(records.limit(0), str(tmp_path / "empty"))
    assert pm.read_invoice_json(spark, str(tmp_path / "empty")).count() == 0


def test_a_long_document_is_packed_in_rows_that_concatenate(monkeypatch):
    monkeypatch.setattr(invoice_json, "SEGMENT_CHARS", 30)
    lines = [("a", "a", 1, i, ("[" if i == 1 else ",") + str(i) * 5 + ("]" if i == 20 else "")) for i in range(1, 21)] + [("b", "b", 1, 1, "[1]")]
    batches = [pa.RecordBatch.from_pylist([dict(zip("vwxyz", row)) for row in lines[i : i + 4]]) for i in range(0, len(lines), 4)]
    rows = [row for batch in invoice_json._segments(batches) for row in batch.to_pylist()]
    assert len([r for r in rows if r["document"] == "a"]) > 3 and all(len(r["json"]) < 50 for r in rows)
    assert "\n".join(r["json"] for r in rows[:-1]) == "\n".join(row[4] for row in lines[:-1]) and rows[-1]["json"] == "[1]"
    assert [r["page_block"] for r in rows[:-1]] == sorted(r["page_block"] for r in rows[:-1])


def test_rejected_values_are_listed_and_records_stay(spark):
    item = "struct<extracted_category string, total_cost_in_shipment_currency string, currency string, mention string>"
    rows = [(1, "x kg", "3.7", "soon", "Atlantis", [("a", "1,5", "", ""), ("b", "-", "", "")]), (2, " ", None, "2025-11-27", "de", None), (3, "1,5", "4", "27 Nov 2025", None, [])]
    raw = spark.createDataFrame(rows, f"id int, gross_weight string, pallet_amount string, shipment_date string, origin_country string, cost_items array<{item}>")
    got = sorted(tuple(r) for r in pm.rejected_values(raw, ["id"]).fillna(0).collect())
    assert got == [(1, "gross_weight", 0, "x kg"), (1, "origin_country", 0, "Atlantis"), (1, "pallet_amount", 0, "3.7"),
                   (1, "shipment_date", 0, "soon"), (1, "total_cost_in_shipment_currency", 2, "-")]
    assert pm.normalize(raw).count() == 3
    assert pm.rejected_values(raw.select("id"), ["id"]).count() == 0


def test_a_document_of_any_length_is_read_in_arrays_of_its_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(invoice_json, "SEGMENT_CHARS", 200)
    monkeypatch.setattr(invoice_json, "ARRAY_CHARS", 2000)
    sizes = {"long": 500, "middle": 30, "small": 1}
    lines = [
        (name, name, page, 1, ("[" if page == 1 else ",") + json.dumps({"page": page, "s": "[]"}) + ("]" if page == n else ""))
        for name, n in sizes.items() for page in range(1, n + 1)
    ]
    batches = [pa.RecordBatch.from_pylist([dict(zip("vwxyz", row)) for row in lines])]
    rows = [tuple(row.values()) for batch in invoice_json._segments(batches) for row in batch.to_pylist()]
    spark.createDataFrame(rows, invoice_json._PACKED).write.parquet(str(tmp_path / "packed"))
    read = pm.read_invoice_json(spark, str(tmp_path / "packed")).orderBy("document", "part").collect()
    long = [r for r in read if r.document == "long"]
    assert len(long) > 5 and [r.part for r in long] == list(range(1, len(long) + 1)) and max(len(r.json) for r in long) < 2500
    assert [record["page"] for r in long for record in json.loads(r.json)] == list(range(1, 501))
    assert {r.document: [record["page"] for record in json.loads(r.json)] for r in read if r.document != "long"} == {"middle": list(range(1, 31)), "small": [1]}
    assert len(read) == len(long) + 2 and len([r for r in rows if r[0] == "middle"]) > 3


def test_stored_records_move_once_and_leave_no_shuffle_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(invoice_json, "RECORDS_PER_PART", 20)
    rows = [(f"inv {i % 40}", i, f"1Z{i:010}\nTransport 1,00 2,00") for i in range(400)] + [("long", i, f"1Z{i:010}") for i in range(200)]
    pages = pm.sources.pages.as_pages(spark.createDataFrame(rows, "invoice_id string, page_num int, text string"))
    records = pm.extract_shipments(pages)
    want = sorted((r.document, r.line) for r in invoice_json._document_lines(records).collect())
    lines = invoice_json._sorted_lines(records, str(tmp_path / "records"))
    text = lines._jdf.queryExecution().executedPlan().toString()
    # One exchange is that of the ends of a document, whose rows are keys only.
    assert text.count("rangepartitioning") == 1 and text.count("hashpartitioning") == 1 and "SortMergeJoin" not in text and "HashJoin" not in text
    assert lines.rdd.getNumPartitions() == 30
    assert sorted((r.document, r.line) for r in lines.collect()) == want
    keys = [tuple(r)[:4] for r in lines.collect()]
    assert keys == sorted(keys)

    def shuffle_files():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {p for top in manager.localDirs() for p in glob.glob(f"{top.getPath()}/**/shuffle_*", recursive=True)}

    held = shuffle_files()
    pm.pack_invoice_json(records, str(tmp_path / "packed"), str(tmp_path / "again"))
    pm.write_invoice_json(records, str(tmp_path / "files"), str(tmp_path / "more"))
    assert shuffle_files() - held == set()


def test_lines_of_stored_records_are_computed_once_and_move_once(spark, tmp_path):
    rows = [(f"inv {i % 20}{'.pdf' * (i % 2)}", i, f"1Z{i:010}\nTransport 1,00 2,00") for i in range(60)] + [("long", i, f"1Z{i:010}") for i in range(100)]
    records = pm.extract_shipments(pm.sources.pages.as_pages(spark.createDataFrame(rows, "invoice_id string, page_num int, text string")))
    lines = pm.invoice_json_lines(records, str(tmp_path / "records"))
    text = lines._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "ArrowEvalPython" not in text and text.count("FileScan") == 2
    assert sorted(map(tuple, lines.collect())) == sorted(map(tuple, pm.invoice_json_lines(records).collect()))
    arrays = {}
    for r in sorted(lines.collect()):
        arrays.setdefault(r.invoice_id.replace(".pdf", ""), []).append(r.line)
    assert len(arrays) == 21 and sum(len(json.loads("".join(array))) for array in arrays.values()) == 160
