import random
import re

import pytest
from dateutil.parser import parse
from pyspark.sql import functions as F

import parcelmill as pm
from parcelmill.operators import costs, dates
from parcelmill.operators.costs import with_cost_items
from parcelmill.operators.identifiers import identifier
from parcelmill.operators.locations import line_kind
from parcelmill.functions.patterns import fold_case


def texts(spark, items):
    return spark.createDataFrame(list(enumerate(items)), "n int, text string").repartition(3)


def in_order(df, *columns):
    return [tuple(row[c] for c in columns) if len(columns) > 1 else row[columns[0]] for row in sorted(df.collect(), key=lambda r: r.n)]


# --- identifiers ---


def test_identifier_tiers(spark):
    cases = {
        "x 1Z8028100495457854 y 1Z7A16006896476723": "1Z8028100495457854",
        "a1Z8028100495457854": None,
        "IZ802810O495457854": "1Z8028100495457854",
        "nr lZ80281004954S": "1Z80281004954S",
        "Lager 1234567890\nSendung 98765 AB12345678": "AB12345678",
        "TRACKING none": "TRACK1NG",
        "Awb 123456789\nABCDEFGH1": "ABCDEFGH1",
        "000123456789 123456789 PKG1234567 1PACKAGE2": None,
        "0012345678": "0012345678",
        "Österreich ABCDEFGHÖ": None,
    }
    found = in_order(texts(spark, cases).select("n", identifier(F.col("text")).alias("id")), "id")
    assert dict(zip(cases, found)) == cases
    assert pm.with_identifier(texts(spark, cases)).count() == sum(v is not None for v in cases.values())


# --- dates ---


def earliest(spark, items, year):
    df = texts(spark, items)
    return [d and d.isoformat() for d in in_order(df.select("n", dates.earliest(dates.raw_candidates(F.col("text")), F.lit(year).cast("int")).alias("d")), "d")]


def test_date_spellings(spark):
    cases = {
        "27.Nov": "2025-11-27", "02.Dezember 2024": "2024-12-02", "1 Mär 25": "2025-03-01", "27.\nNov\n24 x": "2024-11-27",
        "27.11.2025": "2025-11-27", "27/11/25": "2025-11-27", "2025-11-27": "2025-11-27", "11-27-2025": "2025-11-27",
        "31.11.2025": None, "0.11.2025": None, "27.11.1234": None, "27.11.123": None, "29.Feb": None, "29 Feb 2024": "2024-02-29",
        "12,10\nDeklarierter Wert": "2025-12-10", "5 Maut": "2025-03-05", "27.Nov 12 PKG": "2012-11-27", "27.Nov 20256": "2025-11-27",
        "127.Nov": None, "27.Novembermonatlich": None, "3 Jaui, 2024": "2024-01-03", "12.1.2025 3.2.2024": "2024-02-03", "3.13.2025": "2025-03-13",
        "27 Nov 28 Dez 2023": "2028-11-27",
    }
    assert dict(zip(cases, earliest(spark, cases, 2025))) == cases


def test_dates_without_an_invoice_year(spark):
    cases = {"27.Nov": None, "27.Nov 24": "2024-11-27", "1.2.03": "2003-02-01"}
    assert dict(zip(cases, earliest(spark, cases, None))) == cases


def test_day_and_month_order_equals_dateutil(spark):
    items = [f"{d}-{m}-{y}" for y in (1900, 2024, 2025) for m in range(0, 34, 3) for d in range(0, 36)]
    expected = []
    for item in items:
        try:
            expected.append(parse(item, dayfirst=True).date().isoformat())
        except ValueError:
            expected.append(None)
    assert earliest(spark, items, None) == expected


# --- service ---


def test_service_cascade(spark):
    cases = {
        "27.Nov WW Express Saver 1": "Express", "TB Standard 2": "Standard", "Express Saver": "Express Saver",
        "EXPRESS\nWORLDWIDE": "Express Worldwide", "Express Domestic": "Express", "Economy Select": "Economy",
        "expres 12": "Express", "Domestc": "Domestic", "an international matter": "International Priority",
        "Standard and Premium": "Standard", "": None, "Paket": None,
    }
    assert dict(zip(cases, in_order(pm.with_service(texts(spark, cases)), "shipment_type"))) == cases


# --- locations ---

PLACE = ["origin_country", "origin_city", "origin_zipcode", "destination_country", "destination_city", "destination_zipcode"]


def test_location_rules(spark):
    cases = {
        "Versender: OBERSCHLEISSHEIM 85764 DEUTSCHLAND": ("DE", "OBERSCHLEISSHEIM", "85764", None, None, None),
        "Empfänger: 33900 HONG KONG": (None, None, None, "HK", "HONG KONG", "33900"),
        "Empfänger: KOWLOON 33900 HONG KONG, CHINA": (None, None, None, "CN", "KOWLOON", "33900"),
        "Versender:\nKÖLN-SÜD 50829\nGermany\nTransport 1,00 1,00\nmore": ("DE", "KÖLN-SÜD", "50829", None, None, None),
        "Versender:\nTYCHY 43100\nPOLEN\nEmpfänger:\nKOELN 50829 DEUTSCHLAND\n12,00 13,00\nx": (
            "DE", "TYCHY Empfänger KOELN 50829", "43100", "DE", "KOELN", "50829"),
        "EMPFANGER: ignored 1234\nVersender: A Empfänger: B": (None, "A Empfänger B", None, None, None, None),
        "Versender: Street Usaville 01040 GROSSBRITANNIEN ß": (
            "US", "Street ville GROSSBRITANNIEN", "01040", None, None, None),
        "Versender: Singapore, 368814 SINGAPUR": ("SG", "Singapore SINGAPUR", "368814", None, None, None),
        "Versender: X\nService\nlost\nVersender: later 999": (None, "X", None, None, None, None),
        "Versender:\nEmpfänger: Y 12\nZ": (None, "Z", None, None, "Y 12 Z", None),
        "Abs. VERSENDER:  Ä\nAnzahl 3": (None, "Ä", None, None, None, None),
        "nothing": (None,) * 6,
    }
    found = in_order(pm.with_locations(texts(spark, cases)), *PLACE)
    for case, row in zip(cases, found):
        assert row == cases[case], case


def plain_address(lines, role):
    """Lines of a role by walking over the lines with the two facts: begun, ended."""
    begun, taken = False, []
    for line in lines:
        inline = re.search(r"(versender|empf[aä]nger):\s*(.+)", line, re.I)
        if inline:
            if inline[1].lower() == role:
                begun = True
                taken.append(inline[2])
        elif line.lower().endswith(role + ":"):
            begun = True
        elif begun and re.search(r"transport|service|\d[,.]\d\d\s+\d+[,.]\d\d", line, re.I):
            break
        elif begun:
            taken.append(line)
    return taken


def test_addresses_equal_a_plain_walk(spark):
    pieces = [
        "Versender:", "Empfänger:", "Versender: a", "empfänger: b 123", "Empfanger: c", "Service Empfänger:", "Transport",
        "city", "Xstadt", "1,00 2,00", "Transport Versender:", "d: e", "Service: Versender: f",
    ]
    rng = random.Random(4)
    blocks = [rng.choices(pieces, k=rng.randint(1, 8)) for _ in range(600)]
    from parcelmill.operators import locations

    df = texts(spark, ["\n".join(b) for b in blocks]).withColumn("_lines", F.split("text", "\n"))
    df = df.withColumn("_kinds", F.transform(F.split(fold_case(F.col("text")), "\n"), line_kind))
    df = df.withColumn("_word", F.array_join("_kinds", ""))
    for role, name in (("origin", "versender"), ("destination", "empfänger")):
        found = in_order(locations._with_address(df, role), "_address")
        assert [f or "" for f in found] == [" ".join(plain_address(b, name)) for b in blocks]


# --- weights ---

MEASURES = ["gross_weight", "chargeable_weight", "loading_meter", "cubic_meter", "pallet_amount"]


def test_weight_rules(spark):
    cases = {
        "1Z8028100495457854 WW Express 2 9,5": (9.5, None, None, None, 2),
        "WW x 1 2,0\nTB y 3 4,5": (4.5, None, None, None, 3),
        "1 PKG 2,0": (None, None, None, None, 2),
        "WW 0 1,0\nTB 4 pkg": (1.0, None, None, None, 4),
        "WW 2 1,0\nTB 4 pkg": (1.0, None, None, None, 2),
        "Express 748,40 374,25": (None,) * 5,
        "Gewicht/Container 6,0/5,5": (5.5, 6.0, None, None, None),
        "Gewicht/Container 82, D": (82.0, None, None, None, None),
        "Brutto 3\nGewicht 4\nchargeable 5\nberechnetes Gewicht 6,5": (3.0, 6.5, None, None, None),
        "Gewicht 12345678\nWeight 7": (7.0, None, None, None, None),
        "3 m3\nLDM 1.5\nfilm 2": (None, None, 2.0, 3.0, None),
        "Stück: 7\nColis 8": (None, None, None, None, 8),
        "Gewicht 1.234,5": (5.0, None, None, None, None),
        "Newwest 1 2,0": (None,) * 5,
    }
    found = in_order(pm.with_weights(texts(spark, cases)), *MEASURES)
    for case, row in zip(cases, found):
        assert row == cases[case], case


def test_pallets_of_service_lines_equal_a_plain_walk(spark):
    rng = random.Random(8)
    pieces = ["WW 0 1,0", "WW 3 2,5", "TB 4 PKG", "Express 0 pkg x", "WW 5 1,5 PKG", "Standard 9 9,9", "PKG 2 3,5 7 Packages"]
    blocks = [rng.choices(pieces, k=rng.randint(1, 6)) for _ in range(300)]

    def plain(lines):
        pallets = gross = None
        for line in lines:
            if line.startswith("Standard"):
                continue
            pair = re.search(r"\b(\d+)\s+(\d+,\d+)\b", line)
            if pair:
                pallets, gross = int(pair[1]), float(pair[2].replace(",", "."))
            pack = re.search(r"(\d+)\s*(?:pkgs?|packages)\b", line, re.I)
            if pack and not pallets:
                pallets = int(pack[1])
        for line in lines:
            piece = re.search(r"(?:packages|pkgs?)[:,]?\s*(\d+)", line, re.I)
            pallets = int(piece[1]) if piece else pallets
        return gross, pallets

    found = in_order(pm.with_weights(texts(spark, ["\n".join(b) for b in blocks])), "gross_weight", "pallet_amount")
    assert found == [plain(b) for b in blocks]


# --- costs ---

# Cost rows with their published category and amount.
GOLDEN = [
    ("Dritte Partei Transport 244,25 122,15 122,10", "Freight", 122.1),
    ("Benzinzuschlag 72,30 36,05 36,25", "Fuel", 36.25),
    ("Surge Fee - Firmenkunden 0,85 0,85", "Surcharge", 0.85),
    ("Gebühr Zölle und Steuern 22,55 22,55", "Surcharge", 22.55),
    ("Benzinzuschlag(2) 222,20 110,40 111,80", "Fuel", 111.8),
    ("Versender Vorlageprovisionsgebühr 15,30 15,30", "Surcharge", 15.3),
    ("MWST. 472,35 472,35", "MWST.", 472.35),
    ("Drucketikette 1,25 1,25", "Drucketikette", 1.25),
    ("Deklarierter Wert 12,00 12,00", "Deklarierter Wert", 12.0),
    ("Empfänger Transport 151,55 122,90 28,65", "Freight", 28.65),
    ("Dritte Partei Vorlageprovisionsgebühr 69,65 69,65", "Surcharge", 69.65),
    ("Gebühr Pre-Release 3,45 3,45", "Surcharge", 3.45),
    ("WW Express Saver DOC 1 1 178,50 130,15 48,35", "WW Express Saver DOC 1 1", 48.35),
    ("Benzinzuschlag(5) gem. Vertrag 306,75 242,95 63,80", "Fuel", 63.8),
]


def test_golden_cost_rows(spark):
    items = pm.cost_items(texts(spark, [line for line, _, _ in GOLDEN]))
    found = in_order(items, "mention", "extracted_category", "total_cost_in_shipment_currency")
    assert found == GOLDEN


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Zoll 1.234,50 1.234,50\nGesamtkosten\nchf 1,00", [("Customs", 1234.5, "chf")]),
        ("Zoll EUR 1,0 2,0\nZoll 1,0 2,0\nGesamtkosten CHFX", [("Customs", 2.0, "EUR"), ("Customs", 2.0, "CHF")]),
        ("Maut 1,00 2,00\nLager 1,00 2,00\nMaut x 3,00 2,00", [("Toll", 2.0, None), ("Storage", 2.0, None)]),
        ("Maut 1234,00 2,00 3,00\nMaut 5,00\nMaut -5,00 -5,00\nMaut 1,00 2,00 x", [("Toll", 3.0, None)]),
        ("Anzahl 1,00 2,00\nGesamtbetrag 1,00 2,00\nRabatt (gesamt) 1,00 2,00\nPackages 1,00 2,00", []),
        ("Rabatt 1,00 2,00", [("Discount", 2.0, None)]),
        ("Maut 12.345.678,00 12.345.678,00", [("Toll", None, None)]),
        ("Zoll 1,00 2,00", [("Customs", 2.0, None)]),
    ],
)
def test_cost_rules(spark, text, expected):
    (row,) = with_cost_items(texts(spark, [text])).collect()
    assert [tuple(item)[:3] for item in row.cost_items] == expected


COST_ROW = re.compile(
    r"^([A-Za-zÄÖÜäöüß0-9\-.()/ ,]+?)\s+((?:[0-9]{1,3}(?:\.[0-9]{3})*,[0-9]{1,2}\s+)+[0-9]{1,3}(?:\.[0-9]{3})*,[0-9]{1,2})$"
)


def test_cost_rows_equal_a_plain_parser(spark):
    draw = random.Random(5)
    words = ["Maut", "1,00", "12,5", "1.234,56", "1234,5", "a", "(x)", "é", "-", "2.00"]
    texts = ["".join(draw.choice(words) + draw.choice([" ", " ", "  ", "\t", ""]) for _ in range(draw.randrange(1, 8))).strip() for _ in range(2000)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for r in frame.select("i", costs._parsed_rows(F.col("text")).alias("rows")).collect():
        m = COST_ROW.match(texts[r.i])
        want = [(m[1].strip(), float(m[2].split()[-1].replace(".", "").replace(",", ".")))] if m else []
        assert [(x.description, x.total_cost_in_shipment_currency) for x in r.rows] == want, texts[r.i]


def test_cost_rows_of_any_length(spark):
    texts = ["Maut " + "1,00 " * 100_000, "Maut 1" + ".000" * 100_000 + ",00 1,00 2,00"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [len(r[0]) for r in frame.select(costs._parsed_rows(F.col("text"))).collect()] == [1, 1]
