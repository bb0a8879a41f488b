"""Registered queries: every operator over the rendered invoices or over the driver tables as they are."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

import parcelmill as pm
from invoicebench.rendering import DESCRIPTION, decimal, pages, pick, render, shared_folder, table, texts
from parcelmill.functions.dictionaries import COST_CATEGORIES
from parcelmill.functions.patterns import rows_of
from parcelmill.functions.registry import iso_countries
from parcelmill.operators.costs import shipment_currency, with_cost_items, with_cost_rows
from parcelmill.operators.normalize import rejected_values
from parcelmill.operators.pages import chunk_year, page_tracking
from parcelmill.operators.segmentation import BLOCK_KEY, continuation_pages
from parcelmill.sources.invoice_json import document_name

KEY = BLOCK_KEY


def render_pages(spark: SparkSession, sf: str) -> DataFrame:
    return render(spark, sf)


def page_lines(spark: SparkSession, sf: str) -> DataFrame:
    return pm.page_lines(pages(spark, sf)).select("invoice_id", "page_num", "line_no", "line")


def noise_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = pm.page_lines(pages(spark, sf))
    return lines.groupBy("invoice_id", "page_num").agg(
        F.count_if("is_noise").alias("noise_lines"), F.count_if("is_start").alias("start_lines")
    )


def page_has_tracking(spark: SparkSession, sf: str) -> DataFrame:
    return page_tracking(pages(spark, sf)).drop("has_start")


def page_homes(spark: SparkSession, sf: str) -> DataFrame:
    return continuation_pages(pages(spark, sf))


def blocks(spark: SparkSession, sf: str) -> DataFrame:
    return pm.segment(pages(spark, sf)).select(*KEY, F.size(F.split("text", "\n")).alias("n_lines"), "text")


def identifiers_strict(spark: SparkSession, sf: str) -> DataFrame:
    return pm.with_identifier(pm.segment(pages(spark, sf))).select(*KEY, "identifier")


def identifiers_distorted(spark: SparkSession, sf: str) -> DataFrame:
    digits = "lpad(cast(o_orderkey as string), 16, '0')"
    text = pick(
        [
            f"concat('Sendung\\nIZ', {digits}, ' kg')",
            f"concat('Nr. lZ', translate({digits}, '0', 'O'))",
            f"concat('Nr. iz', {digits}, '\\nTRACKING')",
            "concat('Lager 9', lpad(cast(o_orderkey as string), 10, '0'), '\\nFrachtbrief AB', "
            "lpad(cast(o_orderkey as string), 10, '0'))",
            "concat('PKG12345678 00012345678 12345678 X', lpad(cast(o_orderkey as string), 9, '0'))",
            "'nothing here'",
        ],
        "(o_orderkey % 6)",
    )
    return pm.with_identifier(table(spark, sf, "orders").selectExpr("o_orderkey", f"{text} as text")).drop("text")


def identifiers_generic(spark: SparkSession, sf: str) -> DataFrame:
    return pm.with_identifier(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", "identifier")


def document_lines(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    lines = pm.page_lines(documents.select(F.col("source").alias("invoice_id"), F.col("doc_id").alias("page_num"), "text"))
    return lines.withColumnRenamed("invoice_id", "source").withColumnRenamed("page_num", "doc_id")


def document_years(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    return pm.invoice_year(
        documents.select(F.col("source").alias("invoice_id"), F.col("doc_id").alias("page_num"), "text")
    ).withColumnsRenamed({"invoice_id": "source", "invoice_year": "first_year"})


def invoice_year(spark: SparkSession, sf: str) -> DataFrame:
    return pm.invoice_year(pages(spark, sf))


def invoice_chunk_year(spark: SparkSession, sf: str) -> DataFrame:
    return chunk_year(pages(spark, sf))


def _dates(spark: SparkSession, sf: str, source: str) -> DataFrame:
    texts = pages(spark, sf)
    dates = pm.date_candidates(pm.segment(texts), chunk_year(texts)).filter(F.col("source") == source)
    return dates.select(*KEY, F.col("date").cast("string").alias("date"))


def dates_textual(spark: SparkSession, sf: str) -> DataFrame:
    return _dates(spark, sf, "textual")


def dates_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return _dates(spark, sf, "numeric")


def shipment_date(spark: SparkSession, sf: str) -> DataFrame:
    texts = pages(spark, sf)
    dated = pm.with_shipment_date(pm.segment(texts), chunk_year(texts))
    return dated.select(*KEY, F.col("shipment_date").cast("string").alias("shipment_date"))


def service_pattern(spark: SparkSession, sf: str) -> DataFrame:
    return pm.with_service(pm.segment(pages(spark, sf))).select(*KEY, "shipment_type")


MISSPELT_SERVICES = [
    ("Expres 24", "Express"), ("Standrad", "Standard"), ("Internatonal Priority", "International Priority"),
    ("Ecnomy", "Economy"), ("Domstic", "Domestic"), ("Worldwdie", "Worldwide"),
    ("International Service", "International Priority"), ("Premum", "Premium"), ("Paket", None),
]


def service_fuzzy(spark: SparkSession, sf: str) -> DataFrame:
    name = pick(texts([wrong for wrong, _ in MISSPELT_SERVICES]), "(o_orderkey % 9)")
    text = f"concat('Nr. ', cast(o_orderkey as string), '\\n', {name}, '\\n', cast(o_custkey as string), ' kg')"
    named = pm.with_service(table(spark, sf, "orders").selectExpr("o_orderkey", f"{text} as text"))
    return named.select("o_orderkey", "shipment_type")


def locations(spark: SparkSession, sf: str) -> DataFrame:
    return pm.with_locations(pm.segment(pages(spark, sf))).drop("text")


def weights(spark: SparkSession, sf: str) -> DataFrame:
    return pm.with_weights(pm.segment(pages(spark, sf))).drop("text")


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def weights_keywords(spark: SparkSession, sf: str) -> DataFrame:
    quantity, tenths = "cast(l_quantity as bigint)", decimal("(l_partkey % 5000)", 1)
    text = f"""concat_ws('\\n',
        concat('Stück ', {quantity} + 1), concat('pieces, ', {quantity}), '7 8,5',
        case when l_linenumber % 2 = 0 then concat('TB Standard ', {quantity}, ' ', {tenths}) end,
        case when l_linenumber % 3 = 0 then '0 99,0 PKG' end,
        concat('Brutto 1. ', {tenths}), 'Gewicht 99999999 kg', 'Weight 3',
        'chargeable 1,5', concat('berechnetes Gewicht ', {tenths}),
        concat('Ladem. 1 Loading meter ', {decimal('l_suppkey', 2)}), 'Volume: 12,00 13,00',
        concat({quantity}, ' cbm'), concat('Raum ', {quantity}, ' m3 ca.'))"""
    lines = table(spark, sf, "lineitem").selectExpr(*LINE_KEY, "l_quantity", f"{text} as text")
    return pm.with_weights(lines).drop("text")


def weights_pair(spark: SparkSession, sf: str) -> DataFrame:
    text = f"""concat('Gewicht/Container 12,5\\nGewicht/Container ', {decimal('(l_partkey % 900)', 1)}, '/',
        {decimal('(l_suppkey % 70)', 1)}, ' D', case when l_linenumber = 7 then '\\nGewicht/Container 1 2 3' else '' end)"""
    lines = table(spark, sf, "lineitem").selectExpr(*LINE_KEY, f"{text} as text")
    return pm.with_weights(lines).select(*LINE_KEY, "gross_weight", "chargeable_weight")


ITEM = ["extracted_category", "total_cost_in_shipment_currency", "currency", "mention"]


def cost_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_cost_rows(pm.segment(pages(spark, sf))).select(*KEY, F.posexplode_outer("cost_rows").alias("pos", "row"))
    return rows_of(rows).select(*KEY, "row.ord", "row.item.*")


def cost_items(spark: SparkSession, sf: str) -> DataFrame:
    return pm.cost_items(pm.segment(pages(spark, sf)))


def cost_currency(spark: SparkSession, sf: str) -> DataFrame:
    items = with_cost_items(pm.segment(pages(spark, sf)))
    return items.select(*KEY, shipment_currency(F.col("cost_items")).alias("currency_shipment"))


def cost_categories(spark: SparkSession, sf: str) -> DataFrame:
    described = table(spark, sf, "lineitem").selectExpr(*LINE_KEY, f"{DESCRIPTION} as description")
    return pm.dict_match(described, "description", COST_CATEGORIES, "partial", 70.0, "best", "category")


def dictionary_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the dictionary as a table."""
    entries = [(key, value, place) for place, (key, value) in enumerate(COST_CATEGORIES.items())]
    dictionary = spark.createDataFrame(entries, "key string, value string, ord int")
    described = table(spark, sf, "lineitem").selectExpr(*LINE_KEY, f"{DESCRIPTION} as description")
    return pm.dict_match(described, "description", dictionary, "partial", 70.0, "best", "category")


PART_KEY = "concat(p_name, ' ', left(md5(cast(p_partkey as string)), 10))"


def dictionary_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The part that a misspelt line names, by similarity to the names of all parts."""
    parts = table(spark, sf, "part")
    dictionary = parts.selectExpr(f"upper({PART_KEY}) as key", "cast(p_partkey as string) as value", "p_partkey as ord")
    lines = table(spark, sf, "lineitem").join(parts.selectExpr("p_partkey as l_partkey", f"{PART_KEY} as name"), "l_partkey")
    spelt = pick(["concat(left(name, 1), substr(name, 3))", "concat(left(name, length(name) - 4), 'Z', right(name, 3))", "concat('part ', l_suppkey)"], "(l_linenumber % 3)")
    named = pm.dict_match(lines.selectExpr(*LINE_KEY, f"{spelt} as name"), "name", dictionary, "ratio", 85.0, "best", "part")
    return named.select(*LINE_KEY, "part")


def shipment_net(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_cost_rows(pm.with_identifier(pm.segment(pages(spark, sf))))
    net = F.aggregate(
        "cost_rows",
        F.lit(0).cast("bigint"),
        lambda total, row: total + F.round(row["item"]["total_cost_in_shipment_currency"] * 100).cast("bigint"),
    )
    return rows.select(*KEY, "identifier", net.alias("net_cents"))


def normalize_numbers(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "lineitem").selectExpr(
        *LINE_KEY,
        f"case when l_linenumber = 1 then 'n/a' else {decimal('cast(round(l_extendedprice * 100) as bigint)', 2)} end as gross_weight",
        "concat(' ', cast(l_quantity as string)) as chargeable_weight",
        "case when l_linenumber = 2 then '' else concat(cast(cast(l_quantity as bigint) as string), 'e2') end as loading_meter",
        "l_tax as cubic_meter",
        "case when l_linenumber % 2 = 0 then concat(cast(l_partkey as string), '.7') else concat(' ', cast(l_partkey as string)) end as pallet_amount",
    )
    return pm.normalize(raw)


def normalize_strings(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "case when o_orderkey % 3 = 0 then '  ' else concat('\\t', o_orderpriority, '\\u00a0') end as shipment_type",
        "case when o_orderkey % 2 = 0 then '' else o_orderstatus end as currency_shipment",
        "lpad(cast(o_custkey as string), 7, '0') as origin_zipcode",
        """array(named_struct('extracted_category', concat(' ', o_orderpriority), 'total_cost_in_shipment_currency',
            cast(o_totalprice as string), 'currency', '', 'mention', concat(o_orderstatus, '  '))) as cost_items""",
    )
    cleaned = pm.normalize(raw)
    return cleaned.select(*cleaned.columns[:-1], F.inline("cost_items"))


COUNTRY_SPELLINGS = [
    ("de", "DE"), ("CHE", "CH"), (" Norway ", "NO"), ("FRANCE", "FR"), ("hkg", "HK"), ("Viet Nam", "VN"),
    ("Nirgendwo", "NIRGENDWO"), ("", None), ("united kingdom", "GB"), ("XX", "XX"),
]


def normalize_countries(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        f"{pick(texts([s for s, _ in COUNTRY_SPELLINGS]), '(o_orderkey % 10)')} as origin_country",
        f"{pick(texts([s for s, _ in COUNTRY_SPELLINGS]), '(o_custkey % 10)')} as destination_country",
    )
    return pm.normalize(raw)


def normalize_dates(spark: SparkSession, sf: str) -> DataFrame:
    forms = ["yyyy-MM-dd", "d.M.yyyy", "d/M/yyyy", "d MMM yyyy", "d MMMM yyyy", "yyyyMMdd"]
    spelt = F.coalesce(*[
        F.when(F.col("o_orderkey") % 8 == n, F.date_format(F.col("o_orderdate").cast("date"), form))
        for n, form in enumerate(forms)
    ], F.when(F.col("o_orderkey") % 8 == 6, F.lit("31.02.2025")))
    raw = table(spark, sf, "orders").select("o_orderkey", spelt.alias("shipment_date"))
    return pm.normalize(raw).withColumn("shipment_date", F.col("shipment_date").cast("string"))


DATE_SPELLINGS = [
    "yyyy-MM-dd", "d.M.yyyy", "dd.MM.yyyy", "d/M/yyyy", "dd-MM-yyyy", "d. MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d yyyy", "yyyyMMdd",
    "yyyy/MM/dd", "yyyy.M.d", "EEE d MMM yyyy", "EEEE, MMMM d, yyyy", "d-MMM-yyyy", "d 'of' MMMM yyyy", "yyyy MMM d", "dd/MMM/yyyy", "EEE, d MMM. yyyy",
]
TIME_SPELLINGS = [
    "", "T10:00:00Z", "T10:00:00+01:00", "T23:59:59.123456Z", "T0930", " 10:15", " 10:15:30", " 10:15 AM", " 10:15 PM", " at 10:15", ", 7:05 pm",
    " 10:00:00 UTC", " 10:00 +0200", "T10:00-05",
]


def normalize_spelt_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Every spelling of a date with every spelling of a time."""
    spelt = F.coalesce(*[F.when(F.col("o_orderkey") % len(DATE_SPELLINGS) == n, F.date_format("o_orderdate", form)) for n, form in enumerate(DATE_SPELLINGS)])
    time = F.get(F.array(*[F.lit(t) for t in TIME_SPELLINGS]), (F.col("o_custkey") % len(TIME_SPELLINGS)).cast("int"))
    raw = table(spark, sf, "orders").select("o_orderkey", F.concat(spelt, time).alias("shipment_date"))
    return pm.normalize(raw).withColumn("shipment_date", F.col("shipment_date").cast("string"))


def normalize_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Every field of every country, in changing case."""
    countries = iso_countries(spark)
    spellings = [(i, field, value) for i, country in enumerate(countries) for field, value in enumerate(country)]
    fields = spark.createDataFrame(spellings, "i int, field int, spelt string")
    orders = table(spark, sf, "orders").selectExpr("o_orderkey", f"cast(o_orderkey % {len(countries)} as int) as i", "cast(o_custkey % 6 as int) as field")
    case = F.when(F.col("o_orderkey") % 2 == 0, F.lower("spelt")).otherwise(F.concat(F.lit(" "), F.upper("spelt")))
    return pm.normalize(orders.join(fields, ["i", "field"], "left").select("o_orderkey", case.alias("origin_country")))


def shipments(spark: SparkSession, sf: str) -> DataFrame:
    records = pm.extract_shipments(pages(spark, sf))
    total = F.aggregate(
        "cost_items",
        F.lit(0).cast("bigint"),
        lambda so_far, item: so_far + F.round(item["total_cost_in_shipment_currency"] * 100).cast("bigint"),
    )
    return records.withColumns(
        {
            "shipment_date": F.col("shipment_date").cast("string"),
            "n_items": F.size("cost_items"),
            "net_cents": total,
            "mentions": F.array_join(F.col("cost_items")["mention"], "|"),
        }
    ).drop("cost_items")


def shipments_json(spark: SparkSession, sf: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/json-{uuid.uuid4().hex}"
    return pm.invoice_json_lines(pm.extract_shipments(pages(spark, sf)), f"{folder}/records")


def shipments_json_files(spark: SparkSession, sf: str) -> DataFrame:
    """The records of the JSON documents as they are read back from the files."""
    folder = f"{shared_folder(spark)}/json-{uuid.uuid4().hex}"
    pm.write_invoice_json(pm.extract_shipments(pages(spark, sf)), f"{folder}/documents", f"{folder}/records")
    names = spark.read.parquet(f"{folder}/records").select(document_name().alias("document"))
    lines = pm.read_invoice_files(spark, f"{folder}/documents", names).select("document", F.regexp_extract("line", r"^[\[,](\{.*\})\]?$", 1).alias("record"))
    record = "identifier string, invoice_page int, shipment_date string, origin_country string, pallet_amount long, cost_items array<struct<mention string>>"
    read = lines.select("document", F.from_json("record", record).alias("r"))
    return read.select("document", "r.identifier", "r.invoice_page", "r.shipment_date", "r.origin_country", "r.pallet_amount",
                       F.array_join("r.cost_items.mention", "|").alias("mentions"))


def shipments_json_packed(spark: SparkSession, sf: str) -> DataFrame:
    """The records of the JSON documents as they are read back from the packed table."""
    folder = f"{shared_folder(spark)}/json-{uuid.uuid4().hex}"
    pm.pack_invoice_json(pm.extract_shipments(pages(spark, sf)), f"{folder}/packed", f"{folder}/records")
    record = "array<struct<identifier string, invoice_page int, shipment_date string, origin_country string, pallet_amount long, cost_items array<struct<mention string>>>>"
    read = pm.read_invoice_json(spark, f"{folder}/packed").select("document", F.inline(F.from_json("json", record)))
    return read.withColumn("mentions", F.array_join("cost_items.mention", "|")).drop("cost_items")


def normalize_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """The values of malformed records that stay raw or become null."""
    raw = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "case o_orderkey % 5 when 0 then concat(o_custkey, ' kg') when 1 then '' when 2 then '1,5' when 3 then '1.2.3' end as gross_weight",
        "case when o_orderkey % 3 = 0 then concat(o_custkey, '.5') else cast(o_custkey as string) end as pallet_amount",
        "case o_orderkey % 4 when 0 then concat('31.02.', 2000 + o_custkey % 20) when 1 then 'soon' when 2 then '2025-11-27' end as shipment_date",
        "case when o_orderkey % 2 = 0 then 'DE' else concat('Land ', o_custkey) end as origin_country",
        """array(named_struct('extracted_category', 'a', 'total_cost_in_shipment_currency', cast(o_totalprice as string), 'currency', '', 'mention', ''),
            named_struct('extracted_category', 'b', 'total_cost_in_shipment_currency', if(o_orderkey % 7 = 0, concat(o_custkey, ' EUR'), null),
                'currency', '', 'mention', '')) as cost_items""",
    )
    return rejected_values(raw, ["o_orderkey"])


QUERIES = {
    query.__name__: query
    for query in (
        render_pages, page_lines, noise_lines, page_has_tracking, page_homes, blocks, identifiers_strict,
        identifiers_distorted, identifiers_generic, document_lines, document_years, invoice_year, invoice_chunk_year,
        dates_textual, dates_numeric, shipment_date, service_pattern, service_fuzzy, locations, weights,
        weights_keywords, weights_pair, cost_rows, cost_items, cost_currency, cost_categories, shipment_net,
        normalize_numbers, normalize_strings, normalize_countries, normalize_dates, normalize_spelt_dates, normalize_registry, shipments, shipments_json,
        shipments_json_files, dictionary_table, dictionary_parts, shipments_json_packed, normalize_rejects,
    )
}
