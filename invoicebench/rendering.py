"""Rendered invoices: page texts derived from `orders` and `lineitem`.

The expressions here are SQL that Spark and DuckDB read alike. Everything about an order but its date and
price follows from its key, so the pages need one shuffle: orders and line items to slots.

Layout. Three order keys share a slot; a slot is a page with up to three blocks. A third of all slots goes to
one collective invoice `BULK-0` (a hot invoice), the others four slots to an invoice `INV-n`. Content pages have the
numbers 1, 4, 7, ...; the two page numbers after one are for what the last block of the page spills over:

* spill 1: cost rows on the next page, the closing row on the one after: kept;
* spill 2: the next page has a tracking number in a noise line only: all that follows is lost;
* spill 3: the next page starts another block after the cost rows: these are lost, the closing row
  goes to the new block.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from parcelmill.sources.pages import as_pages, read_pages
from parcelmill.sources.tables import write_table

NBSP = "\u00a0"


def big(x: str) -> str:
    return f"cast(floor({x}) as bigint)"


def pick(items: list[str], index: str) -> str:
    """Element of a list of SQL expressions by a number from 0 on."""
    cases = " ".join(f"when {n} then {item}" for n, item in enumerate(items))
    return f"(case {index} {cases} end)"


def texts(items: list[str]) -> list[str]:
    return [f"'{item}'" for item in items]


def amount(cents: str) -> str:
    """German spelling of an amount below one million: 12,34 or 1.234,56."""
    euros = big(f"{cents} / 100")
    whole = (
        f"case when {cents} >= 100000 then concat(cast({big(f'{cents} / 100000')} as string), '.', "
        f"lpad(cast({euros} % 1000 as string), 3, '0')) else cast({euros} as string) end"
    )
    return f"concat({whole}, ',', lpad(cast({cents} % 100 as string), 2, '0'))"


def decimal(value: str, digits: int) -> str:
    """Number with a decimal comma from an integer that counts its last digit."""
    unit = 10**digits
    return f"concat(cast({big(f'{value} / {unit}')} as string), ',', lpad(cast({value} % {unit} as string), {digits}, '0'))"


def placed(key: str) -> str:
    """Place of an order key: slot, position, invoice, page and kind of spill."""
    slot = big(f"{key} / 3")
    return f"""{slot} as slot, {key} % 3 as pos,
        case when {slot} % 3 = 0 then concat('BULK-', cast({big(f'{slot} / 600000000')} as string))
             else concat('INV-', cast({big(f'{slot} / 4')} as string)) end as invoice_id,
        cast(3 * (case when {slot} % 3 = 0 then {slot} % 600000000 else {slot} % 4 end) + 1 as int) as page,
        case when {key} % 3 = 2 then cast({slot} % 4 as int) else 0 end as spill"""


PAGE_YEAR = "(2023 + page % 5)"

SHORT_MONTHS = ["Jan", "Feb", "Mär", "Apr", "Mai", "Jun", "Jul", "Aug", "Sep", "Okt", "Nov", "Dez"]
LONG_MONTHS = [
    "Januar", "Februar", "März", "April", "Mai", "Juni",
    "Juli", "August", "September", "Oktober", "November", "Dezember",
]
# Service words of a start line and the service type they stand for.
SERVICE_WORDS = [
    ("WW Express Saver", "Express"), ("TB Standard", "Standard"), ("Express Saver", "Express Saver"),
    ("EXPRESS WORLDWIDE", "Express Worldwide"), ("International Priority", "International Priority"),
    ("Economy Select", "Economy"), ("Premium", "Premium"), ("TB Domestic", "Domestic"),
]
COUNTRIES = [
    ("DEUTSCHLAND", "DE"), ("GERMANY", "DE"), ("SCHWEIZ", "CH"), ("SWITZERLAND", "CH"),
    ("VOLKSREPUBLIK CHINA", "CN"), ("HONGKONG", "HK"), ("ÖSTERREICH", "AT"), ("AUSTRIA", "AT"),
    ("ITALIEN", "IT"), ("ITALY", "IT"), ("POLEN", "PL"), ("POLAND", "PL"), ("FRANKREICH", "FR"),
    ("FRANCE", "FR"), ("SPANIEN", "ES"), ("SPAIN", "ES"), ("USA", "US"), ("VEREINIGTE STAATEN", "US"),
]
CURRENCIES = ["CHF", "EUR", "USD", "GBP"]
# Descriptions by line number, as written and misspelt, with their category.
DESCRIPTIONS = [
    ("Dritte Partei Transport", "Dritte Partei Transprot", "Freight"),
    ("Benzinzuschlag", "Benzinzuschlg", "Fuel"),
    ("Surge Fee - Firmenkunden", "Surge Fe - Firmenkunden", "Surcharge"),
    ("Gebühr Zölle und Steuern", "Gebürh Abholen", "Surcharge"),
    ("Versicherung", "Versichrung", "Insurance"),
    ("Drucketikette", "Drucketikette", None),
    ("Lagerung", "Handlnig", "Storage"),
]

ORDERS = f"""select o_orderkey as k, o_custkey as ck, cast(o_custkey % 25 as int) as nk,
        cast(extract(year from o_orderdate) as int) + 28 as y, cast(extract(month from o_orderdate) as int) as m,
        cast(extract(day from o_orderdate) as int) as d, cast(round(o_totalprice * 100) as bigint) as total_cents,
        {placed('o_orderkey')}
    from {{orders}}"""

DATE = pick(
    [
        f"concat(cast(d as string), '.', {pick(texts(SHORT_MONTHS), '(m - 1)')})",
        f"concat(cast(d as string), '. ', {pick(texts(LONG_MONTHS), '(m - 1)')}, ' ', cast(y as string))",
        "concat(cast(d as string), '.', cast(m as string), '.', cast(y as string))",
        "concat(cast(y as string), '-', lpad(cast(m as string), 2, '0'), '-', lpad(cast(d as string), 2, '0'))",
    ],
    "(k % 4)",
)
TRACKING = "concat('1Z', lpad(cast(k as string), 16, '0'))"
EXTRA_TRACKING = "concat('1ZX', lpad(cast(k as string), 13, '0'))"
COUNT, WEIGHT_TENTHS = "(1 + k % 9)", "(5 + (ck * 7 + k) % 990)"
START_LINE = (
    f"concat({DATE}, ' ', {TRACKING}, ' ', {pick(texts([w for w, _ in SERVICE_WORDS]), '(k % 8)')}, ' ', "
    f"cast({COUNT} as string), ' ', {decimal(WEIGHT_TENTHS, 1)})"
)
# A pick-up on the 1st to 28th of the month of the order, or the month before.
PICKUP_DAY, PICKUP_MONTH = "(1 + ck % 28)", "(case when m > 1 and k % 2 = 0 then m - 1 else m end)"
PICKUP_LINE = (
    f"concat('Abholung ', cast({PICKUP_DAY} as string), '.', cast({PICKUP_MONTH} as string), '.', cast(y as string))"
)
PAIR_A, PAIR_B = "(10 + ck % 400)", "(10 + k % 300)"
MEASURE_LINE = pick(
    [
        f"concat('Gewicht/Container ', {decimal(PAIR_A, 1)}, '/', {decimal(PAIR_B, 1)})",
        f"concat('Lademeter ', {decimal('(k % 1400)', 2)})",
        f"concat('Volume ', {decimal('(ck % 900)', 2)})",
        "concat('Pakete: ', cast(1 + ck % 40 as string))",
        f"concat('Frachtpflichtiges Gewicht ', {decimal(PAIR_A, 1)}, ' kg')",
    ],
    "(k % 6)",
)

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXY'"
CITY1, CITY2 = f"concat('BAD ', substring({LETTERS}, nk + 1, 1))", f"concat('SANKT ', substring({LETTERS}, (nk + 3) % 25 + 1, 1))"
ZIP1, ZIP2 = "cast(10000 + ck % 80000 as string)", "cast(100000 + k % 800000 as string)"
COUNTRY1, COUNTRY2 = "(nk % 18)", "((nk + 5) % 18)"
_NAMES = texts([name for name, _ in COUNTRIES])
NAME1, NAME2 = pick(_NAMES, COUNTRY1), pick(_NAMES, COUNTRY2)
_ADDRESS1, _ADDRESS2 = f"{CITY1}, ' ', {ZIP1}, ' ', {NAME1}", f"{CITY2}, ' ', {ZIP2}, ' ', {NAME2}"

# Address lines by form (k % 6); at most seven.
ADDRESS_LINES = {
    0: [f"concat('Versender: ', {_ADDRESS1})", f"concat('Empfänger: ', {_ADDRESS2})"],
    1: [
        "'Versender:'", f"concat({CITY1}, ' ', {ZIP1})", NAME1, "'Beschreibung'",
        "'Empfänger:'", f"concat({CITY2}, ' ', {ZIP2})", NAME2,
    ],
    2: [f"concat('Versender: ', {_ADDRESS1})"],
    3: [f"concat('VERSENDER:   ', {_ADDRESS1})", "'EMPFÄNGER: 999077 HONG KONG'"],
    4: [f"concat('Versender: SINGAPORE, ', {ZIP1})", f"concat('Empfänger: TIMBUKTU ', {ZIP2}, ' NIRGENDWO')"],
    5: [
        "'Versender:'", f"concat({CITY1}, ' ', {ZIP1})", NAME1,
        "'Empfänger:'", f"concat({CITY2}, ' ', {ZIP2})", NAME2,
    ],
}
CURRENCY = pick(texts(CURRENCIES), "(nk % 4)")
HAS_TOTAL = "k % 11 <> 0"


def _address_line(nth: int) -> str:
    cases = " ".join(f"when {form} then {lines[nth]}" for form, lines in ADDRESS_LINES.items() if nth < len(lines))
    return f"(case k % 6 {cases} end)"


# Lines of an order: (place in the block, page, line, owner of the line after segmentation).
# The owner is `order`, `extra` (the additional block), `noise` or `lost`.
ORDER_LINES = [
    ("1", "page", f"concat('  ', {START_LINE})", "'order'"),
    ("2", "page", f"case when k % 5 = 0 then {PICKUP_LINE} end", "'order'"),
    ("3", "page", MEASURE_LINE, "'order'"),
    *[(str(4 + nth), "page", _address_line(nth), "'order'") for nth in range(7)],
    ("11", "page", "'Beschreibung'", "'order'"),
    ("12", "page + 1", f"case when spill = 2 then concat('Rechnung zu ', {TRACKING}) end", "'noise'"),
    ("14", "page + 1", f"case when spill = 3 then {EXTRA_TRACKING} end", "'extra'"),
    (
        "15",
        "case when spill = 0 then page else page + 2 end",
        f"case when {HAS_TOTAL} then concat('Gesamtkosten ', {CURRENCY}, ' ', {amount('total_cents')}) end",
        "case spill when 2 then 'lost' when 3 then 'extra' else 'order' end",
    ),
]

NET, BASIC = "net", "(net + disc)"
DESCRIPTION = (
    f"(case when l_returnflag = 'R' then {pick(texts([wrong for _, wrong, _ in DESCRIPTIONS]), '(l_linenumber - 1)')} "
    f"else {pick(texts([right for right, _, _ in DESCRIPTIONS]), '(l_linenumber - 1)')} end)"
)
INLINE_CURRENCY = "(l_linenumber = 2 and l_returnflag = 'A')"
COST_TEXT = (
    f"concat({DESCRIPTION}, case when {INLINE_CURRENCY} then ' eur ' else ' ' end, "
    f"case when l_linestatus = 'O' then concat({amount(BASIC)}, ' ', {amount('disc')}, ' ', {amount(NET)}) "
    f"else concat({amount(NET)}, ' ', {amount(NET)}) end)"
)
LINEITEMS = f"""select l_orderkey as k, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_quantity,
        cast(round(l_extendedprice * 100) as bigint) as net,
        cast(round(l_extendedprice * l_discount * 100) as bigint) as disc, {placed('l_orderkey')}
    from {{lineitem}}"""
COST_PAGE = "case when spill > 0 and l_linenumber >= 4 then page + 1 else page end"
COST_OWNER = "case when spill >= 2 and l_linenumber >= 4 then 'lost' else 'order' end"
# Lines with a round quantity are printed twice.
COST_COPIES = "case when l_quantity % 10 = 0 then 2 else 1 end"


def lines_sql(dialect: str) -> str:
    """All lines but page headers and footers: (k, invoice_id, page_num, pos, place, n1, n2, n3, copy, line, owner)."""
    if dialect == "spark":
        entry = "struct({}, cast({} as int), {}, {})"
        exploded = "inline(array({})) as (place, page_num, line, owner)"
        copies = "explode(sequence(1, {}))"
    else:
        entry = "struct_pack(place := {}, page_num := cast({} as int), line := {}, owner := {})"
        exploded = "unnest([{}], recursive := true)"
        copies = "unnest(range(1, 1 + {}))"
    entries = ", ".join(entry.format(*line) for line in ORDER_LINES)
    return f"""
        select k, invoice_id, page_num, pos, place, n1, n2, n3, copy, line, owner from (
            select k, invoice_id, pos, 0 as n1, cast(0 as bigint) as n2, cast(0 as bigint) as n3, 1 as copy,
                {exploded.format(entries)} from ({ORDERS}) o) l
        where line is not null
        union all
        select k, invoice_id, cast({COST_PAGE} as int) as page_num, pos, 13 as place, l_linenumber as n1,
            l_partkey as n2, l_suppkey as n3, {copies.format(COST_COPIES)} as copy,
            concat({COST_TEXT}, '{NBSP}') as line, {COST_OWNER} as owner
        from ({LINEITEMS}) c"""


# Lines of one slot, which are those of up to three pages: (page of the slot, place on it, line). One row for an order and one for a
# line item hold theirs, so that a slot's rows are few; a line that is printed twice is one entry.
_ENTRY = "'at', {}, 'pos', pos, 'place', {}, 'n1', {}, 'n2', {}, 'n3', {}, 'line', {}"


def _entry(page: str, place: str, line: str, numbers: tuple[str, str, str] = ("0", "cast(0 as bigint)", "cast(0 as bigint)")) -> str:
    # An order without a key has no page: what there is of it goes to the first, whose number is then missing.
    return f"named_struct({_ENTRY.format(f'coalesce(cast({page} - page as int), 0)', place, *numbers, line)})"


def slot_rows_sql() -> str:
    """(slot, entries): the same lines as `lines_sql` has, a row for each order and line item."""
    entries = ", ".join(_entry(page, place, line) for place, page, line, _ in ORDER_LINES)
    cost_line = f"concat({COST_TEXT}, '{NBSP}')"
    printed = f"case when {COST_COPIES} = 2 then concat(line, '\\n', line) else line end"
    cost = _entry(COST_PAGE, "13", "line", ("l_linenumber", "l_partkey", "l_suppkey"))
    return f"""
        select slot, filter(array({entries}), e -> e.line is not null) as entries from ({ORDERS}) o
        union all
        select slot, array({cost}) as entries
        from (select slot, pos, page, spill, l_linenumber, l_partkey, l_suppkey, {printed} as line
              from (select *, {cost_line} as line from ({LINEITEMS}) c) t) p"""


ROWS_PER_PART = 150_000


def rendered_pages(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """The page texts, lazily. On content pages a header comes first and a page footer last."""
    spark = orders.sparkSession
    rows = spark.sql(slot_rows_sql(), orders=orders, lineitem=lineitem)
    # As many parts as there are cores, at least: the number is also the number of files when written. It grows with the rows, so that
    # a part's rows are grouped in memory however many there are; the counts come from the files' footers.
    cores = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = max(cores, -(-(orders.count() + lineitem.count()) // ROWS_PER_PART))
    slots = spark.sql(
        "select slot, sort_array(flatten(collect_list(entries))) as entries from {rows} group by slot", rows=rows.repartition(parts, "slot")
    )
    bodies = ", ".join(
        f"case when exists(entries, e -> e.at = {at}) then array_join(transform(filter(entries, e -> e.at = {at}), e -> e.line), '\\n') end"
        for at in range(3)
    )
    text = f"""
        select invoice_id, page_num,
            concat(if(page_num % 3 = 1, concat('Rechnung ', cast(2023 + page_num % 5 as string), '\\r\\n \\n'), ''), body,
                   if(page_num % 3 = 1, concat('\\n\\n Seite ', cast(page_num as string)), '')) as text
        from (select invoice_id, cast(page + at as int) as page_num, body
              from (select {placed('(slot * 3)')}, bodies from (select slot, array({bodies}) as bodies from {{slots}}) b) s
              lateral view outer posexplode(bodies) x as at, body)
        where body is not null"""
    return as_pages(spark.sql(text, slots=slots))


_written: dict[tuple[str, str], str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only in a local session without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/") if folder else tempfile.mkdtemp(prefix="run-", dir="/tmp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered_pages(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered pages of the tables in a folder, written as a table once per session and read back.

    The table goes to the folder that the cluster names in spark.checkpoint.dir; where none is named, nothing is written
    and the pages are rendered as they are read.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        return render(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        path = f"{folder.rstrip('/')}/rendered-pages-{uuid.uuid4().hex}"
        write_table(render(spark, sf_dir), path)
        _written[key] = path
    return read_pages(spark, _written[key])
