"""SQL oracles: what the queries must return, computed from the driver tables by DuckDB.

All but `page_lines`, `blocks` and `render_pages` compute fields from keys, dates and prices and never look at
the rendered text; the document queries read `documents` with patterns of their own.
"""

from __future__ import annotations

import os

from invoicebench import rendering as r
from invoicebench.queries import COUNTRY_SPELLINGS, MISSPELT_SERVICES
from invoicebench.rendering import decimal, pick, texts
from parcelmill.functions.registry import ISO_CODES, read_registry

_ORDERS = r.ORDERS.format(orders="orders")
_LINEITEMS = r.LINEITEMS.format(lineitem="lineitem")
_LINES = r.lines_sql("duckdb").format(orders="orders", lineitem="lineitem")

# Blocks: one per order, and the additional ones of spill 3.
_BLOCKS = f"""
    o as ({_ORDERS}),
    years as (select invoice_id, arg_min({r.PAGE_YEAR}, page) as iy from o group by 1),
    b as (
        select *, page as invoice_page, cast(row_number() over (partition by slot order by k) as int) as page_block,
            false as extra from o
        union all select *, page + 1, 1, true from o where spill = 3)"""
_KEY = "invoice_id, cast(invoice_page as int) as invoice_page, page_block"

_IDENTIFIER = f"case when extra then {r.EXTRA_TRACKING} else {r.TRACKING} end"


def _date(y: str, m: str, d: str) -> str:
    return f"try_cast(concat({y}, '-', lpad(cast({m} as string), 2, '0'), '-', lpad(cast({d} as string), 2, '0')) as date)"


_TEXT_DATE = _date("case when k % 4 = 0 then iy else y end", "m", "d")
_PICKUP_DATE = _date("y", r.PICKUP_MONTH, r.PICKUP_DAY)
_SHIPMENT_DATE = f"""case when not extra then
    cast(least({_TEXT_DATE}, case when k % 5 = 0 then {_PICKUP_DATE} end) as string) end"""

_SERVICE = f"case when not extra then {pick(texts([s for _, s in r.SERVICE_WORDS]), '(k % 8)')} end"

_CODES = [code for _, code in r.COUNTRIES]
_CODE1, _CODE2 = pick(texts(_CODES), r.COUNTRY1), pick(texts(_CODES), r.COUNTRY2)
# Place of a country spelling in the alias order: of two countries in one address the smaller one counts.
_ALIAS_ORDER = ["0", "1", "2", "3", "4", "6", "8", "9", "10", "11", "12", "13", "14", "15", "16", "17", "18", "19"]
_ORDER1, _ORDER2 = pick(_ALIAS_ORDER, r.COUNTRY1), pick(_ALIAS_ORDER, r.COUNTRY2)
_SWALLOWED = f"""trim(regexp_replace(replace(concat({r.CITY1}, ' ', {r.ZIP1}, '  Empfänger ', {r.CITY2}, ' ', {r.ZIP2}, ' '),
    {r.ZIP1}, ''), ' +', ' ', 'g'))"""
_PLACE = {
    "origin_country": f"case k % 6 when 4 then 'SG' when 5 then (case when {_ORDER1} <= {_ORDER2} then {_CODE1} else {_CODE2} end) else {_CODE1} end",
    "origin_city": f"case k % 6 when 4 then 'SINGAPORE' when 5 then {_SWALLOWED} else {r.CITY1} end",
    "origin_zipcode": r.ZIP1,
    "destination_country": f"case k % 6 when 2 then null when 3 then 'HK' when 4 then null else {_CODE2} end",
    "destination_city": f"case k % 6 when 2 then null when 3 then 'HONG KONG' when 4 then 'TIMBUKTU NIRGENDWO' else {r.CITY2} end",
    "destination_zipcode": f"case k % 6 when 2 then null when 3 then '999077' else {r.ZIP2} end",
}
_A, _B = f"{r.PAIR_A} / 10.0", f"{r.PAIR_B} / 10.0"
_WEIGHTS = {
    "gross_weight": f"cast(case when k % 6 = 0 then least({_A}, {_B}) else {r.WEIGHT_TENTHS} / 10.0 end as double)",
    "chargeable_weight": f"cast(case k % 6 when 0 then greatest({_A}, {_B}) when 4 then {_A} end as double)",
    "loading_meter": "cast(case when k % 6 = 1 then (k % 1400) / 100.0 end as double)",
    "cubic_meter": "cast(case when k % 6 = 2 then (ck % 900) / 100.0 end as double)",
    "pallet_amount": f"case when k % 6 = 3 then 1 + ck % 40 else {r.COUNT} end",
}


def _unless_extra(columns: dict[str, str]) -> str:
    return ", ".join(f"case when not extra then {value} end as {name}" for name, value in columns.items())


def _category(known: bool) -> str:
    """Category of a lineitem; what has none keeps its description, or is null if only known ones count."""
    def one(nth, text, category):
        category = "Handling" if text == "Handlnig" else category
        return "null" if category is None and known else f"'{category or text}'"

    right = [one(n, text, category) for n, (text, _, category) in enumerate(r.DESCRIPTIONS)]
    wrong = [one(n, text, category) for n, (_, text, category) in enumerate(r.DESCRIPTIONS)]
    return (
        f"(case when l_returnflag = 'R' then {pick(wrong, '(l_linenumber - 1)')} "
        f"else {pick(right, '(l_linenumber - 1)')} end)"
    )


# Cost rows that belong to a block, in line order, with the currency of the line or the block.
_COSTS = f"""
    {_BLOCKS},
    l as (select *, unnest(range(1, 1 + {r.COST_COPIES})) as copy, {_category(False)} as extracted_category,
        {r.COST_TEXT} as mention from ({_LINEITEMS}) where {r.COST_OWNER} = 'order'),
    rows_ as (
        select b.invoice_id, cast(b.invoice_page as int) as invoice_page, b.page_block, b.k,
            cast(row_number() over (partition by b.k order by l_linenumber, l_partkey, l_suppkey, mention, copy) as int) as ord,
            extracted_category, net, net / 100.0 as total_cost_in_shipment_currency,
            case when {r.INLINE_CURRENCY} then 'EUR' when b.k % 11 <> 0 and b.spill < 2 then {r.CURRENCY} end as currency,
            mention
        from b join l on b.k = l.k where not b.extra),
    firsts as (
        select invoice_id, invoice_page, page_block, k, extracted_category, net, total_cost_in_shipment_currency, currency,
            arg_min(mention, ord) as mention, min(ord) as ord from rows_ group by all),
    items as (select * exclude (ord), cast(row_number() over (partition by k order by ord) as int) as item_no from firsts)"""
_ITEM = "extracted_category, total_cost_in_shipment_currency, currency, mention"

_RECORDS = f"""
    {_COSTS},
    per_block as (
        select k as bk, arg_max(currency, item_no) filter (where currency is not null) as currency_shipment,
            cast(count(*) as int) as n_items, cast(sum(net) as bigint) as net_cents,
            string_agg(mention, '|' order by item_no) as mentions,
            list(struct_pack(extracted_category := extracted_category,
                 total_cost_in_shipment_currency := total_cost_in_shipment_currency, currency := currency,
                 mention := mention) order by item_no) as cost_items
        from items group by k),
    records as (
        select b.invoice_id, page_block, {_IDENTIFIER} as identifier, cast(invoice_page as int) as invoice_page,
            {_SHIPMENT_DATE} as shipment_date, {_SERVICE} as shipment_type,
            case when not extra then currency_shipment end as currency_shipment,
            {_unless_extra(_PLACE)}, {_unless_extra(_WEIGHTS)},
            case when extra then 0 else coalesce(n_items, 0) end as n_items,
            case when extra then 0 else coalesce(net_cents, 0) end as net_cents,
            case when extra then '' else coalesce(mentions, '') end as mentions,
            case when extra or n_items is null then [] else cost_items end as cost_items
        from b join years on b.invoice_id = years.invoice_id left join per_block on b.k = bk)"""

_JSON_FIELDS = [
    "identifier", "invoice_page", "shipment_date", "shipment_type", "currency_shipment",
    *_PLACE, *_WEIGHTS, "cost_items",
]

# Lines with their text as the operators see it, header and footer lines included.
_PAGES = f"""
    l as (select * from ({_LINES})),
    sheets as (select distinct invoice_id, page_num from l),
    all_lines as (
        select invoice_id, page_num, pos, place, n1, n2, n3, copy, trim(rtrim(line, '{r.NBSP}')) as line, owner, k from l
        union all select invoice_id, page_num, -1, 0, 0, 0, 0, 1, concat('Rechnung ', 2023 + page_num % 5), 'noise', null
            from sheets where page_num % 3 = 1
        union all select invoice_id, page_num, 9, 0, 0, 0, 0, 1, concat('Seite ', page_num), 'noise', null
            from sheets where page_num % 3 = 1)"""
_LINE_ORDER = "pos, place, n1, n2, n3, line, copy"

# Documents: Unicode-aware words, as the patterns of DuckDB see ASCII boundaries only.
_BLANK = r"[\t\v\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_WORD, _NO_WORD = r"[\p{L}\p{N}_]+", r"[^\p{L}\p{N}_]"
_IMPLAUSIBLE = r"^([0-9]{1,9}$|000|.*(PKG|PACKAGE))"


def _generic_tokens(text: str) -> str:
    words = f"regexp_extract_all(translate({text}, 'OoIl', '0011'), '{_WORD}')"
    return (
        f"list_filter({words}, lambda w: regexp_full_match(w, '[A-Z0-9]{{8,25}}') "
        f"and not regexp_matches(w, '{_IMPLAUSIBLE}'))"
    )


_KEYWORDS = "paketnummer|frachtbrief|tracking|waybill|awb|referenz|sendung|shipment|consignment"
_LINE_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_TENTHS = "(l_partkey % 5000) / 10.0"
_PAIR = "(l_partkey % 900) / 10.0, (l_suppkey % 70) / 10.0"
_TRACKED = "1Z[0-9A-Z]{8,18}"

ORACLE = {
    "render_pages": f"""with {_PAGES},
        parts as (select invoice_id, page_num, string_agg(raw, chr(10) order by {_LINE_ORDER}) as body
            from (select *, line as raw from l) group by all)
        select invoice_id, page_num, concat(case when page_num % 3 = 1 then concat('Rechnung ', 2023 + page_num % 5,
            chr(10), ' ', chr(10)) else '' end, body,
            case when page_num % 3 = 1 then concat(chr(10), chr(10), ' Seite ', page_num) else '' end) as text from parts""",
    "page_lines": f"""with {_PAGES} select invoice_id, page_num,
        cast(row_number() over (partition by invoice_id, page_num order by {_LINE_ORDER}) as int) as line_no, line from all_lines""",
    "noise_lines": f"""with {_PAGES} select invoice_id, page_num, count(*) filter (where owner = 'noise') as noise_lines,
        count(*) filter (where place = 14 or (place = 1 and pos >= 0)) as start_lines from all_lines group by 1, 2""",
    "page_has_tracking": f"""with {_PAGES} select invoice_id, page_num,
        bool_or(place in (12, 14) or (place = 1 and pos >= 0)) as has_tracking from all_lines group by 1, 2""",
    "page_homes": f"""with {_PAGES},
        flags as (select invoice_id, page_num, bool_or(place in (12, 14) or (place = 1 and pos >= 0)) as tracked
            from all_lines group by 1, 2),
        homes as (select *, max(case when tracked then page_num end) over (partition by invoice_id order by page_num) as home_page
            from flags)
        select invoice_id, page_num, home_page from homes where not tracked and home_page is not null""",
    "blocks": f"""with {_BLOCKS}, {_PAGES},
        kept as (select k, owner = 'extra' as extra, cast(count(*) as bigint) as n_lines,
            string_agg(line, chr(10) order by page_num, {_LINE_ORDER}) as text
            from all_lines where owner in ('order', 'extra') group by 1, 2)
        select {_KEY}, cast(n_lines as int) as n_lines, text from b join kept using (k, extra)""",
    "identifiers_strict": f"with {_BLOCKS} select {_KEY}, {_IDENTIFIER} as identifier from b",
    "identifiers_distorted": f"""select o_orderkey, {pick([
        "concat('1Z', lpad(cast(o_orderkey as string), 16, '0'))",
        "concat('1Z', lpad(cast(o_orderkey as string), 16, '0'))",
        "concat('1Z', lpad(cast(o_orderkey as string), 16, '0'))",
        "concat('AB', lpad(cast(o_orderkey as string), 10, '0'))",
        "concat('X', lpad(cast(o_orderkey as string), 9, '0'))",
        "null",
    ], '(o_orderkey % 6)')} as identifier from orders where o_orderkey % 6 <> 5""",
    "identifiers_generic": f"""with words as (
            select doc_id, text, regexp_extract_all(text, '{_WORD}') as raw,
                regexp_extract_all(translate(text, 'OoIl', '0011'), '{_WORD}') as folded,
                list_filter(string_split(text, chr(10)), lambda l: regexp_matches(lower(l), '{_KEYWORDS}')) as announced
            from documents),
        tiers as (select doc_id, coalesce(
            list_filter(raw, lambda w: regexp_full_match(w, '1Z[0-9A-Z]{{8,20}}'))[1],
            list_filter(folded, lambda w: regexp_full_match(w, '[1Iil][Zz][0-9A-Z]{{8,20}}'))[1],
            flatten(list_transform(announced, lambda l: {_generic_tokens('l')}))[1],
            {_generic_tokens('text')}[1]) as token from words)
        select doc_id, upper(regexp_replace(token, '^[Iil]', '1')) as identifier from tiers where token is not null""",
    "document_lines": f"""with parts as (
            select source, doc_id, list_filter(list_transform(string_split(text, chr(10)),
                lambda l: regexp_replace(regexp_replace(l, '^{_BLANK}+', ''), '{_BLANK}+$', '')), lambda l: l <> '') as lines
            from documents),
        numbered as (select source, doc_id, unnest(range(1, 1 + len(lines))) as line_no, unnest(lines) as line from parts),
        flagged as (select *, regexp_matches(line,
            '(?i)rechnung|invoice|ups|kunden-nr|lieferant|dachser|(seite|page)({_BLANK}|\\n)+[0-9]') as is_noise from numbered)
        select source, doc_id, cast(line_no as int) as line_no, line, is_noise,
            not is_noise and regexp_matches(line, '(^|{_NO_WORD}){_TRACKED}($|{_NO_WORD})') as is_start from flagged""",
    "document_years": f"""with found as (select source, doc_id,
            nullif(regexp_extract(text, '(^|{_NO_WORD})(20[0-9]{{2}})($|{_NO_WORD})', 2), '') as y from documents)
        select source, cast(arg_min(y, doc_id) filter (where y is not null) as int) as first_year from found group by 1""",
    "invoice_year": f"with {_BLOCKS} select invoice_id, cast(iy as int) as invoice_year from years",
    "invoice_chunk_year": f"""with {_BLOCKS}, {_PAGES} select distinct invoice_id, cast(floor(page_num / 4096) as int) as page_chunk,
        cast(iy as int) as invoice_year from sheets join years using (invoice_id)""",
    "dates_textual": f"""with {_BLOCKS} select {_KEY}, cast({_TEXT_DATE} as string) as date from b join years using (invoice_id)
        where not extra and k % 4 < 2 and {_TEXT_DATE} is not null""",
    "dates_numeric": f"""with {_BLOCKS} select {_KEY}, cast({_TEXT_DATE} as string) as date from b join years using (invoice_id)
        where not extra and k % 4 >= 2
        union all select {_KEY}, cast({_PICKUP_DATE} as string) as date from b where not extra and k % 5 = 0""",
    "shipment_date": f"with {_BLOCKS} select {_KEY}, {_SHIPMENT_DATE} as shipment_date from b join years using (invoice_id)",
    "service_pattern": f"with {_BLOCKS} select {_KEY}, {_SERVICE} as shipment_type from b",
    "service_fuzzy": f"""select o_orderkey, {pick(['null' if right is None else f"'{right}'" for _, right in MISSPELT_SERVICES],
        '(o_orderkey % 9)')} as shipment_type from orders""",
    "locations": f"with {_BLOCKS} select {_KEY}, {_unless_extra(_PLACE)} from b",
    "weights": f"with {_BLOCKS} select {_KEY}, {_unless_extra(_WEIGHTS)} from b",
    "weights_keywords": f"""select {_LINE_KEY}, l_quantity, case when l_linenumber % 3 = 0 then 99.0 else {_TENTHS} end as gross_weight,
        {_TENTHS} as chargeable_weight, l_suppkey / 100.0 as loading_meter, cast(3 as double) as cubic_meter,
        cast(l_quantity as bigint) as pallet_amount from lineitem""",
    "weights_pair": f"""select {_LINE_KEY}, least({_PAIR}) as gross_weight, greatest({_PAIR}) as chargeable_weight from lineitem""",
    "cost_rows": f"with {_COSTS} select invoice_id, invoice_page, page_block, ord, {_ITEM} from rows_",
    "cost_items": f"with {_COSTS} select invoice_id, invoice_page, page_block, item_no, {_ITEM} from items",
    "cost_currency": f"with {_RECORDS} select invoice_id, invoice_page, page_block, currency_shipment from records",
    "cost_categories": f"select {_LINE_KEY}, {r.DESCRIPTION} as description, {_category(True)} as category from lineitem",
    "dictionary_table": f"select {_LINE_KEY}, {r.DESCRIPTION} as description, {_category(True)} as category from lineitem",
    "dictionary_parts": f"""select {_LINE_KEY}, case when l_linenumber % 3 < 2 then cast(l_partkey as string) end as part
        from lineitem join part on l_partkey = p_partkey""",
    "shipment_net": f"""with {_COSTS}, net as (select k, cast(sum(net) as bigint) as net_cents from rows_ group by k)
        select {_KEY}, {_IDENTIFIER} as identifier, case when extra then 0 else coalesce(net_cents, 0) end as net_cents
        from b left join net using (k)""",
    "normalize_numbers": f"""select {_LINE_KEY},
        case when l_linenumber <> 1 then round(l_extendedprice * 100) / 100.0 end as gross_weight,
        l_quantity as chargeable_weight, case when l_linenumber <> 2 then l_quantity * 100 end as loading_meter,
        l_tax as cubic_meter, case when l_linenumber % 2 = 1 then l_partkey end as pallet_amount from lineitem""",
    "normalize_strings": """select o_orderkey, case when o_orderkey % 3 <> 0 then o_orderpriority end as shipment_type,
        case when o_orderkey % 2 = 1 then o_orderstatus end as currency_shipment,
        lpad(cast(o_custkey as string), 7, '0') as origin_zipcode, o_orderpriority as extracted_category,
        o_totalprice as total_cost_in_shipment_currency, cast(null as string) as currency, o_orderstatus as mention from orders""",
    "normalize_countries": "select o_orderkey, {} as origin_country, {} as destination_country from orders".format(
        *[pick(["null" if c is None else f"'{c}'" for _, c in COUNTRY_SPELLINGS], f"({key} % 10)")
          for key in ("o_orderkey", "o_custkey")]
    ),
    "normalize_dates": """select o_orderkey, case when o_orderkey % 8 < 6 then cast(cast(o_orderdate as date) as string) end
        as shipment_date from orders""",
    "normalize_spelt_dates": "select o_orderkey, cast(cast(o_orderdate as date) as string) as shipment_date from orders",
    "shipments": f"with {_RECORDS} select * exclude (cost_items) from records",
    "shipments_json_files": f"""with {_RECORDS} select replace(invoice_id, '.pdf', '') || '_extracted.json' as document, identifier, invoice_page,
        shipment_date, origin_country, pallet_amount, mentions from records""",
    "normalize_rejects": """with lost as (
            select o_orderkey, 'gross_weight' as field, null as item, case o_orderkey % 5 when 0 then concat(o_custkey, ' kg') when 3 then '1.2.3' end as value from orders
            union all select o_orderkey, 'pallet_amount', null, case when o_orderkey % 3 = 0 then concat(o_custkey, '.5') end from orders
            union all select o_orderkey, 'shipment_date', null, case o_orderkey % 4 when 0 then concat('31.02.', 2000 + o_custkey % 20) when 1 then 'soon' end from orders
            union all select o_orderkey, 'origin_country', null, case when o_orderkey % 2 <> 0 then concat('Land ', o_custkey) end from orders
            union all select o_orderkey, 'total_cost_in_shipment_currency', 2, case when o_orderkey % 7 = 0 then concat(o_custkey, ' EUR') end from orders)
        select o_orderkey, field, cast(item as int) as item, value from lost where value is not null""",
    "shipments_json": f"""with {_RECORDS},
        ranked as (select *, row_number() over (partition by invoice_id order by invoice_page, page_block) as nth,
            count(*) over (partition by invoice_id) as n from records)
        select invoice_id, invoice_page, page_block, concat(case when nth = 1 then '[' else ',' end,
            cast(to_json(struct_pack({', '.join(f'{name} := {name}' for name in _JSON_FIELDS)})) as string),
            case when nth = n then ']' else '' end) as line from ranked""",
}

if os.path.exists(ISO_CODES):
    _known = ", ".join(f"({i}, {j}, '{c.alpha_2}')" for i, c in enumerate(read_registry(ISO_CODES)) for j, value in enumerate(c) if value)
    ORACLE["normalize_registry"] = f"""with known as (select * from (values {_known}) as v(i, field, code))
        select o_orderkey, code as origin_country
        from orders left join known on o_orderkey % {len(read_registry(ISO_CODES))} = i and o_custkey % 6 = field"""

ORACLE["shipments_json_packed"] = ORACLE["shipments_json_files"]
