"""Page-level operators: lines, tracking flag, invoice year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelmill.functions import patterns as p
from parcelmill.functions.dictionaries import HEADER_WORDS

# Page footers, in lower case.
FOOTER = rf"(?:seite|page){p.BLANK}+[0-9]"
YEAR = rf"{p.word_start('20')}(20[0-9]{{2}}){p.NOT_BEFORE_WORD}"

# Pages of an invoice are handled in chunks of this many page numbers, so that an invoice of any length
# spreads over many tasks: a window over the pages of a chunk holds at most this many rows, and a window
# over the chunks of an invoice at most 2^31 / 4096 = 524,288 small ones (page_num is an int).
PAGES_PER_CHUNK = 4096


def chunk_of(page_num: Column) -> Column:
    return F.floor(page_num / PAGES_PER_CHUNK).cast("int")


def has_tracking(text: Column) -> Column:
    """Whether a text holds a tracking number anywhere, in noise lines too."""
    return F.contains(text, F.lit("1Z")) & F.rlike(text, F.lit(p.TRACKING))


def is_noise(low: Column) -> Column:
    """Whether a line, given in folded case, is a page header or footer."""
    header = p.contains_any(low, [word.lower() for word in HEADER_WORDS])
    return header | (p.contains_any(low, ["seite", "page"]) & F.rlike(low, F.lit(FOOTER)))


def page_lines(pages: DataFrame) -> DataFrame:
    """Trimmed non-blank lines of every page, numbered from 1, with their noise and start flags."""
    lines = p.lines_of(F.col("text"))
    exploded = p.rows_of(pages.select("invoice_id", "page_num", F.posexplode_outer(lines).alias("pos", "line")))
    noise = is_noise(p.fold_case(F.col("line")))
    return exploded.select(
        "invoice_id",
        "page_num",
        (F.col("pos") + 1).alias("line_no"),
        "line",
        noise.alias("is_noise"),
        (~noise & has_tracking(F.col("line"))).alias("is_start"),
    )


def has_start(text: Column) -> Column:
    """Whether a block starts in a text: a tracking number on a line that is no noise."""
    marked = F.filter(F.split(text, "\n"), lambda line: F.contains(line, F.lit("1Z")))
    # A text without a number is not split.
    return F.contains(text, F.lit("1Z")) & F.exists(marked, lambda line: has_tracking(line) & ~is_noise(p.fold_case(line)))


def page_tracking(pages: DataFrame) -> DataFrame:
    """(invoice_id, page_num, has_tracking, has_start) per page."""
    text = F.col("text")
    return pages.select("invoice_id", "page_num", has_tracking(text).alias("has_tracking"), has_start(text).alias("has_start"))


def page_facts(pages: DataFrame) -> DataFrame:
    """(invoice_id, page_num, page_chunk, facts): what the other pages of an invoice need to know of a page, dealt by chunk.

    All facts come from one look at the text and are one number, read by `tracked`, `started` and `year_of`: whatever a plan
    asks of them, it asks for the same columns, so that all its uses share this scan and this exchange.
    """
    text = F.col("text")
    year = F.coalesce(p.found(text, YEAR).cast("int"), F.lit(0))
    facts = year * 4 + has_tracking(text).cast("int") * 2 + has_start(text).cast("int")
    keyed = pages.select("invoice_id", "page_num", chunk_of(F.col("page_num")).alias("page_chunk"), facts.alias("facts"))
    # The filter is the one that the joins would add to some of the uses.
    return keyed.filter("invoice_id is not null and page_chunk is not null").repartition("invoice_id", "page_chunk")


def tracked(facts: Column) -> Column:
    return facts.bitwiseAND(2) != 0


def started(facts: Column) -> Column:
    return facts.bitwiseAND(1) != 0


def year_of(facts: Column) -> Column:
    return F.when(facts >= 4, F.floor(facts / 4).cast("int"))


def _year_and_page(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min_by("year", F.when(F.col("year").isNotNull(), F.col("page_num"))).alias("year"),
        F.min(F.when(F.col("year").isNotNull(), F.col("page_num"))).alias("page_num"),
    )


def _page_years(pages: DataFrame) -> DataFrame:
    year = p.found(F.col("text"), YEAR).cast("int")
    return pages.select("invoice_id", "page_num", year.alias("year"))


def invoice_year(pages: DataFrame) -> DataFrame:
    """First year 20xx of every invoice, lowest page first; null where no page has one."""
    years = _year_and_page(_page_years(pages), "invoice_id")
    return years.select("invoice_id", F.col("year").alias("invoice_year"))


def chunk_year(pages: DataFrame) -> DataFrame:
    """The invoice year per (invoice_id, page_chunk): a join key that no single invoice overloads."""
    keyed = page_facts(pages).select("invoice_id", "page_num", "page_chunk", year_of(F.col("facts")).alias("year"))
    per_chunk = _year_and_page(keyed, "invoice_id", "page_chunk")
    first_page = F.when(F.col("year").isNotNull(), F.col("page_num"))
    year = F.min_by("year", first_page).over(Window.partitionBy("invoice_id"))
    return per_chunk.select("invoice_id", "page_chunk", year.alias("invoice_year"))
