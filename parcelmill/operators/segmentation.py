"""Segmentation of page texts into shipment blocks.

A line with a tracking number starts a block, noise lines are dropped, and a block runs on to the pages
that follow until one of them holds a tracking number anywhere. A block is therefore known from its own
page, except that the last block of a page may be continued by the pages after it. The plan follows this:

* a page with a tracking number is cut into its blocks where it is read, whatever its invoice;
* pages without one look up the last page before them that has one ("home"), over page flags only, in chunks
  of page numbers, so that one very long invoice spreads over many tasks;
* their lines are gathered per home page and joined to its last block. The join key (invoice_id, page_num)
  is unique, so no invoice is a hot key, and Spark broadcasts the gathered lines by itself where they are few.

Only the lines of one block ever meet in one task: a block is one record, and its text one cell.

The key of a block is (invoice_id, invoice_page, page_block): the page of its start line and its ordinal
among the blocks that start there. It sorts in document order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelmill.functions import patterns as p
from parcelmill.operators.pages import has_tracking, is_noise, page_facts, started, tracked

BLOCK_KEY = ["invoice_id", "invoice_page", "page_block"]

_NEXT_START = rf"\n(?=(?d:.*){p.TRACKING})"
_STARTS_HERE = rf"^(?d:.*){p.TRACKING}"


def _kept_text(text: Column) -> Column:
    # The case of the whole text is folded at once: no line break comes or goes with it.
    lines = F.zip_with(
        F.split(text, "\n"),
        F.split(p.fold_case(text), "\n"),
        lambda line, low: F.struct(p.strip(line).alias("line"), low.alias("low")),
    )
    return F.array_join(F.filter(lines, lambda one: (one["line"] != "") & ~is_noise(one["low"]))["line"], "\n")


def _started_blocks(pages: DataFrame) -> DataFrame:
    """Pages with a tracking number: the texts of the blocks that start there, in order."""
    cut = pages.filter(has_tracking(F.col("text"))).withColumn("cut", F.split(_kept_text(F.col("text")), _NEXT_START))
    started = F.filter("cut", lambda part: F.rlike(part, F.lit(_STARTS_HERE)))
    return cut.select("invoice_id", "page_num", started.alias("started"))


def _continuations(pages: DataFrame) -> DataFrame:
    """(invoice_id, page_num, home_page, home_starts): the pages without a tracking number after one with one, and
    whether a block starts on that one."""
    facts = F.col("facts")
    # Both uses of the flags below, and that of the invoice year, read one exchange: the texts are scanned for them once.
    flags = page_facts(pages).select("invoice_id", "page_num", "page_chunk", tracked(facts).alias("has_tracking"), started(facts).alias("has_start"))
    tracking_page = F.when(F.col("has_tracking"), F.struct("page_num", "has_start"))
    in_chunk = Window.partitionBy("invoice_id", "page_chunk").orderBy("page_num").rowsBetween(Window.unboundedPreceding, 0)
    near = flags.withColumn("near_home", F.last(tracking_page, ignorenulls=True).over(in_chunk))

    chunks = flags.groupBy("invoice_id", "page_chunk").agg(F.max(tracking_page).alias("chunk_last"))
    before = Window.partitionBy("invoice_id").orderBy("page_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.select("invoice_id", "page_chunk", F.max("chunk_last").over(before).alias("far_home"))

    homed = near.filter(~F.col("has_tracking")).join(carried, ["invoice_id", "page_chunk"])
    home = F.coalesce("near_home", "far_home")
    homed = homed.select("invoice_id", "page_num", home.alias("home")).filter("home is not null")
    return homed.select("invoice_id", "page_num", F.col("home.page_num").alias("home_page"), F.col("home.has_start").alias("home_starts"))


def continuation_pages(pages: DataFrame) -> DataFrame:
    """(invoice_id, page_num, home_page) of the pages without a tracking number after one with one."""
    return _continuations(pages).drop("home_starts")


def _tails(pages: DataFrame) -> DataFrame:
    """(invoice_id, page_num, tail): what the pages after a home page add to its last block."""
    continued = pages.filter(~has_tracking(F.col("text"))).select(
        "invoice_id", "page_num", _kept_text(F.col("text")).alias("text")
    )
    # What follows a page on which no block starts belongs to none: its texts are not moved.
    wanted = _continuations(pages).filter("home_starts").drop("home_starts")
    parts = continued.join(wanted, ["invoice_id", "page_num"]).groupBy("invoice_id", "home_page")
    joined = parts.agg(F.sort_array(F.collect_list(F.struct("page_num", "text")))["text"].alias("texts"))
    tail = F.array_join(F.array_remove("texts", ""), "\n")
    return joined.select("invoice_id", F.col("home_page").alias("page_num"), tail.alias("tail"))


def segment(pages: DataFrame) -> DataFrame:
    """Shipment blocks: (invoice_id, invoice_page, page_block, text), lines joined by a line feed."""
    joined = _started_blocks(pages).join(_tails(pages), ["invoice_id", "page_num"], "left")
    but_last = F.slice("started", F.lit(1), F.size("started") - 1)
    continued = F.concat(but_last, F.array(F.concat(F.element_at("started", -1), F.lit("\n"), "tail")))
    whole = F.when((F.size("started") > 0) & (F.col("tail") != ""), continued).otherwise(F.col("started"))
    rows = p.rows_of(joined.select("invoice_id", "page_num", F.posexplode_outer(whole).alias("pos", "text")))
    return rows.select("invoice_id", F.col("page_num").alias("invoice_page"), (F.col("pos") + 1).alias("page_block"), "text")
