"""Source: tables of invoice page texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

PAGE_SCHEMA = StructType(
    [
        StructField("invoice_id", StringType()),
        StructField("page_num", IntegerType()),
        StructField("text", StringType()),
    ]
)


def as_pages(df: DataFrame) -> DataFrame:
    """Page table of a DataFrame: a missing text or invoice becomes empty, every line break a line feed. So pages
    without an invoice are one invoice, and no later join loses them. A page without a number is an error: a table has no
    order to number it by, and two pages of one number would be taken for one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    number = F.col("page_num").cast("int")
    missing = F.raise_error(F.concat(F.lit("a page without a number, of invoice "), F.coalesce(F.col("invoice_id").cast("string"), F.lit("''")))).cast("int")
    return df.select(
        F.coalesce(F.col("invoice_id").cast("string"), F.lit("")).alias("invoice_id"),
        F.coalesce(number, missing).alias("page_num"),
        # Most texts have no such break: a search is cheaper than a pattern.
        F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, "\r\n?", "\n")).otherwise(text).alias("text"),
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows of text files, numbered from 1 within each file: (path, number, value).

    A long file is read by many tasks, each a part of it. A row's place in its part comes from the id that Spark counts up in a
    partition, and the parts of a file are numbered on by the counts of those before them, a row each. Only these counts
    are sorted: no file has to fit into a task.
    """
    part = ["path", "start"]
    placed = rows.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"), "value",
    )
    parts = placed.groupBy(*part).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(*part, "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    joined = placed.join(offsets, part)
    return joined.select("path", (F.col("offset") + F.col("id") - F.col("first") + 1).alias("number"), "value")


def read_pages(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Read page texts: pages(invoice_id string, page_num int, text string), page numbers from 1.

    `parquet`, `orc`, `json` and `csv` hold the three columns; (invoice_id, page_num) is a key. A CSV file is read by one task, as its
    quoted texts hold line breaks: split large ones.
    `text` reads one text file per invoice, its pages separated by form feeds (one at the end closes the last page); the invoice is
    the file name without `.pdf` and without the extension of the text file. A file of any size is read by many tasks; it must not be compressed for that.
    """
    if format == "text":
        pages = _numbered(spark.read.text(path, lineSep="\f"))
        name = F.regexp_replace(F.regexp_extract("path", "[^/]+$", 0), r"\.txt$", "")
        # File paths are percent-encoded, but a plus sign in them is a plus sign.
        decoded = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
        invoice = F.replace(decoded, F.lit(".pdf"), F.lit(""))
        return as_pages(pages.select(invoice.alias("invoice_id"), F.col("number").alias("page_num"), F.col("value").alias("text")))
    reader = spark.read.schema(PAGE_SCHEMA)
    if format == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    return as_pages(reader.format(format).load(path))
