"""The registered queries of the operators: production parameters, whole tables, the columns of the contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parcelmill.llm import align, decontam, fagin, harmonic, html_text, langid, mih, minhash, packing, pii, suffix_dedup, url_filter, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie in a window of the benchmark, and the items of these windows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.hits(docs, table(spark, sf_dir, "benchmark")).withColumn("n_hit", decontam.n_hit())
    items = F.array_join(F.sort_array(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@_query
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near-duplicates that each document belongs to, by shingles of four words."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), k=4)
    return found.select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


@_query
def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document that lie in a 100-byte string which also starts earlier."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


def _of_kind(kind: str) -> Column:
    """How many of the spans found are of a kind."""
    return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")


@_query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in each document."""
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("found", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "row.doc_id",
        *[_of_kind(kind).alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.col("found")).alias("spans"),
    )


@_query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of all pages, written into archives and read back."""
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    whole = F.when(F.col("intact"), F.col("payload_bytes")).otherwise(F.raise_error(F.lit("a record is damaged")))
    return found.select(F.col("page").alias("page_id"), whole.alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


@_query
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page."""
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select("row.page_id", "row.url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


URL_RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
]


@_query
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on the URL of each page."""
    found = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return found.select("row.page_id", "host", "path", "rule", "verdict", F.round("score", 9).alias("score"))


@_query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bins of all documents; copies of a text and documents of one source never share one."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@_query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each page, from its main text, declared language, address and host."""
    model = langid.fit(table(spark, sf_dir, "documents"))
    pages = html_text.extract(table(spark, sf_dir, "pages"))
    tag = F.regexp_extract("row.html", r"(?i)<html\b([^>]*+)", 1)  # of the first one, so nothing is tried again
    declared = F.regexp_extract(tag, r"(?i)\slang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    host, _ = url_filter.host_and_path(F.col("row.url"))
    found = langid.identify(pages, model, F.col("row.page_id"), F.col("main_text"), declared, host)
    return found.select(F.col("key").alias("page_id"), "lang", "confidence", "text_lang", "n_trigrams")


@_query
def op2_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return mih.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def tokenizer_file(name: str) -> str:
    """A public tokenizer's file, at the same place on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op11_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4,096 tokens."""
    found = harmonic.pack_tokens(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return found.select(
        F.col("document").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@_query
def op12_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five positives of every fiftieth vector."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return fagin.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


@_query
def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of each document by two tokenizers, aligned, and how common its links are."""
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    found = align.links(table(spark, sf_dir, "documents"), *files, keep={"groups_sha256": digest})
    return found.withColumnRenamed("document", "doc_id").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
