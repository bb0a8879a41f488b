"""Language identification by Bayesian fusion of evidence.

The posterior of a language is the product of
- the likelihood of the text under a naive Bayes model over hashed letter trigrams, counted as `EFFECTIVE` trigrams at
  most, since neighbouring ones are not independent;
- the chance of the declared language (of the markup, or of a column) and of the address suffix given the language;
- the prior of the host: the languages that its texts alone suggest, smoothed towards those of its parent domain, and
  these towards all texts.
The last three are grouped aggregates over all rows. Besides the languages there is `und`, text that fits no model: all
trigrams are equally likely. The text models are fitted on about `SAMPLE` labelled rows of each language. A label or declared
language counts by its first part, so `en-GB` is `en`; all that occur get a model. What is held and broadcast grows with their
number (64 KB each), not with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from parcelmill.llm import bytetext
from parcelmill.llm.scratch import stored

SAMPLE = 2000  # labelled rows a language that the text model is fitted on
BITS = 14
EFFECTIVE = 30
UNDETERMINED = "und"
UND_PRIOR = 0.01
FOREIGN = 0.1  # share of names, numbers and keys in a text of any language: their trigrams may be any
STRENGTH = 10.0  # of the smoothing: as many rows' weight has what a group is smoothed towards

#: Letters as they are, everything else a blank.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _trigrams(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, trigram bucket, text number) of a slice; trigrams of fewer than two letters are left out."""
    for row, at, data in bytetext.slices(column):
        text = _FOLD[bytetext.LOWER[data]].astype(np.uint32)
        if len(text) < 3:
            yield row, np.zeros(0, np.int64), np.zeros(0, np.int64), len(at) - 1
            continue
        of = np.repeat(np.arange(len(at) - 1), np.diff(at))
        letter = (text != 32).astype(np.int8)
        use = (of[:-2] == of[2:]) & (letter[:-2] + letter[1:-1] + letter[2:] >= 2)
        code = (text[:-2] << 16 | text[1:-1] << 8 | text[2:])[use]
        yield row, (code * np.uint32(0x9E3779B1) >> np.uint32(32 - BITS)).astype(np.int64), of[:-2][use], len(at) - 1


class TextModel:
    """Log chances of trigram buckets for some languages, and last for none of them."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts + 0.5
        smooth = smooth / smooth.sum(axis=1, keepdims=True)
        known = np.log((1 - FOREIGN) * smooth + FOREIGN / (1 << BITS))
        self.chances = np.vstack((known, np.full((1, 1 << BITS), -BITS * np.log(2)))).astype(np.float32)


def first_part(lang: Column) -> Column:
    """The letters with which a language tag begins, in lower case; empty if there are none."""
    return F.regexp_extract(F.lower(F.trim(lang)), "^[a-z]+", 0)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> TextModel:
    """Fit the text model on about `sample` rows of each language, drawn by a hash of the key.

    Null texts, and labels that are null or do not begin with a letter are left out. Without any row the model has no languages.
    """
    rows = labelled.select(F.col(text).alias("text"), first_part(F.col(lang)).alias("lang"), F.col(key).alias("key")).filter("text is not null and lang <> ''")
    sizes = rows.groupBy("lang").count().collect()  # a row for each language
    share = F.try_element_at(F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], sample / r["count"])]), F.col("lang")) if sizes else F.lit(0.0)
    drawn = rows.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < share * (1 << 30)).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for row, bucket, of, n in _trigrams(batch.column(1)):
                names = np.array(langs[row : row + n], object)
                for name in set(names):
                    mine = np.flatnonzero(names == name)
                    seen = np.bincount(bucket[np.isin(of, mine)], minlength=1 << BITS)
                    totals[name] = totals.get(name, 0) + seen
        for name, seen in totals.items():
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(seen[at].astype(np.int64))], ["lang", "bucket", "n"])

    table = drawn.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(table["lang"].to_pylist()))
    counts = np.zeros((len(languages), 1 << BITS))
    place = {name: i for i, name in enumerate(languages)}
    counts[[place[x] for x in table["lang"].to_pylist()], table["bucket"].to_numpy()] = table["n"].to_numpy()
    return TextModel(languages, counts)


def _likelihoods(df: DataFrame, model: TextModel) -> DataFrame:
    """(key, declared, host, n, likelihood): of the text under each language and `und`, as of EFFECTIVE trigrams at most."""
    shared = df.sparkSession.sparkContext.broadcast(model.chances)  # languages x 2**BITS, whatever the input
    key = df.schema["key"].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chances = shared.value
        for batch in batches:
            for row, bucket, of, n in _trigrams(batch.column(3)):
                size = np.bincount(of, minlength=n)
                sums = np.stack([np.bincount(of, weights=c[bucket], minlength=n) for c in chances], axis=1)
                sums = sums * (np.minimum(size, EFFECTIVE) / np.maximum(size, 1))[:, None]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(chances), pa.int32()), pa.array(sums.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(row, n) for i in range(3)), pa.array(size.astype(np.int64)), lists], ["key", "declared", "host", "n", "likelihood"]
                )

    return df.mapInArrow(measure, f"key {key}, declared string, host string, n long, likelihood array<double>")


def _doubles(values: list[Column]) -> Column:
    return F.array(*values).cast("array<double>")


def identify(
    rows: DataFrame, model: TextModel, key: Column, text: Column, declared: Column | None = None, host: Column | None = None,
    suffix: bool = True,
) -> DataFrame:
    """(key, lang, confidence, text_lang, n_trigrams) of every row.

    text_lang: the language of the text alone, null without trigrams. lang: of all evidence, `und` if none fits;
    confidence: its posterior. suffix: whether the last label of the host is evidence, as for addresses. Null and empty
    fields are no evidence: without any, the most frequent language has the highest posterior. Declared languages count
    by their first part, lower-cased. Ties go to the language first in the alphabet.
    """
    names = model.languages
    none = F.lit("")
    mark = first_part(F.coalesce(declared, none)) if declared is not None else none
    place = F.lower(F.coalesce(host, none)) if host is not None else none
    narrow = rows.select(key.alias("key"), mark.alias("declared"), place.alias("host"), text.alias("text"))
    scored = stored(_likelihoods(narrow, model), "likelihoods")
    best = F.array_position("likelihood", F.array_max("likelihood")).cast("int") - 1
    scored = scored.withColumn("vote", F.when(F.col("n") > 0, best)).withColumns({
        "suffix": F.regexp_extract("host", r"\.([^.:]+)(?::.*)?$", 1) if suffix else none,
        "domain": F.regexp_extract("host", r"^[^.]*\.(.*\..*)$", 1),
    })
    size = len(names)
    votes = stored(
        scored.filter(F.col("vote") < size).groupBy("host", "domain", "suffix", "declared", "vote").agg(F.count(F.lit(1)).alias("n")), "votes"
    )

    def tally(*by: str) -> DataFrame:
        """The votes for each language."""
        each = votes.groupBy(*by, "vote").agg(F.sum("n").alias("n")).groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("vote", "n"))).alias("of"))
        sums = F.transform(F.sequence(F.lit(0), F.lit(max(0, size - 1))), lambda i: F.coalesce(F.try_element_at("of", i), F.lit(0)).cast("double"))
        return each.select(*by, (sums if size else F.array().cast("array<double>")).alias("c"))

    def smoothed(counts: str, prior: Column) -> Column:
        total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(F.col(counts), prior, lambda c, p: (c + STRENGTH * p) / (total + STRENGTH))

    whole = np.array((tally().first() or [[0.0] * size])["c"]) if votes.head(1) else np.zeros(size)  # one row
    share = (whole + 1) / (whole.sum() + size) if size else whole
    overall = _doubles([F.lit(float(x)) for x in share])
    domains = tally("domain").filter("domain <> ''").select("domain", smoothed("c", overall).alias("above"))
    hosts = tally("host", "domain").filter("host <> ''").join(domains, "domain", "left")
    hosts = stored(hosts.select("host", smoothed("c", F.coalesce("above", overall)).alias("prior")), "hosts")
    columns = _doubles([F.lit(float(x) + STRENGTH) for x in whole])
    given = lambda: F.zip_with(F.col("c"), columns, lambda c, n: (c + STRENGTH / (4 * max(1, size))) / n)
    suffixes = stored(tally("suffix").filter("suffix <> ''").select("suffix", given().alias("by_suffix")), "suffixes")
    tags = F.array(*[F.lit(name) for name in names])
    same = F.transform(tags, lambda name: F.when(F.col("declared") == name, F.lit(0.8 * STRENGTH)).otherwise(F.lit(0.2 * STRENGTH / max(1, size))))
    marks = tally("declared").filter("declared <> ''")
    marks = stored(marks.select("declared", F.zip_with(F.zip_with("c", same, lambda c, s: c + s), columns, lambda c, n: c / n).alias("by_mark")), "marks")

    flat = _doubles([F.lit(1.0)] * size)
    log = lambda c: F.transform(F.coalesce(F.col(c), flat), lambda p: F.log(p))
    joined = scored.join(hosts, "host", "left").join(suffixes, "suffix", "left").join(marks, "declared", "left")
    prior = F.transform(F.coalesce("prior", overall), lambda p: F.log(p * (1 - UND_PRIOR)))
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    known = add(add(add(F.slice("likelihood", 1, size), prior), log("by_suffix")), log("by_mark"))
    # The chance of any suffix or mark is the same under `und` as its mean over the languages.
    mean = lambda c: F.coalesce(F.log(F.aggregate(F.col(c), F.lit(0.0), lambda a, x: a + x) / max(1, size)), F.lit(0.0))
    und = F.element_at("likelihood", size + 1) + float(np.log(UND_PRIOR)) + mean("by_suffix") + mean("by_mark")
    label = F.array(*[F.lit(x) for x in (*names, UNDETERMINED)])
    return (
        joined.withColumn("logits", F.concat(known, F.array(und))).withColumn("top", F.array_max("logits"))
        .select(
            "key", F.element_at(label, F.array_position("logits", F.col("top")).cast("int")).alias("lang"),
            (1 / F.aggregate("logits", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))).alias("confidence"),
            F.when(F.col("n") > 0, F.element_at(label, F.col("vote") + 1)).alias("text_lang"), F.col("n").alias("n_trigrams"),
        )
    )


def keep_identified(docs: DataFrame, model: TextModel, id_col: str = "doc_id", text: str = "text", declared: str = "lang", source: str = "source", least: float = 0.5) -> DataFrame:
    """The documents whose language is found with a posterior of at least `least`. Those without a letter in them go."""
    name = F.struct(F.col(id_col).alias("id"), F.xxhash64(text, declared, source).alias("row"))
    found = identify(docs, model, name, F.col(text), F.col(declared), F.col(source), suffix=False)
    gone = found.filter((F.col("n_trigrams") == 0) | (F.col("lang") == UNDETERMINED) | (F.col("confidence") < least))
    gone = stored(gone.select(F.col("key.id").alias("__id"), F.col("key.row").alias("__row")).distinct(), "rejected")
    same = docs[id_col].eqNullSafe(gone["__id"]) & (F.xxhash64(docs[text], docs[declared], docs[source]) == gone["__row"])
    return docs.join(gone, same, "left_anti")
