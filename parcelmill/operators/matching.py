"""Dictionary match by string similarity.

A dictionary that is a mapping is a few fixed entries: every text is scored where it is, without a shuffle. A dictionary that is a
table may have any size. Its distinct keys and the distinct texts are dealt into blocks of like length; a block of texts
meets only the blocks of keys whose lengths allow the score that is asked for. Within a pair of blocks, counts of
common characters and of common neighbours rule out most pairs, and what is left is verified (`functions.pairs`). Each meeting
gives its best entry for a text, an aggregate keeps the best of these, and they are joined back to the rows.

Where the best ratio is asked for, most texts need no blocks: a key at a distance of at most two characters has two of four segments
in common with the text, so an equi-join finds all such keys, and a text whose best one scores more than any key further off can is
done (`_near`). What is left, texts without such a key, goes to the blocks; there the work is the product of texts and keys.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from parcelmill.functions import pairs, similarity


def matched(low: Column, dictionary: dict[str, str], score: str, threshold: float, mode: str) -> Column:
    """Dictionary match of a lower-case string column: native where one string settles it, else by score."""
    native = similarity.exact_match(low, dictionary, score, mode)
    open_text = F.when(native.isNull(), low)
    if score == "ratio":
        bound = similarity.length_bound(dictionary, threshold)
        open_text = F.when(native.isNull() & (F.length(low) <= bound), low)
    return F.coalesce(native, similarity.fuzzy_match(open_text, dictionary, score, threshold, mode))


BLOCK = 8192  # strings of a block, about
BLOCK_CHARS = 1 << 20  # characters of a block, about
_GROWTH = 1.25  # lengths of a class differ by this factor at most


def _length_class(text: Column) -> Column:
    return F.floor(F.log(F.char_length(text)) / math.log(_GROWTH) + 1e-9).cast("int")


def _lengths(length_class: int) -> tuple[int, int]:
    """Least and largest length of a class, the ends taken generously."""
    return max(1, int(_GROWTH**length_class) - 1), int(_GROWTH ** (length_class + 1)) + 1


def _meet(one: int, other: int, score: str, threshold: float) -> bool:
    """Whether strings of two length classes can reach the threshold."""
    if score == "partial":
        return True
    (low, high), (other_low, other_high) = _lengths(one), _lengths(other)
    short, long = min(high, other_high), max(low, other_low)
    return short >= long or 200.0 * short / (short + long) >= threshold - 1e-6


class _Blocks:
    """Blocks of distinct strings, numbered class by class."""

    def __init__(self, strings: DataFrame, name: str):
        self.name = name
        sizes = strings.groupBy(_length_class(F.col(name)).alias("c")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length(name)).alias("chars"))
        self.counts = {  # a row for each length class, of which a string type has 97
            r["c"]: max(-(-r["n"] // BLOCK), -(-r["chars"] // BLOCK_CHARS)) for r in sizes.orderBy("c").collect()
        }
        self.first, at = {}, 0
        for c, count in self.counts.items():
            self.first[c], at = at, at + count

    def _by_class(self, values: dict[int, int]) -> Column:
        table = F.create_map(*[F.lit(x) for item in values.items() for x in item])
        return F.try_element_at(table, _length_class(F.col(self.name)))

    def own(self) -> Column:
        """The block of a string."""
        return self._by_class(self.first) + F.pmod(F.xxhash64(self.name), self._by_class(self.counts)).cast("int")

    def others(self, theirs: _Blocks, score: str, threshold: float) -> Column:
        """The blocks on the other side that a string is to meet: neighbouring classes, so one range."""
        first, last = {}, {}
        for c in self.counts:
            near = [o for o in theirs.counts if _meet(c, o, score, threshold)]
            if near:
                first[c], last[c] = theirs.first[near[0]], theirs.first[near[-1]] + theirs.counts[near[-1]] - 1
        if not first:
            return F.lit(None).cast("array<int>")
        low, high = self._by_class(first), self._by_class(last)
        return F.when(low.isNotNull(), F.sequence(low, high))


def _best_in_block(score: str, threshold: float, mode: str):
    """For a block of texts and one of entries: (text, score, ord, value) of the best entry of each text that has one."""

    def search(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if len(mine) and len(theirs):
            order = theirs["ord"].to_numpy()
            for text, key, value in pairs.near_pairs(mine["text"].to_pylist(), theirs["key"].to_pylist(), score, threshold):
                fits = value >= threshold if mode == "best" else value > threshold
                text, key, value = text[fits], key[fits], value[fits]
                by = np.lexsort((order[key], -value, text)) if mode == "best" else np.lexsort((order[key], text))
                first = by[np.flatnonzero(np.diff(text[by], prepend=-1))]
                for column, values in zip(out, (text[first], value[first], key[first])):
                    column.append(values)
        text, value, key = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
        found = theirs.select(["ord", "value"]).take(pa.array(key, pa.int64()))
        return pa.table([mine["text"].take(pa.array(text, pa.int64())), pa.array(value, pa.float64()), found["ord"], found["value"]], ["text", "score", "ord", "value"])

    return search


SEGMENTS = 4  # of a key
DISTANCE = 2  # characters too many or too few, together, that leave two segments whole
NEAR_CHARS = 12  # shorter texts go to the blocks
HOT = 1024  # keys that may share two segments; texts that meet more go to the blocks
SAMPLE = 5000  # keys whose letters decide where keys are cut; any cut gives the same result
_SAMPLE_CHARS = 256


def _probes() -> list[tuple[int, ...]]:
    """(delta, i, j, shift i, shift j): where whole segments i and j of a key of delta more characters lie in a text.

    Any way to put up to `DISTANCE` characters into the segments of the key, or take them out, leaves two of the segments whole;
    what comes before a segment shifts it.
    """
    found = set()
    edits = list(itertools.product(range(SEGMENTS), (1, -1)))
    for n in range(DISTANCE + 1):
        for some in itertools.combinations_with_replacement(edits, n):
            i, j = [s for s in range(SEGMENTS) if s not in {at for at, _ in some}][-2:]
            found.add((-sum(by for _, by in some), i, j, *(sum(by for at, by in some if at < s) for s in (i, j))))
    return sorted(found)


def _cuts(keys: list[str]) -> list[tuple[int, list[int]]]:
    """(length, ends of the segments): each segment of the keys of a length tells about as much, by the letters after each letter."""
    of_length = defaultdict(list)
    for key in keys:
        of_length[len(key)].append(key)
    out = []
    for m, some in of_length.items():
        told = np.zeros(m)
        for at in range(m):
            both, before = Counter(k[max(0, at - 1) : at + 1] for k in some), Counter(k[max(0, at - 1) : at] for k in some)
            told[at] = 0.01 + sum(n * math.log2(before[pair[:-1]] / n) for pair, n in both.items()) / len(some)
        share = np.cumsum(told) / told.sum()
        ends = [0]
        for s in range(1, SEGMENTS):
            ends.append(min(max(int(np.searchsorted(share, s / SEGMENTS)) + 1, ends[-1] + 1), m - SEGMENTS + s))
        out.append((m, [*ends, m]))
    return out


def _signed(strings: DataFrame, name: str, probes: list[tuple[int, ...]], cuts: DataFrame) -> DataFrame:
    """The strings with a signature for each probe: two segments, as hashes."""
    probe = F.explode(F.array(*[F.struct(*[F.lit(x).alias(c) for x, c in zip(p, ("delta", "i", "j", "at_i", "at_j"))]) for p in probes]))
    rows = strings.select(*strings.columns, probe.alias("p")).withColumn("m", F.char_length(name) + F.col("p.delta"))
    even = F.array(*[F.floor(F.col("m") * s / SEGMENTS).cast("int") for s in range(SEGMENTS + 1)])
    rows = rows.join(cuts, "m", "left").withColumn("cut", F.coalesce("cut", even))

    def segment(which: str) -> Column:
        first, last = F.get("cut", F.col(f"p.{which}")), F.get("cut", F.col(f"p.{which}") + 1)
        return F.col(name).substr(first + F.col(f"p.at_{which}") + 1, last - first)

    return rows.select(*strings.columns, F.xxhash64("m", "p.i", "p.j", segment("i"), segment("j")).alias("signature"))


def _score_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, key, ord, value) with the ratio of text and key; without a key no score."""
    for batch in batches:
        texts, keys = batch["text"].to_pylist(), batch["key"].to_pylist()
        at = np.arange(len(texts))
        value = pairs.ratios(*pairs.Strings.pair(texts, [k or "" for k in keys]), at, at)
        score = pa.array(value, pa.float64(), mask=np.array([k is None for k in keys], bool))
        yield pa.RecordBatch.from_arrays([batch["text"], score, batch["ord"], batch["value"]], ["text", "score", "ord", "value"])


def _near(texts: DataFrame, entries: DataFrame, threshold: float) -> DataFrame:
    """(text, value, done) for each text; where done, the value is that of the entry of the best ratio.

    All entries at a distance of at most `DISTANCE` are found. One further off scores less than 100 * (1 - d / (2 n + d)), with d one more
    than this distance and n characters of the text: a text with a better entry is done.
    """
    spark = texts.sparkSession
    long_enough = F.char_length("key") >= NEAR_CHARS - DISTANCE
    sample = entries.filter(long_enough & (F.char_length("key") <= _SAMPLE_CHARS)).select("key").orderBy(F.xxhash64("key")).limit(SAMPLE)
    cuts = spark.createDataFrame(_cuts([r.key for r in sample.collect()]), "m int, cut array<int>")
    segments = [(0, i, j, 0, 0) for i, j in itertools.combinations(range(SEGMENTS), 2)]
    held = _signed(entries.filter(long_enough), "key", segments, cuts)
    hot = held.groupBy("signature").count().filter(F.col("count") > HOT).select("signature")
    marks = hot.select(*[F.lit(None).cast(kind).alias(c) for c, kind in entries.dtypes], "signature")
    held = held.join(hot, "signature", "left_anti").unionByName(marks)
    asked = _signed(texts.filter(F.char_length("text") >= NEAR_CHARS), "text", _probes(), cuts)
    met = asked.join(held, "signature").filter(F.col("key").isNull() | (F.levenshtein("text", "key", DISTANCE) >= 0))
    scored = met.select("text", "key", "ord", "value").mapInArrow(_score_pairs, "text string, score double, ord long, value string")
    fits = F.when(F.col("score") >= threshold, F.struct((-F.col("score")).alias("score"), "ord", "value"))
    rows = scored.select("text", fits.alias("best"), F.col("score").isNull().alias("hot"))
    rows = rows.unionByName(texts.select("text", F.lit(None).cast(rows.schema["best"].dataType).alias("best"), F.lit(False).alias("hot")))
    best = rows.groupBy("text").agg(F.min("best").alias("best"), F.bool_or("hot").alias("hot"))
    further = 100 * (1 - (DISTANCE + 1) / (2 * F.char_length("text") + DISTANCE + 1))
    done = ~F.col("hot") & F.coalesce(-F.col("best.score") > further + 1e-6, F.lit(False))
    return best.select("text", "best.value", done.alias("done"))


def _kept(df: DataFrame) -> DataFrame:
    """The rows computed once: in the folder named in spark.checkpoint.dir, else where they are computed."""
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df.persist()


def table_matches(texts: DataFrame, dictionary: DataFrame, score: str, threshold: float, mode: str) -> DataFrame:
    """(text, value) for each distinct text (a column `text`, not null or empty) that matches an entry (key, value, ord)."""
    low = dictionary.select(F.lower("key").alias("key"), F.struct(F.col("ord").cast("long").alias("ord"), F.col("value").cast("string").alias("value")).alias("entry"))
    entries = low.filter("key <> '' and entry.ord is not null").groupBy("key").agg(F.min("entry").alias("entry")).select("key", "entry.*")
    if score != "ratio" or mode != "best":
        return _block_matches(texts, entries, score, threshold, mode)
    near = _kept(_near(texts, entries, threshold))
    rest = _block_matches(near.filter(~F.col("done")).select("text"), entries, score, threshold, mode)
    return near.filter("done").select("text", "value").unionByName(rest)


def _block_matches(texts: DataFrame, entries: DataFrame, score: str, threshold: float, mode: str) -> DataFrame:
    """The same for entries whose keys are distinct, by blocks."""
    of_texts, of_keys = _Blocks(texts, "text"), _Blocks(entries, "key")
    if not of_texts.counts or not of_keys.counts:
        return texts.select("text", F.lit(None).cast("string").alias("value")).limit(0)
    asked = texts.select("text", of_texts.own().alias("of_text"), F.explode(of_texts.others(of_keys, score, threshold)).alias("of_key"))
    held = entries.select("key", "value", "ord", F.explode(of_keys.others(of_texts, score, threshold)).alias("of_text"), of_keys.own().alias("of_key"))
    found = asked.groupBy("of_text", "of_key").cogroup(held.groupBy("of_text", "of_key")).applyInArrow(
        _best_in_block(score, threshold, mode), "text string, score double, ord long, value string"
    )
    best = F.struct(-F.col("score"), "ord") if mode == "best" else F.col("ord")
    return found.groupBy("text").agg(F.min_by("value", best).alias("value"))


def dict_match(
    df: DataFrame,
    col: str,
    dictionary: dict[str, str] | DataFrame,
    score: str = "partial",
    threshold: float = 70.0,
    mode: str = "best",
    out: str = "match",
) -> DataFrame:
    """Add the dictionary value that matches a text column, compared in lower case.

    The dictionary maps keys to values in order, or is a table (key, value, ord) of any size; keys are of any length. Of
    equal keys the first entry counts; in a table, null and empty keys and null places are left out, and an empty table matches nothing.

    `score` is `ratio` or `partial`. `mode='best'` takes the highest score of at least the threshold
    (the first entry on a tie), `mode='first'` the first entry with a score above the threshold. Null and empty texts match nothing.
    """
    if not isinstance(dictionary, DataFrame):
        return df.withColumn(out, matched(F.lower(F.col(col)), dictionary, score, threshold, mode))
    if not 0 < threshold <= 100:
        raise ValueError("a threshold is above 0 and at most 100")
    texts = df.select(F.lower(F.col(col).cast("string")).alias("text")).filter("text <> ''").distinct()
    found = table_matches(texts, dictionary, score, threshold, mode).select(F.col("text").alias("__text"), F.col("value").alias("__value"))
    # Equal texts meet here only once per row, and Spark splits the rows of a hot text by itself.
    joined = df.join(found, F.lower(df[col].cast("string")) == found["__text"], "left")
    return joined.withColumn(out, F.col("__value")).drop("__text", "__value")
