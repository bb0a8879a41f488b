"""Benchmark decontamination: broadcast the n-grams of the benchmark, scan the word windows of the documents.

Words are runs of digits, ASCII letters (lower-cased) and non-ASCII characters. An item gives all windows of `n`
consecutive words; an item of fewer words is one window. A window found by its hash is confirmed word by word.

The windows are broadcast in slices of at most `SLICE_MB`: their total size is added up first, and a larger benchmark
takes several scans, each over the written result of the one before. Nothing is shuffled but the benchmark.

Rows: benchmark rows with a null id or text have no windows; repeated items and windows count once. Null and empty
texts have no words and no hits. An empty benchmark hits nothing. Every input row gives one output row, and all its
columns are kept in the struct `row`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from parcelmill.llm import bytetext
from parcelmill.llm.scratch import stored

WINDOW = 10
SLICE_MB = 16

IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True

RUNS = "array<struct<first:int,last:int,start:int,end:int>>"


def _hashes(data: np.ndarray, at: np.ndarray):
    low = bytetext.LOWER[data]
    starts, ends, first = bytetext.words(low, at, IS_WORD)
    return low, starts, ends, first, bytetext.range_hash(bytetext.prefix(low), starts, ends)


def _joined(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, i: int, k: int) -> bytes:
    return b" ".join(low[s:e].tobytes() for s, e in zip(starts[i : i + k].tolist(), ends[i : i + k].tolist()))


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", n: int = WINDOW) -> DataFrame:
    """(item, k, hash, words): the windows of every item; k words, joined by a space."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, at, data in bytetext.slices(batch.column(1)):
                low, starts, ends, first, h = _hashes(data, at)
                items, sizes, hashes, words = [], [], [], []
                for doc in range(len(at) - 1):
                    a, b = int(first[doc]), int(first[doc + 1])
                    if (k := min(n, b - a)) == 0:
                        continue
                    windows = bytetext.signed(bytetext.window_hash(h[a:b], k)).tolist()
                    items += [batch.column(0)[row + doc].as_py()] * len(windows)
                    sizes += [k] * len(windows)
                    hashes += windows
                    words += [_joined(low, starts, ends, a + i, k) for i in range(len(windows))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items, batch.schema.field(0).type), pa.array(sizes, pa.int32()), pa.array(hashes, pa.int64()), pa.array(words, pa.binary())],
                    ["item", "k", "hash", "words"],
                )

    kind = benchmark.schema[item].dataType.simpleString()
    rows = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).dropna()
    return rows.mapInArrow(cut, f"item {kind}, k int, hash long, words binary").distinct()


class _Slice:
    """A broadcast part of the windows: hashes by number of words, and the items of each window by its words."""

    BITS = 20

    def __init__(self, rows: pa.Table):
        self.items: dict[bytes, list] = {}
        for item, words in zip(rows["item"].to_pylist(), rows["words"].to_pylist()):
            self.items.setdefault(words, []).append(item)
        k, h = rows["k"].to_numpy(), rows["hash"].to_numpy().view(np.uint64)
        self.keys = {int(size): np.unique(h[k == size]) for size in np.unique(k)}
        self.maybe = {}
        for size, keys in self.keys.items():
            self.maybe[size] = np.zeros(1 << self.BITS, bool)
            self.maybe[size][keys >> np.uint64(64 - self.BITS)] = True

    def hits(self, size: int, h: np.ndarray) -> np.ndarray:
        """Indexes of the window hashes that occur here."""
        found = np.flatnonzero(self.maybe[size][h >> np.uint64(64 - self.BITS)])
        keys = self.keys[size]
        place = np.minimum(np.searchsorted(keys, h[found]), len(keys) - 1)
        return found[keys[place] == h[found]]


def _runs(covered: np.ndarray, first: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> list[list[dict]]:
    """Per text its maximal runs of covered words, as word numbers and byte offsets within the text."""
    cut = np.zeros(len(covered) + 1, bool)
    cut[first] = True
    before = np.concatenate(([False], covered[:-1]))
    opens = np.flatnonzero(covered & (~before | cut[:-1]))
    after = np.concatenate((covered[1:], [False]))
    closes = np.flatnonzero(covered & (~after | cut[1:])) + 1
    out: list[list[dict]] = [[] for _ in range(len(at) - 1)]
    docs = np.searchsorted(first, opens, side="right") - 1
    for doc, a, b in zip(docs.tolist(), opens.tolist(), closes.tolist()):
        base, byte = int(first[doc]), int(at[doc])
        out[doc].append({"first": a - base, "last": b - base, "start": int(starts[a]) - byte, "end": int(ends[b - 1]) - byte})
    return out


def without_runs(text: str, runs: list[dict]) -> str:
    """The text without the bytes of the runs; what is left on both sides of a run is joined by a space."""
    raw, at, kept = text.encode(), 0, []
    for cut in runs:
        kept.append(raw[at : cut["start"]].rstrip())
        at = cut["end"]
    kept.append(raw[at:].lstrip())
    return b" ".join(x for x in kept if x).decode()


def _scan(df: DataFrame, text: str, part, cut: bool) -> DataFrame:
    """Add the hits of one slice to (row, n_words, runs, items), and with `cut` the text without them where there are any."""
    schema = T.StructType([*df.schema, T.StructField("clean", T.StringType())]) if cut else df.schema
    arrow = [f.name for f in schema]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: _Slice = part.value
        for batch in batches:
            texts = batch.column(0).field(text)
            if batch.column(0).null_count:
                texts = pa.compute.if_else(batch.column(0).is_valid(), texts, None)
            n_words, runs, items = [], [], []
            for row, at, data in bytetext.slices(texts):
                low, starts, ends, first, h = _hashes(data, at)
                doc = np.repeat(np.arange(len(at) - 1), np.diff(first))
                n_words += np.diff(first).tolist()
                marks = np.zeros(len(h) + 1, np.int64)
                found: dict[int, set] = {}
                for k in table.keys:
                    for i in table.hits(k, bytetext.window_hash(h, k)).tolist():
                        if doc[i] == doc[i + k - 1] and (of := table.items.get(_joined(low, starts, ends, i, k))):
                            marks[i] += 1
                            marks[i + k] -= 1
                            found.setdefault(int(doc[i]), set()).update(of)
                covered = np.cumsum(marks[:-1]) > 0
                new = _runs(covered, first, starts, ends, at) if found else [[]] * (len(at) - 1)
                for d, fresh in enumerate(new):
                    old_runs = batch.column(2)[row + d].as_py() or []
                    old_items = batch.column(3)[row + d].as_py() or []
                    runs.append(_merged(old_runs + fresh) if old_runs and fresh else old_runs or fresh)
                    items.append(list({*old_items, *found.get(d, ())}))
            columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(runs, batch.schema.field(2).type), pa.array(items, batch.schema.field(3).type)]
            if cut:
                columns.append(pa.array([without_runs(texts[i].as_py(), r) if r else None for i, r in enumerate(runs)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, arrow)

    return df.mapInArrow(scan, schema)


def _merged(runs: list[dict]) -> list[dict]:
    """Overlapping and touching runs become one."""
    out: list[dict] = []
    for run in sorted(runs, key=lambda r: r["first"]):
        if out and run["first"] <= out[-1]["last"]:
            if run["last"] > out[-1]["last"]:
                out[-1] = out[-1] | {"last": run["last"], "end": run["end"]}
        else:
            out.append(run)
    return out


def hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", n: int = WINDOW, slice_mb: float = SLICE_MB, cut: bool = False) -> DataFrame:
    """(row, n_words, runs, items) for every document: its columns, number of words, hit runs and the items that occur.

    A run holds the word numbers [first, last) and the bytes [start, end) of the UTF-8 text. With `cut` there is `clean`, the text
    without the runs where there are any: the last scan makes it, as a pass of its own would need a second worker a core.
    """
    spark = docs.sparkSession
    windows = stored(benchmark_windows(benchmark, item, item_text, n), "benchmark-windows")
    size = windows.agg(F.sum(F.octet_length("words") + 64)).first()[0] or 0
    scans = max(1, -int(-size // (slice_mb * (1 << 20))))
    kind = benchmark.schema[item].dataType.simpleString()
    out = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.lit(0).cast("long").alias("n_words"),
        F.expr(f"cast(array() as {RUNS})").alias("runs"), F.expr(f"cast(array() as array<{kind}>)").alias("items"),
    )
    for number in range(scans):
        rows = windows.filter(F.pmod("hash", F.lit(scans)) == number).toArrow()  # at most about slice_mb
        out = _scan(out, text, spark.sparkContext.broadcast(_Slice(rows)), cut and number + 1 == scans)
        out = stored(out, "benchmark-scan") if number + 1 < scans else out
    return out


def n_hit() -> Column:
    return F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", n: int = WINDOW, drop_share: float = 0.5) -> DataFrame:
    """The documents with the hit passages cut out; those with more than `drop_share` of their words hit are dropped."""
    found = hits(docs, benchmark, text, n=n, cut=True).withColumn("n_hit", n_hit()).filter(F.col("n_hit") <= drop_share * F.col("n_words"))
    clean = F.when(F.col("n_hit") > 0, F.col("clean")).otherwise(F.col(f"row.`{text}`"))
    return found.select(*[(clean if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
