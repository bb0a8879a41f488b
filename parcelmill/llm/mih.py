"""Nearest neighbours by multi-index hashing of learned binary codes.

A rotation learned on a bounded sample (iterative quantisation) turns each vector into a code of at most 64 bits. A code is
split into substrings of 8 bits, each with an index of its own. Codes within Hamming distance r of a query differ by
at most r // 8 in one substring (of eight) at least; so probing every index within that distance finds all of them. Their
floats are then compared in double precision.

The vectors are dealt at random into slices of about `SLICE`, and a task indexes a slice and probes it with a block of about
`QUERIES` queries. What is held at once is a slice and a block, however many rows share a code or a vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelmill.llm.scratch import stored

SAMPLE = 20000  # vectors that the rotation is learned on
BITS = 64
RADIUS = 30  # unrelated codes are 32 +- 4 apart
ROUNDS = 30
SLICE = 8192
QUERIES = 4096
_SUB = 8


class Codes:
    """The learned rotation."""

    def __init__(self, sample: np.ndarray, bits: int = BITS, seed: int = 7):
        """sample: unit vectors, one a row."""
        self.mean = sample.mean(axis=0)
        centred = sample - self.mean
        self.bits = min(bits, sample.shape[1])
        axes = np.linalg.svd(centred.T @ centred)[0][:, : self.bits]
        flat = centred @ axes
        turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(self.bits, self.bits)))[0]
        for _ in range(ROUNDS):
            u, _, v = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
            turn = (u @ v).T
        self.turn = axes @ turn

    def __call__(self, units: np.ndarray) -> np.ndarray:
        """Codes as rows of 8 bytes."""
        bits = np.zeros((len(units), BITS), bool)
        bits[:, : self.bits] = (units - self.mean) @ self.turn > 0
        return np.packbits(bits, axis=1)


class Index:
    """One index for each substring of the codes: the positions by substring value."""

    _NEAR = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.words = np.ascontiguousarray(codes).view(np.uint64)[:, 0]
        self.order = [np.argsort(codes[:, j], kind="stable") for j in range(codes.shape[1])]
        self.starts = [np.searchsorted(codes[o, j], np.arange(257)) for j, o in enumerate(self.order)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Positions of all codes within the radius of a code."""
        hit = np.zeros(len(self.codes), bool)
        for j, (order, starts) in enumerate(zip(self.order, self.starts)):
            for value in np.flatnonzero(self._NEAR[code[j]] <= radius // len(self.order)).tolist():
                hit[order[starts[value] : starts[value + 1]]] = True
        found = np.flatnonzero(hit)
        return found[np.bitwise_count(self.words[found] ^ code.view(np.uint64)[0]) <= radius]


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite, and not all zero."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(wide, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return F.coalesce(fine & F.exists(wide, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array | pa.ChunkedArray, n: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each row divided by a power of two: nothing is rounded, and squares of large or small components stay finite."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _units(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of one row of y with each row of x, every pair computed alike, so that equal vectors have equal scores."""
    x, y = _scaled(x), _scaled(y[None, :])
    return (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))


def learn(vectors: DataFrame, sample: int = SAMPLE) -> Codes | None:
    """Learn the codes on about `sample` of the vectors (id, v), drawn by a hash of the id; None if there are none."""
    n = vectors.count()
    share = min(1.0, sample / max(1, n))
    drawn = vectors.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share * (1 << 30)).select("id", "v")
    table = (drawn if share < 1 else vectors.select("id", "v")).toArrow().sort_by("id")
    return Codes(_units(_matrix(table["v"], len(table)))) if len(table) else None


RESULT = "query_id long, vec_id long, score double"


def nearest(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector: str = "embedding", k: int = 5, radius: int = RADIUS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row for which `queries` holds its k nearest rows by cosine among those found.

    The query's own id is no candidate. Equal scores go to the smaller id. Within a slice that has fewer than k codes in the
    radius the radius grows until it has, so a query gets k rows if there are k others. Null ids, null, empty and zero vectors,
    those with null or non-finite components, and those of another length than the most frequent one take no part. Of
    rows with the same id and vector one takes part.
    """
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("q"))
    rows = stored(own.filter(F.col("id").isNotNull() & usable(F.col("v"))), "vectors")
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.filter(F.size("v") == (length["d"] if length else 0)).dropDuplicates(["id", "v"])
    codes = learn(rows)
    if codes is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("q").alias("q")).first()
    slices, blocks = -(-sizes["n"] // SLICE), max(1, -(-sizes["q"] // QUERIES))
    drawn = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = rows.select(drawn(slices, 1).alias("slice"), each(blocks).alias("block"), "id", "v")
    asked = rows.filter("q").select(each(slices).alias("slice"), drawn(blocks, 2).alias("block"), "id", "v")

    def search(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(mine) and len(theirs):
            out += probe(*((t["id"].to_numpy(), _matrix(t["v"], len(t))) for t in (mine, theirs)))
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*out)], ["query_id", "vec_id", "score"])

    def probe(held: tuple[np.ndarray, np.ndarray], asked: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[np.ndarray, ...]]:
        (ids, floats), (wanted, asking) = held, asked
        units, ask_units = _units(floats), _units(asking)
        index = Index(codes(units))
        for q, vector, unit, code in zip(wanted.tolist(), asking, ask_units, codes(ask_units)):
            reach = radius
            while True:
                found = index.within(code, reach)
                found = found[ids[found] != q]
                if len(found) >= k or reach >= BITS:
                    break
                reach += len(code)
            if len(found) > k:
                rough = units[found] @ unit
                found = found[rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - 1e-9]
            scores = cosines(floats[found], vector)
            best = np.lexsort((ids[found], -scores))[:k]
            yield np.full(len(best), q), ids[found[best]], scores[best]

    found = held.groupBy("slice", "block").cogroup(asked.groupBy("slice", "block")).applyInArrow(search, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
