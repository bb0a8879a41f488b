"""MinHash near-deduplication: banded signatures, verified links, connected components.

1. One pass over the texts makes a sketch of each: number of shingles, a 128-bit key of the shingle set, `BANDS` x
   `ROWS` universal hash minima as band keys, and one byte of each minimum as signature. A pair of the least similarity,
   0.8, shares no band with probability (1 - 0.8**5)**36 = 6e-7.
2. Texts with equal sets form a class; only its smallest document goes on. However many copies there are, a class is
   one aggregated row.
3. A band key that several classes share is a bucket. Rounds of stars link its members, each with a leader of its
   buckets drawn by hash, for each of SEEDS seeds, as long as this finds many new links. Members of buckets that are still in several components are compared by signature, block by block for large
   buckets, and what passes becomes a candidate. So no pair of a bucket is left out, and pairs of one component, which
   are nearly all pairs of a group of copies, are never made.
4. Signatures reject candidates whose estimate is 4.8 standard deviations too low; the others are verified on their full
   shingle sets, and components are computed from the verified links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelmill.llm import bytetext
from parcelmill.llm.components import components
from parcelmill.llm.scratch import stored

SHINGLE_WORDS = 5
SIMILAR = (80, 100)  # links have SIMILAR[1] * intersection >= SIMILAR[0] * union
BANDS, ROWS = 36, 5
LONG = 2048  # hash minima of a long signature
SEEDS = 4  # leaders of a member in a round
BLOCK = 1024  # members of a bucket that are compared at once

IS_WORD = np.ones(256, bool)
IS_WORD[[32, 9, 10, 11, 12, 13]] = False

_random = np.random.default_rng(20240229)


def _family(n: int) -> tuple[np.ndarray, np.ndarray]:
    """n universal hash functions a * x + b modulo 2**32, a odd."""
    return _random.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), _random.integers(0, 1 << 32, n, dtype=np.uint32)


_A, _B = _family(BANDS * ROWS)
_LONG_A, _LONG_B = _family(LONG)


def _shingles(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer than k words is one shingle, none without words."""
    for _, at, data in bytetext.slices(column):
        low = bytetext.LOWER[data]
        starts, ends, first = bytetext.words(low, at, IS_WORD)
        h = bytetext.range_hash(bytetext.prefix(low), starts, ends)
        windows = bytetext.window_hash(h, k)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            yield np.unique(windows[a : b - k + 1] if b - a >= k else bytetext.window_hash(h[a:b], b - a) if b > a else h[:0])


def _minima(shingles: np.ndarray, a: np.ndarray = _A, b: np.ndarray = _B) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(a), 0xFFFFFFFF, np.uint32)
    step = max(1, (1 << 19) // len(a))
    for at in range(0, len(x), step):
        h = a[:, None] * x[None, at : at + step]
        h += b[:, None]
        np.minimum(best, h.min(axis=1), out=best)
    return best


def _short(minima: np.ndarray) -> np.ndarray:
    """One byte of each minimum."""
    return (minima * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8)


SKETCH = "id long, n int, set_a long, set_b long, bands array<long>, signature binary"


def sketches(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = SHINGLE_WORDS) -> DataFrame:
    """The sketch of every row; bands and signature are null without shingles."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, minima = [], [], []
            for x in _shingles(batch.column(1), k):
                sizes.append(len(x))
                keys.append((bytetext.mixed(x).sum(), bytetext.mixed(x ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum()))
                minima.append(_minima(x))
            if not sizes:
                continue
            m = np.stack(minima)
            acc = np.zeros((len(m), BANDS), np.uint64)
            for r in range(ROWS):
                acc = acc * np.uint64(0xD1342543DE82EF95) + m.reshape(len(m), BANDS, ROWS)[:, :, r]
            bands = bytetext.mixed(acc + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            short = _short(m)
            empty = np.array(sizes) == 0
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * BANDS, pa.int32()), pa.array(bytetext.signed(bands.reshape(-1))), mask=pa.array(empty))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int32()), *(pa.array(bytetext.signed(np.array(c, np.uint64))) for c in zip(*keys)), lists,
                 pa.array([None if e else s.tobytes() for e, s in zip(empty, short)], pa.binary())],
                ["id", "n", "set_a", "set_b", "bands", "signature"],
            )

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(sketch, SKETCH)


def _sets(docs: DataFrame, ids: DataFrame, id_col: str, text: str, k: int) -> DataFrame:
    """(id, shingles): the whole shingle sets of some documents."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, kept, size = [], 0, 0
            for x in _shingles(batch.column(1), k):
                held.append(x.tobytes())
                size += 8 * len(x)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(kept, len(held)), pa.array(held, pa.binary())], ["id", "shingles"])
                    kept, held, size = kept + len(held), [], 0
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(kept), pa.array(held, pa.binary())], ["id", "shingles"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).join(ids, "id", "left_semi")
    return rows.mapInArrow(make, "id long, shingles binary")


def _lowest_estimate(hashes: int) -> float:
    """4.8 standard deviations below the least similarity: it turns down one link in a million."""
    j = SIMILAR[0] / SIMILAR[1]
    return j - 4.8 * (j * (1 - j) / hashes) ** 0.5


def _promising(pairs: DataFrame, features: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and signatures allow a link."""

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x, y = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(part.num_rows, -1) for c in ("sa", "sb"))
                keep = pa.array((x == y).mean(axis=1) >= _lowest_estimate(BANDS * ROWS))
                yield pa.RecordBatch.from_arrays([part.column("a").filter(keep), part.column("b").filter(keep)], ["a", "b"])

    low, high = SIMILAR
    sized = (
        pairs.join(features.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("signature").alias("sa")), "a")
        .join(features.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("sb")), "b")
        .filter(high * F.least("na", "nb").cast("long") >= low * F.greatest("na", "nb").cast("long"))
    )
    return sized.select("a", "b", "sa", "sb").mapInArrow(estimate, "a long, b long")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar by their full sets."""
    low, high = SIMILAR

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("xa"), batch.column("xb")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(high * common >= low * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep, pa.bool_())), batch.column("b").filter(pa.array(keep, pa.bool_()))], ["a", "b"])

    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("xa")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("shingles").alias("xb")), "b"
    )
    return both.select("a", "b", "xa", "xb").mapInArrow(verify, "a long, b long")


def _ordered(a: str, b: str):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def _long_signatures(sets: DataFrame) -> DataFrame:
    """(id, long): a signature of LONG bytes of each shingle set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                made = [_short(_minima(np.frombuffer(x.as_py(), np.uint64), _LONG_A, _LONG_B)).tobytes() for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.binary())], ["id", "long"])

    return sets.mapInArrow(sign, "id long, long binary")


def _across(rows: DataFrame) -> DataFrame:
    """All pairs (a, b) of a bucket's members in different components whose sizes and long signatures allow a link.

    rows: (bucket, id, component, n, long, bands, size of the bucket). A bucket of more than BLOCK members is parted into
    blocks, and each pair of blocks is a group of its own; so no task holds more than about two blocks of a bucket.
    A pair that shares several buckets is made in the first of them only.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("id"), blocks).cast("int")
    dealt = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    group = dealt.select("bucket", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "id", "component", "n", "long", "bands")
    small, large = SIMILAR
    first, whole = _lowest_estimate(128), _lowest_estimate(LONG)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(bucket: int, held: list[tuple]) -> pa.RecordBatch:
            ids, comps, n = (np.array([r[i] for r in held]) for i in range(3))
            out: list[tuple[np.ndarray, np.ndarray]] = []
            if (comps != comps[0]).any():
                s = np.frombuffer(b"".join(r[3] for r in held), np.uint8).reshape(len(held), -1)
                head, bands = np.ascontiguousarray(s[:, :128]), np.stack([r[4] for r in held])
                band = int(np.flatnonzero(bands[0] == bucket)[0])
                for i in range(len(held) - 1):
                    near = np.flatnonzero((comps[i + 1 :] != comps[i]) & (large * np.minimum(n[i + 1 :], n[i]) >= small * np.maximum(n[i + 1 :], n[i]))) + i + 1
                    near = near[(head[near] == head[i]).mean(axis=1) >= first] if len(near) else near
                    near = near[~(bands[near, :band] == bands[i, :band]).any(axis=1)] if len(near) else near
                    near = near[(s[near] == s[i]).mean(axis=1) >= whole] if len(near) else near
                    if len(near):
                        out.append((np.minimum(ids[i], ids[near]), np.maximum(ids[i], ids[near])))
            a, b = (np.concatenate([p[x] for p in out]) if out else np.zeros(0, np.int64) for x in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        key, held = None, []
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                columns = [batch.column(c).slice(at, 1024).to_pylist() for c in ("bucket", "low", "high", "id", "component", "n", "long")]
                bands = batch.column("bands").slice(at, 1024).flatten().to_numpy().reshape(-1, BANDS)
                for bucket, low, high, *row in zip(*columns, bands):
                    if (bucket, low, high) != key:
                        if len(held) > 1:
                            yield pairs(key[0], held)
                        key, held = (bucket, low, high), []
                    held.append(row)
        if len(held) > 1:
            yield pairs(key[0], held)

    keys = ["bucket", "low", "high"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return group.repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(compare, "a long, b long").filter("a <> b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = SHINGLE_WORDS) -> DataFrame:
    """(id, n_shingles, component) for every row: size of its shingle set and smallest id linked with it, directly or not.

    Null and empty texts have no shingles and are linked with nothing. Rows with the same id are one document, each with
    the set of its own text. A row with a null id is linked with nothing and has no component.
    """
    sketch = stored(sketches(docs, id_col, text, k), "sketches")
    some = sketch.filter("n > 0 and id is not null")
    classes = stored(some.groupBy("set_a", "set_b", "n").agg(F.min("id").alias("rep")), "classes")
    reps = some.join(classes.withColumnRenamed("rep", "id"), ["id", "set_a", "set_b", "n"], "left_semi")
    features = stored(reps.select("id", "n", "signature", "bands").dropDuplicates(["id", "signature"]), "features")

    rows = features.select("id", F.explode("bands").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high")
    shared = stored(rows.join(sizes.select("bucket", "size"), "bucket"), "buckets")
    sets = stored(_sets(docs, shared.select("id").distinct(), id_col, text, k), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        return stored(_linked(stored(_promising(pairs, features), "candidates"), sets), "links")

    def labelled(found: DataFrame) -> DataFrame:
        """The members of buckets that are still in several components."""
        named = shared.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
        apart = named.groupBy("bucket").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).filter("c0 < c1").select("bucket")
        return named.join(apart, "bucket", "left_semi")

    def stars(members: DataFrame, turn: int) -> DataFrame:
        """For every member SEEDS leaders in other components, drawn by hash from its buckets; linked ones come first."""
        dealt = members.withColumn("seed", F.explode(F.array(*[F.lit(turn * SEEDS + i) for i in range(SEEDS)])))
        rank = F.struct(F.col("linked"), F.xxhash64("id", "seed").alias("rank"), F.col("id"), F.col("component"))
        leaders = dealt.groupBy("bucket", "seed").agg(F.max(rank).alias("leader"))
        apart = dealt.join(leaders, ["bucket", "seed"]).filter("id <> leader.id and component <> leader.component")
        best = apart.groupBy("id", "seed").agg(F.max("leader").alias("leader"))
        return best.select(*_ordered("id", "leader.id")).distinct()

    links, turn = verified(stars(shared.withColumns({"component": F.col("id"), "linked": F.lit(False)}), 0)), 0
    while True:  # as long as they find many new links
        found, turn = components(links), turn + 1
        linked = found.select(F.col("node").alias("id"), F.lit(True).alias("linked"))
        apart = stored(labelled(found).join(linked, "id", "left").fillna(False, ["linked"]), "open-buckets")
        pairs = stored(stars(apart, turn), "stars")
        new = verified(pairs)
        links = stored(links.union(new), "all-links")
        if new.count() * 20 <= pairs.count():
            break
    found = components(links)
    rest = stored(labelled(found).select("bucket", "id", "component", "size"), "open-buckets")
    signed = _long_signatures(sets.join(rest.select("id").distinct(), "id", "left_semi")).join(features.select("id", "n", "bands"), "id")
    links = links.union(stored(_linked(stored(_across(rest.join(signed, "id")), "candidates"), sets), "links"))
    found = stored(components(links), "components")

    ends = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "set_a", "set_b", "n", F.coalesce("component", "rep").alias("component")
    )
    linked = sketch.select("id", "n", "set_a", "set_b").join(ends, ["set_a", "set_b", "n"], "left")
    return linked.select("id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = SHINGLE_WORDS) -> DataFrame:
    """The rows whose id is the smallest of its group; rows with a null id stay.

    Of rows with one id one stays, that with the smallest text, of equal texts that with the smallest hash of its columns.
    """
    kept = near_duplicates(docs, id_col, text, k).filter("id = component").select("id").distinct()
    rows = docs.join(kept, docs[f"`{id_col}`"] == kept["id"], "left_semi")
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = rows.groupBy(F.col(f"`{id_col}`").alias("__id")).agg(F.min_by(whole, F.struct(F.col(f"`{text}`"), F.xxhash64(*hashed))).alias("__row"))
    return first.select("__row.*").unionByName(docs.filter(F.col(id_col).isNull()))
