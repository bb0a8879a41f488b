"""Best-fit packing of documents into training sequences, under conflicts.

No bin holds two documents of one source or of one duplicate cluster. Documents are taken longest first; open bins are ordered
by their residual room and carry a bitmap of their sources and one of their clusters. From the tightest bin that has
room the search goes on through its successors until one is compatible; if none is, a new bin is opened.

Constraints bind only within a bin, so documents are dealt at random over shards of about `SHARD` documents, each
packed by one task: a source or cluster of any size is spread over all shards, and only lengths are shuffled, no texts. A
document longer than a bin is cut into full bins of its own and a rest, which is packed.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

CAPACITY = 2048  # words
SHARD = 4096

WORD = r"[^\x20\x09-\x0D]+"


def pack(items: list[tuple[int, int, int]], capacity: int) -> list[int]:
    """The bin of each item (length, source, cluster), best fit in the given order; source 0 and cluster 0 never conflict."""
    order: list[tuple[int, int]] = []  # (residual room, bin) of the open bins
    sources: list[int] = []
    clusters: list[int] = []
    out = []
    for length, source, cluster in items:
        s, c = (1 << source) & ~1, (1 << cluster) & ~1
        at = bisect_left(order, (length, -1))
        while at < len(order) and (sources[order[at][1]] & s or clusters[order[at][1]] & c):
            at += 1
        if at < len(order):
            room, number = order.pop(at)
        else:
            room, number = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        sources[number] |= s
        clusters[number] |= c
        if room > length:
            insort(order, (room - length, number))
        out.append(number)
    return out


def _numbers(values: list, shared_only: bool = False) -> list[int]:
    """Bits for the values: 0 for null, and for values that occur once if only shared ones matter."""
    count = Counter(values)
    known: dict = {}
    return [0 if v is None or (shared_only and count[v] == 1) else known.setdefault(v, len(known) + 1) for v in values]


PACKED = "bin_id long, doc_id long, piece int, first_word long, n_words long, source string, cluster string"


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", cluster: str | None = None,
    capacity: int = CAPACITY, shard: int = SHARD,
) -> DataFrame:
    """One row for each piece of each document: its bin, its words [first_word, first_word + n_words) and their document.

    The cluster is a column, else the copies of a text (equal texts) are a cluster. A null source or cluster conflicts
    with nothing. A null or blank text is one piece of no words without a bin. Repeated rows are packed each; equal texts are
    a cluster and so lie in different bins. bin_id counts bins within a shard, plus the shard times 2**32.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("n"),
        F.col(source).cast("string").alias("source"), (F.col(cluster).cast("string") if cluster else F.md5(F.col(text))).alias("cluster"),
    )
    shards = max(1, -(-docs.count() // shard))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(shards)))

    def fill(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by([("n", "descending"), ("doc_id", "ascending"), ("cluster", "ascending")])
        base = int(key[0].as_py()) << 32
        ids, sizes, names, groups = (table[c].to_pylist() for c in ("doc_id", "n", "source", "cluster"))
        full: list[tuple] = []
        rest: list[tuple] = []
        for d, n, s, c in zip(ids, sizes, names, groups):
            cuts, last = divmod(n, capacity)
            full += [(d, i, i * capacity, capacity, s, c) for i in range(cuts)]
            if last or not n:
                rest.append((d, cuts, cuts * capacity, last, s, c))
        rest.sort(key=lambda r: -r[3])
        some = [r for r in rest if r[3]]
        bins = pack(list(zip([r[3] for r in some], _numbers([r[4] for r in some]), _numbers([r[5] for r in some], True))), capacity)
        first = max(bins, default=-1) + 1
        out = [(base + b, *r) for b, r in zip(bins, some)]
        out += [(base + first + i, *r) for i, r in enumerate(full)]
        out += [(None, *r) for r in rest if not r[3]]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], [c.split()[0] for c in PACKED.split(", ")])

    return rows.groupBy("shard").applyInArrow(fill, PACKED)
