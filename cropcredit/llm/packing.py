"""Bulk-synchronous best-fit packing of whole token sequences.

Documents are tokenised, closed with an end id and cut into pieces of at most ``capacity``
tokens (only longer ones are cut; a first piece takes the remainder). Pieces are then packed:

1. Pieces are range-sorted by length as runs: a piece is known by its length and its rank among
   the pieces of that length. Ranks come from salted local row numbers plus prefix sums of the
   (length, salt) counts, so no length, however frequent, is one task.
2. Gaps (free room of the open sequences) are runs too: consecutive sequences with equal room.
3. Supersteps, longest pieces first: the unplaced run of a length finds its successor, the
   smallest gap that still holds it; conflicts are resolved by rank (rank r of the pieces takes
   the r-th sequence of the gap run); the gaps left go back as new runs; repeat. With no
   successor, new sequences open.
4. Each row reads its place from the plan by (length, rank).

There are at most ``capacity`` lengths and gap sizes, so the state of step 3 is bounded by the
capacity, not by the rows; all work on rows is distributed.

Null or empty texts give one piece that holds the end id alone. Repeated rows are packed each.
An empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cropcredit.llm.bpe import encoder
from cropcredit.llm.common import map_arrow, materialize

#: Rows that share a salt, about.
ROWS_PER_SALT = 20_000


def cut(n: int, capacity: int):
    """(start, length) of the pieces of n tokens."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    parts = [(0, first)] if first else []
    return parts + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, specials: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for every piece of every document."""
    end = np.array([end_id], np.uint32)

    def run(batches):
        enc = encoder(tokenizer, specials)
        for b in batches:
            out = ([], [], [], [], [])
            for doc, ids in zip(b.column(0).to_pylist(), enc.rows(b.column(1))):
                ids = np.concatenate([ids, end]).astype("<u4")
                for k, (start, n) in enumerate(cut(len(ids), capacity)):
                    for col, v in zip(out, (doc, k, start, n, zlib.crc32(ids[start: start + n].tobytes()))):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_arrow(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit_runs(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """The plan: (length, first rank, end rank, first sequence, offset). Rank r of the length
    goes to sequence ``first sequence + r - first rank``."""
    plan, gaps, sizes, opened = [], defaultdict(list), [], 0

    def put(gap, first, n):
        if gap > 0:
            if not gaps[gap]:
                insort(sizes, gap)
            gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, end = 0, counts[length]
        while rank < end:
            k = bisect_left(sizes, length)
            if k < len(sizes):
                gap = sizes[k]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    sizes.pop(k)
                use = min(n, end - rank)
                if use < n:
                    put(gap, first + use, n - use)
            else:
                gap, first = capacity, opened
                use = -(-(end - rank) // (capacity // length))
                opened += use
            plan.append((length, rank, rank + use, first, capacity - gap))
            put(gap - length, first, use)
            rank += use
    return plan


def rank_in_length(items: DataFrame, length: str, order: list[str]) -> DataFrame:
    """Adds ``rank``: a number from 0 among the rows of equal length, without gaps."""
    salts = 1 + items.count() // ROWS_PER_SALT
    t = items.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    base = t.groupBy(length, "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(length).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    base = base.select(length, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    local = F.row_number().over(Window.partitionBy(length, "_salt").orderBy(*order)) - 1
    return (t.withColumn("_local", local).join(base, [length, "_salt"])
            .withColumn("rank", F.col("_base") + F.col("_local")).drop("_salt", "_base", "_local"))


def pack(items: DataFrame, capacity: int, order: list[str], length: str = "length") -> DataFrame:
    """Adds sequence_id and offset to rows that carry a length of 1 to ``capacity``. ``order``
    names columns that tell rows apart. ``items`` should be materialised: it is read three times."""
    spark = items.sparkSession
    counts = {int(r[0]): int(r[1]) for r in items.groupBy(length).count().collect()}  # <= capacity rows
    plan = spark.createDataFrame(best_fit_runs(counts, capacity) or [(0, 0, 0, 0, 0)],
                                 "_len long, _lo long, _hi long, _first long, _offset long")
    r = rank_in_length(items, length, order)
    hit = (F.col(length) == F.col("_len")) & (F.col("rank") >= F.col("_lo")) & (F.col("rank") < F.col("_hi"))
    return r.join(F.broadcast(plan), hit).select(
        *items.columns, (F.col("_first") + F.col("rank") - F.col("_lo")).alias("sequence_id"),
        F.col("_offset").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024, specials: bool = False) -> DataFrame:
    """Pieces of all documents with their places: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset. ``specials`` as in ``bpe``."""
    p = materialize(pieces(docs, tokenizer, end_id, capacity, specials), "pieces")
    return pack(p, capacity, ["doc_id", "piece", "ids_crc32", "start"])
