"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cropcredit.session import ensure_checkpoint_dir

#: Largest side that ``join_small`` broadcasts; the rows are counted first.
BROADCAST_ROWS = 500_000
#: Largest Arrow batch that goes to a Python worker.
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="ship-"), "cropcredit_package.zip")  # addPyFile serves it
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def release() -> None:
    """Give freed memory of a Python worker back to the system: workers live on and run many tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` with batches of at most ``BATCH_BYTES`` (unless the session sets its own limit)
    and memory given back after each task."""
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(BATCH_KEY, None) is None:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            release()

    return df.mapInArrow(run, schema)


def shared_dir(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder and read it back:
    later steps start from the files, not from the lineage above."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with a broadcast of ``small`` if its counted rows (of a few fixed-size columns)
    stay below ``BROADCAST_ROWS``, with a shuffle otherwise. ``small`` should be cheap to
    count (materialised)."""
    n = small.count()
    return big.join(F.broadcast(small) if n <= BROADCAST_ROWS else small, on, how)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def one_row_each(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """``sample`` (doc_id and other columns; a bounded number of rows, one per doc_id) with the column text of each
    document. Of rows that repeat a doc_id the one with the smallest text by hash is taken, so as many rows come out at
    most."""
    text = F.col("text").cast("string")
    found = docs.select("doc_id", text.alias("text")).join(F.broadcast(sample), "doc_id")
    rest = [c for c in sample.columns if c != "doc_id"]
    first = F.min(F.struct(F.xxhash64("text"), "text")).alias("t")
    return found.groupBy("doc_id", *rest).agg(first).select("doc_id", *rest, F.col("t.text").alias("text"))


#: Rows that one range shard of ``ranked`` takes (about).
SHARD_ROWS = 500_000


def ranked(df: DataFrame, group: list[str], order: list[str], position: str, total: str) -> DataFrame:
    """Adds ``position`` (from 0) of each row within its group (null keys are a group) in ascending ``order``,
    nulls first, and ``total``, the rows of its group. Equal rows stand in any order.

    The rows are sorted in range shards over (group, order), so a hot group spreads over many of them; only
    one count per shard and group is summed up. ``df`` should be narrow: it is written twice."""
    spark = df.sparkSession
    df = materialize(df.withColumn("_tie", F.monotonically_increasing_id()), "rows")  # tells equal rows apart
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // SHARD_ROWS))
    keys = [*group, *order, "_tie"]
    at = F.monotonically_increasing_id()  # partition number in the upper 31 bits, row number in the lower 33
    df = df.repartitionByRange(shards, *keys).sortWithinPartitions(*keys).withColumn("_at", at).drop("_tie")
    df = materialize(df.withColumn("_shard", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND((1 << 33) - 1)), "shards")
    counts = df.groupBy("_shard", *group).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    whole, before = W.partitionBy(*group), W.partitionBy(*group).orderBy("_shard").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn(total, F.sum("_n").over(whole)).withColumn(
        "_base", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).drop("_n", "_first")
    counts = materialize(counts.select(F.col("_shard").alias("_of"), *[F.col(g).alias(f"_g_{g}") for g in group], total, "_base"), "counts")
    same = F.col("_shard") == F.col("_of")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    out = join_small(df, counts, same)
    return out.withColumn(position, F.col("_at") + F.col("_base")).drop("_at", "_shard", "_of", "_base", *[f"_g_{g}" for g in group])


def components(edges: DataFrame) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    ``edges``: columns a, b (any orderable type). Returns node, root (smallest node reachable)
    for every node that has an edge to another node. Each star step is a map-side combined
    ``min`` and a join, so a hub's edges never meet in one task; each round is written to the
    shared folder. No edges: an empty table."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    e = materialize(e.distinct(), "edges")
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: edges point from the larger to the smaller node already
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        e = materialize(small, "edges")
        s = e.agg(F.count("*").alias("n"), F.countDistinct("u").alias("k"),
                  F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        now = (s.n, s.k, s.h)
        if s.n == 0 or now == before:
            break
        before = now
    return (
        e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        .union(e.select(F.col("v").alias("node"), F.col("v").alias("root")))
        .distinct()
    )


def block_units(members: DataFrame, bucket: list[str], block: int) -> DataFrame:
    """Deal the members of each bucket over units of work of at most about 2 * ``block`` rows.

    A bucket of n members is cut into k = ceil(n / block) hashed blocks, and every pair of
    blocks (i <= j) is one unit, so each pair of members meets in exactly one unit (pairs in
    one block i: unit (i, i)). ``members`` needs a column ``member`` that tells members apart.
    Adds: unit (struct i, j), side ('a' for the first block of the unit, 'b' for the second).
    Only counts are aggregated; rows of a hot bucket spread over its units."""
    n = members.groupBy(*bucket).agg(F.count("*").alias("_n")).where("_n > 1")
    m = members.join(n, bucket).withColumn("_k", F.ceil(F.col("_n") / F.lit(block)).cast("int"))
    m = m.withColumn("_me", F.pmod(F.xxhash64("member", F.lit(11)), F.col("_k")).cast("int"))
    m = m.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    return m.select(
        *members.columns,
        F.least("_me", "_other").alias("unit_i"),
        F.greatest("_me", "_other").alias("unit_j"),
        F.when(F.col("_me") <= F.col("_other"), F.lit("a")).otherwise(F.lit("b")).alias("side"),
    )


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    while name.lower() in [c.lower() for c in df.columns]:
        name += "_"
    return name
