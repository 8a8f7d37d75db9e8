"""Mix sources to target weights by Pareto order sampling. DataFrame functions only.

Sizes are words: runs of characters other than ASCII white space (null text: 0). All sizes
together are shared among the sources by weight; a source stops at ``most`` times its size and
the excess goes to the others by weight (a water level: target = min(most * size, level * weight),
found in closed form over the sources sorted by the ratio of cap to weight).

Each document wants c = rho + min(rho, most - rho) * delta copies: rho is its source's target
over size, delta in (-1, 1) prefers longer documents and sums to 0 over the source's words.
floor(c) whole copies are certain; the remainder c - floor(c) is its inclusion probability in one
more copy. Documents are ranked by random odds over inclusion odds, u / (1 - u) * (1 - p) / p, and
taken in that order until the source's words are used up (a sample of fixed size in words; the one
at the cut is taken if that is nearer). Random numbers are digests of seed, doc_id and text, so
reruns agree, and rows equal in both are decided alike.

The cut is found without sorting a source: rows are counted in buckets of the rank (as many as the
source needs for about ``BUCKET_ROWS`` rows each), prefix sums find the bucket of the cut, and only
that bucket is sorted. A hot source is never one task.

Null texts and empty texts have size 0 and are taken 0 times (their copies count floor(c), no
words). A null source is a source of its own, ordered last. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cropcredit.llm.common import join_small, materialize

WEIGHTS = (5, 2, 1)
MOST = 3
BUCKET_ROWS = 5000
WORDS = r"[^\x20\x09-\x0D]+"


def measured(docs: DataFrame, seed: str) -> DataFrame:
    """Adds _size (words) and _h (52 random bits)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), text)
    return (docs.withColumn("_size", F.regexp_count(text, F.lit(WORDS)).cast("long"))
            .withColumn("_h", F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long")))


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, n, target: one row per source."""
    s = sizes.groupBy("source").agg(F.sum("_size").alias("source_size"), F.count("*").alias("n"))
    w = Window.orderBy(F.col("source").asc_nulls_last())  # windows over one row per source
    cycle = F.array(*[F.lit(x) for x in weights])
    s = s.withColumn("weight", F.element_at(cycle, (F.pmod(F.row_number().over(w) - 1, F.lit(len(weights))) + 1).cast("int")))
    s = s.withColumn("_ratio", most * F.col("source_size") / F.col("weight"))
    order = [F.col("_ratio"), F.col("source").asc_nulls_last()]
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(most * F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(after)
    s = s.withColumn("_level", level)
    s = s.withColumn("_level", F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_level"))).over(everything)["_level"])
    target = F.when(F.col("_ratio") < F.col("_level"), (most * F.col("source_size")).cast("double")).otherwise(
        F.col("_level") * F.col("weight"))
    return s.select("source", "source_size", "n", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


def _same(a: DataFrame, b: DataFrame):
    return a["source"].eqNullSafe(b["_source"])


def _with_source(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Join a table of one row per source."""
    t = table.withColumnRenamed("source", "_source")
    return join_small(rows, t, _same(rows, t), "left").drop("_source")


def _wants(rows: DataFrame, most: int) -> DataFrame:
    """Adds _base (certain copies), _p (inclusion probability) and _q (rank) to rows that have
    _size, _h and the columns of the source (source_size, target, _mean, _lean)."""
    rho = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    delta = (_long() - F.col("_lean")) / 1000
    c = F.greatest(F.lit(0.0), F.least(F.lit(float(most)), rho + F.least(rho, most - rho) * delta))
    rows = rows.withColumn("_c", F.when(F.col("_size") > 0, c).otherwise(rho))
    rows = rows.withColumn("_base", F.floor("_c")).withColumn("_p", F.col("_c") - F.col("_base"))
    u = (F.col("_h") + 0.5) / float(1 << 52)
    q = u / (1 - u) * ((1 - F.col("_p")) / F.col("_p"))
    return rows.withColumn("_q", F.when((F.col("_p") > 0) & (F.col("_size") > 0), q)).drop("_c")


def _long():
    """How long a document is against its source's mean, 0 to 999."""
    return F.floor(1000 * F.col("_size") / (F.col("_size") + F.col("_mean")))


def _bucket():
    """A rank's bucket: monotone in _q and nearly even, 0 .. _buckets - 1."""
    x = F.col("_q") * F.col("_share")
    return F.least(F.floor(x / (x + 1 - F.col("_share")) * F.col("_buckets")), F.col("_buckets") - 1)


def plan(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: what ``decide`` needs to settle each document by itself. ``sizes`` has
    source, _size and _h and should be materialised."""
    per = source_targets(sizes, weights, most)
    per = materialize(per.withColumn("_mean", F.floor(F.col("source_size") / F.col("n"))), "sources")
    lean = _with_source(sizes.where("_size > 0"), per).groupBy("source").agg(
        F.sum(_long() * F.col("_size")).alias("_lean"))
    per = materialize(_with_source(per, materialize(lean, "lean")).withColumn(
        "_lean", F.coalesce(F.col("_lean") / F.col("source_size"), F.lit(0.0))), "sources")
    wants = _wants(_with_source(sizes.where("_size > 0"), per), most)
    rest = wants.groupBy("source").agg(
        F.sum(F.col("_base") * F.col("_size")).alias("_sure"), F.sum(F.floor(F.col("_p") * 1000000)).alias("_ps"))
    per = _with_source(per, materialize(rest, "rest"))
    share = F.col("_ps") / F.col("n") / 1000000
    per = (per.withColumn("_rest", F.col("target") - F.coalesce("_sure", F.lit(0)))
           .withColumn("_share", F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.coalesce(share, F.lit(0.5)))))
           .withColumn("_buckets", 1 + F.floor(F.col("n") / BUCKET_ROWS)).drop("_sure", "_ps"))
    per = materialize(per, "sources")
    ranked = _wants(_with_source(sizes.where("_size > 0"), per), most).where("_q is not null").withColumn("_b", _bucket())
    sums = ranked.groupBy("source", "_b").agg(F.sum("_size").alias("_words"), F.first("_rest").alias("_rest"))
    before = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_done", F.coalesce(F.sum("_words").over(before), F.lit(0)))
    cross = sums.where("_done < _rest").groupBy("source").agg(
        F.max("_b").alias("_cut_b"), F.max_by("_done", "_b").alias("_cut_done"))
    per = materialize(_with_source(per, materialize(cross, "cross")), "sources")
    # the bucket of the cut alone, peers (equal rank and digest) together
    last = _wants(_with_source(sizes.where("_size > 0"), per), most).where("_q is not null")
    last = last.where(_bucket() == F.col("_cut_b")).groupBy("source", "_q", "_h").agg(
        F.sum("_size").alias("_words"), F.first("_rest").alias("_rest"), F.first("_cut_done").alias("_cut_done"))
    cum = F.sum("_words").over(Window.partitionBy("source").orderBy("_q", "_h")) + F.col("_cut_done")
    last = last.withColumn("_cum", cum).withColumn("_was", F.col("_cum") - F.col("_words"))
    take = (F.col("_was") < F.col("_rest")) & ((F.col("_cum") <= F.col("_rest")) | (F.col("_cum") - F.col("_rest") <= F.col("_rest") - F.col("_was")))
    cut = last.where(take).groupBy("source").agg(F.max(F.struct("_q", "_h")).alias("_cut"))
    return materialize(_with_source(per, materialize(cut, "cut")), "sources")


def decide(rows: DataFrame, per: DataFrame, most: int = MOST) -> DataFrame:
    """Adds copies (how often the mix takes a document), source_size and target to rows that have
    source, _size and _h."""
    added = [c for c in per.columns if c != "source"]
    names = [c for c in rows.columns if c not in added]
    r = _wants(_with_source(rows.select(*names), per), most)
    r = r.withColumn("_b", _bucket())
    inside = (F.col("_b") < F.col("_cut_b")) | ((F.col("_b") == F.col("_cut_b")) & (F.struct("_q", "_h") <= F.col("_cut")))
    extra = F.coalesce(inside, F.lit(False)) & F.col("_q").isNotNull()
    return r.withColumn("copies", (F.col("_base") + extra.cast("int")).cast("long")).select(
        *names, "source_size", "target", "copies")


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: str = "mix") -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every document."""
    sizes = materialize(measured(docs.select("doc_id", "source", "text"), seed).select("doc_id", "source", "_size", "_h"), "sizes")
    d = decide(sizes, plan(sizes, weights, most), most)
    return d.select("doc_id", "source", F.col("_size").alias("size"), "source_size", "target", "copies",
                    (F.col("copies") * F.col("_size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: str = "mix") -> DataFrame:
    """The mix itself: every document as often as it is taken, with its columns."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("_row")  # no column of the input meets one of ours
    m = measured(docs.select(row, "doc_id", "source", "text"), seed).select("_row", "source", "_size", "_h")
    sizes = materialize(m.select("source", "_size", "_h"), "sizes")
    d = decide(m, plan(sizes, weights, most), most)
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return d.where("copies > 0").select("_row", copies.alias("_copy")).select("_row.*")
