"""Discrimination and calibration metrics of a scored frame (label 0/1, score).

Everything is rank arithmetic over the score distribution. It is computed without a
global single-partition window:

1. per distinct score, positive / negative counts (partial aggregation map-side, so a
   score carried by a third of all rows is a single row afterwards);
2. distinct scores are range-bucketed by approximate quantiles of the scores and the
   per-bucket totals (one row per bucket) are collected; their running offsets are
   broadcast back;
3. running sums are taken within each bucket (a window partitioned by bucket) plus the
   bucket offset.

Quantile positions use exact integer arithmetic: q = k/B over n values sits at rank
floor((n-1)k/B) with fraction ((n-1)k mod B)/B, interpolated linearly.
Only bounded results reach the driver: bucket totals, <= 202 quantile ranks, and the
metric rows themselves (<= 101 points).
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cropcredit.session import BROADCAST_ROWS, written

# Distinct scores per bucket, about: the number of buckets follows the data.
BUCKET_SCORES = 50_000


@dataclass
class ScoreDistribution:
    """Distinct scores with counts and inclusive running counts (per group if ``by``)."""

    table: DataFrame  # [by,] bucket, score, pos, neg, n, cum_pos, cum_neg, cum_n, grp_pos, grp_neg
    spans: dict  # group (None if ungrouped) -> [(bucket, start_n, end_n)] in order
    sizes: dict  # group -> (positives, negatives)
    n_pos: int
    n_neg: int
    by: str | None = None
    by_type: str = "int"

    @property
    def n(self) -> int:
        return self.n_pos + self.n_neg

    def groups(self, rows: list, columns: str) -> DataFrame:
        """A small table of (group, ...) tuples; the group is dropped where there is none."""
        t = self.table.sparkSession.createDataFrame(rows, f"_g {self.by_type}, {columns}")
        return t.withColumnRenamed("_g", self.by) if self.by else t.drop("_g")

    @property
    def keys(self) -> list:
        return [self.by] if self.by else []


def score_distribution(scored: DataFrame, label: str = "y", score: str = "p",
                       bucket_scores: int = BUCKET_SCORES, by: str | None = None) -> ScoreDistribution:
    """``by`` names a grouping column with few values (folds, crop years): bucket bounds
    are shared, running sums restart per group. Collected: one row per (group, bucket)."""
    spark = scored.sparkSession
    keys = [by] if by else []
    counts = scored.where(F.col(score).isNotNull()).groupBy(
        *keys, F.col(score).cast("double").alias("score")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("long").alias("neg"),
    )
    # reused by the quantile sketch, the bucket totals and the running sums
    counts = written(counts.withColumn("n", F.col("pos") + F.col("neg")), "scores")
    n_buckets = 1 + counts.count() // bucket_scores
    probs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = sorted(set(b for b in counts.approxQuantile("score", probs, 1.0 / (4 * n_buckets))
                        if b == b)) if n_buckets > 1 else []
    splits = [float("-inf"), *bounds, float("inf")]
    if len(splits) > 2:
        bz = Bucketizer(splits=splits, inputCol="score", outputCol="_b", handleInvalid="keep")
        counts = bz.transform(counts).withColumn("bucket", F.col("_b").cast("int")).drop("_b")
    else:
        counts = counts.withColumn("bucket", F.lit(0))
    totals = counts.groupBy(*keys, "bucket").agg(
        F.sum("pos").alias("tp"), F.sum("neg").alias("tn")).orderBy(*keys, "bucket").collect()
    acc, rows, spans = {}, [], {}
    grp_tot = {}
    for r in totals:
        g = r[by] if by else None
        grp_tot.setdefault(g, [0, 0])
        grp_tot[g][0] += r["tp"]
        grp_tot[g][1] += r["tn"]
    for r in totals:
        g = r[by] if by else None
        ap, an = acc.get(g, (0, 0))
        rows.append((g, r["bucket"], ap, an, grp_tot[g][0], grp_tot[g][1]))
        spans.setdefault(g, []).append((r["bucket"], ap + an, ap + an + r["tp"] + r["tn"]))
        acc[g] = (ap + r["tp"], an + r["tn"])
    gtype = dict(scored.dtypes)[by] if by else "int"
    offsets = spark.createDataFrame(
        rows or [(None, 0, 0, 0, 0, 0)],
        f"_g {gtype}, bucket int, off_pos long, off_neg long, grp_pos long, grp_neg long")
    if by:
        offsets = offsets.withColumnRenamed("_g", by)
        on = [by, "bucket"]
    else:
        offsets = offsets.drop("_g")
        on = ["bucket"]
    w = W.partitionBy(*keys, "bucket").orderBy("score").rowsBetween(W.unboundedPreceding, W.currentRow)
    t = counts.join(F.broadcast(offsets) if len(rows) <= BROADCAST_ROWS else offsets, on).select(
        *keys, "bucket", "score", "pos", "neg", "n",
        (F.col("off_pos") + F.sum("pos").over(w)).alias("cum_pos"),
        (F.col("off_neg") + F.sum("neg").over(w)).alias("cum_neg"),
        "grp_pos", "grp_neg",
    ).withColumn("cum_n", F.col("cum_pos") + F.col("cum_neg"))
    P = sum(v[0] for v in grp_tot.values())
    N = sum(v[1] for v in grp_tot.values())
    return ScoreDistribution(t, spans, {g: tuple(v) for g, v in grp_tot.items()}, P, N, by, gtype)


def core_metrics(scored: DataFrame, label: str = "y", score: str = "p",
                 dist: ScoreDistribution | None = None, by: str | None = None) -> DataFrame:
    """auroc (tie-aware, NULL with one class), ks, brier, n, n_pos - one row, or one
    per ``by`` group. Brier comes from the per-score table: sum pos*(s-1)^2 + neg*s^2."""
    dist = dist or score_distribution(scored, label, score, by=by)
    s = F.col("score")
    P, N = F.first("grp_pos"), F.first("grp_neg")
    auc_num = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") * 0.5))
    gap = F.abs(F.col("cum_pos") / F.greatest(F.col("grp_pos"), F.lit(1)).cast("double")
                - F.col("cum_neg") / F.greatest(F.col("grp_neg"), F.lit(1)).cast("double"))
    sq = F.sum(F.col("pos") * F.pow(s - 1.0, 2) + F.col("neg") * F.pow(s, 2))
    aggs = [
        F.when((P > 0) & (N > 0), auc_num / (P.cast("double") * N.cast("double"))).alias("auroc"),
        F.max(gap).alias("ks"),
        (sq / F.greatest(P + N, F.lit(1)).cast("double")).alias("brier"),
        (P + N).cast("long").alias("n"),
        P.cast("long").alias("n_pos"),
    ]
    keys = [dist.by] if dist.by else []
    g = dist.table.groupBy(*keys) if keys else dist.table
    return g.agg(*aggs)


def _rank_targets(n: int, steps: int) -> list:
    """(k, lo, hi, frac) for quantiles k/steps, k = 0..steps."""
    out = []
    for k in range(steps + 1):
        num = (n - 1) * k
        lo, rem = divmod(num, steps)
        hi = lo + (1 if rem else 0)
        out.append((k, lo, hi, rem / steps))
    return out


def quantile_values(dist: ScoreDistribution, steps: int) -> DataFrame:
    """([group,] k, lo_score, hi_score, frac, value) for quantiles k/steps of the scored rows (of each group). The wanted
    ranks, at most 2 * (steps + 1) a group, meet the buckets that hold them in one join, however many groups there are."""
    ranks, targets = [], []
    for g, (pos, neg) in dist.sizes.items():
        if not pos + neg:
            continue
        mine = _rank_targets(pos + neg, steps)
        targets += [(g, *t) for t in mine]
        starts = [start for _, start, _ in dist.spans[g]]
        for r in sorted({t[1] for t in mine} | {t[2] for t in mine}):
            ranks.append((g, r, dist.spans[g][bisect.bisect_right(starts, r) - 1][0]))
    rk = dist.groups(ranks, "r long, bucket int")
    keys = dist.keys
    hit = dist.table.join(F.broadcast(rk), [*keys, "bucket"]).where(
        (F.col("cum_n") - F.col("n") <= F.col("r")) & (F.col("r") < F.col("cum_n"))
    ).select(*keys, "r", "score", "cum_pos", "cum_neg")
    tg = dist.groups(targets, "k int, lo long, hi long, frac double")
    lo = hit.select(*keys, F.col("r").alias("lo"), F.col("score").alias("lo_score"),
                    F.col("cum_pos").alias("lo_cum_pos"), F.col("cum_neg").alias("lo_cum_neg"))
    hi = hit.select(*keys, F.col("r").alias("hi"), F.col("score").alias("hi_score"),
                    F.col("cum_pos").alias("hi_cum_pos"), F.col("cum_neg").alias("hi_cum_neg"))
    q = tg.join(lo, [*keys, "lo"]).join(hi, [*keys, "hi"])
    return q.withColumn(
        "value", F.col("lo_score") + (F.col("hi_score") - F.col("lo_score")) * F.col("frac"))


def exact_quantiles(df: DataFrame, column: str, probs_steps: int) -> DataFrame:
    """Exact linear-interpolated quantiles k/steps of a numeric column (all rows)."""
    scored = df.select(F.lit(0).alias("y"), F.col(column).alias("p"))
    return quantile_values(score_distribution(scored), probs_steps).select("k", "value")


def ks_curve(scored: DataFrame, label: str = "y", score: str = "p", n: int = 101,
             dist: ScoreDistribution | None = None, by: str | None = None) -> DataFrame:
    """Class CDFs at n score quantiles: ([group,] k, score, cdf_pos, cdf_neg)."""
    dist = dist or score_distribution(scored, label, score, by=by)
    q = quantile_values(dist, n - 1)
    at_hi = F.col("value") >= F.col("hi_score")
    cum_pos = F.when(at_hi, F.col("hi_cum_pos")).otherwise(F.col("lo_cum_pos"))
    cum_neg = F.when(at_hi, F.col("hi_cum_neg")).otherwise(F.col("lo_cum_neg"))
    sizes = dist.groups([(g, float(max(pos, 1)), float(max(neg, 1))) for g, (pos, neg) in dist.sizes.items()], "_pos double, _neg double")
    if dist.by:
        q = q.join(F.broadcast(sizes), dist.by)  # one row per group
    else:
        q = q.withColumns({"_pos": F.lit(float(max(dist.n_pos, 1))), "_neg": F.lit(float(max(dist.n_neg, 1)))})
    return q.select(*dist.keys, "k", F.col("value").alias("score"), (cum_pos / F.col("_pos")).alias("cdf_pos"), (cum_neg / F.col("_neg")).alias("cdf_neg"))


def calibration(scored: DataFrame, label: str = "y", score: str = "p", n_bins: int = 10,
                dist: ScoreDistribution | None = None, by: str | None = None) -> DataFrame:
    """Quantile-bin calibration: ([group,] bin, mean_pred, frac_pos); empty bins are absent.
    A score equal to an inner edge belongs to the lower bin."""
    dist = dist or score_distribution(scored, label, score, by=by)
    edges = {}
    for r in quantile_values(dist, n_bins).where(F.col("k").between(1, n_bins - 1)).orderBy("k").collect():  # n_bins a group
        edges.setdefault(r[dist.by] if dist.by else None, []).append(r["value"])
    inner = dist.groups(list(edges.items()), "_edges array<double>")
    s = scored.where(F.col(score).isNotNull())
    s = s.join(F.broadcast(inner), dist.by) if dist.by else s.withColumn("_edges", F.array(*[F.lit(e) for e in edges.get(None, [])]))
    p = F.col(score).cast("double")
    return s.groupBy(*dist.keys, F.size(F.filter("_edges", lambda e: e < p)).alias("bin")).agg(
        F.avg(F.col(score)).alias("mean_pred"), F.avg(F.col(label).cast("double")).alias("frac_pos"))


def roc_points(scored: DataFrame, label: str = "y", score: str = "p", n: int = 101,
               dist: ScoreDistribution | None = None, by: str | None = None) -> DataFrame:
    """ROC interpolated on n uniform FPR points: ([group,] k, fpr, tpr), for groups with both classes. Where several curve
    points share an FPR equal to a grid value, the last (highest TPR) counts."""
    dist = dist or score_distribution(scored, label, score, by=by)
    steps, keys = n - 1, dist.keys
    both = {g: v for g, v in dist.sizes.items() if v[0] and v[1]}
    # curve point per distinct score (threshold): counts of scores >= s; and the origin of each group
    pts = dist.table.where("grp_pos > 0 and grp_neg > 0").select(
        *keys, "score", (F.col("grp_neg") - F.col("cum_neg") + F.col("neg")).alias("fps"), (F.col("grp_pos") - F.col("cum_pos") + F.col("pos")).alias("tps"),
        F.col("grp_pos").alias("P"), F.col("grp_neg").alias("N"))
    origin = dist.groups([(g, float("inf"), 0, 0, pos, neg) for g, (pos, neg) in both.items()], "score double, fps long, tps long, P long, N long")
    pts = pts.unionByName(origin)
    # first grid index at or right of the point: ceil(steps * fps / N), integer-exact
    cell = F.expr(f"(fps * {steps} + N - 1) div N")
    pt = F.struct("fps", "tps")
    per_cell = pts.groupBy(*keys, cell.alias("c")).agg(
        F.min_by(pt, F.col("score")).alias("last"), F.max_by(pt, F.col("score")).alias("first"))
    grid = dist.groups([(g, k, float(pos), float(neg)) for g, (pos, neg) in both.items() for k in range(n)], "k long, P double, N double")
    # both sides bounded: <= steps+2 cells against steps+1 grid points of a group
    pc = F.broadcast(per_cell)

    def of(test, pick):
        on = test if not keys else test & (F.col(f"g.{dist.by}") == F.col(f"c.{dist.by}"))
        return grid.alias("g").join(pc.alias("c"), on).groupBy(*[f"g.{c}" for c in keys], "g.k").agg(pick)

    left = of(F.col("c") <= F.col("k"), F.max_by("last", "c").alias("L"))
    right = of(F.col("c") > F.col("k"), F.min_by("first", "c").alias("R"))
    g = grid.join(left, [*keys, "k"], "left").join(right, [*keys, "k"], "left")
    lf, lt = F.col("L.fps") / F.col("N"), F.col("L.tps") / F.col("P")
    rf, rt = F.col("R.fps") / F.col("N"), F.col("R.tps") / F.col("P")
    x = F.col("k") / F.lit(float(steps))
    tpr = F.when(F.col("R").isNull(), lt).otherwise(lt + (rt - lt) * (x - lf) / (rf - lf))
    return g.select(*keys, F.col("k").cast("int").alias("k"), x.alias("fpr"), tpr.alias("tpr"))
