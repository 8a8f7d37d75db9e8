"""Model-evaluation plans built from the operators (naive model end to end)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcredit.config import GROUP, ModelingOptions, target_name
from cropcredit.operators import metrics as ME
from cropcredit.operators import validation as V
from cropcredit.operators.models import SegmentRate
from cropcredit.session import counted_broadcast, written

ROUND = 9  # digits kept in reported metric values


def naive_in_sample(base: DataFrame, segment: str = "uf", label: str = target_name()) -> DataFrame:
    m = SegmentRate([segment]).fit(base, label)
    return m.transform(base).select("ref_bacen", "nu_ordem", "mutuario", F.col(label).alias("y"), "p")


def rounded(df: DataFrame, cols) -> DataFrame:
    return df.select(*[F.round(F.col(c), ROUND).alias(c) if c in cols else F.col(c) for c in df.columns])


def _seg(col: str):
    return F.coalesce(F.col(col).cast("string"), F.lit("NA"))


def naive_oof(base: DataFrame, opts: ModelingOptions = ModelingOptions()) -> DataFrame:
    """Out-of-fold naive scores without refitting per fold: one aggregation gives
    (fold, segment) sums; a fold's training rate is the total minus its own share,
    (S_seg - S_fold,seg) / (N_seg - N_fold,seg), the global rate likewise for segments
    absent from training. Equal to fitting the segment means on the other folds."""
    label = target_name(opts.horizon)
    folds = V.assign_folds(base, GROUP, label, opts.n_splits, opts.random_state)
    d = base.join(counted_broadcast(folds), GROUP, "inner").withColumn("_seg", _seg(opts.naive_segment))
    y = F.col(label).cast("double")
    st = d.groupBy("fold", "_seg").agg(F.sum(y).alias("s"), F.count(F.lit(1)).alias("n"))  # k x segments
    st = written(st, "fold-segments")
    total = lambda *by: st.groupBy(*by).agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    seg = total("_seg").select("_seg", F.col("s").alias("ss"), F.col("n").alias("sn"))
    fold = total("fold").select("fold", F.col("s").alias("fs"), F.col("n").alias("fn"))
    all_ = total().first()
    st = st.join(seg, "_seg").join(F.broadcast(fold), "fold")  # one row per fold
    ts, tn = F.col("ss") - F.col("s"), F.col("sn") - F.col("n")
    gs, gn = F.lit(all_["s"] or 0.0) - F.col("fs"), F.lit(all_["n"] or 0) - F.col("fn")
    rate = F.when(tn > 0, ts / tn).otherwise(F.when(gn > 0, gs / gn).otherwise(F.lit(0.0)))
    rates = written(st.select("fold", "_seg", rate.alias("p")), "fold-rates")
    out = d.join(counted_broadcast(rates), ["fold", "_seg"], "left")
    return out.select("ref_bacen", "nu_ordem", "mutuario", "fold", F.col(label).alias("y"), "p")


def naive_kfold_metrics(base: DataFrame, opts: ModelingOptions = ModelingOptions()) -> DataFrame:
    """(fold 1..k, auroc, ks, brier, n, n_pos, leak_mutuario) for the naive model."""
    oof = naive_oof(base, opts)
    m = ME.core_metrics(oof, by="fold")
    out = m.join(V.fold_leaks(oof, GROUP), "fold", "left").select(
        (F.col("fold") + 1).alias("fold"), "auroc", "ks", "brier", "n", "n_pos",
        F.coalesce("leak_mutuario", F.lit(0)).cast("long").alias("leak_mutuario"))
    return rounded(out, {"auroc", "ks", "brier"})


def naive_temporal_scores(base: DataFrame, opts: ModelingOptions = ModelingOptions()):
    """Walk-forward by crop year for the naive model: each testable year scored by the rates of all earlier years, in one
    pass: (scored rows safra, y, p; crop years; tested years; rows by year). No testable year: no rows."""
    label = target_name(opts.horizon)
    d = base.where(F.col("safra").isNotNull())
    years, tests, by = V.testable_years(d, label, "safra", opts.min_train_safras, opts.min_test_rows)
    # training rates of year t = running (segment) sums over all earlier years: one
    # aggregation to (year, segment) and windows over that small table, no refits
    from pyspark.sql import Window as W

    d = d.withColumn("_seg", _seg(opts.naive_segment))
    y = F.col(label).cast("double")
    ys = d.groupBy("safra", "_seg").agg(F.sum(y).alias("s"), F.count(F.lit(1)).alias("n"))
    yt = d.groupBy("safra").agg(F.sum(y).alias("s"), F.count(F.lit(1)).alias("n"))
    before = W.orderBy("safra").rowsBetween(W.unboundedPreceding, -1)
    glob = yt.select("safra", F.sum("s").over(before).alias("gs"), F.sum("n").over(before).alias("gn"))
    # every (year, segment) met in a test year is a row of ys; summing the earlier rows
    # of its segment gives the training sums (years without the segment add nothing)
    prior = W.partitionBy("_seg").orderBy("safra").rowsBetween(W.unboundedPreceding, -1)
    g = ys.select("safra", "_seg", F.coalesce(F.sum("s").over(prior), F.lit(0.0)).alias("ts"),
                  F.coalesce(F.sum("n").over(prior), F.lit(0)).alias("tn"))
    g = g.join(glob, "safra")
    rate = F.when(F.col("tn") > 0, F.col("ts") / F.col("tn")).otherwise(F.col("gs") / F.col("gn"))
    rates = written(g.where(F.col("safra").isin(tests)).select("safra", "_seg", rate.alias("p")), "year-rates")
    scored = d.where(F.col("safra").isin(tests)).join(counted_broadcast(rates), ["safra", "_seg"], "left").select(
        "safra", F.col(label).alias("y"), "p")
    return scored, years, tests, by


def naive_temporal_metrics(base: DataFrame, opts: ModelingOptions = ModelingOptions()) -> DataFrame:
    """(safra, n_train, n_test, rate_test, auroc, ks, brier) of the naive model for each testable crop year."""
    scored, years, tests, by = naive_temporal_scores(base, opts)
    spark = base.sparkSession
    m = ME.core_metrics(scored, by="safra")
    info = spark.createDataFrame(
        [(int(t), sum(by[y] for y in years if y < t), by[t]) for t in tests],
        "safra int, n_train long, n_test long")
    rate = scored.groupBy("safra").agg(F.avg(F.col("y").cast("double")).alias("rate_test"))
    out = info.join(rate, "safra").join(m, "safra").select(
        "safra", "n_train", "n_test", "rate_test", "auroc", "ks", "brier")
    return rounded(out, {"rate_test", "auroc", "ks", "brier"})
