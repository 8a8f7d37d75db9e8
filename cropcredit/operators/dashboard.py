"""Dashboard data over run records (small tables: one row per run x model x point)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def runs_by_validation(runs: DataFrame, kind: str, models=None) -> DataFrame:
    """Runs of one validation kind (records without one are k-fold), exploded to one
    row per model result, optionally restricted to some models."""
    r = runs.where(F.coalesce(F.col("validation"), F.lit("kfold")) == kind)
    x = r.select("run_id", "created_at", F.explode("results").alias("res"))
    if models:
        x = x.where(F.col("res.model").isin(list(models)))
    return x


def metric_history(runs: DataFrame, metric: str, models=None) -> DataFrame:
    """run_id x model pivot of one k-fold metric (last value per cell)."""
    x = runs_by_validation(runs, "kfold", models).select(
        "run_id", "created_at", F.col("res.model").alias("model"),
        F.col("res.metrics").getItem(metric).alias("value"))
    return x.groupBy("run_id").pivot("model").agg(F.max_by("value", "created_at")).orderBy("run_id")


def out_of_time(runs: DataFrame, run_id: str, metric: str, models=None) -> DataFrame:
    """crop year x model pivot of one metric for an out-of-time run, with the test size
    and observed rate of each crop year."""
    x = runs_by_validation(runs, "temporal", models).where(F.col("run_id") == run_id)
    e = x.select(F.col("res.model").alias("model"), F.posexplode("res.per_safra").alias("at", "e"))
    e = e.select("model", "at", F.col("e.safra_label").alias("safra"), F.col("e.n_test").alias("n_test"),
                 F.col("e.rate_test").alias("rate_test"), F.col("e.metrics").getItem(metric).alias("value"))
    piv = e.groupBy("safra").pivot("model").agg(F.max_by("value", F.col("at")))
    vol = e.groupBy("safra").agg(F.min_by("n_test", F.struct("model", "at")).alias("n_test"), F.min_by("rate_test", F.struct("model", "at")).alias("rate_test"))
    return piv.join(vol, "safra").orderBy("safra")


def ks_location(runs: DataFrame) -> DataFrame:
    """Per run and model: the stored KS-curve point with the largest class-CDF gap
    (the first of equal ones)."""
    x = runs.select("run_id", F.explode("results").alias("res")).select(
        "run_id", F.col("res.model").alias("model"), F.posexplode("res.ks_curve").alias("at", "pt"))
    gap = F.abs(F.col("pt.cdf_pos") - F.col("pt.cdf_neg"))
    return x.groupBy("run_id", "model").agg(F.max_by("pt", F.struct(gap, -F.col("at"))).alias("pt"), F.max(gap).alias("gap")).select(
        "run_id", "model", F.col("pt.score").alias("score"), F.col("pt.cdf_pos").alias("cdf_pos"),
        F.col("pt.cdf_neg").alias("cdf_neg"), "gap")
