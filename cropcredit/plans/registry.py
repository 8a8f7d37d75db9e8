"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each reads the driver tables at ``sf_dir`` through the silver role mapping and runs
one job of the pipeline over the whole data.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from cropcredit.config import GROUP, ModelingOptions, target_name
from cropcredit.functions.columns import crop_year_label
from cropcredit.operators import boosting as BO
from cropcredit.operators import business as B
from cropcredit.operators import consolidate as K
from cropcredit.operators import rule_tables as RT
from cropcredit.operators import dashboard as DB
from cropcredit.operators import features as FE
from cropcredit.operators import labels as L
from cropcredit.operators import metrics as ME
from cropcredit.operators import validation as V
from cropcredit.operators.models import Preprocessor, predict_proba
from cropcredit.plans import ingestion as I
from cropcredit.plans import modelling as MP
from cropcredit.plans import training as T
from cropcredit.plans.portfolio import Portfolio, scoring_base, training_base
from cropcredit.session import ensure_checkpoint_dir, written
from cropcredit.sources.driver_tables import silver_tables
from cropcredit.sources.runs import load_runs, records_frame, save_run

LABEL = target_name()
KEPT = 8  # categories of a column in the preprocessing queries


def portfolio(spark, sf_dir) -> Portfolio:
    return Portfolio(silver_tables(spark, sf_dir))


def _silver(spark, sf_dir):
    return silver_tables(spark, sf_dir)


def q_default_codes(spark, sf):
    return L.default_codes(_silver(spark, sf)["situacao_operacao"])


def q_observation_base(spark, sf):
    s = _silver(spark, sf)
    return L.observation_base(s["saldos"], s["operacao_basica"], s["mutuarios"], s["situacao_operacao"])


def q_target(spark, sf):
    return portfolio(spark, sf).target()


def q_first_default(spark, sf):
    return portfolio(spark, sf).first_default()


def q_vintage(spark, sf):
    return portfolio(spark, sf).vintage()


def q_label_summary(spark, sf):
    p = portfolio(spark, sf)
    return L.label_summary(p.target(), p.target_col)


def q_feature(name):
    def run(spark, sf):
        return portfolio(spark, sf).feature_table(name)

    run.__name__ = f"q_feature_{name}"
    return run


def q_municipio(spark, sf):
    s = _silver(spark, sf)
    return FE.municipio_feature(portfolio(spark, sf).target(), s["complemento_renegociacoes"], s["municipios"], LABEL)


def q_subset(spark, sf):
    """The modelling table of some features; a name without a definition is skipped."""
    p = Portfolio(silver_tables(spark, sf), features=["uf", "sem_definicao", "produto", "juros", "tp_produtor"])
    return p.modelling_base()


def q_consolidated(spark, sf):
    return portfolio(spark, sf).modelling_base()


def q_crop_year(spark, sf):
    m = B.crop_year_map(_silver(spark, sf)["operacao_basica"])
    return m.select("ref_bacen", "nu_ordem", "safra", crop_year_label("safra").alias("safra_label"), "valor")


def q_operation_base(spark, sf):
    return portfolio(spark, sf).operation_base()


def q_aggregates(spark, sf):
    """Volumes to the cent: sums of doubles differ in their last digits between engines."""
    return portfolio(spark, sf).aggregates().withColumn("volume", F.round("volume", 2))


def q_top_categories(spark, sf):
    return B.top_categories(q_aggregates(spark, sf))


def q_display(spark, sf):
    return B.display_measures(q_aggregates(spark, sf))


def q_vintage_curve(spark, sf):
    return portfolio(spark, sf).vintage_curve()


def q_vintage_long(spark, sf):
    return portfolio(spark, sf).vintage_long()


def q_life_table(spark, sf):
    return portfolio(spark, sf).life_table()


def _base(spark, sf):
    """Scoring base (keys, label, segment, crop year), built once: rates, folds and scored rows are
    all read from it."""
    return written(scoring_base(_silver(spark, sf)), "scoring")


def q_naive_scores(spark, sf):
    return MP.rounded(MP.naive_in_sample(_base(spark, sf)), {"p"})


def _in_sample(spark, sf):
    s = MP.naive_in_sample(_base(spark, sf))
    return s, ME.score_distribution(s)


def q_metrics_core(spark, sf):
    s, d = _in_sample(spark, sf)
    return MP.rounded(ME.core_metrics(s, dist=d), {"auroc", "ks", "brier"})


def q_metrics_calibration(spark, sf):
    s, d = _in_sample(spark, sf)
    return MP.rounded(ME.calibration(s, dist=d), {"mean_pred", "frac_pos"})


def q_metrics_roc(spark, sf):
    s, d = _in_sample(spark, sf)
    return MP.rounded(ME.roc_points(s, dist=d), {"fpr", "tpr"})


def q_metrics_ks_curve(spark, sf):
    s, d = _in_sample(spark, sf)
    return MP.rounded(ME.ks_curve(s, dist=d), {"score", "cdf_pos", "cdf_neg"})


def q_folds(spark, sf):
    return V.assign_folds(_base(spark, sf), "mutuario", "target_18m", 5, 42)


def q_naive_oof(spark, sf):
    return MP.rounded(MP.naive_oof(_base(spark, sf)), {"p"})


def q_naive_kfold(spark, sf):
    return MP.naive_kfold_metrics(_base(spark, sf))


def q_naive_temporal(spark, sf):
    return MP.naive_temporal_metrics(_base(spark, sf))


GROUPED_CURVES = {"calibration": (ME.calibration, {"mean_pred", "frac_pos"}), "roc": (ME.roc_points, {"fpr", "tpr"}),
                  "ks_curve": (ME.ks_curve, {"score", "cdf_pos", "cdf_neg"})}


def q_grouped_curve(kind, by):
    """One curve of the naive model for every fold or tested crop year, all groups in one pass."""
    curve, digits = GROUPED_CURVES[kind]

    def run(spark, sf):
        base = _base(spark, sf)
        scored = MP.naive_oof(base) if by == "fold" else MP.naive_temporal_scores(base)[0]
        return MP.rounded(curve(written(scored.select(by, "y", "p"), "scored"), by=by), digits)

    run.__name__ = f"q_{kind}_by_{by}"
    return run


def q_cleaning(spark, sf):
    from cropcredit.plans.cleaning import typed_operations

    return typed_operations(_silver(spark, sf)["operacao_basica"])


def _modelled(spark, sf, name, **kw):
    opts = ModelingOptions()
    df, cat, num = T.load_base(training_base(_silver(spark, sf)), opts)
    prep, model = T.fit_model(name, df, LABEL, cat, num, opts, **kw)
    return df, prep, model


def q_logistic_scores(spark, sf):
    """Balanced logistic regression: fitted on and scoring every row of the modelling table. Iterative optimiser: no SQL
    oracle."""
    df, prep, model = _modelled(spark, sf, "logistic")
    out = predict_proba(model, prep, df)
    return MP.rounded(out.select("ref_bacen", "nu_ordem", "mutuario", F.col(LABEL).alias("y"), "p"), {"p"})


def _evidence(df, prep, model, bound):
    """(n, pos, better_than_chance, balanced): all rows scored. balanced: in every state, the weighted
    residuals add up to less than ``bound`` of the total weight. At the logistic optimum they are the
    gradient of that state's coefficient, which is 0 up to the small penalty."""
    out = written(predict_proba(model, prep, df).select("uf", F.col(LABEL).alias("y"), "p"), "scored")
    m = ME.core_metrics(out).first()
    w = F.when(F.col("y") == 1, m["n"] / (2.0 * m["n_pos"])).otherwise(m["n"] / (2.0 * (m["n"] - m["n_pos"])))
    residual = out.groupBy("uf").agg((F.abs(F.sum(w * (F.col("p") - F.col("y")))) / m["n"]).alias("g"))
    return residual.agg(F.lit(m["n"]).cast("long").alias("n"), F.lit(m["n_pos"]).cast("long").alias("pos"),
                        F.lit(m["auroc"] > 0.5).alias("better_than_chance"), (F.max("g") < bound).alias("balanced"))


def q_logistic_evidence(spark, sf):
    return _evidence(*_modelled(spark, sf, "logistic"), bound=1e-3)


def q_trees_evidence(spark, sf):
    """Boosted trees, 5 of them: enough to see the fit, scoring and metrics work on all rows. beats_constant: with both classes
    weighing alike, the log loss is below log 2, that of the best constant score."""
    df, prep, model = _modelled(spark, sf, "boosted_trees", gbt_trees=5)
    out = written(predict_proba(model, prep, df).select(F.col(LABEL).alias("y"), "p"), "scored")
    m = ME.core_metrics(out).first()
    hit = F.greatest(F.when(F.col("y") == 1, F.col("p")).otherwise(1 - F.col("p")), F.lit(1e-15))
    w = F.when(F.col("y") == 1, 0.5 / m["n_pos"]).otherwise(0.5 / (m["n"] - m["n_pos"]))
    return out.agg(F.lit(m["n"]).cast("long").alias("n"), F.lit(m["n_pos"]).cast("long").alias("pos"),
                   F.lit(m["auroc"] > 0.5).alias("better_than_chance"), (F.sum(-w * F.log(hit)) < math.log(2) - 1e-6).alias("beats_constant"))


BOOSTING_KEYS = ["ref_bacen", "nu_ordem", "mutuario"]


def _binned(spark, sf):
    base = written(portfolio(spark, sf).modelling_base(), "modelling")
    return base, BO.Binning(list(FE.CAT_FEATURES), list(FE.NUM_FEATURES), KEPT).fit(base)


def q_boosting_splits(spark, sf):
    """Every split that the first tree may take at its root, on all rows and columns: (feature, at, gain)."""
    base, binning = _binned(spark, sf)
    rows = BO.derivatives(BO.prepared(base, LABEL, BOOSTING_KEYS, binning)).withColumn("node", F.lit(1))
    found = BO.histograms(rows, list(range(len(binning.columns))))
    splits = BO.candidates(found[1], binning, l2=1.0, min_hessian=1.0) if found else []
    out = [(binning.columns[s.column], binning.name(s), s.null_left, s.gain) for s in splits]
    return spark.createDataFrame(out, "feature string, at string, null_left boolean, gain double").withColumn("gain", F.round("gain", 4))


def q_boosting_loss(spark, sf):
    """(trees, falls): boosting with 10 trees; whether the loss over all rows after so many trees is below the one before."""
    base, binning = _binned(spark, sf)
    losses = BO.fit(base, LABEL, BOOSTING_KEYS, binning, n_trees=10).losses
    return spark.createDataFrame([(k, now < before) for (_, before), (k, now) in zip(losses, losses[1:])], "trees int, falls boolean")


def q_fold_balance(spark, sf):
    base = _base(spark, sf)
    return V.fold_balance(base, V.assign_folds(base, GROUP, LABEL, 5, 42), GROUP, LABEL)


def _naive_run(spark, sf):
    return T.train_kfold(training_base(_silver(spark, sf)), ModelingOptions(), models=("naive",))


def q_dashboard_ks_location(spark, sf):
    """KS location per model of a naive k-fold run record built from the data."""
    found = DB.ks_location(records_frame(spark, [_naive_run(spark, sf)])).drop("run_id")
    return MP.rounded(found, {"score", "cdf_pos", "cdf_neg", "gap"})


def q_consolidated_generic(spark, sf):
    """All 19 per-feature tables, found and joined by the generic path in like buckets."""
    p = portfolio(spark, sf)
    return K.consolidate(p.target(), p.feature_tables())


def q_recode_by_rules(spark, sf):
    """(codigo, modalidade, produto) of every enterprise code, from rule tables instead of compiled rules."""
    codes = written(_silver(spark, sf)["empreendimento"], "codes")

    def by_rules(name):
        recode = FE.BY_NAME[name].recode
        rows = codes.select("`#CODIGO`", *sorted(recode.columns()))
        return RT.classified(rows, RT.rule_table(spark, recode), ["#CODIGO"], name)  # every code, once

    # both sides grow with the domain: never broadcast
    return by_rules("modalidade").join(by_rules("produto").hint("merge"), "#CODIGO").withColumnRenamed("#CODIGO", "codigo")


SAMPLE_ROWS = 2000


def q_sample(spark, sf):
    return K.sample_rows(written(portfolio(spark, sf).target(), "target"), SAMPLE_ROWS)


def q_coerced(spark, sf):
    base = portfolio(spark, sf).modelling_base()
    return K.coerce(K.project_present(base, [*base.columns, "ausente"]), FE.CAT_FEATURES, FE.NUM_FEATURES)


def q_feature_quality(spark, sf):
    base = written(portfolio(spark, sf).modelling_base(), "modelling")
    return MP.rounded(K.feature_quality(base, FE.CAT_FEATURES, FE.NUM_FEATURES), {"null_frac"})


def q_categories(spark, sf):
    """(feature, category): the indicator columns of the fitted encoder."""
    p = Preprocessor(list(FE.CAT_FEATURES), [], KEPT).fit(portfolio(spark, sf).modelling_base())
    rows = [(c, v) for c, (kept, more) in p.categories.items() for v in [*kept, *(["*"] if more else [])]]
    return spark.createDataFrame(rows, "feature string, category string")


def q_scales(spark, sf):
    base = portfolio(spark, sf).modelling_base().select(*FE.NUM_FEATURES)
    p = Preprocessor([], list(FE.NUM_FEATURES)).fit(written(base, "numbers"))
    rows = [(c, p.medians[c], p.scales[c]) for c in p.num_cols]
    return MP.rounded(spark.createDataFrame(rows, "feature string, median double, scale double"), {"median", "scale"})


def q_sparse(spark, sf):
    """Each row's sparse vector, told by its places: how many are not zero, the sum of their indices (from 0), and whether
    Spark stores it as a sparse vector."""
    base = written(portfolio(spark, sf).modelling_base(), "modelling")
    p = Preprocessor(list(FE.CAT_FEATURES), list(FE.NUM_FEATURES), KEPT).fit(base)
    x = p.transform(base).select("ref_bacen", "nu_ordem", "mutuario", F.arrow_udf(_told(), "places long, place_sum long, sparse boolean")(F.unwrap_udt("features")).alias("t"))
    return x.select("ref_bacen", "nu_ordem", "mutuario", "t.places", "t.place_sum", "t.sparse")


def _told():
    """A function of one batch of unwrapped vectors: entries that are not zero, the sum of their indices, whether they are
    stored as sparse ones. A sparse vector names its entries' indices, a dense one stores all."""

    def told(v: pa.Array) -> pa.Array:
        sparse = pc.equal(v.field("type"), 0).to_numpy(zero_copy_only=False)
        lengths = pc.list_value_length(v.field("values")).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(v)), lengths)
        at = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        at[np.repeat(sparse, lengths)] = v.field("indices").flatten().to_numpy(zero_copy_only=False)
        seen = v.field("values").flatten().to_numpy(zero_copy_only=False) != 0
        places = np.bincount(row[seen], minlength=len(v))
        sums = np.bincount(row[seen], at[seen], len(v)).astype("i8")  # exact: far below 2^53
        return pa.StructArray.from_arrays([pa.array(places), pa.array(sums), pa.array(sparse)], ["places", "place_sum", "sparse"])

    return told


def _stored(spark, record):
    """A run record saved and loaded again."""
    uri = f"{ensure_checkpoint_dir(spark).rstrip('/')}/runs-{uuid.uuid4().hex[:12]}"
    save_run(spark, dict(record, run_id="20240101000000"), uri)
    return load_runs(spark, uri)


def q_metric_history(spark, sf):
    return MP.rounded(DB.metric_history(_stored(spark, _naive_run(spark, sf)), "auroc"), {"naive"})


def q_out_of_time(spark, sf):
    rec = T.train_temporal(scoring_base(_silver(spark, sf)), ModelingOptions(), models=("naive",))
    return MP.rounded(DB.out_of_time(_stored(spark, rec), "20240101000000", "auroc"), {"naive", "rate_test"})


def queries() -> dict:
    q = {
        "labels_default_codes": q_default_codes,
        "labels_observation_base": q_observation_base,
        "labels_target_18m": q_target,
        "labels_first_default": q_first_default,
        "labels_vintage_matrix": q_vintage,
        "labels_vintage_long": q_vintage_long,
        "labels_summary": q_label_summary,
    }
    for f in FE.FEATURES:
        q[f"feature_{f.name}"] = q_feature(f.name)
    for kind in GROUPED_CURVES:
        for by in ("fold", "safra"):
            q[f"metrics_{kind}_by_{by}"] = q_grouped_curve(kind, by)
    q.update({
        "features_consolidated": q_consolidated,
        "recode_by_rules": q_recode_by_rules,
        "features_subset": q_subset,
        "feature_municipio": q_municipio,
        "business_crop_year": q_crop_year,
        "business_operation_base": q_operation_base,
        "business_aggregates": q_aggregates,
        "business_top_categories": q_top_categories,
        "business_display": q_display,
        "business_vintage_curve": q_vintage_curve,
        "business_life_table": q_life_table,
        "model_naive_scores": q_naive_scores,
        "metrics_core": q_metrics_core,
        "metrics_calibration": q_metrics_calibration,
        "metrics_roc": q_metrics_roc,
        "metrics_ks_curve": q_metrics_ks_curve,
        "validation_folds": q_folds,
        "validation_fold_balance": q_fold_balance,
        "validation_naive_oof": q_naive_oof,
        "validation_naive_kfold": q_naive_kfold,
        "validation_naive_temporal": q_naive_temporal,
        "cleaning_typed_operations": q_cleaning,
        "model_logistic_scores": q_logistic_scores,
        "model_logistic_evidence": q_logistic_evidence,
        "model_trees_evidence": q_trees_evidence,
        "model_boosting_splits": q_boosting_splits,
        "model_boosting_loss": q_boosting_loss,
        "dashboard_ks_location": q_dashboard_ks_location,
        "dashboard_metric_history": q_metric_history,
        "dashboard_out_of_time": q_out_of_time,
        "consolidate_generic": q_consolidated_generic,
        "loading_sample": q_sample,
        "loading_coerced": q_coerced,
        "loading_feature_quality": q_feature_quality,
        "preprocess_categories": q_categories,
        "preprocess_scales": q_scales,
        "preprocess_sparse": q_sparse,
        "ingest_customers": I.ingested_customers,
        "ingest_transform_counts": I.transformed_counts,
        "ingest_forced_delimiter": I.forced_delimiter,
    })
    return q


def entry_query(spark, sf_dir):
    """Flagship: default rate and credit volume by crop year."""
    aggs = portfolio(spark, sf_dir).aggregates()
    return aggs.where(F.col("dimensao") == "safra").orderBy("categoria")
