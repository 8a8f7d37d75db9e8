"""Validation schemes: stratified folds grouped by borrower, and walk-forward by crop year.

Folds: one rule for every borrower, at any size. Borrowers of equal rows and positives are one type;
types are classed by their number of rows (its bit length) and their share of positives (in tenths).
Class by class, largest first, the borrowers are dealt in turn, in descending order of rows, to the folds
in ascending order of the rows they hold by then. Dealing a descending run in turn gives no fold more
than its largest borrower above another, and the emptiest fold is served first, so the largest and the
smallest fold never differ by more than the largest borrower. A borrower is never on both sides.

All this is decided on the histogram of types: the driver sees the rows that each class deals to each
turn (at most 64 x 11 classes). A borrower's turn is a row number within (type, range of hashes) plus
prefix sums over ranges, blocks of ranges and the types of a class, so neither a type nor a class is
one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cropcredit.operators import metrics as ME
from cropcredit.session import counted_broadcast, written

# Groups that share one range of hashes within a class, about.
RANGE_GROUPS = 20_000


def _md5_int(seed: int, col: str):
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(col).cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long")


def _before(df: DataFrame, within: list[str], order: list, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``_m`` of the rows before, within ``within``."""
    w = W.partitionBy(*within).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum("_m").over(w), F.lit(0)))


def _dealing(classes: list, k: int) -> list[tuple]:
    """(_size, _rate, fold of each turn): the emptiest fold takes the first turn of the next class."""
    held, plan = [0] * k, []
    for c in sorted(classes, key=lambda c: (-c["_size"], -c["_rate"])):
        folds = sorted(range(k), key=lambda f: (held[f], f))
        for turn, f in enumerate(folds):
            held[f] += c[f"t{turn}"]
        plan.append((c["_size"], c["_rate"], folds))
    return plan


def assign_folds(df: DataFrame, group: str, label: str, k: int = 5, seed: int = 42,
                 range_groups: int = RANGE_GROUPS) -> DataFrame:
    """(group, fold) for every group of ``df``; the result is written once."""
    kind, klass = ["_n", "_pos"], ["_size", "_rate"]
    g = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)).alias("_pos"))
    g = written(g.withColumn("_h", _md5_int(seed, group)), "groups")
    ranges = 1 + g.count() // range_groups
    block = math.isqrt(ranges) + 1
    g = g.withColumn("_range", F.shiftright(F.col("_h") * ranges, 32)).withColumn("_block", F.floor(F.col("_range") / block))
    cells = written(g.groupBy(*kind, "_block", "_range").agg(F.count("*").alias("_m")), "fold-cells")
    blocks = cells.groupBy(*kind, "_block").agg(F.sum("_m").alias("_m"))
    types = blocks.groupBy(*kind).agg(F.sum("_m").alias("_m")).withColumns({
        "_size": F.length(F.bin("_n")), "_rate": F.ceil(F.col("_pos") * 10 / F.col("_n")).cast("int")})
    types = written(_before(types, klass, [F.col("_n").desc(), F.col("_pos").desc()], "_type"), "fold-types")
    turns = [F.sum(F.col("_n") * (F.floor(F.col("_m") / k) + (F.pmod(F.lit(i) - F.col("_type"), F.lit(k)) < F.col("_m") % k).cast("long")))
             .alias(f"t{i}") for i in range(k)]
    plan = _dealing(types.groupBy(*klass).agg(*turns).collect(), k)  # at most 64 x 11 rows
    plan = df.sparkSession.createDataFrame(plan, "_size int, _rate int, _folds array<int>")
    base = (_before(cells, [*kind, "_block"], ["_range"], "_a").join(_before(blocks, kind, ["_block"], "_b").drop("_m"), [*kind, "_block"])
            .join(types.drop("_m"), kind).join(F.broadcast(plan), klass)
            .select(*kind, "_range", "_folds", (F.col("_a") + F.col("_b") + F.col("_type")).alias("_base")))
    at = F.col("_base") + F.row_number().over(W.partitionBy(*kind, "_range").orderBy("_h", group)) - 1
    r = g.join(base, [*kind, "_range"])
    return written(r.select(group, F.get("_folds", (at % k).cast("int")).alias("fold")), "folds")


def fold_balance(df: DataFrame, folds: DataFrame, group: str, label: str) -> DataFrame:
    """(fold, n, pos): rows and positives of each fold."""
    return df.join(counted_broadcast(folds), group).groupBy("fold").agg(
        F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("pos"))


def leak_count(train: DataFrame, test: DataFrame, group: str) -> int:
    """Groups present on both sides (must be 0)."""
    return train.select(group).distinct().join(test.select(group).distinct(), group, "inner").count()


def _agg_folds(rows):
    import statistics

    out = {}
    for m in ("auroc", "ks", "brier"):
        vals = [r[m] for r in rows if r[m] is not None]
        out[m] = sum(vals) / len(vals) if vals else None
        out[f"{m}_std"] = statistics.pstdev(vals) if vals else None
    return out


def kfold_scores(df: DataFrame, folds: DataFrame, group: str, label: str, k: int,
                 fit_predict: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """Out-of-fold scores: union over folds of fit_predict(train, test) -> test + 'p'."""
    d = df.join(counted_broadcast(folds), group, "inner")
    parts = []
    for f in range(k):
        tr, te = d.where(F.col("fold") != f), d.where(F.col("fold") == f)
        parts.append(fit_predict(tr.drop("fold"), te).withColumn("fold", F.lit(f)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


CURVES = {"calibration": (ME.calibration, "bin"), "roc": (ME.roc_points, "k"), "ks_curve": (ME.ks_curve, "k")}


def curves(dist: ME.ScoreDistribution, scored: DataFrame) -> dict:
    """The bounded curves of one score distribution: name -> list of points, or, if it has groups, group -> name -> points.
    One job per kind of curve, however many groups."""
    out = {g: {name: [] for name in CURVES} for g in dist.sizes}
    for name, (f, at) in CURVES.items():
        for r in f(scored, dist=dist).orderBy(*dist.keys, at).collect():
            point = r.asDict()
            out[point.pop(dist.by) if dist.by else None][name].append(point)
    return out if dist.by else out.get(None, {name: [] for name in CURVES})


def fold_leaks(rows: DataFrame, group: str) -> DataFrame:
    """(fold, leak_mutuario): groups of a fold's rows that are also in another fold (must be 0), all folds in one pass;
    folds without a leak are absent."""
    sets = rows.groupBy(group).agg(F.collect_set("fold").alias("fs"))  # <= k values each
    multi = sets.where(F.size("fs") > 1).select(F.explode("fs").alias("fold"))
    return multi.groupBy("fold").agg(F.count(F.lit(1)).alias("leak_mutuario"))


def evaluate_kfold(df: DataFrame, folds: DataFrame, group: str, label: str, k: int,
                   fit_predict, name: str) -> dict:
    """Per-fold metrics and leak counts (one pass each), mean/population std, and out-of-fold curves.
    Scores are written once so the curves do not refit the folds."""
    oof = written(kfold_scores(df, folds, group, label, k, fit_predict).select(group, "fold", F.col(label).alias("y"), "p"), "oof")
    leaks = {r["fold"]: r["leak_mutuario"] for r in fold_leaks(oof, group).collect()}
    rows = []
    for r in ME.core_metrics(oof, by="fold").orderBy("fold").collect():
        rows.append(r.asDict() | {"fold": r["fold"] + 1, "leak_mutuario": leaks.get(r["fold"], 0)})
    return {"model": name, "metrics": _agg_folds(rows), "folds": rows, **curves(ME.score_distribution(oof), oof), "oof": oof}


def testable_years(d: DataFrame, label: str, safra: str, min_train_safras: int, min_test_rows: int):
    """(all crop years, those to be tested, rows by year): after the first ``min_train_safras``
    years, each with at least ``min_test_rows`` rows and both classes."""
    stats = d.groupBy(safra).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.col(label)).alias("classes"))
    by = {r[safra]: r for r in stats.collect()}  # one row per crop year
    years = sorted(by)
    fit = [y for y in years[min_train_safras:] if by[y]["n"] >= min_test_rows and by[y]["classes"] > 1]
    return years, fit, {y: int(by[y]["n"]) for y in years}


def walk_forward(df: DataFrame, label: str, fit_predict, name: str, safra: str = "safra",
                 min_train_safras: int = 1, min_test_rows: int = 50, warn=print) -> dict:
    """Expanding window: each testable crop year is scored by a model of all years before it. Rows
    without a crop year are dropped."""
    d = df.where(F.col(safra).isNotNull())
    years, tests, rows = testable_years(d, label, safra, min_train_safras, min_test_rows)
    if len(years) <= min_train_safras:
        raise RuntimeError(f"too few crop years for out-of-time validation: {years}")
    for year in sorted(set(years[min_train_safras:]) - set(tests)):
        warn(f"[{name}] crop year {year} not testable (n={rows[year]}) - skipped")
    per = _tested(d, tests, rows, label, fit_predict, safra)
    means = {}
    for m in ("auroc", "ks", "brier") if per else ():
        known = [e["metrics"][m] for e in per if e["metrics"][m] is not None]
        means[m] = sum(known) / len(known) if known else None
    return {"model": name, "per_safra": per, "metrics": means, "safras": years, "test_safras": years[min_train_safras:]}


def _tested(d: DataFrame, tests: list, rows: dict, label: str, fit_predict, safra: str) -> list:
    """One entry per tested year. The models are fitted year by year; the scores of all years are written once, and metrics
    and curves of all years come from one grouped pass each."""
    if not tests:
        return []
    parts = [fit_predict(d.where(F.col(safra) < y), d.where(F.col(safra) == y)).select(F.lit(int(y)).alias("safra"), F.col(label).alias("y"), "p") for y in tests]
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    scored = written(scored, "years")
    dist = ME.score_distribution(scored, by="safra")
    found, points = {r["safra"]: r.asDict() for r in ME.core_metrics(scored, dist=dist).collect()}, curves(dist, scored)
    rates = {r["safra"]: float(r["rate"]) for r in scored.groupBy("safra").agg(F.avg("y").alias("rate")).collect()}
    return [{
        "safra": int(y), "safra_label": f"{y}/{(y + 1) % 100:02d}",
        "n_train": sum(n for e, n in rows.items() if e < y), "n_test": rows[y],
        "rate_test": rates[y],
        "metrics": {k: v for k, v in found[y].items() if k != "safra"}, **points[y],
    } for y in tests]
