"""Probability-of-default models on Spark: naive segment rate, balanced logistic
regression and gradient-boosted trees, with the preprocessing they share.

Fitting runs on executors (Spark ML / DataFrame aggregations). Fitted state that
reaches the driver is bounded: per-category frequency tops (<= max_categories per
column), quantile bounds, medians and standard deviations, segment rates (one row per segment, joined
back as a broadcast of counted size), model coefficients.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcredit.operators.ranks import order_statistics, top_values
from cropcredit.session import counted_broadcast, written


# --- M1: naive segment rate -------------------------------------------------------------

def _segment_key(cols):
    return [F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(f"_seg{i}") for i, c in enumerate(cols)]


@dataclass
class SegmentRate:
    """Mean label per segment (NULL segment -> "NA"); unseen segments get the global mean. One
    aggregation of the training rows gives (segment, sum, n); written, its size is known: it is
    broadcast to the scored rows if small, and the global mean is its total."""

    segment_cols: list
    rates: DataFrame | None = None
    global_rate: float = 0.0

    def fit(self, train: DataFrame, label: str) -> "SegmentRate":
        y = F.col(label).cast("double")
        sums = train.groupBy(*_segment_key(self.segment_cols)).agg(F.sum(y).alias("_s"), F.count(y).alias("_n"))
        self.rates = written(sums, "segments")
        t = self.rates.agg(F.sum("_s").alias("s"), F.sum("_n").alias("n")).first()
        self.global_rate = t["s"] / t["n"] if t["n"] else 0.0
        return self

    def transform(self, df: DataFrame, out: str = "p") -> DataFrame:
        keys = [f"_seg{i}" for i in range(len(self.segment_cols))]
        rates = self.rates.select(*keys, (F.col("_s") / F.col("_n")).alias("_rate"))
        j = df.select("*", *_segment_key(self.segment_cols)).join(counted_broadcast(rates), keys, "left")
        return j.withColumn(out, F.coalesce("_rate", F.lit(self.global_rate))).drop("_rate", *keys)


# --- P1-P5: preprocessing ----------------------------------------------------------------

@dataclass
class Preprocessor:
    """Categorical: constant "NA" imputation, one indicator per frequent category
    (max_categories-1 when a column has more than max_categories values) plus
    an "infrequent" indicator; unseen values go to "infrequent" (all zeros if the
    column had no infrequent class). Numeric: median imputation, division by the
    population standard deviation (no centring; zero deviation -> 1).

    Fitting takes one job for all categorical columns and a few passes for all numeric ones. A row becomes
    a sparse vector: Arrow batches are looked up column by column in the kept values, so neither the plan nor the row
    grows with the number of categories, and no row goes through a function of its own."""

    cat_cols: list
    num_cols: list
    max_categories: int = 30
    categories: dict = field(default_factory=dict)  # col -> (kept values, has_infrequent)
    medians: dict = field(default_factory=dict)
    scales: dict = field(default_factory=dict)

    def fit(self, train: DataFrame) -> "Preprocessor":
        for c, (top, n_values) in top_values(train, self.cat_cols, self.max_categories).items():
            infrequent = n_values > self.max_categories
            self.categories[c] = (sorted(top[: self.max_categories - 1] if infrequent else top), infrequent)
        for c, s in order_statistics(train, self.num_cols).items():
            self.medians[c] = float(s.median) if s.median is not None else 0.0
            sd = s.filled_deviation()
            self.scales[c] = float(sd) if sd > 0 else 1.0
        return self

    def names(self) -> list[str]:
        """Names of the vector's places, in order."""
        out = []
        for c in self.cat_cols:
            kept, infrequent = self.categories[c]
            out += [f"{c}={v}" for v in kept] + ([f"{c}=infrequent"] if infrequent else [])
        return out + list(self.num_cols)

    def inputs(self) -> tuple[list, list]:
        """(texts, scaled numbers) of a row, with missing ones filled."""
        texts = [F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in self.cat_cols]
        numbers = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(self.medians[c])) / F.lit(self.scales[c])
                   for c in self.num_cols]
        return texts, numbers

    def transform(self, df: DataFrame, out: str = "features") -> DataFrame:
        """``df`` with the vector ``out``, sparse where that is smaller. An unseen value is the infrequent indicator of a
        column that has one, no place otherwise. Places of categories are marked as indicators, which trees need not cut."""
        texts, numbers = self.inputs()
        names, lookups, place = self.names(), [], 0
        for c in self.cat_cols:
            kept, infrequent = self.categories[c]
            lookups.append((kept, place, len(kept) if infrequent else None))
            place += len(kept) + infrequent
        size = len(names)
        assembled = F.arrow_udf(assembler(lookups, place, size), VectorUDT())
        marks = [{"idx": i, "name": n} for i, n in enumerate(names)]
        marks = {kind: some for kind, some in (("binary", marks[:place]), ("numeric", marks[place:])) if some}
        return df.withColumn(out, assembled(*texts, *numbers).alias(out, metadata={"ml_attr": {"attrs": marks, "num_attrs": size}}))


def assembler(lookups: list, place: int, size: int):
    """A function of one batch of columns (texts, then numbers) that gives Spark's vectors. ``lookups``: of each text column
    its kept values, its first place and the offset of its infrequent place or None; numbers start at ``place``. As in Spark's
    own assembler, zeros are left out, and a row is sparse if 1.5 (entries + 1) < size. The function needs no module of this
    package where it runs."""
    ints, doubles = (pa.list_(pa.field("element", t, nullable=False)) for t in (pa.int32(), pa.float64()))
    fields = [pa.field("type", pa.int8(), nullable=False), pa.field("size", pa.int32()), pa.field("indices", ints), pa.field("values", doubles)]

    def assembled(*columns: pa.Array) -> pa.Array:
        n, k = len(columns[0]), len(columns)
        at, value = np.empty((n, k), "i4"), np.ones((n, k))
        for j, (column, (kept, first, other)) in enumerate(zip(columns, lookups)):
            found = pc.index_in(column, value_set=pa.array(kept, column.type))
            at[:, j] = pc.fill_null(pc.add(found, first), -1 if other is None else first + other).to_numpy(zero_copy_only=False)
        for j, column in enumerate(columns[len(lookups):]):
            at[:, len(lookups) + j], value[:, len(lookups) + j] = place + j, column.to_numpy(zero_copy_only=False)
        held = (at >= 0) & (value != 0)
        entries = held.sum(axis=1)
        sparse = 1.5 * (entries + 1) < size
        few = held & sparse[:, None]
        stored = np.where(sparse, entries, size)
        values, of_sparse = np.empty(stored.sum()), np.repeat(sparse, stored)
        values[of_sparse] = value[few]
        if not sparse.all():
            row, j = np.nonzero(held & ~sparse[:, None])
            full = np.zeros((n, size))
            full[row, at[row, j]] = value[row, j]
            values[~of_sparse] = full[~sparse].ravel()
        starts = [np.concatenate([[0], np.cumsum(lengths)]).astype("i4") for lengths in (few.sum(axis=1), stored)]
        indices = pa.ListArray.from_arrays(pa.array(starts[0]), pa.array(at[few]), type=ints, mask=pa.array(~sparse))
        parts = [pa.array((~sparse).astype("i1")), pa.array(np.full(n, size, "i4"), mask=~sparse), indices,
                 pa.ListArray.from_arrays(pa.array(starts[1]), pa.array(values), type=doubles)]
        return pa.StructArray.from_arrays(parts, fields=fields)

    return assembled


# --- M2 / M3 ---------------------------------------------------------------------------------

#: One block of rows: labels, the place of each text among its column's indicators (their number: none), scaled numbers.
BLOCK = "y binary, at binary, x binary"
#: Rows of a block, about.
BLOCK_ROWS = 2_000
#: A row group (100 records at least) is read at once: kept small, its bytes compress to about a fifteenth.
BLOCK_FILES = {"parquet.block.size": 4 << 20, "compression": "zstd"}
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def _looked_up(columns: list, lookups: list) -> np.ndarray:
    """(columns, rows): places among a column's indicators. ``lookups``: kept values and whether the rest has an indicator."""
    at = np.empty((len(lookups), len(columns[0]) if columns else 0), "<i4")
    for j, (column, (kept, infrequent)) in enumerate(zip(columns, lookups)):
        # an unseen value: the infrequent indicator, which is the last one, or the place after all
        at[j] = pc.fill_null(pc.index_in(column, value_set=pa.array(kept, column.type)), len(kept)).to_numpy(zero_copy_only=False)
    return at


def _encoded(lookups: list, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (y, texts, numbers) to blocks."""
    k = len(lookups)
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            some = batch.slice(start, BLOCK_ROWS)
            y = some.column(0).to_numpy(zero_copy_only=False).astype("<f8")
            x = np.array([some.column(j).to_numpy(zero_copy_only=False) for j in range(1 + k, some.num_columns)], "<f8").reshape(-1, len(y))
            at = _looked_up([some.column(j) for j in range(1, 1 + k)], lookups)
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (y, at, x)], ["y", "at", "x"])


def _curvature(theta: np.ndarray, weights: tuple, sizes: list, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of one task's rows, as rows (i, values): second derivatives by coefficients i and all others, then the
    gradient's i; the last row is the loss. ``sizes``: indicators of each text column; numbers and the intercept follow."""
    first, n = np.concatenate([[0], np.cumsum(sizes)]).astype(int), len(theta)
    H, g, loss, seen = np.zeros((n, n)), np.zeros(n), 0.0, False
    for batch in batches:
        if batch.num_rows:  # all blocks of a batch at once
            blocks = [[np.frombuffer(v.as_buffer(), t) for v, t in zip(block, ("<f8", "<i4", "<f8"))] for block in zip(*batch.columns)]
            y, seen = np.concatenate([b[0] for b in blocks]), True
            at = np.hstack([b[1].reshape(len(sizes), len(b[0])) for b in blocks]).astype("i8")
            x = np.hstack([b[2].reshape(-1, len(b[0])) for b in blocks])
            x = np.vstack([x, np.ones(len(y))])  # the intercept
            margin = theta[first[-1]:] @ x
            for j, size in enumerate(sizes):
                margin += np.append(theta[first[j]:first[j + 1]], 0.0)[at[j]]
            w = np.where(y == 1, *weights)
            p = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
            loss += float((w * np.logaddexp(0, np.where(y == 1, -margin, margin))).sum())
            d, v = w * (p - y), w * p * (1 - p)
            g[first[-1]:] += x @ d
            H[first[-1]:, first[-1]:] += (x * v) @ x.T
            for j, size in enumerate(sizes):
                own = slice(first[j], first[j + 1])
                g[own] += np.bincount(at[j], d, size + 1)[:size]
                H[own, own] += np.diag(np.bincount(at[j], v, size + 1)[:size])
                for i in range(len(x)):
                    H[own, first[-1] + i] += np.bincount(at[j], v * x[i], size + 1)[:size]
                for k in range(j):
                    pairs = np.bincount(at[j] * (sizes[k] + 1) + at[k], v, (size + 1) * (sizes[k] + 1))
                    H[own, first[k]:first[k + 1]] += pairs.reshape(size + 1, -1)[:size, :sizes[k]]
    if seen:
        H[first[-1]:, :first[-1]] = H[:first[-1], first[-1]:].T
        H = np.tril(H) + np.tril(H, -1).T
        rows = [*np.column_stack([H, g]), np.array([loss])]
        yield pa.RecordBatch.from_arrays([pa.array(range(n + 1), pa.int32()), pa.array([v.tolist() for v in rows], pa.list_(pa.float64()))], ["i", "values"])


def _row_sum(table: pa.Table) -> pa.Table:
    total = np.sum([np.asarray(v.values) for v in table.column("values")], axis=0)
    return pa.table({"i": pa.array([table.column("i")[0].as_py()], pa.int32()), "values": pa.array([total.tolist()], pa.list_(pa.float64()))})


@dataclass
class Logistic:
    """Coefficients of the places of the preprocessor's vector, and the intercept."""

    coefficients: np.ndarray
    intercept: float

    def scored(self, prep: Preprocessor, df: DataFrame, out: str = "p") -> DataFrame:
        lookups = [prep.categories[c] for c in prep.cat_cols]
        texts, numbers = prep.inputs()
        if not texts and not numbers:
            return df.withColumn(out, F.lit(float(1 / (1 + np.exp(-self.intercept)))))
        return df.withColumn(out, F.arrow_udf(_scorer(lookups, self.coefficients, self.intercept), "double")(*texts, *numbers))


def _scorer(lookups: list, coefficients: np.ndarray, intercept: float):
    sizes = [len(kept) + more for kept, more in lookups]
    first = np.concatenate([[0], np.cumsum(sizes)]).astype(int)

    def score(*columns: pa.Array) -> pa.Array:
        margin = np.full(len(columns[0]), intercept)
        for j, places in enumerate(_looked_up(columns[: len(lookups)], lookups)):
            margin += np.append(coefficients[first[j]:first[j + 1]], 0.0)[places]
        for c, x in zip(coefficients[first[-1]:], columns[len(lookups):]):
            margin += c * x.to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore"):
            return pa.array(1 / (1 + np.exp(-margin)))

    return score


def fit_logistic(train: DataFrame, label: str, prep: Preprocessor, C: float = 1.0, max_iter: int = 2000) -> Logistic:
    """L2 logistic regression on all rows with balanced class weights (n / (2 * n_class)); the intercept has no penalty. Rows are
    encoded once and written as blocks; each of Newton's steps (about ten) is one pass over them, in which every task hands on
    the sums of first and second derivatives, whatever its rows. The driver solves for as many coefficients as there are places."""
    y = F.coalesce(F.col(label).cast("double"), F.lit(0.0))
    lookups = [prep.categories[c] for c in prep.cat_cols]
    sizes = [len(kept) + more for kept, more in lookups]
    n_places = sum(sizes) + len(prep.num_cols)
    row = train.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos")).first()
    n, pos = row["n"], row["pos"] or 0
    if not 0 < pos < n:  # one class: the best intercept is not finite
        return Logistic(np.zeros(n_places), 0.0 if not n else float("inf") if pos else float("-inf"))
    weights = (n / (2.0 * pos), n / (2.0 * (n - pos)))
    texts, numbers = prep.inputs()
    if train.sparkSession.conf.get(BATCH_KEY, None) is None:
        train.sparkSession.conf.set(BATCH_KEY, str(BATCH_BYTES))
    rows = train.select(y.alias("y"), *[c.alias(f"c{j}") for j, c in enumerate(texts)], *[c.alias(f"x{j}") for j, c in enumerate(numbers)])
    blocks = written(rows.mapInArrow(partial(_encoded, lookups), BLOCK), "encoded", **BLOCK_FILES)
    penalty = np.append(np.full(n_places, 1.0 / C), 0.0)
    theta, held, step = np.zeros(n_places + 1), None, None
    for _ in range(max_iter):
        sums = blocks.mapInArrow(partial(_curvature, theta, weights, sizes), "i int, values array<double>")
        found = {r["i"]: np.array(r["values"]) for r in sums.groupBy("i").applyInArrow(_row_sum, "i int, values array<double>").collect()}
        loss = found[n_places + 1][0] + 0.5 * float(penalty @ theta ** 2)
        if held and loss > held[1] * (1 + 1e-12):  # too far: half the step from the last point
            step = step / 2
            if np.abs(step).max() < 1e-12:
                theta = held[0]
                break
            theta = held[0] + step
            continue
        H = np.array([found[i][:-1] for i in range(n_places + 1)]) + np.diag(penalty)
        g = np.array([found[i][-1] for i in range(n_places + 1)]) + penalty * theta
        held, step = (theta, loss), -np.linalg.lstsq(H, g, rcond=None)[0]
        theta = theta + step
        if -float(g @ step) <= 1e-10 * loss:  # twice what the best point may lie below
            break
    return Logistic(theta[:-1], float(theta[-1]))


def fit_boosted_trees(train: DataFrame, label: str, prep: Preprocessor, n_trees: int = 400,
                      max_depth: int = 5, step: float = 0.05, subsample: float = 0.8,
                      feature_fraction: float = 0.8, seed: int = 42):
    """Gradient-boosted trees; positives weighted by (1-p)/max(p, 1e-6)."""
    x = prep.transform(train)
    rate = x.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0
    spw = (1 - rate) / max(rate, 1e-6)
    x = x.withColumn("w", F.when(F.col(label) == 1, spw).otherwise(1.0))
    gbt = GBTClassifier(featuresCol="features", labelCol=label, weightCol="w", maxIter=n_trees,
                        maxDepth=max_depth, stepSize=step, subsamplingRate=subsample,
                        featureSubsetStrategy=str(feature_fraction), seed=seed)
    return gbt.fit(x.withColumn(label, F.col(label).cast("double")))


def predict_proba(model, prep: Preprocessor, df: DataFrame, out: str = "p") -> DataFrame:
    if isinstance(model, Logistic):
        return model.scored(prep, df, out)
    x = model.transform(prep.transform(df))
    return x.withColumn(out, vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction")
