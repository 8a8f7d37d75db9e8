"""Second-order gradient boosting over histograms.

Rows are binned once: a category is its place among the kept values (one more for the rest), a number its place
among exact quantile cuts, -1 if NULL. For training they are written as blocks: one record holds the bins, weights and margins of
many rows as bytes, so that a level reads arrays and no rows. For one level of a tree, every task sums the gradients and hessians
of its rows per (node, column, bin) in numpy, and hands on these sums alone; one aggregation adds those of all tasks: at most
nodes * columns * bins rows of a task, whatever the table's size, and no row is expanded. The driver
picks each node's best split from them: a category against all others (the split that an indicator column gives),
or numbers up to a cut, with NULL on the better side. So a tree costs one job per level; leaf values follow from the chosen
splits' sums. Blocks are written anew with the scores so far every ``WRITE_EVERY`` trees, which bounds the trees that a level walks.

Each tree sees a share of the rows (by a hash of their key, the same whatever the partitioning) and of the columns.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropcredit.operators.ranks import top_values, values_at
from cropcredit.session import written

#: Bins of a number, and trees between two writes of the scores.
BINS = 16
WRITE_EVERY = 5
#: Rows of a block (about 50 bytes a row), about.
BLOCK_ROWS = 10_000
#: A row group is read at once, and an Arrow batch is held twice: both are kept small, since a record is some 500 KB.
BLOCK_FILES = {"parquet.block.size": 16 << 20}
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


@dataclass
class Split:
    column: int
    at: int
    category: bool
    null_left: bool
    gain: float
    left: tuple  # sums of gradient and hessian
    right: tuple

    def test(self) -> Column:
        b = F.get("bins", F.lit(self.column))
        if self.category:
            return b == self.at
        return (b <= self.at) & (F.lit(self.null_left) | (b >= 0))


@dataclass
class Binning:
    """Kept categories and cuts of the columns, in order (categories first)."""

    cat_cols: list
    num_cols: list
    max_categories: int = 30
    bins: int = BINS
    kept: dict = field(default_factory=dict)  # column -> (values, whether the rest is a class of its own)
    cuts: dict = field(default_factory=dict)

    def fit(self, train: DataFrame) -> "Binning":
        for c, (top, n) in top_values(train, self.cat_cols, self.max_categories).items():
            self.kept[c] = (sorted(top[: self.max_categories - 1] if n > self.max_categories else top), n > self.max_categories)
        ranks = {c: (lambda n: [(n - 1) * k // self.bins for k in range(1, self.bins)]) for c in self.num_cols}
        self.cuts = {c: sorted(set(v)) for c, v in values_at(train, ranks).items()}
        return self

    @property
    def columns(self) -> list:
        return [*self.cat_cols, *self.num_cols]

    def places(self) -> Column:
        out = []
        for c in self.cat_cols:
            values = self.kept[c][0]
            place = F.array_position(F.array(*[F.lit(v) for v in values]), F.coalesce(F.col(c).cast("string"), F.lit("NA"))) if values else F.lit(0)
            out.append(F.when(place > 0, place - 1).otherwise(len(values)).cast("int"))
        for c in self.num_cols:
            x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
            cuts = F.array(*[F.lit(float(v)) for v in self.cuts[c]]) if self.cuts[c] else F.array().cast("array<double>")
            out.append(F.when(x.isNull(), -1).otherwise(F.size(F.filter(cuts, lambda v: v < x))).cast("int"))
        return F.array(*out)

    def name(self, split: Split) -> str:
        """A split in words: the category, or the cut up to which numbers go left."""
        c = self.columns[split.column]
        if not split.category:
            return repr(float(self.cuts[c][split.at]))
        return (self.kept[c][0] + ["infrequent"])[split.at]


def candidates(sums: dict, binning: Binning, l2: float, min_hessian: float) -> list[Split]:
    """All splits of one node. ``sums``: column -> bin -> (gradient, hessian)."""
    out = []
    for column, bins in sums.items():
        category = column < len(binning.cat_cols)
        G, H = (sum(v[j] for v in bins.values()) for j in (0, 1))

        def add(at, g, h, null_left=False):
            rest = (G - g, H - h)
            if h < min_hessian or rest[1] < min_hessian:
                return
            gain = 0.5 * (g * g / (h + l2) + rest[0] ** 2 / (rest[1] + l2) - G * G / (H + l2))
            out.append(Split(column, at, category, null_left, gain, (g, h), rest))

        if category:
            values, rest = binning.kept[binning.columns[column]]
            for at in range(len(values) + rest):
                add(at, *bins.get(at, (0.0, 0.0)))
            continue
        g0, h0 = bins.get(-1, (0.0, 0.0))
        g = h = 0.0
        for at in range(len(binning.cuts[binning.columns[column]])):
            g, h = g + bins.get(at, (0.0, 0.0))[0], h + bins.get(at, (0.0, 0.0))[1]
            add(at, g, h)
            if h0:
                add(at, g + g0, h + h0, True)
    return out


class _Sums:
    """Gradients and hessians by (node, column, bin), added up from rows."""

    def __init__(self, columns: list[int]):
        self.columns, self.total = columns, np.zeros((2, 0, len(columns), 0))  # bin + 1

    def add(self, node: np.ndarray, bins: np.ndarray, g: np.ndarray, h: np.ndarray) -> None:
        """``bins``: a row of it for each of the columns."""
        if not len(node):
            return
        total = self.total
        nodes, width = max(total.shape[1], int(node.max()) + 1), max(total.shape[3], int(bins.max()) + 2)
        total = np.pad(total, ((0, 0), (0, nodes - total.shape[1]), (0, 0), (0, width - total.shape[3])))
        first = node.astype(np.int64) * width + 1
        for j in range(len(self.columns)):
            at = first + bins[j]
            for k, v in enumerate((g, h)):
                total[k, :, j] += np.bincount(at, v, nodes * width).reshape(nodes, width)
        self.total = total

    def batch(self) -> pa.RecordBatch:
        """(node, c, b, g, h)"""
        node, j, b = np.nonzero(self.total.any(axis=0))
        found = [node, np.array(self.columns, dtype=np.int64)[j], b - 1]
        return pa.RecordBatch.from_arrays([*[pa.array(v, pa.int32()) for v in found], *[pa.array(self.total[k, node, j, b]) for k in (0, 1)]], ["node", "c", "b", "g", "h"])


SUMS = "node int, c int, b int, g double, h double"


def _task_sums(columns: list[int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of one task's rows: (node, c, b, g, h)."""
    sums = _Sums(columns)
    for batch in batches:
        if batch.num_rows:
            node, g, h = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "g", "h"))
            bins = batch.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            sums.add(node, bins.T[columns], g, h)
    yield sums.batch()


def _added(parts: DataFrame) -> dict:
    """The sums of all tasks: node -> column -> bin -> (gradient, hessian)."""
    out: dict = {}
    for r in parts.groupBy("node", "c", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():  # bounded by nodes * columns * bins
        out.setdefault(r["node"], {}).setdefault(r["c"], {})[r["b"]] = (r["g"], r["h"])
    return out


def histograms(rows: DataFrame, columns: list[int]) -> dict:
    """node -> column -> bin -> (gradient, hessian) of rows (node, bins, g, h); bins without weight are left out."""
    return _added(rows.select("node", "bins", "g", "h").mapInArrow(partial(_task_sums, columns), SUMS))


# --- blocks -----------------------------------------------------------------------------

#: One block: hashes of the rows' keys, labels, weights and margins, and their bins, column by column (signed, -1 is NULL).
BLOCK = "key binary, y binary, w binary, margin binary, bins binary"


def _block(key, y, w, margin, bins) -> pa.RecordBatch:
    parts = [np.ascontiguousarray(v).tobytes() for v in (key, y, w, margin, bins)]
    return pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in parts], ["key", "y", "w", "margin", "bins"])


def _packed(kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, y, w, bins, margin) to blocks; ``kind``: numpy's type of a bin."""
    held, n = [], 0

    def block():
        key, y, w, margin = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in ("key", "y", "w", "margin"))
        bins = np.concatenate([b.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) for b in held])
        return _block(key.astype("<i8"), y.astype("<f8"), w.astype("<f8"), margin.astype("<f8"), bins.T.astype(kind))

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= BLOCK_ROWS:
            yield block()
            held, n = [], 0
    if n:
        yield block()


def _opened(kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(key, y, w, margin, bins) of each block."""
    for batch in batches:
        for r in range(batch.num_rows):
            key, y, w, margin, bins = (np.frombuffer(batch.column(c)[r].as_buffer(), t) for c, t in enumerate(("<u8", "<f8", "<f8", "<f8", kind)))
            yield key, y, w, margin, bins.reshape(-1, len(y))


def _nodes(tree: Tree, bins: np.ndarray) -> np.ndarray:
    """The node that each row has come to, as ``Tree.node`` gives it."""
    node = np.ones(bins.shape[1], dtype=np.int64)
    if not tree.splits:
        return node
    size = 2 * max(tree.splits) + 2
    column, at = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    known, category, null_left = (np.zeros(size, dtype=bool) for _ in range(3))
    for i, s in tree.splits.items():
        column[i], at[i], known[i], category[i], null_left[i] = s.column, s.at, True, s.category, s.null_left
    rows = np.arange(len(node))
    for _ in range(max(tree.splits).bit_length()):
        b, a = bins[column[node], rows], at[node]
        left = np.where(category[node], b == a, (b <= a) & (null_left[node] | (b >= 0)))
        node = np.where(known[node], 2 * node + ~left, node)
    return node


def _margins(trees: list, margin: np.ndarray, bins: np.ndarray) -> np.ndarray:
    for tree in trees:
        leaves = np.zeros(2 * max(tree.splits, default=1) + 2)
        for i, v in tree.leaves.items():
            leaves[i] = v
        margin = margin + leaves[_nodes(tree, bins)]
    return margin


def _moved(kind: str, trees: list, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks whose margins hold ``trees`` too."""
    for key, y, w, margin, bins in _opened(kind, batches):
        yield _block(key, y, w, _margins(trees, margin, bins), bins)


def _lost(kind: str, trees: list, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(weighted log loss, weight) of one task's rows."""
    loss = weight = 0.0
    for _, y, w, margin, bins in _opened(kind, batches):
        m = _margins(trees, margin, bins)
        loss, weight = loss + float((w * np.logaddexp(0, np.where(y == 1, -m, m))).sum()), weight + float(w.sum())
    yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([weight])], ["loss", "weight"])


def _hashed(value: int, seeds: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of one more int argument: the hash so far is its seed."""
    p1, p2, p3, p5 = (np.uint64(v) for v in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
    h = (seeds + p5 + np.uint64(4)) ^ np.uint64((value & 0xFFFFFFFF) * int(p1) & 0xFFFFFFFFFFFFFFFF)
    h = ((h << np.uint64(23)) | (h >> np.uint64(41))) * p2 + p3
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))


def _sampled(key: np.ndarray, k: int, seed: int, share: float) -> np.ndarray:
    """Whether a tree sees a row: by a hash of its key, the tree and the seed."""
    return np.mod(_hashed(seed, _hashed(k, key)).view(np.int64), 1_000_000) < int(share * 1_000_000)


def _level(kind: str, trees: list, tree: Tree, open_: list, columns: list[int], sample: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of one task's rows in the ``open_`` nodes of ``tree``, after ``trees`` that the margins don't hold yet.
    ``sample``: (number of the tree, seed, share of the rows)."""
    sums = _Sums(columns)
    wanted = np.zeros(2 * max(open_) + 2, dtype=bool)
    wanted[open_] = True
    for key, y, w, margin, bins in _opened(kind, batches):
        if sample[-1] < 1:
            seen = _sampled(key, *sample)
            y, w, margin, bins = y[seen], w[seen], margin[seen], bins[:, seen]
        node = _nodes(tree, bins)
        seen = wanted[np.minimum(node, len(wanted) - 1)]
        if not seen.all():
            node, y, w, margin, bins = node[seen], y[seen], w[seen], margin[seen], bins[:, seen]
        p = 1 / (1 + np.exp(-_margins(trees, margin, bins)))
        sums.add(node, bins[columns], w * (p - y), w * p * (1 - p))
    yield sums.batch()


def derivatives(rows: DataFrame) -> DataFrame:
    """Adds g and h of the logistic loss at ``margin``."""
    p = 1 / (1 + F.exp(-F.col("margin")))
    return rows.withColumn("g", F.col("w") * (p - F.col("y"))).withColumn("h", F.col("w") * p * (1 - p))


@dataclass
class Tree:
    """Nodes as in a heap: 1 is the root, 2i and 2i + 1 are the children of i."""

    splits: dict = field(default_factory=dict)
    leaves: dict = field(default_factory=dict)

    def _walk(self, end, i: int = 1) -> Column:
        if i not in self.splits:
            return F.lit(end(i))
        return F.when(self.splits[i].test(), self._walk(end, 2 * i)).otherwise(self._walk(end, 2 * i + 1))

    def node(self) -> Column:
        return self._walk(lambda i: i)

    def value(self) -> Column:
        return self._walk(lambda i: float(self.leaves[i]))


@dataclass
class Boosting:
    binning: Binning
    trees: list = field(default_factory=list)
    losses: list = field(default_factory=list)  # weighted mean log loss before each write

    def transform(self, df: DataFrame, out: str = "p") -> DataFrame:
        """Every row scored by all trees; the sums are written every so many trees like in training."""
        rows = df.withColumn("bins", self.binning.places()).withColumn("margin", F.lit(0.0))
        for k, t in enumerate(self.trees):
            rows = rows.withColumn("margin", F.col("margin") + t.value())
            if (k + 1) % (4 * WRITE_EVERY) == 0:
                rows = written(rows, "boosted")
        return rows.withColumn(out, 1 / (1 + F.exp(-F.col("margin")))).drop("bins", "margin")


def prepared(train: DataFrame, label: str, keys: list[str], binning: Binning) -> DataFrame:
    """(keys, y, w, bins, margin): positives weigh (1 - p) / max(p, 1e-6), p their share. Not written: what reads it more than
    once writes it."""
    rate = train.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0
    y = F.col(label).cast("double")
    weight = F.when(y == 1, (1 - rate) / max(rate, 1e-6)).otherwise(1.0)
    return train.select(*keys, y.alias("y"), weight.alias("w"), binning.places().alias("bins"), F.lit(0.0).alias("margin"))


def fit(train: DataFrame, label: str, keys: list[str], binning: Binning, n_trees: int = 400, max_depth: int = 5, rate: float = 0.05,
        rows_share: float = 0.8, columns_share: float = 0.8, l2: float = 1.0, min_hessian: float = 1.0, seed: int = 42) -> Boosting:
    """``n_trees`` trees on all rows of ``train``."""
    # as narrow as the bins allow: blocks are read once per level
    most = max([BINS, binning.bins, *[len(values) + 1 for values, _ in binning.kept.values()]])
    kind = "i1" if most < 128 else "<i4"
    rows = prepared(train, label, keys, binning).select(F.xxhash64(*keys).alias("key"), "y", "w", "bins", "margin")
    if train.sparkSession.conf.get(BATCH_KEY, None) is None:
        train.sparkSession.conf.set(BATCH_KEY, str(BATCH_BYTES))
    blocks = written(rows.mapInArrow(partial(_packed, kind), BLOCK), "boosting", **BLOCK_FILES)
    model, n_cols, new = Boosting(binning), len(binning.columns), []  # new: trees that the margins don't hold yet

    def loss():
        t = blocks.mapInArrow(partial(_lost, kind, new), "loss double, weight double").agg(F.sum("loss").alias("s"), F.sum("weight").alias("w")).first()
        return t["s"] / t["w"] if t["w"] else None

    for k in range(n_trees):
        if k % WRITE_EVERY == 0:
            if k:
                blocks, new = written(blocks.mapInArrow(partial(_moved, kind, new), BLOCK), "boosting", **BLOCK_FILES), []
            model.losses.append((k, loss()))
        columns = sorted(random.Random(f"{seed}|{k}").sample(range(n_cols), max(1, round(columns_share * n_cols))))
        tree, open_ = Tree(), [1]
        for _ in range(max_depth):
            if not open_:
                break
            found = _added(blocks.mapInArrow(partial(_level, kind, new, tree, open_, columns, (k, seed, rows_share)), SUMS))
            nodes, open_ = open_, []
            for i in nodes:
                best = max(candidates(found.get(i, {}), binning, l2, min_hessian), key=lambda s: (s.gain, -s.column, -s.at), default=None)
                if i == 1 and 1 in found:
                    g, h = (sum(v[j] for v in next(iter(found[1].values())).values()) for j in (0, 1))
                    tree.leaves[1] = -rate * g / (h + l2)
                if best is None or best.gain <= 1e-9:
                    continue
                tree.splits[i] = best
                for child, (g, h) in ((2 * i, best.left), (2 * i + 1, best.right)):
                    tree.leaves[child] = -rate * g / (h + l2)
                    open_.append(child)
        tree.leaves.setdefault(1, 0.0)
        model.trees.append(tree)
        new = [*new, tree]
    model.losses.append((n_trees, loss()))
    return model
