"""Embedding near-duplicates by a pivot-permutation index.

Vectors compare only within equal, non-null labels and equal lengths, by cosine in double precision.
Vectors that are null, zero or hold a null or non-finite component link with nothing.

1. Equal (label, vector) rows are one class; a class joins once, however many copies it has.
2. Pivots: at most ``PIVOT_CANDIDATES`` classes with the smallest hashes (a documented, bounded
   sample) are looked at, and those with a cosine below ``PIVOT_APART`` to all chosen before become
   reference points, about 2 * sqrt(classes) of them, at most ``MAX_PIVOTS``.
3. Each vector is described by the order of its ``NEAREST`` nearest pivots and posted to the inverted
   lists of the first ``POSTS`` of them, within its label. Every vector is indexed.
4. Each list is worked on in blocks (a hot list spreads over many units). Within a unit, pairs that
   share at least ``SHARED`` pivots of their descriptions are verified by cosine. A pair that meets in
   several lists counts in the first. Units return counts and one link per member, never pairs.
5. Components of the links.

If a label or length has few vectors the same steps hold; vectors of a length without pivots share
one list. Result, one row per vector: vec_id, n_links, component_id, kept. Rows that repeat a vec_id
count as vectors of their own; a null vec_id takes part and has kept = false. An empty table gives no
rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcredit.llm.common import block_units, components, map_arrow, materialize, ship

THRESHOLD = 0.98
PIVOT_CANDIDATES = 8192
PIVOT_APART = 0.8
MAX_PIVOTS = 2048
NEAREST = 10
POSTS = 4
SHARED = 3
BLOCK = 512


def classes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vec_id, cls) per row, cls null where the vector links with nothing; and the classes
    (cls, label, embedding, copies, first_id)."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    ok = F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine & some
    text = F.concat_ws("|", F.col("label").cast("string"), F.concat_ws(",", F.transform("embedding", lambda x: x.cast("string"))))
    rows = v.withColumn("cls", F.when(F.coalesce(ok, F.lit(False)), F.unhex(F.md5(text))))
    kinds = rows.where("cls is not null").groupBy("cls").agg(
        F.first("label").cast("string").alias("label"), F.first("embedding").alias("embedding"),
        F.count("*").alias("copies"), F.min("vec_id").alias("first_id"))
    return rows.select("vec_id", "cls"), kinds


def choose_pivots(classes: DataFrame) -> dict[int, np.ndarray]:
    """Unit pivots by vector length, from a bounded sample."""
    n = classes.count()
    rows = classes.select("cls", "embedding").orderBy(F.xxhash64("cls"), "cls").limit(PIVOT_CANDIDATES).collect()
    most = int(min(MAX_PIVOTS, max(16, 2 * n**0.5)))
    by: dict[int, list] = {}
    for r in rows:
        x = np.array(r["embedding"], np.float64)
        x /= np.abs(x).max()
        x /= np.linalg.norm(x)
        chosen = by.setdefault(len(x), [])
        if len(chosen) < most and (not chosen or (np.array(chosen) @ x).max() < PIVOT_APART):
            chosen.append(x)
    return {d: np.array(p) for d, p in by.items()}


def _unit(rows) -> np.ndarray:
    x = np.asarray(rows, np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # components near the ends of the range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nearest_pivots(x: np.ndarray, pivots: np.ndarray | None) -> np.ndarray:
    """The ordered NEAREST pivots of unit vectors; ties by pivot number."""
    if pivots is None or not len(pivots):
        return np.full((len(x), 1), -1, np.int64)
    k = min(NEAREST, len(pivots))
    return np.argsort(-np.round(x @ pivots.T, 12), axis=1, kind="stable")[:, :k]


def described(classes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """cls, label, dim, near: every class with its ordered nearest pivots."""
    def run(batches):
        for b in batches:
            vecs = b.column(2).to_pylist()
            near: list = [None] * len(vecs)
            dims = np.array([len(v) for v in vecs], np.int64)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                for lo in range(0, len(at), 1024):
                    part = at[lo: lo + 1024]
                    got = nearest_pivots(_unit([vecs[k] for k in part]), pivots.get(int(d)))
                    for k, row in zip(part, got.tolist()):
                        near[k] = row
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(dims, pa.int32()), pa.array(near, pa.list_(pa.int32()))],
                names=["cls", "label", "dim", "near"])

    return map_arrow(classes.select("cls", "label", "embedding"), run, "cls binary, label string, dim int, near array<int>")


def verify_unit(x: np.ndarray, near: np.ndarray, copies: np.ndarray, rank: np.ndarray, ia: np.ndarray, ib: np.ndarray, same: bool, here: int, threshold: float):
    """(gain, root) of the members of a unit; ``rank`` orders members by class key."""
    gain, low = np.zeros(len(x), np.int64), rank.copy()
    posts = near[:, :POSTS]
    least = min(SHARED, near.shape[1])
    links = []
    for a0 in range(0, len(ia), BLOCK):
        for b0 in range(a0 if same else 0, len(ib), BLOCK):
            u, v = ia[a0: a0 + BLOCK], ib[b0: b0 + BLOCK]
            _, code = np.unique(np.concatenate([near[u], near[v]]), return_inverse=True)
            code = code.reshape(len(u) + len(v), -1)
            has = np.zeros((len(code), code.max() + 1), np.float32)
            np.put_along_axis(has, code, 1, 1)
            hit = has[: len(u)] @ has[len(u):].T >= least
            hit &= x[u] @ x[v].T >= threshold
            if same and a0 == b0:
                hit &= np.triu(np.ones(hit.shape, bool), 1)
            p, q = np.nonzero(hit)
            for lo in range(0, len(p), 1 << 17):
                i, j = u[p[lo: lo + (1 << 17)]], v[q[lo: lo + (1 << 17)]]
                shared = (posts[i][:, :, None] == posts[j][:, None, :]).any(2)
                first = np.where(shared, posts[i], np.iinfo(np.int64).max).min(1)
                ok = first == here
                links.append((i[ok], j[ok]))
    if links:
        i, j = (np.concatenate([part[k] for part in links]) for k in (0, 1))
        np.add.at(gain, i, copies[j])
        np.add.at(gain, j, copies[i])
        while len(i):
            before = low.copy()
            np.minimum.at(low, i, low[j])
            np.minimum.at(low, j, low[i])
            if (low == before).all():
                break
    return gain, np.argsort(rank)[low]


def class_links(classes: DataFrame, desc: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """cls, gain, root for members of the inverted lists."""
    posts = desc.select(F.col("cls").alias("member"), "label", "dim", F.explode(F.slice("near", 1, POSTS)).alias("pivot"))
    units = block_units(posts, ["label", "dim", "pivot"], block)
    full = desc.select(F.col("cls").alias("member"), "near").join(
        classes.select(F.col("cls").alias("member"), "embedding", "copies"), "member")
    units = units.join(full, "member")

    def verify(key, table):
        here, i, j = key[2].as_py(), key[3].as_py(), key[4].as_py()
        cls = table["member"].to_pylist()
        x = _unit(table["embedding"].to_pylist())
        near = np.array(table["near"].to_pylist(), np.int64)
        order = sorted(range(len(cls)), key=cls.__getitem__)
        rank = np.empty(len(cls), np.int64)
        rank[order] = np.arange(len(cls))
        side_a = np.array([s == "a" for s in table["side"].to_pylist()])
        ia = np.arange(len(cls)) if i == j else np.flatnonzero(side_a)
        ib = ia if i == j else np.flatnonzero(~side_a)
        gain, root = verify_unit(x, near, table["copies"].to_numpy(), rank, ia, ib, i == j, here, threshold)
        some = np.flatnonzero(gain > 0)
        return pa.table({"cls": pa.array([cls[k] for k in some], pa.binary()), "gain": pa.array(gain[some], pa.int64()),
                         "root": pa.array([cls[root[k]] for k in some], pa.binary())})

    ship(classes.sparkSession)
    return units.groupBy("label", "dim", "pivot", "unit_i", "unit_j").applyInArrow(verify, "cls binary, gain long, root binary")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row (see the module's text)."""
    rows, kinds = classes_of(vectors)
    classes = materialize(kinds, "classes")
    desc = materialize(described(classes, choose_pivots(classes)), "described")
    links = materialize(class_links(classes, desc, threshold), "links")
    roots = components(links.select(F.col("cls").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("cls"), "root")
    gains = links.groupBy("cls").agg(F.sum("gain").alias("gain"))
    c = classes.select("cls", "copies", "first_id").join(gains, "cls", "left").join(roots, "cls", "left")
    c = materialize(c.withColumn("root", F.coalesce("root", "cls")), "groups")
    low = c.groupBy("root").agg(F.min("first_id").alias("component_id"))
    c = c.join(low, "root").select("cls", "component_id", (F.col("copies") - 1 + F.coalesce("gain", F.lit(0))).alias("n_links"))
    out = rows.join(c, "cls", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
