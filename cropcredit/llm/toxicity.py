"""Toxicity: a sparse factorisation machine over hashed terms.

Features of a whole text: which of its words (lower-cased) occur, hashed into 2^``HASH_BITS`` buckets, so that
long texts of other words hardly meet a learned one. The model knows the buckets that occur in at least
``MIN_DOCS`` documents of its sample; others count for nothing. No length or share is a feature, and presence is
not scaled by length: an insult counts alike in a short and in a very long text.

score = sigmoid(w0 + sum_i w_i + 1/2 sum_f ((sum_i v_if)^2 - sum_i v_if^2)) over the known buckets of the text:
the sum-of-squares identity gives all pairwise interactions (an insult beside the mention of a group) in linear
time; additive weights alone can't tell such pairs from their parts.

Training: numpy on the driver, Adagrad over a bounded sample (at most ``per_class`` documents of each label, those
with the smallest hash of their id). A proximal step shrinks each weight (``L1``) and each row of factors (as a group,
``GROUP``) towards zero, so words without a meaning for the label end at exactly zero and can't add up in long texts;
factors stay where pairs tell more than the words alone.

Null and empty texts are scored as texts without known words. Of a doc_id that repeats, one row is learned from
(the smallest text by hash); repeated labels count as the highest. Every row is scored, copies alike. Without
labelled rows every score is 0: nothing is known to be toxic. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropcredit.llm.bytes_np import as_strings, blocks, words
from cropcredit.llm.common import map_arrow, one_row_each

HASH_BITS = 24
FACTORS = 6
SAMPLE_PER_CLASS = 4000
MIN_DOCS = 4
#: Penalties on a weight and on a row of factors, in documents.
L1, GROUP = 0.5, 4.0
ACCEPT = 0.5


def terms(arr: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of each distinct bucket of each text of a block, in order."""
    h, text, *_ = words(arr)
    code = np.unique((text.astype(np.int64) << HASH_BITS) | (h >> np.uint64(64 - HASH_BITS)).astype(np.int64))
    return code >> HASH_BITS, code & ((1 << HASH_BITS) - 1)


class TermMachine:
    """A factorisation machine over 0/1 features; ``known`` holds the sorted buckets it has weights for."""

    def __init__(self, known: np.ndarray, factors: int = FACTORS, seed: int = 11):
        self.known, self.w0 = known, 0.0
        self.w = np.zeros(len(known))
        self.v = np.random.default_rng(seed).normal(0, 0.02, (len(known), factors))

    def logits(self, text: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """``at``: positions in ``known``; ``text``: the text of each, below n."""
        z = self.w0 + np.bincount(text, self.w[at], n)
        for f in range(self.v.shape[1]):
            v = self.v[at, f]
            z += 0.5 * (np.bincount(text, v, n) ** 2 - np.bincount(text, v * v, n))
        return z

    def fit(self, text: np.ndarray, at: np.ndarray, y: np.ndarray, passes=20, alone=10, batch=64, rate=1.0, rate_v=0.1, seed=11):
        """``text`` ascending. Logistic loss; the additive weights learn ``alone`` passes before the factors join in, so
        that factors explain what weights can't. The penalties are in documents: a term whose evidence over the whole
        sample is below them stays at zero."""
        rng = np.random.default_rng(seed)
        n_terms, factors = self.v.shape
        first = np.searchsorted(text, np.arange(len(y) + 1))
        docs_of = np.bincount(at, minlength=n_terms)
        squares_w, squares_v, square0 = np.ones(n_terms), np.ones(n_terms), 1.0
        all_v = self.v
        for p in range(passes):
            self.v = all_v if p >= alone else all_v[:, :0]
            order = rng.permutation(len(y))
            for lo in range(0, len(y), batch):
                rows = order[lo: lo + batch]
                sizes = first[rows + 1] - first[rows]
                local = np.repeat(np.arange(len(rows)), sizes)
                here = at[np.arange(int(sizes.sum())) + np.repeat(first[rows] - (np.cumsum(sizes) - sizes), sizes)]
                g = 1 / (1 + np.exp(-np.clip(self.logits(local, here, len(rows)), -30, 30))) - y[rows]
                each, where, seen = np.unique(here, return_inverse=True, return_counts=True)
                share = seen / docs_of[each]  # of the term's documents
                gw = np.bincount(where, g[local], len(each))
                squares_w[each] += gw * gw
                step = rate / np.sqrt(squares_w[each])
                w = self.w[each] - step * gw
                self.w[each] = np.sign(w) * np.maximum(np.abs(w) - step * L1 * share, 0)
                if p >= alone and factors:
                    v = self.v[here]
                    total = np.stack([np.bincount(local, v[:, f], len(rows)) for f in range(factors)], 1)
                    pull = g[local][:, None] * (total[local] - v)
                    gv = np.stack([np.bincount(where, pull[:, f], len(each)) for f in range(factors)], 1)
                    squares_v[each] += (gv * gv).sum(1)
                    step = (rate_v / np.sqrt(squares_v[each]))[:, None]
                    v = self.v[each] - step * gv
                    norm = np.sqrt((v * v).sum(1, keepdims=True))
                    self.v[each] = v * np.maximum(1 - step * GROUP * share[:, None] / np.maximum(norm, 1e-12), 0)
                square0 += g.sum() ** 2
                self.w0 -= rate / np.sqrt(square0) * g.sum()
        self.v = all_v
        keep = (self.w != 0) | (self.v != 0).any(1)
        self.known, self.w, self.v = self.known[keep], self.w[keep], self.v[keep]
        return self

    def scores(self, arr: pa.LargeStringArray) -> np.ndarray:
        out = []
        for lo, hi in blocks(arr):
            text, bucket = terms(arr.slice(lo, hi - lo))
            at = np.searchsorted(self.known, bucket)
            hit = self.known[np.minimum(at, len(self.known) - 1)] == bucket if len(self.known) else np.zeros(len(bucket), bool)
            out.append(self.logits(text[hit], at[hit], hi - lo))
        z = np.concatenate(out) if out else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def labelled_sample(labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """doc_id, toxic: at most ``per_class`` documents of each label that may be learned from."""
    rows = labels.where("doc_id is not null and toxic in (0, 1)").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    rows = rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = [F.xxhash64("doc_id", F.lit(12)), F.col("doc_id")]
    parts = [rows.where(F.col("toxic") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    return parts[0].unionAll(parts[1])


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> TermMachine | None:
    """Fit on the sample: the distinct buckets of at most 2 * per_class documents come to the driver."""
    def run(batches):
        for b in batches:
            arr, found = as_strings(b.column(1)), []
            for lo, hi in blocks(arr):
                text, bucket = terms(arr.slice(lo, hi - lo))
                found += [p.astype(np.uint32).tobytes() for p in np.split(bucket, np.searchsorted(text, np.arange(1, hi - lo)))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary())], names=["toxic", "buckets"])

    texts = one_row_each(docs, labelled_sample(labels, per_class))
    rows = map_arrow(texts.select("toxic", "text"), run, "toxic int, buckets binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.toxic, r.buckets))  # the model must not depend on the order of tasks
    found = [np.frombuffer(r.buckets, np.uint32).astype(np.int64) for r in rows]
    bucket, text = np.concatenate(found), np.repeat(np.arange(len(rows)), [len(x) for x in found])
    known, docs_of = np.unique(bucket, return_counts=True)
    known = known[docs_of >= MIN_DOCS]
    at = np.searchsorted(known, bucket)
    hit = known[np.minimum(at, len(known) - 1)] == bucket if len(known) else np.zeros(len(bucket), bool)
    return TermMachine(known).fit(text[hit], at[hit], np.array([r.toxic for r in rows], float))


def score(docs: DataFrame, model: TermMachine | None, column: str) -> DataFrame:
    """Adds ``column``: the score of each whole text."""
    names = docs.columns

    def run(batches):
        for b in batches:
            arr = as_strings(b.column(names.index("text")))
            s = model.scores(arr) if model else np.zeros(len(arr))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], names=[*names, column])

    return map_arrow(docs, run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))
