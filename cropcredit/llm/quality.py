"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

Features of a whole text: log counts of its words in ``WORD_BUCKETS`` hashed buckets (scaled to
length 1), the square roots of its byte shares (structure: punctuation, symbols, capitals, digits,
line breaks), a few ratios (distinct words, word and line length) and its length. Labels, language,
source and ids are never features.

score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)):
the sum-of-squares identity gives all pairwise interactions in linear time.

Training: numpy, Adam, on the driver, over a bounded sample of labelled rows (``sample_per_class``
documents of each label, those with the smallest hash of their id). Scoring: every text, in Arrow
batches worked on in blocks of 1 MB.

Null and empty texts are scored from the features of an empty text. Repeated labels of one document
count as the lowest; of rows that repeat a doc_id one is learned from (the smallest text by hash). Without labelled rows every score is 0.5. Copies score alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropcredit.llm.bytes_np import as_strings, blocks, buffers, runs, words
from cropcredit.llm.common import free_name, map_arrow, one_row_each

WORD_BUCKETS = 2048
FACTORS = 8
SAMPLE_PER_CLASS = 3000
ACCEPT = 0.7
N_STRUCTURE = 129 + 6


def features(arr: pa.LargeStringArray) -> np.ndarray:
    """Dense features of a block of texts: (texts, WORD_BUCKETS + N_STRUCTURE)."""
    n = len(arr)
    x = np.zeros((n, WORD_BUCKETS + N_STRUCTURE), np.float32)
    h, text, _, _, _ = words(arr)
    n_words = np.bincount(text, minlength=n)
    counts = np.bincount(text * WORD_BUCKETS + (h % np.uint64(WORD_BUCKETS)).astype(np.int64), minlength=n * WORD_BUCKETS)
    w = np.log1p(counts.reshape(n, WORD_BUCKETS)).astype(np.float32)
    x[:, :WORD_BUCKETS] = w / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-6)
    data, offs = buffers(arr)
    size = np.diff(offs)
    of = np.repeat(np.arange(n), size)
    byte = np.minimum(data, 128).astype(np.int64)
    share = np.bincount(of * 129 + byte, minlength=n * 129).reshape(n, 129) / np.maximum(size, 1)[:, None]
    x[:, WORD_BUCKETS: WORD_BUCKETS + 129] = np.sqrt(share)
    order = np.lexsort((h, text))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])
    distinct = np.bincount(text[order][new], minlength=n)
    _, _, line_of = runs(data != 10, offs)
    lines = np.bincount(line_of, minlength=n)
    extra = x[:, WORD_BUCKETS + 129:]
    extra[:, 0] = distinct / np.maximum(n_words, 1)
    extra[:, 1] = np.log1p(size) / 10
    extra[:, 2] = np.log1p(n_words) / 10
    extra[:, 3] = size / np.maximum(n_words, 1) / 10
    extra[:, 4] = np.log1p(n_words / np.maximum(lines, 1)) / 5
    extra[:, 5] = lines / np.maximum(n_words, 1)
    return np.minimum(x, 4)


class FactorisationMachine:
    def __init__(self, n: int, factors: int = FACTORS, seed: int = 7):
        self.w0 = np.float32(0)
        self.w = np.zeros(n, np.float32)
        self.v = np.random.default_rng(seed).normal(0, 0.05, (n, factors)).astype(np.float32)

    def logits(self, x: np.ndarray) -> np.ndarray:
        xv = x @ self.v
        return self.w0 + x @ self.w + 0.5 * ((xv * xv).sum(1) - (x * x) @ (self.v * self.v).sum(1))

    def fit(self, x: np.ndarray, y: np.ndarray, steps=1500, batch=128, rate=0.02, decay=1e-3, seed=7):
        """Logistic loss; at least ``steps`` batches."""
        rng = np.random.default_rng(seed)
        pars = [self.w, self.v]
        m = [np.zeros_like(p) for p in pars] + [0.0]
        s = [np.zeros_like(p) for p in pars] + [0.0]
        step = 0
        for _ in range(-(-steps * batch // max(len(y), 1)) if len(y) > batch else steps):
            order = rng.permutation(len(y))
            for lo in range(0, len(y), batch):
                k = order[lo: lo + batch]
                xb = x[k]
                g = (1 / (1 + np.exp(-np.clip(self.logits(xb), -30, 30))) - y[k]) / len(k)
                xv = xb @ self.v
                grads = [xb.T @ g + decay * self.w,
                         xb.T @ (g[:, None] * xv) - ((xb * xb).T @ g)[:, None] * self.v + decay * self.v, g.sum()]
                step += 1
                for j, grad in enumerate(grads):
                    m[j] = 0.9 * m[j] + 0.1 * grad
                    s[j] = 0.999 * s[j] + 0.001 * grad * grad
                    move = rate * (m[j] / (1 - 0.9**step)) / (np.sqrt(s[j] / (1 - 0.999**step)) + 1e-8)
                    if j < 2:
                        pars[j] -= move.astype(np.float32)
                    else:
                        self.w0 = np.float32(self.w0 - move)
        return self

    def scores(self, arr: pa.LargeStringArray) -> np.ndarray:
        parts = [self.logits(features(arr.slice(lo, hi - lo))) for lo, hi in blocks(arr)]
        z = np.concatenate(parts) if parts else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))


def labelled_sample(labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """doc_id, quality: at most ``per_class`` documents of each label that may be learned from."""
    rows = labels.where("doc_id is not null and quality in (0, 1)").where(
        F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    rows = rows.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = [F.xxhash64("doc_id", F.lit(5)), F.col("doc_id")]
    parts = [rows.where(F.col("quality") == q).orderBy(*order).limit(per_class) for q in (0, 1)]
    return parts[0].unionAll(parts[1])


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> FactorisationMachine | None:
    """Fit on the sample: its features (at most 2 * per_class rows) come to the driver as arrays of
    the non-zero features."""
    def run(batches):
        for b in batches:
            arr, at, val = as_strings(b.column(1)), [], []
            for lo, hi in blocks(arr):
                for row in features(arr.slice(lo, hi - lo)):
                    k = np.flatnonzero(row)
                    at.append(k.astype(np.uint16).tobytes())
                    val.append(row[k].astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at, pa.binary()), pa.array(val, pa.binary())],
                                             names=["quality", "at", "val"])

    sample = labelled_sample(labels, per_class)  # bounded by 2 * per_class rows
    texts = one_row_each(docs, sample)
    rows = map_arrow(texts.select(F.col("quality").cast("int"), "text"), run, "quality int, at binary, val binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.quality, r.at, r.val))  # the model must not depend on the order of tasks
    x = np.zeros((len(rows), WORD_BUCKETS + N_STRUCTURE), np.float32)
    for k, r in enumerate(rows):
        x[k, np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["val"], np.float16)
    return FactorisationMachine(x.shape[1]).fit(x, np.array([r.quality for r in rows], np.float32))


def score(docs: DataFrame, model: FactorisationMachine | None, column: str) -> DataFrame:
    """Adds ``column``: the score of each whole text."""
    names = docs.columns

    def run(batches):
        for b in batches:
            arr = as_strings(b.column(names.index("text")))
            s = model.scores(arr) if model else np.full(len(arr), 0.5)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], names=[*names, column])

    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])
    return map_arrow(docs, run, schema)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with a score of at least ``ACCEPT``, with their columns."""
    column = free_name(docs, "quality_score")
    return score(docs, train(docs, labels), column).where(F.col(column) >= ACCEPT).drop(column)
