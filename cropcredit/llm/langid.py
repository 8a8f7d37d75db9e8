"""Language identification: a bidirectional gated recurrent network over bytes.

Every byte of a text gets a label: two GRUs read windows of ``WINDOW`` bytes (one forwards, one
backwards), and a softmax over both states gives each position's class probabilities. A document's
probabilities are the mean over all its positions that belong to words. Windows tile the whole
text; states start anew in each window, so windows of many texts are stepped through together.

Training: numpy, back-propagation through time, Adam, on the driver, over a bounded sample: about
``SAMPLE_PER_LANG`` documents of each language (by hash of the id; of rows that repeat a doc_id one, that with the
smallest text by hash), all windows of their whole texts.

Texts that are null or hold no letter get ``und`` with score 0. Without learnable rows every text
does. Copies are labelled alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropcredit.llm.bytes_np import WORD, as_strings, blocks, buffers
from cropcredit.llm.common import free_name, map_arrow

WINDOW = 48
HIDDEN = 8
SAMPLE_PER_LANG = 400
STEPS = 400
BATCH = 96
BLOCK = 1 << 18
ACCEPT = 0.4


def squash(x):
    """x (27 + x^2) / (27 + 9 x^2) on [-3, 3]: the network's tanh."""
    x = np.clip(x, -3, 3)
    s = x * x
    x *= s + np.float32(27)
    s *= np.float32(9)
    s += np.float32(27)
    x /= s
    return x


def slope(x):
    """Derivative of ``squash``."""
    s = np.clip(x, -3, 3) ** 2
    return ((9 - s) / (3 + s)) ** 2 / 9


def gate(x):
    x = squash(x)
    x *= np.float32(0.5)
    x += np.float32(0.5)
    return x


class Gru:
    """One direction. Update gate, reset gate, candidate: input weights are a table by byte. Each
    has its own arrays, so all steps work on contiguous memory."""

    def __init__(self, hidden: int, rng):
        self.x = [rng.normal(0, 0.3, (256, hidden)).astype(np.float32) for _ in range(3)]
        self.u = [rng.normal(0, 1 / np.sqrt(hidden), (hidden, hidden)).astype(np.float32) for _ in range(3)]
        self.b = np.zeros(hidden, np.float32)

    def parameters(self):
        return [*self.x, *self.u, self.b]

    def step(self, byte: np.ndarray, h: np.ndarray, keep: bool = False):
        """The next state; with ``keep`` also what ``back`` needs."""
        az, ar, ac = (x.take(byte, 0, mode="clip") for x in self.x)
        az += h @ self.u[0]
        ar += h @ self.u[1]
        p = h @ self.u[2]
        p += self.b
        r = gate(ar)
        ac += r * p
        z, c = gate(az), squash(ac)
        new = h - c
        new *= z
        new += c
        return new, (az, ar, ac, z, r, p, c) if keep else None

    def unroll(self, x: np.ndarray, order):
        """States (time, n, hidden) and, by time, what ``back`` needs: (state before, az, ar, ac, z, r, p, c)."""
        t_all, n = x.shape
        h, hs, ks = np.zeros((n, len(self.b)), self.b.dtype), [None] * t_all, [None] * t_all
        for t in order:
            new, own = self.step(x[t], h, keep=True)
            hs[t], ks[t] = new, (h, *own)
            h = new
        return np.stack(hs), [np.stack(k) for k in zip(*ks)]

    def back(self, x: np.ndarray, order, kept, dout: np.ndarray):
        """Gradients of all parameters, given those of the states (time, n, hidden)."""
        h, az, ar, ac, z, r, p, c = kept
        to_z, to_c, to_r = (h - c) * slope(az) * 0.5, (1 - z) * slope(ac), p * slope(ar) * 0.5
        u = np.concatenate(self.u, 1).T
        d = np.empty((*z.shape[:2], 3 * z.shape[2]), z.dtype)  # of the gates' u-products
        dcs = np.empty_like(z)
        dh, hid = np.zeros_like(h[0]), z.shape[2]
        for t in order:
            dh = dh + dout[t]
            dc = dh * to_c[t]
            dcs[t] = dc
            d[t, :, :hid] = dh * to_z[t]
            d[t, :, hid: 2 * hid] = dc * to_r[t]
            d[t, :, 2 * hid:] = dc * r[t]
            dh = dh * z[t] + d[t] @ u
        byte, flat = x.reshape(-1), d.reshape(-1, 3 * hid)
        at = [flat[:, :hid], flat[:, hid: 2 * hid], dcs.reshape(-1, hid)]
        gx = [np.stack([np.bincount(byte, g[:, k], minlength=256) for k in range(hid)], 1).astype(z.dtype) for g in at]
        gu = h.reshape(-1, hid).T @ flat
        return [*gx, gu[:, :hid], gu[:, hid: 2 * hid], gu[:, 2 * hid:], flat[:, 2 * hid:].sum(0)]


class LanguageModel:
    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.langs, self.hidden = langs, hidden
        self.f, self.r = Gru(hidden, rng), Gru(hidden, rng)
        self.o = rng.normal(0, 0.3, (2 * hidden, len(langs))).astype(np.float32)
        self.c = np.zeros(len(langs), np.float32)

    def gradients(self, x: np.ndarray, on: np.ndarray, y: np.ndarray):
        """(loss, gradients of all parameters): mean cross-entropy of the positions that count, by
        back-propagation through time. x: bytes (time, n); on: (time, n); y: classes (n)."""
        t_all, n, hid = len(x), x.shape[1], self.hidden
        ahead, behind = range(t_all), range(t_all - 1, -1, -1)
        fs, f_kept = self.f.unroll(x, ahead)
        rs, r_kept = self.r.unroll(x, behind)
        both = np.concatenate([fs, rs], 2)
        z = both @ self.o + self.c
        z -= z.max(2, keepdims=True)
        p = np.exp(z)
        p /= p.sum(2, keepdims=True)
        weight = on.astype(np.float32) / max(on.sum(), 1)
        loss = -float((np.log(np.maximum(p[:, np.arange(n), y], 1e-30)) * weight).sum())
        p[:, np.arange(n), y] -= 1
        dz = p * weight[:, :, None]
        dboth = dz @ self.o.T
        return loss, [*self.f.back(x, behind, f_kept, dboth[:, :, :hid]), *self.r.back(x, ahead, r_kept, dboth[:, :, hid:]),
                      np.tensordot(both, dz, ([0, 1], [0, 1])), dz.sum((0, 1))]

    def parameters(self):
        return [*self.f.parameters(), *self.r.parameters(), self.o, self.c]

    def fit(self, x: np.ndarray, on: np.ndarray, y: np.ndarray, steps=STEPS, batch=BATCH, rate=0.02, seed=3):
        """x: windows of bytes (time, n); on: positions that count (time, n); y: class of each window."""
        rng = np.random.default_rng(seed)
        pars = self.parameters()
        m, s = [np.zeros_like(p) for p in pars], [np.zeros_like(p) for p in pars]
        of = [np.flatnonzero(y == k) for k in range(len(self.langs))]
        of = [k for k in of if len(k)]
        for step in range(1, steps + 1):
            k = np.concatenate([rng.choice(o, max(1, batch // len(of))) for o in of])
            _, grads = self.gradients(x[:, k], on[:, k], y[k])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            lr = rate * (1 - 0.9 * step / steps) / (1 - 0.9**step)
            for q, g, mm, ss in zip(pars, grads, m, s):
                g = g / max(1.0, norm)
                mm += 0.1 * (g - mm)
                ss += 0.001 * (g * g - ss)
                q -= (lr * mm / (np.sqrt(ss / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def positions(self, x: np.ndarray):
        """Class probabilities of every position of windows x (time, n): yields (t, (classes, n))."""
        hid, t_all = self.hidden, len(x)
        part = np.empty((t_all, len(self.langs), x.shape[1]), np.float32)
        front, back = np.ascontiguousarray(self.o[:hid].T), np.ascontiguousarray(self.o[hid:].T)
        h = np.zeros((x.shape[1], hid), np.float32)
        for t in range(t_all):
            h, _ = self.f.step(x[t], h)
            np.matmul(front, h.T, out=part[t])
        h = np.zeros((x.shape[1], hid), np.float32)
        for t in range(t_all - 1, -1, -1):
            h, _ = self.r.step(x[t], h)
            z = part[t]
            z += back @ h.T
            z += self.c[:, None]
            z -= z.max(0)
            np.exp(z, out=z)
            z /= z.sum(0)
            yield t, z

    def predict(self, arr: pa.LargeStringArray):
        """(language, score) of each whole text."""
        langs, scores = [], []
        for lo, hi in blocks(arr, BLOCK):
            part = arr.slice(lo, hi - lo)
            data, offs = buffers(part)
            pooled = np.zeros((hi - lo, len(self.langs)))
            text, starts = windows(offs)
            for a in range(0, len(starts), BLOCK // WINDOW):  # also bounds the windows of one long text
                own = text[a: a + BLOCK // WINDOW]
                x, on = cut(data, offs, own, starts[a: a + BLOCK // WINDOW])
                sums = np.zeros((len(self.langs), len(own)), np.float32)
                for t, p in self.positions(x):
                    sums += p * on[t]
                for c in range(len(self.langs)):
                    pooled[:, c] += np.bincount(own, sums[c], minlength=hi - lo)
            total = pooled.sum(1)
            best = pooled.argmax(1)
            alpha = letters(part, data, offs)
            for k in range(hi - lo):
                known = alpha[k] and total[k] > 0
                langs.append(self.langs[best[k]] if known else "und")
                scores.append(float(pooled[k, best[k]] / total[k]) if known else 0.0)
        return langs, scores


def letters(arr, data, offs) -> np.ndarray:
    """Whether each text holds a letter."""
    lower = data | 32
    ascii_ = np.concatenate([[0], np.cumsum((lower >= 97) & (lower <= 122))])
    high = np.concatenate([[0], np.cumsum(data >= 128)])
    found = ascii_[offs[1:]] > ascii_[offs[:-1]]
    for k in np.flatnonzero(~found & (high[offs[1:]] > high[offs[:-1]])):
        found[k] = any(c.isalpha() for c in arr[int(k)].as_py())
    return found


def windows(offs: np.ndarray):
    """(text, start) of the windows that tile each text."""
    n = -(-np.diff(offs) // WINDOW)
    text = np.repeat(np.arange(len(n)), n)
    first = np.repeat(np.cumsum(n) - n, n)
    return text, offs[text] + (np.arange(len(text)) - first) * WINDOW


def cut(data, offs, text, starts):
    """Bytes and counting positions of windows, by time: (WINDOW, n) each."""
    at = starts[None, :] + np.arange(WINDOW)[:, None]
    inside = at < offs[text + 1][None, :]
    x = np.where(inside, data[np.minimum(at, len(data) - 1)], 0)
    return x, inside & WORD[x]


def train(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> LanguageModel | None:
    """Learn from text and lang of documents whose crc32(doc_id as text) mod 3 is not 1."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(
        "doc_id is not null and lang is not null and text is not null").where(
        F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    counts = sorted((r["lang"], r["n"]) for r in rows.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).collect())  # one row per language
    if not counts:
        return None
    share = F.create_map(*[F.lit(v) for lang, n in counts for v in (lang, min(1.0, per_lang / n))])
    u = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1 << 30)) / (1 << 30)
    first = F.min(F.struct(F.xxhash64("text"), "text", "lang")).alias("r")
    picked = rows.where(u < share[F.col("lang")]).groupBy("doc_id").agg(first).select("r.text", "r.lang")

    def run(batches):
        for b in batches:
            arr, x, on, lang = as_strings(b.column(0)), [], [], []
            data, offs = buffers(arr)
            text, starts = windows(offs)
            if len(text):
                got, counted = cut(data, offs, text, starts)
                x = [c.astype(np.uint8).tobytes() for c in got.T]
                on = [c.astype(np.uint8).tobytes() for c in counted.T]
                lang = b.column(1).take(pa.array(text)).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(x, pa.binary()), pa.array(on, pa.binary())],
                                             names=["lang", "x", "on"])

    got = map_arrow(picked.select("text", "lang"), run, "lang string, x binary, on binary").collect()
    got = sorted((r["lang"], r["x"], r["on"]) for r in got)  # the model must not depend on the order of tasks
    if not got:
        return None
    langs = sorted({r[0] for r in got})
    x = np.frombuffer(b"".join(r[1] for r in got), np.uint8).reshape(len(got), WINDOW).T.astype(np.int64)
    on = np.frombuffer(b"".join(r[2] for r in got), np.uint8).reshape(len(got), WINDOW).T > 0
    return LanguageModel(langs).fit(x, on, np.array([langs.index(r[0]) for r in got]))


def label(docs: DataFrame, model: LanguageModel | None, lang: str, score: str) -> DataFrame:
    """Adds the columns ``lang`` and ``score`` for each whole text."""
    names = docs.columns

    def run(batches):
        for b in batches:
            arr = as_strings(b.column(names.index("text")))
            got = model.predict(arr) if model else (["und"] * len(arr), [0.0] * len(arr))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got[0], pa.string()), pa.array(got[1], pa.float64())],
                                             names=[*names, lang, score])

    schema = T.StructType([*docs.schema.fields, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())])
    return map_arrow(docs, run, schema)


def keep_known(docs: DataFrame) -> DataFrame:
    """The documents whose language is known with a score of at least ``ACCEPT``, with their columns."""
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    out = label(docs, train(docs), lang, score)
    return out.where((F.col(lang) != "und") & (F.col(score) >= ACCEPT)).select(*docs.columns)
