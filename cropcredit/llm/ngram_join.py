"""N-gram Jaccard join by MinHash banding.

Words are maximal runs of ASCII letters, ASCII digits and non-ASCII characters, lower-cased; a text's
set holds its distinct runs of ``n`` words (a text of fewer words has one: all its words; a text
without words has none and links with nothing). Two documents link if the Jaccard similarity of
their sets is at least the threshold.

1. Each text becomes a class key (128 bits of SHA-256 of its words) and band hashes of its MinHash
   values; rows and bands are chosen so that a pair at the threshold meets in some band with the
   target recall. Texts with equal word sequences are one class; a class joins once, however many
   copies it has.
2. Classes are shuffled on (band, hash). Buckets with equal members are kept once.
3. Members of kept buckets fetch their full n-gram sets. A hot bucket is cut into blocks; each pair
   of blocks is one unit of work, where all its pairs are verified on the full sets. A pair that
   meets in several buckets counts in the first. A unit returns per member its number of linked
   copies and a link to the smallest member it is connected to: rows grow with the members, not with
   the pairs, and no link is lost.
4. Components of these links give the groups.

Result, one row per document: doc_id, class_id (smallest doc_id among equal word sequences),
n_links (other documents linked with it), group_id (smallest doc_id reachable by links), kept
(it is the group's first row). Rows that repeat a doc_id count as documents. A null doc_id takes
part; its ids are null if no document of its class or group has one. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcredit.llm.bytes_np import as_strings, blocks, first_of, mix, word_digests, words
from cropcredit.llm.common import block_units, components, free_name, join_small, map_arrow, materialize, ship

N = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 128
BLOCK = 256


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(rows, bands): the most selective banding with 1 - (1 - threshold^rows)^bands >= recall and
    at most ``most`` hashes."""
    best = (1, max(1, math.ceil(math.log(1 - recall) / math.log(1 - min(threshold, 1 - 1e-9)))))
    for rows in range(2, most + 1):
        p = threshold**rows
        if p >= 1:
            return rows, 1
        bands = math.ceil(math.log(1 - recall) / math.log(1 - p))
        if rows * bands <= most:
            best = (rows, bands)
    return best


def shingles(h: np.ndarray, text: np.ndarray, n_texts: int, n: int):
    """(hash of each n-gram, its text): n-grams in order, repeats included."""
    lens = np.bincount(text, minlength=n_texts)
    with np.errstate(over="ignore"):
        c = np.uint64(0x9E3779B97F4A7C15)
        if len(h) >= n:
            g = np.zeros(len(h) - n + 1, np.uint64)
            for k in range(n):
                g = g * c + h[k: len(h) - n + 1 + k]
            whole = text[: len(g)] == text[n - 1:]
            g, of = mix(g[whole]), text[: len(whole)][whole]
        else:
            g, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        short = np.flatnonzero((lens > 0) & (lens < n))
        if len(short):
            first = first_of(text, n_texts)
            add = []
            for k in short:
                v = np.uint64(lens[k])
                for w in h[first[k]: first[k + 1]]:
                    v = v * c + w
                add.append(v)
            g = np.concatenate([g, mix(np.array(add, np.uint64))])
            of = np.concatenate([of, short])
            order = np.argsort(of, kind="stable")
            g, of = g[order], of[order]
    return g, of


def band_hashes(g: np.ndarray, of: np.ndarray, n_texts: int, rows: int, bands: int) -> np.ndarray:
    """(texts, bands) hashes of the MinHash values; texts without n-grams get 0s."""
    rng = np.random.default_rng(97)
    a = rng.integers(1, 1 << 32, rows * bands, dtype=np.uint32) | np.uint32(1)
    b = rng.integers(0, 1 << 32, rows * bands, dtype=np.uint32)
    base = (g >> np.uint64(32)).astype(np.uint32)
    first = first_of(of, n_texts)
    some = np.flatnonzero(np.diff(first) > 0)
    out = np.zeros((n_texts, bands), np.uint64)
    if not len(some):
        return out
    at = first[:-1][some]
    with np.errstate(over="ignore"):
        for band in range(bands):
            acc = np.full(len(some), band + 1, np.uint64)
            for k in range(band * rows, band * rows + rows):
                acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(base * a[k] + b[k], at))
            out[some, band] = acc
    return out


def described(docs: DataFrame, n: int, rows: int, bands: int) -> DataFrame:
    """doc_id, text_key, cls, n_grams, bands for every document."""
    def run(batches):
        for b in batches:
            arr = as_strings(b.column(2))
            cls, count, band = [], [], []
            for lo, hi in blocks(arr):
                m = hi - lo
                h, text, *found = words(arr.slice(lo, m))
                g, of = shingles(h, text, m, n)
                cls += word_digests(m, text, *found)
                count.append(np.bincount(of, minlength=m))
                band.append(band_hashes(g, of, m, rows, bands))
            flat = np.concatenate(band).astype(np.int64).ravel() if band else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(arr) + 1) * bands, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(cls, pa.binary()), pa.array(np.concatenate(count) if count else [], pa.int64()), lists],
                names=["doc_id", "text_key", "cls", "n_grams", "bands"])

    rows_ = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_key"),
                        F.col("text").cast("string").alias("text"))
    return map_arrow(rows_, run, "doc_id long, text_key long, cls binary, n_grams long, bands array<long>")


def full_sets(texts: DataFrame, n: int) -> DataFrame:
    """cls, grams (sorted distinct hashes as bytes) of texts."""
    def run(batches):
        for b in batches:
            arr = as_strings(b.column(0))
            for lo, hi in blocks(arr):
                h, text, *found = words(arr.slice(lo, hi - lo))
                g, of = shingles(h, text, hi - lo, n)
                first = first_of(of, hi - lo)
                sets = [np.unique(g[first[k]: first[k + 1]]).tobytes() for k in range(hi - lo)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word_digests(hi - lo, text, *found), pa.binary()), pa.array(sets, pa.binary())], names=["cls", "grams"])

    return map_arrow(texts.select("text"), run, "cls binary, grams binary")


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of a with every set of b."""
    grams = np.concatenate(a + b)
    owner = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in a + b])
    _, code = np.unique(grams, return_inverse=True)
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    size = np.diff(np.append(first, len(code)))
    out = np.zeros((len(a), len(b)), np.float32)
    keep = np.repeat(size > 1, size)  # grams that only one set has do not matter
    code, owner = code[keep], owner[keep]
    if not len(code):
        return out
    _, code = np.unique(code, return_inverse=True)
    step = 4096
    n_codes = int(code[-1]) + 1
    starts = np.arange(0, n_codes, step)
    cut = np.searchsorted(code, np.append(starts, n_codes))
    for lo, hi, c0 in zip(cut[:-1], cut[1:], starts):
        m = np.zeros((len(a) + len(b), step), np.float32)
        m[owner[lo:hi], code[lo:hi] - c0] = 1
        out += m[: len(a)] @ m[len(a):].T
    return out


def verify_unit(cls: list[bytes], copies: np.ndarray, keys: np.ndarray, side_a: np.ndarray, same: bool, here: int, sets: list[np.ndarray], threshold: float):
    """One unit: per member, the linked copies it gains and the smallest member of its component.

    keys: (members, bands), 0 where a member's bucket of that band is not kept; a pair counts only if
    ``here`` is the first key they share."""
    if same:
        ia = ib = np.arange(len(cls))
    else:
        ia, ib = np.flatnonzero(side_a), np.flatnonzero(~side_a)
    gain = np.zeros(len(cls), np.int64)
    root = np.arange(len(cls))
    if not len(ia) or not len(ib):
        return gain, root
    size = np.array([len(s) for s in sets], np.float64)
    # blocks against blocks in pieces of bounded size
    links = []
    for a0 in range(0, len(ia), BLOCK):
        for b0 in range(a0 if same else 0, len(ib), BLOCK):
            pa_, pb = ia[a0: a0 + BLOCK], ib[b0: b0 + BLOCK]
            inter = _overlaps([sets[k] for k in pa_], [sets[k] for k in pb])
            union = size[pa_][:, None] + size[pb][None, :] - inter
            hit = inter >= threshold * union - 1e-9
            if same and a0 == b0:
                hit &= np.triu(np.ones(hit.shape, bool), 1)
            x, y = np.nonzero(hit)
            for lo in range(0, len(x), 1 << 16):
                u, v = pa_[x[lo: lo + (1 << 16)]], pb[y[lo: lo + (1 << 16)]]
                shared = (keys[u] == keys[v]) & (keys[u] != 0)
                firsts = keys[u, shared.argmax(1)]
                ok = shared.any(1) & (firsts == here)
                links.append((u[ok], v[ok]))
    if not links:
        return gain, root
    u, v = (np.concatenate([p[k] for p in links]) for k in (0, 1))
    np.add.at(gain, u, copies[v])
    np.add.at(gain, v, copies[u])
    rank = _ranks(cls)
    low = rank.copy()
    while len(u):  # min-label propagation within the unit
        before = low.copy()
        np.minimum.at(low, u, low[v])
        np.minimum.at(low, v, low[u])
        if (low == before).all():
            break
    return gain, np.argsort(rank)[low]


def _ranks(cls: list[bytes]) -> np.ndarray:
    order = sorted(range(len(cls)), key=cls.__getitem__)
    rank = np.empty(len(cls), np.int64)
    rank[order] = np.arange(len(cls))
    return rank


def class_links(docs: DataFrame, classes: DataFrame, n: int, threshold: float, n_bands: int, block: int = BLOCK) -> DataFrame:
    """cls, gain, root: for members of kept buckets, their linked copies and a link to a smaller
    class. ``classes`` (cls, copies, n_grams, bands, text_key) is materialised."""
    b = classes.where("n_grams > 0").select("cls", F.posexplode("bands").alias("band", "hash"))
    # buckets of two classes and more; of buckets with equal members the first
    buckets = b.groupBy("band", "hash").agg(
        F.count("*").alias("m"), F.sum(F.xxhash64("cls").cast("decimal(20,0)")).alias("s"),
        F.sum(F.xxhash64(F.lit(3), "cls").cast("decimal(20,0)")).alias("s2")).where("m > 1")
    kept = buckets.groupBy("m", "s", "s2").agg(F.min(F.struct("band", "hash")).alias("k")).select("k.band", "k.hash")
    kept = materialize(kept, "buckets")
    members = join_small(b, kept, ["band", "hash"])
    bands = F.collect_list(F.struct("band", "hash"))  # at most one per band
    members = materialize(members.groupBy("cls").agg(bands.alias("kept")), "members")
    # the full sets of the members: one text of each
    keys = materialize(classes.join(members, "cls", "left_semi").select("text_key").distinct(), "keys")
    texts = docs.select(F.col("text").cast("string").alias("text")).withColumn("text_key", F.xxhash64("text"))
    texts = join_small(texts, keys, "text_key", "left_semi").groupBy("text_key").agg(F.first("text").alias("text"))
    sets = full_sets(texts, n).dropDuplicates(["cls"])
    full = materialize(members.join(sets, "cls").join(classes.select("cls", "copies"), "cls"), "sets")
    slim = members.select(F.col("cls").alias("member"), F.explode("kept").alias("k")).select(
        "member", F.col("k.band").alias("band"), F.col("k.hash").alias("hash"))
    units = block_units(slim, ["band", "hash"], block)
    units = units.join(full.withColumnRenamed("cls", "member"), "member")

    def verify(key, table):
        band, here, i, j = (k.as_py() for k in key)
        cls = table["member"].to_pylist()
        copies = table["copies"].to_numpy()
        keys = np.zeros((len(cls), n_bands), np.int64)
        for r, ks in enumerate(table["kept"].to_pylist()):
            for k in ks:
                keys[r, k["band"]] = k["hash"]
        sets = [np.frombuffer(x, np.uint64) for x in table["grams"].to_pylist()]
        side_a = np.array([s == "a" for s in table["side"].to_pylist()])
        # a hash may be equal in two bands only by chance: keys compare within one band
        gain, root = verify_unit(cls, copies, keys, side_a, i == j, here, sets, threshold)
        some = np.flatnonzero(gain > 0)
        return pa.table({"cls": pa.array([cls[k] for k in some], pa.binary()), "gain": pa.array(gain[some], pa.int64()),
                         "root": pa.array([cls[root[k]] for k in some], pa.binary())})

    ship(docs.sparkSession)
    return units.groupBy("band", "hash", "unit_i", "unit_j").applyInArrow(verify, "cls binary, gain long, root binary")


def near_duplicates(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_links, group_id, kept, text_key for every document (see the module's text)."""
    rows, bands = choose_bands(threshold, recall)
    desc = materialize(described(docs, n, rows, bands), "described")
    classes = materialize(desc.groupBy("cls").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("copies"), F.max("n_grams").alias("n_grams"),
        F.first("bands").alias("bands"), F.min("text_key").alias("text_key")), "classes")
    links = materialize(class_links(docs, classes, n, threshold, bands), "links")
    roots = components(links.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    roots = roots.select(F.col("node").alias("cls"), "root")
    gains = links.groupBy("cls").agg(F.sum("gain").alias("gain"))
    c = classes.drop("bands", "text_key").join(gains, "cls", "left").join(roots, "cls", "left")
    c = materialize(c.withColumn("root", F.coalesce("root", "cls")), "groups")
    # the first document of each class, then of each group: smallest doc_id, nulls last
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    heads = desc.groupBy("cls").agg(first).join(c.select("cls", "root"), "cls").groupBy("root").agg(F.min("first").alias("first"))
    own = F.when(F.col("n_grams") > 0, F.col("copies") - 1).otherwise(F.lit(0))
    c = c.join(heads, "root").select(
        "cls", "class_id", "n_grams", "first", (own + F.coalesce("gain", F.lit(0))).alias("n_links"))
    d = desc.select("doc_id", "text_key", "cls").join(c, "cls")
    alone = F.col("n_grams") == 0  # texts without words: each document for itself
    head = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key").eqNullSafe(F.col("first"))
    return d.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), "n_links",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("group_id"), (alone | head).alias("kept"), "text_key")


def keep_one(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One document of each group, with its columns. Of rows equal in doc_id and text one stays;
    texts without words all stay."""
    k, t = free_name(docs, "_text_key"), F.xxhash64(F.col("text").cast("string"))
    kept = near_duplicates(docs, n, threshold, recall).where("kept")
    kept = materialize(kept.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(F.count("*").alias("_n")), "kept")
    rows = docs.withColumn(k, t)
    # the documents that have no equal row, by a semi join; the few that have, made distinct
    hit = lambda f: rows["doc_id"].cast("long").eqNullSafe(f["_id"]) & (rows[k] == f["_key"])
    blank = ~F.coalesce(F.col("text").cast("string"), F.lit("")).rlike("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]")
    one, more = kept.where("_n = 1"), kept.where("_n > 1")
    single = join_small(rows, one, hit(one), "left_semi").drop(k)
    several = join_small(rows, more, hit(more), "left_semi")
    return single.unionByName(several.where(blank).drop(k)).unionByName(
        several.where(~blank).dropDuplicates(["doc_id", k]).drop(k))
