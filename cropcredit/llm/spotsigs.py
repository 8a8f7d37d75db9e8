"""Document fingerprints by spot signatures.

A spot is a place where a chain starts: the text's start, each common word (anchor), and each word
whose hash is 0 modulo ``THIN`` (so that texts without common words have spots too). A signature is
the chain of the next ``CHAIN`` content words (words that are no anchors) after the spot, with the
anchor. Chains are cut short by the text's end. The fingerprint is the set of a text's signatures,
written as ascending 8-digit hex numbers; equal texts have equal fingerprints, texts without a word
the empty one.

Likeness is the Jaccard similarity of two sets, pruned by their lengths: it can't exceed the smaller
length over the larger, so pairs whose bound is below the asked threshold are not compared (their
likeness is then that of nothing: 0). Two empty fingerprints are alike (1).

``near_duplicates`` joins sets: they are partitioned by length, so that sets of a likeness of at least
the threshold lie in the same or neighbouring partitions, and within a partition by the rarest
signatures of each set (any two sets that are alike share one of them); hot lists are dealt in blocks.

Null texts count as empty. The next document is the one that follows in descending doc_id (nulls
last, equal ids by a hash of the text); after the last comes the first, a lone document is its own
next. Rows that repeat a document follow each other. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcredit.llm.bytes_np import as_strings, blocks, first_of, mix, words
from cropcredit.llm.common import block_units, components, map_arrow, materialize, ship
from cropcredit.session import plan_size_bytes

CHAIN = 3
THIN = 16
THRESHOLD = 0.8
#: Stored bytes of one range of documents, about.
RANGE_BYTES = 8 << 20
#: Rows of one doc_id beyond which that id's rows are dealt over several ranges.
HOT_ROWS = 20_000

# Common words of the four languages.
ANCHORS = {
    "en": "a an and are as at be but by for from had has he in is it not of on or she that the then there this to was were which with you",
    "de": "als am auf aus bei das dem den der des die ein eine er es für ich im in ist mit nicht sich sie sind und von war wie zu",
    "fr": "au avec ce dans de des du elle en est et il la le les ne nous on ou par pas pour que qui se sont sur un une vous",
    "es": "al como con de del el ella en es la las lo los no o para pero por que se su sus un una y ya",
}


def _anchor_hashes() -> np.ndarray:
    text = " ".join(ANCHORS[k] for k in sorted(ANCHORS))
    h, *_ = words(as_strings(pa.array([text])))
    return np.unique(h)


_ANCHORS: list[np.ndarray] = []


def signatures(h: np.ndarray, text: np.ndarray, n_texts: int):
    """(signature, text) of every spot of texts given by their word hashes, in order."""
    if not _ANCHORS:
        _ANCHORS.append(_anchor_hashes())
    known = _ANCHORS[0]
    place = np.minimum(np.searchsorted(known, h), len(known) - 1)
    anchor = known[place] == h
    content, c_text = h[~anchor], text[~anchor]
    ends = first_of(c_text, n_texts)[1:]
    after = np.cumsum(~anchor)  # content words up to and with each word
    thin = ~anchor & (h % np.uint64(THIN) == 0)
    first = first_of(text, n_texts)
    has = np.flatnonzero(np.diff(first) > 0)
    starts = first[:-1][has]
    # spots: (what starts the chain, index of the chain's first content word, text)
    spot = np.concatenate([np.flatnonzero(anchor), np.flatnonzero(thin)])
    what = np.concatenate([h[spot], np.full(len(has), 1, np.uint64)])
    at = np.concatenate([after[spot], after[starts] - ~anchor[starts]])
    of = np.concatenate([text[spot], has])
    with np.errstate(over="ignore"):
        sig = mix(what + np.uint64(0x51ED270B))
        for k in range(CHAIN):
            inside = at + k < ends[of]
            w = np.zeros(len(of), np.uint64)
            w[inside] = content[at[inside] + k]
            sig = sig * np.uint64(0x9E3779B97F4A7C15) + w
    sig = (mix(sig) >> np.uint64(32)).astype(np.uint32)
    # an anchor after the last content word starts no chain; the text's start always counts
    keep = (at < ends[of]) | (np.arange(len(of)) >= len(spot))
    sig, of = sig[keep], of[keep]
    order = np.argsort((of.astype(np.uint64) << np.uint64(32)) | sig, kind="stable")
    return sig[order], of[order]


def signature_sets(texts: list[str]) -> list[np.ndarray]:
    """Ascending distinct signatures (uint32) of each text."""
    h, text, *_ = words(as_strings(pa.array(texts, pa.large_string())))
    sig, of = signatures(h, text, len(texts))
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (of[1:] != of[:-1])
    sig, of = sig[new], of[new]
    first = first_of(of, len(texts))
    return [sig[first[k]: first[k + 1]] for k in range(len(texts))]


def as_text(s: np.ndarray) -> str:
    return s.astype(">u4").tobytes().hex()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(s), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray, threshold: float = 0.0) -> float:
    """Jaccard similarity of two ascending sets; 0 if the lengths alone rule the threshold out."""
    if not len(a) and not len(b):
        return 1.0
    small, large = sorted((len(a), len(b)))
    if not small or small < threshold * large:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def partition_of(length: int, threshold: float = THRESHOLD) -> int:
    """Partition of a set length: sets that may be alike are at most one partition apart."""
    return 0 if length <= 0 else 1 + int(math.floor(math.log(length) / -math.log(threshold) + 1e-9))


def _ordered(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn(
        "key", F.xxhash64("text"))


def in_ranges(docs: DataFrame, ranges: int) -> DataFrame:
    """Rows (doc_id, text, key) dealt to ranges of descending doc_id (column r, 0 first) and, as a
    ghost, the first row of each range again at the end of the range before (cyclic)."""
    d = _ordered(docs)
    ids = docs.select(F.col("doc_id").cast("double").alias("x"))
    cuts = ids.approxQuantile("x", [k / ranges for k in range(1, ranges)], 0.25 / ranges) if ranges > 1 else []
    splits = [-math.inf, *(sorted(set(cuts)) or [0.0]), math.inf]
    top = len(splits)  # rows without an id come last
    d = Bucketizer(splits=splits, inputCol="_x", outputCol="_b", handleInvalid="keep").transform(
        d.withColumn("_x", F.col("doc_id").cast("double")))
    d = d.withColumn("_b", F.when(F.col("doc_id").isNull(), F.lit(top)).otherwise(F.lit(len(splits) - 2) - F.col("_b")).cast("int")).drop("_x")
    # a range that is one id (or none) with very many rows is dealt further by the text's hash
    stats = d.groupBy("_b").agg(F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).collect()
    parts = {r["_b"]: 1 + r["n"] // HOT_ROWS for r in stats if r["lo"] == r["hi"]}
    parts = {b: p for b, p in parts.items() if p > 1}
    sub = F.lit(0)
    if parts:
        of = F.create_map(*[F.lit(v) for b, p in parts.items() for v in (b, p)])[F.col("_b")]
        sub = F.coalesce(F.floor((F.col("key") / 2.0**64 + 0.5) * of), F.lit(0))
    d = d.withColumn("r", F.col("_b") * F.lit(1 + max(parts.values(), default=0)) + sub).drop("_b")
    rank = F.struct(F.bitwise_not("doc_id"), F.col("key"))  # one range never mixes null and other ids
    heads = sorted(d.groupBy("r").agg(F.min(rank).alias("head")).collect(), key=lambda x: x["r"])  # one row per range
    if not heads:
        return d.withColumn("ghost", F.lit(False))
    spark = docs.sparkSession
    before = spark.createDataFrame(
        [(h["r"], h["head"]["key"], None if h["head"][0] is None else ~h["head"][0], heads[k - 1]["r"]) for k, h in enumerate(heads)],
        "r long, key long, head long, to long")
    d = d.join(F.broadcast(before), ["r", "key"], "left")
    head = F.col("to").isNotNull() & F.col("doc_id").eqNullSafe(F.col("head"))
    out = F.array_compact(F.array(F.struct(F.col("r").alias("r"), F.lit(False).alias("ghost")),
                                  F.when(head, F.struct(F.col("to").alias("r"), F.lit(True).alias("ghost")))))
    return d.select("doc_id", "text", "key", F.explode(out).alias("o")).select("doc_id", "text", "key", "o.r", "o.ghost")


def edited_text(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next document."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def neighbours(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for
    every document."""
    spark = docs.sparkSession
    ranges = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-plan_size_bytes(docs.select("doc_id", "text")) // RANGE_BYTES))
    rows = in_ranges(docs, ranges)
    # each range has a partition of its own: numbered, not hashed
    places = sorted(r["r"] for r in rows.select("r").distinct().collect())  # one row per range
    numbered = spark.createDataFrame([(r, k) for k, r in enumerate(places)], "r long, place int")
    rows = rows.join(F.broadcast(numbered), "r")
    rows = rows.repartitionById(max(len(places), 1), "place").sortWithinPartitions(
        "r", "ghost", F.col("doc_id").desc_nulls_last(), "key", "text")

    def run(batches):
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.large_string(), pa.large_string(), pa.float64(), pa.float64()]
        held, queue, size = None, [], 0  # held: the row that waits for its next

        def flush():
            if not queue:
                return None
            # queue: (doc_id, text, next text) in order; a row's next is often the following row
            texts, where = [], {}
            for _, t, f in queue:
                for x in (t, f, edited_text(t, f)):
                    if x not in where:
                        where[x] = len(texts)
                        texts.append(x)
            sets = signature_sets(texts)
            cols = [[] for _ in names]
            for doc, t, f in queue:
                e = edited_text(t, f)
                a, b, c = sets[where[t]], sets[where[e]], sets[where[f]]
                for col, v in zip(cols, (doc, len(t), hashlib.sha256(e.encode()).hexdigest(), as_text(a), as_text(b), likeness(a, b), likeness(a, c))):
                    col.append(v)
            queue.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols, kinds)], names=names)

        for b in batches:
            docs_, texts_ = b.column(0).to_pylist(), as_strings(b.column(1))
            rs, ghosts = b.column(2).to_pylist(), b.column(3).to_pylist()
            for k in range(len(docs_)):
                t = texts_[k].as_py()
                if held is not None and held[2] == rs[k]:
                    queue.append((held[0], held[1], t))
                    size += len(held[1])
                held = None if ghosts[k] else (docs_[k], t, rs[k])
                if size > 1 << 20:
                    size = 0
                    yield flush()
        out = flush()
        if out is not None:
            yield out

    return map_arrow(rows.select("doc_id", "text", "r", "ghost"), run,
                     "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every whole text."""
    def run(batches):
        for b in batches:
            arr = as_strings(b.column(1))
            for lo, hi in blocks(arr):
                sets = signature_sets(arr.slice(lo, hi - lo).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array([as_text(s) for s in sets], pa.large_string())],
                                                 names=["doc_id", "fingerprint"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                     run, "doc_id long, fingerprint string")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, block: int = 256) -> DataFrame:
    """doc_id, group_id, n_links: groups of documents whose fingerprints are alike.

    Equal fingerprints are one class. A class is posted, in its own length partition and the next
    lower one, under the first n - ceil(threshold * n) + 1 of its signatures by ascending frequency:
    two sets that are alike share one of these. Lists are worked on in blocks of pairs; a pair counts
    in the first list it shares. Texts without words link with nothing."""
    rows = materialize(fingerprints(docs), "fingerprints")
    kinds = materialize(rows.where("fingerprint <> ''").groupBy(F.unhex(F.md5("fingerprint")).alias("cls")).agg(
        F.first("fingerprint").alias("fingerprint"), F.count("*").alias("copies"), F.min("doc_id").alias("first_id")), "kinds")
    n = (F.length("fingerprint") / 8).cast("int")
    cut = F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.substring(F.col("fingerprint"), k * 8 + 1, 8))
    each = kinds.select("cls", n.alias("n"), F.explode(cut).alias("sig"))
    common = each.groupBy("sig").agg(F.count("*").alias("df")).where("df > 1")
    each = each.join(common, "sig", "left").withColumn("df", F.coalesce("df", F.lit(1)))
    sorted_ = each.groupBy("cls").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("s"))
    prefix = sorted_.select("cls", "n", F.explode(F.slice("s", F.lit(1), F.col("n") - F.ceil(F.col("n") * threshold - 1e-9).cast("int") + 1)).alias("p"))
    part = 1 + F.floor(F.log(F.col("n").cast("double")) / -math.log(threshold) + 1e-9)
    posts = prefix.where("p.df > 1").select(F.col("cls").alias("member"), F.col("p.sig").alias("sig"), part.cast("int").alias("part"))
    posts = materialize(posts.select("member", "sig", F.explode(F.array("part", F.col("part") - 1)).alias("list")), "posts")
    units = block_units(posts, ["list", "sig"], block)
    keys = posts.groupBy("member").agg(F.array_sort(F.collect_list(F.struct("list", "sig"))).alias("keys"))
    full = kinds.select(F.col("cls").alias("member"), "fingerprint", "copies").join(keys, "member")

    def verify(key, table):
        here, same = (key[0].as_py(), key[1].as_py()), key[2].as_py() == key[3].as_py()
        cls, side = table["member"].to_pylist(), table["side"].to_pylist()
        sets = [from_text(x) for x in table["fingerprint"].to_pylist()]
        keys_ = [{(k["list"], k["sig"]) for k in x} for x in table["keys"].to_pylist()]
        copies, gain = table["copies"].to_pylist(), [0] * len(cls)
        low = list(range(len(cls)))

        def root(k):
            while low[k] != k:
                low[k] = low[low[k]]
                k = low[k]
            return k

        order = sorted(range(len(cls)), key=lambda k: len(sets[k]))
        for x, i in enumerate(order):
            for j in order[x + 1:]:  # ascending lengths: the bound ends the sweep
                if len(sets[i]) < threshold * len(sets[j]):
                    break
                if (same or side[i] != side[j]) and likeness(sets[i], sets[j], threshold) >= threshold - 1e-9 and min(keys_[i] & keys_[j]) == here:
                    gain[i] += copies[j]
                    gain[j] += copies[i]
                    a, b = root(i), root(j)
                    low[max(a, b, key=cls.__getitem__)] = min(a, b, key=cls.__getitem__)
        some = [k for k in range(len(cls)) if gain[k]]
        return pa.table({"cls": pa.array([cls[k] for k in some], pa.binary()), "gain": pa.array([gain[k] for k in some], pa.int64()),
                         "root": pa.array([cls[root(k)] for k in some], pa.binary())})

    ship(docs.sparkSession)
    links = materialize(units.join(full, "member").groupBy("list", "sig", "unit_i", "unit_j").applyInArrow(
        verify, "cls binary, gain long, root binary"), "links")
    roots = components(links.select(F.col("cls").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("cls"), "root")
    c = kinds.select("cls", "copies", "first_id").join(links.groupBy("cls").agg(F.sum("gain").alias("gain")), "cls", "left")
    c = materialize(c.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls")), "groups")
    c = c.join(c.groupBy("root").agg(F.min("first_id").alias("group_id")), "root")
    c = c.select("cls", "group_id", (F.col("copies") - 1 + F.coalesce("gain", F.lit(0))).alias("n_links"))
    return rows.withColumn("cls", F.unhex(F.md5("fingerprint"))).join(c, "cls", "left").select(
        "doc_id", F.when(F.col("fingerprint") == "", F.col("doc_id")).otherwise(F.col("group_id")).alias("group_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"))
