"""Prefix trie of conversations: every distinct sequence of first turns is a node.

Method: a turn becomes a 128-bit id (SHA-256 of role and text); a conversation is a row of turn ids. The
rows are range-sharded by their ids and conv_id. Each shard is one padded matrix: ``numpy.lexsort`` orders
it, column changes OR-accumulated from left to right mark where nodes start at every depth, and
``reduceat`` over those starts aggregates each depth (members, smallest member, children, and from the
deepest column up the sums over subtrees). Only the paths of a shard's first and last row can go on in
a neighbour: those boundary nodes are given out in parts under their path's digest and put together by
one small aggregate; everything else is final in its shard.

Long conversations are cut into blocks of ``BLOCK`` turns. A row is then one block, sorted behind the digest
of all turns before it, so memory does not grow with a conversation's length. What a deeper block
sums up (leaves, saved tokens) is added to one member's rows in the blocks above. Positions come from range
shards (``common.ranked``), so neither a hot conversation nor a large group of equal ones meets in one task.
The digest of the conversations that end in a node is one SHA-256 over their ids in order, hence one stream:
a node's ids, collected by shard, pass through one task piece by piece and are never held whole.

Results in special cases: null role or text count as empty; turns of one number (nulls first) stand in the
order of their ids' digests (repeated rows are turns like others); rows with a null conv_id belong to no
conversation and are left out; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cropcredit.llm.common import join_small, map_arrow, materialize, ranked

#: Turns of one block (columns of a matrix) and rows of a shard (about).
BLOCK = 64
SHARD_ROWS = 16_384
#: Positions of one piece of a conversation in joins on conv_id.
PIECE = 65_536
_NOTHING = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), n (turns of the conversation), key (32 hex digits), words."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)
    words = F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")
    turns = conversations.where("conv_id is not null").select("conv_id", "turn", key.alias("key"), words.alias("words"))
    return ranked(turns, ["conv_id"], ["turn", "key"], "pos", "n").drop("turn")


def conversations_of(turns: DataFrame) -> DataFrame:
    """conv_id, length."""
    return turns.groupBy("conv_id").agg(F.max("n").alias("length"))


def rebuilt(turns: DataFrame, every: int, taken) -> tuple[DataFrame, DataFrame]:
    """Every conversation c begins with the first h turns of conversation c - c % ``every`` (h = ``taken`` of the
    column conv_id, a small number; fewer or none if that has fewer or is absent) and goes on with its own turns
    after its first h. Returns turns (conv_id, pos, key, words) and conversations (conv_id, length)."""
    h = taken(F.col("conv_id"))
    base = F.col("conv_id") - F.col("conv_id") % every
    convs = conversations_of(turns).withColumn("h", h).withColumn("base", base)
    bases = convs.select(F.col("conv_id").alias("base"), F.col("length").alias("of_base"))
    convs = convs.join(bases, "base", "left").withColumn("lent", F.least("h", F.coalesce("of_base", F.lit(0))))
    convs = materialize(convs.select("conv_id", "h", "base", "lent", "length", (F.col("lent") + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("now")), "convs")
    first = turns.where("pos < 8").where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), "pos", "key", "words")
    most = convs.agg(F.max("h")).first()[0] or 0
    if most > 8:
        raise ValueError("at most 8 turns can be taken")
    lent = convs.where("lent > 0").select("conv_id", "base", "lent").join(first, "base").where("pos < lent").select("conv_id", "pos", "key", "words")
    # a hot conversation's turns meet its row piece by piece
    pieces = convs.select("conv_id", "lent", "h", F.explode(F.sequence(F.lit(0), F.floor(F.col("length") / PIECE))).alias("piece"))
    own = turns.withColumn("piece", F.floor(F.col("pos") / PIECE)).join(pieces, ["conv_id", "piece"]).where("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("lent")).alias("pos"), "key", "words")
    return lent.unionByName(own), convs.select("conv_id", F.col("now").alias("length"))


def _prefixes(segments: DataFrame, width: int) -> DataFrame:
    """conv_id, block, prefix for each conversation and each block b >= 1 that it reaches the start of: the
    digest of all turns before the block, chained while a conversation's full blocks stream by."""
    def chain(batches):
        key, h = None, None
        for b in batches:
            prefix = []
            for c, d in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if c != key:
                    key, h = c, hashlib.sha256()
                h.update(bytes.fromhex(d))
                prefix.append(h.copy().digest()[:16])
            later = pc.add(b.column(1), pa.scalar(1, pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), later, pa.array(prefix, pa.binary())], names=["conv_id", "block", "prefix"])

    full = segments.where(F.col("len") == width).select("conv_id", "block", F.sha2("ids", 256).alias("d"))
    return map_arrow(full.repartition("conv_id").sortWithinPartitions("conv_id", "block"), chain, "conv_id long, block long, prefix binary")


_RAW = ("kind string, shard long, block long, level int, key binary, conv_id long, n_convs long, n_children long, n_leaves long, saved long, "
        "words long, more boolean, parent_conv_id long, parent_side int, side int, path array<binary>, ends string")


class _Out:
    """Rows of ``_RAW`` gathered column by column; numpy arrays or lists per call."""

    def __init__(self):
        self.schema = pa.schema([("kind", pa.string()), ("shard", pa.int64()), ("block", pa.int64()), ("level", pa.int32()), ("key", pa.binary()),
                                 ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                                 ("saved", pa.int64()), ("words", pa.int64()), ("more", pa.bool_()), ("parent_conv_id", pa.int64()),
                                 ("parent_side", pa.int32()), ("side", pa.int32()), ("path", pa.list_(pa.binary())), ("ends", pa.string())])
        self.batches = []

    def add(self, n: int, **columns):
        cols = []
        for f in self.schema:
            v = columns.get(f.name)
            if v is None:
                cols.append(pa.nulls(n, f.type))
            elif isinstance(v, (str, int, bool)):
                cols.append(pa.array([v] * n, f.type))
            else:
                cols.append(pa.array(v, f.type))
        if n:
            self.batches.append(pa.RecordBatch.from_arrays(cols, schema=self.schema))


def _joined(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def _matrix(flat: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``sizes`` items each, padded with zeros to ``width`` columns."""
    out = np.zeros((len(sizes), width), flat.dtype)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def shard_nodes(table: pa.Table, full: int = BLOCK) -> list[pa.RecordBatch]:
    """The nodes of one shard (blocks of ``full`` turns): final ones, parts of boundary nodes ('open') with the ids that end
    there ('ends'), and the sums of whole blocks."""
    out = _Out()
    n = len(table)
    if not n:
        return []
    col = {c: table.column(c).combine_chunks() for c in table.column_names}
    shard = col["shard"][0].as_py()
    conv, block, size = (col[c].to_numpy() for c in ("conv_id", "block", "len"))
    more = col["more"].to_numpy(zero_copy_only=False)
    top = col["top_conv"].to_numpy()
    width = int(size.max())
    ids = np.frombuffer(b"".join(col["ids"].to_pylist()), ">u8").astype(np.uint64).reshape(-1, 2)
    hi, lo = _matrix(ids[:, 0], size, width), _matrix(ids[:, 1], size, width)
    words = _matrix(pa.chunked_array([col["words"]]).combine_chunks().flatten().to_numpy().astype(np.int64), size, width)
    before = np.frombuffer(b"".join(col["prefix"].to_pylist()), ">u8").astype(np.uint64).reshape(-1, 2)
    keys = [conv]
    for j in range(width - 1, -1, -1):
        keys += [lo[:, j], hi[:, j]]
    order = np.lexsort([*keys, before[:, 1], before[:, 0], block])
    conv, block, size, more, top, hi, lo, words, before = (a[order] for a in (conv, block, size, more, top, hi, lo, words, before))
    # change[i, j]: row i differs from row i - 1 in its block, prefix or first j ids
    change = np.ones((n, width + 1), bool)
    change[1:, 0] = (block[1:] != block[:-1]) | (before[1:] != before[:-1]).any(1)
    change[1:, 1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
    change = np.logical_or.accumulate(change, axis=1)
    starts = [np.flatnonzero(change[:, j]) for j in range(width + 1)]
    low = [np.minimum.reduceat(conv, s) for s in starts]
    # path digests of the first and the last row
    paths = []
    for row in (0, n - 1):
        h = hashlib.sha256(int(block[row]).to_bytes(8, "big") + before[row].astype(">u8").tobytes())
        path = [h.digest()[:16]]
        for j in range(int(size[row])):
            h.update(hi[row, j].astype(">u8").tobytes() + lo[row, j].astype(">u8").tobytes())
            path.append(h.copy().digest()[:16])
        paths.append(path)
    leaves, saved, kids_below = (col[c].to_numpy()[order].copy() for c in ("add_leaves", "add_saved", "add_children"))
    for j in range(width, -1, -1):
        s = starts[j]
        real = size[s] >= j
        if not real.any():
            continue
        count = np.diff(np.append(s, n))
        is_open = np.zeros(len(s), bool)
        is_open[[0, -1]] = True
        last = j == full
        if last:
            children, goes_on = np.add.reduceat(kids_below, s), np.logical_or.reduceat(more, s)
        else:
            goes_on = np.zeros(len(s), bool)
            begins = np.zeros(n, np.int64)
            if j < width:
                child = starts[j + 1][size[starts[j + 1]] >= j + 1]
                begins[child] = 1
                # boundary children are counted when their parts meet
                for k in {0, int(starts[j + 1][-1])}:
                    begins[k] = 0
            children = np.add.reduceat(begins, s)
        word = words[s, j - 1] if j else np.zeros(len(s), np.int64)
        node = real & ~is_open & ((j > 0) | (block[s] == 0))
        leaves[s[node]] += (children[node] == 0) & ~goes_on[node]
        saved[s[node]] += (count[node] - 1) * word[node]
        sum_leaves, sum_saved = np.add.reduceat(leaves, s), np.add.reduceat(saved, s)
        # conversations that end here are the first rows of a run, in the order of their ids
        ending = (size == j) & ~more
        ends = {}
        if ending.any():
            rows = np.flatnonzero(ending)
            run = np.searchsorted(s, rows, "right") - 1
            cut = np.flatnonzero(np.diff(run)) + 1
            ends = {int(r[0]): _joined(conv[i]) for i, r in zip(np.split(rows, cut), np.split(run, cut))}
        if j > 1:
            up = np.searchsorted(starts[j - 1], s, "right") - 1
            above, edge = low[j - 1][up], (up == 0) | (up == len(starts[j - 1]) - 1)
            side = np.where(up == 0, 0, 1)
        else:
            above, edge, side = top[s], np.zeros(len(s), bool), np.zeros(len(s), np.int64)
        k = np.flatnonzero(real & ~is_open)
        closed_ends = [hashlib.sha256(ends[r].encode()).hexdigest() if r in ends else _NOTHING for r in k.tolist()]
        out.add(len(k), kind="node" if j else "block", shard=shard, block=block[s[k]], level=j, conv_id=low[j][k], n_convs=count[k], n_children=children[k],
                n_leaves=sum_leaves[k], saved=sum_saved[k],
                parent_conv_id=pa.array(above[k], pa.int64(), mask=edge[k] | (j == 0)),
                parent_side=pa.array(side[k], pa.int32(), mask=~edge[k]), ends=closed_ends)
        for r in sorted({0, len(s) - 1}):
            if not real[r]:
                continue
            path = paths[0 if r == 0 else 1]
            out.add(1, kind="open", shard=shard, block=block[s[r]: s[r] + 1], level=j, key=[path[j]], conv_id=low[j][r: r + 1], n_convs=count[r: r + 1],
                    n_children=children[r: r + 1], n_leaves=sum_leaves[r: r + 1], saved=sum_saved[r: r + 1], words=word[r: r + 1],
                    more=[bool(goes_on[r])], parent_conv_id=above[r: r + 1], side=0 if r == 0 else 1, path=[path[: j + 1]])
            if r == 0 and len(s) == 1:  # the same node at both edges of the shard
                out.add(1, kind="edge", shard=shard, level=j, key=[path[j]], side=1)
            if r in ends:
                out.add(1, kind="ends", shard=shard, key=[path[j]], ends=[ends[r]])
    return out.batches


def _run_shards(rows: DataFrame, width: int, shard_rows: int) -> DataFrame:
    """``shard_nodes`` of all range shards, written once."""
    shards = max(1, -(-rows.count() // shard_rows))
    keys = ["block", "prefix", "ids", "conv_id"]
    dealt = rows.repartitionByRange(shards, *keys).withColumn("shard", F.spark_partition_id().cast("long"))

    def run(batches):
        got = list(batches)
        if got:
            yield from shard_nodes(pa.Table.from_batches(got), width)

    return materialize(map_arrow(dealt, run, _RAW), "trie")


def _streamed_digests(chunks: DataFrame) -> DataFrame:
    """key, ends_sha256: SHA-256 over each key's texts, joined by commas in the order of the shards."""
    def run(batches):
        key, h = None, None
        for b in batches:
            done = []
            for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if k == key:
                    h.update(b",")
                else:
                    if key is not None:
                        done.append((key, h.hexdigest()))
                    key, h = k, hashlib.sha256()
                h.update(text.encode())
            yield _digest_batch(done)
        if key is not None:
            yield _digest_batch([(key, h.hexdigest())])

    dealt = chunks.repartition("key").sortWithinPartitions("key", "shard").select("key", "ends")
    return map_arrow(dealt, run, "key binary, ends_sha256 string")


def _digest_batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["key", "ends_sha256"])


def _recombined(raw: DataFrame) -> DataFrame:
    """The boundary nodes, put together from their parts: one row per node, with its key."""
    parts = raw.where("kind = 'open'")
    nodes = parts.groupBy("key", "block", "level").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("closed"), F.sum("n_leaves").alias("part_leaves"),
        F.sum("saved").alias("part_saved"), F.max("words").alias("words"), F.max("more").alias("more"), F.max("path").alias("path"),
        F.min("parent_conv_id").alias("top_conv"))
    nodes = materialize(nodes.withColumn("parent", F.expr("case when level > 0 then path[level - 1] end")), "boundary")
    children = nodes.where("level > 0").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("opened"))
    nodes = nodes.join(children, "key", "left").withColumn("n_children", F.col("closed") + F.coalesce("opened", F.lit(0)))
    counted = F.expr("level > 0 or block = 0")  # the start of a later block is no node of that block
    nodes = nodes.withColumn("leaf", F.when(counted & (F.col("n_children") == 0) & ~F.col("more"), 1).otherwise(0)).withColumn(
        "own", F.when(counted, (F.col("n_convs") - 1) * F.col("words")).otherwise(0))
    nodes = materialize(nodes, "boundary")
    below = nodes.select(F.explode("path").alias("key"), "leaf", "own").groupBy("key").agg(F.sum("leaf").alias("leaves"), F.sum("own").alias("owns"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("above"))
    digests = _streamed_digests(raw.where("kind = 'ends'").select("key", "shard", "ends"))
    out = nodes.join(below, "key").join(digests, "key", "left").join(parents, "parent", "left")
    return materialize(out.select(
        "key", "block", "level", "conv_id", "n_convs", "n_children", (F.col("part_leaves") + F.col("leaves")).alias("n_leaves"),
        (F.col("part_saved") + F.col("owns")).alias("saved"),
        F.expr("case when level > 1 then above when level = 1 then top_conv end").alias("parent_conv_id"),
        F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends")), "boundary")


def _block_sums(raw: DataFrame, whole: DataFrame) -> DataFrame:
    """conv_id, block, leaves, saved, children to add to one member's rows for what lies in deeper blocks."""
    cols = ["conv_id", "block", "n_leaves", "saved", "n_children"]
    sums = raw.where("kind = 'block'").select(*cols).unionByName(whole.where("level = 0").select(*cols))
    w = W.partitionBy("conv_id").orderBy("block")
    deep = w.rowsBetween(0, W.unboundedFollowing)
    sums = sums.withColumn("from", F.coalesce(F.lag("block").over(w), F.lit(0))).withColumn("l", F.sum("n_leaves").over(deep)).withColumn("s", F.sum("saved").over(deep))
    at = F.explode(F.sequence("from", F.col("block") - 1)).alias("at")
    return sums.select("conv_id", at, "l", "s", "block", "n_children").select(
        "conv_id", F.col("at").alias("block"), F.col("l").alias("add_leaves"), F.col("s").alias("add_saved"),
        F.when(F.col("at") == F.col("block") - 1, F.col("n_children")).otherwise(0).alias("add_children"))


def trie(turns: DataFrame, convs: DataFrame, width: int = BLOCK, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per node. ``turns``: conv_id, pos (dense, from 0), key (32 hex digits), words; ``convs``: conv_id,
    length (all conversations, those without turns too); ``width`` turns make a block, about ``shard_rows`` blocks a shard.

    Returns, all long but the last: conv_id (smallest member), depth, parent_conv_id (the parent's conv_id; root:
    null), n_convs (members), n_children, n_leaves (childless nodes of the subtree), saved_tokens (sum over the subtree
    of (members - 1) * words of the last turn), ends_sha256 (of the ids of the members that end here)."""
    block = F.floor(F.col("pos") / width)
    segments = turns.groupBy("conv_id", block.alias("block")).agg(F.array_sort(F.collect_list(F.struct("pos", "key", "words"))).alias("t")).select(
        "conv_id", "block", F.unhex(F.array_join("t.key", "")).alias("ids"), F.col("t.words").alias("words"), F.size("t").alias("len"))
    none = convs.where("length = 0").select("conv_id", F.lit(0).cast("long").alias("block"), F.unhex(F.lit("")).alias("ids"),
                                            F.expr("cast(array() as array<bigint>)").alias("words"), F.lit(0).alias("len"))
    segments = materialize(segments.unionByName(none), "segments")
    blocks = convs.select("conv_id", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.greatest(F.col("length") - 1, F.lit(0)) / width))).alias("block"))
    prefixes = materialize(_prefixes(segments, width), "prefixes")
    tops = prefixes.groupBy("block", "prefix").agg(F.min("conv_id").alias("top_conv"))
    root = convs.agg(F.min("conv_id")).first()[0]
    later = segments.where("block > 0").join(prefixes, ["conv_id", "block"]).join(tops, ["block", "prefix"])
    first = segments.where("block = 0").withColumn("prefix", F.unhex(F.lit("00" * 16))).withColumn("top_conv", F.lit(root).cast("long"))
    rows = first.unionByName(later).join(blocks, ["conv_id", "block"]).withColumn("more", F.col("length") > (F.col("block") + 1) * width).drop("length")
    rows = materialize(rows, "segments")
    names = ["add_leaves", "add_saved", "add_children"]
    zero = {c: F.lit(0).cast("long") for c in names}
    deep = _run_shards(rows.where("block > 0").withColumns(zero), width, shard_rows)
    adds = _block_sums(deep, _recombined(deep))
    rows = rows.join(adds, ["conv_id", "block"], "left").withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in names})
    raw = _run_shards(materialize(rows, "segments"), width, shard_rows)
    edges = _recombined(raw)
    at = raw.where("kind in ('open', 'edge')").select("shard", "level", "side", "key")
    at = materialize(at.join(edges.select("key", F.col("conv_id").alias("above")), "key").select(
        "shard", (F.col("level") + 1).alias("level"), F.col("side").alias("parent_side"), "above"), "edges")
    inner = raw.where("kind = 'node'")
    inner = inner.where("parent_side is null").select(*raw.columns).unionByName(
        join_small(inner.where("parent_side is not null").drop("parent_conv_id"), at, ["shard", "level", "parent_side"]).withColumnRenamed("above", "parent_conv_id").select(*raw.columns))
    cols = ["conv_id", "block", "level", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    nodes = inner.select(*cols).unionByName(edges.where("level > 0 or block = 0").select(*cols))
    return nodes.select("conv_id", (F.col("block") * width + F.col("level")).alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
                        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
