"""Merkle manifest of a table of documents: one tree per source, one tree over the sources.

A document is a leaf: H over its fields, each ``-`` if null, else UTF-8 byte count, ``:``, value. The
leaves of a source ascend by doc_id; every ``FANOUT`` consecutive nodes (the last run may be shorter,
even one) become their H until one remains, the source's subroot. The subroots, ordered by source
(null first, bytewise), give the root in the same way. H is SHA-256 of the inputs joined, digests as
lower-case hex text.

Slot pivot: conditional aggregates spread the children of each parent into one column per slot; the
columns joined are hashed for the parent, the columns but a child's own are that child's siblings. A
level is written once. Levels shrink by ``FANOUT``, so all shuffles together move about half a row of
digests more than one pass over the leaves, on the way up and on the way down. Positions come from
range shards (``common.ranked``): neither a hot source nor the list of all sources is sorted in
one task. On the way down each parent hands its path (siblings up to the root) to its children.

Results in special cases: null fields count as ``-``; a null source is a source of its own; rows of one
doc_id stand in the order of their leaf digests (equal rows in any order, it is the same); a null
doc_id comes first. A run of one node is hashed like others and has no siblings. A table of one row
has its leaf as subroot and root. An empty table gives no rows. Other columns are ignored.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropcredit.llm.common import materialize, ranked

FANOUT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """H: lower-case hex SHA-256 of the texts joined."""
    return F.sha2(F.concat(*parts), 256)


def field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**replaced: Column) -> Column:
    """The leaf of a row; ``replaced`` gives other values for some of the fields."""
    return digest(*[field(replaced.get(f, F.col(f))) for f in FIELDS])


def _slots() -> list[str]:
    return [f"slot{j}" for j in range(FANOUT)]


def _levels(nodes: DataFrame, name: str) -> list[DataFrame]:
    """All levels of the trees in ``nodes`` (tree, pos, n, node; n: nodes of the tree), lowest first: one row
    per parent with its children in slots: tree, pos, n, slot0.., node, all of the parent."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels = []
    while most > 1:
        slot = F.col("pos") % FANOUT
        parents = nodes.where("n > 1").groupBy("tree", F.floor(F.col("pos") / FANOUT).alias("pos"), F.ceil(F.col("n") / FANOUT).alias("n")).agg(
            *[F.max(F.when(slot == j, F.col("node"))).alias(s) for j, s in enumerate(_slots())])
        parents = parents.withColumn("node", digest(*[F.coalesce(F.col(s), F.lit("")) for s in _slots()]))
        levels.append(materialize(parents, name))
        nodes, most = levels[-1], -(-most // FANOUT)
    return levels


def _tops(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """tree, node: the one node that remains of each tree."""
    out = nodes.where("n = 1").select("tree", "node")
    for level in levels:
        out = out.unionAll(level.where("n = 1").select("tree", "node"))
    return out


def _siblings(own: int) -> Column:
    """The slots but the own one, those before and those after it."""
    def joined(names):
        return F.concat(F.lit(""), *[F.coalesce(F.col(s), F.lit("")) for s in names])

    return F.struct(joined(_slots()[:own]).alias("before"), joined(_slots()[own + 1:]).alias("after"))


def _descend(nodes: DataFrame, levels: list[DataFrame], tops: DataFrame, name: str) -> DataFrame:
    """``nodes`` with the columns subroot and path. ``tops`` (tree, subroot, path) holds the path above each
    tree's last node."""
    above = None  # tree, pos, subroot, path of the nodes of the level that is looked at
    for level in reversed(levels):
        of_top = level.where("n = 1").alias("l").join(tops.alias("t"), F.expr("l.tree <=> t.tree")).select("l.*", "t.subroot", "t.path")
        if above is not None:
            inner = level.where("n > 1").alias("l").join(above.alias("a"), F.expr("l.pos = a.pos and l.tree <=> a.tree"))
            of_top = of_top.unionAll(inner.select("l.*", "a.subroot", "a.path"))
        if level is levels[0]:
            above = of_top
            break
        children = F.array(*[F.struct(F.lit(j).alias("j"), F.col(s).alias("node"), _siblings(j).alias("sib")) for j, s in enumerate(_slots())])
        above = materialize(of_top.select("tree", "pos", "subroot", "path", F.explode(children).alias("c")).where("c.node is not null").select(
            "tree", (F.col("pos") * FANOUT + F.col("c.j")).alias("pos"), "subroot", F.concat(F.array("c.sib"), "path").alias("path")), name)
    lone = nodes.where("n = 1").alias("d").join(tops.alias("t"), F.expr("d.tree <=> t.tree")).select("d.*", "t.subroot", "t.path")
    if above is None:
        return lone
    own = F.col("pos") % FANOUT
    slots = F.when(own == 0, _siblings(0))
    for j in range(1, FANOUT):
        slots = slots.when(own == j, _siblings(j))
    rows = nodes.where("n > 1").alias("d").join(
        above.select("tree", F.col("pos").alias("up"), *_slots(), "subroot", "path").alias("a"),
        F.expr(f"floor(d.pos / {FANOUT}) = a.up and d.tree <=> a.tree"))
    own_path = F.concat(F.array(slots), "a.path").alias("path")
    return rows.select("d.*", "a.subroot", own_path).unionAll(lone)


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["before"], node, s["after"]))


def path_text(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def manifest(docs: DataFrame, **carried: Column) -> DataFrame:
    """doc_id, source, leaf, subroot, root, path (array of siblings before and after, leaf level first), and the
    ``carried`` expressions over a document's columns."""
    leaves = docs.select("doc_id", F.col("source").cast("string").alias("tree"), leaf_digest().alias("node"),
                         *[c.alias(k) for k, c in carried.items()])
    nodes = ranked(leaves, ["tree"], ["doc_id", "node"], "pos", "n")
    levels = _levels(nodes, "merkle")
    subroots = materialize(_tops(nodes, levels), "merkle-subroots")
    tops = ranked(subroots.select(F.lit(0).alias("tree"), F.col("tree").alias("source"), "node"), ["tree"], ["source"], "pos", "n")
    over = _levels(tops, "merkle-top")
    root = _tops(tops, over).select("node").first()
    start = tops.sparkSession.createDataFrame([(0, root.node if root else None, [])], f"tree int, subroot string, path {_PATH}")
    paths = _descend(tops, over, start, "merkle-top-path")
    paths = materialize(paths.select(F.col("source").alias("tree"), F.col("node").alias("subroot"), "path"), "merkle-start")
    out = _descend(nodes, levels, paths, "merkle-path")
    return out.select("doc_id", F.col("tree").alias("source"), F.col("node").alias("leaf"), "subroot",
                      F.lit(root.node if root else None).cast("string").alias("root"), "path", *carried)


def verified(docs: DataFrame, altered: Column) -> DataFrame:
    """Proofs of all documents, each checked against a received leaf: ``altered`` (over a document's columns)
    gives the leaf as received. Adds proof_sha256, folded_root and verified."""
    out = manifest(docs, received=altered)
    out = out.select("doc_id", "leaf", "subroot", "root", F.sha2(path_text(F.col("path")), 256).alias("proof_sha256"),
                     folded(F.col("received"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
