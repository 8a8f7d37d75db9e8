"""Chat formatting over reply trees. DataFrame functions only.

Messages are nodes (conv_id, node_id, parent_id, role, text, score); a root has no parent (or one
that is not there). Iterative self-joins enumerate the root-to-leaf paths by pointer doubling: round
k joins every node with the one 2^k steps above, so a path of depth d takes log2(d) rounds, and each
join is keyed by (conv_id, node_id), so a conversation of very many messages spreads over tasks. The
rounds give each leaf its path's length and score; leaves are ranked within the conversation by score
per message, then length, then node; the ``best`` first are chosen, and the same pointers, read from
the longest down, collect the chosen paths' messages.

Each chosen path becomes one conversation: per message ``<|turn|>role<|text|>text<|end|>``. Inside
roles and texts ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``, so no control string occurs in them
and ``unescape`` gives every text back. The loss mask is a list of (start, length) spans, in code
points of the formatted string, that cover each assistant text and nothing else.

A null text or role is empty, a null score 0. Messages with a null conv_id are one conversation, whose conv_id is
null in the result; joins on conv_id are null-safe. A tree's cycles have no root and give no path. Messages that repeat
a (conv_id, turn) stand in the order of role and text. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cropcredit.llm.common import materialize

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
MASKED_ROLE = "assistant"


def escape(c):
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c):
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def join_in(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on conv_id, where null equals null, and ``key``, where it does not; both stand once, as on the left."""
    r = right.withColumnsRenamed({"conv_id": "_conv_id", key: "_key"})
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col(key) == F.col("_key"))
    return left.join(r, same, how).drop("_conv_id", "_key")


def linear_tree(messages: DataFrame) -> DataFrame:
    """The tree of a conversation table (conv_id, turn, role, text): each message answers the one
    before it; score 1 each."""
    own = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    m = messages.select("conv_id", F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    m = m.withColumn("node_id", F.row_number().over(own).cast("long"))
    return m.select("conv_id", "node_id", F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"), "role", "text", F.lit(1.0).alias("score"))


def paths(tree: DataFrame, best: int = 1) -> DataFrame:
    """conv_id, leaf_id, position, node_id: the messages of the ``best`` paths of each conversation.

    ``tree`` needs conv_id, node_id, parent_id and score and should be materialised."""
    nodes = tree.select("conv_id", "node_id", "parent_id", "score")
    there = nodes.select("conv_id", F.col("node_id").alias("parent_id")).distinct()
    linked = join_in(nodes, there.withColumn("_there", F.lit(True)), "parent_id", "left")
    # up: the node 2^k steps above, null beyond the root; n, total: messages and score up to it (it excluded)
    state = linked.select("conv_id", "node_id", F.when(F.col("_there"), F.col("parent_id")).alias("up"), F.lit(1).cast("long").alias("n"), F.coalesce("score", F.lit(0.0)).alias("total"))
    state = materialize(state, "pointers")
    done, active, jumps = state.where("up is null"), state.where("up is not null"), []
    longest = nodes.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    while (1 << len(jumps)) <= longest and active.limit(1).count():  # cycles never end by themselves
        jumps.append(active.select("conv_id", "node_id", "up"))
        above = done.unionByName(active).select(
            "conv_id", F.col("node_id").alias("up"), F.col("up").alias("up2"), F.col("n").alias("n2"), F.col("total").alias("total2"))
        j = join_in(active, above, "up")  # nodes that have met their root rest
        j = materialize(j.select("conv_id", "node_id", F.col("up2").alias("up"), (F.col("n") + F.col("n2")).alias("n"),
                                 (F.col("total") + F.col("total2")).alias("total")), "pointers")
        done, active = done.unionByName(j.where("up is null")), j.where("up is not null")
    parents = jumps[0].select("conv_id", F.col("up").alias("node_id")).distinct() if jumps else None
    leaves = done
    if parents is not None:
        leaves = join_in(leaves, parents, "node_id", "left_anti")
    rank = Window.partitionBy("conv_id").orderBy((F.col("total") / F.col("n")).desc(), F.col("n").desc(), "node_id")
    chosen = leaves.withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= best)
    on = chosen.select("conv_id", F.col("node_id").alias("leaf_id"), "node_id", F.col("n").alias("position"))
    for k, jump in reversed(list(enumerate(jumps))):
        here = F.struct("node_id", "position")
        there_ = F.struct(F.col("up").alias("node_id"), (F.col("position") - (1 << k)).alias("position"))
        both = F.array_compact(F.array(here, F.when(F.col("up").isNotNull(), there_)))
        on = join_in(on, jump, "node_id", "left").select("conv_id", "leaf_id", F.explode(both).alias("x"))
        on = on.select("conv_id", "leaf_id", "x.node_id", "x.position")
    return on


def formatted(tree: DataFrame, best: int = 1) -> DataFrame:
    """conv_id, leaf_id, formatted, loss_spans (array of (start, length)) of every chosen path."""
    m = join_in(paths(tree, best), tree.select("conv_id", "node_id", "role", "text"), "node_id")
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    m = m.select("conv_id", "leaf_id", "position", head.alias("head"), escape(F.col("text")).alias("body"), (F.col("role") == MASKED_ROLE).alias("masked"))
    g = m.groupBy("conv_id", "leaf_id").agg(F.array_sort(F.collect_list(F.struct("position", "head", "body", "masked"))).alias("m"))
    end = len(END)
    whole = F.array_join(F.transform("m", lambda x: F.concat(x["head"], x["body"], F.lit(END))), "")
    state = F.aggregate(
        "m",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["head"]) + F.length(x["body"]) + end).alias("at"),
            F.when(x["masked"], F.array_append(acc["spans"], F.struct((acc["at"] + F.length(x["head"])).cast("long").alias("start"), F.length(x["body"]).cast("long").alias("length"))))
            .otherwise(acc["spans"]).alias("spans")))
    return g.select("conv_id", "leaf_id", whole.alias("formatted"), state["spans"].alias("loss_spans"))


def parsed(out: DataFrame) -> DataFrame:
    """conv_id, turns (array of role, text), loss_texts: read back from formatted strings and spans."""
    turns = F.transform(
        F.slice(F.split("formatted", r"<\|turn\|>"), 2, 1 << 30),
        lambda t: F.struct(unescape(F.substring_index(t, TEXT, 1)).alias("role"),
                           unescape(F.regexp_replace(F.regexp_replace(t, r"(?s)^.*?<\|text\|>", ""), r"<\|end\|>$", "")).alias("text")))
    loss = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return out.select("*", turns.alias("turns"), loss.alias("loss_texts"))
