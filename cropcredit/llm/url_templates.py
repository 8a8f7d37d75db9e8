"""URL filters by a path-template tree. DataFrame functions only.

Rules decide first: a rule fits its host and all subdomains if the path starts with the rule's path;
the longest wins. The pages that rules decide are the labelled examples for the rest:

1. Tree: level by level, each (host, template so far) counts its next segments. A segment stays
   literal if it has at least one page in ``LITERALS`` of its node's, unless the node's segments are
   mostly distinct (more than 2 kinds and over half as many kinds as pages); all others become the
   wildcard ``*``. Levels go on to the deepest path; a node whose pages all go on alike is finished at once.
2. Merge: templates of a host that differ in their last literal segment alone are sorted by smoothed
   share of allowed pages; neighbours that a two-proportion test (|z| < ``Z``) does not tell apart are
   one branch; those without labels are one branch too.
3. Purity: allowed share of the branch, smoothed by ``WEIGHT`` pseudo pages of the same template's
   share over all hosts, itself smoothed by the share of all labelled pages. Templates below
   ``ACCEPT`` are rejected: their pages are blocked.

Counts are map-side combined and a node meets its distinct segments by broadcast or in salted places, so a
hot host or path is no single task. A null url, or one without
``://``, has an empty host and path and is judged as template ``''``. Repeated rows are judged each.
Without any label the share is 0.5, which accepts. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cropcredit.llm.common import BROADCAST_ROWS, join_small, materialize

LITERALS = 16
Z = 1.64
WEIGHT = 4
ACCEPT = 0.5


def located(pages: DataFrame) -> DataFrame:
    """page_id, host, path."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    p = pages.select("page_id", F.coalesce(rest, F.lit("")).alias("rest"))
    p = p.withColumn("raw", F.regexp_extract("rest", r"^[^/?#]*", 0))
    path = F.regexp_extract(F.expr("substring(rest, length(raw) + 1)"), r"^[^?#]*", 0)
    return p.select("page_id", F.translate("raw", string.ascii_uppercase, string.ascii_lowercase).alias("host"), path.alias("path"))


def ruled(p: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Adds rule and decided: the longest rule that fits. ``rules``: (host and path, verdict)."""
    rule, decided = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, verdict in sorted(rules, key=lambda r: len(r[0])):  # the last that fits stands outermost
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        rule, decided = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(verdict)).otherwise(decided)
    return p.withColumn("rule", rule).withColumn("decided", decided)


def _with_nodes(tokens: DataFrame, nodes: DataFrame, salts: int = 32) -> DataFrame:
    """tokens with their node's columns. Few nodes are broadcast; of many, each meets its segments in ``salts`` places, so
    a node with very many distinct segments is no single task."""
    if nodes.count() <= BROADCAST_ROWS:
        return tokens.join(F.broadcast(nodes), ["host", "template"])
    spread = nodes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return tokens.withColumn("_salt", F.pmod(F.xxhash64("_t"), F.lit(salts)).cast("int")).join(spread, ["host", "template", "_salt"]).drop("_salt")


def with_templates(p: DataFrame) -> DataFrame:
    """Adds template. Level by level to the deepest path; a path leaves the work where it ends, and where all pages of its
    node go on alike (each further segment is then a literal)."""
    parts = F.filter(F.split("path", "/"), lambda x: x != "")
    p = p.withColumn("_s", F.transform(parts, lambda x: F.replace(x, F.lit("*"), F.lit("%2A"))))
    out = p.columns[:-1] + ["template"]
    p = materialize(p.withColumn("template", F.lit("")), "pages")
    done, k = p.where(F.size("_s") == 0).select(*out), 0
    p = p.where(F.size("_s") > 0)
    while True:
        s, rest = F.get("_s", F.lit(k)), F.array_join(F.slice("_s", k + 1, F.size("_s")), "/")
        tokens = materialize(p.groupBy("host", "template", s.alias("_t")).agg(
            F.count("*").alias("_n"), F.min(F.sha2(rest, 256)).alias("_lo"), F.max(F.sha2(rest, 256)).alias("_hi")), "tokens")
        nodes = materialize(tokens.groupBy("host", "template").agg(
            F.sum("_n").alias("_all"), F.count("*").alias("_kinds"), (F.min("_lo") == F.max("_hi")).alias("_alike")), "nodes")
        literal = (F.col("_n") * LITERALS >= F.col("_all")) & ~((F.col("_kinds") > 2) & (F.col("_kinds") * 2 > F.col("_all")))
        fixed = _with_nodes(tokens, nodes).where(F.col("_alike") | literal).select("host", "template", "_t", "_alike")
        fixed = materialize(fixed, "literals")
        p = join_small(p.withColumn("_t", s), fixed, ["host", "template", "_t"], "left")
        step = F.when(F.col("_alike"), rest).when(F.col("_alike").isNotNull(), F.col("_t")).otherwise(F.lit("*"))
        p = materialize(p.withColumn("template", F.concat("template", F.lit("/"), step)).withColumn(
            "_end", F.coalesce("_alike", F.lit(False)) | (F.size("_s") == k + 1)).drop("_t", "_alike"), "pages")
        done = done.unionByName(p.where("_end").select(*out))
        p, k = p.where("not _end").drop("_end"), k + 1
        if p.isEmpty():
            return done


def judged_templates(p: DataFrame) -> DataFrame:
    """host, template, purity: one row per template of a host."""
    t = p.groupBy("host", "template").agg(
        F.count_if(F.col("decided") == "allow").alias("pos"), F.count_if(F.col("decided") == "block").alias("neg"))
    t = t.withColumn("branch", F.regexp_replace("template", r"/[^/*][^/]*((/\*+)*)$", "/<>$1"))
    t = t.withColumn("n", F.col("pos") + F.col("neg")).withColumn("share", (F.col("pos") + 1) / (F.col("n") + 2))
    order = Window.partitionBy("host", "branch").orderBy((F.col("n") > 0).cast("int"), "share", "template")
    n1, s1 = F.lag("n").over(order) + 2, F.lag("share").over(order)
    n2, s2 = F.col("n") + 2, F.col("share")
    both = (n1 * s1 + n2 * s2) / (n1 + n2)
    z = F.abs(s1 - s2) / F.sqrt(both * (1 - both) * (1 / n1 + 1 / n2))
    apart = F.lag("n").over(order).isNotNull() & (((F.lag("n").over(order) > 0) != (F.col("n") > 0)) | (z >= Z))
    t = t.withColumn("_new", apart.cast("int"))
    t = t.withColumn("merged", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    t = materialize(t, "templates")
    m = t.groupBy("host", "branch", "merged").agg(F.sum("pos").alias("mpos"), F.sum("n").alias("mn"))
    total = t.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("p"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    base = (total["p"] + 1) / (total["n"] + 2)
    shape = t.groupBy("template").agg(F.sum("pos").alias("spos"), F.sum("n").alias("sn"))
    shape = shape.select("template", ((F.col("spos") + WEIGHT * base) / (F.col("sn") + WEIGHT)).alias("prior"))
    out = t.join(m, ["host", "branch", "merged"]).join(shape, "template")
    purity = (F.col("mpos") + WEIGHT * F.col("prior")) / (F.col("mn") + WEIGHT)
    return materialize(out.select("host", "template", purity.alias("purity")), "purity")


def judge(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity for every page."""
    p = with_templates(ruled(located(pages), rules))
    out = join_small(p, judged_templates(p), ["host", "template"])
    verdict = F.coalesce("decided", F.when(F.col("purity") >= ACCEPT, F.lit("allow")).otherwise(F.lit("block")))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity")
