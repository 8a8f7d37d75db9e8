"""Recode rules as a table, so that rules change without code.

A rule table has a row per word of each rule: ``rank`` (0 first; the lowest rank whose rule holds gives the class),
``clause`` (a rule holds if one of its clauses does), ``column`` and ``value`` (what the column has to be, or, with
``banned``, must not be; null with ``known``: it must not be null), ``class`` (the class given) or ``keep`` (the column
whose own value is given). A last rank without a column is the default; rank -1 stands for the null guard: ``column``
is null, so the class is.

Rows are melted into (row, column, value) and joined with the words by equality. A clause holds for a row if it has
as many hits as the clause has words that are not banned (each column's values count as one), and no banned one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropcredit.operators.recode import Keep, Not, Recode
from cropcredit.session import BROADCAST_ROWS

SCHEMA = "rank int, clause int, `column` string, value string, known boolean, banned boolean, class string, keep string"


def rule_table(spark: SparkSession, recode: Recode) -> DataFrame:
    """The rules of ``recode`` as a table."""
    rows = []

    def add(rank, clause, column, value, known, banned, result):
        keep = result.column if isinstance(result, Keep) else None
        rows.append((rank, clause, column, value, known, banned, None if keep else result, keep))

    if recode.null_guard:
        add(-1, 0, recode.null_guard, None, False, False, None)
    for rank, (result, clauses) in enumerate(recode.rules):
        for k, clause in enumerate(clauses):
            for column, values in clause.items():
                banned = isinstance(values, Not)
                if banned:  # a null value is neither in nor out
                    add(rank, k, column, None, True, False, result)
                for v in values.values if banned else values:
                    add(rank, k, column, v, False, banned, result)
    add(len(recode.rules), 0, None, None, False, False, recode.default)
    return spark.createDataFrame(rows, SCHEMA)


def classified(df: DataFrame, rules: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """(key, ``name``) for every row of ``df``; ``key`` is not null and tells its rows apart. Rules over columns that ``df`` lacks
    never hold."""
    # rules are read on the driver and have no estimate: counted. A shuffle by words would send the rows of one word to one task
    small = rules.count() <= BROADCAST_ROWS
    near = F.broadcast if small else lambda part: part
    words = rules.where("column is not null").dropDuplicates(["rank", "clause", "column", "value", "known", "banned"])
    # what a row must offer: the value, or that the column is known, or (null guard) that it is null
    token = F.when(F.col("known"), "known").when(F.col("value").isNull(), "null").otherwise("is")
    words = words.select("rank", "clause", "column", token.alias("_token"), F.coalesce("value", F.lit("")).alias("_value"), "banned")
    needs = words.where("not banned").groupBy("rank", "clause").agg(F.countDistinct("column").alias("_needs"))
    offers = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("_token"), v.alias("_value"), on.alias("_on"))
              for c in df.columns if c not in key for x in (F.col(f"`{c}`").cast("string"),)
              for t, v, on in (("is", x, x.isNotNull()), ("known", F.lit(""), x.isNotNull()), ("null", F.lit(""), x.isNull()))]
    offered = df.select(*key, F.explode(F.array(*offers)).alias("o")).select(*key, "o.*").where("_on").drop("_on")
    hits = offered.join(near(words), ["column", "_token", "_value"]).groupBy(*key, "rank", "clause").agg(
        F.count_if(~F.col("banned")).alias("_hits"), F.max("banned").alias("_banned"))
    holds = hits.join(near(needs), ["rank", "clause"]).where((F.col("_hits") == F.col("_needs")) & ~F.col("_banned"))
    results = rules.groupBy("rank").agg(F.min("class").alias("class"), F.min("keep").alias("keep"))  # one row per rule
    last, keeps = rules.agg(F.min(F.when(F.col("column").isNull(), F.col("rank"))), F.collect_set("keep")).first()  # at most all columns
    # every row takes the default's rank along, with the values that a rule may keep: no join back to the rows
    kept = {c: f"_keep{i}" for i, c in enumerate(c for c in df.columns if c in keeps and c not in key)}
    rest = df.select(*key, F.lit(last).alias("rank"), *[F.col(f"`{c}`").cast("string").alias(k) for c, k in kept.items()])
    ranks = rest.unionByName(holds.select(*key, "rank"), allowMissingColumns=True)
    first = ranks.groupBy(*key).agg(F.min("rank").alias("rank"), *[F.max(k).alias(k) for k in kept.values()])
    out = first.join(near(results), "rank", "left")
    own = F.coalesce(F.lit(None).cast("string"), *[F.when(F.col("keep") == c, F.col(k)) for c, k in kept.items()])
    return out.select(*key, F.coalesce("class", own).alias(name))
