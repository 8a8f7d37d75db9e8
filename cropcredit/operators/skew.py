"""Inner joins with hot keys.

Both sides' rows are counted per key (map-side combined). A key with more than a ``CELLS``-th of a task's
even share of a side is hot there: its rows are cut into pieces of about that size, by a hash of a column
that numbers the rows, and every piece meets a copy of every piece of the other side. So a key with ``a``
pieces left and ``b`` right is ``a * b`` cells that are shuffled apart; each pair of rows meets in one cell.
Fewer than ``CELLS`` keys per task and side can be hot, which bounds the table that is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcredit.session import written

#: Pieces that a task's even share of a side is cut into, about.
CELLS = 32
PLACE = "_place"


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with a column that deals its rows to pieces. Number a scan (before any shuffle): a task that is
    run again then gives its rows the same numbers."""
    return df.withColumn(PLACE, F.monotonically_increasing_id())


def hot_keys(left: DataFrame, right: DataFrame, on: list[str], cells: int = CELLS) -> DataFrame | None:
    """(keys, _a, _b): pieces of each key that is hot on a side, or None if there is none."""
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = []
    for df, pieces in ((left, "_a"), (right, "_b")):
        share = max(df.count() // (tasks * cells), 1)
        n = df.where(" and ".join(f"`{c}` is not null" for c in on)).groupBy(*on).agg(F.count("*").alias("_n"))
        # a share of few rows is no load: a key is not cut below 1,000 rows a piece
        sides.append(n.where(F.col("_n") > max(share, 1000)).select(*on, F.ceil(F.col("_n") / max(share, 1000)).alias(pieces)))
    hot = written(sides[0].join(sides[1], on, "full").na.fill(1, ["_a", "_b"]), "hot-keys")
    return None if hot.isEmpty() else hot


def spread_join(left: DataFrame, right: DataFrame, on: list[str], hot: DataFrame | None) -> DataFrame:
    """``left`` inner join ``right`` on ``on``; each pair of rows once. Both carry the column of ``numbered``; the
    result has the left one's. ``hot`` comes from ``hot_keys`` over both sides, or over larger tables they are
    made of."""
    if hot is None:
        return left.join(right.drop(PLACE), on)
    hot = F.broadcast(hot)  # fewer than CELLS keys per task and side

    def one(n: str):
        return F.coalesce(F.col(n), F.lit(1))

    def piece(n: str):
        return F.pmod(F.xxhash64(PLACE), one(n))

    lf = left.join(hot, on, "left").withColumn("_i", piece("_a"))
    lf = lf.select(*left.columns, "_i", F.explode(F.sequence(F.lit(0).cast("long"), one("_b") - 1)).alias("_j"))
    rt = right.join(hot, on, "left").withColumn("_j", piece("_b"))
    rt = rt.select(*[c for c in right.columns if c != PLACE], "_j", F.explode(F.sequence(F.lit(0).cast("long"), one("_a") - 1)).alias("_i"))
    return lf.join(rt, [*on, "_i", "_j"]).drop("_i", "_j")
