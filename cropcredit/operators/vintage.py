"""Event-time histogram and life table of defaults.

A vintage is described by one small histogram: per group (crop year) and month of first default (NULL: none within
the window) the number of borrower rows. It is aggregated map-side from one row per operation; the cumulative curve and
the life table are prefix sums over at most ``n_deltas`` + 2 rows of a group, so no row carries a column per month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def event_histogram(rows: DataFrame, by: Sequence[str], event: str = "first_default", weight: str | None = None) -> DataFrame:
    """(by, delta, n): rows (or their ``weight``) by month of the event; delta is NULL where there was none. Groups with a
    NULL key are left out."""
    for g in by:
        rows = rows.where(F.col(g).isNotNull())
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return rows.groupBy(*by, F.col(event).alias("delta")).agg(n.cast("long").alias("n"))


def life_table(histogram: DataFrame, by: Sequence[str], n_deltas: int) -> DataFrame:
    """(by, delta 0..n_deltas, em_risco, inadimplentes, acumulado, taxa_mensal, taxa_acumulada): rows not yet in default
    at the start of the month, defaults in it and up to it, hazard (NULL when nobody is at risk) and cumulative rate."""
    keys = list(by)
    in_window = F.col("delta").between(0, n_deltas)
    groups = histogram.groupBy(*keys).agg(  # one read of the histogram; at most n_deltas + 1 counts in a row
        F.sum("n").alias("_total"), F.map_from_entries(F.collect_list(F.when(in_window, F.struct("delta", "n")))).alias("_n"))
    x = groups.select(*keys, "_total", "_n", F.explode(F.sequence(F.lit(0), F.lit(n_deltas))).alias("delta"))
    x = x.withColumn("n", F.coalesce(F.try_element_at("_n", "delta"), F.lit(0)))
    so_far = F.sum("n").over(W.partitionBy(*keys).orderBy("delta").rowsBetween(W.unboundedPreceding, W.currentRow))
    x = x.withColumn("acumulado", so_far)
    at_risk = F.col("_total") - F.col("acumulado") + F.col("n")
    return x.select(*keys, "delta", at_risk.alias("em_risco"), F.col("n").alias("inadimplentes"), "acumulado",
                    F.when(at_risk > 0, F.col("n") / at_risk).alias("taxa_mensal"), (F.col("acumulado") / F.col("_total")).alias("taxa_acumulada"))


def curve(table: DataFrame, by: Sequence[str], n_deltas: int) -> DataFrame:
    """The cumulative rates of a life table, one column per month."""
    return table.groupBy(*by).agg(*[F.max(F.when(F.col("delta") == d, F.col("taxa_acumulada"))).alias(str(d)) for d in range(n_deltas + 1)])


def long_form(first_defaults: DataFrame, keys: Sequence[str], n_deltas: int, event: str = "first_default") -> DataFrame:
    """(keys, delta, inadimplente): one row per month 0..n_deltas; 1 from the month of the first default on."""
    hit = F.when(F.col(event).isNotNull() & (F.col("delta") >= F.col(event)), 1).otherwise(0)
    months = first_defaults.select(*keys, event, F.explode(F.sequence(F.lit(0), F.lit(n_deltas))).alias("delta"))
    return months.select(*keys, "delta", hit.alias("inadimplente"))
