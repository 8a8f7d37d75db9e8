"""SparkSession construction and cluster-safe helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Conservative byte limit for an explicit broadcast hint; sides above it are left to
# the planner (sort-merge join, or AQE's runtime broadcast conversion).
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
# Rows (of a few short columns) that counted_broadcast takes at most.
BROADCAST_ROWS = 500_000


def build_session(
    master: str | None = None,
    app_name: str = "cropcredit",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # No broadcast from static estimates (they under-count derived aggregates);
        # explicit size-checked hints (sized_broadcast) cover the small domains and AQE
        # converts a join only from measured shuffle sizes.
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(8 * 1024 * 1024),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # tables that are transformed at the same time share the cluster (bronze.transform_tables)
        "spark.scheduler.mode": "FAIR",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local master gets a folder of its own where the setting is unset (tests, laptops);
    elsewhere executors would write to their own disks, so that is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = fallback or tempfile.mkdtemp(prefix="cropcredit-ckpt-")
        os.makedirs(current, exist_ok=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written once as parquet below the shared folder and read back: what several jobs
    read, safe from lost executors. ``options`` go to the writer."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, keys: Sequence[str], name: str, dealt: bool = False) -> DataFrame:
    """``df`` written once below the shared folder in ``spark.sql.shuffle.partitions`` buckets of ``keys``, sorted, and
    read back: tables of equal keys join on them without an exchange. ``dealt``: ``df`` ends in a groupBy of just these
    keys, whose shuffle deals rows as the buckets do; else rows are shuffled here. Either way a bucket is one file."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{table}"
    rows = df if dealt else df.repartition(n, *keys)
    rows.write.bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return spark.table(table)


def counted_broadcast(df: DataFrame, limit_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast-hint ``df`` if its counted rows stay below ``limit_rows``; count something written,
    not a lineage. Beyond that it is shuffled, even if its compressed files look small."""
    return F.broadcast(df) if df.count() <= limit_rows else df.hint("merge")


def plan_size_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan (no job is run)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # pragma: no cover - defensive, e.g. on Spark Connect
        return BROADCAST_LIMIT_BYTES + 1


def sized_broadcast(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast-hint ``df`` only when its estimated size is under ``limit_bytes``.

    Above the limit the frame is returned untouched so the planner falls back to a
    shuffle join; AQE may still switch to a broadcast once real sizes are known.
    """
    if plan_size_bytes(df) <= limit_bytes:
        return F.broadcast(df)
    return df
