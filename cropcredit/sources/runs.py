"""Run records: one nested JSON document per training run.

Written with Spark's JSON sink (append, one small file per run) and read back with a
fixed schema, so records from k-fold and out-of-time runs share one table.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

D = T.DoubleType()
CAL = T.ArrayType(T.StructType([T.StructField("bin", T.IntegerType()), T.StructField("mean_pred", D),
                                T.StructField("frac_pos", D)]))
ROC = T.ArrayType(T.StructType([T.StructField("k", T.IntegerType()), T.StructField("fpr", D),
                                T.StructField("tpr", D)]))
KSC = T.ArrayType(T.StructType([T.StructField("k", T.IntegerType()), T.StructField("score", D),
                                T.StructField("cdf_pos", D), T.StructField("cdf_neg", D)]))
METRICS = T.MapType(T.StringType(), D)
PER_SAFRA = T.ArrayType(T.StructType([
    T.StructField("safra", T.IntegerType()), T.StructField("safra_label", T.StringType()),
    T.StructField("n_train", T.LongType()), T.StructField("n_test", T.LongType()),
    T.StructField("rate_test", D), T.StructField("metrics", METRICS),
    T.StructField("roc", ROC), T.StructField("ks_curve", KSC), T.StructField("calibration", CAL),
]))
RESULT = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("metrics", METRICS),
    T.StructField("folds", T.ArrayType(METRICS)), T.StructField("calibration", CAL),
    T.StructField("roc", ROC), T.StructField("ks_curve", KSC), T.StructField("per_safra", PER_SAFRA),
])
RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("created_at", T.StringType()),
    T.StructField("validation", T.StringType()), T.StructField("horizon", T.IntegerType()),
    T.StructField("n_splits", T.IntegerType()), T.StructField("target_rate", D),
    T.StructField("n_rows", T.LongType()),
    T.StructField("features", T.StructType([T.StructField("cat", T.ArrayType(T.StringType())),
                                            T.StructField("num", T.ArrayType(T.StringType()))])),
    T.StructField("safras", T.ArrayType(T.IntegerType())),
    T.StructField("test_safras", T.ArrayType(T.IntegerType())),
    T.StructField("results", T.ArrayType(RESULT)),
])


def _clean(o):
    if isinstance(o, dict):
        return {k: _clean(v) for k, v in o.items() if k != "oof"}
    if isinstance(o, (list, tuple)):
        return [_clean(v) for v in o]
    return o


def stamp(record: dict) -> dict:
    now = _dt.datetime.now(_dt.timezone.utc)
    record.setdefault("run_id", now.strftime("%Y%m%d%H%M%S"))
    record.setdefault("created_at", now.isoformat())
    return record


def records_frame(spark: SparkSession, records: list[dict]) -> DataFrame:
    """Run records (small nested dicts) as a DataFrame with the run schema."""
    texts = [json.dumps(_clean(stamp(r)), ensure_ascii=False, default=float) for r in records]
    raw = spark.createDataFrame([(t,) for t in texts], "doc string")
    return raw.select(F.from_json("doc", RUN_SCHEMA).alias("r")).select("r.*")


def save_run(spark: SparkSession, record: dict, runs_uri: str) -> str:
    df = records_frame(spark, [record])
    df.coalesce(1).write.mode("append").json(runs_uri)
    return record["run_id"]


def load_runs(spark: SparkSession, runs_uri: str) -> DataFrame:
    """All runs, ordered by creation time."""
    return spark.read.schema(RUN_SCHEMA).json(runs_uri).orderBy("created_at")
