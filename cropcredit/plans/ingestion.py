"""Bronze files made of a driver table, in the ways real files come, and read back as silver.

The customers go to four kinds of files by key: UTF-8 and cp1252, four delimiters, plain and gzip,
with quoted line breaks; one kind lacks a column. An older snapshot of every file holds other names
and must not be read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropcredit.session import ensure_checkpoint_dir
from cropcredit.sources import bronze as BZ
from cropcredit.sources.driver_tables import read_table

KINDS = [  # encoding, delimiter, compression, columns left out
    ("utf-8", ";", "none", ()),
    ("cp1252", "|", "gzip", ()),
    ("utf-8", "\t", "none", ("CD_PAIS",)),
    ("cp1252", ",", "none", ()),
]
FILES = 2  # per kind and month
SILVER = {"decimal_separator": ","}


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    name = F.concat("c_name", F.when(F.col("c_custkey") % 7 == 0, F.lit('\n"linha" 2')).otherwise(F.lit(" – ação")))
    value = F.replace(F.col("c_acctbal").cast("decimal(14,2)").cast("string"), F.lit("."), F.lit(","))
    return c.select("c_custkey", F.col("c_custkey").cast("string").alias("CD_CLIENTE"), name.alias("NM_CLIENTE"),
                    value.alias("VL_SALDO"), F.col("c_nationkey").cast("string").alias("CD_PAIS"))


def write_bronze(spark: SparkSession, df: DataFrame, root: str, month: str) -> None:
    """The files of one month; equal names in every month, as a source that is loaded anew."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for k, (encoding, sep, compression, without) in enumerate(KINDS):
        part = df.where(F.col("c_custkey") % len(KINDS) == k).drop("c_custkey", *without)
        if encoding == "cp1252":
            part = part.select(*[F.translate(c, BZ.CP1252_HIGH, BZ.LATIN1_HIGH).alias(c) for c in part.columns])
        folder = f"{root}-parts/{month}-{k}"
        part.repartition(FILES).write.options(
            header=True, sep=sep, quote='"', escape='"', compression=compression,
            encoding="ISO-8859-1" if encoding == "cp1252" else "UTF-8").csv(folder)
        target = fs_path(f"{root}/ingest_month={month}")
        fs.mkdirs(target)
        parts = sorted(f.getPath().toString() for f in fs.globStatus(fs_path(f"{folder}/part-*")))
        for i, p in enumerate(parts):
            fs.rename(fs_path(p), fs_path(target, f"k{k}-{i}.csv" + (".gz" if compression == "gzip" else "")))


def bronze_customers(spark: SparkSession, sf_dir: str) -> str:
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bronze-{uuid.uuid4().hex[:12]}"
    raw = raw_customers(spark, sf_dir)
    write_bronze(spark, raw.withColumn("NM_CLIENTE", F.lit("antigo")), f"{root}/clientes", "2024-01")
    write_bronze(spark, raw, f"{root}/clientes", "2024-02")
    return root


def ingested_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = BZ.latest_files(spark, bronze_customers(spark, sf_dir) + "/clientes")
    df = BZ.read_table(spark, files, {"name": "clientes"}, SILVER)
    return df.select("CD_CLIENTE", "NM_CLIENTE", "VL_SALDO", "CD_PAIS",
                     F.regexp_extract("_source_object", r"ingest_month=([^/]*)/k(\d)", 1).alias("mes"),
                     F.regexp_extract("_source_object", r"ingest_month=([^/]*)/k(\d)", 2).cast("int").alias("tipo"))


def transformed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tabela, linhas): rows written by ``transform_tables``, read back from the silver files; a table
    without files does not stop the others."""
    root = bronze_customers(spark, sf_dir)
    done = BZ.transform_tables(spark, root, f"{root}/silver", [{"name": "ausente"}, {"name": "clientes"}], SILVER, warn=lambda m: None)
    back = spark.read.parquet(*[f"{root}/silver/{t}.parquet" for t, n in done.items() if isinstance(n, int)])
    return back.groupBy(F.lit("clientes").alias("tabela")).agg(F.count("*").alias("linhas"))


def forced_delimiter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose header holds more of another delimiter than of the one that separates it: read with the table's own
    delimiter, after a look with a delimiter that gives one column and its warning (avisos: how many)."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bronze-{uuid.uuid4().hex[:12]}/clientes"
    raw = raw_customers(spark, sf_dir).select("CD_CLIENTE", F.col("VL_SALDO").alias("VL_SALDO;em;reais;hoje"), "CD_PAIS")
    raw.repartition(FILES).write.options(header=True, sep="|", quote='"', escape='"').csv(root)
    files = BZ.latest_files(spark, root)
    warned = []
    BZ.read_table(spark, files, {"name": "clientes", "delimiter": "\t"}, SILVER, warn=warned.append)
    df = BZ.read_table(spark, files, {"name": "clientes", "delimiter": "|"}, SILVER, warn=warned.append)
    return df.select("CD_CLIENTE", F.col("`VL_SALDO;em;reais;hoje`").alias("VL_SALDO"), "CD_PAIS", F.lit(len(warned)).alias("avisos"))
