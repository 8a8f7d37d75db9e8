"""The corpus pipeline: quality, language, near duplicates, mixture, packing.

``run(spark, sf_dir)`` applies STAGES to the table documents; each stage's result is written as
Parquet to the shared folder and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cropcredit.llm import langid, mixing, ngram_join, packing, quality
from cropcredit.llm.common import materialize, read_table


def good_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def known_languages(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs)


def one_of_each_group(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def mixture(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packed(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024, specials=True)


STAGES = [
    ("quality classifier", good_documents),
    ("language ID", known_languages),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources to target weights", mixture),
    ("best-fit packing", packed),
]

#: Trained models and tokenizers are not SQL: tests/llm holds the pipeline against a plain version.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
