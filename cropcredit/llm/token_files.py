"""Token ids as flat binary files with document offsets.

Layout of a data set, one folder in the shared store:

- ``ids/part-NNNNN-*``: shards in ascending document order. A shard starts with the ids of all
  its documents as flat little-endian unsigned integers (16 bits if the ids fit, else 32), each
  document closed by the end id. An index follows: per document (doc_id int64, start uint64 within
  the shard, known uint64: 0 for a null doc_id), then (documents uint64, ids uint64), then one
  more end id.
- ``shards``: Parquet of (shard, n_docs, n_ids, base): base is the prefix sum of the ids of all
  shards before, so base + start is a document's global 64-bit offset.

Spark's text writer commits the shards: each row is one document's bytes, and the line separator
*is* the end id, so the file is the plain concatenation, lost tasks are retried, and any store
that Spark writes to will do. (That holds for end ids whose bytes are all below 128.)

A null or empty text is a document with the end id alone. Null doc_ids come last. Rows that
repeat a doc_id stand side by side, ordered by text. An empty table has no documents.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cropcredit.llm.bpe import encoder
from cropcredit.llm.common import join_small, map_arrow

INDEX = np.dtype([("doc_id", "<i8"), ("start", "<u8"), ("known", "<u8")])


def width(vocab: int) -> int:
    return 2 if vocab <= 1 << 16 else 4


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, vocab: int, specials: bool = False) -> None:
    """Tokenise all documents in doc_id order and write the data set to ``path``; ``specials`` as in
    ``bpe``."""
    size = width(vocab)
    end = int(end_id).to_bytes(size, "little")
    if max(end) > 127:
        raise ValueError("end ids with a byte above 127 can't be written")
    kind = np.dtype(f"<u{size}")

    def run(batches):
        enc, docs_, lens = encoder(tokenizer, specials), [], []
        for b in batches:
            docs_ += b.column(0).to_pylist()
            rows = [ids.astype(kind).tobytes() for ids in enc.rows(b.column(1))]
            lens += [len(r) // size + 1 for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])
        if docs_:
            index = np.zeros(len(docs_), INDEX)
            index["doc_id"] = [d or 0 for d in docs_]
            index["known"] = [d is not None for d in docs_]
            index["start"] = np.cumsum(lens) - lens
            foot = index.tobytes() + np.array([len(docs_), sum(lens)], "<u8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([foot], pa.binary())], names=["value"])

    by = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by, F.col("text").asc())
    (map_arrow(rows, run, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", end.decode("ascii")).text(f"{path}/ids"))
    _write_shards(docs.sparkSession, path, size)


class Shard:
    """One shard's ids and index over a buffer or, by path, a memory map."""

    def __init__(self, source, size: int):
        if isinstance(source, str):  # an empty file can't be mapped
            raw = np.memmap(source, np.uint8, "r") if os.path.getsize(source) else np.zeros(0, np.uint8)
        else:
            raw = np.frombuffer(source, np.uint8)
        foot = len(raw) - size - 16
        n_docs, n_ids = (int(x) for x in np.frombuffer(raw[foot: foot + 16].tobytes(), "<u8")) if foot >= 0 else (0, 0)
        self.n_docs, self.n_ids = n_docs, n_ids
        self.ids = raw[: n_ids * size].view(f"<u{size}")
        self.index = np.frombuffer(raw[foot - n_docs * INDEX.itemsize: foot].tobytes(), INDEX) if n_docs else np.zeros(0, INDEX)
        self.bounds = np.append(self.index["start"].astype(np.int64), n_ids)

    def __getitem__(self, k: int) -> np.ndarray:
        return self.ids[self.bounds[k]: self.bounds[k + 1]]


def _files(spark: SparkSession, path: str) -> DataFrame:
    """path, source of every shard: the source is a local path to map where the store is a mounted
    folder, else the bytes that Spark reads."""
    files = spark.read.format("binaryFile").load(f"{path}/ids")
    if re.match(r"file:|/", path):
        return files.select("path", F.regexp_replace("path", "^file:/+", "/").alias("source"))
    return files.select("path", F.col("content").alias("source"))


def _write_shards(spark: SparkSession, path: str, size: int) -> None:
    def run(batches):
        for b in batches:
            opened = [Shard(s, size) for s in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([s.n_docs for s in opened], pa.int64()), pa.array([s.n_ids for s in opened], pa.int64())],
                names=["path", "n_docs", "n_ids"])

    s = map_arrow(_files(spark, path), run, "path string, n_docs long, n_ids long")
    s = s.withColumn("shard", F.regexp_extract("path", r"part-(\d+)", 1).cast("long"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard file
    s = s.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    s.select("shard", "path", "n_docs", "n_ids", "base").write.parquet(f"{path}/shards")


def read_documents(spark: SparkSession, path: str, vocab: int) -> DataFrame:
    """doc_id, start (global), n_tokens, ids_crc32 (of 32-bit ids) of every document, read from
    the files."""
    size = width(vocab)

    def run(batches):
        for b in batches:
            for source, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = Shard(source, size)
                for lo in range(0, s.n_docs, 4096):
                    part = range(lo, min(lo + 4096, s.n_docs))
                    at = s.index[part.start: part.stop]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([int(d) if k else None for d, k in zip(at["doc_id"], at["known"])], pa.int64()),
                        pa.array(base + at["start"].astype(np.int64), pa.int64()),
                        pa.array([len(s[k]) for k in part], pa.int64()),
                        pa.array([zlib.crc32(s[k].astype("<u4").tobytes()) for k in part], pa.int64()),
                    ], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    shards = spark.read.parquet(f"{path}/shards").select("path", "base")
    return map_arrow(join_small(_files(spark, path), shards, "path").select("source", "base"),
                     run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def new_path(folder: str) -> str:
    return f"{folder.rstrip('/')}/llm-ids-{uuid.uuid4().hex[:12]}"
