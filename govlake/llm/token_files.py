"""Token ids as compact binary files, in ascending doc_id order, and back.

A file holds rows of Parquet, each one self-contained segment of the range coder in `coder`: its
place (part and first token within the part), its number of tokens, and the segment's bytes.
Spark's writer commits whole files, so a lost executor leaves none half written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import coder, tokens
from .shared import partitions, text_of

#: A segment is closed after the window of documents that brings it to so many tokens.
SEGMENT = 8_000_000
_SEGMENTS = "part int, first long, n_tokens long, payload binary"


def _packed(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = tokens.word_ids(path, end_id)
        part = TaskContext.get().partitionId()
        names: list[int | None] = []
        ids: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        size = first = 0

        def segment() -> pa.RecordBatch:
            payload = coder.encode_segment(np.concatenate(ids), names, np.concatenate(lengths).tolist())
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([first]), pa.array([size]),
                 pa.array([payload], pa.binary())], ["part", "first", "n_tokens", "payload"])

        for batch in batches:
            column = batch.column("doc_id").to_pylist()
            for some, counts in coded.windows(text.as_py() for text in batch.column("text")):
                names += column[:len(counts)]
                del column[:len(counts)]
                ids.append(some)
                lengths.append(counts)
                size += len(some)
                if size >= SEGMENT:
                    yield segment()
                    first += size
                    names, ids, lengths, size = [], [], [], 0
        if names:
            yield segment()

    return run


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1) -> None:
    """Write the ids of every whole text, each with `end_id` after it, to `folder`.

    Documents are dealt by ranges of doc_id (null first) and of a hash of the text, so rows that
    share a doc_id spread too. A null or empty text is its end id; repeated rows are written as
    often as they come; no other columns are read. An empty table gives no segment.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", text_of().alias("text")).withColumn("tie", F.xxhash64("text"))
    dealt = (rows.repartitionByRange(partitions(spark), "doc_id", "tie")
             .sortWithinPartitions("doc_id", "tie").select("doc_id", "text"))
    (dealt.mapInArrow(_packed(tokenizer, end_id), _SEGMENTS)
     .write.option("parquet.block.size", 16 << 20).option("compression", "uncompressed").parquet(folder))


def read(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids before the document in the whole order), n_tokens, ids_crc32, and the
    ids themselves on request, all decoded from the files. Only one number per part is gathered."""
    files = spark.read.parquet(folder)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("part", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("before"))
    placed = files.join(F.broadcast(before), "part").select((F.col("before") + F.col("first")).alias("at"), "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, payload in zip(batch.column("at").to_pylist(), batch.column("payload"), strict=True):
                ids, names, lengths = coder.decode_segment(payload.as_py())
                ends = lengths.cumsum()
                starts = ends - lengths
                out = [pa.array(names, pa.int64()), pa.array(at + starts), pa.array(lengths),
                       pa.array([zlib.crc32(ids[s:e]) for s, e in zip(starts, ends, strict=True)], pa.int64())]
                if with_ids:
                    out.append(pa.array([ids[s:e] for s, e in zip(starts, ends, strict=True)], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(out, names_of)

    names_of = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    return placed.mapInArrow(run, ", ".join(f"{c} {'array<long>' if c == 'ids' else 'long'}" for c in names_of))
