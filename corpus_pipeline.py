"""From raw documents to packed training sequences.

Each stage takes what the one before kept, written as Parquet and read again, so stages can be
retried alone and no lineage grows over more than one of them. All but the last return documents
with the columns they came with.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from govlake.llm import decontaminate, packing, quality, shared, simhash


def judged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Null and empty texts are scored like any other, repeated rows get one verdict and stay, and
    without a usable label every document is kept.
    """
    shared.ship(spark)
    return quality.keep_good(docs, shared.table(spark, sf_dir, "labels"))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of four-word shingles link within four bits.

    Null and blank texts are one group; of repeated rows and of ties one stays; an empty table
    stays empty; texts are fingerprinted whole, whatever their length.
    """
    shared.ship(spark)
    return simhash.keep_one(docs, words=4, radius=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items.

    Null and empty texts hold none and stay, repeated rows go or stay together, and an empty
    benchmark removes nothing.
    """
    return decontaminate.keep_clean(docs, shared.table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens.

    Null and empty texts are packed as their end id, repeated rows as often as they come, and an
    empty table gives no piece.
    """
    shared.ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", judged), ("near-dedup", deduplicated),
          ("benchmark decontamination", decontaminated), ("packing", packed)]

#: The classifier, the fingerprints and the tokenizer are beyond SQL; tests hold the pipeline
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    place = shared.folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{number}")
        docs = spark.read.parquet(f"{place}/{number}")
    return docs
