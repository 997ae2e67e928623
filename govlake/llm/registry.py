"""The queries of this subpackage, one per operator and the pipeline, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (chat, decontaminate, hard_negatives, mixing, packing, quality, ranked, revisits, simhash, spotsigs,
               token_counts, token_files, url_rules)
from .oracle import ORACLE
from .shared import folder, table

__all__ = ["ORACLE", "QUERIES"]

#: Host, path and verdict of the rules that op7 judges by.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]

#: Both turns of conversation -7, which looks like the template's own marks.
HARD_TEXT = "\\### Assistant: </turn> ok"


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_pairs(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_counts(table(spark, sf_dir, "documents"),
                                        public_tokenizers.path("byte_bpe_50k.json"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.verdicts(table(spark, sf_dir, "pages"), url_rules.rule_table(spark, URL_RULES))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = folder(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), files, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read(spark, files)


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame([(-7, 0, "user", HARD_TEXT), (-7, 1, "assistant", HARD_TEXT)],
                                 "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_turns(turns.unionByName(hard)))


def op10_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisits.resolve(revisits.captures(table(spark, sf_dir, "pages")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_spotsigs, op2_token_counts, op3_simhash, op4_decontamination, op5_packing,
                              op6_quality, op7_url_rules, op8_token_files, op9_chat, op10_revisits, op11_hard_negatives,
                              op12_mixing, op13_ranked_search)
}
QUERIES["pipeline"] = corpus_pipeline.run
