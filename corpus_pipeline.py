"""From raw documents to packed training sequences: language, quality, near copies, packing."""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ordermill.llm import language, packing, quality, simhash  # noqa: E402
from ordermill.llm.queries import table, vocabulary  # noqa: E402
from ordermill.llm.shipping import ship  # noqa: E402
from ordermill.sources.scratch import materialize  # noqa: E402


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told apart; `und` and ambiguous ones go. Learned from these documents.

    Without any known language to learn from, only texts without letters go.
    """
    ship(spark)
    return language.keep_identified(docs, language.fit(docs))


def grade(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality. Learned from those of these documents that have a label."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return simhash.drop_near_copies(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens, with their ids."""
    ship(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), memo_words=100_000)


STAGES = [("language", identify), ("quality", grade), ("near copies", drop_copies), ("packing", pack)]

ORACLE_SQL = None  # learned models and a tokenizer; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each one's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
