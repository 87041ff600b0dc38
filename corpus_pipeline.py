"""Corpus pipeline over ``documents`` (counted as part of ``ember.llm``).

Each stage takes the rows that its predecessor kept and returns the columns of
``documents``; the last returns the token ids of every row. Stages:

1. quality classifier: rows scored under 0.3 go;
2. exact dedup: of equal texts the row with the largest id stays;
3. MinHash near-dedup: of each group of similar texts the least id stays;
4. source mixing: each row is repeated as often as the mix takes it;
5. SentencePiece: ids of every row, with digests of ids and decoded text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ember.llm import exact_dedup, mixture, near_dup, pieces, quality
from ember.llm.common import materialize, table
from ember.llm.queries import ORACLES as LLM_ORACLES
from ember.llm.queries import QUERIES as LLM_QUERIES

ORACLE_SQL = None  # stages 1 and 4 are a trained model and a random draw


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted_rows(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.kept_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.kept_rows(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixture.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), outputs=("ids",))


STAGES = [
    ("quality_classifier", accept),
    ("exact_dedup", drop_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


LLM_QUERIES = {**LLM_QUERIES, "pipeline": run}
if ORACLE_SQL:
    LLM_ORACLES = {**LLM_ORACLES, "pipeline": ORACLE_SQL}
