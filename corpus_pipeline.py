"""The corpus pipeline: quality classifier, MinHash near-dedup, benchmark
decontamination, mixing to target weights, token-ID files.

Each stage is one operator of ``tessera.llm`` applied to all that its
predecessor kept; ``run`` writes what a stage returns as Parquet and reads it
again as the next one's documents.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, mixing, near_dedup, quality, token_files
from tessera.llm.common import documents, stored
from tessera.session import scratch_path

#: SQL can't express compressed sizes or the tokenizer; tests compare each stage with brute force.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the compression classifier accepts.  It learns from
    the given labels and their documents, and scores every row of ``docs``."""
    model = quality.learn(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no span of a benchmark item."""
    return decontaminate.drop_contaminated(docs, documents(spark, sf_dir, "benchmark"))


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: never, once or more."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from
    the token files that this stage writes to the shared scratch folder."""
    frames = token_files.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), scratch_path(spark, "pipeline-tokens"))
    return token_files.token_statistics(frames)


STAGES = [("quality", keep_quality), ("near_dedup", one_of_each), ("decontaminate", without_benchmark),
          ("mixing", to_weights), ("token_files", token_ids)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
