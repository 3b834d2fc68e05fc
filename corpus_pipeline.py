"""Corpus pipeline over ``documents``: quality rules, near-dedup, suffix-array dedup, decontamination, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``.  A stage judges what the stage before it kept.  Rows with null or repeated ids
pass through as the operators' docstrings say; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from govframe.llm import bpe, decontam, host_quality, minhash, suffix_dedup
from govframe.llm.common import cut_lineage
from govframe.llm.queries import BPE_FILE

#: Bytes of the strings whose repeats go: fifty words of five bytes, the space included, so that a passage of over fifty words
#: is one (in the test data 51 words of prose have about 300 bytes, at least 263).  The 400 bytes of ``op7`` would miss most of those.
PASSAGE_BYTES = 250

#: SQL cannot express byte-level BPE; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and whose host does."""
    return host_quality.keep_documents(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return minhash.keep_one(spark, docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of ``PASSAGE_BYTES`` bytes that start elsewhere too, their first copy included."""
    return suffix_dedup.strip_documents(spark, docs, PASSAGE_BYTES)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than traces of ``benchmark``."""
    return decontam.drop_contaminated(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each text that is left."""
    return bpe.encode_documents(spark, docs, public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN, digests=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("decontaminate", decontaminate),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each cut off from the work before it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(spark, stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
