"""A training-data pipeline over ``documents``: five stages, each one of the
operators in ``tollgate.llm``, applied to all that the stage before kept.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. Its result is
written as Parquet and reread as the next stage's documents, so that a lost
executor costs one stage at most. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import decontaminate, packing, quality_rules, simhash, suffix_dedup
from tollgate.llm.common import Written, read_table

SHINGLE, MAX_BITS = 3, 2
#: A passage of over 50 words counts as a repeat. 99 of 100 stretches of 51 words
#: (``documents`` at sf0.1) have 200 bytes or more, and half of them 304 or less,
#: so that at 400 bytes most passages just over 50 words would stay.
REPEAT_BYTES = 200
SEQUENCE_TOKENS = 2048


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of the rule ledger keeps."""
    return quality_rules.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.keep_one(docs, shingle=SHINGLE, radius=MAX_BITS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that stand elsewhere too; ``n_chars``, where
    there is such a column, follows the text. No document goes."""
    out = suffix_dedup.without_repeats(docs, length=REPEAT_BYTES)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark stands."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=SEQUENCE_TOKENS)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeats),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", sequences),
]

#: The byte-level and fingerprint stages are beyond SQL; tests/llm/ holds the
#: pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        out = Written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        docs = out.df
        if before:
            before.drop()
        before = out
    return docs
