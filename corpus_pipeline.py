"""The cleaning pipeline over ``documents``: quality rules, exact and near copies, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on every row its predecessor kept; all but the last
return the columns of ``documents``. Between stages the rows are written as Parquet and read again.
Null, empty, repeated and very long texts have the results their operators define; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusq.llm import exact_dedup, near_copies, packing, pii, quality_rules
from corpusq.llm.common import read_table, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that fail and documents that lose too much or fail the base rules."""
    return quality_rules.clean_documents(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the smallest doc_id stays: five-word shingles, similarity of 0.8 or more."""
    return near_copies.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of the packed documents."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("simhash_near_dedup", near), ("pii", personal_data), ("best_fit_packing", pack)]
#: Fingerprints, components and tokens have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
