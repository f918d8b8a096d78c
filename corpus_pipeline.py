"""Corpus pipeline: documents in, token ids of the mix out.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickforge.llm import bpe, exact_dedup, langid, minhash, mixing
from tickforge.llm.common import stored, table, work_dir

#: No SQL: language ID, MinHash and the mix have no SQL form; tests/llm compares the
#: stages with brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has no language go: null, or without a letter."""
    return langid.drop_unidentified(spark, docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the longest stays, then the smallest doc_id."""
    return exact_dedup.keep_first(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more, the smallest doc_id stays."""
    return minhash.keep_one(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated or left out so that sources come near their target weights."""
    return mixing.repeat(spark, docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the texts, with digests of ids and decoded text."""
    return bpe.encode_documents(spark, docs, bpe.default_path())


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored in the shared folder."""
    path = work_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{path}/{i}-{name}")
    return docs
