"""Corpus pipeline: documents in, packed sequences out.

Every stage works on all that the one before it kept.  All but the last return
the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import exact_dedup, langid, mixing, packing, simhash
from tillroll.llm.queries import vocabulary
from tillroll.session import cut_lineage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in which no language stands out, go."""
    return langid.keep_identified(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.keep_one_of_each(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the one with the smallest doc_id stays."""
    return simhash.keep_one_of_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0 to 3 times)."""
    return mixing.take_copies(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in the sequences."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [("language_id", language), ("exact_dedup", exact_copies), ("simhash_near_dedup", near_copies),
          ("mix_sources", mix), ("best_fit_packing", pack)]

# the network, the random rounding and the tokenizer are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; the tables
    leave the shared folder with ``release_tables``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
