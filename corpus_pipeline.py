"""The corpus pipeline: four of the operators, one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run` writes
it as Parquet into the shared folder and reads it back as the documents of the
next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import mixing, packing, quality, simhash
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.shared import stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: three-word shingles,
    two differing bits at most."""
    return simhash.keep_one(docs, shingle=3, distance=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, or the selected blocks of them, as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, ids included, with their places in sequences of 1024
    tokens. A document that the mix takes several times has as many copies."""
    return packing.pack_documents(docs, tokenizer_path(), with_ids=True)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

# A trained classifier cannot be said in SQL; the stages are tested against
# brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
