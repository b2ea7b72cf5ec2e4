"""The operators of this subpackage as registered queries.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; each applies its
operator, with its defaults, to the whole of its table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    alignment,
    chat,
    fingerprints,
    licenses,
    links,
    mixing,
    packing,
    quality,
    search,
    sharding,
    simhash,
    spelling,
    warc,
)
from .shared import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_warc_chunks(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("target_uri")


@query
def op2_bm25_topk(spark, sf_dir):
    return search.similar_documents(table(spark, sf_dir, "documents"))


@query
def op3_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op4_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_source_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op6_chat_perspectives(spark, sf_dir):
    return chat.perspectives(table(spark, sf_dir, "conversations"))


@query
def op7_iblt_fingerprints(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return fingerprints.fingerprint_documents(docs, digests=fingerprints.sentences)


@query
def op8_uniform_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query
def op9_license_scan(spark, sf_dir):
    return licenses.scan_documents(table(spark, sf_dir, "documents"))


@query
def op10_quality_classifier(spark, sf_dir):
    return quality.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@query
def op11_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query
def op12_tokenizer_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return alignment.align_documents(docs, tokenizer_path(), tokenizer_path(PIECES))


@query
def op13_url_filter(spark, sf_dir):
    return links.judge_urls(table(spark, sf_dir, "pages"))
