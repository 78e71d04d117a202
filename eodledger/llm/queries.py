"""The registered queries of the training-data operators, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eodledger.llm import (
    bpe,
    checks,
    collocations,
    merkle,
    mixing,
    pii,
    quality_model,
    quality_rules,
    secrets,
    simhash,
    substrings,
    token_counts,
    topk,
    toxicity,
)
from eodledger.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}

#: Target weights of the sources: whole-number shares, one for every source that is not named.
WEIGHTS = {"src0": 6, "src1": 3, "src2": 3, "src3": 2, "src4": 2}
#: Vocabularies, which every machine of a cluster has at the same place.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_pfair_mix(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "source")
    found = mixing.positions(documents, WEIGHTS)
    return found.select("doc_id", "source", F.col(f"{found.columns[-1]}.*"))


@query
def op2_quality_votes(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents"))


@query
def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"), RANKS, PATTERN)


@query
def op4_bpe_cuts(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), WORD_BPE)


@query
def op5_toxic_windows(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op6_simhash_tiles(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op7_pii_boosted(spark: SparkSession, folder: str) -> DataFrame:
    return pii.scan(table(spark, folder, "documents"))


@query
def op8_bit_sliced_top(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"))


@query
def op9_separator_scan(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), WORD_BPE)


@query
def op10_indexed_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_model.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


#: What a leaf of the manifest is made of.
LEAF = ("doc_id", "source", "lang", "n_chars", "text")


@query
def op11_merkle_proofs(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.verified(table(spark, folder, "documents"), LEAF)


@query
def op12_cover_anchors(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeats(table(spark, folder, "documents"), digest=True)


@query
def op13_phrase_streams(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


CHECKS |= {
    "op1_pfair_mix": checks.mix(WEIGHTS),
    "op2_quality_votes": checks.quality(),
    "op8_bit_sliced_top": checks.TOP_K,
    "op11_merkle_proofs": checks.MANIFEST,
    "op12_cover_anchors": checks.REPEATS,
    "op13_phrase_streams": checks.COLLOCATIONS,
}
