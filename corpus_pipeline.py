"""The training-data pipeline: documents through five operators, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eodledger.llm import bpe, mixing, quality_rules, secrets, simhash
from eodledger.llm.queries import PATTERN, RANKS, WEIGHTS, WORD_BPE, table
from eodledger.session import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that the rules reject go."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6, with its contract's three-word shingles and three bits: of each component the smallest id stays."""
    return simhash.drop_near_duplicates(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: secrets are replaced in the texts; every document stays."""
    return secrets.redact(docs, RANKS, PATTERN, length="n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents are put into the order of the mix; every document stays.

    Its decision is the order of the rows, which the files keep: ``encode`` takes the places from there.
    """
    return mixing.mixed(docs, WEIGHTS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: ids of each text, the digests of the ids and of what they decode to, and the place in the mix.

    ``place`` numbers the rows as they come from the mix stage. Slots and positions, which have gaps where
    a source has run out, are those of each source's documents in that same order.
    """
    rows = mixing.arrived(docs.select("doc_id", "source", "text"), "come")
    done = stored(bpe.digests(rows, WORD_BPE, keep=("doc_id", "source", "come"), with_ids=True), "encoded")
    placed = mixing.positions(mixing.numbered_rows(done, "come", "place"), WEIGHTS, order="place")
    return placed.select("doc_id", "source", f"{placed.columns[-1]}.*", "place", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("secret scan", secret_scan),
    ("mix", mix),
    ("encode", encode),
]

#: The hashes behind the fingerprints are not among DuckDB's functions; tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written to the shared folder and read again.

    The rows come in the order in which the mix stage has put them.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs.orderBy("place")
