"""Registered queries of this folder, one per operator, over the driver's tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from voltaria.llm import oracles
from voltaria.llm.align import align
from voltaria.llm.bpe import vocabulary
from voltaria.llm.count import token_counts
from voltaria.llm.encode import encode
from voltaria.llm.iblt import fingerprints
from voltaria.llm.jaccard import jaccard_join
from voltaria.llm.langid import identify
from voltaria.llm.paragraphs import duplicates
from voltaria.llm.secrets_scan import scan
from voltaria.llm.sharding import shards
from voltaria.llm.ship import ship
from voltaria.llm.suffixes import repeated_bytes
from voltaria.llm.template import extract
from voltaria.llm.tiling import contaminated
from voltaria.llm.whiten import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op3_rendezvous_shards": oracles.SHARDS, "op8_jaccard_join": oracles.JACCARD}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(run)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = shipped
    return shipped


@_query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked groups of documents at five words and 0.8."""
    return jaccard_join(_table(spark, sf_dir, "documents"))


@_query
def op4_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the labelled documents that are not held out."""
    return identify(_table(spark, sf_dir, "documents"))


@_query
def op2_tree_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and their decoding, as digests."""
    return encode(_table(spark, sf_dir, "documents"), vocabulary())


@_query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return token_counts(_table(spark, sf_dir, "documents"), vocabulary())


@_query
def op10_tiled_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, with the share covered."""
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op1_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs and passages of documents that other documents keep."""
    return duplicates(_table(spark, sf_dir, "documents"))


@_query
def op3_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 7 of all documents."""
    return shards(_table(spark, sf_dir, "documents"))


@_query
def op7_template_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(_table(spark, sf_dir, "pages"))


@_query
def op6_paragraph_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every document and its edited text, and likenesses recovered from them."""
    return fingerprints(_table(spark, sf_dir, "documents"))


@_query
def op5_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that 200-byte strings found elsewhere cover."""
    return repeated_bytes(_table(spark, sf_dir, "documents"))


@_query
def op11_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the 16 leading components, whitened."""
    return whiten(_table(spark, sf_dir, "embeddings"))


@_query
def op12_novel_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, by pattern and by novelty."""
    return scan(_table(spark, sf_dir, "documents"))


@_query
def op13_lockstep_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers, for every document."""
    return align(_table(spark, sf_dir, "documents"), vocabulary(), vocabulary("piece_bpe_32k.model"))
