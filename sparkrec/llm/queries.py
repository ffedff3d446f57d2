"""Registered queries of the subpackage: (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkrec.llm.fill_in_middle import digests, fill_in_middle
from sparkrec.llm.licenses import scan
from sparkrec.llm.metric_join import near_vectors
from sparkrec.llm.minhash import near_duplicates
from sparkrec.llm.oracles import SQL
from sparkrec.llm.packing import pack
from sparkrec.llm.pieces import segment_texts
from sparkrec.llm.pii import personal_data
from sparkrec.llm.prefix_trie import trie
from sparkrec.llm.quality import quality
from sparkrec.llm.sharding import shard
from sparkrec.llm.suffix_dedup import repeated_bytes
from sparkrec.llm.token_counts import count_tokens
from sparkrec.llm.toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = dict(SQL)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under byte_bpe_50k."""
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in bins of four permitted lengths."""
    return pack(table(spark, sf_dir, "documents"))


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without its repeated 100-byte strings."""
    return repeated_bytes(table(spark, sf_dir, "documents"))


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and line-first verdict of every document."""
    return quality(table(spark, sf_dir, "documents")).drop("clean_text")


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and secrets of every document."""
    return personal_data(table(spark, sf_dir, "documents"))


@query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmed licenses of every document."""
    return scan(table(spark, sf_dir, "documents"))


@query
def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four best segmentations of every document under piece_bpe_32k."""
    return segment_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels that are not held out."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of the embeddings of each label."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of the documents' two-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=2)


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of the rebuilt conversations."""
    return trie(table(spark, sf_dir, "conversations"))


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at line ends and rearranged, as digests."""
    return digests(fill_in_middle(table(spark, sf_dir, "documents")))


@query
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard among 24, and among 25."""
    return shard(table(spark, sf_dir, "documents"), shards=24)
