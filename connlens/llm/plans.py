"""Registered queries of the subpackage, each with production parameters over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from connlens.llm import bpe, licences, manifest, mixing, neighbours, quality, secrets, simhash, substrings, tokenfiles, toxicity, urls, whitening
from connlens.sources.storage import read_table


def op1_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(read_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op2_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scanned(read_table(spark, folder, "documents"))


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(read_table(spark, folder, "pages"))


def op4_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.takes(read_table(spark, folder, "documents"))


def op5_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(read_table(spark, folder, "embeddings"))


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokenfiles.round_trip(read_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return secrets.scanned(read_table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def op8_simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_components(read_table(spark, folder, "documents"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op10_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeats(read_table(spark, folder, "documents"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.proofs(read_table(spark, folder, "documents"))


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = whitening.whitened(read_table(spark, folder, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.judged(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


QUERIES = {
    "op1_bpe_round_trip": op1_bpe_round_trip,
    "op2_licence_scan": op2_licence_scan,
    "op3_url_filter": op3_url_filter,
    "op4_source_mix": op4_source_mix,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_token_files": op6_token_files,
    "op7_secret_scan": op7_secret_scan,
    "op8_simhash_components": op8_simhash_components,
    "op9_quality_rules": op9_quality_rules,
    "op10_repeated_passages": op10_repeated_passages,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_toxicity": op13_toxicity,
}
ORACLES: dict[str, str] = {
    "op2_licence_scan": licences.ORACLE,
    "op3_url_filter": urls.ORACLE,
    "op4_source_mix": mixing.ORACLE,
    "op9_quality_rules": quality.ORACLE,
    "op10_repeated_passages": substrings.ORACLE,
    "op11_merkle_manifest": manifest.ORACLE,
}
