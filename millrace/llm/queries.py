"""The queries of the corpus operators: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import alignment, exact_dedup, hard_negatives, licenses, minhash, packing, quality, sentencepiece_codec, sharding, simhash, substring_dedup, token_files, warc
from .common import read


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.assign(read(spark, sf_dir, "documents"))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(read(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.run(read(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.assign(read(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.measure(read(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(read(spark, sf_dir, "documents"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(read(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read(spark, sf_dir, "documents"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.assign(read(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"))


def all_queries() -> dict:
    return {
        "op1_sentencepiece": op1_sentencepiece,
        "op2_packing": op2_packing,
        "op3_simhash": op3_simhash,
        "op4_exact_dedup": op4_exact_dedup,
        "op5_warc": op5_warc,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_quality": op7_quality,
        "op8_licenses": op8_licenses,
        "op9_token_files": op9_token_files,
        "op10_sharding": op10_sharding,
        "op11_minhash": op11_minhash,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_alignment": op13_alignment,
    }
