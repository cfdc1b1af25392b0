"""Registered queries of the subpackage: one per operator, production
parameters, whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (bagminhash, decontam, html, interactions, packing, passages, quality, secrets, sharding, tokengroups, tokens,
               urls, whitening)
from .common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return tokens.report(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.report(spark, sf_dir)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op10_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.report(table(spark, sf_dir, "documents"))


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.report(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokengroups.report(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {"op1_quality": op1_quality, "op2_decontaminate": op2_decontaminate,
           "op3_secrets": op3_secrets, "op4_packing": op4_packing, "op5_tokens": op5_tokens, "op6_main_text": op6_main_text,
           "op7_urls": op7_urls,
           "op8_sharding": op8_sharding, "op9_passages": op9_passages,
           "op10_near_documents": op10_near_documents, "op11_filter_audit": op11_filter_audit,
           "op12_ngram_join": op12_ngram_join, "op13_whitening": op13_whitening}
SQL = {"op1_quality": quality.SQL, "op2_decontaminate": decontam.SQL, "op7_urls": urls.SQL,
       "op11_filter_audit": interactions.SQL}
