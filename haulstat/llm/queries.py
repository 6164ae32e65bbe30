"""One registered query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from haulstat.llm import merkle, mixing, preference, sharding, token_store, whitening
from haulstat.llm.common import shared_path, ship, table
from haulstat.llm.decontamination import decontamination
from haulstat.llm.language_id import language_id
from haulstat.llm.licenses import license_scan
from haulstat.llm.ngram_join import ngram_join
from haulstat.llm.pii import personal_data
from haulstat.llm.quality_classifier import quality_classifier
from haulstat.llm.quality_rules import quality_rules


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids, read back from the store that was written."""
    path = shared_path(spark, "token-store")
    token_store.write(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return token_store.digests(spark, path)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharding(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing(table(spark, sf_dir, "documents"))


def op6_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.preferences(table(spark, sf_dir, "conversations"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.component_rows(table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered_manifest(table(spark, sf_dir, "documents"))


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: shipped(f) for f in (
        op1_token_store, op2_language_id, op3_sharding, op4_quality_rules, op5_mixing, op6_preference,
        op7_quality_classifier, op8_ngram_join, op9_decontamination, op10_pii, op11_license_scan, op12_embedding_whitening, op13_merkle_manifest)}

#: DuckDB SQL twins of the queries that SQL can express.
SQL: dict[str, str] = {
    "op3_sharding": sharding.oracle(), "op5_mixing": mixing.oracle(), "op6_preference": preference.oracle()}
