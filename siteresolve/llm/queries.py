"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversations, decontam, exact_dedup, filter_audit, langid, pii, rans, secrets, sp_dropout, substring, superminhash, token_counts, warc
from .common import table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"), words=tokenizer_file("byte_bpe_50k.json"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="max")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_dropout.encode_documents(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(table(spark, sf_dir, "documents"), size=13).drop("kept")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), limit=512)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_groups(table(spark, sf_dir, "documents"), k=3, num=85, den=100)


def op9_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages"), least=100)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.token_files(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=2)


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.digests(conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_secret_scan,
        op2_decontamination,
        op3_exact_dedup,
        op4_language_id,
        op5_sentencepiece,
        op6_substring_dedup,
        op7_token_counts,
        op8_near_dedup,
        op9_warc_index,
        op10_token_files,
        op11_pii,
        op12_filter_audit,
        op13_conversation_repair,
    )
}
ORACLES: dict[str, str] = {"op3_exact_dedup": exact_dedup.ORACLE, "op9_warc_index": warc.ORACLE, "op12_filter_audit": filter_audit.ORACLE, "op13_conversation_repair": conversations.ORACLE}
