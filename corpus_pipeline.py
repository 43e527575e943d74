"""The corpus pipeline: documents in, token ids of the documents worth training on out.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and its result is
written as Parquet and read again as the next one's documents. All but the last return the columns
of ``documents``, and drop others. SQL can't express the stages, so ORACLE_SQL is None; tests hold
run() against a brute-force version.

Every stage decides on rows, not on ids: rows get numbers of their own first, so rows that share an
id, and rows with a null id, come and go by their own texts. Null, empty and letterless texts go in
the first stage. Rows repeated whole are exact copies: one stays. Of rows that tie by id, one of them
stays. An empty table gives an empty result in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteresolve.llm import decontam, exact_dedup, langid, sp_dropout, superminhash
from siteresolve.llm.common import durable, size_checked, table
from siteresolve.llm.queries import tokenizer_file

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with __row, a number for each row, written so that numbers stay."""
    return durable(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("__row")), "numbered")


def _without(rows: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """``rows`` without the numbers in ``gone``, which may repeat."""
    gone = durable(gone.select(F.col("__row").alias("__gone")).distinct(), name)
    return rows.join(size_checked(gone, 16), rows["__row"] == gone["__gone"], "left_anti").select(COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the compressors tell; those without letters, or with a narrow margin, go."""
    return langid.classify(docs.select(COLUMNS), langid.dictionaries(docs)).filter("accepted").select(COLUMNS)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts the one with the largest id stays; null ids come last."""
    rows = _numbered(docs)
    groups = exact_dedup.exact_groups(rows.select(F.struct("doc_id", "__row").alias("key"), "text"), id_col="key", keep="max")
    return _without(rows, groups.filter("not kept").select("key.__row"), "exact-gone")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicate rows (five-word shingles, similarity of 0.8 or more) the one with the smallest id stays; null ids come last."""
    rows = _numbered(docs)
    groups = superminhash.near_groups(rows, k=5, num=80, den=100, id_col="__row").select("__row", "component_id")
    named = durable(groups.join(rows.select("__row", "doc_id"), "__row"), "near-named")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "__row"))
    stays = durable(named.groupBy("component_id").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "near-first")
    return _without(rows, named.join(stays, "component_id").filter("__row <> first.__row"), "near-gone")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    rows = _numbered(docs)
    found = decontam.leaks(rows, table(spark, sf_dir, "benchmark"), id_col="__row")
    return _without(rows, found.select(F.col("doc_id").alias("__row")), "leaks-gone")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids, ids_crc32, decoded_sha256, lossless of each document."""
    return sp_dropout.encode_documents(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", decontaminate),
    ("sentencepiece", token_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
