"""Sources and sinks: provider tables, saved search responses, evidence records, label files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank, compact, json_list, whole_number
from ..operators.providers import valid_rows

NORMALIZED = ["provider_id", "provider_name", "service_apis", "provider_locations", "provider_languages", "service_types", "detail_url", "source_rows"]
LISTS = ["service_apis", "provider_locations", "provider_languages", "service_types"]
FINAL_FIELDS = [
    "provider_id", "provider_name", "provider_detail_url", "listing_logo_url", "official_url", "official_domain", "status", "decision_source", "confidence", "source_status", "evidence_summary",
    "candidate_count", "scored_candidate_count", "service_apis", "provider_locations", "notes",
]
# Parts of the names of label files that are trusted.
TRUSTED_MARKERS = ("manual_review_combined_decisions", "agent_human_review_regression_cases", "agent_no_official_regression_cases")

# Where each kind of saved response has its results, and what their fields are called: address, title, snippet.
LAYOUTS = {
    "serpapi": ("organic_results", "link", "title", "snippet"),
    "brave": ("web.results", "url", "title", "description"),
    "tavily": ("results", "url", "title", "content"),
    "serper": ("organic", "link", "title", "snippet"),
    "firecrawl": ("data.web", "url", "title", "description"),
    "exa": ("results", "url", "title", "text"),
    "ddgs": ("results", "href", "title", "body"),
}
LONG_SNIPPETS = ("tavily", "firecrawl", "exa")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, quoted line breaks and perhaps a byte-order mark; all columns are strings, missing cells empty."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8")
    names = [c.lstrip("﻿") for c in df.columns]
    return df.toDF(*names).na.fill("")


def read_providers(spark: SparkSession, path: str) -> DataFrame:
    """Raw directory rows without description lines, with their input order in ``pos``."""
    return valid_rows(read_csv(spark, path).withColumn("pos", F.monotonically_increasing_id()))


def is_normalized(df: DataFrame) -> bool:
    return set(df.columns) >= set(NORMALIZED)


def read_normalized(df: DataFrame) -> DataFrame:
    """JSON list columns as arrays, source_rows as a number, detail_urls from detail_url."""
    detail = blank(F.col("detail_url"))
    return df.withColumns({c: json_list(F.col(c)) for c in LISTS}).withColumns({"source_rows": whole_number(F.col("source_rows")), "detail_urls": F.when(detail != "", F.array(detail)).otherwise(F.array().cast("array<string>"))})


def to_normalized(df: DataFrame) -> DataFrame:
    """The reverse: arrays as JSON text, the first detail address, fixed columns."""
    rows = df.withColumns({c: F.to_json(F.coalesce(c, F.array().cast("array<string>"))) for c in LISTS}).withColumn("detail_url", F.coalesce(F.get("detail_urls", F.lit(0)), F.lit("")))
    return rows.select(NORMALIZED)


def search_candidates(responses: DataFrame, source: str, per_query: int = 3) -> DataFrame:
    """Saved JSON responses (provider_id, query, response) as candidate rows with ranks from 1."""
    where, url, title, snippet = LAYOUTS[source]
    item = f"struct<{url}: string, {title}: string, {snippet}: string" + (", summary: string, highlights: array<string>>" if source == "exa" else ", url: string>" if source == "ddgs" else ">")
    first, *deeper = where.split(".")
    shape = f"array<{item}>"
    for part in reversed(deeper):
        shape = f"struct<{part}: {shape}>"
    listed = F.from_json("response", f"`{first}` {shape}")[first]
    for part in deeper:
        listed = listed[part]
    rows = responses.select("provider_id", "query", F.posexplode(F.slice(listed, 1, per_query)).alias("k", "x"))
    said: Column = blank(F.col(f"x.{snippet}"))
    if source == "exa":
        said = compact(F.concat_ws(" ", "x.summary", f"x.{snippet}", F.array_join(F.coalesce("x.highlights", F.array().cast("array<string>")), " ")))
    if source in LONG_SNIPPETS:
        said = F.substring(said, 1, 1000)
    address = F.coalesce(F.nullif(blank(F.col(f"x.{url}")), F.lit("")), F.col("x.url"), F.lit("")) if source == "ddgs" else blank(F.col(f"x.{url}"))
    return rows.select("provider_id", "query", address.alias("url"), blank(F.col(f"x.{title}")).alias("title"), said.alias("snippet"), F.lit(source).alias("source"), (F.col("k") + 1).alias("rank"))


def crawl_lookup(candidates: DataFrame, crawl: DataFrame) -> DataFrame:
    """Candidates with the crawl's page record of their address, nulls where there is none."""
    return candidates.join(crawl, "url", "left")


def evidence_records(results: DataFrame, scored: DataFrame) -> DataFrame:
    """One nested record per provider: its result and all scored candidates in order."""
    nested = scored.groupBy("provider_id").agg(F.sort_array(F.collect_list(F.struct("pos", "url", "domain", "score", "reject", "reasons"))).alias("candidates"))
    return results.join(nested, "provider_id", "left")


def write_final(final: DataFrame, path: str) -> None:
    """The delivery table: fixed columns, missing ones empty, others left out."""
    final.select(*[(F.col(c).cast("string") if c in final.columns else F.lit("")).alias(c) for c in FINAL_FIELDS]).write.mode("overwrite").parquet(path)


def trusted_labels(spark: SparkSession, folder: str, markers: tuple[str, ...] = TRUSTED_MARKERS) -> DataFrame:
    """Label rows of all CSV files below a folder whose name has a trusted marker, with their source path."""
    df = spark.read.option("recursiveFileLookup", "true").csv(folder, header=True, multiLine=True, escape='"', pathGlobFilter="*.csv")
    name = F.lower(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    ok = F.lit(False)
    for m in markers:
        ok = ok | name.contains(m)
    return df.withColumn("label_source_path", F.col("_metadata.file_path")).filter(ok)
