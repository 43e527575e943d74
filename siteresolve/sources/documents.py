"""JSON documents of other tools as tables: pattern files of several layouts, and evidence lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import blank, first_filled
from ..operators.patterns import AND, canonical
from ..operators.providers import entity_key

# Where pattern files keep their lists, in the order in which they count.
LISTS = ["durable_safe_patterns", "actionable_safe_patterns", "all_patterns", "candidate_for_rule", "needs_more_labels", "reject_pattern"]
RULE_LISTS = "pattern_rule_candidates"
RELEASE_LISTS = ["selected_actionable_pattern_set", "actionable_safe_patterns", "safe_patterns", "candidate_for_rule"]


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """file, value: the files of a folder or pattern as one text each."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")


def _items(files: DataFrame, lists: list[str], rule_lists: list[str] | None) -> DataFrame:
    """file, scope, place (list, item) and item of each pattern in ``lists`` and then in the lists under RULE_LISTS (all, by name, or the named ones). What isn't JSON, a list or an object gives nothing."""
    doc = files.select("file", F.try_parse_json("value").alias("doc"))
    at = lambda p: F.try_variant_get("doc", f"$.{p}", "array<variant>")
    named = [F.struct(F.lit(k).alias("k"), at(p).alias("items")) for k, p in enumerate(lists)]
    under = F.map_entries(F.try_variant_get("doc", f"$.{RULE_LISTS}", "map<string, variant>"))
    kept = F.coalesce(under, F.array().cast("array<struct<key: string, value: variant>>"))
    if rule_lists is not None:
        kept = F.filter(kept, lambda e: e["key"].isin(rule_lists))
    rules = F.transform(kept, lambda e, i: F.struct((i + len(lists)).alias("k"), F.try_variant_get(e["value"], "$", "array<variant>").alias("items")))
    each = doc.select("file", "doc", F.explode(F.concat(F.array(*named), rules)).alias("l")).select("file", "doc", "l.k", F.posexplode("l.items").alias("i", "item"))
    return each.select("file", blank(F.try_variant_get("doc", "$.summary.scope", "string")).alias("file_scope"), F.struct("file", "k", "i").alias("place"), "item").filter(F.schema_of_variant("item").startswith("OBJECT"))


def _text(name: str) -> Column:
    return F.trim(blank(F.try_variant_get("item", f"$.{name}", "string")))


def _count(*names: str) -> Column:
    """The first of the fields that is a number other than 0, without its fraction."""
    numbers = [F.try_variant_get("item", f"$.{n}", "string").try_cast("double").try_cast("long") for n in names]
    return F.coalesce(*[F.nullif(x, F.lit(0)) for x in numbers], F.lit(0))


def _read(items: DataFrame) -> DataFrame:
    listed = F.transform(F.try_variant_get("item", "$.features", "array<variant>"), lambda x: F.trim(blank(F.try_variant_get(x, "$", "string"))))
    named = F.transform(F.split(_text("pattern"), AND), lambda x: F.trim(x))
    rows = items.withColumn("features", canonical(F.filter(F.coalesce(listed, named), lambda x: x != ""))).filter(F.size("features") > 0)
    return rows.withColumn("pattern", F.when(_text("pattern") != "", _text("pattern")).otherwise(F.array_join("features", AND)))


def pattern_table(files: DataFrame, default_scope: str = "recall") -> DataFrame:
    """pattern, features, scope, source_support_rows, source_wrong_rows of all patterns in ``files`` (file, value); of equal scopes and feature sets the first by file and place."""
    rows = _read(_items(files, LISTS, None)).withColumn("scope", first_filled(_text("pattern_scope"), _text("scope"), F.col("file_scope"), F.lit(default_scope)))
    made = rows.select("scope", "features", "place", "pattern", _count("support_rows", "supporting_rows", "correct_recovery_rows").alias("source_support_rows"), _count("wrong_release_rows", "blocking_rows").alias("source_wrong_rows"))
    first = made.groupBy("scope", "features").agg(F.min_by(F.struct("pattern", "source_support_rows", "source_wrong_rows"), "place").alias("p"))
    return first.select("p.pattern", "features", "scope", "p.source_support_rows", "p.source_wrong_rows")


def release_patterns(files: DataFrame, with_unsafe: bool = False) -> DataFrame:
    """pattern, features, correct_recovery_rows, wrong_release_rows, actionable and pattern_pos, their order: most recovered rows first, then fewest wrong, then fewest features, then as they came.

    A file's selected set counts instead of its actionable patterns where it has one; other safe ones count ``with_unsafe``. Of equal feature sets the first by file and place counts.
    The order takes one row a distinct feature set.
    """
    items = _items(files, RELEASE_LISTS, ["candidate_for_rule"])
    if not with_unsafe:
        items = items.filter(F.col("place.k") != RELEASE_LISTS.index("safe_patterns"))
    chosen = files.select(F.col("file").alias("f"), F.try_variant_get(F.try_parse_json("value"), "$.selected_actionable_pattern_set", "array<variant>").isNotNull().alias("chosen"))
    items = items.join(chosen, items["file"] == chosen["f"]).filter(~(F.col("chosen") & (F.col("place.k") == RELEASE_LISTS.index("actionable_safe_patterns"))))
    actionable = F.coalesce(F.try_variant_get("item", "$.actionable", "boolean"), F.lit(True))
    made = _read(items).select("features", "place", "pattern", _count("correct_recovery_rows", "supporting_rows").alias("correct_recovery_rows"), _count("wrong_release_rows", "blocking_rows").alias("wrong_release_rows"), actionable.alias("actionable"))
    first = made.groupBy("features").agg(F.min_by(F.struct("pattern", "correct_recovery_rows", "wrong_release_rows", "actionable", "place"), "place").alias("p")).select("features", "p.*")
    order = Window.orderBy(F.desc("correct_recovery_rows"), "wrong_release_rows", F.size("features"), "place")
    return first.withColumn("pattern_pos", F.row_number().over(order) - 1).drop("place")


EVIDENCE = """provider_id string, provider_name string, candidate_count long, scored_candidate_count long,
    candidates array<struct<url: string, domain: string, score: long, reject: boolean, reasons: array<string>, source: string, query: string, rank: long, page_title: string, evidence_url: string>>"""
BROKEN = "broken_line"


def evidence_lines(spark: SparkSession, path: str) -> DataFrame:
    """EVIDENCE columns, one row a line of JSON with its candidates nested, and BROKEN: the line as it is where it isn't such an object, else null. Blank lines are skipped, other fields ignored."""
    lines = spark.read.text(path).select(F.col("value"), F.col("_metadata.file_path").alias("file")).filter(F.trim(F.regexp_replace("value", "[\\t\\r\\u00a0\\ufeff]", " ")) != "")
    parsed = F.from_json(F.regexp_replace("value", "^\\ufeff", ""), f"{EVIDENCE}, {BROKEN} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    return lines.select(parsed.alias("x"), "file").select("x.*", "file", F.monotonically_increasing_id().alias("pos"))


def sound_and_broken(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Evidence rows without a broken line, and the broken lines (file, pos, line)."""
    return lines.filter(F.col(BROKEN).isNull()).drop(BROKEN), lines.filter(F.col(BROKEN).isNotNull()).select("file", "pos", F.col(BROKEN).alias("line"))


def with_evidence(rows: DataFrame, evidence: DataFrame, pos: str = "pos") -> DataFrame:
    """``rows`` with candidates and candidate_count of their evidence: the last record with their id, or for rows without an id the last with their name in any case; none gives an empty list and 0."""
    last = evidence.withColumn("__k", entity_key()).filter("__k <> ''").groupBy("__k").agg(F.max_by(F.struct("candidates", "candidate_count"), pos).alias("__e"))
    by_name = evidence.withColumn("__k", F.concat(F.lit("name:"), F.lower(F.trim(blank(F.col("provider_name")))))).filter("__k <> 'name:'").groupBy("__k").agg(F.max_by(F.struct("candidates", "candidate_count"), pos).alias("__e"))
    table = last.filter("__k LIKE 'id:%'").unionByName(by_name)
    found = rows.withColumn("__key", entity_key()).join(table, F.col("__key") == F.col("__k"), "left")
    none = F.array().cast(evidence.schema["candidates"].dataType)
    return found.select(*rows.columns, F.coalesce("__e.candidates", none).alias("candidates"), F.coalesce("__e.candidate_count", F.lit(0)).alias("candidate_count"))


def write_evidence(records: DataFrame, path: str) -> None:
    """One line of JSON a record, nulls left out."""
    records.select(*[c.strip().split(" ")[0] for c in ("provider_id", "provider_name", "candidate_count", "scored_candidate_count", "candidates")]).write.mode("overwrite").json(path)
