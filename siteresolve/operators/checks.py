"""Checks of what a run delivers: counts observed on the write itself, reconciled across tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import blank

# Columns that a labelling task must have, and the decisions that it may hold.
TASK_FIELDS = ["provider_id", "provider_name", "provider_detail_url", "review_reason", "candidate_url", "official_url", "manual_decision", "manual_url", "notes", "review_instruction", "optimization_use"]
TASK_DECISIONS = ["accept", "replace", "reject", "unsure"]
UNRESOLVED = ["unresolved", "rejected", "invalid_manual_decision"]
FAILURE = "check string, found long, expected long"


def observed_write(rows: DataFrame, path: str, counts: dict[str, Column]) -> dict[str, int]:
    """Writes ``rows`` as Parquet; how many there are (rows) and how many meet each condition, counted in that same pass."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counts.items()]).write.mode("overwrite").parquet(path)
    return {k: int(v) for k, v in seen.get.items()}


def _filled(c: str) -> Column:
    return F.trim(blank(F.col(c).cast("string"))) != ""


def _failures(spark, rules: list[tuple[str, int, int]]) -> DataFrame:
    return spark.createDataFrame([r for r in rules if r[1] != r[2]], FAILURE)


def output_checks(final: DataFrame, unresolved: DataFrame, gate: DataFrame | None, folder: str, expected_rows: int | None = None, expected_unresolved: int | None = None) -> DataFrame:
    """Writes final and unresolved rows below ``folder``; a row (check, found, expected) for each check that fails.

    Checked: both numbers against what was expected, unresolved rows against those of the final table, rows without a detail address, and the gate's row (``quality_gate``; left out if None):
    its failures, excluded, repeated and malformed addresses, its number of rows.
    """
    a = observed_write(final, f"{folder}/final", {"open": (blank(F.col("official_url")) == "") | F.col("status").isin(UNRESOLVED), "detailed": _filled("provider_detail_url")})
    b = observed_write(unresolved, f"{folder}/unresolved", {})
    rules = [("unresolved_csv_rows", b["rows"], a["open"]), ("missing_provider_detail_url_rows", a["rows"] - a["detailed"], 0)]
    if expected_rows is not None:
        rules.append(("final_rows", a["rows"], expected_rows))
    if expected_unresolved is not None:
        rules.append(("unresolved_rows", b["rows"], expected_unresolved))
    one = gate.first() if gate is not None else None
    if one is not None:
        rules += [("quality_gate", int(one["failures"] != ""), 0), ("excluded_official_url_rows", one["excluded_urls"], 0), ("duplicate_provider_ids", one["duplicate_ids"], 0), ("malformed_official_url_rows", one["malformed_urls"], 0)]
        if expected_rows is not None:
            rules.append(("quality_total_rows", one["rows"], expected_rows))
    return _failures(final.sparkSession, rules)


def task_checks(task: DataFrame, folder: str, summary: DataFrame | None = None, allow_filled: bool = False, require_filled: bool = False) -> DataFrame:
    """Writes a labelling task to ``folder``; a row (check, found, expected) for each check that fails.

    ``summary``: review_reason, n, as counted where the task was made. ``allow_filled``: decisions may be there, and must be valid; ``require_filled``: each row must have one.
    Repeated keys of provider and reason take one grouped count, the comparison with the summary another; all else is counted on the write.
    """
    spark = task.sparkSession
    missing = [c for c in TASK_FIELDS if c not in task.columns]
    rows = task.withColumns({c: F.lit("") for c in missing})
    decision = F.lower(F.trim(blank(F.col("manual_decision"))))
    n = observed_write(
        rows,
        folder,
        {
            "no_detail": ~_filled("provider_detail_url"),
            "no_address": ~_filled("candidate_url") & ~_filled("official_url"),
            "filled": decision != "",
            "invalid": (decision != "") & ~decision.isin(TASK_DECISIONS),
            "no_replacement": (decision == "replace") & ~_filled("manual_url"),
        },
    )
    keys = rows.filter(_filled("provider_id") & _filled("review_reason")).groupBy(F.trim("provider_id"), F.trim("review_reason")).agg(F.count(F.lit(1)).alias("n"))
    rules = [("required_fields", len(missing), 0), ("duplicate_provider_reason", keys.filter("n > 1").count(), 0), ("provider_detail_url", n["no_detail"], 0), ("candidate_or_official_url", n["no_address"], 0)]
    allow_filled = allow_filled or require_filled
    if not allow_filled:
        rules.append(("manual_decision_blank", n["filled"], 0))
    if require_filled:
        rules.append(("manual_decision_required", n["rows"] - n["filled"], 0))
    if allow_filled:
        rules += [("invalid_manual_decision", n["invalid"], 0), ("replace_missing_manual_url", n["no_replacement"], 0)]
    if summary is not None:
        given = summary.groupBy(blank(F.col("review_reason")).alias("reason")).agg(F.sum("n").alias("given"))
        counted = rows.groupBy(blank(F.col("review_reason")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
        both = counted.join(given, "reason", "full").agg(F.coalesce(F.sum("given"), F.lit(0)).alias("given"), F.count_if(F.coalesce("n", F.lit(0)) != F.coalesce("given", F.lit(0))).alias("off")).first()
        rules += [("summary_task_rows", n["rows"], both["given"]), ("summary_reason_counts", both["off"], 0)]
    return _failures(spark, rules)
