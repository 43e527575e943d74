"""Regression cases from decided labels, the gate over an output, the overlay of cases on it, and releases and hold-outs by pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.text import append_note, blank, let
from .patterns import matches

BLOCKING = ["precision_blocking_fixture", "recall_blocking_fixture"]
POSITIVE = ["precision_positive_fixture", "recall_positive_fixture"]


def case_type(lane_kind: Column, outcome: Column) -> Column:
    recall = lane_kind == "recall"
    return (
        F.when(recall & (outcome == "recall_candidate_useful"), "recall_positive_fixture")
        .when(recall & (outcome == "recall_candidate_not_useful"), "recall_blocking_fixture")
        .when(outcome == "candidate_correct", "precision_positive_fixture")
        .when(outcome == "candidate_incorrect", "precision_blocking_fixture")
        .otherwise("")
    )


def build_cases(details: DataFrame) -> DataFrame:
    """Cases of decided labels without quality issues: the label's columns, case_type and expected_url."""
    c = lambda n: F.trim(blank(F.col(n)))
    replacement = c("normalized_manual_url")
    shown = F.when(c("calibration_outcome").isin("candidate_correct", "recall_candidate_useful"), F.coalesce(F.nullif(c("official_url"), F.lit("")), c("candidate_url"))).otherwise("")
    rows = details.filter((c("decision_quality_issue") == "") & ~c("normalized_decision").isin("", "unsure"))
    rows = rows.withColumns({"case_type": case_type(c("lane_kind"), c("calibration_outcome")), "expected_url": F.when(replacement != "", replacement).otherwise(shown)})
    return rows.filter("case_type <> ''")


def _blocked(prefix: str = "") -> Column:
    return F.trim(F.coalesce(F.nullif(blank(F.col(prefix + "candidate_url")), F.lit("")), blank(F.col(prefix + "official_url"))))


def gate(cases: DataFrame, output: DataFrame, pos: str = "pos") -> DataFrame:
    """Cases with observed_url, gate_result (pass, fail, unverified) and failure_reason, against the output's last row of the provider."""
    last = output.groupBy("provider_id").agg(F.max_by(F.struct(F.col("official_url").alias("url")), pos).alias("o"))
    rows = cases.join(last, "provider_id", "left").withColumn("observed_url", blank(F.col("o.url"))).withColumn("blocked_url", _blocked())
    seen, expected, blocked = F.col("observed_url"), blank(F.col("expected_url")), F.col("blocked_url")
    moved = (expected != "") & (seen != "") & ~urls.same_site(seen, expected)
    kind = F.col("case_type")
    fail = (
        F.when(F.col("o").isNull(), "provider_missing_from_candidate_output")
        .when(kind.isin(BLOCKING) & (seen != "") & urls.same_site(seen, blocked), "blocked_candidate_was_auto_accepted")
        .when(kind.isin(BLOCKING) & moved, "candidate_changed_away_from_blocked_url")
        .when(kind.isin(POSITIVE) & (seen == ""), "positive_fixture_over_rejected")
        .when(kind.isin(POSITIVE) & moved, "positive_fixture_changed_to_different_site")
        .otherwise("")
    )
    rows = rows.withColumn("failure_reason", fail)
    result = F.when(F.col("o").isNull(), "unverified").when(F.col("failure_reason").isin("", "candidate_changed_away_from_blocked_url"), "pass").otherwise("fail")
    return rows.withColumn("gate_result", result).drop("o")


def gate_summary(gated: DataFrame) -> DataFrame:
    """One row: cases, passes, failures, unverified, and the status they make."""
    n = lambda r: F.count_if(F.col("gate_result") == r)
    one = gated.agg(F.count(F.lit(1)).alias("cases"), n("pass").alias("passed"), n("fail").alias("failed"), n("unverified").alias("unverified"))
    return one.withColumn("gate_status", F.when(F.col("failed") > 0, "failed").when(F.col("unverified") > 0, "unverified").otherwise("passed"))


def apply_cases(output: DataFrame, cases: DataFrame, pos: str = "pos") -> DataFrame:
    """Each output row after its provider's cases, in order: replaced, blocked or restored addresses, status, decision source, notes, and the list of changes.

    A provider's cases are a handful; they are gathered per provider and folded into the row. Addresses are compared by their site keys: each case's are made once, before it is
    gathered, and the row carries the key of its address along, so the fold itself compares strings only.
    """
    kind, expected = F.col("case_type"), F.trim(blank(F.col("expected_url")))
    key_of_blocked = F.when(kind.isin(BLOCKING), urls.site_key(_blocked())).otherwise("")
    one = F.struct(F.col(pos).alias("p"), kind.alias("kind"), expected.alias("expected"), F.when(expected == "", "").otherwise(urls.site_key(expected)).alias("key"), key_of_blocked.alias("blocked"))
    listed = cases.filter(kind.isin(*BLOCKING, *POSITIVE)).groupBy("provider_id").agg(F.sort_array(F.collect_list(one)).alias("cases"))
    own = {"url": blank(F.col("official_url")), "status": blank(F.col("status")), "source": blank(F.col("decision_source")), "notes": blank(F.col("notes")), "changes": F.array().cast("array<string>")}
    rows = output.join(listed, "provider_id", "left").withColumn("__own", F.struct(*[c.alias(n) for n, c in own.items()], F.when(F.col("cases").isNotNull(), urls.site_key(own["url"])).otherwise("").alias("key")))

    def step(s: Column, x: Column) -> Column:
        same = s["key"] != ""
        away = (x["expected"] != "") & ~(same & (s["key"] == x["key"]))
        block = same & (s["key"] == x["blocked"])
        what = F.when(x["kind"].isin(BLOCKING), F.when(away, "replace").when(block, "block")).when(away, "positive")

        def after(w: Column) -> Column:
            label, new = F.concat(F.lit("calibration_regression_"), w), w != "block"
            change = F.when(w == "replace", "replace_with_expected_url").when(w == "block", "block_known_wrong_url").otherwise("restore_known_correct_url")
            made = F.struct(
                F.when(new, x["expected"]).otherwise("").alias("url"),
                F.when(new, "manual_accepted").otherwise("rejected").alias("status"),
                label.alias("source"),
                append_note(s["notes"], F.concat(label, F.lit(":"), x["kind"])).alias("notes"),
                F.concat(s["changes"], F.array(change)).alias("changes"),
                F.when(new, x["key"]).otherwise("").alias("key"),
            )
            return F.when(w.isNull(), s).otherwise(made)

        return let(what, after)

    rows = rows.withColumn("s", F.when(F.col("cases").isNull(), F.col("__own")).otherwise(F.aggregate("cases", F.col("__own"), step)))
    out = rows.withColumns({"official_url": F.col("s.url"), "status": F.col("s.status"), "decision_source": F.col("s.source"), "notes": F.col("s.notes"), "changes": F.col("s.changes")})
    return out.withColumn("official_domain", F.when(F.col("official_url") == "", F.lit("")).otherwise(urls.domain(F.col("official_url")))).drop("s", "cases", "__own")


def release_by_pattern(final: DataFrame, evidence: DataFrame, patterns: DataFrame, risky: list[str]) -> DataFrame:
    """Final rows where unresolved rows of a recall lane with a matching pattern and an independent candidate become calibrated_released.

    ``evidence``: row_id (the provider), features, candidate_url, review_reason.
    """
    found = matches(evidence, patterns, "row_id")
    rows = final.join(evidence.select(F.col("row_id").alias("provider_id"), "candidate_url", "review_reason"), "provider_id", "left").join(found.withColumnRenamed("row_id", "provider_id"), "provider_id", "left")
    host = urls.domain(F.col("candidate_url"))
    ok = (blank(F.col("official_url")) == "") & blank(F.col("review_reason")).startswith("recall_unresolved") & F.col("pattern").isNotNull() & (blank(F.col("candidate_url")) != "") & ~urls.excluded(host, risky)
    return rows.withColumn("__ok", ok).withColumns(
        {
            "official_url": F.when(F.col("__ok"), urls.delivered(F.col("candidate_url"))).otherwise(F.col("official_url")),
            "status": F.when(F.col("__ok"), "calibrated_released").otherwise(F.col("status")),
            "decision_source": F.when(F.col("__ok"), "pattern_release").otherwise(F.col("decision_source")),
            "notes": F.when(F.col("__ok"), append_note(blank(F.col("notes")), F.concat(F.lit("pattern_release:"), F.col("pattern")))).otherwise(F.col("notes")),
        }
    ).drop("__ok", "candidate_url", "review_reason", "pattern")


def hold_lanes(final: DataFrame, task: DataFrame, lanes: list[str]) -> DataFrame:
    """Final rows of the given review lanes moved from the output to needs_review."""
    held = task.filter(F.col("review_reason").isin(lanes)).select("provider_id").distinct().withColumn("__held", F.lit(True))
    rows = final.join(held, "provider_id", "left")
    hold = F.col("__held") & (blank(F.col("official_url")) != "")
    return rows.withColumn("__h", F.coalesce(hold, F.lit(False))).withColumns(
        {"official_url": F.when(F.col("__h"), "").otherwise(F.col("official_url")), "status": F.when(F.col("__h"), "needs_review").otherwise(F.col("status")), "decision_source": F.when(F.col("__h"), "policy_holdout").otherwise(F.col("decision_source"))}
    ).drop("__h", "__held")


def threshold_choice(sweep: DataFrame, current: int) -> DataFrame:
    """One row: the threshold with the best accuracy; the current one if it ties; else the one nearest to it, lower first. With the change in accuracy."""
    now = sweep.filter(F.col("threshold") == current).select(F.col("overall_accuracy").alias("current_accuracy"))
    rows = sweep.crossJoin(F.broadcast(now))
    rank = F.struct(F.col("overall_accuracy").alias("a"), (-F.abs(F.col("threshold") - current)).alias("d"), (-F.col("threshold")).alias("t"))
    one = rows.agg(F.max_by(F.struct("threshold", "overall_accuracy", "current_accuracy"), rank).alias("b")).select("b.*")
    return one.withColumn("accuracy_change", F.round(F.col("overall_accuracy") - F.col("current_accuracy"), 4)).withColumnRenamed("threshold", "recommended_threshold")
