"""Labels against output: outcomes, precision and recall, threshold sweeps, review lanes, intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.text import blank
from .providers import entity_key

OUTCOMES = ["correct_official", "false_official", "over_rejected", "correct_no_official"]
WILSON_Z = 1.2815515655446004


def ratio(n: Column, d: Column, digits: int = 4) -> Column:
    """n / d rounded, null for d = 0."""
    return F.round(F.try_divide(n, d), digits)


def matched_to(labels: DataFrame, output: DataFrame, pos: str = "pos") -> DataFrame:
    """Labels with struct ``row``: the output's last row of the same entity key (rows with an id are found by id only)."""
    last = output.withColumn("__k", entity_key()).filter("__k <> ''").groupBy("__k").agg(F.max_by(F.struct(*output.columns), pos).alias("row"))
    return labels.withColumn("__key", entity_key()).join(last, F.col("__key") == F.col("__k"), "left").drop("__key", "__k")


def outcome(expected_kind: Column, expected_domain: Column, output_domain: Column) -> Column:
    official = expected_kind == "official"
    given = output_domain != ""
    return (
        F.when(official & given & (output_domain == expected_domain), "correct_official").when(given, "false_official").when(official, "over_rejected").otherwise("correct_no_official")
    )


def evaluate_labels(labels: DataFrame, output: DataFrame) -> DataFrame:
    """Labels with output_status, output_confidence, output_url, output_domain and outcome."""
    rows = matched_to(labels, output)
    url = urls.compared(F.col("row.official_url"))
    given = F.coalesce(F.nullif(blank(F.col("row.official_domain")), F.lit("")), F.col("output_url"))
    rows = rows.withColumn("output_url", url).withColumn("output_domain", F.when(F.col("output_url") == "", F.lit("")).otherwise(urls.domain(given)))
    return rows.select(
        *labels.columns,
        blank(F.col("row.status")).alias("output_status"),
        blank(F.col("row.confidence").cast("string")).alias("output_confidence"),
        "output_url",
        "output_domain",
        outcome(F.col("expected_kind"), F.col("expected_domain"), F.col("output_domain")).alias("outcome"),
    )


def summarize(details: DataFrame, by: list[str] | None = None, result: str = "outcome") -> DataFrame:
    """Counts of each outcome, and precision, recall and accuracy; for each group of ``by``, or one row."""
    counts = [F.count_if(F.col(result) == o).alias(f"{o}_rows") for o in OUTCOMES]
    one = details.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("labeled_rows"), F.count_if(F.col("expected_kind") == "official").alias("expected_official_rows"), *counts)
    c = F.col
    return one.withColumns(
        {
            "official_output_rows": c("correct_official_rows") + c("false_official_rows"),
            "auto_precision": ratio(c("correct_official_rows"), c("correct_official_rows") + c("false_official_rows")),
            "official_recall": ratio(c("correct_official_rows"), c("expected_official_rows")),
            "overall_accuracy": ratio(c("correct_official_rows") + c("correct_no_official_rows"), c("labeled_rows")),
        }
    )


def threshold_sweep(details: DataFrame, thresholds: list[int]) -> DataFrame:
    """The summary at each threshold: matched rows with an address below it count as without one. One pass over the labels per group of sums."""
    confidence = F.col("output_confidence").try_cast("double").try_cast("int")
    candidate = (F.col("output_status") == "matched") & (F.col("output_url") != "")
    each = details.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))
    dropped = candidate & (F.coalesce(F.nullif(F.col("output_confidence"), F.lit("")), F.lit("0")).try_cast("double").isNull() | (F.coalesce(confidence, F.lit(0)) < F.col("threshold")))
    left = F.when(dropped, F.lit("")).otherwise(F.col("output_domain"))
    return summarize(each.withColumn("at", outcome(F.col("expected_kind"), F.col("expected_domain"), left)), ["threshold"], "at")


def review_lanes(details: DataFrame, task: DataFrame) -> DataFrame:
    """Per review reason: rows of the task, and the labelled rows' outcomes inside it. ``details`` carries review_reason for rows in the task, else null."""
    sizes = task.groupBy("review_reason").agg(F.count(F.lit(1)).alias("review_task_rows"))
    known = details.filter(blank(F.col("review_reason")) != "").groupBy("review_reason").agg(F.count(F.lit(1)).alias("labeled_rows"), *[F.count_if(F.col("outcome") == o).alias(f"{o}_rows") for o in OUTCOMES])
    lanes = sizes.join(known, "review_reason", "full_outer").na.fill(0)
    c = F.col
    risk = c("false_official_rows") + c("over_rejected_rows")
    return lanes.withColumns({"risk_rows": risk, "risk_share_of_labeled_lane": ratio(risk, c("labeled_rows")), "correct_share_of_labeled_lane": ratio(c("correct_official_rows") + c("correct_no_official_rows"), c("labeled_rows"))})


def lane_drops(lanes: DataFrame) -> DataFrame:
    """What is saved and what is missed if a lane is no longer reviewed."""
    total = lanes.agg(F.sum("review_task_rows").alias("all_rows"))
    return lanes.crossJoin(F.broadcast(total)).select(
        F.col("review_reason").alias("drop_review_reason"),
        (F.col("all_rows") - F.col("review_task_rows")).alias("manual_review_rows_after_drop"),
        F.col("review_task_rows").alias("manual_review_rows_removed"),
        F.col("false_official_rows").alias("known_false_official_missed"),
        F.col("over_rejected_rows").alias("known_over_rejected_missed"),
        (F.col("correct_official_rows") + F.col("correct_no_official_rows")).alias("known_correct_reviews_removed"),
    )


def review_capture(details: DataFrame) -> DataFrame:
    """One row: false officials and over-rejections inside and outside the review task."""
    inside = blank(F.col("review_reason")) != ""
    false, over = F.col("outcome") == "false_official", F.col("outcome") == "over_rejected"
    one = details.agg(
        F.count_if(inside).alias("reviewed_rows"),
        F.count_if(false & inside).alias("false_official_captured"),
        F.count_if(false & ~inside).alias("false_official_missed"),
        F.count_if(over & inside).alias("over_rejected_captured"),
        F.count_if(over & ~inside).alias("over_rejected_missed"),
    )
    return one.withColumn("false_official_capture_rate", ratio(F.col("false_official_captured"), F.col("false_official_captured") + F.col("false_official_missed")))


def wilson(positive: Column, n: Column, z: float = WILSON_Z) -> tuple[Column, Column]:
    """Lower and upper bound of the share, to four digits; null for n = 0."""
    share = F.try_divide(positive, n)
    scale = 1 + z * z / n
    middle = (share + z * z / (2 * n)) / scale
    half = z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n)) / scale
    some = n > 0
    return F.when(some, F.round(F.greatest(F.lit(0.0), middle - half), 4)), F.when(some, F.round(F.least(F.lit(1.0), middle + half), 4))


def group_stats(rows: DataFrame, fields: list[str], decision: str, outcome_col: str) -> DataFrame:
    """Long form over several fields at once (grouping sets): field, value, rows, labelled, decisive, supporting rows, shares and their interval."""
    support = F.count_if(F.col(outcome_col) == "support")
    block = F.count_if(F.col(outcome_col) == "blocking")
    long = rows.select(decision, outcome_col, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), blank(F.col(f).cast("string")).alias("value")) for f in fields])).alias("x")).select("x.*", decision, outcome_col)
    one = long.groupBy("field", "value").agg(F.count(F.lit(1)).alias("rows"), F.count_if(blank(F.col(decision)) != "").alias("labeled_rows"), support.alias("support_rows"), block.alias("blocking_rows"))
    one = one.withColumn("decisive_rows", F.col("support_rows") + F.col("blocking_rows"))
    low, high = wilson(F.col("support_rows"), F.col("decisive_rows"))
    return one.withColumns({"support_rate": ratio(F.col("support_rows"), F.col("decisive_rows")), "support_low": low, "support_high": high})
