"""Rows on which people validate a policy before it holds or releases results, and what they said."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text, urls
from ..functions.text import blank, first_filled
from ..storage import written
from .balance import matched_to
from .finalize import ensure_columns
from .learning import evidence_features
from .patterns import matches
from .providers import entity_key

# Host labels below which a company's own site doesn't live.
RISKY_LABELS = ["api", "app", "apps", "auth", "developer", "developers", "dev", "docs", "help", "login", "portal", "signin", "support"]
# Statuses from which a release may start.
FREE_STATUSES = ["unresolved", "low_confidence", "not_found", "needs_review", ""]
HOLD = "Check whether this current official URL should be held for human review instead of auto-accepted."
RELEASE = "Check whether this unresolved candidate is strong enough to auto-release in future runs."


def risky_label(host):
    labels = F.split(host, r"\.")
    return (F.size(labels) >= 3) & F.lower(F.get(labels, F.lit(0))).isin(RISKY_LABELS)


def _last_filled(rows: DataFrame, column: str, key: str = "__k", pos: str = "pos") -> DataFrame:
    """Per key the last value of ``column`` that isn't blank."""
    value = F.trim(blank(F.col(column)))
    return rows.filter(value != "").groupBy(key).agg(F.max_by(value, pos).alias("__reason"))


def policy_rows(final: DataFrame, reviews: DataFrame, checks: DataFrame, hold_reasons: list[str], hold_patterns: DataFrame, release_patterns: DataFrame, pos: str = "pos") -> DataFrame:
    """Rows to validate: results that a holding rule would take back, and unresolved ones that a release pattern would accept.

    ``final``, ``reviews`` and ``checks`` (verification rows: decision, reason_for_unsure, evidence_score, supporting_facts, counter_evidence, candidate_url, review_reason) meet by id,
    else by name; the last row of a key counts. ``hold_patterns`` and ``release_patterns``: pattern, pattern_pos, features; the first that matches counts, by distinct feature sets.
    A row with an address gives a holdout at most, one without a release. Of rows with equal id, action and pattern the first by ``pos`` stays. Columns: those of ``final``, action, pattern, policy_source, candidate_url,
    candidate_domain, review_reason, decision, evidence_score, review_instruction.
    """
    final = ensure_columns(final, ["official_domain", "top_candidate_domain", "top_candidate_url"])
    reviews = ensure_columns(reviews, ["provider_name", "review_reason", "official_domain", "official_url", "top_candidate_domain", "top_candidate_url", pos])
    checks = ensure_columns(checks, ["provider_name", "candidate_domain", "confidence"])
    named = reviews.withColumn("__k", entity_key()).filter("__k <> ''")
    rows = matched_to(matched_to(final, reviews).withColumnRenamed("row", "review"), checks).withColumnRenamed("row", "check")
    rows = rows.withColumn("__key", entity_key()).join(_last_filled(named, "review_reason"), F.col("__key") == F.col("__k"), "left").drop("__k", "__key")
    r, k = lambda c: blank(F.col(f"review.{c}")), lambda c: blank(F.col(f"check.{c}"))
    checked = F.col("check").isNotNull()
    score = text.whole_number(first_filled(F.col("check.evidence_score").cast("string"), k("confidence")))

    def features(c):
        """As ``evidence_features`` has them for the row whose columns ``c`` gives, and the verification."""
        shown = [c(x) for x in ("top_candidate_domain", "top_candidate_url", "official_domain", "official_url")]
        host = urls.domain(first_filled(k("candidate_domain"), k("candidate_url"), *shown))
        return evidence_features(first_filled(c("provider_name"), k("provider_name")), first_filled(c("review_reason"), k("review_reason")), k("decision"), k("reason_for_unsure"), score, k("supporting_facts"), k("counter_evidence"), host)

    own_column = lambda c: blank(F.col(c)) if c in final.columns else F.lit("")
    own, offered, reason = blank(F.col("official_url")), F.col("__offered"), blank(F.col("__reason"))
    host = urls.domain(offered)
    may = (own == "") & blank(F.col("status")).isin(FREE_STATUSES) & ((k("review_reason") == "") | k("review_reason").startswith("recall_unresolved")) & (offered != "") & (host != "") & ~risky_label(host)
    # A row with an address can only be held, one without only released: its features are those of one of the two, and none where neither can be.
    rows = rows.withColumn("__offered", urls.compared(k("candidate_url"))).withColumn("__may", checked & may & ~k("counter_evidence").contains("candidate_not_independent_official_site"))
    wanted = F.when(own != "", F.col("review").isNotNull() | checked).otherwise(F.col("__may"))
    shown = features(lambda c: F.when(own != "", r(c)).otherwise(own_column(c)))
    rows = written(rows.withColumns({"__row": F.monotonically_increasing_id(), "__features": F.when(wanted, shown).otherwise(F.array().cast("array<string>"))}), "policy")
    own_rows = lambda when: rows.filter(when).select("__row", F.col("__features").alias("features"))
    found = matches(own_rows(own != ""), hold_patterns, "__row").unionAll(matches(own_rows(F.col("__may")), release_patterns, "__row"))
    rows = rows.drop("__features").join(found.select(F.col("__row").alias("__r"), F.col("pattern").alias("__pattern")), F.col("__row") == F.col("__r"), "left").drop("__r")
    by_pattern = F.col("__pattern").isNotNull()
    hold = (own != "") & (reason.isin(hold_reasons) | by_pattern)
    free = F.col("__may") & by_pattern

    def made(action, pattern, source, url, domain, note):
        return F.struct(F.lit(action).alias("action"), pattern.alias("pattern"), source.alias("policy_source"), url.alias("candidate_url"), domain.alias("candidate_domain"), F.lit(note).alias("review_instruction"))

    held = made("holdout", F.coalesce("__pattern", F.concat(F.lit("review_reason:"), reason)), F.when(by_pattern, "hold_pattern").otherwise("hold_review_reason"), own, urls.domain(first_filled(F.col("official_domain"), own)), HOLD)
    freed = made("release", F.col("__pattern"), F.lit("release_pattern"), offered, urls.domain(first_filled(k("candidate_domain"), offered)), RELEASE)
    each = rows.withColumn("x", F.explode(F.array_compact(F.array(F.when(hold, held), F.when(free, freed)))))
    out = each.select(*final.columns, "x.*", first_filled(r("review_reason"), k("review_reason")).alias("review_reason"), k("decision").alias("decision"), k("evidence_score").alias("evidence_score"))
    first = out.groupBy(blank(F.col("provider_id")).alias("__id"), "action", "pattern").agg(F.min_by(F.struct(*out.columns), pos).alias("o"))
    return first.select("o.*")


def with_labels(rows: DataFrame, labels: DataFrame, pos: str = "pos") -> DataFrame:
    """Adds expected_kind, expected_url, expected_domain, known_label_status and ``decisive`` from the first label of each row's id, else name."""
    back = labels.withColumn(pos, -F.col(pos))
    found = matched_to(rows, back)
    l = lambda c: F.trim(blank(F.col(f"row.{c}")))  # noqa: E731, E741
    kind = l("expected_kind")
    return found.select(
        *rows.columns, kind.alias("expected_kind"), l("expected_url").alias("expected_url"), l("expected_domain").alias("expected_domain"),
        F.when(kind == "", "unlabeled").otherwise(F.concat(F.lit("labeled_"), kind)).alias("known_label_status"), kind.isin("official", "no_official").alias("decisive"),
    )


def policy_summary(rows: DataFrame) -> DataFrame:
    """Per action and pattern: matched rows, those to be labelled (not decisive yet), and known labels of either kind. Over ``with_labels``."""
    return rows.groupBy("action", "pattern").agg(
        F.count(F.lit(1)).alias("matched_rows"),
        F.count_if(~F.col("decisive")).alias("output_rows"),
        F.count_if(F.col("expected_kind") == "official").alias("labeled_official"),
        F.count_if(F.col("expected_kind") == "no_official").alias("labeled_no_official"),
    )
