"""What labels recommend: for review lanes, for releases by threshold or pattern, for the next rows to label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ACCEPT_SCORE
from ..functions import urls
from ..functions.text import blank, whole_number
from .balance import ratio, wilson
from .calibration import LEAST_CLEAN
from .finalize import ensure_columns
from .providers import cut_per_key
from .secondpass import MATCHED_CUTOFF

OUTCOMES = {"candidate_correct_rows": "candidate_correct", "candidate_incorrect_rows": "candidate_incorrect", "recall_useful_rows": "recall_candidate_useful", "recall_not_useful_rows": "recall_candidate_not_useful"}
# Recommendations of lanes in the order in which they are listed, and names that say little.
LANE_ORDER = ["keep_review_lane", "candidate_for_review_downgrade", "candidate_for_narrow_recall_rule", "needs_more_labels"]
DESCRIPTIVE = ["full-service", "account management", "amazon", "scaling"]


def _valid() -> Column:
    return (blank(F.col("normalized_decision")) != "") & (blank(F.col("decision_quality_issue")) == "")


def lane_recommendations(details: DataFrame, pos: str = "pos") -> DataFrame:
    """Per review lane of a filled sample: counts, support with its bounds, evidence_strength, recommendation, and rank, its place in the list.

    A lane with a decisive label against it keeps its review; one with LEAST_CLEAN or more for it and none against it may be relaxed. The lane's kind is that of its first row.
    """
    valid = _valid()
    decisive = valid & (F.col("normalized_decision") != "unsure")
    one = details.filter(blank(F.col("review_reason")) != "").groupBy("review_reason").agg(
        F.min_by(blank(F.col("lane_kind")), pos).alias("lane_kind"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(valid).alias("labeled_rows"),
        F.count_if(decisive).alias("decisive_rows"),
        *[F.count_if(decisive & (F.col("calibration_outcome") == o)).alias(n) for n, o in OUTCOMES.items()],
        F.count_if(valid & (F.col("calibration_outcome") == "manual_unsure")).alias("manual_unsure_rows"),
    )
    recall, c = F.col("lane_kind") == "recall", F.col
    one = one.withColumns({"support_rows": F.when(recall, c("recall_useful_rows")).otherwise(c("candidate_correct_rows")), "blocking_rows": F.when(recall, c("recall_not_useful_rows")).otherwise(c("candidate_incorrect_rows"))})
    n = c("decisive_rows")
    low, _ = wilson(c("support_rows"), n)
    _, high = wilson(c("blocking_rows"), n)
    clean = F.when(recall, "candidate_for_narrow_recall_rule").otherwise("candidate_for_review_downgrade")
    said = F.when(n == 0, "needs_more_labels").when(c("blocking_rows") > 0, "keep_review_lane").when(c("support_rows") >= LEAST_CLEAN, clean).otherwise("needs_more_labels")
    strength = F.when(n <= 0, "unlabeled").when(c("blocking_rows") > 0, "blocked").when(c("support_rows") < LEAST_CLEAN, "thin_support").when(n < 2 * LEAST_CLEAN, "minimum_support").otherwise("strong_support")
    one = one.withColumns({"support_rate": ratio(c("support_rows"), n), "support_rate_wilson_lower_80": low, "blocking_rate_wilson_upper_80": high, "evidence_strength": strength, "recommendation": said})
    place = F.array_position(F.array(*map(F.lit, LANE_ORDER)), c("recommendation"))
    return one.withColumn("rank", F.struct(place.alias("place"), (-n).alias("fewer"), "review_reason"))


def sample_summary(details: DataFrame) -> DataFrame:
    """One row over a filled sample: rows, labelled and decisive ones, quality issues, outcomes."""
    valid, issue, outcome = _valid(), blank(F.col("decision_quality_issue")), F.col("calibration_outcome")
    return details.agg(
        F.count(F.lit(1)).alias("sample_rows"),
        F.count_if(valid).alias("labeled_rows"),
        F.count_if(valid & (F.col("normalized_decision") != "unsure")).alias("decisive_rows"),
        F.count_if(issue == "invalid_manual_decision").alias("invalid_manual_decision_rows"),
        F.count_if(issue == "replace_missing_manual_url").alias("replace_missing_manual_url_rows"),
        F.count_if(issue != "").alias("decision_quality_issue_rows"),
        *[F.count_if(outcome == o).alias(n) for n, o in OUTCOMES.items()],
        F.count_if(outcome == "manual_unsure").alias("unsure_rows"),
    )


def recall_release(simulations: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per sweep (columns ``by``; none: one sweep) the threshold to release at, as one aggregation.

    Of thresholds that release right rows and no wrong one, the one with most right rows, then the lowest: narrow_auto_release_candidate. Else the most precise, with most right and
    fewest wrong rows, then the lowest: manual_only. Without rows: not_evaluated.
    """
    c = F.col
    right, wrong, at = F.coalesce("correct_recovery_rows", F.lit(0)), F.coalesce("wrong_release_rows", F.lit(0)), c("evidence_threshold")
    clean = (wrong == 0) & (right > 0)
    order = F.struct(clean.alias("a"), F.when(clean, 0.0).otherwise(F.coalesce(c("release_precision"), F.lit(0.0))).alias("b"), right.alias("c"), F.when(clean, 0).otherwise(-wrong).alias("d"), (-at).alias("e"))
    best = simulations.groupBy(*(by or [])).agg(F.max_by(F.struct(clean.alias("clean"), at.alias("threshold"), right.alias("correct_recovery_rows"), wrong.alias("wrong_release_rows")), order).alias("x"))
    said = F.when(c("x").isNull(), "not_evaluated").when(c("x.clean"), "narrow_auto_release_candidate").otherwise("manual_only")
    return best.select(*(by or []), said.alias("recommendation"), "x.threshold", "x.correct_recovery_rows", "x.wrong_release_rows")


def pattern_release(candidates: DataFrame, by: list[str] | None = None, pos: str = "pos") -> DataFrame:
    """The pattern set to release (path, pattern_count, correct_recovery_rows, wrong_release_rows, overall_accuracy), per group of ``by``: recommended ones first, then fewest wrong, most right, most accurate, first by ``pos``."""
    c = F.col
    n, right, wrong = (F.coalesce(x, F.lit(0)) for x in ("pattern_count", "correct_recovery_rows", "wrong_release_rows"))
    good = (n > 0) & (right > 0) & (wrong == 0)
    reason = F.when(good, "recovers_labeled_sites_only").when((n > 0) & (wrong > 0), "would_release_wrong_candidates").when(n > 0, "recovers_nothing").otherwise("no_selected_patterns")
    order = F.struct((~good).alias("a"), wrong.alias("b"), (-right).alias("c"), (-F.coalesce(c("overall_accuracy").cast("double"), F.lit(0.0))).alias("d"), c(pos).alias("e"))
    row = F.struct("path", F.when(good, "narrow_pattern_release_candidate").otherwise("not_recommended").alias("recommendation"), reason.alias("reason"), n.alias("pattern_count"), right.alias("correct_recovery_rows"), wrong.alias("wrong_release_rows"))
    best = candidates.groupBy(*(by or [])).agg(F.min_by(row, order).alias("x"))
    return best.select(*(by or []), "x.path", F.coalesce("x.recommendation", F.lit("not_evaluated")).alias("recommendation"), "x.reason", "x.pattern_count", "x.correct_recovery_rows", "x.wrong_release_rows")


def _any(c: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


# Words of names that many companies share, and marks of risk in a verification row.
SHARED_WORDS = ["agency", "consulting", "consultoria", "consultoría", "ecommerce", "ecom", "expert", "experts", "marketplace", "seller", "sellers", "services", "solutions", "support"]
RISK_MARKS = ["manual_accepted", "needs_review", "unresolved", "same", "generic", "identity", "slug", "platform", "directory", "parked"]
BLOB = ["supporting_facts", "counter_evidence", "evidence_summary", "reason_for_unsure", "provider_locations", "service_apis"]


def priority_reason(rows: DataFrame) -> DataFrame:
    """Adds priority_reason, why a boundary row is worth a label, and decision_impact, a key for what its label can change. Missing columns count as blank."""
    rows = ensure_columns(rows, [*BLOB, "review_reason", "provider_name", "agent_b_decision"])
    blob = F.lower(F.concat_ws(" ", *[blank(F.col(c)) for c in BLOB]))
    name, lane = F.lower(blank(F.col("provider_name"))), blank(F.col("review_reason"))
    made = rows.withColumns({"__blob": blob, "__name": name, "__words": F.regexp_extract_all(name, F.lit("([a-z0-9]+)"), F.lit(1))})
    b, foreign = F.col("__blob"), blank(F.col("provider_name")).rlike(r"[^\x00-\x7F]")
    vague = (F.size("__words") <= 2) | (F.size(F.filter("__words", lambda w: w.isin(SHARED_WORDS))) >= 2)
    slug = F.when(blank(F.col("agent_b_decision")) == "accept", "slug_extension_agentb_accept").when(b.contains("fuzzy"), "slug_extension_fuzzy_identity").when(vague, "slug_extension_generic_identity").otherwise("slug_extension_identity_boundary")
    recall = F.when(_any(b, ["service_content_matches_amazon_provider", "some_service_content_matches"]), "recall_name_gap_with_service_match").otherwise("recall_unresolved_candidate_boundary")
    low = F.when(foreign, "localized_low_confidence_boundary").when(_any(F.col("__name"), DESCRIPTIVE), "descriptive_provider_name_boundary").otherwise("low_confidence_auto_match_boundary")
    generic = F.when(vague, "generic_short_name_collision").when(foreign, "localized_generic_identity_boundary").otherwise("generic_identity_boundary")
    reason = (
        F.when(b.contains("country_conflict"), "country_conflict_boundary")
        .when(b.contains("identity_cap_logo_only_evidence"), "logo_only_evidence_boundary")
        .when(b.contains("listing_logo_visual_near_match"), "logo_near_match_boundary")
        .when(b.contains("candidate_pages_not_fetchable"), "unfetchable_candidate_boundary")
        .when(b.contains("provider_name_not_found_on_candidate_pages"), "missing_provider_name_boundary")
        .when(lane == "precision_slug_extension_identity_risk", slug)
        .when(lane == "recall_unresolved_top_candidate", recall)
        .when(lane == "precision_low_confidence_auto_match", low)
        .when(lane == "precision_generic_identity_term_risk", generic)
        .otherwise("protected_lane_boundary")
    )
    said = F.col("priority_reason")
    impact = (
        F.when(lane == "recall_unresolved_top_candidate", "recall_rule")
        .when(said.contains("logo"), "logo_evidence")
        .when(_any(said, ["country", "localized"]), "country_and_language")
        .when(said.contains("unfetchable"), "search_evidence_alone")
        .when(said.contains("missing_provider_name"), "service_evidence_for_name")
        .when(said.contains("slug_extension"), "slug_extension")
        .when(_any(said, ["generic", "descriptive"]), "generic_names")
        .otherwise("none_alone")
    )
    return made.withColumn("priority_reason", reason).withColumn("decision_impact", impact).drop("__blob", "__name", "__words")


def judge_queue(rows: DataFrame) -> DataFrame:
    """Verification rows that a second judge should see: in a review lane, with a mark of risk in their texts, with a logo as only identity, or with low confidence or score."""
    rows = ensure_columns(rows, ["review_reason", "source_status", "status", "counter_evidence", "reason_for_unsure", "notes", "supporting_facts", "source_confidence", "confidence", "evidence_score"])
    c = lambda n: blank(F.col(n).cast("string"))
    said = F.lower(F.concat_ws(" ", *map(c, ["review_reason", "source_status", "status", "counter_evidence", "reason_for_unsure", "notes"])))
    facts = F.lower(c("supporting_facts"))
    sure = whole_number(F.coalesce(F.nullif(c("source_confidence"), F.lit("")), c("confidence")))
    low = (sure < MATCHED_CUTOFF) | (whole_number(c("evidence_score")) < ACCEPT_SCORE)
    return rows.filter((F.trim(c("review_reason")) != "") | _any(said, RISK_MARKS) | (facts.contains("logo") & ~facts.contains("page_contains_exact_provider_name")) | low)


# Recommendations from tagged reviews: kind, tags, action, whether it may be applied at once.
TAGGED = [
    ("url_reachability", ["candidate_unreachable", "domain_variant_fix"], "verify_url_variants_before_accept", False),
    ("platform_profile_evidence_only", ["platform_profile_only"], "add_to_excluded_domains", True),
    ("identity_constraint", ["wrong_company", "service_mismatch", "name_or_logo_mismatch", "region_mismatch"], "write_identity_regression_fixtures", False),
    ("no_official_regression", ["confirmed_no_official", "wrong_candidate_no_replacement"], "write_no_official_regression_fixtures", False),
]


def tag_counts(tagged: DataFrame) -> DataFrame:
    """tag, n over rows with array note_tags."""
    return tagged.select(F.explode("note_tags").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def tagged_recommendations(tagged: DataFrame, examples: int = 50, pos: str = "pos") -> DataFrame:
    """kind, action, safe_to_apply, n (tags; for no_official_regression rows) and examples, the ids of the first rows by ``pos`` that carry one of the kind's tags; kinds without any are left out.

    ``tagged``: provider_id, provider_name, note_tags; rows without id and name don't count. Rows meet kinds through their own tags, and of each kind's rows only the first
    ``examples`` of a task leave it.
    """
    rows = tagged.filter((F.trim(blank(F.col("provider_id"))) != "") | (F.trim(blank(F.col("provider_name"))) != ""))
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(a).alias("action"), F.lit(s).alias("safe_to_apply"), F.size(F.array_intersect("note_tags", F.array(*map(F.lit, tags)))).alias("hits")) for k, tags, a, s in TAGGED])
    each = rows.select("provider_id", pos, F.inline(F.filter(kinds, lambda k: k["hits"] > 0)))
    counts = each.groupBy("kind", "action", "safe_to_apply").agg(F.sum(F.when(F.col("kind") == "no_official_regression", 1).otherwise(F.col("hits"))).alias("n"))
    first = cut_per_key(each, ["kind"], [F.col(pos)], examples).groupBy("kind").agg(F.sort_array(F.collect_list(F.struct(pos, "provider_id")))["provider_id"].alias("examples"))
    return counts.join(first, "kind")


# Words of filled calibration samples for each decision.
SAMPLE_WORDS = {
    "accept": ["accept", "accepted", "approve", "approved", "correct", "yes", "true", "正确", "对"],
    "replace": ["replace", "replacement", "修正", "替换"],
    "reject": ["reject", "rejected", "no", "false", "wrong", "incorrect", "错误", "错", "无官网"],
    "unsure": ["unsure", "unknown", "uncertain", "不确定"],
}
NO_OFFICIAL = ["实际无官网", "no official", "no reliable official"]
BUCKETS = ["candidate_for_rule", "needs_more_labels", "reject_pattern"]


def sample_decision(decision: Column) -> Column:
    """accept, replace, reject or unsure by the words of filled samples; blank for any other word."""
    known = F.create_map(*[F.lit(x) for d, words in SAMPLE_WORDS.items() for w in words for x in (w, d)])
    return F.coalesce(F.try_element_at(known, F.lower(F.trim(blank(decision)))), F.lit(""))


def quality_issue(decision: Column, manual_url: Column) -> Column:
    """invalid_manual_decision for an unknown word, replace_missing_manual_url for a replacement without an address, else blank."""
    said = sample_decision(decision)
    return F.when((F.trim(blank(decision)) != "") & (said == ""), "invalid_manual_decision").when((said == "replace") & (F.trim(blank(manual_url)) == ""), "replace_missing_manual_url").otherwise("")


def rule_buckets(recommendations: DataFrame) -> DataFrame:
    """Pattern recommendations (pattern, pattern_scope, supporting_rows, decisive_rows, recommendation, ...) that call for something, with required_action and rank, their place in their bucket: most supported, then most decisive, then by name."""
    c = F.col
    action = (
        F.when((c("recommendation") == "candidate_for_rule") & c("pattern_scope").isin("recall", "precision"), F.concat(F.lit("test_then_narrow_"), c("pattern_scope"), F.lit("_rule")))
        .when(c("recommendation") == "candidate_for_rule", "test_before_any_rule")
        .when(c("recommendation") == "needs_more_labels", "keep_in_samples")
        .otherwise("keep_in_review")
    )
    kept = recommendations.filter(c("recommendation").isin(BUCKETS))
    return kept.withColumns({"required_action": action, "rank": F.struct((-c("supporting_rows")).alias("a"), (-c("decisive_rows")).alias("b"), c("pattern").alias("c"))})


def learning_summary(rows: DataFrame) -> DataFrame:
    """One row over reviewed results: decisions, accepts of low confidence, rejects of what had been accepted, recall additions, rows confirmed to have no site.

    ``rows``: manual_decision, manual_url, previous_url (what was shown), previous_status, previously_decided (boolean), confidence, error_type, notes; made by one look-up of the review
    and base rows. One pass.
    """
    c = F.col
    before, after = urls.domain(blank(c("previous_url"))), urls.domain(F.coalesce(F.nullif(blank(c("manual_url")), F.lit("")), blank(c("previous_url"))))
    rows = rows.withColumns({"__b": before, "__a": after, "__n": whole_number(c("confidence").cast("string")), "__e": F.lower(F.concat_ws(" ", blank(c("error_type")), blank(c("notes"))))})
    taken = c("manual_decision").isin("accept", "replace") & (c("__a") != "")
    none = _any(c("__e"), NO_OFFICIAL)
    return rows.agg(
        *[F.count_if(c("manual_decision") == d).alias(f"{d}_rows") for d in SAMPLE_WORDS],
        F.count_if(taken & (c("__n") > 0) & (c("__n") < 70)).alias("accepted_low_confidence_rows"),
        F.count_if(taken & (c("__b") == "")).alias("recall_additions"),
        F.count_if((c("manual_decision") == "reject") & (c("__b") != "") & (F.coalesce(c("previously_decided"), F.lit(False)) | (blank(c("previous_status")) == "manual_accepted"))).alias("rejected_auto_accepted_rows"),
        F.count_if(none).alias("confirmed_no_official_rows"),
        F.count_if(none & (c("__b") != "")).alias("wrong_candidate_no_official_rows"),
    )


def review_fixtures(tagged: DataFrame, pos: str = "pos") -> DataFrame:
    """Regression fixtures of human review: of rows with equal provider, candidate and manual address the first by ``pos``, with note_tags as one text."""
    keys = ["provider_id", "candidate_url", "manual_url"]
    rest = [c for c in tagged.columns if c not in keys]
    plain = tagged.withColumns({c: blank(F.col(c).cast("string")) for c in keys})
    one = plain.groupBy(*keys).agg(F.min_by(F.struct(*rest), pos).alias("r")).select(*keys, "r.*")
    return one.withColumn("note_tags", F.array_join("note_tags", "; "))


def exclusions_to_add(domains: DataFrame, known: list[str]) -> DataFrame:
    """domain, added (false: already excluded) of the distinct domains that recommendations name."""
    plain = domains.select(F.lower(F.trim(blank(F.col("domain")))).alias("domain")).filter("domain <> ''").distinct()
    return plain.withColumn("added", ~F.col("domain").isin(known))


def batch_rollup(batches: DataFrame) -> DataFrame:
    """One row over batch runs (run_dir, released_rows, official_url_rows, unresolved_rows, quality_passed): sums, runs that failed their gate, and rows released in runs that no labels cover."""
    labelled = blank(F.col("run_dir")).contains("100") | blank(F.col("run_dir")).contains("balance_tuned")
    total = lambda c, when=None: F.coalesce(F.sum(F.when(when, F.col(c)) if when is not None else F.col(c)), F.lit(0)).cast("long")
    return batches.agg(
        F.count(F.lit(1)).alias("batches"), total("released_rows").alias("released_rows"), total("official_url_rows").alias("official_url_rows"), total("unresolved_rows").alias("unresolved_rows"),
        F.count_if(~F.coalesce("quality_passed", F.lit(False))).alias("quality_blockers"), total("released_rows", ~labelled).alias("unlabelled_released_rows"),
    )
