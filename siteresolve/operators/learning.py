"""Review work to labels and features: filled rows, labels and their evaluation, what to verify, evidence features, sample priorities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DECISIONS
from ..functions import text, urls
from ..functions.text import blank, cell_url, first_filled, whole_number
from .balance import matched_to, ratio
from .finalize import ensure_columns
from .providers import entity_key, lookup
from .scoring import ambiguous_name
from .secondpass import MATCHED_CUTOFF, strong_identity
from .verification import not_independent

# Further words in filled sheets.
REVIEW_WORDS = {**DECISIONS, "accpet": "accept", "unsure": "unsure"}
URL_FIELDS = ["manual_url", "your_true_official_url", "true_official_url"]
# Names and bounds of evidence features.
SCORE_BOUNDS = [30, 45, 50, 60, 70, 75, 80, 85]
IDENTITY_FACTS = [
    "candidate_pages_fetch_ok", "contact_email_found", "legal_entity_marker_found", "listing_logo_visual_match", "listing_logo_visual_near_match", "location_matches",
    "page_contains_exact_provider_name", "page_contains_provider_name_tokens", "schema_org_organization_seen", "service_content_matches_amazon_provider", "standard_company_pages_found",
]
GENERIC_TOKENS = [
    "amazon", "account", "agency", "consulting", "consultancy", "digital", "ecom", "ecommerce", "global", "growth", "llc", "ltd", "management", "marketplace", "media",
    "seller", "sellers", "service", "services", "solution", "solutions",
]
NAME_MARKERS = ["consult", "seller", "marketplace", "agency", "amazon", "ecom"]
TOP_CANDIDATE = "recall_unresolved_top_candidate"
# Lanes whose recommendation keeps them in a labelling task.
PROTECTED = ["keep_review_lane", "needs_more_labels", "candidate_for_review_downgrade", "candidate_for_narrow_recall_rule", "spot_check_candidate"]


def review_word(decision: Column) -> Column:
    """accept, replace, reject or unsure; other words as they are, in lower case."""
    known = F.create_map(*[F.lit(x) for kv in REVIEW_WORDS.items() for x in kv])
    raw = F.lower(F.trim(blank(decision)))
    return F.coalesce(F.try_element_at(known, raw), raw)


def normalize_filled(rows: DataFrame) -> DataFrame:
    """Filled review rows with manual_decision, manual_url and ``applied``; an address makes blank and reject a replace, unsure and blank rows aren't applied."""
    rows = ensure_columns(rows, [*URL_FIELDS, "manual_decision", "your_decision", "official_url", "candidate_1_url", "top_candidate_url"])
    url, word = F.trim(cell_url(F.trim(first_filled(*map(F.col, URL_FIELDS))))), review_word(first_filled(F.col("manual_decision"), F.col("your_decision")))
    said = F.when((url != "") & word.isin("reject", ""), "replace").otherwise(word)
    shown, first = F.trim(first_filled(F.col("official_url"), F.col("top_candidate_url"))), F.trim(first_filled(F.col("candidate_1_url"), F.col("top_candidate_url"), F.col("official_url")))
    done = rows.withColumns({"manual_decision": said, "manual_url": url, "official_url": shown, "candidate_1_url": first})
    return done.withColumn("applied", ~F.col("manual_decision").isin("unsure", ""))


def manual_labels(applied: DataFrame) -> DataFrame:
    """Labels of accepted and replaced rows with an address: their own, else the shown one, else the first candidate's."""
    rows = applied.withColumn("__u", F.trim(first_filled(F.col("manual_url"), F.col("official_url"), F.col("candidate_1_url")))).filter((F.col("__u") != "") & F.col("manual_decision").isin("accept", "replace"))
    full = F.when(F.col("__u").contains("://"), F.col("__u")).otherwise(F.concat(F.lit("https://"), "__u"))
    return rows.select("provider_id", "provider_name", full.alias("expected_url"), urls.domain(F.col("__u")).alias("expected_domain"), F.lit("manual_review").alias("label_source"))


def evaluated(labels: DataFrame, results: DataFrame) -> DataFrame:
    """Labels with their result (by id, else by name): found, expected_domain, actual_domain, status, domain_match."""
    rows = lookup(labels, results)
    side = lambda *c: urls.domain(first_filled(*c))
    rows = rows.withColumns({"expected_domain": side(F.col("expected_domain"), F.col("expected_url")), "actual_domain": side(F.col("found.official_domain"), F.col("found.official_url"))})
    match = (F.col("expected_domain") != "") & (F.col("expected_domain") == F.col("actual_domain"))
    return rows.select("provider_id", "provider_name", F.col("found").isNotNull().alias("found"), "expected_domain", "actual_domain", blank(F.col("found.status")).alias("status"), match.alias("domain_match"))


def evaluation_summary(rows: DataFrame) -> DataFrame:
    """One row over ``evaluated``: counts, accuracy and the precision of automatic matches."""
    found, match = F.col("found"), F.col("found") & F.col("domain_match")
    auto = found & (F.col("status") == "matched")
    one = rows.agg(
        F.count(F.lit(1)).alias("labeled_rows"),
        F.count_if(found).alias("evaluated_rows"),
        F.count_if(~found).alias("missing_labeled_rows"),
        F.count_if(match).alias("domain_matches"),
        F.count_if(auto).alias("auto_matched_rows"),
        F.count_if(auto & match).alias("auto_correct_rows"),
        F.count_if(found & (F.col("status") == "needs_review")).alias("needs_review_rows"),
        F.count_if(found & (F.col("status").isin("low_confidence", "not_found") | (F.col("actual_domain") == ""))).alias("unresolved_rows"),
    )
    return one.withColumns({"domain_accuracy": ratio(F.col("domain_matches"), F.col("evaluated_rows")), "auto_match_precision": ratio(F.col("auto_correct_rows"), F.col("auto_matched_rows"))}).drop("auto_correct_rows")


def labels_from_review(baseline: DataFrame, reviews: DataFrame) -> DataFrame:
    """A label per baseline row: what its last review says, else the baseline itself. Unsure rows give none."""
    rows = matched_to(baseline, ensure_columns(reviews, [*URL_FIELDS, "manual_decision", "official_url", "current_or_candidate_url", "candidate_url"]))
    r = lambda c: F.col(f"row.{c}")
    word, given = review_word(r("manual_decision")), urls.compared(cell_url(first_filled(*map(r, URL_FIELDS))))
    shown, own = urls.compared(cell_url(first_filled(r("official_url"), r("current_or_candidate_url"), r("candidate_url")))), urls.compared(F.col("official_url"))
    rows = rows.withColumns({"__d": word, "__g": given, "__s": shown, "__o": own}).filter("__d <> 'unsure'")
    d, g, s, o = (F.col(c) for c in ("__d", "__g", "__s", "__o"))
    url = F.when(d.isin("replace", "reject"), g).when(d == "accept", F.when(g != "", g).otherwise(s)).otherwise(o)
    some = url != ""
    source = (
        F.when(d == "replace", F.when(some, "human_replace").otherwise("human_replace_missing_url"))
        .when(d == "reject", F.when(some, "human_reject_with_url").otherwise("human_reject"))
        .when(d == "accept", F.when(some, "human_accept").otherwise("human_accept_no_url"))
        .otherwise(F.when(some, "baseline_unmarked_correct").otherwise("baseline_unmarked_no_official"))
    )
    return rows.select("provider_id", "provider_name", source.alias("label_source"), F.when(some, "official").otherwise("no_official").alias("expected_kind"), url.alias("expected_url"), F.when(some, urls.domain(url)).otherwise("").alias("expected_domain"))


def verification_input(final: DataFrame, task: DataFrame, pos: str = "pos") -> DataFrame:
    """Task rows over their final rows: cells that the task fills win, columns are those of both."""
    packed = final.withColumn("__k", entity_key()).filter("__k <> ''").groupBy("__k").agg(F.max_by(F.struct(*final.columns), pos).alias("__f"))
    rows = task.withColumn("__key", entity_key()).join(packed, F.col("__key") == F.col("__k"), "left")
    cell = lambda c: F.coalesce(F.when(F.col(c).cast("string") != "", F.col(c)), F.col(f"__f.{c}")) if c in final.columns else F.col(c)
    return rows.select(*[cell(c).alias(c) for c in task.columns], *[F.col(f"__f.{c}").alias(c) for c in final.columns if c not in task.columns])


def high_risk(status: Column, confidence: Column, evidence: Column, official_url: Column, candidate_url: Column, name: Column, accepted: Column) -> Column:
    """Whether a final row goes to verification. ``accepted``: taken by the second pass."""
    e, sure = F.lower(blank(evidence)), whole_number(confidence.cast("string"))
    has = lambda *w: F.coalesce(*[F.when(e.contains(x), True) for x in w], F.lit(False))
    vague = ambiguous_name(name)
    low = F.lower(blank(name))
    same_name = (sure >= 85) & vague & ~has("listing_logo_visual_match") & (low.contains("consult") | low.contains("seller") | (has("domain_contains_provider_slug") & ~has("domain_exact_provider_slug")))
    lone_logo = has("listing_logo_visual_match", "listing_logo_visual_near_match") & ~has("page_contains_exact_provider_name", "page_contains_provider_name_tokens", "page_contains_amazon_service_keywords", "page_mentions_amazon_spn")
    return (
        (blank(official_url) == "")
        | (status != "matched")
        | accepted
        | (sure < MATCHED_CUTOFF)
        | has("identity_cap_", "page_industry_mismatch:", "provider_name_not_found")
        | not_independent(candidate_url)
        | same_name
        | (vague & ~strong_identity(e))
        | lone_logo
    )


def _facts(listed: Column) -> Column:
    return F.filter(F.transform(F.split(blank(listed), ";"), lambda x: F.regexp_replace(F.trim(x), r"\s+", "_")), lambda x: x != "")


def evidence_features(name: Column, review_reason: Column, decision: Column, unsure: Column, score: Column, supporting: Column, counter: Column, candidate_domain: Column) -> Column:
    """Sorted feature array of a review row and its verification: reason, decision, score bounds, facts had and missed, the name's shape, its relation to the domain."""
    once = F.struct(text.tokens_of(text.normalized(name)).alias("words"), _facts(supporting).alias("facts"), F.lower(blank(name)).alias("low"), text.slug(name).alias("own"), text.slug(urls.base_label(candidate_domain)).alias("other"))
    return text.let(once, lambda x: _features(x, review_reason, decision, unsure, score, counter))


def _features(once: Column, review_reason: Column, decision: Column, unsure: Column, score: Column, counter: Column) -> Column:
    none = F.array().cast("array<string>")
    words, facts, low, own, other = (once[c] for c in ("words", "facts", "low", "own", "other"))
    n, meaningful, joined = F.size(words), F.size(F.filter(words, lambda w: ~w.isin(GENERIC_TOKENS))), F.array_join(words, "")
    both = (own != "") & (other != "")
    shared = F.size(F.filter(words, lambda w: other.contains(w)))
    tagged = lambda tag, c: F.when(blank(c) != "", F.concat(F.lit(tag), c))
    single = [
        tagged("review_reason:", review_reason),
        tagged("agent_b_decision:", decision),
        tagged("reason_for_unsure:", unsure),
        *[F.when(score >= t, f"agent_b_score>={t}").otherwise(f"agent_b_score<{t}") for t in SCORE_BOUNDS],
        F.when(F.exists(facts, lambda f: f.startswith("location_matches:")), "has:location_matches"),
        F.when(n > 0, F.concat(F.lit("provider_token_count:"), F.least(n, F.lit(5)).cast("string"))),
        F.when(n == 1, "provider_name_shape:single_token"),
        F.when(meaningful <= 1, "provider_name_shape:generic_or_one_meaningful_token"),
        F.when(F.length(joined) <= 4, "provider_name_shape:short"),
        *[F.when(low.contains(m), f"provider_name_contains:{m}") for m in NAME_MARKERS],
        F.when(both & (own == other), "domain_relation:exact_provider_slug").when(both & other.contains(own), "domain_relation:domain_contains_provider_slug").when(both & own.contains(other), "domain_relation:provider_slug_contains_domain"),
        F.when(both & (shared >= 1), "domain_relation:provider_token_in_domain"),
        F.when(both & (shared >= 2), "domain_relation:two_provider_tokens_in_domain"),
    ]
    missing = F.filter(F.array(*map(F.lit, IDENTITY_FACTS)), lambda m: ~F.exists(facts, lambda f: (f == m) | f.startswith(F.concat(m, F.lit(":")))))
    prefixed = lambda tag, c: F.transform(F.coalesce(c, none), lambda x: F.concat(F.lit(tag), x))
    every = F.concat(F.array_compact(F.array(*[c.cast("string") for c in single])), prefixed("has:", facts), prefixed("missing:", missing), prefixed("counter:", _facts(counter)))
    return F.array_sort(F.array_distinct(F.filter(every, lambda x: ~x.endswith(":"))))


def labeled_pattern_rows(details: DataFrame, checks: DataFrame, scope: str) -> DataFrame:
    """Rows for pattern mining: details (labels with outcome, output_domain) that were verified in the scope's review lanes, with correct and features."""
    rows = matched_to(details, checks).filter(F.col("row").isNotNull())
    c = lambda n: blank(F.col(f"row.{n}"))
    listed = [c("candidate_url")] + ([F.col("output_domain")] if scope == "precision" else [])
    rows = rows.withColumns({"candidate_domain": urls.domain(first_filled(*listed)), "review_reason": c("review_reason")}).filter("candidate_domain <> ''")
    reason = F.col("review_reason")
    if scope == "recall":
        rows, right = rows.filter(reason == TOP_CANDIDATE), (F.col("expected_kind") == "official") & (F.col("candidate_domain") == F.col("expected_domain"))
    else:
        rows, right = rows.filter(reason.startswith("precision_")), F.col("outcome") == "correct_official"
    made = evidence_features(first_filled(F.col("provider_name"), c("provider_name")), reason, c("decision"), c("reason_for_unsure"), whole_number(F.col("row.evidence_score").cast("string")), c("supporting_facts"), c("counter_evidence"), F.col("candidate_domain"))
    return rows.select("provider_id", F.lit(scope).alias("scope"), right.alias("correct"), "candidate_domain", "review_reason", made.alias("features"))


def sample_priority(review_reason: Column, decision: Column, unsure: Column, pattern_kind: Column) -> Column:
    """struct(priority, reason) of a row in a calibration sample; the first rule that applies."""
    r, d = blank(review_reason), blank(decision)
    rules = [
        (blank(unsure) == "agent_b_row_timeout", 100, "timeout_needs_manual"),
        (pattern_kind == "actionable_release", 98, "actionable_release_validation"),
        (pattern_kind == "durable_safe", 96, "pattern_candidate_validation"),
        (pattern_kind == "risky", 74, "pattern_control_validation"),
        (d == "reject", 92, "agent_b_reject_check"),
        ((d == "accept") & r.startswith("precision_"), 88, "agent_b_accept_risky_lane"),
        (r == TOP_CANDIDATE, 80, "recall_candidate_label"),
        (d == "unsure", 70, "agent_b_unsure_label"),
        (r.contains("slug_extension"), 68, "slug_extension_label"),
        (r.contains("generic_identity"), 66, "generic_identity_label"),
        (r.contains("second_pass_accepted"), 62, "second_pass_threshold_label"),
        (r.contains("low_confidence"), 58, "low_confidence_label"),
    ]
    made = lambda p, w: F.struct(F.lit(p).alias("priority"), F.lit(w).alias("reason"))
    return F.coalesce(*[F.when(cond, made(p, w)) for cond, p, w in rules], made(40, "general_calibration"))


def lane_included(target: DataFrame, release_status: str = "", with_validated: bool = False) -> DataFrame:
    """Label targets whose lane belongs in a labelling task. A validated pattern release with no labels needed and none against it is left out."""
    reason, c = blank(F.col("review_reason")), F.col
    validated = (reason == "precision_calibrated_pattern_release") & (c("decisive_rows_needed") == 0) & (c("blocking_rows") == 0) & F.lit(release_status == "current_guarded_candidate" and not with_validated)
    wanted = c("recommendation").isin(PROTECTED) | (c("priority").isin("high", "medium") & (reason.startswith("precision_") | (reason == TOP_CANDIDATE)))
    return target.filter((reason != "") & ~F.coalesce(validated, F.lit(False)) & F.coalesce(wanted, F.lit(False)))
