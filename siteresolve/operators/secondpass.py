"""A second look at rows without a site: the plan per row, the review task, and the verification's page roles, risks and decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, text, urls
from ..functions.text import blank, whole_number
from .providers import entity_key
from .scoring import ambiguous_name

TIERS = {"needs_review": "A_verify_top_candidate", "not_found": "D_registry_social_then_manual"}
# Extra queries by country; {n} is the name.
COUNTRY_QUERIES = [
    ("india", ['"{n}" MCA', '"{n}" GST website']),
    ("united states", ['"{n}" LLC official site', '"{n}" "contact us"']),
    ("germany", ['"{n}" GmbH website', '"{n}" "Impressum"']),
    ("united kingdom", ['"{n}" Companies House website', '"{n}" "contact"']),
    ("china", ['"{n}" 官网', '"{n}" official site']),
    ("italy", ['"{n}" "sito ufficiale"', '"{n}" "partita iva"']),
    ("spain", ['"{n}" "sitio web oficial"', '"{n}" CIF']),
    ("france", ['"{n}" "site officiel"', '"{n}" SIREN']),
]
# Order of the review reasons in a task.
REASON_ORDER = {
    "precision_second_pass_accepted_lt70": 0, "precision_second_pass_accepted_70_84": 1, "precision_second_pass_accepted_85_plus": 2, "precision_identity_constraint_risk": 3,
    "precision_generic_identity_term_risk": 4, "precision_slug_extension_identity_risk": 5, "precision_ambiguous_name_risk": 6, "precision_calibrated_pattern_release": 6,
    "precision_low_confidence_auto_match": 7, "recall_unresolved_top_candidate": 8, "recall_unresolved_manual_search": 9,
}
MATCHED_CUTOFF, SECOND_PASS_CUTOFF = 83, 85


def _filled(template: str, name: Column, **more: Column) -> Column:
    out = F.replace(F.lit(template), F.lit("{n}"), name)
    for k, v in more.items():
        out = F.replace(out, F.lit("{" + k + "}"), v)
    return out


def tier(status: Column, source: Column, score: Column) -> Column:
    return (
        F.when(status == "needs_review", TIERS["needs_review"])
        .when(status == "not_found", TIERS["not_found"])
        .when((source == "domain_guess") | (score >= 35), "B_verify_or_expand_domain_guess")
        .otherwise("C_broaden_search")
    )


def plan(rows: DataFrame, most: int = 8) -> DataFrame:
    """Rows with strategy_tier and query_1 to query_8. Needs status, candidate_1_url, _source, _score, provider_name, provider_locations, service_apis."""
    c = lambda n: blank(F.col(n))
    name, place = c("provider_name"), F.coalesce(F.get("provider_locations", F.lit(0)), F.lit(""))
    service = F.coalesce(F.get("service_apis", F.lit(0)), F.lit("Amazon service provider"))
    host = F.when(c("candidate_1_url") != "", urls.domain(F.col("candidate_1_url"))).otherwise("")
    step = tier(c("status"), c("candidate_1_source"), whole_number(F.col("candidate_1_score").cast("string")))
    rows = rows.withColumns({"strategy_tier": step, "top_candidate_domain": host, "__place": place})
    by_country = F.coalesce(*[F.when(F.lower("__place").contains(k), F.array(*[_filled(q, name) for q in qs])) for k, qs in COUNTRY_QUERIES], F.array().cast("array<string>"))
    top = F.col("top_candidate_domain")
    made = F.concat(
        F.array(*[_filled(q, name, s=service) for q in ('"{n}" official website', '"{n}" website -linkedin -facebook -instagram -amazon', '"{n}" "contact"', '"{n}" "{s}"')]),
        F.when(F.col("__place") != "", F.array(_filled('"{n}" "{p}" website', name, p=F.col("__place")))).otherwise(F.array().cast("array<string>")),
        F.when(top != "", F.array(_filled('site:{t} "{n}"', name, t=top), _filled('"{n}" "{t}"', name, t=top))).otherwise(F.array().cast("array<string>")),
        by_country,
        F.transform(F.slice(geo.search_terms(F.array("__place")), 1, 5), lambda t: F.concat(F.lit('"'), name, F.lit('" "'), t, F.lit('"'))),
        F.when(F.col("strategy_tier") == TIERS["not_found"], F.array(_filled('"{n}" LinkedIn website', name), _filled('"{n}" Crunchbase website', name))).otherwise(F.array().cast("array<string>")),
    )
    rows = rows.withColumn("__q", F.array_distinct(made))
    return rows.withColumns({f"query_{k + 1}": F.coalesce(F.get("__q", F.lit(k)), F.lit("")) for k in range(most)}).drop("__q", "__place")


def plan_summary(planned: DataFrame) -> DataFrame:
    return planned.groupBy("strategy_tier", "status").agg(F.count(F.lit(1)).alias("rows"))


def review_task(final: DataFrame, second_pass: DataFrame, cutoff: int = MATCHED_CUTOFF) -> DataFrame:
    """Final rows that a person must look at, with review_reason, top_candidate_url and priority (the task's order is priority, confidence, name)."""
    second = second_pass.withColumn("__k", entity_key()).groupBy("__k").agg(F.max_by(F.struct("official_url", "previous_top_candidate_url", "evidence_summary", "accepted_for_final"), "pos").alias("s"))
    rows = final.withColumn("__key", entity_key()).join(second, F.col("__key") == F.col("__k"), "left")
    c = lambda n: blank(F.col(n))
    confidence = whole_number(F.col("confidence").cast("string"))
    evidence = F.lower(F.coalesce(F.nullif(c("evidence_summary"), F.lit("")), c("s.evidence_summary")))
    rows = rows.withColumns({"__c": confidence, "__e": evidence, "__amb": ambiguous_name(F.col("provider_name"))})
    sure, e, status = F.col("__c"), F.col("__e"), c("status")
    constrained = e.contains("identity_cap_") | e.contains("page_industry_mismatch:")
    risky = (sure >= 85) & F.col("__amb") & ~e.contains("listing_logo_visual_match")
    low = F.lower(c("provider_name"))
    generic = risky & (low.contains("consult") | low.contains("seller"))
    extended = risky & e.contains("domain_contains_provider_slug") & ~e.contains("domain_exact_provider_slug")
    no_url = c("official_url") == ""
    accepted = status == "manual_accepted"
    needed = F.when(no_url, True).when(accepted, sure < SECOND_PASS_CUTOFF).when(status != "matched", True).otherwise((sure < cutoff) | constrained | generic | extended)
    known = (c("s.official_url") != "") | (c("s.previous_top_candidate_url") != "")
    reason = (
        F.when(no_url & known, "recall_unresolved_top_candidate")
        .when(no_url, "recall_unresolved_manual_search")
        .when(status == "calibrated_released", "precision_calibrated_pattern_release")
        .when(accepted & (sure < 70), "precision_second_pass_accepted_lt70")
        .when(accepted & (sure < SECOND_PASS_CUTOFF), "precision_second_pass_accepted_70_84")
        .when(accepted, "precision_second_pass_accepted_85_plus")
        .when(constrained, "precision_identity_constraint_risk")
        .when(generic, "precision_generic_identity_term_risk")
        .when(extended, "precision_slug_extension_identity_risk")
        .when(sure < MATCHED_CUTOFF, "precision_low_confidence_auto_match")
        .otherwise("spot_check_non_matched_status")
    )
    order = F.create_map(*[F.lit(x) for kv in REASON_ORDER.items() for x in kv])
    top = F.coalesce(*[F.nullif(x, F.lit("")) for x in (c("official_url"), c("s.official_url"), c("s.previous_top_candidate_url"))], F.lit(""))
    return rows.withColumn("review_reason", reason).filter(needed).select(*final.columns, "review_reason", top.alias("top_candidate_url"), F.coalesce(F.try_element_at(order, F.col("review_reason")), F.lit(9)).alias("priority"))


def _contains_any(c: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


# Directory sites, and what a path says about a page.
DIRECTORIES = r"(^|\.)(clutch\.co|goodfirms\.co|crunchbase\.com|trustpilot\.com|indiamart\.com|kompass\.com)$"
PATH_RISKS = {
    "candidate_looks_platform_profile": ["/profile", "/profiles/", "/company/", "/companies/"],
    "candidate_looks_login_or_app_page": ["/login", "/signin", "/sign-in", "/app", "/dashboard"],
    "candidate_looks_docs_help_support_page": ["/docs", "/documentation", "/help", "/support", "/kb", "/api"],
}


def _path_risks(path: Column) -> list[tuple[Column, str]]:
    return [(_contains_any(path, words), risk) for risk, words in PATH_RISKS.items()]


def address_risks(url: Column) -> Column:
    """What an address alone says against it."""
    pairs = [*_path_risks(F.lower(urls.path_part(url))), (urls.domain(url).rlike(DIRECTORIES), "candidate_looks_directory_page")]
    return F.array_compact(F.array(*[F.when(cond, F.lit(v)) for cond, v in pairs]))


def page_roles(read: DataFrame) -> DataFrame:
    """url, roles (home, about, contact, services, privacy, terms) and risks of read pages."""
    path = F.lower(urls.path_part(F.col("url")))
    head = text.normalized(F.concat_ws(" ", "title", "h1", "nav", "footer"))
    rows = read.withColumns({"__p": path, "__h": head, "__t": text.normalized(F.concat_ws(" ", "title", "meta", "h1", "h2", "footer", F.substring("text", 1, 6000))), "__d": urls.domain(F.col("url"))})
    p, h, t, d = (F.col(x) for x in ("__p", "__h", "__t", "__d"))
    roles = [
        (p.isin("", "/"), "home"),
        (p.contains("about") | h.contains("about us"), "about"),
        (p.contains("contact") | h.contains("contact us") | (F.size("mailto_links") > 0), "contact"),
        (p.contains("service") | h.contains("services"), "services"),
        (p.contains("privacy") | h.contains("privacy policy"), "privacy"),
        (p.contains("terms") | h.contains("terms and conditions") | h.contains("terms of service"), "terms"),
    ]
    listing = _contains_any(t, ["claim this profile", "company profile", "business directory", "supplier profile", "view profile", "review this company"])
    directory = d.rlike(DIRECTORIES)
    risks = [
        *_path_risks(p),
        (_contains_any(t, ["domain for sale", "buy this domain", "this domain may be for sale", "sedo domain parking", "hugedomains"]), "candidate_looks_parked_or_domain_sale"),
        (listing | directory, "candidate_looks_directory_page"),
    ]
    listed = lambda pairs: F.array_compact(F.array(*[F.when(cond, F.lit(v)) for cond, v in pairs]))
    return rows.select("url", listed(roles).alias("roles"), listed(risks).alias("risks"))


def verification_decision(score: Column, facts: Column, counters: Column, replacement_url: Column, replacement_score: Column, reason: Column) -> Column:
    """struct(decision, url, confidence, reason_for_unsure): rules in order, first that applies."""
    strict = reason.isin("precision_low_confidence_auto_match", "precision_second_pass_accepted_70_84", "precision_generic_identity_term_risk", "precision_slug_extension_identity_risk")
    replaceable, contradicted, reviewed = blank(replacement_url) != "", F.size(counters) > 0, blank(reason) != ""
    blocking = F.exists(counters, lambda x: x.startswith("candidate_looks_")) | F.array_contains(counters, "candidate_not_independent_official_site")
    held = lambda c: F.greatest(F.lit(0), F.least(F.lit(69), c))
    row = lambda d, u, c, r: F.struct(F.lit(d).alias("decision"), u.alias("url"), c.cast("int").alias("confidence"), F.lit(r).alias("reason_for_unsure"))
    none, better = F.lit(""), F.greatest(score, replacement_score)
    return (
        F.when(reason.startswith("recall_unresolved"), row("unsure", none, held(better), "recall_candidate_needs_human_confirmation"))
        .when(replaceable & reviewed, row("unsure", none, held(better), "replacement_candidate_needs_human_confirmation"))
        .when(reviewed & contradicted, row("unsure", none, held(score), "high_risk_counter_evidence_needs_human_confirmation"))
        .when(strict & ~F.array_contains(facts, "listing_logo_visual_match"), row("unsure", none, F.least(F.lit(69), score), "high_risk_identity_needs_human_confirmation"))
        .when((score >= 70) & ~blocking, row("accept", none, F.least(F.lit(100), score), ""))
        .when(replaceable, row("replace", replacement_url, F.greatest(F.lit(70), F.least(F.lit(95), F.when(replacement_score == 0, 70).otherwise(replacement_score))), ""))
        .when((score <= 20) & contradicted, row("reject", none, F.least(F.lit(90), F.greatest(F.lit(50), 100 - score)), ""))
        .otherwise(row("unsure", none, held(score), "insufficient_or_conflicting_evidence"))
    )


# What makes an address too risky to accept without a person.
RISKY_DOMAINS = ["hugedomains.com", "atom.com", "all.biz", "inc.com", "itch.io", "indiamart.com", "recaptcha.cloud"]
RISKY_HOST_PARTS = ["zendesk.", "hubspotpagebuilder.", "myshopify.com", "app.", "apps.", "staging.", "develop.", "onboarding.", "refund."]
RISKY_PATH_PARTS = ["domain_profile", "/name/", "suspendedpage", "/login", "/password", "/signin", "/sign-in"]


def risky_address(url: Column) -> Column:
    """Parked or platform domains, application hosts, and log-in or profile paths (also in the query)."""
    after = F.lower(F.regexp_extract(blank(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://)?[^/?#]*([^#]*)", 1))
    host = urls.domain(url)
    return urls.excluded(host, RISKY_DOMAINS) & (host != "") | _contains_any(host, RISKY_HOST_PARTS) | _contains_any(after, RISKY_PATH_PARTS)


def strong_identity(evidence: Column) -> Column:
    """Whether an evidence summary names the company on the page or its own domain, together with its services."""
    has = lambda *w: _contains_any(evidence, list(w))
    page = has("page_contains_exact_provider_name", "page_contains_provider_name_tokens", "page_fuzzy_provider_name_match")
    named = page | has("search_result_contains_exact_name", "domain_exact_provider_slug")
    services = has("page_contains_amazon_service_keywords", "page_contains_some_service_keywords", "page_mentions_amazon_spn", "search_snippet_contains_amazon_service_keywords")
    return ~has("identity_cap_", "page_industry_mismatch:") & named & services & (page | has("domain_exact_provider_slug", "listing_logo_visual_match"))


def visual_lane(final: DataFrame, excluded_domains: list[str], below: int = MATCHED_CUTOFF) -> DataFrame:
    """Final rows that need a look at the page itself, with visual_reason. Needs candidate_url (the second pass's best) beside the final columns."""
    c = lambda n: blank(F.col(n))
    evidence, name = F.lower(c("evidence_summary")), F.lower(c("provider_name"))
    accepted = (c("official_url") != "") & c("status").isin("matched", "manual_accepted")
    candidate = F.coalesce(F.nullif(c("official_url"), F.lit("")), c("candidate_url"))
    reason = (
        F.when(accepted & _contains_any(evidence, ["identity_cap_", "page_industry_mismatch:"]), "precision_identity_constraint")
        .when(accepted & (ambiguous_name(F.col("provider_name")) | _contains_any(name, ["consult", "seller"])), "precision_same_name_risk")
        .when(accepted & (whole_number(F.col("confidence").cast("string")) < below), "precision_low_confidence_accept")
        .when(~accepted & (candidate != "") & ~urls.excluded(candidate, excluded_domains), "recall_unresolved_candidate")
    )
    return final.withColumn("visual_reason", reason).filter(F.col("visual_reason").isNotNull())
