"""Preliminary scores of candidate sites, and the best one per provider."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import ACCEPT_SCORE, EXCLUDED_DOMAINS, REVIEW_SCORE, SERVICE_KEYWORDS
from ..functions import fuzzy, geo, text, urls

NOT_SEARCHED = ["domain_guess", "second_pass_domain_variant", "second_pass_input_url", "second_pass_top_candidate"]
# Words that don't identify a company.
GENERIC_WORDS = [
    "amazon", "account", "agency", "consulting", "consultancy", "digital", "ecom", "ecommerce", "global", "growth", "management",
    "marketplace", "media", "seller", "sellers", "service", "services", "solution", "solutions", "brand", "brands",
]
# Reasons that a summary names first.
FIRST_REASONS = [
    "javascript_page_requires_dynamic_review", "page_requires_javascript", "dynamic_rendered_page", "dynamic_render_unavailable", "dynamic_render_failed",
    "page_contains_amazon_service_keywords", "page_contains_some_service_keywords", "search_snippet_contains_amazon_service_keywords",
    "search_snippet_contains_some_service_keywords", "page_mentions_amazon_spn", "page_contains_exact_provider_name", "page_contains_provider_name_tokens",
    "page_fuzzy_provider_name_match", "listing_logo_visual_match", "listing_logo_visual_near_match", "identity_cap_industry_mismatch_without_service",
    "identity_cap_country_conflict_without_service", "identity_cap_country_conflict_needs_review", "identity_cap_ambiguous_name_requires_page_and_service",
    "identity_cap_generic_name_requires_location", "identity_cap_logo_only_evidence", "identity_cap_missing_service_country_corroboration",
]


def _plain(words: list[str]) -> Column:
    return F.array(*[F.lit(geo._plain(w)) for w in words])


def meaningful(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(GENERIC_WORDS))


def ambiguous_name(name: Column) -> Column:
    tokens = text.tokens_of(text.normalized(name))
    return (F.size(tokens) > 0) & ((F.size(meaningful(tokens)) <= 1) | (F.length(F.array_join(tokens, "")) <= 4))


def generic_name(name: Column) -> Column:
    tokens = text.tokens_of(text.normalized(name))
    return (F.size(tokens) >= 2) & (F.size(meaningful(tokens)) == 0)


#: Name similarity: shared words of all words, or the token-set ratio (an Arrow function).
SIMILARITY = {"words": text.similarity, "token_set": fuzzy.token_set}


def provider_features(providers: DataFrame) -> DataFrame:
    """Adds struct ``own``: what scores need of a provider's name and locations. Computed once a provider, before candidates meet it."""
    name, places = text.normalized(F.col("provider_name")), F.col("provider_locations")
    rows = providers.withColumns({"__name": name, "__tlds": geo.expected_suffixes(places), "__markers": geo.plain_markers(places)})
    own = F.struct(F.col("__name").alias("name"), F.replace("__name", F.lit(" "), F.lit("")).alias("short"), text.tokens_of(F.col("__name")).alias("words"), F.col("__tlds").alias("tlds"), F.col("__markers").alias("markers"))
    return rows.withColumn("own", own).drop("__name", "__tlds", "__markers")


def score_candidates(candidates: DataFrame, fuzzy_names: str = "words") -> DataFrame:
    """Adds domain, reject, score and reasons, from name, address, snippet, rank, query and locations.

    Needs ``own`` of ``provider_features`` (or else provider_name and provider_locations) beside the candidate's columns. Each part that several rules use is a column of its own,
    computed once. ``fuzzy_names``: a key of SIMILARITY.
    """
    similar = SIMILARITY[fuzzy_names]
    given = candidates if "own" in candidates.columns else provider_features(candidates)
    rows = given.withColumns({"domain": urls.domain(F.col("url")), "said": text.normalized(F.concat_ws(" ", text.blank(F.col("title")), text.blank(F.col("snippet")))), "name": F.col("own.name"), "short": F.col("own.short"), "words": F.col("own.words")})
    rows = rows.withColumn("label", text.normalized(urls.base_label(F.col("domain"), is_domain=True)))
    rows = rows.withColumns(
        {
            "label_slug": F.replace(F.col("label"), F.lit(" "), F.lit("")),
            "in_label": F.filter("words", lambda t: F.replace(F.col("label"), F.lit(" "), F.lit("")).contains(t)),
            "in_said": F.filter("words", lambda t: F.col("said").contains(t)),
            "services": F.size(F.filter(_plain(SERVICE_KEYWORDS), lambda k: F.col("said").contains(k))),
            "signal": geo.suffix_signal(urls.suffix(F.col("domain")), F.col("own.tlds")),
            "markers": F.col("own.markers"),
            "like_label": similar(F.col("name"), F.col("label")),
            "like_said": similar(F.col("name"), F.col("said")),
            "searched": F.col("rank").isNotNull() & (F.col("rank") > 0),
        }
    )
    c = F.col
    named = c("short") != ""
    n_in_label, n_in_said = F.size("in_label"), F.size("in_said")
    by_name = (
        F.when(named & (c("short") == c("label_slug")), F.struct(F.lit(35).alias("p"), F.lit("domain_exact_provider_slug").alias("r")))
        .when(named & (c("label_slug").contains(c("short")) | c("short").contains(c("label_slug"))), F.struct(F.lit(25).alias("p"), F.lit("domain_contains_provider_slug").alias("r")))
        .when(c("like_label") >= 92, F.struct(F.lit(24).alias("p"), F.lit("domain_fuzzy_provider_match").alias("r")))
        .when(n_in_label > 0, F.struct(F.least(F.lit(22), 8 * n_in_label).alias("p"), F.concat(F.lit("domain_token_match:"), F.array_join(F.slice("in_label", 1, 4), ",")).alias("r")))
    )
    rule = lambda points, reason: F.struct(F.lit(points).alias("p"), F.lit(reason).alias("r"))
    by_text = (
        F.when((c("name") != "") & c("said").contains(c("name")), rule(15, "search_result_contains_exact_name"))
        .when(c("like_said") >= 90, rule(12, "search_result_fuzzy_name_match"))
        .when((F.size("words") > 0) & (n_in_said >= F.least(F.lit(2), F.size("words"))), rule(8, "search_result_contains_name_tokens"))
    )
    by_rank = F.when(c("searched") & (c("rank") <= 3) & ~text.blank(c("source")).isin(NOT_SEARCHED), rule(8, "top_search_result"))
    by_query = F.when(F.lower(text.blank(c("query"))).contains("official website") & c("searched") & (c("rank") <= 5), rule(6, "official_website_query_hit"))
    by_service = F.when(c("services") >= 3, rule(8, "search_snippet_contains_amazon_service_keywords")).when(c("services") > 0, rule(3, "search_snippet_contains_some_service_keywords"))
    by_country = F.when(c("signal") == "match", rule(6, "domain_tld_matches_provider_country")).when(c("signal") == "conflict", rule(-8, "domain_tld_conflicts_provider_country"))
    by_place = F.when(F.exists("markers", lambda m: c("said").contains(m)), rule(4, "search_result_contains_provider_country"))
    rows = rows.withColumn("rules", F.array_compact(F.array(by_name, by_text, by_rank, by_query, by_service, by_country, by_place)))
    reject = urls.excluded(c("domain"), EXCLUDED_DOMAINS, is_domain=True)
    rows = rows.withColumns(
        {
            "reject": reject,
            "score": F.when(reject, F.lit(-100)).otherwise(F.aggregate("rules", F.lit(0), lambda s, x: s + x["p"])),
            "reasons": F.when(reject, F.array(F.lit("excluded_domain"))).otherwise(F.concat(F.transform("rules", lambda x: x["r"]), F.array(F.lit("not_fetched_preliminary_score")))),
        }
    )
    return rows.select(*[x for x in candidates.columns if x != "own"], "domain", "reject", "score", "reasons")


def is_search_source(source: Column) -> Column:
    return ~F.regexp_replace(text.blank(source), "_snippet_url$", "").isin("domain_guess", "second_pass_domain_variant", "")


def to_inspect(scored: DataFrame, n: int = 2, pos: str = "pos") -> DataFrame:
    """The candidates whose pages are worth reading: the best ``n``; if none of them came from a search, the last place goes to the best one that did."""
    w = Window.partitionBy("provider_id")
    rows = scored.filter(~F.col("reject")).withColumn("__s", is_search_source(F.col("source")))
    rows = rows.withColumn("__n", F.row_number().over(w.orderBy(F.desc("score"), pos)))
    rows = rows.withColumn("__has", F.max(F.col("__s") & (F.col("__n") <= n)).over(w)).withColumn("__first", F.min(F.when(F.col("__s"), F.col("__n"))).over(w))
    swap = F.lit(n > 1) & ~F.col("__has") & F.col("__first").isNotNull()
    keep = F.when(swap, (F.col("__n") <= n - 1) | (F.col("__n") == F.col("__first"))).otherwise(F.col("__n") <= n)
    return rows.filter(keep).drop("__s", "__n", "__has", "__first")


def summary(reasons: Column) -> Column:
    """Up to six reasons, the telling ones first."""
    first = F.filter(reasons, lambda r: r.isin(FIRST_REASONS) | r.startswith("page_industry_mismatch:"))
    return F.array_join(F.slice(F.array_distinct(F.concat(first, reasons)), 1, 6), "; ")


def choose_best(providers: DataFrame, scored: DataFrame, pos: str = "pos", accept: int = ACCEPT_SCORE, review: int = REVIEW_SCORE) -> DataFrame:
    """A row per provider: address, domain, confidence, status, evidence and counts. The best candidate is one aggregation; providers without any are not_found."""
    viable = scored.withColumn("__v", ~F.col("reject"))
    best = viable.groupBy("provider_id").agg(
        F.max_by(F.struct("url", "domain", "score", "reasons"), F.when(F.col("__v"), F.struct("score", (-F.col(pos)).alias("p")))).alias("b"),
        F.count(F.lit(1)).alias("candidate_count"),
        F.count_if("__v").alias("scored_candidate_count"),
    )
    rows = providers.join(best, "provider_id", "left")
    found = F.col("b.score").isNotNull()
    confidence = F.when(found, F.greatest(F.lit(0), F.least(F.lit(100), F.col("b.score")))).otherwise(0).cast("long")
    status = F.when(~found, "not_found").when(confidence >= accept, "matched").when(confidence >= review, "needs_review").otherwise("low_confidence")
    shown = found & (confidence >= review)
    return rows.select(
        "provider_id",
        "provider_name",
        F.when(shown, F.col("b.url")).otherwise("").alias("official_url"),
        F.when(shown, F.col("b.domain")).otherwise("").alias("official_domain"),
        confidence.alias("confidence"),
        status.alias("status"),
        F.when(found, summary(F.col("b.reasons"))).otherwise("No non-excluded candidate domains found.").alias("evidence_summary"),
        F.coalesce("candidate_count", F.lit(0)).alias("candidate_count"),
        F.coalesce("scored_candidate_count", F.lit(0)).alias("scored_candidate_count"),
    )
