"""Verification of candidate sites from page evidence: score, facts and counter-evidence; replacements; further searches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import EXCLUDED_DOMAINS, SERVICE_KEYWORDS
from ..functions import geo, text, urls
from ..functions.text import blank
from .scoring import _plain
from .secondpass import address_risks, page_roles

# Paths that are read under a candidate's root, in order, and how many pages count.
PATHS = ["/", "/about", "/contact", "/services", "/privacy", "/terms", "/about-us", "/contact-us"]
MOST_PAGES = 4
# Words of normalized page text, and what in an address or name counts against a site.
LEGAL_WORDS = ["llc", "ltd", "limited", "gmbh", "sarl", "s.r.l", "inc", "private limited"]
COMPANY_PAGES = ["contact us", "about us", "privacy policy", "terms of service", "terms and conditions"]
SOCIAL_DOMAINS = ["linkedin.com", "facebook.com", "instagram.com", "youtube.com", "crunchbase.com", "trustpilot.com"]
PROFILE_PATHS = ["/profile", "/company/", "/login", "/signin", "/sign-in"]
GENERIC_NAMES = [
    "amazon", "account", "management", "service", "services", "seller", "sellers", "ecommerce", "e-commerce", "marketplace", "boosting", "growth", "consulting", "consultancy",
]
BLOCKING_RISKS = [
    "candidate_looks_platform_profile", "candidate_looks_directory_page", "candidate_looks_login_or_app_page", "candidate_looks_docs_help_support_page", "candidate_looks_parked_or_domain_sale",
]
SEARCH_AGAIN = [
    "candidate_pages_not_fetchable", "provider_name_not_found_on_candidate_pages", "candidate_not_independent_official_site", "candidate_looks_platform_profile",
    "candidate_looks_directory_page", "candidate_looks_parked_or_domain_sale", "identity_gap_location_or_service_context_missing",
]
SAFE_SCORE = 70


def _strings(*values: str) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def _said(c: Column, words: list[str]) -> Column:
    return F.exists(_strings(*words), lambda w: c.contains(w))


def not_independent(url: Column) -> Column:
    """A page on a social or review site, or a profile or log-in page."""
    return (urls.excluded(url, SOCIAL_DOMAINS) & (urls.domain(url) != "")) | _said(F.lower(urls.path_part(url)), PROFILE_PATHS)


def organization_text(organizations: Column) -> Column:
    parts = F.transform(organizations, lambda o: F.array_join(F.filter(F.array(*[blank(o[f]) for f in ("name", "legalName", "url", "address", "contactPoint")]), lambda x: x != ""), " "))
    return F.array_join(F.filter(parts, lambda x: x != ""), " ")


def _named(name: Column, words: Column, said: Column) -> tuple[Column, Column]:
    """Whether a text has the whole normalized name, or else two of its words (one, if it has no more)."""
    whole = (name != "") & said.contains(name)
    return whole, ~whole & (F.size(words) > 0) & (F.size(F.filter(words, lambda w: said.contains(w))) >= F.least(F.lit(2), F.size(words)))


def organization_facts(orgs: Column, org_said: Column, name: Column, words: Column, place: Column) -> list[tuple[Column, int, Column]]:
    """(holds, points, fact) of what the pages' organization records say. ``place``: a location that they or the pages name."""
    whole, part = _named(name, words, org_said)
    some, any_of = F.size(orgs) > 0, lambda f: F.exists(orgs, lambda o: blank(o[f]) != "")
    return [
        (some & whole, 15, F.lit("schema_org_name_matches_provider")),
        (some & part, 8, F.lit("schema_org_name_token_match")),
        (some & any_of("legalName"), 6, F.lit("schema_org_legal_name_seen")),
        (some & any_of("address"), 5, F.lit("schema_org_address_seen")),
        (some & any_of("contactPoint"), 5, F.lit("schema_org_contact_point_seen")),
        (some & place.isNotNull(), 5, F.concat(F.lit("schema_or_page_location_matches:"), place)),
    ]


def site_pages(candidates: DataFrame, read: DataFrame) -> DataFrame:
    """Per candidate (provider_id, pos) with a page: ``pages``, up to MOST_PAGES of the first of its roots that has one, in the order of PATHS.

    Two equi-joins: addresses to try with read pages, and those found with the pages' facts, which are made once per page.
    """
    facts = read.select(
        "url",
        text.normalized(F.concat_ws(" ", "title", "meta", "h1", "h2", "nav", "footer", "text", organization_text(F.col("organizations")))).alias("said"),
        F.array_compact(F.array(F.when(F.col("h1") != "", F.lit("page_h1_seen")), F.when(F.col("footer") != "", F.lit("footer_text_seen")), F.when(F.size("mailto_links") > 0, F.lit("mailto_link_found")), F.when(F.size("tel_links") > 0, F.lit("telephone_link_found")))).alias("facts"),
        "organizations",
    ).join(page_roles(read), "url")
    tried = candidates.select("provider_id", "pos", F.posexplode(urls.roots(F.col("url"))).alias("root_pos", "root"))
    tried = tried.select("*", F.posexplode(_strings(*PATHS)).alias("path_pos", "path")).withColumn("page", F.concat("root", "path"))
    seen = tried.join(facts.select(F.col("url").alias("page"), F.struct("said", "facts", "roles", "risks", "organizations").alias("f")), "page")
    one = seen.groupBy("provider_id", "pos", "root_pos", "root").agg(F.slice(F.sort_array(F.collect_list(F.struct("path_pos", "page", "f"))), 1, MOST_PAGES).alias("pages"))
    first = one.groupBy("provider_id", "pos").agg(F.min_by(F.struct("root", "pages"), "root_pos").alias("x"))
    return first.select("provider_id", "pos", "x.root", "x.pages")


def verify_sites(candidates: DataFrame, read: DataFrame) -> DataFrame:
    """Per candidate (provider_id, pos, url, provider_name, provider_locations; logo_share, if there is such a column): domain, score from -100 to 100, evidence_urls, supporting_facts, counter_evidence.

    A blank address has score 0 and nothing else; an excluded domain -100.
    """
    none = _strings()
    rows = candidates.join(site_pages(candidates, read), ["provider_id", "pos"], "left").withColumns({"pages": F.coalesce("pages", F.array().cast("array<struct<path_pos:int,page:string,f:struct<said:string,facts:array<string>,roles:array<string>,risks:array<string>,organizations:array<struct<name:string,legalName:string,url:string,logo:string,address:string,contactPoint:string>>>>>"))})
    over = lambda f: F.transform("pages", f)
    rows = rows.withColumns(
        {
            "said": F.array_join(F.filter(over(lambda p: p["f"]["said"]), lambda x: x != ""), " "),
            "orgs": F.flatten(over(lambda p: p["f"]["organizations"])),
            "page_facts": F.flatten(over(lambda p: F.concat(p["f"]["facts"], F.transform(p["f"]["roles"], lambda r: F.concat(F.lit("page_role:"), r))))),
            "page_risks": F.concat(address_risks(F.col("url")), F.flatten(over(lambda p: p["f"]["risks"]))),
            "name": text.normalized(F.col("provider_name")),
            "places": F.filter(F.transform(F.coalesce("provider_locations", none), lambda x: F.struct(x.alias("given"), text.normalized(x).alias("plain"))), lambda x: x["plain"] != ""),
        }
    )
    rows = rows.withColumns({"words": text.tokens_of(F.col("name")), "org_said": text.normalized(organization_text(F.col("orgs")))})
    said, name, words, facts = (F.col(x) for x in ("said", "name", "words", "page_facts"))
    whole, part = _named(name, words, said)
    on_pages = F.get(F.filter("places", lambda x: said.contains(x["plain"])), F.lit(0))["given"]
    on_either = F.get(F.filter("places", lambda x: said.contains(x["plain"]) | F.col("org_said").contains(x["plain"])), F.lit(0))["given"]
    services = F.size(F.filter(_plain(SERVICE_KEYWORDS), lambda k: said.contains(k)))
    fetched, has = F.size("pages") > 0, lambda f: F.array_contains(facts, f)
    legal = _said(said, LEGAL_WORDS)
    share = F.coalesce(F.col("logo_share"), F.lit(0.0)) if "logo_share" in candidates.columns else F.lit(0.0)
    match, near = fetched & (share >= 0.88), fetched & (share >= 0.78) & (share < 0.88)
    meaningful = F.filter(words, lambda w: ~w.isin(GENERIC_NAMES))
    gap = (said == "") | ((F.size(words) > 0) & (F.size(meaningful) == 0) & ~whole) | ((F.size(F.coalesce("provider_locations", none)) > 0) & on_pages.isNull() & ~whole & ~legal)
    # in the order in which facts are listed; those with no points are listed only
    gained = [
        (fetched, 15, F.lit("candidate_pages_fetch_ok")),
        (whole, 30, F.lit("page_contains_exact_provider_name")),
        (part, 18, F.lit("page_contains_provider_name_tokens")),
        (legal, 8, F.lit("legal_entity_marker_found")),
        (_said(said, COMPANY_PAGES), 8, F.lit("standard_company_pages_found")),
        (has("page_role:about") & has("page_role:contact"), 5, F.lit("about_and_contact_pages_found")),
        (services >= 3, 15, F.lit("service_content_matches_amazon_provider")),
        ((services > 0) & (services < 3), 6, F.lit("some_service_content_matches")),
        (on_pages.isNotNull(), 7, F.concat(F.lit("location_matches:"), on_pages)),
        *organization_facts(F.col("orgs"), F.col("org_said"), name, words, on_either),
        (F.size("orgs") > 0, 5, F.lit("schema_org_organization_seen")),
    ]
    lone = not_independent(F.col("url"))
    against = [
        (~fetched, "candidate_pages_not_fetchable"),
        (~whole & ~part, "provider_name_not_found_on_candidate_pages"),
        ((F.size("orgs") > 0) & (F.col("org_said") != "") & (name != "") & ~F.col("org_said").contains(name), "schema_org_name_does_not_confirm_provider"),
        (lone, "candidate_not_independent_official_site"),
    ]
    points = [F.when(c, p).otherwise(0) for c, p, _ in gained]
    points += [F.when(has("mailto_link_found"), 5).otherwise(0), F.when(has("telephone_link_found"), 3).otherwise(0), F.when(match, 18).when(near, 8).otherwise(0), F.when(lone, -35).otherwise(0)]
    points += [F.when(F.arrays_overlap("page_risks", _strings(*BLOCKING_RISKS)), -35).otherwise(0), F.when(gap, -12).otherwise(0)]
    logo = F.array_compact(F.array(F.when(match, F.lit("listing_logo_visual_match")).when(near, F.lit("listing_logo_visual_near_match"))))
    moved = F.array_compact(F.array(F.when(fetched & (urls.domain(F.col("root")) != urls.domain(F.col("url"))), F.lit("canonical_domain_variant_fetch_ok"))))
    supporting = F.array_distinct(F.concat(logo, facts, moved, F.array_compact(F.array(*[F.when(c, f) for c, _, f in gained]))))
    counters = F.array_distinct(F.concat("page_risks", F.array_compact(F.array(*[F.when(c, F.lit(f)) for c, f in against], F.when(gap, F.lit("identity_gap_location_or_service_context_missing"))))))
    empty, out = blank(F.col("url")) == "", urls.excluded(F.col("url"), EXCLUDED_DOMAINS)
    return rows.select(
        "provider_id",
        "pos",
        "url",
        urls.domain(F.col("url")).alias("domain"),
        F.when(empty, 0).when(out, -100).otherwise(F.greatest(F.lit(-100), F.least(F.lit(100), sum(points[1:], points[0])))).cast("int").alias("score"),
        F.when(empty | out, none).otherwise(F.array_distinct(over(lambda p: p["page"]))).alias("evidence_urls"),
        F.when(empty | out, none).otherwise(supporting).alias("supporting_facts"),
        F.when(empty, none).when(out, _strings("excluded_domain")).otherwise(counters).alias("counter_evidence"),
    )


def needs_search(url: Column, score: Column, counters: Column) -> Column:
    """Whether a verified candidate calls for an independent search."""
    return (blank(url) == "") | (score < SAFE_SCORE) | F.arrays_overlap(counters, _strings(*SEARCH_AGAIN))


def independent_queries(name: Column, locations: Column) -> Column:
    """Search queries: official website, contact, the first location, and up to four local terms."""
    q = lambda x: F.concat(F.lit('"'), name, F.lit('" '), x)
    quoted = lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    places = F.coalesce(locations, _strings())
    made = F.concat(F.array(q(F.lit("official website")), q(F.lit("contact"))), F.transform(F.slice(places, 1, 1), lambda x: q(quoted(x))), F.transform(F.slice(geo.search_terms(places), 1, 4), lambda x: q(quoted(x))))
    return F.when(blank(name) == "", _strings()).otherwise(made)


def best_replacement(scored: DataFrame, current: DataFrame, first: int = 12, least: int = SAFE_SCORE) -> DataFrame:
    """provider_id, replacement_url, replacement_score: the best of a provider's first candidates (by pos) on another domain than its current_url. Ties go to the earlier one."""
    nth = F.row_number().over(Window.partitionBy("provider_id").orderBy("pos"))
    rows = scored.withColumn("nth", nth).filter(F.col("nth") <= first).filter(~F.col("reject") & (F.col("score") >= least))
    other = rows.join(current.select("provider_id", "current_url"), "provider_id", "left").filter(urls.domain(F.col("url")) != urls.domain(blank(F.col("current_url"))))
    best = other.groupBy("provider_id").agg(F.max_by(F.struct("url", "score"), F.struct("score", (-F.col("pos")).alias("p"))).alias("b"))
    return best.select("provider_id", F.col("b.url").alias("replacement_url"), F.col("b.score").alias("replacement_score"))
