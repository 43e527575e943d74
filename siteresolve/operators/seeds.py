"""Seeds and acceptance of the second pass: addresses to try for rows without a site, and when a result may be accepted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, urls
from ..functions.text import blank
from .scoring import FIRST_REASONS
from .secondpass import risky_address

# Words at a name's end that a brand's address often leaves out.
TRAILING_WORDS = [
    "agency", "consulting", "consultancy", "digital", "ecom", "ecommerce", "global", "group", "infotech", "marketing", "media", "services", "service", "solution",
    "solutions", "technologies", "technology",
]
# Top-level domains to try first for a location; the first marker found counts.
LOCATION_TLDS = [
    ("united kingdom", ["co.uk", "uk"]), ("uk", ["co.uk", "uk"]), ("india", ["in", "co.in"]), ("germany", ["de"]), ("italy", ["it"]), ("france", ["fr"]), ("spain", ["es"]),
    ("brazil", ["com.br", "br"]), ("united arab emirates", ["ae"]), ("uae", ["ae"]), ("china", ["cn", "com.cn"]), ("canada", ["ca"]), ("australia", ["com.au", "au"]),
    ("singapore", ["sg", "com.sg"]), ("netherlands", ["nl"]), ("poland", ["pl"]),
]
COMMON_TLDS = ["com", "co", "io", "net"]
BLOCKING_CAPS = [r for r in FIRST_REASONS if r.startswith("identity_cap_")]
STRONG = ["page_contains_exact_provider_name", "page_mentions_amazon_spn", "page_contains_amazon_service_keywords", "listing_logo_visual_match"]
SEARCH_SOURCES = ["serpapi", "brave", "tavily", "serper", "firecrawl", "exa", "ddgs"]


def _words(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def brand_slugs(name: Column, most: int = 4) -> Column:
    """The slug, then slugs without trailing generic words one by one, then the first two words; four letters or more, distinct."""
    words = text.tokens_of(text.normalized(name))
    n = F.size(words)
    meaning = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: ~F.coalesce(F.get(words, k - 1), F.lit("")).isin(TRAILING_WORDS))
    least = F.greatest(F.lit(1), F.coalesce(F.array_max(meaning), F.lit(1)))
    shorter = F.when(n - 1 >= least, F.transform(F.sequence(n - 1, least, F.lit(-1)), lambda k: F.array_join(F.slice(words, F.lit(1), k), ""))).otherwise(F.array().cast("array<string>"))
    two = F.when(n >= 2, F.array(F.array_join(F.slice(words, 1, 2), ""))).otherwise(F.array().cast("array<string>"))
    made = F.concat(F.array(text.slug(name)), shorter, two)
    return F.slice(F.array_distinct(F.filter(made, lambda s: F.length(s) >= 4)), 1, most)


def location_tlds(locations: Column) -> Column:
    said = F.lower(F.array_join(F.coalesce(locations, F.array().cast("array<string>")), " "))
    own = F.coalesce(*[F.when(said.contains(m), _words(t)) for m, t in LOCATION_TLDS], F.array().cast("array<string>"))
    return F.array_distinct(F.concat(own, _words(COMMON_TLDS)))


def domain_variants(providers: DataFrame, excluded_domains: list[str]) -> DataFrame:
    """provider_id, seed_pos, url: brand slugs under the location's top-level domains, without excluded ones."""
    pairs = F.flatten(F.transform(brand_slugs(F.col("provider_name")), lambda s: F.transform(location_tlds(F.col("provider_locations")), lambda t: F.concat(F.lit("https://www."), s, F.lit("."), t))))
    return providers.select("provider_id", F.posexplode(pairs).alias("seed_pos", "url")).filter(~urls.excluded(F.col("url"), excluded_domains))


def mentioned_seeds(providers: DataFrame, fields: list[str], excluded_domains: list[str]) -> DataFrame:
    """provider_id, seed_pos, url: addresses in the listing's own texts."""
    found = F.transform(urls.mentioned(F.concat_ws(" ", *fields)), lambda u: F.when(u.startswith("http"), u).otherwise(F.concat(F.lit("https://"), u)))
    return providers.select("provider_id", F.posexplode(found).alias("seed_pos", "url")).filter(~urls.excluded(F.col("url"), excluded_domains))


# Where second-pass seeds come from, in the order in which they count.
SEED_SOURCES = ["second_pass_top_candidate", "second_pass_input_url", "second_pass_domain_variant"]


def seed_candidates(planned: DataFrame, fields: list[str], excluded_domains: list[str]) -> DataFrame:
    """provider_id, pos (source, place), url, source, rank of a second pass's seeds: the planned row's top candidate, the addresses in its listing's texts (``fields``), and its name's variants; no excluded ones.

    Of equal addresses of a provider the first stays. One projection a row and one grouping by provider and address.
    """
    top = blank(F.col("top_candidate_url"))
    first = planned.filter((top != "") & ~urls.excluded(top, excluded_domains)).select("provider_id", F.lit(0).alias("seed_pos"), top.alias("url"))
    parts = [first, mentioned_seeds(planned, fields, excluded_domains), domain_variants(planned, excluded_domains)]
    each = [p.select("provider_id", F.struct(F.lit(k).alias("source_pos"), F.col("seed_pos").cast("int").alias("place")).alias("pos"), "url", F.lit(s).alias("source")) for k, (p, s) in enumerate(zip(parts, SEED_SOURCES))]
    one = each[0].union(each[1]).union(each[2]).groupBy("provider_id", "url").agg(F.min_by("source", "pos").alias("source"), F.min("pos").alias("pos"))
    rank = F.when(F.col("source") == SEED_SOURCES[2], 0).otherwise(F.col("pos.place") + 1)  # a variant is a guess
    return one.select("provider_id", "pos", "url", "source", rank.alias("rank"))


def semantic_queries(name: Column, location: Column, service: Column, most: int = 3) -> Column:
    n, place = blank(name), blank(location)
    full = lambda *p: F.trim(F.concat(*[F.lit(x) if isinstance(x, str) else x for x in p]))
    made = F.array_compact(
        F.array(
            full('official company website for "', n, '" Amazon seller service provider ', place),
            full('"', n, '" ecommerce agency marketplace services official site contact ', place),
            full('"', n, '" Amazon Seller Central marketplace agency official website contact'),
            full('"', n, '" about us contact official website ', place),
            F.when(blank(service) != "", full('official website for "', n, '" providing ', blank(service), " services")),
        )
    )
    return F.when(n == "", F.array().cast("array<string>")).otherwise(F.slice(F.array_distinct(made), 1, most))


def verified(candidate: Column) -> Column:
    """Whether one candidate (struct with reasons, source) proves the site: a page that answered, a domain and a page, search or service that name the company."""
    some = lambda *r: F.arrays_overlap(candidate["reasons"], _words(list(r)))
    answered = some("http_ok_home", "http_ok_supporting_page")
    strong_domain = some("domain_exact_provider_slug", "domain_contains_provider_slug", "domain_fuzzy_provider_match")
    token_domain = F.exists(candidate["reasons"], lambda r: r.startswith("domain_token_match:"))
    strong_page = some("page_contains_exact_provider_name", "page_fuzzy_provider_name_match", "listing_logo_visual_match")
    page = strong_page | some("page_contains_provider_name_tokens")
    search = some("search_result_contains_exact_name", "search_result_contains_name_tokens", "search_result_fuzzy_name_match")
    service = some("page_contains_amazon_service_keywords", "page_mentions_amazon_spn", "search_snippet_contains_amazon_service_keywords")
    asked, top = some("official_website_query_hit"), some("top_search_result")
    searched = F.regexp_replace(blank(candidate["source"]), "_snippet_url$", "").isin(SEARCH_SOURCES)
    domain = strong_domain | token_domain
    return (
        (answered & strong_domain & (page | service | (search & asked)))
        | (answered & token_domain & (strong_page | service) & (search | asked | top))
        | (answered & service & (page | search) & domain)
        | (searched & domain & search & asked & (top | service))
    )


def accepted(results: DataFrame, excluded_domains: list[str], threshold: int = 75) -> DataFrame:
    """Results (official_url, status, confidence, evidence_summary, candidates) with ``accepted``.

    Only the selected candidate's caps block; siblings on the same domain may add support.
    """
    c = F.col
    url, host = blank(c("official_url")), urls.domain(blank(c("official_url")))
    bare = lambda u: F.regexp_replace(blank(u), "/+$", "")
    rows = results.withColumns({"__u": url, "__h": host, "__s": F.split(blank(c("evidence_summary")), "; ")})
    rows = rows.withColumn("__same", F.filter("candidates", lambda x: urls.domain(x["url"]) == F.col("__h")))
    chosen = F.get(F.filter("candidates", lambda x: bare(x["url"]) == bare(F.col("__u"))), F.lit(0))["reasons"]
    blocked = F.arrays_overlap(F.coalesce(chosen, c("__s")), _words(BLOCKING_CAPS))
    strong = F.arrays_overlap(c("__s"), _words(STRONG)) | F.exists("__same", lambda x: F.arrays_overlap(x["reasons"], _words(STRONG)))
    supports = F.size(F.array_distinct(F.filter(F.transform("__same", lambda x: blank(x["source"])), lambda s: ~s.isin("", "domain_guess", "second_pass_domain_variant")))) >= 2
    proven = (c("confidence") >= 50) & (c("__h") != "") & F.exists("__same", lambda x: ~x["reject"] & verified(x))
    good = F.when((c("status") == "matched") & (c("confidence") >= 85), True).when((c("status") == "matched") & (c("confidence") >= threshold), strong | supports).otherwise(proven)
    barred = (c("__u") == "") | urls.excluded(c("__u"), excluded_domains) | risky_address(c("__u")) | blocked | ~c("status").isin("matched", "needs_review")
    return rows.withColumn("accepted", F.coalesce(~barred & good, F.lit(False))).drop("__u", "__h", "__s", "__same")
