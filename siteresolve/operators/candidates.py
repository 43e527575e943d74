"""Candidate sites: queries, guesses, mentions, dedupe, caps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geo, text, urls


def build_queries(providers: DataFrame) -> DataFrame:
    """Array ``queries``: fixed templates, the first location, up to five local terms, and the slug; distinct, in order."""
    name = text.compact(F.col("provider_name"))
    quoted = F.concat(F.lit('"'), name, F.lit('"'))
    hint = F.coalesce(F.get("service_apis", F.lit(0)), F.lit("Amazon service provider"))
    place = F.get("provider_locations", F.lit(0))
    short = text.slug(F.col("provider_name"))
    made = F.concat(
        F.array(F.concat(quoted, F.lit(" official website")), F.concat(quoted, F.lit(" Amazon service provider")), F.concat(quoted, F.lit(' "'), hint, F.lit('"')), F.concat(quoted, F.lit(" Seller Central"))),
        F.array_compact(F.array(F.concat(quoted, F.lit(' "'), place, F.lit('" website')))),
        F.transform(F.slice(geo.search_terms(F.col("provider_locations")), 1, 5), lambda t: F.concat(quoted, F.lit(' "'), t, F.lit('"'))),
        F.array_compact(F.array(F.when(short != "", F.concat(short, F.lit(" website"))))),
    )
    return providers.withColumn("queries", F.array_distinct(made))


def query_rows(with_queries: DataFrame, most: int = 6) -> DataFrame:
    """A row per query kept: provider_id, query_pos (from 0), query."""
    return with_queries.select("provider_id", F.posexplode(F.slice("queries", 1, most)).alias("query_pos", "query"))


def workload(with_queries: DataFrame, most: int = 6, sources: int = 1, per_query: int = 3, pages: int = 2, supporting: int = 3) -> DataFrame:
    """One row: providers, average queries, search requests, candidates and a bound on page reads."""
    n = F.least(F.size("queries"), F.lit(most))
    one = with_queries.agg(F.count(F.lit(1)).alias("providers"), F.sum(n).alias("queries"), F.round(F.avg(n), 2).alias("avg_queries"))
    return one.select(
        "providers", "avg_queries", (F.col("queries") * sources).alias("search_requests"), (F.col("queries") * sources * per_query).alias("search_candidates"), (F.col("providers") * pages * (1 + supporting)).alias("page_bound")
    )


def domain_guesses(providers: DataFrame) -> DataFrame:
    """provider_id, guess_pos, url: www.<slug>.com and <slug>.com; nothing for a blank slug."""
    short = text.slug(F.col("provider_name"))
    made = F.array(F.concat(F.lit("https://www."), short, F.lit(".com")), F.concat(F.lit("https://"), short, F.lit(".com")))
    return providers.withColumn("__s", short).filter("__s <> ''").select("provider_id", F.posexplode(made).alias("guess_pos", "url"))


def mentioned_sites(candidates: DataFrame) -> DataFrame:
    """Candidates for the addresses that titles and snippets mention; their source says so and evidence_url is the parent's address."""
    found = urls.mentioned(F.concat(text.blank(F.col("title")), F.lit(" "), text.blank(F.col("snippet"))))
    return candidates.select("*", F.posexplode(found).alias("mention_pos", "mention")).withColumns({"evidence_url": F.col("url"), "url": F.col("mention"), "source": F.concat(F.col("source"), F.lit("_snippet_url"))}).drop("mention")


def dedupe_candidates(candidates: DataFrame, pos: str = "pos") -> DataFrame:
    """The first candidate per provider, domain and address (no trailing slash); blank ones go. One aggregation."""
    rows = candidates.withColumn("__d", urls.domain(F.col("url"))).withColumn("__u", F.regexp_replace(F.trim(text.blank(F.col("url"))), "/+$", "")).filter("__d <> '' and __u <> ''")
    return rows.groupBy("provider_id", "__d", "__u").agg(F.min_by(F.struct(*candidates.columns), pos).alias("r")).select("r.*")


def cap_candidates(candidates: DataFrame, limit: int, pos: str = "pos") -> DataFrame:
    """At most ``limit`` per provider, but every domain guess: others come first, in order, up to what the guesses leave."""
    w = Window.partitionBy("provider_id")
    guess = (F.col("source") == "domain_guess").cast("int")
    rows = candidates.withColumn("__g", guess).withColumn("__guesses", F.sum("__g").over(w))
    rows = rows.withColumn("__n", F.row_number().over(w.orderBy("__g", pos)))
    return rows.filter((F.col("__g") == 1) | (F.col("__n") <= F.greatest(F.lit(limit) - F.col("__guesses"), F.lit(0)))).drop("__g", "__guesses", "__n")
