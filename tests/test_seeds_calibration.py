"""Brand slugs, acceptance of second-pass results, note tags."""

from pyspark.sql import functions as F

from siteresolve.config import EXCLUDED_DOMAINS
from siteresolve.operators import calibration, seeds


def test_brand_slugs_and_tlds(spark):
    names = ["Acme Growth Digital Agency Ltd", "Solo", "Digital Agency", "深圳", "Foo Bar Baz"]
    rows = spark.createDataFrame([(k, n) for k, n in enumerate(names)], "k int, n string").select("k", seeds.brand_slugs(F.col("n")).alias("s")).orderBy("k").collect()
    assert [r["s"] for r in rows] == [
        ["acmegrowthdigitalagency", "acmegrowthdigital", "acmegrowth"],
        ["solo"],
        ["digitalagency", "digital"],
        [],
        ["foobarbaz", "foobar"],
    ]
    tlds = spark.range(1).select(seeds.location_tlds(F.array(F.lit("Ukraine"))).alias("a"), seeds.location_tlds(F.array(F.lit("Mars"))).alias("b")).first()
    assert tlds["a"] == ["co.uk", "uk", "com", "co", "io", "net"] and tlds["b"] == ["com", "co", "io", "net"]


def test_acceptance(spark):
    def row(k, url, status, confidence, evidence, *found):
        return (k, url, status, confidence, evidence, [(u, s, r, False) for u, s, r in found])

    rows = [
        row("high", "https://a.com", "matched", 90, ""),
        row("thin", "https://a.com", "matched", 78, "", ("https://a.com/x", "brave", ["top_search_result"])),
        row("two", "https://a.com", "matched", 78, "", ("https://a.com/x", "brave", ["x"]), ("a.com", "exa", ["y"])),
        row("strong", "https://a.com", "matched", 78, "page_mentions_amazon_spn; x"),
        row("capped", "https://a.com/", "matched", 95, "", ("https://a.com", "brave", ["identity_cap_logo_only_evidence"])),
        row("sibling", "https://a.com/", "matched", 95, "", ("https://a.com", "brave", ["x"]), ("https://b.com", "brave", ["identity_cap_logo_only_evidence"])),
        row("proven", "https://a.com", "needs_review", 55, "", ("https://a.com", "domain_guess", ["http_ok_home", "domain_exact_provider_slug", "page_contains_provider_name_tokens"])),
        row("login", "https://a.com/login", "matched", 95, ""),
        row("excluded", "https://m.facebook.com/a", "matched", 95, ""),
        row("low", "https://a.com", "low_confidence", 95, ""),
    ]
    df = spark.createDataFrame(rows, "provider_id string, official_url string, status string, confidence int, evidence_summary string, candidates array<struct<url:string,source:string,reasons:array<string>,reject:boolean>>")
    got = {r["provider_id"] for r in seeds.accepted(df, EXCLUDED_DOMAINS).filter("accepted").collect()}
    assert got == {"high", "two", "strong", "sibling", "proven"}


def test_note_tags(spark):
    notes = [("No official page", "u.com", "", "reject"), ("同名 timeout", "", "", ""), ("", "http://a.com/x", "www.a.com", "replace"), ("", "", "", "unsure")]
    df = spark.createDataFrame([(k, *n) for k, n in enumerate(notes)], "k int, n string, c string, m string, d string")
    got = [r["t"] for r in df.select("k", calibration.note_tags(F.col("n"), F.col("c"), F.col("m"), F.col("d"), F.lit("")).alias("t")).orderBy("k").collect()]
    assert got == [["wrong_candidate_no_replacement", "confirmed_no_official"], ["candidate_unreachable", "wrong_company"], ["domain_variant_fix"], ["insufficient_evidence"]]


def test_policy_and_targets(spark):
    rows = [("accept", "holdout", "", ""), ("reject", "Holdout", "", ""), ("replace", "release", "https://www.a.com/", "a.com"), ("reject", "release", "a.com", ""), ("unsure", "release", "", ""), ("", "release", "", "")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, d string, a string, c string, m string")
    got = [r["o"] for r in df.select("k", calibration.policy_outcome(F.col("d"), F.col("a"), F.col("c"), F.col("m")).alias("o")).orderBy("k").collect()]
    assert got == ["holdout_blocked", "holdout_supported", "release_supported", "release_blocked", "manual_unsure", "unlabeled"]
    lanes = spark.createDataFrame([("a", 2, 0, ""), ("b", 9, 1, ""), ("c", 9, 7, ""), ("d", 9, 0, "candidate_for_review_downgrade")], "review_reason string, rows int, decisive_rows int, recommendation string")
    got = {r["review_reason"]: (r["priority"], r["target_decisive_rows"], r["decisive_rows_needed"]) for r in calibration.label_targets(lanes, ["a"], ["b"], []).collect()}
    assert got == {"a": ("high", 2, 2), "b": ("medium", 3, 2), "c": ("normal", 5, 0), "d": ("high", 5, 5)}
