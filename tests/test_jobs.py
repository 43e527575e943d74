"""Small tables with worked results, and properties that hold for any."""

from itertools import combinations

from pyspark.sql import functions as F

from siteresolve.operators import balance, candidates, finalize, patterns, providers, review, scoring


def test_merge_keeps_order_and_first_values(spark):
    rows = [("p-1", "", "B", 3), ("p-1", "Acme", "A", 1), ("p-1", "Other", "B", 2), ("p-2", None, None, 4), ("", "x", "y", 5), (None, "x", "y", 6)]
    raw = spark.createDataFrame(rows, "provider_id string, provider_name string, service_api string, pos long")
    got = {r["provider_id"]: r for r in providers.merge_providers(providers.valid_rows(raw), {"service_api": "apis"}, {"provider_name": "provider_name"}).collect()}
    assert set(got) == {"p-1", "p-2"}
    assert (got["p-1"]["provider_name"], got["p-1"]["apis"], got["p-1"]["source_rows"]) == ("Acme", ["A", "B"], 3)
    assert (got["p-2"]["provider_name"], got["p-2"]["apis"]) == ("", [])


def test_finalize_decisions(spark):
    results = spark.createDataFrame(
        [("1", "A", "matched", "www.a.com/login", "80"), ("2", "B", "needs_review", "b.com", "50"), ("3", "C", "matched", "c.com", "90"), ("4", "D", "low_confidence", "", "1"), ("5", "E", "matched", "e.com", "77"), ("", "f", "not_found", "", "")],
        "provider_id string, provider_name string, status string, official_url string, confidence string",
    )
    decisions = spark.createDataFrame(
        [("2", "", "yes", "", 1, ""), ("3", "", "拒绝", "", 1, ""), ("4", "", "", "//new.org/x.", 1, "n"), ("5", "", "perhaps", "", 1, ""), ("9", "F", "accept", "", 1, ""), ("2", "", "no", "", 0, "")],
        "provider_id string, provider_name string, manual_decision string, manual_url string, pos long, notes string",
    )
    got = {r["provider_name"]: (r["status"], r["decision_source"], r["official_url"], r["official_domain"], r["notes"]) for r in finalize.finalize(results, decisions).collect()}
    assert got == {
        "A": ("matched", "auto_matched", "https://www.a.com/", "a.com", ""),
        "B": ("manual_accepted", "manual_accept", "https://b.com", "b.com", ""),
        "C": ("rejected", "manual_reject", "", "", ""),
        "D": ("manual_accepted", "manual_replace", "https://new.org/x", "new.org", "n"),
        "E": ("invalid_manual_decision", "invalid_manual_decision", "", "", "invalid:perhaps"),
        "f": ("unresolved", "manual_accept_missing_url", "", "", "manual_accept_missing_url"),
    }
    assert finalize.finalize(results.limit(0), decisions).count() == 0


def test_candidates_dedupe_and_cap(spark):
    rows = [("1", k, u, s) for k, (u, s) in enumerate([("https://a.com/", "s"), ("a.com", "s"), ("https://a.com", "t"), ("", "s"), ("g.com", "domain_guess"), ("b.com", "s"), ("c.com", "s"), ("h.com", "domain_guess")])]
    df = spark.createDataFrame(rows, "provider_id string, pos int, url string, source string")
    once = candidates.dedupe_candidates(df)
    assert sorted(r["pos"] for r in once.collect()) == [0, 1, 4, 5, 6, 7]
    assert candidates.dedupe_candidates(once).count() == once.count()
    assert sorted(r["pos"] for r in candidates.cap_candidates(once, 4).collect()) == [0, 1, 4, 7]


def test_preliminary_score(spark):
    rows = [
        (0, "https://acmegrowth.de", "Acme Growth official", "amazon ppc advertising in Germany", "brave", "x official website", 1),
        (1, "https://linkedin.com/acme", "Acme Growth", "", "brave", "", 1),
        (2, "https://other.fr", "", "", "domain_guess", "", 1),
    ]
    df = spark.createDataFrame(rows, "pos int, url string, title string, snippet string, source string, query string, rank int")
    df = df.withColumns({"provider_id": F.lit("1"), "provider_name": F.lit("Acme Growth Ltd"), "provider_locations": F.array(F.lit("Germany"))})
    got = {r["pos"]: r for r in scoring.score_candidates(df).collect()}
    assert got[0]["score"] == 35 + 15 + 8 + 6 + 8 + 6 + 4
    assert got[1]["score"] == -100 and got[1]["reject"] and got[1]["reasons"] == ["excluded_domain"]
    assert got[2]["score"] == -8 and "domain_tld_conflicts_provider_country" in got[2]["reasons"]
    best = scoring.choose_best(df.select("provider_id", "provider_name").distinct(), scoring.score_candidates(df)).first()
    assert (best["status"], best["official_domain"], best["candidate_count"], best["scored_candidate_count"]) == ("matched", "acmegrowth.de", 3, 2)


def test_label_precision(spark):
    labels = spark.createDataFrame([("1", "", "official", "a.com"), ("2", "", "official", "b.com"), ("3", "", "official", "c.com"), ("4", "", "official", "d.com")], "provider_id string, provider_name string, expected_kind string, expected_domain string")
    output = spark.createDataFrame([("1", "", "matched", "90", "https://www.a.com/x", 1), ("2", "", "matched", "76", "b.com", 1), ("3", "", "matched", "x", "z.com", 1)], "provider_id string, provider_name string, status string, confidence string, official_url string, pos int").withColumn("official_domain", F.lit(""))
    details = balance.evaluate_labels(labels, output)
    one = balance.summarize(details).first()
    assert (one["auto_precision"], one["official_recall"], one["over_rejected_rows"]) == (0.6667, 0.5, 1)
    sweep = {r["threshold"]: r["official_output_rows"] for r in balance.threshold_sweep(details, [0, 80, 95]).collect()}
    assert sweep == {0: 2, 80: 1, 95: 0}


def test_patterns_equal_brute_force(spark):
    sets = [(list("abc"), True), (list("abd"), False), (list("bc"), True), (list("abc"), True), ([], True), (list("cde"), False)]
    rows = spark.createDataFrame([(k, f, c) for k, (f, c) in enumerate(sets)], "row_id int, features array<string>, correct boolean")
    want = {}
    for f, c in sets:
        for n in (1, 2, 3):
            for p in combinations(sorted(set(f)), n):
                s, r = want.get(" AND ".join(p), (0, 0))
                want[" AND ".join(p)] = (s + 1, r + c)
    mined = patterns.mine(rows, 3)
    assert {r["pattern"]: (r["support_rows"], r["correct_rows"]) for r in mined.collect()} == want
    good = {p for p, (s, c) in want.items() if s == c and s >= 2}
    minimal = {p for p in good if not any(q != p and set(q.split(" AND ")) < set(p.split(" AND ")) for q in good)}
    assert {r["pattern"] for r in patterns.minimal(patterns.safe(mined, 2)).collect()} == minimal
    assert {r["pattern"] for r in patterns.safe(patterns.mine(rows, 3, 2, durable_only=True), 2).collect()} == good


def test_review_samples(spark):
    rows = spark.createDataFrame([("a", 5, 1), ("a", 9, 2), ("b", 7, 3), ("b", 1, 4), ("c", 8, 5)], "review_reason string, score int, seq int")
    got = [(r["review_reason"], r["seq"]) for r in review.round_robin(rows, "review_reason", [F.desc("score"), F.col("seq")], 4, 2).collect()]
    assert got == [("a", 2), ("c", 5), ("b", 3), ("a", 1)]
