"""Reasons, queues and recommendations on worked rows."""

from siteresolve.operators import recommend, reports


def test_priority_reasons(spark):
    rows = [
        ("x", "Acme", "has country_conflict", "", ""),
        ("precision_slug_extension_identity_risk", "Acme Media House", "FUZZY match", "", "accept"),
        ("precision_slug_extension_identity_risk", "Acme Media House", "FUZZY match", "", ""),
        ("precision_slug_extension_identity_risk", "Best Seller Agency", "", "", ""),
        ("recall_unresolved_top_candidate", "Acme", "some_service_content_matches", "", ""),
        ("recall_unresolved_top_candidate", "Acme", "", "candidate_pages_not_fetchable", ""),
        ("precision_low_confidence_auto_match", "Müller", "", "", ""),
        ("precision_low_confidence_auto_match", "Amazon Scaling Co", "", "", ""),
        ("precision_generic_identity_term_risk", "Öko Handel und Mehr", "", "", ""),
        ("", None, None, None, None),
    ]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, review_reason string, provider_name string, supporting_facts string, counter_evidence string, agent_b_decision string")
    got = [(r["priority_reason"], r["decision_impact"]) for r in recommend.priority_reason(df).orderBy("k").collect()]
    assert got == [
        ("country_conflict_boundary", "country_and_language"),
        ("slug_extension_agentb_accept", "slug_extension"),
        ("slug_extension_fuzzy_identity", "slug_extension"),
        ("slug_extension_generic_identity", "slug_extension"),
        ("recall_name_gap_with_service_match", "recall_rule"),
        ("unfetchable_candidate_boundary", "recall_rule"),
        ("localized_low_confidence_boundary", "country_and_language"),
        ("descriptive_provider_name_boundary", "generic_names"),
        ("localized_generic_identity_boundary", "country_and_language"),
        ("protected_lane_boundary", "none_alone"),
    ]


def test_judge_queue(spark):
    rows = [("a", "", "", "90", "80"), ("b", "lane", "", "90", "80"), ("c", "", "logo_match", "90", "80"), ("d", "", "logo; page_contains_exact_provider_name", "90", "80"), ("e", "", "", "82", "80"), ("f", "", "", "90", "74"), ("g", "", "", "x", "99")]
    df = spark.createDataFrame(rows, "id string, review_reason string, supporting_facts string, confidence string, evidence_score string")
    assert {r["id"] for r in recommend.judge_queue(df).collect()} == {"b", "c", "e", "f", "g"}


def test_tagged_recommendations(spark):
    rows = [(1, "1", "n", ["candidate_unreachable", "domain_variant_fix"]), (2, "2", "n", ["wrong_candidate_no_replacement", "confirmed_no_official"]), (3, "", " ", ["wrong_company"]), (4, "4", "n", []), (5, "5", "n", ["candidate_unreachable"])]
    df = spark.createDataFrame(rows, "pos int, provider_id string, provider_name string, note_tags array<string>")
    got = {r["kind"]: (r["n"], r["examples"], r["safe_to_apply"]) for r in recommend.tagged_recommendations(df, examples=1).collect()}
    assert got == {"url_reachability": (3, ["1"], False), "no_official_regression": (1, ["2"], False)}


def test_lanes_without_decisive_labels_and_clean_ones(spark):
    make = lambda lane, kind, outcome, decision, n, issue="": [(lane, kind, outcome, decision, issue)] * n
    rows = make("p", "precision", "candidate_correct", "accept", 5) + make("r", "recall", "recall_candidate_useful", "accept", 12) + make("q", "recall", "recall_candidate_not_useful", "reject", 1) + make("q", "recall", "recall_candidate_useful", "accept", 9)
    rows += make("u", "precision", "manual_unsure", "unsure", 3) + make("i", "precision", "candidate_correct", "accept", 9, "invalid_manual_decision") + make("", "precision", "candidate_correct", "accept", 1)
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "pos int, review_reason string, lane_kind string, calibration_outcome string, normalized_decision string, decision_quality_issue string")
    got = [(r["review_reason"], r["recommendation"], r["evidence_strength"], r["decisive_rows"]) for r in recommend.lane_recommendations(df).orderBy("rank").collect()]
    assert got == [("q", "keep_review_lane", "blocked", 10), ("p", "candidate_for_review_downgrade", "minimum_support", 5), ("r", "candidate_for_narrow_recall_rule", "strong_support", 12), ("i", "needs_more_labels", "unlabeled", 0), ("u", "needs_more_labels", "unlabeled", 0)]


def test_verification_recommendations(spark):
    schema = "pos int, provider_id string, decision string, candidate_url string, evidence_score string, counter_evidence string, reason_for_unsure string, independent_search_queries string"
    rows = [(1, "1", "accept", "https://a.com", "90", "", "", ""), (2, "2", "reject", "https://b.com", "9", "", "", "")]
    kinds = lambda r: {(x["kind"], x["domain"], x["n"]) for x in reports.verification_recommendations(spark.createDataFrame(r, schema)).collect()}
    assert kinds(rows) == {("labels_only", "", 0)}
    assert kinds([]) == set()
    more = [(3, "3", "reject", "https://b.com/x", "9", "", "", ""), (4, "4", "reject", "https://linkedin.com/x", "9", "", "", ""), (5, "5", "replace", "", "", "", "", "q1; q2"), (6, "6", "replace", "", "", "", "", "q1")]
    assert kinds(rows + more) == {("excluded_domain", "b.com", 2), ("excluded_domain", "linkedin.com", 1), ("second_pass_query", "", 2)}
