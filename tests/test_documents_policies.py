"""Pattern files, evidence lines and policy rows on worked documents."""

import json
import tempfile

from pyspark.sql import functions as F

from siteresolve.operators import patterns, policies
from siteresolve.sources import documents


def files(spark, *docs):
    d = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    for k, doc in enumerate(docs):
        with open(f"{d}/{k}.json", "w") as f:
            f.write(doc if isinstance(doc, str) else json.dumps(doc, indent=1))
    return documents.whole_files(spark, d)


ONE = {
    "summary": {"scope": "precision"},
    "reject_pattern": [{"pattern": "c AND a", "blocking_rows": "3"}],
    "durable_safe_patterns": [{"features": ["b", " a ", "a", ""], "support_rows": 0, "correct_recovery_rows": 4.0}, "text", {"features": []}, {"pattern": "x", "scope": "own"}],
}
TWO = {"pattern_rule_candidates": {"needs_more_labels": [{"pattern": "b AND a", "pattern_scope": "precision", "supporting_rows": 9}], "candidate_for_rule": [{"pattern": "z"}, {"features": [1, True]}]}, "all_patterns": {"no": "list"}}


def test_pattern_table(spark):
    got = {(r["scope"], tuple(r["features"])): (r["pattern"], r["source_support_rows"], r["source_wrong_rows"]) for r in documents.pattern_table(files(spark, ONE, TWO, "no json", "[1]")).collect()}
    assert got == {("precision", ("a", "b")): ("a AND b", 4, 0), ("precision", ("a", "c")): ("c AND a", 0, 3), ("own", ("x",)): ("x", 0, 0), ("recall", ("z",)): ("z", 0, 0), ("recall", ("1", "true")): ("1 AND true", 0, 0)}


def test_release_patterns(spark):
    chosen = {"selected_actionable_pattern_set": [{"pattern": "s", "correct_recovery_rows": 2}], "actionable_safe_patterns": [{"pattern": "left out"}], "safe_patterns": [{"pattern": "u", "correct_recovery_rows": 8}]}
    other = {"actionable_safe_patterns": [{"pattern": "b AND a", "supporting_rows": 2, "actionable": False}, {"pattern": "t", "correct_recovery_rows": 2, "wrong_release_rows": 1}], "pattern_rule_candidates": {"candidate_for_rule": [{"pattern": "a AND b"}, {"pattern": "r"}], "reject_pattern": [{"pattern": "n"}]}}
    rows = lambda **k: [(r["pattern"], r["actionable"]) for r in documents.release_patterns(files(spark, chosen, other), **k).orderBy("pattern_pos").collect()]
    assert rows() == [("s", True), ("b AND a", False), ("t", True), ("r", True)]
    assert rows(with_unsafe=True)[0] == ("u", True)


def test_evidence_lines_round_trip(spark):
    d = tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/lines"
    records = [("1", "Acme", 2, 1, [("https://a.com", "a.com", 70, False, ["r1", "r2"], "brave", "q", 1, "A", None)]), ("2", None, 0, 0, []), (None, "Solo", 1, 1, [])]
    df = spark.createDataFrame(records, documents.EVIDENCE)
    documents.write_evidence(df, d)
    with open(d + "/part-extra.json", "w") as f:
        f.write('﻿{"provider_id": "9", "other": 1, "candidates": [{"url": "u", "score": 5}]}\n\n   \n{"provider_id": \nnot json\n[1]\n')
    lines = documents.evidence_lines(spark, d)
    sound, broken = documents.sound_and_broken(lines)
    back = sound.filter("file NOT LIKE '%extra%'").select(df.columns)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    assert sorted(r["line"] for r in broken.collect()) == ["[1]", "not json", '{"provider_id": ']
    extra = sound.filter("provider_id = '9'").first()
    assert extra["candidates"][0]["score"] == 5 and extra["candidate_count"] is None


def test_with_evidence_by_id_and_by_name(spark):
    lines = [(1, "1", "Acme", 5), (2, "1", "Acme", 6), (3, "2", "SOLO", 7), (4, "", "other", 8)]
    made = spark.createDataFrame([(p, i, n, c) for p, i, n, c in lines], "pos long, provider_id string, provider_name string, candidate_count long").withColumn("candidates", F.array(F.struct(F.lit("u").alias("url"))))
    rows = spark.createDataFrame([("1", "x"), ("", "solo "), (None, "Other"), ("3", "acme"), ("", "")], "provider_id string, provider_name string")
    got = {(r["provider_id"], r["provider_name"]): (r["candidate_count"], len(r["candidates"])) for r in documents.with_evidence(rows, made).collect()}
    assert got == {("1", "x"): (6, 1), ("", "solo "): (7, 1), (None, "Other"): (8, 1), ("3", "acme"): (0, 0), ("", ""): (0, 0)}


def test_policy_rows(spark):
    final = spark.createDataFrame(
        [("1", "Acme", "https://a.com", "matched", 1), ("2", "Brite", "", "not_found", 2), ("3", "Core", "", "not_found", 3), ("4", "Dune", "https://d.com", "matched", 4), ("", "Echo", "", "unresolved", 5), ("2", "Brite", "", "not_found", 6), ("7", "Fern", "", "rejected", 7)],
        "provider_id string, provider_name string, official_url string, status string, pos long",
    )
    reviews = spark.createDataFrame([("1", "Acme", "lane_a", 1), ("1", "Acme", "", 2), ("4", "Dune", "lane_b", 3)], "provider_id string, provider_name string, review_reason string, pos long")
    check = lambda i, n, url, lane="recall_unresolved_top_candidate", counter="", decision="accept": (i, n, url, lane, counter, decision, "", "80", "", 1)
    checks = spark.createDataFrame(
        [check("2", "Brite", "https://brite.com/"), check("3", "Core", "https://app.core.com"), check("4", "Dune", "https://d.com", lane="x", decision="reject"), check("", "ECHO", "echo.org", counter="odd; candidate_not_independent_official_site"), check("7", "Fern", "https://fern.com")],
        "provider_id string, provider_name string, candidate_url string, review_reason string, counter_evidence string, decision string, reason_for_unsure string, evidence_score string, supporting_facts string, pos long",
    )
    listed = lambda *p: spark.createDataFrame(list(p), "pattern string, pattern_pos int, features array<string>")
    made = policies.policy_rows(final, reviews, checks, ["lane_a"], listed(("rejected", 0, ["agent_b_decision:reject"])), listed(("good", 0, ["agent_b_decision:accept", "agent_b_score>=80"])))
    got = {(r["provider_id"], r["action"], r["pattern"], r["policy_source"], r["candidate_url"], r["candidate_domain"]) for r in made.collect()}
    assert got == {("1", "holdout", "review_reason:lane_a", "hold_review_reason", "https://a.com", "a.com"), ("4", "holdout", "rejected", "hold_pattern", "https://d.com", "d.com"), ("2", "release", "good", "release_pattern", "https://brite.com", "brite.com")}
    assert made.count() == 3
    labels = spark.createDataFrame([("1", "", "official", "https://a.com", "a.com", 1), ("1", "", "no_official", "", "", 2), ("4", "", "unsure", "", "", 3)], "provider_id string, provider_name string, expected_kind string, expected_url string, expected_domain string, pos long")
    known = {r["provider_id"]: (r["known_label_status"], r["decisive"]) for r in policies.with_labels(made, labels).collect()}
    assert known == {"1": ("labeled_official", True), "4": ("labeled_unsure", False), "2": ("unlabeled", False)}


def test_policy_summary_never_broadcasts_unmeasured_features(spark, monkeypatch):
    monkeypatch.setattr(patterns, "BROADCAST_BYTES", 0, raising=False)
    ids = spark.range(40).select(F.col("id").cast("string").alias("provider_id"), F.concat(F.lit("Acme "), "id").alias("provider_name"), F.col("id").alias("pos"), (F.col("id") % 2 == 0).alias("own"))
    final = ids.select("provider_id", "provider_name", "pos", F.when(F.col("own"), F.concat(F.lit("https://a"), "pos", F.lit(".com"))).otherwise("").alias("official_url"), F.when(F.col("own"), "matched").otherwise("not_found").alias("status"))
    given = {"candidate_url": F.concat(F.lit("https://b"), "pos", F.lit(".com")), "decision": F.when(F.col("pos") % 4 < 2, "accept").otherwise("reject"), "evidence_score": F.lit("80"), "review_reason": F.lit(""), "reason_for_unsure": F.lit(""), "supporting_facts": F.lit("location_matches:Peru"), "counter_evidence": F.lit("")}
    checks = ids.withColumns(given)
    listed = lambda p, f: spark.createDataFrame([(p, 0, [f])], "pattern string, pattern_pos int, features array<string>")
    made = policies.policy_rows(final, ids.withColumn("review_reason", F.lit("lane_a")).filter("pos < 10"), checks, ["lane_a"], listed("no", "agent_b_decision:reject"), listed("yes", "agent_b_decision:accept"))
    labels = spark.createDataFrame([("1", "", "official", "", "", 1), ("2", "", "no_official", "", "", 1)], "provider_id string, provider_name string, expected_kind string, expected_url string, expected_domain string, pos long")
    summary = policies.policy_summary(policies.with_labels(made, labels))
    assert {tuple(r) for r in summary.collect()} == {("holdout", "no", 10, 9, 0, 1), ("holdout", "review_reason:lane_a", 3, 3, 0, 0), ("release", "yes", 10, 9, 1, 0)}
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "HashedRelationBroadcastMode(List(input[0, array<string>" not in plan and "HashedRelationBroadcastMode(List(input[1, array<string>" not in plan
