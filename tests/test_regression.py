"""Cases, gate and overlay on worked rows."""

import random
import re

from pyspark.sql import functions as F

from siteresolve.functions import urls
from siteresolve.operators import regression


def test_cases_gate_and_overlay(spark):
    labels = spark.createDataFrame(
        [
            ("1", "recall", "recall_candidate_useful", "accept", "", "", "https://a.com", ""),
            ("2", "precision", "candidate_incorrect", "reject", "https://bad.com/", "", "", ""),
            ("3", "precision", "candidate_correct", "accept", "https://c.com", "", "", "issue"),
            ("4", "precision", "candidate_correct", "unsure", "https://d.com", "", "", ""),
            ("5", "precision", "candidate_incorrect", "replace", "https://e.com", "https://new.com", "", ""),
            ("6", "precision", "candidate_correct", "accept", "https://f.com", "", "", ""),
        ],
        "provider_id string, lane_kind string, calibration_outcome string, normalized_decision string, official_url string, normalized_manual_url string, candidate_url string, decision_quality_issue string",
    )
    cases = {r["provider_id"]: (r["case_type"], r["expected_url"]) for r in regression.build_cases(labels).collect()}
    assert cases == {
        "1": ("recall_positive_fixture", "https://a.com"),
        "2": ("precision_blocking_fixture", ""),
        "5": ("precision_blocking_fixture", "https://new.com"),
        "6": ("precision_positive_fixture", "https://f.com"),
    }
    output = spark.createDataFrame([("1", "", "unresolved", 1), ("2", "http://www.bad.com", "matched", 1), ("5", "https://e.com", "matched", 1), ("7", "https://g.com", "matched", 1)], "provider_id string, official_url string, status string, pos int")
    from pyspark.sql import functions as F

    output = output.withColumns({"decision_source": F.lit("auto"), "notes": F.lit("")})
    made = regression.build_cases(labels).withColumn("pos", F.lit(1))
    got = {r["provider_id"]: (r["gate_result"], r["failure_reason"]) for r in regression.gate(made, output).collect()}
    assert got == {"1": ("fail", "positive_fixture_over_rejected"), "2": ("fail", "blocked_candidate_was_auto_accepted"), "5": ("fail", "blocked_candidate_was_auto_accepted"), "6": ("unverified", "provider_missing_from_candidate_output")}
    after = {r["provider_id"]: (r["official_url"], r["status"], r["changes"]) for r in regression.apply_cases(output, made).collect()}
    assert after == {
        "1": ("https://a.com", "manual_accepted", ["restore_known_correct_url"]),
        "2": ("", "rejected", ["block_known_wrong_url"]),
        "5": ("https://new.com", "manual_accepted", ["replace_with_expected_url"]),
        "7": ("https://g.com", "matched", []),
    }
    again = regression.gate_summary(regression.gate(made, regression.apply_cases(output, made))).first()
    assert (again["passed"], again["failed"], again["unverified"], again["gate_status"]) == (3, 0, 1, "unverified")


def test_overlay_as_plain_fold_over_site_keys(spark):
    rng = random.Random(3)
    shown = ["", " ", "https://a.com", "http://www.A.com/", "a.com/x", "https://b.org/x/", "www.b.org/x", "https:///nohost", "mailto:", "https://c.de", None]
    key = {r["u"]: r["k"] for r in spark.createDataFrame([(u,) for u in shown], "u string").select("u", urls.site_key(F.col("u")).alias("k")).collect()}
    output = [(str(k), rng.choice(shown), rng.choice(["matched", None]), rng.choice(["auto", None]), rng.choice(["", "seen", None])) for k in range(120)]
    kinds = [*regression.BLOCKING, *regression.POSITIVE, "other", None]
    cases = [(str(rng.randint(0, 130)), pos, rng.choice(kinds), rng.choice(shown), rng.choice(shown), rng.choice(shown)) for pos in range(900)]
    want = {}
    for i, url, status, source, notes in output:
        url, status, source, notes, changes = url or "", status or "", source or "", notes or "", []
        for _, _, kind, expected, candidate, official in sorted((c for c in cases if c[0] == i), key=lambda c: c[1]):
            e, same = (expected or "").strip(), lambda x: key[url] != "" and key[url] == key[x]
            blocked = candidate if candidate else official or ""
            away, what = e != "" and not same(expected), None
            if kind in regression.BLOCKING:
                what = ("replace", "replace_with_expected_url") if away else ("block", "block_known_wrong_url") if same(blocked) else None
            elif kind in regression.POSITIVE and away:
                what = ("positive", "restore_known_correct_url")
            if what:
                source = "calibration_regression_" + what[0]
                url, status = ("", "rejected") if what[0] == "block" else (e, "manual_accepted")
                notes, changes = f"{notes}; {source}:{kind}" if notes else f"{source}:{kind}", [*changes, what[1]]
        want[i] = (url, status, source, notes, changes)
    made = regression.apply_cases(
        spark.createDataFrame(output, "provider_id string, official_url string, status string, decision_source string, notes string"),
        spark.createDataFrame(cases, "provider_id string, pos long, case_type string, expected_url string, candidate_url string, official_url string"),
    )
    assert {r["provider_id"]: (r["official_url"], r["status"], r["decision_source"], r["notes"], r["changes"]) for r in made.collect()} == want
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    folds = [line[line.index("lambdafunction(") :] for line in plan.splitlines() if "aggregate(cases" in line]
    assert folds and not any(re.search("regexp", f) for f in folds)  # addresses are taken apart once a case, not at each step
