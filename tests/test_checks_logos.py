"""Output and task checks one by one, recommendations and logo look-ups against plain versions."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from siteresolve.operators import checks, finalize, logos, recommend

FINAL = "provider_id string, official_url string, official_domain string, status string, provider_detail_url string"
GOOD = [("1", "https://a.com", "a.com", "matched", "d"), ("2", "", "", "unresolved", "d"), ("3", "https://c.com", "c.com", "matched", "d")]


def folder():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/x"


def failing(df):
    return {r["check"] for r in df.collect()}


@pytest.mark.parametrize(
    "rows, more, want",
    [
        (GOOD, {}, set()),
        (GOOD, {"expected_rows": 4}, {"final_rows", "quality_total_rows"}),
        (GOOD, {"expected_unresolved": 2}, {"unresolved_rows"}),
        ([*GOOD, ("4", "https://d.com", "d.com", "matched", " ")], {}, {"missing_provider_detail_url_rows"}),
        ([*GOOD, ("4", "https://d.com", "d.com", "invalid_manual_decision", "d")], {}, {"unresolved_csv_rows", "quality_gate"}),
        ([*GOOD, ("1", "https://a.com", "a.com", "matched", "d")], {}, {"duplicate_provider_ids", "quality_gate"}),
        ([*GOOD, ("4", "https://www.linkedin.com/x", "linkedin.com", "matched", "d")], {}, {"excluded_official_url_rows", "quality_gate"}),
        ([*GOOD, ("4", "nonsense", "", "matched", "d")], {}, {"malformed_official_url_rows", "quality_gate"}),
    ],
)
def test_output_checks(spark, rows, more, want):
    df = spark.createDataFrame(rows, FINAL)
    assert want <= failing(checks.output_checks(df, finalize.unresolved(df), finalize.quality_gate(df, ["linkedin.com"]), folder(), **more))
    if not want or more:
        assert failing(checks.output_checks(df, finalize.unresolved(df), finalize.quality_gate(df, ["linkedin.com"]), folder(), **more)) == want


TASK = {c: "x" for c in checks.TASK_FIELDS} | {"provider_id": "1", "review_reason": "r", "manual_decision": "", "manual_url": ""}


@pytest.mark.parametrize(
    "rows, more, want",
    [
        ([TASK], {}, set()),
        ([TASK, TASK], {}, {"duplicate_provider_reason"}),
        ([TASK | {"provider_id": ""}, TASK | {"provider_id": ""}], {}, set()),
        ([TASK | {"provider_detail_url": None}], {}, {"provider_detail_url"}),
        ([TASK | {"candidate_url": " ", "official_url": ""}], {}, {"candidate_or_official_url"}),
        ([TASK | {"manual_decision": "accept"}], {}, {"manual_decision_blank"}),
        ([TASK | {"manual_decision": " Accept "}], {"allow_filled": True}, set()),
        ([TASK | {"manual_decision": "maybe"}], {"allow_filled": True}, {"invalid_manual_decision"}),
        ([TASK | {"manual_decision": "replace"}], {"allow_filled": True}, {"replace_missing_manual_url"}),
        ([TASK], {"require_filled": True}, {"manual_decision_required"}),
        ([{k: v for k, v in TASK.items() if k != "notes"}], {}, {"required_fields"}),
    ],
)
def test_task_checks(spark, rows, more, want):
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} string" for c in rows[0]))
    assert failing(checks.task_checks(df, folder(), **more)) == want


def test_task_summary_is_reconciled(spark):
    df = spark.createDataFrame([tuple((TASK | {"provider_id": str(k), "review_reason": r}).values()) for k, r in enumerate("aab")], ", ".join(f"{c} string" for c in TASK))
    summary = lambda *n: spark.createDataFrame(list(n), "review_reason string, n long")
    assert failing(checks.task_checks(df, folder(), summary(("a", 2), ("b", 1)))) == set()
    assert failing(checks.task_checks(df, folder(), summary(("a", 1), ("b", 2)))) == {"summary_reason_counts"}
    assert failing(checks.task_checks(df, folder(), summary(("a", 2), ("b", 1), ("c", 1)))) == {"summary_reason_counts", "summary_task_rows"}


def test_release_recommendations(spark):
    sims = spark.createDataFrame([("s", 30, 9, 1, 0.9), ("s", 60, 4, 0, 1.0), ("s", 70, 4, 0, 1.0), ("t", 30, 5, 5, 0.5), ("t", 60, 5, 5, 0.5), ("t", 90, 0, 0, None)], "sweep string, evidence_threshold int, correct_recovery_rows long, wrong_release_rows long, release_precision double")
    got = {r["sweep"]: tuple(r)[1:] for r in recommend.recall_release(sims, ["sweep"]).collect()}
    assert got == {"s": ("narrow_auto_release_candidate", 60, 4, 0), "t": ("manual_only", 30, 5, 5)}
    assert recommend.recall_release(sims.limit(0)).first()["recommendation"] == "not_evaluated"
    rows = [("a", 0, 9, 0, 0.9, 1), ("b", 2, 3, 0, 0.8, 2), ("c", 1, 3, 0, 0.8, 3), ("d", 2, 9, 1, 0.9, 4)]
    made = spark.createDataFrame(rows, "path string, pattern_count int, correct_recovery_rows long, wrong_release_rows long, overall_accuracy double, pos long")
    assert tuple(recommend.pattern_release(made).first())[:2] == ("b", "narrow_pattern_release_candidate")
    assert tuple(recommend.pattern_release(made.filter("path IN ('a', 'd')")).first())[:3] == ("a", "not_recommended", "no_selected_patterns")
    assert recommend.pattern_release(made.limit(0)).first()["recommendation"] == "not_evaluated"


def test_near_logos_equal_all_pairs(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(12)]
    table = [(k, base[k % 12] ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 10)))) for k in range(150)] + [(900, base[0]), (901, base[0]), (902, None)]
    asked = [(k, h) for k, h in table if h is not None][::5] + [(7777, None)]
    signed = lambda h: h if h is None or h < 1 << 63 else h - (1 << 64)
    frame = lambda rows, c: spark.createDataFrame([(k, signed(h)) for k, h in rows], f"{c} long, hash long")
    got = {(r["query_id"], r["id"]): r["share"] for r in logos.near_logos(frame(asked, "query_id"), frame(table, "id")).collect()}
    want = {(q, k): 1 - (g ^ h).bit_count() / 64 for q, g in asked for k, h in table if g is not None and h is not None and 1 - (g ^ h).bit_count() / 64 >= logos.MATCH}
    assert got == want and len(want) > len(asked)
    with pytest.raises(ValueError):
        logos.near_logos(frame(asked, "query_id"), frame(table, "id"), least=0.8)


def test_packed_hashes(spark):
    bits = ["1" * 64, "0" * 63 + "1", "1" + "0" * 63, "01" * 32, "1" * 63, "x" * 64, None]
    got = [r[0] for r in spark.createDataFrame([(k, b) for k, b in enumerate(bits)], "k int, b string").orderBy("k").select(logos.packed(F.col("b"))).collect()]
    assert got == [-1, 1, -(1 << 63), int("01" * 32, 2), None, None, None]


def test_best_of_the_first_six(spark):
    hashes = spark.createDataFrame([("own", 0), ("far", -1), ("near", (1 << 13) - 1), ("same", 1), ("twin", 1)], "logo_url string, hash long")
    pages = spark.createDataFrame([("p1", ["far", "near", "far", "", "unknown", "twin", "same"]), ("p2", ["far", "u1", "u2", "u3", "u4", "u5", "same"]), ("p3", []), ("p4", ["near"])], "url string, logos array<string>")
    rows = [("a", 1, "own", "p1"), ("b", 1, "own", "p2"), ("c", 1, "own", "p3"), ("d", 1, "own", "p4"), ("e", 1, "", "p1"), ("f", 1, "lost", "p1"), ("g", 1, "own", "none")]
    got = {r["provider_id"]: (r["matched"], r["near"], r["score"], r["points"], r["reason"], r["logo_url"]) for r in logos.best_logos(spark.createDataFrame(rows, "provider_id string, pos int, listing_logo_url string, url string"), pages, hashes).collect()}
    assert got == {
        "a": (True, False, 0.984, 18, "logo_visual_match", "twin"),
        "b": (False, False, 0.0, 0, "no_logo_match", None),
        "c": (False, False, 0.0, 0, "no_candidate_logo_urls", None),
        "d": (False, True, 0.797, 8, "logo_visual_near_match", "near"),
        "e": (False, False, 0.0, 0, "missing_listing_logo_or_html", None),
        "f": (False, False, 0.0, 0, "listing_logo_unavailable", None),
        "g": (False, False, 0.0, 0, "missing_listing_logo_or_html", None),
    }
