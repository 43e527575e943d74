from pyspark.sql import functions as F

from siteresolve.operators import learning, patterns, reports


def test_features_of_a_row_without_anything(spark):
    rows = spark.createDataFrame([(None, None, None), ("Müller Seller GmbH", "muller.co.uk", " location_matches:Bonn;; legal entity_marker  found")], "name string, host string, facts string")
    none = F.lit(None).cast("string")
    made = learning.evidence_features(F.col("name"), none, none, none, F.lit(60), F.col("facts"), none, F.col("host"))
    empty, full = [set(r[0]) for r in rows.select(made).collect()]
    assert {"provider_name_shape:short", "agent_b_score>=60", "agent_b_score<70", "missing:location_matches"} <= empty
    assert not any(f.startswith(("has:", "domain_relation:", "review_reason:", "provider_token_count:")) or f.endswith(":") for f in empty)
    assert {"has:location_matches:Bonn", "has:location_matches", "has:legal_entity_marker_found", "provider_token_count:2", "provider_name_contains:seller", "domain_relation:provider_slug_contains_domain"} <= full
    assert "missing:location_matches" not in full and "missing:legal_entity_marker_found" not in full and "missing:contact_email_found" in full


def test_filled_rows(spark):
    rows = spark.createDataFrame([("1", "No", " own.de "), ("2", None, None), ("3", "", "x.com"), ("4", "UNSURE", "x.com"), ("5", "later", None)], "provider_id string, manual_decision string, true_official_url string")
    got = {r.provider_id: (r.manual_decision, r.manual_url, r.applied) for r in learning.normalize_filled(rows).collect()}
    assert got == {"1": ("replace", "own.de", True), "2": ("", "", False), "3": ("replace", "x.com", True), "4": ("unsure", "x.com", False), "5": ("later", "", True)}


def test_a_rescue_counts_only_where_it_is_accepted_and_needed(spark):
    columns = "provider_id string, accepted boolean, official_url string"
    first = spark.createDataFrame([("1", True, "a"), ("2", False, "b"), ("3", False, "c"), ("4", False, "d")], columns)
    rescued = spark.createDataFrame([("1", True, "x"), ("2", True, "y"), ("3", False, "z")], columns)
    got = sorted((r.provider_id, r.accepted, r.official_url, r.rescue_used) for r in reports.with_rescue(first, rescued).collect())
    assert got == [("1", True, "a", False), ("2", True, "y", True), ("3", False, "c", False), ("4", False, "d", False)]


def test_lanes_of_a_labelling_task(spark):
    columns = "review_reason string, recommendation string, priority string, decisive_rows_needed int, blocking_rows int"
    release = "precision_calibrated_pattern_release"
    rows = spark.createDataFrame([(release, "needs_more_labels", "low", 0, 0), ("precision_x", "", "high", 1, 0), ("other", "", "high", 1, 0), ("other_kept", "keep_review_lane", "low", 1, 0), ("", "keep_review_lane", "high", 1, 0), (None, None, None, None, None)], columns)
    lanes = lambda *a: sorted(r.review_reason for r in learning.lane_included(rows, *a).collect())
    assert lanes() == lanes("current_guarded_candidate", True) == ["other_kept", release, "precision_x"]
    assert lanes("current_guarded_candidate") == ["other_kept", "precision_x"]


def test_greedy_cover(spark):
    rows = spark.createDataFrame([(["a", "b"], True)] * 3 + [(["a"], True), (["b"], False), (["c"], True), (["c", "a"], True)], "features array<string>, correct boolean")
    wanted = spark.createDataFrame([("a", ["a"]), ("b", ["b"]), ("c", ["c"]), ("a AND b", ["a", "b"])], "pattern string, features array<string>")
    assert [tuple(r) for r in patterns.actionable_set(rows, wanted).orderBy("place").collect()] == [("a", 1, 5, 0), ("c", 2, 1, 0)]
    assert patterns.actionable_set(rows.limit(0), wanted).count() == 0


def test_unfilled_goes_by_id(spark):
    from siteresolve.operators import review

    columns = "provider_id string, review_reason string"
    task = spark.createDataFrame([("1", "x"), ("2", "x"), ("", "x"), (None, "x")], columns)
    filled = spark.createDataFrame([("1", "z"), ("", "x"), (None, "x")], columns)
    assert sorted(r.provider_id or "" for r in review.unfilled(task, filled).collect()) == ["", "", "2"]


def test_lookup_of_rows_without_id_or_name(spark):
    from siteresolve.operators import providers

    rows = spark.createDataFrame([(None, None, 1), ("", "", 2), ("", "A", 3), ("7", None, 4)], "provider_id string, provider_name string, n int")
    table = spark.createDataFrame([("", "a", 1), (None, None, 2), ("7", "b", 3)], "provider_id string, provider_name string, pos int")
    assert {r.n: r.p for r in providers.lookup(rows, table).select("n", F.col("found.pos").alias("p")).collect()} == {1: None, 2: None, 3: 1, 4: 3}
