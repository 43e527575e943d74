"""Matching, covers and samples against plain versions on random rows, with ties, nulls and repeats."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siteresolve.operators import patterns, review

LETTERS = "abcdefgh"


def random_sets(rng, n, null=True):
    return [None if null and rng.random() < 0.05 else [rng.choice([*LETTERS, *"abab"] + [None] * null) for _ in range(rng.randint(0, 6))] for _ in range(n)]


def test_matches_equal_all_pairs(spark):
    rng = random.Random(1)
    rows = list(enumerate(random_sets(rng, 300)))
    listed = [(f"p{k}", rng.randint(0, 5), rng.sample([*LETTERS, "zz"], rng.randint(0, 4))) for k in range(40)]
    df = spark.createDataFrame([(k, f, "x") for k, f in rows], "id long, features array<string>, pattern string")
    table = spark.createDataFrame(listed, "pattern string, pattern_pos int, features array<string>")
    want = [(k, q, p) for k, f in rows for p, q, w in listed if w and f is not None and set(w) <= set(f)]
    every = patterns.matches(df, table, "id", first_only=False)
    assert sorted(tuple(r) for r in every.collect()) == sorted((k, p) for k, _, p in want)
    first = {k: min((q, p) for j, q, p in want if j == k)[1] for k, *_ in want}
    assert dict(tuple(r) for r in patterns.matches(df, table, "id").collect()) == first
    right = df.withColumn("correct", F.col("id") % 3 > 0)
    got = {r["pattern"]: (r["released_rows"], r["correct_released"]) for r in patterns.release_simulation(right, table).collect()}
    assert got == {p: (sum(x[2] == p for x in want), sum(x[2] == p and x[0] % 3 > 0 for x in want)) for p in {x[2] for x in want}}


def broadcasts(df):
    """How many sides the plan that ran has broadcast."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[: plan.find("== Initial Plan ==")].count("BroadcastExchange")


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_matches_broadcast_only_what_was_measured(spark, tmp_path, monkeypatch, most):
    """Rows with long features in a file that compresses well, beside a wide column: Spark takes their features for a few bytes."""
    monkeypatch.setattr(patterns, "BROADCAST_BYTES", most, raising=False)
    wide = spark.range(2000).select("id", F.array(F.lit("a"), F.concat(F.lit("b"), F.col("id") % 3), F.repeat(F.lit("c"), 2000)).alias("features"), *[F.lit("x").alias(f"w{k}") for k in range(20)])
    wide.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    table = spark.createDataFrame([("p", 0, ["a", "b1"]), ("q", 1, ["b2"]), ("r", 2, ["a", "b2"])], "pattern string, pattern_pos int, features array<string>")
    found = patterns.matches(rows.select("id", "features"), table, "id")
    assert Counter(r["pattern"] for r in found.collect()) == {"p": 667, "q": 666}
    assert broadcasts(found) == (1 if most else 0)


def plain_cover(rows, listed, most_wrong):
    cover = {p: ([k for k, (f, c) in enumerate(rows) if c and set(w) <= set(f)], [k for k, (f, c) in enumerate(rows) if not c and set(w) <= set(f)], len(set(w))) for p, w in listed if w}
    right, wrong, out = set(), set(), []
    for p in sorted((p for p in cover if cover[p][0] or cover[p][1]), key=lambda p: (len(cover[p][1]), -len(cover[p][0]), cover[p][2], p)):
        new, bad = set(cover[p][0]) - right, wrong | set(cover[p][1])
        if new and len(bad) <= most_wrong:
            right |= new
            wrong = bad
            out.append((p, len(out) + 1, len(new), len(wrong)))
    return out


@pytest.mark.parametrize("most_wrong", [0, 3, 12, 1000])
def test_actionable_set_equals_the_walk(spark, most_wrong):
    rng = random.Random(most_wrong)
    rows = [(f, rng.random() < 0.9 or "a" not in f) for f in random_sets(rng, 250, null=False)]
    listed = [(f"p{k:02}", rng.sample(LETTERS, rng.randint(1, 4))) for k in range(30)]
    want = plain_cover(rows, listed, most_wrong)
    got = patterns.actionable_set(spark.createDataFrame(rows, "features array<string>, correct boolean"), spark.createDataFrame(listed, "pattern string, features array<string>"), most_wrong)
    assert [tuple(r) for r in got.orderBy("place").collect()] == want
    assert most_wrong == 0 or len(want) >= 5


def test_actionable_set_checks_the_number_of_patterns(spark):
    rows = spark.createDataFrame([(["a", "b"], True)], "features array<string>, correct boolean")
    listed = spark.createDataFrame([("p", ["a"]), ("q", ["b"])], "pattern string, features array<string>")
    with pytest.raises(ValueError):
        patterns.actionable_set(rows, listed, most_patterns=1)


def plain_sample(rows, most, per_reason, per_pattern):
    """rows: (score, id, reason, pattern, key) in any order."""
    rows = sorted(rows, key=lambda r: (-r[0], r[1]))
    taken, keys, reasons, found = [], set(), Counter(), Counter()
    for walk in (1, 2):
        for score, i, reason, pattern, key in rows:
            full = per_reason and reasons[reason] >= per_reason
            if len(taken) >= most or full or (walk == 2 and key in keys) or (walk == 1 and per_pattern and pattern and found[pattern] >= per_pattern):
                continue
            if walk == 2 and not per_pattern:
                continue
            taken.append(i)
            keys.add(key)
            reasons[reason] += 1
            found[pattern] += 1
    return taken


@pytest.mark.parametrize("most, per_reason, per_pattern, own", [(8, 5, 2, True), (40, 6, 3, True), (30, 0, 2, True), (25, 4, 0, False), (60, 10, 1, False), (200, 9, 2, False)])
def test_balanced_sample_equals_the_walk(spark, most, per_reason, per_pattern, own):
    rng = random.Random(most)
    rows = [(rng.randint(0, 9), i, rng.choice(["r0", "r0", "r0", "r1", "r2", None]), rng.choice([None, "", "p0", "p0", "p1", "p2", "p3"]), i if own else rng.randint(0, 60)) for i in range(220)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "score int, id long, review_reason string, pattern_match string, k long, a string").repartition(3)
    got = review.balanced_sample(df, [F.desc("score"), F.col("id")], most, per_reason, per_pattern, key=None if own else "k")
    assert got.columns == [*df.columns, "sample_pos"]
    got = sorted((r["sample_pos"], r["id"]) for r in got.collect())
    assert [n for n, _ in got] == list(range(1, len(got) + 1))
    assert [i for _, i in got] == plain_sample(rows, most, per_reason, per_pattern)
    assert review.balanced_sample(df.limit(0), [F.desc("score")], 5, 2, 1).count() == 0
