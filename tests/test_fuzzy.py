"""Token-set similarity against a plain table of common subsequences."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siteresolve.functions import fuzzy
from siteresolve.operators import scoring


def plain_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@settings(max_examples=500, deadline=None)
@given(st.text("abc é", max_size=90), st.text("abc é", max_size=90))
def test_common_subsequence(a, b):
    assert fuzzy.common_subsequence(a, b) == plain_lcs(a, b)


def plain_ratio(a, b):
    x, y = set((a or "").split()), set((b or "").split())
    if not x or not y:
        return 0.0
    if x & y and (x <= y or y <= x):
        return 100.0
    both, one, other = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    lists = [both, f"{both} {one}".strip(), f"{both} {other}".strip()]

    def like(p, q):  # both begin with the shared words, so only the rest differs
        return 100 - 100 * (len(p) + len(q) - 2 * plain_lcs(p, q)) / (len(p) + len(q))

    n = len(both) + 1 if both else 0
    rest = 100 - 100 * (len(one) + len(other) - 2 * plain_lcs(one, other)) / (2 * n + len(one) + len(other))
    return max(rest, *(like(both, z) for z in lists[1:] if both)) if both else rest


WORDS = st.lists(st.sampled_from(["acme", "acne", "media", "medial", "shop", "the", "x", "sho"]), max_size=6).map(" ".join)


@settings(max_examples=500, deadline=None)
@given(WORDS, WORDS)
def test_token_set_ratio(a, b):
    assert abs(fuzzy.token_set_ratio(a, b) - plain_ratio(a, b)) < 1e-9
    assert abs(fuzzy.token_set_ratio(a, b) - fuzzy.token_set_ratio(b, a)) < 1e-9


def test_known_values_and_columns(spark):
    pairs = [("fuzzy was a bear", "fuzzy fuzzy was a bear"), ("acme media", "medial acme"), ("", "x"), ("abc", "abcd"), ("new york mets", "yankees new york"), (None, "x")]
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k int, a string, b string")
    got = [r[0] for r in df.orderBy("k").select(fuzzy.token_set(F.col("a"), F.col("b"))).collect()]
    assert got[0] == 100.0 and got[2] == 0.0 and got[3] == 100.0
    assert abs(got[1] - plain_ratio(*pairs[1])) < 1e-9 and abs(got[4] - plain_ratio(*pairs[4])) < 1e-9 and got[5] in (0.0, None)


def test_scores_take_either_similarity(spark):
    rows = [(1, "Acme Media", ["Germany"], "https://acmemedial.org", "t", "s", "brave", 9, "q"), (2, "Brite Consulting House", ["Germany"], "https://x.de", "House Consultng Brite", "", "brave", 9, "q")]
    df = spark.createDataFrame(rows, "pos int, provider_name string, provider_locations array<string>, url string, title string, snippet string, source string, rank int, query string")
    words, sets = ({r["pos"]: r["reasons"] for r in scoring.score_candidates(df, how).collect()} for how in ("words", "token_set"))
    assert "search_result_fuzzy_name_match" not in words[2] and "search_result_fuzzy_name_match" in sets[2]
    assert scoring.score_candidates(scoring.provider_features(df)).collect() == scoring.score_candidates(df).collect()
