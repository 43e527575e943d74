"""Readers and writers, second-pass plan, samples with caps."""

import json
import tempfile

from pyspark.sql import functions as F

from siteresolve.operators import patterns, review, secondpass
from siteresolve.sources import readers


def test_provider_csv(spark):
    d = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    with open(d + "/p.csv", "w", encoding="utf-8-sig") as f:
        f.write('provider_id,provider_name,about\nAmazon SPN 服务商唯一 ID；主表关联键之一,服务商名称,x\np1,"A ""quoted""\nname",\n,blank,\np2,B,t\n')
    rows = {r["provider_id"]: r for r in readers.read_providers(spark, d + "/p.csv").collect()}
    assert set(rows) == {"p1", "p2"} and rows["p1"]["provider_name"] == 'A "quoted"\nname' and rows["p1"]["about"] == "" and rows["p1"]["pos"] < rows["p2"]["pos"]


def test_normalized_round_trip(spark):
    row = ("1", "A", '["x","y"]', "[1", "{}", None, "https://d", "2.0")
    df = spark.createDataFrame([row], "provider_id string, provider_name string, service_apis string, provider_locations string, provider_languages string, service_types string, detail_url string, source_rows string")
    assert readers.is_normalized(df) and not readers.is_normalized(df.drop("detail_url"))
    got = readers.read_normalized(df).first()
    assert (got["service_apis"], got["provider_locations"], got["provider_languages"], got["service_types"], got["source_rows"], got["detail_urls"]) == (["x", "y"], [], [], [], 2, ["https://d"])
    back = readers.to_normalized(readers.read_normalized(df)).first()
    assert (back["service_apis"], back["service_types"], back["detail_url"]) == ('["x","y"]', "[]", "https://d")


def test_search_layouts(spark):
    def rows(source, body):
        df = spark.createDataFrame([("1", "q", json.dumps(body)), ("2", "q", "not json")], "provider_id string, query string, response string")
        return [(r["url"], r["title"], r["snippet"], r["rank"]) for r in readers.search_candidates(df, source, 2).orderBy("rank").collect()]

    assert rows("brave", {"web": {"results": [{"url": "u1", "title": "t", "description": "d"}, {"url": "u2"}, {"url": "u3"}]}}) == [("u1", "t", "d", 1), ("u2", "", "", 2)]
    assert rows("serpapi", {"organic_results": [{"link": "u", "title": "t", "snippet": "s"}]}) == [("u", "t", "s", 1)]
    assert rows("tavily", {"results": [{"url": "u", "title": "t", "content": "c" * 2000}]}) == [("u", "t", "c" * 1000, 1)]
    assert rows("exa", {"results": [{"url": "u", "title": "t", "summary": "S", "text": "T", "highlights": ["a", "b"]}]}) == [("u", "t", "S T a b", 1)]
    assert rows("ddgs", {"results": [{"url": "u", "title": "t", "body": "b"}]}) == [("u", "t", "b", 1)]


def test_plan_queries(spark):
    df = spark.createDataFrame([("Acme Ltd", "not_found", "", "", None, ["Germany"], []), ("Beta", "low_confidence", "https://www.beta.de/x", "brave", 40, [], ["PPC"])], "provider_name string, status string, candidate_1_url string, candidate_1_source string, candidate_1_score int, provider_locations array<string>, service_apis array<string>")
    got = {r["provider_name"]: r for r in secondpass.plan(df, 14).collect()}
    acme, beta = got["Acme Ltd"], got["Beta"]
    assert acme["strategy_tier"] == "D_registry_social_then_manual" and beta["strategy_tier"] == "B_verify_or_expand_domain_guess"
    assert acme["query_4"] == '"Acme Ltd" "Amazon service provider"' and acme["query_5"] == '"Acme Ltd" "Germany" website' and acme["query_6"] == '"Acme Ltd" GmbH website'
    assert beta["query_5"] == 'site:beta.de "Beta"' and beta["query_7"] == ""


def test_balanced_sample_and_greedy_set(spark):
    rows = spark.createDataFrame([(k, "r" + str(k % 2), "p" + str(k % 3), 100 - k) for k in range(30)], "row_id int, review_reason string, pattern_match string, score int")
    got = [r["row_id"] for r in review.balanced_sample(rows, [F.desc("score"), F.col("row_id")], 8, 5, 2).orderBy("sample_pos").collect()]
    assert got == [0, 1, 2, 3, 4, 5, 6, 7]
    got = [r["row_id"] for r in review.balanced_sample(rows, [F.desc("score"), F.col("row_id")], 20, 3, 1).orderBy("sample_pos").collect()]
    assert got == [0, 1, 2, 3, 4, 5]
    rows = spark.createDataFrame([(["a", "b"], True), (["a", "b"], True), (["b"], True), (["c"], True), (["d"], True), (["d"], False)], "features array<string>, correct boolean")
    listed = spark.createDataFrame([(x, [x]) for x in "abcd"], "pattern string, features array<string>")
    assert [(r["pattern"], r["new_correct"]) for r in patterns.actionable_set(rows, listed).orderBy("place").collect()] == [("b", 3), ("c", 1)]
