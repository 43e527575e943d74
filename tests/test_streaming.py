import json
import tempfile

from siteresolve.streaming.incremental import append_new, new_files

SCHEMA = "provider_id string, pos long"


def test_only_new_entities_are_appended(spark):
    d = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    put = lambda rows: spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(d + "/in")

    def run():
        q = append_new(new_files(spark, d + "/in", SCHEMA), d + "/out", d + "/check")
        q.awaitTermination(120)
        assert q.exception() is None
        return q

    out = lambda: sorted((tuple(r) for r in spark.read.parquet(d + "/out").collect()), key=repr)
    put([("a", 2), ("a", 1), ("b", 3), (None, 7)])
    run()
    put([("b", 9), ("c", 4), (None, 1), ("a", 0)])
    run()
    assert out() == [("a", 1), ("b", 3), ("c", 4), (None, 7)]
    # a restart without new files adds nothing, and one with new files reads only these
    run()
    put([("c", 1), ("d", 5)])
    last = run()
    assert out() == [("a", 1), ("b", 3), ("c", 4), ("d", 5), (None, 7)]
    rows = sum(p["numInputRows"] for p in map(lambda p: json.loads(p.json), last.recentProgress))
    assert rows == 2


def test_batches_of_many_files(spark):
    d = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    for k in range(4):
        spark.range(k * 50, k * 50 + 100).selectExpr("CAST(id AS STRING) AS provider_id", f"id + {k} AS pos").coalesce(1).write.mode("append").parquet(d + "/in")
    append_new(new_files(spark, d + "/in", SCHEMA, per_batch=1), d + "/out", d + "/check").awaitTermination(120)
    got = spark.read.parquet(d + "/out")
    assert got.count() == got.select("provider_id").distinct().count() == 250
