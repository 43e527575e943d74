"""run() against a plain version of its stages on a small corpus."""

import os
import random
import tempfile

import corpus_pipeline
from siteresolve.llm import decontam, langid

from .test_operators import brute_near


def corpus(rng):
    parts = {"en": ["the", "ing", "tion", "and", "er", "st"], "de": ["der", "ung", "sch", "und", "keit", "bei"]}
    text = lambda lang, n: " ".join("".join(rng.choices(parts[lang], k=rng.randint(2, 5))) for _ in range(n))
    items = [(k, text("en", 30)) for k in range(5)]
    rows = []
    for k in range(120):
        lang = rng.choice(list(parts))
        rows.append((k, text(lang, rng.choice([30, 80])), lang))
    for k in range(120, 150):
        _, t, lang = rows[rng.randint(0, 119)]
        if k % 2:
            w = t.split()
            w[3] = "changed" + str(k)
            t = " ".join(w)
        rows.append((k, t, lang))
    rows += [(150 + k, text("en", 40) + " " + items[k][1] + " " + text("en", 40), "en") for k in range(5)]
    rows += [(160, None, None), (161, "", "en"), (162, "12 34", None)]
    return rows, items


def test_pipeline_equals_plain_stages(spark):
    rows, items = corpus(random.Random(11))
    d = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(os.path.join(d, "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(os.path.join(d, "benchmark.parquet"))

    model = langid.Compressors(langid.dictionaries(docs))
    left = [(i, t) for i, t, _ in rows if (p := model.predict(t))[0] != "und" and p[1] >= langid.LEAST_MARGIN]
    last = {t: i for i, t in sorted(left)}
    left = [(i, t) for i, t in left if last[t] == i]
    kept = {i for i, _, _, k in brute_near(left, 5, 80, 100) if k}
    left = [(i, t) for i, t in left if i in kept]
    words = decontam.Items(items).words
    held = lambda t: any(decontam.lcs(decontam.bit_places(w), decontam.Items([(0, t)]).words[0].tolist()) >= 0.8 * len(w) for w in words)
    left = {i for i, t in left if not held(t)}

    got = corpus_pipeline.run(spark, d).collect()
    assert {r["doc_id"] for r in got} == left and len(left) > 80
    assert all(r["lossless"] for r in got)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontamination", "sentencepiece"]


def test_stages_decide_on_rows(spark):
    """Rows that share an id or have none go by their own texts; rows repeated whole leave one; extra columns are dropped; empty tables pass."""
    import random

    rng = random.Random(3)
    body = lambda: " ".join(rng.choice("the and station river over under light green house walking slowly tonight letters".split()) + rng.choice("abcdefgh") for _ in range(60))
    a, b, c, leak = body(), body(), body(), body()
    near = a.replace(a.split()[30], "other", 1)
    rows = [(1, a), (1, b), (2, a), (3, c), (3, c), (None, c), (None, body()), (0, near), (None, near + " end"), (5, body() + " " + leak), (5, body())]
    make = lambda rows: spark.createDataFrame([(i, t, "en", "s", 0, 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, __row int")
    key = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    d = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(os.path.join(d, "benchmark.parquet"))

    exact = corpus_pipeline.exact_copies(spark, make(rows), d)
    assert key(exact) == sorted([(1, b), (2, a), (3, c), *rows[6:]], key=repr) and exact.columns == corpus_pipeline.COLUMNS
    kept = corpus_pipeline.near_copies(spark, exact, d)
    assert key(kept) == sorted([(1, b), (3, c), rows[6], (0, near), rows[9], rows[10]], key=repr)
    clean = corpus_pipeline.decontaminate(spark, kept, d)
    assert key(clean) == sorted([(1, b), (3, c), rows[6], (0, near), rows[10]], key=repr)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, make([]), d).count() == 0
