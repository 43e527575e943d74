"""The filter interaction audit against a plain version, and its matrix against the texts."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest

from siteresolve.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int, part string"
DOCS = "doc_id long, text string, lang string, fails string, good int, part string, shard long"


def plain(docs, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    fails = []
    for i, t, part in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A"} if len(w) < 100 else set()
        f |= {"B"} if 100 * len(set(w)) < 80 * len(w) else set()
        f |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t) else set()
        f |= {"D"} if re.search("[#$%&*|]", t) else set()
        f |= {"E"} if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs) else set()
        fails.append((part or "", f, i))
    out = {}
    for order in map("".join, permutations("ABCDE")):
        for p, f, i in fails:
            gone = False
            for step, c in enumerate(order, 1):
                x = out.setdefault((p, order, step), Counter())
                if c in f and not gone:
                    x["removed"] += 1
                    x["good_lost"] += i in good
                    x["toxic_lost"] += i in toxic
                elif c in f:
                    x["redundant"] += 1
                x["unique_fails"] += f == {c}
                gone |= c in f
                x["kept"] += not gone
    shapley = Counter()
    for (p, order, step), x in out.items():
        shapley[p, order[step - 1]] += x["removed"]
    return {k: (x["kept"], x["removed"], x["redundant"], x["unique_fails"], x["good_lost"], x["toxic_lost"], shapley[k[0], k[1][k[2] - 1]]) for k, x in out.items()}


@pytest.mark.parametrize("shard_bytes", [300, 2 << 20])
def test_audit_equals_a_plain_version(spark, shard_bytes, monkeypatch):
    monkeypatch.setattr(filter_audit, "ENTRIES", shard_bytes // 4)
    rng = random.Random(5)
    texts = [None, "", " \n", "A B C", "é" * 9 + "A", "x " * 120, " ".join(map(str, range(130))), "a|b", "\x85   w", "word " * 3000 + "TAIL"]
    docs = [(rng.choice([None, *range(12)]), rng.choice(texts), rng.choice([None, "", "en", "de"])) for _ in range(60)]
    docs += [(k, "a third of all rows", "en") for k in range(30)] + [(5, "a third of all rows", "en")] * 2
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in [*range(0, 30, 2), 4, 6]] + [(None, 1, 1)]
    table = spark.createDataFrame([(i, t, p, "A", 7, "own", 1) for i, t, p in docs], DOCS)
    got = filter_audit.audit(table, spark.createDataFrame([(*x, "own") for x in labels], LABELS), shard_bytes=shard_bytes)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()} == plain(docs, labels)


def test_the_matrix_holds_each_texts_words(spark):
    rng = random.Random(6)
    docs = [(k, " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.choice([0, 5, 400]))), "en") for k in range(40)]
    table = spark.createDataFrame([(*d, "A", 7, "own", 1) for d in docs], DOCS).repartition(3)
    words = table.selectExpr("explode(split(text, ' ')) AS word").filter("word <> ''")
    numbers = {(r["word"], r["word_id"]) for r in filter_audit.numbered(words).collect()}
    assert len(numbers) == len({w for w, _ in numbers}) == len({i for _, i in numbers})
    shards = filter_audit.matrix(table, shard_bytes=1000).collect()
    assert len(shards) > 5
    ids = {i for s in shards for i in s["indices"]}
    assert ids == {i for _, i in numbers}  # one dictionary over all shards
    seen, same = {}, {}
    for s in shards:
        for k, i in enumerate(s["ids"]):
            row = slice(s["indptr"][k], s["indptr"][k + 1])
            assert s["indices"][row] == sorted(set(s["indices"][row]))
            seen[i] = dict(zip(s["indices"][row], s["data"][row]))
    texts = {i: Counter(t.split()) for i, t, _ in docs}
    for i, t in texts.items():
        assert sorted(t.values()) == sorted(seen[i].values()) and len(seen[i]) == len(t)
        for w in t:  # an id stands for one word in every document
            same.setdefault(w, set(seen[i])).intersection_update({c for c, n in seen[i].items() if n == t[w]})
    assert all(same.values())


def test_audit_of_an_empty_table(spark):
    assert filter_audit.audit(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).count() == 0
