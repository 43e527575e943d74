"""Each operator on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns; against brute force where SQL can't say it."""

import hashlib
import random
import re
import time
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siteresolve.llm import decontam, exact_dedup, langid, rans, secrets, sp_dropout, substring, superminhash, token_counts, warc, words
from siteresolve.llm.components import components
from siteresolve.llm.queries import tokenizer_file
from siteresolve.llm.words import second_hashes, text_parts, window_hashes, word_hashes

EDGE = [(1, "a b c"), (2, "a b c"), (3, None), (4, ""), (5, "x" * 30000), (7, "Ünï \n\n  x"), (7, "other"), (None, "a b c"), (9, "word " * 4000)]
SCHEMA = "doc_id long, text string, id int, h string, kept string, lang string"


def docs(spark, rows):
    """With extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, 1, "h", "k", "en") for i, t in rows], SCHEMA)


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


# ---- 1: secrets -----------------------------------------------------------------------------


def test_base_spans_follow_the_contract():
    text = "é token: 'abc' PASSWORD = \"abcdefghijkl\" AKIA0123456789ABCD AKIAshort deadbeefdeadbeef0 api_key=secret=aaaaaaaaaaaa Secret:aaaaaaaaaaa"
    forms = [
        (re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), lambda m: len(m[2]) >= 12),
        (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
        (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16),
    ]
    want = sorted((m.start(), k, m.end()) for k, (f, ok) in enumerate(forms) for m in f.finditer(text) if ok(m))
    assert [s for s in secrets.spans(text, RANKS)[0] if s[1] < 3] == want and len(want) == 4


RANKS = secrets.word_ranks(None)


def brute_bits(value):
    """The cheapest segmentation by trying every span as every kind, repeats at any number of times, units by the same search."""
    n, best = len(value), [0.0] + [float("inf")] * len(value)
    for j in range(1, n + 1):
        for i in range(j):
            s, costs = value[i:j], [sum(map(secrets.char_bits, value[i:j]))]
            costs += [b for b in (secrets.word_bits(s, RANKS) if len(s) >= 3 else None, secrets.date_bits(s) if len(s) >= 4 and s[-1].isdigit() else None) if b is not None]
            if len(s) >= 3 and all(secrets.walk_step(a, b) for a, b in zip(s, s[1:])):
                costs.append(secrets.WALK_BITS + secrets.TURN_BITS * (len(s) - 1))
            for p in range(1, len(s) // 2 + 1):
                times = len(s) // p
                if len(s) % p == 0 and s == s[:p] * times and times >= (3 if p == 1 else 2):
                    costs.append(brute_bits(s[:p]) + np.log2(times))
            best[j] = min(best[j], best[i] + min(costs) + secrets.SEGMENT_BITS)
    return best[n]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["password", "P@ss", "1999", "2020-01-02", "qwer", "aaa", "nnnn", "abab", "x", "7", "zX", "lkj", "123", "!", "é", "Kx9mQ2vT7p"]), min_size=1, max_size=4).map("".join))
def test_guess_bits_are_minimal(value):
    bits, parts = secrets.guess_bits(value, RANKS)
    assert abs(bits - brute_bits(value)) < 1e-6
    assert "".join(value[a:b] for _, a, b in parts) == value


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from(["token=", "secret:", "aaaa", "abab", "1999", "qwer", "Kx9", "pass", "&", "zz"]), min_size=1, max_size=6).map("".join))
def test_one_table_has_the_costs_of_all_suffixes(value):
    costs = secrets.suffix_bits(value, RANKS)[0]
    assert all(abs(costs[i] - brute_bits(value[i:])) < 1e-6 for i in range(len(value)))
    spans = [(a, b) for a, k, b in secrets.spans(value, RANKS, 20.0)[0] if k == 3]
    for a, b in spans:
        assert brute_bits(value[a:b]) >= 20.0 - 1e-6


def test_repeats_by_period_and_by_anchors():
    rng = random.Random(3)
    for n in range(200):
        unit = "".join(rng.choice("abc") for _ in range(rng.randint(1, 30)))
        value = "".join(rng.choice(rng.choice(["ab", "a", "xyz12"])) for _ in range(40)) + unit * rng.randint(1, 7) + unit[: rng.randint(0, 3)] + "".join(rng.choice("ab") for _ in range(n % 30))
        assert sorted(secrets._runs_by_period(value)) == sorted(secrets._runs_by_anchors(value))


def test_farther_ends_take_over_in_time():
    rng = random.Random(4)
    for _ in range(100):
        costs = [rng.choice([0.0, 1.0, 3.0, 5.5]) + rng.random() * rng.choice([0, 4]) for _ in range(80)]
        far = secrets._Farther(2)
        for i in range(75, 0, -2):
            far.add(i + 4, costs)
            bits, j = far.best(i, costs)
            want = min(costs[j] + np.log2((j - i) // 2) for j in range(i + 4, 80, 2))
            assert abs(bits - want) < 1e-9 and abs(costs[j] + np.log2((j - i) // 2) - want) < 1e-9


def test_long_units_are_repeats_too():
    rng = random.Random(5)
    for n in (64, 65, 300):
        unit = "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
        assert secrets.guess_bits(unit * 3, RANKS)[0] <= sum(map(secrets.char_bits, unit)) + np.log2(3) + 2 * secrets.SEGMENT_BITS + 1e-6


def test_long_runs_of_visible_characters_take_seconds():
    import time

    began = time.time()
    pairs = "".join(f"token=v{k:07}&" for k in range(7000))
    found, _ = secrets.spans(pairs + " " + "secret=" + "x" * 300_000, RANKS)
    assert sum(k == 3 for _, k, _ in found) == 6999 and time.time() - began < 60
    few = pairs[:300]
    for a, k, b in secrets.spans(few, RANKS)[0]:
        if k == 3:
            assert secrets.guess_bits(few[a:b], RANKS)[0] >= secrets.LEAST_BITS


def test_guess_spans_only_for_costly_values():
    kinds = lambda text, ranks=RANKS: [text[a:b] for a, k, b in secrets.spans(text, ranks)[0] if k == 3]
    assert kinds("pwd is x7$kQ9!zLm2 ok") == ["x7$kQ9!zLm2"]
    assert kinds("password: password1999 and login: qwertyuiop") == []
    assert kinds("userPassword=Zx9$Qw!2Lk8v secret: token: Zx9Qw2Lk8vTr, 'passwd': 'pässwörtZx9$'") == ["Zx9$Qw!2Lk8v", "Zx9Qw2Lk8vTr", "pässwörtZx9$"]
    large = secrets.word_ranks(tokenizer_file("byte_bpe_50k.json"))
    assert len(large) > 10_000 and kinds("password: photographer login: australia secret: " + "ab" * 3000 + " pin:" + "x" * 9000, large) == []


def test_scan_edges(spark):
    df = secrets.scan(docs(spark, EDGE))
    assert df.columns[:6] == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert df.count() == len(EDGE)
    assert df.filter("doc_id = 3").first()["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert secrets.scan(docs(spark, [])).count() == 0


# ---- 2: decontamination ---------------------------------------------------------------------


def test_leaks_and_paraphrases(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3))
    items = [(k, " ".join(word() for _ in range(rng.randint(15, 55))) + ". Answer " + word()) for k in range(30)]
    noise = [" ".join(word() for _ in range(rng.choice([20, 300]))) for _ in range(60)]
    rows, planted = [], set()
    for k, x in enumerate(noise):
        w = x.split()
        if k % 2:
            item = items[k % 30][1].split()
            if k % 3 == 0:
                item = [y if rng.random() > 0.1 or j > len(item) - 4 else word() for j, y in enumerate(item)]
            w[10:10] = [y.upper() if k % 5 == 0 else y for y in item]
            planted.add((k, k % 30))
        rows.append((k, " ".join(w)))
    rows += [(100, None), (101, ""), (102, items[3][1])]
    found = decontam.leaks(docs(spark, rows), spark.createDataFrame([*items, (98, None), (99, "")], "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert got <= planted | {(102, 3)}
    assert len(got & planted) >= 0.9 * len(planted) and (102, 3) in got
    assert decontam.leaks(docs(spark, []), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert decontam.leaks(docs(spark, rows), spark.createDataFrame([], "item_id long, text string")).count() == 0


@pytest.mark.parametrize("every, length", [(3, 300), (1, 20), (50, 300)])
def test_leaks_find_paraphrases_in_many_or_few_documents(spark, every, length):
    """One altered form of an item, whose replaced words are rare or absent, in a third of long documents, in all short ones, and in few."""
    rng = random.Random(4)
    items = [(k, " ".join(f"i{k}x{j}" for j in range(40))) for k in range(3)]
    form = [x if j % 8 else f"new{j}" for j, x in enumerate(items[0][1].split())]
    rows, planted = [], set()
    for k in range(300):
        w = [f"w{rng.randint(0, 2000)}" for _ in range(length)]
        if k % every == 0:
            w[7:7] = form
            planted.add((k, 0))
        rows.append((k, " ".join(w)))
    rows.append((900, items[0][1]))
    found = decontam.leaks(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == planted | {(900, 0)}


def test_latent_candidates_reach_exact_cosines(spark):
    """Recall of the latent candidate search against brute-force cosines over all passages."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(rng.choices(words, k=90))) for k in range(80)]
    items = decontam.Items([(k, " ".join(rows[k * 3][1].split()[20:50])) for k in range(25)])
    df = docs(spark, rows).select("text")
    n, freq = decontam.frequencies(df, items.vocabulary, "text")
    weights = np.log((n + 1) / (freq + 1)).astype(np.float32) + 0.01
    basis = decontam.latent_basis(df, items, weights, "text")
    q = items.times(weights, np.eye(len(weights), dtype=np.float32))
    hits = total = 0
    for _, _, _, p in decontam.parts(pa.array([t for _, t in rows]), decontam.Terms(items.vocabulary)):
        _, exact = p.times(weights, np.eye(len(weights), dtype=np.float32))
        _, latent = p.times(weights, basis)
        cos = lambda a, b: (a @ b.T) / np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1))
        true = cos(exact, q) >= 0.5
        hits += (true & (cos(latent, q @ basis) >= decontam.LEAST_COSINE)).sum()
        total += true.sum()
    assert total > 10 and hits >= 0.9 * total


@pytest.mark.parametrize("bounds", [{}, {"PLACES": 0}, {"LONGEST_BOUNDED": 5}, {"BLOCK_BYTES": 200}])
def test_acceptance_over_all_pairs(spark, monkeypatch, bounds):
    """With every passage a candidate, the rows are those that the stated rule accepts over all (document, item) pairs; whatever bound or block is in force."""
    for name, value in bounds.items():
        monkeypatch.setattr(decontam, name, value)
    rng = random.Random(8)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") + rng.choice("aeiou")
    items = [(k, " ".join(word() for _ in range(rng.randint(3, 20))) + ". " + " ".join(word() for _ in range(rng.choice([1, 4, 12]))) + ".") for k in range(12)] + [(50, "Is it one sentence " + " ".join(word() for _ in range(9)))]
    rows = []
    for k in range(50):
        w = [word() for _ in range(rng.choice([0, 5, 40, 130]))]
        for _, t in rng.sample(items, 2):
            part = [x.strip(".") for x in t.split() if rng.random() > rng.choice([0, 0.2, 0.4])]
            at = rng.randint(0, len(w))
            w[at:at] = part
        rows.append((k, " ".join(w)))
    split = lambda t: re.findall("[a-z0-9]+", t.lower())

    def common(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    want = {}
    for i, text in rows:
        w = split(text)
        for k, t in items:
            item, answer = split(t), split(t.rstrip(" .").rpartition(". ")[2])
            for slot in range(max(1, -(-len(w) // 32) - 1) if w else 0):
                part = w[max(0, slot * 32 - len(item)) : (slot + 2) * 32 + len(item)]
                share = common(item, part) / len(item)
                if share >= 0.8 or (share >= 0.6 and common(answer, part) == len(answer)):
                    want[i, k] = max(want.get((i, k), 0), share)
    got = {(r["doc_id"], r["item_id"]): r["lcs_share"] for r in decontam.leaks(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"), least_cosine=-2.0).collect()}
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-9 for x in got) and len(want) > 30


def test_passes_take_a_few_times_their_word_hashes(spark, monkeypatch):
    """CPU seconds of the three passes over the texts, as multiples of those of hashing the texts' words in the same process; half of the terms are rare."""
    rng = random.Random(9)
    hot, rare = [f"h{k}" for k in range(300)], [f"r{k}" for k in range(6000)]
    word = lambda: rng.choice(hot if rng.random() < 0.7 else rare)
    rows = [(k, " ".join(word() for _ in range(400))) for k in range(1500)]
    items = [(k, " ".join(word() for _ in range(60)) + ". The answer") for k in range(200)]
    passes, plain = [], type(docs(spark, [])).mapInArrow
    monkeypatch.setattr(type(docs(spark, [])), "mapInArrow", lambda df, f, schema: passes.append(f) or plain(df, f, schema))
    decontam.leaks(docs(spark, rows[:1]).unionByName(docs(spark, rows[1:])), spark.createDataFrame(items, "item_id long, text string"))
    assert len(passes) == 3
    texts, ids = pa.array([t for _, t in rows]), pa.array([k for k, _ in rows])

    def cost(f):
        took = []
        for _ in range(3):
            began = time.thread_time()
            f()
            took.append(time.thread_time() - began)
        return min(took)

    hashing = cost(lambda: [word_hashes(raw, offs, lower=True) for _, _, raw, offs in text_parts(texts)])
    batches = [pa.RecordBatch.from_arrays([texts], ["text"])] * 2 + [pa.RecordBatch.from_arrays([ids, texts], ["id", "text"])]
    passes_cost = [cost(lambda f=f, b=b: list(f(iter([b])))) for f, b in zip(passes, batches)]
    assert sum(passes_cost) < 21 * hashing, (passes_cost, hashing)


def test_passages_equal_plain_counts():
    """Counts, products and shared words of passages against plain loops, where terms are often or rare and rows have no, one, a slot's or many words."""
    rng = random.Random(10)
    word = lambda: f"h{rng.randint(0, 5)}" if rng.random() < 0.6 else f"r{rng.randint(0, 900)}"
    sizes = [0, 1, 31, 32, 33, 64, 65, 0, 96, 97, 1200, 7, *(rng.randint(0, 200) for _ in range(60)), 0]
    rows = [[word() for _ in range(n)] for n in sizes]
    texts = sorted(([word() for _ in range(n)] for n in (1, 5, 32, 33, 60, 120)), key=len)
    items = decontam.Items([(k, " ".join(t)) for k, t in enumerate(texts)])
    names = {int(w): x for t, ws in zip(texts, items.words) for x, w in zip(t, ws)}
    names = [names[int(w)] for w in items.vocabulary]
    ((_, words, counts, p),) = decontam.parts(pa.array([" ".join(r) for r in rows]), decontam.Terms(items.vocabulary))
    windows = [(k, s, r[s * 32 : s * 32 + 64]) for k, r in enumerate(rows) if r for s in range(max(1, -(-len(r) // 32) - 1))]
    assert [(int(k), int(s)) for k, s in zip(p.row, p.slot)] == [x[:2] for x in windows] and 0 < len(p.often) < len(names)
    tf = np.array([[w.count(x) for x in names] for _, _, w in windows])
    a = np.where(tf > 0, 1 + np.log(np.maximum(tf, 1)), 0)
    assert (p.with_term() == (tf > 0).sum(axis=0)).all() and p.with_terms().tolist() == np.flatnonzero(tf.any(axis=1)).tolist()
    m, y, total = np.random.default_rng(1).standard_normal((len(names), 9)), np.random.default_rng(2).standard_normal((p.n, 4)), np.zeros((len(names), 4))
    assert np.allclose(p.product(m), a @ m, atol=1e-4)
    p.add_transposed(y, total)
    assert np.allclose(total, a.T @ y, atol=1e-4)
    own = np.arange(p.n)[::2]
    least = [[sum(x in set(rows[k][max(0, s * 32 - len(t)) : s * 32 + 64 + len(t)]) for x in t) for t in texts] for k, s, _ in windows]
    for n in range(1, 40, 3):
        may = p.shared(items, own, np.full(len(texts), n - 0.001, np.float32))
        assert may[np.array(least)[own] >= n].all()
    none = decontam.Passages(np.zeros(0, np.uint64), np.zeros(2, np.int64), decontam.Terms(items.vocabulary))
    assert none.n == 0 and none.product(m).shape == (0, 9) and not none.with_term().any()


def test_terms_that_share_their_last_bits():
    vocabulary = np.unique(np.array([5, 5 + (1 << 40), 5 + (1 << 50), 6, 6 + (1 << 30), 9], np.uint64))
    words = np.array([5, 5 + (1 << 45), 9, 6 + (1 << 30), 5 + (1 << 50), 7, 6, 5 + (1 << 40)], np.uint64)
    at, place = decontam.Terms(vocabulary).find(words)
    assert at.tolist() == [0, 2, 3, 4, 6, 7] and (vocabulary[place] == words[at]).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=12), st.lists(st.integers(0, 5), max_size=12))
def test_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    assert decontam.lcs(decontam.bit_places(np.array(a, np.int64)), b) == t[-1][-1]


# ---- 3: exact dedup -------------------------------------------------------------------------


@pytest.mark.parametrize("keep", ["max", "min"])
def test_exact_groups(spark, keep, monkeypatch):
    rows = [*EDGE, *((k, f"copy {k % 3}") for k in range(100, 160)), (100, "copy 1"), *((None, "nobody") for _ in range(3)), *((k, "hot") for k in range(1000, 1400))]
    monkeypatch.setattr(exact_dedup, "partitions", lambda _: 9)
    got = rows_of(exact_dedup.exact_groups(docs(spark, rows), keep=keep), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    best = max if keep == "max" else min
    want = [(i, k := best((x for x in groups[t or ""] if x is not None), default=None), len(groups[t or ""]), i == k, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows]
    assert got == sorted(want, key=repr)
    assert exact_dedup.exact_groups(docs(spark, [])).count() == 0


def test_each_round_merges_sorted_runs(spark):
    """The plan of a round: one exchange by run, a sort by digest, and a pass in that order; no hash aggregation."""
    rounds, fan_in = exact_dedup.tree(51, 8)
    assert (rounds, fan_in) == (2, 8) and exact_dedup.tree(211, 8) == (3, 6) and exact_dedup.tree(1, 8) == (1, 2)
    rows = exact_dedup.digests(docs(spark, EDGE), fan_in**rounds).select("__run", *exact_dedup.KEY, F.col("__id").alias("__keep"), F.lit(1).cast("long").alias("__n"))
    for pieces in (rows, exact_dedup.moved(rows, 1, fan_in).select(exact_dedup.ENTRY)):
        one = exact_dedup.merged(pieces, fan_in**rounds)
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Sort [__run" in plan and "Window" in plan and "HashAggregate" not in plan
        parts = one.rdd.mapPartitionsWithIndex(lambda k, it: [(k, [(r["__run"], bytes(r["__sha"])) for r in it])]).collect()
        assert len(parts) == fan_in**rounds and all(x == sorted(set(x)) and {run for run, _ in x} <= {k} for k, x in parts)


# ---- 4: language ID -------------------------------------------------------------------------


def test_language_id(spark):
    rng = random.Random(1)
    parts = {"en": ["the", "ing", "tion", "and", "er"], "de": ["der", "ung", "sch", "und", "keit"], "fr": ["les", "eau", "que", "ment", "oux"]}
    rows = [(k, " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 3))) for _ in range(60)), lang) for k in range(240) for lang in [rng.choice(list(parts))]]
    df = spark.createDataFrame([*rows, (900, None, "en"), (901, "", None), (902, "123 !!", "de"), (904, "\u00bd \u00b2 \u2460 \u2167", "de"), (903, "the and", None), (None, "der und", "xx")], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.language_id(df).collect()}
    held = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i]["held_out"] for i, _ in held) and 50 < len(held) < 110
    assert sum(got[i]["lang_pred"] == lang for i, lang in held) >= 0.95 * len(held)
    assert all(got[i]["lang_pred"] == "und" and not got[i]["accepted"] and got[i]["score"] == 0 for i in (900, 901, 902, 904))
    assert got[903]["lang_pred"] in parts and 0 <= got[903]["score"] <= 1
    assert "xx" not in {r["lang_pred"] for r in got.values()}
    assert langid.language_id(df.limit(0)).count() == 0


def test_language_id_equals_a_plain_version(spark, monkeypatch):
    """Few bins, a shared id, ties between languages, labels beyond the bound: dictionaries, sizes, choice and margin by plain rules."""
    import zstandard

    rng = random.Random(2)
    rows = [(rng.choice([5, *range(200)]), " ".join(rng.choice(["the", "Und", "\u00e9t\u00e9", "1", "\u00bd", "x" * 50]) for _ in range(rng.choice([0, 3, 900]))), rng.choice(["aa", "bb", "bb", "cc", None])) for _ in range(400)]
    rows += [(5, f"shared {k} " * 900, "aa") for k in range(60)] + [(k, "rare", f"r{k}") for k in range(300, 330)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    hashed = df.select("doc_id", "text", "lang", F.xxhash64("doc_id", F.lit(11)).alias("o"), F.xxhash64("text").alias("t"), F.xxhash64("doc_id", F.lit(13)).alias("p")).collect()
    learn = [r for r in hashed if r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1]
    labels = sorted({r["lang"] for r in learn}, key=lambda x: (-sum(r["lang"] == x for r in learn), x))[:5]
    size, content = 3000, {}
    for lang in labels:
        bins = {}
        for r in learn:
            if r["lang"] == lang:
                bins.setdefault(r["o"] % 8, []).append(r)
        share, own = size // len(bins), []
        for some in bins.values():
            at = min(some, key=lambda r: (r["o"], 0))["o"]
            cut = lambda r: r["text"][(k := r["p"] % (max(len(r["text"]) - share, 0) + 1)) : k + share]
            ties = [(r["doc_id"], cut(r)) for r in some if r["o"] == at]
            hashes = {r["x"]: r["h"] for r in spark.createDataFrame([(x,) for _, x in ties], "x string").select("x", F.xxhash64("x").alias("h")).collect()}
            own.append(min(ties, key=lambda x: hashes[x[1]]))
        body = [" ".join("".join(c if c.isalpha() else " " for c in x.lower()).split(" ")) for _, x in sorted(own) if x]
        content[lang] = b" ".join(re.sub(" +", " ", x).encode()[:share] for x in body)[:size]
    got = langid.dictionaries(df, sample_texts=8, size=size, most_languages=5)
    assert got == content
    model = langid.Compressors(content)
    for text in [r["text"] for r in hashed[:80]] + ["the", "\u00bd", None, "", "zz"]:
        sizes = {}
        raw = re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in (text or "").lower())).encode()
        for lang in sorted(content):
            c = zstandard.ZstdCompressor(level=6, dict_data=zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes[lang] = sum(len(c.compress(raw[k : k + 1024])) for k in range(0, len(raw), 1024))
        first, second = sorted(sizes.items(), key=lambda x: (x[1], x[0]))[:2]
        want = (first[0], second[1] / first[1] - 1) if any(c.isalpha() for c in text or "") else ("und", 0.0)
        assert model.predict(text) == want


def test_a_shared_id_and_many_labels_stay_bounded(spark):
    rows = spark.range(4000).selectExpr("CAST(7 AS LONG) AS doc_id", "repeat(concat('w', char(97 + id % 26), ' '), 3000) AS text", "concat('l', id % 500) AS lang")
    got = langid.dictionaries(rows, size=1 << 12)
    assert len(got) == langid.MOST_LANGUAGES and all(len(v) <= 1 << 12 for v in got.values())


def test_every_chosen_text_is_in_the_dictionary(spark):
    """Long texts with one opening: all 64 chosen ones have a share, and not of the opening alone."""
    name = lambda k: "q" + "".join(chr(97 + int(c)) for c in f"{k:03d}")
    rows = [(k, "opening " * 1500 + (name(k) + " ") * 6000, "en") for k in range(300)]
    got = langid.dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"))["en"]
    assert len(got) <= langid.DICTIONARY_BYTES
    assert len({name(k) for k in range(300) if (name(k) + " ").encode() in got}) >= 35


# ---- 5: SentencePiece -----------------------------------------------------------------------

MIXED = st.lists(st.sampled_from(list("abcdething ,.()'\n\t") + ["  ", "é", "日", "́", "ﬁ", "𝒳", "▁", "<s>"]), max_size=40).map("".join)


@settings(max_examples=200, deadline=None)
@given(MIXED, st.integers(0, 3))
def test_merge_dropout_is_lossless_and_plain_without_dropout(text, doc_id):
    import sentencepiece

    path = tokenizer_file("piece_bpe_32k.model")
    plain, dropped = sp_dropout.Encoder(path, 0), sp_dropout.Encoder(path, 0.3)
    assert dropped.decode(dropped.encode(text, doc_id)) == text == plain.decode(plain.encode(text))
    if "▁" not in text:
        assert plain.encode(text).tolist() == sentencepiece.SentencePieceProcessor(model_file=path).encode(text)


def naive_dropout(path, text, doc_id, dropout, seed):
    """Run by run, the best pair that is left found by scanning all of them."""
    m = sp_dropout.model(path)
    limit, out = round(dropout * 65536), []
    letter = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]").match
    runs = []
    for k, c in enumerate(t := " " + text if text else ""):
        new = k == 0 or (c == " " != t[k - 1]) or (" " not in (c, t[k - 1]) and bool(letter(c)) != bool(letter(t[k - 1])))
        runs += [""] if new else []
        runs[-1] += c
    for place, x in enumerate(runs):
        z = (sp_dropout.document_key(seed, doc_id) + place * sp_dropout._GOLDEN) % 2**64
        occurrence = int(sp_dropout.mixed(np.array([z], np.uint64))[0])
        parts, skipped, pop = list(x), set(), 0
        while True:
            begins = np.cumsum([0] + [len(y) for y in parts]).tolist()
            pairs = [(m.by_piece[a + b][0], begins[k], begins[k + 2], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in m.by_piece]
            pairs = [y for y in pairs if (y[1], begins[y[3] + 1], y[2]) not in skipped]
            if not pairs:
                break
            _, a, c, k = min(pairs)
            if int(sp_dropout.draws(np.array([occurrence], np.uint64), pop)[0, pop % 4]) < limit:
                skipped.add((a, begins[k + 1], c))
            else:
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            pop += 1
        for y in parts:
            out += [m.by_piece[y][1]] if y in m.by_piece else [m.by_byte[b] for b in y.encode()]
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(MIXED, st.sampled_from(["international organisations", " understanding,understood", "a" * 60, "", "ﬁx\n日本 éèà"])), min_size=1, max_size=6), st.sampled_from([5, 48]))
def test_merge_dropout_equals_a_plain_agenda(texts, longest):
    """By tables side by side, and by the heap for longer runs."""
    path, before = tokenizer_file("piece_bpe_32k.model"), sp_dropout.LONG
    encoder = sp_dropout.Encoder(path, 0.25, 3)
    raw = [t.encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(x) for x in raw]))
    try:
        sp_dropout.LONG = longest
        ids, counts = encoder.encode_texts(np.frombuffer(b"".join(raw), np.uint8), offsets, list(range(len(texts))))
    finally:
        sp_dropout.LONG = before
    got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [naive_dropout(path, t, k, 0.25, 3) for k, t in enumerate(texts)]
    back, ends = encoder.decode_texts(ids, counts)
    assert back.tobytes() == b"".join(raw) and ends.tolist() == offsets[1:].tolist()


def test_merge_dropout_query_equals_a_plain_agenda(spark):
    path = tokenizer_file("piece_bpe_32k.model")
    rows = [*EDGE[:4], (6, "international segmentation, of organisations\n\nagain é日 " * 4), (6, "international segmentation"), (8, "y" * 300)]
    got = rows_of(sp_dropout.encode_documents(docs(spark, rows), path), "doc_id", "ids", "lossless")
    assert got == sorted(((i, naive_dropout(path, t or "", i, sp_dropout.DROPOUT, sp_dropout.SEED), True) for i, t in rows), key=repr)


def test_merge_dropout_varies_by_seed_only(spark):
    path = tokenizer_file("piece_bpe_32k.model")
    text = "international organisations understand segmentation " * 20
    ids = [sp_dropout.Encoder(path, 0.2, seed).encode(text).tolist() for seed in (1, 1, 2)]
    assert ids[0] == ids[1] != ids[2]
    df = sp_dropout.encode_documents(docs(spark, EDGE), path)
    assert df.filter("not lossless").count() == 0 and df.count() == len(EDGE)
    back = sp_dropout.decode_documents(df.filter("doc_id = 9"), path).first()["text"]
    assert back == "word " * 4000
    assert sp_dropout.encode_documents(docs(spark, []), path).count() == 0


def test_merge_dropout_varies_by_occurrence(spark):
    """Occurrences of one word are cut in several ways, within a document and between documents, and the same way on every run."""
    path = tokenizer_file("piece_bpe_32k.model")
    df = sp_dropout.encode_documents(docs(spark, [(1, "international " * 60), (2, "international " * 60), (3, "international")]), path)
    got = {r["doc_id"]: r["ids"] for r in df.collect()}
    one = got[1]
    assert one != got[2] and got == {r["doc_id"]: r["ids"] for r in df.repartition(3).collect()}
    assert len({sp_dropout.Encoder(path).encode("international", k).tobytes() for k in range(60)}) > 2
    cuts = sp_dropout.Encoder(path, 0).encode("international").tolist()
    assert any(one[k : k + len(cuts)] != cuts for k in range(0, 50 * len(cuts), len(cuts)))
    assert one != (one[: len(one) // 60] * 60)[: len(one)]


# ---- 6: substring dedup ---------------------------------------------------------------------


def brute_substring(rows, size=13):
    first, words = {}, [(t or "").encode().split() for _, t in rows]
    for (d, _), w in zip(rows, words):
        for k in range(len(w) - size + 1 if d is not None else 0):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, d), d)
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - size + 1 if d is not None else 0):
            if first[tuple(w[k : k + size])] < d:
                gone.update(range(k, k + size))
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(x for j, x in enumerate(w) if j not in gone)).hexdigest()))
    return sorted(out, key=repr)


def test_substring_dedup(spark):
    rng = random.Random(4)
    shared = [[rng.choice("abcdefgh") for _ in range(rng.randint(10, 40))] for _ in range(6)]
    rows = []
    for i in range(120):
        w = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(shared)
            w += p[rng.randint(0, 5) :] if rng.random() < 0.5 else [rng.choice(["the", "of", "é", "b\x0bc", " x"]) for _ in range(rng.randint(0, 30))]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    rows += [(200, None), (201, ""), (None, rows[3][1]), (5, rows[9][1]), (5, rows[5][1]), (202, "x " * 500)]
    rng.shuffle(rows)
    got = rows_of(substring.substring_dedup(docs(spark, rows)), "doc_id", "n_words", "n_removed", "kept_sha256")
    want = brute_substring(rows)
    assert got == want and sum(r[2] for r in want) > 500
    assert substring.substring_dedup(docs(spark, [])).count() == 0


def test_rows_decided_where_they_are_read():
    h, h2, doc = np.array([5, 5, 5, 5, 9, 5, 7], np.uint64), np.array([0, 0, 0, 0, 0, 1, 0], np.uint64), np.array([4, 2, 2, 9, 1, 9, 3])
    assert substring._decided(h, h2, doc, 1).tolist() == [True, False, False, True, False, False, False]
    assert substring._decided(h, h2, doc, 2).tolist() == [False, False, False, True, False, False, False]
    everywhere = " ".join(f"w{k}" for k in range(20))
    batch = pa.RecordBatch.from_arrays([pa.array(range(500), pa.int64()), pa.array([0] * 500, pa.int32()), pa.array([everywhere] * 500)], ["doc", "alt", "text"])
    words, counts = word_hashes(*next(text_parts(batch.column(2)))[2:])
    got, row, at = window_hashes(words, counts, 13)
    rows = substring._rows(batch, 0, got, None, row, at, 2).to_pandas()
    done = rows[rows["at"] < 0]
    assert rows[rows["at"] >= 0].groupby("h").size().tolist() == [2] * 8
    assert done.groupby("doc").h.nunique().tolist() == [1] * 498 and done.h.nunique() == 498


def test_windows_of_one_hash_and_another_second_hash_differ():
    def batch(h, h2, doc):
        n = len(h)
        return pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(h2, pa.int32()), pa.array(doc, pa.int64()), pa.array([0] * n, pa.int32()), pa.array(range(n), pa.int32())], ["h", "h2", "doc", "alt", "at"])

    for parts in ([batch([1, 1, 1], [3, 4, 4], [8, 6, 7])], [batch([1], [3], [8]), batch([1], [4], [6]), batch([1], [4], [7])]):
        out = [d for b in substring._shared(iter(parts), True) for d in b.column(0).to_pylist()]
        assert out == [7]


def test_second_hashes_tell_windows_apart():
    words = np.array([1, 2, 3, 1, 2, 3, 2, 1, 3], np.uint64)
    h = substring.second_hashes(words, np.arange(7), 3).tolist()
    assert h[0] == h[3] and len(set(h)) == 6


def test_difference_cover():
    for i in range(substring.PERIOD):
        for j in range(substring.PERIOD):
            assert any((i + s) % substring.PERIOD in substring.COVER and (j + s) % substring.PERIOD in substring.COVER for s in range(substring.PERIOD))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n\t\x0b", max_size=12), min_size=1, max_size=5))
def test_word_hashes(texts):
    seen = {}
    for a, b, raw, offs in text_parts(pa.array(texts)):
        h, counts = word_hashes(raw, offs)
        split = [t.encode().split() for t in texts[a:b]]
        assert counts.tolist() == [len(w) for w in split]
        for x, w in zip(h.tolist(), (y for w in split for y in w)):
            assert seen.setdefault(w, x) == x
        _, row, at = window_hashes(h, counts, 2)
        assert list(zip(row.tolist(), at.tolist())) == [(r, k) for r, w in enumerate(split) for k in range(len(w) - 1)]
    assert len(set(seen.values())) == len(seen)


def thue_morse(n):
    bits = [0]
    while len(bits) < n:
        bits += [1 - x for x in bits]
    return "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)


@pytest.mark.parametrize("n", [8, 32, 64, 1024, 4096])
def test_words_on_which_polynomials_agree_have_other_hashes(n):
    """Polynomials modulo 2**64 agree on Thue-Morse words of 1024 letters, whatever their base."""
    rest = " a b c d e f g h i j k l"
    for lower in (False, True):
        parts = [next(text_parts(pa.array([w + rest]))) for w in thue_morse(n)]
        (one, counts), (other, _) = (word_hashes(raw, offs, lower) for _, _, raw, offs in parts)
        assert one[0] != other[0] and (one[1:] == other[1:]).all()
        assert window_hashes(one, counts, 13)[0][0] != window_hashes(other, counts, 13)[0][0]
        assert second_hashes(one, np.array([0]), 13)[0] != second_hashes(other, np.array([0]), 13)[0]
    upper, low = (word_hashes(*next(text_parts(pa.array([w])))[2:], lower=True)[0][0] for w in ("AbC" * 40, "abc" * 40))
    assert upper == low


def test_near_and_repeated_texts_that_differ_in_such_a_word(spark):
    one, other = thue_morse(1024)
    rest = " ".join(f"w{k}" for k in range(12))
    rows = [(1, f"{one} {rest}"), (2, f"{other} {rest}"), (3, f"{one} {rest}")]
    got = {r["doc_id"]: r["n_removed"] for r in substring.substring_dedup(docs(spark, rows), size=13).collect()}
    assert got == {1: 0, 2: 0, 3: 13}
    groups = {r["doc_id"]: r["component_id"] for r in superminhash.near_groups(docs(spark, [(1, f"{one} x y"), (2, f"{other} x y")]), k=3, num=85, den=100).collect()}
    assert groups == {1: 1, 2: 2}


# ---- 7: token counts ------------------------------------------------------------------------

ODD = st.lists(st.sampled_from(["a", "b", " ", "\n", "  ", "\t", "é", "'s", " 're", "23", ".", "<|endoftext|>", "日本", "\r\n", "\x1c", "́", "İ", "_", "​", " "]), max_size=14).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD, min_size=1, max_size=4))
def test_token_counts_equal_the_library(texts):
    path = tokenizer_file("byte_bpe_50k.json")
    whole = token_counts.tokenizer(path)
    assert token_counts.Lengths(path).count(texts) == [len(whole.encode(t, add_special_tokens=False)) for t in texts]


def test_token_count_edges(spark):
    path = tokenizer_file("byte_bpe_50k.json")
    whole = token_counts.tokenizer(path)
    got = rows_of(token_counts.token_counts(docs(spark, EDGE), path), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = [(i, len((t or "").encode()), n := len(whole.encode(t or "", add_special_tokens=False)), n > 512) for i, t in EDGE]
    assert got == sorted(want, key=repr)


# ---- 8: near-dedup --------------------------------------------------------------------------


def brute_near(rows, k, num, den):
    sets = []
    for _, t in rows:
        w = [x.lower() for x in (t or "").encode().split()]
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    links = superminhash.UnionFind()
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and None not in (rows[i][0], rows[j][0]) and den * len(a & b) >= num * len(a | b):
                links.join(rows[i][0], rows[j][0])
    comp = lambda d: None if d is None else links.find(d)
    return sorted(((d, len(s), comp(d), d is None or comp(d) == d) for (d, _), s in zip(rows, sets)), key=repr)


def test_near_groups_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(superminhash, "BLOCK", 20)
    rng = random.Random(7)
    rows = []
    for g in range(6):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(rng.choice([40, 100, 200]))]
        for _ in range(120 if g == 3 else rng.choice([1, 5, 15])):
            share = rng.choice([0, 0.01, 0.03, 0.06])
            rows.append(" ".join(f"e{rng.randint(0, 10**6)}" if rng.random() < share else w for w in base))
    rows += ["", "a b", "A b", "a b c", "x", None, "x", *rows[:5]]
    rng.shuffle(rows)
    rows = [*enumerate(rows), (None, rows[0]), (5000, "long " * 3000), (5001, "long " * 2900)]
    got = rows_of(superminhash.near_groups(docs(spark, rows)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == brute_near(rows, 3, 85, 100)
    assert superminhash.near_groups(docs(spark, [])).count() == 0


def test_a_chain_of_buckets_is_compared_bucket_by_bucket(spark, monkeypatch):
    """One candidate cluster of 400 nodes of which each shares buckets with its two neighbours only: what is compared grows with the nodes."""
    monkeypatch.setattr(superminhash, "BLOCK", 10)
    n = 400
    nodes = spark.createDataFrame([(i, [2 * i, 2 * i + 1, 2 * i + 2, 2 * i + 3]) for i in range(n)], "id long, bands array<long>")
    now = spark.createDataFrame([(i, i) for i in range(n)], "id long, comp long")
    members, rest = superminhash._mixed(nodes, now)
    assert members.count() <= 4 * n and rest.count() == 0
    assert members.groupBy("cluster", "block").count().agg(F.max("count")).first()[0] <= 2
    # documents that overlap by two thirds with the next: one cluster, no links, and here and there a linked pair
    words = [f"w{k}" for k in range(8 * n)]
    rows = [(i, " ".join(words[8 * i : 8 * i + 60])) for i in range(n)] + [(1000 + i, " ".join(words[8 * i : 8 * i + 60]) + " end") for i in range(0, n, 50)]
    got = rows_of(superminhash.near_groups(docs(spark, rows)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == brute_near(rows, 3, 85, 100)


def test_pairs_at_the_threshold_share_buckets():
    """Of pairs at a similarity of 0.85, few shingles or many, all share a band."""
    rng = np.random.default_rng(6)
    for size in (13, 40, 400):
        same = round(size * 2 * 0.85 / 1.85)
        missed = 0
        for _ in range(150):
            h = rng.integers(0, 2**63, 2 * size - same).astype(np.uint64)
            a, b = h[:size], np.append(h[:same], h[size:])
            keys = superminhash.band_keys(superminhash.signatures(np.concatenate([a, b]), np.array([len(a), len(b)])))
            missed += not (keys[0] == keys[1]).any()
        assert missed == 0


def test_superminhash_estimates_similarity():
    rng = random.Random(2)
    a = [f"w{rng.randint(0, 10**6)}" for _ in range(500)]
    b = [x if rng.random() > 0.05 else "z" + x for x in a]
    sets = [set(zip(x, x[1:], x[2:])) for x in (a, b)]
    for _, _, raw, offs in text_parts(pa.array([" ".join(a), " ".join(b)])):
        h, counts = superminhash.shingle_sets(raw, offs, 3)
        sig = superminhash.signatures(h, counts)
    assert abs((sig[0] == sig[1]).mean() - len(sets[0] & sets[1]) / len(sets[0] | sets[1])) < 0.1
    few = superminhash.signatures(h[:3], np.array([3]))
    assert sorted(np.floor(few[0]).astype(int).tolist()) != [] and np.isfinite(few).all()


def test_components(spark):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(60)] + [(rng.randint(100, 300), rng.randint(100, 300)) for _ in range(120)] + [(500, k) for k in range(501, 560)]
    uf = superminhash.UnionFind()
    for a, b in links:
        uf.join(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    assert got == {x: uf.find(x) for x in {y for e in links for y in e} if uf.find(x) != x}


# ---- 9: WARC --------------------------------------------------------------------------------


def test_warc_round_trip_and_lookup(spark):
    from siteresolve.llm.common import new_dir

    big = "<p>" + "é" * 80
    rows = [(k, f"http://h{k % 7}.ex.com:80/p{k}?q=1#f", [big, "small", None, f"{k} " * 50][k % 4]) for k in range(60)] + [(60, None, big), (3, "https://Ex.com", "tie"), (3, "https://ex.com/", "tie2")]
    rows += [(None, "http://no.id/", big), (None, None, "z" * 300), (70, "http://long.ex.com/", "long " * 300_000), (71, "http://long.ex.com/", "long " * 300_000), (71, "http://long.ex.com/", "long " * 300_000)]
    rows += [(k, "http://hot.ex.com/", f"hot {k}") for k in range(100, 400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"key": F.lit("x"), "first": F.lit(1), "digest": F.lit("d")})
    out = new_dir(spark, "warc")
    directory = warc.write_archive(pages, out)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    got = rows_of(warc.lookup(directory, out, pages), *names)
    first = {}
    for i, _, h in rows:
        first[h or ""] = i if first.get(h or "") is None else min(first[h or ""], i if i is not None else first[h or ""])
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= 100 and first[h or ""] != i
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[h or ""] if again else None))
    assert got == sorted(want, key=repr)
    assert got == rows_of(warc.warc_round_trip(pages), *names)
    found = warc.lookup(directory, out, spark.createDataFrame([("https://ex.com",), ("http://h1.ex.com/p1?q=1",), ("http://nowhere.org/",), ("http://h1.ex.com/p1?q=1",)], "url string")).collect()
    assert sorted((r["key"], r["page_id"], bytes(r["payload"])) for r in found) == [("com,ex)/", 3, b"tie"), ("com,ex)/", 3, b"tie2"), ("com,ex,h1)/p1?q=1", 1, b"small")]
    assert warc.warc_round_trip(pages.limit(0)).count() == 0


def test_a_url_with_very_many_captures(spark):
    """One URL with nearly all pages: its captures fill many index blocks and several portions."""
    n = 2 * warc.PORTION + 500
    pages = spark.range(n).selectExpr("id AS page_id", "IF(id % 1000 = 0, concat('https://b.org/', id), 'https://hot.org/x') AS url", "concat('<p>', id % 7, '</p>') AS html").repartition(3)
    got = warc.warc_round_trip(pages)
    assert got.count() == n == got.select("page_id").distinct().count()


def test_warc_records_follow_the_standard(spark):
    """Read as any reader would: member by member, header lines up to a blank one, a block of the length said, two line ends."""
    import gzip
    import io

    from siteresolve.llm.common import new_dir, open_fs

    rows = [(k, f"http://ex.com/{k}", "same " * 40 if k % 2 else f"page {k}") for k in range(20)]
    out = new_dir(spark, "warc")
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), out)
    fs, root = open_fs(out)
    from pyarrow import fs as files

    ids, refers, seen = set(), set(), 0
    for info in fs.get_file_info(files.FileSelector(root)):
        if not info.path.endswith(".warc.gz"):
            continue
        data = io.BytesIO(gzip.decompress(fs.open_input_file(info.path).read()))
        while (line := data.readline()) != b"":
            assert line == b"WARC/1.1\r\n"
            fields = {}
            while (line := data.readline()) != b"\r\n":
                name, _, value = line.decode().rstrip("\r\n").partition(": ")
                assert name not in fields
                fields[name] = value
            block = data.read(int(fields["Content-Length"]))
            assert data.read(4) == b"\r\n\r\n"
            assert re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", fields["WARC-Record-ID"]) and fields["WARC-Type"] in ("response", "revisit")
            assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields["WARC-Date"]) and fields["Content-Type"].startswith("application/http")
            assert block.startswith(b"HTTP/1.1 200 OK\r\n") and fields["WARC-Target-URI"].startswith("http://ex.com/")
            ids.add(fields["WARC-Record-ID"])
            refers |= {fields["WARC-Refers-To"]} if fields["WARC-Type"] == "revisit" else set()
            seen += 1
    assert seen == len(ids) == 20 and len(refers) == 1 and refers <= ids


# ---- 10: token files ------------------------------------------------------------------------


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 40000), st.integers(1, 49000), st.integers(0, 10**6))
def test_rans_round_trip(n, top, seed):
    ids = (np.random.default_rng(seed).zipf(1.2, n) % top).astype(np.uint32)
    head, body = rans.encoded(ids)
    assert (rans.decoded(head, memoryview(body)) == ids).all()
    size = rans.LANES * rans.STEPS
    if n > size:
        assert (rans.decoded(head, memoryview(body), 1, 2) == ids[size : 2 * size]).all()


def test_rans_checksum():
    head, body = rans.encoded(np.arange(1000, dtype=np.uint32))
    with pytest.raises(ValueError):
        rans.decoded(head, memoryview(body[:-1] + bytes([body[-1] ^ 1])))


@settings(max_examples=200, deadline=None)
@given(st.lists(ODD, min_size=1, max_size=4))
def test_word_encoder_equals_the_library(texts):
    path = tokenizer_file("word_bpe_49k.json")
    whole = token_counts.tokenizer(path)
    want = [whole.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    ids, counts = rans.Encoder(path).ids(pa.array(texts), 2)
    assert ids.tolist() == sum(want, []) and counts.tolist() == [len(x) for x in want]


def test_word_encoder_without_known_configuration(monkeypatch):
    """A file whose normaliser or pre-tokenizer isn't known: every word is a text of its own."""
    path = tokenizer_file("word_bpe_49k.json")
    assert rans.knows_plain_words(path) and not rans.knows_plain_words(tokenizer_file("byte_bpe_50k.json"))
    monkeypatch.setattr(rans, "knows_plain_words", lambda _: False)
    texts = ["Plain words, and odd1 ones.", "", "again Plain"]
    ids, _ = rans.Encoder(path).ids(pa.array(texts), 2)
    assert ids.tolist() == sum(([*e.ids, 2] for e in token_counts.tokenizer(path).encode_batch(texts, add_special_tokens=False)), [])


def test_batches_are_balanced_by_bytes():
    texts = pa.array(["é" * 40, None, "", "a" * 30, "b" * 200, "c", "d"])
    assert list(token_counts.by_bytes(texts, 100)) == [(0, 4), (4, 5), (5, 7)]
    assert list(token_counts.by_bytes(texts.slice(5), 100)) == [(0, 2)] and list(token_counts.by_bytes(texts.slice(7), 100)) == []


def test_token_files_of_one_id(spark):
    """Files of a few ids each: one document id in many of them, nulls too, still has one order and every start follows."""
    from siteresolve.llm.common import new_dir

    path, out = tokenizer_file("word_bpe_49k.json"), new_dir(spark, "rids")
    whole = token_counts.tokenizer(path)
    rows = [(i, f"text {chr(97 + k % 26)} number {k}") for k in range(60) for i in (7, None)] + [(9, "last")]
    manifest = rans.encode_documents(docs(spark, rows), out, path, file_ids=20, batch_bytes=60)
    got = rows_of(rans.read_digests(manifest, out), "start", "doc_id", "n_tokens")
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        n = len(whole.encode(t, add_special_tokens=False).ids) + 1
        want.append((start, i, n))
        start += n
    assert got == sorted(want, key=repr) and manifest.count() > 20


def test_token_files(spark):
    path = tokenizer_file("word_bpe_49k.json")
    whole = token_counts.tokenizer(path)
    rows = [*EDGE, *((k, f"Hello there, number {k}!") for k in range(50, 90))]
    got = rows_of(rans.token_files(docs(spark, rows), path), "doc_id", "start", "n_tokens", "ids_crc32")
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == sorted(want, key=repr)
    assert rans.token_files(docs(spark, []), path).count() == 0


def test_tables_that_workers_keep_are_not_much_larger_than_what_they_hold(monkeypatch):
    m = sp_dropout.Model(tokenizer_file("piece_bpe_32k.model"))
    held = 0
    for name, (rank, k) in m.by_piece.items():
        for at in range(1, len(name)):
            a, b = m.by_piece.get(name[:at]), m.by_piece.get(name[at:])
            if a and b:
                left, right = np.array([a[1]], np.int32), np.array([b[1]], np.int32)
                if held % 7 == 0:
                    assert m.pairs.ranks(left, right)[0] == rank and m.pairs.joined(left, right)[0] == k
                held += 1
    none = np.array([m.extra + 5], np.int32)
    assert m.pairs.joined(none, none)[0] == -1
    assert sum(x.nbytes for table in m.pairs.tables for x in table if isinstance(x, np.ndarray)) < 300 * held
    monkeypatch.setattr(words, "_powers", [])
    for n in (1000, 100_000, 600_000, 600_500, 50):
        power, inverse = words.power_tables(n)
        assert len(power) == len(inverse) > n
        assert int(power[n]) * int(inverse[n]) % 2**64 == 1 and int(power[n]) == pow(words._BASE, n, 2**64)
    assert len(power) < 700_000


def test_encoding_and_signing_take_little_memory_at_once():
    rng = random.Random(8)
    pieces = ["in", "ter", "na", "tion", "al", "ge", "sch", "keit", "é", "x"]
    known = ["".join(rng.choices(pieces, k=rng.randint(1, 5))) for _ in range(4000)]
    texts = pa.array([" ".join(rng.choices(known, k=300)) for _ in range(1200)])
    assert texts.nbytes > 2 << 20
    encoder = sp_dropout.Encoder(tokenizer_file("piece_bpe_32k.model"))

    def encode():
        for a, b, raw, offsets in text_parts(texts, sp_dropout.PORTION):
            encoder.decode_texts(*encoder.encode_texts(raw, offsets, list(range(a, b))))

    def sign():
        for _, _, raw, offsets in text_parts(texts.slice(0, 300), superminhash.SIGN_BYTES):
            superminhash.signatures(*superminhash.shingle_sets(raw, offsets, 5))

    for f, most_mb in ((encode, 28), (sign, 28)):
        f()  # tables that stay
        tracemalloc.start()
        f()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < most_mb << 20, (f.__name__, peak >> 20)
