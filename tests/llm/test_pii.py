"""Personal data: base spans by the plain forms, EM on votes drawn from known rates, and held-out texts with personal data in other forms."""

import hashlib
import random
import re
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from siteresolve.llm import pii


def plain_base(text):
    def ok_ip(s):
        return all(int(p) <= 255 for p in s.split("."))

    def digits(s):
        return re.sub("[^0-9]", "", s)

    def luhn(d):
        n = [int(c) for c in d[::-1]]
        return (sum(n[::2]) + sum(sum(divmod(2 * x, 10)) for x in n[1::2])) % 10 == 0

    forms = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", ok_ip),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, (f, ok) in enumerate(forms) for m in re.finditer(f, text) if ok(m[0])]


PIECES = ["a@b.co", "@", ".", "x", "é", " ", "-", "1", "4111111111111111", "4111 1111-1111 1111", "255", "1.2.3.4", "300.1.1.1", "0.0.0.0.1", "+", "+1 (555) 555-0199", "(", ")", "00", "a.b@c-d.e.f", "@b.c", "\n", "_", "999999999999999999999"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_base_spans_equal_the_plain_forms(text):
    assert pii.base_spans(text) == sorted(plain_base(text))
    for s in pii.candidates(text):
        assert 0 <= s["start"] < s["end"] <= len(text) and len(s["votes"]) == len(pii.LABELERS) and max(s["features"]) < pii.WIDTH * len(pii.KINDS)


def test_long_runs_take_linear_time():
    began = time.time()
    for unit in ("a", "1", "1.", "a@", "1 ", "+1", "(", "1-", "a.", "@", " at ", "a:", "a (at) b"):
        pii.candidates(unit * (400_000 // len(unit)))
    assert time.time() - began < 60


def test_em_finds_the_rates_that_votes_were_drawn_from():
    rng = np.random.default_rng(4)
    rates = np.array([[[0.6, 0.3, 0.1], [0.1, 0.2, 0.7]], [[0.7, 0.2, 0.1], [0.05, 0.15, 0.8]], [[0.3, 0.6, 0.1], [0.1, 0.6, 0.3]], [[0.5, 0.1, 0.4], [0.2, 0.1, 0.7]], [[0.8, 0.1, 0.1], [0.1, 0.1, 0.8]]])
    truth = rng.random(60_000) < 0.3
    drawn = np.stack([(rng.random(len(truth))[:, None] > np.cumsum(r[truth.astype(int)], 1)).sum(1) for r in rates], 1)
    counts = {}
    for row in drawn.tolist():
        p = "".join("-0+"[v] for v in row)
        counts[p] = counts.get(p, 0) + 1
    share, found, post = pii.reliabilities(sorted(counts.items()))
    assert abs(share - 0.3) < 0.02 and np.abs(found - rates).max() < 0.03
    said = np.array([post["".join("-0+"[v] for v in row)] > 0.5 for row in drawn.tolist()])
    assert (said == truth).mean() > 0.95


def planted(rng, n):
    """Texts with personal data in other forms, with what is to be found, and look-alikes that are none."""
    word = lambda: "".join(rng.choice("bdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3)))
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def card(k, head):
        body = head + digits(k - len(head) - 1)
        return next(body + c for c in "0123456789" if pii.luhn(body + c))

    rows = []
    for k in range(n):
        name, host = word(), word() + word()
        yes = [
            ("email", f"write to {{}} today", f"{name} (at) {host} (dot) com"),
            ("email", "contact {} or", f"{name}.{word()}[at]{host}.org"),
            ("phone", "call {} now", f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"),
            ("phone", "Tel: {},", f"0049 {rng.randint(30, 99)} {rng.randint(1000, 9999)} {rng.randint(100, 999)}"),
            ("card", "amex card {} paid", card(15, "37")),
            ("ip", "from host {} today", "2001:db8:" + ":".join(f"{rng.randint(1, 65535):x}" for _ in range(6))),
            ("email", "mail {} please", f"{name}@{host}.com"),
            ("phone", "phone {} please", f"+49 30 {rng.randint(1000000, 9999999)}"),
        ]
        no = ["order {} was", "invoice no {} of", "serial {} on", "part {} line"]
        body = [word() for _ in range(30)]
        if k % 2:
            kind, frame, value = yes[k // 2 % len(yes)]
            before, after = frame.split("{}")
            head = " ".join(body[:9]) + " " + before
            rows.append((k, head + value + after + " " + " ".join(body[9:]), f"{kind}:{len(head)}:{len(head) + len(value)}"))
        else:
            value = rng.choice([digits(8), digits(10), f"{digits(4)}_{digits(6)}", f"2019-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}", f"x{digits(9)}"])
            rows.append((k, " ".join(body[:9]) + " " + rng.choice(no).format(value) + " " + " ".join(body[9:]), ""))
    return rows


def test_held_out_texts(spark):
    rows = planted(random.Random(1), 1600)
    held = planted(random.Random(2), 400)
    table = lambda r: spark.createDataFrame([(i, t, "c") for i, t, _ in r], "doc_id long, text string, candidates string").repartition(4)
    weights = pii.model(pii.found(table(rows)))
    right = wrong = wanted = 0
    for _, text, want in held:
        got = set(filter(None, pii.joined(pii.decided(pii.candidates(text), weights)).split(",")))
        want = set(filter(None, [want]))
        right, wrong, wanted = right + len(got & want), wrong + len(got - want), wanted + len(want)
    assert right >= 0.9 * wanted and wrong <= 0.05 * wanted, (right, wrong, wanted)


def test_scan_equals_a_plain_version(spark):
    rows = planted(random.Random(3), 300)
    docs = [(i, t) for i, t, _ in rows] + [(1, None), (2, ""), (None, "a@b.co"), (7, "a@b.co"), (7, "x " * 100_000 + "1.2.3.4"), (8, "😀 a@b.co 4111111111111111")]
    table = spark.createDataFrame([(i, t, "c", 1) for i, t in docs], "doc_id long, text string, candidates string, kind int").repartition(5)
    got = pii.scan(table)
    assert got.columns[:7] == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    weights = pii.model(pii.found(table))
    want = []
    for i, t in docs:
        base, every = sorted(plain_base(t or "")), pii.decided(pii.candidates(t), weights)
        assert set(base) <= set(every)
        counts = [sum(k == b[0] for b in base) for k in range(4)]
        want.append((i, *counts, hashlib.sha256(pii.joined(base).encode()).hexdigest(), pii.joined(every), len(every) - len(base)))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert any(w[-1] for w in want)


def test_the_sample_is_cut_by_hash(spark):
    """Many more candidates than the sample takes: the model still tells them, and does so alike however rows are dealt."""
    rows = planted(random.Random(6), 1200)
    table = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    one, other = (pii.model(pii.found(table.repartition(n)), sample=150) for n in (2, 7))
    assert np.array_equal(one, other) and np.abs(one).max() > 0
    everything = pii.model(pii.found(table), sample=10**6)
    assert not np.array_equal(one, everything)


def test_scan_without_rows_or_candidates(spark):
    schema = "doc_id string, text string"
    assert pii.scan(spark.createDataFrame([], schema)).count() == 0
    assert pii.scan(spark.createDataFrame([("a", None), ("b", "no data")], schema)).agg({"n_added": "sum"}).first()[0] == 0
