"""Conversation repair: least edits against all edit strings, and whole conversations in one or several ranges against a plain version."""

import hashlib
import random
import re
import zlib

import pytest

from siteresolve.llm import conversations as c

LEGAL = re.compile(r"(s?(ua)*u?)?")
DONE = re.compile(r"(s?(ua)+)?")


def every_way(codes):
    """The least (cost, edits) of all edit strings with at most two inserts in a row, by the grammar alone."""
    best = None

    def go(k, cost, x, roles):
        nonlocal best
        if not LEGAL.fullmatch(roles) or best and cost > best[0]:
            return
        for n in range(3):
            tail = roles
            for _ in range(n):
                tail += "a" if tail[-1:] == "u" else "u"
            if k == len(codes):
                if DONE.fullmatch(tail):
                    best = min(filter(None, [best, (cost + 3 * n, x + "I" * n)]))
                continue
            code, y, sum_ = codes[k], x + "I" * n, cost + 3 * n
            go(k + 1, sum_ + 4, y + "D", tail)
            if code != c.GONE:
                more, initial = 3 * (code % 2), "sua?"[code // 2]
                if initial != "?":
                    go(k + 1, sum_ + more, y + "K", tail + initial)
                for r in "ua":
                    go(k + 1, sum_ + 3 + more, y + "R", tail + r)

    go(0, 0, "", "")
    return best


def table_way(codes):
    """The same by a plain table of least (cost, edits) by row and state."""
    best = {0: (0, "")}
    for code in codes:
        new = {}
        for a, (cost, x) in best.items():
            for b, w in enumerate(c._STEP[code][a]):
                if w:
                    new[b] = min(new.get(b, (9e9, "")), (cost + w[0], x + w[1]))
        best = new
    return min((cost + c._END[s][0], x + c._END[s][1]) for s, (cost, x) in best.items())


def solved(segments):
    states, cost = c.borders([c.between(x) for x in segments])
    return cost, "".join("".join(c.edits(x, a, b)) for x, a, b in zip(segments, states, states[1:])) + c._END[states[-1]][1]


@pytest.mark.parametrize("way, longest, n", [(every_way, 4, 300), (table_way, 60, 600)])
def test_edits_are_the_least_whole_or_in_segments(way, longest, n):
    rng = random.Random(longest)
    for _ in range(n):
        codes = [rng.choice(rng.choice([range(9), [2, 4], [8, 8, 0]])) for _ in range(rng.randint(0, longest))]
        cuts = [0, *sorted(rng.randint(0, len(codes)) for _ in range(rng.randint(0, 4))), len(codes)]
        want = way(codes)
        assert solved([codes]) == want
        assert solved([codes[a:b] for a, b in zip(cuts, cuts[1:])]) == want


def test_long_stretches_are_linear():
    rng = random.Random(1)
    codes = [rng.randint(0, 8) for _ in range(100_000)]
    cost, audit = solved([codes])
    assert sum(x != "I" for x in audit) == len(codes) and (cost, audit) == solved([codes[:30_000], codes[30_000:30_001], codes[30_001:]])


def plain(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        after = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            f = zlib.crc32(key.encode()) % 20
            text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
            role = "user" if f == 4 else role
            after += [(turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), role, text)] * (0 if f == 0 else 2 if f == 3 else 1)
        after.sort()
        codes, seen, faults = [], set(), [0, 0, 0]
        for *_, role, text in after:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                faults[fault] += 1
            codes.append(c.GONE if fault in (0, 1) else 2 * ("sua".find(role[:1]) % 4 if role else 3) + (fault == 2))
        initials = [x[3][:1] for x in after]
        numbers = [x[1] for x in after if x[0]]
        cost, audit = table_way(codes)
        lines, roles, left = [], "", list(after)
        for letter in audit:
            row = None if letter == "I" else left.pop(0)
            if letter != "D":
                initial = row[3][:1] if letter == "K" else "a" if roles[-1:] == "u" else "u"
                roles += initial
                lines.append((row[3] if letter == "K" else {"u": "user", "a": "assistant"}[initial]) + ":" + (row[4] if row else ""))
        assert DONE.fullmatch(roles) and not left
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out[conv] = (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_repair_equals_a_plain_version(spark, ranges):
    """One conversation holds half of all rows, so with many ranges it lies in many; some ranges hold no whole one."""
    rng = random.Random(ranges)
    texts = [None, "", " \n", "Hi.", "no end", "Why? \n", "x" * 20_000 + ".", "é!", ":", "a\nb."]
    roles = ["user", "assistant", "system", None, "", "tool", "user", "assistant"]
    rows = [(5, rng.choice([None, *range(40)]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.3 else f"t{rng.randint(0, 60)}" + rng.choice([".", ""])) for _ in range(150)]
    rows += [(k % 40 if k % 40 else None, rng.choice([None, *range(6)]), rng.choice(roles), rng.choice(texts)) for k in range(130)]
    rows += [(900, None, "user", "same.")] * 30  # rows that are alike in all are still dealt over ranges
    rows += [(k, 0, "user", "only row.") for k in range(1000, 1060)]  # some of these are dropped
    table = spark.createDataFrame([(*r, "own") for r in rows], "conv_id long, turn long, role string, text string, conv string").repartition(5)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = c.repair(c.damaged(table))
        got = c.digests(pieces).collect()
        assert (ranges == 1) == (pieces.agg({"pieces": "max"}).first()[0] == 1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len({r["conv_id"] for r in got})
    assert {r[0]: tuple(r)[1:] for r in got} == plain(rows)


def test_repair_edges(spark):
    schema = "conv_id string, turn int, role string, text string"
    assert c.digests(c.repair(c.damaged(spark.createDataFrame([], schema)))).count() == 0
    far = spark.createDataFrame([("a", -(1 << 31), "user", "x."), ("a", (1 << 31) - 1, "assistant", "y.")], schema)
    assert {r["conv_id"] for r in c.digests(c.repair(c.damaged(far))).collect()} == {"a"}
