"""Conversation structure repair: the cheapest edits that give a well-formed order of roles.

The rows of a conversation are taken by turn. Edits are Keep (0), Rerole to user or assistant (3), Delete
(4; the only edit of blank rows and of duplicates) and Insert of an empty user or assistant text (3,
anywhere); a truncated row that is not deleted adds 3. The roles that are left, by their initials, must
be ``(s?(ua)+)?``. Four states follow them: nothing yet, after s, after u, after a; the end may be
in the first or the last. Of edit strings of least cost the ASCII-least is the answer.

The method is Hirschberg's. Over any stretch of rows a vector of four costs is carried forward from the
stretch's first state and another backward from its last one; they meet in the middle, where the
crossing of least sum is fixed, and both halves are solved alike. No table of costs by row is kept.
Inserts belong to the row that they precede, so the edit strings of one stretch are prefix-free, and strings
that lead to different states differ: each forward vector therefore carries the states' order by
least string, and of crossings that tie the first in this order is the audit-least.

Rows are sorted into ranges by conversation and turn, so a conversation that lies inside a range is
whole in one task, where it is solved at once. The first and the last of each range may go on in the
next one: their rows are written apart, a segment per range (``_segments``). A segment is summed up as the
costs and orders between its four first and four last states; of these a conversation has one a range,
and the same divide-and-conquer over them fixes the states in which each segment begins and ends.
Then each segment is solved on its own. So a conversation with a third of all rows is worked on by as
many tasks as it has ranges, and its answer comes in as many pieces. Repeats inside a segment are
told apart there; only the first of each meets those of other segments, at most one a range.

Nulls, ties and repeats: a null role or text is one space (blank, and no known role); a null turn comes
first and counts for no gap; null conversation ids make one conversation. Rows of equal turn come in
the order of the SHA-256 of role and text. Rows repeated whole are rows of their own, the later
ones duplicates. Texts are taken whole at any length. Extra columns are ignored, whatever their
names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, size_checked

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
STATES = 4
_NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_ROLES = {"u": "user", "a": "assistant"}
_LEGAL = {"su", "ua", "au"}
#: A row's class: its initial among "sua" or another one, and whether it is truncated; GONE where it must go.
GONE = 8


def _inserts(state: int) -> list[tuple[str, int]]:
    """Inserts before a row, and the state after them. A third would come back to the state after the first."""
    out = [("", state)]
    for _ in range(2):
        state = _NEXT["a" if state == 2 else "u"][state]
        out.append((out[-1][0] + "I", state))
    return out


def _steps() -> list[list[list[tuple[int, str] | None]]]:
    """By class, state before and state after: the least (cost, edits) over one row and the inserts before it."""
    table = []
    for code in range(GONE + 1):
        initial, more = "sua?"[code // 2 % 4], TRUNCATED * (code % 2)
        paths = [[None] * STATES for _ in range(STATES)]
        for a in range(STATES):
            for letters, b in _inserts(a):
                edits = [("D", DELETE, b)]
                if code != GONE:
                    edits += [("R", REROLE + more, _NEXT[c][b]) for c in "ua" if b in _NEXT[c]]
                    edits += [("K", KEEP + more, _NEXT[initial][b])] if b in _NEXT.get(initial, {}) else []
                for letter, cost, c in edits:
                    way = (INSERT * len(letters) + cost, letters + letter)
                    if paths[a][c] is None or way < paths[a][c]:
                        paths[a][c] = way
        table.append(paths)
    return table


_STEP = _steps()
_END = [(INSERT * len(letters), letters) for letters in ("", "II", "I", "")]
#: Costs and orders by state; None where the state can't be reached. An order is a place among the reached states by least edit string.
Vector = tuple[tuple[int, int] | None, ...]


#: Whatever follows, at most 7 more reach the same end from any state as from any other one (by two inserts and a
#: delete at most): a state that costs more than the least one by this is on no cheapest way and is left out.
BEYOND = 8


def unit(state: int) -> Vector:
    return tuple((0, 0) if s == state else None for s in range(STATES))


def _joined(vector: Vector, ways) -> tuple[Vector, int]:
    """``vector`` carried over ``ways`` (by state before and after: cost and an order), less its least cost, and that cost."""
    best = []
    for c in range(STATES):
        found = [(v[0] + w[0], v[1], w[1]) for v, w in ((vector[b], ways[b][c]) for b in range(STATES)) if v and w]
        best.append(min(found) if found else None)
    least = min(x[0] for x in best if x)
    best = [x if x and x[0] <= least + BEYOND else None for x in best]
    ranks = {key: k for k, key in enumerate(sorted(x[1:] for x in best if x))}
    return tuple((x[0] - least, ranks[x[1:]]) if x else None for x in best), least


@lru_cache(1 << 16)
def _forward(vector: Vector, code: int) -> tuple[Vector, int]:
    # vectors less their least cost are few, so nearly every step is a look-up
    return _joined(vector, _STEP[code])


@lru_cache(1 << 16)
def _backward(costs: tuple, code: int) -> tuple[tuple, int]:
    new = [min((w[0] + x for w, x in zip(_STEP[code][a], costs) if w and x is not None), default=None) for a in range(STATES)]
    least = min(x for x in new if x is not None)
    return tuple(None if x is None else x - least for x in new), least


def _crossing(forward: Vector, backward) -> int:
    return min((f[0] + b, f[1], s) for s, (f, b) in enumerate(zip(forward, backward)) if f and b is not None)[2]


def edits(codes: list[int], first: int, last: int) -> list[str]:
    """The least edits of each row, with the inserts before it, from state ``first`` to state ``last``; Hirschberg's recursion, as a stack of stretches."""
    out, todo = [], [(0, len(codes), first, last)] if codes else []
    while todo:
        lo, hi, a, b = todo.pop()
        if hi - lo == 1:
            out.append(_STEP[codes[lo]][a][b][1])
            continue
        mid = (lo + hi) // 2
        forward, backward = unit(a), tuple(0 if s == b else None for s in range(STATES))
        for k in range(lo, mid):
            forward = _forward(forward, codes[k])[0]
        for k in range(hi - 1, mid - 1, -1):
            backward = _backward(backward, codes[k])[0]
        s = _crossing(forward, backward)
        todo += [(mid, hi, s, b), (lo, mid, a, s)]
    return out


def between(codes: list[int]) -> list[list[tuple[int, int] | None]]:
    """By state before and after all of ``codes``: cost and order."""
    out = []
    for a in range(STATES):
        vector, total = unit(a), 0
        for code in codes:
            vector, more = _forward(vector, code)
            total += more
        out.append([x and (x[0] + total, x[1]) for x in vector])
    return out


def borders(sums: list, first: int = 0) -> tuple[list[int], int]:
    """States before, between and after segments with these ``between``, and the whole cost with the last inserts."""
    forward, total = unit(first), 0
    for ways in sums:
        forward, more = _joined(forward, ways)
        total += more
    last = _crossing(forward, [x for x, _ in _END])
    cost = total + forward[last][0] + _END[last][0]
    states, todo = [first, *[0] * len(sums)], [(0, len(sums), first, last)]
    while todo:
        lo, hi, a, b = todo.pop()
        if hi - lo < 2:
            states[hi] = b
            continue
        mid = (lo + hi) // 2
        forward, backward = unit(a), [0 if s == b else None for s in range(STATES)]
        for k in range(lo, mid):
            forward = _joined(forward, sums[k])[0]
        for k in range(hi - 1, mid - 1, -1):
            backward = [min((w[0] + x for w, x in zip(sums[k][s], backward) if w and x is not None), default=None) for s in range(STATES)]
        s = _crossing(forward, backward)
        todo += [(lo, mid, a, s), (mid, hi, s, b)]
    return states, cost


def turns(rows: list[tuple[str, str]], audit: list[str], state: int) -> tuple[list[dict], int]:
    """The rows that ``audit`` (edits by row) leaves or inserts, and the state after them."""
    out = []

    def put(letter: str, role: str | None, text: str) -> None:
        nonlocal state
        initial = role[:1] if letter == "K" else "a" if state == 2 else "u"
        out.append({"role": role if letter == "K" else _ROLES[initial], "text": text})
        state = _NEXT[initial][state]

    for (role, text), letters in zip(rows, audit):
        for letter in letters:
            if letter != "D":
                put(letter, role, "" if letter == "I" else text)
    return out, state


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows as conv, turn, role, text, alive: by crc32("conv:turn") % 20, 0 drops a row (it stays as one that is not alive), 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes its role user."""
    blank = F.lit(" ")
    conv, turn = F.col(conv_col), F.col(turn_col)
    part = F.crc32(F.concat(F.coalesce(conv.cast("string"), blank), F.lit(":"), F.coalesce(turn.cast("string"), blank)).cast("binary")) % 20
    given = rows.select(conv.alias("conv"), turn.alias("turn"), F.coalesce(role_col, blank).alias("role"), F.coalesce(text_col, blank).alias("text"), part.alias("part"))
    part, text = F.col("part"), F.col("text")
    return given.select(
        "conv",
        "turn",
        F.when(part == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(part <= 1, F.lit("")).when(part == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (part != 0).alias("alive"),
        F.explode(F.when(part == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows of conv, turn, role, text, alive in ranges by conversation and turn, with what is to be known of each."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    end = F.right(F.rtrim(text, F.lit(SPACES)), F.lit(1))
    known = rows.select(
        "conv",
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        "alive",
        (end == "").alias("is_blank"),
        (~end.isin(".", "!", "?")).alias("is_cut"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("place"),
    )
    # place parts only rows that are alike in all else, so that no range must hold them all
    by = ["conv", "turn", "digest", "place"]
    return known.repartitionByRange(*by).sortWithinPartitions(*by)


class _Segment:
    """Rows of one conversation in order, as counts and classes."""

    def __init__(self, rows: list[dict], repeated: list[bool] | None = None):
        rows = [r for r in rows if r["alive"]]
        self.rows, self.codes, self.blank, self.duplicate, self.truncated, self.illegal = rows, [], 0, 0, 0, 0
        seen: set[bytes] = set()
        before = None
        for r in rows:
            again = r["repeated"] if "repeated" in r else r["digest"] in seen
            seen.add(r["digest"])
            initial = r["initial"] if "initial" in r else r["role"][:1]
            if r["is_blank"] or again:
                self.codes.append(GONE)
                self.blank += r["is_blank"]
                self.duplicate += not r["is_blank"]
            else:
                k = "sua".find(initial) if initial else -1
                self.codes.append(2 * (k if k >= 0 else 3) + r["is_cut"])
                self.truncated += r["is_cut"]
            self.illegal += before is not None and before + initial not in _LEGAL
            before = initial
        numbers = [r["turn"] for r in rows if r["turn"] is not None]
        self.numbers = (min(numbers), max(numbers), len(set(numbers))) if numbers else None
        self.initials = (rows[0]["initial"] if "initial" in rows[0] else rows[0]["role"][:1], before) if rows else None


def _gaps(least: int, most: int, n: int) -> int:
    """A long that wraps, as Spark's do."""
    return (most - least + 1 - n + (1 << 63)) % (1 << 64) - (1 << 63)


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_OPEN = ["turn", "role", "text", "alive", "is_blank", "is_cut", "digest"]


def _solved(rows: list[dict]) -> dict:
    s = _Segment(rows)
    states, cost = borders([between(s.codes)])
    audit = edits(s.codes, 0, states[1])
    out, _ = turns([(r["role"], r["text"]) for r in s.rows], [*audit], 0)
    end = _END[states[1]][1]
    more, _ = turns([("", "")], [end], states[1])
    return {"gaps": _gaps(*s.numbers) if s.numbers else 0, "blank": s.blank, "duplicate": s.duplicate, "truncated": s.truncated, "illegal": s.illegal, "cost": cost, "audit": "".join(audit) + end, "turns": out + more}


def _solve_ranges(ordered: DataFrame) -> DataFrame:
    """Whole conversations solved (``cost`` not null); the rows of each range's first and last one as they are, with a segment number, place and whether they repeat one of the segment."""
    kind = ordered.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() * 2
        held: list[dict] = []
        first = True
        conv_type = None

        def batch_of(closed: list[tuple], rows: list[dict], segment: int | None) -> pa.RecordBatch:
            convs = [c for c, _ in closed] + [r["conv"] for r in rows]
            n, m = len(closed), len(rows)
            seen: set[bytes] = set()
            repeated = []
            for r in rows:
                repeated.append(r["alive"] and r["digest"] in seen)
                if r["alive"]:
                    seen.add(r["digest"])
            columns = [pa.array(convs, conv_type)]
            columns += [pa.array([x[c] for _, x in closed] + [None] * m, pa.int64()) for c in REPORT]
            columns += [pa.array([x["audit"] for _, x in closed] + [None] * m, pa.string()), pa.array([x["turns"] for _, x in closed] + [None] * m, TURNS)]
            columns += [pa.array([None] * n + [segment] * m, pa.int64()), pa.array([None] * n + list(range(m)), pa.int64()), pa.array([None] * n + repeated, pa.bool_())]
            types = [pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.bool_(), pa.binary()]
            columns += [pa.array([None] * n + [r[c] for r in rows], t) for c, t in zip(_OPEN, types)]
            return pa.RecordBatch.from_arrays(columns, ["conv", *REPORT, "audit", "turns", "segment", "at", "repeated", *_OPEN])

        for batch in batches:
            conv_type, closed, opened = batch.schema.field("conv").type, [], []
            for r in batch.to_pylist():
                if held and held[0]["conv"] != r["conv"]:
                    if first:
                        opened, first = held, False
                    else:
                        closed.append((held[0]["conv"], _solved(held)))
                    held = []
                held.append(r)
            if opened or closed:
                yield batch_of(closed, opened, number)
        if held:
            yield batch_of([], held, number + (not first))

    report = ", ".join(f"{c} long" for c in REPORT)
    return ordered.drop("place").mapInArrow(
        run, f"conv {kind}, {report}, audit string, turns array<struct<role string, text string>>, segment long, at long, repeated boolean, turn long, role string, text string, alive boolean, is_blank boolean, is_cut boolean, digest binary"
    )


_SUMS = "segment long, costs array<long>, ranks array<long>, n_blank long, n_duplicate long, n_truncated long, n_illegal long, initials array<string>, numbers array<long>"


def _segments(parts: DataFrame) -> DataFrame:
    """Pieces of the conversations that may lie in several ranges, from the rows that ``_solve_ranges`` left."""
    kind = parts.schema["conv"].dataType.simpleString()
    rows = parts.filter("segment IS NOT NULL").select("conv", "segment", "at", "repeated", *_OPEN)
    once = F.col("alive") & ~F.col("repeated")
    # the first of each text in each segment meets those of the conversation's other segments
    firsts = rows.filter(once).groupBy("conv", "digest").agg(F.min("segment").alias("earliest"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = durable(firsts.select(F.col("conv").alias("c"), F.col("digest").alias("d"), "earliest"), "repeats")
    met = rows.filter(once).join(firsts, rows["conv"].eqNullSafe(F.col("c")) & (rows["digest"] == F.col("d")), "left")
    met = met.withColumn("repeated", F.coalesce(F.col("segment") > F.col("earliest"), F.lit(False))).drop("c", "d", "earliest")
    rows = durable(met.unionByName(rows.filter(~once)).withColumn("initial", F.left("role", F.lit(1))), "open")

    def summed(table: pa.Table) -> pa.Table:
        got = table.sort_by("at").to_pylist()
        s = _Segment(got)
        ways = [w for line in between(s.codes) for w in line]
        out = {"segment": got[0]["segment"], "costs": [w and w[0] for w in ways], "ranks": [w and w[1] for w in ways], "n_blank": s.blank, "n_duplicate": s.duplicate, "n_truncated": s.truncated}
        out |= {"n_illegal": s.illegal, "initials": list(s.initials) if s.initials else None, "numbers": list(s.numbers) if s.numbers else None}
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.int64()] * 4, pa.list_(pa.string()), pa.list_(pa.int64())]
        return pa.table({c: pa.array([v], t) for (c, v), t in zip(out.items(), types)})

    sums = rows.drop("role", "text").groupBy("segment").applyInArrow(summed, _SUMS)
    convs = rows.groupBy("segment").agg(F.first("conv").alias("conv"))
    sums = durable(sums.join(convs, "segment"), "sums")

    def chained(table: pa.Table) -> pa.Table:
        got = table.sort_by("segment").to_pylist()
        ways = [[[c if c is None else (c, k) for c, k in zip(x["costs"][4 * a : 4 * a + 4], x["ranks"][4 * a : 4 * a + 4])] for a in range(STATES)] for x in got]
        states, cost = borders(ways)
        illegal, before = sum(x["n_illegal"] for x in got), None
        for x in got:
            if x["initials"]:
                illegal += before is not None and before + x["initials"][0] not in _LEGAL
                before = x["initials"][1]
        numbers = [x["numbers"] for x in got if x["numbers"]]
        shared = sum(a[1] == b[0] for a, b in zip(numbers, numbers[1:]))
        gaps = _gaps(numbers[0][0], numbers[-1][1], sum(x[2] for x in numbers) - shared) if numbers else 0
        report = [gaps, *(sum(x[c] for x in got) for c in ("n_blank", "n_duplicate", "n_truncated")), illegal, cost]
        n = len(got)
        columns = {"segment": [x["segment"] for x in got], "piece": list(range(n)), "pieces": [n] * n, "before": states[:-1], "after": states[1:], **{c: [v] * n for c, v in zip(REPORT, report)}}
        return pa.table({c: pa.array(v, pa.int64()) for c, v in columns.items()})

    # a row a segment, at most two a range
    report = ", ".join(f"{c} long" for c in REPORT)
    chain = durable(sums.groupBy("conv").applyInArrow(chained, f"segment long, piece long, pieces long, before long, after long, {report}"), "chain")

    def solved(table: pa.Table) -> pa.Table:
        got = table.sort_by("at").to_pylist()
        s, one = _Segment(got), got[0]
        audit = edits(s.codes, one["before"], one["after"])
        out, state = turns([(r["role"], r["text"]) for r in s.rows], audit, one["before"])
        if one["piece"] == one["pieces"] - 1:
            end = _END[one["after"]][1]
            out += turns([("", "")], [end], one["after"])[0]
            audit = [*audit, end]
        columns = {"conv": table.column("conv").slice(0, 1).combine_chunks(), **{c: pa.array([one[c]], pa.int64()) for c in ["piece", "pieces", *REPORT]}}
        return pa.table({**columns, "audit": pa.array(["".join(audit)], pa.string()), "turns": pa.array([out], TURNS)})

    return rows.join(size_checked(chain, 128), "segment").groupBy("segment").applyInArrow(solved, f"conv {kind}, piece long, pieces long, {report}, audit string, turns array<struct<role string, text string>>")


def repair(rows: DataFrame) -> DataFrame:
    """Repaired conversations from rows of conv, turn, role, text, alive (false: the row only names its conversation).

    Per conversation: conv, piece, pieces, REPORT (gaps, blank, duplicate, truncated, illegal, cost), audit and
    turns (role, text). One that lies in several ranges comes in ``pieces`` rows of equal reports, whose
    audits and turns follow each other by ``piece``.
    """
    parts = durable(_solve_ranges(_ordered(rows)), "ranges")
    whole = parts.filter("segment IS NULL").select("conv", F.lit(0).cast("long").alias("piece"), F.lit(1).cast("long").alias("pieces"), *REPORT, "audit", "turns")
    return whole.unionByName(_segments(parts))


def digests(pieces: DataFrame, id_name: str = "conv_id") -> DataFrame:
    """Per conversation: id, REPORT, audit, repaired_sha256 of its ``role:text`` joined by newlines. Pieces of one are hashed one after another as they come, as SHA-256 must be; none is held with another."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    kept = [F.col("conv").alias(id_name), *REPORT, "audit"]
    whole = pieces.filter("pieces = 1").select(*kept, F.sha2(lines.cast("binary"), 256).alias("repaired_sha256"))
    kind = pieces.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, audit, begun = hashlib.sha256(), [], False
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                x = {c: row.column(c)[0].as_py() for c in ("piece", "pieces", "audit", "n", "body")}
                if not x["piece"]:
                    state, audit, begun = hashlib.sha256(), [], False
                audit.append(x["audit"])
                if x["n"]:
                    state.update((b"\n" if begun else b"") + x["body"].encode())
                    begun = True
                if x["piece"] == x["pieces"] - 1:
                    last = [row.column("conv"), *(row.column(c) for c in REPORT), pa.array(["".join(audit)]), pa.array([state.hexdigest()])]
                    yield pa.RecordBatch.from_arrays(last, [id_name, *REPORT, "audit", "repaired_sha256"])

    report = ", ".join(f"{c} long" for c in REPORT)
    several = pieces.filter("pieces > 1").select("conv", "piece", "pieces", *REPORT, "audit", F.size("turns").alias("n"), lines.alias("body"))
    several = several.repartition("conv").sortWithinPartitions("conv", "piece").mapInArrow(run, f"{id_name} {kind}, {report}, audit string, repaired_sha256 string")
    return whole.unionByName(several)


ORACLE = r"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c,
    xor(4294967295, list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
        lambda x: [CAST(unicode(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda h, b: CASE WHEN b >= 0 THEN xor(h, b) WHEN h & 1 = 1 THEN xor(3988292384, h >> 1) ELSE h >> 1 END)) % 20 AS part
  FROM conversations),
damaged AS (
  SELECT c, turn, CASE WHEN part = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN part = 1 THEN '' WHEN part = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM given, (SELECT unnest([1, 2]) AS copy) WHERE part <> 0 AND (copy = 1 OR part = 3)),
placed AS (
  SELECT c, turn, role, text, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS is_blank,
    regexp_matches(text, '[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*$') AS is_cut,
    row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS k
  FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY k) AS again FROM placed),
faults AS (
  SELECT *, is_blank OR again > 1 AS gone, is_cut AND NOT is_blank AND again = 1 AS cut, lag(initial) OVER (PARTITION BY c ORDER BY k) || initial AS pair FROM seen),
report AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (is_blank) AS blank, count(*) FILTER (again > 1 AND NOT is_blank) AS duplicate,
    count(*) FILTER (cut) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faults GROUP BY c),
-- states: 0 nothing yet, 1 after s, 2 after u, 3 after a
ins(s, t, cost, edits, lines) AS (VALUES
  (0, 0, 0, '', ''), (0, 2, 3, 'I', chr(10) || 'user:'), (0, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (1, 1, 0, '', ''), (1, 2, 3, 'I', chr(10) || 'user:'), (1, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (2, 2, 0, '', ''), (2, 3, 3, 'I', chr(10) || 'assistant:'), (2, 2, 6, 'II', chr(10) || 'assistant:' || chr(10) || 'user:'),
  (3, 3, 0, '', ''), (3, 2, 3, 'I', chr(10) || 'user:'), (3, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
moves(s, initial, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
ops AS (
  SELECT s, t, initial, 'K' AS edit, 0 AS cost, NULL AS new_role FROM moves
  UNION ALL SELECT s, t, NULL, 'R', 3, CASE initial WHEN 'u' THEN 'user' ELSE 'assistant' END FROM moves WHERE initial <> 's'
  UNION ALL SELECT DISTINCT s, s, NULL, 'D', 4, NULL FROM ins),
walk AS (
  SELECT c, CAST(0 AS BIGINT) AS k, 0 AS s, {'cost': CAST(0 AS BIGINT), 'edits': '', 'lines': ''} AS best FROM (SELECT DISTINCT c FROM given)
  UNION ALL
  SELECT f.c, f.k, o.t, min({'cost': CAST(w.best.cost + i.cost + o.cost + CASE WHEN f.cut AND o.edit <> 'D' THEN 3 ELSE 0 END AS BIGINT), 'edits': w.best.edits || i.edits || o.edit,
    'lines': w.best.lines || i.lines || CASE WHEN o.edit = 'D' THEN '' ELSE chr(10) || coalesce(o.new_role, f.role) || ':' || f.text END})
  FROM walk w JOIN faults f ON f.c = w.c AND f.k = w.k + 1 JOIN ins i ON i.s = w.s JOIN ops o ON o.s = i.t AND (o.edit <> 'K' OR o.initial = f.initial) AND (o.edit = 'D' OR NOT f.gone)
  GROUP BY f.c, f.k, o.t),
ends AS (
  SELECT w.c, min({'cost': CAST(w.best.cost + i.cost AS BIGINT), 'edits': w.best.edits || i.edits, 'lines': w.best.lines || i.lines}) AS best
  FROM walk w LEFT JOIN report r ON r.c = w.c JOIN ins i ON i.s = w.s AND (i.t = 3 OR i.t = 0) WHERE w.k = coalesce(r.n, 0) GROUP BY w.c)
SELECT g.conv_id, coalesce(r.gaps, 0) AS gaps, coalesce(r.blank, 0) AS blank, coalesce(r.duplicate, 0) AS duplicate, coalesce(r.truncated, 0) AS truncated, coalesce(r.illegal, 0) AS illegal,
  e.best.cost AS cost, e.best.edits AS audit, sha256(substr(e.best.lines, 2)) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM given) g JOIN ends e ON e.c = g.c LEFT JOIN report r ON r.c = g.c
"""
