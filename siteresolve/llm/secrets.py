"""Secret scans: fixed-form base spans, and password guess costs of values in credential context.

Base kinds, leftmost and non-overlapping per kind, in code points with an exclusive end:
``assign`` (a credential name, ``:`` or ``=``, a value of 12 or more characters), ``access``
(AKIA keys of 18 or more characters) and ``hex`` (runs of 16 or more digits).

The method adds kind ``guess``: every value that follows a credential word (a wider list than the
base's, also at the end of a longer name, and without ``:`` or ``=`` after "is"), any MIN_VALUE or
more visible characters other than a credential word itself, whose guess cost is at least
``least_bits``. The guess cost is the smallest sum, over all segmentations of the
value, of the segments' costs in bits (see ``suffix_bits``). Dynamic programming goes backwards from
the end of a run of visible characters, so that one table has the costs of all values that begin in
it, however many do. A word's cost is its rank: first the short list of words that people put
into passwords, then the words of a public vocabulary file (``words``, a byte-level BPE in the
tokenizers library's format) in its merge order, which goes by how often they occur.

Null and empty texts have no spans. Texts and values are taken whole at any length, in little more
than linear time; repeated rows repeat. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["assign", "access", "hex", "guess"]
LEAST_BITS = 30.0
MIN_VALUE = 6

_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_CREDENTIAL = "(?:password|passwd|passphrase|passcode|pass|pwd|pin|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|login)"
_CONTEXT = re.compile(_CREDENTIAL + r"[\"']?(?:\x20*(?::=|=>|[:=])\x20*|\x20+is\x20+)[\"']?", re.IGNORECASE | re.ASCII)
_VALUE = re.compile(r"\S+")
LONGEST_CREDENTIAL = 16
_WORD_ITSELF = re.compile(_CREDENTIAL, re.IGNORECASE | re.ASCII).fullmatch

# Words that people put into passwords, most common first (a word's place is its guess rank).
WORDS = (
    "password the and love admin welcome monkey dragon master hello secret test user root login pass letmein sunshine princess football baseball "
    "shadow superman batman michael jordan soccer hockey killer george charlie andrew michelle jessica pepper daniel access starwars computer "
    "summer winter spring autumn flower freedom whatever cheese cookie orange banana apple guitar music money happy lucky angel tiger "
    "eagle falcon silver golden diamond thunder ginger hunter ranger buster thomas robert matthew joshua maggie hannah amanda nicole "
    "internet server system database backup default public private guest demo sample example token key changeme temp staging production "
    "qwerty iloveyou trustno january february march april may june july august september october november december monday friday sunday "
    "red green blue black white north south east west king queen star moon sun fire water earth wind home office school work family"
).split()
KEY_ROWS = ["`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./"]
LEET = str.maketrans("430$@157", "aeosaist")

_NEXT: set[tuple[str, str]] = set()
for _r, _row in enumerate(KEY_ROWS):
    for _k, _c in enumerate(_row):
        for _other in (_row[_k + 1 : _k + 2], *(KEY_ROWS[_r + 1][max(0, _k - 1) : _k + 1] if _r + 1 < len(KEY_ROWS) else "")):
            _NEXT |= {(x, y) for a, b in ((_c, _other), (_other, _c)) if a and b for x in (a,) for y in (b,)}

_DATE = re.compile(r"(?:(?:19|20)\d\d[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d)")
SEGMENT_BITS = 1.0
YEARS = 120
WALK_BITS, TURN_BITS = math.log2(47), 2.0
#: Units of repeats up to this length cost what their own cheapest segmentation does, longer ones what their characters do (far beyond any threshold).
OWN_SEGMENTS = 64
#: Values up to this length look for repeats period by period, longer ones by anchors.
SHORT = 200

_ranks: dict[str | None, dict[str, int]] = {}
_beginnings: dict[int, frozenset[str]] = {}


def word_ranks(path: str | None) -> dict[str, int]:
    """Rank by word, from 1; the vocabulary file is read once per worker."""
    if path not in _ranks:
        words = dict.fromkeys(WORDS)
        if path:
            with open(path) as f:
                vocabulary = json.load(f)["model"]["vocab"]
            # "Ġ" is the format's mark for a space: such pieces begin words
            words.update(dict.fromkeys(w for x in sorted(vocabulary, key=vocabulary.get) if x[0] == "Ġ" and (w := x[1:].lower()).isascii() and w.isalpha() and len(w) >= 3))
        _ranks[path] = {w: k + 1 for k, w in enumerate(words)}
    return _ranks[path]


def _prefixes(ranks: dict[str, int]) -> frozenset[str]:
    if id(ranks) not in _beginnings:
        _beginnings[id(ranks)] = frozenset(w[:k] for w in ranks for k in range(1, len(w) + 1))
    return _beginnings[id(ranks)]


def char_bits(c: str) -> float:
    """A brute-force span costs this for each of its characters: the size of the character's class."""
    return math.log2(10) if c.isdigit() else math.log2(26) if c.isascii() and c.isalpha() else math.log2(33) if c.isascii() else math.log2(1 << 12)


def word_bits(s: str, ranks: dict[str, int]) -> float | None:
    """Rank of the word, and a bit or two for capitals or digits in place of letters."""
    low = s.lower()
    bits = 0.0 if low == s else 1.0 if s[1:] == low[1:] or s.isupper() else 2.0
    if low not in ranks:
        low, bits = low.translate(LEET), bits + 2.0
    return math.log2(ranks[low]) + 1 + bits if low in ranks else None


def date_bits(s: str) -> float | None:
    if not _DATE.fullmatch(s):
        return None
    return math.log2(YEARS) if len(s) == 4 else math.log2(YEARS * 365) + 2.0 * (not s.isdigit())


def walk_step(a: str, b: str) -> bool:
    """Neighbours on the keyboard, or one apart in the alphabet or in digits."""
    a, b = a.lower(), b.lower()
    return (a, b) in _NEXT or (a.isalnum() and b.isalnum() and a.isdigit() == b.isdigit() and abs(ord(a) - ord(b)) == 1)


def _runs_by_period(value: str) -> list[tuple[int, int, int]]:
    out: list[tuple[int, int, int]] = []
    n = len(value)
    for p in range(1, n // 2 + 1):
        since = None
        for i in range(n - p + 1):
            if i < n - p and value[i] == value[i + p]:
                since = i if since is None else since
            elif since is not None:
                if i - since >= p and not any(p % q == 0 and s <= since and i + p <= e for q, s, e in out):
                    out.append((p, since, i + p))
                since = None
    return out


def _common(codes: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray, sums: np.ndarray, powers: np.ndarray, prime: int) -> np.ndarray:
    """How many characters from ``a`` and ``b`` (before ``a``) on agree, ``most`` at most: binary search by hash."""
    low, high = np.zeros(len(a), np.int64), most.copy()
    while (low < high).any():
        mid = (low + high + 1) // 2
        x, y = (sums[a + mid] - sums[a]) % prime * powers[b - a] % prime, (sums[b + mid] - sums[b]) % prime
        same = x == y
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def _runs_by_anchors(value: str) -> list[tuple[int, int, int]]:
    """A stretch of period p and length 2p or more holds two places that are multiples of p: those of all periods, some n log n pairs, are extended both ways."""
    codes = np.array([ord(c) for c in value], np.int64)
    n, prime = len(codes), (1 << 31) - 1
    powers = np.ones(1, np.int64)
    while len(powers) <= n:
        powers = np.concatenate([powers, powers * (int(powers[-1]) * 911382323 % prime) % prime])
    sums = np.concatenate([[0], np.cumsum((codes + 1) * powers[:n] % prime)])
    back = codes[::-1]
    back_sums = np.concatenate([[0], np.cumsum((back + 1) * powers[:n] % prime)])
    out: list[tuple[int, int, int]] = []
    long: list[tuple[int, int, int]] = []
    p = 1
    while p <= n // 2:
        last, pairs = p, n // p
        while last + 1 <= min(n // 2, 2 * p - 1) and pairs < 1 << 20:
            last += 1
            pairs += n // last
        sizes = np.array([len(range(0, n - q, q)) for q in range(p, last + 1)])
        first = np.cumsum(sizes) - sizes
        period = np.repeat(np.arange(p, last + 1), sizes)
        x = (np.arange(len(period)) - np.repeat(first, sizes)) * period
        ok = codes[x] == codes[x + period]
        for q, s, e in long:  # a multiple of a stretch's period has no stretch of its own in it
            for m in range(-(-p // q) * q, min(last, (e - s) // 2) + 1, q):
                k = first[m - p]
                ok[k + -(-s // m) : k + max(-(-s // m), -(-(e - m) // m))] = False
        x, period = x[ok], period[ok]
        if len(x):
            ahead = _common(codes, x, x + period, n - x - period, sums, powers, prime)
            behind = _common(back, n - x - period, n - x, x, back_sums, powers, prime)
            found = np.unique(np.stack([period, x - behind, x + period + ahead], 1)[ahead + behind >= period], axis=0)
            for q, s, e in found.tolist():
                if not np.array_equal(codes[s : e - q], codes[s + q : e]):  # a hash that lied: what agrees around each anchor is found character by character
                    out += [r for r in _runs_near(value, q, s, e) if r not in out]
                    continue
                out.append((q, s, e))
                if e - s >= 4 * q:
                    long.append((q, s, e))
        long = [r for r in long if r[2] - r[1] >= 2 * (last + 1)]
        p = last + 1
    return out


def _runs_near(value: str, p: int, lo: int, hi: int) -> list[tuple[int, int, int]]:
    out, since = [], None
    for i in range(lo, hi - p + 1):
        if i < hi - p and value[i] == value[i + p]:
            since = i if since is None else since
        elif since is not None:
            out += [(p, since, i + p)] if i - since >= p else []
            since = None
    return out


def repeats(value: str) -> list[tuple[int, int, int]]:
    """(period, start, end) of each longest stretch that repeats a unit, itself no repeat, twice or more."""
    return _runs_by_period(value) if len(value) <= SHORT else _runs_by_anchors(value)


class _Farther:
    """The least ``costs[j] + log2(times)`` over the ends j = i + times * p so far, as i goes down by p.

    Of two ends the farther gains on the nearer with every step, so one that is beaten stays so: a stack
    holds those that will be best in turn, each with the first i at which the next takes over.
    """

    def __init__(self, p: int):
        self.p, self.stack = p, []

    def _takes_over(self, near: int, far: int, costs: list[float]) -> float:
        gain = costs[near] - costs[far]
        if gain <= 1e-12:
            return -math.inf
        if gain > 60:
            return math.inf
        return near - (far - near) / (2.0**gain - 1.0)

    def add(self, j: int, costs: list[float]) -> None:
        while self.stack:
            until = self._takes_over(j, self.stack[-1][0], costs)
            if len(self.stack) > 1 and until < self.stack[-1][1]:
                self.stack.pop()  # beaten by the one below before this one would be
                continue
            self.stack.append((j, until))
            return
        self.stack.append((j, -math.inf))

    def best(self, i: int, costs: list[float]) -> tuple[float, int]:
        while len(self.stack) > 1 and i <= self.stack[-1][1]:
            self.stack.pop()
        j = self.stack[-1][0]
        return costs[j] + math.log2((j - i) // self.p), j


def suffix_bits(value: str, ranks: dict[str, int]) -> tuple[list[float], list[tuple[str, int]]]:
    """log2 of the guesses for each suffix of ``value``, and the kind and end of the first segment of its cheapest segmentation.

    Each segment adds SEGMENT_BITS. Kinds: word; date; repeat (a unit of any length two or more times, of one
    character three or more: the unit's cost plus log2 of the times); walk (three keys or more: the first key,
    then TURN_BITS per step); brute (each character's class).
    """
    n = len(value)
    best: list[float] = [0.0] * (n + 1)
    ahead: list[tuple[str, int]] = [("", n)] * (n + 1)
    sums = [0.0]
    for c in value:
        sums.append(sums[-1] + char_bits(c))
    low = "".join(x if len(x := c.lower()) == 1 else "\0" for c in value)
    leet, begin = low.translate(LEET), _prefixes(ranks)
    begins: dict[int, list[tuple[int, int, int]]] = {}
    for p, s, e in repeats(value):
        least = 3 if p == 1 else 2
        if e - s >= least * p:
            begins.setdefault(e - least * p, []).append((p, s, least))
    active: list[tuple[int, int, int, dict[int, _Farther]]] = []
    units: dict[str, float] = {}
    open_brute, brute_to = math.inf, n
    walk_open, walk_to, walk = math.inf, n, 0
    for i in range(n - 1, -1, -1):
        if best[i + 1] + sums[i + 1] < open_brute - 1e-9:
            open_brute, brute_to = best[i + 1] + sums[i + 1], i + 1
        cost, to = open_brute - sums[i] + SEGMENT_BITS, ("brute", brute_to)
        j, by_low, by_leet = i, True, True
        while j < n and (by_low or by_leet):
            j += 1
            by_low, by_leet = by_low and low[i:j] in begin, by_leet and leet[i:j] in begin
            if j - i >= 3 and (by_low or by_leet) and (bits := word_bits(value[i:j], ranks)) is not None and bits + SEGMENT_BITS + best[j] < cost - 1e-9:
                cost, to = bits + SEGMENT_BITS + best[j], ("word", j)
        if value[i].isdigit():
            for j in range(i + 4, min(n, i + 10) + 1):
                if (bits := date_bits(value[i:j])) is not None and bits + SEGMENT_BITS + best[j] < cost - 1e-9:
                    cost, to = bits + SEGMENT_BITS + best[j], ("date", j)
        walk = walk + 1 if i + 1 < n and walk_step(value[i], value[i + 1]) else 0
        if not walk:
            walk_open = math.inf
        elif walk >= 2:
            if best[i + 3] + TURN_BITS * (i + 3) < walk_open - 1e-9:
                walk_open, walk_to = best[i + 3] + TURN_BITS * (i + 3), i + 3
            if (bits := walk_open + WALK_BITS - TURN_BITS * (i + 1) + SEGMENT_BITS) < cost - 1e-9:
                cost, to = bits, ("walk", walk_to)
        if i in begins:
            active += [(p, s, least, {}) for p, s, least in begins[i]]
        if active:
            active = [r for r in active if i >= r[1]]
            for p, _, least, ends in active:
                far = ends.get(i % p) or ends.setdefault(i % p, _Farther(p))
                far.add(i + least * p, best)
                bits, j = far.best(i, best)
                unit = value[i : i + p] if p <= OWN_SEGMENTS else ""
                if p > OWN_SEGMENTS or p == 1:
                    bits += sums[i + p] - sums[i] + 2 * SEGMENT_BITS
                else:
                    if unit not in units:
                        units[unit] = guess_bits(unit, ranks)[0]
                    bits += units[unit] + SEGMENT_BITS
                if bits < cost - 1e-9:
                    cost, to = bits, ("repeat", j)
        best[i], ahead[i] = cost, to
    return best, ahead


def guess_bits(value: str, ranks: dict[str, int]) -> tuple[float, list[tuple[str, int, int]]]:
    """log2 of the guesses for ``value``, and its cheapest segmentation as (kind, start, end)."""
    best, ahead = suffix_bits(value, ranks)
    parts, i = [], 0
    while i < len(value):
        kind, j = ahead[i]
        parts.append((kind, i, j))
        i = j
    return best[0], parts


def spans(text: str | None, ranks: dict[str, int], least_bits: float = LEAST_BITS) -> tuple[list[tuple[int, int, int]], float]:
    """(start, kind's place in KINDS, end) in order, and the largest guess cost of a context value."""
    if not text:
        return [], 0.0
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end() - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    most, first, end, run_end, costs = 0.0, 0, 0, -1, []
    for m in _CONTEXT.finditer(text):
        at = m.end()
        if at >= run_end:  # a new run of visible characters; the table covers all values that begin in it
            if not (found := _VALUE.match(text, at)):
                continue
            first, run_end, costs = at, found.end(), []
            end = at + len(found[0].rstrip("\"'.,;:)]}>"))
        if end - at >= MIN_VALUE and not (end - at <= LONGEST_CREDENTIAL and _WORD_ITSELF(text[at:end])):
            costs = costs or suffix_bits(text[first:end], ranks)[0]
            bits = costs[at - first]
            most = max(most, bits)
            if bits >= least_bits:
                out.append((at, 3, end))
    out.sort()
    return out, most


def joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_bits: float = LEAST_BITS, words: str | None = None) -> DataFrame:
    """Per row: id, n_assign, n_access, n_hex, base_sha256, spans, n_guess, max_guess_bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = word_ranks(words)
        for batch in batches:
            found = [spans(x, ranks, least_bits) for x in batch.column(1).to_pylist()]
            counts = [[sum(s[1] == k for s in f) for f, _ in found] for k in range(4)]
            base = [hashlib.sha256(joined([s for s in f if s[1] < 3]).encode()).hexdigest() for f, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts[:3]), pa.array(base, pa.string()), pa.array([joined(f) for f, _ in found], pa.string()), pa.array(counts[3], pa.int64()), pa.array([m for _, m in found], pa.float64())],
                ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess", "max_guess_bits"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(run, f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long, max_guess_bits double")
        .withColumnRenamed("id", id_col)
    )
