"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs them, a classifier decides.

Base spans, by fixed forms, in code points with an exclusive end, leftmost and non-overlapping per
kind: ``email``, ``ip`` (four numbers up to 255), ``card`` (16 to 19 digits that pass Luhn) and
``phone`` (+, 8 to 15 digits). They always stay. The method adds spans of the same kinds in other
forms: addresses with "(at)" or "at ... dot", IPv6, cards of 13 to 19 digits that pass Luhn whatever
parts them, and numbers of 7 to 15 digits that may be phones.

1. One pass over the texts finds base and other candidates, lets the labelers of ``LABELERS`` vote on
   each (1 for, -1 against, 0 none): regular forms, gazetteers (domain endings, card issuers,
   calling codes, reserved networks) and contexts (words before, characters around, spans near by).
   What is kept of a document is its id and candidates.
2. The distinct vote patterns of all candidates are counted; a kind has at most 3 ** labelers of them.
   EM over these counts estimates, per kind, how often there is personal data and how each labeler
   votes on it and on the rest (Dawid and Skene's model). Counts of PRIOR imagined candidates
   keep labelers that hardly vote near the rates that they begin with.
3. The posteriors are the soft labels of a logistic regression over votes, shapes and the words
   before. It is fitted on at most SAMPLE candidates, those with the smallest hash, and applied to
   all. A candidate that isn't a base span is added at a score of THRESHOLD or more; of added
   ones that overlap the highest score stays, the first of equal ones.

Nulls and repeats: a null text is empty and has no spans; every row gives a row, repeated ids and
rows too. Texts are taken whole at any length, in linear time. Extra columns are ignored, whatever
their names. Without candidates nothing is fitted. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable

KINDS = ["email", "ip", "card", "phone"]
EMAIL, IP, CARD, PHONE = range(4)
LABELERS = ["form", "check", "gazetteer", "words", "edges", "near", "texture"]
SAMPLE = 20_000
PRIOR = 60.0
THRESHOLD = 0.5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT = re.compile(r"[\x20\t]?[\[({<][\x20\t]?(?:at|@)[\x20\t]?[\])}>][\x20\t]?|\x20at\x20(?=[a-z0-9-]++\x20dot\x20)", re.IGNORECASE | re.ASCII)
_SPELLED = re.compile(r"[a-z0-9-]++(?:(?:[\x20\t]?[\[({<][\x20\t]?(?:dot|\.)[\x20\t]?[\])}>][\x20\t]?|\x20dot\x20|\.)[a-z0-9-]++)++", re.IGNORECASE | re.ASCII)
_V6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:{1,2}){2,7}[0-9A-Fa-f]{1,4}(?![\w:])")
_NUMBER = re.compile(r"\(?[0-9]++\)?(?:[\x20./-]?\(?[0-9]++\)?)*+")
_WORD = re.compile(r"[^\W\d_]+")

# Domain endings, providers, issuers' first digits with lengths, calling codes, and words before personal data or before other numbers.
ENDINGS = frozenset("com net org edu gov mil int info biz name io co ai app dev me tv uk us ca au nz ie de at ch fr be nl lu es pt it gr pl cz sk hu ro bg se no dk fi ru ua tr il in pk cn jp kr sg hk tw th vn id ph br mx ar cl pe za ng ke eg ae sa eu".split())
ISSUERS = {15: ("34", "37"), 13: ("4",), 14: ("30", "36", "38", "39"), 16: ("4", "51", "52", "53", "54", "55", "22", "23", "24", "25", "26", "27", "6011", "65", "35"), 19: ("4", "62", "6011")}
CODES = ("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98 "
         "212 213 216 218 234 254 351 352 353 354 358 359 370 371 372 380 385 386 420 421 852 880 886 961 962 965 966 971 972 974").split()  # fmt: skip
CONTEXT = {
    EMAIL: frozenset("mail email mailto contact write correo courriel kontakt contacto adresse address reach".split()),
    IP: frozenset("ip ips ipv address host server client login logged adresse from visitor".split()),
    CARD: frozenset("card cards visa mastercard amex credit debit karte kreditkarte carte tarjeta payment paid zahlung".split()),
    PHONE: frozenset("tel phone phones call mobile cell fax telefon telephone téléphone teléfono portable móvil handy whatsapp sms ring text reach dial".split()),
}
OTHERWISE = frozenset("order invoice version versions isbn issn id ref reference page pages serial model sku ticket build release bestellung rechnung facture pedido commit item part year years number lines section".split())
_FAKE = frozenset("0123456789012345678 1234567890123456789 9876543210987654321".split())


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _begin(text: str, at: int, least: int) -> int:
    """Where the run of an address's local part that ends at ``at`` begins, not before ``least``."""
    while at > least and text[at - 1] in _LOCAL:
        at -= 1
    return at


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in order."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        # an address's parts hold no other "@", so each "@" is looked at once
        start = _begin(text, at, done)
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((EMAIL, start, done := m.end()))
        at = text.find("@", at + 1)
    # runs of digits are taken whole: no part of one can match where the whole does not
    out += [(IP, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
    out += [(CARD, m.start(), m.end()) for m in _CARD.finditer(text) if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    out += [(PHONE, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def _version6(s: str) -> bool:
    try:
        return ipaddress.ip_address(s).version == 6
    except ValueError:
        return False


def other_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates in other forms that touch no base span, (kind, start, end) in order."""
    out, done = [], 0
    for m in _AT.finditer(text):
        start = _begin(text, m.start(), done)
        if start < m.start() and (d := _SPELLED.match(text, m.end())):
            out.append((EMAIL, start, done := d.end()))
    if ":" in text:
        out += [(IP, m.start(), m.end()) for m in _V6.finditer(text) if _version6(m[0])]
    for m in _NUMBER.finditer(text):
        if m.end() - m.start() < 7:
            continue
        digits = _digits(m[0])
        edge = text[m.start() - 1 : m.start()] + text[m.end() : m.end() + 1]
        if 7 <= len(digits) <= 19 and not any(c.isalnum() or c == "_" for c in edge):
            if 13 <= len(digits) and luhn(digits):
                out.append((CARD, m.start(), m.end()))
            if len(digits) <= 15:
                out.append((PHONE, m.start(), m.end()))
    taken = sorted((a, b) for _, a, b in base)
    starts = np.array([a for a, _ in taken])
    reach = np.maximum.accumulate([b for _, b in taken]) if taken else starts
    free = []
    for kind, a, b in out:
        k = int(np.searchsorted(starts, b)) if taken else 0
        if not k or reach[k - 1] <= a:
            free.append((kind, a, b))
    return sorted(free)


def _words_before(text: str, a: int) -> list[str]:
    return _WORD.findall(text[max(0, a - 40) : a].lower())[-4:]


def _form(kind: int, s: str, digits: str) -> int:
    if kind == EMAIL:
        local, _, domain = s.partition("@")
        return 0 if not domain else 1 if local[0] not in ".-%" and local[-1] != "." and ".." not in local and domain.rpartition(".")[2].isalpha() else -1
    if kind == IP:
        return 1 if ":" in s or all(p == "0" or p[0] != "0" for p in s.split(".")) else -1
    groups = [len(x) for x in re.split("[^0-9]+", s) if x]
    if kind == CARD:
        return 1 if groups in ([len(digits)], [4, 4, 4, 4], [4, 6, 5], [4, 4, 4, 4, 3]) else -1
    return 1 if s[0] == "+" or digits[:2] == "00" else -1 if len(groups) == 1 or re.fullmatch(r"(?:19|20)\d\d[./-]\d\d?[./-]\d\d?|\d\d?[./-]\d\d?[./-](?:19|20)\d\d", s) else 0


def _check(kind: int, s: str, digits: str) -> int:
    if kind == EMAIL:
        return 1 if 6 <= len(s) <= 80 else -1
    if kind == IP:
        return 0 if ":" in s else 1 if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in s.split(".")) else -1
    return (1 if luhn(digits) else -1) if kind == CARD else 1 if 9 <= len(digits) <= 13 else 0


def _gazetteer(kind: int, s: str, digits: str) -> int:
    if kind == EMAIL:
        return 1 if re.split(r"[^A-Za-z0-9-]+", s)[-1].lower() in ENDINGS else -1
    if kind == IP:
        try:
            return 1 if ipaddress.ip_address(s).is_global else -1
        except ValueError:
            return -1
    if kind == CARD:
        return 1 if digits.startswith(ISSUERS.get(len(digits), ("~",))) else -1
    code = digits if s[0] == "+" else digits[2:] if digits[:2] == "00" else ""
    return 0 if not code else 1 if code.startswith(tuple(CODES)) else -1


def votes(text: str, span: tuple[int, int, int], near: bool) -> tuple[int, ...]:
    """The labelers' votes, in their order."""
    kind, a, b = span
    s = text[a:b]
    digits = _digits(s)
    before = set(_words_before(text, a))
    words = 1 if before & CONTEXT[kind] else -1 if before & OTHERWISE else 0
    edge = text[a - 1 : a] if a else "", text[b : b + 1]
    edges = -1 if any(c and (c.isalnum() or c in "_/=#%$€£") for c in edge) else 1
    texture = 0 if kind in (EMAIL, IP) else -1 if len(set(digits)) <= 2 or any(digits in x for x in _FAKE) else 1
    return _form(kind, s, digits), _check(kind, s, digits), _gazetteer(kind, s, digits), words, edges, int(near), texture


N_VOTES, N_SHAPES, N_WORDS = 2 * len(LABELERS), 64, 64
WIDTH = 1 + N_VOTES + 8 + N_SHAPES + N_WORDS


def features(text: str, span: tuple[int, int, int], given: tuple[int, ...]) -> list[int]:
    """Places of the ones in a candidate's feature vector: votes, length, shapes of three characters, words before. Each kind has its own part."""
    kind, a, b = span
    s = text[a : min(b, a + 64)]
    shape = "^" + re.sub(r"([a-z])\1+", r"\1", re.sub("[A-Z]", "u", re.sub("[a-z]", "l", re.sub("[0-9]", "d", s)))) + "$"
    out = {0, *(1 + 2 * k + (v < 0) for k, v in enumerate(given) if v), 1 + N_VOTES + min(7, (b - a) // 4)}
    out |= {1 + N_VOTES + 8 + zlib.crc32(shape[k : k + 3].encode()) % N_SHAPES for k in range(len(shape) - 2)}
    out |= {1 + N_VOTES + 8 + N_SHAPES + zlib.crc32(w.encode()) % N_WORDS for w in _words_before(text, a)}
    return sorted(kind * WIDTH + x for x in out)


def candidates(text: str | None) -> list[dict]:
    """All candidates of a text: kind, start, end, base, votes, features; base ones first, each in order of kind and start."""
    if not text:
        return []
    base = base_spans(text)
    spans = [(s, True) for s in base] + [(s, False) for s in other_spans(text, base)]
    mids = np.array(sorted((a + b) // 2 for _, a, b in base))
    out = []
    for span, is_base in spans:
        kind, a, b = span
        lo, hi = np.searchsorted(mids, [a - 80, b + 80])
        given = votes(text, span, bool(hi - lo > is_base))
        out.append({"kind": kind, "start": a, "end": b, "base": is_base, "votes": "".join("-0+"[v + 1] for v in given), "features": features(text, span, given)})
    return out


_SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("votes", pa.string()), ("features", pa.list_(pa.int32()))]))


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, and candidates as found in its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = pa.array((candidates(x.as_py()) for x in batch.column(1)), _SPANS)
            yield pa.RecordBatch.from_arrays([batch.column(0), spans], ["id", "candidates"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, candidates array<struct<kind int, start long, end long, base boolean, votes string, features array<int>>>"
    )


BEGIN = np.array([[0.45, 0.35, 0.2], [0.1, 0.35, 0.55]])  # of a labeler's -, 0, + on the rest, and on personal data


def reliabilities(patterns: list[tuple[str, int]], rounds: int = 100) -> tuple[float, np.ndarray, dict[str, float]]:
    """EM over counted vote patterns of one kind: the share of personal data, rates[labeler, class, vote], and each pattern's posterior."""
    codes = np.array([["-0+".index(c) for c in p] for p, _ in patterns])
    n = np.array([k for _, k in patterns], float)
    rates = np.tile(BEGIN, (codes.shape[1], 1, 1))
    share = 0.5
    for _ in range(rounds):
        with np.errstate(over="ignore"):
            odds = np.log(share / (1 - share)) + sum(np.log(rates[k, 1, codes[:, k]]) - np.log(rates[k, 0, codes[:, k]]) for k in range(codes.shape[1]))
            post = 1 / (1 + np.exp(-odds))
        weight = np.stack([n * (1 - post), n * post])
        share = float((weight[1].sum() + PRIOR / 2) / (n.sum() + PRIOR))
        new = np.stack([[np.bincount(codes[:, k], weight[c], 3) + PRIOR * BEGIN[c] for c in (0, 1)] for k in range(codes.shape[1])])
        new /= new.sum(2, keepdims=True)
        if np.abs(new - rates).max() < 1e-9:
            break
        rates = new
    return share, rates, dict(zip([p for p, _ in patterns], post.tolist()))


def fitted(rows: list[list[int]], target: np.ndarray, steps: int = 300, penalty: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by gradient steps scaled by each weight's past gradients."""
    weights, past = np.zeros(WIDTH * len(KINDS)), np.full(WIDTH * len(KINDS), 1e-8)
    if not rows:
        return weights
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    cols = np.concatenate([np.asarray(r) for r in rows])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.bincount(at, weights[cols], len(rows))))
        slope = np.bincount(cols, (p - target)[at], len(weights)) + penalty * weights
        past += slope**2
        weights -= 0.5 * slope / np.sqrt(past)
    return weights


def model(candidates_by_row: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Classifier weights from the ``found`` table: vote patterns of all candidates, features of ``sample`` of them at most."""
    each = candidates_by_row.select("id", F.inline("candidates"))
    # at most 3 ** labelers patterns a kind
    counts = sorted((r["kind"], r["votes"], r["count"]) for r in each.groupBy("kind", "votes").count().collect())
    posterior = {k: reliabilities([x[1:] for x in g])[2] for k, g in groupby(counts, lambda x: x[0])}
    # a cut of the hashes' range that some twice the sample pass, whatever the number of candidates, so that little more than the sample is sorted
    cut = int(-(1 << 63) + (1 << 64) * min(1.0, 2 * sample / max(1, sum(n for _, _, n in counts)))) - 1
    hashed = each.select(F.xxhash64("id", "kind", "start", "votes").alias("h"), "kind", "votes", "features").filter(F.col("h") <= min(cut, (1 << 63) - 1))
    few = hashed.orderBy("h", "kind", "votes", "features").limit(sample).toArrow()
    target = np.array([posterior[k][v] for k, v in zip(few["kind"].to_pylist(), few["votes"].to_pylist())])
    return fitted(few["features"].to_pylist(), target)


def decided(spans: list[dict], weights: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[int, int, int]]:
    """Base spans and added ones, (kind, start, end) in order."""
    scores = [(1 / (1 + np.exp(-weights[s["features"]].sum())), s) for s in spans if not s["base"]]
    kept: list[tuple[int, int, int]] = []
    for p, s in sorted(scores, key=lambda x: (-x[0], x[1]["start"], x[1]["kind"])):
        if p >= threshold and all(s["end"] <= a or b <= s["start"] for _, a, b in kept):
            kept.append((s["kind"], s["start"], s["end"]))
    return sorted([(s["kind"], s["start"], s["end"]) for s in spans if s["base"]] + kept)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """Per row: id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all), n_added."""
    rows = durable(found(docs, id_col, text_col), "candidates")
    weights = model(rows, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, base, spans, added = [], [], [], []
            for x in batch.column(1):
                given = x.as_py()
                fixed = [(s["kind"], s["start"], s["end"]) for s in given if s["base"]]
                every = decided(given, weights, threshold)
                counts.append([sum(s[0] == k for s in fixed) for k in range(len(KINDS))])
                base.append(hashlib.sha256(joined(sorted(fixed)).encode()).hexdigest())
                spans.append(joined(every))
                added.append(len(every) - len(fixed))
            columns = [batch.column(0), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS)))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(base, pa.string()), pa.array(spans, pa.string()), pa.array(added, pa.int64())], [id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"{id_col} {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long")
