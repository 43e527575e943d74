"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of 2 * STRIDE words, one every STRIDE words, of every whole document; words
are lower-cased (A-Z) runs of letters and digits. The terms of the index are those of the benchmark
items, since only they add to a cosine with an item.

1. Document frequencies of the terms, over all passages (sums per task, then per term).
2. Randomised SVD of the passages' TF-IDF matrix A: with a random D x RANK matrix W, each task adds
   up A'(AW) over its passages, the sums meet per slice of terms, and the small D x RANK result
   gives an orthonormal basis and, by Nystrom's formula, the singular directions V in it.
3. Every passage's latent vector A V is compared with every item's; pairs with a cosine of at least
   ``least_cosine`` are candidates. A candidate holds if, in the passage widened by the item's length
   on either side, the longest common subsequence of words covers ``alone`` of the item, or
   ``answered`` of it while the item's answer (the words of its last sentence, all of them unless
   ``answer_words`` says how many of the last ones) is itself a subsequence of that part. Word order and most words must thus agree, but words may be
   put in, left out or replaced.

All terms that stand in some passage take part in candidate search, by the smoothed IDF
1 + log((n + 1) / (df + 1)): an altered item's kept words count even where they are in most passages,
and words of no passage, which can't add to a cosine, take nothing from it. Of each part of the texts, terms in more than
COMMON of the passages are multiplied as dense columns, the others as dense blocks of some passages (ROWS at most, with about ENTRIES
entries) by the terms in them. Items are searched in blocks
of about BLOCK_BYTES of text, and their vectors are kept as entries, not as a matrix: what goes to the tasks is a
few times BLOCK_BYTES and the basis (RANK numbers a term). Counts of terms by item
leave out pairs early; a block of more than PLACES terms by items, or an item of more than LONGEST_BOUNDED words,
goes without, with the same results.

Extra columns are ignored, whatever their names. Null or empty texts have no passages; items without words match nothing; a document shorter than a
passage is one passage. Repeated documents are all reported. Results: a row per (document, item).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released
from .words import PUNCTUATION, text_parts, word_hashes

STRIDE = 32
RANK = 128
COMMON = 0.01
ROWS, ENTRIES = 128, 512
SLICE = 256
BLOCK_BYTES = 4 << 20
PLACES = 1 << 24
LONGEST_BOUNDED = 256
LEAST_COSINE = 0.3


class Terms:
    """Places of hashed words in a sorted vocabulary, by a table over the words' last bits."""

    def __init__(self, vocabulary: np.ndarray):
        self.vocabulary = vocabulary
        self.mask = np.uint64((1 << min(22, max(16, (16 * len(vocabulary)).bit_length()))) - 1)
        last = (vocabulary & self.mask).astype(np.int64)
        self.place = np.argsort(last, kind="stable")
        self.words, last = vocabulary[self.place], last[self.place]
        self.more = np.append(last[1:] == last[:-1], False)  # the next word has the same last bits
        some, first = np.unique(last, return_index=True)
        self.first = np.full(int(self.mask) + 1, -1, np.int32)
        self.first[some] = first

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the words that are terms, and the terms' places."""
        k = self.first[(words & self.mask).astype(np.int64)]
        at = np.flatnonzero(k >= 0)
        k, words = k[at], words[at]
        left = np.flatnonzero(self.words[k] != words)
        while len(left := left[self.more[k[left]]]):
            k[left] += 1
            left = left[self.words[k[left]] != words[left]]
        same = self.words[k] == words
        return at[same], self.place[k[same]]


class Passages:
    """The term counts of the passages of some rows, and where each passage is.

    A row has slots of STRIDE words, one more than it has passages: passage k takes slots k and k + 1. Terms that these rows
    use in more than COMMON of the passages (``often``) are counted in a column each, the others as passage, term and count.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, terms: Terms):
        per_row = np.where(counts > 0, np.maximum(1, -(-counts // STRIDE) - 1), 0)
        first = np.cumsum(per_row) - per_row
        self.n = int(per_row.sum())
        self.row = np.repeat(np.arange(len(counts)), per_row)
        self.slot = np.arange(self.n) - np.repeat(first, per_row)
        self.at, self.place = terms.find(words)  # all words that are terms, in order
        self.first_slot = first + np.cumsum(counts > 0) - (counts > 0)
        self.last_slot = self.first_slot + per_row
        self.begin = self.first_slot[self.row] + self.slot  # first slot of each passage
        self.slots = self.n + int((counts > 0).sum())
        start = np.cumsum(counts) - counts
        row = np.repeat(np.arange(len(counts)), counts)[self.at]
        slot = self.first_slot[row] + (self.at - start[row]) // STRIDE
        self.d = len(terms.vocabulary)
        self.often = np.flatnonzero(np.bincount(self.place, minlength=self.d) > COMMON * self.n)
        column = np.full(self.d, -1)
        column[self.often] = np.arange(len(self.often))
        column = column[self.place]
        many = column >= 0
        self.by_slot = np.zeros((self.slots, len(self.often)), np.uint8)
        np.add.at(self.by_slot.reshape(-1), slot[many] * len(self.often) + column[many], np.uint8(1))
        self.dense = self.by_slot[self.begin] + self.by_slot[self.begin + 1]
        few = np.flatnonzero(~many)
        self.few_slot, self.few_term, row = slot[few], self.place[few], row[few]
        passage = self.few_slot - (self.first_slot - first)[row]
        inside = self.few_slot < self.last_slot[row]
        before = self.few_slot > self.first_slot[row]
        key = np.concatenate([passage[inside] * self.d + self.few_term[inside], (passage[before] - 1) * self.d + self.few_term[before]])
        key, self.count = np.unique(key, return_counts=True)
        self.passage, self.term = key // self.d, key % self.d
        self._matrix: tuple[np.ndarray, list[tuple[int, int, np.ndarray, np.ndarray]]] | None = None

    def with_term(self) -> np.ndarray:
        """Number of passages with each term."""
        out = np.bincount(self.term, minlength=self.d)
        out[self.often] += np.count_nonzero(self.dense, axis=0)
        return out

    def matrix(self) -> tuple[np.ndarray, list[tuple[int, int, np.ndarray, np.ndarray]]]:
        """The passages' damped term counts 1 + log(count): columns of the terms ``often``; of the others, for each few passages (from, to) the terms in them and these terms' columns."""
        if self._matrix is None:
            damped = np.append(0, 1 + np.log(np.arange(1, 2 * STRIDE + 1))).astype(np.float32)
            dense = np.zeros(self.dense.size, np.float32)
            some = np.flatnonzero(self.dense.ravel() != 0)
            dense[some] = damped[self.dense.ravel()[some]]
            blocks, value = [], damped[self.count]
            step = min(ROWS, max(1, ENTRIES * self.n // max(1, len(value))))
            cuts = np.searchsorted(self.passage, np.arange(0, self.n + step, step)).tolist()
            for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
                if lo < hi:
                    own, column = np.unique(self.term[lo:hi], return_inverse=True)
                    block = np.zeros((min(step, self.n - k * step), len(own)), np.float32)
                    block[self.passage[lo:hi] - k * step, column] = value[lo:hi]
                    blocks.append((k * step, k * step + len(block), own, block))
            self._matrix = dense.reshape(self.dense.shape), blocks
        return self._matrix

    def product(self, matrix: np.ndarray) -> np.ndarray:
        """Damped term counts @ matrix."""
        dense, blocks = self.matrix()
        out = dense @ matrix[self.often]
        for lo, hi, own, block in blocks:
            out[lo:hi] += block @ matrix[own]
        return out

    def add_transposed(self, y: np.ndarray, total: np.ndarray) -> None:
        """Adds transposed damped term counts @ y to ``total``."""
        dense, blocks = self.matrix()
        total[self.often] += dense.T @ y
        for lo, hi, own, block in blocks:
            total[own] += block.T @ y[lo:hi]

    def with_terms(self) -> np.ndarray:
        """Passages with a term."""
        some = self.dense.any(axis=1)
        some[self.passage] = True
        return np.flatnonzero(some)

    def times(self, weights: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Passages with a term, and their rows of A @ matrix, A being the TF-IDF matrix."""
        own = self.with_terms()
        return own, self.product(weights[:, None] * matrix)[own]

    def shared(self, items: Items, own: np.ndarray, least: np.ndarray) -> np.ndarray:
        """By passage of ``own`` and item, whether at least ``least`` of the item's words may stand in the passage widened by the item's length; items come in order of length."""
        out = np.zeros((len(own), len(items.words)), bool)
        begin, row = self.begin[own], self.row[own]
        first, last = self.first_slot[row], self.last_slot[row]
        column = np.full(self.d, -1)
        column[self.often] = np.arange(len(self.often))
        column = column[items.entry_term]
        many = column >= 0
        places = np.zeros((len(self.often), len(items.words)), np.float32)
        places[column[many], items.entry_item[many]] = items.entry_count[many]
        few = self._few_shared(items)
        near, reached = self.by_slot[begin], -1
        reaches, starts = np.unique(items.reach, return_index=True)
        for reach, a, b in zip(reaches.tolist(), starts, np.append(starts[1:], len(items.reach))):
            for k in range(reached + 1, reach + 1):  # slots on either side
                np.maximum(near, self.by_slot[np.maximum(begin - k, first)], out=near)
                np.maximum(near, self.by_slot[np.minimum(begin + 1 + k, last)], out=near)
            reached = reach
            n = (near != 0).astype(np.float32) @ places[:, a:b]
            n += few[np.minimum(begin + 1 + reach, last) + 1, a:b] - few[np.maximum(begin - reach, first), a:b]
            out[:, a:b] = n >= least[a:b]
        return out

    def _few_shared(self, items: Items) -> np.ndarray:
        """By slot and item, how many of the item's words are none of the terms ``often`` and stand in the slots before, counted once a slot."""
        out = np.zeros((self.slots + 1, len(items.words)), np.int32)
        flat = out.reshape(-1)
        key = np.unique(self.few_slot * self.d + self.few_term)
        slot, term = key // self.d, key % self.d
        n = np.diff(items.entries_of)[term]
        to = np.cumsum(n)
        cuts = np.searchsorted(to, np.arange(1 << 20, n.sum() + (1 << 20), 1 << 20)) + 1
        lo = 0
        for hi in np.minimum(cuts, len(n)).tolist():
            part = n[lo:hi]
            at = np.arange(part.sum()) + np.repeat(items.entries_of[term[lo:hi]] - (np.cumsum(part) - part), part)
            np.add.at(flat, np.repeat((slot[lo:hi] + 1) * len(items.words), part) + items.entry_item[at], items.entry_count[at])
            lo = hi
        return np.cumsum(out, axis=0, dtype=np.int32, out=out)


def parts(column: pa.Array, terms: Terms) -> Iterator[tuple[int, np.ndarray, np.ndarray, Passages]]:
    for a, _, raw, offs in text_parts(column, 1 << 19):
        words, counts = word_hashes(raw, offs, lower=True, separators=PUNCTUATION)
        yield a, words, counts, Passages(words, counts, terms)


class Items:
    """A block of benchmark items: hashed words, vocabulary, answers."""

    def __init__(self, rows: list[tuple[int, str]], answer_words: int | None = None):
        self.ids = [i for i, _ in rows]
        texts = [t or "" for _, t in rows]
        self.words = self._words(texts)
        last = [t.rstrip(" \n.!?").replace("\n", " ") for t in texts]
        self.answers = [w[-answer_words:] if answer_words else w for w in self._words([max(x.rpartition(". ")[2], x.rpartition("? ")[2], key=lambda y: -len(y)) for x in last])]
        self.vocabulary = np.unique(np.concatenate(self.words)) if rows else np.zeros(0, np.uint64)
        self.terms = [np.searchsorted(self.vocabulary, w) for w in self.words]
        self.reach = np.array([-(-len(w) // STRIDE) for w in self.words], np.int64)
        # counts of terms by item, in order of term; those of term t are from entries_of[t] to entries_of[t + 1]
        item, term, count = self.counts()
        order = np.argsort(term, kind="stable")
        self.entry_term, self.entry_item, self.entry_count = term[order], item[order], count[order].astype(np.int32)
        self.entries_of = np.searchsorted(self.entry_term, np.arange(len(self.vocabulary) + 1))
        self.masks = [bit_places(t) for t in self.terms]
        self.answer_masks = [bit_places(np.searchsorted(self.vocabulary, a)) for a in self.answers]

    @staticmethod
    def _words(texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for _, _, raw, offs in text_parts(pa.array(texts, pa.string())):
            h, counts = word_hashes(raw, offs, lower=True, separators=PUNCTUATION)
            out += np.split(h, np.cumsum(counts)[:-1])
        return out

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, term and count of each term of an item, in order of item and term."""
        found = [np.unique(t, return_counts=True) for t in self.terms]
        item = np.repeat(np.arange(len(found)), [len(t) for t, _ in found])
        term = np.concatenate([t for t, _ in found]) if found else np.zeros(0, np.int64)
        count = np.concatenate([c for _, c in found]) if found else np.zeros(0, np.int64)
        return item, term, count

    def vectors(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, term and value of each entry of the items' TF-IDF matrix, in order of item and term."""
        item, term, count = self.counts()
        return item, term, (weights[term] * (1 + np.log(np.maximum(count, 1)))).astype(np.float32)

    def times(self, weights: np.ndarray, matrix: np.ndarray) -> np.ndarray:
        """The items' TF-IDF matrix times ``matrix``."""
        item, term, value = self.vectors(weights)
        out = np.zeros((len(self.words), matrix.shape[1]), np.float32)
        if len(item):
            begin = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
            for lo, hi in zip(begin, np.append(begin[1:], len(item))):
                out[item[lo]] = value[lo:hi] @ matrix[term[lo:hi]]
        return out


def bit_places(a: np.ndarray) -> tuple[int, dict[int, int]]:
    """Length of a sequence, and for each value a number with a bit for each of its places."""
    places: dict[int, int] = {}
    for k, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << k
    return len(a), places


def lcs(a: tuple[int, dict[int, int]], b: list[int]) -> int:
    """Length of the longest common subsequence of a sequence, given as its bit_places, and another: a bit per element of the first."""
    n, places = a
    whole = s = (1 << n) - 1
    for x in b:
        if m := places.get(x):
            u = s & m
            s = (s + u | s - u) & whole
    return n - s.bit_count()


def frequencies(docs: DataFrame, vocabulary: np.ndarray, text_col: str) -> tuple[int, np.ndarray]:
    """Number of passages, and of passages with each term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, n, total = Terms(vocabulary), 0, np.zeros(len(vocabulary), np.int64)
        for batch in released(batches):
            for _, _, _, p in parts(batch.column(0), terms):
                n += p.n
                total += p.with_term()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(total[some], n))], ["term", "n"])

    sums = docs.select(text_col).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    n, out = 0, np.zeros(len(vocabulary), np.int64)
    for r in sums:
        if r["term"] < 0:
            n = r["n"]
        else:
            out[r["term"]] = r["n"]
    return n, out


def term_weights(n: int, df: np.ndarray) -> np.ndarray:
    return np.where(df > 0, 1 + np.log((n + 1) / (df + 1)), 0).astype(np.float32)


def latent_basis(docs: DataFrame, items: Items, weights: np.ndarray, text_col: str, rank: int = RANK, seed: int = 5) -> np.ndarray:
    """V (D x rank): approximate right singular vectors of the passages' TF-IDF matrix, items included as rows."""
    d = len(items.vocabulary)
    rank = min(rank, d)
    draw = np.random.default_rng(seed).standard_normal((d, rank)).astype(np.float32)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weighted, total = Terms(items.vocabulary), weights[:, None] * draw, np.zeros((d, rank), np.float32)
        for batch in released(batches):
            for _, _, _, p in parts(batch.column(0), terms):
                p.add_transposed(p.product(weighted), total)
        total *= weights[:, None]
        for k in range(0, d, SLICE):
            if (piece := total[k : k + SLICE]).any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([piece.tobytes()], pa.binary())], ["at", "sums"])

    def added(table: pa.Table) -> pa.Table:
        pieces = [np.frombuffer(x, np.float32) for x in table.column("sums").to_pylist()]
        return pa.table({"at": table.column("at")[:1], "sums": pa.array([np.sum(pieces, axis=0, dtype=np.float64).astype(np.float32).tobytes()], pa.binary())})

    slices = docs.select(text_col).mapInArrow(project, "at long, sums binary").groupBy("at").applyInArrow(added, "at long, sums binary").collect()
    item, term, value = items.vectors(weights)
    y, b = items.times(weights, draw), np.zeros((d, rank))
    order = np.argsort(term, kind="stable")
    for k in range(0, len(order), 1 << 14):
        part = order[k : k + (1 << 14)]
        np.add.at(b, term[part], (y[item[part]] * value[part, None]).astype(np.float64))
    for r in slices:
        b[r["at"] : r["at"] + SLICE] += np.frombuffer(r["sums"], np.float32).reshape(-1, rank)
    q, _ = np.linalg.qr(b)
    qb = q.T @ b
    small = qb @ np.linalg.pinv(draw.T.astype(np.float64) @ b) @ qb.T
    _, u = np.linalg.eigh((small + small.T) / 2)
    return (q @ u[:, ::-1]).astype(np.float32)


def _search(docs: DataFrame, rows: list[tuple[int, str]], id_col: str, text_col: str, alone: float, answered: float, least_cosine: float, answer_words: int | None) -> DataFrame:
    items = Items(rows, answer_words)
    n, df = frequencies(docs, items.vocabulary, text_col)
    weights = term_weights(n, df)
    basis = latent_basis(docs, items, weights, text_col)
    targets = items.times(weights, basis)
    norms = np.linalg.norm(targets, axis=1)
    targets = (targets / np.where(norms > 0, norms, 1)[:, None]).T.copy()
    bounded = max(map(len, items.words)) <= LONGEST_BOUNDED and len(items.vocabulary) * len(items.words) <= PLACES
    least = np.array([answered * len(w) for w in items.words], np.float32) - 0.001
    sent = docs.sparkSession.sparkContext.broadcast((items, weights[:, None] * basis, targets, bounded, least))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weighted, targets, bounded, least = sent.value
        terms, lengths = Terms(items.vocabulary), np.array([len(w) for w in items.words])
        for batch in released(batches):
            doc_ids, out = batch.column(0), []
            for a, words, counts, p in parts(batch.column(1), terms):
                own = p.with_terms()
                z = p.product(weighted)[own]
                size = np.linalg.norm(z, axis=1)
                cosine = (z @ targets) / np.where(size > 0, size, 1)[:, None]
                likely = cosine >= least_cosine
                if bounded:  # pairs without enough words in common are left out at once
                    some = np.flatnonzero(likely.any(axis=1))
                    likely[some] &= p.shared(items, own[some], least)
                start = np.cumsum(counts) - counts
                best: dict[tuple[int, int], tuple] = {}
                present = np.zeros(len(items.vocabulary), bool)
                ks, ofs = np.nonzero(likely)
                rows, slots = p.row[own[ks]], p.slot[own[ks]]
                # the words from lo to hi; those that aren't terms match nothing in an item
                lo = start[rows] + np.maximum(0, slots * STRIDE - lengths[ofs])
                hi = start[rows] + np.minimum(counts[rows], (slots + 2) * STRIDE + lengths[ofs])
                lo, hi = np.searchsorted(p.at, lo), np.searchsorted(p.at, hi)
                for k, i, row, slot, lo, hi in zip(*(x.tolist() for x in (ks, ofs, rows, slots, lo, hi))):
                    n, part = len(items.words[i]), p.place[lo:hi]
                    present[part] = True
                    most = np.count_nonzero(present[items.terms[i]])  # no subsequence is longer
                    present[part] = False
                    if most < answered * n:
                        continue
                    said_here = part.tolist()
                    share = lcs(items.masks[i], said_here) / n
                    if share < answered:
                        continue
                    said = items.answer_masks[i][0] > 0 and lcs(items.answer_masks[i], said_here) == items.answer_masks[i][0]
                    if share >= alone or said:
                        key = (row, i)
                        best[key] = max(best.get(key, (-1.0,)), (share, float(cosine[k, i]), said, slot * STRIDE))
                out += [(doc_ids[a + row].as_py(), items.ids[i], *x) for (row, i), x in sorted(best.items())]
            cols = list(zip(*out)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.float64()), pa.array(cols[4], pa.bool_()), pa.array(cols[5], pa.int64())],
                ["doc_id", "item_id", "lcs_share", "cosine", "answer_found", "first_word"],
            )

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(search, "doc_id long, item_id long, lcs_share double, cosine double, answer_found boolean, first_word long")


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", alone: float = 0.8, answered: float = 0.6, least_cosine: float = LEAST_COSINE, answer_words: int | None = None) -> DataFrame:
    """doc_id, item_id, lcs_share, cosine, answer_found, first_word: the items found in each document."""
    spark = docs.sparkSession
    items = benchmark.filter("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    found = None
    for k in range(blocks):
        rows = [tuple(r) for r in items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()]
        rows = [r for r, w in sorted(zip(rows, Items(rows).words), key=lambda x: len(x[1])) if len(w)]
        if rows:
            part = _search(docs, rows, id_col, text_col, alone, answered, least_cosine, answer_words)
            found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "doc_id long, item_id long, lcs_share double, cosine double, answer_found boolean, first_word long")
    return found
