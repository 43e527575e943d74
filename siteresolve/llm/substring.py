"""Substring dedup by difference-cover anchors.

A window is ``size`` consecutive words of one document; a word goes if a window that covers it
starts, with the same words, in a document with a smaller id. To find such windows without moving
all of them, anchors - hashes of ``size - PERIOD + 1`` words - are taken only at positions whose
remainder by PERIOD = 7 is in the difference cover {0, 1, 3}: any two positions i, j have a shift
s < 7 at which both i + s and j + s are cover positions, so equal windows share an aligned anchor.

1. Anchors go to their hash's partition, sorted by hash and id; a stream over each partition tells
   which stand in two documents. Those positions return to their documents as runs.
2. Each document extends its shared anchors to the windows that contain one, and only these
   windows' hashes move; in the same kind of stream every holder but the smallest id is told.
3. Each document cuts the words its told windows cover.

A document sends each hash once, with its first position; what comes back is first positions, and
the document finds the hash's other positions itself. So a line repeated a thousand times in one
document is one row. A hash that many documents hold is decided for most of them where they are
read: among a part's documents all but the smallest few know at once that another one holds it, and
their rows travel by document. So a hash's partition gets a few rows a part of about 1 MB, whatever
share of the documents holds it. No step groups a document's or hash's rows in memory: streams hold
one batch and one pending row per partition. Positions that come back are runs of a few bytes; texts and runs
meet in a shuffled join, whose large partitions Spark may split.

Null text has no words. Rows with a null id are neither sources nor changed. Rows with equal ids
are copies of one document id (their windows don't remove each other's). Words come back unchanged
and joined by one space. Anchors only propose windows and have 48 bits; windows of two documents are
equal when two hashes, of 64 and 32 bits, of their words' 64-bit hashes are (``words``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, partitions
from .words import mixed, second_hashes, text_parts, window_hashes, word_hashes

PERIOD = 7
COVER = (0, 1, 3)
_HITS = pa.schema([("doc", pa.int64()), ("alt", pa.int32()), ("at", pa.int32())])
# rows that meet others of their hash; a place below 0 is ~place of a row decided before
_ANCHORS = "h long, doc long, alt int, at int"
_WINDOWS = "h long, h2 int, doc long, alt int, at int"
_ANCHOR_BITS = 48


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, alt, text. alt tells rows of one id apart; it is 0 for all if no id repeats."""
    repeats = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count() > 0
    alt = F.hash(F.coalesce(F.col(text_col), F.lit(""))) if repeats else F.lit(0)
    return docs.select(F.col(id_col).cast("long").alias("doc"), alt.cast("int").alias("alt"), F.col(text_col).alias("text"))


def _shared(batches: Iterator[pa.RecordBatch], others_only: bool) -> Iterator[pa.RecordBatch]:
    """Rows (doc, alt, at) of hashes that occur in two documents, from rows sorted by hash, second hash (if they have one) and doc. others_only: without the smallest document's.

    Rows decided before come out as they are.

    A hash's first document is held back until a second one is seen; of that document's rows, those in earlier batches wait in ``pending``.
    """
    last_hash = last_doc = None
    known = False  # the last hash has been seen in two documents
    pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for batch in batches:
        h, *more, doc, alt, at = (c.to_numpy() for c in batch.columns)
        h2 = more[0] if more else np.zeros(len(h), np.int32)
        decided = at < 0
        if decided.any():
            yield pa.RecordBatch.from_arrays([pa.array(doc[decided]), pa.array(alt[decided]), pa.array(~at[decided])], schema=_HITS)
            h, h2, doc, alt, at = (x[~decided] for x in (h, h2, doc, alt, at))
        if not len(h):
            continue
        new = np.append(True, (h[1:] != h[:-1]) | (h2[1:] != h2[:-1]))
        goes_on = last_hash == (h[0], h2[0])
        new[0] = not goes_on
        begin = np.flatnonzero(new)
        if goes_on:
            begin = np.append(0, begin)
        size = np.diff(np.append(begin, len(h)))
        first_doc = doc[begin].copy()
        if goes_on:
            first_doc[0] = last_doc
        two = doc[begin + size - 1] != first_doc
        if goes_on and (known or two[0]):
            two[0] = True
            if pending and not others_only:
                for a, b, c in pending:
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(c)], schema=_HITS)
            pending = []
        elif not goes_on:
            pending = []
        out = np.repeat(two, size)
        if others_only:
            out &= doc != np.repeat(first_doc, size)
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array(doc[out]), pa.array(alt[out]), pa.array(at[out])], schema=_HITS)
        if len(begin) > 1:
            pending = []
        last_hash, last_doc, known = (h[-1], h2[-1]), first_doc[-1], bool(two[-1])
        if not known and not others_only:
            k = begin[-1]
            pending.append((doc[k:].copy(), alt[k:].copy(), at[k:].copy()))


def _runs(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (doc, alt, at): per document its runs [first, last + reach), merged where they touch, as int32 pairs in one binary value."""
    key, runs = None, []

    def row():
        return key[0], key[1], np.array(runs, "<i4").tobytes()

    for batch in batches:
        done = []
        doc, alt, at = (batch.column(k).to_numpy() for k in range(3))
        if not len(doc):
            continue
        breaks = np.append(True, (doc[1:] != doc[:-1]) | (alt[1:] != alt[:-1]) | (at[1:] > at[:-1] + reach))
        begin = np.flatnonzero(breaks)
        end = np.append(begin[1:], len(doc)) - 1
        for d, x, a, b in zip(doc[begin].tolist(), alt[begin].tolist(), at[begin].tolist(), at[end].tolist()):
            if key != (d, x):
                if key:
                    done.append(row())
                key, runs = (d, x), [(a, b + reach)]
            elif a <= runs[-1][1]:
                runs[-1] = (runs[-1][0], max(runs[-1][1], b + reach))
            else:
                runs.append((a, b + reach))
        if done:
            yield _run_rows(done)
    if key:
        yield _run_rows([row()])


def _run_rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    d, a, r = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(a, pa.int32()), pa.array(r, pa.binary())], ["doc", "alt", "runs"])


def _told(hashes: DataFrame, others_only: bool, name: str) -> DataFrame:
    """Rows of _rows -> durable doc, alt, runs (of first positions)."""
    n = partitions(hashes.sparkSession)
    hits = hashes.repartition(n, "h").sortWithinPartitions(*[c for c in ("h", "h2", "doc") if c in hashes.columns]).mapInArrow(lambda b: _shared(b, others_only), "doc long, alt int, at int")
    runs = hits.repartition(n, "doc", "alt").sortWithinPartitions("doc", "alt", "at").mapInArrow(lambda b: _runs(b, 1), "doc long, alt int, runs binary")
    return durable(runs, name)


def _key(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    return mixed(h + mixed(row.astype(np.uint64)))


def _once(h: np.ndarray, row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each hash once per row, at its first position."""
    first = np.sort(np.unique(_key(h, row), return_index=True)[1])
    return h[first], row[first], at[first]


def _all_places(h: np.ndarray, row: np.ndarray, place: np.ndarray, runs: list[bytes | None], start: np.ndarray, n_words: int) -> np.ndarray:
    """Which of the hashes, at word ``place``, equal one at a position that ``runs`` names in the same row."""
    told = np.zeros(n_words + 1, bool)
    for k, own in enumerate(runs):
        if own:
            for x, y in np.frombuffer(own, "<i4").reshape(-1, 2).tolist():
                told[start[k] + x : start[k] + y] = True
    key = _key(h, row)
    return np.isin(key, key[told[place]])


def _decided(h: np.ndarray, h2: np.ndarray, doc: np.ndarray, undecided: int) -> np.ndarray:
    """Rows of hashes that ``undecided`` smaller documents of these rows hold too."""
    order = np.lexsort((doc, h2, h))
    h, h2, doc = h[order], h2[order], doc[order]
    new_hash = np.append(True, (h[1:] != h[:-1]) | (h2[1:] != h2[:-1]))
    smaller = np.cumsum(np.append(True, new_hash[1:] | (doc[1:] != doc[:-1])))
    begin = np.flatnonzero(new_hash)
    smaller -= np.repeat(smaller[begin], np.diff(np.append(begin, len(h))))
    out = np.empty(len(h), bool)
    out[order] = smaller >= undecided
    return out


def _rows(batch: pa.RecordBatch, a: int, h: np.ndarray, h2: np.ndarray | None, row: np.ndarray, at: np.ndarray, undecided: int) -> pa.RecordBatch:
    """Rows for _told. Decided ones go by document: their hash is replaced by one of the document, so that they stand together in the shuffle's blocks."""
    doc, alt = batch.column(0).to_numpy()[row + a], batch.column(1).to_numpy()[row + a]
    done = _decided(h, np.zeros_like(h) if h2 is None else h2, doc, undecided) if len(h) else np.zeros(0, bool)
    columns = {"h": np.where(done, mixed(doc.view(np.uint64)), h).view(np.int64), "doc": doc, "alt": alt, "at": np.where(done, ~at, at).astype(np.int32)}
    if h2 is not None:
        columns = {"h": columns.pop("h"), "h2": np.where(done, np.int32(0), h2), **columns}
    return pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})


def substring_dedup(docs: DataFrame, size: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, n_removed, kept_sha256, kept (the words that stay)."""
    if size < PERIOD:
        raise ValueError(f"windows of at least {PERIOD} words")
    width = size - PERIOD + 1
    texts = _keyed(docs, id_col, text_col)
    matched = texts.filter(F.col("doc").isNotNull())

    def cover_anchors(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h, row, at = window_hashes(words, counts, width)
        take = np.isin(at % PERIOD, COVER) & (counts[row] >= size)
        return h[take] >> np.uint64(64 - _ANCHOR_BITS), row[take], at[take]

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, _, raw, offs in text_parts(batch.column(2)):
                h, row, at = _once(*cover_anchors(*word_hashes(raw, offs)))
                # of a hash's documents the smallest two go to its partition, which then knows of both
                yield _rows(batch, a, h, None, row, at, 2)

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column(3).to_pylist()
            for a, b, raw, offs in text_parts(batch.column(2)):
                words, counts = word_hashes(raw, offs)
                start = np.cumsum(counts) - counts
                h, row, at = cover_anchors(words, counts)
                shared = np.zeros(len(words) + PERIOD + 1, np.int64)
                shared[(start[row] + at)[_all_places(h, row, start[row] + at, runs[a:b], start, len(words))] + 1] = 1
                upto = np.cumsum(shared)
                h, row, at = window_hashes(words, counts, size)
                place = start[row] + at
                take = upto[place + PERIOD] > upto[place]
                h, row, at = _once(h[take], row[take], at[take])
                yield _rows(batch, a, h, second_hashes(words, start[row] + at, size).astype(np.uint32).view(np.int32), row, at, 1)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, texts_of = batch.column(3).to_pylist(), batch.column(2).to_pylist()
            n, gone, kept = [], [], []
            for a, b, raw, offs in text_parts(batch.column(2)):
                covered = None
                if any(runs[a:b]):
                    words, counts = word_hashes(raw, offs)
                    start = np.cumsum(counts) - counts
                    h, row, at = window_hashes(words, counts, size)
                    place = start[row] + at
                    place = place[_all_places(h, row, place, runs[a:b], start, len(words))]
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, place, 1)
                    np.add.at(change, place + size, -1)
                    covered = np.cumsum(change) > 0
                for k in range(a, b):
                    own = (texts_of[k] or "").encode().split()
                    n.append(len(own))
                    if runs[k]:
                        own = list(compress(own, (~covered[start[k - a] : start[k - a] + len(own)]).tolist()))
                    gone.append(n[-1] - len(own))
                    kept.append(b" ".join(own))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), pa.array([x.decode() for x in kept], pa.string())],
                ["id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    found = _told(matched.mapInArrow(anchors, _ANCHORS), False, "anchors")
    windows = matched.join(found, ["doc", "alt"]).select("doc", "alt", "text", "runs").mapInArrow(extended, _WINDOWS)
    cuts = _told(windows, True, "cuts")
    out = texts.join(cuts, ["doc", "alt"], "left").select("doc", "alt", "text", "runs").mapInArrow(cut, "id long, n_words long, n_removed long, kept_sha256 string, kept string")
    return out.withColumnRenamed("id", id_col)
