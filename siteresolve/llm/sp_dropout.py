"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

The vocabulary and its merge order come from a public model file; this module runs the merges. A
text is one space plus itself, cut into runs: before every space that follows another character - no
piece has a space inside it, so no merge crosses such a cut - and between Latin letters and other
characters, if the model has no piece with both. In each run, an agenda holds the adjacent pairs
whose joined piece exists, best rank first, leftmost first. The pair that is popped is skipped if a
keyed hash says so: a pair that is skipped comes back only once one of its sides has grown.

The hash is that of an occurrence: BLAKE2b with the seed as key, over the document's id, mixed with
the run's place in the document and with the number of the pop. So the segmentation is the same on
every run and machine, every occurrence of a word draws its own skips, and another seed (an epoch)
gives others. Skipping nothing (``dropout`` 0) gives the library's own ids.

All runs of a portion of texts go through their agendas side by side, a pop of each at a time, in
numpy: first each distinct run without skips, which tells how many pops it has; then, with their
skips, the occurrences for which one of these pops is skipped. Runs of more than LONG characters
take a heap, one after the other; so do all runs under a model with pieces whose characters are no
pieces, which the tables of pairs can't hold.

A character without a piece becomes its UTF-8 bytes' pieces, and so does U+2581 (the model's own
mark for a space), which the library would turn into a space. Decoding joins the pieces' bytes and
takes off the first space, so every text comes back as it was.

Null and empty texts have no pieces, and an empty decoded text. Repeated rows (id and text) get equal
ids; a null id is an id like others. Nothing is kept from one portion of texts to the next.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from hashlib import blake2b
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released
from .words import mixed, power_tables, text_parts

DROPOUT = 0.1
SEED = 17
LONG = 48
PORTION = 1 << 19  # bytes of text taken together
ROWS = 8192  # runs whose agendas go side by side
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
_MIXED = re.compile(f"[{_LETTER}][^{_LETTER} ]|[^{_LETTER} ][{_LETTER}]")
_GOLDEN, _TURN, _ALL = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, (1 << 64) - 1
_NONE = np.int32(2**31 - 1)
_CHARS = 0x110000
_SPARE = 8  # slots a pair, about

_models: dict[str, Model] = {}


class Pairs:
    """Ranks and joined pieces of pairs of symbols, in hash tables: what finds its slot taken goes to the next table."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray, joined: np.ndarray):
        self.tables = []
        while len(keys):
            bits = (_SPARE * len(keys)).bit_length()
            slot = self._slots(keys, len(self.tables), bits)
            _, first = np.unique(slot, return_index=True)
            table = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _NONE, np.int32), np.full(1 << bits, -1, np.int32)
            for column, values in zip(table, (keys, ranks, joined)):
                column[slot[first]] = values[first]
            self.tables.append((bits, *table))
            keys, ranks, joined = (np.delete(x, first) for x in (keys, ranks, joined))

    @staticmethod
    def _slots(keys: np.ndarray, table: int, bits: int) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(_GOLDEN + 2 * table * _TURN & _ALL)) >> np.uint64(64 - bits)).view(np.int64)

    def _found(self, left: np.ndarray, right: np.ndarray, column: int, missing: int) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        out = np.full(keys.shape, missing, np.int32)
        for k, (bits, *table) in enumerate(self.tables):
            slot = self._slots(keys, k, bits)
            np.copyto(out, table[column][slot], where=table[0][slot] == keys)
        return out

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self._found(left, right, 1, _NONE)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self._found(left, right, 2, -1)


class Model:
    """Of a model file: rank (best 0) and id by piece (spaces as such), ids of the 256 bytes, bytes by id, and the tables made of them."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            m = sentencepiece.SentencePieceProcessor(model_proto=f.read())
        by_piece, by_byte, raw = {}, [m.unk_id()] * 256, []
        for k in range(m.get_piece_size()):
            name = m.id_to_piece(k)
            if m.is_byte(k):
                by_byte[int(name[3:-1], 16)] = k
                raw.append(bytes([int(name[3:-1], 16)]))
            elif m.is_control(k) or m.is_unknown(k) or m.is_unused(k):
                raw.append(b"")
            else:
                name = name.replace("▁", " ")
                by_piece[name] = (m.get_score(k), k)
                raw.append(name.encode())
        ranks = {x: r for r, x in enumerate(sorted({x for x, _ in by_piece.values()}, reverse=True))}
        self.by_piece = {name: (ranks[x], k) for name, (x, k) in by_piece.items()}
        self.by_byte = by_byte
        self.apart = not any(map(_MIXED.search, by_piece))
        self.sizes = np.array([len(x) for x in raw], np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        #: Symbols: ids of pieces; a character without one is ``extra`` plus its code point.
        self.extra = len(raw)
        self.symbols = np.arange(self.extra, self.extra + _CHARS, dtype=np.int32)
        for name, (_, k) in self.by_piece.items():
            if len(name) == 1:
                self.symbols[ord(name)] = k
        self.tabled = all(c in self.by_piece for name in self.by_piece for c in name)
        if self.tabled:
            of_rank: dict[int, int] = {}
            pairs: dict[int, tuple[int, int]] = {}
            for name, (r, k) in self.by_piece.items():
                of_rank[r] = -1 if r in of_rank else k
                for at in range(1, len(name)):
                    a, b = self.by_piece.get(name[:at]), self.by_piece.get(name[at:])
                    if a and b:
                        pairs[a[1] << 32 | b[1]] = r, k
            values = np.array(list(pairs.values()), np.int32).reshape(-1, 2)
            self.pairs = Pairs(np.fromiter(pairs, np.int64, len(pairs)), values[:, 0], values[:, 1])
            #: The piece of each rank; -1 where several pieces share it.
            self.of_rank = np.array([of_rank[r] for r in range(len(ranks))], np.int32)
        letter = np.zeros(_CHARS, np.uint8)
        letter[[c for c in range(0x250) if re.match(f"[{_LETTER}]", chr(c))]] = 1
        self.letter = letter


def model(path: str) -> Model:
    """Loaded once per worker."""
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def draws(occurrence: np.ndarray, pop: int) -> np.ndarray:
    """Four 16-bit draws an occurrence: those of pops ``pop`` to ``pop`` + 3."""
    return mixed(occurrence + np.uint64((pop // 4 + 1) * 0xD1342543DE82EF95 % (1 << 64))).view("<u2").reshape(-1, 4)


def skipped(occurrence: int, pop: int, limit: int) -> bool:
    return bool(draws(np.array([occurrence], np.uint64), pop)[0, pop % 4] < limit)


def document_key(seed: int, doc_id: object) -> int:
    return int.from_bytes(blake2b(str(doc_id).encode(), key=f"merge-dropout {seed}".encode(), digest_size=8).digest(), "little")


class Encoder:
    """Encodes and decodes portions of texts."""

    def __init__(self, path: str, dropout: float = DROPOUT, seed: int = SEED):
        self.model, self.seed = model(path), seed
        self.limit = round(dropout * (1 << 16))

    # ---- agendas ----

    def by_heap(self, chars: np.ndarray, occurrence: int | None) -> list[int]:
        """Symbols of one run. An agenda entry: rank, where the pair begins, where it ends."""
        by_piece, text = self.model.by_piece, chars.astype("<u4").tobytes().decode("utf-32-le")
        n = len(text)
        own, end, before = self.model.symbols[chars].tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(p[0], k, k + 2) for k in range(n - 1) if (p := by_piece.get(text[k : k + 2]))]
        heapify(agenda)
        pop, lanes = 0, None
        while agenda:
            _, a, c = heappop(agenda)
            b = end[a]
            if not 0 < b < c or end[b] != c:
                continue
            if occurrence is not None:
                if pop % 4 == 0:
                    lanes = draws(np.array([occurrence], np.uint64), pop)[0].tolist()
                pop += 1
                if lanes[(pop - 1) % 4] < self.limit:
                    continue
            end[a], end[b], own[a] = c, 0, by_piece[text[a:c]][1]  # 0: merged into another symbol
            if c < n:
                before[c] = a
                if p := by_piece.get(text[a : end[c]]):
                    heappush(agenda, (p[0], a, end[c]))
            if (z := before[a]) >= 0 and (p := by_piece.get(text[z:c])):
                heappush(agenda, (p[0], z, c))
        return [x for x, e in zip(own, end) if e]

    def side_by_side(self, symbols: np.ndarray, ranks: np.ndarray, begin: np.ndarray, size: np.ndarray, occurrence: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of runs of similar length: their symbols after all pops, one run after the other; the number of symbols and of pops of each."""
        m, n, wide = self.model, len(begin), int(size.max())
        rows, columns = np.arange(n), np.arange(wide + 1)
        # a last column stands for what is before the first and after the last symbol
        place = np.minimum(begin[:, None] + columns, len(symbols) - 1)
        paired = columns + 1 < size[:, None]
        own = np.where(columns < size[:, None], symbols[place], -1)
        rank = np.where(paired, ranks[place], _NONE)
        width = wide + 1
        after = np.where(paired, columns + 1, wide).astype(np.int32)
        before = np.broadcast_to(np.where(columns > 0, columns - 1, wide).astype(np.int32), own.shape).copy()
        own, rank_flat, after, before = own.reshape(-1), rank.reshape(-1), after.reshape(-1), before.reshape(-1)
        pops = np.zeros(n, np.int64)
        lanes, pop = None, 0
        live = rows
        while True:
            part = rank if len(live) == n else rank[live]
            row = live * width
            a = row + part.argmin(axis=1)
            best = rank_flat[a]
            some = best < _NONE
            if not some.all():
                live, row, a, best = live[some], row[some], a[some], best[some]
            if not len(live):
                break
            if occurrence is not None:
                if pop % 4 == 0:
                    lanes = draws(occurrence, pop)
                skip = lanes[live, pop % 4] < self.limit
                rank_flat[a[skip]] = _NONE
                row, a, best = row[~skip], a[~skip], best[~skip]
            pops[live] += 1
            pop += 1
            b = row + after[a]
            joined = m.of_rank[best]
            if (shared := joined < 0).any():
                joined[shared] = m.pairs.joined(own[a[shared]], own[b[shared]])
            c = after[b]
            own[a], own[b], rank_flat[b] = joined, -1, _NONE
            after[a] = c
            before[row + c] = a - row
            z = row + before[a]
            rank_flat[a] = m.pairs.ranks(joined, own[row + c])
            rank_flat[z] = m.pairs.ranks(own[z], joined)
            rank_flat[row + wide] = _NONE
        own = own.reshape(n, width)
        left = own >= 0
        return own[left], left.sum(axis=1), pops

    def all_runs(self, chars: np.ndarray, symbols: np.ndarray, ranks: np.ndarray, begin: np.ndarray, size: np.ndarray, occurrence: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of runs, where each run's begin, their numbers, and the numbers of pops (of runs that a heap took: -1)."""
        n = len(begin)
        at, counts, pops = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, -1, np.int64)
        out, used = [], 0
        order = np.argsort(size, kind="stable")
        short = int(np.searchsorted(size[order], LONG, "right")) if self.model.tabled else 0
        for k in range(0, short, ROWS):
            own = order[k : min(k + ROWS, short)]
            flat, counts[own], pops[own] = self.side_by_side(symbols, ranks, begin[own], size[own], None if occurrence is None else occurrence[own])
            at[own] = used + np.cumsum(counts[own]) - counts[own]
            out.append(flat.astype(np.int32))
            used += len(flat)
        for k in order[short:].tolist():
            got = self.by_heap(chars[begin[k] : begin[k] + size[k]], None if occurrence is None else int(occurrence[k]))
            out.append(np.array(got, np.int32))
            at[k], counts[k] = used, len(got)
            used += len(got)
        return np.concatenate(out) if out else np.zeros(0, np.int32), at, counts, pops

    # ---- texts ----

    def runs(self, chars: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Where runs begin in ``chars``; texts begin at ``begin``."""
        space, letter = chars == 32, self.model.letter[chars]
        cut = np.zeros(len(chars), bool)
        cut[1:] = space[1:] & ~space[:-1]
        if self.model.apart:
            cut[1:] |= ~space[1:] & ~space[:-1] & (letter[1:] != letter[:-1])
        cut[begin] = True
        return np.flatnonzero(cut)

    @staticmethod
    def distinct(chars: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First occurrence of each distinct run, and each run's number among these. Hashes are verified by the characters."""
        powers, inverse = power_tables(len(chars))
        powers, inverse = powers[: len(chars)], inverse[begin]
        total = np.append(np.uint64(0), np.cumsum(chars * powers))
        h = mixed((total[begin + size] - total[begin]) * inverse)
        code, names = pd.factorize(h)
        first = np.full(len(names), len(h), np.int64)
        np.minimum.at(first, code, np.arange(len(h)))
        model_run = first[code]
        same = bool((size[model_run] == size).all())
        if same:
            shift = np.repeat(begin[model_run] - begin, size)
            same = bool((chars[np.arange(len(chars)) + shift] == chars).all())
        if not same:
            return np.arange(len(h)), np.arange(len(h))
        return first, code

    def encode_texts(self, raw: np.ndarray, offsets: np.ndarray, doc_ids: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (UTF-8 in ``raw``), one after the other, and their number for each."""
        n_docs = len(offsets) - 1
        own = np.append(0, np.cumsum((raw & 0xC0) != 0x80))[offsets]
        some = np.flatnonzero(np.diff(own))
        chars = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), "<u4").astype(np.uint32)
        chars = np.insert(chars, own[some], 32)
        if not len(chars):
            return np.zeros(0, np.int32), np.zeros(n_docs, np.int64)
        text_begin = own[some] + np.arange(len(some))
        begin = self.runs(chars, text_begin)
        size = np.diff(np.append(begin, len(chars)))
        first, code = self.distinct(chars, begin, size)
        begin_of, size_of = begin[first], size[first]
        symbols, ranks = self.model.symbols[chars], np.full(len(chars), _NONE, np.int32)
        if self.model.tabled:
            place = np.repeat(begin_of - np.cumsum(size_of) + size_of, size_of) + np.arange(size_of.sum())
            ranks[place] = self.model.pairs.ranks(symbols[place], symbols[np.minimum(place + 1, len(chars) - 1)])
        ids, at, counts, pops = self.all_runs(chars, symbols, ranks, begin_of, size_of, None)
        at, counts = at[code], counts[code]
        run_doc = np.searchsorted(text_begin, begin, "right") - 1
        if self.limit:
            keys = np.array([document_key(self.seed, doc_ids[k]) for k in some.tolist()], np.uint64)
            first_run = np.searchsorted(begin, text_begin)
            occurrence = mixed(keys[run_doc] + (np.arange(len(begin)) - first_run[run_doc]).astype(np.uint64) * np.uint64(_GOLDEN))
            pops = pops[code]
            redone = [np.flatnonzero(pops < 0)]
            left = np.flatnonzero(pops > 0)
            for pop in range(0, int(pops.max(initial=0)), 4):
                left = left[pops[left] > pop]
                hit = ((draws(occurrence[left], pop) < self.limit) & (np.arange(pop, pop + 4) < pops[left, None])).any(axis=1)
                redone.append(left[hit])
                left = left[~hit]
            own_way = np.concatenate(redone)
            more, at_more, counts[own_way], _ = self.all_runs(chars, symbols, ranks, begin_of[code[own_way]], size[own_way], occurrence[own_way])
            at[own_way] = len(ids) + at_more
            ids = np.concatenate([ids, more])
        ends = np.cumsum(counts)
        ids = ids[np.arange(ends[-1]) + np.repeat(at - (ends - counts), counts)]
        per_doc = np.zeros(n_docs, np.int64)
        np.add.at(per_doc, some, np.bincount(run_doc, counts, len(some)).astype(np.int64))
        return self._bytes_of_extra(ids, per_doc)

    def _bytes_of_extra(self, ids: np.ndarray, per_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as the pieces of their bytes."""
        extra = np.flatnonzero(ids >= self.model.extra)
        if not len(extra):
            return ids, per_doc
        chars, code = np.unique(ids[extra] - self.model.extra, return_inverse=True)
        spelled = [[self.model.by_byte[b] for b in chr(c).encode()] for c in chars.tolist()]
        longer = np.zeros(len(ids), np.int64)
        longer[extra] = np.array([len(x) - 1 for x in spelled])[code]
        doc = np.repeat(np.arange(len(per_doc)), per_doc)
        out = np.repeat(ids, longer + 1)
        begin = (np.arange(len(ids)) + np.cumsum(longer) - longer)[extra]
        for k in range(4):
            has = np.array([len(x) > k for x in spelled])[code]
            out[begin[has] + k] = np.array([x[k] if len(x) > k else 0 for x in spelled], np.int32)[code[has]]
        return out, per_doc + np.bincount(doc, longer, len(per_doc)).astype(np.int64)

    def encode(self, text: str, doc_id: object = None) -> np.ndarray:
        raw = np.frombuffer(text.encode(), np.uint8)
        return self.encode_texts(raw, np.array([0, len(raw)]), [doc_id])[0]

    def decode_texts(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 of all texts, without their first spaces, and where each ends."""
        m = self.model
        sizes = m.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        raw = m.bytes[np.arange(total) + np.repeat(m.places[ids] - (ends - sizes), sizes)]
        text_ends = np.append(0, ends)[np.cumsum(counts)]
        firsts = np.append(0, text_ends[:-1])[counts > 0]
        return np.delete(raw, firsts), text_ends - np.cumsum(counts > 0)

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_texts(np.asarray(ids, np.int64), np.array([len(ids)]))[0].tobytes().decode()


def encode_documents(docs: DataFrame, path: str, dropout: float = DROPOUT, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_pieces, ids, ids_crc32, decoded_sha256 (of the decoded text), lossless."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, dropout, seed)
        for batch in released(batches):
            doc_ids = batch.column(0).to_pylist()
            for a, b, raw, offsets in text_parts(batch.column(1), PORTION):
                ids, counts = encoder.encode_texts(raw, offsets, doc_ids[a:b])
                back, ends = encoder.decode_texts(ids, counts)
                edges = np.append(0, np.cumsum(counts))
                coded, decoded, given = (memoryview(x) for x in (ids.astype("<u4").tobytes(), back.tobytes(), raw.tobytes()))
                spans = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
                texts = list(zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), offsets[:-1].tolist(), offsets[1:].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(counts),
                        pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids)),
                        pa.array([zlib.crc32(coded[4 * x : 4 * y]) for x, y in spans], pa.int64()),
                        pa.array([hashlib.sha256(decoded[x:y]).hexdigest() for x, y, _, _ in texts], pa.string()),
                        pa.array([decoded[x:y] == given[v:w] for x, y, v, w in texts], pa.bool_()),
                    ],
                    ["id", "n_pieces", "ids", "ids_crc32", "decoded_sha256", "lossless"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(run, f"id {kind}, n_pieces long, ids array<int>, ids_crc32 long, decoded_sha256 string, lossless boolean")
        .withColumnRenamed("id", id_col)
    )


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per row of encode_documents: id, text (null or empty texts are empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            texts = [encoder.decode(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(F.col(id_col).alias("id"), "ids").mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)
