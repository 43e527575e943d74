"""Token-ID files coded by a static range asymmetric numeral system (rANS).

File layout (little endian)::

    "RIDS1\\n"  u32 length of the header  header (JSON)  table  document table  checkpoints  words

* table: zlib of the symbols (u32) and their quantised frequencies (u32, summing to 2**scale).
  It is static and shared by all blocks of the file.
* document table: zlib of the ids (i64), a null flag (u8) and the token counts (u32) of the
  documents, in file order.
* blocks of STEPS x LANES token ids. Each block is independent: LANES interleaved coders, whose
  renormalisation words (u32) share one stream. A checkpoint holds a block's lane states (u64),
  and the header its word offset, word count and CRC-32. So any block decodes without the others;
  here all blocks of a file are decoded side by side, one numpy operation per step.

Files hold documents in ascending id order (null ids first, equal ids by text); a file is closed
at the end of the batch (of ``batch_bytes`` of text) in which it passes ``file_ids`` ids. Texts reach the writer through a range partition
by id (equal ids by their texts' beginnings), and the manifest has each file's part and its place
there, so the files of all tasks are one global sequence, whatever ids repeat. File names are
random and only names in the returned manifest count, so a task that runs twice leaves an
unused file at most. Null texts count as empty; an empty document still has its end id.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable, new_dir, open_fs, partitions
from .token_counts import by_bytes, tokenizer

MAGIC = b"RIDS1\n"
SCALE, LANES, STEPS = 18, 128, 128
LOW = 1 << 20  # states stay in [2**20, 2**52), where a float64 quotient by a frequency is exact
FILE_IDS = 1 << 21
KEPT_WORDS = 800_000
BATCH_BYTES = 2 << 20


# ---- coder ----------------------------------------------------------------------------------


def quantised(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies of at least 1 that sum to 2**scale, near in proportion to ``counts`` (all > 0)."""
    whole = 1 << scale
    if len(counts) > whole:
        raise ValueError("more symbols than slots")
    f = np.maximum(1, (counts.astype(np.float64) * (whole / counts.sum())).astype(np.int64))
    over = int(f.sum()) - whole
    if over < 0:
        f[np.argmax(f)] -= over
    for k in np.argsort(-f) if over > 0 else ():
        cut = min(over, int(f[k]) - max(1, int(f[k]) // 2))
        f[k] -= cut
        over -= cut
        if not over:
            break
    return f


def encoded(ids: np.ndarray) -> tuple[dict, bytes]:
    """Header fields and body (table, checkpoints, words) for ``ids``."""
    if not len(ids):
        return {"n_ids": 0, "scale": SCALE, "lanes": LANES, "steps": STEPS, "sizes": [0, 0], "blocks": []}, b""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    freq = quantised(counts[symbols])
    place = np.zeros(len(counts), np.int32)
    place[symbols] = np.arange(len(symbols))
    f_of, c_of = freq, np.cumsum(freq) - freq
    size = LANES * STEPS
    n = -(-len(ids) // size)
    rows = np.full(n * size, int(np.argmax(freq)), np.int32)
    rows[: len(ids)] = place[ids]
    rows = rows.reshape(n, STEPS, LANES)
    x = np.full((n, LANES), LOW, np.int64)
    words, sent = np.zeros((n, STEPS, LANES), np.uint32), np.zeros((n, STEPS, LANES), bool)
    for t in range(STEPS - 1, -1, -1):
        f, c = f_of[rows[:, t]], c_of[rows[:, t]]
        full = x >= (f << (52 - SCALE))
        sent[:, t], words[:, t] = full, x.astype(np.uint32)
        x = np.where(full, x >> 32, x)
        q = (x / f).astype(np.int64)
        x = (q << SCALE) + (x - q * f) + c
    table = zlib.compress(symbols.astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 6)
    states = x.astype("<u8").tobytes()
    blocks, body, offset = [], [], 0
    for k in range(n):
        w = words[k][sent[k]].astype("<u4")
        data = w.tobytes()
        blocks.append([offset, len(w), zlib.crc32(data, zlib.crc32(x[k].astype("<u8").tobytes()))])
        body.append(data)
        offset += len(w)
    head = {"n_ids": len(ids), "scale": SCALE, "lanes": LANES, "steps": STEPS, "sizes": [len(table), len(states)], "blocks": blocks}
    return head, table + states + b"".join(body)


def decoded(head: dict, body: memoryview, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks ``first`` to ``last`` (all by default); raises on a checksum that doesn't hold."""
    blocks = head["blocks"][first:last]
    if not blocks:
        return np.zeros(0, np.uint32)
    n_table, n_states = head["sizes"]
    lanes, steps, scale = head["lanes"], head["steps"], head["scale"]
    symbols, freq = np.frombuffer(zlib.decompress(body[:n_table]), "<u4").reshape(2, -1)
    f_of = freq.astype(np.int64)
    c_of = np.cumsum(f_of) - f_of
    slot_of = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
    states = np.frombuffer(body[n_table : n_table + n_states], "<u8").reshape(-1, lanes)[first:last]
    begin, total = blocks[0][0], blocks[-1][0] + blocks[-1][1]
    start = n_table + n_states
    words = np.frombuffer(body[start + 4 * begin : start + 4 * total], "<u4")
    for k, (at, n, crc) in enumerate(blocks):
        if zlib.crc32(words[at - begin : at - begin + n].tobytes(), zlib.crc32(states[k].tobytes())) != crc:
            raise ValueError(f"block {first + k}: the checksum does not hold")
    words = np.append(words, np.zeros(lanes + 1, "<u4")).astype(np.int64)
    at = np.array([b[0] - begin for b in blocks], np.int64)
    x = states.astype(np.int64)
    out = np.empty((len(blocks), steps, lanes), np.uint32)
    mask = (1 << scale) - 1
    for t in range(steps):
        slot = x & mask
        s = slot_of[slot]
        out[:, t] = s
        x = f_of[s] * (x >> scale) + slot - c_of[s]
        low = x < LOW
        nth = np.cumsum(low, axis=1)
        x = np.where(low, (x << 32) | words[at[:, None] + np.maximum(nth - 1, 0)], x)
        at += nth[:, -1]
    ids = symbols[out.reshape(-1)]
    return ids[: head["n_ids"] - first * lanes * steps] if last is None or last >= len(head["blocks"]) else ids


def write_file(fs, path: str, doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> None:
    head, body = encoded(ids)
    docs = zlib.compress(np.array([x or 0 for x in doc_ids], "<i8").tobytes() + np.array([x is None for x in doc_ids], "u1").tobytes() + np.array(counts, "<u4").tobytes(), 6)
    head |= {"n_docs": len(doc_ids), "docs": len(docs), "docs_crc": zlib.crc32(docs)}
    text = json.dumps(head, separators=(",", ":")).encode()
    with fs.open_output_stream(path) as f:
        f.write(MAGIC + struct.pack("<I", len(text)) + text + docs)
        f.write(body)


def read_file(fs, path: str) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, token counts and all token ids of a file."""
    with fs.open_input_stream(path) as f:
        data = memoryview(f.read())
    if bytes(data[: len(MAGIC)]) != MAGIC:
        raise ValueError(f"{path}: not a token-ID file")
    at = len(MAGIC) + 4
    n = struct.unpack("<I", data[at - 4 : at])[0]
    head = json.loads(bytes(data[at : at + n]))
    docs, at = bytes(data[at + n : at + n + head["docs"]]), at + n + head["docs"]
    if zlib.crc32(docs) != head["docs_crc"]:
        raise ValueError(f"{path}: the document table's checksum does not hold")
    raw, k = zlib.decompress(docs), head["n_docs"]
    doc_ids, null, counts = np.frombuffer(raw, "<i8", k), np.frombuffer(raw, "u1", k, 8 * k), np.frombuffer(raw, "<u4", k, 9 * k)
    return [None if z else int(x) for x, z in zip(doc_ids, null)], counts, decoded(head, data[at:])


# ---- encoding of texts ----------------------------------------------------------------------


#: Words of one pre-token, or of one and a full stop or comma. The letters are their own normal form, and lower-case letter by letter.
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ɏ]+[.,]?").fullmatch
#: The normalisers and pre-tokenisers under which plain words have these pre-tokens.
_NORMALIZERS = {"NFC", "Replace", "Lowercase"}
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def knows_plain_words(path: str) -> bool:
    """Whether the file's normaliser and pre-tokenizer are those under which plain words have one or two known pre-tokens."""
    with open(path) as f:
        conf = json.load(f)
    steps = (conf["normalizer"] or {}).get("normalizers", [])
    split = (conf["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    if [x.get("type") for x in split] != ["Split", "ByteLevel"] or {x["type"] for x in steps} != _NORMALIZERS:
        return False
    white = [x["pattern"] == {"Regex": "\\s+"} and x["content"] == " " for x in steps if x["type"] == "Replace"]
    own = split[0]["pattern"] == {"Regex": _SPLIT} and split[0]["invert"] and split[0]["behavior"] == "Removed"
    return all(white) and own and not split[1]["add_prefix_space"] and not split[1]["use_regex"]


def _byte_letters() -> dict[int, str]:
    """Latin letters beyond ASCII as the byte-level alphabet writes them: a byte that is printable as itself, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    as_char = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return {c: "".join(as_char[b] for b in chr(c).encode()) for c in range(0xC0, 0x250)}


_LETTERS = _byte_letters()


class Encoder:
    """Token ids of texts, by words: this kind of vocabulary drops white space and never joins across it.

    All ids come from the library. Of words not met before, plain ones go in lower case straight to its
    model, the stem and its full stop or comma apart, as its normaliser and pre-tokenizer would hand them
    on; all others, and all words under a file of another configuration, go through ``encode_batch``.
    """

    def __init__(self, path: str, kept: int = KEPT_WORDS):
        whole = tokenizer(path)
        self.encode, self.model, self.plain, self.kept = whole.encode_batch_fast, whole.model, knows_plain_words(path), kept
        self.forget()

    def _pre_token(self, x: str) -> list[int]:
        got = self.pre_tokens.get(x)
        if got is None:
            got = self.pre_tokens[x] = [t.id for t in self.model.tokenize(x if x.isascii() else x.translate(_LETTERS))]
        return got

    def encoded(self, words: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        odd = []
        for k, w in enumerate(words):
            if not self.plain or not _PLAIN(w):
                odd.append(k)
                out.append([])
            elif w[-1] in ".,":
                out.append(self._pre_token(w[:-1].lower()) + self._pre_token(w[-1]))
            else:
                out.append(self._pre_token(w.lower()))
        for k, e in zip(odd, self.encode([words[k] for k in odd], add_special_tokens=False)):
            out[k] = e.ids
        return out

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.pre_tokens: dict[str, list[int]] = {}
        self.flat, self.begin = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def ids(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` (nulls are empty), each with ``end_id`` at its end, and the number of ids of each."""
        split = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()).fill_null(""), "\n", " "), " ")
        n_words = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        here = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > self.kept:
            self.forget()
        new = [w for w in here if w not in self.known]
        if new:
            got = self.encoded(new)
            lengths = np.fromiter(map(len, got), np.int64, len(got))
            flat = np.fromiter(chain.from_iterable(got), np.uint32, int(lengths.sum()))
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(lengths)])
            self.flat = np.concatenate([self.flat, flat])
        words = np.fromiter(map(self.known.__getitem__, here), np.int64, len(here))[coded.indices.to_numpy()]
        begin = self.begin[words]
        per_word = self.begin[words + 1] - begin
        ends = np.append(0, np.cumsum(per_word))
        upto = np.cumsum(n_words)
        counts = ends[upto] - ends[upto - n_words] + 1
        at = np.arange(ends[-1]) + np.repeat(begin - ends[:-1], per_word)
        return np.insert(self.flat[at], ends[upto], end_id), counts


def encode_documents(docs: DataFrame, out_dir: str, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Write token-ID files; return the durable manifest: part (of the range partitioning), place (in the part), file, n_docs, n_ids."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(out_dir)
        fs.create_dir(root, recursive=True)
        encoder, part, place = Encoder(path), TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        counts: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            nonlocal place
            name = f"{uuid.uuid4().hex}.rids"
            all_ids, n = np.concatenate(ids), np.concatenate(counts)
            write_file(fs, f"{root}/{name}", doc_ids, n.tolist(), all_ids)
            row = pa.RecordBatch.from_arrays([pa.array([x]) for x in (part, place, name, len(doc_ids), len(all_ids))], ["part", "place", "file", "n_docs", "n_ids"])
            doc_ids.clear(), counts.clear(), ids.clear()
            place += 1
            return row

        for batch in batches:
            own = batch.column(0).to_pylist()
            for a, b in by_bytes(batch.column(1), batch_bytes):
                got, n = encoder.ids(batch.column(1).slice(a, b - a), end_id)
                doc_ids += own[a:b]
                ids.append(got)
                counts.append(n)
                if sum(map(len, ids)) >= file_ids:
                    yield close()
        if doc_ids:
            yield close()

    start = F.substring("text", 1, 64)  # in the order of the texts
    rows = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .repartitionByRange(partitions(docs.sparkSession), F.col("id"), start)
        .sortWithinPartitions("id", "text")
        .mapInArrow(write, "part long, place long, file string, n_docs long, n_ids long")
    )
    return durable(rows, "rids-manifest")


def read_documents(manifest: DataFrame, out_dir: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids (in file order)."""
    return _read(manifest, out_dir, "doc_id long, start long, n_tokens long, ids array<int>", lambda ids: pa.array(ids.astype(np.int32)))


def read_digests(manifest: DataFrame, out_dir: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    return _read(manifest, out_dir, "doc_id long, start long, n_tokens long, ids_crc32 long", None)


def _read(manifest: DataFrame, out_dir: str, schema: str, as_array) -> DataFrame:
    # Ids before a file: those of earlier parts (a number per shuffle partition comes to the driver), and of earlier files of its part.
    totals = sorted((r["part"], r["n"]) for r in manifest.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    bases = list(zip([k for k, _ in totals], np.cumsum([0] + [n for _, n in totals]).tolist()))
    before = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("n_ids").over(before), F.lit(0))
    files = manifest.join(F.broadcast(manifest.sparkSession.createDataFrame(bases, "part long, base long")), "part").withColumn("base", F.col("base") + own)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(out_dir)
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                doc_ids, counts, ids = read_file(fs, f"{root}/{name}")
                ends = np.cumsum(counts, dtype=np.int64)
                begins = ends - counts
                if as_array:
                    offsets = pa.array(np.append(begins, ends[-1:]).astype(np.int32))
                    last = pa.ListArray.from_arrays(offsets, as_array(ids))
                else:
                    raw = memoryview(ids.astype("<u4").tobytes())
                    last = pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(base + begins), pa.array(counts, pa.int64()), last], names)

    names = [x.split()[0] for x in schema.split(", ")]
    return files.select("file", "base").repartition(partitions(manifest.sparkSession), "file").mapInArrow(read, schema)


def token_files(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Write the files to the shared folder and read them back."""
    out_dir = new_dir(docs.sparkSession, "rids")
    return read_digests(encode_documents(docs, out_dir, path, end_id), out_dir)
