"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts are taken in batches balanced by UTF-8 bytes, not rows. Inside a batch every text is split
at safe boundaries - places where the byte-level pre-tokenizer always starts a new token, so the
pieces' lengths add up to the text's length: a single space between two visible characters (the
space begins the next token), and a single line break between two visible characters (a token of
its own). The pieces that the worker has not met before go to the library in one ``encode_batch``
call; the lengths are kept in a bounded table per worker, since words repeat. A text with any
other white space, or characters outside Latin, is split only where the first rule surely holds;
a long piece is encoded without being kept.

Null text counts as empty (0 bytes, 0 tokens). Repeated rows give repeated rows. Special strings
in a text are treated as the library does by default.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 1 << 20
KEPT_PIECES = 400_000
LONGEST_KEPT = 48
_VISIBLE = "!-~¡-ɏ"
_ODD = re.compile(f"[^{_VISIBLE} \n]|[ \n][ \n]|^[ \n]|[ \n]$")
_SAFE = re.compile(f"(?<=[{_VISIBLE}]) (?=[{_VISIBLE}])")

_tokenizers: dict[str, object] = {}


def tokenizer(path: str):
    """The tokenizer of a file, loaded once per worker; the library's threads stay off."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


class Lengths:
    """Token counts of texts, by pieces."""

    def __init__(self, path: str, kept: int = KEPT_PIECES):
        self.encode, self.kept = tokenizer(path).encode_batch_fast, kept
        self.known: dict[str, int] = {}

    def pieces(self, text: str) -> list[str]:
        if not text:
            return []
        if _ODD.search(text):
            first, *rest = _SAFE.split(text)
            return [first, *(" " + x for x in rest)]
        out: list[str] = []
        for k, line in enumerate(text.split("\n")):
            words = line.split(" ")
            if k:
                out.append("\n")
            out.append(words[0])
            out.extend([" " + w for w in words[1:]])
        return out

    def count(self, texts: list[str]) -> list[int]:
        split = [self.pieces(x) for x in texts]
        if len(self.known) > self.kept:
            self.known.clear()
        new = list(set().union(*split).difference(self.known))
        lengths = dict(zip(new, (len(e) for e in self.encode(new, add_special_tokens=False))))
        self.known.update(lengths)
        out = [sum(map(self.known.__getitem__, x)) for x in split]
        for x in new:
            if len(x) > LONGEST_KEPT:
                del self.known[x]
        return out


def by_bytes(texts: pa.Array, most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` that end with the text that reaches ``most`` UTF-8 bytes; the last may be smaller."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < len(ends):
        end = min(len(ends), int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + most)) + 1)
        yield begin, end
        begin = end


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit (n_tokens > limit)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(path)
        for batch in batches:
            n: list[int] = []
            for a, b in by_bytes(batch.column(1)):
                n += lengths.count(batch.column(1).slice(a, b - a).fill_null("").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.col(text_col)
    return (
        docs.select(F.col(id_col).alias("id"), text.alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
        .mapInArrow(counted, f"id {kind}, n_bytes long, n_tokens long")
        .select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
