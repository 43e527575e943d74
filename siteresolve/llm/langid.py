"""Language ID by compression: the language whose raw-content dictionary helps zstandard most.

Learning takes a bounded, documented sample. The MOST_LANGUAGES labels with the most learnable rows are
learned (of equal ones the first in alphabetical order); labels beyond are left out. For each at most SAMPLE_TEXTS
rows are chosen (the smallest hash in each of as many hash bins, so every row has its chance), of which
DICTIONARY_BYTES bytes at most make the language's raw-content dictionary. Each of a language's n
chosen rows gives DICTIONARY_BYTES / n characters at most, from a place that a hash of its id names,
and DICTIONARY_BYTES / n bytes of their letters at most. Rows are chosen, not ids, and only their cut
pieces leave the cluster, so what is sent and broadcast is bounded by MOST_LANGUAGES * DICTIONARY_BYTES characters. Prediction takes every
whole text: lower-cased, with everything but letters turned into single spaces, it is cut into pieces of about PIECE bytes (so that a long text can't become its own
dictionary), each piece is compressed with each dictionary, and sizes are summed. The smallest
sum wins; equal sums go to the first language in alphabetical order.

``score`` is min(1, margin * 10), where margin is the part of the best size by which the second
best is larger. A row is rejected (``accepted`` false) when it has no letter or no text, or its
margin is under ``least_margin``.

A letter is what ``str.isalpha`` says: other numbers, as fractions, superscripts or Roman numeral signs, are
none. Null or letterless text: ``und``, score 0. With no labelled rows at all every prediction is
``und``. A row with null id counts as not held out, and isn't learned from. Extra columns are kept by ``classify``, but for those named
as its results, and left out by ``language_id``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import released

SAMPLE_TEXTS = 64
DICTIONARY_BYTES = 128 << 10
PIECE = 1024
#: From held-out texts: of 3358, the 17 with a margin under it are right in 18 of 100 cases, the others in 99.9.
LEAST_MARGIN = 0.02
LEVEL = 6
MOST_LANGUAGES = 200
_OTHER = re.compile(r"[\W\d_]+")
#: Word characters that are no letters, beyond decimal digits and "_". Those up to U+FFFF make a set of their own, which is looked up by bitmap.
_NUMBERS = [c for c in map(chr, range(0x80, 0x110000)) if c.isalnum() and not c.isalpha() and not c.isdecimal()]
_NUMBER = re.compile("[" + "".join(c for c in _NUMBERS if c <= "\uffff") + "]")
_FAR = re.compile("[\U00010000-\U0010ffff]")
_FAR_NUMBERS = {ord(c): " " for c in _NUMBERS if c > "\uffff"}


def letters(text: str) -> bytes:
    """Lower-cased, with everything but letters as single spaces."""
    low = text.lower()
    if not low.isascii():
        low = _NUMBER.sub(" ", low)
        if _FAR.search(low):
            low = low.translate(_FAR_NUMBERS)
    return _OTHER.sub(" ", low).encode()


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def dictionaries(docs: DataFrame, id_col: str = "doc_id", sample_texts: int = SAMPLE_TEXTS, size: int = DICTIONARY_BYTES, most_languages: int = MOST_LANGUAGES) -> dict[str, bytes]:
    """Raw content per language, from labelled rows that aren't held out."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    order = F.xxhash64(id_col, F.lit(11))
    rows = rows.select(F.col("lang").alias("__lang"), F.col(id_col).alias("__id"), "text", order.alias("__order"), F.pmod(order, F.lit(sample_texts)).alias("__bin"))
    counts = rows.groupBy("__lang").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("__bin").alias("bins")).orderBy(F.desc("n"), "__lang").limit(most_languages).collect()
    if not counts:
        return {}
    share = {r["__lang"]: size // r["bins"] for r in counts}
    most = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])[F.col("__lang")]
    place = F.pmod(F.xxhash64("__id", F.lit(13)), F.greatest(F.length("text") - most, F.lit(0)) + 1).cast("int") + 1
    cut = rows.filter(F.col("__lang").isin(list(share))).withColumn("text", F.substring("text", place, most))
    # rows that share an id tie by their text
    chosen = cut.groupBy("__lang", "__bin").agg(F.min_by(F.struct("__id", "text"), F.struct("__order", F.xxhash64("text"))).alias("c"))
    by_lang: dict[str, list[tuple]] = {}
    for r in chosen.select("__lang", "c.*").collect():
        by_lang.setdefault(r["__lang"], []).append((r["__id"], r["text"]))
    # the part nearest the end is the cheapest to refer to; order by id for the same content on every run
    return {lang: b" ".join(letters(x)[: share[lang]] for _, x in sorted(own) if x)[:size] for lang, own in by_lang.items()}


class Compressors:
    def __init__(self, content: dict[str, bytes], level: int = LEVEL):
        import zstandard

        self.langs = sorted(content)
        self.each = []
        for lang in self.langs:
            data = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=level)
            self.each.append(zstandard.ZstdCompressor(level=level, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        raw = letters(text)
        pieces = [raw[k : k + PIECE] for k in range(0, len(raw), PIECE)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.each]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and margin."""
        if not self.langs or not text or not has_letter(text):
            return "und", 0.0
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        rest = [s for k, s in enumerate(sizes) if k != best]
        return self.langs[best], (min(rest) / sizes[best] - 1 if rest else 1.0)


def classify(docs: DataFrame, content: dict[str, bytes], least_margin: float = LEAST_MARGIN, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score, accepted."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Compressors(sent.value)
        for batch in released(batches):
            # one text at a time: a worker never holds a batch's texts a second time
            found = [model.predict(x.as_py()) for x in batch.column(batch.schema.get_field_index(text_col))]
            lang, margin = pa.array([x for x, _ in found], pa.string()), [m for _, m in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lang, pa.array([min(1.0, 10 * m) for m in margin], pa.float64()), pa.array([x != "und" and m >= least_margin for x, m in found], pa.bool_())],
                [*batch.schema.names, "lang_pred", "score", "accepted"],
            )

    kept = docs.drop("lang_pred", "score", "accepted")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{fields}, lang_pred string, score double, accepted boolean")


def language_id(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row: id, held_out, lang_pred, score, accepted. Only the text is an input of a prediction."""
    out = classify(docs.select(id_col, "text"), dictionaries(docs, id_col))
    return out.select(id_col, held_out(F.col(id_col)).alias("held_out"), "lang_pred", "score", "accepted")
