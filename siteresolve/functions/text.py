"""Text and name functions: Column in, Column out, all inside the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal forms, longest first where one begins another.
LEGAL_FORMS = (
    r"\b(private limited|pvt ltd|pvt\. ltd\.|pte ltd|pte\. ltd\.|sp\.?\s*z\s*o\.?\s*o\.?|s\.?\s*r\.?\s*l\.?|"
    r"limited|ltd|llc|llp|inc|corp|corporation|gmbh|sarl|aps|srl|sl|sas|ag|bv|plc|oy|ab|co\.?|company)\b"
)


def _ascii(c: str) -> str:
    return unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()


def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Characters beyond ASCII whose compatibility form has ASCII in it: those with one ASCII character, and those with more."""
    beyond = [chr(k) for k in range(0x80, 0x110000) if not 0xD800 <= k < 0xE000]
    folded = {c: a for c in beyond if (a := _ascii(c))}
    single = [c for c in folded if len(folded[c]) == 1]
    return "".join(single), "".join(folded[c] for c in single), {c: a for c, a in folded.items() if len(a) > 1}


_FROM, _TO, _MORE = _fold_tables()


def fold(c: Column) -> Column:
    """Compatibility decomposition with everything but ASCII dropped. Text in ASCII is passed on untouched."""
    several = F.str_to_map(F.lit("\u0001".join(f"{k}\u0002{v}" for k, v in _MORE.items())), F.lit("\u0001"), F.lit("\u0002"))
    spread = F.array_join(F.transform(F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0)), lambda x: F.coalesce(F.try_element_at(several, x), x)), "")
    has_several = F.translate(c, "".join(_MORE), "") != c
    wide = F.regexp_replace(F.translate(F.when(has_several, spread).otherwise(c), _FROM, _TO), r"[^\x00-\x7F]", "")
    return F.when(c.rlike(r"[^\x00-\x7F]"), wide).otherwise(c)


def blank(c: Column) -> Column:
    """Null as the empty string."""
    return F.coalesce(c, F.lit(""))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once however often it is used; keeps large expressions small."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def compact(c: Column) -> Column:
    return F.trim(F.regexp_replace(blank(c), r"(?U)\s+", " "))


def normalized(c: Column) -> Column:
    """ASCII-folded, lower-cased, without legal forms and punctuation."""
    low = F.regexp_replace(F.lower(fold(blank(c))), LEGAL_FORMS, " ")
    return F.trim(F.regexp_replace(low, "[^a-z0-9]+", " "))


def slug(c: Column) -> Column:
    return F.regexp_replace(normalized(c), "[^a-z0-9]+", "")


def tokens_of(norm: Column) -> Column:
    """Words of three or more letters of a normalized text, repeats kept."""
    return F.filter(F.split(norm, " "), lambda x: F.length(x) >= 3)


def similarity(a: Column, b: Column) -> Column:
    """0 to 100 between two normalized texts: 100 if one contains the other, else the Jaccard index of their words; 0 if one is blank."""
    words = [F.array_remove(F.split(x, " "), "") for x in (a, b)]
    both, either = F.size(F.array_intersect(*words)), F.size(F.array_union(*words))
    jaccard = F.when(either > 0, both * 100.0 / either).otherwise(0.0)
    return F.when((a == "") | (b == ""), F.lit(0.0)).when(a.contains(b) | b.contains(a), F.lit(100.0)).otherwise(jaccard)


def append_note(notes: Column, note: Column) -> Column:
    return F.when(blank(notes) == "", note).otherwise(F.concat(notes, F.lit("; "), note))


def whole_number(c: Column) -> Column:
    """int(float(x)) with 0 for anything else."""
    return F.coalesce(c.try_cast("double").try_cast("int"), F.lit(0))


def first_filled(*cols: Column) -> Column:
    """The first of the columns that isn't blank, else the empty string."""
    return F.coalesce(*[F.when(F.trim(blank(c)) != "", c) for c in cols], F.lit(""))


def cell_url(c: Column) -> Column:
    """The address inside a HYPERLINK("address", ...) cell, in any case and with or without a leading =; blank if such a cell has none. Other cells as they are, without a leading =."""
    bare = F.regexp_replace(F.trim(blank(c)), "^=", "")
    return F.when(bare.rlike(r"(?i)^HYPERLINK\("), F.trim(F.regexp_extract(bare, r'(?i)HYPERLINK\("([^"]+)"', 1))).otherwise(bare)


def json_list(c: Column) -> Column:
    """A JSON array of strings; anything else is an empty array."""
    return F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))


def fuzzy_hash_share(a: Column, b: Column) -> Column:
    """Share of equal characters of two hash strings of one length, else 0."""
    same = F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)))
    return F.when((F.length(a) == F.length(b)) & (F.length(a) > 0), same / F.length(a)).otherwise(F.lit(0.0))
