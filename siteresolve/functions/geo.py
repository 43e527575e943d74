"""What a company's locations say about domains, search terms and page text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import COUNTRIES, GENERIC_TLDS
from . import text, urls

_FIELDS = ["code", "names", "tlds", "official", "service"]


def _plain(name: str) -> str:
    """A literal name as ``text.normalized`` makes it."""
    import re

    return " ".join(re.sub("[^a-z0-9]+", " ", re.sub(text.LEGAL_FORMS, " ", text._ascii(name).lower())).split())


def _array(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def profiles(locations: Column) -> Column:
    """The country profiles whose name is part of the locations' text, as structs, in the list's order."""
    every = F.array(
        *[
            F.struct(F.lit(code).alias("code"), _array(names).alias("names"), _array([_plain(n) for n in names]).alias("plain"), _array(tlds).alias("tlds"), _array(official).alias("official"), _array(service).alias("service"))
            for code, names, tlds, official, service in COUNTRIES
        ]
    )
    said = text.normalized(F.array_join(F.coalesce(locations, F.array().cast("array<string>")), " "))
    # a name inside the text counts wherever it stands, as "uk" does in "ukraine"
    return text.let(said, lambda s: F.filter(every, lambda p: F.exists(p["plain"], lambda n: s.contains(n))))


def search_terms(locations: Column) -> Column:
    found = F.transform(profiles(locations), lambda p: F.concat(F.slice(p["official"], 1, 3), F.slice(p["service"], 1, 2)))
    return F.array_distinct(F.flatten(found))


def text_markers(locations: Column) -> Column:
    given = F.coalesce(locations, F.array().cast("array<string>"))
    return F.array_distinct(F.filter(F.concat(F.flatten(F.transform(profiles(locations), lambda p: p["names"])), given), lambda x: x != ""))


def plain_markers(locations: Column) -> Column:
    """The markers in normalized form, without blank ones. The profiles' names are literals that were normalized beforehand."""
    given = F.coalesce(locations, F.array().cast("array<string>"))
    named = F.flatten(F.transform(profiles(locations), lambda p: p["plain"]))
    return F.array_distinct(F.filter(F.concat(named, F.transform(given, lambda x: text.normalized(x))), lambda x: x != ""))


def expected_suffixes(locations: Column) -> Column:
    """The top-level domains of the locations' countries."""
    return F.flatten(F.transform(profiles(locations), lambda p: p["tlds"]))


def suffix_signal(end: Column, expected: Column) -> Column:
    """match, conflict or neutral: a domain's ``urls.suffix`` against the expected ones."""
    known = _array(sorted({t for c in COUNTRIES for t in c[2]}))
    return F.when((end == "") | end.isin(GENERIC_TLDS), "neutral").when(F.array_contains(expected, end), "match").when((F.size(expected) > 0) & F.array_contains(known, end), "conflict").otherwise("neutral")


def domain_signal(name: Column, locations: Column) -> Column:
    """match, conflict or neutral: the domain's country against the locations' countries."""
    return text.let(expected_suffixes(locations), lambda expected: suffix_signal(urls.suffix(name), expected))
