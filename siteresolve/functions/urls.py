"""URL functions: Column in, Column out. The variants differ on purpose; jobs name the one they need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank, let

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*://"
RISKY_SEGMENTS = ["app", "apps", "auth", "login", "password", "sign-in", "signin", "user", "users"]
URL_LIKE = (
    r"(?i)(https?://[^\s\"'<>]+|www\.[^\s\"'<>]+|[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?(?:\.[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?)*"
    r"\.(?:com|co|io|net|org|de|fr|it|es|in|pk|uk|nl|pl|ae|ca|au|us|cn|jp|sg|br|mx|tr|eu)\b)"
)


def _full(url: Column) -> Column:
    clean = F.regexp_replace(F.regexp_replace(blank(url), r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    return F.regexp_replace(clean, r"^(?![\s\S]*://)", "https://")


def host_part(url: Column) -> Column:
    """What stands between // and the path, with user and port."""
    return F.regexp_extract(_full(url), _SCHEME + r"([^/?#]*)", 1)


def path_part(url: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(_full(url), _SCHEME + r"[^/?#]*", ""), r"^[^?#]*", 0)


def domain(url: Column) -> Column:
    """Host without user, port, outer dots and www.; the path where there is no host; blank for broken brackets."""
    host_or_path = F.regexp_extract(_full(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://(?![/?#]|$))?((?<=//)[^/?#]*|(?<!//)[^?#]*)", 1)
    at = F.regexp_replace(F.lower(host_or_path), r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    bare = F.regexp_replace(F.regexp_replace(at, r"^[\s\S]*@|:(?![\s\S]*@)[\s\S]*$", ""), r"^\.+|\.+$", "")
    return F.regexp_replace(F.when(at.rlike(r"^[^\[]*\]|\[[^\]]*$"), F.lit("")).otherwise(bare), r"^www\.", "")


def base_label(name: Column, is_domain: bool = False) -> Column:
    """The registrable label: a.b.co.uk -> b. ``is_domain``: the name is a ``domain`` already."""

    def label(parts: Column) -> Column:
        n = F.size(parts)
        second = F.get(parts, n - 2)
        return F.when((n >= 3) & second.isin("co", "com", "net", "org"), F.get(parts, n - 3)).when(n >= 2, second).otherwise(F.get(parts, F.lit(0)))

    return let(F.split(name if is_domain else domain(name), r"\."), label)


def suffix(name: Column) -> Column:
    """Top-level domain; the last two labels where the second-level one is co, com, net or org."""
    parts = F.split(F.regexp_replace(F.lower(blank(name)), r"^\.+|\.+$", ""), r"\.")
    n = F.size(parts)
    last, second = F.get(parts, n - 1), F.get(parts, n - 2)
    return F.when(n < 2, F.lit("")).when((n >= 3) & second.isin("co", "com", "net", "org"), F.concat_ws(".", second, last)).otherwise(last)


def mentioned(text: Column) -> Column:
    """URL-like strings in a text, in order, without closing punctuation."""
    return F.transform(F.regexp_extract_all(blank(text), F.lit(URL_LIKE), F.lit(1)), lambda u: F.regexp_replace(u, r"[.,);\]]+$", ""))


def delivered(url: Column) -> Column:
    """For delivery: with a scheme, without closing punctuation; log-in pages become the home page."""
    bare = F.regexp_replace(F.trim(blank(url)), r"[.,);\]]+$", "")

    def home(full: Column) -> Column:
        first = F.lower(F.regexp_extract(full, r"^[^:]*://[^/?#]*/+([^/?#]*)", 1))
        return F.when(first.isin(RISKY_SEGMENTS), F.concat(F.regexp_extract(full, r"^([^:]*://[^/?#]*)", 1), F.lit("/"))).otherwise(full)

    return let(F.regexp_replace(F.regexp_replace(bare, "^//", "https://"), r"^(?=[\s\S])(?![\s\S]*://)", "https://"), home)


def compared(url: Column) -> Column:
    """For evaluation: scheme, host as given and path only, no trailing slash, closing punctuation or non-breaking spaces; blank without a host."""
    bare = F.regexp_replace(F.replace(F.trim(blank(url)), F.lit("\u00a0"), F.lit("")), r"[.,);\]]+$", "")
    scheme = F.lower(F.coalesce(F.nullif(F.regexp_extract(_full(bare), r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1), F.lit("")), F.lit("https")))
    path = F.regexp_replace(path_part(bare), ";[^/]*$", "")
    return F.when(host_part(bare) == "", F.lit("")).otherwise(F.regexp_replace(F.concat(scheme, F.lit("://"), host_part(bare), path), "/+$", ""))


def site_key(url: Column) -> Column:
    """host/path without www. and trailing slash; blank if there is no host."""
    host = F.regexp_replace(F.lower(host_part(F.trim(blank(url)))), r"^www\.", "")
    return F.when(F.trim(blank(url)) == "", F.lit("")).otherwise(F.regexp_replace(F.concat(host, path_part(F.trim(blank(url)))), "/+$", ""))


def same_site(a: Column, b: Column) -> Column:
    return (site_key(a) != "") & (site_key(a) == site_key(b))


def same_registrable(a: Column, b: Column) -> Column:
    """The last two host labels agree."""
    ends = [F.slice(F.filter(F.split(domain(x), r"\."), lambda p: p != ""), F.greatest(F.size(F.filter(F.split(domain(x), r"\."), lambda p: p != "")) - 1, F.lit(1)), F.lit(2)) for x in (a, b)]
    return (F.size(ends[0]) > 0) & (ends[0] == ends[1])


def roots(url: Column) -> Column:
    """Home pages to try, in order: the given scheme, then https and http; the host as given, then with or without www."""
    host = F.when(host_part(url) != "", host_part(url)).otherwise(F.regexp_extract(path_part(url), "^[^/]*", 0))
    other = F.when(host.startswith("www."), F.regexp_replace(host, r"^www\.", "")).otherwise(F.concat(F.lit("www."), host))
    given = F.coalesce(F.nullif(F.lower(F.regexp_extract(_full(url), r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1)), F.lit("")), F.lit("https"))
    made = F.array(*[F.concat(s, F.lit("://"), h) for s in (given, F.lit("https"), F.lit("http")) for h in (host, other)])
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(made))


def excluded(name: Column, patterns: list[str], is_domain: bool = False) -> Column:
    """A blank domain, a listed one, below a listed one, or with a listed label. ``is_domain``: the name is a ``domain`` already."""
    labels = F.array(*[F.lit(p.rstrip(".")) for p in patterns if p.endswith(".")])
    listed = F.array(*[F.lit(p) for p in patterns if not p.endswith(".")])

    def hit(parts: Column) -> Column:
        parents = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))
        return (parts == F.array(F.lit(""))) | F.arrays_overlap(parents, listed) | F.arrays_overlap(parts, labels)

    return let(F.split(name if is_domain else domain(name), r"\."), hit)
