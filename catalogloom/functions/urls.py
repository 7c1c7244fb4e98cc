"""URL handling as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that end a URL inside a sentence.
TRAILING_PUNCTUATION = ".,;)"


def url_part(url: Column, part: str, key: str | None = None) -> Column:
    args = [url, F.lit(part)] + ([F.lit(key)] if key else [])
    return F.try_parse_url(*args)


def host(url: Column) -> Column:
    """Lower-case host without port; null when there is none."""
    raw = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(raw, F.lit(""))


def path(url: Column) -> Column:
    """Path of an absolute or relative reference, without query and fragment."""
    rest = F.regexp_replace(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*", "")
    return F.regexp_extract(rest, r"^([^?#]*)", 1)


def query_value(url: Column, key: str) -> Column:
    """First value of a query parameter, or null."""
    found = F.regexp_extract(url, rf"[?&]{key}=([^&#]*)", 1)
    return F.nullif(found, F.lit(""))


def absolute(base: Column, href: Column) -> Column:
    """Resolve a link against the page it stands on.

    Handles escaped slashes, scheme-relative, root-relative, query-only,
    fragment-only and directory-relative references.
    """
    link = F.replace(href, F.lit("\\/"), F.lit("/"))
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    base_path = path(base)
    folder = F.regexp_extract(F.when(base_path == "", F.lit("/")).otherwise(base_path), r"^(.*/)", 1)
    joined = (
        F.when(link == "", F.lit(""))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"),
              F.concat(F.when(scheme == "", F.lit("https")).otherwise(scheme), F.lit(":"), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link.startswith("?"), F.concat(origin, base_path, link))
        .when(link.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), link))
        .otherwise(F.concat(origin, folder, F.regexp_replace(link, r"^(?:\./)+", ""))))
    return joined


def is_web_url(url: Column) -> Column:
    return F.coalesce(url.rlike(r"(?i)^https?://[^/?#\s]+"), F.lit(False))


def first_web_url(c: Column) -> Column:
    """First http(s) URL inside a composite field, without sentence punctuation."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(?i)(https?://[^\s]+)"), 1)
    trimmed = F.transform(found, lambda u: F.rtrim(u, F.lit(TRAILING_PUNCTUATION)))
    return F.get(F.filter(trimmed, is_web_url), F.lit(0))


def host_allowed(url: Column, allowed_suffixes: list[str]) -> Column:
    """True when the host is one of the names or below one of them."""
    h = host(url)
    ok = F.lit(False)
    for suffix in allowed_suffixes:
        ok = ok | (h == suffix) | h.endswith("." + suffix)
    return F.coalesce(ok, F.lit(False))


def listing_url(base: Column, page: Column, style: str, page_size: int = 50) -> Column:
    """Address of a listing page: ``path`` (/p2/), ``query`` (?p=2) or ``offset`` (&start=50).

    Page 1 has no suffix.
    """
    root = F.regexp_replace(base, r"/+$", "")
    number = page.cast("string")
    later = {
        "path": F.concat(root, F.lit("/p"), number, F.lit("/")),
        "query": F.concat(root, F.lit("/?p="), number),
        "offset": F.concat(base, F.lit("&start="), ((page - 1) * page_size).cast("string")),
    }[style]
    first = base if style == "offset" else F.concat(root, F.lit("/"))
    return F.when(page > 1, later).otherwise(first)


def id_list(c: Column, default: list[int]) -> Column:
    """``"7, 3,7"`` to distinct ids in order; an empty text means the default list."""
    ids = F.transform(F.filter(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x) != ""),
                      lambda x: F.trim(x).cast("int"))
    return F.when(F.size(ids) > 0, F.array_distinct(ids)).otherwise(F.array(*map(F.lit, default)))
