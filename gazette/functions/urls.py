"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def domain(url: Column) -> Column:
    """Host in lower case without ``www.`` and port; null where there is none."""
    host = F.regexp_extract(F.lower(url), r"^https?://([^/?#:]+)", 1)
    return F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^https?://[^/?#]+(/[^?#]*)", 1)


def canonical_key(url: Column) -> Column:
    """Scheme, host and path without query, fragment and last slash."""
    return F.regexp_replace(F.regexp_replace(F.trim(url), r"[?#].*$", ""), r"/+$", "")


def is_http(url: Column) -> Column:
    return F.coalesce(url.rlike(r"^https?://[^/?#]+"), F.lit(False))


#: Paths of front and section pages.
GENERIC = ("", "/news", "/world", "/business", "/technology", "/research-highlights")


def reject_reason(url: Column, generic: tuple[str, ...] = GENERIC, sites: tuple[tuple[str, str, str], ...] = ()) -> Column:
    """bad_url, generic_url, incomplete_url or null.

    Incomplete are addresses that end with a question mark or with an id, article or story without a value, and those of
    ``sites`` (end of the host, end of the path, parameter) without a value of the parameter.
    """
    host, where = F.regexp_extract(F.lower(url), r"^https?://([^/?#]+)", 1), F.regexp_replace(path(url), r"/+$", "")
    incomplete = url.rlike(r"\?$") | url.rlike(r"[?&](id|article|story)=?$")
    for site, end, key in sites:
        incomplete = incomplete | (F.endswith(host, F.lit(site)) & F.endswith(path(url), F.lit(end)) & ~url.rlike(rf"[?&]{key}=[^&#]"))
    return F.when(~is_http(url), "bad_url").when(where.isin(*generic), "generic_url").when(incomplete, "incomplete_url")


def suffixes(host: Column) -> Column:
    """The host and all domains above it, so that a sub-domain match becomes an equality join."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def resolved(link: Column, page: Column) -> Column:
    """An address as it stands on a page: whole, without scheme, from the root, or beside the page (``./`` and ``../`` steps taken)."""
    scheme, root = F.regexp_extract(page, r"^(https?):", 1), F.regexp_extract(page, r"^https?://[^/?#]+", 0)
    folder = F.regexp_replace(F.regexp_replace(page, r"[?#].*$", ""), r"(?<=[^/:])/[^/]*$", "")
    joined = F.concat(F.when(F.length(folder) > F.length(root), folder).otherwise(root), F.lit("/"), F.regexp_replace(link, r"^(?:\./)+", ""))
    for _ in range(4):  # each pass takes one step up
        joined = F.regexp_replace(joined, r"(?<=[^/:])/(?:(?!\.\.)[^/?#]+)/\.\./", "/")
    joined = F.regexp_replace(joined, r"^(https?://[^/?#]+)(?:/\.\.)+(?=/)", "$1")
    return (
        F.when(link.rlike("(?i)^https?://"), link).when(link.startswith("//"), F.concat(scheme, F.lit(":"), link)).when(link.startswith("/"), F.concat(root, link))
        .when(link.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), F.lit(None)).when(link.startswith("?"), F.concat(F.regexp_replace(page, r"[?#].*$", ""), link)).when(link.startswith("#"), F.regexp_replace(page, "#.*$", "")).when(link != "", joined)
    )


def same_site(a: Column, b: Column) -> Column:
    """Whether two hosts are one, or one is below the other."""
    return F.coalesce((a == b) | F.endswith(a, F.concat(F.lit("."), b)) | F.endswith(b, F.concat(F.lit("."), a)), F.lit(False))
