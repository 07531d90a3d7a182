"""Addresses: hosts, paths, kinds of pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What addresses of the kinds of pages look like.
PDF_HINTS = r"\.pdf(?:$|[?#])|/viewcontent\.cgi|/download(?:$|[/?#])|/bitstream/|[?&](?:format|type)=pdf|/dl/"
ARCHIVE_HINTS = r"archive|back-?issues|all_issues|past-issues"
ISSUE_HINTS = r"/(?:vol|volume)[-_]?\d+/(?:iss|issue|no)[-_]?\d+/?$|/issue/view|current-issue"
ARTICLE_HINTS = r"/(?:vol|volume)[-_]?\d+/(?:iss|issue|no)[-_]?\d+/[^/]+/?$|/article/|abstract"


def host(url: Column) -> Column:
    """Host in lower case without port and ``www.``; a text that is no address is taken for a host."""
    raw = F.regexp_replace(F.lower(F.trim(url)), r"^[a-z][a-z0-9+.-]*://", "")
    return F.regexp_replace(F.regexp_replace(raw, r"[/:?#].*$", ""), r"^www\.", "")


def path(url: Column) -> Column:
    bare = F.regexp_replace(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    return F.regexp_replace(bare, r"[?#].*$", "")


def slug(url: Column) -> Column:
    """First part of the path in lower case."""
    return F.lower(F.regexp_extract(path(F.coalesce(url, F.lit(""))), r"^/*([^/]+)", 1))


def query_value(url: Column, key: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), rf"[?&]{key}=([^&#]+)", 1))


def without_fragment(url: Column) -> Column:
    return F.regexp_replace(F.trim(url), "#.*$", "")


def is_pdf(url: Column) -> Column:
    return F.coalesce(F.lower(url).rlike(PDF_HINTS), F.lit(False))


def url_class(url: Column, anchor: Column | None = None) -> Column:
    """pdf, archive, issue, article or other; the address tells a PDF, path and anchor the rest."""
    seen = F.lower(F.concat_ws(" ", path(url), anchor) if anchor is not None else path(url))
    return F.when(is_pdf(url), "pdf").when(seen.rlike(ARCHIVE_HINTS), "archive").when(seen.rlike(ISSUE_HINTS), "issue").when(seen.rlike(ARTICLE_HINTS), "article").otherwise("other")


def template(url: Column) -> Column:
    """Path with every number as ``{n}``."""
    return F.regexp_replace(path(url), r"[0-9]+", "{n}")


def galley_download(url: Column) -> Column:
    """Address of the download of a galley's view; others as they are."""
    return F.regexp_replace(url, r"/article/view/([0-9]+)/([0-9]+)", "/article/download/$1/$2")


def expanded_ranges(url: Column) -> Column:
    """Addresses with ``[a-b]`` in them, one for each number; those without or with a > b as they are."""
    low, high = F.regexp_extract(url, r"\[([0-9]{1,6})-[0-9]{1,6}\]", 1).try_cast("int"), F.regexp_extract(url, r"\[[0-9]{1,6}-([0-9]{1,6})\]", 1).try_cast("int")
    each = F.transform(F.sequence(low, F.greatest(low, high)), lambda n: F.regexp_replace(url, r"\[[0-9]+-[0-9]+\]", n.cast("string")))
    return F.when(low.isNotNull() & (low <= high), each).otherwise(F.array(url))


def path_domain(pdf_path: Column) -> Column:
    """First part of a path that has a dot and is no PDF, else ``unknown``."""
    part = F.filter(F.split(F.lower(pdf_path), "/"), lambda p: p.contains(".") & ~p.endswith(".pdf"))
    return F.coalesce(F.get(part, F.lit(0)), F.lit("unknown"))
