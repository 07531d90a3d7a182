"""Expressions over acquisition records: keys, years, partial dates, platforms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import urls

# Platforms and the spellings they go by.
PLATFORMS = {
    "digital_commons": ("digitalcommons", "bepress", "elsevierdigitalcommons"), "ojs": ("ojs", "openjournalsystems", "pkp"), "wordpress": ("wordpress", "wordpressacademic", "wp"),
    "drupal": ("drupal",), "scholastica": ("scholastica",), "janeway": ("janeway",), "quartex": ("quartex",), "dspace": ("dspace",), "squarespace": ("squarespace",),
}


def text(c: Column) -> Column:
    """Trimmed text, empty for NULL."""
    return F.coalesce(F.trim(c), F.lit(""))


def filled(c: Column) -> Column:
    """Trimmed text, NULL for empty."""
    return F.nullif(F.trim(c), F.lit(""))


def author_text(authors: Column) -> Column:
    return F.coalesce(F.array_join(F.filter(F.transform(authors, lambda x: F.trim(x)), lambda a: a != ""), "; "), F.lit(""))


def year(*sources: Column) -> Column:
    """The first year from 1800 on in the first source that has one, else empty."""
    one = lambda c: F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"\b((?:18|19|20)\d{2})\b", 1), F.lit(""))
    return F.coalesce(*[one(c) for c in sources], F.lit(""))


def article_key(m: Column, pdf_url: Column, page_url: Column) -> Column:
    """Identity of an article: its address, DOI, title with place, PDF or page."""
    low = lambda c: F.lower(text(c))
    dated = F.coalesce(filled(m["date"]), filled(m["year"]), F.lit(""))
    title = F.concat(F.lit("title:"), low(m["title"]), F.lit("|vol:"), low(m["volume"]), F.lit("|iss:"), low(m["issue"]), F.lit("|date:"), F.lower(dated), F.lit("|auth:"), F.lower(author_text(m["authors"])))
    return (
        F.when(text(m["url"]) != "", F.concat(F.lit("url:"), low(m["url"])))
        .when(text(m["doi"]) != "", F.concat(F.lit("doi:"), low(m["doi"])))
        .when(text(m["title"]) != "", title)
        .when(text(pdf_url) != "", F.concat(F.lit("pdf:"), low(pdf_url)))
        .otherwise(F.concat(F.lit("page:"), low(page_url)))
    )


def article_identity(m: Column, pdf_url: Column, page_url: Column) -> Column:
    """Identity of an article in exports, which knows no authors and takes pages before PDFs."""
    low = lambda c: F.lower(text(c))
    dated = F.coalesce(filled(m["year"]), filled(m["date"]), F.lit(""))
    title = F.concat(F.lit("title:"), low(m["title"]), F.lit("|v:"), low(m["volume"]), F.lit("|i:"), low(m["issue"]), F.lit("|y:"), F.lower(dated))
    return (
        F.when(text(m["url"]) != "", F.concat(F.lit("url:"), low(m["url"])))
        .when(text(m["doi"]) != "", F.concat(F.lit("doi:"), low(m["doi"])))
        .when(text(m["title"]) != "", title)
        .otherwise(F.lower(F.coalesce(filled(page_url), filled(pdf_url), F.lit(""))))
    )


def document_id(sha256: Column, path: Column) -> Column:
    return F.substring(F.sha1(F.coalesce(F.nullif(sha256, F.lit("")), path, F.lit(""))), 1, 24)


def issue_key(journal: Column, domain: Column, volume: Column, issue: Column, yr: Column) -> Column:
    parts = [F.lower(text(c)) for c in (journal, domain, volume, issue, yr)]
    some = (parts[2] != "") | (parts[3] != "") | (parts[4] != "")
    return F.when(some, F.concat_ws("|", *parts)).otherwise("")


def slug_key(name: Column) -> Column:
    key = F.regexp_replace(F.regexp_replace(F.lower(text(name)), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")
    return F.coalesce(F.nullif(key, F.lit("")), F.lit("unknown"))


def platform(label: Column) -> Column:
    key = F.regexp_replace(F.lower(F.coalesce(label, F.lit(""))), "[^a-z0-9]+", "")
    out = F.when(key == "", "unknown")
    for name, spellings in PLATFORMS.items():
        out = out.when(key.isin(*spellings), name)
    return out.otherwise(F.regexp_replace(F.lower(F.trim(label)), r"[^a-z0-9]+", "_"))


def contexts(pdf_url: Column, page_url: Column, meta_url: Column, set_spec: Column) -> Column:
    """Ordered distinct hints of the journal: set, query values and first parts of paths."""
    hints = [F.regexp_replace(F.lower(text(set_spec)), r"^.*:", "")]
    for u in (pdf_url, page_url, meta_url):
        hints += [urls.query_value(u, k) for k in ("context", "publication", "collection")]
        s = urls.slug(u)
        hints.append(F.when(~s.endswith(".cgi"), s).otherwise(""))
    return F.array_distinct(F.filter(F.array(*hints), lambda h: h != ""))


MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]


def partial_date(value: Column) -> Column:
    """struct<normalized, start, end, year>: a date of year, month or day precision.

    ``start`` and ``end`` are numbers yyyymmdd; a month ends on day 31 and a
    year on December 31, so that they order as intervals. NULL if none is found.
    """
    plain = F.regexp_replace(F.lower(text(value)), r"(\d)(?:st|nd|rd|th)\b", "$1")
    plain = F.trim(F.regexp_replace(plain, r"\s+", " "))
    # bound to a name, so that the text is cleaned once and not for each pattern
    return F.get(F.transform(F.array(plain), _dated), F.lit(0))


def _dated(t: Column) -> Column:
    dashed = F.translate(t, "/.", "--")
    num = lambda pattern, i, src=dashed: F.regexp_extract(src, pattern, i).try_cast("int")
    full, ym = r"\b((?:19|20)\d{2})-(\d{1,2})-(\d{1,2})\b", r"\b((?:19|20)\d{2})-(\d{1,2})\b"
    month = lambda pattern, i: F.nullif(F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), F.substring(F.regexp_extract(t, pattern, i), 1, 3)).cast("int"), F.lit(0))
    name = r"(" + "|".join(f"{m}|{m[:3]}" for m in MONTHS) + r")"
    dmy, mdy, my = rf"^(\d{{1,2}}) {name} (\d{{4}})$", rf"^{name} (\d{{1,2}}), (\d{{4}})$", rf"^{name} (\d{{4}})$"
    day_ok = lambda m, d: m.between(1, 12) & d.between(1, 31)
    made = lambda y, m, d: F.struct(
        F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0")).alias("normalized"),
        (y * 10000 + F.coalesce(m, F.lit(1)) * 100 + F.coalesce(d, F.lit(1))).alias("start"),
        (y * 10000 + F.coalesce(m, F.lit(12)) * 100 + F.coalesce(d, F.lit(31))).alias("end"),
        y.alias("year"),
    )
    none = F.lit(None).cast("int")
    parts = (
        F.when(day_ok(num(full, 2), num(full, 3)), F.array(num(full, 1), num(full, 2), num(full, 3)))
        .when(num(ym, 2).between(1, 12), F.array(num(ym, 1), num(ym, 2), none))
        .when(day_ok(month(dmy, 2), num(dmy, 1, t)), F.array(num(dmy, 3, t), month(dmy, 2), num(dmy, 1, t)))
        .when(day_ok(month(mdy, 1), num(mdy, 2, t)), F.array(num(mdy, 3, t), month(mdy, 1), num(mdy, 2, t)))
        .when(month(my, 1).isNotNull(), F.array(num(my, 2, t), month(my, 1), none))
        .when(num(r"\b((?:19|20)\d{2})\b", 1, t).isNotNull(), F.array(num(r"\b((?:19|20)\d{2})\b", 1, t), none, none))
    )
    # bound to a name, so that the parts are found once and not for each field
    bound = F.transform(F.array(parts), lambda p: F.when(p.isNotNull(), made(F.get(p, F.lit(0)), F.get(p, F.lit(1)), F.get(p, F.lit(2)))))
    return F.get(bound, F.lit(0))


def completeness(m: Column) -> Column:
    """Share of title, authors, volume, year and address that are given, two digits."""
    flags = [text(m["title"]) != "", F.coalesce(F.size(m["authors"]), F.lit(0)) > 0, text(m["volume"]) != "", F.coalesce(filled(m["year"]), filled(m["date"])).isNotNull(), text(m["url"]) != ""]
    total = flags[0].cast("int")
    for f in flags[1:]:
        total = total + F.coalesce(f.cast("int"), F.lit(0))
    return F.round(total / F.lit(5.0), 2)


def error_class(status: Column, state: Column) -> Column:
    """Class of a failed attempt by state and status."""
    return (
        F.when((state == "blocked") | status.isin(403, 429), "waf")
        .when(status == 404, "not_found").when(status >= 500, "server").when(status.isNull() | (status == 0), "network").otherwise("other")
    )


def is_retryable(kind: Column) -> Column:
    return kind.isin("server", "network", "other")
