"""Pages of HTML and XML: links, signs of platforms, notes, sitemaps.

What regular expressions express runs as Column expressions; what needs a
document tree runs in Arrow UDFs over the standard library's parser. NULL and
broken pages have no links and no notes.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from corpusloom.functions import urls as U

# What pages of the platforms contain.
PLATFORM_SIGNS = {
    "digital_commons": r"bepress|digital commons|viewcontent\.cgi", "ojs": r"open journal systems|pkp_|/index\.php/[^/]+/issue", "wordpress": r"wp-content|wp-json|wordpress",
    "drupal": r"drupal-settings-json|sites/default/files|x-drupal", "scholastica": r"scholasticahq", "janeway": r"janeway", "quartex": r"quartex", "squarespace": r"squarespace",
}


class _Reader(HTMLParser):
    """Links with their texts, notes of lists and of elements with a note's id, and the title."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.links, self.notes, self.title, self.meta = [], [], "", {}
        self._open, self._note, self._in_title = None, None, False

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "a" and a.get("href"):
            self._open = [a["href"], ""]
        if tag == "title":
            self._in_title = True
        if tag == "meta" and a.get("name"):
            self.meta.setdefault(a["name"].lower(), a.get("content", ""))
        if tag in ("li", "p", "div", "aside") and (m := re.match(r"(?:fn|footnote|note|_ftn|ftn)[-_:]?(\d+)$", a.get("id", ""), re.I)):
            self._note = [m[1], "", tag]

    def handle_endtag(self, tag):
        if tag == "a" and self._open:
            self.links.append((self._open[0], " ".join(self._open[1].split())))
            self._open = None
        if tag == "title":
            self._in_title = False
        if self._note and tag == self._note[2]:
            self.notes.append((self._note[0], " ".join(self._note[1].replace("↩", " ").split())))
            self._note = None

    def handle_data(self, data):
        if self._open:
            self._open[1] += data
        if self._note:
            self._note[1] += data
        if self._in_title:
            self.title += data


def read_page(page: str | None) -> _Reader:
    reader = _Reader()
    try:
        reader.feed(page or "")
        reader.close()
    except Exception:
        pass
    return reader


_LINK = ArrayType(StructType([StructField("url", StringType()), StructField("anchor", StringType())]))
_NOTE = ArrayType(StructType([StructField("label", StringType()), StructField("text", StringType())]))


@F.pandas_udf(_LINK)
def links(page: pd.Series, base: pd.Series) -> pd.Series:
    """Absolute addresses without fragments, with the text of their anchors, each once."""

    def one(p, b):
        seen = {}
        for href, text in read_page(p).links:
            try:
                url = urljoin(b or "", href).split("#", 1)[0].strip()
            except ValueError:
                continue
            if re.match("https?://", url):
                seen.setdefault(url, text)
        return [{"url": u, "anchor": t} for u, t in seen.items()]

    return pd.Series([one(p, b) for p, b in zip(page, base)], dtype=object)


@F.pandas_udf(_NOTE)
def notes(page: pd.Series) -> pd.Series:
    """Notes by number, the first of each label."""

    def one(p):
        seen = {}
        for label, text in read_page(p).notes:
            seen.setdefault(label, re.sub(rf"^\[?{label}\]?[.):]?\s*", "", text))
        return [{"label": k, "text": seen[k]} for k in sorted(seen, key=int)]

    return pd.Series([one(p) for p in page], dtype=object)


_META = StructType([StructField(n, StringType()) for n in ("title", "citation_title", "citation_author", "citation_date", "citation_pdf_url")])


@F.pandas_udf(_META)
def metadata(page: pd.Series) -> pd.DataFrame:
    """Title and citation tags of a page."""
    rows = []
    for p in page:
        r = read_page(p)
        rows.append((" ".join(r.title.split()) or None, r.meta.get("citation_title"), r.meta.get("citation_author"), r.meta.get("citation_date") or r.meta.get("citation_publication_date"), r.meta.get("citation_pdf_url")))
    return pd.DataFrame(rows, columns=["title", "citation_title", "citation_author", "citation_date", "citation_pdf_url"])


def classified_links(pages: DataFrame) -> DataFrame:
    """(url, link, anchor, kind): links of pages (url, html) with the kind of page they lead to."""
    l = pages.select("url", F.explode(links("html", "url")).alias("l"))  # noqa: E741
    return l.select("url", F.col("l.url").alias("link"), F.col("l.anchor").alias("anchor"), U.url_class(F.col("l.url"), F.col("l.anchor")).alias("kind"))


def needs_script(page: Column) -> Column:
    """Whether a page shows little without scripts: it says so, or has many scripts and hardly a link."""
    p = F.lower(F.coalesce(page, F.lit("")))
    anchors, scripts = F.regexp_count(p, F.lit(r"<a\s[^>]*href")), F.regexp_count(p, F.lit("<script"))
    return p.contains("enable javascript") | ((anchors == 0) & (scripts >= 10)) | (p.rlike(r"id=[\"']root[\"']") & (scripts >= 5) & (anchors <= 2))


def platform(page: Column) -> Column:
    """The first platform whose signs a page has, else ``unknown``."""
    p = F.lower(F.coalesce(page, F.lit("")))
    out = F.when(p == "", "unknown")
    for name, sign in PLATFORM_SIGNS.items():
        out = out.when(p.rlike(sign), name)
    return out.otherwise("unknown")


def sitemap_locations(content: Column) -> Column:
    """struct<is_index, locations> of a sitemap or an index of sitemaps."""
    c = F.coalesce(content, F.lit(""))
    found = F.filter(F.transform(F.regexp_extract_all(c, F.lit(r"<loc>\s*([^<]*?)\s*</loc>"), F.lit(1)), lambda u: F.replace(u, F.lit("&amp;"), F.lit("&"))), lambda u: u != "")
    return F.struct(c.contains("<sitemapindex").alias("is_index"), found.alias("locations"))


#: What leads to a journal's archive, in an address or the text of a link.
ARCHIVE = r"archive|all[-_ ]?issues|past[-_ ]?issues|back[-_ ]?issues|volumes|/issue"


def archive_candidates(pages: DataFrame) -> DataFrame:
    """(url, link, place): links of a page to archives on its own host, each once, in the order of the page."""
    l = pages.select("url", F.posexplode(links("html", "url")).alias("at", "l"))  # noqa: E741
    own = U.host(F.col("l.url")) == U.host(F.col("url"))
    l = l.where(own & (F.lower("l.url").rlike(ARCHIVE) | F.lower("l.anchor").rlike(ARCHIVE)))  # noqa: E741
    return l.select("url", F.col("l.url").alias("link"), (F.row_number().over(Window.partitionBy("url").orderBy("at"))).alias("place"))


def page_addresses(maps: DataFrame) -> DataFrame:
    """(host, address): pages that the sitemaps (host, content) of a host name on that host, sorted out and each once; indexes name none."""
    s = maps.select("host", sitemap_locations(F.col("content")).alias("s")).where("not s.is_index").select("host", F.explode("s.locations").alias("address"))
    return s.where((U.host(F.col("address")) == F.col("host")) & ~F.lower("address").rlike(r"\.(?:css|js|png|jpe?g|gif|svg|ico)$")).distinct()


def resolved_platform(page: Column, url: Column, listed: Column) -> Column:
    """The platform of a site by what its page shows, then by its address, then as it is listed, else ``unknown``."""
    seen = platform(page)
    by_address = F.when(url.rlike(r"viewcontent\.cgi|/cgi/"), "digital_commons").when(url.rlike(r"/index\.php/"), "ojs").when(url.rlike("wp-content"), "wordpress")
    return F.coalesce(F.nullif(seen, F.lit("unknown")), by_address, F.nullif(F.trim(listed), F.lit("")), F.lit("unknown"))
