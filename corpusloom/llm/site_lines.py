"""Lines that a site repeats in many of its documents.

A line is known by its letters in lower case. For every site and line the
number of the site's documents that have it is held against the documents of
the other sites by a log-likelihood ratio; sites that repeat the line
themselves are no part of that background, so that a notice shared by many
sites is not excused by its spread. Significant excess is decided with control
of the false-discovery rate; the lines found are taken out by an anti-join and
the rest of each page is put together by position.

Defined results: the site of a document is the directory in its path, else no
site; documents without a site, lines without letters and NULL lines are never
found; a document given twice counts once; NULL pages and line lists have no
lines; an empty table gives empty results. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import broadcast_if_small, stage

LEAST_LETTERS, LEAST_DOCUMENTS, LEAST_SHARE, FDR = 20, 3, 0.1, 0.05


def site_of(path: Column) -> Column:
    site = F.lower(F.regexp_extract(path, r"/pdfs/([^/]+)/", 1))
    return F.when(site != "", site)


def letters(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), r"[^\p{L}]+", "")


def lines(docs: DataFrame) -> DataFrame:
    """(pdf_id, site, page_no, page_number, side, line_no, text) in one generator per page."""
    pages = docs.select("pdf_id", site_of(F.col("pdf_path")).alias("site"), F.posexplode("pages").alias("page_no", "page"))
    side = lambda name: F.transform(F.coalesce(F.col(f"page.{name}_lines.text"), F.array().cast("array<string>")), lambda t, i: F.struct(F.lit(name).alias("side"), i.alias("line_no"), t.alias("text")))
    out = pages.select("pdf_id", "site", "page_no", F.col("page.page_number").alias("page_number"), F.explode(F.concat(side("body"), side("note"))).alias("l"))
    return out.select("pdf_id", "site", "page_no", "page_number", "l.side", "l.line_no", "l.text")


def keyed(docs: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """Lines of at least ``least`` letters with a 128-bit key of their letters."""
    out = lines(docs).withColumn("letters", letters(F.col("text"))).where(F.col("site").isNotNull() & (F.length("letters") >= least))
    return out.select("pdf_id", "site", "page_no", "page_number", "side", "line_no", F.xxhash64("letters").alias("k1"), F.xxhash64(F.lit(11), "letters").alias("k2"))


def g_statistic(k1, n1, k2, n2) -> Column:
    """Log-likelihood ratio of two shares; negative where the first one is smaller."""
    p = (k1 + k2) / (n1 + n2)

    def part(k, n, q):
        safe = lambda x: F.when(x > 0, x).otherwise(1e-300)
        return k * F.log(safe(q)) + (n - k) * F.log(safe(1 - q))

    g = 2 * (part(k1, n1, k1 / n1) + part(k2, n2, k2 / n2) - part(k1, n1, p) - part(k2, n2, p))
    return F.when(k1 / n1 >= k2 / n2, g).otherwise(-g)


def fdr_threshold(tested: DataFrame, level: float, tests: int) -> float:
    """Smallest statistic that Benjamini and Hochberg accept among ``tests``, from a histogram of those that may be accepted.

    Bins are 0.05 wide up to 400, whatever the number of tests; a bin is taken
    by its lower edge, which errs to the side of not finding.
    """
    bins = tested.groupBy(F.least(F.floor(F.greatest("g", F.lit(0.0)) * 20), F.lit(8000)).alias("b")).count().collect()
    m, seen, best = max(tests, 1), 0, math.inf
    for b, n in sorted(((int(r[0]), r[1]) for r in bins), reverse=True):
        seen += n
        # one-sided tail of the chi-square distribution with one degree of freedom
        if math.erfc(math.sqrt(b / 20 / 2)) / 2 <= level * seen / m:
            best = b / 20
    return best


def repeated(docs: DataFrame, share: float = LEAST_SHARE, documents: int = LEAST_DOCUMENTS, level: float = FDR, least: int = LEAST_LETTERS) -> DataFrame:
    """(site, k1, k2, df, n_docs, g, significant, frequent).

    ``significant``: more frequent in the site than outside, at the given false
    discovery rate over all lines of all sites. Sites that repeat a line
    themselves are no background for it; what is left counts as at least as many
    documents as the site has, in which the line does not stand, so that a site
    without others around is held against one of its own size. ``frequent``: in at least ``documents`` documents and in
    ``share`` of the site's documents.
    """
    n_docs = docs.select("pdf_id", site_of(F.col("pdf_path")).alias("site")).where("site is not null").groupBy("site").agg(F.countDistinct("pdf_id").alias("n_docs"))
    per_doc = keyed(docs, least).groupBy("k1", "k2", "site", "pdf_id").agg(F.lit(1).alias("one"))
    df = stage(per_doc.groupBy("k1", "k2", "site").agg(F.count("*").alias("df")), "site-lines")
    # every line of every site is a test, also those too rare to be found
    tests = df.count()
    df = df.join(n_docs, "site").withColumn("frequent", (F.col("df") >= documents) & (F.col("df") >= share * F.col("n_docs") - 1e-9))
    # a line's row per site: the background adds up over sites, of which there are few
    out = df.groupBy("k1", "k2").agg(
        F.sum(F.when(~F.col("frequent"), F.col("df")).otherwise(0)).alias("k_calm"),
        F.sum(F.when(F.col("frequent"), F.col("n_docs")).otherwise(0)).alias("n_loud"),
        F.max("df").alias("most"),
    )
    total = n_docs.agg(F.sum("n_docs").alias("n_all"))
    df = df.where(F.col("df") >= documents).join(out.where(F.col("most") >= documents), ["k1", "k2"]).join(F.broadcast(total))
    inside = lambda c: F.when(F.col("frequent"), F.lit(0)).otherwise(F.col(c))
    k2 = F.col("k_calm") - inside("df")
    n2 = F.greatest(F.col("n_all") - F.col("n_loud") - inside("n_docs"), F.col("n_docs"), k2)
    df = stage(df.withColumn("g", g_statistic(F.col("df").cast("double"), F.col("n_docs").cast("double"), k2.cast("double"), n2.cast("double"))), "excess")
    return df.select("site", "k1", "k2", "df", "n_docs", "g", (F.col("g") >= F.lit(fdr_threshold(df, level, tests))).alias("significant"), "frequent")


def found_lines(docs: DataFrame, excess: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """(pdf_id, page_no, page_number, side, line_no) of significant lines that pass the exact check."""
    hit = excess.where("significant and frequent").select("site", "k1", "k2")
    return keyed(docs, least).join(broadcast_if_small(hit), ["site", "k1", "k2"], "left_semi").select("pdf_id", "page_no", "page_number", "side", "line_no")


def without_repeated(docs: DataFrame, excess: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """(pdf_id, page_number, side, n_lines, text): the pages without the lines found, by position."""
    hit = broadcast_if_small(excess.where("significant and frequent").select("site", "k1", "k2"))
    all_lines = lines(docs).withColumn("letters", letters(F.col("text")))
    # shorter lines and documents without a site have no partner and stay
    keys = all_lines.withColumns({"k1": F.when(F.length("letters") >= least, F.xxhash64("letters")), "k2": F.xxhash64(F.lit(11), "letters")}).drop("letters")
    left = keys.join(hit, ["site", "k1", "k2"], "left_anti").where("text is not null")
    page = left.groupBy("pdf_id", "page_no", "page_number", "side").agg(F.sort_array(F.collect_list(F.struct("line_no", "text"))).alias("l"))
    return page.select("pdf_id", "page_number", "side", F.size("l").alias("n_lines"), F.array_join(F.col("l.text"), "\n").alias("text"))
