"""Markers of notes beyond a number at the start of a line.

Notes that share a line, marks of authors, notes at the end of a document,
pages of scans, lists of contents, labels lost or missing. Lines are (pdf_id,
page_index, line, page, text) in reading order; a document is the largest group
any of these sees. NULL and empty lines are left out; empty tables give empty
results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators import notes as N

# Forms of lines. All are understood alike by Java's and RE2's regular expressions.
INNER = r"([a-z0-9][.!?;)\]\"”’]*[.!?;)\]][\"”’]*)\s*([0-9]{1,4}[\]).,:;-]?\s*[A-Z“\"])"
GLUED = r"^([0-9]{1,4})([\]).,:;-]?)([A-Z“\"])"
RULE = r"^[\s_=*·–—-]{3,}$"
BANNER = r"(?i)^\W*(?:end|foot)?notes\W*$|^electronic copy available|^downloaded (?:from|by)"
AUTHOR = r"^([*†‡§¶]+)\s*(\S.*)$"
NOTES_HEADING = r"(?i)^\W*(?:end|foot)?notes\W*$"
MARKER = r"^[0-9]{1,4}[\]).,:;-]?\s+\S"
LEADERS = r"\.{3,}|(?:\. ){3,}|…"
LAST_PAGE = r"[0-9]{1,4}\s*$"
CONTENTS = r"(?i)table of contents"
CITES = r"(?i)\b(?:see|cf\.|id\.|ibid\.|supra|infra|v\.|u\.s\.|l\. rev\.|§)"
#: Greatest label of a document by its pages, and at most.
LABELS_A_PAGE, MOST_LABELS = 60, 1500


def note_lines(docs: DataFrame, side: str = "note") -> DataFrame:
    """Lines of one side of the pages, spaces collapsed."""
    p = docs.select("pdf_id", F.posexplode("pages").alias("page_index", "p"))
    l = p.select("pdf_id", "page_index", F.col("p.page_number").alias("page"), F.posexplode(f"p.{side}_lines").alias("line", "l"))  # noqa: E741
    return l.select("pdf_id", "page_index", "line", "page", F.trim(F.regexp_replace("l.text", r"[\s\x{00A0}]+", " ")).alias("text"))


def split_lines(lines: DataFrame, ahead: int = 3) -> DataFrame:
    """Lines cut where a number follows the end of a sentence and precedes a capital; a number glued to its text is set apart.

    A cut counts where its number is at most ``ahead`` labels on from the last
    number that begins a line of the document; the numbers of citations stay in
    their line.
    """
    parts = F.posexplode(F.split(F.regexp_replace(F.col("text"), INNER, "$1\ue000$2"), "\ue000")).alias("part", "t")
    s = N.numbered(lines).select("pdf_id", "page_index", "line", "page", "n", parts).withColumn("t", F.regexp_replace("t", GLUED, "$1$2 $3"))
    within, page = Window.partitionBy("pdf_id").orderBy("page_index", "line", "part"), ["pdf_id", "page_index", "line", "page"]
    s = s.withColumn("last", F.last(F.when(F.col("part") == 0, F.col("n")), ignorenulls=True).over(within))
    own = F.regexp_extract("t", r"^([0-9]{1,4})", 1).try_cast("int")
    cut = F.coalesce((F.col("part") == 0) | own.between(F.col("last") + 1, F.col("last") + ahead), F.lit(False))
    s = s.withColumn("piece", F.sum(cut.cast("int")).over(Window.partitionBy(*page[:3]).orderBy("part")))
    g = s.groupBy(*page, "piece").agg(F.array_join(F.sort_array(F.collect_list(F.struct("part", "t")))["t"], " ").alias("text"))
    return g.select("pdf_id", "page_index", (F.col("line").cast("bigint") * 1048576 + F.col("piece")).alias("line"), "page", "text")


def without_banners(lines: DataFrame) -> DataFrame:
    """Lines below the first rule of their page, where it has one, less banners and rules."""
    rule = F.min(F.when(F.col("text").rlike(RULE), F.col("line"))).over(Window.partitionBy("pdf_id", "page_index"))
    kept = lines.where("text <> ''").withColumn("_rule", rule).where("_rule is null or line > _rule").drop("_rule")
    return kept.where(~F.col("text").rlike(BANNER) & ~F.col("text").rlike(RULE))


def author_notes(lines: DataFrame) -> DataFrame:
    """(pdf_id, marker, page, text): notes marked by a sign, with the lines up to the next mark or number."""
    signed = F.col("text").rlike(AUTHOR)
    opens = (signed | F.col("text").rlike(MARKER)).cast("int")
    w = Window.partitionBy("pdf_id").orderBy("page_index", "line")
    l = lines.where("text <> ''").withColumns({"opens": opens, "signed": signed}).withColumn("note", F.sum("opens").over(w)).where("note > 0")  # noqa: E741
    body = F.when(F.col("signed"), F.regexp_extract("text", AUTHOR, 2)).otherwise(F.col("text"))
    g = l.groupBy("pdf_id", "note").agg(F.max(F.when(F.col("signed"), F.regexp_extract("text", AUTHOR, 1))).alias("marker"), F.min("page").alias("page"), F.sort_array(F.collect_list(F.struct("page_index", "line", body.alias("t")))).alias("parts"))
    return g.where("marker is not null").select("pdf_id", "marker", "page", F.array_join(F.col("parts.t"), " ").alias("text"))


def endnote_starts(docs: DataFrame, share: float = 0.6) -> DataFrame:
    """(pdf_id, start): index of the page on which the notes at the end of a document begin.

    That is the first page with a heading of its own line, from ``share`` of the
    pages on or in a document of one page; without one, the first of the last
    two pages with at least five lines, six of them and 30 % begin with numbers
    that count up from 1 by one at least to 3.
    """
    n_pages = docs.select("pdf_id", F.size("pages").alias("n_pages")).where("n_pages > 0")
    b = note_lines(docs, "body").where("text <> ''").join(n_pages, "pdf_id")
    late = (F.col("n_pages") == 1) | (F.col("page_index") + 1 >= F.greatest(F.lit(2), F.ceil(F.col("n_pages") * share)))
    headed = b.where(F.col("text").rlike(NOTES_HEADING) & late).groupBy("pdf_id").agg(F.min("page_index").alias("start"))
    last = N.numbered(b.where("n_pages >= 2 and page_index >= n_pages - 2"))
    page = Window.partitionBy("pdf_id", "page_index").orderBy("line")
    last = last.withColumn("before", F.max("n").over(page.rowsBetween(Window.unboundedPreceding, -1))).withColumn("high", F.col("n").isNotNull() & (F.col("before").isNull() | (F.col("n") > F.col("before"))))
    last = last.withColumn("step", F.sum(F.col("high").cast("int")).over(page))
    g = last.groupBy("pdf_id", "page_index").agg(F.count("*").alias("lines"), F.count("n").alias("marked"), F.sum(F.when(F.col("high") & (F.col("step") <= 3) & (F.col("n") == F.col("step")), 1).otherwise(0)).alias("counted"))
    dense = g.where("lines >= 5 and marked >= 6 and marked >= 0.3 * lines and counted = 3").groupBy("pdf_id").agg(F.min("page_index").alias("start"))
    return headed.unionAll(dense.join(headed, "pdf_id", "left_anti"))


def endnotes(docs: DataFrame) -> DataFrame:
    """Notes gathered from body lines from the page on which they begin; see ``notes.segmented``."""
    b = note_lines(docs, "body").join(endnote_starts(docs), "pdf_id").where("page_index >= start").drop("start")
    return N.segmented(b.where(~F.col("text").rlike(NOTES_HEADING)))


def from_text(texts: DataFrame) -> DataFrame:
    """Notes of plain texts (pdf_id, text) as one page each: lines below a heading of their own; without one there are none."""
    l = texts.select("pdf_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "t")).select("pdf_id", F.lit(0).alias("page_index"), "line", F.lit(1).alias("page"), F.trim(F.regexp_replace("t", r"[\s\x{00A0}]+", " ")).alias("text"))  # noqa: E741
    head = F.min(F.when(F.col("text").rlike(NOTES_HEADING), F.col("line"))).over(Window.partitionBy("pdf_id"))
    return N.segmented(l.withColumn("_head", head).where("line > _head").drop("_head"))


# ------------------------------------------------------------ false markers
def rejection(label: Column, text: Column, most: Column) -> Column:
    """Why a number at the start of a line is no label, or NULL: the first reason that holds."""
    cites = text.rlike(CITES)
    words = F.size(F.split(F.trim(text), r"\s+"))
    return (
        F.when(text.rlike(CONTENTS) | (text.rlike(LEADERS) & text.rlike(LAST_PAGE) & ~cites), "contents")
        .when(label > most, "too_great").when(label == 0, "zero").when(text.rlike(r"^[0-9\s.,;:()\[\]–—-]+$"), "figures_only")
        .when(text.rlike(N.FRAGMENT), "rest_of_a_citation").when((F.length(text) < 3) & ~cites, "too_short")
        .when((words <= 2) & text.rlike(r"^[a-z]") & ~text.rlike(r"[.;]$"), "rest_of_a_sentence")
    )


def rejected(docs: DataFrame) -> DataFrame:
    """(pdf_id, page_index, line, label, reason): numbers at the start of note lines that are no labels."""
    n_pages = docs.select("pdf_id", F.size("pages").alias("n_pages"))
    start = r"^([0-9]{1,4})[\]).,:;-]?\s+(\S.*)$"
    l = note_lines(docs).where(F.col("text").rlike(start)).join(n_pages, "pdf_id")  # noqa: E741
    label, most = F.regexp_extract("text", start, 1).cast("int"), F.least(F.lit(MOST_LABELS), F.col("n_pages") * LABELS_A_PAGE)
    return l.select("pdf_id", "page_index", "line", label.alias("label"), rejection(label, F.regexp_extract("text", start, 2), most).alias("reason")).where("reason is not null")


def contents_like(page: Column, text: Column) -> Column:
    """Whether a gathered note of the first pages is an entry of a list of contents."""
    words = F.size(F.split(F.trim(text), r"\s+"))
    entry = text.rlike(CONTENTS) | (text.rlike(LEADERS) & (words <= 120) & text.rlike(LAST_PAGE)) | (text.rlike(LAST_PAGE) & (words <= 14) & ~text.rlike(CITES))
    return F.coalesce((page <= 3) & entry, F.lit(False))


def contents_documents(solved: DataFrame, docs: DataFrame) -> DataFrame:
    """(pdf_id): documents whose labels (pdf_id, label, page_index) are page numbers of a list of contents.

    Four labels at least that do not begin at 1, on four pages at least, and 80 %
    of them on two pages.
    """
    by_page = solved.groupBy("pdf_id", "page_index").agg(F.count("*").alias("n"), F.min("label").alias("low"))
    w = Window.partitionBy("pdf_id").orderBy(F.desc("n"), "page_index")
    g = by_page.withColumn("at", F.row_number().over(w)).groupBy("pdf_id").agg(F.sum("n").alias("labels"), F.sum(F.when(F.col("at") <= 2, F.col("n"))).alias("top"), F.min("low").alias("low"))
    return g.join(docs.select("pdf_id", F.size("pages").alias("n_pages")), "pdf_id").where("labels >= 4 and n_pages >= 4 and low <> 1 and top >= 0.8 * labels").select("pdf_id")


# ---------------------------------------------------------- gaps and repairs
def gap_filled(solved: DataFrame, candidates: DataFrame) -> DataFrame:
    """(pdf_id, label, page_index, line): labels missing in a chain, from candidates left over near the gap.

    A candidate counts between the places of the labels around the gap or up to
    two pages before or after; the best score wins, then the earlier place.
    """
    place = F.struct("page_index", "line")
    w = Window.partitionBy("pdf_id").orderBy("page_index", "line")
    gaps = solved.select("pdf_id", "label", "page_index", F.lead("label").over(w).alias("next"), F.lead("page_index").over(w).alias("next_page")).where("next > label + 1")
    gaps = gaps.select("pdf_id", F.col("page_index").alias("lo"), F.col("next_page").alias("hi"), F.explode(F.sequence(F.col("label") + 1, F.col("next") - 1)).alias("label"))
    free = candidates.select("pdf_id", F.inline("c")).join(solved.select("pdf_id", "label", "page_index", "line"), ["pdf_id", "label", "page_index", "line"], "left_anti")
    hit = free.join(gaps, ["pdf_id", "label"]).where("page_index between lo - 2 and hi + 2")
    best = hit.groupBy("pdf_id", "label").agg(F.max_by(place, F.struct("score", -F.col("page_index"), -F.col("line"))).alias("p"))
    return best.select("pdf_id", "label", "p.page_index", "p.line")


def one_per_label(places: DataFrame) -> DataFrame:
    """(pdf_id, label, page_index, line): of several places of a label the one nearest to the pages of the labels before and after, then the first."""
    pages = places.groupBy("pdf_id", "label").agg(F.min("page_index").alias("first"))
    w = Window.partitionBy("pdf_id").orderBy("label")
    around = pages.select("pdf_id", "label", F.lag("first").over(w).alias("before"), F.lead("first").over(w).alias("after"))
    far = F.coalesce(F.abs(F.col("page_index") - F.col("before")), F.lit(0)) + F.coalesce(F.abs(F.col("page_index") - F.col("after")), F.lit(0))
    best = places.join(around, ["pdf_id", "label"]).groupBy("pdf_id", "label").agg(F.min(F.struct(far.alias("far"), "page_index", "line")).alias("p"))
    return best.select("pdf_id", "label", "p.page_index", "p.line")


def restored_labels(notes: DataFrame, group: list[str], order: list[str], label: str = "number") -> DataFrame:
    """notes with ``restored``: a label of one figure between greater ones is the only number between them that ends in that figure."""
    w = Window.partitionBy(*group).orderBy(*order)
    long = F.when(F.col(label) >= 10, F.col(label))
    n = notes.withColumns({"_lo": F.last(long, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), "_hi": F.first(long, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))})
    # the first number above _lo with that last figure, and whether another fits below _hi
    step = F.col("_lo") + 1 + F.pmod(F.col(label) - F.col("_lo") - 1, F.lit(10))
    fits = F.col(label).between(0, 9) & (F.col("_hi") > F.col("_lo")) & (step < F.col("_hi")) & (step + 10 >= F.col("_hi"))
    return n.withColumn("restored", F.when(fits, step).otherwise(F.col(label))).drop("_lo", "_hi")


# --------------------------------------------------------------------- scans
def scan_lines(docs: DataFrame) -> DataFrame:
    """Note lines of scanned pages, found by their labels alone: from the first labelled line on from which labels rise."""
    from corpusloom.operators.repair import rising_block

    p = docs.select("pdf_id", F.posexplode("pages").alias("page_index", "p")).where("coalesce(p.source, 'text') <> 'text'")
    every = F.concat(F.coalesce(F.col("p.body_lines.text"), F.array().cast("array<string>")), F.coalesce(F.col("p.note_lines.text"), F.array().cast("array<string>")))
    l = p.select("pdf_id", "page_index", F.col("p.page_number").alias("page"), F.posexplode(every).alias("pos", "t"))  # noqa: E741
    l = l.select("pdf_id", "page_index", "page", "pos", F.trim(F.regexp_replace("t", r"[\s\x{00A0}]+", " ")).alias("text")).where("text <> ''")  # noqa: E741
    label = F.when(~F.col("text").rlike(r"\.{4,}\s*[0-9]{1,4}\s*$"), F.regexp_extract("text", r"^([0-9]{1,4})[.)]?\s+\S", 1).try_cast("int"))
    l = l.withColumn("label", label)  # noqa: E741
    return l.join(rising_block(l), ["pdf_id", "page_index"]).where("pos >= start").select("pdf_id", "page_index", F.col("pos").alias("line"), "page", "text")


def scan_notes(docs: DataFrame) -> DataFrame:
    """(pdf_id, label, page_start, text): notes of scanned pages, the longest text of every label, then the first."""
    s = N.segmented(scan_lines(docs))
    return s.groupBy("pdf_id", "label").agg(F.max_by(F.struct("page_start", "text"), F.struct(F.length("text"), -F.col("note_no"))).alias("b")).select("pdf_id", "label", "b.page_start", "b.text")


def dropped_labels(found: DataFrame) -> DataFrame:
    """(pdf_id, label): labels from 1 to the greatest that were not found."""
    top = found.groupBy("pdf_id").agg(F.max("label").alias("top")).where("top >= 1")
    return top.select("pdf_id", F.explode(F.sequence(F.lit(1), "top")).alias("label")).join(found.select("pdf_id", "label"), ["pdf_id", "label"], "left_anti")
