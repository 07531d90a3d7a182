"""Operators over lines with layout: recurring lines, changes of type size, dense markers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.notes import LEGAL_SIGNAL, NOTE_LIKE


def page_lines(docs: DataFrame) -> DataFrame:
    """(pdf_id, page_index, page, height, pos, n_lines, text, top, font_size): body, then notes of every page."""
    p = docs.select("pdf_id", F.posexplode("pages").alias("page_index", "p"))
    every = F.concat(F.coalesce(F.col("p.body_lines"), F.expr("array()")), F.coalesce(F.col("p.note_lines"), F.expr("array()")))
    l = p.select("pdf_id", "page_index", F.col("p.page_number").alias("page"), F.col("p.height").alias("height"), F.size(every).alias("n_lines"), F.posexplode(every).alias("pos", "l"))  # noqa: E741
    return l.select("pdf_id", "page_index", "page", "height", "n_lines", "pos", "l.text", "l.top", "l.font_size")


def recurring_lines(lines: DataFrame, share: float = 0.4, least: int = 3) -> DataFrame:
    """(pdf_id, band, line, pages): texts, without their numbers, in the same band of ten points on many pages of a document."""
    pages = lines.groupBy("pdf_id").agg(F.countDistinct("page_index").alias("n_pages"))
    t = lines.where("text is not null and trim(text) <> ''").groupBy("pdf_id", F.round(F.col("top") / 10).cast("int").alias("band"), F.regexp_replace(F.lower(F.trim("text")), "[0-9]+", "#").alias("line")).agg(F.countDistinct("page_index").alias("pages"))
    return t.join(pages, "pdf_id").where(F.col("pages") >= F.greatest(F.lit(least), F.floor(F.col("n_pages") * share))).select("pdf_id", "band", "line", "pages")


def font_variance(lines: DataFrame) -> DataFrame:
    """Range of type sizes of every page, and whether it is too small to tell notes by."""
    g = lines.groupBy("pdf_id", "page_index").agg(F.count("font_size").alias("sized"), F.round(F.max("font_size") - F.min("font_size"), 3).alias("spread"))
    return g.withColumn("low_variance", F.coalesce((F.col("sized") >= 6) & (F.col("spread") <= 1.25), F.lit(False)))


def font_transition(lines: DataFrame) -> DataFrame:
    """(pdf_id, page_index, cutoff): the first line from which type is smaller than above.

    Running means above and below every line; pages need ten sized lines.
    """
    page = Window.partitionBy("pdf_id", "page_index")
    up = page.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    down = page.orderBy("pos").rowsBetween(0, Window.unboundedFollowing)
    m = lines.groupBy("pdf_id", "page_index").agg(F.median("font_size").alias("median"), F.count("font_size").alias("sized")).where("sized >= 10")
    l = lines.join(m, ["pdf_id", "page_index"]).withColumns({"above": F.avg("font_size").over(up), "below": F.avg("font_size").over(down)})  # noqa: E741
    hit = (F.col("pos") >= F.floor(F.col("n_lines") * 0.4)) & (F.col("pos") < F.col("n_lines") - 2) & (F.col("above") > F.col("median") * 0.98) & (F.col("below") < F.col("median") * 0.92)
    return l.where(hit).groupBy("pdf_id", "page_index").agg(F.min_by("top", "pos").alias("cutoff"))


def _marked(lines: DataFrame) -> DataFrame:
    like, legal = F.coalesce(F.col("text").rlike(NOTE_LIKE), F.lit(False)), F.coalesce(F.col("text").rlike(LEGAL_SIGNAL), F.lit(False))
    w = Window.partitionBy("pdf_id", "page_index").orderBy("top", "pos")
    return lines.where("height > 0").withColumns({"like": like.cast("int"), "legal": legal.cast("int"), "rn": F.row_number().over(w)})


def marker_density(lines: DataFrame) -> DataFrame:
    """(pdf_id, page_index, cutoff): the first line in the lower part from which lines look like notes densely."""
    below = Window.partitionBy("pdf_id", "page_index").orderBy("rn").rowsBetween(0, Window.unboundedFollowing)
    l = _marked(lines).withColumns({"n_like": F.sum("like").over(below), "n_legal": F.sum("legal").over(below), "n": F.count("*").over(below)})  # noqa: E741
    ok = (F.col("n_lines") >= 6) & (F.col("top") / F.col("height") >= 0.45) & (F.col("n") >= 2) & (F.col("n") <= F.greatest(F.lit(6), F.floor(F.col("n_lines") * 0.7)))
    ok = ok & (F.col("n_like") >= 2) & ((F.col("n_like") + 0.5 * F.col("n_legal")) / F.col("n") >= 0.35)
    return l.where(ok).groupBy("pdf_id", "page_index").agg(F.min_by("top", "rn").alias("cutoff"))


def frame_density(lines: DataFrame) -> DataFrame:
    """(pdf_id, page_index, cutoff): the first line whose next eight lines look like notes."""
    frame = Window.partitionBy("pdf_id", "page_index").orderBy("rn").rowsBetween(0, 7)
    below = Window.partitionBy("pdf_id", "page_index").orderBy("rn").rowsBetween(0, Window.unboundedFollowing)
    l = _marked(lines).withColumn("strong", F.greatest("like", "legal"))  # noqa: E741
    l = l.withColumns({"strong8": F.sum("strong").over(frame), "starts8": F.sum("like").over(frame), "n8": F.count("*").over(frame), "n": F.count("*").over(below)})  # noqa: E741
    ok = (F.col("n_lines") >= 8) & (F.col("top") / F.col("height") >= 0.4) & (F.col("n8") >= 5) & (F.col("n") <= F.greatest(F.lit(8), F.floor(F.col("n_lines") * 0.75))) & (F.col("strong8") >= 5) & (F.col("starts8") >= 2)
    return l.where(ok).groupBy("pdf_id", "page_index").agg(F.min_by("top", "rn").alias("cutoff"))


def text_density(docs: DataFrame) -> DataFrame:
    """Mean characters of the first, quarter, middle, three-quarter and last page."""
    n = F.size("pages")
    picks = F.array_distinct(F.array(F.lit(0), F.floor(n / 4), F.floor(n / 2), F.floor(n * 3 / 4), n - 1).cast("array<int>"))
    p = docs.where("size(pages) > 0").select("pdf_id", n.alias("n_pages"), F.explode(picks).alias("i"), "pages")
    chars = F.aggregate(F.coalesce(F.get(F.col("pages"), F.col("i"))["body_lines"]["text"], F.expr("array()").cast("array<string>")), F.lit(0), lambda acc, t: acc + F.length(F.trim(F.coalesce(t, F.lit("")))))
    return p.groupBy("pdf_id", "n_pages").agg(F.round(F.avg(chars), 4).alias("density"))


def context_lines(docs: DataFrame, notes: DataFrame) -> DataFrame:
    """(pdf_id, label, page, context_page, pos, text, found): the body line in which a label is called.

    The last line of the note's page that ends a word with the label, else of
    the page before, else the last line of the page (``found`` is false).
    """
    p = docs.select("pdf_id", F.explode("pages").alias("p"))
    body = p.select("pdf_id", F.col("p.page_number").alias("body_page"), F.posexplode("p.body_lines").alias("pos", "l")).select("pdf_id", "body_page", "pos", "l.text")
    calls = body.withColumn("call", F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z][.,;:?!]?\"?([0-9]{1,4})(?:\s|$)"), F.lit(1)))).groupBy("pdf_id", "body_page", F.col("call").alias("label")).agg(F.max(F.struct("pos", "text")).alias("c"))
    last = body.groupBy("pdf_id", "body_page").agg(F.max(F.struct("pos", "text")).alias("c"))
    n = notes.select("pdf_id", "label", F.col("page_start").alias("page"), "idx").distinct()
    same = n.join(calls.withColumnRenamed("body_page", "page"), ["pdf_id", "page", "label"]).select(*n.columns, F.lit(1).alias("rank"), F.col("page").alias("context_page"), "c")
    prev = n.join(calls.withColumn("page", F.col("body_page") + 1).drop("body_page"), ["pdf_id", "page", "label"]).select(*n.columns, F.lit(2).alias("rank"), (F.col("page") - 1).alias("context_page"), "c")
    rest = n.join(last.withColumnRenamed("body_page", "page"), ["pdf_id", "page"]).select(*n.columns, F.lit(3).alias("rank"), F.col("page").alias("context_page"), "c")
    best = same.unionAll(prev).unionAll(rest).groupBy("pdf_id", "label", "page", "idx").agg(F.min(F.struct("rank", "context_page", "c")).alias("b"))
    return best.select("pdf_id", "label", "page", "idx", "b.context_page", F.col("b.c.pos").alias("pos"), F.col("b.c.text").alias("text"), (F.col("b.rank") < 3).alias("found"))


def low_density(lines: DataFrame) -> DataFrame:
    """(pdf_id, page_index, cutoff): where notes begin when type size does not tell: markers, legal signs and short references from the middle of the page on."""
    below = Window.partitionBy("pdf_id", "page_index").orderBy("rn").rowsBetween(0, Window.unboundedFollowing)
    three = Window.partitionBy("pdf_id", "page_index").orderBy("rn").rowsBetween(0, 2)
    short = F.coalesce(F.col("text").rlike(r"(?i)^\s*[0-9]{1,4}[.)]?\s+(?:id|ibid)\."), F.lit(False)).cast("int")
    l = _marked(lines).withColumn("short", short)  # noqa: E741
    l = l.withColumns({"n_like": F.sum("like").over(below), "n_legal": F.sum("legal").over(below), "n_short": F.sum("short").over(below), "n": F.count("*").over(below), "near": F.sum("like").over(three)})  # noqa: E741
    density = (F.col("n_like") + 0.6 * F.col("n_legal") + 0.8 * F.col("n_short")) / F.col("n")
    ok = (F.col("n_lines") >= 6) & (F.col("top") / F.col("height") >= 0.5) & (F.col("n") >= 3) & (F.col("n") <= F.greatest(F.lit(5), F.floor(F.col("n_lines") * 0.6))) & (F.col("near") > 0)
    ok = ok & (((F.col("n_like") >= 2) & (density >= 0.45)) | ((F.col("n_like") >= 1) & (F.col("n_legal") >= 2) & (density >= 0.55)))
    return l.where(ok).groupBy("pdf_id", "page_index").agg(F.min_by("top", "rn").alias("cutoff"))


def bimodal_split(lines: DataFrame) -> DataFrame:
    """(pdf_id, page_index, cutoff): the top of the small type at the foot of a page with two sizes.

    From the foot upwards the share of small lines has to stay at 70 % from the
    fourth line on; the first line where it does not ends the region.
    """
    page = ["pdf_id", "page_index"]
    sized = lines.where("font_size is not null and height > 0").withColumn("s", F.round("font_size").cast("int"))
    total = sized.groupBy(*page).agg(F.count("*").alias("total"))
    sizes = sized.groupBy(*page, "s").agg(F.count("*").alias("k")).join(total, page).where("total >= 10 and k / total >= 0.12")
    two = sizes.groupBy(*page).agg(F.min("s").alias("small"), F.max("s").alias("big")).where("small < big and small / big <= 0.9")
    up = Window.partitionBy(*page).orderBy(F.desc("top"), F.desc("pos"))
    run = up.rowsBetween(Window.unboundedPreceding, 0)
    l = sized.join(two, page).withColumn("is_small", (F.col("font_size") <= (F.col("small") + F.col("big")) / 2).cast("int"))  # noqa: E741
    l = l.withColumns({"n": F.count("*").over(run), "k": F.sum("is_small").over(run)})  # noqa: E741
    l = l.withColumn("broken", F.max(((F.col("n") >= 4) & (F.col("k") / F.col("n") < 0.7)).cast("int")).over(run)).where("broken = 0 and n >= 4 and is_small = 1")  # noqa: E741
    g = l.groupBy(*page).agg(F.min("top").alias("cutoff"), F.max("k").alias("k"), F.max("height").alias("height"))
    return g.where("k >= 3 and cutoff / height >= 0.4").select(*page, "cutoff")


def citation_line(lines: DataFrame, first: int = 160) -> DataFrame:
    """(pdf_id, line): the line among the first of a document that looks most like a citation; the longest of equals."""
    t = F.trim(F.regexp_replace("text", r"[\s\x{00A0}]+", " "))
    l = lines.withColumn("n", F.row_number().over(Window.partitionBy("pdf_id").orderBy("page_index", "pos"))).where(F.col("n") <= first).select("pdf_id", "n", t.alias("t")).where("length(t) >= 20")  # noqa: E741
    low = F.lower("t")
    score = 4 * F.col("t").rlike(r"[0-9]+ [A-Z][A-Za-z. ]+ [0-9]+").cast("int") + 2 * low.rlike(r"l\. rev\.|law review|journal").cast("int") + F.col("t").rlike(r"\b(?:19|20)[0-9]{2}\b").cast("int") + low.startswith("citation").cast("int")
    return l.withColumn("score", score).where("score > 0").groupBy("pdf_id").agg(F.max_by("t", F.struct("score", F.length("t"), -F.col("n"))).alias("line"))
