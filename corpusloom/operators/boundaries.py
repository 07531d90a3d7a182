"""Articles inside a compiled issue, from page references of its table of contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

REFERENCE = r"(?:\.{2,}|\s{2,}|\t)\s*([0-9]{1,4})\s*$"


def toc_references(pages: DataFrame, first_pages: int = 6) -> DataFrame:
    """(doc_id, ref): strictly rising page references of the first pages of a document.

    pages: doc_id, page_index, text. A page counts as contents with three
    references; a reference is kept where it exceeds all before it.
    """
    lines = pages.where(F.col("page_index") < first_pages).select("doc_id", "page_index", F.posexplode(F.split("text", "\n")).alias("line", "t"))
    refs = lines.withColumn("ref", F.regexp_extract("t", REFERENCE, 1).try_cast("int")).where("ref is not null")
    many = refs.groupBy("doc_id", "page_index").count().where("count >= 3").select("doc_id", "page_index")
    refs = refs.join(many, ["doc_id", "page_index"], "left_semi")
    before = F.max("ref").over(Window.partitionBy("doc_id").orderBy("page_index", "line").rowsBetween(Window.unboundedPreceding, -1))
    return refs.withColumn("high", before).where(F.col("high").isNull() | (F.col("ref") > F.col("high"))).select("doc_id", "ref")


def page_offset(pages: DataFrame, refs: DataFrame, horizon: int = 20) -> DataFrame:
    """(doc_id, offset): index less printed number of the first page that carries the first reference."""
    first = refs.groupBy("doc_id").agg(F.min("ref").alias("ref"))
    edge = F.coalesce(F.nullif(F.regexp_extract("text", r"^\s*([0-9]{1,4})\b", 1), F.lit("")), F.regexp_extract("text", r"\b([0-9]{1,4})\s*$", 1)).try_cast("int")
    hit = pages.join(first, "doc_id").where((edge == F.col("ref")) & (F.col("page_index") < horizon))
    return hit.groupBy("doc_id").agg(F.min(F.col("page_index") - F.col("ref")).alias("offset"))


def article_spans(pages: DataFrame) -> DataFrame:
    """(doc_id, ref, first_index, last_index): inclusive spans of pages between references."""
    refs = toc_references(pages)
    n = pages.groupBy("doc_id").agg((F.max("page_index") + 1).alias("n_pages"))
    s = refs.join(page_offset(pages, refs), "doc_id").join(n, "doc_id").withColumn("first_index", F.col("ref") + F.col("offset")).where("first_index between 0 and n_pages - 1")
    nxt = F.lead("first_index").over(Window.partitionBy("doc_id").orderBy("first_index"))
    return s.select("doc_id", "ref", "first_index", F.coalesce(nxt - 1, F.col("n_pages") - 1).alias("last_index"))


def heading_spans(pages: DataFrame, apart: int = 4) -> DataFrame:
    """(doc_id, first_index, last_index): spans from pages that open with a heading and an abstract.

    A start counts where it is ``apart`` pages from the last one that counts;
    with fewer than two there are no spans.
    """
    lines = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda t: F.trim(t)), lambda t: t != "")
    head = F.get(lines, F.lit(0))
    heading = head.rlike(r"^[A-Z0-9][^a-z]{5,}$|^(?:[A-Z][\w'’-]*|of|and|the|in|a|for|to|on|&|:|,|\s)+$") & ~head.rlike(r"(?i)law review|journal")
    opens = heading & F.exists(F.slice(lines, 1, 10), lambda t: F.lower(t).startswith("abstract"))
    starts = pages.where(F.coalesce(opens, F.lit(False))).groupBy("doc_id").agg(F.array_sort(F.collect_list("page_index")).alias("s"))
    # pages of one document; whether a start counts depends on the one that counted before
    kept = F.aggregate("s", F.array().cast("array<int>"), lambda acc, p: F.when((F.size(acc) == 0) | (p - F.element_at(acc, -1) >= apart), F.array_append(acc, p)).otherwise(acc))
    n = pages.groupBy("doc_id").agg((F.max("page_index") + 1).alias("n_pages"))
    k = starts.select("doc_id", kept.alias("k")).where(F.size("k") >= 2).join(n, "doc_id").select("doc_id", "n_pages", F.explode("k").alias("first_index"))
    nxt = F.lead("first_index").over(Window.partitionBy("doc_id").orderBy("first_index"))
    return k.select("doc_id", "first_index", F.coalesce(nxt - 1, F.col("n_pages") - 1).alias("last_index"))
