"""Aggregates over acquisition records: completeness, gaps, deltas, retries, streaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import records as R
from corpusloom.functions import urls as U
from corpusloom.functions.text import first_number
from corpusloom.session import stage


def placed(runs: DataFrame) -> DataFrame:
    """domain, record_id, volume, issue, record_type, pdf_url of records; numbers are the first digits."""
    return runs.select(
        U.host(F.col("domain")).alias("domain"), "record_id", first_number(F.col("metadata.volume")).alias("volume"), first_number(F.col("metadata.issue")).alias("issue"),
        R.text(F.col("metadata.record_type")).alias("record_type"), "pdf_url",
    )


def gaps(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Whole numbers missing between the least and the greatest of each group.

    Distinct values are combined before the shuffle and missing stretches come
    from neighbours, so no group's numbers are collected into one list.
    """
    seen = rows.where(F.col(value).isNotNull()).select(*keys, value).distinct()
    w = Window.partitionBy(*keys).orderBy(value)
    step = seen.withColumn("next", F.lead(value).over(w)).where(F.col("next") > F.col(value) + 1)
    return step.select(*keys, F.explode(F.sequence(F.col(value) + 1, F.col("next") - 1)).alias("missing"))


def issue_outliers(rows: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Issues of a domain with at most ``threshold`` times the median count; domains need two issues."""
    n = rows.where("volume is not null and issue is not null").groupBy("domain", "volume", "issue").agg(F.count("*").alias("records"))
    m = n.groupBy("domain").agg(F.median("records").alias("median"), F.count("*").alias("issues")).where("issues >= 2 and median > 0")
    return n.join(m, "domain").where(F.col("records") <= F.col("median") * threshold).select("domain", "volume", "issue", "records", "median")


def completeness(rows: DataFrame) -> DataFrame:
    """Gaps, outliers, share of articles with a PDF and confidence of every domain."""
    count = lambda df, name: df.groupBy("domain").agg(F.count("*").alias(name))
    typed = F.col("record_type") != ""
    article = F.col("record_type") == "article"
    pdf = R.text(F.col("pdf_url")) != ""
    one = lambda c: F.sum(c.cast("int"))
    base = rows.groupBy("domain").agg(F.count("*").alias("records"), one(typed).alias("typed"), one(article).alias("articles"), one(article & pdf).alias("article_pdfs"), one(pdf).alias("pdfs"))
    ratio = F.when(F.col("typed") > 0, F.when(F.col("articles") > 0, F.col("article_pdfs") / F.col("articles")).otherwise(0.0)).otherwise(F.col("pdfs") / F.col("records"))
    out = base.withColumn("pdf_ratio", F.round(ratio, 6))
    for df, name in ((gaps(rows, ["domain"], "volume"), "volume_gaps"), (gaps(rows.where("volume is not null"), ["domain", "volume"], "issue"), "issue_gaps"), (issue_outliers(rows), "outliers")):
        out = out.join(count(df, name), "domain", "left")
    out = out.fillna(0, ["volume_gaps", "issue_gaps", "outliers"])
    high = (F.col("volume_gaps") == 0) & (F.col("issue_gaps") == 0) & (F.col("outliers") == 0) & (F.col("pdf_ratio") >= 0.9)
    level = F.when(high, "HIGH").when((F.col("volume_gaps") == 0) & (F.col("pdf_ratio") >= 0.7), "MEDIUM").otherwise("LOW")
    return out.select("domain", "records", "volume_gaps", "issue_gaps", "outliers", "pdf_ratio", level.alias("confidence"))


def url_index(runs: DataFrame) -> DataFrame:
    """(pdf_url, sha): the last successful record of every address wins."""
    ok = runs.where("ok and trim(coalesce(pdf_url, '')) <> ''")
    return ok.groupBy(F.trim("pdf_url").alias("pdf_url")).agg(F.max_by(F.coalesce("pdf_sha256", F.lit("")), F.struct("seq", "record_id")).alias("sha"))


def delta(base: DataFrame, new: DataFrame) -> DataFrame:
    """(pdf_url, change): added, removed, changed or unchanged between two url indexes."""
    j = base.select("pdf_url", F.col("sha").alias("old")).join(new.select("pdf_url", F.col("sha").alias("now")), "pdf_url", "full_outer")
    differ = (F.col("old") != "") & (F.col("now") != "") & (F.col("old") != F.col("now"))
    return j.select("pdf_url", F.when(F.col("old").isNull(), "added").when(F.col("now").isNull(), "removed").when(differ, "changed").otherwise("unchanged").alias("change"))


def failures(runs: DataFrame) -> DataFrame:
    return runs.where("not coalesce(ok, false)").withColumn("error_class", R.error_class(F.col("http_status"), F.col("download_state")))


def latest_retryable(runs: DataFrame, max_retries: int = 3) -> DataFrame:
    """The last eligible failure of every address; blocked ones are not retried."""
    f = failures(runs).where((R.text(F.col("pdf_url")) != "") & (F.coalesce("retries", F.lit(0)) < max_retries) & R.is_retryable(F.col("error_class")))
    return f.groupBy(F.trim("pdf_url").alias("pdf_url")).agg(F.max_by(F.struct("record_id", "error_class", "retries"), F.struct("seq", "record_id")).alias("e")).select("pdf_url", "e.*")


def first_blocked(runs: DataFrame, max_retries: int = 3) -> DataFrame:
    """The first blocked failure of every address."""
    f = failures(runs).where((R.text(F.col("pdf_url")) != "") & (F.coalesce("retries", F.lit(0)) < max_retries) & (F.col("error_class") == "waf"))
    return f.groupBy(F.trim("pdf_url").alias("pdf_url")).agg(F.min_by(F.struct("record_id", U.host(F.col("domain")).alias("domain")), F.struct("seq", "record_id")).alias("e")).select("pdf_url", "e.*")


def failure_streaks(runs: DataFrame) -> DataFrame:
    """Longest run of failures in a row of every domain, in order of seq."""
    key = [U.host(F.col("domain")).alias("domain"), F.coalesce("ok", F.lit(False)).alias("ok"), "seq", "record_id"]
    w = Window.partitionBy("domain").orderBy("seq", "record_id")
    s = runs.select(*key).withColumn("island", F.sum(F.col("ok").cast("int")).over(w)).where("not ok")
    n = s.groupBy("domain", "island").agg(F.count("*").alias("n"))
    return n.groupBy("domain").agg(F.max("n").alias("longest"), F.count("*").alias("streaks"))


def journal_summary(runs: DataFrame) -> DataFrame:
    """Records, articles and the span of dates of every domain.

    Every distinct spelling of a date is read once; records are gathered by
    article before they are counted by domain.
    """
    m = F.col("metadata")
    r = runs.select(U.host(F.col("domain")).alias("domain"), F.coalesce("ok", F.lit(False)).cast("int").alias("ok"), R.article_key(m, F.col("pdf_url"), F.col("page_url")).alias("k"), m["date"].alias("date"), m["year"].alias("year"))
    told = r.select(F.explode(F.array("date", "year")).alias("v")).where("v is not null").distinct()
    # staged, or the reading of dates would be moved behind the join
    told = stage(told.withColumn("d", R.partial_date(F.col("v"))).where("d is not null"), "dates")
    one = lambda c: told.select(F.col("v").alias(c), F.col("d").alias(f"{c}_d"))
    both = F.filter(F.array("date_d", "year_d"), lambda x: x.isNotNull())
    r = r.join(one("date"), "date", "left").join(one("year"), "year", "left")
    low = F.array_min(F.transform(both, lambda x: F.struct(x["start"].alias("at"), x["normalized"].alias("normalized"))))
    high = F.array_max(F.transform(both, lambda x: F.struct(x["end"].alias("at"), x["normalized"].alias("normalized"))))
    a = r.groupBy("domain", "k").agg(F.count("*").alias("n"), F.sum("ok").alias("ok"), F.min(low).alias("low"), F.max(high).alias("high"))
    known = F.col("k").isNotNull()
    return a.groupBy("domain").agg(
        F.sum("n").alias("records"), F.sum("ok").alias("downloaded"), F.count("k").alias("articles"), F.count(F.when(known & F.col("low").isNotNull(), 1)).alias("articles_with_date"),
        F.min("low")["normalized"].alias("earliest"), F.max("high")["normalized"].alias("latest"),
    )


def export_grains(runs: DataFrame) -> DataFrame:
    """Articles and PDFs by (domain, journal) and by (domain, journal, volume, issue), in one pass."""
    m = F.col("metadata")
    r = runs.select(
        U.host(F.col("domain")).alias("domain"), F.coalesce(R.filled(m["journal"]), U.host(F.col("domain"))).alias("journal"), R.text(m["volume"]).alias("volume"), R.text(m["issue"]).alias("issue"),
        R.article_identity(m, F.col("pdf_url"), F.col("page_url")).alias("article"), F.coalesce("ok", F.lit(False)).cast("int").alias("ok"),
    )
    g = r.groupingSets([["domain", "journal"], ["domain", "journal", "volume", "issue"]], "domain", "journal", "volume", "issue")
    g = g.agg(F.countDistinct("article").alias("articles"), F.sum("ok").alias("pdfs"), (F.grouping("volume") == 0).alias("by_issue"))
    return g.withColumn("ratio", F.round(F.col("pdfs") / F.col("articles"), 6))


def round_robin(runs: DataFrame, per_domain: int | None = None) -> DataFrame:
    """(turn, domain, pdf_url): addresses not yet downloaded, one of each domain in turn."""
    u = runs.where("trim(coalesce(pdf_url, '')) <> ''").groupBy(U.host(F.col("domain")).alias("domain"), F.trim("pdf_url").alias("pdf_url")).agg(F.min("seq").alias("seq"), F.max(F.coalesce("ok", F.lit(False)).cast("int")).alias("done")).where("done = 0")
    u = u.withColumn("turn", F.row_number().over(Window.partitionBy("domain").orderBy("seq", "pdf_url")))
    return (u.where(F.col("turn") <= per_domain) if per_domain else u).select("turn", "domain", "pdf_url")
