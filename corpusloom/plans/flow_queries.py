"""Queries over events, merges, routes and signals; a stream run to its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import records as R
from corpusloom.functions import urls as U
from corpusloom.operators import groups as G
from corpusloom.operators import html as H
from corpusloom.operators import merge as M
from corpusloom.session import staging_path, table
from corpusloom.streaming import cooldown, events


def event_windows(spark: SparkSession, d: str) -> DataFrame:
    """Events by hour and type."""
    return events.windowed(table(spark, d, "events"))


def event_slides(spark: SparkSession, d: str) -> DataFrame:
    """Events by sliding windows of six hours."""
    return events.windowed(table(spark, d, "events"), "6 hours", "2 hours")


def event_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of users with gaps of at most twelve hours."""
    return events.sessions(table(spark, d, "events"), "12 hours")


def event_props(spark: SparkSession, d: str) -> DataFrame:
    """Events by a value of their JSON properties."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    return table(spark, d, "events").groupBy(k.alias("k")).agg(F.count("*").alias("events"), F.round(F.sum("value"), 4).alias("total"))


def _drained(stream: DataFrame) -> DataFrame:
    """What a stream has written when its source is read to the end."""
    spark = stream.sparkSession
    base = staging_path(spark, "stream")
    q = stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def _stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.readStream.schema(table(spark, d, name).schema).parquet(f"{d}/{name}.parque[t]")


def streamed_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """What a circuit breaker does with the outcomes of every site, as a stream."""
    o = _stream(spark, d, "run_records").select(U.host(F.col("domain")).alias("key"), F.timestamp_seconds("seq").alias("ts"), F.coalesce("ok", F.lit(False)).alias("ok")).where("key is not null and ts is not null")
    return _drained(cooldown.cooldowns(o, threshold=2, seconds=200)).groupBy("key").agg(F.count("*").alias("outcomes"), F.sum(F.col("opened").cast("int")).alias("opened"), F.sum(F.col("refused").cast("int")).alias("refused"))


def merged_articles(spark: SparkSession, d: str) -> DataFrame:
    """Records of the same address, merged field by field by the rank of their source."""
    m = F.col("metadata")
    r = table(spark, d, "run_records").select("seq", R.filled(F.col("pdf_url")).alias("pdf_url"), R.filled(m["title"]).alias("title"), R.filled(m["volume"]).alias("volume"), R.filled(m["date"]).alias("date"), R.filled(F.col("local_path")).alias("local_path"), F.when(F.col("extraction_path") == "primary", 3).when(F.col("extraction_path") == "fallback", 2).otherwise(1).alias("source_rank"))
    return M.merge_ranked(r, "pdf_url", ["title", "volume", "date", "local_path"], F.col("source_rank"), "seq")


def routed_sites(spark: SparkSession, d: str) -> DataFrame:
    """Sites by the route their host takes."""
    routes = spark.createDataFrame([("test", "generic_test"), ("lawjournal.test", "wordpress"), ("law.bramlumen.test", "digital_commons"), ("example", "generic_example"), ("ojs.holcairn.example", "ojs")], "suffix string, route string")
    r = M.routed(table(spark, d, "run_records").select("record_id", U.host(F.col("domain")).alias("host")), "host", routes)
    return r.groupBy("route").agg(F.count("*").alias("records"), F.countDistinct("host").alias("hosts"))


def ruled_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents by the first rule their text matches."""
    rules = spark.createDataFrame([("contents", 1, "(?i)table of contents"), ("symposium", 2, "(?i)symposium"), ("by_line", 3, r"(?m)^By [A-Z]"), ("sections", 4, "§")], "rule string, position int, pattern string")
    return M.first_rule(table(spark, d, "documents"), "doc_id", F.col("text"), rules)


def site_marks(spark: SparkSession, d: str) -> DataFrame:
    """High-water marks of fetched files by site over two halves of the runs."""
    n = lambda cond: table(spark, d, "run_records").where("ok").where(cond).groupBy(U.host(F.col("domain")).alias("domain")).agg(F.countDistinct("pdf_url").alias("n"))
    return M.high_water(n("run_id <= 'run-202212'"), n("run_id > 'run-202212'"), "domain", "n")


def document_signals(spark: SparkSession, d: str) -> DataFrame:
    """Shares of characters of every document."""
    return table(spark, d, "documents").select("doc_id", *M.text_signals(F.col("text")))


def quota_sample(spark: SparkSession, d: str) -> DataFrame:
    """Fifty evaluated PDFs, shared out over platforms with a floor of three, by a seeded order; a PDF's latest platform counts."""
    s = table(spark, d, "doc_stats").select("pdf_id", "evaluated_at", R.platform(F.col("platform_family")).alias("platform"))
    s = s.groupBy("pdf_id").agg(F.max_by("platform", F.struct("evaluated_at", "platform")).alias("platform"))
    return G.drawn(s, "platform", "pdf_id", G.quotas(s.groupBy("platform").agg(F.count("*").alias("n")), "platform", 50, 3), 7)


def page_links(spark: SparkSession, d: str) -> DataFrame:
    """Links of pages made from records, by kind."""
    r = table(spark, d, "run_records").where("page_url is not null")
    page = F.concat(F.lit("<html><title>t</title><a href='"), F.coalesce("pdf_url", F.lit("#")), F.lit("'>PDF</a> <a href=\"/archive\">All issues</a><a href='mailto:x@y.z'>Mail</a></html>"))
    return H.classified_links(r.select(F.col("page_url").alias("url"), page.alias("html"))).groupBy("kind").agg(F.count("*").alias("links"))


QUERIES = {
    f.__name__: f
    for f in (
        event_windows, event_slides, event_sessions, event_props, streamed_outcomes, merged_articles, routed_sites, ruled_documents, site_marks, document_signals, quota_sample, page_links,
    )
}

_H = "regexp_replace(regexp_replace(regexp_replace(lower(trim(domain)), '^[a-z][a-z0-9+.-]*://', ''), '[/:?#].*$', ''), '^www\\.', '')"
_W = lambda size, slide: f"""WITH w AS (SELECT *, unnest(range(0, {size // slide})) AS i FROM events), x AS (SELECT epoch_us(time_bucket(INTERVAL '{slide} hours', ts, TIMESTAMP '1970-01-01')) - i * {slide} * 3600000000 AS s, event_type, value FROM w)
        SELECT make_timestamp(s) AS start, make_timestamp(s + {size} * 3600000000) AS "end", event_type, count(*) AS events, round(sum(value), 4) AS total FROM x GROUP BY ALL"""  # noqa: E731
_BEST = lambda c: f"arg_max({c}, CASE WHEN {c} IS NOT NULL THEN rk * 10000000000 - seq END) AS {c}"
_SH = lambda p, n: f"round(length(regexp_replace(t, '{p}', '', 'g')) / greatest(length(t), 1), 6) AS {n}"

SQL = {
    "event_windows": _W(1, 1),
    "event_slides": _W(6, 2),
    "event_sessions": """WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL '12 hours' THEN 0 ELSE 1 END AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
        SELECT user_id, min(ts) AS start, max(ts) + INTERVAL '12 hours' AS "end", count(*) AS events FROM s GROUP BY user_id, k""",
    "event_props": "SELECT TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k, count(*) AS events, round(sum(value), 4) AS total FROM events GROUP BY 1",
    "merged_articles": f"""WITH r AS (SELECT seq, nullif(trim(pdf_url), '') AS pdf_url, nullif(trim(metadata.title), '') AS title, nullif(trim(metadata.volume), '') AS volume, nullif(trim(metadata.date), '') AS date, nullif(trim(local_path), '') AS local_path, CASE WHEN extraction_path = 'primary' THEN 3 WHEN extraction_path = 'fallback' THEN 2 ELSE 1 END AS rk FROM run_records)
        SELECT pdf_url, {_BEST('title')}, {_BEST('volume')}, {_BEST('date')}, {_BEST('local_path')}, count(DISTINCT rk) AS sources FROM r WHERE pdf_url IS NOT NULL GROUP BY 1""",
    "routed_sites": f"""WITH h AS (SELECT {_H} AS host FROM run_records), r AS (SELECT host, CASE WHEN host = 'ojs.holcairn.example' THEN 'ojs' WHEN host LIKE '%.law.bramlumen.test' OR host = 'law.bramlumen.test' THEN 'digital_commons' WHEN host LIKE '%.lawjournal.test' OR host = 'lawjournal.test' THEN 'wordpress' WHEN host LIKE '%.test' THEN 'generic_test' WHEN host LIKE '%.example' THEN 'generic_example' ELSE 'generic' END AS route FROM h)
        SELECT route, count(*) AS records, count(DISTINCT host) AS hosts FROM r GROUP BY 1""",
    "ruled_documents": """WITH r AS (SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)table of contents') THEN 'contents' WHEN regexp_matches(text, '(?i)symposium') THEN 'symposium' WHEN regexp_matches(text, '(?m)^By [A-Z]') THEN 'by_line' WHEN contains(text, '§') THEN 'sections' END AS rule FROM documents) SELECT * FROM r WHERE rule IS NOT NULL""",
    "site_marks": f"""WITH a AS (SELECT {_H} AS domain, count(DISTINCT pdf_url) AS n FROM run_records WHERE ok AND run_id <= 'run-202212' GROUP BY 1), b AS (SELECT {_H} AS domain, count(DISTINCT pdf_url) AS n FROM run_records WHERE ok AND run_id > 'run-202212' GROUP BY 1)
        SELECT domain, greatest(coalesce(a.n, 0), coalesce(b.n, 0)) AS mark, coalesce(b.n, 0) < coalesce(a.n, 0) AS regressed FROM a FULL OUTER JOIN b USING (domain)""",
    "document_signals": rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents) SELECT doc_id, CAST(length(t) AS INT) AS chars, {_SH('[^A-Za-z]', 'letters')}, {_SH('[^0-9]', 'digits')}, {_SH('[^A-Z]', 'capitals')}, {_SH(r'[^\x00-\x08\x0B\x0C\x0E-\x1F]', 'controls')}, CAST(len(regexp_extract_all(t, '[A-Za-z0-9]+')) AS INT) AS words FROM d""",
}
