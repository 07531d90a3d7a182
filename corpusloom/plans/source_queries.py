"""Queries that write through the sinks and read back through the readers, and over pages made of stored records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import records as R
from corpusloom.functions import urls as U
from corpusloom.operators import boundaries as B
from corpusloom.operators import columns as L
from corpusloom.operators import html as H
from corpusloom.plans import record_queries as Q
from corpusloom.session import staging_path, table
from corpusloom.sources import readers, sinks


def manifest_lines(spark: SparkSession, d: str) -> DataFrame:
    """Records written as JSON lines in two appends and read as a manifest: a missing ``ok`` is true."""
    runs, path = table(spark, d, "run_records"), staging_path(spark, "lines")
    for half in (0, 1):
        sinks.append_lines(runs.where(f"record_id % 2 = {half}").drop("seq"), path)
    return readers.manifest(spark, path).select("record_id", "ok", "pdf_url", "retries", F.col("metadata.title").alias("title"))


def bad_line_counts(spark: SparkSession, d: str) -> DataFrame:
    """Records of which every tenth line is cut in half, every eleventh is blank and every twelfth a list: what is read and what is not."""
    runs, path = table(spark, d, "run_records").select("record_id", F.to_json(F.struct("record_id", "ok", "pdf_url")).alias("j")), staging_path(spark, "bad")
    k = F.col("record_id")
    runs.select(F.when(k % 10 == 0, F.substring("j", 1, 9)).when(k % 11 == 0, "  ").when(k % 12 == 0, F.concat(F.lit("["), "j", F.lit("]"))).otherwise(F.col("j")).alias("value")).write.text(path)
    read = readers.records(spark, path)
    return readers.good(read).agg(F.count("*").alias("good")).join(readers.bad_lines(read).agg(F.sum("lines").alias("bad")))


def registry_csv(spark: SparkSession, d: str) -> DataFrame:
    """The registry written as CSV and read with all its columns as strings, empty where missing."""
    reg, path = table(spark, d, "registry"), staging_path(spark, "csv")
    sinks.joined_csv(reg, path)
    return readers.registry(spark, path, ["seq", "journal_name", "url", "host", "platform", "status", "not_there"])


def seed_files(spark: SparkSession, d: str) -> DataFrame:
    """Seed files made of the registry, one for every host, with a range in every second address, read and expanded."""
    reg, path = table(spark, d, "registry").where("host <> '' and url <> ''"), staging_path(spark, "seeds")
    start = F.when(F.col("seq") % 2 == 0, F.concat("url", F.lit("/volume-[2-4]"))).otherwise(F.concat("url", F.lit("/volume")))
    seed = F.to_json(F.struct(F.col("journal_name").alias("id"), F.array(start).alias("start_urls"), F.struct("url", "journal_name", "platform", F.nullif("status", F.lit("")).alias("status")).alias("metadata")))
    # one host's part of the registry, which is of fixed size
    one = reg.groupBy("host").agg(F.concat(F.lit("["), F.array_join(F.collect_list(seed), ","), F.lit("]")).alias("value"))
    one.write.partitionBy("host").text(path)
    return readers.seeds(spark, path, "*.txt").groupBy("seed_url", "status").agg(F.count("*").alias("seeds"))


def host_dossiers(spark: SparkSession, d: str) -> DataFrame:
    """A JSON document for every host of the registry, read as variants."""
    reg, path = table(spark, d, "registry").where("host <> ''"), staging_path(spark, "dossiers")
    one = reg.groupBy("host").agg(F.to_json(F.struct(F.first("host").alias("name"), F.sort_array(F.collect_set("journal_name")).alias("journals"))).alias("value"))
    one.write.partitionBy("host").text(path)
    body = readers.sidecars(spark, path, "*.txt")
    return body.select(F.variant_get("body", "$.name", "string").alias("host"), F.variant_get("body", "$.journals[0]", "string").alias("first_journal"), F.size(F.variant_get("body", "$.journals", "array<string>")).alias("journals"))


def typed_sidecars(spark: SparkSession, d: str) -> DataFrame:
    """Sidecars of typed lines, one for every host of the registry with its rows as notes, folded to a row."""
    reg, path = table(spark, d, "registry").where("host <> ''"), staging_path(spark, "typed")
    meta = reg.select("host", F.to_json(F.struct(F.lit("metadata").alias("type"), F.col("host").alias("name"))).alias("value")).distinct()
    notes = reg.select("host", F.to_json(F.struct(F.lit("footnote").alias("type"), F.col("seq").alias("ordinal"), F.col("journal_name").alias("text"))).alias("value"))
    # a host's rows in one file
    meta.unionAll(notes).repartition(8, "host").write.partitionBy("host").text(path)
    s = readers.line_sidecars(spark, path, "*.txt")
    return s.select(F.get_json_object("meta", "$.name").alias("host"), F.size("notes").alias("notes"), F.get_json_object(F.get("notes", F.lit(0)), "$.text").alias("first_text"))


def candidate_list(spark: SparkSession, d: str) -> DataFrame:
    """Candidates written with tabs and read from a priority on; what is no number counts as 0."""
    pdfs, path = table(spark, d, "pdf_records"), staging_path(spark, "tsv")
    pdfs.select("path", F.when(F.col("pdf_id") % 7 == 0, "high").otherwise((F.coalesce("page_count", F.lit(0)) / 100).cast("string")).alias("priority")).write.option("sep", "\t").option("header", True).csv(path)
    return readers.candidates(spark, path, 0.2).select("path", F.col("priority").cast("double").alias("priority"))


def cache_fresh(spark: SparkSession, d: str) -> DataFrame:
    """Entries of a cache of version 2 that are newer than their files; every third is older, every fourth of another version."""
    pdfs = table(spark, d, "pdf_records").where("mtime is not null")
    cache = pdfs.select("path", (F.col("mtime") + F.when(F.col("pdf_id") % 3 == 0, -1).otherwise(1)).alias("cached"), F.when(F.col("pdf_id") % 4 == 0, "1").otherwise("2").alias("version"))
    return readers.fresh(cache, pdfs.select("path", F.col("mtime").alias("modified")), "2").select("path", "version")


def cache_kept(spark: SparkSession, d: str) -> DataFrame:
    """The newest files that fit into two hundred million bytes together."""
    pdfs = table(spark, d, "pdf_records").where("mtime is not null and size is not null").select("pdf_id", "size", F.timestamp_seconds("mtime").alias("at"))
    return sinks.within_bytes(pdfs, "size", "at", "pdf_id", 200_000_000).select("pdf_id", "size")


def latest_run(spark: SparkSession, d: str) -> DataFrame:
    """Records of the last run by site."""
    return readers.latest_run(spark, table(spark, d, "run_records")).groupBy("domain").agg(F.count("*").alias("records"))


def shard_files(spark: SparkSession, d: str) -> DataFrame:
    """Documents written as shards in two runs, the second of which leaves out what the first has done."""
    docs, path = table(spark, d, "documents").select("doc_id", "lang", "n_chars"), staging_path(spark, "shards")
    sinks.shards(docs.where("doc_id % 3 = 0"), f"{path}/a", 500)
    done = spark.read.parquet(f"{path}/a")
    sinks.shards(sinks.new_only(docs, done, "doc_id"), f"{path}/b", 500)
    both = done.withColumn("run", F.lit("a")).unionByName(spark.read.parquet(f"{path}/b").withColumn("run", F.lit("b")))
    return both.groupBy("run", "lang").agg(F.count("*").alias("documents"), F.sum("n_chars").alias("chars"))


def exported_counts(spark: SparkSession, d: str) -> DataFrame:
    """Records exported as compressed lines, with the manifest of their states."""
    return sinks.export(table(spark, d, "run_records").select("record_id", "download_state", "pdf_url"), staging_path(spark, "export"), "download_state")


def stored_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of a folder by shard of their names: one for every host of the registry."""
    path = staging_path(spark, "files")
    table(spark, d, "registry").where("host <> ''").select("host").distinct().withColumn("value", F.col("host")).write.partitionBy("host").text(path)
    files = [readers.files(spark, path, "*.txt", 4, k) for k in range(4)]
    every = files[0].unionAll(files[1]).unionAll(files[2]).unionAll(files[3])
    return every.select(F.trim(F.regexp_replace(F.col("content").cast("string"), "\n", "")).alias("host"), "size")


# ---------------------------------------------------------------- stored pages
def escaped(text: Column) -> Column:
    """Text as it stands in HTML, in attributes too."""
    out = F.coalesce(text, F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def html_notes(spark: SparkSession, d: str) -> DataFrame:
    """Notes of sidecars, set as lists of pages and read from them."""
    s = table(spark, d, "sidecars").where("size(notes) > 0")
    item = lambda n, i: F.concat(F.lit('<li id="fn'), (i + 1).cast("string"), F.lit('">'), (i + 1).cast("string"), F.lit(". <i>"), escaped(n["text"]), F.lit("</i> ↩</li>"))
    page = F.concat(F.lit("<html><body><p>text</p><ol>"), F.array_join(F.transform("notes", item), ""), F.lit("</ol>"))
    r = s.select("pdf_id", "extractor_version", F.explode(H.notes(page)).alias("n"))
    return r.select("pdf_id", "extractor_version", F.col("n.label").cast("int").alias("label"), F.md5("n.text").alias("text"))


def record_pages(spark: SparkSession, d: str) -> DataFrame:
    """Tags of the pages of records: each record set as a page with its metadata and read from it."""
    r, m = table(spark, d, "run_records"), F.col("metadata")
    tag = lambda name, c: F.when(R.filled(c).isNotNull(), F.concat(F.lit(f'<meta name="{name}" content="'), escaped(c), F.lit('">'))).otherwise("")
    page = F.concat(F.lit("<html><head><title>"), escaped(m["title"]), F.lit("</title>"), tag("citation_title", m["title"]), tag("citation_date", m["date"]), tag("citation_pdf_url", F.col("pdf_url")), F.lit("</head>"))
    out = r.select("record_id", H.metadata(page).alias("p"))
    return out.select("record_id", F.md5(F.coalesce("p.title", F.lit(""))).alias("title"), F.md5(F.coalesce("p.citation_title", F.lit(""))).alias("citation_title"), F.col("p.citation_date").alias("date"), F.col("p.citation_pdf_url").alias("pdf_url"))


def _site_pages(spark: SparkSession, d: str) -> DataFrame:
    """(seq, url, html, platform): a page for every row of the registry with the signs of its platform and links."""
    sign = F.when(F.col("platform") == "WordPress", "<link href='/wp-content/x.css'>").when(F.col("platform") == "OJS", "<meta name='generator' content='Open Journal Systems'>").when(F.col("platform") == "Drupal", "<script>drupal-settings-json</script>").otherwise("")
    foot = F.when(F.col("seq") % 5 == 0, F.repeat(F.lit("<script></script>"), 12)).otherwise("<a href='/archive'>All issues</a> <a href='volumes'>V</a> <a href='https://elsewhere.test/archive'>x</a> <a href='/archive#top'>again</a> <a href='/about'>About</a>")
    return table(spark, d, "registry").where("url <> ''").select("seq", "url", F.concat(F.lit("<html>"), sign, foot).alias("html"), "platform")


def site_platforms(spark: SparkSession, d: str) -> DataFrame:
    """Platform of every registry row by its page, address and listing, and whether the page needs scripts."""
    return _site_pages(spark, d).select("seq", H.resolved_platform(F.col("html"), F.col("url"), F.col("platform")).alias("platform"), H.needs_script(F.col("html")).alias("script"))


def archive_links(spark: SparkSession, d: str) -> DataFrame:
    """Links to archives on the pages of the registry's sites."""
    return H.archive_candidates(_site_pages(spark, d).select("url", "html").distinct()).groupBy(U.host(F.col("link")).alias("host"), "place").agg(F.count("*").alias("links"))


def sitemap_pages(spark: SparkSession, d: str) -> DataFrame:
    """Addresses named by sitemaps: a map for every record with its page, its file and an address elsewhere."""
    r = table(spark, d, "run_records").where("page_url is not null and pdf_url is not null")
    loc = lambda c: F.concat(F.lit("<url><loc> "), escaped(c), F.lit(" </loc></url>"))
    content = F.concat(F.lit("<urlset>"), loc(F.col("page_url")), loc(F.col("pdf_url")), loc(F.lit("https://elsewhere.test/x")), loc(F.concat("page_url", F.lit("/logo.png"))), F.lit("</urlset>"))
    return H.page_addresses(r.select(U.host(F.col("page_url")).alias("host"), content.alias("content"))).groupBy("host").agg(F.count("*").alias("addresses"))


# ---------------------------------------------------------------------- layout
def word_lines(spark: SparkSession, d: str) -> DataFrame:
    """Body lines taken apart into words with boxes and put together again; lines stand twelve points apart."""
    p = table(spark, d, "extracted_docs").select(F.col("pdf_id").alias("doc_id"), F.posexplode("pages").alias("page", "p")).select("doc_id", "page", F.posexplode("p.body_lines.text").alias("pos", "t"))
    w = p.select("doc_id", "page", (F.col("pos") * 12.0).alias("top"), F.posexplode(F.filter(F.split("t", r"\s+"), lambda x: x != "")).alias("k", "text"))
    words = w.select("doc_id", "page", (50.0 + 12.0 * F.col("k")).alias("x0"), (60.0 + 12.0 * F.col("k")).alias("x1"), "top", "text")
    return L.lines_of(words).select("doc_id", "page", (F.col("top") / 12).cast("int").alias("pos"), F.md5("text").alias("text"))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "extracted_docs").select(F.col("pdf_id").alias("doc_id"), F.posexplode("pages").alias("page_index", "p")).select("doc_id", "page_index", F.array_join("p.body_lines.text", "\n").alias("text"))


def article_spans(spark: SparkSession, d: str) -> DataFrame:
    """Articles of compiled issues: every document with a first page of contents put before it, which names its third and sixth page and one past it."""
    pages = _pages(spark, d)
    contents = pages.groupBy("doc_id").agg(F.lit(0).alias("page_index"), F.lit("CONTENTS\nFirst ..... 103\nSecond ..... 106\nThird ..... 140").alias("text"))
    numbered = pages.select("doc_id", F.col("page_index") + 1, F.concat((F.col("page_index") + 101).cast("string"), F.lit("\n"), "text"))
    return B.article_spans(contents.unionAll(numbered))


def heading_spans(spark: SparkSession, d: str) -> DataFrame:
    """Articles by pages that open with a heading and an abstract, which every fifth page is given."""
    p = _pages(spark, d)
    return B.heading_spans(p.withColumn("text", F.when(F.col("page_index") % 5 == 0, F.concat(F.lit("A Theory of Leases\nBy A. Author\nAbstract. We show.\n"), "text")).otherwise(F.concat(F.lit("goes on\n"), "text"))))


QUERIES = {
    f.__name__: f
    for f in (
        manifest_lines, bad_line_counts, registry_csv, seed_files, host_dossiers, typed_sidecars, candidate_list, cache_fresh, cache_kept, latest_run, shard_files, exported_counts, stored_files,
        html_notes, record_pages, site_platforms, archive_links, sitemap_pages, word_lines, article_spans, heading_spans,
    )
}

_SP = r"regexp_replace({}, '[\s\x{{00A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}\x{{0085}}\x{{001C}}-\x{{001F}}]+', ' ', 'g')"
_PG = "pg AS (SELECT pdf_id AS doc_id, unnest(pages) AS p, generate_subscripts(pages, 1) - 1 AS page_index, len(pages) AS n FROM extracted_docs)"

SQL = {
    "manifest_lines": "SELECT record_id, coalesce(ok, true) AS ok, pdf_url, retries, metadata.title AS title FROM run_records",
    "bad_line_counts": "SELECT count(*) FILTER (WHERE record_id % 10 <> 0 AND record_id % 11 <> 0 AND record_id % 12 <> 0) AS good, count(*) FILTER (WHERE record_id % 10 = 0 OR (record_id % 11 <> 0 AND record_id % 12 = 0)) AS bad FROM run_records",
    "registry_csv": "SELECT CAST(seq AS VARCHAR) AS seq, coalesce(journal_name, '') AS journal_name, coalesce(url, '') AS url, coalesce(host, '') AS host, coalesce(platform, '') AS platform, coalesce(status, '') AS status, '' AS not_there FROM registry",
    "seed_files": "WITH r AS (SELECT *, coalesce(nullif(status, ''), 'active') AS st FROM registry WHERE host <> '' AND url <> ''), s AS (SELECT url || '/volume-' || unnest([2, 3, 4]) AS seed_url, st FROM r WHERE seq % 2 = 0 UNION ALL SELECT url || '/volume', st FROM r WHERE seq % 2 <> 0) SELECT trim(seed_url) AS seed_url, st AS status, count(*) AS seeds FROM s GROUP BY ALL",
    "host_dossiers": "SELECT host, min(journal_name) AS first_journal, CAST(count(DISTINCT journal_name) AS INT) AS journals FROM registry WHERE host <> '' GROUP BY 1",
    "typed_sidecars": "SELECT host, CAST(count(*) AS INT) AS notes, arg_min(journal_name, seq) AS first_text FROM registry WHERE host <> '' GROUP BY 1",
    "candidate_list": "SELECT path, coalesce(page_count, 0) / 100 AS priority FROM pdf_records WHERE pdf_id % 7 <> 0 AND coalesce(page_count, 0) / 100 >= 0.2",
    "cache_fresh": "SELECT path, '2' AS version FROM pdf_records WHERE mtime IS NOT NULL AND pdf_id % 3 <> 0 AND pdf_id % 4 <> 0",
    "cache_kept": "SELECT pdf_id, size FROM (SELECT pdf_id, size, sum(size) OVER (ORDER BY epoch_us(to_timestamp(mtime)) DESC, pdf_id ROWS UNBOUNDED PRECEDING) AS run FROM pdf_records WHERE mtime IS NOT NULL AND size IS NOT NULL) WHERE run <= 200000000",
    "latest_run": "SELECT domain, count(*) AS records FROM run_records WHERE run_id = (SELECT max(run_id) FROM run_records) GROUP BY 1",
    "shard_files": "SELECT CASE WHEN doc_id % 3 = 0 THEN 'a' ELSE 'b' END AS run, lang, count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY ALL",
    "exported_counts": "SELECT coalesce(download_state, '') AS value, count(*) AS rows FROM run_records GROUP BY 1 UNION ALL SELECT '*', count(*) FROM run_records",
    "stored_files": "SELECT DISTINCT host, CAST(strlen(host) + 1 AS BIGINT) AS size FROM registry WHERE host <> ''",
    "html_notes": f"""WITH n AS (SELECT pdf_id, extractor_version, generate_subscripts(notes, 1) AS label, coalesce(unnest(notes).text, '') AS t FROM sidecars WHERE len(notes) > 0)
        SELECT pdf_id, extractor_version, CAST(label AS INT) AS label, md5(trim({_SP.format("replace(t, '↩', ' ')")})) AS text FROM n""",
    "record_pages": f"SELECT record_id, md5(trim({_SP.format('coalesce(metadata.title, chr(32))')})) AS title, md5(CASE WHEN trim(metadata.title) <> '' THEN metadata.title ELSE '' END) AS citation_title, CASE WHEN trim(metadata.date) <> '' THEN metadata.date END AS date, CASE WHEN trim(pdf_url) <> '' THEN pdf_url END AS pdf_url FROM run_records",
    "site_platforms": r"""WITH a AS (SELECT seq, url, trim(platform) AS p, platform, seq % 5 = 0 AS script FROM registry WHERE url <> '')
        SELECT seq, CASE WHEN platform = 'WordPress' THEN 'wordpress' WHEN platform = 'OJS' THEN 'ojs' WHEN platform = 'Drupal' THEN 'drupal' WHEN regexp_matches(url, 'viewcontent\.cgi|/cgi/') THEN 'digital_commons' WHEN regexp_matches(url, '/index\.php/') THEN 'ojs' WHEN contains(url, 'wp-content') THEN 'wordpress' WHEN p <> '' THEN p ELSE 'unknown' END AS platform, script FROM a""",
    "archive_links": f"WITH u AS (SELECT DISTINCT url FROM registry WHERE url <> '' AND seq % 5 <> 0) SELECT {Q._host('url')} AS host, CAST(place AS INT) AS place, count(*) AS links FROM u, range(1, 3) r(place) GROUP BY ALL",
    "sitemap_pages": f"WITH r AS (SELECT {Q._host('page_url')} AS host, unnest([trim(page_url), trim(pdf_url)]) AS address FROM run_records WHERE page_url IS NOT NULL AND pdf_url IS NOT NULL) SELECT host, count(DISTINCT address) AS addresses FROM r WHERE {Q._host('address')} = host AND address <> '' GROUP BY 1",
    "word_lines": rf"""WITH {_PG}, l AS (SELECT doc_id, page_index AS page, generate_subscripts(p.body_lines, 1) - 1 AS pos, unnest(p.body_lines).text AS t FROM pg), w AS (SELECT doc_id, page, pos, list_filter(string_split_regex(t, '\s+'), lambda x: x <> '') AS ws FROM l)
        SELECT doc_id, CAST(page AS INT) AS page, CAST(pos AS INT) AS pos, md5(array_to_string(ws, ' ')) AS text FROM w WHERE len(ws) > 0""",
    "article_spans": f"""WITH {_PG}, n AS (SELECT doc_id, max(n) AS n FROM pg GROUP BY 1), s AS (SELECT doc_id, unnest([103, 106, 140]) AS ref, n + 1 AS pages FROM n WHERE n >= 3), t AS (SELECT doc_id, ref, ref - 100 AS first_index, pages FROM s WHERE ref - 100 <= pages - 1)
        SELECT doc_id, CAST(ref AS INT) AS ref, CAST(first_index AS INT) AS first_index, CAST(coalesce(lead(first_index) OVER (PARTITION BY doc_id ORDER BY first_index) - 1, pages - 1) AS INT) AS last_index FROM t""",
    "heading_spans": f"WITH {_PG}, k AS (SELECT doc_id, max(n) AS n FROM pg GROUP BY 1 HAVING max(n) > 5), s AS (SELECT doc_id, n, unnest(range(0, n, 5)) AS f FROM k) SELECT doc_id, CAST(f AS INT) AS first_index, CAST(coalesce(lead(f) OVER (PARTITION BY doc_id ORDER BY f) - 1, n - 1) AS INT) AS last_index FROM s",
}
