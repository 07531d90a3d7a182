"""Queries over acquisition records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import records as R
from corpusloom.functions import urls as U
from corpusloom.operators import record_stats as S
from corpusloom.session import table

SPLIT = "run-202212"  # the runs up to here are the base of the delta


def _runs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "run_records")


def record_keys(spark: SparkSession, d: str) -> DataFrame:
    """Identities of every record."""
    m, p, g = F.col("metadata"), F.col("pdf_url"), F.col("page_url")
    return _runs(spark, d).select(
        "record_id", F.md5(R.article_key(m, p, g)).alias("article_key"), F.md5(R.article_identity(m, p, g)).alias("identity"), R.document_id(F.col("pdf_sha256"), F.col("local_path")).alias("document_id"),
        U.host(p).alias("host"), U.slug(g).alias("slug"), R.year(m["year"], m["date"]).alias("year"),
        R.issue_key(m["journal"], U.host(F.col("domain")), m["volume"], m["issue"], m["year"]).alias("issue_key"), R.slug_key(m["journal"]).alias("journal_key"), F.round(R.completeness(m), 2).alias("complete"),
    )


def record_contexts(spark: SparkSession, d: str) -> DataFrame:
    """Hints of the journal in set, query and path of every record."""
    return _runs(spark, d).select("record_id", F.array_join(R.contexts(F.col("pdf_url"), F.col("page_url"), F.col("metadata.url"), F.col("metadata.dc_set_spec")), "|").alias("contexts"))


def partial_dates(spark: SparkSession, d: str) -> DataFrame:
    """Dates of records as intervals."""
    return _runs(spark, d).select("record_id", R.partial_date(F.col("metadata.date")).alias("p")).where("p is not null").select("record_id", "p.*")


def url_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Kinds of addresses by site."""
    r = _runs(spark, d).select(U.host(F.col("domain")).alias("domain"), F.explode(F.array(F.struct(F.lit("pdf_url").alias("field"), F.col("pdf_url").alias("u")), F.struct(F.lit("page_url").alias("field"), F.col("page_url").alias("u")))).alias("x"))
    return r.where("x.u is not null").groupBy("domain", F.col("x.field").alias("field"), U.url_class(F.col("x.u")).alias("kind")).agg(F.count("*").alias("n"))


def url_templates(spark: SparkSession, d: str) -> DataFrame:
    """Paths with their numbers left out, by site."""
    r = _runs(spark, d).where("pdf_url is not null")
    return r.groupBy(U.host(F.col("pdf_url")).alias("host"), F.regexp_replace(U.template(F.col("pdf_url")), r"/[a-z0-9]{1,4}/download$", "/{id}/download").alias("template")).agg(F.count("*").alias("n"))


def metadata_quality(spark: SparkSession, d: str) -> DataFrame:
    """Completeness of metadata by site, with the site's platform in the registry."""
    m = F.col("metadata")
    miss = lambda c, name: F.sum((R.text(c) == "").cast("int")).alias(name)
    r = _runs(spark, d).groupBy(U.host(F.col("domain")).alias("host")).agg(F.count("*").alias("records"), F.round(F.avg(R.completeness(m)), 6).alias("complete"), miss(m["title"], "no_title"), miss(m["volume"], "no_volume"), miss(m["doi"], "no_doi"), F.sum((F.coalesce(F.size(m["authors"]), F.lit(0)) <= 0).cast("int")).alias("no_authors"))
    reg = table(spark, d, "registry").groupBy(U.host(F.col("host")).alias("host")).agg(F.max_by(R.platform(F.col("platform")), "seq").alias("platform"))
    return r.join(reg, "host", "left")


def error_classes(spark: SparkSession, d: str) -> DataFrame:
    """Failures by class with the addresses and sites they hit."""
    f = S.failures(_runs(spark, d))
    return f.groupBy("error_class").agg(F.count("*").alias("failures"), F.countDistinct("pdf_url").alias("addresses"), F.countDistinct(U.host(F.col("domain"))).alias("sites"))


def retry_set(spark: SparkSession, d: str) -> DataFrame:
    """The last failure worth a retry of every address."""
    return S.latest_retryable(_runs(spark, d))


def blocked_set(spark: SparkSession, d: str) -> DataFrame:
    """The first blocked failure of every address."""
    return S.first_blocked(_runs(spark, d))


def run_delta(spark: SparkSession, d: str) -> DataFrame:
    """What changed between the addresses of earlier and later runs."""
    r = _runs(spark, d)
    return S.delta(S.url_index(r.where(F.col("run_id") <= SPLIT)), S.url_index(r.where(F.col("run_id") > SPLIT)))


def url_sets(spark: SparkSession, d: str) -> DataFrame:
    """Distinct addresses that were fetched, by site."""
    return _runs(spark, d).where("ok and pdf_url is not null").groupBy(U.host(F.col("domain")).alias("domain")).agg(F.countDistinct(U.without_fragment(F.col("pdf_url"))).alias("addresses"), F.countDistinct("pdf_sha256").alias("files"))


def volume_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Volumes missing between the first and the last of every site."""
    return S.gaps(S.placed(_runs(spark, d)), ["domain"], "volume")


def issue_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Issues missing between the first and the last of every volume."""
    return S.gaps(S.placed(_runs(spark, d)).where("volume is not null"), ["domain", "volume"], "issue")


def issue_outliers(spark: SparkSession, d: str) -> DataFrame:
    """Issues with at most half the median number of records."""
    return S.issue_outliers(S.placed(_runs(spark, d)))


def site_completeness(spark: SparkSession, d: str) -> DataFrame:
    """Gaps, outliers, share of PDFs and confidence by site."""
    return S.completeness(S.placed(_runs(spark, d)))


def journal_summary(spark: SparkSession, d: str) -> DataFrame:
    """Articles and span of dates by site."""
    return S.journal_summary(_runs(spark, d))


def export_grains(spark: SparkSession, d: str) -> DataFrame:
    """Articles and PDFs by journal and by issue."""
    return S.export_grains(_runs(spark, d))


def failure_streaks(spark: SparkSession, d: str) -> DataFrame:
    """Longest runs of failures by site."""
    return S.failure_streaks(_runs(spark, d))


def download_plan(spark: SparkSession, d: str) -> DataFrame:
    """Addresses not yet fetched, one of each site in turn."""
    return S.round_robin(_runs(spark, d))


QUERIES = {
    f.__name__: f
    for f in (
        record_keys, record_contexts, partial_dates, url_kinds, url_templates, metadata_quality, error_classes, retry_set, blocked_set, run_delta, url_sets, volume_gaps, issue_gaps, issue_outliers,
        site_completeness, journal_summary, export_grains, failure_streaks, download_plan,
    )
}


def _host(c: str) -> str:
    return f"regexp_replace(regexp_replace(regexp_replace(lower(trim({c})), '^[a-z][a-z0-9+.-]*://', ''), '[/:?#].*$', ''), '^www\\.', '')"


def _path(c: str) -> str:
    return f"regexp_replace(regexp_replace(trim({c}), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '[?#].*$', '')"


def _slug(c: str) -> str:
    return f"lower(regexp_extract({_path(f"coalesce({c}, '')")}, '^/*([^/]+)', 1))"


_t = lambda c: f"coalesce(trim({c}), '')"
_AUTHORS = "coalesce(array_to_string(list_filter(list_transform(metadata.authors, lambda a: trim(a)), lambda a: a <> ''), '; '), '')"
_KEY = f"""CASE WHEN {_t('metadata.url')} <> '' THEN 'url:' || lower({_t('metadata.url')}) WHEN {_t('metadata.doi')} <> '' THEN 'doi:' || lower({_t('metadata.doi')})
  WHEN {_t('metadata.title')} <> '' THEN 'title:' || lower({_t('metadata.title')}) || '|vol:' || lower({_t('metadata.volume')}) || '|iss:' || lower({_t('metadata.issue')}) || '|date:' || lower(coalesce(nullif(trim(metadata.date), ''), nullif(trim(metadata.year), ''), '')) || '|auth:' || lower({_AUTHORS})
  WHEN {_t('pdf_url')} <> '' THEN 'pdf:' || lower({_t('pdf_url')}) ELSE 'page:' || lower({_t('page_url')}) END"""
_IDENTITY = f"""CASE WHEN {_t('metadata.url')} <> '' THEN 'url:' || lower({_t('metadata.url')}) WHEN {_t('metadata.doi')} <> '' THEN 'doi:' || lower({_t('metadata.doi')})
  WHEN {_t('metadata.title')} <> '' THEN 'title:' || lower({_t('metadata.title')}) || '|v:' || lower({_t('metadata.volume')}) || '|i:' || lower({_t('metadata.issue')}) || '|y:' || lower(coalesce(nullif(trim(metadata.year), ''), nullif(trim(metadata.date), ''), ''))
  ELSE lower(coalesce(nullif(trim(page_url), ''), nullif(trim(pdf_url), ''), '')) END"""
_COMPLETE = f"round((CAST({_t('metadata.title')} <> '' AS INT) + CAST(coalesce(len(metadata.authors), 0) > 0 AS INT) + CAST({_t('metadata.volume')} <> '' AS INT) + CAST(coalesce(nullif(trim(metadata.year), ''), nullif(trim(metadata.date), '')) IS NOT NULL AS INT) + CAST({_t('metadata.url')} <> '' AS INT)) / 5.0, 2)"
_YEAR = lambda c: f"nullif(regexp_extract(coalesce({c}, ''), '\\b((?:18|19|20)\\d{{2}})\\b', 1), '')"
_INT = lambda c: f"TRY_CAST(nullif(regexp_extract(coalesce({c}, ''), '([0-9]{{1,9}})', 1), '') AS INT)"
_CLASS = "CASE WHEN download_state = 'blocked' OR http_status IN (403, 429) THEN 'waf' WHEN http_status = 404 THEN 'not_found' WHEN http_status >= 500 THEN 'server' WHEN http_status IS NULL OR http_status = 0 THEN 'network' ELSE 'other' END"
_HINTS = ", ".join([f"regexp_replace(lower({_t('metadata.dc_set_spec')}), '^.*:', '')"] + [x for c in ("pdf_url", "page_url", "metadata.url") for x in (*[f"lower(regexp_extract(coalesce({c}, ''), '[?&]{k}=([^&#]+)', 1))" for k in ("context", "publication", "collection")], f"CASE WHEN NOT {_slug(c)} LIKE '%.cgi' THEN {_slug(c)} ELSE '' END")])
_PLACED = f"SELECT {_host('domain')} AS domain, {_INT('metadata.volume')} AS volume, {_INT('metadata.issue')} AS issue, {_t('metadata.record_type')} AS record_type, pdf_url FROM run_records"
_MONTH = "list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], substr({}, 1, 3))"
_NAMES = "january|jan|february|feb|march|mar|april|apr|may|june|jun|july|jul|august|aug|september|sep|october|oct|november|nov|december|dec"


def _dates(source: str, keep: str) -> str:
    """Rows of ``source`` (keep, v) with a date: keep, normalized, start, end, year."""
    return f"""
        a AS (SELECT {keep}, trim(regexp_replace(regexp_replace(lower(coalesce(trim(v), '')), '(\\d)(?:st|nd|rd|th)\\b', '\\1', 'g'), '\\s+', ' ', 'g')) AS t FROM {source}),
        b AS (SELECT *, translate(t, '/.', '--') AS u, regexp_extract(t, '^(\\d{{1,2}}) ({_NAMES}) (\\d{{4}})$', ['d','m','y']) AS dmy, regexp_extract(t, '^({_NAMES}) (\\d{{1,2}}), (\\d{{4}})$', ['m','d','y']) AS mdy, regexp_extract(t, '^({_NAMES}) (\\d{{4}})$', ['m','y']) AS my FROM a),
        c AS (SELECT *, regexp_extract(u, '\\b((?:19|20)\\d{{2}})-(\\d{{1,2}})-(\\d{{1,2}})\\b', ['y','m','d']) AS f, regexp_extract(u, '\\b((?:19|20)\\d{{2}})-(\\d{{1,2}})\\b', ['y','m']) AS ym, regexp_extract(t, '\\b((?:19|20)\\d{{2}})\\b', 1) AS y1 FROM b),
        e AS (SELECT {keep}, CASE
            WHEN TRY_CAST(f.m AS INT) BETWEEN 1 AND 12 AND TRY_CAST(f.d AS INT) BETWEEN 1 AND 31 THEN [TRY_CAST(f.y AS INT), TRY_CAST(f.m AS INT), TRY_CAST(f.d AS INT)]
            WHEN TRY_CAST(ym.m AS INT) BETWEEN 1 AND 12 THEN [TRY_CAST(ym.y AS INT), TRY_CAST(ym.m AS INT), NULL]
            WHEN dmy.m <> '' AND TRY_CAST(dmy.d AS INT) BETWEEN 1 AND 31 THEN [TRY_CAST(dmy.y AS INT), CAST({_MONTH.format('dmy.m')} AS INT), TRY_CAST(dmy.d AS INT)]
            WHEN mdy.m <> '' AND TRY_CAST(mdy.d AS INT) BETWEEN 1 AND 31 THEN [TRY_CAST(mdy.y AS INT), CAST({_MONTH.format('mdy.m')} AS INT), TRY_CAST(mdy.d AS INT)]
            WHEN my.m <> '' THEN [TRY_CAST(my.y AS INT), CAST({_MONTH.format('my.m')} AS INT), NULL]
            WHEN y1 <> '' THEN [TRY_CAST(y1 AS INT), NULL, NULL] END AS x FROM c),
        p AS (SELECT {keep}, lpad(CAST(x[1] AS VARCHAR), 4, '0') || coalesce('-' || lpad(CAST(x[2] AS VARCHAR), 2, '0'), '') || coalesce('-' || lpad(CAST(x[3] AS VARCHAR), 2, '0'), '') AS normalized,
            x[1] * 10000 + coalesce(x[2], 1) * 100 + coalesce(x[3], 1) AS "start", x[1] * 10000 + coalesce(x[2], 12) * 100 + coalesce(x[3], 31) AS "end", x[1] AS year FROM e WHERE x IS NOT NULL)"""


def _gaps(keys: str, value: str) -> str:
    return f"""WITH r AS ({_PLACED}), s AS (SELECT DISTINCT {keys}, {value} AS v FROM r WHERE {value} IS NOT NULL AND (volume IS NOT NULL)),
        w AS (SELECT *, lead(v) OVER (PARTITION BY {keys} ORDER BY v) AS nxt FROM s)
        SELECT {keys}, unnest(range(v + 1, nxt)) AS missing FROM w WHERE nxt > v + 1"""


_OUTLIERS = f"""r AS ({_PLACED}), c AS (SELECT domain, volume, issue, count(*) AS records FROM r WHERE volume IS NOT NULL AND issue IS NOT NULL GROUP BY ALL),
        m AS (SELECT domain, median(records) AS median FROM c GROUP BY domain HAVING count(*) >= 2),
        o AS (SELECT c.domain, c.volume, c.issue, c.records, m.median FROM c JOIN m USING (domain) WHERE c.records <= m.median * 0.5)"""
_INDEX = "SELECT trim(pdf_url) AS pdf_url, arg_max(coalesce(pdf_sha256, ''), (seq, record_id)) AS sha FROM run_records WHERE ok AND trim(coalesce(pdf_url, '')) <> '' AND run_id {} GROUP BY 1"
_FAILED = f"SELECT *, {_CLASS} AS error_class FROM run_records WHERE NOT coalesce(ok, false)"
_PDF = U.PDF_HINTS
_CLS = lambda u: f"CASE WHEN regexp_matches(lower({u}), '{_PDF}') THEN 'pdf' WHEN regexp_matches(lower({_path(u)}), '{U.ARCHIVE_HINTS}') THEN 'archive' WHEN regexp_matches(lower({_path(u)}), '{U.ISSUE_HINTS}') THEN 'issue' WHEN regexp_matches(lower({_path(u)}), '{U.ARTICLE_HINTS}') THEN 'article' ELSE 'other' END"
_PLATFORM = "CASE WHEN k = '' THEN 'unknown' " + " ".join(f"WHEN k IN ({', '.join(repr(s) for s in spellings)}) THEN '{name}'" for name, spellings in R.PLATFORMS.items()) + " ELSE regexp_replace(lower(trim(platform)), '[^a-z0-9]+', '_', 'g') END"

SQL = {
    "record_keys": f"""SELECT record_id, md5({_KEY}) AS article_key, md5({_IDENTITY}) AS identity, substr(sha1(coalesce(nullif(pdf_sha256, ''), local_path, '')), 1, 24) AS document_id,
        {_host('pdf_url')} AS host, {_slug('page_url')} AS slug, coalesce({_YEAR('metadata.year')}, {_YEAR('metadata.date')}, '') AS year,
        CASE WHEN {_t('metadata.volume')} <> '' OR {_t('metadata.issue')} <> '' OR {_t('metadata.year')} <> '' THEN concat_ws('|', lower({_t('metadata.journal')}), {_host('domain')}, lower({_t('metadata.volume')}), lower({_t('metadata.issue')}), lower({_t('metadata.year')})) ELSE '' END AS issue_key,
        coalesce(nullif(regexp_replace(regexp_replace(lower({_t('metadata.journal')}), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'unknown') AS journal_key, {_COMPLETE} AS complete FROM run_records""",
    "record_contexts": f"""WITH h AS (SELECT record_id, [{_HINTS}] AS h FROM run_records), u AS (SELECT record_id, unnest(h) AS x, generate_subscripts(h, 1) AS i FROM h),
        f AS (SELECT record_id, x, min(i) AS i FROM u WHERE x <> '' GROUP BY record_id, x)
        SELECT r.record_id, coalesce(string_agg(f.x, '|' ORDER BY f.i), '') AS contexts FROM run_records r LEFT JOIN f USING (record_id) GROUP BY r.record_id""",
    "partial_dates": f"""WITH s AS (SELECT record_id, metadata.date AS v FROM run_records), {_dates('s', 'record_id')} SELECT * FROM p""",
    "url_kinds": f"""WITH x AS (SELECT {_host('domain')} AS domain, 'pdf_url' AS field, pdf_url AS u FROM run_records UNION ALL SELECT {_host('domain')}, 'page_url', page_url FROM run_records)
        SELECT domain, field, {_CLS('u')} AS kind, count(*) AS n FROM x WHERE u IS NOT NULL GROUP BY ALL""",
    "url_templates": f"""SELECT {_host('pdf_url')} AS host, regexp_replace(regexp_replace({_path('pdf_url')}, '[0-9]+', '{{n}}', 'g'), '/[a-z0-9]{{1,4}}/download$', '/{{id}}/download') AS template, count(*) AS n FROM run_records WHERE pdf_url IS NOT NULL GROUP BY ALL""",
    "metadata_quality": f"""WITH g AS (SELECT {_host('host')} AS host, seq, platform, regexp_replace(lower(coalesce(platform, '')), '[^a-z0-9]+', '', 'g') AS k FROM registry),
        p AS (SELECT host, arg_max({_PLATFORM}, seq) AS platform FROM g GROUP BY host),
        r AS (SELECT {_host('domain')} AS host, count(*) AS records, round(avg({_COMPLETE}), 6) AS complete, sum(CAST({_t('metadata.title')} = '' AS INT)) AS no_title, sum(CAST({_t('metadata.volume')} = '' AS INT)) AS no_volume,
          sum(CAST({_t('metadata.doi')} = '' AS INT)) AS no_doi, sum(CAST(coalesce(len(metadata.authors), 0) <= 0 AS INT)) AS no_authors FROM run_records GROUP BY 1)
        SELECT r.*, p.platform FROM r LEFT JOIN p USING (host)""",
    "error_classes": f"""WITH f AS ({_FAILED}) SELECT error_class, count(*) AS failures, count(DISTINCT pdf_url) AS addresses, count(DISTINCT {_host('domain')}) AS sites FROM f GROUP BY 1""",
    "retry_set": f"""WITH f AS ({_FAILED}), e AS (SELECT *, row_number() OVER (PARTITION BY trim(pdf_url) ORDER BY seq DESC, record_id DESC) AS rn FROM f WHERE {_t('pdf_url')} <> '' AND coalesce(retries, 0) < 3 AND error_class IN ('server', 'network', 'other'))
        SELECT trim(pdf_url) AS pdf_url, record_id, error_class, retries FROM e WHERE rn = 1""",
    "blocked_set": f"""WITH f AS ({_FAILED}), e AS (SELECT *, row_number() OVER (PARTITION BY trim(pdf_url) ORDER BY seq, record_id) AS rn FROM f WHERE {_t('pdf_url')} <> '' AND coalesce(retries, 0) < 3 AND error_class = 'waf')
        SELECT trim(pdf_url) AS pdf_url, record_id, {_host('domain')} AS domain FROM e WHERE rn = 1""",
    "run_delta": f"""WITH b AS ({_INDEX.format(f"<= '{SPLIT}'")}), n AS ({_INDEX.format(f"> '{SPLIT}'")})
        SELECT pdf_url, CASE WHEN b.sha IS NULL THEN 'added' WHEN n.sha IS NULL THEN 'removed' WHEN b.sha <> '' AND n.sha <> '' AND b.sha <> n.sha THEN 'changed' ELSE 'unchanged' END AS change FROM b FULL OUTER JOIN n USING (pdf_url)""",
    "url_sets": f"""SELECT {_host('domain')} AS domain, count(DISTINCT regexp_replace(trim(pdf_url), '#.*$', '')) AS addresses, count(DISTINCT pdf_sha256) AS files FROM run_records WHERE ok AND pdf_url IS NOT NULL GROUP BY 1""",
    "volume_gaps": _gaps("domain", "volume"),
    "issue_gaps": _gaps("domain, volume", "issue"),
    "issue_outliers": f"WITH {_OUTLIERS} SELECT * FROM o",
    "site_completeness": f"""WITH {_OUTLIERS}, vg AS (SELECT domain, count(*) AS n FROM ({_gaps('domain', 'volume')}) GROUP BY 1), ig AS (SELECT domain, count(*) AS n FROM ({_gaps('domain, volume', 'issue')}) GROUP BY 1), oo AS (SELECT domain, count(*) AS n FROM o GROUP BY 1),
        b AS (SELECT domain, count(*) AS records, sum(CAST(record_type <> '' AS INT)) AS typed, sum(CAST(record_type = 'article' AS INT)) AS articles, sum(CAST(record_type = 'article' AND {_t('pdf_url')} <> '' AS INT)) AS article_pdfs, sum(CAST({_t('pdf_url')} <> '' AS INT)) AS pdfs FROM r GROUP BY 1),
        x AS (SELECT b.domain, records, coalesce(vg.n, 0) AS volume_gaps, coalesce(ig.n, 0) AS issue_gaps, coalesce(oo.n, 0) AS outliers, round(CASE WHEN typed > 0 THEN CASE WHEN articles > 0 THEN article_pdfs / articles ELSE 0.0 END ELSE pdfs / records END, 6) AS pdf_ratio
          FROM b LEFT JOIN vg USING (domain) LEFT JOIN ig USING (domain) LEFT JOIN oo USING (domain))
        SELECT *, CASE WHEN volume_gaps = 0 AND issue_gaps = 0 AND outliers = 0 AND pdf_ratio >= 0.9 THEN 'HIGH' WHEN volume_gaps = 0 AND pdf_ratio >= 0.7 THEN 'MEDIUM' ELSE 'LOW' END AS confidence FROM x""",
    "journal_summary": f"""WITH s AS (SELECT {_host('domain')} AS domain, record_id, metadata.date AS v FROM run_records UNION ALL SELECT {_host('domain')}, record_id, metadata.year FROM run_records), {_dates('s', 'domain, record_id')},
        r AS (SELECT {_host('domain')} AS domain, record_id, ok, {_KEY} AS k FROM run_records), dr AS (SELECT DISTINCT record_id FROM p),
        g AS (SELECT domain, count(*) AS records, sum(CAST(coalesce(ok, false) AS INT)) AS downloaded, count(DISTINCT k) AS articles, count(DISTINCT CASE WHEN dr.record_id IS NOT NULL THEN k END) AS articles_with_date FROM r LEFT JOIN dr USING (record_id) GROUP BY 1),
        z AS (SELECT domain, arg_min(normalized, ("start", normalized)) AS earliest, arg_max(normalized, ("end", normalized)) AS latest FROM p GROUP BY 1)
        SELECT g.*, z.earliest, z.latest FROM g LEFT JOIN z USING (domain)""",
    "export_grains": f"""WITH r AS (SELECT {_host('domain')} AS domain, coalesce(nullif(trim(metadata.journal), ''), {_host('domain')}) AS journal, {_t('metadata.volume')} AS volume, {_t('metadata.issue')} AS issue, {_IDENTITY} AS article, CAST(coalesce(ok, false) AS INT) AS ok FROM run_records),
        g AS (SELECT domain, journal, volume, issue, count(DISTINCT article) AS articles, sum(ok) AS pdfs, grouping(volume) = 0 AS by_issue FROM r GROUP BY GROUPING SETS ((domain, journal), (domain, journal, volume, issue)))
        SELECT *, round(pdfs / articles, 6) AS ratio FROM g""",
    "failure_streaks": f"""WITH s AS (SELECT {_host('domain')} AS domain, coalesce(ok, false) AS ok, sum(CAST(coalesce(ok, false) AS INT)) OVER (PARTITION BY {_host('domain')} ORDER BY seq, record_id) AS island FROM run_records),
        n AS (SELECT domain, island, count(*) AS n FROM s WHERE NOT ok GROUP BY ALL) SELECT domain, max(n) AS longest, count(*) AS streaks FROM n GROUP BY 1""",
    "download_plan": f"""WITH u AS (SELECT {_host('domain')} AS domain, trim(pdf_url) AS pdf_url, min(seq) AS seq, max(CAST(coalesce(ok, false) AS INT)) AS done FROM run_records WHERE trim(coalesce(pdf_url, '')) <> '' GROUP BY 1, 2)
        SELECT CAST(row_number() OVER (PARTITION BY domain ORDER BY seq, pdf_url) AS INT) AS turn, domain, pdf_url FROM u WHERE done = 0""",
}
