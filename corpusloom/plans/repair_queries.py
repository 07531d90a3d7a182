"""Queries over repairs, checks and further splits of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import records as R
from corpusloom.functions import urls as U
from corpusloom.functions.text import plain_name
from corpusloom.operators import groups as G
from corpusloom.operators import layout as L
from corpusloom.operators import notes as N
from corpusloom.operators import record_stats as S
from corpusloom.operators import repair as P
from corpusloom.plans import corpus_queries as C
from corpusloom.plans import record_queries as Q
from corpusloom.session import table


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return L.page_lines(table(spark, d, "extracted_docs"))


def ascending_labels(spark: SparkSession, d: str) -> DataFrame:
    """Share of rising steps among the labels at the beginnings of lines, by document."""
    label = F.regexp_extract("text", r"^\s*([0-9]{1,4})[\]).,:;-]?\s+\S", 1).try_cast("int")
    return P.ascending_share(_lines(spark, d).withColumn("label", label), ["pdf_id"], ["page_index", "pos"], "label")


def rising_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Where the labels of a page begin to rise."""
    label = F.regexp_extract("text", r"^\s*([0-9]{1,4})[\]).,:;-]?\s+\S", 1).try_cast("int")
    return P.rising_block(_lines(spark, d).withColumn("label", label))


def filled_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of sidecars with every third one taken away and filled again."""
    n = N.notes_of(table(spark, d, "sidecars")).withColumn("number", F.when(F.col("idx") % 3 != 2, F.col("number")))
    return P.filled_labels(n, ["pdf_id", "extractor_version"], ["idx"]).select("pdf_id", "extractor_version", "idx", "number", "filled")


def sequence_quality(spark: SparkSession, d: str) -> DataFrame:
    """Amount and order of the notes of every sidecar."""
    n = N.notes_of(table(spark, d, "sidecars"))
    s = N.document_labels(n).select("pdf_id", "extractor_version", N.ordinality(F.col("labels")).alias("o")).select("pdf_id", "extractor_version", "o.status", F.size("o.gaps").alias("gap_count"))
    return P.sequence_quality(n, s)


def low_density(spark: SparkSession, d: str) -> DataFrame:
    """Where notes begin on pages of one type size."""
    return L.low_density(_lines(spark, d))


def bimodal_split(spark: SparkSession, d: str) -> DataFrame:
    """Where the small type begins on pages of two."""
    return L.bimodal_split(_lines(spark, d))


def citation_lines(spark: SparkSession, d: str) -> DataFrame:
    """The line of every document that looks most like a citation."""
    return L.citation_line(_lines(spark, d))


def patched_records(spark: SparkSession, d: str) -> DataFrame:
    """Holdings whose empty titles and years are filled from the records of their file."""
    h = table(spark, d, "holdings").select("holding_id", "pdf_url", "title", "year")
    r = table(spark, d, "run_records").where("ok and pdf_url is not null").select("pdf_url", F.col("metadata.title").alias("title"), F.col("metadata.year").alias("year"))
    p = r.groupBy("pdf_url").agg(F.max("title").alias("title"), F.max("year").alias("year"))
    return P.patched(h, p, "pdf_url", ["title", "year"])


def dangling_stats(spark: SparkSession, d: str) -> DataFrame:
    """Evaluated PDFs without notes in sidecars."""
    return P.dangling(table(spark, d, "doc_stats"), "pdf_id", table(spark, d, "sidecars"), "pdf_id")


def repeated_sidecars(spark: SparkSession, d: str) -> DataFrame:
    """PDFs with several sidecars."""
    return P.repeated(table(spark, d, "sidecars"), ["pdf_id"])


def worklist_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Files of every site in chunks of fifty, the newest first."""
    r = table(spark, d, "pdf_records")
    return P.chunked(r, "journal_domain", [F.desc_nulls_last("mtime"), F.col("pdf_id")], "pdf_id", 50)


def retry_targets(spark: SparkSession, d: str) -> DataFrame:
    """Distinct addresses of failures in overlapping classes."""
    f = S.failures(table(spark, d, "run_records")).where("pdf_url is not null")
    one = lambda c: F.countDistinct(F.when(c, F.col("pdf_url")))
    return f.groupBy(U.host(F.col("domain")).alias("domain")).agg(F.countDistinct("pdf_url").alias("all"), one(F.col("error_class") == "waf").alias("blocked"), one(F.col("error_class") == "network").alias("network"), one(F.coalesce("retries", F.lit(0)) > 0).alias("retried"))


def identical_siblings(spark: SparkSession, d: str) -> DataFrame:
    """Files with the same content and the same name but for its version."""
    stem = F.regexp_replace(F.regexp_replace(F.regexp_replace("path", r"^.*/", ""), r"\.[A-Za-z0-9]{1,5}$", ""), r"-[0-9]+$", "")
    return table(spark, d, "pdf_records").groupBy("journal_domain", stem.alias("stem"), F.lower("sha256").alias("sha")).agg(F.count("*").alias("files"), F.min("pdf_id").alias("first_id")).where("files > 1")


def url_places(spark: SparkSession, d: str) -> DataFrame:
    """Volume and issue in the addresses of pages against those of the metadata."""
    low = F.lower("page_url")
    v = F.regexp_extract(low, r"/v(?:ol(?:ume)?)?[-_]?([0-9]{1,4})", 1).try_cast("int")
    i = F.regexp_extract(low, r"/v(?:ol(?:ume)?)?[-_]?[0-9]{1,4}[/_-]?(?:n|no|iss|issue)[-_]?([0-9]{1,3})", 1).try_cast("int")
    r = table(spark, d, "run_records").select(v.alias("volume"), i.alias("issue"), F.col("metadata.volume").try_cast("int").alias("mv"), F.col("metadata.issue").try_cast("int").alias("mi"))
    kind = lambda a, b: F.when(F.col(a).isNull(), "none").when(F.col(b).isNull(), "only_url").when(F.col(a) == F.col(b), "same").otherwise("other")
    return r.groupBy(kind("volume", "mv").alias("volume"), kind("issue", "mi").alias("issue")).agg(F.count("*").alias("records"))


def alias_matches(spark: SparkSession, d: str) -> DataFrame:
    """Spellings of journals in holdings that exactly one journal of the registry has, but for marks and case."""
    reg = table(spark, d, "registry").select(plain_name(F.col("journal_name")).alias("key"), "journal_name").where("key <> ''").groupBy("key").agg(F.countDistinct("journal_name").alias("n"), F.min("journal_name").alias("journal")).where("n = 1").drop("n")
    h = table(spark, d, "holdings").where("trim(journal) <> ''").groupBy(F.trim("journal").alias("name")).agg(F.count("*").alias("holdings"))
    return h.select("name", "holdings", plain_name(F.col("name")).alias("key")).join(reg, "key").select("name", "holdings", "journal")


def resumable_sites(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of the registry that no successful record has begun from."""
    done = table(spark, d, "run_records").where("ok").select(U.host(F.col("seed_url")).alias("host")).distinct()
    reg = table(spark, d, "registry").select(U.host(F.col("url")).alias("host"), "journal_name", R.text(F.col("status")).alias("status")).where("host <> ''")
    return reg.join(done, "host", "left_anti").groupBy("host", "status").agg(F.countDistinct("journal_name").alias("journals"))


def sqrt_sample(spark: SparkSession, d: str) -> DataFrame:
    """Sixty files with quotas by the square root of a site's files, at most eight from one, by a seeded order."""
    r = table(spark, d, "pdf_records").select("journal_domain", "pdf_id").where("journal_domain <> ''")
    n = r.groupBy("journal_domain").agg(F.greatest(F.lit(1), F.round(100 * F.sqrt(F.count("*")))).cast("bigint").alias("n"))
    quota = G.quotas(n, "journal_domain", 60, 0).withColumn("quota", F.least(F.lit(8), "quota"))
    return G.drawn(r, "journal_domain", "pdf_id", quota, 11)


QUERIES = {
    f.__name__: f
    for f in (
        ascending_labels, rising_blocks, filled_labels, sequence_quality, low_density, bimodal_split, citation_lines, patched_records, dangling_stats, repeated_sidecars, worklist_chunks, retry_targets,
        identical_siblings, url_places, alias_matches, resumable_sites, sqrt_sample,
    )
}

_LB = f"{C._L}, lb AS (SELECT *, TRY_CAST(nullif(regexp_extract(text, '^\\s*([0-9]{{1,4}})[\\]).,:;-]?\\s+\\S', 1), '') AS INT) AS label FROM l)"
_SQ = C.SQL["label_ordinality"]
_PN = r"trim(regexp_replace(regexp_replace(replace(lower(strip_accents({})), '&', ' and '), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), '^\s*the ', ''))"



def _quotas(counts: str, group: str, size: int, floor: int) -> str:
    """Common tables up to ``quota`` over ``counts`` (group, n)."""
    return f"""n0 AS (SELECT {group} AS g, n FROM {counts} WHERE n > 0), tg AS (SELECT least({size}, coalesce(sum(n), 0)) AS target FROM n0),
        tu AS (SELECT g, unnest(range(1, least({floor}, n) + 1)) AS turn FROM n0), ta AS (SELECT g, row_number() OVER (ORDER BY turn, g) AS seat FROM tu), tb AS (SELECT g, count(*) AS base FROM ta, tg WHERE seat <= target GROUP BY 1),
        qa AS (SELECT n0.g, coalesce(base, 0) AS base, n - coalesce(base, 0) AS room, target FROM n0 LEFT JOIN tb USING (g), tg), qb AS (SELECT *, target - sum(base) OVER () AS rest, greatest(1, sum(room) OVER ()) AS total FROM qa),
        qc AS (SELECT *, (rest * room) // total AS whole, (rest * room) % total AS part FROM qb), quota AS (SELECT g, base + whole + CAST(row_number() OVER (ORDER BY part DESC, g) <= rest - sum(whole) OVER () AS INT) AS quota FROM qc)"""


SQL = {
    "ascending_labels": f"WITH {_LB}, s AS (SELECT pdf_id, CAST(label > lag(label) OVER (PARTITION BY pdf_id ORDER BY page_index, pos) AS INT) AS rise FROM lb WHERE label IS NOT NULL) SELECT pdf_id, count(rise) AS steps, round(coalesce(avg(rise), 1.0), 6) AS share FROM s GROUP BY 1",
    "rising_blocks": f"""WITH {_LB}, s AS (SELECT *, CAST(lead(label) OVER (PARTITION BY pdf_id, page_index ORDER BY pos) > label AS INT) AS rise FROM lb WHERE label IS NOT NULL),
        w AS (SELECT *, count(rise) OVER x AS steps, coalesce(sum(rise) OVER x, 0) AS good FROM s WINDOW x AS (PARTITION BY pdf_id, page_index ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
        SELECT pdf_id, CAST(page_index AS INT) AS page_index, CAST(min(pos) AS INT) AS start FROM w WHERE steps = 0 OR good / greatest(steps, 1) >= 0.75 GROUP BY ALL""",
    "filled_labels": f"""WITH {C._N}, a AS (SELECT pdf_id, extractor_version, idx, CASE WHEN idx % 3 <> 2 THEN number END AS number FROM n), k AS (SELECT *, last_value(number IGNORE NULLS) OVER w AS known, count(number) OVER w AS run FROM a WINDOW w AS (PARTITION BY pdf_id, extractor_version ORDER BY idx ROWS UNBOUNDED PRECEDING))
        SELECT pdf_id, extractor_version, CAST(idx AS INT) AS idx, number, CAST(known + row_number() OVER (PARTITION BY pdf_id, extractor_version, run ORDER BY idx) - 1 AS INT) AS filled FROM k""",
    "sequence_quality": f"""WITH {C._N}, o AS ({_SQ}), g AS (SELECT pdf_id, extractor_version, count(*) AS c, count(number) AS k, count(DISTINCT number) AS u, avg(length(trim(coalesce(text, '')))) AS mean FROM n GROUP BY ALL),
        s AS (SELECT g.*, o.status, CASE WHEN o.gaps = '' THEN 0 ELSE len(string_split(o.gaps, ',')) END AS gc FROM g JOIN o USING (pdf_id, extractor_version))
        SELECT pdf_id, extractor_version, round(least(c, 400) * 2.0::DOUBLE + least(k, 400) * 3.0::DOUBLE + least(mean, 160.0) * 0.1::DOUBLE + CASE WHEN k = 0 THEN -80.0 WHEN status = 'valid' THEN 120.0 WHEN status = 'valid_with_gaps' THEN greatest(40.0, 100.0 - 5.0 * gc) ELSE -120.0 END - 8.0::DOUBLE * (k - u), 3) AS score FROM s""",
    "low_density": f"""WITH {C._L}, {C._CUT}, z AS (SELECT *, CAST(coalesce(regexp_matches(text, '(?i)^\\s*[0-9]{{1,4}}[.)]?\\s+(?:id|ibid)\\.'), false) AS INT) AS sh FROM k),
        w AS (SELECT *, sum(lk) OVER x AS n_like, sum(lg) OVER x AS n_legal, sum(sh) OVER x AS n_short, count(*) OVER x AS n, sum(lk) OVER t AS near FROM z WINDOW x AS (PARTITION BY pdf_id, page_index ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), t AS (PARTITION BY pdf_id, page_index ORDER BY rn ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)),
        v AS (SELECT *, (n_like + 0.6 * n_legal + 0.8 * n_short) / n AS density FROM w)
        SELECT pdf_id, CAST(page_index AS INT) AS page_index, arg_min(top, rn) AS cutoff FROM v WHERE n_lines >= 6 AND top / height >= 0.5 AND n >= 3 AND n <= greatest(5, floor(n_lines * 0.6)) AND near > 0 AND ((n_like >= 2 AND density >= 0.45) OR (n_like >= 1 AND n_legal >= 2 AND density >= 0.55)) GROUP BY ALL""",
    "bimodal_split": f"""WITH {C._L}, s AS (SELECT *, CAST(round(font_size) AS INT) AS sz FROM l WHERE font_size IS NOT NULL AND height > 0), tt AS (SELECT pdf_id, page_index, count(*) AS total FROM s GROUP BY ALL),
        b AS (SELECT pdf_id, page_index, min(sz) AS small, max(sz) AS big FROM (SELECT pdf_id, page_index, sz, count(*) AS k FROM s GROUP BY ALL) JOIN tt USING (pdf_id, page_index) WHERE total >= 10 AND k / total >= 0.12 GROUP BY ALL HAVING min(sz) < max(sz) AND min(sz) / max(sz) <= 0.9),
        m AS (SELECT s.*, CAST(font_size <= (small + big) / 2 AS INT) AS sm FROM s JOIN b USING (pdf_id, page_index)), c AS (SELECT *, count(*) OVER u AS n, sum(sm) OVER u AS k FROM m WINDOW u AS (PARTITION BY pdf_id, page_index ORDER BY top DESC, pos DESC ROWS UNBOUNDED PRECEDING)),
        r AS (SELECT *, max(CAST(n >= 4 AND k / n < 0.7 AS INT)) OVER (PARTITION BY pdf_id, page_index ORDER BY top DESC, pos DESC ROWS UNBOUNDED PRECEDING) AS broken FROM c), g AS (SELECT pdf_id, page_index, min(top) AS cutoff, max(k) AS k, max(height) AS height FROM r WHERE broken = 0 AND n >= 4 AND sm = 1 GROUP BY ALL)
        SELECT pdf_id, CAST(page_index AS INT) AS page_index, cutoff FROM g WHERE k >= 3 AND cutoff / height >= 0.4""",
    "citation_lines": f"""WITH {C._L}, n AS (SELECT pdf_id, row_number() OVER (PARTITION BY pdf_id ORDER BY page_index, pos) AS n, trim(regexp_replace(text, '[\\s\\x{{00A0}}]+', ' ', 'g')) AS t FROM l), s AS (SELECT *, 4 * CAST(regexp_matches(t, '[0-9]+ [A-Z][A-Za-z. ]+ [0-9]+') AS INT) + 2 * CAST(regexp_matches(lower(t), 'l\\. rev\\.|law review|journal') AS INT) + CAST(regexp_matches(t, '\\b(?:19|20)[0-9]{{2}}\\b') AS INT) + CAST(starts_with(lower(t), 'citation') AS INT) AS score FROM n WHERE n <= 160 AND length(t) >= 20)
        SELECT pdf_id, arg_max(t, score * 100000000 + length(t) * 10000 - n) AS line FROM s WHERE score > 0 GROUP BY 1""",
    "patched_records": """WITH p AS (SELECT pdf_url, max(metadata.title) AS title, max(metadata.year) AS year FROM run_records WHERE ok AND pdf_url IS NOT NULL GROUP BY 1)
        SELECT h.holding_id, h.pdf_url, CASE WHEN coalesce(trim(h.title), '') = '' AND coalesce(trim(p.title), '') <> '' THEN p.title ELSE h.title END AS title, CASE WHEN coalesce(trim(h.year), '') = '' AND coalesce(trim(p.year), '') <> '' THEN p.year ELSE h.year END AS year FROM holdings h LEFT JOIN p USING (pdf_url)""",
    "dangling_stats": "SELECT pdf_id, count(*) AS rows FROM doc_stats WHERE pdf_id IS NOT NULL AND pdf_id NOT IN (SELECT pdf_id FROM sidecars WHERE pdf_id IS NOT NULL) GROUP BY 1",
    "repeated_sidecars": "SELECT pdf_id, count(*) AS rows FROM sidecars GROUP BY 1 HAVING count(*) > 1",
    "worklist_chunks": "SELECT journal_domain, CAST(floor((row_number() OVER (PARTITION BY journal_domain ORDER BY mtime DESC NULLS LAST, pdf_id) - 1) / 50) AS INT) AS chunk, pdf_id FROM pdf_records",
    "retry_targets": f"WITH f AS ({Q._FAILED}) SELECT {Q._host('domain')} AS domain, count(DISTINCT pdf_url) AS \"all\", count(DISTINCT CASE WHEN error_class = 'waf' THEN pdf_url END) AS blocked, count(DISTINCT CASE WHEN error_class = 'network' THEN pdf_url END) AS network, count(DISTINCT CASE WHEN coalesce(retries, 0) > 0 THEN pdf_url END) AS retried FROM f WHERE pdf_url IS NOT NULL GROUP BY 1",
    "identical_siblings": f"SELECT journal_domain, regexp_replace({C._STEM}, '-[0-9]+$', '') AS stem, lower(sha256) AS sha, count(*) AS files, min(pdf_id) AS first_id FROM pdf_records GROUP BY ALL HAVING count(*) > 1",
    "url_places": r"""WITH r AS (SELECT TRY_CAST(nullif(regexp_extract(lower(page_url), '/v(?:ol(?:ume)?)?[-_]?([0-9]{1,4})', 1), '') AS INT) AS volume, TRY_CAST(nullif(regexp_extract(lower(page_url), '/v(?:ol(?:ume)?)?[-_]?[0-9]{1,4}[/_-]?(?:n|no|iss|issue)[-_]?([0-9]{1,3})', 1), '') AS INT) AS issue, TRY_CAST(metadata.volume AS INT) AS mv, TRY_CAST(metadata.issue AS INT) AS mi FROM run_records)
        SELECT CASE WHEN volume IS NULL THEN 'none' WHEN mv IS NULL THEN 'only_url' WHEN volume = mv THEN 'same' ELSE 'other' END AS volume, CASE WHEN issue IS NULL THEN 'none' WHEN mi IS NULL THEN 'only_url' WHEN issue = mi THEN 'same' ELSE 'other' END AS issue, count(*) AS records FROM r GROUP BY 1, 2""",
    "alias_matches": f"""WITH g AS (SELECT {_PN.format('journal_name')} AS key, min(journal_name) AS journal FROM registry GROUP BY 1 HAVING count(DISTINCT journal_name) = 1), h AS (SELECT trim(journal) AS name, count(*) AS holdings FROM holdings WHERE trim(journal) <> '' GROUP BY 1)
        SELECT name, holdings, journal FROM h JOIN g ON g.key = {_PN.format('h.name')} WHERE g.key <> ''""",
    "resumable_sites": f"""WITH d AS (SELECT DISTINCT {Q._host('seed_url')} AS host FROM run_records WHERE ok), g AS (SELECT {Q._host('url')} AS host, journal_name, {Q._t('status')} AS status FROM registry)
        SELECT host, status, count(DISTINCT journal_name) AS journals FROM g WHERE host <> '' AND host NOT IN (SELECT host FROM d WHERE host IS NOT NULL) GROUP BY ALL""",
    "sqrt_sample": f"""WITH c AS (SELECT journal_domain, CAST(greatest(1, round(100 * sqrt(count(*)))) AS BIGINT) AS n FROM pdf_records WHERE journal_domain <> '' GROUP BY 1), {_quotas('c', 'journal_domain', 60, 0)},
        r AS (SELECT journal_domain, pdf_id, row_number() OVER (PARTITION BY journal_domain ORDER BY md5('11:' || pdf_id), pdf_id) AS seat FROM pdf_records) SELECT journal_domain, pdf_id FROM r JOIN quota ON g = journal_domain WHERE seat <= least(8, quota)""",
    "quota_sample": f"""WITH k AS (SELECT pdf_id, evaluated_at, platform_family AS platform, regexp_replace(lower(coalesce(platform_family, '')), '[^a-z0-9]+', '', 'g') AS k FROM doc_stats), x AS (SELECT pdf_id, evaluated_at, {Q._PLATFORM} AS p FROM k), s AS (SELECT pdf_id, arg_max(p, (evaluated_at, p)) AS platform FROM x GROUP BY 1),
        c AS (SELECT platform, count(*) AS n FROM s GROUP BY 1), {_quotas('c', 'platform', 50, 3)},
        r AS (SELECT platform, pdf_id, row_number() OVER (PARTITION BY platform ORDER BY md5('7:' || pdf_id), pdf_id) AS seat FROM s) SELECT platform, pdf_id FROM r JOIN quota ON g = platform WHERE seat <= quota""",
    "trimmed_ordinality": f"""WITH RECURSIVE {C._N}, a AS (SELECT pdf_id, extractor_version, coalesce(list_sort(list_distinct(list(number) FILTER (WHERE number IS NOT NULL))), []) AS l FROM n GROUP BY ALL),
        st AS (SELECT pdf_id, extractor_version, l, CASE WHEN len(l) < 3 THEN 4 ELSE 0 END AS ph, len(l) AS m FROM a
          UNION ALL SELECT pdf_id, extractor_version, CASE WHEN go AND ph < 2 THEN l[:-2] WHEN go THEN l[2:] ELSE l END, CASE WHEN go THEN ph ELSE ph + 1 END, CASE WHEN go THEN m ELSE len(l) END FROM (
            SELECT *, CASE ph WHEN 0 THEN len(l) >= 4 AND j >= greatest(8, 5 * greatest(1, floor(list_aggregate(list_transform(range(1, len(l) - 1), lambda i: l[i + 1] - l[i]), 'median')))) AND j > 0.15 * hi
              WHEN 1 THEN len(l) >= 3 AND j > greatest(5, m // 2) AND j > 0.25 * hi
              WHEN 2 THEN len(l) >= 4 AND (l[1] <= 0 OR (j >= greatest(8, 5 * greatest(1, floor(list_aggregate(list_transform(range(2, len(l)), lambda i: l[i + 1] - l[i]), 'median')))) AND j > 0.15 * hi))
              ELSE len(l) >= 3 AND (l[1] <= 0 OR (j > greatest(5, m // 2) AND j > 0.25 * hi)) END AS go
            FROM (SELECT *, CASE WHEN ph < 2 THEN l[-1] - l[-2] ELSE l[2] - l[1] END AS j, CASE WHEN ph < 2 THEN l[-1] ELSE l[2] END AS hi FROM st WHERE ph < 4))),
        f AS (SELECT pdf_id, extractor_version, l, l[1] AS lo, l[-1] AS hi, CASE WHEN len(l) > 0 THEN list_filter(range(l[1], l[-1] + 1), lambda x: NOT list_contains(l, x)) ELSE [] END AS gp FROM st WHERE ph = 4)
        SELECT pdf_id, extractor_version, CASE WHEN len(gp) = 0 THEN 'valid' WHEN len(gp) > 2 AND len(gp) / coalesce(hi - lo + 1, 1) > 0.05 THEN 'invalid' ELSE 'valid_with_gaps' END AS status, coalesce(lo, 0) AS low, coalesce(hi, 0) AS high, coalesce(array_to_string(gp, ','), '') AS gaps FROM f""",
    "streamed_outcomes": f"""WITH RECURSIVE o AS (SELECT {Q._host('domain')} AS key, seq AS ts, coalesce(ok, false) AS ok FROM run_records WHERE {Q._host('domain')} IS NOT NULL AND seq IS NOT NULL),
        r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts, ok DESC) AS i FROM o),
        c AS (SELECT key, 0 AS i, 0 AS streak, CAST(0 AS BIGINT) AS til, false AS refused, false AS opened FROM (SELECT DISTINCT key FROM o)
          UNION ALL SELECT key, i, CASE WHEN ok THEN 0 ELSE s1 + 1 END, CASE WHEN ok THEN 0 WHEN s1 + 1 >= 2 THEN ts + 200 ELSE t1 END, til > ts, NOT ok AND s1 + 1 >= 2 FROM (
            SELECT r.key, r.i, r.ts, r.ok, c.til, CASE WHEN c.til > 0 AND c.til <= r.ts THEN 0 ELSE c.streak END AS s1, CASE WHEN c.til > 0 AND c.til <= r.ts THEN 0 ELSE c.til END AS t1 FROM c JOIN r ON r.key = c.key AND r.i = c.i + 1))
        SELECT key, count(*) AS outcomes, CAST(sum(CAST(opened AS INT)) AS BIGINT) AS opened, CAST(sum(CAST(refused AS INT)) AS BIGINT) AS refused FROM c WHERE i > 0 GROUP BY 1""",
    "token_scores": rf"""WITH RECURSIVE {C._N}, {C._SEG}, gd AS (SELECT pdf_id, number AS label, arg_min(text, idx) AS text FROM n WHERE (pdf_id, extractor_version) IN (SELECT (pdf_id, max(extractor_version)) FROM sidecars GROUP BY pdf_id) AND number IS NOT NULL GROUP BY 1, 2), pd AS (SELECT pdf_id, label, arg_min(text, note_no) AS text FROM s GROUP BY 1, 2),
        bo AS (SELECT pdf_id, label, gd.text AS a, pd.text AS b FROM gd JOIN pd USING (pdf_id, label)),
        w AS (SELECT pdf_id, label, unnest(regexp_extract_all({C._PLAIN.replace('(text,', '(a,')}, '[A-Za-z0-9_]+(?:[''.-][A-Za-z0-9_]+)*|[^A-Za-z0-9_\s]')) AS t, 1 AS g, 0 AS p FROM bo UNION ALL SELECT pdf_id, label, unnest(regexp_extract_all({C._PLAIN.replace('(text,', '(b,')}, '[A-Za-z0-9_]+(?:[''.-][A-Za-z0-9_]+)*|[^A-Za-z0-9_\s]')), 0, 1 FROM bo),
        c2 AS (SELECT pdf_id, label, t, sum(g) AS g, sum(p) AS p FROM w GROUP BY ALL) SELECT pdf_id, CAST(sum(least(g, p)) AS BIGINT) AS tp, CAST(sum(greatest(p - g, 0)) AS BIGINT) AS fp, CAST(sum(greatest(g - p, 0)) AS BIGINT) AS fn FROM c2 GROUP BY 1""",
    "page_links": f"""WITH r AS (SELECT regexp_extract(page_url, '^(https?://[^/]+)', 1) || '/archive' AS a, nullif(trim(regexp_replace(pdf_url, '#.*$', '')), '') AS f FROM run_records WHERE page_url IS NOT NULL), l AS (SELECT a AS u, 'all issues' AS t FROM r UNION ALL SELECT f, 'pdf' FROM r WHERE regexp_matches(f, '^https?://'))
        SELECT CASE WHEN t = 'all issues' THEN 'archive' ELSE {Q._CLS('u')} END AS kind, count(*) AS links FROM l GROUP BY 1""",
}
