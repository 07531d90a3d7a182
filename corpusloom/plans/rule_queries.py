"""Queries over rules as data, reviews, versions, schemas, plug-ins and label spans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import records as R
from corpusloom.functions import text as T
from corpusloom.functions import urls as U
from corpusloom.operators import layout as L
from corpusloom.operators import notes as N
from corpusloom.operators import repair as P
from corpusloom.operators import rules as X
from corpusloom.plans import corpus_queries as C
from corpusloom.plans import marker_queries as K
from corpusloom.plans import record_queries as Q
from corpusloom.plans import repair_queries as V
from corpusloom.plans.source_queries import _site_pages
from corpusloom.session import table
from corpusloom.sources.plugins import Plugins

#: An example of rules as they are stored.
RULES = """[
 {"name": "cover", "column": "name", "op": "matches", "value": "cover|masthead|front", "confidence": 0.99},
 {"name": "whole_issue", "column": "name", "op": "matches", "value": "issue|volume", "confidence": 0.99},
 {"name": "one_page", "column": "page_count", "op": "less", "value": 2, "confidence": 0.6},
 {"name": "very_long", "column": "page_count", "op": "more", "value": 90, "confidence": 0.98},
 {"name": "large", "column": "size", "op": "more", "value": 5000000, "confidence": 0.7},
 {"name": "titled", "column": "title_key", "op": "filled", "guard": true},
 {"name": "read", "column": "first_text_hash", "op": "filled", "guard": true}
]"""


def ruled_pdfs(spark: SparkSession, d: str) -> DataFrame:
    """Files judged by stored rules: reasons, guards, confidence and verdict."""
    pdfs = table(spark, d, "pdf_records").withColumn("name", F.lower(F.regexp_replace("path", r"^.*/", "")))
    j = X.judged(pdfs, X.load_rules(RULES))
    return j.select("pdf_id", F.array_join("reasons", "|").alias("reasons"), F.array_join("guards", "|").alias("guards"), "confidence", "excluded")


def document_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Documents by the first case of a cascade over their kind, size and title."""
    cases = [("empty", [X.Rule("", "n_chars", "less", 1)]), ("stub", [X.Rule("", "n_chars", "less", 200)]), ("notice", [X.Rule("", "doc_kind", "in", ["notice", "comment"])]), ("long_untitled", [X.Rule("", "n_chars", "more", 2000), X.Rule("", "title", "empty")]), ("long", [X.Rule("", "n_chars", "more", 2000)])]
    return table(spark, d, "documents").select("doc_id", X.first_case(cases, "article").alias("kind"))


def review_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Evaluated documents by why they should be looked at."""
    rules = [X.Rule("no_notes", "note_count", "less", 1), X.Rule("gaps", "gap_count", "more", 0), X.Rule("unsure", "document_confidence", "less", 0.7), X.Rule("no_context", "missing_context_count", "more", 3), X.Rule("order", "ordinality_status", "is", "invalid")]
    r = table(spark, d, "doc_stats").select(F.explode(X.reasons(rules, "none")).alias("reason"), "pdf_id")
    return r.groupBy("reason").agg(F.count("*").alias("rows"), F.countDistinct("pdf_id").alias("pdfs"))


def first_valid_seeds(spark: SparkSession, d: str) -> DataFrame:
    """Registry rows with an address: the first of every host, the others, and those without."""
    r = table(spark, d, "registry").select("seq", U.host(F.col("url")).alias("host"), "url", "journal_name")
    return X.first_valid(r, "host", ["seq", "journal_name", "url"], F.col("url").rlike("^https?://")).groupBy("state").agg(F.count("*").alias("rows"))


def note_cutoffs(spark: SparkSession, d: str) -> DataFrame:
    """Share of the page at which notes may begin: by site, else by platform, else the default."""
    s = table(spark, d, "doc_stats").select("pdf_id", "evaluated_at", U.host(F.col("domain")).alias("host"), R.platform(F.col("platform_family")).alias("platform"))
    site = table(spark, d, "host_settings").select("host", F.when(F.col("date_order") == "dmy", 0.95).otherwise(0.55).alias("cutoff")).where("host like 'l%'")
    family = spark.createDataFrame([("ojs", 0.35), ("digital_commons", 0.62)], "platform string, cutoff double")
    return X.overridden(s, [(site, "host"), (family, "platform")], "cutoff", 0.7, 0.4, 0.9).groupBy("cutoff").agg(F.count("*").alias("rows"))


def gap_triage(spark: SparkSession, d: str) -> DataFrame:
    """Missing labels of sidecars: whether the text has them at the start of a line."""
    gaps = table(spark, d, "sidecars").where("size(ordinality.gaps) > 0").groupBy("pdf_id").agg(F.max("ordinality.gaps").alias("gaps"))
    seen = N.candidate_lists(table(spark, d, "extracted_docs")).select("pdf_id", F.array_distinct(F.col("c.label")).alias("seen"))
    j = gaps.join(seen, "pdf_id", "left").withColumn("hit", F.size(F.array_intersect("gaps", F.coalesce("seen", F.array().cast("array<int>")))))
    kind = F.when(F.col("hit") == F.size("gaps"), "all").when(F.col("hit") > 0, "some").otherwise("none")
    return j.select("pdf_id", F.size("gaps").alias("gaps"), "hit", kind.alias("in_text"))


def path_counts(spark: SparkSession, d: str) -> DataFrame:
    """Downloads of every site by the way they came."""
    r = table(spark, d, "run_records").groupBy(U.host(F.col("domain")).alias("domain"))
    return r.agg(*[F.count_if(F.coalesce(F.col("ok"), F.lit(False)) & (F.coalesce("extraction_path", F.lit("")) == k)).alias(k or "unnamed") for k in ("primary", "fallback", "")], F.count_if(F.coalesce("ok", F.lit(False))).alias("downloads"))


def review_rates(spark: SparkSession, d: str) -> DataFrame:
    """By platform: evaluated PDFs, the share in a critical state, and whether that is low enough to go on."""
    bad = (F.col("ordinality_status") == "invalid") | (F.coalesce("note_count", F.lit(0)) == 0)
    g = table(spark, d, "doc_stats").groupBy(R.platform(F.col("platform_family")).alias("platform")).agg(F.count("*").alias("rows"), F.count_if(F.coalesce(bad, F.lit(False))).alias("critical"))
    return g.withColumn("rate", F.round(F.col("critical") / F.col("rows"), 6)).withColumn("go", F.col("rate") <= 0.1)


def progress_report(spark: SparkSession, d: str) -> DataFrame:
    """Evaluation as a whole: rows, empty ones, median notes, and valid ones of all, of those with notes and of articles."""
    s = table(spark, d, "doc_stats")
    valid, noted, article = F.col("ordinality_status") == "valid", F.coalesce("note_count", F.lit(0)) > 0, F.col("doc_type") == "article"
    g = s.agg(F.count("*").alias("rows"), F.count_if(~noted).alias("empty"), F.median("note_count").alias("median_notes"), F.count_if(valid).alias("valid"), F.count_if(valid & noted).alias("valid_noted"), F.count_if(noted).alias("noted"), F.count_if(valid & article).alias("valid_articles"), F.count_if(article).alias("articles"))
    share = lambda a, b: F.round(F.col(a) / F.nullif(F.col(b), F.lit(0)), 6)
    return g.select("rows", "empty", "median_notes", "valid", share("valid", "rows").alias("of_all"), share("valid_noted", "noted").alias("of_noted"), share("valid_articles", "articles").alias("of_articles"), (F.col("empty") > F.col("rows") * 0.2).alias("alarm"))


def best_versions(spark: SparkSession, d: str) -> DataFrame:
    """Of several extractions of a PDF the best: valid, then with fewer gaps, more notes, more confidence, then the later version."""
    s = table(spark, d, "sidecars")
    key = F.struct((F.col("ordinality.status") == "valid").cast("int").alias("a"), (-F.size("ordinality.gaps")).alias("b"), F.size("notes").alias("c"), F.coalesce("document_confidence", F.lit(0.0)).alias("d"), F.col("extractor_version").alias("e"))
    return s.groupBy("pdf_id").agg(F.max(key).alias("k"), F.count("*").alias("versions")).select("pdf_id", F.col("k.e").alias("extractor_version"), F.col("k.c").alias("notes"), "versions")


def sequence_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Counts of every sidecar: notes, numbered ones, repeated labels, gaps, the greatest label."""
    n = C._notes(spark, d)
    g = n.groupBy("pdf_id", "extractor_version").agg(F.count("*").alias("notes"), F.count("number").alias("numbered"), (F.count("number") - F.countDistinct("number")).alias("repeated"), F.coalesce(F.max("number") - F.min("number") + 1 - F.countDistinct("number"), F.lit(0)).alias("gaps"), F.max("number").alias("greatest"))
    return g


def collapsed_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of sidecars with those over 20 read as if they were from 100 on, and read back."""
    o = N.document_labels(C._notes(spark, d)).withColumn("labels", F.transform("labels", lambda v: F.when(v > 5, v + 100).otherwise(v)))
    return o.select("pdf_id", "extractor_version", F.array_join(P.collapsed_hundreds(F.col("labels")), ",").alias("labels"))


def classified_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of pages with two type sizes by side of the cut."""
    lines = L.page_lines(table(spark, d, "extracted_docs"))
    j = lines.join(L.bimodal_split(lines), ["pdf_id", "page_index"])
    return j.groupBy("pdf_id", "page_index").agg(F.count_if(F.col("top") < F.col("cutoff")).alias("body"), F.count_if(F.col("top") >= F.col("cutoff")).alias("notes"))


def reversed_notes(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose note lines end with a label instead of beginning with it: how many, and whether the order of words is in doubt."""
    n = K.M.note_lines(table(spark, d, "extracted_docs")).where("text <> ''")
    starts, ends = F.col("text").rlike(K.M.MARKER), F.col("text").rlike(r"[a-z.,;)]\s[0-9]{1,4}[\]).,:;-]?$")
    g = n.where(starts | ends).groupBy("pdf_id").agg(F.count("*").alias("like"), F.count_if(ends & ~starts).alias("turned"))
    return g.withColumn("suspected", (F.col("turned") >= 2) & (F.col("turned") >= 0.4 * F.col("like")))


def label_spans(spark: SparkSession, d: str) -> DataFrame:
    """Records of notes from the places of their labels: the lines from one label of the chain to the next."""
    docs = table(spark, d, "extracted_docs")
    at = N.solved_labels(N.candidate_lists(docs)).select("pdf_id", "page_index", F.col("line").alias("pos"), "label")
    from pyspark.sql import Window

    w = Window.partitionBy("pdf_id").orderBy("page_index", "pos")
    l = L.page_lines(docs).join(at, ["pdf_id", "page_index", "pos"], "left").withColumn("note", F.count("label").over(w)).where("note > 0")  # noqa: E741
    return l.groupBy("pdf_id", "note").agg(F.max("label").alias("label"), F.min("page").alias("page_start"), F.max("page").alias("page_end"), F.count("*").alias("lines"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars"))


def quarantine_plan(spark: SparkSession, d: str) -> DataFrame:
    """Files that rules exclude and where they go, but for those whose hash an earlier one has already."""
    pdfs = table(spark, d, "pdf_records").withColumn("name", F.lower(F.regexp_replace("path", r"^.*/", "")))
    out = X.judged(pdfs, [r for r in X.load_rules(RULES) if not r.guard], 0.6).where("excluded").withColumn("sha", F.lower("sha256"))
    first = out.groupBy("sha").agg(F.min("pdf_id").alias("pdf_id"))
    return out.join(first, ["sha", "pdf_id"], "left_semi").select("pdf_id", F.concat(F.lit("/quarantine/"), F.coalesce("journal_domain", F.lit("unknown")), F.lit("/"), "name").alias("target"))


_SCHEMA = {"type": "object", "required": ["record_id", "pdf_url"], "properties": {"pdf_url": {"type": "string", "minLength": 12}, "retries": {"type": "integer", "maximum": 1}, "http_status": {"enum": [200, 404, 403]}, "metadata": {"$ref": "#/$defs/m"}}, "$defs": {"m": {"type": "object", "required": ["title"], "properties": {"authors": {"type": "array", "minItems": 1}}}}}


def schema_errors(spark: SparkSession, d: str) -> DataFrame:
    """Errors of records under a JSON schema, by the path and kind of error."""
    r = table(spark, d, "run_records").select(F.to_json(F.struct("record_id", "pdf_url", "retries", "http_status", "metadata")).alias("j"))
    e = r.select(F.explode(P.json_errors(F.col("j"), _SCHEMA)).alias("e"))
    return e.groupBy(F.regexp_extract("e", r"^([^:]*):", 1).alias("path"), F.regexp_extract("e", r": (lacks|is none|has|is out|is too)", 1).alias("kind")).agg(F.count("*").alias("errors"))


def discovered_files(spark: SparkSession, d: str) -> DataFrame:
    """Files that plug-ins find on the pages of the registry's sites: one for archives by host, the others by the general one."""
    pages = _site_pages(spark, d)
    host = U.host(F.col("url"))
    archive = lambda seed, page: [{"page_url": seed, "pdf_url": f"{seed}/archive.pdf", "title": "archive"}] if "All issues" in page else []
    hosts = [r[0] for r in table(spark, d, "host_settings").select("host").where("host like 'l%'").collect()]  # a table of fixed size
    out = Plugins().register_many(hosts, "archive", archive).discover(pages.select(F.col("url").alias("seed_url"), F.concat("html", F.when(host.startswith("o"), "<a href='/x.pdf'>PDF</a>").otherwise("")).alias("html")))
    return out.groupBy("source").agg(F.count("*").alias("files"), F.countDistinct("pdf_url").alias("addresses"))


def first_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Volumes and issues of records as numbers."""
    m = F.col("metadata")
    return table(spark, d, "run_records").select("record_id", T.first_number(m["volume"]).alias("volume"), T.first_number(m["issue"]).alias("issue"))


def sentence_counts(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of every document."""
    return table(spark, d, "documents").select("doc_id", F.size(T.sentences(F.col("text"))).alias("sentences"))


QUERIES = {
    f.__name__: f
    for f in (
        ruled_pdfs, document_kinds, review_reasons, first_valid_seeds, note_cutoffs, gap_triage, path_counts, review_rates, progress_report, best_versions, sequence_metrics, collapsed_labels, classified_lines,
        reversed_notes, label_spans, quarantine_plan, schema_errors, discovered_files, first_numbers, sentence_counts,
    )
}

_NAME = "lower(regexp_replace(path, '^.*/', ''))"
_WHY = f"[CASE WHEN regexp_matches({_NAME}, 'cover|masthead|front') THEN 'cover' END, CASE WHEN size > 5000000 THEN 'large' END, CASE WHEN page_count < 2 THEN 'one_page' END, CASE WHEN page_count > 90 THEN 'very_long' END, CASE WHEN regexp_matches({_NAME}, 'issue|volume') THEN 'whole_issue' END]"
_SURE = f"greatest(0.0, CASE WHEN regexp_matches({_NAME}, 'cover|masthead|front|issue|volume') THEN 0.99 ELSE 0 END, CASE WHEN size > 5000000 THEN 0.7 ELSE 0 END, CASE WHEN page_count < 2 THEN 0.6 ELSE 0 END, CASE WHEN page_count > 90 THEN 0.98 ELSE 0 END)"
_OKD = "coalesce(ok, false)"
_PLAT = f"(SELECT *, {Q._PLATFORM} AS pl FROM (SELECT *, platform_family AS platform, regexp_replace(lower(coalesce(platform_family, '')), '[^a-z0-9]+', '', 'g') AS k FROM doc_stats))"
_NUM = lambda c: f"TRY_CAST(nullif(regexp_extract(coalesce(metadata.{c}, ''), '([0-9]{{1,9}})', 1), '') AS INT)"

SQL = {
    "ruled_pdfs": f"""WITH r AS (SELECT pdf_id, list_filter({_WHY}, lambda x: x IS NOT NULL) AS w, list_filter([CASE WHEN coalesce(trim(first_text_hash), '') <> '' THEN 'read' END, CASE WHEN coalesce(trim(title_key), '') <> '' THEN 'titled' END], lambda x: x IS NOT NULL) AS g, CAST({_SURE} AS DOUBLE) AS confidence FROM pdf_records)
        SELECT pdf_id, array_to_string(w, '|') AS reasons, array_to_string(g, '|') AS guards, confidence, len(w) > 0 AND len(g) = 0 AND confidence >= 0.98 AS excluded FROM r""",
    "document_kinds": "SELECT doc_id, CASE WHEN n_chars < 1 THEN 'empty' WHEN n_chars < 200 THEN 'stub' WHEN doc_kind IN ('notice', 'comment') THEN 'notice' WHEN n_chars > 2000 AND coalesce(trim(title), '') = '' THEN 'long_untitled' WHEN n_chars > 2000 THEN 'long' ELSE 'article' END AS kind FROM documents",
    "review_reasons": """WITH r AS (SELECT pdf_id, list_filter([CASE WHEN note_count < 1 THEN 'no_notes' END, CASE WHEN gap_count > 0 THEN 'gaps' END, CASE WHEN document_confidence < 0.7 THEN 'unsure' END, CASE WHEN missing_context_count > 3 THEN 'no_context' END, CASE WHEN ordinality_status = 'invalid' THEN 'order' END], lambda x: x IS NOT NULL) AS w FROM doc_stats),
        e AS (SELECT pdf_id, unnest(CASE WHEN len(w) = 0 THEN ['none'] ELSE w END) AS reason FROM r) SELECT reason, count(*) AS rows, count(DISTINCT pdf_id) AS pdfs FROM e GROUP BY 1""",
    "first_valid_seeds": f"WITH r AS (SELECT {Q._host('url')} AS host, coalesce(regexp_matches(url, '^https?://'), false) AS ok, seq, journal_name, url FROM registry), s AS (SELECT CASE WHEN NOT ok THEN 'invalid' WHEN row_number() OVER (PARTITION BY host, ok ORDER BY seq, journal_name, url) = 1 THEN 'first' ELSE 'repeated' END AS state FROM r) SELECT state, count(*) AS rows FROM s GROUP BY 1",
    "note_cutoffs": f"""WITH h AS (SELECT host, max(CASE WHEN date_order = 'dmy' THEN 0.95 ELSE 0.55 END) AS c FROM host_settings WHERE host LIKE 'l%' GROUP BY 1), s AS (SELECT {Q._host('domain')} AS host, pl FROM {_PLAT})
        SELECT CAST(greatest(0.4, least(0.9, coalesce(h.c, CASE pl WHEN 'ojs' THEN 0.35 WHEN 'digital_commons' THEN 0.62 END, 0.7))) AS DOUBLE) AS cutoff, count(*) AS rows FROM s LEFT JOIN h USING (host) GROUP BY 1""",
    "gap_triage": f"""{K._SOLVED.replace('WITH RECURSIVE', 'WITH RECURSIVE g0 AS (SELECT pdf_id, max(ordinality.gaps) AS gaps FROM sidecars WHERE len(ordinality.gaps) > 0 GROUP BY 1),', 1)}, sn AS (SELECT pdf_id, list(DISTINCT label) AS seen FROM cd GROUP BY 1), j AS (SELECT pdf_id, gaps, len(list_intersect(gaps, coalesce(seen, []))) AS hit FROM g0 LEFT JOIN sn USING (pdf_id))
        SELECT pdf_id, CAST(len(gaps) AS INT) AS gaps, CAST(hit AS INT) AS hit, CASE WHEN hit = len(gaps) THEN 'all' WHEN hit > 0 THEN 'some' ELSE 'none' END AS in_text FROM j""",
    "path_counts": f"SELECT {Q._host('domain')} AS domain, count(*) FILTER (WHERE {_OKD} AND extraction_path = 'primary') AS \"primary\", count(*) FILTER (WHERE {_OKD} AND extraction_path = 'fallback') AS fallback, count(*) FILTER (WHERE {_OKD} AND coalesce(extraction_path, '') = '') AS unnamed, count(*) FILTER (WHERE {_OKD}) AS downloads FROM run_records GROUP BY 1",
    "review_rates": f"WITH g AS (SELECT pl AS platform, count(*) AS rows, count(*) FILTER (WHERE ordinality_status = 'invalid' OR coalesce(note_count, 0) = 0) AS critical FROM {_PLAT} GROUP BY 1) SELECT *, round(critical / rows, 6) AS rate, round(critical / rows, 6) <= 0.1 AS go FROM g",
    "progress_report": """WITH g AS (SELECT count(*) AS rows, count(*) FILTER (WHERE coalesce(note_count, 0) <= 0) AS empty, CAST(median(note_count) AS DOUBLE) AS median_notes, count(*) FILTER (WHERE ordinality_status = 'valid') AS valid, count(*) FILTER (WHERE ordinality_status = 'valid' AND note_count > 0) AS vn, count(*) FILTER (WHERE note_count > 0) AS nn, count(*) FILTER (WHERE ordinality_status = 'valid' AND doc_type = 'article') AS va, count(*) FILTER (WHERE doc_type = 'article') AS na FROM doc_stats)
        SELECT rows, empty, median_notes, valid, round(valid / nullif(rows, 0), 6) AS of_all, round(vn / nullif(nn, 0), 6) AS of_noted, round(va / nullif(na, 0), 6) AS of_articles, empty > rows * 0.2 AS alarm FROM g""",
    "best_versions": "WITH k AS (SELECT pdf_id, row_number() OVER (PARTITION BY pdf_id ORDER BY CAST(ordinality.status = 'valid' AS INT) DESC, len(ordinality.gaps), len(notes) DESC, coalesce(document_confidence, 0) DESC, extractor_version DESC) AS rn, count(*) OVER (PARTITION BY pdf_id) AS versions, extractor_version, CAST(len(notes) AS INT) AS notes FROM sidecars) SELECT pdf_id, extractor_version, notes, versions FROM k WHERE rn = 1",
    "sequence_metrics": f"WITH {C._N} SELECT pdf_id, extractor_version, count(*) AS notes, count(number) AS numbered, count(number) - count(DISTINCT number) AS repeated, coalesce(max(number) - min(number) + 1 - count(DISTINCT number), 0) AS gaps, max(number) AS greatest FROM n GROUP BY 1, 2",
    "collapsed_labels": f"""WITH {C._N}, g AS (SELECT pdf_id, extractor_version, list_sort(list(DISTINCT number) FILTER (WHERE number IS NOT NULL)) AS l0 FROM n GROUP BY 1, 2), h AS (SELECT *, list_transform(coalesce(l0, []), lambda v: CASE WHEN v > 5 THEN v + 100 ELSE v END) AS l FROM g),
        o AS (SELECT *, len(l) <= 8 AND list_contains(l, 1) AND len(list_filter(l, lambda v: v BETWEEN 100 AND 130)) > 0 AS sparse, list_filter(list_transform(l, lambda v: CASE WHEN v BETWEEN 100 AND 130 THEN v - 100 ELSE v END), lambda v: v <> 0) AS f FROM h)
        SELECT pdf_id, extractor_version, array_to_string(CASE WHEN sparse THEN f ELSE l END, ',') AS labels FROM o""",
    "classified_lines": f"WITH bs AS ({V.SQL['bimodal_split']}), {C._L} SELECT pdf_id, CAST(page_index AS INT) AS page_index, count(*) FILTER (WHERE top < cutoff) AS body, count(*) FILTER (WHERE top >= cutoff) AS notes FROM l JOIN bs USING (pdf_id, page_index) GROUP BY 1, 2",
    "reversed_notes": rf"""WITH {K._V0}, a AS (SELECT pdf_id, regexp_matches(text, '{K.M.MARKER}') AS st, regexp_matches(text, '[a-z.,;)]\s[0-9]{{1,4}}[\]).,:;-]?$') AS en FROM v0 WHERE text <> ''), g AS (SELECT pdf_id, count(*) AS "like", count(*) FILTER (WHERE en AND NOT st) AS turned FROM a WHERE st OR en GROUP BY 1) SELECT *, turned >= 2 AND turned >= 0.4 * "like" AS suspected FROM g""",
    "label_spans": f"""{K._SOLVED}, pn AS (SELECT pdf_id, page_index, p.page_number AS page FROM t), m AS (SELECT l.pdf_id, l.page_index, l.line, pn.page, l.l.text AS text, sv.label FROM l JOIN pn ON pn.pdf_id = l.pdf_id AND pn.page_index = l.page_index LEFT JOIN sv ON sv.pdf_id = l.pdf_id AND sv.page_index = l.page_index AND sv.line = l.line),
        w AS (SELECT *, count(label) OVER (PARTITION BY pdf_id ORDER BY page_index, line ROWS UNBOUNDED PRECEDING) AS note FROM m) SELECT pdf_id, note, max(label) AS label, min(page) AS page_start, max(page) AS page_end, count(*) AS lines, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS chars FROM w WHERE note > 0 GROUP BY 1, 2""",
    "quarantine_plan": f"WITH r AS (SELECT *, {_NAME} AS name, len(list_filter({_WHY}, lambda x: x IS NOT NULL)) > 0 AND {_SURE} >= 0.6 AS ex FROM pdf_records), f AS (SELECT lower(sha256) AS sha, min(pdf_id) AS pdf_id FROM r WHERE ex AND sha256 IS NOT NULL GROUP BY 1) SELECT r.pdf_id, '/quarantine/' || coalesce(journal_domain, 'unknown') || '/' || name AS target FROM r JOIN f ON f.pdf_id = r.pdf_id AND f.sha = lower(r.sha256) WHERE ex",
    "schema_errors": """WITH e AS (SELECT CASE WHEN pdf_url IS NULL THEN '$' END AS a, CASE WHEN pdf_url IS NOT NULL AND length(pdf_url) < 12 THEN '$.pdf_url' END AS b, CASE WHEN retries > 1 THEN '$.retries' END AS c, CASE WHEN http_status IS NOT NULL AND http_status NOT IN (200, 404, 403) THEN '$.http_status' END AS d, CASE WHEN metadata IS NOT NULL AND metadata.title IS NULL THEN '$.metadata' END AS f, CASE WHEN len(metadata.authors) = 0 THEN '$.metadata.authors' END AS g FROM run_records),
        u AS (SELECT a AS path, 'lacks' AS kind FROM e UNION ALL SELECT b, 'is too' FROM e UNION ALL SELECT c, 'is out' FROM e UNION ALL SELECT d, 'is none' FROM e UNION ALL SELECT f, 'lacks' FROM e UNION ALL SELECT g, 'has' FROM e) SELECT path, kind, count(*) AS errors FROM u WHERE path IS NOT NULL GROUP BY 1, 2""",
    "discovered_files": f"""WITH r AS (SELECT url, seq, {Q._host('url')} AS host FROM registry WHERE url <> ''), f AS (SELECT 'archive' AS source, url || '/archive.pdf' AS a FROM r WHERE seq % 5 <> 0 AND host IN (SELECT host FROM host_settings WHERE host LIKE 'l%') UNION ALL SELECT 'generic', host || '/x.pdf' FROM r WHERE host LIKE 'o%')
        SELECT source, count(*) AS files, count(DISTINCT a) AS addresses FROM f GROUP BY 1""",
    "first_numbers": f"SELECT record_id, {_NUM('volume')} AS volume, {_NUM('issue')} AS issue FROM run_records",
    "sentence_counts": r"SELECT doc_id, CAST(len(list_filter(string_split(regexp_replace(coalesce(text, ''), '([.!?])[ \t\n\x0B\f\r]+', '\1' || chr(57344), 'g'), chr(57344)), lambda x: trim(x, ' ') <> '')) AS INT) AS sentences FROM documents",
}
