"""Queries of the text functions over notes and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.session import table


def _notes(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "sidecars").select("pdf_id", "extractor_version", F.explode("notes").alias("n"))
    return n.select("pdf_id", "extractor_version", F.col("n.ordinal").alias("ordinal"), F.col("n.label").alias("label"), F.col("n.page_start").alias("page_start"), F.col("n.text").alias("text"))


def note_features(spark: SparkSession, d: str) -> DataFrame:
    """Kind of citation, addresses and years of every note."""
    joined = lambda c: F.array_join(F.array_sort(c), "|")
    t = F.col("text")
    return _notes(spark, d).select("pdf_id", "extractor_version", "ordinal", "page_start", T.citation_type(t).alias("citation"), joined(T.urls(t)).alias("urls"), joined(T.years(t)).alias("years"), joined(F.transform(T.emails(t), F.lower)).alias("emails"))


def citation_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Mentions by kind, and how many different ones."""
    m = _notes(spark, d).select(F.explode(T.citation_mentions(F.col("text"))).alias("m"))
    return m.groupBy(F.col("m.kind").alias("kind")).agg(F.count("*").alias("mentions"), F.countDistinct(F.lower("m.text")).alias("different"))


def note_citations(spark: SparkSession, d: str) -> DataFrame:
    """Notes by number of distinct citations."""
    return _notes(spark, d).groupBy(F.size(T.citations(F.col("text"))).alias("citations")).agg(F.count("*").alias("notes"))


def document_counts(spark: SparkSession, d: str) -> DataFrame:
    """Tokens, sentences and years of every document."""
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.size(T.tokens(t)).alias("tokens"), F.size(T.sentences(t)).alias("sentences"), F.array_join(T.years(t), "|").alias("years"))


def document_headers(spark: SparkSession, d: str) -> DataFrame:
    """Headings of documents."""
    h = table(spark, d, "documents").select("doc_id", T.section_headers(F.col("text")).alias("h"))
    return h.where(F.size("h") > 0).select("doc_id", F.size("h").alias("headers"), F.array_join("h", "|").alias("header_text"))


def text_hash_groups(spark: SparkSession, d: str) -> DataFrame:
    """Documents that begin with the same words."""
    h = table(spark, d, "documents").select("doc_id", T.first_text_hash(F.col("text")).alias("text_hash")).where("text_hash is not null")
    return h.groupBy("text_hash").agg(F.count("*").alias("documents"), F.min("doc_id").alias("first_id")).where("documents > 1")


def joined_note_text(spark: SparkSession, d: str) -> DataFrame:
    """Notes that change when broken words are joined, with their unified text."""
    n = _notes(spark, d).select("pdf_id", "extractor_version", "ordinal", "page_start", "text", T.joined_hyphens(F.col("text")).alias("joined"))
    return n.where("joined <> text").select("pdf_id", "extractor_version", "ordinal", "page_start", F.md5(T.note_text(F.col("text"))).alias("unified"))


def folded_keys(spark: SparkSession, d: str) -> DataFrame:
    """Titles of holdings under compatibility folding, with the number of spellings."""
    k = table(spark, d, "holdings").where("title is not null and title <> ''").select("title", T.compatible_key(F.col("title")).alias("title_key"))
    return k.groupBy("title_key").agg(F.count("*").alias("rows"), F.countDistinct("title").alias("spellings"))


def year_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Notes that mention each year."""
    return _notes(spark, d).select(F.explode(T.years(F.col("text"))).alias("year")).groupBy("year").agg(F.count("*").alias("notes"))


QUERIES = {f.__name__: f for f in (note_features, citation_mentions, note_citations, document_counts, document_headers, text_hash_groups, joined_note_text, folded_keys, year_mentions)}

_q = lambda p: p.replace("'", "''")
_NOTES = "WITH n AS (SELECT pdf_id, extractor_version, unnest(notes) AS n FROM sidecars), t AS (SELECT pdf_id, extractor_version, n.ordinal AS ordinal, n.page_start AS page_start, coalesce(n.text, '') AS text FROM n)"
_KIND = "CASE " + " ".join(f"WHEN regexp_matches(text, '{_q(p)}', 'i') THEN '{k}'" for k, p in T.CITATIONS.items()) + " ELSE 'other' END"
_MENTIONS = " UNION ALL ".join(f"SELECT '{k}' AS kind, pdf_id, extractor_version, ordinal, page_start, trim(regexp_replace(unnest(regexp_extract_all(text, '{_q(p)}', 0, 'i')), '[ \\t\\n\\r\\f]+', ' ', 'g')) AS m FROM t" for k, p in T.CITATIONS.items())
_CITES = ", ".join(f"regexp_extract_all(text, '{_q(p)}')" for p in (T.STATUTE, T.CASE, T.SECONDARY))

SQL = {
    "note_features": f"""{_NOTES}
        SELECT pdf_id, extractor_version, ordinal, page_start, {_KIND} AS citation,
          array_to_string(list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(text, '{_q(T.URL)}', 0, 'i'), lambda u: rtrim(u, '.,;:)')), lambda u: regexp_matches(u, '^https?://.', 'i')))), '|') AS urls,
          array_to_string(list_sort(list_distinct(regexp_extract_all(text, '{T.YEAR}'))), '|') AS years,
          array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(text, '{T.EMAIL}', 0, 'i'), lambda e: lower(e)))), '|') AS emails
        FROM t""",
    "citation_mentions": f"""{_NOTES}, m AS ({_MENTIONS}), e AS (SELECT DISTINCT kind, pdf_id, extractor_version, ordinal, page_start, lower(m) AS m FROM m)
        SELECT kind, count(*) AS mentions, count(DISTINCT m) AS different FROM e GROUP BY kind""",
    "note_citations": f"""{_NOTES}
        SELECT CAST(len(list_distinct(list_transform(flatten([{_CITES}]), lambda c: trim(regexp_replace(c, '[ \\t\\n\\r\\f]+', ' ', 'g'))))) AS INTEGER) AS citations, count(*) AS notes FROM t GROUP BY 1""",
    "document_counts": f"""
        SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9_]+(?:[''.-][A-Za-z0-9_]+)*|[^A-Za-z0-9_ \\t\\n\\r\\f\\v]')) AS INTEGER) AS tokens,
          CAST(len(list_filter(string_split(regexp_replace(coalesce(text, ''), '([.!?])[ \\t\\n\\r\\f\\v]+', '\\1' || chr(57344), 'g'), chr(57344)), lambda s: trim(s) <> '')) AS INTEGER) AS sentences,
          array_to_string(list_sort(list_distinct(regexp_extract_all(coalesce(text, ''), '{T.YEAR}'))), '|') AS years
        FROM documents""",
    "document_headers": f"""
        WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
        h AS (SELECT doc_id, trim(raw) AS s, min(i) AS i FROM l
              WHERE length(trim(raw)) BETWEEN 1 AND 120 AND len(regexp_split_to_array(trim(raw), '[ \\t\\n\\r\\f\\v]+')) <= 16
                AND ((regexp_matches(trim(raw), '[A-Z]') AND trim(raw) = upper(trim(raw))) OR regexp_matches(lower(trim(raw)), '{T.HEADING}'))
              GROUP BY doc_id, trim(raw)),
        k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS rn FROM h)
        SELECT doc_id, CAST(count(*) AS INTEGER) AS headers, string_agg(s, '|' ORDER BY i) AS header_text FROM k GROUP BY doc_id""",
    "text_hash_groups": r"""
        WITH k AS (SELECT doc_id, trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')) AS k FROM documents WHERE text IS NOT NULL),
        h AS (SELECT doc_id, sha256(substr(k, 1, 500)) AS text_hash FROM k WHERE k <> '')
        SELECT text_hash, count(*) AS documents, min(doc_id) AS first_id FROM h GROUP BY text_hash HAVING count(*) > 1""",
    "joined_note_text": f"""{_NOTES}, c AS (SELECT *, regexp_replace(regexp_replace(text, '[­↩︎]', '', 'g'), '([A-Za-z])-[ \\t\\n\\r\\f]+([a-z])', '\\1\\2', 'g') AS c FROM t WHERE regexp_matches(text, '[A-Za-z]- [a-z]'))
        SELECT pdf_id, extractor_version, ordinal, page_start, md5(trim(regexp_replace(lower(translate(c, '‐‑‒–—―‘’‛“”„' || chr(160), '------''''''\"\"\" ')), '[ \\t\\n\\r\\f]+', ' ', 'g'))) AS unified FROM c""",
    "year_mentions": f"""{_NOTES}
        SELECT year, count(*) AS notes FROM (SELECT unnest(list_distinct(regexp_extract_all(text, '{T.YEAR}'))) AS year FROM t) GROUP BY year""",
}
