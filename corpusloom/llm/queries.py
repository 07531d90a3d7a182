"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import encode, mixing, name_variants, readability, sampling, scan_repair, site_lines, survivors
from corpusloom.session import table


def _audit(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    stats = table(spark, d, "doc_stats")
    return stats, sampling.calibrate(stats, table(spark, d, "audit_configs"), table(spark, d, "family_targets"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Targets that the PDFs at hand cannot meet."""
    report = _audit(spark, d)[1]
    return report.where("gap > 0").select("config_id", "platform_family")


def p1_sample(spark: SparkSession, d: str) -> DataFrame:
    """The PDFs drawn for every plan."""
    return sampling.sample(*_audit(spark, d))


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    """Targets, plans and what was drawn, for every plan and family."""
    stats, report = _audit(spark, d)
    drawn = sampling.sample(stats, report).groupBy("config_id", sampling.family_key(F.col("platform_family")).alias("fam")).agg(F.count("*").alias("drawn"))
    return report.join(drawn, ["config_id", "fam"], "left").drop("fam").fillna(0, ["drawn"])


def p1_totals(spark: SparkSession, d: str) -> DataFrame:
    """Of every plan: PDFs drawn, and families below what the floor and their PDFs allow."""
    stats, report = _audit(spark, d)
    drawn = sampling.sample(stats, report).groupBy("config_id", sampling.family_key(F.col("platform_family")).alias("fam")).agg(F.count("*").alias("n"))
    per = report.where("target_share > 0").groupBy("config_id", "fam").agg(F.first("available").alias("available"), F.first("floor_per_family").alias("floor")).join(drawn, ["config_id", "fam"], "left")
    n = F.coalesce("n", F.lit(0))
    return per.groupBy("config_id").agg(F.sum(n).alias("drawn"), F.count_if(n < F.least("floor", "available")).alias("below"))


def _scans(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, dict]:
    docs, notes = table(spark, d, "extracted_docs"), table(spark, d, "sidecars")
    return docs, notes, scan_repair.find(docs, notes)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Marks of print and scanning in lines and notes."""
    return scan_repair.found(_scans(spark, d)[2])


def p2_text(spark: SparkSession, d: str) -> DataFrame:
    """Body and notes as continuous paragraphs."""
    docs, notes, parts = _scans(spark, d)
    return scan_repair.repaired_lines(docs, parts).unionAll(scan_repair.repaired_notes(notes, parts))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of spellings of the same person, institution or journal."""
    return name_variants.found(*name_variants.find(table(spark, d, "holdings"), table(spark, d, "registry")))


def p3_entities(spark: SparkSession, d: str) -> DataFrame:
    """Every spelling with its entity, and how many other spellings that has."""
    authors, journals = name_variants.find(table(spark, d, "holdings"), table(spark, d, "registry"))
    return name_variants.members(authors, journals)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Lines that a site puts into many of its documents."""
    docs = table(spark, d, "extracted_docs")
    return site_lines.found_lines(docs, site_lines.repeated(docs)).select("pdf_id", "page_number", "side", "line_no")


def p5_clean(spark: SparkSession, d: str) -> DataFrame:
    """The pages without those lines."""
    docs = table(spark, d, "extracted_docs")
    return site_lines.without_repeated(docs, site_lines.repeated(docs))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Groups of records of the same PDF with the record that survives."""
    return survivors.survivors(table(spark, d, "pdf_records")).select("first_id", "canonical_id")


def p6_survivors(spark: SparkSession, d: str) -> DataFrame:
    """Groups with the fused values of their fields."""
    return survivors.survivors(table(spark, d, "pdf_records"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return encode.encode_corpus(table(spark, d, "documents"))


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    targets = table(spark, d, "mix_targets")
    sized = mixing.sizes(table(spark, d, "documents"), targets)
    return sized, mixing.plan(sized, table(spark, d, "mix_plans"), targets)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Sources too small for their share, even repeated as often as allowed."""
    return _mix(spark, d)[1].where("reason = 'short'").select("mix_id", "source")


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The documents of every mixture and how often each is taken."""
    return mixing.mixture(*_mix(spark, d))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual shares of every mixture."""
    sized, planned = _mix(spark, d)
    return mixing.reached(planned, mixing.mixture(sized, planned))


def _levels(spark: SparkSession, d: str) -> DataFrame:
    return readability.levels(table(spark, d, "documents"), table(spark, d, "grade_labels"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Level of every English document of at least 40 words."""
    return _levels(spark, d).select("doc_id", "level")


def p9_profile(spark: SparkSession, d: str) -> DataFrame:
    """Documents and mean grade by level."""
    return readability.profile(_levels(spark, d))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_sample, p1_report, p1_totals, p2_found, p2_text, p3_found, p3_entities, p5_found, p5_clean, p6_found, p6_survivors, p7_ids, p8_found, p8_mixture, p8_report, p9_found, p9_profile)
}

_FAMILY = "nullif(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', '', 'g'), '')"

SQL = {
    "p1_found": f"""
        WITH have AS (
          SELECT fam, count(*) AS n FROM (
            SELECT pdf_id, arg_max({_FAMILY.format('platform_family')}, (evaluated_at, {_FAMILY.format('platform_family')})) AS fam
            FROM doc_stats WHERE {_FAMILY.format('platform_family')} IS NOT NULL GROUP BY pdf_id) GROUP BY fam)
        SELECT t.config_id, t.platform_family
        FROM family_targets t JOIN audit_configs c USING (config_id)
        LEFT JOIN have h ON h.fam = {_FAMILY.format('t.platform_family')}
        WHERE coalesce(h.n, 0) < c.floor_per_family
           OR coalesce(h.n, 0) < CAST(t.target_share AS DECIMAL(18,9)) * c.sample_size""",
    "p1_totals": f"""
        WITH have AS (
          SELECT fam, count(*) AS n FROM (
            SELECT pdf_id, arg_max({_FAMILY.format('platform_family')}, (evaluated_at, {_FAMILY.format('platform_family')})) AS fam
            FROM doc_stats WHERE {_FAMILY.format('platform_family')} IS NOT NULL GROUP BY pdf_id) GROUP BY fam),
        f AS (SELECT t.config_id, c.sample_size, c.floor_per_family, coalesce(any_value(h.n), 0) AS n
          FROM family_targets t JOIN audit_configs c USING (config_id) LEFT JOIN have h ON h.fam = {_FAMILY.format('t.platform_family')}
          WHERE t.target_share > 0 GROUP BY t.config_id, c.sample_size, c.floor_per_family, {_FAMILY.format('t.platform_family')})
        SELECT config_id, CAST(least(any_value(sample_size), sum(n)) AS BIGINT) AS drawn,
          CASE WHEN sum(least(floor_per_family, n)) <= any_value(sample_size) THEN CAST(0 AS BIGINT) END AS below
        FROM f GROUP BY config_id""",
    "p5_found": r"""
        WITH d AS (SELECT pdf_id, nullif(lower(regexp_extract(pdf_path, '/pdfs/([^/]+)/', 1)), '') AS site, unnest(pages) AS p FROM extracted_docs),
        l AS (SELECT pdf_id, site, p.page_number AS page_number, 'body' AS side, unnest(p.body_lines).text AS text, generate_subscripts(p.body_lines, 1) - 1 AS line_no FROM d
              UNION ALL SELECT pdf_id, site, p.page_number, 'note', unnest(p.note_lines).text, generate_subscripts(p.note_lines, 1) - 1 FROM d),
        k AS (SELECT *, regexp_replace(lower(text), '[^\p{L}]+', '', 'g') AS letters FROM l WHERE site IS NOT NULL),
        n AS (SELECT site, count(DISTINCT pdf_id) AS n FROM d WHERE site IS NOT NULL GROUP BY site),
        g AS (SELECT site, letters, count(DISTINCT pdf_id) AS df FROM k WHERE length(letters) >= 20 GROUP BY site, letters)
        SELECT k.pdf_id, k.page_number, k.side, CAST(k.line_no AS INTEGER) AS line_no
        FROM k JOIN g USING (site, letters) JOIN n USING (site) WHERE g.df >= 3 AND g.df * 10 >= n.n""",
    "p5_clean": r"""
        WITH d AS (SELECT pdf_id, nullif(lower(regexp_extract(pdf_path, '/pdfs/([^/]+)/', 1)), '') AS site, unnest(pages) AS p, generate_subscripts(pages, 1) - 1 AS page_no FROM extracted_docs),
        l AS (SELECT pdf_id, site, page_no, p.page_number AS page_number, 'body' AS side, unnest(p.body_lines).text AS text, generate_subscripts(p.body_lines, 1) - 1 AS line_no FROM d
              UNION ALL SELECT pdf_id, site, page_no, p.page_number, 'note', unnest(p.note_lines).text, generate_subscripts(p.note_lines, 1) - 1 FROM d),
        k AS (SELECT *, regexp_replace(lower(text), '[^\p{L}]+', '', 'g') AS letters FROM l),
        n AS (SELECT site, count(DISTINCT pdf_id) AS n FROM d WHERE site IS NOT NULL GROUP BY site),
        g AS (SELECT site, letters, count(DISTINCT pdf_id) AS df FROM k WHERE site IS NOT NULL AND length(letters) >= 20 GROUP BY site, letters),
        h AS (SELECT site, letters FROM g JOIN n USING (site) WHERE df >= 3 AND df * 10 >= n.n)
        SELECT pdf_id, page_number, side, CAST(count(*) AS INTEGER) AS n_lines, string_agg(text, chr(10) ORDER BY line_no) AS text
        FROM k ANTI JOIN h ON h.site = k.site AND h.letters = k.letters WHERE text IS NOT NULL GROUP BY pdf_id, page_no, page_number, side""",
    "p6_found": r"""
        WITH RECURSIVE k AS (
          SELECT pdf_id, 's' || lower(sha256) AS key FROM pdf_records WHERE sha256 IS NOT NULL AND trim(sha256) <> ''
          UNION ALL SELECT pdf_id, 't' || title_key || chr(1) || first_text_hash FROM pdf_records WHERE title_key IS NOT NULL AND first_text_hash IS NOT NULL
          UNION ALL SELECT pdf_id, 'f' || journal_domain || chr(1) || regexp_replace(regexp_replace(regexp_replace(path, '^.*/', ''), '\.[A-Za-z0-9]{1,5}$', ''), '-[0-9]+$', '')
                    FROM pdf_records WHERE journal_domain IS NOT NULL AND path IS NOT NULL),
        e AS (SELECT DISTINCT a.pdf_id AS a, b.pdf_id AS b FROM k a JOIN k b USING (key) WHERE a.pdf_id <> b.pdf_id),
        r AS (SELECT a AS id, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id),
        g AS (SELECT id, min(root) AS first_id FROM r GROUP BY id)
        SELECT first_id, id AS canonical_id FROM (
          SELECT g.first_id, g.id, row_number() OVER (PARTITION BY g.first_id ORDER BY coalesce(p.mtime, '-infinity'::DOUBLE) DESC, coalesce(p.size, 0) DESC, coalesce(p.page_count, 0) DESC, p.path) AS rn
          FROM g JOIN pdf_records p ON p.pdf_id = g.id) WHERE rn = 1""",
}
