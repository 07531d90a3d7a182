"""Queries over notes, layout, duplicates, registries and evaluations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import records as R
from corpusloom.functions import urls as U
from corpusloom.operators import evaluate as E
from corpusloom.operators import groups as G
from corpusloom.operators import layout as L
from corpusloom.operators import notes as N
from corpusloom.plans import record_queries as Q
from corpusloom.session import table


def _notes(spark: SparkSession, d: str, *more: str) -> DataFrame:
    return N.notes_of(table(spark, d, "sidecars"), *more)


def _latest(spark: SparkSession, d: str) -> DataFrame:
    """Notes of the latest extraction of every PDF."""
    last = table(spark, d, "sidecars").groupBy("pdf_id").agg(F.max("extractor_version").alias("extractor_version"))
    return _notes(spark, d).join(last, ["pdf_id", "extractor_version"], "left_semi")


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "extracted_docs")


def label_ordinality(spark: SparkSession, d: str) -> DataFrame:
    """Status, span and gaps of the labels of every sidecar, outliers included."""
    o = N.document_labels(_notes(spark, d)).select("pdf_id", "extractor_version", F.size("labels").alias("labels"), N.ordinality(F.col("labels")).alias("o"))
    return o.select("pdf_id", "extractor_version", "labels", "o.status", "o.low", "o.high", F.array_join("o.gaps", ",").alias("gaps"), F.round("o.ratio", 6).alias("ratio"))


def trimmed_ordinality(spark: SparkSession, d: str) -> DataFrame:
    """The same without isolated labels at the ends."""
    o = N.document_labels(_notes(spark, d)).select("pdf_id", "extractor_version", N.ordinality(N.trimmed(F.col("labels"))).alias("o"))
    return o.select("pdf_id", "extractor_version", "o.status", "o.low", "o.high", F.array_join("o.gaps", ",").alias("gaps"))


def label_page_bounds(spark: SparkSession, d: str) -> DataFrame:
    """First and last page of every label."""
    return N.page_bounds(_notes(spark, d))


def _gathered(spark: SparkSession, d: str) -> DataFrame:
    s = N.segmented(N.note_lines(_docs(spark, d)))
    return s.select("pdf_id", F.lit("lines").alias("extractor_version"), F.col("note_no").alias("idx"), F.col("label").alias("number"), "page_start", "page_end", "text")


def label_gap_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages on which labels missing among gathered notes may stand."""
    return N.gap_pages(_gathered(spark, d))


def relabelled_notes(spark: SparkSession, d: str) -> DataFrame:
    """Notes numbered by their place."""
    return N.relabelled(_notes(spark, d))


def junk_notes(spark: SparkSession, d: str) -> DataFrame:
    """Gathered notes that look like artefacts."""
    return N.junk_signals(_gathered(spark, d))


def note_confidences(spark: SparkSession, d: str) -> DataFrame:
    """Mean confidence of the notes of every sidecar."""
    n = _notes(spark, d).withColumn("c", N.note_confidence())
    return n.groupBy("pdf_id", "extractor_version").agg(F.count("*").alias("notes"), F.round(F.avg("c"), 6).alias("confidence"))


def merged_notes(spark: SparkSession, d: str) -> DataFrame:
    """Notes of the same label as one."""
    m = N.merged_labels(_notes(spark, d))
    return m.select("pdf_id", "extractor_version", "label", F.md5("text").alias("text"), "page_end", F.round("confidence", 6).alias("confidence"), "flags", "merged")


def label_sort(spark: SparkSession, d: str) -> DataFrame:
    """Notes of every sidecar in order of their labels."""
    from pyspark.sql import Window

    w = Window.partitionBy("pdf_id", "extractor_version").orderBy(N.label_order(F.col("label")), "idx")
    return _notes(spark, d).select("pdf_id", "extractor_version", "label", "idx", F.row_number().over(w).alias("place"))


def recurring_lines(spark: SparkSession, d: str) -> DataFrame:
    """Texts in the same place on many pages of a document."""
    return L.recurring_lines(L.page_lines(_docs(spark, d)))


def font_variance(spark: SparkSession, d: str) -> DataFrame:
    """Range of type sizes by page."""
    return L.font_variance(L.page_lines(_docs(spark, d)))


def font_transition(spark: SparkSession, d: str) -> DataFrame:
    """Where smaller type begins on a page."""
    return L.font_transition(L.page_lines(_docs(spark, d)))


def marker_density(spark: SparkSession, d: str) -> DataFrame:
    """Where lines like notes begin on a page."""
    return L.marker_density(L.page_lines(_docs(spark, d)))


def frame_density(spark: SparkSession, d: str) -> DataFrame:
    """Where eight lines like notes begin on a page."""
    return L.frame_density(L.page_lines(_docs(spark, d)))


def page_text_density(spark: SparkSession, d: str) -> DataFrame:
    """Characters of five pages of every document."""
    return L.text_density(_docs(spark, d))


def note_segments(spark: SparkSession, d: str) -> DataFrame:
    """Notes gathered from note lines."""
    s = N.segmented(N.note_lines(_docs(spark, d)))
    return s.select("pdf_id", "note_no", "label", "page_start", "page_end", F.length("text").alias("chars"), F.md5("text").alias("text"))


def solved_labels(spark: SparkSession, d: str) -> DataFrame:
    """The best chain of labels of every document."""
    return N.solved_labels(N.candidate_lists(_docs(spark, d)))


def note_contexts(spark: SparkSession, d: str) -> DataFrame:
    """The body line in which every note is called."""
    n = _latest(spark, d)
    return L.context_lines(_docs(spark, d), n).select("pdf_id", "label", "page", "idx", "context_page", "pos", F.md5("text").alias("text"), "found")


def _evaluated(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    gold = _latest(spark, d).where("number is not null").select("pdf_id", F.col("number").alias("label"), F.col("idx").alias("seq"), "text")
    pred = N.segmented(N.note_lines(_docs(spark, d))).select("pdf_id", "label", F.col("note_no").alias("seq"), "text")
    return gold, pred


def label_scores(spark: SparkSession, d: str) -> DataFrame:
    """Labels of gathered notes against those of sidecars."""
    return E.label_scores(*_evaluated(spark, d))


def failure_taxonomy(spark: SparkSession, d: str) -> DataFrame:
    """Kinds of failures by document."""
    return E.failure_taxonomy(*_evaluated(spark, d))


def token_scores(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of gathered notes against those of sidecars, by document."""
    gold, pred = (x.groupBy("pdf_id", "label").agg(F.min_by("text", "seq").alias("text")) for x in _evaluated(spark, d))
    s = E.token_scores(gold, pred, ["pdf_id", "label"])
    return s.groupBy("pdf_id").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))


def duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    """Every file that has copies, with the canonical file and the reasons of its group."""
    return G.duplicate_members(table(spark, d, "pdf_records"))


def domain_medians(spark: SparkSession, d: str) -> DataFrame:
    """Medians of size and pages by site."""
    return G.domain_medians(table(spark, d, "pdf_records"))


def volume_suspects(spark: SparkSession, d: str) -> DataFrame:
    """Files that look like whole volumes."""
    return G.volume_suspects(table(spark, d, "pdf_records"))


def path_shards(spark: SparkSession, d: str) -> DataFrame:
    """Shard of every file among eight."""
    return table(spark, d, "pdf_records").select("pdf_id", G.path_shard(F.col("path"), 8).alias("shard"))


def first_files(spark: SparkSession, d: str) -> DataFrame:
    """The first file of every hash."""
    return table(spark, d, "pdf_records").groupBy(F.lower("sha256").alias("sha")).agg(F.min_by("path", "pdf_id").alias("path"), F.count("*").alias("files"))


def promoted_names(spark: SparkSession, d: str) -> DataFrame:
    """File names without collisions inside a site."""
    return G.versioned_names(table(spark, d, "pdf_records"), "journal_domain", "path", "pdf_id")


def registry_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Counts of the registry by platform, status, source and what is missing, in one pass."""
    r = table(spark, d, "registry")
    fields = F.explode(F.array(*[F.struct(F.lit(n).alias("field"), c.alias("value")) for n, c in (("platform", R.platform(F.col("platform"))), ("status", R.text(F.col("status"))), ("source", R.text(F.col("source"))), ("no_sitemap", (R.text(F.col("sitemap_file")) == "").cast("string")), ("total", F.lit("")))]))
    return r.select("host", "journal_name", fields.alias("x")).groupBy("x.field", "x.value").agg(F.count("*").alias("rows"), F.countDistinct("host").alias("hosts"), F.countDistinct("journal_name").alias("journals"))


def registry_groups(spark: SparkSession, d: str) -> DataFrame:
    """Registry rows of the same journal."""
    return G.registry_groups(table(spark, d, "registry"))


def unique_hosts(spark: SparkSession, d: str) -> DataFrame:
    """Hosts with one journal."""
    return G.unique_hosts(table(spark, d, "registry"))


def holdings_view(spark: SparkSession, d: str) -> DataFrame:
    """The best record of every file with the journal it belongs to."""
    h = G.holdings(table(spark, d, "run_records"), table(spark, d, "registry"))
    return h.select("identity", "record_id", "host", "journal", "title", "authors", "year", F.coalesce(F.get("contexts", F.lit(0)), F.lit("")).alias("context"))


def holdings_by_journal(spark: SparkSession, d: str) -> DataFrame:
    """Files, years and described files by journal."""
    h = G.holdings(table(spark, d, "run_records"), table(spark, d, "registry"))
    y = F.nullif("year", F.lit(""))
    return h.groupBy("journal").agg(F.count("*").alias("files"), F.sum((F.col("title") != "").cast("int")).alias("titled"), F.min(y).alias("first_year"), F.max(y).alias("last_year"), F.countDistinct("host").alias("hosts"))


def site_status(spark: SparkSession, d: str) -> DataFrame:
    """Sites of registry, records and files side by side."""
    reg = G.registry_index(table(spark, d, "registry")).groupBy("host").agg(F.countDistinct("journal").alias("journals"))
    run = table(spark, d, "run_records").groupBy(U.host(F.col("domain")).alias("host")).agg(F.count("*").alias("records"), F.sum(F.coalesce("ok", F.lit(False)).cast("int")).alias("ok"))
    pdf = table(spark, d, "pdf_records").groupBy(U.path_domain(F.col("path")).alias("host")).agg(F.count("*").alias("files"))
    return reg.join(run, "host", "full_outer").join(pdf, "host", "full_outer").fillna(0, ["journals", "records", "ok", "files"])


def site_rank(spark: SparkSession, d: str) -> DataFrame:
    """Sites by weighted records, failures and breadth."""
    r = table(spark, d, "run_records").groupBy(U.host(F.col("domain")).alias("host")).agg(F.count("*").alias("records"), F.sum((~F.coalesce("ok", F.lit(False))).cast("int")).alias("failed"), F.countDistinct("metadata.volume").alias("volumes"))
    return G.rank_by(r, "host", {"records": 0.5, "failed": 0.3, "volumes": 0.2})


def unrecorded_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of the corpus that no holding knows, by hash."""
    known = table(spark, d, "holdings").select(F.lower("pdf_sha256").alias("sha")).where("sha is not null").distinct()
    have = table(spark, d, "pdf_records").select("pdf_id", F.lower("sha256").alias("sha"))
    return have.join(known, "sha", "left_anti").groupBy("sha").agg(F.min("pdf_id").alias("first_id"), F.count("*").alias("files"))


def corpus_report(spark: SparkSession, d: str) -> DataFrame:
    """Evaluations by kind of document: counts, medians and percentiles."""
    s = table(spark, d, "doc_stats")
    kind = F.coalesce(F.nullif(F.trim("doc_type"), F.lit("")), F.lit("unknown"))
    p = lambda c, q, name: F.round(F.percentile(c, F.lit(q)), 6).alias(name)
    return s.groupBy(kind.alias("doc_type")).agg(
        F.count("*").alias("rows"), F.countDistinct("pdf_id").alias("pdfs"), F.sum((F.col("ordinality_status") == "valid").cast("int")).alias("valid"), F.sum(F.coalesce(F.col("note_count") == 0, F.lit(False)).cast("int")).alias("without_notes"),
        p("document_confidence", 0.5, "median_confidence"), p("document_confidence", 0.1, "low_confidence"), p("note_count", 0.9, "many_notes"), F.sum("gap_count").alias("gaps"),
    )


def failure_modes(spark: SparkSession, d: str) -> DataFrame:
    """The newest evaluation of every PDF by what went wrong."""
    s = table(spark, d, "doc_stats").groupBy("pdf_id").agg(F.max_by(F.struct("ordinality_status", "note_count", "gap_count", "document_confidence", "missing_context_count"), F.struct("evaluated_at", "note_count")).alias("s")).select("pdf_id", "s.*")
    mode = F.when(F.col("note_count") == 0, "no_notes").when((F.col("ordinality_status") == "invalid") & (F.col("gap_count") > 20), "many_gaps").when(F.col("ordinality_status") == "invalid", "some_gaps").when(F.col("document_confidence") < 0.5, "low_confidence").when(F.col("missing_context_count") > 5, "no_context").otherwise("none")
    return s.groupBy(mode.alias("mode")).agg(F.count("*").alias("pdfs"), F.sum("gap_count").alias("gaps"))


def platform_families(spark: SparkSession, d: str) -> DataFrame:
    """Spellings of platforms by family."""
    s = table(spark, d, "doc_stats")
    return s.groupBy(R.platform(F.col("platform_family")).alias("platform")).agg(F.count("*").alias("rows"), F.countDistinct("platform_family").alias("spellings"))


def spread_files(spark: SparkSession, d: str) -> DataFrame:
    """Oldest, newest and evenly spaced files of every site."""
    return G.spread(table(spark, d, "pdf_records"), "journal_domain", ["mtime", "pdf_id"], "pdf_id")


QUERIES = {
    f.__name__: f
    for f in (
        label_ordinality, trimmed_ordinality, label_page_bounds, label_gap_pages, relabelled_notes, junk_notes, note_confidences, merged_notes, label_sort, recurring_lines, font_variance, font_transition,
        marker_density, frame_density, page_text_density, note_segments, solved_labels, note_contexts, label_scores, failure_taxonomy, token_scores, duplicate_groups, domain_medians, volume_suspects, path_shards,
        first_files, promoted_names, registry_snapshot, registry_groups, unique_hosts, holdings_view, holdings_by_journal, site_status, site_rank, unrecorded_files, corpus_report, failure_modes, platform_families, spread_files,
    )
}

_N = "n0 AS (SELECT pdf_id, extractor_version, unnest(notes) AS n, generate_subscripts(notes, 1) - 1 AS idx FROM sidecars), n AS (SELECT pdf_id, extractor_version, idx, n.label AS label, n.ordinal AS ordinal, n.text AS text, n.page_start AS page_start, n.page_end AS page_end, n.context_body AS context_body, n.confidence AS confidence, n.flags AS flags, CASE WHEN regexp_matches(n.label, '^[0-9]{1,6}$') THEN CAST(n.label AS INT) END AS number FROM n0)"
_L = "p AS (SELECT pdf_id, unnest(pages) AS p, generate_subscripts(pages, 1) - 1 AS page_index FROM extracted_docs), l0 AS (SELECT pdf_id, page_index, p.page_number AS page, p.height AS height, list_concat(coalesce(p.body_lines, []), coalesce(p.note_lines, [])) AS ls FROM p), l1 AS (SELECT pdf_id, page_index, page, height, len(ls) AS n_lines, unnest(ls) AS l, generate_subscripts(ls, 1) - 1 AS pos FROM l0), l AS (SELECT pdf_id, page_index, page, height, n_lines, pos, l.text AS text, l.top AS top, l.font_size AS font_size FROM l1)"
_PB = "pb AS (SELECT pdf_id, extractor_version, number, min(page_start) AS first_page, max(greatest(page_start, coalesce(page_end, page_start))) AS last_page FROM n WHERE number IS NOT NULL AND coalesce(page_start, 0) > 0 GROUP BY ALL)"
_LIKE, _LEGAL = (p.replace("'", "''") for p in (N.NOTE_LIKE, N.LEGAL_SIGNAL))
_CUT = f"""k AS (SELECT *, CAST(coalesce(regexp_matches(text, '{_LIKE}'), false) AS INT) AS lk, CAST(coalesce(regexp_matches(text, '{_LEGAL}'), false) AS INT) AS lg, row_number() OVER (PARTITION BY pdf_id, page_index ORDER BY top, pos) AS rn FROM l WHERE height > 0)"""
#: Note lines in reading order, spaces collapsed.
_V = r"""t AS (SELECT pdf_id, unnest(pages) AS p, generate_subscripts(pages, 1) - 1 AS page_index FROM extracted_docs),
  u AS (SELECT pdf_id, page_index, p.page_number AS page, unnest(p.note_lines) AS l, generate_subscripts(p.note_lines, 1) - 1 AS line FROM t),
  v AS (SELECT pdf_id, page_index, line, page, trim(regexp_replace(l.text, '[\s\x{00A0}]+', ' ', 'g')) AS text FROM u)"""
#: From lines ``v`` the notes ``s``: the best chain of labels, found as a longest path.
_CHAIN = (r"""m AS (SELECT *, CASE WHEN NOT regexp_matches(regexp_extract(text, '^([0-9]{1,4})[\]).,:;-]?\s+(\S.*)$', 2), '""" + N.FRAGMENT + r"""') THEN TRY_CAST(nullif(regexp_extract(text, '^([0-9]{1,4})[\]).,:;-]?\s+\S', 1), '') AS INT) END AS n FROM v WHERE text <> ''),
  lb AS (SELECT pdf_id, page_index, line, n, row_number() OVER (PARTITION BY pdf_id ORDER BY page_index, line) AS k FROM m WHERE n IS NOT NULL),
  ls AS (SELECT pdf_id, list(n ORDER BY k) AS ns FROM lb GROUP BY 1),
  dp AS (SELECT pdf_id, ns, 0 AS k, CAST([] AS DOUBLE[]) AS tot, CAST([] AS BIGINT[]) AS par FROM ls
    UNION ALL SELECT pdf_id, ns, k + 1, list_append(tot, -b.v), list_append(par, b.j) FROM (
      SELECT *, list_min(list_append(list_transform(range(1, k + 1), lambda j: {'v': -(tot[j] + 1 - (CASE WHEN ns[k + 1] - ns[j] BETWEEN 1 AND 4 THEN [0.0, 0.5, 1.5, 2.5][ns[k + 1] - ns[j]] WHEN ns[k + 1] = 1 THEN 1.5 ELSE 3.0 END)), 'w': CASE WHEN ns[k + 1] - ns[j] BETWEEN 1 AND 4 THEN ns[k + 1] - ns[j] ELSE 5 END, 'j': j}),
        {'v': -(1 - (CASE WHEN ns[k + 1] BETWEEN 1 AND 4 THEN [0.0, 0.5, 1.5, 2.5][ns[k + 1]] ELSE 3.0 END)), 'w': 0, 'j': 0})) AS b FROM dp WHERE k < len(ns))),
  pt AS (SELECT pdf_id, par, CAST(list_position(tot, list_max(tot)) AS BIGINT) AS k FROM dp WHERE k = len(ns) UNION ALL SELECT pdf_id, par, par[k] FROM pt WHERE par[k] > 0),
  o AS (SELECT m.*, CAST(pt.k IS NOT NULL AS INT) AS opens FROM m LEFT JOIN lb USING (pdf_id, page_index, line) LEFT JOIN pt ON pt.pdf_id = m.pdf_id AND pt.k = lb.k),
  g AS (SELECT *, sum(opens) OVER (PARTITION BY pdf_id ORDER BY page_index, line ROWS UNBOUNDED PRECEDING) AS note_no FROM o),
  s AS (SELECT pdf_id, CAST(note_no AS BIGINT) AS note_no, max(CASE WHEN opens = 1 THEN n END) AS label, min(page) AS page_start, max(page) AS page_end, regexp_replace(replace(regexp_replace(string_agg(CASE WHEN opens = 1 THEN regexp_replace(text, '^[0-9]{1,4}[\]).,:;-]?\s+', '') ELSE text END, ' ' ORDER BY page_index, line), '([A-Za-z0-9_])- ([a-z])', '\1' || chr(57344) || '\2', 'g'), chr(57344), ''), '^ +', '') AS text FROM g WHERE note_no > 0 GROUP BY pdf_id, note_no)""")
_SEG = f"{_V}, {_CHAIN}"
_GOLD = "gold AS (SELECT pdf_id, number AS label, idx AS seq, text FROM n WHERE (pdf_id, extractor_version) IN (SELECT (pdf_id, max(extractor_version)) FROM sidecars GROUP BY pdf_id) AND number IS NOT NULL), pred AS (SELECT pdf_id, label, note_no AS seq, text FROM s)"
_MS = "c AS (SELECT pdf_id, label, sum(g) AS g, sum(p) AS p FROM (SELECT pdf_id, label, 1 AS g, 0 AS p FROM gold UNION ALL SELECT pdf_id, label, 0, 1 FROM pred) GROUP BY ALL), q AS (SELECT pdf_id, sum(least(g, p)) AS tp, sum(greatest(p - g, 0)) AS fp, sum(greatest(g - p, 0)) AS fn FROM c GROUP BY 1)"
_ORD = "a1 AS (SELECT pdf_id, row_number() OVER (PARTITION BY pdf_id ORDER BY seq) AS i, label AS a FROM gold), b1 AS (SELECT pdf_id, row_number() OVER (PARTITION BY pdf_id ORDER BY seq) AS i, label AS b FROM pred), j AS (SELECT pdf_id, min(coalesce(CAST(a = b AS INT), 0)) AS same FROM a1 FULL OUTER JOIN b1 USING (pdf_id, i) GROUP BY 1)"
_PR = "CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS pr, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS rc"
_PLAIN = "trim(regexp_replace(lower(translate(text, '‐‑‒–—―‘’‛“”„' || chr(160), '------''''''\"\"\" ')), '[ \\t\\n\\r\\f\\v]+', ' ', 'g'))"
_RI = f"ri AS (SELECT DISTINCT coalesce(nullif({Q._host('host')}, ''), {Q._host('url')}) AS host, {Q._t('journal_name')} AS journal, {Q._slug('url')} AS slug FROM registry WHERE coalesce(nullif({Q._host('host')}, ''), {Q._host('url')}) <> '' AND {Q._t('journal_name')} <> '')"
_HOLD = f"""h0 AS (SELECT seq, record_id, coalesce(nullif({Q._host('domain')}, ''), {Q._host("coalesce(nullif(trim(pdf_url), ''), trim(metadata.url))")}) AS host, [{Q._HINTS}] AS hints, {Q._t('metadata.title')} AS title, {Q._AUTHORS} AS authors, coalesce({Q._YEAR('metadata.year')}, {Q._YEAR('metadata.date')}, '') AS year,
    coalesce(nullif(trim(pdf_sha256), ''), nullif(trim(pdf_url), ''), nullif(trim(metadata.url), ''), nullif(trim(local_path), '')) AS identity FROM run_records WHERE coalesce(ok, false) OR download_state = 'downloaded'),
  h1 AS (SELECT *, row_number() OVER (PARTITION BY identity ORDER BY title <> '' DESC, authors <> '' DESC, year <> '' DESC, seq, record_id) AS rn FROM h0 WHERE identity IS NOT NULL),
  h2 AS (SELECT *, list_filter(hints, lambda x: x <> '') AS ctx FROM h1 WHERE rn = 1), {_RI},
  nm AS (SELECT h2.identity, count(DISTINCT journal) AS k, min(journal) AS j FROM h2 JOIN ri ON ri.host = h2.host AND list_contains(h2.ctx, ri.slug) GROUP BY 1),
  ev AS (SELECT host, count(DISTINCT journal) AS k, min(journal) AS j FROM ri GROUP BY 1),
  hh AS (SELECT h2.*, CASE WHEN nm.k = 1 THEN nm.j WHEN ev.k = 1 THEN ev.j WHEN len(ctx) > 0 THEN ctx[1] || ' (' || coalesce(h2.host, '') || ')' ELSE coalesce(nullif(h2.host, ''), '(unknown journal)') END AS journal FROM h2 LEFT JOIN nm USING (identity) LEFT JOIN ev ON ev.host = h2.host)"""
_STEM = r"regexp_replace(regexp_replace(path, '^.*/', ''), '\.[A-Za-z0-9]{1,5}$', '')"

SQL = {
    "label_ordinality": f"""WITH {_N}, d AS (SELECT pdf_id, extractor_version, count(DISTINCT number) AS labels, min(number) AS lo, max(number) AS hi, list_sort(list_distinct(list(number) FILTER (WHERE number IS NOT NULL))) AS ls FROM n GROUP BY ALL),
        g AS (SELECT *, CASE WHEN labels > 0 THEN list_filter(range(lo, hi + 1), lambda x: NOT list_contains(ls, x)) ELSE [] END AS gp, coalesce(hi - lo + 1, 1) AS span FROM d)
        SELECT pdf_id, extractor_version, CAST(labels AS INT) AS labels, CASE WHEN len(gp) = 0 THEN 'valid' WHEN len(gp) > 2 AND len(gp) / span > 0.05 THEN 'invalid' ELSE 'valid_with_gaps' END AS status, coalesce(lo, 0) AS low, coalesce(hi, 0) AS high, coalesce(array_to_string(gp, ','), '') AS gaps, round(len(gp) / span, 6) AS ratio FROM g""",
    "label_page_bounds": f"WITH {_N}, {_PB} SELECT * FROM pb",
    "label_gap_pages": f"""WITH RECURSIVE {_SEG}, n AS (SELECT pdf_id, 'lines' AS extractor_version, label AS number, page_start, page_end FROM s), {_PB}, w AS (SELECT *, lead(number) OVER (PARTITION BY pdf_id, extractor_version ORDER BY number) AS nx, lead(first_page) OVER (PARTITION BY pdf_id, extractor_version ORDER BY number) AS np FROM pb)
        SELECT pdf_id, extractor_version, number AS after_label, nx AS before_label, CAST(unnest(CASE WHEN greatest(1, last_page) <= np THEN range(greatest(1, last_page), np + 1) ELSE [CAST(greatest(1, last_page) AS BIGINT)] END) AS INT) AS page FROM w WHERE nx > number + 1""",
    "relabelled_notes": f"WITH {_N} SELECT pdf_id, extractor_version, CAST(idx AS INT) AS idx, label, CAST(row_number() OVER w AS INT) AS new_label, coalesce(number, -1) <> row_number() OVER w AS changed FROM n WINDOW w AS (PARTITION BY pdf_id, extractor_version ORDER BY page_start, page_end, ordinal, idx)",
    "junk_notes": rf"""WITH RECURSIVE {_SEG}, nt AS (SELECT pdf_id, 'lines' AS extractor_version, note_no AS idx, trim(coalesce(text, '')) AS t FROM s), c AS (SELECT *, count(*) OVER (PARTITION BY pdf_id, extractor_version, t) AS same, regexp_matches(t, '{N.SHORT_CITE}') AS cite FROM nt),
        js AS (SELECT *, CASE WHEN t = '' THEN 'empty_note' WHEN regexp_matches(t, '^[\[(-]*\s*[0-9]{{1,4}}\s*[\])-]*\.?$') THEN 'page_number_artifact' WHEN regexp_matches(t, '(?i)^\[?vol\.?\s*[0-9]+') THEN 'vol_issue_stamp' END AS stop FROM c)
        SELECT pdf_id, extractor_version, idx, signal FROM (SELECT *, stop AS signal FROM js WHERE stop IS NOT NULL UNION ALL SELECT *, 'suspiciously_short' FROM js WHERE stop IS NULL AND length(t) < 15 AND NOT cite UNION ALL SELECT *, 'duplicate_text' FROM js WHERE stop IS NULL AND same >= 3 AND length(t) >= 60 AND NOT cite)""",
    "note_confidences": f"""WITH {_N}, c AS (SELECT *, 0.55 + CASE WHEN length(trim(coalesce(text, ''))) >= 80 THEN 0.2 WHEN length(trim(coalesce(text, ''))) >= 30 THEN 0.1 ELSE -0.1 END + CASE WHEN coalesce(context_body, '') <> '' THEN 0.1 ELSE -0.15 END + CASE WHEN page_end > page_start THEN 0.05 ELSE 0 END
          - 0.1 * len(list_filter(coalesce(flags, []), lambda f: f IN ('ambiguous_context', 'missing_context'))) AS s FROM n)
        SELECT pdf_id, extractor_version, count(*) AS notes, round(avg(CAST(greatest(0, least(1, s)) AS DOUBLE)), 6) AS confidence FROM c GROUP BY ALL""",
    "merged_notes": f"""WITH {_N}, g AS (SELECT pdf_id, extractor_version, label, list(coalesce(text, '') ORDER BY idx) AS ts, max(page_end) AS page_end, min(confidence) AS confidence, list_sort(list_distinct(flatten(list(flags)))) AS fl, count(*) AS merged FROM n GROUP BY ALL)
        SELECT pdf_id, extractor_version, label, md5(list_reduce(list_concat([''], ts), lambda acc, x: CASE WHEN x = '' THEN acc WHEN acc = '' THEN x WHEN contains(acc, x) THEN acc ELSE acc || ' ' || x END)) AS text, page_end, round(confidence, 6) AS confidence, coalesce(array_to_string(fl, '|'), '') AS flags, merged FROM g""",
    "label_sort": f"WITH {_N} SELECT pdf_id, extractor_version, label, CAST(idx AS INT) AS idx, CAST(row_number() OVER (PARTITION BY pdf_id, extractor_version ORDER BY (NOT coalesce(regexp_matches(label, '^[0-9]{{1,9}}$'), false)), coalesce(number, 0), label, idx) AS INT) AS place FROM n",
    "recurring_lines": f"""WITH {_L}, c AS (SELECT pdf_id, count(DISTINCT page_index) AS n_pages FROM l GROUP BY 1), t AS (SELECT pdf_id, CAST(round(top / 10) AS INT) AS band, regexp_replace(lower(trim(text)), '[0-9]+', '#', 'g') AS line, count(DISTINCT page_index) AS pages FROM l WHERE text IS NOT NULL AND trim(text) <> '' GROUP BY ALL)
        SELECT pdf_id, band, line, pages FROM t JOIN c USING (pdf_id) WHERE pages >= greatest(3, floor(n_pages * 0.4))""",
    "font_variance": f"WITH {_L}, g AS (SELECT pdf_id, page_index, count(font_size) AS sized, round(max(font_size) - min(font_size), 3) AS spread FROM l GROUP BY ALL) SELECT pdf_id, CAST(page_index AS INT) AS page_index, sized, spread, coalesce(sized >= 6 AND spread <= 1.25, false) AS low_variance FROM g",
    "font_transition": f"""WITH {_L}, m AS (SELECT pdf_id, page_index, median(font_size) AS med FROM l GROUP BY ALL HAVING count(font_size) >= 10),
        w AS (SELECT l.*, med, avg(font_size) OVER (PARTITION BY pdf_id, page_index ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS above, avg(font_size) OVER (PARTITION BY pdf_id, page_index ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS below FROM l JOIN m USING (pdf_id, page_index))
        SELECT pdf_id, CAST(page_index AS INT) AS page_index, arg_min(top, pos) AS cutoff FROM w WHERE pos >= floor(n_lines * 0.4) AND pos < n_lines - 2 AND above > med * 0.98 AND below < med * 0.92 GROUP BY ALL""",
    "marker_density": f"""WITH {_L}, {_CUT}, w AS (SELECT *, sum(lk) OVER x AS n_like, sum(lg) OVER x AS n_legal, count(*) OVER x AS n FROM k WINDOW x AS (PARTITION BY pdf_id, page_index ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
        SELECT pdf_id, CAST(page_index AS INT) AS page_index, arg_min(top, rn) AS cutoff FROM w WHERE n_lines >= 6 AND top / height >= 0.45 AND n >= 2 AND n <= greatest(6, floor(n_lines * 0.7)) AND n_like >= 2 AND (n_like + 0.5 * n_legal) / n >= 0.35 GROUP BY ALL""",
    "frame_density": f"""WITH {_L}, {_CUT}, w AS (SELECT *, sum(greatest(lk, lg)) OVER f AS s8, sum(lk) OVER f AS l8, count(*) OVER f AS n8, count(*) OVER x AS n FROM k WINDOW f AS (PARTITION BY pdf_id, page_index ORDER BY rn ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING), x AS (PARTITION BY pdf_id, page_index ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
        SELECT pdf_id, CAST(page_index AS INT) AS page_index, arg_min(top, rn) AS cutoff FROM w WHERE n_lines >= 8 AND top / height >= 0.4 AND n8 >= 5 AND n <= greatest(8, floor(n_lines * 0.75)) AND s8 >= 5 AND l8 >= 2 GROUP BY ALL""",
    "page_text_density": """WITH d AS (SELECT pdf_id, len(pages) AS n_pages, unnest(list_distinct([0, CAST(floor(len(pages) / 4) AS INT), CAST(floor(len(pages) / 2) AS INT), CAST(floor(len(pages) * 3 / 4) AS INT), len(pages) - 1])) AS i, pages FROM extracted_docs WHERE len(pages) > 0)
        SELECT pdf_id, CAST(n_pages AS INT) AS n_pages, round(avg(coalesce(list_sum(list_transform(pages[i + 1].body_lines, lambda l: length(trim(coalesce(l.text, ''))))), 0)), 4) AS density FROM d GROUP BY ALL""",
    "note_segments": f"WITH RECURSIVE {_SEG} SELECT pdf_id, note_no, label, page_start, page_end, CAST(length(text) AS INT) AS chars, md5(text) AS text FROM s",
    "note_contexts": rf"""WITH {_N}, p AS (SELECT pdf_id, unnest(pages) AS p FROM extracted_docs), b0 AS (SELECT pdf_id, p.page_number AS bp, unnest(p.body_lines) AS l, generate_subscripts(p.body_lines, 1) - 1 AS pos FROM p), b AS (SELECT pdf_id, bp, pos, l.text AS text FROM b0),
        c0 AS (SELECT pdf_id, bp, pos, text, unnest(regexp_extract_all(text, '[A-Za-z][.,;:?!]?"?([0-9]{{1,4}})(?:\s|$)', 1)) AS label FROM b), c AS (SELECT pdf_id, bp, label, max(pos) AS pos, arg_max(text, pos) AS text FROM c0 GROUP BY ALL), z AS (SELECT pdf_id, bp, max(pos) AS pos, arg_max(text, pos) AS text FROM b GROUP BY ALL),
        m AS (SELECT DISTINCT pdf_id, label, page_start AS page, idx FROM n WHERE (pdf_id, extractor_version) IN (SELECT (pdf_id, max(extractor_version)) FROM sidecars GROUP BY pdf_id)),
        u AS (SELECT m.*, 1 AS rk, m.page AS cp, c.pos, c.text FROM m JOIN c ON c.pdf_id = m.pdf_id AND c.bp = m.page AND c.label = m.label UNION ALL SELECT m.*, 2, m.page - 1, c.pos, c.text FROM m JOIN c ON c.pdf_id = m.pdf_id AND c.bp = m.page - 1 AND c.label = m.label UNION ALL SELECT m.*, 3, m.page, z.pos, z.text FROM m JOIN z ON z.pdf_id = m.pdf_id AND z.bp = m.page),
        r AS (SELECT *, row_number() OVER (PARTITION BY pdf_id, label, page, idx ORDER BY rk) AS rn FROM u)
        SELECT pdf_id, label, page, CAST(idx AS INT) AS idx, cp AS context_page, CAST(pos AS INT) AS pos, md5(text) AS text, rk < 3 AS found FROM r WHERE rn = 1""",
    "solved_labels": r"""WITH RECURSIVE t AS (SELECT pdf_id, unnest(pages) AS p, generate_subscripts(pages, 1) - 1 AS page_index FROM extracted_docs),
        e AS (SELECT pdf_id, page_index, p.height AS height, list_concat(list_transform(coalesce(p.body_lines, []), lambda l: {'text': l.text, 'top': l.top, 'low': false}), list_transform(coalesce(p.note_lines, []), lambda l: {'text': l.text, 'top': l.top, 'low': true})) AS every FROM t),
        l AS (SELECT pdf_id, page_index, height, unnest(every) AS l, generate_subscripts(every, 1) - 1 AS line FROM e),
        cd AS (SELECT pdf_id, page_index, line, coalesce(l.top, 0) AS top, CAST(regexp_extract(l.text, '^\s*([0-9]{1,4})', 1) AS INT) AS label,
          greatest(0.1, 1.0 + CASE WHEN regexp_matches(l.text, '^\s*[0-9]{1,4}[\]).,:;-]') THEN 2.0 ELSE 0.0 END + CASE WHEN l.low THEN 1.25 ELSE -1.25 END + CASE WHEN regexp_matches(l.text, '(?i)\b(?:v\.|u\.s\.|f\.\d|s\. ct\.|id\.|supra|infra)') THEN 2.0 ELSE 1.5 END + CASE WHEN l.top >= 0.5 * height THEN 0.5 WHEN l.top < 0.2 * height THEN -1.0 ELSE 0.0 END) AS score
          FROM l WHERE regexp_matches(l.text, '^\s*[0-9]{1,4}[\]).,:;-]?\s+\S')),
        ls AS (SELECT pdf_id, list({'n': label, 'p': page_index, 't': top, 's': CAST(score AS DOUBLE), 'l': line} ORDER BY page_index, line) AS c FROM cd GROUP BY 1),
        dp AS (SELECT pdf_id, c, 0 AS k, CAST([] AS DOUBLE[]) AS tot, CAST([] AS BIGINT[]) AS par FROM ls
          UNION ALL SELECT pdf_id, c, k + 1, list_append(tot, -b.v), list_append(par, b.j) FROM (
            SELECT *, list_min(list_append(list_transform(range(1, k + 1), lambda j: {'v': -(tot[j] + c[k + 1].s - (CASE WHEN c[k + 1].n > c[j].n THEN
                CASE c[k + 1].n - c[j].n WHEN 1 THEN 0.0 WHEN 2 THEN 0.5 WHEN 3 THEN 1.5 WHEN 4 THEN 4.0 ELSE 4.0 + (c[k + 1].n - c[j].n - 5) * 2.0 END + CASE WHEN c[j].p = c[k + 1].p AND c[k + 1].t < c[j].t - 0.5 THEN 10.0 ELSE 0.0 END
                WHEN c[k + 1].n <= 2 AND c[j].p <> c[k + 1].p THEN 12.0 ELSE 1e12 END)), 'w': 1, 'j': j}), {'v': -(c[k + 1].s - 5.0 * greatest(0, c[k + 1].n - 1)), 'w': 0, 'j': 0})) AS b FROM dp WHERE k < len(c))),
        en AS (SELECT pdf_id, c, par, list_max(list_transform(range(1, len(c) + 1), lambda j: {'v': tot[j], 'n': c[j].n, 'j': -j})) AS top FROM dp WHERE k = len(c)),
        pt AS (SELECT pdf_id, c, par, -top.j AS k FROM en UNION ALL SELECT pdf_id, c, par, par[k] FROM pt WHERE par[k] > 0)
        SELECT pdf_id, c[k].n AS label, CAST(c[k].p AS INT) AS page_index, CAST(c[k].l AS INT) AS line FROM pt""",
    "label_scores": f"WITH RECURSIVE {_N}, {_SEG}, {_GOLD}, {_MS}, {_ORD}, x AS (SELECT q.*, same, {_PR} FROM q JOIN j USING (pdf_id)) SELECT pdf_id, tp, fp, fn, round(pr, 4) AS precision, round(rc, 4) AS recall, round(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END, 4) AS f1, same = 1 AS same_order FROM x",
    "failure_taxonomy": f"""WITH RECURSIVE {_N}, {_SEG}, {_GOLD}, {_MS}, {_ORD}, tw AS (SELECT pdf_id, max(k) AS most FROM (SELECT pdf_id, label, count(*) AS k FROM pred GROUP BY ALL) GROUP BY 1), x AS (SELECT q.*, same, most FROM q JOIN j USING (pdf_id) LEFT JOIN tw USING (pdf_id))
        SELECT pdf_id, 'missing_labels' AS failure FROM x WHERE fn > 0 UNION ALL SELECT pdf_id, 'extra_labels' FROM x WHERE fp > 0 UNION ALL SELECT pdf_id, 'repeated_labels' FROM x WHERE most > 1 UNION ALL SELECT pdf_id, 'order' FROM x WHERE fn = 0 AND fp = 0 AND same = 0""",
    "duplicate_groups": rf"""WITH RECURSIVE k AS (SELECT pdf_id, 'sha256' AS reason, lower(sha256) AS key FROM pdf_records WHERE coalesce(sha256, '') <> '' UNION ALL SELECT pdf_id, 'title_first_text', title_key || chr(1) || first_text_hash FROM pdf_records WHERE title_key IS NOT NULL AND first_text_hash IS NOT NULL
          UNION ALL SELECT pdf_id, 'versioned_name', journal_domain || chr(1) || regexp_replace({_STEM}, '-[0-9]+$', '') FROM pdf_records WHERE journal_domain IS NOT NULL),
        sh AS (SELECT reason, key FROM k GROUP BY ALL HAVING count(*) > 1), e AS (SELECT DISTINCT a.pdf_id AS a, b.pdf_id AS b FROM k a JOIN k b USING (reason, key) WHERE a.pdf_id <> b.pdf_id), r AS (SELECT a AS id, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id),
        g AS (SELECT id, min(root) AS root FROM r GROUP BY id), why AS (SELECT root, string_agg(DISTINCT reason, '|' ORDER BY reason) AS reasons FROM k JOIN sh USING (reason, key) JOIN g ON g.id = k.pdf_id GROUP BY 1),
        m AS (SELECT root, path, first_value(path) OVER (PARTITION BY root ORDER BY coalesce(mtime, 0) DESC, coalesce(size, 0) DESC, coalesce(page_count, 0) DESC, path) AS canonical_path, count(*) OVER (PARTITION BY root) AS group_size FROM pdf_records JOIN g ON g.id = pdf_id)
        SELECT path, canonical_path, reasons, group_size FROM m JOIN why USING (root)""",
    "domain_medians": "SELECT journal_domain, count(*) AS n, coalesce(median(CASE WHEN size > 0 THEN size END), 0) AS median_size, coalesce(median(CASE WHEN page_count > 0 THEN page_count END), 0) AS median_pages FROM pdf_records GROUP BY 1",
    "volume_suspects": r"""WITH m AS (SELECT journal_domain, coalesce(median(CASE WHEN size > 0 THEN size END), 0) AS ms, coalesce(median(CASE WHEN page_count > 0 THEN page_count END), 0) AS mp FROM pdf_records GROUP BY 1 HAVING count(*) > 1),
        w AS (SELECT pdf_id, array_to_string(list_filter([CASE WHEN regexp_matches(lower(regexp_replace(path, '^.*/', '')), '(?:full|complete|entire)[-_ ]?(?:issue|volume)|^vol[0-9]+[-_.]') THEN 'filename' END, CASE WHEN ms > 0 AND size > 5 * ms AND size > 10485760 THEN 'size' END, CASE WHEN page_count > 150 AND mp > 0 AND mp < 40 THEN 'pages' END], lambda x: x IS NOT NULL), '|') AS reasons FROM pdf_records JOIN m USING (journal_domain))
        SELECT * FROM w WHERE reasons <> ''""",
    "path_shards": "SELECT pdf_id, CAST(CAST('0x' || substr(sha1(path), 1, 16) AS UBIGINT) % 8 AS INT) AS shard FROM pdf_records",
    "first_files": "SELECT lower(sha256) AS sha, arg_min(path, pdf_id) AS path, count(*) AS files FROM pdf_records GROUP BY 1",
    "promoted_names": rf"""WITH s AS (SELECT pdf_id, journal_domain, {_STEM} AS stem, regexp_extract(path, '(\.[A-Za-z0-9]{{1,5}})$', 1) AS ext FROM pdf_records), n AS (SELECT *, row_number() OVER (PARTITION BY journal_domain, stem, ext ORDER BY pdf_id) AS n FROM s)
        SELECT pdf_id, stem || CASE WHEN n > 1 THEN '__v' || n ELSE '' END || ext AS name FROM n""",
    "registry_snapshot": f"""WITH k AS (SELECT *, regexp_replace(lower(coalesce(platform, '')), '[^a-z0-9]+', '', 'g') AS k FROM registry), f AS (SELECT host, journal_name, 'platform' AS field, {Q._PLATFORM} AS value FROM k UNION ALL SELECT host, journal_name, 'status', {Q._t('status')} FROM k UNION ALL SELECT host, journal_name, 'source', {Q._t('source')} FROM k UNION ALL SELECT host, journal_name, 'no_sitemap', CAST({Q._t('sitemap_file')} = '' AS VARCHAR) FROM k UNION ALL SELECT host, journal_name, 'total', '' FROM k)
        SELECT field, value, count(*) AS rows, count(DISTINCT host) AS hosts, count(DISTINCT journal_name) AS journals FROM f GROUP BY ALL""",
    "registry_groups": r"""WITH RECURSIVE r0 AS (SELECT seq, trim(regexp_replace(regexp_replace(replace(lower(strip_accents(journal_name)), '&', ' and '), '[^\p{L}\p{N}]+', ' ', 'g'), '^\s*the ', '')) AS name, nullif(trim(wlu_mainid), '') AS wlu FROM registry), x AS (SELECT * FROM r0 WHERE name <> ''),
        k AS (SELECT seq, 'n:' || name AS key FROM x UNION ALL SELECT seq, 'w:' || wlu FROM x WHERE wlu IS NOT NULL AND wlu <> 'n/a'), e AS (SELECT DISTINCT a.seq AS a, b.seq AS b FROM k a JOIN k b USING (key)), r AS (SELECT a AS id, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id)
        SELECT id AS seq, min(root) AS group_seq FROM r GROUP BY id""",
    "unique_hosts": f"WITH {_RI} SELECT host, min(journal) AS journal FROM ri GROUP BY 1 HAVING count(DISTINCT journal) = 1",
    "holdings_view": f"WITH {_HOLD} SELECT identity, record_id, host, journal, title, authors, year, coalesce(ctx[1], '') AS context FROM hh",
    "holdings_by_journal": f"WITH {_HOLD} SELECT journal, count(*) AS files, sum(CAST(title <> '' AS INT)) AS titled, min(nullif(year, '')) AS first_year, max(nullif(year, '')) AS last_year, count(DISTINCT host) AS hosts FROM hh GROUP BY 1",
    "site_status": f"""WITH {_RI}, g AS (SELECT host, count(DISTINCT journal) AS journals FROM ri GROUP BY 1), r AS (SELECT {Q._host('domain')} AS host, count(*) AS records, sum(CAST(coalesce(ok, false) AS INT)) AS ok FROM run_records GROUP BY 1),
        f AS (SELECT coalesce(list_filter(string_split(lower(path), '/'), lambda p: contains(p, '.') AND NOT p LIKE '%.pdf')[1], 'unknown') AS host, count(*) AS files FROM pdf_records GROUP BY 1)
        SELECT host, coalesce(journals, 0) AS journals, coalesce(records, 0) AS records, coalesce(ok, 0) AS ok, coalesce(files, 0) AS files FROM g FULL OUTER JOIN r USING (host) FULL OUTER JOIN f USING (host)""",
    "site_rank": f"""WITH r AS (SELECT {Q._host('domain')} AS host, count(*) AS records, sum(CAST(NOT coalesce(ok, false) AS INT)) AS failed, count(DISTINCT metadata.volume) AS volumes FROM run_records GROUP BY 1),
        s AS (SELECT host, round(0.5 * records / greatest(max(records) OVER (), 1) + 0.3 * failed / greatest(max(failed) OVER (), 1) + 0.2 * volumes / greatest(max(volumes) OVER (), 1), 6) AS score FROM r) SELECT CAST(row_number() OVER (ORDER BY score DESC, host) AS INT) AS rank, host, score FROM s""",
    "unrecorded_files": "SELECT lower(sha256) AS sha, min(pdf_id) AS first_id, count(*) AS files FROM pdf_records WHERE lower(sha256) NOT IN (SELECT lower(pdf_sha256) FROM holdings WHERE pdf_sha256 IS NOT NULL) GROUP BY 1",
    "corpus_report": """SELECT coalesce(nullif(trim(doc_type), ''), 'unknown') AS doc_type, count(*) AS rows, count(DISTINCT pdf_id) AS pdfs, sum(CAST(ordinality_status = 'valid' AS INT)) AS valid, sum(CAST(coalesce(note_count = 0, false) AS INT)) AS without_notes,
        round(quantile_cont(document_confidence, 0.5), 6) AS median_confidence, round(quantile_cont(document_confidence, 0.1), 6) AS low_confidence, round(quantile_cont(note_count, 0.9), 6) AS many_notes, sum(gap_count) AS gaps FROM doc_stats GROUP BY 1""",
    "failure_modes": """WITH s AS (SELECT *, row_number() OVER (PARTITION BY pdf_id ORDER BY evaluated_at DESC, note_count DESC) AS rn FROM doc_stats)
        SELECT CASE WHEN note_count = 0 THEN 'no_notes' WHEN ordinality_status = 'invalid' AND gap_count > 20 THEN 'many_gaps' WHEN ordinality_status = 'invalid' THEN 'some_gaps' WHEN document_confidence < 0.5 THEN 'low_confidence' WHEN missing_context_count > 5 THEN 'no_context' ELSE 'none' END AS mode, count(*) AS pdfs, sum(gap_count) AS gaps FROM s WHERE rn = 1 GROUP BY 1""",
    "platform_families": f"WITH k AS (SELECT platform_family AS platform, regexp_replace(lower(coalesce(platform_family, '')), '[^a-z0-9]+', '', 'g') AS k FROM doc_stats), x AS (SELECT {Q._PLATFORM} AS p, platform FROM k) SELECT p AS platform, count(*) AS rows, count(DISTINCT platform) AS spellings FROM x GROUP BY 1",
    "spread_files": """WITH r AS (SELECT journal_domain, pdf_id, row_number() OVER (PARTITION BY journal_domain ORDER BY mtime NULLS FIRST, pdf_id) - 1 AS i, count(*) OVER (PARTITION BY journal_domain) AS n FROM pdf_records)
        SELECT journal_domain, pdf_id, CAST(i AS INT) AS place FROM r WHERE i IN (0, floor(n / 4), floor(n / 2), floor(n * 3 / 4), n - 1)""",
}
