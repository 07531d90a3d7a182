"""Queries over markers of notes: lines that hold several, authors' signs, endnotes, scans, contents, gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import markers as M
from corpusloom.operators import notes as N
from corpusloom.plans import corpus_queries as C
from corpusloom.session import table


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "extracted_docs")


def _told(notes: DataFrame) -> DataFrame:
    return notes.select("pdf_id", "note_no", "label", "page_start", "page_end", F.md5("text").alias("text"))


def split_segments(spark: SparkSession, d: str) -> DataFrame:
    """Notes gathered from lines that are cut at the markers inside them."""
    return _told(N.segmented(M.split_lines(M.note_lines(_docs(spark, d)))))


def clean_segments(spark: SparkSession, d: str) -> DataFrame:
    """Notes gathered from lines below the rules of pages, without banners."""
    return _told(N.segmented(M.without_banners(M.note_lines(_docs(spark, d)))))


def author_notes(spark: SparkSession, d: str) -> DataFrame:
    """Notes marked by a sign."""
    return M.author_notes(M.note_lines(_docs(spark, d))).withColumn("text", F.md5("text"))


def endnote_starts(spark: SparkSession, d: str) -> DataFrame:
    """Where the notes at the end of documents begin."""
    return M.endnote_starts(_docs(spark, d))


def endnotes(spark: SparkSession, d: str) -> DataFrame:
    """Notes at the end of documents."""
    return _told(M.endnotes(_docs(spark, d)))


def text_notes(spark: SparkSession, d: str) -> DataFrame:
    """Notes below a heading in plain texts."""
    return _told(M.from_text(table(spark, d, "documents").select(F.col("doc_id").alias("pdf_id"), "text")))


def rejected_markers(spark: SparkSession, d: str) -> DataFrame:
    """Numbers at the start of note lines that are no labels, by reason."""
    return M.rejected(_docs(spark, d))


def contents_notes(spark: SparkSession, d: str) -> DataFrame:
    """Gathered notes of first pages that are entries of a list of contents."""
    s = N.segmented(M.note_lines(_docs(spark, d)))
    return s.where(M.contents_like(F.col("page_start"), F.col("text"))).select("pdf_id", "note_no", "label")


def contents_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose labels are page numbers of a list of contents."""
    docs = _docs(spark, d)
    return M.contents_documents(N.solved_labels(N.candidate_lists(docs)), docs)


def gap_fills(spark: SparkSession, d: str) -> DataFrame:
    """Missing labels of chains, from candidates left over; every fifth label of the chain is taken away first."""
    c = N.candidate_lists(_docs(spark, d))
    return M.gap_filled(N.solved_labels(c).where("label % 5 <> 0"), c)


def single_places(spark: SparkSession, d: str) -> DataFrame:
    """One place for every number that may be a label."""
    return M.one_per_label(N.candidate_lists(_docs(spark, d)).select("pdf_id", F.inline("c")).select("pdf_id", "label", "page_index", "line"))


def restored_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of sidecars, every fourth one cut to its last figure and restored."""
    n = N.notes_of(table(spark, d, "sidecars")).withColumn("number", F.when(F.col("idx") % 4 == 3, F.col("number") % 10).otherwise(F.col("number")))
    return M.restored_labels(n, ["pdf_id", "extractor_version"], ["idx"]).select("pdf_id", "extractor_version", "idx", "number", "restored")


def scan_notes(spark: SparkSession, d: str) -> DataFrame:
    """Notes of scanned pages, by their labels alone."""
    return M.scan_notes(_docs(spark, d)).withColumn("text", F.md5("text"))


def scan_dropped(spark: SparkSession, d: str) -> DataFrame:
    """Labels that scans do not show."""
    return M.dropped_labels(M.scan_notes(_docs(spark, d)))


QUERIES = {
    f.__name__: f
    for f in (
        split_segments, clean_segments, author_notes, endnote_starts, endnotes, text_notes, rejected_markers, contents_notes, contents_documents, gap_fills, single_places, restored_labels, scan_notes, scan_dropped,
    )
}

_V0 = C._V.replace("v AS (", "v0 AS (")
_B0 = _V0.replace("note_lines", "body_lines")
_TOLD = "SELECT pdf_id, note_no, label, page_start, page_end, md5(text) AS text FROM s"
_ST = rf"""np AS (SELECT pdf_id, len(pages) AS n_pages FROM extracted_docs WHERE len(pages) > 0), bl AS (SELECT v0.*, n_pages FROM v0 JOIN np USING (pdf_id) WHERE text <> ''),
  hd AS (SELECT pdf_id, min(page_index) AS start FROM bl WHERE regexp_matches(text, '{M.NOTES_HEADING}') AND (n_pages = 1 OR page_index + 1 >= greatest(2, ceil(n_pages * 0.6))) GROUP BY 1),
  la AS (SELECT *, CASE WHEN NOT regexp_matches(regexp_extract(text, '^([0-9]{{1,4}})[\]).,:;-]?\s+(\S.*)$', 2), '{N.FRAGMENT}') THEN TRY_CAST(nullif(regexp_extract(text, '^([0-9]{{1,4}})[\]).,:;-]?\s+\S', 1), '') AS INT) END AS n FROM bl WHERE n_pages >= 2 AND page_index >= n_pages - 2),
  lc AS (SELECT *, max(n) OVER (PARTITION BY pdf_id, page_index ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bf FROM la), le AS (SELECT *, n IS NOT NULL AND (bf IS NULL OR n > bf) AS high FROM lc),
  lf AS (SELECT *, sum(CAST(high AS INT)) OVER (PARTITION BY pdf_id, page_index ORDER BY line ROWS UNBOUNDED PRECEDING) AS step FROM le),
  dn AS (SELECT pdf_id, min(page_index) AS start FROM (SELECT pdf_id, page_index FROM lf GROUP BY ALL HAVING count(*) >= 5 AND count(n) >= 6 AND count(n) >= 0.3 * count(*) AND sum(CAST(high AND step <= 3 AND n = step AS INT)) = 3) GROUP BY 1),
  st AS (SELECT * FROM hd UNION ALL SELECT * FROM dn WHERE pdf_id NOT IN (SELECT pdf_id FROM hd))"""
_WORDS = r"len(string_split_regex(trim({}), '\s+'))"
_CD = C.SQL["solved_labels"]
_SOLVED = _CD[: _CD.rindex("SELECT pdf_id, c[k].n AS label")] + ", sv AS (SELECT pdf_id, c[k].n AS label, c[k].p AS page_index, c[k].l AS line FROM pt)"
_SCAN = r"""t AS (SELECT pdf_id, unnest(pages) AS p, generate_subscripts(pages, 1) - 1 AS page_index FROM extracted_docs),
  e AS (SELECT pdf_id, page_index, p.page_number AS page, list_concat(list_transform(coalesce(p.body_lines, []), lambda l: l.text), list_transform(coalesce(p.note_lines, []), lambda l: l.text)) AS every FROM t WHERE coalesce(p.source, 'text') <> 'text'),
  x0 AS (SELECT pdf_id, page_index, page, generate_subscripts(every, 1) - 1 AS pos, trim(regexp_replace(unnest(every), '[\s\x{00A0}]+', ' ', 'g')) AS text FROM e),
  x1 AS (SELECT *, CASE WHEN NOT regexp_matches(text, '\.{4,}\s*[0-9]{1,4}\s*$') THEN TRY_CAST(nullif(regexp_extract(text, '^([0-9]{1,4})[.)]?\s+\S', 1), '') AS INT) END AS label FROM x0 WHERE text <> ''),
  x2 AS (SELECT *, CAST(lead(label) OVER (PARTITION BY pdf_id, page_index ORDER BY pos) > label AS INT) AS rise FROM x1 WHERE label IS NOT NULL),
  x3 AS (SELECT *, count(rise) OVER w AS steps, coalesce(sum(rise) OVER w, 0) AS good FROM x2 WINDOW w AS (PARTITION BY pdf_id, page_index ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
  x4 AS (SELECT pdf_id, page_index, min(pos) AS start FROM x3 WHERE steps = 0 OR good / greatest(steps, 1) >= 0.75 GROUP BY ALL),
  v AS (SELECT pdf_id, page_index, pos AS line, page, text FROM x1 JOIN x4 USING (pdf_id, page_index) WHERE pos >= start)"""
_BEST = "sn AS (SELECT pdf_id, label, arg_max({'p': page_start, 't': text}, (length(text), -note_no)) AS b FROM s GROUP BY 1, 2)"

SQL = {
    "split_segments": rf"""WITH RECURSIVE {_V0}, v1 AS (SELECT *, string_split(regexp_replace(text, '{M.INNER}', '\1' || chr(57344) || '\2', 'g'), chr(57344)) AS ps, CASE WHEN NOT regexp_matches(regexp_extract(text, '^([0-9]{{1,4}})[\]).,:;-]?\s+(\S.*)$', 2), '{N.FRAGMENT}') THEN TRY_CAST(nullif(regexp_extract(text, '^([0-9]{{1,4}})[\]).,:;-]?\s+\S', 1), '') AS INT) END AS n FROM v0 WHERE text <> ''),
        v2 AS (SELECT pdf_id, page_index, line, page, n, regexp_replace(unnest(ps), '{M.GLUED}', '\1\2 \3') AS t, generate_subscripts(ps, 1) - 1 AS part FROM v1),
        v3 AS (SELECT *, last_value(CASE WHEN part = 0 THEN n END IGNORE NULLS) OVER (PARTITION BY pdf_id ORDER BY page_index, line, part ROWS UNBOUNDED PRECEDING) AS lst, TRY_CAST(nullif(regexp_extract(t, '^([0-9]{{1,4}})', 1), '') AS INT) AS own FROM v2),
        v4 AS (SELECT *, sum(CAST(coalesce(part = 0 OR own BETWEEN lst + 1 AND lst + 3, false) AS INT)) OVER (PARTITION BY pdf_id, page_index, line ORDER BY part ROWS UNBOUNDED PRECEDING) AS piece FROM v3),
        v AS (SELECT pdf_id, page_index, line * 1048576 + piece AS line, page, string_agg(t, ' ' ORDER BY part) AS text FROM v4 GROUP BY pdf_id, page_index, line, page, piece), {C._CHAIN} {_TOLD}""",
    "clean_segments": rf"""WITH RECURSIVE {_V0}, v1 AS (SELECT *, min(CASE WHEN regexp_matches(text, '{M.RULE}') THEN line END) OVER (PARTITION BY pdf_id, page_index) AS rl FROM v0 WHERE text <> ''),
        v AS (SELECT pdf_id, page_index, line, page, text FROM v1 WHERE (rl IS NULL OR line > rl) AND NOT regexp_matches(text, '{M.BANNER}') AND NOT regexp_matches(text, '{M.RULE}')), {C._CHAIN} {_TOLD}""",
    "author_notes": rf"""WITH {_V0}, a AS (SELECT *, regexp_matches(text, '{M.AUTHOR}') AS signed, regexp_matches(text, '{M.AUTHOR}') OR regexp_matches(text, '{M.MARKER}') AS opens FROM v0 WHERE text <> ''),
        b AS (SELECT *, sum(CAST(opens AS INT)) OVER (PARTITION BY pdf_id ORDER BY page_index, line ROWS UNBOUNDED PRECEDING) AS note FROM a)
        SELECT pdf_id, max(CASE WHEN signed THEN regexp_extract(text, '{M.AUTHOR}', 1) END) AS marker, min(page) AS page, md5(string_agg(CASE WHEN signed THEN regexp_extract(text, '{M.AUTHOR}', 2) ELSE text END, ' ' ORDER BY page_index, line)) AS text FROM b WHERE note > 0 GROUP BY pdf_id, note HAVING max(CAST(signed AS INT)) = 1""",
    "endnote_starts": f"WITH {_B0}, {_ST} SELECT pdf_id, CAST(start AS INT) AS start FROM st",
    "endnotes": f"WITH RECURSIVE {_B0}, {_ST}, v AS (SELECT v0.* FROM v0 JOIN st USING (pdf_id) WHERE page_index >= start AND NOT regexp_matches(text, '{M.NOTES_HEADING}')), {C._CHAIN} {_TOLD}",
    "text_notes": rf"""WITH RECURSIVE q0 AS (SELECT doc_id AS pdf_id, string_split(coalesce(text, ''), chr(10)) AS ps FROM documents), q1 AS (SELECT pdf_id, 0 AS page_index, generate_subscripts(ps, 1) - 1 AS line, 1 AS page, trim(regexp_replace(unnest(ps), '[\s\x{{00A0}}]+', ' ', 'g')) AS text FROM q0),
        q2 AS (SELECT *, min(CASE WHEN regexp_matches(text, '{M.NOTES_HEADING}') THEN line END) OVER (PARTITION BY pdf_id) AS hd FROM q1), v AS (SELECT pdf_id, page_index, line, page, text FROM q2 WHERE line > hd), {C._CHAIN} {_TOLD}""",
    "rejected_markers": rf"""WITH {_V0}, a AS (SELECT v0.*, CAST(regexp_extract(text, '^([0-9]{{1,4}})[\]).,:;-]?\s+(\S.*)$', 1) AS INT) AS label, regexp_extract(text, '^([0-9]{{1,4}})[\]).,:;-]?\s+(\S.*)$', 2) AS r, least({M.MOST_LABELS}, len(pages) * {M.LABELS_A_PAGE}) AS most FROM v0 JOIN extracted_docs USING (pdf_id) WHERE regexp_matches(text, '^([0-9]{{1,4}})[\]).,:;-]?\s+(\S.*)$')),
        b AS (SELECT *, regexp_matches(r, '{M.CITES}') AS ct FROM a),
        c AS (SELECT pdf_id, page_index, line, label, CASE WHEN regexp_matches(r, '{M.CONTENTS}') OR (regexp_matches(r, '{M.LEADERS}') AND regexp_matches(r, '{M.LAST_PAGE}') AND NOT ct) THEN 'contents' WHEN label > most THEN 'too_great' WHEN label = 0 THEN 'zero' WHEN regexp_matches(r, '^[0-9\s.,;:()\[\]–—-]+$') THEN 'figures_only'
          WHEN regexp_matches(r, '{N.FRAGMENT}') THEN 'rest_of_a_citation' WHEN length(r) < 3 AND NOT ct THEN 'too_short' WHEN {_WORDS.format('r')} <= 2 AND regexp_matches(r, '^[a-z]') AND NOT regexp_matches(r, '[.;]$') THEN 'rest_of_a_sentence' END AS reason FROM b)
        SELECT pdf_id, CAST(page_index AS INT) AS page_index, CAST(line AS INT) AS line, label, reason FROM c WHERE reason IS NOT NULL""",
    "contents_notes": rf"""WITH RECURSIVE {C._SEG} SELECT pdf_id, note_no, label FROM s WHERE page_start <= 3 AND (regexp_matches(text, '{M.CONTENTS}') OR (regexp_matches(text, '{M.LEADERS}') AND {_WORDS.format('text')} <= 120 AND regexp_matches(text, '{M.LAST_PAGE}')) OR (regexp_matches(text, '{M.LAST_PAGE}') AND {_WORDS.format('text')} <= 14 AND NOT regexp_matches(text, '{M.CITES}')))""",
    "contents_documents": f"""{_SOLVED}, bp AS (SELECT pdf_id, page_index, count(*) AS n, min(label) AS low FROM sv GROUP BY ALL), br AS (SELECT *, row_number() OVER (PARTITION BY pdf_id ORDER BY n DESC, page_index) AS rk FROM bp)
        SELECT pdf_id FROM br JOIN extracted_docs USING (pdf_id) GROUP BY pdf_id HAVING sum(n) >= 4 AND any_value(len(pages)) >= 4 AND min(low) <> 1 AND sum(CASE WHEN rk <= 2 THEN n END) >= 0.8 * sum(n)""",
    "gap_fills": f"""{_SOLVED}, ch AS (SELECT * FROM sv WHERE label % 5 <> 0), ld AS (SELECT *, lead(label) OVER w AS nx, lead(page_index) OVER w AS np FROM ch WINDOW w AS (PARTITION BY pdf_id ORDER BY page_index, line)), gp AS (SELECT pdf_id, page_index AS lo, np AS hi, unnest(range(label + 1, nx)) AS label FROM ld WHERE nx > label + 1),
        ht AS (SELECT cd.pdf_id, cd.label, cd.page_index, cd.line, score FROM cd ANTI JOIN ch ON cd.pdf_id = ch.pdf_id AND cd.label = ch.label AND cd.page_index = ch.page_index AND cd.line = ch.line), hg AS (SELECT ht.* FROM ht JOIN gp ON ht.pdf_id = gp.pdf_id AND ht.label = gp.label AND ht.page_index BETWEEN lo - 2 AND hi + 2),
        hb AS (SELECT *, row_number() OVER (PARTITION BY pdf_id, label ORDER BY score DESC, page_index, line) AS rk FROM hg) SELECT pdf_id, label, CAST(page_index AS INT) AS page_index, CAST(line AS INT) AS line FROM hb WHERE rk = 1""",
    "single_places": f"""{_SOLVED}, fp AS (SELECT pdf_id, label, min(page_index) AS f FROM cd GROUP BY ALL), ar AS (SELECT *, lag(f) OVER w AS bf, lead(f) OVER w AS af FROM fp WINDOW w AS (PARTITION BY pdf_id ORDER BY label)),
        rk AS (SELECT cd.pdf_id, label, page_index, line, row_number() OVER (PARTITION BY cd.pdf_id, label ORDER BY coalesce(abs(page_index - bf), 0) + coalesce(abs(page_index - af), 0), page_index, line) AS r FROM cd JOIN ar USING (pdf_id, label)) SELECT pdf_id, label, CAST(page_index AS INT) AS page_index, CAST(line AS INT) AS line FROM rk WHERE r = 1""",
    "restored_labels": f"""WITH {C._N}, a AS (SELECT pdf_id, extractor_version, idx, CASE WHEN idx % 4 = 3 THEN number % 10 ELSE number END AS number FROM n),
        b AS (SELECT *, last_value(CASE WHEN number >= 10 THEN number END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lo, first_value(CASE WHEN number >= 10 THEN number END IGNORE NULLS) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS hi FROM a WINDOW w AS (PARTITION BY pdf_id, extractor_version ORDER BY idx)),
        c AS (SELECT *, lo + 1 + (((number - lo - 1) % 10) + 10) % 10 AS st FROM b)
        SELECT pdf_id, extractor_version, CAST(idx AS INT) AS idx, number, CASE WHEN number BETWEEN 0 AND 9 AND hi > lo AND st < hi AND st + 10 >= hi THEN st ELSE number END AS restored FROM c""",
    "scan_notes": f"WITH RECURSIVE {_SCAN}, {C._CHAIN}, {_BEST} SELECT pdf_id, label, b.p AS page_start, md5(b.t) AS text FROM sn",
    "scan_dropped": f"WITH RECURSIVE {_SCAN}, {C._CHAIN}, {_BEST}, tp AS (SELECT pdf_id, unnest(range(1, max(label) + 1)) AS label FROM sn GROUP BY 1 HAVING max(label) >= 1) SELECT pdf_id, CAST(label AS INT) AS label FROM tp ANTI JOIN sn ON sn.pdf_id = tp.pdf_id AND sn.label = tp.label",
}
