from pyspark.sql import functions as F

from corpusloom.operators import markers as M
from corpusloom.operators import notes as N

LINE = "struct<text: string, top: double>"
DOCS = f"pdf_id bigint, pages array<struct<page_number: int, height: double, source: string, body_lines: array<{LINE}>, note_lines: array<{LINE}>>>, text string"
LINES = "pdf_id bigint, page_index int, line int, page int, text string"


def page(n, body=(), note=(), source="text"):
    return (n, 800.0, source, [(t, 700.0) for t in body], [(t, 700.0) for t in note])


def docs(spark, *pages):
    return spark.createDataFrame([(i, list(p), "x") for i, p in enumerate(pages, 1)], DOCS)


def got(df, *order):
    return sorted(tuple(r) for r in (df.select(*order) if order else df).collect())


def test_lines_that_hold_several_notes(spark):
    rows = [(1, 0, 0, 1, "1 See the services.). 2See next case. 3 Id. at 7."), (1, 0, 1, 1, "44 Tarn. L. Rev. 2 (1990). 51 The number of a reporter"), (1, 0, 2, 1, "4 Last."), (1, 0, 3, 1, None), (1, 0, 4, 1, "")]
    s = M.split_lines(spark.createDataFrame(rows, LINES))
    assert [r.text for r in s.orderBy("page_index", "line").collect()] == ["1 See the services.).", "2 See next case.", "3 Id. at 7.", "44 Tarn. L. Rev. 2 (1990). 51 The number of a reporter", "4 Last."]
    assert [r.label for r in N.segmented(s).orderBy("note_no").collect()] == [1, 2, 3, 4]
    assert M.split_lines(s.limit(0)).count() == 0


def test_banners_and_rules(spark):
    rows = [(1, 0, i, 1, t) for i, t in enumerate(["1 above the rule", "______", "NOTES", "1 One.", "Downloaded from the repository", "---"])] + [(1, 1, 0, 2, "2 Two.")]
    assert got(M.without_banners(spark.createDataFrame(rows, LINES)), "text") == [("1 One.",), ("2 Two.",)]


def test_author_notes(spark):
    rows = [(1, 0, i, 1, t) for i, t in enumerate(["stray", "* Professor of Law.", "Thanks to all.", "† J.D. candidate.", "1 A note", "goes on"])]
    assert got(M.author_notes(spark.createDataFrame(rows, LINES))) == [(1, "*", 1, "Professor of Law. Thanks to all."), (1, "†", 1, "J.D. candidate.")]


def test_endnotes(spark):
    early = [page(1, ["Introduction"]), page(2, ["NOTES", "This is a section heading in body text."]), page(3, ["More."]), page(4, ["Conclusion."])]
    late = [page(1, ["Introduction"]), page(2, ["Text"]), page(3, ["More"]), page(4, ["NOTES", "1 First", "goes on.", "2 Second."])]
    dense = [page(1, ["Text"]), page(2, ["Text"]), page(3, ["end of text", *[f"{i} Note number {i}." for i in range(1, 8)]])]
    citations = [page(1, ["Text"]), page(2, [f"{i} U.S. reports of that year" for i in range(301, 309)])]
    df = docs(spark, early, late, dense, citations, [page(1, ["Notes", "1 Only page."])], [])
    assert got(M.endnote_starts(df)) == [(2, 3), (3, 2), (5, 0)]
    assert got(M.endnotes(df).where("pdf_id <> 3"), "pdf_id", "label", "text") == [(2, 1, "First goes on."), (2, 2, "Second."), (5, 1, "Only page.")]
    assert M.endnotes(df).where("pdf_id = 3").count() == 7
    texts = spark.createDataFrame([(1, "Body 1 of it\nNotes\n1 One\nmore\n2 Two"), (2, "1 no heading"), (3, None)], "pdf_id bigint, text string")
    assert got(M.from_text(texts), "pdf_id", "label", "text") == [(1, 1, "One more"), (1, 2, "Two")]


def test_rejections(spark):
    rows = [(49, "See infra Part III.", None), (12, "Smith v. Jones, 1 U.S. 1 (2020).", None), (5, "Understanding Agency Deference ............ 77", "contents"), (2000, "See id.", "too_great"), (3, "12, 14.", "figures_only"), (0, "Id.", "zero"), (9, "at 7 of it", "rest_of_a_citation"), (4, "x", "too_short"), (8, "of it", "rest_of_a_sentence"), (7, "Id.", None)]
    df = spark.createDataFrame(rows, "label int, text string, want string")
    out = df.select("want", M.rejection(F.col("label"), F.col("text"), F.lit(1500)).alias("got")).collect()
    assert [r.got for r in out] == [r.want for r in out]
    c = spark.createDataFrame([(1, "Introduction .... 5"), (1, "Background 12"), (9, "Introduction .... 5"), (2, "See Smith, at 5"), (None, "x 5")], "page int, text string")
    assert [r[0] for r in c.select(M.contents_like(F.col("page"), F.col("text"))).collect()] == [True, True, False, False, False]


def test_contents_documents(spark):
    solved = [(1, l, 0) for l in (5, 19, 40, 77)] + [(2, l, 0) for l in (1, 2, 3, 4)] + [(3, l, l) for l in (5, 6, 7, 8)]
    df = docs(spark, *[[page(n) for n in range(6)]] * 3)
    assert got(M.contents_documents(spark.createDataFrame(solved, "pdf_id bigint, label int, page_index int"), df)) == [(1,)]


def test_gaps(spark):
    solved = spark.createDataFrame([(1, 1, 0, 0), (1, 4, 2, 0)], "pdf_id bigint, label int, page_index int, line int")
    cands = spark.createDataFrame([(1, [(0, 0, 1.0, 1, 5.0), (1, 3, 1.0, 2, 1.0), (1, 7, 1.0, 2, 3.0), (9, 1, 1.0, 3, 9.0), (2, 0, 1.0, 4, 5.0)])], f"pdf_id bigint, c {N.CANDIDATES}")
    assert got(M.gap_filled(solved, cands)) == [(1, 2, 1, 7)]
    places = spark.createDataFrame([(1, 1, 0, 0), (1, 2, 8, 0), (1, 2, 1, 5), (1, 2, 1, 4), (1, 3, 1, 9)], "pdf_id bigint, label int, page_index int, line int")
    assert got(M.one_per_label(places)) == [(1, 1, 0, 0), (1, 2, 1, 4), (1, 3, 1, 9)]
    n = spark.createDataFrame([(1, i, v) for i, v in enumerate([8, 19, 0, 21, 2, 35, 6, None])], "g int, i int, number int")
    assert [r.restored for r in M.restored_labels(n, ["g"], ["i"]).orderBy("i").collect()] == [8, 19, 20, 21, 2, 35, 6, None]


def test_scans(spark):
    """Blocks of notes are found by rising labels, lists of contents give none, and dropped labels are told."""
    contents = page(1, ["TABLE OF CONTENTS", "Introduction ............ 1", "I. Background ............ 5"], source="ocr")
    block = page(2, ["The statute is ambiguous.1 Courts have long deferred.2", "1 Chevron v. NRDC, 467 U.S. 837 (1984).", "2 See id. at 842-43.", "3 Loper v. Raimondo, 603 U.S. 369 (2024)."], source="ocr")
    prose = page(3, ["The agency issued new guidance.4 It then revised the rule.5"], source="olmocr")
    last = page(4, ["Petitioners challenged the rule.6", "6 See 5 U.S.C. § 706.", "7 Motor v. State Farm, 463 U.S. 29 (1983)."], source="ocr")
    df = docs(spark, [contents, block, prose, last], [page(1, ["1 printed"])])
    found = M.scan_notes(df)
    assert got(found, "pdf_id", "label", "page_start") == [(1, 1, 2), (1, 2, 2), (1, 3, 2), (1, 6, 4), (1, 7, 4)]
    assert got(M.dropped_labels(found)) == [(1, 4), (1, 5)]
