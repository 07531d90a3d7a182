import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import scan_repair as S

LINE = "struct<text: string, page_number: int, top: double, bottom: double, font_size: double, source: string>"
DOCS = f"pdf_id bigint, pages array<struct<page_number: int, source: string, body_lines: array<{LINE}>, note_lines: array<{LINE}>>>, place string"
NOTES = "pdf_id bigint, notes array<struct<ordinal: int, text: string, page_start: int, segments: array<struct<page: int, text: string>>, features: struct<source: string>>>, what string"
TEXT = [
    "The modern court found that the covenant was clear and the light of the statute was",
    "enough for the tribunal to decide the appeal without a long hearing on the procedure",
    "of the regulation that the legislature had passed in the light of the long-term plan",
]


def page(n, body, note=(), source="text"):
    line = lambda t: (t, n, 0.0, 1.0, None, source)
    return (n, source, [line(t) for t in body], [line(t) for t in note])


@pytest.fixture(scope="module")
def parts(spark):
    header = lambda n: f"{n} CORMOOR LAW REVIEW [Vol. 36:1]"
    other = lambda n: f"{n}   Cormoor Law Review"
    notes = ["1 See the statute of the tribunal on the procedure.", "tribunal on the procedure.", "such a long-term plan of the court."]
    plain = [(i, [page(n, [(header, other)[i % 2](n), *TEXT, TEXT[i % 3], f"{n}"], [notes[i % 3]]) for n in (5, 6, 7)], "x") for i in range(12)]
    scan = (50, [
        page(8, [header(8), "The court found tbe covenant in the 1ight of the stat-", "8."], source="ocr"),
        page(9, [header(9), "ute and of the long-", "term plan for the tri-", "Page 9 of 9"], source="ocr"),
        page(10, ["bunal.", None, "", "II.", "— 10 —"], ["2 The regula­", "tion of the hearing"], source="ocr"),
        None, page(None, ["no number here"], source="ocr"),
    ], "x")
    docs = spark.createDataFrame([*plain, scan, (51, None, "x")], DOCS)
    notes = spark.createDataFrame([
        (50, [(3, "See the proce- dure of the 11 Cormoor Law Review long- term plan", 10, [(10, "See the proce- dure of the p. 10"), (11, "11   Cormoor Law Review long- term plan")], ("text",)), (4, "tbe statute", 10, [], ("ocr",)), (None, "x", None, None, None)], "x"),
        (50, [(4, "tbe statute", 10, [], ("ocr",))], "x"), (52, None, "x"),
    ], NOTES)
    return docs, notes, S.find(docs, notes)


def test_found(parts):
    got = {tuple(r) for r in S.found(parts[2]).where("pdf_id = 50").collect()}
    assert got == {
        (50, "body", 8, 0, "header"), (50, "body", 8, 1, "hyphen"), (50, "body", 8, 1, "misread"), (50, "body", 8, 2, "page_number"),
        (50, "body", 9, 0, "header"), (50, "body", 9, 2, "hyphen"), (50, "body", 9, 3, "page_number"), (50, "body", 10, 4, "page_number"),
        (50, "note", 10, 0, "hyphen"), (50, "sidecar", 10, 3, "header"), (50, "sidecar", 10, 3, "page_number"), (50, "sidecar", 10, 3, "hyphen"), (50, "sidecar", 10, 4, "misread"),
    }
    clean = S.found(parts[2]).where("pdf_id < 50")
    assert {r.kind for r in clean.collect()} == {"header", "page_number"} and clean.count() == 12 * 3 * 2


def test_text(parts):
    docs, notes, p = parts
    rows = S.repaired_lines(docs, p).where("pdf_id = 50 and place = 'body'").orderBy("paragraph").collect()
    text = " ".join(r.text for r in rows)
    assert "The court found the covenant in the light of the statute and of the long-term plan for the tribunal." in text and "LAW REVIEW" not in text
    assert [r.text for r in S.repaired_lines(docs, p).where("pdf_id = 50 and place = 'note'").collect()] == ["2 The regulation of the hearing"]
    note = {r.paragraph: r.text for r in S.repaired_notes(notes, p).collect()}
    assert note[3] == "See the procedure of the long-term plan" and note[4] == "the statute"


def test_empty(spark):
    docs, notes = spark.createDataFrame([], DOCS), spark.createDataFrame([], NOTES)
    p = S.find(docs, notes)
    assert S.found(p).count() == 0 and S.repaired_lines(docs, p).count() == 0 and S.repaired_notes(notes, p).count() == 0


def test_page_numbers():
    yes = [("12", 12), ("[12]", 12), ("- 12 -", 12), ("· 12 ·", 12), ("p. 12", 12), ("Page 12 of 40", 12), ("1 2", 12), ("l2.", 12), ("xii", 12), ("7O8", 708), ("l", 1), ("ll4", 114)]
    no = [("13", 12), ("(12)", 12), ("XII.", 12), ("12 Law Review", 12), ("", 12), ("12", None), ("II.", 2), ("I.", 1), ("O", 0)]
    assert all(S.is_page_number(*x) for x in yes) and not any(S.is_page_number(*x) for x in no)


def test_headers_of_notes():
    """The chains tell headers of the kinds they have counted, whatever their words, from text that goes on."""
    head, tail = np.zeros((S.CLASSES, S.CLASSES)), np.zeros((S.CLASSES, S.CLASSES))

    def count(table, text, n):
        path = [S.FROM, *S.word_classes(S.unspaced(text).split(), n), S.TO]
        np.add.at(table, (path[:-1], path[1:]), 10)

    for line in ("211  Liszerizand / Concurrent Negligence of Law", "1984] TOWARD A THEORY OF STATUTE (VISZIBEVAND) 211", "Belcairn Law Review / Vol. 59 (1977) 211", "211   B E L C A I R N   L A W   R E V I E W", "Fenmilawill: What the Article Owes 211"):
        count(head, line, 211)
    for line in ("trespass within the guard.", "Theory of the trespass.", "Rev. 1108, 1467 (1997).", "2016).", "Cir. 2020) (holding that the plan was long)", "Legislature, 54 Quil. L. Rev. 646, 343 (1963)."):
        count(tail, line, 211)
    model = S.HeaderModel(head, tail)
    cut = lambda t, n: t[model.length(t, n) :].strip()
    assert cut("416  Galselafoft / What the Defendant Owes the Chapter urrent permit", 416) == "urrent permit"
    assert cut("1973] WHAT THE DEFENDANT OWES THE CHAPTER (GALSELAFOFT) 415 Theory of", 415) == "Theory of"
    assert cut("Holcairn Law Review / Vol. 59 (1977) 270 its nurse", 270) == "its nurse"
    assert cut("3 9 2     B E L C A I R N     L A W     R E V I E W such harm", 392) == "such harm"
    assert cut("9 Corg. L. Rev. 1590, 1230 (1951).", 9) == "9 Corg. L. Rev. 1590, 1230 (1951)." and cut("the 12 rules", 12) == "the 12 rules"
    assert S.HeaderModel(head * 0, tail).length("211   Belcairn Law Review", 211) == 0 and model.length("", 3) == 0 and model.length("x", None) == 0


def test_skeleton_is_a_homomorphism(spark):
    pairs = [("modern", "modem"), ("clear", "dear"), ("with", "vvith"), ("unit", "iiiiit"), ("light", "1ight"), ("certified", "cernfied"), ("insofar", "iiisofar"), ("discretion", "cliscre†i0n"), ("the", "tbe"), ("final", "ﬁnal")]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert df.where(S.skeleton(F.col("a")) != S.skeleton(F.col("b"))).count() == 0
    assert df.where(S.skeleton(F.col("a")) == S.skeleton(F.lit("court"))).count() == 0


def test_viterbi_equals_brute_force():
    import itertools

    rng = np.random.default_rng(4)
    model = S.LineModel(rng.integers(0, 50, (5, 512)).astype(float), rng.integers(0, 9, (6, 4)).astype(float))
    bits, sizes = rng.integers(0, 512, 14), [5, 0, 3, 6]
    got, at = model.label(bits, sizes), 0
    for n in sizes:
        b = bits[at : at + n]
        score = lambda s: model.start[int(b[0] & S.NOTE > 0)][s[0]] + sum(model.emit[x, y] for x, y in zip(s, b)) + sum(model.step[x, y] for x, y in zip(s, s[1:]))  # noqa: B023,E731
        if n:
            assert np.isclose(score(got[at : at + n]), max(map(score, itertools.product(range(4), repeat=n))))
        at += n


def test_headers_that_are_not_the_first_line(spark):
    header = lambda n: f"{n} CORMOOR LAW REVIEW [Vol. 36:1]"
    plain = [(i, [page(n, [header(n), *TEXT, TEXT[i % 3], f"{n}"]) for n in (5, 6, 7)], "x") for i in range(12)]
    moved = (60, [page(8, ["received in the library of the court", header(8), *TEXT]), page(9, ["9", header(9), *TEXT]), page(10, [*TEXT, "CORMOOR LAW REVIEW 10"]), page(11, [*TEXT, "1 1  C O R M O O R  L A W  R E V I E W", "11"])], "x")
    parts = S.find(spark.createDataFrame([*plain, moved], DOCS), spark.createDataFrame([], NOTES))
    got = {(r.page_no, r.pos, r.kind) for r in S.found(parts).where("pdf_id = 60").collect()}
    assert got == {(8, 1, "header"), (9, 0, "page_number"), (9, 1, "header"), (10, 3, "header"), (11, 3, "header"), (11, 4, "page_number")}
    assert S.found(parts).where("pdf_id < 60").count() == 12 * 3 * 2


def test_the_model_decides(spark):
    """Headers that are no seeds, since nothing like them stands on the pages around, are the model's; so are lines that only recur."""
    plain = [(i, [page(n, [f"{n} CORMOOR LAW REVIEW [Vol. 36:1]", *TEXT, TEXT[i % 3], f"{n}"]) for n in (5, 6, 7)], "x") for i in range(12)]
    lone = (70, [page(8, ["Halvemond: Essays On Leases 8", *TEXT]), page(9, ["1984] ANOTHER TITLE (HALVEMOND) 9", *TEXT])], "x")
    parts = S.find(spark.createDataFrame([*plain, lone], DOCS), spark.createDataFrame([], NOTES))
    assert {(r.page_no, r.pos, r.kind) for r in S.found(parts).where("pdf_id = 70").collect()} == {(8, 0, "header"), (9, 0, "header")}
    lines = ["Halvemond: Essays On Leases 8", *TEXT]
    bits = S.line_features(lines, [4], [8], np.full(4, np.nan), False)
    assert S.seed_labels(bits).tolist() == [S.OPEN, S.BODY, S.BODY, S.BODY]


def test_the_rest_of_a_word_far_below(spark):
    """Lines put between the halves of a word, however many, do not hide its rest on the next page."""
    plain = [(i, [page(n, [*TEXT]) for n in (5, 6, 7)], "x") for i in range(12)]
    between = [f"Share this page number {w} with the friends of it" for w in "abcdefghijklmnopqrst"]
    far = (80, [page(1, [TEXT[0], "in the light of the legis-", *between]), page(2, ["lature had passed"])], "x")
    parts = S.find(spark.createDataFrame([*plain, far], DOCS), spark.createDataFrame([], NOTES))
    assert {(r.page_no, r.pos, r.kind) for r in S.found(parts).where("pdf_id = 80").collect()} == {(1, 1, "hyphen")}
    broken = parts["broken"].where("pdf_id = 80").collect()
    assert [(r.next, r.next_page, r.meant) for r in broken] == [("lature", 2, "legislature")]
