from corpusloom.llm import site_lines as S

LINE = "struct<text: string, page_number: int, top: double, bottom: double, font_size: double, source: string>"
SCHEMA = f"pdf_id bigint, pdf_path string, pages array<struct<page_number: int, body_lines: array<{LINE}>, note_lines: array<{LINE}>>>, site string, k1 int"
NOTE = "Download this article from the archive"


def doc(i, site, *body, note=()):
    line = lambda t: (t, 1, 0.0, 1.0, None, "text")
    return (i, f"/corpus/pdfs/{site}/{i}.pdf" if site else None, [(1, [line(t) for t in body], [line(t) for t in note]), (2, None, None), None], "x", 0)


def test_repeated_lines(spark):
    docs = [doc(i, "a.test", f"unique sentence number {chr(97 + i)}{chr(98 + i)} of this document", NOTE if i % 2 else NOTE.upper() + "!!", None, "") for i in range(8)]
    docs += [doc(20 + i, "b.test", f"another sentence {chr(97 + i) * 5} in a different place", note=(NOTE,) if i == 0 else ()) for i in range(12)]
    docs += [doc(50, None, NOTE), doc(51, None, NOTE), doc(52, None, NOTE), (53, "/corpus/pdfs/a.test/53.pdf", None, "x", 0), docs[0]]
    df = spark.createDataFrame(docs, SCHEMA)
    excess = S.repeated(df)
    assert [(r.site, r.df, r.n_docs, r.significant) for r in excess.collect()] == [("a.test", 8, 9, True)]
    got = sorted(tuple(r) for r in S.found_lines(df, excess).select("pdf_id", "side", "line_no").distinct().collect())
    assert got == [(i, "body", 1) for i in range(8)]
    clean = {(r.pdf_id, r.side): r.text for r in S.without_repeated(df, excess).collect()}
    assert NOTE not in clean[1, "body"] and clean[1, "body"].startswith("unique sentence") and clean[50, "body"] == NOTE and clean[20, "note"] == NOTE
    assert S.repeated(df.limit(0)).count() == 0


def test_a_notice_of_every_site_is_found(spark):
    docs = [doc(100 * s + i, f"s{s}.test", NOTE, f"own text {chr(97 + s)} {chr(97 + i)} with words enough") for s in range(4) for i in range(10)]
    excess = S.repeated(spark.createDataFrame(docs, SCHEMA)).collect()
    assert len(excess) == 4 and all(r.significant and r.frequent for r in excess)


def test_statistic():
    assert S.LEAST_LETTERS == 20
