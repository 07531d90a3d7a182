from pyspark.sql import functions as F

from corpusloom.functions import records as R
from corpusloom.functions import text as T
from corpusloom.functions import urls as U


def values(spark, data, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_citations(spark):
    texts = ["Smith v. Jones, 1 F.3d 2", "42 U.S.C. § 1983", "12 C.F.R. § 5", "city code § 7", "H.R. Rep. No. 12", "the Geneva Convention", "12 Harv. L. Rev. 34", "plain", None, ""]
    assert values(spark, texts, T.citation_type) == ["case", "statute", "regulation", "municipal_code", "legislative_history", "treaty_or_international", "secondary_source", "other", "other", "other"]
    m = values(spark, ["See 42 U.S.C. § 1983 and 42 u.s.c. §  1983; Smith v. Jones"], T.citation_mentions)[0]
    assert [(x.kind, x.text) for x in m] == [("case", "See 42 U.S.C. § 1983 and 42 u.s.c. § 1983; Smith v. Jones"), ("statute", "42 U.S.C. § 1983")] or [x.kind for x in m].count("statute") == 1


def test_addresses_in_text(spark):
    assert values(spark, ["see http://a.b/c). and HTTP://A.B/C http://a.b/c.", None], T.urls) == [["http://a.b/c", "HTTP://A.B/C"], []]
    assert values(spark, ["A@b.com a@B.com x@y.org", None], T.emails) == [["A@b.com", "x@y.org"], []]
    assert values(spark, ["2001 1999 2001 1800 12001", None], T.years) == [["1999", "2001"], []]


def test_texts(spark):
    assert values(spark, ["A — “b”  c"], T.unified) == ['a - "b" c'] and values(spark, ["Sa- cramento re-\nport"], T.note_text) == ["sacramento report"]
    assert values(spark, ["Dr. A. One! Two?  Three", None, " "], lambda c: F.size(T.sentences(c))) == [5, 0, 0]
    assert values(spark, ["INTRODUCTION\nthe text\nII. Part\nINTRODUCTION"], T.section_headers) == [["INTRODUCTION", "II. Part"]]
    assert values(spark, ["ﬁnal Straße!", None], T.compatible_key) == ["final strasse", None] and values(spark, ["The Économic & Law  Review"], T.plain_name) == ["economic and law review"]
    assert values(spark, ["A and B; C, D", None], T.split_names) == [["A", "B", "C", "D"], []]
    assert values(spark, ["Vol. 12a", "x", None], T.first_number) == [12, None, None] and values(spark, [None, "!!"], T.first_text_hash) == [None, None]


def test_urls(spark):
    urls = ["https://www.A.test:80/Law/x.pdf?y=1#z", "a.test", None, "http://b.test/cgi/viewcontent.cgi?article=1&context=AbC"]
    assert values(spark, urls, U.host) == ["a.test", "a.test", None, "b.test"] and values(spark, urls, U.slug) == ["law", "a.test", "", "cgi"]
    assert values(spark, urls, lambda c: U.query_value(c, "context")) == ["", "", "", "abc"]
    kinds = ["http://a/x.pdf", "http://a/all_issues.html", "http://a/vol3/iss2/", "http://a/vol3/iss2/5", "http://a/about"]
    assert values(spark, kinds, U.url_class) == ["pdf", "archive", "issue", "article", "other"]
    assert values(spark, ["http://a/vol[1-3]", "http://a/vol[3-1]", "http://a"], U.expanded_ranges) == [["http://a/vol1", "http://a/vol2", "http://a/vol3"], ["http://a/vol[3-1]"], ["http://a"]]
    assert values(spark, ["/corpus/a.test/x.pdf", "x.pdf", None], U.path_domain) == ["a.test", "unknown", "unknown"]
    assert values(spark, ["http://j/article/view/1/2"], U.galley_download) == ["http://j/article/download/1/2"] and values(spark, ["http://a/v1/n22"], U.template) == ["/v{n}/n{n}"]


def test_partial_dates(spark):
    dates = ["2020-05-03", "2020/5", "3rd May 1999", "May 3, 1999", "Sept 2001", "published 1987", "2020-13-40", "", None, "1875"]
    got = values(spark, dates, R.partial_date)
    assert [g and (g.normalized, g.start, g.end) for g in got] == [
        ("2020-05-03", 20200503, 20200503), ("2020-05", 20200501, 20200531), ("1999-05-03", 19990503, 19990503), ("1999-05-03", 19990503, 19990503), ("2001", 20010101, 20011231),
        ("1987", 19870101, 19871231), ("2020", 20200101, 20201231), None, None, None,
    ]


def test_keys(spark):
    schema = "title string, authors array<string>, volume string, issue string, date string, year string, doi string, url string"
    m = [("T", ["A", " B "], "1", None, None, "1999", None, None), (None, None, None, None, None, None, " 10.1/X ", None), (None, None, None, None, None, None, None, None)]
    assert values(spark, m, lambda c: R.article_key(c, F.lit(" P "), F.lit("g")), f"struct<{schema.replace(' ', ':').replace(',:', ',')}>") == ["title:t|vol:1|iss:|date:1999|auth:a; b", "doi:10.1/x", "pdf:p"]
    assert values(spark, ["Digital  Commons", "OJS", "", None, "Own Thing"], R.platform) == ["digital_commons", "ojs", "unknown", "unknown", "own_thing"]
    assert values(spark, ["A & B!", None], R.slug_key) == ["a_b", "unknown"]
