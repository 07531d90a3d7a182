import numpy as np

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import boundaries, evaluate, groups, html, layout, merge, notes, record_stats


def got(df, *order):
    return sorted(tuple(r) for r in (df.select(*order) if order else df).collect())


# ------------------------------------------------------------------- records
def test_gaps_and_outliers(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 4, 1), ("a", 4, 1), ("a", None, 2), ("b", 7, 1), ("b", 7, 3), (None, 1, 1), (None, 3, 1)], "domain string, volume int, issue int")
    assert set(map(tuple, record_stats.gaps(df, ["domain"], "volume").collect())) == {("a", 2), ("a", 3), (None, 2)}
    assert got(record_stats.gaps(df.where("volume is not null and domain is not null"), ["domain", "volume"], "issue")) == [("b", 7, 2)]
    n = spark.createDataFrame([("a", 1, i) for i in (1, 1, 1, 1, 2, 2, 2, 2, 3)], "domain string, volume int, issue int")
    assert [(r.issue, r.records) for r in record_stats.issue_outliers(n).collect()] == [(3, 1)]
    assert record_stats.gaps(df.limit(0), ["domain"], "volume").count() == 0


RUN = "record_id bigint, seq bigint, domain string, pdf_url string, ok boolean, pdf_sha256 string, http_status int, download_state string, retries int"


def runs(spark, *rows):
    return spark.createDataFrame([(i, i, d, u, ok, sha, st, state, r) for i, (d, u, ok, sha, st, state, r) in enumerate(rows)], RUN)


def test_delta_and_retries(spark):
    a = record_stats.url_index(runs(spark, ("d", "u1", True, "x", 200, "", 0), ("d", "u1", True, "y", 200, "", 0), ("d", "u2", True, "z", 200, "", 0), ("d", "u4", True, None, 200, "", 0)))
    b = record_stats.url_index(runs(spark, ("d", "u1", True, "q", 200, "", 0), ("d", "u3", True, "z", 200, "", 0), ("d", " ", True, "z", 200, "", 0), ("d", "u4", True, "z", 200, "", 0)))
    assert got(a) == [("u1", "y"), ("u2", "z"), ("u4", "")]
    assert got(record_stats.delta(a, b)) == [("u1", "changed"), ("u2", "removed"), ("u3", "added"), ("u4", "unchanged")]
    r = runs(spark, ("d", "u", False, None, 500, "failed", 0), ("d", "u", False, None, 503, "failed", 1), ("d", "u", False, None, 500, "failed", 9), ("d", "v", False, None, 403, "blocked", 0), ("D", "v", None, None, 429, "failed", 0), ("d", None, False, None, 500, "failed", 0))
    assert got(record_stats.latest_retryable(r)) == [("u", 1, "server", 1)] and got(record_stats.first_blocked(r)) == [("v", 3, "d")]
    assert got(record_stats.failure_streaks(r)) == [("d", 6, 1)]
    plan = record_stats.round_robin(runs(spark, ("a", "1", False, None, 0, "", 0), ("a", "2", False, None, 0, "", 0), ("b", "3", False, None, 0, "", 0), ("b", "3", True, None, 0, "", 0)))
    assert got(plan) == [(1, "a", "1"), (2, "a", "2")]


# --------------------------------------------------------------------- notes
TRIMS = [
    ([1, 2, 3, 4, 250], [1, 2, 3, 4]), ([], []), ([0, 1, 2, 3, 4], [1, 2, 3, 4]), ([3, 90], [3, 90]), ([1, 2, 3, 90, 95, 250], [1, 2, 3, 90, 95]), ([-4, 0, 7, 8, 9], [7, 8, 9]),
    ([1, 40, 41, 42, 43], [40, 41, 42, 43]), ([5, 6, 7, 8, 15], [5, 6, 7, 8]), ([5, 6, 7, 8, 13], [5, 6, 7, 8, 13]), ([1, 2, 30], [1, 2]), ([2, 2, 3, 3, 4], [2, 3, 4]), ([10, 12, 14, 16, 100, 400], [10, 12, 14, 16]),
]


@pytest.mark.parametrize("labels, want", TRIMS)
def test_trim_outliers(labels, want):
    assert notes.trim_outliers(labels) == want and notes.trim_outliers(labels[::-1]) == want and notes.trim_outliers(want) == want


def test_ordinality(spark):
    df = spark.createDataFrame([(1, [1, 2, 3]), (2, [1, 2, 4]), (3, [1, 2, 5, 6, 10]), (4, [])], "i int, labels array<int>")
    o = {r.i: r.o for r in df.select("i", notes.ordinality(F.col("labels")).alias("o")).collect()}
    assert [o[i].status for i in (1, 2, 3, 4)] == ["valid", "valid_with_gaps", "invalid", "valid"] and o[3].gaps == [3, 4, 7, 8, 9] and (o[4].low, o[4].high) == (0, 0)


def test_best_sequence():
    # the stray 84 and the page number going up the page are left out
    labels, pages, tops = [1, 84, 2, 3, 4, 5], [1, 1, 1, 2, 2, 2], [700, 710, 720, 700, 50, 730]
    assert [labels[i] for i in notes.best_sequence(labels, pages, tops, [5.0] * 6)] == [1, 2, 3, 5]
    again = [1, 2, 3, 4, 5, 6, 1, 2, 3, 4, 5, 6]
    assert [again[i] for i in notes.best_sequence(again, [1] * 6 + [9] * 6, list(range(12)), [5.0] * 12)] == again
    assert notes.best_sequence([], [], [], []) == []


def test_best_sequence_equals_brute_force():
    import itertools
    import random

    rng, costs = random.Random(7), notes.ChainCosts()
    assert costs.step(np.array([1, 2, 3, 4, 5, 6, 8])).tolist() == [0.0, 0.5, 1.5, 4.0, 4.0, 6.0, 10.0]

    def score(path, labels, pages, tops, base):
        total = base[path[0]] - max(0, (labels[path[0]] - 1) * 5.0)
        for j, i in zip(path, path[1:]):
            d = labels[i] - labels[j]
            if d > 0:
                cost = float(costs.step(np.array([d]))[0]) + (10.0 if pages[i] == pages[j] and tops[i] < tops[j] - 0.5 else 0.0)
            elif labels[i] <= 2 and pages[i] != pages[j]:
                cost = 12.0
            else:
                return -1e9
            total += base[i] - cost
        return total

    for _ in range(60):
        n = rng.randrange(1, 8)
        labels, pages, tops = [rng.randrange(1, 6) for _ in range(n)], sorted(rng.randrange(3) for _ in range(n)), [rng.random() * 700 for _ in range(n)]
        base = [rng.random() * 8 for _ in range(n)]
        best = max(score(c, labels, pages, tops, base) for k in range(1, n + 1) for c in itertools.combinations(range(n), k))
        assert abs(score(notes.best_sequence(labels, pages, tops, base), labels, pages, tops, base) - best) < 1e-9


def test_segments(spark):
    lines = [(1, 0, 0, 3, "stray line"), (1, 0, 1, 3, "1 See the re-"), (1, 0, 2, 3, "port of 1999."), (1, 1, 0, 4, "2. Id. at 7."), (1, 1, 1, 4, "84 Bost. L. Rev. 2"), (1, 1, 2, 4, None), (2, 0, 0, 1, "5 Late start")]
    s = notes.segmented(spark.createDataFrame(lines, "pdf_id bigint, page_index int, line int, page int, text string"))
    assert got(s, "pdf_id", "label", "page_start", "page_end", "text") == [(1, 1, 3, 3, "See the report of 1999."), (1, 2, 4, 4, "Id. at 7. 84 Bost. L. Rev. 2"), (2, 5, 1, 1, "Late start")]


def test_segments_with_wrapped_citations(spark):
    texts = ["1 See Smith,", "112 Tarn. App. 4", "2 Id.", "1965) (holding", "3 Reed v. Roe,", "445 (1963)", "4 See", "5 Corb. L. Rev. 2", "4, 348 (1979).", "5 Id.", "6 See id.", "30 After lost pages", "31 Id.", "32 Id.", "33 Id.", "1 Second part", "2 Id."]
    df = spark.createDataFrame([(1, i // 4, i % 4, i // 4, t) for i, t in enumerate(texts)], "pdf_id bigint, page_index int, line int, page int, text string")
    s = notes.segmented(df).orderBy("note_no").collect()
    assert [r.label for r in s] == [1, 2, 3, 4, 5, 6, 30, 31, 32, 33, 1, 2]
    assert [r.text for r in s[:3]] == ["See Smith, 112 Tarn. App. 4", "Id. 1965) (holding", "Reed v. Roe, 445 (1963)"]
    assert notes.opened([]) == [] and notes.opened([None, 5, None]) == [0, 1, 1] and notes.opened([1, 4, 2]) == [1, 1, 2]


# -------------------------------------------------------------------- layout
def test_layout(spark):
    rows = [(1, 0, 1, 800.0, 14, i, f"body line {i}" if i < 9 else f"{i} See id. at 4", 40.0 + 50 * i, 11.0 if i < 9 else 8.0) for i in range(14)]
    rows += [(1, p, p + 1, 800.0, 1, 0, f"{p} Law Review", 20.0, 9.0) for p in (1, 2, 3)]
    df = spark.createDataFrame(rows, "pdf_id bigint, page_index int, page int, height double, n_lines int, pos int, text string, top double, font_size double")
    # from the sixth line on the mean below is under 92 % of the median; markers are dense from the first line in the lower part
    assert got(layout.font_transition(df)) == [(1, 0, 290.0)] and got(layout.marker_density(df)) == [(1, 0, 390.0)]
    assert got(layout.recurring_lines(df)) == [(1, 2, "# law review", 3)]
    v = {r.page_index: r for r in layout.font_variance(df).collect()}
    assert v[0].spread == 3.0 and not v[0].low_variance and v[1].sized == 1


# -------------------------------------------------------------------- groups
def test_groups(spark):
    df = spark.createDataFrame([(1, "s", 5, "/a/x.pdf", 1.0), (2, "s", 1, "/a/y.pdf", 2.0), (3, "s", 9, "/a/x.pdf", 3.0), (4, "t", 2, "/b/z.pdf", None)], "pdf_id bigint, site string, n int, path string, mtime double")
    assert got(groups.versioned_names(df, "site", "path", "pdf_id")) == [(1, "x.pdf"), (2, "y.pdf"), (3, "x__v2.pdf"), (4, "z.pdf")]
    assert [r.pdf_id for r in groups.rank_by(df, "pdf_id", {"n": 1.0}).orderBy("rank").collect()] == [3, 1, 4, 2]
    assert {r.pdf_id for r in groups.spread(df, "site", ["mtime"], "pdf_id").collect()} == {1, 2, 3, 4}


@pytest.mark.parametrize("have, size, floor, want", [({"a": 100, "b": 10, "c": 1}, 20, 2, {"a": 16, "b": 3, "c": 1}), ({"a": 5, "b": 5}, 3, 4, {"a": 2, "b": 1}), ({}, 5, 1, {}), ({"a": 2, "b": 0}, 9, 1, {"a": 2}), ({"a": 7, "b": 7, "c": 7}, 8, 0, {"a": 3, "b": 3, "c": 2})])
def test_quotas(spark, have, size, floor, want):
    counts = spark.createDataFrame(list(have.items()), "g string, n bigint")
    assert {r.g: r.quota for r in groups.quotas(counts, "g", size, floor).collect()} == want


def test_ranked(spark):
    df = spark.createDataFrame([((i * 7919) % 1000, str(i)) for i in range(500)], "v bigint, k string")
    got_ = [(r["rank"], r.v) for r in groups.ranked(df, [F.desc("v"), F.col("k")]).orderBy("rank").collect()]
    assert [x for x, _ in got_] == list(range(1, 501)) and [v for _, v in got_] == sorted((v for _, v in got_), reverse=True)


def test_duplicate_members(spark):
    rows = [(1, "/a/x.pdf", "s", "H1", None, None, 3, 1.0, 5), (2, "/b/y.pdf", "t", "h1", "k", "f", 3, 1.0, 5), (3, "/c/z.pdf", "u", "h2", "k", "f", 4, 1.0, 5), (4, "/d/q.pdf", "u", "h4", None, "f", None, None, None), (5, "/e/q-2.pdf", "u", None, None, "f", None, 9.0, None)]
    df = spark.createDataFrame(rows, "pdf_id bigint, path string, journal_domain string, sha256 string, title_key string, first_text_hash string, page_count int, mtime double, size bigint")
    assert got(groups.duplicate_members(df)) == [("/a/x.pdf", "/c/z.pdf", "sha256|title_first_text", 3), ("/b/y.pdf", "/c/z.pdf", "sha256|title_first_text", 3), ("/c/z.pdf", "/c/z.pdf", "sha256|title_first_text", 3), ("/d/q.pdf", "/e/q-2.pdf", "versioned_name", 2), ("/e/q-2.pdf", "/e/q-2.pdf", "versioned_name", 2)]
    assert groups.duplicate_members(df.limit(0)).count() == 0


def test_infer_journals(spark):
    index = spark.createDataFrame([("h", "One", "one"), ("h", "Two", "two"), ("k", "Only", "x")], "host string, journal string, slug string")
    rows = spark.createDataFrame([(1, "h", ["two"]), (2, "h", ["zzz"]), (3, "k", []), (4, "m", []), (5, None, [])], "i int, host string, contexts array<string>")
    assert got(groups.infer_journals(rows, index), "i", "journal") == [(1, "Two"), (2, "zzz (h)"), (3, "Only"), (4, "m"), (5, "(unknown journal)")]


# ---------------------------------------------------------------- evaluation
def test_scores(spark):
    gold = spark.createDataFrame([(1, "1", 0), (1, "2", 1), (1, "2", 2), (2, "1", 0)], "pdf_id bigint, label string, seq int")
    pred = spark.createDataFrame([(1, "2", 0), (1, "1", 1), (1, "9", 2), (3, "1", 0)], "pdf_id bigint, label string, seq int")
    s = {r.pdf_id: r for r in evaluate.label_scores(gold, pred).collect()}
    assert (s[1].tp, s[1].fp, s[1].fn, s[1].f1, s[1].same_order) == (2, 1, 1, 0.6667, False) and s[2].recall == 0.0 and s[3].precision == 0.0
    assert got(evaluate.failure_taxonomy(gold, pred)) == [(1, "extra_labels"), (1, "missing_labels"), (2, "missing_labels"), (3, "extra_labels")]
    t = evaluate.token_scores(spark.createDataFrame([(1, "a b b")], "k int, text string"), spark.createDataFrame([(1, "b a c"), (2, "x")], "k int, text string"), ["k"])
    assert got(t, "k", "tp", "fp", "fn") == [(1, 2, 1, 1)]


# ------------------------------------------------------------- html and merge
PAGE = "<html><title>A  title</title><meta name='citation_title' content='T'><a href='/x.pdf#p'>Get <b>PDF</b></a><a href='x.pdf'>again</a><a href='mailto:a@b'>m</a><ol><li id='fn2'>2. Two</li><li id='fn1'><p>One</p></li></ol>"


def test_html(spark):
    df = spark.createDataFrame([("http://a.test/d/", PAGE), ("http://a.test/", None), ("http://a.test/", "<a href='"), ("http://b", "<script></script>" * 10)], "url string, html string")
    l = html.classified_links(df).collect()  # noqa: E741
    assert sorted((r.link, r.anchor, r.kind) for r in l) == [("http://a.test/d/x.pdf", "again", "pdf"), ("http://a.test/x.pdf", "Get PDF", "pdf")]
    r = df.select(html.notes("html").alias("n"), html.metadata("html").alias("m"), html.needs_script(F.col("html")).alias("s"), html.platform(F.col("html")).alias("p")).collect()
    assert [(n.label, n.text) for n in r[0].n] == [("1", "One"), ("2", "Two")] and (r[0].m.title, r[0].m.citation_title) == ("A title", "T") and r[1].n == [] and [x.s for x in r] == [False, False, False, True]
    s = spark.createDataFrame([("<sitemapindex><loc> http://a/1&amp;2 </loc></sitemapindex>",), (None,)], "x string").select(html.sitemap_locations(F.col("x")).alias("s")).collect()
    assert s[0].s.is_index and s[0].s.locations == ["http://a/1&2"] and s[1].s.locations == []


def test_boundaries(spark):
    toc = "CONTENTS\nFirst Article ..... 101\nSecond ..... 120\nEarlier .... 90\nThird ..... 131\nxx 5"
    pages = [(1, 0, toc)] + [(1, i, f"{99 + i}\ntext" if i > 1 else "cover") for i in range(1, 40)] + [(2, 0, "no contents")]
    assert got(boundaries.article_spans(spark.createDataFrame(pages, "doc_id bigint, page_index int, text string"))) == [(1, 101, 2, 20), (1, 120, 21, 31), (1, 131, 32, 39)]


def test_merge(spark):
    rows = spark.createDataFrame([(1, "u", 1, "a", None), (2, "u", 3, "", "v"), (3, "u", 3, "b", None), (4, "u", 3, "c", None), (5, None, 1, "x", "y")], "seq bigint, k string, r int, f string, g string")
    assert got(merge.merge_ranked(rows, "k", ["f", "g"], F.col("r"), "seq")) == [("u", "b", "v", 2)]
    hosts = spark.createDataFrame([("x.a.test",), ("a.test",), ("b.c",), (None,)], "host string")
    routes = spark.createDataFrame([("test", "t"), ("a.test", "at")], "suffix string, route string")
    assert {(r.host, r.route) for r in merge.routed(hosts, "host", routes).collect()} == {("x.a.test", "at"), ("a.test", "at"), ("b.c", "generic"), (None, "generic")}
    rules = spark.createDataFrame([("one", 2, "a"), ("zero", 1, "^b")], "rule string, position int, pattern string")
    assert got(merge.first_rule(spark.createDataFrame([(1, "ba"), (2, "xa"), (3, None)], "k int, t string"), "k", F.col("t"), rules)) == [(1, "zero"), (2, "one")]
    assert got(merge.high_water(spark.createDataFrame([("a", 3), ("b", 1)], "k string, n int"), spark.createDataFrame([("a", 2), ("c", 5)], "k string, n int"), "k", "n")) == [("a", 3, True), ("b", 1, True), ("c", 5, False)]


def test_shard(spark):
    import hashlib

    paths = [f"/a/{i}.pdf" for i in range(40)]
    r = spark.createDataFrame([(p,) for p in paths], "p string").select("p", groups.path_shard(F.col("p"), 7).alias("s")).collect()
    assert all(x.s == int(hashlib.sha1(x.p.encode()).hexdigest()[:16], 16) % 7 for x in r)




# -------------------------------------------------------------------- repair
def test_repairs(spark):
    from corpusloom.operators import repair

    n = spark.createDataFrame([(1, 0, None), (1, 1, 4), (1, 2, None), (1, 3, None), (1, 4, 8), (2, 0, None)], "g int, i int, number int")
    assert [r.filled for r in repair.filled_labels(n, ["g"], ["i"]).orderBy("g", "i").collect()] == [None, 4, 5, 6, 8, None]
    s = spark.createDataFrame([([1, 102, 3, 100],), ([101, 102],), ([1, 2],)], "l array<int>").select(repair.collapsed_hundreds(F.col("l")).alias("l"))
    assert [r.l for r in s.collect()] == [[1, 2, 3], [101, 102], [1, 2]]
    rows = spark.createDataFrame([("a", None, 0.5), ("b", "old", 0.9), ("c", "old", 0.1)], "k string, t string, conf double")
    new = spark.createDataFrame([("a", "new", 0.4), ("b", "new", 0.4), ("c", "new", 0.4), ("c", "", 0.3)], "k string, t string, conf double")
    want = {"fill_missing": ["new", "old", "old"], "always": ["new", "new", "new"], "higher_confidence": ["new", "old", "new"]}
    for policy, values in want.items():
        assert [r.t for r in repair.patched(rows, new, "k", ["t"], policy, "conf").orderBy("k").collect()] == values
    b = spark.createDataFrame([(1, 0, 0, 9), (1, 0, 1, 1), (1, 0, 2, 2), (1, 0, 3, 3), (1, 0, 4, 1), (1, 1, 0, None)], "pdf_id int, page_index int, pos int, label int")
    # from the second label on two of three steps rise, from the third on one of two: only the last, with no step, is left
    assert got(repair.rising_block(b)) == [(1, 0, 4)]
    assert got(repair.ascending_share(b, ["pdf_id"], ["page_index", "pos"], "label")) == [(1, 4, 0.5)]


def test_schema_errors():
    from corpusloom.operators.repair import schema_errors

    schema = {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {"a": {"$ref": "#/$defs/n"}, "l": {"type": "array", "minItems": 1, "items": {"enum": ["x", "y"]}}}, "$defs": {"n": {"type": ["integer", "null"], "minimum": 1}}}
    assert schema_errors({"a": 1, "l": ["x"]}, schema) == [] and schema_errors({"a": None}, schema) == []
    assert len(schema_errors({"a": 0, "l": ["z"], "b": 1}, schema)) == 3 and schema_errors([], schema) == ["$: is no object"] and len(schema_errors({"a": True, "l": []}, schema)) == 2


# ------------------------------------------------------------------- columns
def test_columns(spark):
    from corpusloom.operators import columns

    # lines begin at different places, so that spaces between words do not stand above each other
    words = [(1, 1, x + 7 * r % 40, x + 7 * r % 40 + 46.0, 50.0 + 12 * r + 0.5 * (k % 2), f"{'L' if x < 300 else 'R'}{r}.{k}") for r in range(12) for k, x in enumerate((50.0, 100.0, 150.0, 200.0, 350.0, 400.0, 450.0, 500.0))]
    words += [(1, 2, 50.0 + 40 * k + 7 * r % 40, 88.0 + 40 * k + 7 * r % 40, 60.0 + 12 * r, "w") for r in range(12) for k in range(12)] + [(1, 3, None, None, 1.0, "x")]
    df = spark.createDataFrame(words, "doc_id bigint, page int, x0 double, x1 double, top double, text string")
    g = got(columns.gutters(df))
    assert len(g) == 1 and g[0][1] == 1 and 240 <= g[0][2] <= 350
    c = got(columns.center_gaps(df))
    assert len(c) == 1 and 220 < c[0][2] < 370
    l = columns.lines_of(df, columns.gutters(df)).where("page = 1").orderBy("line").collect()  # noqa: E741
    assert [r.text for r in l[:2]] == ["L0.0 L0.1 L0.2 L0.3", "L1.0 L1.1 L1.2 L1.3"] and l[12].text == "R0.4 R0.5 R0.6 R0.7" and len(l) == 24
    assert columns.lines_of(df).where("page = 1").count() == 12


def test_heading_spans(spark):
    pages = [(1, i, "text\nmore") for i in range(12)]
    for i in (0, 2, 5):
        pages[i] = (1, i, "A Theory of Everything\nBy A. Author\nAbstract. We show.")
    df = spark.createDataFrame([*pages, (2, 0, "A Theory\nabstract"), (3, 0, None)], "doc_id bigint, page_index int, text string")
    assert got(boundaries.heading_spans(df)) == [(1, 0, 4), (1, 5, 11)]
