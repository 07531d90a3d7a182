import random

from corpusloom.llm import survivors as S

SCHEMA = "pdf_id bigint, path string, journal_domain string, sha256 string, title_key string, first_text_hash string, page_count int, mtime double, size bigint, first_id bigint, key string"


def record(i, path="/p/x%d.pdf", site="s", sha=None, title=None, text=None, pages=None, mtime=None, size=None):
    return (i, path % i if "%" in path else path, site, sha, title, text, pages, mtime, size, 1, "k")


def test_groups_survivors_and_fields(spark):
    rows = [
        record(1, sha="AA", mtime=5.0, size=10, pages=3, site="good"), record(2, sha="aa", mtime=5.0, size=10, pages=None, site="bad"), record(3, sha="bb", title="t", text="h", mtime=9.0, site="good"),
        record(4, sha="aa", title="t", text="h", mtime=1.0, pages=3, site="other"),  # joins 1, 2 and 3
        record(5, "/p/y-1.pdf", sha="c1"), record(6, "/p/y-22.pdf", sha="c2"), record(7, "/p/y.pdf", site="elsewhere"), record(8, "/q/y.pdf", site=None),
        record(9, title="lone", text=None), record(10, title="lone", text=None), record(11, sha=""), record(12, sha=""), record(13, path="/p/z.pdf", sha=None, site=None),
    ]
    df = spark.createDataFrame([*rows, rows[0], rows[0]], SCHEMA)
    got = {r.first_id: r for r in S.survivors(df).collect()}
    assert set(got) == {1, 5} and got[1].canonical_id == 3 and got[1].n_records == 4 and got[5].canonical_id == 5
    assert got[1].page_count == 3 and got[1].size == 10 and 0 < got[1].least_posterior <= 1
    assert S.survivors(df.limit(0)).count() == 0


def test_copiers_are_discounted(spark):
    """Two sources that share many false values do not outvote an accurate one."""
    rows, i = [], 0
    for g in range(30):
        sha = f"g{g}"
        # the honest sources agree on everything; the copiers repeat each other's errors in page_count
        for site, pages in (("h1", 100 + g), ("h2", 100 + g), ("h3", 100 + g), ("c1", 7), ("c2", 7)):
            rows.append(record(i, site=site, sha=sha, pages=pages, mtime=1.0))
            i += 1
    for site, pages in (("h1", 50), ("c1", 8), ("c2", 8)):
        rows.append(record(i, site=site, sha="last", pages=pages, mtime=1.0))
        i += 1
    got = S.survivors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 31 and {r.page_count for r in got if r.first_id == i - 3} == {50}


def test_ties_take_the_smaller_path(spark):
    df = spark.createDataFrame([record(1, "/b.pdf", sha="x", mtime=1.0), record(2, "/a.pdf", sha="x", mtime=1.0), record(3, "/c.pdf", sha="x", mtime=None)], SCHEMA)
    assert [r.canonical_id for r in S.survivors(df).collect()] == [2]


def planted(seed=3, groups=60):
    """Honest sites that are right nine times in ten, and two that copy a careless one; in every fourth group only two honest ones speak."""
    rng, rows, truth = random.Random(seed), [], {}
    for g in range(groups):
        truth[len(rows)] = true = 100 + g
        wrong = lambda: rng.choice([v for v in range(7) if v]) * 1000 + g  # noqa: B023,E731
        careless = true if rng.random() < 0.3 else wrong()
        said = {**{f"h{k}": true if rng.random() < 0.9 else wrong() for k in range(2 if g % 4 == 3 else 4)}, **dict.fromkeys(("c0", "c1", "c2"), careless)}
        rows += [record(len(rows) + k, site=site, sha=f"g{g}", pages=v, mtime=float(k)) for k, (site, v) in enumerate(said.items())]
    return rows, truth


def test_planted_truth_in_any_order(spark):
    """Against three voices of one careless site two honest ones win; order and partitions change nothing."""
    rows, truth = planted()
    before, results = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n, partitions in enumerate(("1", "4", "16")):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            mixed = random.Random(n).sample(rows, len(rows))
            results.append(sorted(tuple(r) for r in S.survivors(spark.createDataFrame(mixed, SCHEMA).repartition(n + 1)).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]
    found = {r.first_id: r.page_count for r in S.survivors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found.keys() == truth.keys() and sum(found[k] == v for k, v in truth.items()) >= 0.9 * len(truth)


def test_records_given_twice_and_sites(spark):
    rows = [record(1, sha="x", mtime=1.0, pages=3, site="a"), record(1, sha="x", mtime=2.0, pages=4, site="a"), record(2, sha="x", mtime=2.0, pages=4, site=None)]
    got = S.survivors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.first_id, r.n_records, r.page_count, r.mtime, r.journal_domain) for r in got] == [(1, 2, 4, 2.0, "a")]
