from decimal import Decimal

from corpusloom.llm import mixing as M


def test_water_fill():
    assert M.water_fill([Decimal("0.5"), Decimal("0.3"), Decimal("0.2")], [100, 1000, 1000], 1000) == [100.0, 540.0, 360.0]
    assert M.water_fill([Decimal(1), Decimal(0)], [5, 5], 100) == [5.0, 0.0]
    assert M.water_fill([], [], 10) == []


def test_mixture(spark):
    rng_text = lambda n: " ".join(["law"] * n)
    docs = [(i, rng_text(10 + i % 7), "big", 1) for i in range(400)] + [(1000 + i, rng_text(20), "small", 1) for i in range(5)] + [(2000, None, "small", 1), (2001, "", "small", 1), (2002, "x", None, 1)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string, n_tokens int")
    targets = spark.createDataFrame([(1, "big", 0.5, 2), (1, "small", 0.5, 3), (2, "big", 1.0, 4), (2, "gone", 0.0, 4), (3, "gone", 1.0, 1)], "mix_id int, source string, target_share double, max_repeat int")
    plans = spark.createDataFrame([(1, 1000), (2, 12_345), (3, 50)], "mix_id int, total_tokens bigint")
    sized = M.sizes(df, targets)
    plan = M.plan(sized, plans, targets)
    p = {(r.mix_id, r.source): r for r in plan.collect()}
    assert p[1, "small"].reason == "short" and p[1, "small"].planned_tokens == 300 and p[3, "gone"].reason == "short" and p[2, "gone"].reason == "met"
    mixed = M.mixture(sized, plan, seed=3)
    rows = mixed.collect()
    assert all(r.repeats <= p[r.mix_id, r.source].max_repeat for r in rows) and len({(r.mix_id, r.doc_id) for r in rows}) == len(rows)
    for r in M.reached(plan, mixed).collect():
        # a source ends within one document of its plan
        assert 0 <= r.planned_tokens - r.tokens <= 20
    assert M.mixture(sized, plan, seed=3).exceptAll(mixed).count() == 0
    assert M.plan(sized, plans.limit(0), targets).count() == 0 and M.sizes(df.limit(0), targets).count() == 0
