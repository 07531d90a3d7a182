import numpy as np

from corpusloom.llm import sampling as S

STATS = "pdf_id bigint, platform_family string, evaluated_at timestamp, fam string, n bigint"
CONFIG, TARGET = "config_id int, sample_size int, floor_per_family int, seed bigint", "config_id int, platform_family string, target_share double"


def tables(spark, counts, configs, targets):
    rows, n = [], 0
    for family, k in counts:
        for _ in range(k):
            rows.append((n, family, None, "x", 1))
            n += 1
    return spark.createDataFrame(rows, STATS), spark.createDataFrame(configs, CONFIG), spark.createDataFrame(targets, TARGET)


def test_targets_are_met_and_gaps_reported(spark):
    t = tables(spark, [("Ojs", 300), ("o j s", 100), ("drupal", 50), ("rare", 3), ("", 40), (None, 10)], [(1, 100, 5, 7), (2, 10_000, 0, 7), (3, 0, 0, 1)], [(c, f, s) for c in (1, 2, 3) for f, s in (("ojs", 0.6), ("drupal", 0.35), ("rare", 0.05), ("none", 0.0))])
    report = S.calibrate(*t)
    got = {(r.config_id, r.platform_family): r for r in report.collect()}
    assert got[1, "rare"].reason == "below_floor" and got[1, "rare"].planned == 3 and got[1, "ojs"].available == 400
    assert got[1, "none"].reason == "below_floor" and got[1, "none"].planned == 0
    assert sum(r.planned for k, r in got.items() if k[0] == 1) == 100
    assert {k[1] for k, r in got.items() if k[0] == 2 and r.reason.startswith("below")} == {"ojs", "drupal", "rare"}
    drawn = S.sample(t[0], report, block=37)
    counts = {(r.config_id, r.platform_family): r["count"] for r in drawn.groupBy("config_id", "platform_family").count().collect()}
    assert counts == {k: r.planned for k, r in got.items() if r.planned}
    assert drawn.distinct().count() == drawn.count()
    again = S.sample(t[0], report, block=37)
    assert again.exceptAll(drawn).count() == 0


def test_newest_row_names_the_family(spark):
    import datetime as dt

    day = lambda d: dt.datetime(2020, 1, d)
    df = spark.createDataFrame([(1, "", day(9), "", 0), (1, "Ojs", day(1), "", 0), (2, "ojs", day(1), "", 0), (2, "drupal", day(2), "", 0), (3, None, day(2), "", 0), (None, "ojs", day(2), "", 0)], STATS)
    assert sorted(map(tuple, S.units(df).collect())) == [(1, "ojs"), (2, "drupal")]


def test_pivotal_keeps_the_sum_and_the_probabilities():
    import pandas as pd

    rng = np.random.default_rng(5)
    hits = np.zeros(6)
    p = np.array([0.5, 0.25, 0.25, 0.9, 0.6, 0.5])
    for _ in range(3000):
        frame = pd.DataFrame({"unit": range(6), "p": p, "u": rng.random(6), "v": rng.random(6)})
        out = S._pivotal(frame)
        assert len(out) == 3 and (out.p > 1 - 1e-9).all()
        hits[out.unit] += 1
    assert np.abs(hits / 3000 - p).max() < 0.04


def test_newton_and_empty(spark):
    p, rounds = S.newton_tilt(np.full(3, 0.01), np.array([1000.0, 50.0, 5.0]), np.array([10.0, 49.0, 5.0]))
    assert np.allclose(p * [1000, 50, 5], [10, 49, 5]) and rounds < 60
    t = tables(spark, [("ojs", 1)], [(1, 5, 2, 1)], [(1, "ojs", 1.0)])
    empty = S.calibrate(t[0].limit(0), t[1], t[2])
    assert [(r.planned, r.reason) for r in empty.collect()] == [(0, "below_floor")]
    assert S.sample(t[0].limit(0), empty).count() == 0 and S.calibrate(t[0], t[1].limit(0), t[2].limit(0)).count() == 0


def test_every_row_of_the_targets_is_reported(spark, tmp_path):
    from corpusloom.llm import queries

    t = tables(spark, [("Ojs", 60), ("drupal", 40)], [(1, 50, 2, 7)], [(1, "ojs", 0.3), (1, "O.J.S.", 0.3), (1, "drupal", 0.3), (1, None, 0.05), (1, "--", 0.05)])
    for name, df in zip(("doc_stats", "audit_configs", "family_targets"), t):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    report = {r.platform_family: r for r in queries.p1_report(spark, str(tmp_path)).collect()}
    assert set(report) == {"ojs", "O.J.S.", "drupal", None, "--"}
    assert {r.platform_family for r in queries.p1_found(spark, str(tmp_path)).collect()} == {None, "--"}
    assert report["ojs"].planned == report["ojs"].drawn == report["O.J.S."].drawn and report["ojs"].planned + report["drupal"].planned == 50 and report[None].drawn == 0
    assert queries.p1_sample(spark, str(tmp_path)).count() == 50


def test_shortfalls_are_what_the_definition_says():
    """The calibration leaves a gap exactly where fewer exist than the floor or the share."""
    import random
    from collections import namedtuple
    from decimal import Decimal

    import numpy as np

    row, rng = namedtuple("row", "target_share"), random.Random(3)
    for _ in range(200):
        size, floor = rng.choice([0, 10, 100, 4000]), rng.choice([0, 3, 25])
        family = [row(Decimal(rng.randrange(0, 1001)) / 1000) for _ in range(6)]
        have = np.array([rng.choice([0, 1, 3, 25, 40, 400, 4000]) for _ in family], dtype=float)
        gaps = S.shortfalls(family, have, size, floor)
        assert [g > 0 for g in gaps] == [h < floor or Decimal(int(h)) < f.target_share * size for f, h in zip(family, have)]
