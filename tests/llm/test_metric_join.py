import random

import pytest

from corpusloom.llm.metric_join import edit_distance, pivot_sets, radius_join, steps, within_one


def brute(a, b):
    """Damerau-Levenshtein distance by its recurrence over a table of last places."""
    big, last = len(a) + len(b), {}
    h = [[big] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        h[i + 1][1] = i
    for j in range(len(b) + 1):
        h[1][j + 1] = j
    for i in range(1, len(a) + 1):
        db = 0
        for j in range(1, len(b) + 1):
            k, col = last.get(b[j - 1], 0), db
            cost = 0 if a[i - 1] == b[j - 1] else 1
            if not cost:
                db = j
            h[i + 1][j + 1] = min(h[i][j] + cost, h[i + 1][j] + 1, h[i][j + 1] + 1, h[k][col] + (i - k - 1) + 1 + (j - col - 1))
        last[a[i - 1]] = i
    return h[-1][-1]


WORDS = sorted({"".join(random.Random(i).choice("abc") for _ in range(random.Random(-i).randrange(0, 8))) for i in range(160)})


def test_edit_distance():
    for a in WORDS[::7]:
        for b in WORDS[::5]:
            assert edit_distance(a, b) == brute(a, b)
            assert within_one(a, b) == (brute(a, b) <= 1)


@pytest.mark.parametrize("radius", [1, 2])
def test_radius_join(spark, radius):
    df = spark.createDataFrame([(w,) for w in [*WORDS, *WORDS[:5], None]], "word string")
    got = {(r.a, r.b, r.distance) for r in radius_join(df, radius, sets=5).collect()}
    assert got == {(a, b, brute(a, b)) for a in WORDS for b in WORDS if a < b and brute(a, b) <= radius}
    assert radius_join(df.limit(0), radius).count() == 0


def test_one_prefix_in_a_third_of_the_names(spark):
    """All names of a hot surname meet only those of like letters; accents and other scripts keep their distances."""
    rng = random.Random(5)
    name = lambda n: "".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(n))
    names = {*("kalpasenoft " + name(6) for _ in range(150)), *(name(9) + " " + name(6) for _ in range(300)), "名前", "名前名", "müller é", "muller é", ""}
    for n in list(names)[:60]:
        i = rng.randrange(len(n) or 1)
        names.add(n[:i] + n[i + 1 : i + 2] + n[i : i + 1] + n[i + 2 :])
        names.add(n[:i] + "x" + n[i + 1 :])
    got = {(r.a, r.b) for r in radius_join(spark.createDataFrame([(n,) for n in names], "word string")).collect()}
    assert got == {(a, b) for a in names for b in names if a < b and within_one(a, b)} and len(got) >= 100


def test_steps():
    assert len(steps(4, 1)) == 1 + (2 * 4 + 4 * 3) // 2 and pivot_sets(0) == 4 and pivot_sets(10**12) == 10 and pivot_sets(10**12, 2) == 6
