import random

from corpusloom.operators.components import components


def brute(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(root)}


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 7), (5, 900)] * 2 + [(rng.randrange(1000, 1300), rng.randrange(1000, 1300)) for _ in range(150)] + [(2000, 2000 + k) for k in range(1, 300)]
    df = spark.createDataFrame([*edges, (None, 3), (4, None)], "src bigint, dst bigint")
    got = {r.id: r.root for r in components(df).collect()}
    assert got == brute([e for e in edges if e[0] != e[1]])
    assert components(df.limit(0)).count() == 0
