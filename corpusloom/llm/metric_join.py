"""Similarity self-join of strings under a true edit metric, by metric-space partitioning.

The pivots are sets of strings: for a class of characters, all strings without
a character of it. The distance of a string to such a set under the edit metric
is how many of its characters are in the class, and by the triangle inequality
it changes by no more than the distance of two strings. The vector of these
distances names a string's cell; a string is replicated to the cells its
partners may lie in, and cells are joined exactly. All of it runs on the JVM
but the last check of swapped characters; nothing is sampled or collected.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from corpusloom.session import stage

#: Pivot sets: the least, the most for radius 1 and beyond, and the strings a cell should have on average.
LEAST, MOST, MOST_BEYOND, PER_CELL = 4, 10, 6, 8


def edit_distance(a: str, b: str) -> int:
    """Damerau-Levenshtein distance (adjacent transpositions, a true metric)."""
    if a == b:
        return 0
    if within_one(a, b):
        return 1
    big = len(a) + len(b)
    rows = {(i, -1): big for i in range(-1, len(a) + 1)} | {(-1, j): big for j in range(-1, len(b) + 1)}
    rows |= {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    last: dict[str, int] = {}
    for i in range(1, len(a) + 1):
        match = 0
        for j in range(1, len(b) + 1):
            k, m = last.get(b[j - 1], 0), match
            same = a[i - 1] == b[j - 1]
            rows[i, j] = min(rows[i - 1, j - 1] + (not same), rows[i, j - 1] + 1, rows[i - 1, j] + 1, rows[k - 1, m - 1] + (i - k - 1) + 1 + (j - m - 1))
            if same:
                match = j
        last[a[i - 1]] = i
    return rows[len(a), len(b)]


def within_one(a: str, b: str) -> bool:
    """Whether the distance is at most one, in one pass over the strings."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i, n = 0, len(a)
    while i < n and a[i] == b[i]:
        i += 1
    if i == n:
        return True
    if len(a) < len(b):
        return a[i:] == b[i + 1 :]
    return a[i + 1 :] == b[i + 1 :] or (a[i] == b[i + 1 : i + 2] and a[i + 1 : i + 2] == b[i] and a[i + 2 :] == b[i + 2 :])


def pivot_sets(strings: int, radius: int = 1) -> int:
    """Pivot sets for so many strings: each divides them over about five distances, and the cells a string is replicated to hold it back."""
    return int(np.clip(np.ceil(np.log(max(1.0, strings / PER_CELL)) / np.log(5)), LEAST, MOST if radius == 1 else MOST_BEYOND))


def distances(words: DataFrame, sets: int) -> DataFrame:
    """(word, d0, d1, ...): distances of strings to the pivot sets, their characters of each class."""
    classes = words.select("word", F.transform(F.filter(F.split("word", ""), lambda c: c != ""), lambda c: F.ascii(c) % sets).alias("classes"))
    among = lambda i: F.size(F.filter("classes", lambda c: c == i)).cast("smallint")
    return classes.select("word", *[among(i).alias(f"d{i}") for i in range(sets)])


def steps(sets: int, radius: int) -> list[tuple[int, ...]]:
    """By how much the distances of two strings within the radius may differ, one of each pair of opposites and none.

    An insertion or deletion changes one distance by one, a substitution two
    distances in opposite directions.
    """
    out = []
    for step in product(range(-radius, radius + 1), repeat=sets):
        up, down = sum(x for x in step if x > 0), -sum(x for x in step if x < 0)
        if max(up, down) <= radius and step >= tuple(-x for x in step):
            out.append(step)
    return out


@F.pandas_udf(IntegerType())
def _measured(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([edit_distance(x, y) for x, y in zip(a, b)], dtype="int32")


def radius_join(words: DataFrame, radius: int = 1, sets: int | None = None) -> DataFrame:
    """(a, b, distance), a < b: all pairs of distinct strings within ``radius`` edits.

    ``words`` has a column ``word``; repeated and NULL strings are dropped, the
    empty string is a string. A string goes to its own cell and to one of each
    two opposite cells around it, so that every pair meets once. Cells meet in
    an equi-join, which adaptive execution can split, and the length too is a
    distance (to the empty string).
    """
    words = words.select("word").where("word is not null").distinct()
    sets = sets or pivot_sets(words.count(), radius)
    names = [f"d{i}" for i in range(sets)]
    placed = stage(distances(words, sets), "placed")
    homes = placed.select(F.col("word").alias("b"), F.xxhash64(*names).alias("cell"))
    # one expression for each neighbour, all of whose steps are constants
    cells = [F.xxhash64(*[(F.col(d) + F.lit(x)).cast("smallint") if x else F.col(d) for d, x in zip(names, step)]) for step in steps(sets, radius)]
    spread = placed.select(F.col("word").alias("a"), F.explode(F.array(*cells)).alias("cell"))
    pairs = spread.join(homes, "cell").where(F.col("a") != F.col("b"))
    # a swap of neighbours is one edit here and two of Levenshtein's
    close = F.levenshtein("a", "b", 2 * radius)
    pairs = pairs.where(close >= 0).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs.withColumn("distance", _measured("a", "b")).where(F.col("distance") <= radius)
