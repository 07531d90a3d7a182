"""Connected components of an edge list, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import stage


def is_star_forest(edges: DataFrame) -> bool:
    """Whether every source has one target and no target is a source."""
    doubled = edges.groupBy("src").count().where("count > 1").limit(1).count()
    if doubled:
        return False
    roots = edges.select(F.col("dst").alias("src")).distinct()
    return edges.join(roots, "src", "left_semi").limit(1).count() == 0


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(id, root): for every node of ``edges`` (src, dst) the smallest node it is linked to.

    Alternates large-star and small-star steps, which need aggregates of the
    minimum (combined before the shuffle) and one join each, until the edges
    form stars; a hub is never collected into one task. Loops, repeated edges
    and NULL ends are dropped. An empty edge list gives an empty result.
    """
    e = edges.where("src is not null and dst is not null and src <> dst")
    e = stage(e.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "cc")
    for _ in range(max_rounds):
        if is_star_forest(e):
            break
        both = e.unionAll(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
        large = both.join(low, "src").where("dst > src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).where("src <> dst").distinct()
        low = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = large.join(low, "src").where("dst <> m").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
        e = stage(small.unionAll(low.select("src", F.col("m").alias("dst"))).distinct(), "cc")
    else:
        raise RuntimeError(f"components: not settled after {max_rounds} rounds")
    return e.select(F.col("src").alias("id"), F.col("dst").alias("root")).unionAll(e.select(F.col("dst").alias("id"), F.col("dst").alias("root")).distinct())
