"""Mixtures of sources with target shares of the total size in tokens.

Targets are met by capped water-filling: a source that cannot give its share
even when every document is repeated ``max_repeat`` times is clamped there, and
its excess weight goes to the others in proportion, until the plan is feasible.
Documents are then taken whole times, and the fraction by a seeded order.

Defined results: NULL and empty texts have no tokens and are never taken;
sources without documents have capacity 0 and are reported; a NULL share or
``max_repeat`` counts as 0; an empty plan gives an empty mixture; equal places
in the seeded order are settled by doc_id.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.encode import TOKENIZER, token_count
from corpusloom.session import stage

#: Bins of the seeded order; only the bin in which a source's quota ends is sorted.
BINS = 4096


def sizes(documents: DataFrame, targets: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, n_tokens) of the documents of the sources that are mixed."""
    wanted = targets.select("source").where("source is not null").distinct()
    docs = documents.select("doc_id", "text", "source").join(F.broadcast(wanted), "source", "left_semi")
    return stage(docs.select("doc_id", "source", token_count(F.col("text"), path).alias("n_tokens")), "sizes")


def water_fill(shares: list[Decimal], capacity: list[int], total: int) -> list[float]:
    """Tokens of each source: shares of the total, none beyond its capacity."""
    give = [0.0] * len(shares)
    free = {i for i, s in enumerate(shares) if s > 0}
    rest = float(total)
    while free:
        weight = float(sum(shares[i] for i in free))
        want = {i: rest * float(shares[i]) / weight for i in free}
        over = [i for i in free if want[i] > capacity[i]]
        if not over:
            for i in free:
                give[i] = want[i]
            break
        for i in over:
            give[i] = float(capacity[i])
            rest -= capacity[i]
            free.discard(i)
        rest = max(rest, 0.0)
    return give


def plan(sized: DataFrame, plans: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per plan and source.

    mix_id, source, target_share, max_repeat, total_tokens, documents,
    available_tokens, capacity, target_tokens, planned_tokens, whole (times each
    document is taken), fraction_tokens (taken once more), reason (``short``,
    ``raised`` or ``met``). Plans, targets and one count per named source come
    to the driver.
    """
    spark = sized.sparkSession
    have = {r.source: (r.n, r.t) for r in sized.where("n_tokens > 0").groupBy("source").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("t")).collect()}
    totals = {r.mix_id: int(r.total_tokens or 0) for r in plans.select("mix_id", "total_tokens").collect()}
    by: dict = {}
    for r in targets.select("mix_id", "source", F.col("target_share").cast("decimal(18,9)").alias("share"), "max_repeat").collect():
        if r.mix_id in totals:
            by.setdefault(r.mix_id, {})[r.source] = r
    rows = []
    for mix_id, members in sorted(by.items()):
        total = totals[mix_id]
        members = [members[s] for s in sorted(members, key=str)]
        shares = [max(Decimal(0), m.share or Decimal(0)) for m in members]
        capacity = [have.get(m.source, (0, 0))[1] * int(m.max_repeat or 0) for m in members]
        given = water_fill(shares, capacity, total)
        for m, s, c, g in zip(members, shares, capacity, given):
            n, tokens = have.get(m.source, (0, 0))
            whole = min(int(m.max_repeat or 0), int(g // tokens)) if tokens else 0
            reason = "short" if c < s * total else "raised" if g > float(s * total) + 1e-6 else "met"
            rows.append((mix_id, m.source, float(s), int(m.max_repeat or 0), total, n, tokens, c, float(s * total), int(round(g)), whole, max(0, int(round(g)) - whole * tokens), reason))
    schema = "mix_id int, source string, target_share double, max_repeat int, total_tokens bigint, documents bigint, available_tokens bigint, capacity bigint, target_tokens double, planned_tokens bigint, whole int, fraction_tokens bigint, reason string"
    return spark.createDataFrame(rows, schema)


def mixture(sized: DataFrame, planned: DataFrame, seed: int = 0) -> DataFrame:
    """(mix_id, source, doc_id, n_tokens, repeats): how often each document is taken.

    A document is taken ``whole`` times, and once more where the running sum of
    tokens in the seeded order stays within the source's fraction. The running
    sum is made over bins of the order first; only one bin of each source is
    sorted.
    """
    p = F.broadcast(planned.where("planned_tokens > 0").select("mix_id", "source", "whole", "fraction_tokens"))
    docs = sized.where("n_tokens > 0").join(p, "source")
    docs = docs.withColumn("u", F.xxhash64(F.lit(seed), "mix_id", "doc_id").bitwiseAND(F.lit((1 << 62) - 1)))
    docs = docs.withColumn("bin", F.shiftright("u", 50).cast("int"))
    bins = docs.where("fraction_tokens > 0").groupBy("mix_id", "source", "bin").agg(F.sum("n_tokens").alias("t"))
    before = F.coalesce(F.sum("t").over(Window.partitionBy("mix_id", "source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # at most BINS rows for each of the planned pairs
    bins = bins.withColumn("before", before).select("mix_id", "source", "bin", "t", "before")
    docs = docs.join(F.broadcast(bins), ["mix_id", "source", "bin"], "left")
    full = F.coalesce(F.col("before") + F.col("t") <= F.col("fraction_tokens"), F.lit(False))
    cross = F.coalesce((F.col("before") < F.col("fraction_tokens")) & ~full, F.lit(False))
    ordered = Window.partitionBy("mix_id", "source").orderBy("u", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    out = ["mix_id", "source", "doc_id", "n_tokens", "repeats"]
    plain = docs.where(~cross).withColumn("repeats", F.col("whole") + full.cast("int")).select(*out)
    last = docs.where(cross).withColumn("sum", F.col("before") + F.sum("n_tokens").over(ordered))
    last = last.withColumn("repeats", F.col("whole") + (F.col("sum") <= F.col("fraction_tokens")).cast("int")).select(*out)
    return plain.unionAll(last).where("repeats > 0")


def reached(planned: DataFrame, mixed: DataFrame) -> DataFrame:
    """The plan with the tokens and the shares that were reached."""
    got = mixed.groupBy("mix_id", "source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("documents_taken"), F.max("repeats").alias("most_repeats"))
    total = got.groupBy("mix_id").agg(F.sum("tokens").alias("mix_tokens"))
    out = planned.join(got, ["mix_id", "source"], "left").join(total, "mix_id", "left")
    return out.select("mix_id", "source", "target_share", "max_repeat", "total_tokens", "available_tokens", "planned_tokens", "reason", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents_taken", F.lit(0)).alias("documents_taken"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), F.coalesce(F.col("tokens") / F.col("mix_tokens"), F.lit(0.0)).alias("actual_share"))
