"""Streams of records of the same thing, merged field by field; routes; rules; high-water marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_ranked(rows: DataFrame, key: str, fields: list[str], rank: Column, seq: str) -> DataFrame:
    """One row per key: every field from the best-ranked row that has it, the earliest of equals.

    ``sources`` counts the ranks that took part; empty text is missing.
    """
    order = F.struct(rank, -F.col(seq))
    has = lambda c: F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.max_by(c, F.when(has(c), order)).alias(c) for c in fields], F.countDistinct(rank).alias("sources"))


def routed(rows: DataFrame, host: str, routes: DataFrame) -> DataFrame:
    """rows with ``route``: the exact route of the host, else the longest route it ends in, else ``generic``.

    routes: suffix, route; a table of configuration. Hosts meet routes by
    equality on every suffix of theirs, which are as many as their labels.
    """
    parts = F.split(F.lower(F.col(host)), r"\.")
    suffixes = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, i + 1, F.size(parts)), "."))
    hosts = rows.select(host).where(F.col(host).isNotNull()).distinct()
    each = hosts.select(host, F.posexplode(suffixes).alias("depth", "suffix")).join(F.broadcast(routes), "suffix")
    best = each.groupBy(host).agg(F.min_by("route", "depth").alias("route"))
    return rows.join(best, host, "left").withColumn("route", F.coalesce("route", F.lit("generic")))


def first_rule(rows: DataFrame, key: str, text: Column, rules: DataFrame) -> DataFrame:
    """(key, rule): the first rule in order whose pattern the text matches.

    rules: rule, position, pattern; a table of configuration. Patterns are
    columns, so that rules need no change of code.
    """
    r = rules.agg(F.sort_array(F.collect_list(F.struct("position", "rule", "pattern"))).alias("rules"))
    j = rows.select(key, text.alias("_t")).join(F.broadcast(r))
    hit = F.filter("rules", lambda x: F.regexp_like(F.coalesce("_t", F.lit("")), x["pattern"]))
    return j.select(key, F.get(hit, F.lit(0))["rule"].alias("rule")).where("rule is not null")


def high_water(base: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """(key, mark, regressed): the greater of two counts, and whether the new one fell below the old."""
    j = base.select(key, F.col(value).alias("old")).join(new.select(key, F.col(value).alias("now")), key, "full_outer")
    return j.select(key, F.greatest(F.coalesce("old", F.lit(0)), F.coalesce("now", F.lit(0))).alias("mark"), (F.coalesce("now", F.lit(0)) < F.coalesce("old", F.lit(0))).alias("regressed"))


def text_signals(text: Column) -> list[Column]:
    """Shares of letters, digits, capitals and controls of a text, and its words."""
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(t), F.lit(1))
    share = lambda pattern, name: F.round(F.length(F.regexp_replace(t, pattern, "")) / n, 6).alias(name)
    return [F.length(t).alias("chars"), share("[^A-Za-z]", "letters"), share("[^0-9]", "digits"), share("[^A-Z]", "capitals"), share(r"[^\x00-\x08\x0B\x0C\x0E-\x1F]", "controls"), F.size(F.regexp_extract_all(t, F.lit("[A-Za-z0-9]+"), F.lit(0))).alias("words")]
