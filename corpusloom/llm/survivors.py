"""Best representative of each group of duplicate records.

Groups are the connected components over shared keys. Each group keeps one
surviving record by a fixed order, and every field gets the value of maximum
posterior: the accuracies of sources and their dependence are estimated
together, sources that share false values are taken for copies of each other,
and of two such sources the less accurate one loses the vote it may have copied.

Defined results: NULL, empty and zero values are missing and never win; NULL
keys link nothing; of equal posteriors the value of the newest record wins,
then the smaller value; of a record given twice the one with the newest mtime,
then the greater values counts; records without a site are claims of one unnamed
source; groups of one record are left out; an empty table gives an empty result.
Further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.components import components
from corpusloom.session import stage

#: Fields with values to fuse; the site is who says them and no claim itself.
FIELDS = ("mtime", "size", "page_count", "title_key", "first_text_hash")
COLUMNS = ("pdf_id", "path", "journal_domain", "sha256", "title_key", "first_text_hash", "page_count", "mtime", "size")


def file_stem(path):
    """File name without directory, extension and one trailing hyphen and number."""
    name = F.regexp_replace(path, r"^.*/", "")
    return F.regexp_replace(F.regexp_replace(name, r"\.[A-Za-z0-9]{1,5}$", ""), r"-[0-9]+$", "")


def record_keys(records: DataFrame) -> DataFrame:
    """(pdf_id, key): the keys through which a record may meet its copies."""
    filled = lambda c: c.isNotNull() & (F.trim(c) != "")
    sha, title, text = F.col("sha256"), F.col("title_key"), F.col("first_text_hash")
    site, stem = F.col("journal_domain"), file_stem(F.col("path"))
    keys = F.array(
        F.when(filled(sha), F.concat(F.lit("s\x00"), F.lower(sha))),
        F.when(title.isNotNull() & text.isNotNull(), F.concat(F.lit("t\x00"), title, F.lit("\x00"), text)),
        F.when(site.isNotNull() & filled(stem), F.concat(F.lit("f\x00"), site, F.lit("\x00"), stem)),
    )
    return records.select("pdf_id", F.explode(keys).alias("key")).where("key is not null")


def duplicate_groups(records: DataFrame) -> DataFrame:
    """(pdf_id, first_id) of all records that have a copy.

    Keys travel as 128-bit hashes; a key shared by n records gives n - 1 edges
    to its smallest record, found by an aggregate that combines before the
    shuffle.
    """
    keys = record_keys(records).select("pdf_id", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(7), "key").alias("k2"))
    keys = stage(keys, "keys")
    low = keys.groupBy("k1", "k2").agg(F.min("pdf_id").alias("low"), F.max("pdf_id").alias("high")).where("low < high").drop("high")
    edges = keys.join(low, ["k1", "k2"]).where("pdf_id > low").select(F.col("pdf_id").alias("src"), F.col("low").alias("dst"))
    return components(edges).select(F.col("id").alias("pdf_id"), F.col("root").alias("first_id"))


def canonical(members: DataFrame) -> DataFrame:
    """(first_id, canonical_id): newest, then larger, then more pages, then smaller path."""
    # max of a struct combines before the shuffle; the path is compared apart, since the smaller one wins
    whole = F.struct(F.coalesce("mtime", F.lit(float("-inf"))), F.coalesce("size", F.lit(0)), F.coalesce("page_count", F.lit(0)))
    best = members.groupBy("first_id").agg(F.max(whole).alias("best"), F.count("*").alias("n_records"))
    tied = members.join(best, "first_id").where(whole == F.col("best"))
    return tied.groupBy("first_id").agg(F.min(F.struct(F.coalesce("path", F.lit("\U0010ffff")), "pdf_id")).alias("w"), F.first("n_records").alias("n_records")).select("first_id", F.col("w.pdf_id").alias("canonical_id"), "n_records")


def _units(x):
    """A number as whole billionths: sums of whole numbers do not depend on their order."""
    return F.round(x * 1e9).cast("bigint")


def _hashed(*columns: str) -> list:
    return [F.xxhash64(*columns).alias("s1"), F.xxhash64(F.lit(7), *columns).alias("s2")]


def _pairs(sets: DataFrame, *more: str) -> DataFrame:
    """The unordered pairs (x, y), x < y, of the sources of every distinct set."""
    rest = lambda i: F.slice("sources", i + 2, F.size("sources"))
    each = F.flatten(F.transform("sources", lambda x, i: F.transform(rest(i), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    return sets.select(*more, F.explode(each).alias("p")).select(*more, "p.x", "p.y")


def claims_of(members: DataFrame) -> DataFrame:
    """(first_id, field, value, sources, newest): who says what; the votes of one source for one value count once."""
    good = lambda c: F.when(~c.cast("string").isin("", "0", "0.0"), c.cast("string"))
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), good(F.col(f)).alias("value")) for f in FIELDS])
    each = members.select("first_id", F.coalesce("journal_domain", F.lit("")).alias("source"), F.col("mtime").alias("seen"), F.explode(pairs).alias("c")).where("c.value is not null")
    # a set of sources is at most all sites there are, however many records a group has
    return each.groupBy("first_id", "c.field", "c.value").agg(F.sort_array(F.collect_set("source")).alias("sources"), F.max("seen").alias("newest"))


def fuse(members: DataFrame, rounds: int = 4, false_values: int = 10, copy_prior: float = 0.2, copy_rate: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(first_id, field, value, posterior) and (field, source, a), the accuracies: Bayesian fusion with copy detection.

    ``members`` has first_id, the fields and journal_domain as the source; a
    source may be accurate in one field and a copier in another. The score of a
    value depends on the set of its sources alone, and the posterior
    of an item's values on the multiset of these sets. The rounds therefore run
    over distinct sets and distinct multisets with their counts, however many
    records stand behind them, and dependence is counted for every pair of
    sources of a set. Sums are of whole numbers, so that the result depends
    neither on the order nor on the partition of the rows.
    """
    item, key, who, two = ["first_id", "field"], ["s1", "s2"], ["field", "source"], ["field", "x", "y"]
    told = stage(claims_of(members).select(*item, "value", "newest", *_hashed("field", "sources"), "sources"), "claims")
    sets = stage(told.groupBy(*key).agg(F.first("field").alias("field"), F.first("sources").alias("sources")), "sets")
    # (item, set, n): how many of its values have this set; the multiset of an item by a hash of its rows that no order changes
    held = told.groupBy(*item, *key).agg(F.count("*").alias("n"))
    mixed = lambda seed: F.sum(F.xxhash64(F.lit(seed), "s1", "s2", "n").cast("decimal(38,0)"))
    held = stage(held, "held")
    items = held.groupBy(*item).agg(mixed(1).alias("g1"), mixed(2).alias("g2"))
    kinds = items.groupBy("g1", "g2").agg(F.min(F.struct(*item)).alias("r"), F.count("*").alias("items"))
    rows = stage(held.join(kinds.select("g1", "g2", "items", "r.first_id", "r.field"), item).select("g1", "g2", "items", *key, "n"), "kinds")
    each = sets.select(*key, "field", F.explode("sources").alias("source"))
    twos = stage(_pairs(sets.where("size(sources) > 1"), *key, "field"), "pairs")
    # items on which both of two sources say something
    met = rows.join(each, key).groupBy("g1", "g2", "field").agg(F.sort_array(F.collect_set("source")).alias("sources"), F.first("items").alias("items"))
    met = _pairs(met.groupBy("field", "sources").agg(F.sum("items").alias("items")), "field", "items").groupBy(*two).agg(F.sum("items").alias("met"))
    met = stage(met.join(twos.select(*two).distinct(), two), "met")
    accuracy = each.select(*who).distinct().withColumn("a", F.lit(0.8))
    copies = None
    a_of = lambda name, a: accuracy.select("field", F.col("source").alias(name), F.col("a").alias(a))
    known = lambda df: df.join(a_of("x", "ax"), ["field", "x"]).join(a_of("y", "ay"), ["field", "y"])
    for last in [False] * (rounds - 1) + [True]:
        votes, vote = each.join(accuracy, who), F.log(F.lit(false_values) * F.col("a") / (1 - F.col("a")))
        if copies is not None:
            # of two dependent sources the less accurate one loses what it may have copied
            lost = known(twos.join(copies, two))
            lost = lost.select(*key, F.when(F.struct("ay", "x") < F.struct("ax", "y"), F.col("y")).otherwise(F.col("x")).alias("source"), _units(F.log(1 - copy_rate * F.col("dep"))).alias("u"))
            votes = votes.join(lost.groupBy(*key, "source").agg(F.sum("u").alias("u")), [*key, "source"], "left")
            vote = vote * F.exp(F.coalesce("u", F.lit(0)) / 1e9)
        scores = votes.groupBy(*key).agg((F.sum(_units(vote)) / 1e9).alias("score"))
        scored = rows.join(scores, key)
        scored = scored.join(scored.groupBy("g1", "g2").agg(F.max("score").alias("top")), ["g1", "g2"]).withColumn("e", _units(F.exp(F.col("score") - F.col("top"))))
        whole = scored.groupBy("g1", "g2").agg(F.sum(F.col("e") * F.col("n")).alias("whole"))
        scored = scored.join(whole, ["g1", "g2"]).select("g1", "g2", "items", *key, "n", F.round(F.col("e") / F.col("whole"), 9).alias("p"))
        if last:
            scored = stage(scored, "posterior")
        # of every set: how many of its values there are, their posteriors, and how many are taken for true
        many = F.col("items") * F.col("n")
        by_set = stage(scored.groupBy(*key).agg(F.sum(many).alias("n"), F.sum(many * _units(F.col("p")).cast("decimal(38,0)")).alias("u"), F.sum(F.when(F.col("p") >= 0.5, many).otherwise(0)).alias("kt")), "sets-told")
        # the mean posterior of a source's claims, drawn to 0.8 as by ten claims
        mean = (F.sum("u").cast("double") / 1e9 + 8) / (F.sum("n") + 10)
        accuracy = stage(each.join(by_set, key).groupBy(*who).agg(F.round(F.least(F.lit(0.99), F.greatest(F.lit(0.05), mean)), 9).alias("a")), "accuracy")
        if last:
            break
        shared = twos.join(by_set, key).groupBy(*two).agg(F.sum("kt").alias("kt"), F.sum(F.col("n") - F.col("kt")).alias("kf")).join(met, two)
        shared = known(shared)
        kd, high = F.greatest(F.lit(0), F.col("met") - F.col("kt") - F.col("kf")), F.greatest("ax", "ay")
        pt, pf, c = F.col("ax") * F.col("ay"), (1 - F.col("ax")) * (1 - F.col("ay")) / float(false_values), copy_rate
        log_odds = F.col("kt") * F.log(pt / (c * high + (1 - c) * pt)) + F.col("kf") * F.log(pf / (c * (1 - high) + (1 - c) * pf)) + kd * F.log(F.lit(1 / (1 - c)))
        # only shared false values speak for copying; agreeing on the truth is what good sources do
        dep = 1 / (1 + (1 - copy_prior) / copy_prior * F.exp(F.least(F.greatest(log_odds, F.lit(-60.0)), F.lit(60.0))))
        copies = shared.where("kf > 0").select(*two, F.round(dep, 9).alias("dep")).where("dep > 0")
    final = told.join(items, item).join(scored.select("g1", "g2", *key, "p"), ["g1", "g2", *key])
    # the best value by aggregates, which combine before the shuffle, since a group may hold a third of all records
    rank = F.struct("p", F.coalesce("newest", F.lit(float("-inf"))))
    best = final.groupBy(*item).agg(F.max(rank).alias("best"))
    return final.join(best, item).where(rank == F.col("best")).groupBy(*item).agg(F.min("value").alias("value"), F.max("p").alias("posterior")), accuracy


def survivors(records: DataFrame) -> DataFrame:
    """One row per group: first_id, canonical_id, n_records, the fused fields, the most accurate of its sites and the least posterior."""
    every = F.struct("mtime", "size", *[c for c in COLUMNS if c not in ("pdf_id", "mtime", "size")])
    records = records.groupBy("pdf_id").agg(F.max(every).alias("r")).select("pdf_id", "r.*")
    members = stage(records.join(duplicate_groups(records), "pdf_id"), "members")
    fused, accuracy = fuse(members)
    kinds = dict(members.dtypes)
    wide = fused.groupBy("first_id").agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).cast(kinds[f]).alias(f) for f in FIELDS], F.min("posterior").alias("least_posterior"))
    sites = members.where("journal_domain <> ''").select("first_id", F.col("journal_domain").alias("source")).distinct().join(accuracy.groupBy("source").agg((F.sum(_units(F.col("a"))) / F.count("*")).alias("a")), "source")
    sites = sites.groupBy("first_id").agg(F.max(F.struct("a", "source")).alias("s")).select("first_id", F.col("s.source").alias("journal_domain"))
    return canonical(members).join(wide, "first_id", "left").join(sites, "first_id", "left")
