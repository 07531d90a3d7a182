"""Scores of predicted notes and labels against others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import tokens, unified


def prf(tp: Column, fp: Column, fn: Column) -> list[Column]:
    """precision, recall and f1, four digits; 0 where nothing is there to divide by."""
    safe = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    p, r = safe(tp, tp + fp), safe(tp, tp + fn)
    return [F.round(p, 4).alias("precision"), F.round(r, 4).alias("recall"), F.round(safe(2 * p * r, p + r), 4).alias("f1")]


def multiset_counts(gold: DataFrame, pred: DataFrame, group: list[str], key: list[str]) -> DataFrame:
    """(group, tp, fp, fn) of two multisets of keys: counts meet key by key, no lists are compared."""
    one = lambda df, g, p: df.select(*group, *key, F.lit(g).alias("g"), F.lit(p).alias("p"))
    n = one(gold, 1, 0).unionAll(one(pred, 0, 1)).groupBy(*group, *key).agg(F.sum("g").alias("g"), F.sum("p").alias("p"))
    sums = [F.sum(F.least("g", "p")).alias("tp"), F.sum(F.greatest(F.col("p") - F.col("g"), F.lit(0))).alias("fp"), F.sum(F.greatest(F.col("g") - F.col("p"), F.lit(0))).alias("fn")]
    return n.groupBy(*group).agg(*sums)


def label_scores(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """Per document: precision and recall of labels, and whether they come in the same order.

    gold, pred: pdf_id, label, seq.
    """
    c = multiset_counts(gold, pred, ["pdf_id"], ["label"])
    place = lambda df, name: df.select("pdf_id", F.row_number().over(Window.partitionBy("pdf_id").orderBy("seq")).alias("i"), F.col("label").alias(name))
    j = place(gold, "a").join(place(pred, "b"), ["pdf_id", "i"], "full_outer").groupBy("pdf_id").agg(F.min(F.coalesce((F.col("a") == F.col("b")).cast("int"), F.lit(0))).alias("same"))
    return c.join(j, "pdf_id").select("pdf_id", "tp", "fp", "fn", *prf(F.col("tp"), F.col("fp"), F.col("fn")), (F.col("same") == 1).alias("same_order"))


def failure_taxonomy(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """(pdf_id, failure): missing, extra, repeated or unordered labels of a document."""
    s = label_scores(gold, pred)
    twice = pred.groupBy("pdf_id", "label").count().groupBy("pdf_id").agg(F.max("count").alias("most"))
    s = s.join(twice, "pdf_id", "left")
    kinds = F.array(F.when(F.col("fn") > 0, "missing_labels"), F.when(F.col("fp") > 0, "extra_labels"), F.when(F.col("most") > 1, "repeated_labels"), F.when((F.col("fn") == 0) & (F.col("fp") == 0) & ~F.col("same_order"), "order"))
    return s.select("pdf_id", F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("failure"))


def token_scores(gold: DataFrame, pred: DataFrame, key: list[str]) -> DataFrame:
    """Token precision and recall of texts that share a key; gold, pred: key, text."""
    words = lambda df: df.select(*key, F.explode(tokens(unified(F.col("text")))).alias("token"))
    both = gold.select(*key).distinct().join(pred.select(*key).distinct(), key, "left_semi")
    c = multiset_counts(words(gold.join(both, key, "left_semi")), words(pred.join(both, key, "left_semi")), key, ["token"])
    return c.select(*key, "tp", "fp", "fn", *prf(F.col("tp"), F.col("fp"), F.col("fn")))
