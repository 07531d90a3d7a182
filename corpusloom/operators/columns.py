"""Words with boxes put into lines and columns.

words: doc_id, page, x0, x1, top, text. A page is the largest group any of
these sees. NULL boxes are left out; a page without words has no lines.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PAGE = ["doc_id", "page"]


def center_gaps(words: DataFrame, width: float = 250.0, least: float = 55.0) -> DataFrame:
    """(doc_id, page, split): where the centres of words leave a wide gap near the middle of a page.

    The gap is four times the median one, a fifth of the words stand on either
    side, and it lies within the middle 40 % of the page.
    """
    c = words.where("x0 is not null and x1 is not null").withColumn("c", (F.col("x0") + F.col("x1")) / 2)
    w = Window.partitionBy(*PAGE).orderBy("c")
    c = c.withColumns({"gap": F.lead("c").over(w) - F.col("c"), "left": F.row_number().over(w)})
    g = c.groupBy(*PAGE).agg(F.count("*").alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi"), F.median(F.when(F.col("gap") > 0, F.col("gap"))).alias("median"), F.max_by(F.struct("c", "gap", "left"), F.struct("gap", -F.col("left"))).alias("b"))
    g = g.withColumn("split", F.col("b.c") + F.col("b.gap") / 2).withColumn("side", F.greatest(F.lit(4), F.floor(F.col("n") * 0.2)))
    span = F.col("hi") - F.col("lo")
    ok = (F.col("n") >= 12) & (span >= width) & (F.col("b.gap") >= F.greatest(F.lit(least), F.col("median") * 4)) & (F.col("b.left") >= F.col("side")) & (F.col("n") - F.col("b.left") >= F.col("side"))
    return g.where(ok & F.col("split").between(F.col("lo") + span * 0.3, F.col("lo") + span * 0.7)).select(*PAGE, "split")


def _gutter(x0: np.ndarray, x1: np.ndarray, least: int = 40, width: float = 250.0) -> float | None:
    """Where the fewest words cover the middle of a page, if that is a gutter."""
    keep = x1 > x0
    x0, x1 = x0[keep], x1[keep]
    if len(x0) < least:
        return None
    centers, left = (x0 + x1) / 2, x0.min()
    span = x1.max() - left
    if np.ptp(centers) < width or span < width:
        return None
    # covered units as a difference array
    n = int(span) + 2
    a = np.clip((x0 - left).astype(int), 0, None)
    b = np.minimum((x1 - left).astype(int), n)
    cover = np.cumsum(np.bincount(a, minlength=n + 1) - np.bincount(np.maximum(b, a + 1), minlength=n + 1)[: n + 1])[:n]
    lo, hi = int(span * 0.3), int(span * 0.7)
    at = lo + int(cover[lo:hi].argmin())
    split, side = float(left + at), max(4, int(len(x0) * 0.2))
    balanced = side <= (centers < split).sum() <= len(x0) - side
    crossing = ((x0 < split) & (split < x1)).sum()
    good = cover[at] <= max(2, 0.12 * cover[lo:hi].max()) and balanced and crossing <= max(3, int(len(x0) * 0.03))
    return split if good else None


def gutters(words: DataFrame) -> DataFrame:
    """(doc_id, page, split): the gutter of pages of two columns, from what the words cover."""

    def find(frame: pd.DataFrame) -> pd.DataFrame:
        split = _gutter(frame["x0"].to_numpy(float), frame["x1"].to_numpy(float))
        return pd.DataFrame({"doc_id": frame["doc_id"].iloc[:1], "page": frame["page"].iloc[:1], "split": [split]}) if split is not None else pd.DataFrame({"doc_id": [], "page": [], "split": []})

    return words.where("x0 is not null and x1 is not null").groupBy(*PAGE).applyInPandas(find, "doc_id bigint, page int, split double")


def _bands(tops: np.ndarray, tolerance: float) -> np.ndarray:
    """Band of every word of a page in order of top: a word joins the open band while it is near its median."""
    out, band = np.zeros(len(tops), dtype=int), []
    n = 0
    for i, t in enumerate(tops):
        if band and abs(t - float(np.median(band))) > tolerance:
            band, n = [], n + 1
        band.append(t)
        out[i] = n
    return out


def lines_of(words: DataFrame, splits: DataFrame | None = None, tolerance: float = 2.5) -> DataFrame:
    """(doc_id, page, line, column, top, text): words gathered into lines, the left column first where a page has two."""
    j = words.where("x0 is not null and top is not null")
    j = j.join(splits, PAGE, "left") if splits is not None else j.withColumn("split", F.lit(None).cast("double"))

    def gather(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.assign(column=((frame["x0"] + frame["x1"]) / 2 >= frame["split"]).astype(int)).sort_values(["column", "top", "x0"], kind="stable")
        rows = []
        for column, part in frame.groupby("column", sort=True):
            part = part.assign(band=_bands(part["top"].to_numpy(float), tolerance))
            for _, line in part.sort_values(["band", "x0"], kind="stable").groupby("band", sort=True):
                rows.append((frame["doc_id"].iloc[0], frame["page"].iloc[0], len(rows), int(column), float(line["top"].min()), " ".join(line["text"].fillna("").astype(str))))
        return pd.DataFrame(rows, columns=["doc_id", "page", "line", "column", "top", "text"])

    return j.select(*PAGE, "x0", "x1", "top", "text", "split").groupBy(*PAGE).applyInPandas(gather, "doc_id bigint, page int, line int, column int, top double, text string")
