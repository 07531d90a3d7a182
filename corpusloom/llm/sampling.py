"""Samples whose shares of each category match given proportions.

Inclusion probabilities are calibrated by Newton iterations on the dual of
exponential tilting, over category moments that are counted distributedly once
(a cell per plan and category, so that an iteration touches a few hundred
cells); units are then drawn by the pivotal method in blocks. Floors are part
of the targets, what a category cannot give goes to the others in proportion,
and every target that could not be met is reported.

Defined results: a category written differently in case, spaces or punctuation
is the same one; units without a category or with one that has no target are
not drawn; of several rows of a unit the newest that names a category counts
(then the smaller name); a NULL or negative target counts as zero; an empty
table gives an empty sample and a report of the targets it misses.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Units of one block of the pivotal method.
BLOCK = 20_000


def family_key(c: Column) -> Column:
    """Category in one spelling; NULL where nothing is left of it."""
    k = F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "")
    return F.when(k != "", k)


def units(stats: DataFrame) -> DataFrame:
    """(pdf_id, fam): one row per PDF that some row names a family of."""
    rows = stats.select("pdf_id", family_key(F.col("platform_family")).alias("fam"), "evaluated_at").where("pdf_id is not null and fam is not null")
    newest = F.max_by("fam", F.struct(F.coalesce(F.col("evaluated_at").cast("timestamp"), F.lit("0001-01-01").cast("timestamp")), "fam"))
    return rows.groupBy("pdf_id").agg(newest.alias("fam"))


def newton_tilt(base: np.ndarray, size: np.ndarray, target: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, int]:
    """Tilts l with ``size * p(base * exp(l)) = target`` for p(w) = w / (1 + w).

    The dual of entropy calibration with probabilities kept inside (0, 1); its
    Hessian is diagonal for categories. Returns probabilities and iterations.
    """
    lam = np.zeros(len(base))
    full = target >= size
    goal = np.clip(target, 1e-12, np.maximum(size * (1 - 1e-12), 1e-12))
    used = 0
    for used in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-(np.log(base) + lam)))
        gradient = size * p - goal
        if np.all(np.abs(gradient[~full]) < 1e-9 * np.maximum(1, goal[~full])):
            break
        hessian = np.maximum(size * p * (1 - p), 1e-12)
        lam = lam - np.clip(gradient / hessian, -2, 2)
    p = np.where(full, 1.0, 1 / (1 + np.exp(-(np.log(base) + lam))))
    return np.where(size > 0, np.where(target <= 0, 0.0, p), 0.0), used


def set_targets(share: np.ndarray, available: np.ndarray, size: int, floor: int) -> np.ndarray:
    """Whole targets: floors first, then shares of the rest, within what exists.

    Excess of a category that has too few goes to the others in proportion.
    """
    low = np.minimum(np.where(share > 0, floor, 0), available).astype(float)
    size = min(size, int(available[share > 0].sum())) if (share > 0).any() else 0
    if low.sum() >= size:
        # floors alone exceed the sample: shrink them evenly, largest rest first
        want = low * (size / low.sum()) if low.sum() else low
    else:
        want, fixed = np.zeros(len(share)), share <= 0
        for _ in range(len(share) + 1):
            rest = size - want[fixed].sum()
            open_share = share[~fixed].sum()
            if open_share <= 0:
                break
            want[~fixed] = share[~fixed] / open_share * rest
            over, under = ~fixed & (want > available), ~fixed & (want < low)
            # excess and shortfall are settled on the side that outweighs, as in water-filling
            if not over.any() and not under.any():
                break
            if (want - available)[over].sum() >= (low - want)[under].sum():
                want[over], fixed = available[over], fixed | over
            else:
                want[under], fixed = low[under], fixed | under
    whole = np.floor(want + 1e-9)
    order = np.lexsort((np.arange(len(want)), -(want - whole)))
    for i in order[: max(0, int(round(size - whole.sum())))]:
        whole[i] += whole[i] < available[i]
    return whole


def shortfalls(family: list, have: np.ndarray, size: int, floor: int) -> np.ndarray:
    """By how much each row misses its own floor and share where the calibration has taken all that exists.

    The rows are calibrated to what they ask for, not to what can be had: the
    tilt of one that asks for more than exists ends at probability 1, and what
    its probabilities then sum to falls short.
    """
    want = np.array([max(float(floor), float((f.target_share or 0) * size)) for f in family])
    p, _ = newton_tilt(np.full(len(have), max(size, 1) / max(have.sum(), 1)), have, want)
    gap = want - have * p
    return np.where(gap > 4e-9 * np.maximum(1, want), gap, 0.0)


def calibrate(stats: DataFrame, configs: DataFrame, targets: DataFrame) -> DataFrame:
    """Report, one row per plan and row of its targets.

    config_id, platform_family, target_share, sample_size, floor_per_family,
    seed, available, target (share x size), planned, probability, gap (see
    ``shortfalls``), reason: ``below_floor`` / ``below_target`` where the
    calibration leaves a gap,
    ``raised`` / ``lowered`` where others' floors or gaps moved the plan, else
    ``met``. Spellings of one family are calibrated as one with the sum of their
    shares: available, planned and probability are the family's in each of its
    rows, target the row's own. A row that names no family has no units. Plans
    and targets are configuration; only they and the counts per
    family come to the driver.
    """
    spark = stats.sparkSession
    wanted = targets.select("config_id", "platform_family", family_key(F.col("platform_family")).alias("fam"), F.col("target_share").cast("decimal(18,9)").alias("target_share"))
    counts = units(stats).groupBy("fam").agg(F.count("*").alias("available"))
    counts = wanted.select("fam").distinct().join(counts, "fam")
    available = {r.fam: r.available for r in counts.collect()}
    plans = {r.config_id: r for r in configs.select("config_id", "sample_size", "floor_per_family", "seed").collect()}
    rows = []
    cells: dict = {}
    for r in wanted.collect():
        cells.setdefault(r.config_id, []).append(r)
    for config_id, family in sorted(cells.items(), key=lambda x: str(x[0])):
        if config_id not in plans:
            continue
        plan = plans[config_id]
        size, floor = int(plan.sample_size or 0), int(plan.floor_per_family or 0)
        merged: dict = {}
        for f in family:
            if f.fam:
                merged[f.fam] = merged.get(f.fam, 0) + max(0, f.target_share or 0)
        keys = sorted(merged)
        share = np.array([float(merged[k]) for k in keys])
        have = np.array([available.get(k, 0) for k in keys], dtype=float)
        planned = set_targets(share, have, size, floor)
        p, _ = newton_tilt(np.full(len(have), max(size, 1) / max(have.sum(), 1)), have, planned)
        of = {k: (int(h), int(n), float(q)) for k, h, n, q in zip(keys, have, planned, p)}
        family = sorted(family, key=lambda r: (r.fam or "", r.platform_family or ""))
        gaps = shortfalls(family, np.array([of.get(f.fam, (0,))[0] for f in family], dtype=float), size, floor)
        for f, gap in zip(family, gaps):
            h, n, q = of.get(f.fam, (0, 0, 0.0))
            target, whole = (f.target_share or 0) * size, merged.get(f.fam, 0) * size
            reason = ("below_floor" if h < floor else "below_target") if gap > 0 else "raised" if n >= whole + 1 else "lowered" if n <= whole - 1 else "met"
            rows.append((config_id, f.platform_family, f.fam, float(f.target_share or 0), size, floor, int(plan.seed or 0), h, float(target), n, q, float(gap), reason))
    schema = "config_id int, platform_family string, fam string, target_share double, sample_size int, floor_per_family int, seed bigint, available bigint, target double, planned int, probability double, gap double, reason string"
    return spark.createDataFrame(rows, schema)


def _pivotal(frame: pd.DataFrame) -> pd.DataFrame:
    """Sequential pivotal draws over the rows in order of ``u``; columns unit, p, u, v.

    Each duel leaves one unit decided; at most one stays open, and is returned
    with the probability it has then. Decided winners come with p = 1.
    """
    frame = frame.sort_values(["u", "unit"], kind="stable")
    out, last = [], None
    p, v, unit = frame["p"].to_numpy(float).copy(), frame["v"].to_numpy(float), frame["unit"].to_numpy()
    eps = 1e-9
    for i in range(len(p)):
        if p[i] >= 1 - eps:
            out.append((i, 1.0))
        elif p[i] > eps:
            if last is None:
                last = i
                continue
            a, b = p[last], p[i]
            if a + b < 1:
                winner = last if v[i] < a / (a + b) else i
                p[winner], last = a + b, winner
            else:
                chosen = last if v[i] < (1 - b) / (2 - a - b) else i
                other = i if chosen == last else last
                out.append((chosen, 1.0))
                p[other] = a + b - 1
                last = other if p[other] > eps else None
                if last is not None and p[last] >= 1 - eps:
                    out.append((last, 1.0))
                    last = None
            if last is not None and p[last] >= 1 - eps:
                out.append((last, 1.0))
                last = None
    if last is not None:
        out.append((last, p[last]))
    index = [i for i, _ in out]
    return frame.iloc[index].assign(p=[q for _, q in out]) if index else frame.iloc[:0]


def sample(stats: DataFrame, report: DataFrame, block: int = BLOCK) -> DataFrame:
    """(config_id, pdf_id, platform_family): as many units of each family as planned.

    Units are dealt by a seeded hash into blocks of about ``block`` units; each
    block runs the pivotal method and leaves at most one open unit, and the open
    units of a family meet in further rounds until one is left, which is drawn
    or not so that the family's sum stays whole.
    """
    # spellings of one family are drawn for once, under the smallest
    plan = F.broadcast(report.where("planned > 0").groupBy("config_id", "fam", "seed", "available", "planned", "probability").agg(F.min("platform_family").alias("platform_family")))
    u = units(stats).join(plan, "fam").select("config_id", "platform_family", F.col("pdf_id").alias("unit"), F.col("probability").alias("p"), "available", "seed", "planned")
    rand = lambda salt: (F.xxhash64("seed", "config_id", "unit", F.lit(salt)).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53))
    u = u.withColumn("u", rand(1)).withColumn("v", rand(2))
    schema = "config_id int, platform_family string, unit bigint, p double, u double, v double"
    blocks = F.floor(F.col("u") * F.ceil(F.col("available") / float(block))).cast("long")
    u = u.withColumn("blk", blocks)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return _pivotal(frame)[["config_id", "platform_family", "unit", "p", "u", "v"]]

    first = u.groupBy("config_id", "platform_family", "blk").applyInPandas(run, schema)
    sure = first.where("p >= 1 - 1e-9")
    # one open unit of each block: a family of 100 million units has 5,000
    rest = first.where("p < 1 - 1e-9").groupBy("config_id", "platform_family").applyInPandas(lambda f: run(f).assign(p=lambda x: np.where(x.p > 0.5, 1.0, x.p)), schema).where("p >= 1 - 1e-6")
    return sure.unionAll(rest).select("config_id", F.col("unit").alias("pdf_id"), "platform_family")
