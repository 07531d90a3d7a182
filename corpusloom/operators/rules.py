"""Rules as data: conditions over columns that give reasons, guards, confidence and verdicts.

A rule is (name, column, op, value) with a confidence or as a guard; rules come
from code or from JSON and become one expression, so that no row meets a table
of rules. NULL fulfils no condition. No rules, no reasons.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPS = {
    "matches": lambda c, v: c.rlike(v), "lacks": lambda c, v: ~c.rlike(v), "less": lambda c, v: c < v, "more": lambda c, v: c > v, "is": lambda c, v: c == v, "in": lambda c, v: c.isin(*v),
    "empty": lambda c, v: F.coalesce(F.trim(c.cast("string")), F.lit("")) == "", "filled": lambda c, v: F.coalesce(F.trim(c.cast("string")), F.lit("")) != "",
}


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    op: str
    value: object = None
    confidence: float = 1.0
    guard: bool = False

    def holds(self) -> Column:
        return F.coalesce(OPS[self.op](F.col(self.column), self.value), F.lit(False))


def load_rules(text: str | None) -> list[Rule]:
    """Rules from a JSON list of objects; nothing for an empty or missing text, an error for an unknown operation."""
    rules = [Rule(**r) for r in json.loads(text)] if text and text.strip() else []
    for r in rules:
        if r.op not in OPS:
            raise ValueError(f"rule {r.name}: no operation {r.op}")
    return rules


def reasons(rules: list[Rule], default: str | None = None) -> Column:
    """Names of the rules that hold, sorted and each once; ``default`` alone where none does."""
    if not rules:
        return F.array(F.lit(default)) if default else F.array().cast("array<string>")
    held = F.array_sort(F.array_distinct(F.filter(F.array(*[F.when(r.holds(), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())))
    return F.when(F.size(held) == 0, F.array(F.lit(default))).otherwise(held) if default else held


def confidence(rules: list[Rule]) -> Column:
    """The greatest confidence of the rules that hold, 0 without one."""
    return F.greatest(F.lit(0.0), F.lit(0.0), *[F.when(r.holds(), F.lit(float(r.confidence))).otherwise(0.0) for r in rules])


def judged(rows: DataFrame, rules: list[Rule], least: float = 0.98) -> DataFrame:
    """rows with reasons, guards, confidence and ``excluded``: a reason, no guard, and the confidence that is asked for."""
    plain, guards = [r for r in rules if not r.guard], [r for r in rules if r.guard]
    out = rows.withColumns({"reasons": reasons(plain), "guards": reasons(guards), "confidence": confidence(plain)})
    return out.withColumn("excluded", (F.size("reasons") > 0) & (F.size("guards") == 0) & (F.col("confidence") >= least))


def first_case(cases: list[tuple[str, list[Rule]]], default: str) -> Column:
    """The name of the first case all rules of which hold."""
    out = None
    for name, rules in cases:
        every = F.lit(True)
        for r in rules:
            every = every & r.holds()
        out = F.when(every, name) if out is None else out.when(every, name)
    return F.lit(default) if out is None else out.otherwise(default)


def first_valid(rows: DataFrame, key: str, order: list[str], valid: Column) -> DataFrame:
    """rows with ``state``: ``invalid``, ``first`` of the valid ones of its key, or ``repeated``."""
    ok = F.coalesce(valid, F.lit(False))
    at = F.row_number().over(Window.partitionBy(key, "_ok").orderBy(*order))
    return rows.withColumn("_ok", ok).withColumn("state", F.when(~F.col("_ok"), "invalid").when(at == 1, "first").otherwise("repeated")).drop("_ok")


def overridden(rows: DataFrame, levels: list[tuple[DataFrame, str]], value: str, default: float, low: float, high: float) -> DataFrame:
    """rows with ``value`` from the first table (key, value) that has one for the row's key, within bounds; ``default`` else."""
    out, found = rows, []
    for i, (values, key) in enumerate(levels):
        one = values.groupBy(key).agg(F.max(value).alias(f"_v{i}"))
        out = out.join(one, key, "left")
        found.append(F.col(f"_v{i}"))
    return out.withColumn(value, F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce(*found, F.lit(default))))).drop(*[f"_v{i}" for i in range(len(levels))])
