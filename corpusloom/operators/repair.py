"""Repairs and checks of sequences and records."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType


def ascending_share(rows: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    """(group, steps, share): how many steps from one value to the next rise; 1 without a step."""
    w = Window.partitionBy(*group).orderBy(*order)
    s = rows.where(F.col(value).isNotNull()).withColumn("_rise", (F.col(value) > F.lag(value).over(w)).cast("int"))
    return s.groupBy(*group).agg(F.count("_rise").alias("steps"), F.round(F.coalesce(F.avg("_rise"), F.lit(1.0)), 6).alias("share"))


def rising_block(lines: DataFrame, least: float = 0.75) -> DataFrame:
    """(pdf_id, page_index, start): the first labelled line of a page from which the labels rise.

    lines: pdf_id, page_index, pos, label (NULL where a line has none). Steps
    are counted from below in one window, so no suffix is scanned twice.
    """
    page = Window.partitionBy("pdf_id", "page_index").orderBy("pos")
    below = page.rowsBetween(0, Window.unboundedFollowing)
    l = lines.where("label is not null").withColumn("rise", (F.lead("label").over(page) > F.col("label")).cast("int"))  # noqa: E741
    l = l.withColumns({"steps": F.count("rise").over(below), "good": F.coalesce(F.sum("rise").over(below), F.lit(0))})  # noqa: E741
    ok = (F.col("steps") == 0) | (F.col("good") / F.greatest(F.col("steps"), F.lit(1)) >= least)
    return l.where(ok).groupBy("pdf_id", "page_index").agg(F.min("pos").alias("start"))


def filled_labels(notes: DataFrame, group: list[str], order: list[str], label: str = "number") -> DataFrame:
    """notes with ``filled``: a missing label counts on from the last known one; before the first it stays missing."""
    w = Window.partitionBy(*group).orderBy(*order)
    n = notes.withColumn("_known", F.last(label, ignorenulls=True).over(w)).withColumn("_run", F.count(label).over(w))
    place = F.row_number().over(Window.partitionBy(*group, "_run").orderBy(*order))
    return n.withColumn("_place", place).withColumn("filled", F.when(F.col("_known").isNotNull(), F.col("_known") + F.col("_place") - 1)).drop("_known", "_run", "_place")


def collapsed_hundreds(labels: Column) -> Column:
    """Labels of a short list with 1 in it, 100..130 read as 0..30 and 0 dropped; each label once, in order; others as they are."""
    sparse = (F.size(labels) <= 8) & F.array_contains(labels, 1) & F.exists(labels, lambda v: v.between(100, 130))
    fixed = F.array_distinct(F.filter(F.transform(labels, lambda v: F.when(v.between(100, 130), v - 100).otherwise(v)), lambda v: v != 0))
    return F.when(sparse, fixed).otherwise(labels)


def sequence_quality(notes: DataFrame, status: DataFrame) -> DataFrame:
    """(pdf_id, extractor_version, score): amount and order of notes as one number.

    notes: one row per note with number and text; status: status and gaps of
    each document.
    """
    size = F.length(F.trim(F.coalesce("text", F.lit(""))))
    g = notes.groupBy("pdf_id", "extractor_version").agg(F.count("*").alias("n"), F.count("number").alias("k"), F.countDistinct("number").alias("u"), F.avg(size).alias("mean"))
    j = g.join(status, ["pdf_id", "extractor_version"])
    order = F.when(F.col("k") == 0, -80.0).when(F.col("status") == "valid", 120.0).when(F.col("status") == "valid_with_gaps", F.greatest(F.lit(40.0), 100.0 - 5.0 * F.col("gap_count"))).otherwise(-120.0)
    score = F.least("n", F.lit(400)) * 2.0 + F.least("k", F.lit(400)) * 3.0 + F.least("mean", F.lit(160.0)) * 0.1 + order - 8.0 * (F.col("k") - F.col("u"))
    return j.select("pdf_id", "extractor_version", F.round(score, 3).alias("score"))


def patched(rows: DataFrame, patches: DataFrame, key: str, fields: list[str], policy: str = "fill_missing", confidence: str | None = None) -> DataFrame:
    """rows with fields taken from patches by key.

    ``fill_missing`` sets empty fields only, ``always`` all that the patch has,
    ``higher_confidence`` those of a patch surer than the row. One patch per key
    is expected; the greatest counts of several.
    """
    has = lambda c: c.isNotNull() & (F.trim(c.cast("string")) != "")
    p = patches.groupBy(key).agg(F.max(F.struct(*([confidence] if confidence else []), *fields)).alias("_p"))
    j = rows.join(p, key, "left")
    surer = F.coalesce(F.col(f"_p.{confidence}") > F.coalesce(F.col(confidence), F.lit(0.0)), F.lit(False)) if confidence else F.lit(False)
    allowed = {"fill_missing": F.lit(False), "always": F.lit(True), "higher_confidence": surer}[policy]
    new = {f: F.when(has(F.col(f"_p.{f}")) & (~F.coalesce(has(F.col(f)), F.lit(False)) | allowed), F.col(f"_p.{f}")).otherwise(F.col(f)) for f in fields}
    return j.withColumns(new).drop("_p")


def dangling(rows: DataFrame, key: str, targets: DataFrame, target: str) -> DataFrame:
    """(key, rows): values that refer to nothing; NULL refers to nothing at all and is no error."""
    return rows.where(F.col(key).isNotNull()).join(targets.select(F.col(target).alias(key)).distinct(), key, "left_anti").groupBy(key).agg(F.count("*").alias("rows"))


def repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rows): combinations that occur more than once."""
    return rows.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def chunked(rows: DataFrame, group: str, order: list[str], key: str, size: int) -> DataFrame:
    """(group, chunk, key): rows of every group in chunks of ``size``."""
    n = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return rows.withColumn("_n", n).select(group, F.floor((F.col("_n") - 1) / size).cast("int").alias("chunk"), key)


_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def schema_errors(value, schema: dict, root: dict | None = None, path: str = "$") -> list[str]:
    """Errors of a JSON value under a subset of JSON Schema: $ref, const, enum, type, required, properties, additionalProperties, items, sizes and bounds."""
    root = root or schema
    if "$ref" in schema:
        target = root
        for part in schema["$ref"].lstrip("#/").split("/"):
            target = target[part]
        return schema_errors(value, target, root, path)
    out = []
    if "const" in schema and value != schema["const"]:
        out.append(f"{path}: is not {schema['const']!r}")
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{path}: is none of {schema['enum']!r}")
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    kinds = [schema["type"]] if isinstance(schema.get("type"), str) else schema.get("type") or []
    fits = lambda k: number and (k == "number" or float(value).is_integer()) if k in ("number", "integer") else isinstance(value, _TYPES[k])
    if kinds and not any(fits(k) for k in kinds):
        return [*out, f"{path}: is no {' or '.join(kinds)}"]
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}: lacks {k!r}" for k in schema.get("required", []) if k not in value]
        for k, v in value.items():
            if k in known:
                out += schema_errors(v, known[k], root, f"{path}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{path}.{k}: is not allowed")
    if isinstance(value, list):
        if not schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", len(value)):
            out.append(f"{path}: has {len(value)} items")
        if "items" in schema:
            for i, v in enumerate(value):
                out += schema_errors(v, schema["items"], root, f"{path}[{i}]")
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        out.append(f"{path}: is too short")
    if number and not schema.get("minimum", value) <= value <= schema.get("maximum", value):
        out.append(f"{path}: is out of bounds")
    return out


def json_errors(value: Column, schema: dict) -> Column:
    """Errors of a column of JSON texts under ``schema``, as ``schema_errors`` tells them; text that is no JSON has one."""

    @F.pandas_udf(ArrayType(StringType()))
    def check(texts: pd.Series) -> pd.Series:
        def one(text):
            if text is None:
                return []
            try:
                return schema_errors(json.loads(text), schema)
            except ValueError:
                return ["$: is no JSON"]

        return texts.map(one)

    return check(value)
