"""Writers: lines, shards, tables with manifests, renderings of small aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def append_lines(df: DataFrame, path: str) -> None:
    """JSON lines with the columns in order of their names."""
    df.select(*sorted(df.columns)).write.mode("append").json(path)


def replace_lines(df: DataFrame, path: str, compressed: bool = False) -> None:
    w = df.write.mode("overwrite")
    (w.option("compression", "gzip") if compressed else w).json(path)


def shards(df: DataFrame, path: str, rows: int = 100_000) -> None:
    """Parquet with zstd, files of at most ``rows`` rows."""
    df.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows).parquet(path)


def new_only(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key was not handled before; a NULL key never was."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def export(df: DataFrame, path: str, by: str) -> DataFrame:
    """Compressed JSON lines, and the manifest: rows by ``by`` and in all."""
    replace_lines(df, path, compressed=True)
    back = df.sparkSession.read.schema(df.schema).json(path)
    return back.groupBy(F.coalesce(F.col(by).cast("string"), F.lit("")).alias("value")).agg(F.count("*").alias("rows")).unionAll(back.select(F.lit("*").alias("value")).groupBy("value").agg(F.count("*").alias("rows")))


def joined_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; lists joined with a bar."""
    flat = [F.array_join(c, "|").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def markdown(df: DataFrame, title: str, rows: int) -> str:
    """A table of a small aggregate; ``rows`` is the size of the report."""
    head = f"# {title}\n\n| {' | '.join(df.columns)} |\n|{'---|' * len(df.columns)}\n"
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    return head + "".join(f"| {' | '.join(cell(v) for v in r)} |\n" for r in df.limit(rows).collect())


def within_bytes(df: DataFrame, size: str, newest: str, key: str, cap: int) -> DataFrame:
    """The newest entries that fit into ``cap`` bytes together; older ones are what a cache evicts.

    Sums are made by day first, so that the running sum over entries is sorted
    only within the day in which the cap is reached.
    """
    d = df.withColumn("_day", F.to_date(newest))
    days = d.groupBy("_day").agg(F.sum(size).alias("_bytes"))
    # one row per day
    days = days.withColumn("_before", F.coalesce(F.sum("_bytes").over(Window.orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    d = d.join(days, "_day")
    run = F.col("_before") + F.sum(size).over(Window.partitionBy("_day").orderBy(F.desc(newest), key).rowsBetween(Window.unboundedPreceding, 0))
    whole = d.where(F.col("_before") + F.col("_bytes") <= cap)
    part = d.where((F.col("_before") <= cap) & (F.col("_before") + F.col("_bytes") > cap)).withColumn("_run", run).where(F.col("_run") <= cap).drop("_run")
    return whole.unionAll(part).select(*df.columns)
