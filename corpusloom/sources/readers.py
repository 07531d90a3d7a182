"""Readers of stored inputs; bad rows are counted, not fatal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RECORD = (
    "record_id bigint, seed_url string, domain string, page_url string, pdf_url string, local_path string, ok boolean, download_state string, "
    "metadata struct<title: string, authors: array<string>, journal: string, volume: string, issue: string, year: string, date: string, doi: string, url: string, record_type: string, pdf_relative_path: string, dc_source: string, dc_set_spec: string>, "
    "source_adapter string, extraction_path string, retrieved_at string, http_status int, content_type string, pdf_sha256 string, pdf_size_bytes bigint, retries int, run_id string"
)
BAD = "_bad"


def records(spark: SparkSession, path: str, schema: str = RECORD) -> DataFrame:
    """JSON lines with a column of what could not be read, and seq by file and line.

    Blank lines are skipped; objects only.
    """
    lines = spark.read.text(path).withColumn("_file", F.col("_metadata.file_path")).withColumn("_at", F.monotonically_increasing_id()).where("trim(value) <> ''")
    parsed = F.from_json("value", StructType.fromDDL(schema) if isinstance(schema, str) else schema, {"mode": "PERMISSIVE"})
    object_ = F.col("value").rlike(r"^\s*\{.*\}\s*$")
    df = lines.withColumn("r", F.when(object_, parsed)).withColumn(BAD, F.when(~object_ | F.try_parse_json("value").isNull(), F.col("value")))
    return df.select("r.*", BAD, "_file", "_at")


def good(df: DataFrame) -> DataFrame:
    return df.where(F.col(BAD).isNull()).drop(BAD)


def bad_lines(df: DataFrame) -> DataFrame:
    """(file, lines): unreadable lines by file."""
    return df.where(F.col(BAD).isNotNull()).groupBy(F.col("_file").alias("file")).agg(F.count("*").alias("lines"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Records of a manifest; ``ok`` counts as true where it is absent."""
    return good(records(spark, path)).withColumn("ok", F.coalesce("ok", F.lit(True)))


def registry(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV with a header, all columns strings, a byte-order mark allowed."""
    df = spark.read.option("header", True).option("inferSchema", False).option("multiLine", True).option("escape", '"').csv(path)
    df = df.toDF(*[c.lstrip("\ufeff").strip() for c in df.columns])
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns])


def seeds(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """(file, seed_url, status): one row for every start address of every seed file, ranges expanded."""
    from corpusloom.functions.urls import expanded_ranges

    schema = "id string, start_urls array<string>, metadata struct<url: string, journal_name: string, platform: string, status: string>"
    df = spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", pattern).option("recursiveFileLookup", True).json(folder)
    one = df.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), F.coalesce("metadata.status", F.lit("active")).alias("status"), F.explode("start_urls").alias("u"))
    return one.select("file", "status", F.explode(expanded_ranges(F.trim("u"))).alias("seed_url")).where("seed_url <> ''")


def sidecars(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """(file, body): whole JSON documents as variants, NULL where they cannot be read."""
    df = spark.read.option("wholetext", True).option("pathGlobFilter", pattern).option("recursiveFileLookup", True).text(folder)
    return df.select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("body"))


def line_sidecars(spark: SparkSession, folder: str, pattern: str = "*.jsonl") -> DataFrame:
    """(file, meta, notes): sidecars of lines, one of type ``metadata`` and one for each note, folded to a row.

    A file without metadata has NULL for it.
    """
    df = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).text(folder).withColumn("file", F.col("_metadata.file_path"))
    kind, label = F.get_json_object("value", "$.type"), F.get_json_object("value", "$.ordinal").try_cast("int")
    rows = df.select("file", "value", kind.alias("kind"), label.alias("n"))
    notes = F.sort_array(F.collect_list(F.when(F.col("kind") == "footnote", F.struct("n", "value"))))
    return rows.groupBy("file").agg(F.max(F.when(F.col("kind") == "metadata", F.col("value"))).alias("meta"), F.transform(notes, lambda x: x["value"]).alias("notes"))


def candidates(spark: SparkSession, path: str, least_priority: float = 0.0) -> DataFrame:
    """Tab-separated candidates with a header, of at least a priority."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    return df.where(F.coalesce(F.col("priority").try_cast("double"), F.lit(0.0)) >= least_priority)


def files(spark: SparkSession, folder: str, pattern: str = "*.pdf", shards: int = 1, shard: int = 0) -> DataFrame:
    """(path, modified, size, content) of files, of one shard by hash of the path."""
    from corpusloom.operators.groups import path_shard

    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    df = df if shards <= 1 else df.where(path_shard(F.col("path"), shards) == shard)
    return df.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"), "content")


def latest_run(spark: SparkSession, records_: DataFrame) -> DataFrame:
    """The records of the last run by name."""
    return records_.join(records_.agg(F.max("run_id").alias("run_id")), "run_id", "left_semi")


def fresh(cache: DataFrame, sources: DataFrame, version: str) -> DataFrame:
    """Entries of a cache (path, cached, version, ...) that are newer than their source (path, modified)."""
    return cache.where(F.col("version") == version).join(sources.select("path", "modified"), "path").where(F.col("cached") >= F.col("modified")).drop("modified")


