"""The last eligible failure of every address, kept up to date from a stream of records."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.record_stats import latest_retryable


def keep_latest(path: str, max_retries: int = 3):
    """A function for foreachBatch that merges a batch's failures into the parquet table at ``path``.

    A batch that runs again gives the same table: of an address the greatest
    (seq, record_id) wins. Versions are written beside each other and read by the
    name in the file ``current``, which is swapped when a version is whole; only
    a table that does not exist counts as empty, and errors of reading are errors.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        order = batch.groupBy("record_id").agg(F.max("seq").alias("seq"))
        new = latest_retryable(batch, max_retries).join(order, "record_id")
        old = current(batch.sparkSession, path)
        both = new if old is None else old.unionByName(new)
        best = both.groupBy("pdf_url").agg(F.max_by(F.struct("record_id", "error_class", "retries", "seq"), F.struct("seq", "record_id")).alias("b")).select("pdf_url", "b.*")
        version = f"v-{uuid.uuid4().hex}"
        best.write.parquet(f"{path}/{version}")
        _swap(batch.sparkSession, path, version)

    return merge


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _version(spark: SparkSession, path: str) -> str | None:
    jvm, at, files = _files(spark, f"{path}/current")
    if not files.exists(at):
        return None
    return spark.read.text(f"{path}/current").first()[0]


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as it is, or None before the first batch."""
    version = _version(spark, path)
    return None if version is None else spark.read.parquet(f"{path}/{version}")


def _swap(spark: SparkSession, path: str, version: str) -> None:
    """Let ``current`` name the new version and delete the one before the last."""
    before = _version(spark, path)
    jvm, temporary, files = _files(spark, f"{path}/.current-{version}")
    out = files.create(temporary, True)
    out.write(bytearray(version.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(temporary.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(temporary, jvm.org.apache.hadoop.fs.Path(f"{path}/current"), over)
    for status in files.listStatus(jvm.org.apache.hadoop.fs.Path(path)):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in (version, before):
            files.delete(status.getPath(), True)
