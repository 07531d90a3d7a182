"""Session helpers: table loading and staging of intermediate results."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest table (bytes of plan statistics or rows counted) that may be broadcast by hand.
BROADCAST_ROWS = 200_000

_shipped: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    Python workers import it by name; the driver serves the archive, so nothing
    has to be installed on the executors.
    """
    context = spark.sparkContext
    if _shipped.get("id") == context.applicationId:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="corpusloom-ship-")
    atexit.register(shutil.rmtree, folder, True)
    archive = f"{folder}/corpusloom.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(archive)
    _shipped["id"] = context.applicationId


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share: ``spark.checkpoint.dir`` where it is set.

    Only where it is unset and the session is local (tests, a laptop) a temporary
    folder is used; on a cluster that is an error, since other machines do not
    see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext._jsc.sc()
    if context.getCheckpointDir().isDefined():
        return context.getCheckpointDir().get()
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set: a cluster needs a folder that all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:
        pass


_staged: list[tuple[SparkSession, str]] = []


def staging_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted by ``release`` or when the Python driver ends."""
    if not _staged:
        atexit.register(release)
    path = f"{shared_dir(spark).rstrip('/')}/loom-{name}-{uuid.uuid4().hex}"
    _staged.append((spark, path))
    return path


def release() -> None:
    """Delete what was staged so far; results that were not written before can no longer be read."""
    while _staged:
        _delete(*_staged.pop())


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back.

    Cuts the lineage and survives the loss of an executor; stays until
    ``release`` is called or the Python driver ends.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint behind a count; above ``limit`` rows the join shuffles.

    ``df`` should be cheap to count (a staged table).
    """
    return F.broadcast(df) if len(df.limit(limit + 1).select(F.lit(1)).take(limit + 1)) <= limit else df
