"""Make the package importable in executors and find the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

PACKAGE = os.path.dirname(os.path.abspath(__file__))


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers once for each Spark context.

    Workers do not share the driver's ``sys.path``; Spark's own file server carries the zip.
    """
    sc = spark.sparkContext
    if getattr(sc, "_edispark_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="edispark-"), "edispark_package.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(PACKAGE)))
    sc.addPyFile(path)
    sc._edispark_shipped = True


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``.

    Where that setting is absent, only a one-machine session gets a temporary folder;
    a cluster without it is an error, since executors could not read each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        sc = spark.sparkContext
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = getattr(sc, "_edispark_scratch", None)
        if base is None:
            base = sc._edispark_scratch = "file://" + tempfile.mkdtemp(prefix="edispark-")
            sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What a query shuffles goes from the disks when it ends, not when the driver's memory is next collected."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the lineage ends there."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._edispark_at = path
    return back


def dropped(df: DataFrame) -> None:
    """Remove the table of a ``stored`` result that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._edispark_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
