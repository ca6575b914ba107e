"""Folders and marker files of the shared storage, through Hadoop's file system interface.

Only names are listed here, never rows: what Spark reads it reads by ``spark.read``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    context = spark.sparkContext
    location = context._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(context._jsc.hadoopConfiguration()), location


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly in ``folder``, without hidden ones; none where it does not exist. One listing."""
    system, location = _located(spark, folder)
    if not system.exists(location):
        return []
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    paths = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(system.listStatus(location))
    # One text for all of them: a call from Python per name would take seconds for thousands of drops.
    objects = gateway.new_array(jvm.Object, len(paths))
    jvm.System.arraycopy(paths, 0, objects, 0, len(paths))
    found = (path.rpartition("/")[2] for path in jvm.org.apache.commons.lang3.StringUtils.join(objects, "\0").split("\0"))
    return sorted(name for name in found if name and name[0] not in "._")


def holds(spark: SparkSession, folder: str) -> bool:
    """Whether ``folder`` has anything in it that is not hidden."""
    system, location = _located(spark, folder)
    if not system.exists(location):
        return False
    found = system.listStatusIterator(location)
    while found.hasNext():
        if found.next().getPath().getName()[0] not in "._":
            return True
    return False


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all it holds; no error where there is none."""
    system, location = _located(spark, path)
    system.delete(location, True)


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file; an error if there is one already."""
    system, location = _located(spark, path)
    system.create(location, False).close()
