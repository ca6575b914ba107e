"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from hazemill import storage

T = TypeVar("T")

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Dimensions are broadcast when Spark measures them below this size, never by hint.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    # A small load runs code of more than the 100 generated classes kept by default: all would be compiled anew in each.
    "spark.sql.codegen.cache.maxEntries": "1000",
    # Recording the call site of every column operation makes plans slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Generated methods above 8000 bytes (several AQIs in one stage) are compiled as well.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


#: Tasks that list folders at once, at most: by default a task lists one of up to 10,000 folders.
LISTING, LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 64


def list_in_few_tasks(spark: SparkSession) -> None:
    """Let a task list many folders: thousands of drops are then listed in seconds, not in a task each."""
    if int(spark.conf.get(LISTING)) > LISTING_TASKS:
        spark.conf.set(LISTING, LISTING_TASKS)


def build_session(app: str = "hazemill", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the cluster; a local session without one gets a fresh folder."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="hazemill-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


#: Paths of the innermost open scope of each thread.
_SCOPE = threading.local()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path no earlier run has written to, in the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if getattr(_SCOPE, "paths", None) is not None:
        _SCOPE.paths.append(path)
    return path


def at_once(spark: SparkSession, steps: Sequence[Callable[[], T]]) -> list[T]:
    """What independent steps return, each run in a thread of its own. All have ended when the first error is raised."""
    shared_dir(spark)  # made once, before the threads ask for it
    with ThreadPoolExecutor(max(1, len(steps))) as threads:
        running = [threads.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in running]


#: Steps that ``ahead`` begins before the one whose result is asked for.
AHEAD = 3


def ahead(spark: SparkSession, steps: Sequence[Callable[[], T]]) -> Iterator[T]:
    """What independent steps return, in order; while a result is used, the next few steps run."""
    shared_dir(spark)
    with ThreadPoolExecutor(AHEAD) as threads:
        running = deque()
        for step in steps:
            running.append(threads.submit(inheritable_thread_target(spark)(step)))
            if len(running) > AHEAD:
                yield running.popleft().result()
        while running:
            yield running.popleft().result()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are removed at the end, also after an error.

    For steps that finish their work inside; a DataFrame that outlives the scope must not read
    such a table. Scopes may be nested.
    """
    outer, _SCOPE.paths = getattr(_SCOPE, "paths", None), []
    try:
        yield
    finally:
        made, _SCOPE.paths = _SCOPE.paths, outer
        for path in made:
            storage.remove(spark, path)


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage is cut, their size is known."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
