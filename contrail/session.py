"""Session set-up and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution does the run-time work: it coalesces small shuffle partitions, turns a join into a
# broadcast only once the measured side is below the threshold, and splits skewed partitions even if that
# costs another exchange.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "contrail", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="contrail-")
    spark.sparkContext.setCheckpointDir(made)
    return made


_PATHS: ContextVar[list[str] | None] = ContextVar("paths of stored tables", default=None)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table's files, wherever the path's file system is; a missing one is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def stored_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Scope of a job: what ``materialize`` stores inside is dropped at its end, also if the job fails.

    Write the job's result inside the scope; a DataFrame that still reads stored tables is of no use afterwards. Scopes can be nested: each drops
    its own tables.
    """
    paths: list[str] = []
    token = _PATHS.set(paths)
    try:
        yield paths
    finally:
        _PATHS.reset(token)
        for path in paths:
            drop_path(spark, path)


def stored_result(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """``build()``, stored, once all it stored on the way is dropped."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    with stored_tables(spark):
        df = build()
        df.write.parquet(path)
        schema = df.schema
    if _PATHS.get() is not None:
        _PATHS.get().append(path)
    return spark.read.schema(schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Scope whose queries give back the files of their shuffles when they end, not when the driver next collects garbage.

    For a chain of stored tables; a DataFrame that is run twice as it is would make its shuffles again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, was)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The read-back table has no upstream lineage (a lost executor re-reads files instead of redoing joins)
    and an exact size, so the planner broadcasts it only when it really is small. Inside ``stored_tables`` it is dropped with its job.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    if _PATHS.get() is not None:
        _PATHS.get().append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_all(store: Callable[[DataFrame, str], DataFrame], tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Store independent tables side by side, so that small jobs do not wait for each other."""
    with ThreadPoolExecutor(max_workers=min(8, max(1, len(tables)))) as pool:
        futures = {label: pool.submit(copy_context().run, store, df, label) for label, df in tables.items()}
        return {label: f.result() for label, f in futures.items()}
