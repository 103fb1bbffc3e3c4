"""Spark session settings and the shared folder for cut lineages and staged tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}
_session_dirs: set[str] = set()


def build_session(app: str = "voltaria", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, ANSI mode and adaptive execution; the cluster sets the rest."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster. Only a local master, as in tests, gets one of its own."""
    named = spark.conf.get(_CHECKPOINT_KEY, None)
    if not named:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = held.get() if held.isDefined() else None
    if not named:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError(f"name a folder that all executors share in {_CHECKPOINT_KEY}")
        named = _local_dirs.get(context.applicationId)
        if named is None:
            named = _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="voltaria-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
    return named


def session_dir(spark: SparkSession) -> str:
    """This session's folder under the shared one; it goes when the session's JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/voltaria-{spark.sparkContext.applicationId}"
    if path not in _session_dirs:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = where.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(where)
        files.deleteOnExit(where)
        _session_dirs.add(path)
    return path


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system that Spark reads; none if it is not there."""
    files, where = _files(spark, path)
    return [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    files, where = _files(spark, path)
    files.delete(where, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the session's folder."""
    return f"{session_dir(spark)}/{label}-{uuid.uuid4().hex}"


class Staging:
    """The tables staged inside a ``with`` block; ``release`` deletes those that nothing will read again."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def __enter__(self) -> Staging:
        _scopes.append(self)
        return self

    def __exit__(self, *error) -> None:
        _scopes.remove(self)

    def release(self, *kept: DataFrame) -> None:
        """Delete the tables staged so far, but for those that the kept frames read."""
        read = {name.rsplit("/", 2)[-2] for df in kept for name in df.inputFiles()}
        for path in self.paths:
            if path.rsplit("/", 1)[-1] not in read:
                remove_path(self.spark, path)
        self.paths = [p for p in self.paths if p.rsplit("/", 1)[-1] in read]


_scopes: list[Staging] = []


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, so later jobs start from the table."""
    path = scratch_path(df.sparkSession, label)
    for scope in _scopes:
        scope.paths.append(path)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int:
    """Size that Catalyst estimates for a frame, from file sizes; no job is run."""
    return int(str(_optimized(df).stats().sizeInBytes()))


def input_bytes(df: DataFrame) -> int:
    """Size of everything a frame reads. Joins multiply the estimate of :func:`plan_bytes`, not this one."""
    leaves = _optimized(df).collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


BROADCAST_BYTES = 16 << 20


def broadcast_if_small(df: DataFrame, one_row_per_key: bool = False) -> DataFrame:
    """Mark a join side for broadcast if its size is known to be small; else Spark picks the join.

    The check uses Catalyst's estimate. A dimension with one row per key cannot outgrow the files it is
    read from, while the estimate multiplies the sizes of the tables it joins: there the files count.
    """
    size = input_bytes(df) if one_row_per_key else plan_bytes(df)
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def is_derived(df: DataFrame) -> bool:
    """Whether reading the frame again would repeat a shuffle, and not just a scan."""
    nodes = [_optimized(df)]
    while nodes:
        node = nodes.pop()
        if node.nodeName().split()[0] in ("Aggregate", "Join", "Window", "Sort", "RepartitionByExpression", "Distinct"):
            return True
        children = node.children()
        nodes.extend(children.apply(i) for i in range(children.size()))
    return False


def _optimized(df: DataFrame):
    return df._jdf.queryExecution().optimizedPlan()
