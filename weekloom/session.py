"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "weekloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this package is tuned for.

    AQE coalesces small shuffle partitions, splits skewed join partitions and picks
    broadcast joins from measured sizes, so no operator carries a broadcast hint.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster a machine-local
    folder would be lost with its executor, so the setting is required there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="weekloom-")
    spark.sparkContext.setCheckpointDir(root)
    return root


_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_SCOPE: ContextVar[list[str] | None] = ContextVar("staging_scope", default=None)


def drop_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside belong to the scope and go at its end, however it ends.

    Frames made inside are dead afterwards unless they were staged with ``keep``. Tables staged outside, by
    other jobs of the application or other threads, are not touched. Scopes nest.
    """
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in paths:
            drop_path(spark, path)


def stage(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Used where several consumers need a small result of a large scan (the weekly series):
    the facts are read once, the lineage ends, and later readers see true table sizes. With ``keep`` it
    outlives the scope it is written in.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    scope = _SCOPE.get()
    if scope is not None and not keep:
        scope.append(path)
    staged = spark.read.schema(df.schema).parquet(path)
    _PATHS[staged] = path
    return staged


def unstage(staged: DataFrame) -> None:
    """Remove the table behind a frame that ``stage`` returned, once nothing reads it any more; other frames are left alone."""
    path = _PATHS.pop(staged, None)
    if path is not None:
        drop_path(staged.sparkSession, path)


@contextmanager
def checkpointed(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` read from a checkpoint, which goes at the end of the block.

    For loops of many small jobs over the same rows: jobs and tasks carry nothing of how the rows were made, not even
    skipped stages. Frames made from it are dead afterwards.
    """
    spark = df.sparkSession
    root = staging_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    held = df.checkpoint()
    try:
        yield held
    finally:
        drop_path(spark, held._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get())


_SHARED: set[str] = set()


def share_code(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application; they may have no copy of it."""
    context = spark.sparkContext
    if context.applicationId not in _SHARED:
        package = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(os.path.realpath(tempfile.mkdtemp()), "weekloom")
        context.addPyFile(shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package)))
        _SHARED.add(context.applicationId)
