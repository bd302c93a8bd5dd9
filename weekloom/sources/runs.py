"""A set of output tables that appears together or not at all.

Each run writes its tables to a folder of its own; when all are there, its manifest follows, one file with a row
per table. Readers take the newest manifest and the paths it names, so they see whole runs only: before the manifest is
written the run before, afterwards this one. A run that fails leaves no manifest.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weekloom.session import drop_path

_MANIFEST = "run string, name string, path string, rows long, columns string"


class Run:
    """One set of tables under ``folder``; ``publish`` makes it the one that readers see."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        # names sort by time, and two runs of one instant differ
        self.name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        self.tables: dict[str, tuple] = {}

    @property
    def names(self) -> list[str]:
        return list(self.tables)

    def path(self, name: str) -> str:
        return f"{self.folder}/runs/{self.name}/{name}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table, counting its rows on the way, and read it back; a name is written once."""
        if name in self.tables:
            raise ValueError(f"{name} is already written in this run")
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").parquet(self.path(name))
        self.tables[name] = (self.name, name, self.path(name), seen.get["n"], df.schema.json())
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def publish(self) -> None:
        """The manifest is one file, which the file system shows whole or not at all."""
        rows = self.spark.createDataFrame(list(self.tables.values()), _MANIFEST)
        rows.coalesce(1).write.mode("errorifexists").parquet(f"{self.folder}/manifests/{self.name}")

    def discard(self) -> None:
        """Remove what an unpublished run has written."""
        drop_path(self.spark, f"{self.folder}/runs/{self.name}")


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """(run, name, path, rows, columns) of all published runs."""
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifests/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)


def published(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the newest published run; none where nothing is published."""
    known = manifests(spark, folder)
    newest = known.where(F.col("run") == known.agg(F.max("run")).scalar())
    return {r.name: spark.read.parquet(r.path) for r in newest.collect()}


def incomplete(spark: SparkSession, folder: str) -> list[str]:
    """Names of the newest run whose tables no longer have the rows that the manifest counted."""
    known = manifests(spark, folder)
    newest = known.where(F.col("run") == known.agg(F.max("run")).scalar())
    return [r.name for r in newest.collect() if spark.read.parquet(r.path).count() != r.rows]


def expire(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Remove all published runs but the newest ``keep``, manifests first; returns their names. Readers of those should have ended."""
    names = sorted((r.run for r in manifests(spark, folder).select("run").distinct().collect()), reverse=True)
    for name in names[max(keep, 1) :]:
        drop_path(spark, f"{folder}/manifests/{name}")
        drop_path(spark, f"{folder}/runs/{name}")
    return names[max(keep, 1) :]
