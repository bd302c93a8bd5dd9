"""Rows whose labels a model may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out():
    """crc32 of the id as text, modulo 4, is 2: never learnt from. A null id counts as held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(True))


def labels_to_learn(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of rows that aren't held out; repeated rows are averaged, ties count as 0."""
    known = labels.where(F.col(label).isNotNull() & ~held_out())
    return known.groupBy("doc_id").agg((F.avg(F.col(label)) > 0.5).cast("int").alias("label"))


def sample_rows(docs: DataFrame, learn: DataFrame, piece: Column, per_class: int, salt: str) -> DataFrame:
    """(label, place, piece) of the rows of at most ``per_class`` ids of each label, those with the smallest salted hash, their ``place``.

    ``piece`` is computed from the rows of ``docs`` alone, whose other columns play no part. One id may have many
    rows; ``at_most`` bounds them.
    """
    order = [F.xxhash64("doc_id", F.lit(salt)), F.col("doc_id")]
    ids = [learn.where(F.col("label") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    ids = ids[0].unionByName(ids[1]).select(F.col("doc_id").alias("learnt_id"), F.col("label").alias("learnt"))
    rows = docs.select(F.col("doc_id").alias("read_id"), piece.alias("piece"))
    both = rows.join(ids, F.col("read_id") == F.col("learnt_id"))
    return both.select(F.col("learnt").alias("label"), F.xxhash64("read_id", F.lit(salt)).alias("place"), "piece")


def at_most(rows: DataFrame, per_class: int) -> DataFrame:
    """Of rows (label, place, piece) the first ``per_class`` of each label; every partition keeps no more than that."""
    parts = [rows.where(F.col("label") == k).orderBy("place", F.xxhash64("piece")).limit(per_class) for k in (0, 1)]
    return parts[0].unionByName(parts[1])
