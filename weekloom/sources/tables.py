"""Reading, writing and normalising tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from weekloom.functions.columns import parse_date, present
from weekloom.session import stage
from weekloom.sources.schemas import schema


def read_csv(
    spark: SparkSession, path: str, name: str, day_first: Sequence[str] = (), ledger: list[DataFrame] | None = None
) -> DataFrame:
    """Header CSV read with the declared schema, matched by column name.

    Columns are read as text and cast, because files keep their own column order; NaN and a value
    that does not parse become NULL. Columns in ``day_first`` use the day-first formats.

    With ``ledger`` nothing vanishes unseen: the file is read once into a staged table, and a frame (table, column,
    value, raw) of its values that did not parse, each with its whole row as JSON, is added to the list. Blanks and NaN are missing, not rejected.
    """
    text = spark.read.option("header", True).option("multiLine", False).option("escape", '"').csv(path)
    sources = {c.replace("﻿", "").strip().lower(): c for c in text.columns}
    out, rejected = [], []
    for field in schema(name).fields:
        source = sources.get(field.name)
        if source is None:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        raw = F.col(f"`{source}`")
        value = parse_date(raw) if field.name in day_first else raw.try_cast(field.dataType)
        bad = value.isNull() & (F.trim(raw) != "") & (F.lower(F.trim(raw)) != "nan")
        rejected.append(F.when(bad, F.struct(F.lit(field.name).alias("column"), raw.alias("value"))))
        if isinstance(field.dataType, (DoubleType, FloatType)):
            value = present(value)
        out.append(value.cast(field.dataType).alias(field.name))
    if ledger is None:
        return text.select(*out)
    found = F.array_compact(F.array(*rejected)) if rejected else F.array().cast("array<struct<column:string,value:string>>")
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in text.columns]))
    parsed = text.select(*out, found.alias("_rejected"), F.when(F.size(found) > 0, whole).alias("_raw"))
    parsed = stage(parsed, f"{name}-parsed")
    ledger.append(parsed.select(F.lit(name).alias("table"), F.inline("_rejected"), F.col("_raw").alias("raw")))
    return parsed.drop("_rejected", "_raw")


def read_parquet(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    reader = spark.read if name is None else spark.read.schema(schema(name))
    return reader.parquet(path)


def first_file(
    spark: SparkSession, candidates: Sequence[str], name: str, optional: bool = False, ledger: list[DataFrame] | None = None
) -> DataFrame | None:
    """The first of the paths that exists, read by its ending: CSV or else Parquet.

    Existence is asked of Spark's own reader, so paths in any store will do. ``ledger`` as in read_csv.
    """
    for path in candidates:
        try:
            return read_csv(spark, path, name, ledger=ledger) if path.endswith(".csv") else read_parquet(spark, path, name)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if optional:
        return None
    raise LookupError(f"none of these files exist: {list(candidates)}")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown table format: {fmt}")


def first_table(spark: SparkSession, candidates: Sequence[str], optional: bool = False) -> DataFrame | None:
    """The first catalog table or view that exists."""
    for name in candidates:
        if spark.catalog.tableExists(name):
            return spark.table(name)
    if optional:
        return None
    raise LookupError(f"none of these tables exist: {list(candidates)}")


def table_or_empty(spark: SparkSession, candidates: Sequence[str], name: str) -> DataFrame:
    found = first_table(spark, candidates, optional=True)
    return spark.createDataFrame([], schema(name)) if found is None else found


def standardize_columns(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Strip and lower column names, then give each first matching alias its standard name."""
    lowered = df.toDF(*[c.strip().lower() for c in df.columns])
    renames = {}
    for target, options in aliases.items():
        if target in lowered.columns:
            continue
        found = next((o for o in options if o in lowered.columns and o not in renames), None)
        if found:
            renames[found] = target
    return lowered.withColumnsRenamed(renames)


def require(df: DataFrame, columns: Sequence[str], what: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}")
    return df


def clean_predictions(df: DataFrame) -> DataFrame:
    """order_week, category, y, yhat from any prediction table; incomplete rows dropped."""
    from weekloom.sources.schemas import PREDICTION_ALIASES

    std = require(standardize_columns(df, PREDICTION_ALIASES), ["order_week", "category", "y", "yhat"], "predictions")
    dtype = dict(std.dtypes)["order_week"]
    week = parse_date("order_week") if dtype == "string" else F.col("order_week").cast("date")
    out = std.select(
        week.alias("order_week"),
        F.col("category").cast("string").alias("category"),
        F.col("y").try_cast("double").alias("y"),
        F.col("yhat").try_cast("double").alias("yhat"),
    )
    numbers = ["y", "yhat"]
    out = out.select("order_week", "category", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in numbers])
    return out.dropna(subset=["order_week", "category", "y", "yhat"])
