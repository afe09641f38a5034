"""File sources and sinks: typed CSV, filtered Parquet, partitioned stores, materialised tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors see. A session that names none gets a temporary one on one machine, else an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("a cluster needs a folder that all executors see: set spark.checkpoint.dir")
        root = "file://" + tempfile.mkdtemp(prefix="quayside-")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def scan_csv(spark: SparkSession, path: str, schema: str, dates: dict[str, str] | None = None) -> DataFrame:
    """CSV with a header by an explicit schema; a byte order mark is dropped; text dates become dates."""
    rows = spark.read.csv(path, schema=schema, header=True, encoding="UTF-8", enforceSchema=True)
    return rows.withColumns({c: F.to_date(c, form) for c, form in (dates or {}).items()})


def scan_parquet(spark: SparkSession, path: str, column: str, values: list, columns: list[str], more: Column | None = None) -> DataFrame:
    """Only the rows with one of the values and only the columns asked for; both reach the file scan."""
    rows = spark.read.parquet(path).where(F.col(column).isin(values))
    return (rows if more is None else rows.where(more)).select(*columns)


def star_publish(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A frame through CSV into Parquet: what a bulk conversion does, in tasks of bounded size."""
    csv, parquet = shared_path(spark, "csv"), shared_path(spark, "parquet")
    df.write.csv(csv, header=True)
    scan_csv(spark, csv, df.schema.simpleString()[7:-1].replace(":", " ")).write.parquet(parquet)
    return spark.read.parquet(parquet)


def event_store(spark: SparkSession, events: DataFrame, parts: list[str]) -> DataFrame:
    """A store with one folder per value of `parts`; writing again replaces only the folders it touches."""
    path = shared_path(spark, "store")
    events.write.partitionBy(*parts).parquet(path)
    changed = spark.read.parquet(path).where(F.col(parts[1]) == "arrive")
    # Read rows are written elsewhere first: a folder is never read and replaced in one job.
    again = shared_path(spark, "changed")
    changed.write.parquet(again)
    spark.read.parquet(again).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    return spark.read.parquet(path)


def csv_with_mark(spark: SparkSession, df: DataFrame) -> str:
    """A folder of CSV files as spreadsheets write them: a byte order mark before the header of each."""
    path = shared_path(spark, "marked")
    first, *others = df.columns
    df.select(F.col(first).alias(f"\ufeff{first}"), *others).write.csv(path, header=True)
    return path


def materialised(spark: SparkSession, df: DataFrame, by: str) -> DataFrame:
    """A presentation table, computed once and stored by the values of a column, as the readers of one page ask for it."""
    path = shared_path(spark, "table")
    df.repartition(by).write.partitionBy(by).parquet(path)
    return spark.read.parquet(path)
