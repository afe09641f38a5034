"""Property operators: listing price index, weekly series, agreement of sources, map selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .clean import robust
from .text import checkpointed


def price_index(listings: DataFrame, keys: list[str], first: str, last: str, window_days: int = 120, least: int = 5, ties: tuple[str, ...] = ()) -> DataFrame:
    """Per group and month end: quartiles and mean of the last row of each listing in the window, robustly filtered.

    A listing meets the month ends that follow it within the window (four or five), not all of them. Of rows of one listing
    and day the first by the columns `ties` counts.
    """
    last_possible = F.least(F.lit(last).cast("date"), F.last_day(F.date_add("posted", window_days)))
    start = F.greatest(F.trunc(F.lit(first).cast("date"), "month"), F.trunc("posted", "month"))
    usable = listings.where(start <= F.trunc(last_possible, "month"))
    months = F.explode(F.transform(F.sequence(start, F.trunc(last_possible, "month"), F.expr("INTERVAL 1 MONTH")), lambda m: F.last_day(m)))
    each = usable.select("*", months.alias("month")).where((F.col("posted") <= F.col("month")) & (F.col("posted") > F.date_sub("month", window_days)))
    newest = checkpointed(each.groupBy(*keys, "month", "prid").agg(F.min_by("ppm2", F.struct((-F.unix_date("posted")).alias("_back"), *ties)).alias("ppm2")))
    kept = robust(newest, [*keys, "month"], "ppm2")
    out = kept.groupBy(*keys, "month").agg(F.count("*").alias("n"), *[F.percentile("ppm2", q).alias(f"p{int(q * 100)}") for q in (0.25, 0.5, 0.9)], F.avg("ppm2").alias("mean"))
    return out.where(F.col("n") >= least)


def by_bedrooms(listings: DataFrame, key: str, least: int = 3) -> DataFrame:
    return listings.groupBy(key, "bed").agg(F.median("ppm2").alias("median"), F.count("*").alias("n")).where(F.col("n") >= least)


def summary(listings: DataFrame, key: str, as_of: str) -> DataFrame:
    day = F.lit(as_of).cast("date")
    return listings.groupBy(key).agg(F.count("*").alias("n"), *[F.percentile("ppm2", q).alias(f"q{k + 1}") for k, q in enumerate((0.25, 0.5, 0.75))], F.count_if(F.col("posted") > F.date_sub(day, 7)).alias("new7"), F.count_if(F.col("posted") > F.date_sub(day, 30)).alias("new30"))


def weekly(listings: DataFrame, key: str) -> DataFrame:
    """Last row per project and week, then the median over projects; weeks are stamped at their Sunday."""
    week = F.date_add(F.date_trunc("week", "posted").cast("date"), 6)
    last = listings.groupBy(key, "project_id", week.alias("week")).agg(F.max_by("ppm2", F.struct("posted", "prid")).alias("ppm2"))
    return last.groupBy(key, "week").agg(F.median("ppm2").alias("median"), F.percentile("ppm2", 0.25).alias("p25"), F.percentile("ppm2", 0.75).alias("p75"), F.count("*").alias("projects"))


def agreement(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """How two sources of the same values agree: quantiles of the ratio, share within a tenth, correlation of logs."""
    both = left.withColumnRenamed("value", "a").join(right.withColumnRenamed("value", "b"), keys).where("a > 0 AND b > 0")
    ratio = F.col("a") / F.col("b")
    return both.agg(F.count("*").alias("n"), *[F.percentile(ratio, q).alias(f"p{int(q * 100)}") for q in (0.1, 0.5, 0.9)], (F.count_if(F.abs(ratio - 1) <= 0.1) / F.count("*")).alias("within"), F.corr(F.log("a"), F.log("b")).alias("log_corr"))


def in_box(rows: DataFrame, box: tuple[float, float, float, float], low: tuple[str, str], high: tuple[str, str]) -> DataFrame:
    """Rows whose own box overlaps (min x, min y, max x, max y); plain range predicates that reach the scan."""
    x0, y0, x1, y1 = box
    return rows.where((F.col(low[0]) <= x1) & (F.col(high[0]) >= x0) & (F.col(low[1]) <= y1) & (F.col(high[1]) >= y0))


def status_summary(projects: DataFrame, listings: DataFrame, status: Column) -> DataFrame:
    """Per status: projects, units, listings, and the median price of each listing's newest row."""
    newest = listings.groupBy("project_id").agg(F.count("*").alias("listings"), F.max_by("ppm2", F.struct("posted", "prid")).alias("ppm2"))
    return projects.withColumn("status", status).join(newest, "project_id", "left").groupBy("status").agg(F.count("*").alias("projects"), F.sum("units").alias("units"), F.sum("listings").alias("listings"), F.median("ppm2").alias("median"))
