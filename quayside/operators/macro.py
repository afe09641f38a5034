"""Macro series operators: aligned derived series, change reports, selectors, splices. Series are (series_id, date, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .temporal import filled


def derived(series: DataFrame, formulas: dict[str, tuple[str, str]], limit: int = 5) -> DataFrame:
    """Formulas (main input, expression over series columns) on the grid of all dates, inputs filled `limit` steps.

    A result is given only where its main input has an observation of its own.
    """
    import re

    # Names in the formulas that aren't called are series; one that has no rows is a column of nulls.
    words = {"and", "or", "not", "case", "when", "then", "else", "end", "is", "null", "between", "in"}
    inputs = sorted({name for main, f in formulas.values() for name in [main, *re.findall(r"\b[A-Za-z_]\w*\b(?!\s*\()", f)] if name.lower() not in words})
    wide = series.where(F.col("series_id").isin(inputs)).groupBy("date").pivot("series_id", inputs).agg(F.max("value"))
    steps = wide.withColumn("step", F.row_number().over(Window.orderBy("date"))).withColumn("k", F.lit(1))
    both = steps.select("date", *[F.col(c).alias(f"raw_{c}") for c in inputs], *[filled(c, "k", "step", limit).alias(c) for c in inputs])
    rows = F.array(*[F.struct(F.lit(n).alias("series_id"), F.when(F.col(f"raw_{main}").isNotNull(), F.expr(f)).alias("value")) for n, (main, f) in formulas.items()])
    return both.select("date", F.explode(rows).alias("r")).select("r.series_id", "date", "r.value").where("value IS NOT NULL")


def change_report(series: DataFrame, as_of: str, lags: tuple[int, ...] = (1, 5, 20), stale_days: int = 45) -> DataFrame:
    """Latest value per series, its change against earlier observations, its age and a stale flag."""
    w = Window.partitionBy("series_id").orderBy("date")
    lagged = series.select("*", *[(F.col("value") - F.lag("value", n).over(w)).alias(f"chg{n}") for n in lags])
    last = lagged.groupBy("series_id").agg(F.max_by(F.struct(*lagged.columns), "date").alias("r")).select("r.*")
    age = F.datediff(F.lit(as_of).cast("date"), "date")
    return last.select("*", age.alias("age"), (age > stale_days).alias("stale"))


def exact_month_changes(series: DataFrame) -> DataFrame:
    """Growth against exactly one month and one year before, by joins on shifted month ends."""
    now = series.withColumn("m", F.last_day("date"))
    out = now
    for name, n in (("mom", 1), ("yoy", 12)):
        past = now.select("series_id", F.last_day(F.add_months("m", n)).alias("m"), F.col("value").alias(f"_{name}"))
        out = out.join(past, ["series_id", "m"], "left").withColumn(name, F.try_divide("value", f"_{name}") - 1).drop(f"_{name}")
    return out.drop("m")


def year_to_date_growth(series: DataFrame, near_days: int = 25) -> DataFrame:
    """Growth since a real December, and against the observation nearest to the day a year before, within `near_days`."""
    december = series.where(F.month("date") == 12).groupBy("series_id", (F.year("date") + 1).alias("y")).agg(F.max_by("value", "date").alias("dec"))
    based = series.withColumn("y", F.year("date")).join(december, ["series_id", "y"], "left").withColumn("ytd", F.try_divide("value", "dec") - 1)
    past = series.select("series_id", F.col("date").alias("pd"), F.col("value").alias("pv"), (F.year("date") + 1).alias("py"))
    # The day a year before is in the year before or, near its ends, in a neighbouring one.
    year = F.year("date")
    near = series.select("series_id", "date", F.explode(F.array(year - 1, year, year + 1)).alias("py"))
    gap = F.abs(F.datediff("pd", F.add_months("date", -12)))
    found = near.join(past, ["series_id", "py"]).where(gap <= near_days).groupBy("series_id", "date").agg(F.min_by("pv", F.struct(gap, "pd")).alias("pv"))
    return based.join(found, ["series_id", "date"], "left").withColumn("yoy", F.try_divide("value", "pv") - 1).select("series_id", "date", "value", "ytd", "yoy")


def selected(series: DataFrame, ids: list[str], index_ids: list[str]) -> DataFrame:
    """Series side by side; those in `index_ids` are indices against 100 and lose it."""
    value = F.when(F.col("series_id").isin(index_ids), F.col("value") - 100).otherwise(F.col("value"))
    return series.where(F.col("series_id").isin(ids)).withColumn("value", value).groupBy("date").pivot("series_id", ids).agg(F.max("value"))


def shares(rows: DataFrame, period: str, part: str, value: str) -> DataFrame:
    """Each part's share of its period's sum, in per cent."""
    per = rows.groupBy(period, part).agg(F.sum(value).alias("value"))
    return per.withColumn("share", F.try_divide(100 * F.col("value"), F.sum("value").over(Window.partitionBy(period))))


def spliced(first: DataFrame, second: DataFrame, beside: DataFrame, keys: list[str]) -> DataFrame:
    """One rule's series, the other filling its gaps, and an external one beside them."""
    a, b, c = first.withColumnRenamed("value", "_a"), second.withColumnRenamed("value", "_b"), beside.withColumnRenamed("value", "external")
    return a.join(b, keys, "full_outer").join(c, keys, "full_outer").select(*keys, F.coalesce("_a", "_b").alias("value"), "external")


def regional_monthly(daily: DataFrame, monthly: DataFrame, fx: DataFrame, keys: list[str]) -> DataFrame:
    """Monthly flows in dollars: stated monthly rows before summed daily ones, at the month's mean rate filled forward."""
    summed = daily.groupBy(*keys, F.last_day("date").alias("month")).agg(F.sum("value").alias("_d"))
    stated = monthly.select(*keys, F.last_day("date").alias("month"), F.col("value").alias("_m"))
    both = summed.join(stated, [*keys, "month"], "full_outer").withColumn("value", F.coalesce("_m", "_d"))
    rates = fx.groupBy("currency", F.last_day("date").alias("month")).agg(F.avg("rate").alias("rate"))
    joined = both.join(rates, ["currency", "month"], "left")
    return joined.withColumn("rate", filled("rate", "currency", "month")).withColumn("usd", F.try_divide("value", "rate")).drop("_m", "_d")
