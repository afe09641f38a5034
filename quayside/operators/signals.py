"""The market's signal table, and earnings of baskets with their growth.

Windows here run over tables of one row per session, or per basket and session; joins by name are as-of joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .clean import despiked
from .temporal import asof_join

#: As published: sessions of three and five years, deviations below the mean, days until a quarter's statements are out.
SPANS, THRESHOLDS, LAG_DAYS = (750, 1250), (1.7, 1.9), 45


def z_value(value: str, n: int) -> Column:
    """(value - mean) / sample deviation of the last n rows by date, null before there are so many."""
    span = Window.orderBy("date").rowsBetween(-(n - 1), 0)
    return F.when(F.count(value).over(span) == n, F.try_divide(F.col(value) - F.avg(value).over(span), F.stddev_samp(value).over(span)))


def as_known(days: DataFrame, series: DataFrame, time: str, columns: list[str]) -> DataFrame:
    """Each day with the newest row of one series at or before it; both are tables of days or quarters."""
    return asof_join(days.withColumn("_one", F.lit(0)), series.withColumn("_one", F.lit(0)), "_one", "date", time, columns).drop("_one")


def group_price_book(bars: DataFrame, figures: DataFrame, lag_days: int, least: int) -> DataFrame:
    """Sum of capitalisations over sum of published equity per day, of the names that have both; from `least` names on."""
    out = figures.where("equity IS NOT NULL").select("symbol", F.date_add("quarter_end", lag_days).alias("_out"), "equity")
    known = asof_join(bars.select("symbol", "date", "cap"), out, "symbol", "date", "_out", ["equity"])
    daily = known.where("equity IS NOT NULL AND cap IS NOT NULL").groupBy("date").agg(F.count("*").alias("_n"), F.try_divide(F.sum("cap"), F.sum("equity")).alias("pb"))
    return daily.where((F.col("_n") >= least) & F.col("pb").isNotNull()).select("date", "pb")


def profit_flags(figures: DataFrame, lag_days: int) -> DataFrame:
    """Per quarter: the group's profit, whether it rose on the quarter and on the year before, and the day it is out."""
    w = Window.orderBy("quarter_end")
    total = figures.groupBy("quarter_end").agg(F.coalesce(F.sum("profit"), F.lit(0.0)).alias("profit"))
    rose = {n: F.coalesce(F.col("profit") > F.lag("profit", k).over(w), F.lit(False)) for n, k in {"profit_qoq": 1, "profit_yoy": 4}.items()}
    return total.select("quarter_end", F.date_add("quarter_end", lag_days).alias("_out"), *[c.alias(n) for n, c in rose.items()])


def liquidity_flags(turnover: DataFrame) -> DataFrame:
    """Per quarter, at its last session so far: whether turnover fell against the quarter before."""
    quarter = F.year("date") * 4 + F.quarter("date")
    total = turnover.where("value > 0").groupBy(quarter.alias("_q")).agg(F.sum("value").alias("_v"), F.max("date").alias("_last"))
    return total.select("_last", F.coalesce(F.col("_v") < F.lag("_v").over(Window.orderBy("_q")), F.lit(False)).alias("quiet"))


def signal_table(market: DataFrame, bars: DataFrame, figures: DataFrame, turnover: DataFrame, *, spans: tuple[int, int] = SPANS, thresholds: tuple[float, float] = THRESHOLDS, lag_days: int = LAG_DAYS, least: int = 5) -> DataFrame:
    """Per session: valuations with their z values, liquidity and profit flags as of their publication, entry tiers and buys.

    `market` is (date, pe), `bars` (symbol, date, cap) of the group, `figures` its (symbol, quarter_end, equity, profit),
    `turnover` (date, value). Sessions begin where the price-earnings ratio has the shorter span. Tier 2 asks for falling
    turnover and a profit above the quarter before, tier 1 for one above the year before; `buy1` and `buy2` need their tier and a z
    value at or below minus their threshold. `new_quarter` stands at the first session that knows a quarter's statements.
    """
    short, long = spans
    pe = market.where("pe IS NOT NULL").select("date", "pe", z_value("pe", short).alias("z_short"), z_value("pe", long).alias("z_long"))
    begins = pe.withColumn("_n", F.row_number().over(Window.orderBy("date"))).where(F.col("_n") == short).agg(F.min("date").alias("_begins"))
    days = bars.select("date").distinct().join(F.broadcast(begins)).where("date >= _begins").select("date")
    pb = group_price_book(bars, figures, lag_days, least).select("date", "pb", z_value("pb", short).alias("z_pb"))
    out = as_known(days, pe, "date", ["pe", "z_short", "z_long"])
    out = as_known(out, pb, "date", ["pb", "z_pb"])
    out = as_known(out, liquidity_flags(turnover), "_last", ["quiet"])
    out = as_known(out, profit_flags(figures, lag_days), "_out", ["quarter_end", "profit_qoq", "profit_yoy"])
    out = out.na.fill(False, ["quiet", "profit_qoq", "profit_yoy"])
    tier = F.when(F.col("quiet") & F.col("profit_qoq"), 2).when(F.col("quiet") & F.col("profit_yoy"), 1).otherwise(0)

    def buy(threshold: float, least_tier: int) -> Column:
        low = F.coalesce(F.col("z_short") <= -threshold, F.lit(False)) | F.coalesce(F.col("z_long") <= -threshold, F.lit(False))
        return low & (tier >= least_tier)

    fresh = ~F.col("quarter_end").eqNullSafe(F.lag("quarter_end").over(Window.orderBy("date")))
    return out.withColumns({"tier": tier, "buy1": buy(thresholds[0], 1), "buy2": buy(thresholds[1], 2), "new_quarter": F.when(fresh, F.col("quarter_end")), "new_rose": fresh & F.col("profit_qoq")}).drop("quarter_end")


def basket_growth(values: DataFrame, keys: list[str], measures: list[str], tolerance: float = 0.3) -> DataFrame:
    """`values` (keys, date, measures) with the measures freed of spikes and their growth in percent on the year before.

    A spike deviates from the values before and after it by more than `tolerance`; the year before is the last value
    at or before the same day. Where a measure is missing or a spike, it and its growth are null.
    """
    long = values.unpivot([*keys, "date"], measures, "_m", "_v").where("_v IS NOT NULL")
    kept = despiked(long, [*keys, "_m"], "date", "_v", tolerance)
    asked = kept.withColumn("_ago", F.add_months("date", -12))
    past = kept.select(*keys, "_m", F.col("date").alias("_day"), F.col("_v").alias("_past"))
    grown = asof_join(asked, past, [*keys, "_m"], "_ago", "_day", ["_past"]).withColumn("_g", 100 * (F.try_divide("_v", "_past") - 1))
    wide = grown.groupBy(*keys, "date").agg(*[F.max(F.when(F.col("_m") == m, F.col(c))).alias(n) for m in measures for c, n in (("_v", m), ("_g", f"{m}_growth"))])
    return values.drop(*measures).join(wide, [*keys, "date"], "left")


def latest_growth(values: DataFrame, key: str, measure: str, others: list[str], until: str, tolerance: float = 0.3) -> DataFrame:
    """Per group, up to a day: the last value of a measure with its growth, and the last values of others; groups without growth are left out."""
    inside = values.where(F.col("date") <= F.lit(until).cast("date"))
    grown = basket_growth(inside, [key], [measure], tolerance)
    # Growth is that of the measure's last value, be it null.
    at = F.when(F.col(measure).isNotNull(), F.col("date"))
    columns = [F.max_by(measure, at).alias(measure), F.max_by(f"{measure}_growth", at).alias("growth")]
    columns += [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("date"))).alias(c) for c in others]
    return grown.groupBy(key).agg(*columns).where("growth IS NOT NULL")
