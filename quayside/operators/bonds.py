"""Bond operators: lot facts, issuer roll-ups, maturity wall, yields by bisection, sector curves.

Lots are (lot, issuer, issue, months, coupon, amount), trades (lot, line, date, price, traded). The yield of a trade
follows from its own schedule, so a table of trades of any size is one narrow pass without a shuffle of its own.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .clean import trimmed
from .temporal import asof_join, interpolated


def issuers(lots: DataFrame, as_of: str) -> DataFrame:
    """Per issuer: amounts by year window, weighted coupon, first and last issue, kinds of term."""
    day = F.lit(as_of).cast("date")
    due = F.add_months("issue", F.col("months"))
    return lots.groupBy("issuer").agg(
        F.count("*").alias("lots"),
        F.sum("amount").alias("amount"),
        F.sum(F.when(due > day, F.col("amount")).otherwise(0.0)).alias("outstanding"),
        F.sum(F.when(F.col("issue") > F.add_months(day, -12), F.col("amount")).otherwise(0.0)).alias("last_year"),
        F.try_divide(F.sum(F.col("coupon") * F.col("amount")), F.sum("amount")).alias("coupon"),
        F.min("issue").alias("first_issue"),
        F.max("issue").alias("last_issue"),
        F.array_join(F.array_sort(F.collect_set(F.col("months").cast("string"))), ",").alias("terms"),
    )


def bought_back(trades: DataFrame) -> DataFrame:
    return trades.groupBy("lot").agg(F.sum("traded").alias("total"), F.count("*").alias("n"), F.max("date").alias("last_date"))


def lot_facts(lots: DataFrame, parents: DataFrame, events: DataFrame, buybacks: DataFrame) -> DataFrame:
    """Master, parent group, credit events and buy-backs side by side; lots without them stay."""
    by_issuer = events.groupBy("issuer").agg(F.count("*").alias("events"))
    out = lots.join(parents, "issuer", "left").join(by_issuer, "issuer", "left").join(buybacks, "lot", "left")
    return out.withColumns({"events": F.coalesce("events", F.lit(0)), "remaining": F.greatest(F.col("amount") - F.coalesce("total", F.lit(0.0)), F.lit(0.0))})


def maturity_wall(lots: DataFrame) -> DataFrame:
    """Amount and weighted coupon falling due per quarter."""
    due = F.add_months("issue", F.col("months"))
    return lots.groupBy(F.year(due).alias("year"), F.quarter(due).alias("quarter")).agg(F.sum("amount").alias("due"), F.count("*").alias("lots"), (F.sum(F.col("coupon") * F.col("amount")) / F.sum("amount")).alias("coupon"))


#: Halvings of a bracket that Newton's steps stand for.
HALVED = 40


def with_yields(lots: DataFrame, trades: DataFrame, steps: int = 60, low: float = -0.5, high: float = 2.0, every: int = 6) -> DataFrame:
    """Every trade with its yield to maturity; null if the bracket [low, high] holds no root.

    A batch's schedules are one array, made from its lots' terms. The logarithm of a bond's worth falls in that of the
    discount and is nearly straight, so Newton's steps from the low end come up to the root within a few, and only the last of
    `steps` halvings are made, so that yields are those of bisection to the last bit; what Newton doesn't solve is halved throughout.
    """

    @F.pandas_udf("double")
    def solved(issue: pd.Series, months: pd.Series, coupon: pd.Series, day: pd.Series, price: pd.Series) -> pd.Series:
        asked, n = price.to_numpy(np.float64), months.to_numpy(np.int64) // every
        issued, traded = issue.to_numpy(np.int64).astype("datetime64[D]"), day.to_numpy(np.int64)
        k = np.arange(1, n.max(initial=1) + 1)
        first = issued.astype("datetime64[M]")
        due = first[:, None] + every * k
        starts = due.astype("datetime64[D]")
        length = ((due + 1).astype("datetime64[D]") - starts).astype(np.int64)
        days = starts.astype(np.int64) + np.minimum((issued - first.astype("datetime64[D]")).astype(np.int64)[:, None], length - 1)
        inside = (days > traded[:, None]) & (k <= n[:, None])
        t = np.where(inside, (days - traded[:, None]) / 365.0, 0.0)
        cf = np.where(inside, (coupon.to_numpy(np.float64) * every / 12)[:, None] + np.where(k == n[:, None], 100.0, 0.0), 0.0)

        def worth(x: np.ndarray, rows=slice(None)) -> np.ndarray:
            return (cf[rows] * np.exp(-t[rows] * x[:, None])).sum(axis=1)

        lo, hi = np.full(len(asked), np.log1p(low)), np.full(len(asked), np.log1p(high))
        at_low = worth(lo)
        rooted = (at_low >= asked) & (worth(hi) <= asked)
        x, ok = lo.copy(), np.zeros(len(asked), bool)
        rows = np.flatnonzero(rooted & (cf >= 0).all(axis=1) & (asked > 0))
        for _ in range(20):
            if not len(rows):
                break
            parts = cf[rows] * np.exp(-t[rows] * x[rows, None])
            now = parts.sum(axis=1)
            with np.errstate(all="ignore"):
                step = np.log(now / asked[rows]) * now / (t[rows] * parts).sum(axis=1)
            x[rows] += step
            done = np.abs(step) < 1e-13
            ok[rows[done]] = True
            rows = rows[~done & np.isfinite(step)]
        out = np.full(len(asked), np.nan)
        # Halving ends alike from the cell of its 40th step that holds the root as from the whole bracket.
        near = np.flatnonzero(ok)
        width = (high - low) / 2.0**HALVED
        a = low + np.floor((np.expm1(x[near]) - low) / width) * width
        held = (worth(np.log1p(a), near) > asked[near]) & (worth(np.log1p(a + width), near) <= asked[near])
        far = np.setdiff1d(np.flatnonzero(rooted), near[held])
        for left, a, b, n in ((near[held], a[held], a[held] + width, steps - HALVED), (far, np.full(len(far), low), np.full(len(far), high), steps)):
            for _ in range(n if len(left) else 0):
                middle = (a + b) / 2
                above = worth(np.log1p(middle), left) > asked[left]
                a, b = np.where(above, middle, a), np.where(above, b, middle)
            out[left] = (a + b) / 2
        return pd.Series(out)  # not a number becomes null

    joined = trades.join(lots, "lot")
    end = F.add_months("issue", F.floor(F.col("months") / every).cast("int") * every)
    open_ = joined.where((F.col("months") >= every) & (end > F.col("date")))
    terms = [F.unix_date("issue").cast("long"), F.col("months").cast("long"), F.col("coupon").cast("double"), F.unix_date("date").cast("long"), F.col("price").cast("double")]
    return open_.withColumns({"ytm": solved(*terms), "years": F.datediff(end, "date") / 365.0})


def judged_yields(yields: DataFrame, curves: DataFrame, kind: Column, method: Column) -> DataFrame:
    """Yields with their spread over a curve in basis points, how far they can be trusted, and notes.

    `curves` has (curve_date, pts: sorted (x, y) in years and per cent); a trade takes the last curve up to its day, at its
    remaining years. Floating and mixed coupons (`kind`) use the first coupon as a proxy; they and unusual ways of payment
    (`method` other) are trusted fairly only. Yields beyond 0 to 40 per cent and prices beyond 50 to 250 are outliers.
    """
    key = F.lit(1).alias("_k")
    days = yields.select("date").distinct().select("*", key)
    known = asof_join(days, curves.select("*", key), "_k", "date", "curve_date", ["pts"], piece_days=366).select("date", "pts")
    joined = yields.join(known, "date", "left")
    spot = F.when(F.col("pts").isNotNull(), interpolated(F.col("pts"), F.col("years")))
    percent = 100 * F.col("ytm")
    proxy = kind.isin("floating", "mixed")
    outlier = ~percent.between(0.0, 40.0) | ~F.col("price").between(50.0, 250.0)
    notes = F.concat_ws(";", F.when(F.col("ytm").isNull(), "unsolved").when(outlier, "outlier"), F.when(proxy, "first_coupon_proxy"))
    return joined.withColumns({"spot": spot, "spread_bps": 100 * (percent - spot), "confidence": F.when(proxy | (method == "other"), "fair").otherwise("high"), "notes": notes}).drop("pts")


def tenor_bucket(years: Column) -> Column:
    return F.when(years < 1, "<1").when(years < 2, "1-2").when(years < 3, "2-3").when(years < 5, "3-5").otherwise("5+")


def sector_curves(yields: DataFrame, as_of: str, look_backs: dict[str, int], window_days: int = 90, least: int = 3) -> DataFrame:
    """Value-weighted yield by sector, tenor bucket and look-back: last trade per lot in the window, trimmed."""
    spark = yields.sparkSession
    # Said of the days alone, this is asked before a yield is solved.
    ranges = [F.col("date").between(F.date_sub(F.lit(as_of).cast("date"), days + window_days - 1), F.date_sub(F.lit(as_of).cast("date"), days)) for days in look_backs.values()]
    yields = yields.where(reduce(or_, ranges))
    ends = spark.createDataFrame(list(look_backs.items()), "look_back string, days int").withColumn("end", F.date_sub(F.lit(as_of).cast("date"), F.col("days")))
    inside = yields.where("ytm IS NOT NULL").join(F.broadcast(ends), (F.col("date") <= F.col("end")) & (F.col("date") > F.date_sub("end", window_days)))
    last = inside.groupBy("look_back", "lot").agg(F.max_by(F.struct("sector", "years", "ytm", "traded"), F.struct("date", "line", "price", "traded")).alias("r")).select("look_back", "lot", "r.*")
    bucketed = last.withColumn("bucket", tenor_bucket(F.col("years")))
    kept = trimmed(bucketed, ["look_back", "sector", "bucket"], "ytm")
    weight = F.sum("traded")
    out = kept.groupBy("look_back", "sector", "bucket").agg(F.count("*").alias("bonds"), (F.sum(F.col("ytm") * F.col("traded")) / weight).alias("ytm"), (F.sum(F.col("years") * F.col("traded")) / weight).alias("years"))
    return out.where(F.col("bonds") >= least)


def standard_tenors(curves: DataFrame, tenors: list[float]) -> DataFrame:
    """Curves at standard tenors, linear in the logarithm of the tenor, flat beyond the ends."""
    points = curves.groupBy("look_back", "sector").agg(F.array_sort(F.collect_list(F.struct(F.log("years").alias("x"), F.col("ytm").alias("y")))).alias("pts"))
    each = points.select("look_back", "sector", "pts", F.explode(F.array(*[F.lit(t) for t in tenors])).alias("tenor"))
    return each.select("look_back", "sector", "tenor", interpolated(F.col("pts"), F.log("tenor")).alias("ytm"))


def curve_snapshot(fx: DataFrame, as_of: str, look_backs: dict[str, int]) -> DataFrame:
    """Per currency the last value at or before each look-back date, side by side."""
    day = F.lit(as_of).cast("date")
    cells = [F.max_by("rate", F.when(F.col("date") <= F.date_sub(day, n), F.col("date"))).alias(k) for k, n in look_backs.items()]
    return fx.groupBy("currency").agg(*cells)
