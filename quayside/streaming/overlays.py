"""Today's rows: what the live board adds to the stored history of turnover, breadth, flows, valuations, sectors and bars.

The board has one row per name: symbol, exchange, sector, shares, kind, price, ref, ceiling, floor, open, high, low, volume,
value, buy_val, sell_val. Every overlay replaces rows of the same day, so it can be computed as often as the board changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.temporal import filled, sessions
from .live import with_today


def board_state(ticks: DataFrame) -> DataFrame:
    """Open, high, low, last price, volume, value and both sides' values per symbol; ticks are (symbol, ts, price, volume, side)."""
    at, value = F.struct("ts", "price"), F.col("price") * F.col("volume")
    side = {n: F.sum(F.when(F.col("side") == s, value).otherwise(0.0)).alias(f"{n}_val") for n, s in {"buy": "buy", "sell": "sell"}.items()}
    return ticks.groupBy("symbol").agg(F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("price"), F.sum("volume").alias("volume"), F.sum(value).alias("value"), *side.values())


def venue_totals(board: DataFrame, future: str | int, index: str | int) -> DataFrame:
    """Per venue, of ordinary shares only: names, advances, declines, unchanged, at the ceiling, at the floor, value, bought, sold,
    net; and the future's price over its index's, null if either is missing."""
    change = F.col("price") - F.col("ref")
    shares = board.where(F.col("kind").isNull() | (F.col("kind") == "share"))
    per = shares.groupBy("exchange").agg(
        F.count("*").alias("n"), F.count_if(change > 0).alias("advances"), F.count_if(change < 0).alias("declines"), F.count_if(change == 0).alias("unchanged"),
        F.count_if(F.col("price") == F.col("ceiling")).alias("at_ceiling"), F.count_if(F.col("price") == F.col("floor")).alias("at_floor"),
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(n) for c, n in (("value", "value"), ("buy_val", "bought"), ("sell_val", "sold"))],
    )
    last = [F.max(F.when(F.col("symbol") == s, F.col("price"))) for s in (future, index)]
    return per.withColumn("net", F.col("bought") - F.col("sold")).join(F.broadcast(board.agg((last[0] - last[1]).alias("basis"))))


def _today(day: str) -> Column:
    return F.lit(day).cast("date")


def turnover_today(history: DataFrame, board: DataFrame, day: str, means: tuple[int, ...] = (20, 50)) -> DataFrame:
    """Turnover (date, total, and a mean `ma{n}` per n of `means`) with today's row, whose means need n - 1 sessions before it."""
    past = history.where(F.col("date") < _today(day)).select("date", "total", *[f"ma{n}" for n in means])
    live = board.agg(F.sum("value").alias("total")).where("total IS NOT NULL")
    newest = past.orderBy(F.desc("date")).limit(max(means) - 1)  # the window of the means
    near = newest.agg(F.array_sort(F.collect_list(F.struct((-F.unix_date("date")).alias("d"), F.col("total").alias("v")))).alias("_past"))

    def mean(n: int) -> Column:
        taken = F.slice("_past", 1, n - 1)
        total = F.aggregate(taken, F.lit(0.0), lambda a, p: a + p["v"]) + F.col("total")
        return F.when(F.size(taken) == n - 1, total / n)

    today = live.join(F.broadcast(near)).select(_today(day).alias("date"), "total", *[mean(n).alias(f"ma{n}") for n in means])
    return past.unionByName(today)


def last_sessions(bars: DataFrame, n: int, limit: int = 20) -> DataFrame:
    """symbol, back, px on the last n sessions (back 0 is the last), closes carried on over at most `limit` sessions, up to the last one of all."""
    numbered = bars.select("symbol", "date", "close").join(sessions(bars), "date")
    newest = numbered.agg(F.max("sess").alias("_top"))
    near = numbered.join(F.broadcast(newest)).where(F.col("sess") > F.col("_top") - n - limit)
    lives = near.groupBy("symbol", "_top").agg(F.min("sess").alias("_first"))
    cells = lives.select("symbol", "_top", F.explode(F.sequence("_first", "_top")).alias("sess"))
    priced = cells.join(near.select("symbol", "sess", "close"), ["symbol", "sess"], "left").withColumn("px", filled("close", "symbol", "sess", limit))
    return priced.select("symbol", (F.col("_top") - F.col("sess")).alias("back"), "px").where(F.col("back") < n)


def counts_today(board: DataFrame) -> DataFrame:
    """Advances, declines, unchanged and traded names of the board, the share of advances among movers in percent, and their balance."""
    change = F.col("price") - F.col("ref")
    per = board.agg(F.count_if(change > 0).alias("adv"), F.count_if(change < 0).alias("decl"), F.count_if(change == 0).alias("unch"), F.count(change).alias("traded"))
    return per.withColumns({"pct_adv": 100.0 * F.try_divide("adv", F.col("adv") + F.col("decl")), "balance": F.col("adv") - F.col("decl")})


def levels_today(board: DataFrame, bars: DataFrame, day: str, windows: tuple[int, ...] = (20, 50, 100, 200, 300), limit: int = 20) -> DataFrame:
    """Per window and venue (null: all): names with a full window up to today, and how many stand above and below their mean.

    A name that didn't trade today stands at its last price. One beyond its mean is so by more than rounding.
    """
    past = last_sessions(bars.where(F.col("date") < _today(day)), max(windows), limit)
    inside = {w: F.when(F.col("back") <= w - 2, F.col("px")) for w in windows}
    sums = [f(c).alias(f"_{k}{w}") for w, c in inside.items() for k, f in (("s", F.sum), ("n", F.count))]
    per = past.groupBy("symbol").agg(F.max(F.when(F.col("back") == 0, F.col("px"))).alias("_last"), *sums)
    joined = per.join(board.select("symbol", "price"), "symbol", "left").withColumn("p", F.coalesce("price", "_last")).where("p IS NOT NULL")
    each = [F.struct(F.lit(w).alias("w"), F.when(F.col(f"_n{w}") == w - 1, (F.coalesce(f"_s{w}", F.lit(0.0)) + F.col("p")) / w).alias("ma")) for w in windows]
    return joined.select("symbol", "p", F.explode(F.array(*each)).alias("_x")).select("symbol", "p", "_x.w", "_x.ma").where("ma IS NOT NULL")


def levels_by_venue(levels: DataFrame, instruments: DataFrame) -> DataFrame:
    """`levels_today` counted per window for all names and for each venue."""
    joined = levels.join(instruments.select("symbol", "exchange"), "symbol")
    sets = joined.groupingSets([["w"], ["w", "exchange"]], "w", "exchange")
    out = sets.agg(F.count("*").alias("names"), F.count_if(F.col("p") > F.col("ma") * (1 + 1e-9)).alias("above"), F.count_if(F.col("p") < F.col("ma") * (1 - 1e-9)).alias("below"))
    return out.withColumns({"pct_above": 100.0 * F.col("above") / F.col("names"), "pct_below": 100.0 * F.col("below") / F.col("names")})


def flows_today(history: DataFrame, board: DataFrame, day: str) -> DataFrame:
    """Net flows (date, exchange, net) with today's, and the running sum over days per venue."""
    live = board.groupBy("exchange").agg(F.sum(F.col("buy_val") - F.col("sell_val")).alias("net")).where("net IS NOT NULL")
    past = history.where(F.col("date") < _today(day)).groupBy("exchange").agg(F.sum("net").alias("_past"))
    joined = live.join(past, "exchange", "left")
    today = joined.select(_today(day).alias("date"), "exchange", "net", (F.coalesce("_past", F.lit(0.0)) + F.col("net")).alias("cumulative"))
    stored = history.select("date", "exchange", "net", F.lit(None).cast("double").alias("cumulative"))
    return with_today(stored, today, "date", day)


def investors_today(board: DataFrame) -> DataFrame:
    """Today's turnover by investor: half of what the reporting one bought and sold, and the rest."""
    own = F.sum(F.coalesce("buy_val", F.lit(0.0)) + F.coalesce("sell_val", F.lit(0.0))) / 2
    return board.agg(own.alias("reported"), (F.sum("value") - own).alias("others"))


def bars_today(history: DataFrame, board: DataFrame, day: str) -> DataFrame:
    """Bars (symbol, date, close, volume, value) with today's from the board; names without a price have none."""
    today = board.where("price IS NOT NULL").select("symbol", _today(day).alias("date"), F.col("price").alias("close"), "volume", "value")
    return with_today(history.select(*today.columns), today, "date", day)


def cap_ratios(board: DataFrame, group: str, least: int = 5) -> DataFrame:
    """Capitalisation now over that at reference prices, per group; null with fewer than `least` names."""
    whole = board.where("shares IS NOT NULL AND price IS NOT NULL AND ref > 0")
    ratio = F.sum(F.col("price") * F.col("shares")) / F.sum(F.col("ref") * F.col("shares"))
    return whole.groupBy(group).agg(F.when(F.count("*") >= least, ratio).alias("ratio"))


def scaled_today(history: DataFrame, ratios: DataFrame, group: str, columns: list[str], day: str, carried: bool = True) -> DataFrame:
    """History (group, date, columns) with today's row per group: the newest values times the group's ratio.

    With `carried` each column's newest value counts, otherwise those of the group's last day. Groups without ratio or values have no row.
    """
    past = history.where(F.col("date") < _today(day)).select(group, "date", *columns)
    at = {c: F.when(F.col(c).isNotNull(), F.col("date")) if carried else F.col("date") for c in columns}
    last = past.groupBy(group).agg(*[F.max_by(c, at[c]).alias(c) for c in columns]).join(ratios.where("ratio IS NOT NULL"), group)
    some = F.coalesce(*[F.col(c) for c in columns]).isNotNull()
    return past.unionByName(last.where(some).select(group, _today(day).alias("date"), *[(F.col(c) * F.col("ratio")).alias(c) for c in columns]))
