"""Equity-market operators: price grids, breadth, windows of prices, group valuations, flows.

All take bars of (symbol, date, close, volume, value), instruments of (symbol, exchange, sector, shares) or flows of
(code, date, buy_val, sell_val, total_value). Per-symbol windows shuffle once by symbol; sums per day or group combine
before they shuffle. Windows over whole days run on the aggregated day table, whose size is the number of sessions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .temporal import asof_join, dense_grid, filled, full_mean, horizon_prices, running_product, with_range, with_running_means


def by_symbol():
    return Window.partitionBy("symbol").orderBy("date")


def price_grid(bars: DataFrame, limit: int | None = 20) -> DataFrame:
    """Each symbol on each session of its life, with `px`: the close filled forward over at most `limit` sessions."""
    return dense_grid(bars).withColumn("px", filled("close", "symbol", "sess", limit))


def breadth(bars: DataFrame, means: tuple[int, ...] = (20, 50, 200), year: int = 250, least: int = 120) -> DataFrame:
    """Per session: advances and declines against the last traded close, share above moving averages, yearly extremes.

    Moving averages need a full window, and a price above one is so by more than rounding; yearly extremes need `least` prices. The advance-decline line sums over days.
    """
    # All windows have the order of `sess`, so cells are sorted once.
    before = F.last("close", ignorenulls=True).over(Window.partitionBy("symbol").orderBy("sess").rowsBetween(Window.unboundedPreceding, -1))
    cells = price_grid(bars.select("symbol", "date", "close")).select("symbol", "date", "sess", "close", "px", before.alias("prev"))
    averaged = with_running_means(cells, "px", "symbol", "sess", {f"ma{n}": n for n in means})
    seen = with_range(averaged, "px", "symbol", "sess", year, "lo", "hi", "n52")
    enough = F.col("n52") >= least
    daily = seen.groupBy("date").agg(
        F.count_if(F.col("close") > F.col("prev")).alias("adv"),
        F.count_if(F.col("close") < F.col("prev")).alias("decl"),
        F.count_if(F.col("close") == F.col("prev")).alias("unch"),
        F.count("close").alias("traded"),
        *[F.count_if(F.col("px") > F.col(f"ma{n}") * (1 + 1e-9)).alias(f"above{n}") for n in means],
        F.count_if(enough & (F.col("px") >= F.col("hi"))).alias("highs"),
        F.count_if(enough & (F.col("px") <= F.col("lo"))).alias("lows"),
    )
    days = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    share = F.round(F.try_divide(100.0 * F.col("adv"), F.col("traded")) + 1e-9, 4)
    return daily.select("date", "adv", "decl", "unch", "traded", share.alias("pct_adv"), F.sum(F.col("adv") - F.col("decl")).over(days).alias("ad_line"), *[f"above{n}" for n in means], "highs", "lows")


def moving_averages(bars: DataFrame, means: tuple[int, ...], volume_rows: int = 20) -> DataFrame:
    sums = F.sum("volume").over(by_symbol().rowsBetween(-(volume_rows - 1), 0))
    return bars.select("*", *[full_mean("close", by_symbol(), n).alias(f"ma{n}") for n in means], sums.alias(f"volume{volume_rows}"))


def year_range(bars: DataFrame, rows: int = 250, least: int = 120) -> DataFrame:
    """Highest and lowest close of the last `rows` trades, null with fewer than `least`."""
    enough = F.col("_n") >= least
    return with_range(bars, "close", "symbol", "date", rows, "_lo", "_hi", "_n").select(*bars.columns, F.when(enough, F.col("_hi")).alias("high52"), F.when(enough, F.col("_lo")).alias("low52"))


def calendar_yoy(bars: DataFrame) -> DataFrame:
    """Growth against the last value at or before the same day a year earlier."""
    asked = bars.withColumn("year_ago", F.add_months("date", -12))
    past = bars.select("symbol", F.col("date").alias("past_date"), F.col("close").alias("past_close"))
    found = asof_join(asked, past, "symbol", "year_ago", "past_date", ["past_close"])
    return found.withColumn("yoy", F.try_divide(F.col("close"), F.col("past_close")) - 1)


def daily_caps(bars: DataFrame, instruments: DataFrame, group_sector: str) -> DataFrame:
    """Per day: capitalisation of all traded names and of one group (null on days it doesn't trade)."""
    cap = F.col("close") * F.col("shares")
    return bars.join(instruments, "symbol").groupBy("date").agg(F.sum(cap).alias("cap"), F.sum(F.when(F.col("sector") == group_sector, cap)).alias("grp"))


def chained_ex_group(bars: DataFrame, instruments: DataFrame, group_sector: str) -> DataFrame:
    """Index without a group: R = (R_index - w_prev r_group) / (1 - w_prev), chained from the first value.

    Where the group's return is missing, or it was the whole index, the day takes the index's own return; returns are
    kept above -99 % so that the chain stays positive.
    """
    days = Window.orderBy("date")
    lagged = daily_caps(bars, instruments, group_sector).select("*", F.lag("cap").over(days).alias("pc"), F.lag("grp").over(days).alias("pg"), F.first("cap").over(days).alias("first_cap"))
    weight, own, group = F.col("pg") / F.col("pc"), F.col("cap") / F.col("pc") - 1, F.col("grp") / F.col("pg") - 1
    r = F.when(F.col("pc").isNull(), 0.0).when(group.isNull() | (weight >= 1), own).otherwise(F.greatest(F.try_divide(own - weight * group, 1 - weight), F.lit(-0.99)))
    chained = F.col("first_cap") * running_product(1 + r, days.rowsBetween(Window.unboundedPreceding, 0))
    return lagged.select("date", chained.alias("chained"))


def back_adjusted(source: DataFrame, other: DataFrame, venues: DataFrame, listed: tuple[str, ...], least: float = 0.004) -> DataFrame:
    """Closes of `source` (symbol, date, close, ref) brought to the level of an adjusted series `other` (symbol, date, close).

    On common days the factor is the ratio of both closes, rounded to four places; it is carried forward, then back, within
    a symbol, and is 1 where the series never meet. After the other's last day, a reference price more than `least` off the
    close before it is an event, on the `listed` venues of `venues` (symbol, exchange) only; every close before it is
    multiplied by it.
    """
    ends = other.groupBy("symbol").agg(F.max("date").alias("_end"))
    met = source.join(other.select("symbol", "date", F.col("close").alias("_other")), ["symbol", "date"], "left").join(ends, "symbol", "left").join(venues.select("symbol", "exchange"), "symbol", "left")
    upto = by_symbol().rowsBetween(Window.unboundedPreceding, 0)
    whole = by_symbol().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    step = F.col("ref") / F.lag("close").over(by_symbol())
    after = F.col("_end").isNull() | (F.col("date") > F.col("_end"))
    event = F.when(after & F.col("exchange").isin(*listed) & (F.abs(step - 1) > least), step).otherwise(1.0)
    marked = met.withColumns({"_ahead": F.last(F.round(F.col("_other") / F.col("close"), 4), ignorenulls=True).over(upto), "_event": event})
    # What follows a row is taken from the whole and what came so far: frames that end with the series cost its length for every row.
    level = F.coalesce("_ahead", F.first("_ahead", ignorenulls=True).over(whole), F.lit(1.0))
    total, so_far = (F.coalesce(F.sum(F.log("_event")).over(w), F.lit(0.0)) for w in (whole, upto))
    later = F.exp(total - so_far)
    factored = marked.withColumn("factor", level * later)
    return factored.select(*source.columns, "factor", (F.col("close") * F.col("factor")).alias("adjusted"))


def rolling_z(bars: DataFrame, rows: int) -> DataFrame:
    """(close - mean) / sample deviation of the last `rows` closes, once there are so many."""
    span = by_symbol().rowsBetween(-(rows - 1), 0)
    z = F.try_divide(F.col("close") - F.avg("close").over(span), F.stddev_samp("close").over(span))
    return bars.withColumn("z", F.when(F.count("close").over(span) == rows, z))


def signals(bars: DataFrame, rows: int) -> DataFrame:
    """Bands of the z value, a quiet-volume flag and entry tiers."""
    scored = rolling_z(bars, rows).withColumn("v20", F.avg("volume").over(by_symbol().rowsBetween(-19, 0))).where("z IS NOT NULL")
    quiet = F.col("volume") < F.col("v20")
    tier = F.when((F.col("z") <= -1.5) & quiet, 2).when(F.col("z") <= -1, 1).otherwise(0)
    band = F.when(F.col("z") <= -2, "deep").when(F.col("z") <= -1, "low").when(F.col("z") >= 2, "high").otherwise("mid")
    return scored.select("symbol", "date", tier.alias("tier"), band.alias("band"), quiet.alias("quiet"))


def trailing_stop(bars: DataFrame, limit: float, tight: float, gain: float) -> DataFrame:
    """First session at which the close is `limit` below its peak; `tight` once the peak is `gain` above the entry."""
    upto = by_symbol().rowsBetween(Window.unboundedPreceding, 0)
    marked = bars.select("symbol", "date", "close", F.max("close").over(upto).alias("peak"), F.first("close").over(upto).alias("entry_close"))
    allowed = F.when(F.col("peak") / F.col("entry_close") >= 1 + gain, tight).otherwise(limit)
    out = F.col("close") / F.col("peak") - 1 <= -allowed
    return marked.groupBy("symbol").agg(F.min("date").alias("entry"), F.min(F.when(out, F.col("date"))).alias("exit"), F.max("peak").alias("peak"))


def latest(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The newest row per key, as one aggregation (no sort of whole groups)."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), order).alias("_row")).select("_row.*")


def basket_profit(bars: DataFrame, tranches: DataFrame, limit: float = 0.3, tight: float = 0.2, gain: float = 0.2) -> DataFrame:
    """Profit of lots per day: each tranche (lot, symbol, entry, invested) is worth invested * price / entry price from its entry on.

    The entry price is the last close at or before the entry; a day without a close takes the last one. `stop` is the
    profit at which the trailing stop cuts the lot: `limit` below the peak, `tight` once the peak profit reaches `gain`.
    """
    entered = asof_join(tranches, bars.select("symbol", F.col("date").alias("_day"), F.col("close").alias("entry_close")), "symbol", "entry", "_day", ["entry_close"]).where("entry_close IS NOT NULL")
    # A lot's days are the sessions of its members from its first entry to the last close of any.
    priced = price_grid(bars, limit=None).select("symbol", "date", "px")
    worth = entered.join(priced, "symbol").where(F.col("date") >= F.col("entry")).groupBy("lot", "date").agg(F.sum(F.col("invested") * F.col("px") / F.col("entry_close")).alias("worth"), F.sum("invested").alias("invested"))
    profit = worth.withColumn("profit", F.col("worth") / F.col("invested") - 1)
    upto = Window.partitionBy("lot").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    peaked = profit.withColumn("peak", F.max("profit").over(upto))
    allowed = F.when(F.col("peak") >= gain, tight).otherwise(limit)
    return peaked.withColumn("stop", (1 + F.col("peak")) * (1 - allowed) - 1)


def valuation(bars: DataFrame, instruments: DataFrame, fundamentals: DataFrame) -> DataFrame:
    """symbol, sector, exchange, close, cap at the last close, with the fundamentals (symbol, earnings, book, dividends, expected; any may be null)."""
    last = bars.groupBy("symbol").agg(F.max_by("close", "date").alias("close"))
    named = ("earnings", "book", "dividends", "expected")
    return instruments.join(last, "symbol").join(fundamentals, "symbol", "left").select("symbol", "sector", "exchange", "close", (F.col("close") * F.col("shares")).alias("cap"), *named)


def same_members(value: str):
    """Sum of caps of the members that have the value, over the sum of the value; null unless that is positive."""
    total = F.sum(value)
    return F.when(total > 0, F.sum(F.when(F.col(value).isNotNull(), F.col("cap"))) / total)


def aggregate_pe(valued: DataFrame) -> DataFrame:
    """Price-earnings and price-book of the market, its exchanges and their sectors, by one pass of grouping sets."""
    level = F.when(F.grouping("exchange") == 1, "all").when(F.grouping("sector") == 1, "exchange").otherwise("sector")
    gain = F.col("earnings") > 0
    ex_loss = F.sum(F.when(gain, F.col("cap"))) / F.sum(F.when(gain, F.col("earnings")))
    sets = valued.groupingSets([[], ["exchange"], ["exchange", "sector"]], "exchange", "sector")
    return sets.agg(level.alias("level"), F.count("*").alias("members"), same_members("earnings").alias("pe"), ex_loss.alias("pe_ex_loss"), same_members("book").alias("pb"))


def snapshot(valued: DataFrame) -> DataFrame:
    """Per sector of `valuation` rows: price-earnings, price-book, expected price-earnings, dividend yield, cap-weighted return on equity and coverage."""
    has = F.col("earnings").isNotNull()
    both = (F.col("book") > 0) & has
    roe = F.sum(F.when(both, F.col("earnings") / F.col("book") * F.col("cap"))) / F.sum(F.when(both, F.col("cap")))
    coverage = F.sum(F.when(has, F.col("cap")).otherwise(0.0)) / F.sum("cap")
    return valued.groupBy("sector").agg(F.count("*").alias("members"), same_members("earnings").alias("pe"), same_members("book").alias("pb"), same_members("expected").alias("forward_pe"), F.try_divide(F.sum("dividends"), F.sum(F.when(F.col("dividends").isNotNull(), F.col("cap")))).alias("dividend_yield"), roe.alias("roe"), coverage.alias("coverage"))


def ratios_long(valued: DataFrame) -> DataFrame:
    """symbol, ratio, value rows; ratios that can't be computed have none."""
    wide = valued.select("symbol", "cap", "close", F.try_divide(F.col("cap"), F.col("earnings")).alias("pe"), F.try_divide(F.col("cap"), F.col("book")).alias("pb"))
    return wide.unpivot(["symbol"], ["cap", "close", "pe", "pb"], "ratio", "value").where("value IS NOT NULL")


def ratio_pivot(long: DataFrame) -> DataFrame:
    """Ratios side by side with what they imply: trailing earnings, equity, return, earnings yield and earnings at the price level."""
    wide = long.groupBy("symbol").pivot("ratio", ["cap", "close", "pe", "pb"]).agg(F.max("value"))
    implied = {"ln_ttm": F.col("cap") / F.col("pe"), "gtss": F.col("cap") / F.col("pb"), "roe": F.col("pb") / F.col("pe"), "earnings_yield": 1 / F.col("pe"), "eps_index": F.col("close") / F.col("pe")}
    return wide.withColumns(implied)


def ex_group_valuation(bars: DataFrame, instruments: DataFrame, group_sector: str) -> DataFrame:
    """Market capitalisation without a group; days before the group is listed subtract nothing."""
    rest = F.col("cap") - F.coalesce("grp", F.lit(0.0))
    return daily_caps(bars, instruments, group_sector).select("date", "cap", rest.alias("cap_ex"), (rest / F.col("cap")).alias("share_ex"))


def valuation_without(market: DataFrame, members: DataFrame) -> DataFrame:
    """The market's valuation without some names, per day: `market` has (date, cap, earnings, book), `members` (code, date, cap, earnings, book).

    A name counts from its first day with a book value. A day on which one of them has a capitalisation but no earnings has
    no price-earnings ratio without them, and likewise for book values; days before any of them is listed subtract nothing.
    """
    live = members.where("book IS NOT NULL").groupBy("code").agg(F.min("date").alias("_live"))
    rows = members.join(live, "code").where(F.col("date") >= F.col("_live"))

    def summed(c: str) -> Column:
        lacking = F.count_if(F.col("cap").isNotNull() & F.col(c).isNull())
        return F.when(lacking == 0, F.coalesce(F.sum(c), F.lit(0.0)))

    out = rows.groupBy("date").agg(F.coalesce(F.sum("cap"), F.lit(0.0)).alias("_cap"), summed("earnings").alias("_earnings"), summed("book").alias("_book"), F.count("cap").alias("names"))
    joined = market.join(out, "date", "left")
    none = F.col("names").isNull()
    cap, earnings, book = (F.col(c) - F.when(none, 0.0).otherwise(F.col(f"_{c}")) for c in ("cap", "earnings", "book"))
    return joined.select(
        "date", F.coalesce("names", F.lit(0)).alias("names"), cap.alias("cap_ex"), F.try_divide(cap, earnings).alias("pe_ex"), F.try_divide(cap, book).alias("pb_ex"),
        F.try_divide("earnings", "book").alias("roe"), F.try_divide(earnings, book).alias("roe_ex"), F.try_divide(F.coalesce("_cap", F.lit(0.0)), "cap").alias("share"),
    )


def market_per_share(valued: DataFrame, market: DataFrame, unit: float = 1.0, limit: int = 20) -> DataFrame:
    """Earnings and book per share of the market: `valued` has (symbol, date, close, cap), `market` (date, cap, earnings, book).

    A name's shares are its capitalisation over its price; they and the capitalisation are carried over at most `limit`
    sessions. `cap_check` is the sum of the names' capitalisations over the market's.
    """
    shares = valued.where("close > 0 AND cap > 0").select("symbol", "date", (F.col("cap") / (F.col("close") * unit)).alias("shares"), "cap")
    dense = dense_grid(shares)
    carried = dense.select("date", filled("shares", "symbol", "sess", limit).alias("shares"), filled("cap", "symbol", "sess", limit).alias("cap"))
    daily = carried.groupBy("date").agg(F.count("shares").alias("names"), F.sum("shares").alias("shares"), F.sum("cap").alias("_cap"))
    joined = daily.join(market, "date", "left")
    return joined.select("date", "names", "shares", F.try_divide("earnings", "shares").alias("eps"), F.try_divide("book", "shares").alias("bvps"), F.try_divide("_cap", "cap").alias("cap_check"))


def turnover_by_venue(official: DataFrame, bars: DataFrame, instruments: DataFrame, venues: list[str], main: str) -> DataFrame:
    """Turnover per day and venue: the official value (exchange, date, value), else price times volume of its bars, with their total,
    its means over 20 and 50 sessions, and whether the main venue's value is official."""
    estimated = bars.join(instruments, "symbol").groupBy("exchange", "date").agg(F.sum(F.col("close") * F.col("volume")).alias("est"))
    both = official.select("exchange", "date", "value").join(estimated, ["exchange", "date"], "full_outer").where(F.col("exchange").isin(venues))
    cells = [F.sum(F.when(F.col("exchange") == v, F.coalesce("value", "est"))).alias(v) for v in venues]
    daily = both.groupBy("date").agg(*cells, F.sum(F.coalesce("value", "est")).alias("total"), F.count(F.when(F.col("exchange") == main, F.col("value"))).alias("_n")).where("total IS NOT NULL")
    days = Window.orderBy("date")
    return daily.select("date", *venues, "total", full_mean("total", days, 20).alias("ma20"), full_mean("total", days, 50).alias("ma50"), F.when(F.col("_n") > 0, "official").otherwise("estimate").alias("source"))


def size_buckets(bars: DataFrame, instruments: DataFrame, since: str, end: str, top: int = 30, middle: int = 100) -> DataFrame:
    """Capitalisation per day of the `top` largest names by the period's last day, of those up to `middle`, and of the rest."""
    inside = price_grid(bars).where(F.col("date").between(F.lit(since).cast("date"), F.lit(end).cast("date"))).join(instruments, "symbol").withColumn("cap", F.col("px") * F.col("shares"))
    last = inside.agg(F.max("date").alias("_last"))
    # One row per name with a price on that day.
    ranked = inside.join(F.broadcast(last), F.col("date") == F.col("_last")).where("cap IS NOT NULL").select("symbol", F.rank().over(Window.orderBy(F.desc("cap"))).alias("_rank"))
    sized = inside.join(ranked, "symbol", "left")
    size = F.when(F.col("_rank") <= top, "top").when(F.col("_rank") <= middle, "middle").when(F.col("_rank").isNotNull(), "small")
    return sized.groupBy("date").agg(*[F.coalesce(F.sum(F.when(size == n, F.col("cap"))), F.lit(0.0)).alias(n) for n in ("top", "middle", "small")], F.coalesce(F.sum("cap"), F.lit(0.0)).alias("all"))


def market_cap_filled(bars: DataFrame, instruments: DataFrame, limit: int = 20) -> DataFrame:
    priced = price_grid(bars, limit).join(instruments, "symbol")
    return priced.groupBy("date").agg(F.count("px").alias("members"), F.sum(F.col("px") * F.col("shares")).alias("cap"))


def turnover(bars: DataFrame, instruments: DataFrame, rows: int = 20) -> DataFrame:
    daily = bars.join(instruments, "symbol").groupBy("exchange", "date").agg(F.sum("value").alias("turnover"))
    return daily.withColumn(f"ma{rows}", full_mean("turnover", Window.partitionBy("exchange").orderBy("date"), rows))


def sector_index(bars: DataFrame, instruments: DataFrame, since: str, end: str) -> DataFrame:
    """Sector capitalisation rebased to 100, of the members that have a price at both ends of the period."""
    inside = price_grid(bars).where(F.col("date").between(F.lit(since).cast("date"), F.lit(end).cast("date"))).join(instruments, "symbol")
    ends = inside.agg(F.min("date").alias("d0"), F.max("date").alias("d1"))
    priced_at = [F.count_if((F.col("date") == F.col(d)) & F.col("px").isNotNull()) for d in ("d0", "d1")]
    fixed = inside.join(F.broadcast(ends)).groupBy("symbol").agg(*[n.alias(f"n{k}") for k, n in enumerate(priced_at)]).where("n0 > 0 AND n1 > 0").select("symbol")
    daily = inside.join(fixed, "symbol", "left_semi").groupBy("sector", "date").agg(F.count("px").alias("members"), F.sum(F.col("px") * F.col("shares")).alias("cap"))
    return daily.withColumn("idx", 100 * F.col("cap") / F.first("cap").over(Window.partitionBy("sector").orderBy("date")))


def cap_weighted_returns(bars: DataFrame, instruments: DataFrame, as_of: str) -> DataFrame:
    """Returns of sectors over several horizons, weighted by capitalisation at the start."""
    day = F.lit(as_of).cast("date")
    months = {"1M": 1, "3M": 3, "6M": 6, "1Y": 12, "2Y": 24, "3Y": 36, "5Y": 60}
    cuts = {"1D": F.date_sub(day, 1), "1W": F.date_sub(day, 7), **{k: F.add_months(day, -n) for k, n in months.items()}, "YTD": F.date_sub(F.trunc(day, "year"), 1)}
    spark = bars.sparkSession
    horizons = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(k).alias("horizon"), v.alias("cutoff")) for k, v in cuts.items()])).alias("h")).select("h.*")
    start = horizon_prices(bars, horizons).withColumnRenamed("price", "p0")
    end = bars.where(F.col("date") <= day).groupBy("symbol").agg(F.max_by("close", "date").alias("p1"))
    joined = start.join(end, "symbol").join(instruments, "symbol")
    weight = F.col("p0") * F.col("shares")
    return joined.groupBy("sector", "horizon").agg(F.count("*").alias("members"), (F.sum((F.col("p1") / F.col("p0") - 1) * weight) / F.sum(weight)).alias("ret"))


def heatmap(bars: DataFrame, instruments: DataFrame, rows: int, n: int) -> DataFrame:
    """The n largest names with their change over `rows` trades."""
    lagged = bars.withColumn("before", F.lag("close", rows).over(by_symbol()))
    now = latest(lagged, ["symbol"], "date").join(instruments, "symbol")
    cap = F.col("close") * F.col("shares")
    return now.select("symbol", "sector", cap.alias("cap"), (F.col("close") / F.col("before") - 1).alias("change")).orderBy(F.desc("cap"), "symbol").limit(n)


def flows_by_period(flows: DataFrame, instruments: DataFrame, unit: str) -> DataFrame:
    """Net flows by sector and period (stamped at its last day), with the number of codes."""
    end = {"month": F.last_day("date"), "week": F.next_day(F.date_sub("date", 1), "Fri"), "day": F.col("date")}[unit]
    joined = flows.join(instruments, flows.code == instruments.symbol)
    return joined.groupBy("sector", end.alias("period")).agg(F.countDistinct("code").alias("codes"), F.sum(F.col("buy_val") - F.col("sell_val")).alias("net"))


def both_tails(flows: DataFrame, n: int) -> DataFrame:
    net = flows.groupBy("code").agg(F.sum(F.col("buy_val") - F.col("sell_val")).alias("net"))
    top = net.orderBy(F.desc("net"), "code").limit(n).select(F.lit("buy").alias("side"), "*")
    return top.unionByName(net.orderBy("net", "code").limit(n).select(F.lit("sell").alias("side"), "*"))


def flow_drilldown(flows: DataFrame) -> DataFrame:
    net, bought = F.col("buy_val") - F.col("sell_val"), F.when(F.col("buy_val") > 0, F.col("date"))
    return flows.groupBy("code").agg(F.sum(net).alias("net"), F.try_divide(F.sum(net), F.sum("total_value")).alias("share"), F.count_if(net > 0).alias("up_days"), F.count_if(net < 0).alias("down_days"), F.min(bought).alias("first_day"), F.max(bought).alias("last_day"))


def venue_flows(flows: DataFrame, instruments: DataFrame) -> DataFrame:
    """Net flow per venue and day, its running sum, and the turnover of all other investors."""
    joined = flows.join(instruments, flows.code == instruments.symbol)
    daily = joined.groupBy("exchange", "date").agg(F.sum(F.col("buy_val") - F.col("sell_val")).alias("net"), F.sum(F.col("total_value") - F.col("buy_val") - F.col("sell_val")).alias("others"))
    upto = Window.partitionBy("exchange").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("cumulative", F.sum("net").over(upto))


def monthly_turnover(bars: DataFrame) -> DataFrame:
    """Mean daily turnover per month; the newest month is unfinished unless its last day has traded."""
    daily = bars.groupBy("date").agg(F.sum("value").alias("v"))
    months = daily.groupBy(F.last_day("date").alias("month")).agg(F.count("*").alias("sessions"), F.avg("v").alias("mean_turnover"), F.max("date").alias("last"))
    newest = F.max("last").over(Window.partitionBy())
    return months.withColumn("unfinished", (F.col("last") == newest) & (F.col("last") < F.col("month"))).drop("last")


def own_history_quintiles(bars: DataFrame, years: int = 5, least: int = 12) -> DataFrame:
    """Per month: how many names stand in which fifth of their own past `years` of month-end prices."""
    month_end = bars.groupBy("symbol", F.last_day("date").alias("month")).agg(F.max_by("close", "date").alias("px"))
    past = month_end.select("symbol", F.col("month").alias("m"), F.col("px").alias("p"))
    pairs = month_end.join(past, "symbol").where((F.col("m") < F.col("month")) & (F.col("m") >= F.add_months("month", -12 * years)))
    ranked = pairs.groupBy("symbol", "month").agg(F.count("*").alias("n"), F.count_if(F.col("p") < F.col("px")).alias("below")).where(F.col("n") >= least)
    fifth = 1 + F.least(F.floor(5.0 * F.col("below") / F.col("n")), F.lit(4)).cast("int")
    return ranked.groupBy("month", fifth.alias("quintile")).agg(F.count("*").alias("names"))


def growth_by_group(bars: DataFrame, instruments: DataFrame) -> DataFrame:
    """Value per member of a sector and year, and its growth over the absolute base."""
    level = bars.join(instruments, "symbol").groupBy("sector", F.year("date").alias("year")).agg((F.sum("value") / F.countDistinct("symbol")).alias("level"))
    before = F.lag("level").over(Window.partitionBy("sector").orderBy("year"))
    return level.withColumn("growth", F.try_divide(F.col("level") - before, F.abs(before)))


def liquidity(bars: DataFrame, instruments: DataFrame) -> DataFrame:
    return bars.join(instruments, "symbol").withColumn("liquidity", F.col("close") * F.col("volume") / 1e6)


def top_by_cap(bars: DataFrame, instruments: DataFrame, n: int, least_sessions: int) -> DataFrame:
    summed = bars.groupBy("symbol").agg(F.count("*").alias("sessions"), F.max_by("close", "date").alias("close")).where(F.col("sessions") >= least_sessions)
    return summed.join(instruments, "symbol").withColumn("cap", F.col("close") * F.col("shares")).orderBy(F.desc("cap"), "symbol").limit(n)


def top_by_size(flows: DataFrame, n: int) -> DataFrame:
    return flows.withColumn("net", F.col("buy_val") - F.col("sell_val")).orderBy(F.desc(F.abs("net")), "code", "date").limit(n)


def insider_tables(flows: DataFrame) -> DataFrame:
    """Per month and code: number of days, sum bought and the largest net trade by size."""
    net = F.col("buy_val") - F.col("sell_val")
    return flows.groupBy(F.last_day("date").alias("month"), "code").agg(F.count("*").alias("trades"), F.sum("buy_val").alias("bought"), F.max_by(net, F.struct(F.abs(net), "date")).alias("largest"))
