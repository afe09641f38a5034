"""Who trades: flows of two kinds of investors per name, and the deals of insiders.

Flows are (code, date, buy_val, sell_val, ...) rows. Deals of insiders are (symbol, person, role, kind, announced, from_day,
to_day, plan_buy, plan_sell, done_on, done_buy, done_sell, net_volume, value) rows; what is only registered has no `done_on`.
All tables are sums per name, day or month, which combine before they shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drilldown(flows: DataFrame, instruments: DataFrame) -> DataFrame:
    """Per sector and code: bought, sold, net, net matched, turnover, the investor's share of it in percent, sessions with net
    buying and selling, and the share owned at the first and the last day that tell it, in percent.

    `flows` also has net_match, total_value and owned, each of which may be null. Codes without a trade have no row; a sum
    of nulls only is null.
    """
    net = F.col("buy_val") - F.col("sell_val")
    known = F.when(F.col("owned").isNotNull(), F.col("date"))
    sums = {"bought": F.sum("buy_val"), "sold": F.sum("sell_val"), "net": F.sum(net), "net_match": F.sum("net_match"), "turnover": F.sum("total_value")}
    days = {"up_days": F.count_if(net > 0), "down_days": F.count_if(net < 0)}
    owned = {"owned_first": 100 * F.min_by("owned", known), "owned_last": 100 * F.max_by("owned", known)}
    joined = flows.join(instruments.select(F.col("symbol").alias("code"), "exchange", "sector"), "code")
    per = joined.groupBy("sector", "code", "exchange").agg(*[c.alias(n) for n, c in (sums | days | owned).items()])
    share = 50 * F.try_divide(F.col("bought") + F.col("sold"), "turnover")
    return per.where("bought > 0 OR sold > 0").withColumns({"share": share, "owned_change": F.col("owned_last") - F.col("owned_first")})


def two_investors(first: DataFrame, second: DataFrame, names: tuple[str, str] = ("first", "second")) -> DataFrame:
    """Net flows of two investors per code, their sum, and whether they go the same way, opposite ways or only one of them trades."""

    def nets(flows: DataFrame, name: str) -> DataFrame:
        per = flows.groupBy("code").agg(F.sum("buy_val").alias("_b"), F.sum("sell_val").alias("_s"))
        return per.where("_b > 0 OR _s > 0").select("code", (F.col("_b") - F.col("_s")).alias(name))

    joined = nets(first, names[0]).join(nets(second, names[1]), "code", "full_outer").na.fill(0.0, list(names))
    sign = F.signum(names[0]) * F.signum(names[1])
    way = F.when(sign > 0, "same").when(sign < 0, "opposite").otherwise("one side")
    return joined.select("code", *names, (F.col(names[0]) + F.col(names[1])).alias("total"), way.alias("way"))


def _done(deals: DataFrame) -> DataFrame:
    return deals.where("done_on IS NOT NULL AND value IS NOT NULL")


def _bought() -> Column:
    return F.sum(F.when(F.col("value") > 0, F.col("value")).otherwise(0.0))


def _sold() -> Column:
    return F.sum(F.when(F.col("value") < 0, F.col("value")).otherwise(0.0))


def deals_by_day(deals: DataFrame) -> DataFrame:
    """Values of the whole market per day of execution: net, bought, sold (negative) and number of deals."""
    return _done(deals).groupBy("done_on").agg(F.sum("value").alias("net"), _bought().alias("bought"), _sold().alias("sold"), F.count("*").alias("deals"))


def top_deals(deals: DataFrame, first: str, last: str, n: int) -> DataFrame:
    """The n names that insiders bought most, and sold most, on balance in a period, each with its largest deal by size.

    Equally large deals: the later one, then the person's name, decide. Balances are rounded to a tenth before they are ranked;
    ties go to the smaller symbol.
    """
    inside = _done(deals).where(F.col("done_on").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    largest = F.max_by(F.struct("person", "role", F.col("value").alias("size"), "done_on"), F.struct(F.abs("value"), "done_on", "person", "value"))
    per = inside.groupBy("symbol").agg(F.round(F.sum("value") + 1e-9, 1).alias("net"), F.sum("net_volume").alias("volume"), F.count("*").alias("deals"), largest.alias("_l"))
    rows = per.select("symbol", "net", "volume", "deals", F.col("_l.person").alias("person"), F.col("_l.role").alias("role"), F.col("_l.size").alias("largest"), F.col("_l.done_on").alias("largest_on"))
    most = rows.where("net > 0").orderBy(F.desc("net"), "symbol").limit(n).select(F.lit("bought").alias("side"), "*")
    return most.unionByName(rows.where("net < 0").orderBy("net", "symbol").limit(n).select(F.lit("sold").alias("side"), "*"))


def open_registrations(deals: DataFrame, bars: DataFrame, as_of: str, grace: int = 3, recent: int = 60) -> DataFrame:
    """Registered deals that still run, or ended at most `grace` days ago, valued at the name's last close.

    Only closes of the table's last `recent` days count; a name without one has a null value.
    """
    newest = bars.agg(F.max("date").alias("_newest"))
    near = bars.join(F.broadcast(newest)).where(F.col("date") >= F.date_sub("_newest", recent))
    last = near.groupBy("symbol").agg(F.max_by("close", "date").alias("_close"))
    running = deals.where((F.col("kind") == "registered") & ((F.col("plan_buy") > 0) | (F.col("plan_sell") > 0)) & (F.col("to_day") >= F.date_sub(F.lit(as_of).cast("date"), grace)))
    value = (F.col("plan_buy") - F.col("plan_sell")) * F.col("_close")
    return running.join(last, "symbol", "left").select("symbol", "person", "role", "plan_buy", "plan_sell", value.alias("value"), "from_day", "to_day", "announced")


def deals_by_month(deals: DataFrame) -> DataFrame:
    """Per symbol and month of execution: values bought and sold (negative), and both volumes."""
    volumes = [F.coalesce(F.sum(f"done_{s}"), F.lit(0.0)).alias(f"volume_{s}") for s in ("buy", "sell")]
    return _done(deals).groupBy("symbol", F.last_day("done_on").alias("month")).agg(_bought().alias("bought"), _sold().alias("sold"), *volumes)
