"""Today's rows from the live board: the events replayed as a stream of trades against the stored history, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import market
from ..operators.temporal import full_mean
from ..sources.views import bars, flows, instruments, rounded, rsql, sql, valued_bars
from ..streaming import live as L
from ..streaming import overlays as V
from .live_plans import events
from .market_plans import GRID
from pyspark.sql import Window

Q, S = {}, {}
DAY = "2024-01-30"


def add(name, statement=None):
    def put(run):
        Q[name], S[name] = run, statement
        return run

    return put


def references(s, d):
    """symbol, ref, ceiling, floor: the last stored close, to two places, and seven percent around it."""
    ref = bars(s, d).groupBy("symbol").agg(F.max_by("close", "date").alias("close")).select("symbol", rounded("close", 2).alias("ref"))
    return ref.select("symbol", "ref", (F.col("ref") * 1.07).alias("ceiling"), (F.col("ref") * 0.93).alias("floor"))


def board(s, d):
    """Clicks are sales and purchases buys, at prices within the limits; names ending in 9 are funds."""
    limits = references(s, d)
    trades = events(s, d).where(F.col("event_type").isin("click", "purchase")).select(F.col("user_id").alias("symbol"), "ts", (F.col("value") * 20).alias("p"), (1 + F.col("event_id") % 100).alias("volume"), F.when(F.col("event_type") == "purchase", "buy").otherwise("sell").alias("side"))
    ticks = trades.join(limits, "symbol").select("symbol", "ts", F.least(F.greatest("p", "floor"), F.col("ceiling")).alias("price"), "volume", "side")
    state = L.replay(V.board_state(ticks), "update", ["symbol"])
    return state.join(limits, "symbol").join(instruments(s, d), "symbol").withColumn("kind", F.when(F.col("symbol") % 10 == 9, "fund").otherwise("share"))


BOARD = {
    "lims": f"SELECT symbol, {rsql('MAX_BY(close, date)', 2)} AS ref FROM bars GROUP BY symbol",
    "trs": "SELECT user_id AS symbol, ts, LEAST(GREATEST(value * 20, ref * 0.93::DOUBLE), ref * 1.07::DOUBLE) AS price, 1 + event_id % 100 AS volume, event_type FROM events JOIN lims ON symbol = user_id WHERE event_type IN ('click', 'purchase')",
    "sta": "SELECT symbol, MIN_BY(price, (ts, price)) AS open_, MAX(price) AS high, MIN(price) AS low, MAX_BY(price, (ts, price)) AS price, SUM(volume) AS volume, SUM(price * volume) AS value, SUM(CASE WHEN event_type = 'purchase' THEN price * volume ELSE 0 END) AS buy_val, SUM(CASE WHEN event_type = 'click' THEN price * volume ELSE 0 END) AS sell_val FROM trs GROUP BY symbol",
    "brd": "SELECT sta.*, i.exchange, i.sector, i.shares, l.ref, l.ref * 1.07::DOUBLE AS ceiling, l.ref * 0.93::DOUBLE AS floor_ FROM sta JOIN lims l ON l.symbol = sta.symbol JOIN instruments i ON i.symbol = sta.symbol",
}


def listed(expressions: dict[str, str], places: int = 4) -> str:
    return ", ".join(f"{rsql(e, places)} AS {n}" for n, e in expressions.items())


@add("str6_venue_totals", sql(
    f"SELECT exchange, COUNT(*) AS n, COUNT(*) FILTER (WHERE price > ref) AS advances, COUNT(*) FILTER (WHERE price < ref) AS declines, COUNT(*) FILTER (WHERE price = ref) AS unchanged, COUNT(*) FILTER (WHERE price = ceiling) AS at_ceiling, COUNT(*) FILTER (WHERE price = floor_) AS at_floor, {listed({'value': 'SUM(value)', 'bought': 'SUM(buy_val)', 'sold': 'SUM(sell_val)', 'net': 'SUM(buy_val) - SUM(sell_val)', 'basis': '(SELECT MAX(price) FILTER (WHERE symbol = 1) - MAX(price) FILTER (WHERE symbol = 2) FROM brd)'})} FROM brd WHERE symbol % 10 <> 9 GROUP BY exchange",
    **BOARD))
def str6_totals(s, d):
    """The names 1 and 2 stand for the future and its index."""
    out = V.venue_totals(board(s, d), 1, 2)
    return out.withColumns({c: rounded(c) for c in ("value", "bought", "sold", "net", "basis")})


TURN = "SELECT date, SUM(value) AS total FROM bars GROUP BY date UNION ALL SELECT DATE '2024-01-30', SUM(value) FROM brd"


@add("str8_turnover_today", sql(
    "SELECT date, " + listed({"total": "total", **{f"ma{n}": f"CASE WHEN COUNT(total) OVER m{n} = {n} THEN AVG(total) OVER m{n} END" for n in (20, 50)}}) + " FROM tu WINDOW m20 AS (ORDER BY date ROWS 19 PRECEDING), m50 AS (ORDER BY date ROWS 49 PRECEDING)",
    **BOARD, tu=TURN))
def str8_turnover(s, d):
    daily = bars(s, d).groupBy("date").agg(F.sum("value").alias("total"))
    days = Window.orderBy("date")
    history = daily.select("date", "total", *[full_mean("total", days, n).alias(f"ma{n}") for n in (20, 50)])
    return V.turnover_today(history, board(s, d), DAY).select("date", *[rounded(c).alias(c) for c in ("total", "ma20", "ma50")])


@add("str8_counts_today", sql("SELECT a AS adv, b AS decl, c AS unch, a + b + c AS traded, " + listed({"pct_adv": "100.0 * a / NULLIF(a + b, 0)"}) + ", a - b AS balance FROM (SELECT COUNT(*) FILTER (WHERE price > ref) AS a, COUNT(*) FILTER (WHERE price < ref) AS b, COUNT(*) FILTER (WHERE price = ref) AS c FROM brd)", **BOARD))
def str8_counts(s, d):
    return V.counts_today(board(s, d)).withColumn("pct_adv", rounded("pct_adv"))


WINDOWS = (20, 50, 100, 200, 300)


@add("str8_levels_today", sql(
    "SELECT w, exchange, COUNT(*) AS names, COUNT(*) FILTER (WHERE p > ma * (1 + 1e-9)) AS above, COUNT(*) FILTER (WHERE p < ma * (1 - 1e-9)) AS below, " + listed({"pct_above": "100.0 * COUNT(*) FILTER (WHERE p > ma * (1 + 1e-9)) / COUNT(*)", "pct_below": "100.0 * COUNT(*) FILTER (WHERE p < ma * (1 - 1e-9)) / COUNT(*)"}) + " FROM lv JOIN instruments USING (symbol) WHERE ma IS NOT NULL GROUP BY GROUPING SETS ((w), (w, exchange))",
    **BOARD, cal=GRID["cal"],
    near="SELECT symbol, sess, close FROM bars JOIN cal USING (date) WHERE sess > (SELECT MAX(sess) FROM cal) - 320",
    cells="SELECT symbol, UNNEST(RANGE(MIN(sess), (SELECT MAX(sess) FROM cal) + 1)) AS sess FROM near GROUP BY symbol",
    fl8="SELECT c.symbol, (SELECT MAX(sess) FROM cal) - c.sess AS back, CASE WHEN c.sess - LAST_VALUE(CASE WHEN close IS NOT NULL THEN c.sess END IGNORE NULLS) OVER v <= 20 THEN LAST_VALUE(close IGNORE NULLS) OVER v END AS px FROM cells c LEFT JOIN near n ON n.symbol = c.symbol AND n.sess = c.sess WINDOW v AS (PARTITION BY c.symbol ORDER BY c.sess ROWS UNBOUNDED PRECEDING)",
    pw="SELECT f.symbol, COALESCE(ANY_VALUE(b.price), MAX(px) FILTER (WHERE back = 0)) AS p, " + ", ".join(f"SUM(px) FILTER (WHERE back <= {w - 2}) AS s{w}, COUNT(px) FILTER (WHERE back <= {w - 2}) AS n{w}" for w in WINDOWS) + " FROM fl8 f LEFT JOIN brd b ON b.symbol = f.symbol WHERE back < 300 GROUP BY f.symbol",
    lv=" UNION ALL ".join(f"SELECT symbol, p, {w} AS w, CASE WHEN n{w} = {w - 1} THEN (s{w} + p) / {w} END AS ma FROM pw WHERE p IS NOT NULL" for w in WINDOWS)))
def str8_levels(s, d):
    out = V.levels_by_venue(V.levels_today(board(s, d), bars(s, d), DAY, WINDOWS), instruments(s, d))
    return out.withColumns({c: rounded(c) for c in ("pct_above", "pct_below")})


@add("str8_flows_today", sql(
    "SELECT date, exchange, " + listed({"net": "net", "cumulative": "CASE WHEN date = DATE '2024-01-30' THEN SUM(net) OVER (PARTITION BY exchange ORDER BY date) END"}) + " FROM fw",
    **BOARD, fw="SELECT date, exchange, SUM(buy_val - sell_val) AS net FROM flows JOIN instruments ON symbol = code GROUP BY ALL UNION ALL SELECT DATE '2024-01-30', exchange, SUM(buy_val - sell_val) FROM brd GROUP BY exchange"))
def str8_flows(s, d):
    history = market.venue_flows(flows(s, d), instruments(s, d)).select("date", "exchange", "net")
    out = V.flows_today(history, board(s, d), DAY)
    return out.withColumns({c: rounded(c) for c in ("net", "cumulative")})


@add("str8_investors_today", sql("SELECT " + listed({"reported": "SUM(buy_val + sell_val) / 2", "others": "SUM(value) - SUM(buy_val + sell_val) / 2"}) + " FROM brd", **BOARD))
def str8_investors(s, d):
    return V.investors_today(board(s, d)).select(*[rounded(c).alias(c) for c in ("reported", "others")])


@add("str8_bars_today", sql("SELECT symbol, date, " + listed({c: c for c in ("close", "volume", "value")}) + " FROM (SELECT symbol, date, close, volume, value FROM bars UNION ALL SELECT symbol, DATE '2024-01-30', price, volume, value FROM brd)", **BOARD))
def str8_bars(s, d):
    return V.bars_today(bars(s, d), board(s, d), DAY).select("symbol", "date", *[rounded(c).alias(c) for c in ("close", "volume", "value")])


VAL8 = "SELECT exchange, date, SUM(cap) / NULLIF(SUM(earnings), 0) AS pe, SUM(cap) / NULLIF(SUM(book), 0) AS pb FROM (SELECT symbol, date, cap, earnings, book FROM valued_bars) v JOIN (SELECT symbol, exchange FROM instruments) i USING (symbol) GROUP BY ALL"


@add("str8_valuation_today", sql(
    "SELECT exchange, date, " + listed({"pe": "pe", "pb": "pb"}) + " FROM (SELECT * FROM vh UNION ALL SELECT exchange, DATE '2024-01-30', pe * ratio, pb * ratio FROM vl JOIN ra USING (exchange) WHERE ratio IS NOT NULL AND COALESCE(pe, pb) IS NOT NULL)",
    **BOARD, vh=VAL8,
    vl="SELECT exchange, MAX_BY(pe, date) FILTER (WHERE pe IS NOT NULL) AS pe, MAX_BY(pb, date) FILTER (WHERE pb IS NOT NULL) AS pb FROM vh GROUP BY exchange",
    ra="SELECT exchange, CASE WHEN COUNT(*) >= 2 THEN SUM(price * shares) / SUM(ref * shares) END AS ratio FROM brd WHERE ref > 0 GROUP BY exchange"))
def str8_valuation(s, d):
    v = valued_bars(s, d).join(instruments(s, d).select("symbol", "exchange"), "symbol")
    history = v.groupBy("exchange", "date").agg(F.try_divide(F.sum("cap"), F.sum("earnings")).alias("pe"), F.try_divide(F.sum("cap"), F.sum("book")).alias("pb"))
    out = V.scaled_today(history, V.cap_ratios(board(s, d), "exchange", 2), "exchange", ["pe", "pb"], DAY)
    return out.select("exchange", "date", rounded("pe").alias("pe"), rounded("pb").alias("pb"))


@add("str8_sectors_today", sql(
    f"SELECT sector, date, {rsql('cap / 1e6')} AS cap FROM (SELECT * FROM sh UNION ALL SELECT sector, DATE '2024-01-30', cap * ratio FROM (SELECT sector, MAX_BY(cap, date) AS cap FROM sh GROUP BY sector) JOIN rs USING (sector))",
    **BOARD, sh="SELECT sector, date, SUM(close * shares) AS cap FROM bars JOIN instruments USING (symbol) GROUP BY ALL",
    rs="SELECT sector, SUM(price * shares) / SUM(ref * shares) AS ratio FROM brd WHERE ref > 0 GROUP BY sector"))
def str8_sectors(s, d):
    history = bars(s, d).join(instruments(s, d), "symbol").groupBy("sector", "date").agg(F.sum(F.col("close") * F.col("shares")).alias("cap"))
    out = V.scaled_today(history, V.cap_ratios(board(s, d), "sector", 1), "sector", ["cap"], DAY, carried=False)
    return out.select("sector", "date", rounded(F.col("cap") / 1e6).alias("cap"))
