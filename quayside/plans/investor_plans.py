"""Investors, insiders, signals, baskets, drivers and port figures over the domain views, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import investors as I
from ..operators import ports, signals, statements
from ..sources.views import bars, flows, foreign_flows, house_flows, insider_deals, instruments, official_turnover, quarter_figures, rate_quotes, rounded, rsql, ship_visits, sql, table, valued_bars

Q, S = {}, {}


def add(name, statement=None):
    def put(run):
        Q[name], S[name] = run, statement
        return run

    return put


def listed(expressions: dict[str, str], places: int = 4) -> str:
    return ", ".join(f"{rsql(e, places)} AS {n}" for n, e in expressions.items())


DRILL = {"bought": "b", "sold": "s", "net": "b - s", "net_match": "nm", "turnover": "tv", "share": "50 * (b + s) / NULLIF(tv, 0)", "owned_first": "100 * o1", "owned_last": "100 * o2", "owned_change": "100 * o2 - 100 * o1"}


@add("agg13_investor_drilldown", sql(
    f"SELECT sector, code, exchange, up AS up_days, down AS down_days, {listed(DRILL)} FROM dr WHERE b > 0 OR s > 0",
    dr="SELECT sector, code, exchange, SUM(buy_val) AS b, SUM(sell_val) AS s, SUM(net_match) AS nm, SUM(total_value) AS tv, COUNT(*) FILTER (WHERE buy_val > sell_val) AS up, COUNT(*) FILTER (WHERE buy_val < sell_val) AS down, MIN_BY(owned, date) FILTER (WHERE owned IS NOT NULL) AS o1, MAX_BY(owned, date) FILTER (WHERE owned IS NOT NULL) AS o2 FROM foreign_flows JOIN instruments ON code = symbol GROUP BY ALL"))
def agg13_drilldown(s, d):
    out = I.drilldown(foreign_flows(s, d), instruments(s, d))
    return out.select("sector", "code", "exchange", "up_days", "down_days", *[rounded(c).alias(c) for c in DRILL])


@add("agg13_two_investors", sql(
    f"SELECT code, {listed({'abroad': 'x', 'house': 'y', 'total': 'x + y'})}, CASE SIGN(x) * SIGN(y) WHEN 1 THEN 'same' WHEN -1 THEN 'opposite' ELSE 'one side' END AS way FROM (SELECT code, COALESCE(a.n, 0) AS x, COALESCE(h.n, 0) AS y FROM ab a FULL JOIN ho h USING (code))",
    ab="SELECT code, SUM(buy_val) - SUM(sell_val) AS n FROM foreign_flows GROUP BY code HAVING SUM(buy_val) > 0 OR SUM(sell_val) > 0",
    ho="SELECT code, SUM(buy_val) - SUM(sell_val) AS n FROM house_flows GROUP BY code HAVING SUM(buy_val) > 0 OR SUM(sell_val) > 0"))
def agg13_two(s, d):
    out = I.two_investors(foreign_flows(s, d), house_flows(s, d), ("abroad", "house"))
    return out.select("code", "way", *[rounded(c).alias(c) for c in ("abroad", "house", "total")])


SIDES = {"bought": "COALESCE(SUM(value) FILTER (WHERE value > 0), 0)", "sold": "COALESCE(SUM(value) FILTER (WHERE value < 0), 0)"}


@add("agg46_insider_market", sql(f"SELECT done_on, COUNT(*) AS deals, {listed({'net': 'SUM(value)', **SIDES})} FROM insider_deals WHERE done_on IS NOT NULL AND value IS NOT NULL GROUP BY done_on"))
def agg46_market(s, d):
    return I.deals_by_day(insider_deals(s, d)).select("done_on", "deals", *[rounded(c).alias(c) for c in ("net", "bought", "sold")])


@add("agg46_insider_top", sql(
    f"SELECT side, symbol, net, {rsql('volume')} AS volume, deals, l.person AS person, l.role AS role, {rsql('l.value')} AS largest, l.done_on AS largest_on FROM (SELECT 'bought' AS side, * FROM (SELECT * FROM pn WHERE net > 0 ORDER BY net DESC, symbol LIMIT 15) UNION ALL SELECT 'sold', * FROM (SELECT * FROM pn WHERE net < 0 ORDER BY net, symbol LIMIT 15))",
    pn="SELECT symbol, ROUND(SUM(value) + 1e-9, 1) AS net, SUM(net_volume) AS volume, COUNT(*) AS deals, MAX_BY({'person': person, 'role': role, 'value': value, 'done_on': done_on}, (ABS(value), done_on, person, value)) AS l FROM insider_deals WHERE value IS NOT NULL AND done_on BETWEEN DATE '1997-01-01' AND DATE '1998-12-31' GROUP BY symbol"))
def agg46_top(s, d):
    out = I.top_deals(insider_deals(s, d), "1997-01-01", "1998-12-31", 15)
    return out.withColumns({c: rounded(c) for c in ("volume", "largest")})


@add("agg46_insider_open", sql(
    f"SELECT symbol, person, role, plan_buy, plan_sell, {rsql('(plan_buy - plan_sell) * close')} AS value, from_day, to_day, announced FROM insider_deals LEFT JOIN lc USING (symbol) WHERE kind = 'registered' AND (plan_buy > 0 OR plan_sell > 0) AND to_day >= DATE '2001-07-31' - 3",
    lc="SELECT symbol, MAX_BY(close, date) AS close FROM bars WHERE date >= (SELECT MAX(date) FROM bars) - 60 GROUP BY symbol"))
def agg46_open(s, d):
    return I.open_registrations(insider_deals(s, d), bars(s, d), "2001-07-31").withColumn("value", rounded("value"))


@add("agg46_insider_symbol_months", sql(f"SELECT symbol, LAST_DAY(done_on) AS month, {listed({**SIDES, 'volume_buy': 'SUM(done_buy)', 'volume_sell': 'SUM(done_sell)'})} FROM insider_deals WHERE done_on IS NOT NULL AND value IS NOT NULL GROUP BY ALL"))
def agg46_months(s, d):
    out = I.deals_by_month(insider_deals(s, d))
    return out.select("symbol", "month", *[rounded(c).alias(c) for c in ("bought", "sold", "volume_buy", "volume_sell")])


def z_sql(value: str, n: int) -> str:
    w = f"OVER (ORDER BY date ROWS {n - 1} PRECEDING)"
    return f"CASE WHEN COUNT({value}) {w} = {n} THEN ({value} - AVG({value}) {w}) / NULLIF(STDDEV_SAMP({value}) {w}, 0) END"


BUY = "(COALESCE(z_short <= -{k}, FALSE) OR COALESCE(z_long <= -{k}, FALSE)) AND tier >= {t}"


@add("win18_signal_table", sql(
    f"SELECT date, {listed({c: c for c in ('pe', 'z_short', 'z_long', 'pb', 'z_pb')})}, quiet, profit_qoq, profit_yoy, tier, {BUY.format(k=1.7, t=1)} AS buy1, {BUY.format(k=1.9, t=2)} AS buy2, CASE WHEN fresh THEN quarter_end END AS new_quarter, fresh AND profit_qoq AS new_rose FROM t18",
    pe18="SELECT date, SUM(cap) / NULLIF(SUM(earnings), 0) AS pe FROM valued_bars GROUP BY date HAVING SUM(earnings) <> 0",
    z18=f"SELECT date, pe, {z_sql('pe', 750)} AS z_short, {z_sql('pe', 1250)} AS z_long, ROW_NUMBER() OVER (ORDER BY date) AS n FROM pe18",
    d18="SELECT DISTINCT date FROM bars WHERE date >= (SELECT date FROM z18 WHERE n = 750)",
    f18="SELECT symbol, quarter_end + 45 AS out_day, equity FROM quarter_figures WHERE equity IS NOT NULL",
    pb18="SELECT b.date, SUM(cap) / SUM(equity) AS pb FROM valued_bars b ASOF JOIN f18 f ON b.symbol = f.symbol AND b.date >= f.out_day GROUP BY b.date HAVING COUNT(*) >= 3",
    zp18=f"SELECT date, pb, {z_sql('pb', 750)} AS z_pb FROM pb18",
    q18="SELECT YEAR(date) * 4 + QUARTER(date) AS q, SUM(value) AS v, MAX(date) AS last_day FROM bars GROUP BY 1",
    l18="SELECT last_day, COALESCE(v < LAG(v) OVER (ORDER BY q), FALSE) AS quiet FROM q18",
    p18="SELECT quarter_end, quarter_end + 45 AS out_day, COALESCE(p > LAG(p) OVER (ORDER BY quarter_end), FALSE) AS qoq, COALESCE(p > LAG(p, 4) OVER (ORDER BY quarter_end), FALSE) AS yoy FROM (SELECT quarter_end, COALESCE(SUM(profit), 0) AS p FROM quarter_figures GROUP BY 1)",
    j18="SELECT d.date, z.pe, z.z_short, z.z_long, b.pb, b.z_pb, COALESCE(l.quiet, FALSE) AS quiet, p.quarter_end, COALESCE(p.qoq, FALSE) AS profit_qoq, COALESCE(p.yoy, FALSE) AS profit_yoy FROM d18 d ASOF LEFT JOIN z18 z ON d.date >= z.date ASOF LEFT JOIN zp18 b ON d.date >= b.date ASOF LEFT JOIN l18 l ON d.date >= l.last_day ASOF LEFT JOIN p18 p ON d.date >= p.out_day",
    t18="SELECT *, CASE WHEN quiet AND profit_qoq THEN 2 WHEN quiet AND profit_yoy THEN 1 ELSE 0 END AS tier, quarter_end IS DISTINCT FROM LAG(quarter_end) OVER (ORDER BY date) AS fresh FROM j18"))
def win18_table(s, d):
    v = valued_bars(s, d)
    pe = v.groupBy("date").agg(F.try_divide(F.sum("cap"), F.sum("earnings")).alias("pe"))
    turnover = bars(s, d).groupBy("date").agg(F.sum("value").alias("value"))
    out = signals.signal_table(pe, v.select("symbol", "date", "cap"), quarter_figures(s, d), turnover, least=3)
    return out.withColumns({c: rounded(c) for c in ("pe", "z_short", "z_long", "pb", "z_pb")})


BASKET = "SUM(earnings) / SUM(shares) AS eps, SUM(earnings) / 1e6 AS profit, SUM(cap) / NULLIF(SUM(earnings), 0) AS pe, SUM(cap) / NULLIF(SUM(book), 0) AS pb, SUM(earnings) / NULLIF(SUM(book), 0) AS roe, SUM(cap) / 1e6 AS cap"


def baskets(s, d, group):
    joined = valued_bars(s, d).drop("sector").join(instruments(s, d), "symbol")
    total = {c: F.sum(c) for c in ("cap", "earnings", "book", "shares")}
    made = {"eps": total["earnings"] / total["shares"], "profit": total["earnings"] / 1e6, "pe": F.try_divide(total["cap"], total["earnings"]), "pb": F.try_divide(total["cap"], total["book"]), "roe": F.try_divide(total["earnings"], total["book"]), "cap": total["cap"] / 1e6}
    return joined.groupBy(group, "date").agg(*[c.alias(n) for n, c in made.items()])


def growth_sql(group: str, measure: str, source: str = "bv") -> dict[str, str]:
    """A measure without spikes, and with its growth on the year before."""
    k = f"k_{measure}"
    return {
        k: f"SELECT {group}, date, v FROM (SELECT {group}, date, {measure} AS v, LAG({measure}) OVER w AS a, LEAD({measure}) OVER w AS b FROM {source} WHERE {measure} IS NOT NULL WINDOW w AS (PARTITION BY {group} ORDER BY date)) WHERE NOT COALESCE(ABS(v / NULLIF(a, 0) - 1) > 0.3 AND ABS(v / NULLIF(b, 0) - 1) > 0.3, FALSE)",
        f"g_{measure}": f"SELECT x.{group}, x.date, x.v, 100 * (x.v / NULLIF(y.v, 0) - 1) AS g FROM {k} x ASOF LEFT JOIN {k} y ON x.{group} = y.{group} AND CAST(x.date - INTERVAL 1 YEAR AS DATE) >= y.date",
    }


JOINED = "SELECT b.symbol, i.exchange, i.sector, i.shares, b.date, b.cap, b.earnings, b.book FROM (SELECT symbol, date, cap, earnings, book FROM valued_bars) b JOIN instruments i ON i.symbol = b.symbol"


@add("agg18_basket_earnings", sql(
    f"SELECT b.exchange, b.date, {listed({'eps': 'e.v', 'eps_growth': 'e.g', 'profit': 'p.v', 'profit_growth': 'p.g', 'pe': 'b.pe', 'pb': 'b.pb', 'roe': 'b.roe'})} FROM bv b LEFT JOIN g_eps e ON e.exchange = b.exchange AND e.date = b.date LEFT JOIN g_profit p ON p.exchange = b.exchange AND p.date = b.date",
    jo=JOINED, bv=f"SELECT exchange, date, {BASKET} FROM jo GROUP BY ALL", **growth_sql("exchange", "eps"), **growth_sql("exchange", "profit")))
def agg18_baskets(s, d):
    out = signals.basket_growth(baskets(s, d, "exchange"), ["exchange"], ["eps", "profit"])
    return out.select("exchange", "date", *[rounded(c).alias(c) for c in ("eps", "eps_growth", "profit", "profit_growth", "pe", "pb", "roe")])


@add("agg18_sector_earnings", sql(
    f"SELECT sector, {listed({'profit': 'pv', 'growth': 'pg', 'pe': 'ppe', 'pb': 'ppb', 'roe': 'proe', 'cap': 'pcap'})} FROM ls WHERE pg IS NOT NULL",
    jo=JOINED, bv=f"SELECT sector, date, {BASKET} FROM jo WHERE date <= DATE '2000-06-30' GROUP BY ALL", **growth_sql("sector", "profit"),
    la="SELECT sector, MAX_BY(v, date) AS pv, MAX_BY({'g': g}, date).g AS pg FROM g_profit GROUP BY sector",
    lo="SELECT sector, " + ", ".join(f"MAX_BY({c}, date) FILTER (WHERE {c} IS NOT NULL) AS p{c}" for c in ("pe", "pb", "roe", "cap")) + " FROM bv GROUP BY sector",
    ls="SELECT * FROM la JOIN lo USING (sector)"))
def agg18_sectors(s, d):
    out = signals.latest_growth(baskets(s, d, "sector"), "sector", "profit", ["pe", "pb", "roe", "cap"], "2000-06-30")
    return out.select("sector", *[rounded(c).alias(c) for c in ("profit", "growth", "pe", "pb", "roe", "cap")])


SPAN = {"now": "day > DATE '1998-05-31' AND day <= DATE '1998-06-30'", "before": "day > DATE '1998-05-01' AND day <= DATE '1998-05-31'", "year_ago": "day > DATE '1997-05-31' AND day <= DATE '1997-06-30'"}
KPI = {f"{m}_{s}": f"COALESCE(SUM({m}) FILTER (WHERE {w}), 0)" for m in ("calls", "teu", "dwt") for s, w in SPAN.items()}
CHANGE = {f"{m}_{c}": f"({m}_now - {m}_{s}) / NULLIF({m}_{s}, 0)" for m in ("calls", "teu", "dwt") for c, s in (("change", "before"), ("yearly", "year_ago"))}


@add("agg36_port_kpis", sql(
    f"SELECT terminal, ships, {listed({k: k for k in KPI})}, {listed(CHANGE, 6)}, {listed({'hours_now': 'hours_now', 'hours_before': 'hours_before', 'hours_change': 'hours_now - hours_before'})} FROM kp",
    kp=f"SELECT terminal, {', '.join(f'{e} AS {n}' for n, e in KPI.items())}, MEDIAN(hours) FILTER (WHERE {SPAN['now']}) AS hours_now, MEDIAN(hours) FILTER (WHERE {SPAN['before']}) AS hours_before, COUNT(DISTINCT ship) FILTER (WHERE {SPAN['now']}) AS ships FROM ship_visits WHERE ({') OR ('.join(SPAN.values())}) GROUP BY terminal"))
def agg36_kpis(s, d):
    out = ports.period_kpis(ship_visits(s, d), "terminal", "day", ["calls", "teu", "dwt"], "hours", "ship", "1998-06-30")
    return out.withColumns({c: rounded(c) for c in (*KPI, "hours_now", "hours_before", "hours_change")} | {c: rounded(c, 6) for c in CHANGE})


@add("agg51_traded_quarters", sql(f"SELECT exchange AS venue, CAST(YEAR(date) * 4 + QUARTER(date) - 1 AS INT) AS t, {listed({'total': 'SUM(value)', 'mean': 'AVG(value)'})}, COUNT(*) AS sessions FROM official_turnover WHERE value > 0 GROUP BY ALL"))
def agg51_traded(s, d):
    out = statements.traded_by_quarter(official_turnover(s, d).withColumnRenamed("exchange", "venue"))
    return out.select("venue", "t", "sessions", rounded("total").alias("total"), rounded("mean").alias("mean"))


T51 = "CAST(YEAR(date) * 4 + QUARTER(date) - 1 AS INT)"


@add("agg51_driver_series", sql(
    f"SELECT series, t, {rsql('COALESCE(m.value, k.value)', 6)} AS value FROM (SELECT 'flow_net' AS series, t, value FROM n51 UNION ALL SELECT 'flow_year', t, value FROM y51 WHERE value IS NOT NULL UNION ALL SELECT series, t, mean FROM r51 WHERE series <> '5-LOW' UNION ALL SELECT series, t, value FROM h51 UNION ALL SELECT 'cap', t, value FROM c51) m FULL JOIN k51 k USING (series, t)",
    n51=f"SELECT {T51} AS t, SUM(net) / 1e6 AS value FROM (SELECT date, SUM(buy_val - sell_val) AS net FROM flows GROUP BY date) GROUP BY 1 HAVING COUNT(*) >= 80",
    y51="SELECT t, CASE WHEN LAG(t, 3) OVER (ORDER BY t) = t - 3 THEN SUM(value) OVER (ORDER BY t ROWS 3 PRECEDING) END AS value FROM n51",
    o51="SELECT series, date, MAX_BY(value, source) / 100 AS value FROM rate_quotes GROUP BY ALL",
    r51=f"SELECT series, {T51} AS t, AVG(value) AS mean, MAX_BY(value, date) AS last_value FROM o51 GROUP BY ALL",
    e51="SELECT series, MIN(t) AS a, MAX(t) AS b FROM r51 WHERE series = '5-LOW' GROUP BY series",
    w51="SELECT series, CAST(UNNEST(RANGE(a, b + 1)) AS INT) AS t FROM e51",
    h51="SELECT w51.series, w51.t, LAST_VALUE(r51.last_value IGNORE NULLS) OVER (PARTITION BY w51.series ORDER BY w51.t ROWS UNBOUNDED PRECEDING) AS value FROM w51 LEFT JOIN r51 ON r51.series = w51.series AND r51.t = w51.t",
    m51="SELECT date, cap, MEDIAN(cap) OVER w AS m, COUNT(cap) OVER w AS n FROM (SELECT date, SUM(cap) / 1e9 AS cap FROM valued_bars GROUP BY date) WINDOW w AS (ORDER BY date ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING)",
    c51=f"SELECT {T51} AS t, MAX_BY(cap, date) AS value FROM m51 WHERE n >= 5 AND cap > 0.5 * m AND cap < 2 * m GROUP BY 1",
    k51="SELECT 'flow_net' AS series, CAST(YEAR(o_orderdate) * 4 + QUARTER(o_orderdate) - 1 AS INT) AS t, SUM(o_totalprice) / 1e6 AS value FROM orders GROUP BY 2"))
def agg51_series(s, d):
    """Quarters of fewer than 80 sessions take the fixed history."""
    net = flows(s, d).groupBy("date").agg((F.sum(F.col("buy_val") - F.col("sell_val")) / 1e6).alias("net"))
    caps = valued_bars(s, d).groupBy("date").agg((F.sum("cap") / 1e9).alias("cap"))
    day = F.col("o_orderdate")
    known = table(s, d, "orders").groupBy((F.year(day) * 4 + F.quarter(day) - 1).alias("t")).agg((F.sum("o_totalprice") / 1e6).alias("value")).select(F.lit("flow_net").alias("series"), "t", "value")
    out = statements.driver_series(net, rate_quotes(s, d), caps, known, ("5-LOW",), 80)
    return out.withColumn("value", rounded("value", 6))
