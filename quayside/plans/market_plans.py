"""Market queries over the domain views, each with its SQL."""

from __future__ import annotations

from ..operators import market as M
from ..operators import temporal as T
from ..sources.views import bars, flows, fundamentals, instruments, official_turnover, quoted, rounded, rsql, second_closes, sql, tranches, valued_bars
from pyspark.sql import functions as F

GRID = {
    "cal": "SELECT date, ROW_NUMBER() OVER (ORDER BY date) AS sess FROM (SELECT DISTINCT date FROM bars)",
    "bound": "SELECT symbol, MIN(date) AS f, MAX(date) AS l FROM bars GROUP BY symbol",
    "grid": "SELECT b.symbol, c.date, c.sess, x.close, x.volume, x.value FROM bound b JOIN cal c ON c.date BETWEEN b.f AND b.l LEFT JOIN bars x ON x.symbol = b.symbol AND x.date = c.date",
    "filled": "SELECT *, CASE WHEN sess - LAST_VALUE(CASE WHEN close IS NOT NULL THEN sess END IGNORE NULLS) OVER w <= 20 THEN LAST_VALUE(close IGNORE NULLS) OVER w END AS px FROM grid WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
}
Q, S = {}, {}


def add(name, run, statement):
    Q[name], S[name] = run, statement


def cal1(s, d):
    g = M.price_grid(bars(s, d))
    return g.groupBy("date").agg(F.count("*").alias("cells"), F.count("close").alias("traded"), F.count("px").alias("priced"), rounded(F.sum("px")).alias("px_sum"))


add("cal1_dense_grid", cal1, sql(f"SELECT date, COUNT(*) AS cells, COUNT(close) AS traded, COUNT(px) AS priced, {rsql('SUM(px)')} AS px_sum FROM filled GROUP BY date", **GRID))


def win1(s, d):
    return M.breadth(bars(s, d))


MA = ", ".join(f"CASE WHEN COUNT(px) OVER (PARTITION BY symbol ORDER BY date ROWS {n - 1} PRECEDING) = {n} THEN AVG(px) OVER (PARTITION BY symbol ORDER BY date ROWS {n - 1} PRECEDING) END AS ma{n}" for n in (20, 50, 200))
add("win1_breadth", win1, sql(
    f"SELECT date, adv, decl, unch, traded, {rsql('100.0 * adv / NULLIF(traded, 0)')} AS pct_adv, CAST(SUM(adv - decl) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS ad_line, above20, above50, above200, highs, lows FROM daily",
    **GRID,
    seen=f"SELECT *, LAST_VALUE(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev, {MA}, COUNT(px) OVER y AS n52, MAX(px) OVER y AS hi, MIN(px) OVER y AS lo FROM filled WINDOW y AS (PARTITION BY symbol ORDER BY date ROWS 249 PRECEDING)",
    daily="SELECT date, COUNT(*) FILTER (WHERE close > prev) AS adv, COUNT(*) FILTER (WHERE close < prev) AS decl, COUNT(*) FILTER (WHERE close = prev) AS unch, COUNT(close) AS traded, COUNT(*) FILTER (WHERE px > ma20 * (1 + 1e-9)) AS above20, COUNT(*) FILTER (WHERE px > ma50 * (1 + 1e-9)) AS above50, COUNT(*) FILTER (WHERE px > ma200 * (1 + 1e-9)) AS above200, COUNT(*) FILTER (WHERE n52 >= 120 AND px >= hi) AS highs, COUNT(*) FILTER (WHERE n52 >= 120 AND px <= lo) AS lows FROM seen GROUP BY date",
))


def win2(s, d):
    out = M.moving_averages(bars(s, d), (5, 20))
    return out.select("symbol", "date", rounded("ma5").alias("ma5"), rounded("ma20").alias("ma20"), rounded("volume20").alias("volume20"))


add("win2_moving_averages", win2, sql(
    f"SELECT symbol, date, {rsql('ma5')} AS ma5, {rsql('ma20')} AS ma20, {rsql('volume20')} AS volume20 FROM m",
    m="SELECT symbol, date, CASE WHEN COUNT(close) OVER a = 5 THEN AVG(close) OVER a END AS ma5, CASE WHEN COUNT(close) OVER b = 20 THEN AVG(close) OVER b END AS ma20, SUM(volume) OVER b AS volume20 FROM bars WINDOW a AS (PARTITION BY symbol ORDER BY date ROWS 4 PRECEDING), b AS (PARTITION BY symbol ORDER BY date ROWS 19 PRECEDING)",
))


def win3(s, d):
    out = M.year_range(bars(s, d))
    return out.select("symbol", "date", rounded("high52").alias("high52"), rounded("low52").alias("low52"))


add("win3_year_range", win3, sql(
    f"SELECT symbol, date, {rsql('CASE WHEN COUNT(close) OVER y >= 120 THEN MAX(close) OVER y END')} AS high52, {rsql('CASE WHEN COUNT(close) OVER y >= 120 THEN MIN(close) OVER y END')} AS low52 FROM bars WINDOW y AS (PARTITION BY symbol ORDER BY date ROWS 249 PRECEDING)"
))


def win4(s, d):
    g = M.price_grid(bars(s, d), limit=5)
    return g.groupBy("symbol").agg(F.count("close").alias("traded"), F.count("px").alias("priced"))


add("win4_limited_fill", win4, sql("SELECT symbol, COUNT(close) AS traded, COUNT(px) AS priced FROM filled GROUP BY symbol", **(GRID | {"filled": GRID["filled"].replace("<= 20", "<= 5")})))


def win8(s, d):
    out = M.calendar_yoy(bars(s, d))
    return out.select("symbol", "date", rounded("yoy").alias("yoy"))


add("win8_calendar_yoy", win8, sql(
    f"SELECT a.symbol, a.date, {rsql('a.close / NULLIF(b.close, 0) - 1')} AS yoy FROM bars a ASOF LEFT JOIN bars b ON a.symbol = b.symbol AND CAST(a.date - INTERVAL 1 YEAR AS DATE) >= b.date"
))


def win15(s, d):
    out = M.chained_ex_group(bars(s, d), instruments(s, d), group_sector="CHINA")
    return out.select("date", rounded(F.log("chained"), 6).alias("log_chained"))


add("win15_chained_ex_group", win15, sql(
    f"SELECT date, {rsql('LN(first_close) + SUM(LN(1 + r)) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING)', 6)} AS log_chained FROM rets",
    day="SELECT b.date, SUM(b.close * i.shares) AS cap, SUM(CASE WHEN i.sector = 'CHINA' THEN b.close * i.shares END) AS grp FROM bars b JOIN instruments i USING (symbol) GROUP BY b.date",
    lagged="SELECT *, LAG(cap) OVER (ORDER BY date) AS pc, LAG(grp) OVER (ORDER BY date) AS pg, FIRST_VALUE(cap) OVER (ORDER BY date) AS first_close FROM day",
    rets="SELECT date, first_close, CASE WHEN pc IS NULL THEN 0 WHEN grp / pg - 1 IS NULL OR pg / pc >= 1 THEN cap / pc - 1 ELSE GREATEST((cap / pc - 1 - pg / pc * (grp / pg - 1)) / (1 - pg / pc), -0.99) END AS r FROM lagged",
))


def win16(s, d):
    """One series is brought to the level of an adjusted one that ends earlier; events after that come from two venues."""
    out = M.back_adjusted(quoted(s, d), second_closes(s, d), instruments(s, d), ("ASIA", "EUROPE"))
    return out.select("symbol", "date", rounded("factor", 6).alias("factor"), rounded("adjusted").alias("adjusted"))


add("win16_back_adjustment", win16, sql(
    f"SELECT symbol, date, {rsql('factor', 6)} AS factor, {rsql('close * factor')} AS adjusted FROM adj",
    met="SELECT q.symbol, q.date, q.close, ROUND(o.close / q.close, 4) AS ratio, q.ref / LAG(q.close) OVER (PARTITION BY q.symbol ORDER BY q.date) AS step, i.exchange, e.last FROM quoted q LEFT JOIN second_closes o ON o.symbol = q.symbol AND o.date = q.date LEFT JOIN (SELECT symbol, MAX(date) AS last FROM second_closes GROUP BY 1) e ON e.symbol = q.symbol LEFT JOIN instruments i ON i.symbol = q.symbol",
    ahead="SELECT *, LAST_VALUE(ratio IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING) AS fwd, CASE WHEN (last IS NULL OR date > last) AND exchange IN ('ASIA', 'EUROPE') AND ABS(step - 1) > 0.004 THEN step ELSE 1.0 END AS event FROM met",
    adj="SELECT *, COALESCE(fwd, FIRST_VALUE(fwd IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 1.0) * EXP(COALESCE(SUM(LN(event)) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0)) AS factor FROM ahead",
))


def win17(s, d):
    return M.rolling_z(bars(s, d), 60).select("symbol", "date", rounded("z").alias("z"))


add("win17_rolling_z", win17, sql(
    f"SELECT symbol, date, {rsql('CASE WHEN COUNT(close) OVER w = 60 THEN (close - AVG(close) OVER w) / NULLIF(STDDEV_SAMP(close) OVER w, 0) END')} AS z FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS 59 PRECEDING)"
))


def win18(s, d):
    return M.signals(bars(s, d), 60)


add("win18_signals", win18, sql(
    "SELECT symbol, date, CASE WHEN z <= -1.5 AND volume < v20 THEN 2 WHEN z <= -1 THEN 1 ELSE 0 END AS tier, CASE WHEN z <= -2 THEN 'deep' WHEN z <= -1 THEN 'low' WHEN z >= 2 THEN 'high' ELSE 'mid' END AS band, volume < v20 AS quiet FROM z WHERE z IS NOT NULL",
    z="SELECT symbol, date, volume, CASE WHEN COUNT(close) OVER w = 60 THEN (close - AVG(close) OVER w) / NULLIF(STDDEV_SAMP(close) OVER w, 0) END AS z, AVG(volume) OVER v AS v20 FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS 59 PRECEDING), v AS (PARTITION BY symbol ORDER BY date ROWS 19 PRECEDING)",
))


def win19(s, d):
    return M.trailing_stop(bars(s, d), 0.3, 0.2, 0.2).select("symbol", "entry", "exit", rounded("peak").alias("peak"))


add("win19_trailing_stop", win19, sql(
    f"SELECT symbol, MIN(date) AS entry, MIN(CASE WHEN close / peak - 1 <= -(CASE WHEN peak / first >= 1.2 THEN 0.2 ELSE 0.3 END) THEN date END) AS exit, {rsql('MAX(peak)')} AS peak FROM p GROUP BY symbol",
    p="SELECT symbol, date, close, MAX(close) OVER w AS peak, FIRST_VALUE(close) OVER w AS first FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING)",
))


def win20(s, d):
    return M.latest(bars(s, d), ["symbol"], "date").select("symbol", "date", rounded("close").alias("close"), "volume")


add("win20_latest_row", win20, sql(f"SELECT symbol, date, {rsql('close')} AS close, volume FROM bars QUALIFY ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY date DESC) = 1"))


def win29(s, d):
    return M.basket_profit(bars(s, d), tranches(s, d)).select("lot", "date", *[rounded(c).alias(c) for c in ("worth", "profit", "peak", "stop")])


add("win29_basket_profit", win29, sql(
    f"SELECT lot, date, {rsql('worth')} AS worth, {rsql('profit')} AS profit, {rsql('peak')} AS peak, {rsql('(1 + peak) * (1 - CASE WHEN peak >= 0.2 THEN 0.2 ELSE 0.3 END) - 1')} AS stop FROM pk",
    cal="SELECT DISTINCT date FROM bars",
    grid29="SELECT x.symbol, c.date, LAST_VALUE(b.close IGNORE NULLS) OVER (PARTITION BY x.symbol ORDER BY c.date ROWS UNBOUNDED PRECEDING) AS px FROM (SELECT symbol, MIN(date) AS f, MAX(date) AS l FROM bars GROUP BY 1) x JOIN cal c ON c.date BETWEEN x.f AND x.l LEFT JOIN bars b ON b.symbol = x.symbol AND b.date = c.date",
    entered="SELECT t.*, b.close AS p0 FROM tranches t ASOF JOIN bars b ON t.symbol = b.symbol AND t.entry >= b.date",
    w29="SELECT lot, date, SUM(invested * px / p0) AS worth, SUM(invested * px / p0) / SUM(invested) - 1 AS profit FROM entered e JOIN grid29 g ON g.symbol = e.symbol AND g.date >= e.entry GROUP BY lot, date",
    pk="SELECT *, MAX(profit) OVER (PARTITION BY lot ORDER BY date ROWS UNBOUNDED PRECEDING) AS peak FROM w29",
))


def valued(s, d):
    return M.valuation(bars(s, d), instruments(s, d), fundamentals(s, d))


def agg3(s, d):
    return M.snapshot(valued(s, d)).select("sector", "members", rounded("pe").alias("pe"), rounded("pb").alias("pb"), rounded("forward_pe").alias("forward_pe"), rounded("dividend_yield", 8).alias("dividend_yield"), rounded("roe").alias("roe"), rounded("coverage").alias("coverage"))


VAL = {"lastp": "SELECT symbol, MAX_BY(close, date) AS close FROM bars GROUP BY symbol",
       "val": "SELECT i.symbol, i.sector, i.exchange, p.close, p.close * i.shares AS cap, f.dividends, f.expected, f.earnings, f.book FROM instruments i JOIN lastp p USING (symbol) LEFT JOIN fundamentals f USING (symbol)"}
add("agg3_snapshot", agg3, sql(
    f"SELECT sector, COUNT(*) AS members, {rsql('SUM(CASE WHEN earnings IS NOT NULL THEN cap END) / NULLIF(GREATEST(SUM(earnings), 0), 0)')} AS pe, {rsql('SUM(CASE WHEN book IS NOT NULL THEN cap END) / NULLIF(GREATEST(SUM(book), 0), 0)')} AS pb, {rsql('SUM(CASE WHEN expected IS NOT NULL THEN cap END) / NULLIF(GREATEST(SUM(expected), 0), 0)')} AS forward_pe, {rsql('SUM(dividends) / NULLIF(SUM(CASE WHEN dividends IS NOT NULL THEN cap END), 0)', 8)} AS dividend_yield, {rsql('SUM(CASE WHEN book > 0 AND earnings IS NOT NULL THEN earnings / book * cap END) / NULLIF(SUM(CASE WHEN book > 0 AND earnings IS NOT NULL THEN cap END), 0)')} AS roe, {rsql('SUM(CASE WHEN earnings IS NOT NULL THEN cap ELSE 0 END) / SUM(cap)')} AS coverage FROM val GROUP BY sector", **VAL))


def agg2(s, d):
    return M.aggregate_pe(valued(s, d)).select("level", "exchange", "sector", "members", rounded("pe").alias("pe"), rounded("pe_ex_loss").alias("pe_ex_loss"), rounded("pb").alias("pb"))


add("agg2_aggregate_pe", agg2, sql(
    f"SELECT CASE WHEN GROUPING(exchange) = 1 THEN 'all' WHEN GROUPING(sector) = 1 THEN 'exchange' ELSE 'sector' END AS level, exchange, sector, COUNT(*) AS members, {rsql('SUM(CASE WHEN earnings IS NOT NULL THEN cap END) / NULLIF(GREATEST(SUM(earnings), 0), 0)')} AS pe, {rsql('SUM(CASE WHEN earnings > 0 THEN cap END) / NULLIF(SUM(CASE WHEN earnings > 0 THEN earnings END), 0)')} AS pe_ex_loss, {rsql('SUM(CASE WHEN book IS NOT NULL THEN cap END) / NULLIF(GREATEST(SUM(book), 0), 0)')} AS pb FROM val GROUP BY GROUPING SETS ((), (exchange), (exchange, sector))", **VAL))


def agg4(s, d):
    return M.ratio_pivot(M.ratios_long(valued(s, d))).select("symbol", *[rounded(c).alias(c) for c in ("cap", "close", "pe", "pb", "ln_ttm", "gtss", "roe", "earnings_yield", "eps_index")])


add("agg4_ratio_pivot", agg4, sql(
    f"SELECT symbol, {rsql('cap')} AS cap, {rsql('close')} AS close, {rsql('cap / NULLIF(earnings, 0)')} AS pe, {rsql('cap / NULLIF(book, 0)')} AS pb, {rsql('NULLIF(earnings, 0)')} AS ln_ttm, {rsql('NULLIF(book, 0)')} AS gtss, {rsql('close * NULLIF(earnings, 0) / cap')} AS eps_index, {rsql('(cap / NULLIF(book, 0)) / (cap / NULLIF(earnings, 0))')} AS roe, {rsql('1 / (cap / NULLIF(earnings, 0))')} AS earnings_yield FROM val", **VAL))


def agg5(s, d):
    return M.ex_group_valuation(bars(s, d), instruments(s, d), "CHINA").select("date", rounded(F.col("cap") / 1e6).alias("cap"), rounded(F.col("cap_ex") / 1e6).alias("cap_ex"), rounded("share_ex").alias("share_ex"))


add("agg5_ex_group", agg5, sql(
    f"SELECT date, {rsql('cap / 1e6')} AS cap, {rsql('(cap - COALESCE(grp, 0)) / 1e6')} AS cap_ex, {rsql('(cap - COALESCE(grp, 0)) / cap')} AS share_ex FROM day",
    day="SELECT b.date, SUM(b.close * i.shares) AS cap, SUM(CASE WHEN i.sector = 'CHINA' THEN b.close * i.shares END) AS grp FROM bars b JOIN instruments i USING (symbol) GROUP BY b.date"))


def agg6(s, d):
    return M.market_cap_filled(bars(s, d), instruments(s, d)).select("date", "members", rounded(F.col("cap") / 1e6).alias("cap"))


add("agg6_market_per_share", agg6, sql(f"SELECT date, COUNT(px) AS members, {rsql('SUM(px * shares) / 1e6')} AS cap FROM filled JOIN instruments USING (symbol) GROUP BY date", **GRID))


def market(s, d):
    return valued_bars(s, d).groupBy("date").agg(F.sum("cap").alias("cap"), F.sum("earnings").alias("earnings"), F.sum("book").alias("book"))


MARKET = "SELECT date, SUM(cap) AS cap, SUM(earnings) AS earnings, SUM(book) AS book FROM valued_bars GROUP BY date"


def agg5_without(s, d):
    """The market without the names of two nations, with earnings and book values."""
    members = valued_bars(s, d).where(F.col("sector").isin("CHINA", "JAPAN")).withColumnRenamed("symbol", "code")
    out = M.valuation_without(market(s, d), members)
    return out.select("date", "names", rounded(F.col("cap_ex") / 1e6).alias("cap_ex"), *[rounded(c).alias(c) for c in ("pe_ex", "pb_ex", "roe", "roe_ex", "share")])


add("agg5_valuation_without", agg5_without, sql(
    "SELECT date, names, " + ", ".join(f"{rsql(e)} AS {n}" for n, e in {"cap_ex": "(cap - c) / 1e6", "pe_ex": "(cap - c) / NULLIF(earnings - e, 0)", "pb_ex": "(cap - c) / NULLIF(book - b, 0)", "roe": "earnings / NULLIF(book, 0)", "roe_ex": "(earnings - e) / NULLIF(book - b, 0)", "share": "c / cap"}.items()) + " FROM jx",
    mk=MARKET, mem="SELECT * FROM valued_bars WHERE sector IN ('CHINA', 'JAPAN')", liv="SELECT symbol, MIN(date) AS f FROM mem WHERE book IS NOT NULL GROUP BY 1",
    ex="SELECT date, COUNT(*) AS names, SUM(cap) AS c, CASE WHEN COUNT(*) = COUNT(earnings) THEN SUM(earnings) END AS e, CASE WHEN COUNT(*) = COUNT(book) THEN SUM(book) END AS b FROM mem JOIN liv USING (symbol) WHERE date >= f GROUP BY date",
    jx="SELECT mk.*, COALESCE(names, 0) AS names, COALESCE(c, 0) AS c, CASE WHEN names IS NULL THEN 0 ELSE e END AS e, CASE WHEN names IS NULL THEN 0 ELSE b END AS b FROM mk LEFT JOIN ex USING (date)"))


def agg6_per_share(s, d):
    v = valued_bars(s, d)
    return M.market_per_share(v, market(s, d)).select("date", "names", rounded("shares").alias("shares"), *[rounded(c, 6).alias(c) for c in ("eps", "bvps", "cap_check")])


add("agg6_per_share", agg6_per_share, sql(
    f"SELECT date, names, {rsql('shares')} AS shares, {rsql('earnings / NULLIF(shares, 0)', 6)} AS eps, {rsql('book / NULLIF(shares, 0)', 6)} AS bvps, {rsql('cp / cap', 6)} AS cap_check FROM (SELECT date, COUNT(sh) AS names, SUM(sh) AS shares, SUM(cp) AS cp FROM fl6 GROUP BY date) JOIN mk USING (date)",
    mk=MARKET, cal=GRID["cal"], bound=GRID["bound"],
    g6="SELECT b.symbol, c.date, c.sess, v.cap / v.close AS sh, v.cap AS cp FROM bound b JOIN cal c ON c.date BETWEEN b.f AND b.l LEFT JOIN valued_bars v ON v.symbol = b.symbol AND v.date = c.date",
    fl6="SELECT date, CASE WHEN sess - LAST_VALUE(CASE WHEN sh IS NOT NULL THEN sess END IGNORE NULLS) OVER w <= 20 THEN LAST_VALUE(sh IGNORE NULLS) OVER w END AS sh, CASE WHEN sess - LAST_VALUE(CASE WHEN cp IS NOT NULL THEN sess END IGNORE NULLS) OVER w <= 20 THEN LAST_VALUE(cp IGNORE NULLS) OVER w END AS cp FROM g6 WINDOW w AS (PARTITION BY symbol ORDER BY sess ROWS UNBOUNDED PRECEDING)"))

VENUES = ["AFRICA", "ASIA", "EUROPE"]


def agg7_venues(s, d):
    out = M.turnover_by_venue(official_turnover(s, d), bars(s, d), instruments(s, d), VENUES, "ASIA")
    return out.select("date", "source", *[rounded(c).alias(c) for c in (*VENUES, "total", "ma20", "ma50")])


add("agg7_turnover_by_venue", agg7_venues, sql(
    f"SELECT date, CASE WHEN n > 0 THEN 'official' ELSE 'estimate' END AS source, {', '.join(f'{rsql(v)} AS {v}' for v in (*VENUES, 'total'))}, {', '.join(f'{rsql(f'CASE WHEN COUNT(total) OVER m{n} = {n} THEN AVG(total) OVER m{n} END')} AS ma{n}' for n in (20, 50))} FROM dy WINDOW m20 AS (ORDER BY date ROWS 19 PRECEDING), m50 AS (ORDER BY date ROWS 49 PRECEDING)",
    es="SELECT exchange, date, SUM(close * volume) AS est FROM bars JOIN instruments USING (symbol) GROUP BY ALL",
    bo="SELECT exchange, date, o.value AS val, COALESCE(o.value, est) AS v FROM official_turnover o FULL JOIN es USING (exchange, date) WHERE exchange IN ('AFRICA', 'ASIA', 'EUROPE')",
    dy="SELECT date, " + ", ".join(f"SUM(v) FILTER (WHERE exchange = '{v}') AS {v}" for v in VENUES) + ", SUM(v) AS total, COUNT(val) FILTER (WHERE exchange = 'ASIA') AS n FROM bo GROUP BY date"))


def agg8_sizes(s, d):
    return M.size_buckets(bars(s, d), instruments(s, d), "1996-01-01", "1997-12-31", 3, 6).select("date", *[rounded(F.col(c) / 1e6).alias(c) for c in ("top", "middle", "small", "all")])


add("agg8_size_buckets", agg8_sizes, sql(
    "SELECT date, " + ", ".join(f"{rsql(f'COALESCE(SUM(cap) FILTER (WHERE {w}), 0) / 1e6')} AS {n}" for n, w in {"top": "r <= 3", "middle": "r > 3 AND r <= 6", "small": "r > 6", '"all"': "TRUE"}.items()) + " FROM ins LEFT JOIN rk USING (symbol) GROUP BY date",
    **GRID, ins="SELECT f.symbol, date, px * shares AS cap FROM filled f JOIN instruments USING (symbol) WHERE date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'",
    rk="SELECT symbol, RANK() OVER (ORDER BY cap DESC) AS r FROM ins WHERE date = (SELECT MAX(date) FROM ins) AND cap IS NOT NULL"))


def agg7(s, d):
    return M.turnover(bars(s, d), instruments(s, d)).select("exchange", "date", rounded("turnover").alias("turnover"), rounded("ma20").alias("ma20"))


add("agg7_turnover", agg7, sql(
    f"SELECT exchange, date, {rsql('turnover')} AS turnover, {rsql('CASE WHEN COUNT(turnover) OVER w = 20 THEN AVG(turnover) OVER w END')} AS ma20 FROM t WINDOW w AS (PARTITION BY exchange ORDER BY date ROWS 19 PRECEDING)",
    t="SELECT exchange, date, SUM(value) AS turnover FROM bars JOIN instruments USING (symbol) GROUP BY exchange, date"))


def agg8(s, d):
    return M.sector_index(bars(s, d), instruments(s, d), "1995-01-01", "1996-12-31").select("sector", "date", "members", rounded("idx").alias("idx"))


add("agg8_sector_index", agg8, sql(
    f"SELECT sector, date, members, {rsql('100 * cap / FIRST_VALUE(cap) OVER (PARTITION BY sector ORDER BY date)')} AS idx FROM c",
    **GRID,
    inside="SELECT f.*, i.sector, i.shares FROM filled f JOIN instruments i USING (symbol) WHERE date BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'",
    ends="SELECT MIN(date) AS d0, MAX(date) AS d1 FROM inside",
    fixed="SELECT symbol FROM inside, ends WHERE date IN (d0, d1) AND px IS NOT NULL GROUP BY symbol HAVING COUNT(*) = 2",
    c="SELECT sector, date, COUNT(px) AS members, SUM(px * shares) AS cap FROM inside WHERE symbol IN (SELECT symbol FROM fixed) GROUP BY sector, date"))


def agg9(s, d):
    return M.cap_weighted_returns(bars(s, d), instruments(s, d), "1998-01-01").select("sector", "horizon", "members", rounded("ret", 6).alias("ret"))


add("agg9_cap_weighted_returns", agg9, sql(
    f"SELECT sector, horizon, COUNT(*) AS members, {rsql('SUM((p1 / p0 - 1) * p0 * shares) / NULLIF(SUM(p0 * shares), 0)', 6)} AS ret FROM j GROUP BY sector, horizon",
    h="SELECT * FROM (VALUES ('1D', DATE '1997-12-31'), ('1W', DATE '1997-12-25'), ('1M', DATE '1997-12-01'), ('3M', DATE '1997-10-01'), ('6M', DATE '1997-07-01'), ('2Y', DATE '1996-01-01'), ('5Y', DATE '1993-01-01'), ('1Y', DATE '1997-01-01'), ('3Y', DATE '1995-01-01'), ('YTD', DATE '1997-12-31')) v(horizon, cutoff)",
    p0="SELECT symbol, horizon, MAX_BY(close, date) AS p0 FROM bars JOIN h ON date <= cutoff GROUP BY symbol, horizon",
    p1="SELECT symbol, MAX_BY(close, date) AS p1 FROM bars WHERE date <= DATE '1998-01-01' GROUP BY symbol",
    j="SELECT sector, horizon, p0, p1, shares FROM p0 JOIN p1 USING (symbol) JOIN instruments USING (symbol)"))


def agg10(s, d):
    return M.heatmap(bars(s, d), instruments(s, d), 5, 30).select("symbol", "sector", rounded(F.col("cap") / 1e6).alias("cap"), rounded("change", 6).alias("change"))


add("agg10_heatmap", agg10, sql(
    f"SELECT symbol, sector, {rsql('cap / 1e6')} AS cap, {rsql('close / before - 1', 6)} AS change FROM m ORDER BY m.cap DESC, symbol LIMIT 30",
    l="SELECT *, LAG(close, 5) OVER (PARTITION BY symbol ORDER BY date) AS before FROM bars",
    m="SELECT symbol, sector, close * shares AS cap, close, before FROM l JOIN instruments USING (symbol) QUALIFY ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY date DESC) = 1"))


def agg11(s, d):
    return M.flows_by_period(flows(s, d), instruments(s, d), "month").select("sector", "period", "codes", rounded("net").alias("net"))


add("agg11_flows_by_sector", agg11, sql(f"SELECT sector, CAST(LAST_DAY(date) AS DATE) AS period, COUNT(DISTINCT code) AS codes, {rsql('SUM(buy_val - sell_val)')} AS net FROM flows JOIN instruments ON code = symbol GROUP BY ALL"))


def agg12(s, d):
    return M.both_tails(flows(s, d), 10).select("side", "code", rounded("net").alias("net"))


add("agg12_top_flows", agg12, sql(
    f"SELECT 'buy' AS side, code, {rsql('net')} AS net FROM (SELECT * FROM n ORDER BY net DESC, code LIMIT 10) UNION ALL SELECT 'sell', code, {rsql('net')} FROM (SELECT * FROM n ORDER BY net, code LIMIT 10)",
    n="SELECT code, SUM(buy_val - sell_val) AS net FROM flows GROUP BY code"))


def agg13(s, d):
    return M.flow_drilldown(flows(s, d)).select("code", rounded("net").alias("net"), rounded("share", 6).alias("share"), "up_days", "down_days", "first_day", "last_day")


add("agg13_flow_drilldown", agg13, sql(
    f"SELECT code, {rsql('SUM(buy_val - sell_val)')} AS net, {rsql('SUM(buy_val - sell_val) / NULLIF(SUM(total_value), 0)', 6)} AS share, COUNT(*) FILTER (WHERE buy_val > sell_val) AS up_days, COUNT(*) FILTER (WHERE buy_val < sell_val) AS down_days, MIN(CASE WHEN buy_val > 0 THEN date END) AS first_day, MAX(CASE WHEN buy_val > 0 THEN date END) AS last_day FROM flows GROUP BY code"))


def agg15(s, d):
    return M.venue_flows(flows(s, d), instruments(s, d)).select("exchange", "date", rounded("net").alias("net"), rounded("cumulative").alias("cumulative"), rounded("others").alias("others"))


add("agg15_venue_flows", agg15, sql(
    f"SELECT exchange, date, {rsql('net')} AS net, {rsql('SUM(net) OVER (PARTITION BY exchange ORDER BY date ROWS UNBOUNDED PRECEDING)')} AS cumulative, {rsql('others')} AS others FROM v",
    v="SELECT exchange, date, SUM(buy_val - sell_val) AS net, SUM(total_value - buy_val - sell_val) AS others FROM flows JOIN instruments ON code = symbol GROUP BY exchange, date"))


def agg16(s, d):
    return M.monthly_turnover(bars(s, d)).select("month", "sessions", rounded("mean_turnover").alias("mean_turnover"), "unfinished")


add("agg16_monthly_turnover", agg16, sql(
    f"SELECT LAST_DAY(date) AS month, COUNT(*) AS sessions, {rsql('AVG(v)')} AS mean_turnover, MAX(date) = (SELECT MAX(date) FROM bars) AND MAX(date) < LAST_DAY(MAX(date)) AS unfinished FROM t GROUP BY LAST_DAY(date)",
    t="SELECT date, SUM(value) AS v FROM bars GROUP BY date"))


def agg17(s, d):
    return M.own_history_quintiles(bars(s, d))


add("agg17_own_history_quintiles", agg17, sql(
    "SELECT month, 1 + CAST(LEAST(FLOOR(5.0 * below / n), 4) AS INT) AS quintile, COUNT(*) AS names FROM r WHERE n >= 12 GROUP BY ALL",
    m="SELECT symbol, CAST(LAST_DAY(date) AS DATE) AS month, MAX_BY(close, date) AS px FROM bars GROUP BY ALL",
    r="SELECT a.symbol, a.month, COUNT(*) AS n, COUNT(*) FILTER (WHERE b.px < a.px) AS below FROM m a JOIN m b ON a.symbol = b.symbol AND b.month < a.month AND b.month >= a.month - INTERVAL 5 YEAR GROUP BY ALL"))


def agg18(s, d):
    return M.growth_by_group(bars(s, d), instruments(s, d)).select("sector", "year", rounded("level").alias("level"), rounded("growth", 6).alias("growth"))


add("agg18_growth_by_sector", agg18, sql(
    f"SELECT sector, year, {rsql('level')} AS level, {rsql('(level - LAG(level) OVER w) / NULLIF(ABS(LAG(level) OVER w), 0)', 6)} AS growth FROM g WINDOW w AS (PARTITION BY sector ORDER BY year)",
    g="SELECT sector, CAST(YEAR(date) AS INT) AS year, SUM(value) / COUNT(DISTINCT symbol) AS level FROM bars JOIN instruments USING (symbol) GROUP BY ALL"))


def agg54(s, d):
    return M.liquidity(bars(s, d), instruments(s, d)).select("symbol", "date", "sector", rounded("liquidity").alias("liquidity"))


add("agg54_liquidity", agg54, sql(f"SELECT symbol, date, sector, {rsql('close * volume / 1e6')} AS liquidity FROM bars JOIN instruments USING (symbol)"))


def top1(s, d):
    return M.top_by_cap(bars(s, d), instruments(s, d), 20, 200).select("symbol", "sessions", rounded("cap").alias("cap"))


add("top1_largest_by_cap", top1, sql(
    f"SELECT symbol, sessions, {rsql('cap')} AS cap FROM c WHERE sessions >= 200 ORDER BY c.cap DESC, symbol LIMIT 20",
    c="SELECT symbol, COUNT(*) AS sessions, MAX_BY(close, date) * ANY_VALUE(shares) AS cap FROM bars JOIN instruments USING (symbol) GROUP BY symbol"))


def top2(s, d):
    return M.top_by_size(flows(s, d), 25).select("code", "date", rounded("net").alias("net"))


add("top2_top_by_size", top2, sql(f"SELECT code, date, {rsql('buy_val - sell_val')} AS net FROM flows ORDER BY ABS(buy_val - sell_val) DESC, code, date LIMIT 25"))


def agg46(s, d):
    return M.insider_tables(flows(s, d)).select("month", "code", "trades", rounded("bought").alias("bought"), rounded("largest").alias("largest"))


add("agg46_insider_months", agg46, sql(
    f"SELECT CAST(LAST_DAY(date) AS DATE) AS month, code, COUNT(*) AS trades, {rsql('SUM(buy_val)')} AS bought, {rsql('MAX_BY(buy_val - sell_val, (ABS(buy_val - sell_val), date))')} AS largest FROM flows GROUP BY ALL"))
