"""Statement queries, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import statements as O
from ..operators import temporal as T
from ..sources.views import SECURITIES, bars, facts, instruments, rounded, rsql, securities_items, sql
from .join_plans import PUB, published

Q, S = {}, {}


def add(name, statement):
    def put(run):
        Q[name], S[name] = run, statement
        return run

    return put


def lag_sql(c: str, n: int) -> str:
    return f"CASE WHEN LAG(t, {n}) OVER w = t - {n} THEN LAG({c}, {n}) OVER w END"


def ttm_sql(c: str) -> str:
    return f"CASE WHEN LAG(t, 3) OVER w = t - 3 AND COUNT({c}) OVER (w ROWS 3 PRECEDING) = 4 THEN SUM({c}) OVER (w ROWS 3 PRECEDING) END"


ITEM = "PARTITION BY ticker, item ORDER BY t"


@add("win5_trailing_sum", sql(f"SELECT ticker, item, t, {rsql(ttm_sql('value').replace('(w ROWS', f'({ITEM} ROWS'))} AS ttm FROM facts WINDOW w AS ({ITEM})"))
def win5(s, d):
    return facts(s, d).select("ticker", "item", "t", rounded(T.trailing_sum("value", ["ticker", "item"], "t")).alias("ttm"))


@add("win6_growth", sql(f"SELECT ticker, item, t, {rsql(f'(value - {lag_sql(chr(118) + "alue", 4)}) / NULLIF(ABS({lag_sql("value", 4)}), 0)', 6)} AS yoy, {rsql(f'(value + {lag_sql("value", 1)}) / 2')} AS mean_ends FROM facts WINDOW w AS ({ITEM})"))
def win6(s, d):
    f = facts(s, d)
    keys = ["ticker", "item"]
    return f.select("ticker", "item", "t", rounded(O.growth(f, keys, "t", "value", 4), 6).alias("yoy"), rounded(O.mean_of_ends(keys, "t", "value", 1)).alias("mean_ends"))


ITEMS = {"a": "1-URGENT", "b": "2-HIGH", "c": "3-MEDIUM", "d": "4-NOT SPECIFIED", "e": "5-LOW"}
WIDE = "SELECT ticker, t, " + ", ".join(f"SUM(value) FILTER (WHERE item = '{v}') AS {k}" for k, v in ITEMS.items()) + " FROM facts GROUP BY ALL"
TICK = "PARTITION BY ticker ORDER BY t"
BASE = "SELECT *, " + ", ".join(f"{ttm_sql(c).replace('(w ROWS', f'({TICK} ROWS')} AS {c}_ttm" for c in "cd") + ", " + ", ".join(f"({c} + {lag_sql(c, 4)}) / 2 AS {c}_mean" for c in "ab") + f" FROM wide WINDOW w AS ({TICK})"


def wide(s, d):
    return O.wide_items(facts(s, d), ["ticker", "t"], ITEMS)


def div(top: str, bottom: str) -> str:
    return f"({top}) / NULLIF({bottom}, 0)"


RATIO_SQL = {
    "equity": "a - b", "leverage": div("a", "a - b"), "margin": div("c - d", "c"), "cost_income": div("d", "c"), "turnover": div("c", "a"), "cash_share": div("e", "a"),
    "debt_share": div("b", "a"), "roa": div("c_ttm - d_ttm", "a_mean"), "roe": div("c_ttm - d_ttm", "a_mean - b_mean"), "margin_ttm": div("c_ttm - d_ttm", "c_ttm"), "cash_cover": div("e", "b"),
    "spread": div("c_ttm", "a_mean") + " - " + div("d_ttm", "b_mean"),
}


@add("win7_ratio_set", sql("SELECT ticker, t, " + ", ".join(f"{rsql(e)} AS {n}" for n, e in RATIO_SQL.items()) + " FROM base", wide=WIDE, base=BASE))
def win7(s, d):
    out = O.ratio_set(wide(s, d), "ticker", "t")
    return out.select("ticker", "t", *[rounded(n).alias(n) for n in O.RATIOS])


#: The windows are written once more here; formulas of ratios are data of the library.
PER = "PARTITION BY ticker, freq ORDER BY t"


def lag_of(c: str, n: int) -> str:
    return f"CASE WHEN LAG(t, {n}) OVER w = t - {n} THEN LAG({c}, {n}) OVER w END"


def year_of(c: str) -> str:
    return f"CASE WHEN freq = 'Q' THEN {lag_of(c, 4)} ELSE {lag_of(c, 1)} END"


SEC = {
    "swide": "SELECT ticker, freq, t, " + ", ".join(f"{'ABS(' if n in O.COSTS else '('}SUM(value) FILTER (WHERE item = '{n}')) AS {n}" for n in SECURITIES) + " FROM securities_items GROUP BY ALL",
    "sder": "SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in O.DERIVED.items()) + " FROM swide",
    "swin": "SELECT *, " + ", ".join(f"CASE WHEN freq = 'Y' THEN {c} WHEN LAG(t, 3) OVER w = t - 3 AND COUNT({c}) OVER (w ROWS 3 PRECEDING) = 4 THEN SUM({c}) OVER (w ROWS 3 PRECEDING) END AS {c}_ttm".replace("(w ROWS", f"({PER} ROWS") for c in O.SUMMED) + ", " + ", ".join(f"({c} + COALESCE({year_of(c)}, {c})) / 2 AS {c}_avg" for c in O.AVERAGED) + ", " + ", ".join(f"{year_of(c)} AS {c}_year" for c in O.COMPARED) + f", {lag_of('margin_book', 1)} AS margin_book_last FROM sder WINDOW w AS ({PER})",
    "srat": "SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in O.SECURITIES_RATIOS.items()) + " FROM swin",
}
SHOWN = [*O.DERIVED, *[f"{c}_ttm" for c in O.SUMMED], *O.SECURITIES_RATIOS]


@add("win7_securities_ratios", sql("SELECT ticker, freq, t, " + ", ".join(f"{rsql(c)} AS {c}" for c in SHOWN) + " FROM srat", **SEC))
def win7_securities(s, d):
    """Eleven derived figures, fifteen trailing sums and twenty-nine ratios, of quarters and years."""
    return O.securities_ratios(securities_items(s, d), SECURITIES).select("ticker", "freq", "t", *[rounded(c).alias(c) for c in SHOWN])


SUMMARY = {"sum_equity": "SUM(equity)", "sum_total_assets": "SUM(total_assets)", "sum_margin_book": "SUM(margin_book)", "sum_npat_ttm": "SUM(npat_ttm)", "sum_op_revenue_ttm": "SUM(op_revenue_ttm)", "med_roe": "MEDIAN(roe)", "med_leverage": "MEDIAN(leverage)", "med_net_margin": "MEDIAN(net_margin)", "med_cir": "MEDIAN(cir)", "ind_roe_ttm": "100 * " + div("SUM(npat_ttm)", "SUM(equity)"), "ind_margin_to_equity": "100 * " + div("SUM(margin_book)", "SUM(equity)"), "ind_net_margin_ttm": "100 * " + div("SUM(npat_ttm)", "SUM(op_revenue_ttm)")}


@add("agg30_securities_summary", sql("SELECT freq, t, COUNT(DISTINCT ticker) AS companies, " + ", ".join(f"{rsql(e)} AS {n}" for n, e in SUMMARY.items()) + " FROM srat GROUP BY ALL", **SEC))
def agg30_securities(s, d):
    out = O.securities_summary(O.securities_ratios(securities_items(s, d), SECURITIES))
    return out.select("freq", "t", "companies", *[rounded(c).alias(c) for c in SUMMARY])


@add("agg30_size_classes", sql(f"SELECT ticker, t, {rsql('equity')} AS equity, CASE WHEN equity <= (SELECT QUANTILE_CONT(equity, 0.33) FROM lst) THEN 'small' WHEN equity <= (SELECT QUANTILE_CONT(equity, 0.66) FROM lst) THEN 'medium' ELSE 'large' END AS size FROM lst", **SEC, lst="SELECT ticker, MAX(t) AS t, MAX_BY(equity, t) AS equity FROM srat WHERE freq = 'Q' AND equity IS NOT NULL GROUP BY 1"))
def agg30_sizes(s, d):
    return O.size_classes(O.securities_ratios(securities_items(s, d), SECURITIES)).withColumn("equity", rounded("equity"))


@add("mod7_metric_formulas", sql(f"SELECT ticker, t, {rsql('c_ttm - d_ttm')} AS profit, {rsql(div('c_ttm', 'a_mean'))} AS yield, {rsql(div(f'a - {lag_sql(chr(97), 4)}', f'ABS({lag_sql(chr(97), 4)})'))} AS asset_growth FROM base WINDOW w AS ({TICK})", wide=WIDE, base=BASE))
def mod7(s, d):
    formulas = {"profit": "ttm(c) - ttm(d)", "yield": "try_divide(ttm(c), avg(a))", "asset_growth": "try_divide(a - lag(a), abs(lag(a)))"}
    return O.metrics(wide(s, d), "ticker", "t", formulas).select("ticker", "t", *[rounded(n).alias(n) for n in formulas])


LINES = "SELECT l_orderkey AS st, l_linenumber AS pos, CAST(l_partkey % 4 AS INT) AS lvl, 'i' || CAST(l_partkey AS VARCHAR) AS name FROM (SELECT l_orderkey, l_linenumber, MIN(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL)"


@add("win28_parents", sql("SELECT x.st, x.pos, x.name, (SELECT ARG_MAX(y.name, y.pos) FROM ln y WHERE y.st = x.st AND y.pos < x.pos AND y.lvl < x.lvl) AS parent FROM ln x", ln=LINES))
def win28(s, d):
    x = s.read.parquet(f"{d}/lineitem.parquet").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"))
    ln = x.select(F.col("l_orderkey").alias("st"), F.col("l_linenumber").alias("pos"), (F.col("p") % 4).cast("int").alias("lvl"), F.concat(F.lit("i"), F.col("p").cast("string")).alias("name"))
    return O.parents(ln, "st", "pos", "lvl", "name").select("st", "pos", "name", "parent")


GROUPS = "SELECT DISTINCT ticker, 'g' || CAST(ticker % 5 AS VARCHAR) AS grp FROM facts"


def groups(s, d):
    return facts(s, d).select("ticker").distinct().withColumn("grp", F.concat(F.lit("g"), (F.col("ticker") % 5).cast("string")))


@add("agg1_industry_statement", sql(f"SELECT grp, item, t, {rsql('SUM(value)')} AS value, COUNT(DISTINCT ticker) AS companies FROM facts JOIN groups USING (ticker) GROUP BY ALL", groups=GROUPS))
def agg1(s, d):
    return O.industry_statement(facts(s, d), groups(s, d)).withColumn("value", rounded("value"))


@add("agg25_same_member_ratio", sql(f"SELECT t, members, {rsql('top / NULLIF(bottom, 0)', 6)} AS ratio FROM p WHERE members >= 0.6 * (SELECT MAX(members) FROM p)", b="SELECT ticker, t, SUM(value) FILTER (WHERE item = '1-URGENT') AS x, SUM(value) FILTER (WHERE item = '2-HIGH') AS y FROM facts GROUP BY ALL", p="SELECT t, SUM(x) AS top, SUM(y) AS bottom, COUNT(*) AS members FROM b WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY t"))
def agg25(s, d):
    return O.same_member_ratio(facts(s, d), "1-URGENT", "2-HIGH", 0.6).withColumn("ratio", rounded("ratio", 6))


@add("agg26_funding_gap", sql(f"SELECT item, {rsql('c')} AS change, {rsql('c / NULLIF(SUM(c) OVER (), 0)', 6)} AS share FROM (SELECT item, COALESCE(SUM(value) FILTER (WHERE t = 7992), 0) - COALESCE(SUM(value) FILTER (WHERE t = 7988), 0) AS c FROM facts WHERE t IN (7988, 7992) GROUP BY item)"))
def agg26(s, d):
    return O.funding_gap(facts(s, d), 7988, 7992).select("item", rounded("change").alias("change"), rounded("share", 6).alias("share"))


@add("agg27_group_mean", sql(f"SELECT item, {rsql('AVG(value)')} AS mean, COUNT(*) AS n, STRING_AGG(DISTINCT CAST(ticker AS VARCHAR), ',' ORDER BY CAST(ticker AS VARCHAR)) AS members FROM (SELECT * FROM facts QUALIFY ROW_NUMBER() OVER (PARTITION BY ticker, item ORDER BY t DESC) = 1) GROUP BY item HAVING COUNT(*) >= 2"))
def agg27(s, d):
    last = facts(s, d).groupBy("ticker", "item").agg(F.max_by("value", "t").alias("value")).withColumn("member", F.col("ticker").cast("string"))
    return O.group_mean(last, "item", "member", "value").withColumn("mean", rounded("mean"))


@add("agg28_fixed_panel", sql(f"SELECT t, {rsql('value')} AS value, n, {rsql(ttm_sql('value').replace('(w ROWS', '(ORDER BY t ROWS'))} AS ttm FROM k WINDOW w AS (ORDER BY t)", k="SELECT t, SUM(value) AS value, COUNT(DISTINCT ticker) AS n FROM facts GROUP BY t HAVING COUNT(DISTINCT ticker) >= 0.9 * (SELECT COUNT(DISTINCT ticker) FROM facts)"))
def agg28(s, d):
    return O.fixed_panel(facts(s, d)).select("t", rounded("value").alias("value"), "n", rounded("ttm").alias("ttm"))


@add("agg29_group_years", sql(f"SELECT grp, item, year, {rsql('CASE WHEN COUNT(*) = 4 THEN SUM(value) END')} AS flow, {rsql('MAX(value) FILTER (WHERE quarter = 4)')} AS balance FROM (SELECT grp, item, year, quarter, SUM(value) AS value FROM facts JOIN groups USING (ticker) GROUP BY ALL) GROUP BY ALL", groups=GROUPS))
def agg29(s, d):
    return O.group_years(facts(s, d), groups(s, d)).select("grp", "item", "year", rounded("flow").alias("flow"), rounded("balance").alias("balance"))


@add("agg30_industry_summary", sql(f"SELECT t, {rsql('SUM(a - b)')} AS equity, {rsql('MEDIAN(' + div('a', 'a - b') + ')')} AS leverage, {rsql('MEDIAN(' + div('c - d', 'c') + ')')} AS margin, {rsql('QUANTILE_CONT(a - b, 0.33)')} AS p33, {rsql('QUANTILE_CONT(a - b, 0.66)')} AS p66 FROM wide GROUP BY t", wide=WIDE))
def agg30(s, d):
    out = O.industry_summary(O.ratio_set(wide(s, d), "ticker", "t"))
    return out.select("t", *[rounded(c).alias(c) for c in ("equity", "leverage", "margin", "p33", "p66")])


@add("agg52_statement_feed", sql("SELECT ticker, item, year, " + ", ".join(f"{rsql(f'COALESCE(SUM(value) FILTER (WHERE quarter = {q}), 0)')} AS q{q}" for q in (1, 2, 3, 4)) + f", {rsql('SUM(value)')} AS total FROM facts GROUP BY ALL"))
def agg52(s, d):
    out = O.statement_feed(facts(s, d), [1, 2, 3, 4])
    return out.select("ticker", "item", "year", *[rounded(c).alias(c) for c in ("q1", "q2", "q3", "q4", "total")])


@add("agg52_blank_feed", sql("SELECT ticker, item, year, " + ", ".join(f"{rsql(f'SUM(value) FILTER (WHERE quarter = {q})')} AS q{q}" for q in (1, 2, 3, 4)) + f", {rsql('SUM(value)')} AS total FROM (SELECT * FROM facts WHERE (ticker + t) % 5 <> 0) GROUP BY ALL"))
def agg52_blank(s, d):
    out = O.statement_feed(facts(s, d).where((F.col("ticker") + F.col("t")) % 5 != 0), [1, 2, 3, 4], blank=True)
    return out.select("ticker", "item", "year", *[rounded(c).alias(c) for c in ("q1", "q2", "q3", "q4", "total")])


@add("agg52_ticker_statement", sql("SELECT item, " + ", ".join(f"{rsql(f'SUM(value) FILTER (WHERE t = {t})')} AS p{t}" for t in range(7984, 7992)) + " FROM facts WHERE ticker = 3 GROUP BY item"))
def agg52_ticker(s, d):
    periods = list(range(7984, 7992))
    return O.ticker_statement(facts(s, d), 3, periods).select("item", *[rounded(F.col(str(t))).alias(f"p{t}") for t in periods])


@add("agg51_market_drivers", sql(f"SELECT CAST(YEAR(date) * 4 + QUARTER(date) - 1 AS INT) AS t, {rsql('CASE WHEN COUNT(*) >= 40 THEN SUM(v) END')} AS total, {rsql('AVG(v)')} AS mean, COUNT(*) AS sessions, {rsql('MAX_BY(v, date)')} AS last FROM m WHERE v BETWEEN 0.5 * m AND 2 * m GROUP BY 1", m="SELECT date, v, MEDIAN(v) OVER (ORDER BY date ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING) AS m FROM (SELECT date, SUM(value) AS v FROM bars GROUP BY date)"))
def agg51(s, d):
    out = O.market_drivers(bars(s, d), 40)
    return out.select("t", rounded("total").alias("total"), rounded("mean").alias("mean"), "sessions", rounded("last").alias("last"))


@add("top3_report_order", sql("SELECT ticker, item, t, CASE item WHEN '5-LOW' THEN 1 WHEN '1-URGENT' THEN 2 ELSE 3 END AS place FROM facts"))
def top3(s, d):
    return O.report_order(facts(s, d), ["5-LOW", "1-URGENT"]).select("ticker", "item", "t", F.col("place").cast("int").alias("place"))


@add("src14_fact_schema", sql(f"SELECT ticker, item, t, {rsql('value')} AS value, src FROM (SELECT ticker, item, t, value, 'a' AS src FROM facts WHERE ticker % 2 = 0 UNION ALL SELECT ticker, item, t, value / 1000 * 1000, 'b' FROM facts WHERE ticker % 2 = 1)"))
def src14(s, d):
    """Two providers, one in thousands and with textual periods, brought into one schema."""
    f = facts(s, d)
    a = f.where("ticker % 2 = 0").select("ticker", "item", "t", "value", F.lit("a").alias("src"))
    text = f.where("ticker % 2 = 1").select("ticker", "item", F.concat(F.lit("Q"), F.col("quarter"), F.lit("/"), F.col("year")).alias("period"), (F.col("value") / 1000).alias("thousands"))
    q, y = F.regexp_extract("period", r"Q(\d)", 1).cast("int"), F.regexp_extract("period", r"/(\d+)", 1).cast("int")
    b = text.select("ticker", "item", (y * 4 + q - 1).alias("t"), (F.col("thousands") * 1000).alias("value"), F.lit("b").alias("src"))
    return a.unionByName(b).withColumn("value", rounded("value"))


@add("agg2_daily_industry_pe", sql(f"SELECT exchange, date, members, {rsql('CASE WHEN e > 0 THEN cap / e END', 6)} AS pe FROM (SELECT exchange, date, SUM(CASE WHEN v IS NOT NULL THEN close * shares END) AS cap, SUM(v) AS e, COUNT(v) AS members FROM (SELECT b.*, i.exchange, i.shares, q.value AS v FROM bars b JOIN instruments i USING (symbol) ASOF LEFT JOIN q ON b.symbol % 25 = q.ticker AND b.date >= q.known) GROUP BY exchange, date) WHERE members >= 2", q=PUB))
def daily_pe(s, d):
    held = instruments(s, d).withColumn("ticker", F.col("symbol") % 25)
    known = published(s, d).withColumn("ticker", F.col("ticker").cast("long"))
    return O.industry_pe(bars(s, d), held, known, 2).select("exchange", "date", "members", rounded("pe", 6).alias("pe"))
