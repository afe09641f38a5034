"""Property and macro queries, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import macro as C
from ..operators import property as O
from ..sources.views import bars, facts, flows, fx, instruments, listings, rounded, rsql, sql, table

Q, S = {}, {}


def add(name, statement=None):
    def put(run):
        Q[name], S[name] = run, statement
        return run

    return put


INDEX = {
    "ms": "SELECT LAST_DAY(CAST(UNNEST(GENERATE_SERIES(DATE '1996-01-01', DATE '1997-12-01', INTERVAL 1 MONTH)) AS DATE)) AS month",
    "nw": "SELECT district, month, prid, MAX_BY(ppm2, posted) AS ppm2 FROM listings JOIN ms ON posted <= month AND posted > month - 120 GROUP BY ALL",
    "m1": "SELECT district, month, MEDIAN(ppm2) AS m FROM nw GROUP BY ALL",
    "a": "SELECT nw.* FROM nw JOIN m1 USING (district, month) WHERE ppm2 BETWEEN 0.5 * m AND 2 * m",
    "c": "SELECT district, month, MEDIAN(ppm2) AS c, COUNT(*) AS n FROM a GROUP BY ALL",
    "e": "SELECT a.*, c, n, ABS(ppm2 - c) AS dev FROM a JOIN c USING (district, month)",
    "sd": "SELECT district, month, 1.4826 * MEDIAN(dev) AS s FROM e GROUP BY ALL",
    "kept": "SELECT e.* FROM e JOIN sd USING (district, month) WHERE n < 4 OR s = 0 OR dev <= 3.5 * s",
}


@add("agg42_price_index", sql(f"SELECT district, month, COUNT(*) AS n, {rsql('QUANTILE_CONT(ppm2, 0.25)')} AS p25, {rsql('MEDIAN(ppm2)')} AS p50, {rsql('QUANTILE_CONT(ppm2, 0.9)')} AS p90, {rsql('AVG(ppm2)')} AS mean FROM kept GROUP BY ALL HAVING COUNT(*) >= 5", **INDEX))
def agg42(s, d):
    """Numbers of listings repeat: of two rows of one day, the first in the table counts, as the SQL takes it."""
    out = O.price_index(listings(s, d, "file", "row"), ["district"], "1996-01-01", "1997-12-31", ties=("file", "row"))
    return out.withColumns({c: rounded(c) for c in ("p25", "p50", "p90", "mean")})


@add("agg42_by_bedrooms", sql(f"SELECT project_id, bed, {rsql('MEDIAN(ppm2)')} AS median, COUNT(*) AS n FROM listings GROUP BY ALL HAVING COUNT(*) >= 3"))
def agg42_beds(s, d):
    return O.by_bedrooms(listings(s, d), "project_id").withColumn("median", rounded("median"))


@add("agg43_listing_summary", sql(f"SELECT district, COUNT(*) AS n, {rsql('QUANTILE_CONT(ppm2, 0.25)')} AS q1, {rsql('MEDIAN(ppm2)')} AS q2, {rsql('QUANTILE_CONT(ppm2, 0.75)')} AS q3, COUNT(*) FILTER (WHERE posted > DATE '1998-06-23') AS new7, COUNT(*) FILTER (WHERE posted > DATE '1998-05-31') AS new30 FROM listings GROUP BY district"))
def agg43(s, d):
    return O.summary(listings(s, d), "district", "1998-06-30").withColumns({c: rounded(c) for c in ("q1", "q2", "q3")})


@add("agg44_weekly", sql(f"SELECT district, week, {rsql('MEDIAN(ppm2)')} AS median, {rsql('QUANTILE_CONT(ppm2, 0.25)')} AS p25, {rsql('QUANTILE_CONT(ppm2, 0.75)')} AS p75, COUNT(*) AS projects FROM (SELECT district, project_id, CAST(DATE_TRUNC('week', posted) + INTERVAL 6 DAY AS DATE) AS week, MAX_BY(ppm2, (posted, prid)) AS ppm2 FROM listings GROUP BY ALL) GROUP BY ALL"))
def agg44(s, d):
    return O.weekly(listings(s, d), "district").withColumns({c: rounded(c) for c in ("median", "p25", "p75")})


@add("agg45_agreement", sql(f"SELECT COUNT(*) AS n, {rsql('QUANTILE_CONT(r, 0.1)')} AS p10, {rsql('MEDIAN(r)')} AS p50, {rsql('QUANTILE_CONT(r, 0.9)')} AS p90, {rsql('COUNT(*) FILTER (WHERE ABS(r - 1) <= 0.1) / COUNT(*)')} AS within, {rsql('CORR(LN(a), LN(b))', 6)} AS log_corr FROM (SELECT a, b, a / b AS r FROM (SELECT project_id, MEDIAN(ppm2) AS a FROM listings WHERE bed = 1 GROUP BY 1) JOIN (SELECT project_id, MEDIAN(ppm2) AS b FROM listings WHERE bed = 2 GROUP BY 1) USING (project_id))"))
def agg45(s, d):
    one, two = (listings(s, d).where(f"bed = {k}").groupBy("project_id").agg(F.median("ppm2").alias("value")) for k in (1, 2))
    out = O.agreement(one, two, ["project_id"])
    return out.select("n", *[rounded(c).alias(c) for c in ("p10", "p50", "p90", "within")], rounded("log_corr", 6).alias("log_corr"))


@add("agg55_box_overlap", sql("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity <= 20 AND l_quantity + 3 >= 10 AND l_discount <= 0.05 AND l_discount + 0.01 >= 0.02"))
def agg55(s, d):
    x = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("x0"), (F.col("l_quantity") + 3).alias("x1"), F.col("l_discount").alias("y0"), (F.col("l_discount") + 0.01).alias("y1"))
    return O.in_box(x, (10, 0.02, 20, 0.05), ("x0", "y0"), ("x1", "y1")).select("l_orderkey", "l_linenumber")


@add("agg59_status_summary", sql(f"SELECT status, COUNT(*) AS projects, SUM(units) AS units, CAST(SUM(listings) AS BIGINT) AS listings, {rsql('MEDIAN(ppm2)')} AS median FROM (SELECT p_partkey, p_size AS units, CASE WHEN p_size < 20 THEN 'open' ELSE 'sold' END AS status, x.listings, x.ppm2 FROM part LEFT JOIN (SELECT project_id, COUNT(*) AS listings, MAX_BY(ppm2, (posted, prid)) AS ppm2 FROM listings GROUP BY 1) x ON x.project_id = p_partkey) GROUP BY status"))
def agg59(s, d):
    projects = table(s, d, "part").select(F.col("p_partkey").alias("project_id"), F.col("p_size").alias("units"))
    out = O.status_summary(projects, listings(s, d), F.when(F.col("units") < 20, "open").otherwise("sold"))
    return out.withColumn("median", rounded("median"))


SER = "SELECT 's' || currency AS series_id, date, rate AS value FROM fx WHERE NOT (currency = 'F' AND MONTH(date) % 5 = 0)"


def series(s, d):
    return fx(s, d).where("NOT (currency = 'F' AND month(date) % 5 = 0)").select(F.concat(F.lit("s"), "currency").alias("series_id"), "date", F.col("rate").alias("value"))


FILL = "CASE WHEN step - LAST_VALUE(CASE WHEN {c} IS NOT NULL THEN step END IGNORE NULLS) OVER w <= 5 THEN LAST_VALUE({c} IGNORE NULLS) OVER w END AS {c}f"


@add("win13_derived_series", sql(f"SELECT series_id, date, {rsql('value')} AS value FROM (SELECT 'spread' AS series_id, date, CASE WHEN sO IS NOT NULL THEN sOf - sFf END AS value FROM g UNION ALL SELECT 'ratio', date, CASE WHEN sF IS NOT NULL THEN sFf / NULLIF(sOf, 0) END FROM g) WHERE value IS NOT NULL", ser=SER, wide="SELECT date, MAX(value) FILTER (WHERE series_id = 'sO') AS sO, MAX(value) FILTER (WHERE series_id = 'sF') AS sF, ROW_NUMBER() OVER (ORDER BY date) AS step FROM ser WHERE series_id IN ('sO', 'sF') GROUP BY date", g=f"SELECT *, {FILL.format(c='sO')}, {FILL.format(c='sF')} FROM wide WINDOW w AS (ORDER BY step ROWS UNBOUNDED PRECEDING)"))
def win13(s, d):
    return C.derived(series(s, d), {"spread": ("sO", "sO - sF"), "ratio": ("sF", "try_divide(sF, sO)")}).withColumn("value", rounded("value"))


@add("win14_change_report", sql(f"SELECT series_id, date, {rsql('value')} AS value, {rsql('c1')} AS chg1, {rsql('c5')} AS chg5, DATE_DIFF('day', date, DATE '2002-01-31') AS age, DATE_DIFF('day', date, DATE '2002-01-31') > 45 AS stale FROM (SELECT *, value - LAG(value, 1) OVER w AS c1, value - LAG(value, 5) OVER w AS c5 FROM ser WINDOW w AS (PARTITION BY series_id ORDER BY date)) QUALIFY ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY date DESC) = 1", ser=SER))
def win14(s, d):
    out = C.change_report(series(s, d), "2002-01-31", (1, 5))
    return out.select("series_id", "date", rounded("value").alias("value"), rounded("chg1").alias("chg1"), rounded("chg5").alias("chg5"), "age", "stale")


@add("win9_exact_months", sql(f"SELECT a.series_id, a.date, {rsql('a.value / NULLIF(b.value, 0) - 1', 6)} AS mom, {rsql('a.value / NULLIF(c.value, 0) - 1', 6)} AS yoy FROM ser a LEFT JOIN ser b ON b.series_id = a.series_id AND b.date = CAST(a.date - INTERVAL 1 MONTH AS DATE) LEFT JOIN ser c ON c.series_id = a.series_id AND c.date = CAST(a.date - INTERVAL 12 MONTH AS DATE)", ser=SER))
def win9(s, d):
    return C.exact_month_changes(series(s, d)).select("series_id", "date", rounded("mom", 6).alias("mom"), rounded("yoy", 6).alias("yoy"))


@add("win10_ytd_and_nearest", sql(f"SELECT a.series_id, a.date, {rsql('a.value / NULLIF(b.value, 0) - 1', 6)} AS ytd, {rsql('a.value / NULLIF(c.value, 0) - 1', 6)} AS yoy FROM ser a LEFT JOIN ser b ON b.series_id = a.series_id AND MONTH(b.date) = 12 AND YEAR(b.date) = YEAR(a.date) - 1 LEFT JOIN ser c ON c.series_id = a.series_id AND c.date = CAST(a.date - INTERVAL 12 MONTH AS DATE)", ser=SER))
def win10(s, d):
    return C.year_to_date_growth(series(s, d)).select("series_id", "date", rounded("ytd", 6).alias("ytd"), rounded("yoy", 6).alias("yoy"))


@add("agg47_shares", sql(f"SELECT year, item, {rsql('SUM(value)')} AS value, {rsql('100 * SUM(value) / SUM(SUM(value)) OVER (PARTITION BY year)')} AS share FROM facts GROUP BY year, item"))
def agg47(s, d):
    return C.shares(facts(s, d), "year", "item", "value").withColumns({c: rounded(c) for c in ("value", "share")})


@add("agg48_selected_series", sql(f"SELECT date, {rsql('MAX(value) FILTER (WHERE series_id = chr(115) || chr(79))')} AS \"sO\", {rsql('MAX(value - 100) FILTER (WHERE series_id = chr(115) || chr(80))')} AS \"sP\" FROM ser WHERE series_id IN ('sO', 'sP') GROUP BY date", ser=SER))
def agg48(s, d):
    return C.selected(series(s, d), ["sO", "sP"], ["sP"]).select("date", rounded("sO").alias("sO"), rounded("sP").alias("sP"))


@add("agg50_splice", sql(f"SELECT t, item, {rsql('COALESCE(a.value, b.value)')} AS value, {rsql('c.value')} AS external FROM (SELECT t, item, SUM(value) AS value FROM facts WHERE ticker = 1 GROUP BY ALL) a FULL JOIN (SELECT t, item, SUM(value) AS value FROM facts WHERE ticker = 2 GROUP BY ALL) b USING (t, item) FULL JOIN (SELECT t, item, SUM(value) AS value FROM facts WHERE ticker = 3 GROUP BY ALL) c USING (t, item)"))
def agg50(s, d):
    one, two, three = (facts(s, d).where(f"ticker = {k}").groupBy("t", "item").agg(F.sum("value").alias("value")) for k in (1, 2, 3))
    return C.spliced(one, two, three, ["t", "item"]).withColumns({c: rounded(c) for c in ("value", "external")})


@add("agg49_period_tables", sql(f"SELECT item, year, {rsql('SUM(value)')} AS total, {rsql('SUM(value) FILTER (WHERE quarter <= 2)')} AS first_half FROM facts GROUP BY ALL"))
def agg49(s, d):
    return facts(s, d).groupBy("item", "year").agg(rounded(F.sum("value")).alias("total"), rounded(F.sum(F.when(F.col("quarter") <= 2, F.col("value")))).alias("first_half"))


REG = {
    "day": "SELECT exchange, 'F' AS currency, date, SUM(buy_val - sell_val) AS value FROM flows JOIN instruments ON code = symbol GROUP BY ALL",
    "stated": "SELECT exchange, currency, CAST(LAST_DAY(date) AS DATE) AS month, SUM(value) * 2 AS value FROM day WHERE MONTH(date) = 3 GROUP BY ALL",
    "summed": "SELECT exchange, currency, CAST(LAST_DAY(date) AS DATE) AS month, SUM(value) AS value FROM day GROUP BY ALL",
    "r": "SELECT CAST(LAST_DAY(date) AS DATE) AS month, AVG(rate) AS rate FROM fx WHERE currency = 'F' GROUP BY 1",
}


@add("agg14_regional_monthly", sql(f"SELECT exchange, month, {rsql('COALESCE(s.value, x.value) / NULLIF(LAST_VALUE(r.rate IGNORE NULLS) OVER (ORDER BY month ROWS UNBOUNDED PRECEDING), 0)')} AS usd FROM summed x LEFT JOIN stated s USING (exchange, month) LEFT JOIN r USING (month)", **REG))
def agg14(s, d):
    day = flows(s, d).join(instruments(s, d), F.col("code") == F.col("symbol")).groupBy("exchange", F.lit("F").alias("currency"), "date").agg(F.sum(F.col("buy_val") - F.col("sell_val")).alias("value"))
    stated = day.where("month(date) = 3").groupBy("exchange", "currency", F.last_day("date").alias("date")).agg((F.sum("value") * 2).alias("value"))
    return C.regional_monthly(day, stated, fx(s, d), ["exchange", "currency"]).select("exchange", "month", rounded("usd").alias("usd"))


@add("agg60_monthly_turnover", sql(f"SELECT month, {rsql('SUM(v) FILTER (WHERE exchange = chr(65) || chr(83) || chr(73) || chr(65)) / ANY_VALUE(rate)')} AS asia, {rsql('SUM(v) / ANY_VALUE(rate)')} AS total FROM (SELECT exchange, CAST(LAST_DAY(date) AS DATE) AS month, SUM(value) AS v FROM bars JOIN instruments USING (symbol) GROUP BY ALL) JOIN r USING (month) GROUP BY month", r=REG["r"]))
def agg60(s, d):
    monthly = bars(s, d).join(instruments(s, d), "symbol").groupBy("exchange", F.last_day("date").alias("month")).agg(F.sum("value").alias("v"))
    rate = fx(s, d).where("currency = 'F'").groupBy(F.last_day("date").alias("month")).agg(F.avg("rate").alias("rate"))
    wide = monthly.join(rate, "month").groupBy("month").agg(F.sum(F.when(F.col("exchange") == "ASIA", F.col("v"))).alias("a"), F.sum("v").alias("t"), F.max("rate").alias("rate"))
    return wide.select("month", rounded(F.col("a") / F.col("rate")).alias("asia"), rounded(F.col("t") / F.col("rate")).alias("total"))
