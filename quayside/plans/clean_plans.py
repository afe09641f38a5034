"""Cleaning and data-quality queries, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import clean as O
from ..sources.views import bars, facts, fx, listings, lots, port_events, rounded, rsql, sql, table, trades

Q, S = {}, {}


def add(name, statement):
    def put(run):
        Q[name], S[name] = run, statement
        return run

    return put


@add("cln1_local_numbers", sql("SELECT l_orderkey, l_linenumber, " + rsql("l_extendedprice") + " AS strict, " + rsql("l_extendedprice") + " AS loose FROM lineitem"))
def cln1(s, d):
    """Prices are spelled with points for thousands and a decimal comma, and read back both ways."""
    x = table(s, d, "lineitem")
    local = F.translate(F.format_number("l_extendedprice", 2), ",.", ".,")
    return x.select("l_orderkey", "l_linenumber", rounded(X.number(local, strict=True)).alias("strict"), rounded(X.number(local)).alias("loose"))


@add("cln2_local_dates", sql("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders"))
def cln2(s, d):
    form = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.date_format("o_orderdate", "dd-MM-yyyy"))
    return table(s, d, "orders").select("o_orderkey", X.day(form).alias("day"))


@add("cln3_text_keys", sql("SELECT doc_id, TRIM(REGEXP_REPLACE(TRANSLATE(LOWER(REGEXP_REPLACE(text, '<[^>]*>', ' ', 'g')), '" + X.MARKED + "', '" + X.PLAIN + "'), '[^a-z0-9]+', ' ', 'g')) AS key FROM documents"))
def cln3(s, d):
    return table(s, d, "documents").select("doc_id", X.key(F.col("text")).alias("key"))


@add("cln4_unit_scale", sql("SELECT symbol, date, " + rsql("CASE WHEN value / volume > 1500 THEN value / 1e6 ELSE value END") + " AS value FROM bars"))
def cln4(s, d):
    return bars(s, d).select("symbol", "date", rounded(O.unit_scale(F.col("value"), F.col("volume"), 1500)).alias("value"))


@add("cln5_repaired", sql("SELECT event_id, " + rsql("CASE WHEN dwt BETWEEN 5 AND 95 THEN dwt ELSE m END") + " AS repaired FROM port_events LEFT JOIN (SELECT ship_key, MEDIAN(dwt) AS m FROM port_events WHERE dwt BETWEEN 5 AND 95 GROUP BY 1) USING (ship_key)"))
def cln5(s, d):
    return O.repaired(port_events(s, d), "ship_key", "dwt", 5, 95).select("event_id", rounded("repaired").alias("repaired"))


@add("cln6_despiked", sql("SELECT symbol, COUNT(*) AS n, " + rsql("SUM(close)") + " AS total FROM (SELECT *, ABS(close / LAG(close) OVER w - 1) > 0.3 AND ABS(close / LEAD(close) OVER w - 1) > 0.3 AS spike FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)) WHERE spike IS NOT TRUE GROUP BY symbol"))
def cln6(s, d):
    return O.despiked(bars(s, d), "symbol", "date", "close", 0.3).groupBy("symbol").agg(F.count("*").alias("n"), rounded(F.sum("close")).alias("total"))


@add("cln7_corrected", sql("SELECT ticker, item, t, ticker % 5 = 0 AND t % 7 = 0 AND quarter <> 4 AS fixed, " + rsql("CASE WHEN ticker % 5 = 0 AND t % 7 = 0 AND quarter <> 4 THEN value / 10 ELSE value END") + " AS value FROM facts"))
def cln7(s, d):
    f = facts(s, d)
    fixes = f.where("ticker % 5 = 0 AND t % 7 = 0").select("ticker", "item", "t", F.when(F.col("quarter") == 4, F.col("value") + 1000).otherwise(F.col("value")).alias("wrong"), (F.col("value") / 10).alias("right"))
    return O.corrected(f, fixes, ["ticker", "item", "t"], "value").select("ticker", "item", "t", "fixed", rounded("value").alias("value"))


UNIT = {"e": "SELECT ticker, item, t, CASE WHEN (ticker + t) % 17 = 0 THEN value * 1000 WHEN (ticker + t) % 19 = 0 THEN value * 200 WHEN (ticker + t) % 23 = 0 THEN value * 60 ELSE value END AS value FROM facts", "r": "SELECT *, CASE WHEN LAG(t) OVER w = t - 1 AND LEAD(t) OVER w = t + 1 AND ABS(value) >= 100 THEN ABS(value) / NULLIF((ABS(LAG(value) OVER w) + ABS(LEAD(value) OVER w)) / 2, 0) END AS ratio FROM e WINDOW w AS (PARTITION BY ticker, item ORDER BY t)", "f": "SELECT *, ratio BETWEEN 500 AND 5000 OR (ratio >= 100 AND ABS(value) >= 1e8) AS fix FROM r"}


@add("cln8_unit_errors", sql("SELECT ticker, item, t, CASE WHEN fix THEN 'fixed' WHEN ratio >= 30 THEN 'review' ELSE 'ok' END AS what, " + rsql("CASE WHEN fix THEN value / 1000 ELSE value END") + " AS value_fixed FROM f", **UNIT))
def cln8(s, d):
    k = F.col("ticker") + F.col("t")
    e = facts(s, d).withColumn("value", F.when(k % 17 == 0, F.col("value") * 1000).when(k % 19 == 0, F.col("value") * 200).when(k % 23 == 0, F.col("value") * 60).otherwise(F.col("value")))
    return O.unit_errors(e, ["ticker", "item"], "t", "value", absurd=1e8).select("ticker", "item", "t", "what", rounded("value_fixed").alias("value_fixed"))


@add("cln9_holdings_volume", sql("SELECT l_orderkey, l_linenumber, " + rsql("CASE WHEN stated <= 0 OR GREATEST(stated, implied) > 1.01 * LEAST(stated, implied) THEN implied ELSE stated END") + " AS volume FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 3 = 0 THEN l_quantity * 10 ELSE l_quantity END AS stated, ABS((l_extendedprice + l_quantity) - l_extendedprice) AS implied FROM lineitem)"))
def cln9(s, d):
    x = table(s, d, "lineitem")
    stated = F.when(F.col("l_partkey") % 3 == 0, F.col("l_quantity") * 10).otherwise(F.col("l_quantity"))
    return x.select("l_orderkey", "l_linenumber", rounded(O.holdings_volume(F.col("l_extendedprice"), F.col("l_extendedprice") + F.col("l_quantity"), stated)).alias("volume"))


ROBUST = {
    "m": "SELECT district, MEDIAN(ppm2) AS m FROM listings GROUP BY 1",
    "a": "SELECT l.* FROM listings l JOIN m USING (district) WHERE ppm2 BETWEEN 0.5 * m AND 2 * m",
    "c": "SELECT district, MEDIAN(ppm2) AS c, COUNT(*) AS n FROM a GROUP BY 1",
    "e": "SELECT a.*, c, n, ABS(ppm2 - c) AS dev FROM a JOIN c USING (district)",
    "sd": "SELECT district, 1.4826 * MEDIAN(dev) AS s FROM e GROUP BY 1",
    "kept": "SELECT e.* FROM e JOIN sd USING (district) WHERE n < 4 OR s = 0 OR dev <= 3.5 * s",
}


@add("cln10_robust_filter", sql("SELECT district, COUNT(*) AS n, " + rsql("SUM(ppm2)") + " AS total FROM kept GROUP BY district", **ROBUST))
def cln10(s, d):
    return O.robust(listings(s, d), ["district"], "ppm2").groupBy("district").agg(F.count("*").alias("n"), rounded(F.sum("ppm2")).alias("total"))


@add("cln11_iqr_trim", sql("SELECT project_id, COUNT(*) AS n, " + rsql("SUM(ppm2)") + " AS total FROM k JOIN (SELECT project_id, COUNT(*) FILTER (WHERE inside) AS kept FROM k GROUP BY 1) USING (project_id) WHERE inside OR kept < 2 GROUP BY 1", q="SELECT project_id, QUANTILE_CONT(ppm2, 0.25) AS q1, QUANTILE_CONT(ppm2, 0.75) AS q3, COUNT(*) AS c FROM listings GROUP BY 1", k="SELECT l.*, c < 5 OR ppm2 BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM listings l JOIN q USING (project_id)"))
def cln11(s, d):
    return O.trimmed(listings(s, d), ["project_id"], "ppm2").groupBy("project_id").agg(F.count("*").alias("n"), rounded(F.sum("ppm2")).alias("total"))


@add("cln12_check_digits", sql("SELECT o_orderkey, n, (n // 1000000 * 7 + n // 100000 % 10 * 6 + n // 10000 % 10 * 5 + n // 1000 % 10 * 4 + n // 100 % 10 * 3 + n // 10 % 10 * 2) % 10 = n % 10 AS valid FROM (SELECT o_orderkey, 1000000 + o_orderkey * 37 % 8999999 AS n FROM orders)"))
def cln12(s, d):
    n = 1000000 + F.col("o_orderkey") * 37 % 8999999
    return table(s, d, "orders").select("o_orderkey", n.alias("n"), X.imo_valid(n).alias("valid"))


@add("cln13_quality_gate", sql("SELECT lot, line, date, " + rsql("COALESCE(NULLIF(traded, 0), 1)") + " AS weight FROM trades JOIN lots USING (lot) WHERE price BETWEEN 96 AND 104 AND CASE coupon WHEN 5 THEN 1 WHEN 6 THEN 2 ELSE 3 END <= 2 AND DATE_DIFF('day', date, CAST(issue + TO_MONTHS(months) AS DATE)) / 365.25 >= 0.1"))
def cln13(s, d):
    joined = trades(s, d).join(lots(s, d), "lot")
    rank = F.when(F.col("coupon") == 5, 1).when(F.col("coupon") == 6, 2).otherwise(3)
    left = F.datediff(F.add_months("issue", F.col("months")), "date") / 365.25
    kept = joined.where(F.col("price").between(96, 104) & (rank <= 2) & (left >= 0.1))
    return kept.select("lot", "line", "date", rounded(F.coalesce(F.nullif("traded", F.lit(0.0)), F.lit(1.0))).alias("weight"))


@add("cln14_bond_currency", sql("SELECT lot, " + rsql("CASE WHEN lot % 10 = 0 THEN amount * rate ELSE amount END") + " AS amount, CASE WHEN issuer % 4 = 0 THEN 'other' ELSE 'sector' || CAST(issuer % 4 AS VARCHAR) END AS sector FROM lots LEFT JOIN (SELECT date, AVG(rate) AS rate FROM fx WHERE currency = 'F' GROUP BY 1) f ON f.date = CAST(DATE_TRUNC('month', issue) AS DATE)"))
def cln14(s, d):
    rates = fx(s, d).where("currency = 'F'").groupBy("date").agg(F.avg("rate").alias("rate"))
    joined = lots(s, d).withColumn("date", F.trunc("issue", "month")).join(rates, "date", "left")
    sector = F.when(F.col("issuer") % 4 == 0, "other").otherwise(F.concat(F.lit("sector"), (F.col("issuer") % 4).cast("string")))
    return joined.select("lot", rounded(F.when(F.col("lot") % 10 == 0, F.col("amount") * F.col("rate")).otherwise(F.col("amount"))).alias("amount"), sector.alias("sector"))


@add("cln15_partial_session", sql("SELECT symbol, date, date = DATE '1998-06-01' AS partial FROM bars WHERE date <= DATE '1998-06-01'"))
def cln15(s, d):
    today = F.lit("1998-06-01").cast("date")
    return bars(s, d).where(F.col("date") <= today).select("symbol", "date", (F.col("date") == today).alias("partial"))


@add("cln16_whole_periods", sql("SELECT CAST(LAST_DAY(date) AS DATE) AS period, " + rsql("SUM(value)") + " AS value, CAST(LAST_DAY(date) AS DATE) = (SELECT CAST(LAST_DAY(MAX(date)) AS DATE) FROM bars) AS running FROM bars WHERE DATE_TRUNC('month', date) > (SELECT MIN(date) FROM bars) OR (SELECT DATE_TRUNC('month', MIN(date)) = MIN(date) FROM bars) GROUP BY 1"))
def cln16(s, d):
    return O.whole_periods(bars(s, d), F.last_day("date"), "date", [F.sum("value").alias("value")]).withColumn("value", rounded("value"))


@add("cln17_unit_conversion", sql("SELECT event_id, " + rsql("value * CASE event_type WHEN 'view' THEN 0.001 WHEN 'click' THEN 1.0 WHEN 'purchase' THEN 1000.0 END") + " AS converted FROM events"))
def cln17(s, d):
    units = s.createDataFrame([("view", 0.001), ("click", 1.0), ("purchase", 1000.0)], "unit string, factor double")
    return O.converted(table(s, d, "events").withColumnRenamed("event_type", "unit"), units).select("event_id", rounded("converted").alias("converted"))


@add("dq1_completeness", sql("SELECT ticker, t, items, LAG(items) OVER w AS before, COALESCE(items < 0.9 * LAG(items) OVER w, FALSE) AS incomplete FROM (SELECT ticker, t, COUNT(DISTINCT item) AS items FROM facts GROUP BY ALL) WINDOW w AS (PARTITION BY ticker ORDER BY t)"))
def dq1(s, d):
    return O.completeness(facts(s, d), ["ticker"], "t", "item")


@add("dq2_identity", sql("SELECT ticker, t, " + rsql("total") + " AS total, " + rsql("parts") + " AS parts, ABS(total - parts) <= 0.015 * ABS(total) AS balanced FROM (SELECT ticker, t, SUM(value) FILTER (WHERE item = '1-URGENT') AS total, SUM(value) FILTER (WHERE item IN ('2-HIGH', '3-MEDIUM')) AS parts FROM facts GROUP BY ALL)"))
def dq2(s, d):
    out = O.identity_gap(facts(s, d), ["ticker", "t"], "item", "value", "1-URGENT", ["2-HIGH", "3-MEDIUM"])
    return out.select("ticker", "t", rounded("total").alias("total"), rounded("parts").alias("parts"), "balanced")


@add("dq3_formula_checks", sql("SELECT formula, ticker, t, " + rsql("stated") + " AS stated, " + rsql("computed") + " AS computed, ABS(stated - computed) <= 0.005 * ABS(stated) AS matches FROM (SELECT formula, ticker, t, SUM(CASE WHEN k = 0 THEN value END) AS stated, SUM(CASE WHEN k > 0 THEN sign * value END) AS computed FROM facts JOIN terms USING (item) GROUP BY ALL)", terms="SELECT * FROM (VALUES ('o1 = o2 + o3', 0, 1, (SELECT MIN(o_orderpriority) FROM orders)), ('o1 = o2 + o3', 1, 1, (SELECT MAX(o_orderpriority) FROM orders))) v(formula, k, sign, item)"))
def dq3(s, d):
    """The formula compares the first priority with the last one, by the names that the table has."""
    f = facts(s, d)
    names = {"a": F.min("item"), "b": F.max("item")}
    ends = f.agg(*[v.alias(k) for k, v in names.items()])
    coded = f.join(F.broadcast(ends)).withColumn("item", F.when(F.col("item") == F.col("a"), "o1").when(F.col("item") == F.col("b"), "o2").otherwise("x"))
    formulas = s.createDataFrame([("o1 = o2 + o3",)], "formula string")
    out = O.formula_checks(coded, formulas, ["ticker", "t"], "item", "value")
    return out.select("formula", "ticker", "t", rounded("stated").alias("stated"), rounded("computed").alias("computed"), "matches")


@add("dq4_running_totals", sql("SELECT ticker, item, t, ABS(cum - (prev + value)) <= 0.015 * cum AS adds_up FROM (SELECT *, LAG(cum, 1, 0) OVER (PARTITION BY ticker, item, year ORDER BY quarter) AS prev FROM (SELECT *, SUM(value) OVER (PARTITION BY ticker, item, year ORDER BY quarter) * CASE WHEN t % 11 = 0 THEN 1.1 ELSE 1.0 END AS cum FROM facts))"))
def dq4(s, d):
    from pyspark.sql import Window

    w = Window.partitionBy("ticker", "item", "year").orderBy("quarter")
    f = facts(s, d).withColumn("cum", F.sum("value").over(w) * F.when(F.col("t") % 11 == 0, 1.1).otherwise(1.0))
    gap = F.abs(F.col("cum") - (F.lag("cum", 1, 0.0).over(w) + F.col("value")))
    return f.select("ticker", "item", "t", (gap <= 0.015 * F.col("cum")).alias("adds_up"))


@add("dq5_year_chain", sql("SELECT a.year, COUNT(*) AS pairs, COUNT(*) FILTER (WHERE ABS(a.prior - b.value) <= 1e-6 * GREATEST(ABS(b.value), 1)) AS matches FROM y a JOIN y b ON a.ticker = b.ticker AND a.item = b.item AND a.year = b.year + 1 GROUP BY 1", y0="SELECT ticker, item, year, SUM(value) AS value FROM facts GROUP BY ALL", y="SELECT *, LAG(value) OVER (PARTITION BY ticker, item ORDER BY year) * CASE WHEN ticker % 6 = 0 THEN 1.01 ELSE 1.0 END AS prior FROM y0"))
def dq5(s, d):
    from pyspark.sql import Window

    y = facts(s, d).groupBy("ticker", "item", "year").agg(F.sum("value").alias("value"))
    prior = F.lag("value").over(Window.partitionBy("ticker", "item").orderBy("year")) * F.when(F.col("ticker") % 6 == 0, 1.01).otherwise(1.0)
    return O.year_chain(y.withColumn("prior", prior), ["ticker", "item"], "year", "value", "prior")


@add("dq6_best_version", sql("SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem QUALIFY ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY l_discount, l_quantity DESC, l_orderkey DESC, l_linenumber DESC) = 1"))
def dq6(s, d):
    x = table(s, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_discount", "l_quantity")
    return O.best_version(x, ["l_partkey"], [-F.col("l_discount"), F.col("l_quantity"), F.col("l_orderkey"), F.col("l_linenumber")]).select("l_partkey", "l_orderkey", "l_linenumber")


@add("dq7_layouts", sql("SELECT ticker, COUNT(DISTINCT layout) AS layouts, COUNT(*) AS periods FROM (SELECT ticker, t, STRING_AGG(DISTINCT item, '|' ORDER BY item) AS layout FROM facts GROUP BY ALL) GROUP BY ticker"))
def dq7(s, d):
    return O.layouts(facts(s, d), "ticker", "t", "item")


@add("dq8_expected_samples", sql("SELECT verdict, COUNT(*) AS n FROM (SELECT CASE WHEN x.ticker IS NULL THEN 'extra' WHEN x.expected IS NULL THEN CASE WHEN g.value IS NULL THEN 'ok' ELSE 'unexpected' END WHEN g.value IS NULL THEN 'missing' WHEN ABS(g.value - x.expected) <= 0.001 * GREATEST(ABS(x.expected), 1) THEN 'ok' ELSE 'different' END AS verdict FROM (SELECT * FROM facts WHERE ticker % 3 <> 0) g FULL JOIN (SELECT ticker, item, t, CASE WHEN ticker % 5 = 0 THEN NULL WHEN ticker % 7 = 0 THEN value * 1.01 ELSE value END AS expected FROM facts WHERE quarter = 1) x ON g.ticker = x.ticker AND g.item = x.item AND g.t = x.t) GROUP BY 1"))
def dq8(s, d):
    f = facts(s, d)
    k = F.col("ticker")
    expected = f.where("quarter = 1").select("ticker", "item", "t", F.when(k % 5 == 0, None).when(k % 7 == 0, F.col("value") * 1.01).otherwise(F.col("value")).alias("expected"))
    return O.against_expected(f.where("ticker % 3 <> 0").select("ticker", "item", "t", "value"), expected, ["ticker", "item", "t"], 0.001)
