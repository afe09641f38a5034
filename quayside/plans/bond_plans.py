"""Bond queries, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bonds as O
from .join_plans import CURVE, curve
from ..sources.views import SQL as VIEWS
from ..sources.views import fx, lots, rounded, rsql, sql, table, trades

Q, S = {}, {}


def add(name, statement):
    def put(run):
        Q[name], S[name] = run, statement
        return run

    return put


@add("agg19_issuers", sql(f"SELECT issuer, COUNT(*) AS lots, {rsql('SUM(amount)')} AS amount, {rsql('SUM(CASE WHEN issue + TO_MONTHS(months) > DATE 1997 THEN amount ELSE 0 END)'.replace('DATE 1997', 'DATE ' + chr(39) + '1997-06-30' + chr(39)))} AS outstanding, {rsql('SUM(CASE WHEN issue > DATE 1996 THEN amount ELSE 0 END)'.replace('DATE 1996', 'DATE ' + chr(39) + '1996-06-30' + chr(39)))} AS last_year, {rsql('SUM(coupon * amount) / SUM(amount)')} AS coupon, MIN(issue) AS first_issue, MAX(issue) AS last_issue, STRING_AGG(DISTINCT CAST(months AS VARCHAR), ',' ORDER BY CAST(months AS VARCHAR)) AS terms FROM lots GROUP BY issuer"))
def agg19(s, d):
    out = O.issuers(lots(s, d), "1997-06-30")
    return out.withColumns({c: rounded(c) for c in ("amount", "outstanding", "last_year", "coupon")})


@add("agg20_buybacks", sql(f"SELECT lot, {rsql('SUM(traded)')} AS total, COUNT(*) AS n, MAX(date) AS last_date FROM trades WHERE price < 100 GROUP BY lot"))
def agg20(s, d):
    return O.bought_back(trades(s, d).where("price < 100")).withColumn("total", rounded("total"))


@add("agg21_lot_facts", sql(f"SELECT lot, issuer, sector, COALESCE(events, 0) AS events, {rsql('GREATEST(amount - COALESCE(total, 0), 0)')} AS remaining FROM lots LEFT JOIN (SELECT c_custkey AS issuer, c_mktsegment AS sector FROM customer) USING (issuer) LEFT JOIN (SELECT user_id AS issuer, COUNT(*) AS events FROM events WHERE event_type = 'purchase' GROUP BY 1) USING (issuer) LEFT JOIN (SELECT lot, SUM(traded) AS total FROM trades WHERE price < 100 GROUP BY lot) USING (lot)"))
def agg21(s, d):
    parents = table(s, d, "customer").select(F.col("c_custkey").alias("issuer"), F.col("c_mktsegment").alias("sector"))
    events = table(s, d, "events").where("event_type = 'purchase'").select(F.col("user_id").alias("issuer"))
    out = O.lot_facts(lots(s, d), parents, events, O.bought_back(trades(s, d).where("price < 100")).select("lot", "total"))
    return out.select("lot", "issuer", "sector", "events", rounded("remaining").alias("remaining"))


@add("agg22_maturity_wall", sql(f"SELECT CAST(YEAR(d) AS INT) AS year, CAST(QUARTER(d) AS INT) AS quarter, {rsql('SUM(amount)')} AS due, COUNT(*) AS lots, {rsql('SUM(coupon * amount) / SUM(amount)')} AS coupon FROM (SELECT *, issue + TO_MONTHS(months) AS d FROM lots) GROUP BY ALL"))
def agg22(s, d):
    return O.maturity_wall(lots(s, d)).withColumns({c: rounded(c) for c in ("due", "coupon")})


BIS = {
    "fl": "SELECT t.lot, t.line, t.date, t.price, l.issuer, t.traded, k, DATE_DIFF('day', t.date, CAST(l.issue + TO_MONTHS(k * 6) AS DATE)) / 365.0::DOUBLE AS ty, l.coupon * 6 / 12 + CASE WHEN k = l.months // 6 THEN 100.0::DOUBLE ELSE 0 END AS cf FROM trades t JOIN lots l USING (lot), UNNEST(GENERATE_SERIES(1, l.months // 6)) u(k) WHERE CAST(l.issue + TO_MONTHS(k * 6) AS DATE) > t.date",
    "cfs": "SELECT lot, line, date, price, issuer, traded, LIST(ty ORDER BY k) AS ts, LIST(cf ORDER BY k) AS cs, MAX(ty) AS years FROM fl GROUP BY ALL",
}
PV = "LIST_SUM(LIST_TRANSFORM(LIST_ZIP(ts, cs), lambda z: z[2] / POW(1 + {r}, z[1])))"
REC = f"""WITH RECURSIVE {', '.join(f'{k} AS ({{{k}}})' for k in ('lots', 'trades', 'fl', 'cfs'))},
b AS (SELECT *, 0 AS i, -0.5::DOUBLE AS lo, 2.0::DOUBLE AS hi FROM cfs WHERE {PV.format(r='(-0.5)')} >= price AND {PV.format(r='2.0')} <= price
UNION ALL SELECT lot, line, date, price, issuer, traded, ts, cs, years, i + 1, CASE WHEN {PV.format(r='((lo + hi) / 2)')} > price THEN (lo + hi) / 2 ELSE lo END, CASE WHEN {PV.format(r='((lo + hi) / 2)')} > price THEN hi ELSE (lo + hi) / 2 END FROM b WHERE i < 60)"""


def recursive(tail: str) -> str:
    from ..sources.views import SQL

    parts = {"lots": SQL["lots"], "trades": SQL["trades"], **BIS}
    head = REC
    for k, v in parts.items():
        head = head.replace("{" + k + "}", v)
    return head + " " + tail


@add("mod6_yields", recursive(f"SELECT c.lot, c.line, c.date, {rsql('(lo + hi) / 2', 6)} AS ytm, {rsql('c.years', 6)} AS years FROM cfs c LEFT JOIN (SELECT * FROM b WHERE i = 60) x ON x.lot = c.lot AND x.line = c.line AND x.date = c.date AND x.price = c.price AND x.traded = c.traded"))
def mod6(s, d):
    return O.with_yields(lots(s, d), trades(s, d)).select("lot", "line", "date", rounded("ytm", 6).alias("ytm"), rounded("years", 6).alias("years"))


SPREAD = """, fx AS ({fx}), cv AS ({cv}), yl AS (SELECT c.*, (lo + hi) / 2 AS ytm FROM cfs c LEFT JOIN (SELECT * FROM b WHERE i = 60) x ON x.lot = c.lot AND x.line = c.line AND x.date = c.date AND x.price = c.price AND x.traded = c.traded),
sp AS (SELECT *, LIST_FILTER(pts, lambda p: p.x <= years)[-1] AS a, LIST_FILTER(pts, lambda p: p.x > years)[1] AS z FROM (SELECT yl.*, cv.pts FROM yl ASOF LEFT JOIN cv ON yl.date >= cv.date)),
st AS (SELECT *, CASE WHEN z.x IS NULL THEN a.y WHEN a.x IS NULL THEN z.y ELSE a.y + (z.y - a.y) * (years - a.x) / (z.x - a.x) END AS spot FROM sp)
SELECT lot, line, date, {spread} AS spread_bps, CASE WHEN lot % 4 < 2 OR lot % 3 = 0 THEN 'fair' ELSE 'high' END AS confidence, CONCAT_WS(';', CASE WHEN ytm IS NULL THEN 'unsolved' WHEN NOT (ytm * 100 BETWEEN 0 AND 40 AND price BETWEEN 50 AND 250) THEN 'outlier' END, CASE WHEN lot % 4 < 2 THEN 'first_coupon_proxy' END) AS notes FROM st"""


@add("mod6_spreads", recursive(SPREAD.format(fx=VIEWS["fx"], cv=CURVE["cv"], spread=rsql("(ytm * 100 - spot) * 100", 2))))
def mod6_spreads(s, d):
    """Spreads over the curve of JN12, with what is to be thought of each yield."""
    kind = F.when(F.col("lot") % 4 == 0, "floating").when(F.col("lot") % 4 == 1, "mixed").otherwise("fixed")
    method = F.when(F.col("lot") % 3 == 0, "other").otherwise("periodic")
    out = O.judged_yields(O.with_yields(lots(s, d), trades(s, d)), curve(s, d).withColumnRenamed("date", "curve_date"), kind, method)
    return out.select("lot", "line", "date", rounded("spread_bps", 2).alias("spread_bps"), "confidence", "notes")


def curves(s, d):
    sector = F.concat(F.lit("s"), (F.col("issuer") % 3).cast("string"))
    yields = O.with_yields(lots(s, d), trades(s, d)).withColumn("sector", sector)
    return O.sector_curves(yields, "1998-06-30", {"now": 0, "3m": 91, "1y": 365})


CURVES = f"""y AS (SELECT lot, line, date, price, traded, years, 's' || CAST(issuer % 3 AS VARCHAR) AS sector, (lo + hi) / 2 AS ytm FROM b WHERE i = 60),
e AS (SELECT * FROM (VALUES ('now', DATE '1998-06-30'), ('3m', DATE '1998-03-31'), ('1y', DATE '1997-06-30')) v(look_back, ed)),
lastt AS (SELECT * FROM y JOIN e ON date <= ed AND date > ed - 90 QUALIFY ROW_NUMBER() OVER (PARTITION BY look_back, lot ORDER BY date DESC, line DESC, price DESC, traded DESC) = 1),
bk AS (SELECT *, CASE WHEN years < 1 THEN '<1' WHEN years < 2 THEN '1-2' WHEN years < 3 THEN '2-3' WHEN years < 5 THEN '3-5' ELSE '5+' END AS bucket FROM lastt),
q AS (SELECT look_back, sector, bucket, QUANTILE_CONT(ytm, 0.25) AS q1, QUANTILE_CONT(ytm, 0.75) AS q3, COUNT(*) AS c FROM bk GROUP BY ALL),
k AS (SELECT bk.*, c < 5 OR ytm BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM bk JOIN q USING (look_back, sector, bucket)),
n AS (SELECT look_back, sector, bucket, COUNT(*) FILTER (WHERE inside) AS kept FROM k GROUP BY ALL),
cu AS (SELECT look_back, sector, bucket, COUNT(*) AS bonds, SUM(ytm * traded) / SUM(traded) AS ytm, SUM(years * traded) / SUM(traded) AS years FROM k JOIN n USING (look_back, sector, bucket) WHERE inside OR kept < 2 GROUP BY ALL HAVING COUNT(*) >= 3)"""


@add("agg23_sector_curves", recursive(f", {CURVES} SELECT look_back, sector, bucket, bonds, {rsql('ytm', 6)} AS ytm, {rsql('years')} AS years FROM cu"))
def agg23(s, d):
    return curves(s, d).select("look_back", "sector", "bucket", "bonds", rounded("ytm", 6).alias("ytm"), rounded("years").alias("years"))


@add("agg23_standard_tenors", recursive(f", {CURVES}, p AS (SELECT look_back, sector, LIST(STRUCT_PACK(x := LN(years), y := ytm) ORDER BY years) AS pts FROM cu GROUP BY ALL), g AS (SELECT look_back, sector, tenor, LIST_FILTER(pts, lambda z: z.x <= LN(tenor))[-1] AS lo_, LIST_FILTER(pts, lambda z: z.x > LN(tenor))[1] AS hi_ FROM p, (SELECT UNNEST([1.0, 2.0, 3.0, 5.0])::DOUBLE AS tenor)) SELECT look_back, sector, tenor, {rsql('CASE WHEN lo_.x IS NULL THEN hi_.y WHEN hi_.x IS NULL THEN lo_.y ELSE lo_.y + (hi_.y - lo_.y) * (LN(tenor) - lo_.x) / (hi_.x - lo_.x) END', 6)} AS ytm FROM g"))
def agg23_tenors(s, d):
    return O.standard_tenors(curves(s, d), [1.0, 2.0, 3.0, 5.0]).withColumn("ytm", rounded("ytm", 6))


@add("agg24_curve_snapshot", sql(f"SELECT currency, {rsql('MAX_BY(rate, date) FILTER (WHERE date <= DATE 1)'.replace('DATE 1', 'DATE ' + chr(39) + '1998-06-30' + chr(39)))} AS now, {rsql('MAX_BY(rate, date) FILTER (WHERE date <= DATE 1)'.replace('DATE 1', 'DATE ' + chr(39) + '1997-06-30' + chr(39)))} AS year_ago FROM fx GROUP BY currency"))
def agg24(s, d):
    out = O.curve_snapshot(fx(s, d), "1998-06-30", {"now": 0, "year_ago": 365})
    return out.select("currency", rounded("now").alias("now"), rounded("year_ago").alias("year_ago"))
