"""Join queries, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as O
from ..operators import temporal as T
from ..sources.views import bars, facts, flows, fx, instruments, listings, lots, port_events, rounded, rsql, sql, table, trades

Q, S = {}, {}


def add(name, statement):
    def put(run):
        Q[name], S[name] = run, statement
        return run

    return put


@add("jn1_star", sql("SELECT lot, line, o.issuer, n_name AS nation, c_mktsegment AS segment, " + rsql("price") + " AS price FROM trades JOIN lots o USING (lot) LEFT JOIN customer ON c_custkey = issuer LEFT JOIN nation ON n_nationkey = c_nationkey"))
def jn1(s, d):
    c, n = table(s, d, "customer"), table(s, d, "nation")
    joined = trades(s, d).join(lots(s, d), "lot").join(c, F.col("issuer") == c.c_custkey, "left").join(n, F.col("c_nationkey") == n.n_nationkey, "left")
    return joined.select("lot", "line", "issuer", F.col("n_name").alias("nation"), F.col("c_mktsegment").alias("segment"), rounded("price").alias("price"))


QEND = "SELECT symbol, date, close, q.value FROM bars b ASOF LEFT JOIN q ON b.symbol % 25 = q.ticker AND b.date >= q.known"
PUB = "SELECT ticker, CAST(LAST_DAY(MAKE_DATE(year, quarter * 3, 1)) + 30 AS DATE) AS known, SUM(value) AS value FROM facts GROUP BY ALL"


def published(s, d):
    known = F.date_add(F.last_day(F.make_date("year", F.col("quarter") * 3, F.lit(1))), 30)
    return facts(s, d).groupBy("ticker", known.alias("known")).agg(F.sum("value").alias("value"))


@add("jn2_asof_join", sql(f"SELECT symbol, date, {rsql('value')} AS value FROM ({QEND})", q=PUB))
def jn2(s, d):
    left = bars(s, d).withColumn("ticker", F.col("symbol") % 25)
    return T.asof_join(left, published(s, d).withColumn("ticker", F.col("ticker").cast("long")), "ticker", "date", "known", ["value"], piece_days=366).select("symbol", "date", rounded("value").alias("value"))


@add("jn3_asof_tolerance", sql(f"SELECT e.event_id, CASE WHEN DATE_DIFF('day', b.date, e.day) <= 10 THEN {rsql('b.close * e.dwt')} END AS worth FROM (SELECT event_id, ship_key % 10 AS symbol, CAST(ts AS DATE) + 0 AS day, dwt FROM port_events) e ASOF LEFT JOIN (SELECT symbol, CAST(date + 9500 AS DATE) AS date, close FROM bars) b ON e.symbol = b.symbol AND e.day >= b.date"))
def jn3(s, d):
    e = port_events(s, d).select("event_id", (F.col("ship_key") % 10).alias("symbol"), F.col("ts").cast("date").alias("day"), "dwt")
    b = bars(s, d).select("symbol", F.date_add("date", 9500).alias("date"), "close")
    return T.asof_join(e, b, "symbol", "day", "date", ["close"], tolerance_days=10, piece_days=92).select("event_id", rounded(F.col("close") * F.col("dwt")).alias("worth"))


@add("jn4_currency", sql("SELECT code, date, " + rsql("total_value / NULLIF(rate, 0)") + " AS usd FROM (SELECT *, CASE code % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS currency FROM flows) f ASOF LEFT JOIN fx USING (currency, date)"))
def jn4(s, d):
    f = flows(s, d).withColumn("currency", F.when(F.col("code") % 3 == 0, "F").when(F.col("code") % 3 == 1, "O").otherwise("P"))
    out = T.asof_join(f, fx(s, d).withColumnRenamed("date", "fx_date"), "currency", "date", "fx_date", ["rate"], piece_days=31)
    return out.select("code", "date", rounded(F.try_divide("total_value", "rate")).alias("usd"))


NEAR = {
    "l": "SELECT event_id, ship_key, ts FROM port_events WHERE section = 'arrive'",
    "r": "SELECT event_id AS other, ship_key, ts AS rt FROM port_events WHERE section = 'depart'",
    "p": "SELECT l.event_id, other, rt, ABS(EPOCH(rt) - EPOCH(ts)) AS gap FROM l JOIN r USING (ship_key) WHERE ABS(DATE_DIFF('second', ts, rt)) <= 172800",
}


@add("jn5_nearest", sql("SELECT l.event_id, x.other FROM l LEFT JOIN (SELECT * FROM p QUALIFY ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY gap, rt, other) = 1) x USING (event_id)", **{**NEAR, "l": NEAR["l"].replace(", ts", ", DATE_TRUNC('second', ts) AS ts"), "r": NEAR["r"].replace("ts AS rt", "DATE_TRUNC('second', ts) AS rt")}))
def jn5(s, d):
    e = port_events(s, d).withColumn("ts", F.date_trunc("second", F.col("ts").cast("timestamp")))
    left = e.where("section = 'arrive'").select("event_id", "ship_key", "ts")
    right = e.where("section = 'depart'").select(F.col("event_id").alias("other"), "ship_key", F.col("ts").alias("rt"))
    return T.nearest_join(left, right, "ship_key", "event_id", "ts", "rt", ["other"], 2.0).select("event_id", "other")


@add("jn6_entity_cascade", sql("SELECT k, COALESCE(a, b, CASE WHEN ABS(size - csize) <= 0.2 * csize THEN c END) AS reg_id, CASE WHEN a IS NOT NULL THEN 'number' WHEN b IS NOT NULL THEN 'second' WHEN ABS(size - csize) <= 0.2 * csize THEN 'name' END AS matched_by FROM x LEFT JOIN (SELECT number, MIN(reg_id) AS a FROM reg GROUP BY 1) USING (number) LEFT JOIN (SELECT second, MIN(reg_id) AS b FROM reg GROUP BY 1) USING (second) LEFT JOIN (SELECT name, MIN(reg_id) AS c, MIN(size) AS csize FROM reg GROUP BY 1 HAVING COUNT(*) = 1) USING (name)", x="SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN c_custkey END AS number, CASE WHEN c_custkey % 3 <> 2 THEN c_custkey * 7 END AS second, c_mktsegment || (c_custkey // 2) AS name, ABS(c_acctbal) + 1 AS size FROM customer", reg="SELECT c_custkey AS reg_id, CASE WHEN c_custkey % 2 = 0 THEN c_custkey END AS number, CASE WHEN c_custkey % 5 = 0 THEN c_custkey * 7 END AS second, c_mktsegment || (c_custkey // 2) AS name, ABS(c_acctbal) + 1 AS size FROM customer"))
def jn6(s, d):
    c = table(s, d, "customer")
    k, name = F.col("c_custkey"), F.concat("c_mktsegment", F.floor(F.col("c_custkey") / 2).cast("string"))
    size = (F.abs("c_acctbal") + 1).alias("size")
    x = c.select(k.alias("k"), F.when(k % 3 == 0, k).alias("number"), F.when(k % 3 != 2, k * 7).alias("second"), name.alias("name"), size)
    reg = c.select(k.alias("reg_id"), F.when(k % 2 == 0, k).alias("number"), F.when(k % 5 == 0, k * 7).alias("second"), name.alias("name"), size)
    return O.resolve_entities(x, reg, "number", "second", "name", "size").select("k", "reg_id", "matched_by")


RULES = [("(?i)BRASS$", "metal"), ("(?i)^(PROMO|ECONOMY)", "cheap"), ("(?i)STEEL|TIN", "metal2")]


@add("jn7_ordered_rules", sql("SELECT p_partkey, CASE WHEN REGEXP_MATCHES(p_type, '(?i)BRASS$') THEN 'metal' WHEN REGEXP_MATCHES(p_type, '(?i)^(PROMO|ECONOMY)') THEN 'cheap' WHEN REGEXP_MATCHES(p_type, '(?i)STEEL|TIN') THEN 'metal2' ELSE 'other' END AS label FROM part"))
def jn7(s, d):
    return table(s, d, "part").select("p_partkey", O.ordered_rules(F.col("p_type"), RULES, "other").alias("label"))


TOK = {"t": "SELECT p_partkey AS id, p_brand AS block, LIST_DISTINCT(STRING_SPLIT(LOWER(p_name || ' ' || p_type || ' s' || (p_size // 10)), ' ')) AS tokens FROM part"}


@add("jn8_token_match", sql("SELECT l_id, ARG_MAX(r_id, (score, -r_id)) AS r_id, " + rsql("MAX(score)") + " AS score FROM (SELECT l.id AS l_id, r.id AS r_id, CASE WHEN LEN(LIST_INTERSECT(l.tokens, r.tokens)) < 2 THEN LEAST(LEN(LIST_INTERSECT(l.tokens, r.tokens)) / LEN(LIST_DISTINCT(l.tokens || r.tokens)), 0.59) ELSE LEN(LIST_INTERSECT(l.tokens, r.tokens)) / LEN(LIST_DISTINCT(l.tokens || r.tokens)) END AS score FROM t l JOIN t r ON l.block = r.block WHERE l.id % 2 = 0 AND r.id % 2 = 1) WHERE score >= 0.3 GROUP BY l_id", **TOK))
def jn8(s, d):
    p = table(s, d, "part")
    words = F.lower(F.concat("p_name", F.lit(" "), "p_type", F.lit(" s"), F.floor(F.col("p_size") / 10).cast("string")))
    t = p.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("block"), F.array_distinct(F.split(words, " ")).alias("tokens"))
    return O.token_match(t.where("id % 2 = 0"), t.where("id % 2 = 1"), "block", least=0.3).withColumn("score", rounded("score"))


@add("jn9_reference_cascade", sql("SELECT prid, " + rsql("CASE WHEN own IS NOT NULL THEN own WHEN n0 >= 5 THEN m0 WHEN n1 >= 5 THEN m1 ELSE m2 END") + " AS reference, CASE WHEN own IS NOT NULL THEN 'own' WHEN n0 >= 5 THEN 'project_id' WHEN n1 >= 5 THEN 'district' ELSE 'all' END AS source FROM x JOIN (SELECT project_id, MEDIAN(own) AS m0, COUNT(own) AS n0 FROM x GROUP BY 1) USING (project_id) JOIN (SELECT district, MEDIAN(own) AS m1, COUNT(own) AS n1 FROM x GROUP BY 1) USING (district), (SELECT MEDIAN(own) AS m2 FROM x)", x="SELECT prid, project_id, district, CASE WHEN prid % 4 = 0 THEN ppm2 END AS own FROM listings"))
def jn9(s, d):
    x = listings(s, d).select("prid", "project_id", "district", F.when(F.col("prid") % 4 == 0, F.col("ppm2")).alias("own"))
    return O.reference_cascade(x, "own", [["project_id"], ["district"], []], 5).select("prid", rounded("reference").alias("reference"), "source")


@add("jn10_provenance_cascade", sql("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE CAST(o_custkey AS VARCHAR) END AS value, CASE WHEN o_orderkey % 4 = 0 THEN 'document' WHEN o_orderkey % 3 = 0 THEN 'agent' ELSE 'self' END AS source FROM orders"))
def jn10(s, d):
    k = F.col("o_orderkey")
    found = O.first_of([("document", F.when(k % 4 == 0, F.col("o_orderpriority"))), ("agent", F.when(k % 3 == 0, F.col("o_orderstatus"))), ("self", F.col("o_custkey").cast("string"))])
    return table(s, d, "orders").select("o_orderkey", found["value"].alias("value"), found["source"].alias("source"))


@add("jn11_step_values", sql("SELECT c.currency, CAST(m AS DATE) AS month, " + rsql("rate") + " AS rate FROM (SELECT DISTINCT currency, m FROM st, (SELECT LAST_DAY(CAST(UNNEST(GENERATE_SERIES(DATE '1996-01-01', DATE '1998-12-01', INTERVAL 1 MONTH)) AS DATE)) AS m)) c ASOF JOIN st ON st.currency = c.currency AND m >= st.date", st="SELECT * FROM fx WHERE MONTH(date) IN (1, 6, 9)"))
def jn11(s, d):
    steps = fx(s, d).where(F.month("date").isin(1, 6, 9))
    return O.step_values(steps, "currency", "date", "rate", "1996-01-01", "1998-12-31").withColumn("rate", rounded("rate"))


CURVE = {"cv": "SELECT date, LIST(STRUCT_PACK(x := tenor, y := y) ORDER BY tenor) AS pts FROM (SELECT date, CASE currency WHEN 'F' THEN 1.0 WHEN 'O' THEN 3.0 ELSE 5.0 END AS tenor, rate AS y FROM fx) GROUP BY date"}


def curve(s, d):
    tenor = F.when(F.col("currency") == "F", 1.0).when(F.col("currency") == "O", 3.0).otherwise(5.0)
    return fx(s, d).groupBy("date").agg(F.array_sort(F.collect_list(F.struct(tenor.alias("x"), F.col("rate").alias("y")))).alias("pts"))


@add("jn12_curve_join", sql("SELECT lot, line, " + rsql("CASE WHEN b.x IS NULL THEN a.y WHEN a.x IS NULL THEN b.y ELSE a.y + (b.y - a.y) * (t - a.x) / (b.x - a.x) END") + " AS rate FROM (SELECT *, LIST_FILTER(pts, lambda p: p.x <= t)[-1] AS a, LIST_FILTER(pts, lambda p: p.x > t)[1] AS b FROM (SELECT lot, line, 0.5 + line * 0.9 AS t, cv.pts FROM trades ASOF LEFT JOIN cv ON trades.date >= cv.date)) WHERE pts IS NOT NULL", **CURVE))
def jn12(s, d):
    one = F.lit(1)
    left = trades(s, d).select("lot", "line", "date", (0.5 + F.col("line") * 0.9).alias("tenor"))
    # Curves are one row per month: each trade's curve is that of its month or, failing that, the last one before.
    months = curve(s, d).withColumnRenamed("date", "curve_date").select(one.alias("k"), "curve_date", "pts")
    by_month = left.select(F.trunc("date", "month").alias("m")).distinct().withColumn("k", one)
    known = T.asof_join(by_month, months, "k", "m", "curve_date", ["pts"]).select("m", "pts")
    joined = left.withColumn("m", F.trunc("date", "month")).join(known, "m").where("pts IS NOT NULL")
    return joined.select("lot", "line", rounded(T.interpolated(F.col("pts"), F.col("tenor"))).alias("rate"))


#: Every sixth ticker has a copy under a new name, shifted by less than a cent; of each such copy there is one of a third name with one other value.
SERIES = "SELECT ticker, t, SUM(value) AS value FROM facts GROUP BY ALL"
NAMES = {
    "ser": SERIES,
    "alln": "SELECT ticker, t, value FROM ser UNION ALL SELECT ticker + 100, t, value + 0.004 FROM ser WHERE ticker % 6 = 0 UNION ALL SELECT ticker + 200, t, CASE WHEN t = (SELECT MAX(t) FROM ser) THEN value + 1 ELSE value END FROM ser WHERE ticker % 6 = 0 UNION ALL SELECT ticker + 300, t, value + 0.008 FROM ser WHERE ticker % 12 = 0",
    "met": "SELECT a.ticker AS e, b.ticker AS e2, COUNT(*) AS common, COUNT(*) FILTER (WHERE ABS(a.value - b.value) < 0.01) AS agree, MAX(ABS(a.value)) AS size FROM alln a JOIN alln b ON a.t = b.t AND a.ticker < b.ticker GROUP BY ALL",
    "prs": "SELECT e AS old, e2 AS new, common FROM met WHERE common >= 8 AND agree = common AND size > 0.01",
    "chain": "SELECT old AS name, MAX(new) AS nxt FROM prs GROUP BY 1",
}


@add("jn13_renamed", sql("SELECT old, new, common, COALESCE(c2.nxt, c1.nxt) AS current FROM prs JOIN chain c1 ON c1.name = prs.old LEFT JOIN chain c2 ON c2.name = c1.nxt", **NAMES))
def jn13(s, d):
    """Files of higher ticker numbers are newer here."""
    f = facts(s, d).groupBy("ticker", "t").agg(F.sum("value").alias("value"))
    sixth, last = f.where("ticker % 6 = 0"), f.agg(F.max("t").alias("last"))
    other = sixth.join(F.broadcast(last)).select((F.col("ticker") + 200).alias("ticker"), "t", F.when(F.col("t") == F.col("last"), F.col("value") + 1).otherwise(F.col("value")).alias("value"))
    copies = sixth.select((F.col("ticker") + 100).alias("ticker"), "t", (F.col("value") + 0.004).alias("value")).unionByName(f.where("ticker % 12 = 0").select((F.col("ticker") + 300).alias("ticker"), "t", (F.col("value") + 0.008).alias("value")))
    every = f.unionByName(copies).unionByName(other)
    files = every.select("ticker").distinct().withColumn("file_date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("ticker").cast("int")))
    return O.renamed(every, files, "ticker", "t", "value")


@add("jn14_overlay", sql("SELECT item, t, " + rsql("COALESCE(o.v, z.v)") + " AS value, CASE WHEN o.v IS NOT NULL THEN 'official' ELSE 'second' END AS origin FROM (SELECT item, t, SUM(value) AS v FROM facts WHERE quarter IN (2, 4) GROUP BY ALL) o FULL JOIN (SELECT item, t, 2 * SUM(value) AS v FROM facts GROUP BY ALL) z USING (item, t)"))
def jn14(s, d):
    """The official source has every second quarter, the other all."""
    f = facts(s, d)
    official = f.where("quarter IN (2, 4)").groupBy("item", "t").agg(F.sum("value").alias("value"))
    return O.overlay(official, f.groupBy("item", "t").agg((2 * F.sum("value")).alias("value")), ["item", "t"], "value").withColumn("value", rounded("value"))


@add("jn15_mean_and_deviation", sql("SELECT COALESCE(a.date, b.date) AS date, " + rsql("a.m") + " AS m, " + rsql("b.dev") + " AS dev FROM (SELECT date, AVG(close) AS m FROM bars WHERE DAYOFWEEK(date) <> 1 GROUP BY 1) a FULL JOIN (SELECT date, MAX(close) - MIN(close) AS dev FROM bars WHERE DAYOFWEEK(date) <> 5 GROUP BY 1) b ON a.date = b.date"))
def jn15(s, d):
    """One feed has no Mondays, the other no Fridays."""
    b = bars(s, d)
    m = b.where(F.dayofweek("date") != 2).groupBy("date").agg(rounded(F.avg("close")).alias("m"))
    return m.join(b.where(F.dayofweek("date") != 6).groupBy("date").agg(rounded(F.max("close") - F.min("close")).alias("dev")), "date", "full_outer")


@add("jn16_disclosures", sql("SELECT o_custkey, o_orderstatus, ARG_MIN(day, (est, day, o_orderpriority)) AS day, ARG_MIN(o_orderpriority, (est, day, o_orderpriority)) AS source, MIN(est) AS est, STRING_AGG(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS sources FROM (SELECT *, CAST(o_orderdate AS DATE) AS day, o_orderkey % 2 = 0 AS est FROM orders) GROUP BY ALL"))
def jn16(s, d):
    x = table(s, d, "orders").select("o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("day"), (F.col("o_orderkey") % 2 == 0).alias("est"), F.col("o_orderpriority").alias("source"))
    return O.merge_disclosures(x, ["o_custkey", "o_orderstatus"], "day", "est", "source")


@add("jn17_two_signals", sql("SELECT COALESCE(a.o_custkey, b.o_custkey) AS o_custkey, tags, tags IS NOT NULL AS by_first, b.o_custkey IS NOT NULL AS by_second FROM (SELECT o_custkey, STRING_AGG(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS tags FROM orders WHERE o_orderpriority LIKE '%URGENT%' OR o_orderpriority LIKE '%LOW%' GROUP BY 1) a FULL JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 200000) b ON a.o_custkey = b.o_custkey"))
def jn17(s, d):
    return O.two_signals(table(s, d, "orders"), "o_custkey", F.col("o_orderpriority").rlike("URGENT|LOW"), F.col("o_totalprice") > 200000, "o_orderpriority")


@add("jn18_to_process", sql("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) OR doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)"))
def jn18(s, d):
    done = table(s, d, "labels")
    return O.to_process(table(s, d, "documents").select("doc_id"), done.select("doc_id"), done.where("toxic = 1").select("doc_id"), "doc_id")


@add("jn19_attribute_fallback", sql("SELECT symbol, CASE WHEN sector = 'CHINA' THEN 'special' WHEN symbol % 4 = 0 THEN exchange ELSE sector END AS grp FROM instruments"))
def jn19(s, d):
    fine = F.when(F.col("symbol") % 4 != 0, F.col("sector"))
    return instruments(s, d).select("symbol", F.when(F.col("sector") == "CHINA", "special").otherwise(F.coalesce(fine, "exchange")).alias("grp"))


@add("jn20_gazetteer", sql("SELECT p_name, CASE WHEN REGEXP_MATCHES(LOWER(p_name), '^[a-f]') THEN 'north' WHEN REGEXP_MATCHES(LOWER(p_name), '[0-9]$') THEN 'port' END AS place, NOT REGEXP_MATCHES(LOWER(p_name), '^[a-f]') AND NOT REGEXP_MATCHES(LOWER(p_name), '[0-9]$') AS unmapped FROM (SELECT DISTINCT p_name FROM part)"))
def jn20(s, d):
    from ..functions.text import key

    names = table(s, d, "part").select("p_name").distinct()
    label = O.ordered_rules(key(F.col("p_name")), [("^[a-f]", "north"), ("[0-9]$", "port")], "")
    return names.select("p_name", F.nullif(label, F.lit("")).alias("place"), (label == "").alias("unmapped"))


@add("jn21_overrides", sql("SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN 'X' ELSE c_mktsegment END AS segment, CASE WHEN c_custkey % 3 = 0 THEN CASE WHEN c_custkey % 4 = 0 THEN 'n' || c_custkey END ELSE c_name END AS name, c_custkey % 4 = 0 AS manual FROM customer"))
def jn21(s, d):
    k = F.col("c_custkey")
    rows = table(s, d, "customer").select(k.alias("k"), F.col("c_mktsegment").alias("segment"), F.when(k % 3 == 0, "").otherwise(F.col("c_name")).alias("name"))
    manual = rows.where("k % 4 = 0").select("k", F.lit("X").alias("segment"), F.concat(F.lit("n"), F.col("k").cast("string")).alias("name"))
    return O.overridden(rows, manual, "k", ["segment"], ["name"]).withColumn("manual", F.coalesce("manual", F.lit(False)))


@add("jn22_canonical_names", sql("SELECT name, CASE WHEN CONTAINS(name, 'CHINA') THEN 'cn' WHEN CONTAINS(name, 'UNITED') THEN 'united' WHEN 1 - LEVENSHTEIN(name, 'MOROCO') / GREATEST(LENGTH(name), 6) >= 0.8 THEN 'ma' WHEN 1 - LEVENSHTEIN(name, 'JAPANN') / GREATEST(LENGTH(name), 6) >= 0.8 THEN 'jp' END AS canonical FROM (SELECT DISTINCT n_name AS name FROM nation)"))
def jn22(s, d):
    aliases = s.createDataFrame([("CHINA", "cn"), ("UNITED", "united"), ("MOROCO", "ma"), ("JAPANN", "jp")], "alias string, canonical string")
    return O.canonical_names(table(s, d, "nation").select(F.col("n_name").alias("name")), aliases, 0.8)
