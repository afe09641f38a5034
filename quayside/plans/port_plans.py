"""Port queries, each with its SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ports as O
from ..sources.views import bars, facts, port_events, rounded, rsql, sql

Q, S = {}, {}


def add(name, statement=None):
    def put(run):
        Q[name], S[name] = run, statement
        return run

    return put


CALLS = {
    "u": "SELECT ship_key, ts, section, place_from, place_to, MIN(event_id) AS event_id, CASE section WHEN 'arrive' THEN 1 WHEN 'shift' THEN 2 ELSE 3 END AS rank FROM port_events WHERE section <> 'pass' GROUP BY ALL",
    "m": "SELECT *, CASE WHEN LAG(section) OVER w IS NULL OR LAG(section) OVER w = 'depart' OR (section = 'arrive' AND NOT (LAG(section) OVER w = 'arrive' AND LAG(place_from) OVER w = place_from AND LAG(place_to) OVER w = place_to AND EPOCH_US(ts) - EPOCH_US(LAG(ts) OVER w) < 4 * 86400000000)) THEN 1 ELSE 0 END AS opens, LEAD(ts) OVER w IS NULL AS is_last FROM u WINDOW w AS (PARTITION BY ship_key ORDER BY ts, rank, event_id)",
    "n": "SELECT *, SUM(opens) OVER (PARTITION BY ship_key ORDER BY ts, rank, event_id ROWS UNBOUNDED PRECEDING) AS part FROM m",
    "l": "SELECT *, COALESCE(section <> 'arrive' AND EPOCH_US(ts) - EPOCH_US(MAX(CASE WHEN section = 'arrive' THEN ts END) OVER (PARTITION BY ship_key, part)) >= 46 * 86400000000, FALSE) AS late FROM n",
    "c": "SELECT ship_key, MAX(ts) FILTER (WHERE section = 'arrive') AS arrival, MAX(place_from) FILTER (WHERE section = 'arrive') AS origin, ARG_MIN(CASE WHEN section = 'arrive' THEN place_to ELSE place_from END, (ts, rank, event_id)) AS first_berth, LIST(CASE WHEN section = 'depart' THEN place_from ELSE place_to END ORDER BY ts, rank, event_id) AS touched, CAST(COUNT(*) FILTER (WHERE section = 'shift') AS INT) AS n_shifts, MAX(ts) FILTER (WHERE section = 'depart') AS departure, MAX(place_to) FILTER (WHERE section = 'depart') AS destination, CAST(GREATEST(COUNT(*) FILTER (WHERE section = 'arrive') - 1, 0) AS INT) AS n_revisions, BOOL_OR(is_last) AS is_last FROM l GROUP BY ship_key, part, late",
    # Distinct berths in the order of their first place in the list.
    "b": "SELECT *, LIST_TRANSFORM(LIST_FILTER(LIST_ZIP(every, RANGE(1, LEN(every) + 1)), lambda z: LIST_POSITION(every, z[1]) = z[2]), lambda z: z[1]) AS berth_list FROM (SELECT *, [first_berth] || touched AS every FROM c)",
}


@add("win22_calls", sql("SELECT ship_key, arrival, origin, first_berth, ARRAY_TO_STRING(berth_list, '|') AS berths, berth_list[-1] AS last_berth, n_shifts, departure, destination, ROUND((EPOCH_US(departure) - EPOCH_US(arrival)) / 3.6e9, 1) AS hours_in_port, CASE WHEN arrival IS NOT NULL AND departure IS NOT NULL THEN 'complete' WHEN departure IS NOT NULL THEN 'no_arrival' WHEN arrival IS NULL AND is_last THEN 'shift_only' ELSE 'no_departure' END AS status, n_revisions FROM b", **CALLS))
def win22(s, d):
    """Calls by windows; the tests compare them with a plain loop per ship, too."""
    return O.calls_from_events(port_events(s, d)).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("arrival", "departure")})


@add("win22_calls_by_id", sql("SELECT ship_key * 1000 + event_id % 7 AS call_id, MAX(ts) FILTER (WHERE section = 'arrive') AS arrival, MAX(ts) FILTER (WHERE section = 'depart') AS departure, STRING_AGG(CAST(place_to AS VARCHAR), '|' ORDER BY ts, event_id) AS berths FROM port_events GROUP BY 1"))
def win22_by_id(s, d):
    return O.calls_by_id(port_events(s, d).withColumn("call_id", F.col("ship_key") * 1000 + F.col("event_id") % 7), "call_id")


CTX = "SELECT ship_key, event_id FROM port_events WHERE section = 'arrive'"


@add("win23_frozen_and_tail", sql("SELECT ship_key * 1000 + event_id % 7 AS call_id, COUNT(*) AS n, MIN(ts) AS first, CASE WHEN MAX(ts) < (SELECT MAX(ts) FROM port_events) - INTERVAL 10 DAY THEN 'frozen' ELSE 'tail' END AS half FROM port_events GROUP BY 1"))
def win23(s, d):
    """Calls that ended before the cut are taken from the frozen half, the others recomputed; together they are all."""
    e = port_events(s, d).withColumn("call_id", F.col("ship_key") * 1000 + F.col("event_id") % 7)
    cut = e.agg((F.max("ts") - F.expr("INTERVAL 10 DAYS")).alias("cut"))
    per = e.groupBy("call_id").agg(F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last")).join(F.broadcast(cut))
    frozen = per.where(F.col("last") < F.col("cut")).select("call_id", "n", "first", F.lit("frozen").alias("half"))
    open_ = per.where(F.col("last") >= F.col("cut")).select("call_id")
    tail = e.join(open_, "call_id", "left_semi").groupBy("call_id").agg(F.count("*").alias("n"), F.min("ts").alias("first"), F.lit("tail").alias("half"))
    return frozen.unionByName(tail)


@add("agg31_port_days", sql("SELECT place, day, COUNT(*) FILTER (WHERE what = 'arrive') AS n_arrive, COUNT(*) FILTER (WHERE what = 'depart') AS n_depart, COUNT(*) FILTER (WHERE what = 'in') AS n_in, COUNT(*) FILTER (WHERE what = 'out') AS n_out, " + rsql("SUM(CASE WHEN what = 'arrive' THEN dwt ELSE 0 END)") + " AS dwt_in FROM (SELECT CAST(ts AS DATE) AS day, place_to AS place, 'arrive' AS what, dwt FROM port_events WHERE section = 'arrive' UNION ALL SELECT CAST(ts AS DATE), place_from, 'depart', dwt FROM port_events WHERE section = 'depart' UNION ALL SELECT CAST(ts AS DATE), place_from, 'out', dwt FROM port_events WHERE section = 'shift' UNION ALL SELECT CAST(ts AS DATE), place_to, 'in', dwt FROM port_events WHERE section = 'shift') GROUP BY ALL"))
def agg31(s, d):
    return O.port_days(port_events(s, d)).withColumn("dwt_in", rounded("dwt_in"))


@add("agg32_visits", sql("SELECT call_id, CAST(k - 1 AS INT) AS k, bs[k] AS berth FROM (SELECT *, UNNEST(GENERATE_SERIES(1, LEN(bs))) AS k FROM (SELECT ship_key * 1000 + event_id % 7 AS call_id, LIST(CAST(place_to AS VARCHAR) ORDER BY ts, event_id) AS bs FROM port_events GROUP BY 1)) WHERE bs[k] NOT IN ('0', '5')"))
def agg32(s, d):
    return O.visits(win22_by_id(s, d), ["0", "5"]).select("call_id", F.col("k").cast("int").alias("k"), "berth")


CLASS = "CASE WHEN dwt < 30 THEN 's' WHEN dwt < 70 THEN 'm' ELSE 'l' END"


@add("agg33_month_operator", sql(f"SELECT CAST(LAST_DAY(CAST(ts AS DATE)) AS DATE) AS month, CAST(ship_key % 5 AS VARCHAR) AS operator, {CLASS} AS size_class, COUNT(*) AS n, COUNT(DISTINCT ship_key) AS ships, {rsql('SUM(dwt)')} AS dwt FROM port_events GROUP BY ALL"))
def agg33(s, d):
    size = F.when(F.col("dwt") < 30, "s").when(F.col("dwt") < 70, "m").otherwise("l")
    return O.month_by_operator(port_events(s, d), (F.col("ship_key") % 5).cast("string"), size).withColumn("dwt", rounded("dwt"))


@add("agg34_vessel_profiles", sql("SELECT ship_key, SUM(c) AS calls, SUM(recent) AS calls_12m, MAX(dwt) AS largest, ARG_MAX(place_to, (c, -place_to)) AS berth, MIN(t0) AS first_seen, MAX(t1) AS last_seen FROM (SELECT ship_key, place_to, COUNT(*) AS c, COUNT(*) FILTER (WHERE CAST(ts AS DATE) > DATE '2023-01-10') AS recent, MAX(dwt) AS dwt, MIN(ts) AS t0, MAX(ts) AS t1 FROM port_events GROUP BY ALL) GROUP BY ship_key"))
def agg34(s, d):
    return O.vessel_profiles(port_events(s, d), "2024-01-10")


@add("agg35_top_and_others", sql(f"SELECT day, name, {rsql('value')} AS value, {rsql('100 * value / SUM(value) OVER (PARTITION BY day)')} AS share FROM (SELECT day, CASE WHEN ship_key IN (SELECT ship_key FROM t ORDER BY v DESC, ship_key LIMIT 5) THEN CAST(ship_key AS VARCHAR) ELSE 'other' END AS name, SUM(dwt) AS value FROM e GROUP BY ALL)", e="SELECT *, CAST(ts AS DATE) AS day FROM port_events", t="SELECT ship_key, SUM(dwt) AS v FROM e GROUP BY 1"))
def agg35(s, d):
    e = port_events(s, d).withColumn("day", F.col("ts").cast("date"))
    return O.top_and_others(e, "day", "ship_key", "dwt", 5).withColumns({c: rounded(c) for c in ("value", "share")})


@add("agg36_period_compare", sql(f"SELECT symbol, {rsql(chr(83) + 'UM(CASE WHEN date > DATE 1 AND date <= DATE 2 THEN value ELSE 0 END)')} AS now, {rsql('SUM(CASE WHEN date > DATE 0 AND date <= DATE 1 THEN value ELSE 0 END)')} AS before, {rsql('SUM(CASE WHEN date > DATE 3 AND date <= DATE 4 THEN value ELSE 0 END)')} AS year_ago FROM bars GROUP BY symbol".replace("DATE 0", "DATE '1998-05-01'").replace("DATE 1", "DATE '1998-05-31'").replace("DATE 2", "DATE '1998-06-30'").replace("DATE 3", "DATE '1997-05-31'").replace("DATE 4", "DATE '1997-06-30'")))
def agg36(s, d):
    out = O.period_compare(bars(s, d), "symbol", "date", "value", "1998-06-30", 30)
    return out.withColumns({c: rounded(c) for c in ("now", "before", "year_ago")})


@add("agg37_running_yoy", sql(f"SELECT year, {rsql('total')} AS total, {rsql('total / NULLIF(CASE WHEN year = 1998 THEN LAG(same) OVER w ELSE LAG(total) OVER w END, 0) - 1', 6)} AS yoy FROM (SELECT CAST(YEAR(date) AS INT) AS year, SUM(value) AS total, SUM(CASE WHEN DAYOFYEAR(date) <= DAYOFYEAR(DATE '1998-06-30') THEN value ELSE 0 END) AS same FROM bars WHERE date <= DATE '1998-06-30' GROUP BY 1) WINDOW w AS (ORDER BY year)"))
def agg37(s, d):
    return O.running_yoy(bars(s, d), "date", "value", "1998-06-30").select("year", rounded("total").alias("total"), rounded("yoy", 6).alias("yoy"))


STOPS = {
    "m": "SELECT *, CASE WHEN LAG(ts) OVER w IS NOT NULL AND place_to = LAG(place_to) OVER w AND EPOCH(DATE_TRUNC('second', ts)) - EPOCH(DATE_TRUNC('second', LAG(ts) OVER w)) <= 2 * 86400 THEN 0 ELSE 1 END AS n FROM port_events WINDOW w AS (PARTITION BY ship_key ORDER BY ts, event_id)",
    "g": "SELECT *, CAST(SUM(n) OVER (PARTITION BY ship_key ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop FROM m",
    "stops": "SELECT ship_key, stop, MIN(place_to) AS place, MIN(ts) AS start, MAX(ts) AS \"end\", COUNT(*) AS events FROM g GROUP BY ALL",
    "legs": "SELECT ship_key, stop, place AS from_place, LEAD(place) OVER w AS to_place, \"end\" AS left_at, LEAD(start) OVER w AS reached_at FROM stops WINDOW w AS (PARTITION BY ship_key ORDER BY stop)",
}


def stops_legs(s, d):
    return O.stops_and_legs(port_events(s, d).withColumn("ts", F.col("ts").cast("timestamp")), 2)


@add("win24_stops", sql("SELECT ship_key, stop, place, start, \"end\", events FROM stops", **STOPS))
def win24(s, d):
    return stops_legs(s, d)[0].withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@add("win24_legs", sql("SELECT ship_key, stop, from_place, to_place, left_at, reached_at FROM legs WHERE to_place IS NOT NULL", **STOPS))
def win24_legs(s, d):
    return stops_legs(s, d)[1].withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("left_at", "reached_at")})


@add("agg38_lanes", sql("SELECT CAST(LAST_DAY(CAST(left_at AS DATE)) AS DATE) AS month, from_place, to_place, COUNT(*) AS legs, COUNT(DISTINCT ship_key) AS ships FROM legs WHERE to_place IS NOT NULL GROUP BY ALL", **STOPS))
def agg38(s, d):
    return O.lanes(stops_legs(s, d)[1])


#: Ports 0 to 8 lie in three regions, the others in none.
REGION = "CASE WHEN {p} < 9 THEN CAST({p} AS INT) // 3 END"


def _see(side: str, k: int) -> str:
    see = f"{'LAG' if side == 'origin' else 'LEAD'}({{c}}, {k}) OVER w"
    rest = _see(side, k + 1) if k < 3 else "FALSE"
    p, i, g, t = (see.format(c=c) for c in ("port", "inferred", "region", "t"))
    return f"CASE WHEN {t} IS NULL THEN FALSE WHEN {p} = home THEN FALSE WHEN NOT {i} AND {g} = region THEN ABS(FLOOR((EPOCH(DATE_TRUNC('second', {t})) - EPOCH(DATE_TRUNC('second', t))) / 86400)) <= 10 ELSE {rest} END"


ORDER = "t, rank, COALESCE(port, -1), COALESCE(home, -1)"
ITINERARY = {
    **CALLS,
    "fin": "SELECT ship_key, arrival, departure, origin, destination, first_berth AS home FROM b",
    "raw": "SELECT ship_key, arrival - INTERVAL 1 MINUTE AS t, origin AS port, 1 AS rank, NULL::TIMESTAMP AS arrive, NULL::TIMESTAMP AS depart, home FROM fin WHERE origin IS NOT NULL AND arrival IS NOT NULL UNION ALL SELECT ship_key, COALESCE(arrival, departure), home, 2, arrival, departure, home FROM fin WHERE COALESCE(arrival, departure) IS NOT NULL UNION ALL SELECT ship_key, departure + INTERVAL 1 MINUTE, destination, 3, NULL, NULL, home FROM fin WHERE destination IS NOT NULL AND departure IS NOT NULL",
    "reg": f"SELECT *, rank <> 2 AS inferred, {REGION.format(p='port')} AS region FROM raw",
    "looked": f"SELECT *, inferred AND region IS NOT NULL AND CASE WHEN rank = 3 THEN {_see('to', 1)} ELSE {_see('origin', 1)} END AS gone FROM reg WINDOW w AS (PARTITION BY ship_key ORDER BY {ORDER})",
    "stay": "SELECT * FROM looked WHERE NOT COALESCE(gone, FALSE)",
    "turns": f"SELECT *, CASE WHEN LAG(port) OVER w = port THEN 0 ELSE 1 END AS fresh FROM stay WINDOW w AS (PARTITION BY ship_key ORDER BY {ORDER})",
    "runs": f"SELECT *, SUM(fresh) OVER (PARTITION BY ship_key ORDER BY {ORDER} ROWS UNBOUNDED PRECEDING) AS run FROM turns",
    "lasts": f"SELECT *, LAST_VALUE(CASE WHEN NOT inferred THEN COALESCE(depart, arrive, t) END IGNORE NULLS) OVER (PARTITION BY ship_key, run ORDER BY {ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS left_at FROM runs",
    "gapped": "SELECT *, NOT inferred AND left_at IS NOT NULL AND EPOCH(DATE_TRUNC('second', COALESCE(arrive, depart, t))) - EPOCH(DATE_TRUNC('second', left_at)) > 172800 AS gap FROM lasts",
    "numbered": f"SELECT *, CAST(SUM(CASE WHEN gap THEN 2 ELSE fresh END) OVER (PARTITION BY ship_key ORDER BY {ORDER} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS idx FROM gapped",
    "itin": "SELECT ship_key, idx, ANY_VALUE(port) AS port, COALESCE(MIN(t) FILTER (WHERE NOT inferred), MIN(t)) AS start, MIN(arrive) AS arrive, MAX(depart) AS depart, BOOL_AND(inferred) AS inferred, COUNT(*) AS \"rows\" FROM numbered GROUP BY ALL UNION ALL SELECT ship_key, idx - 1, NULL, left_at + INTERVAL 1 MINUTE, NULL, NULL, TRUE, 0 FROM numbered WHERE gap",
    "ilegs": "SELECT a.ship_key, a.idx, a.port AS from_place, b.port AS to_place, COALESCE(a.depart, a.arrive, a.start) AS left_at, COALESCE(b.arrive, b.start) AS reached_at FROM itin a JOIN itin b ON a.ship_key = b.ship_key AND b.idx = a.idx + 1",
}


def itinerary(s, d):
    region = F.when(F.col("port") < 9, F.floor(F.col("port") / 3))
    return O.itinerary(O.calls_from_events(port_events(s, d)), region)


def ntz(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@add("win24_itinerary", sql("SELECT * FROM itin", **ITINERARY))
def win24_itinerary(s, d):
    return ntz(itinerary(s, d), "start", "arrive", "depart")


@add("win24_itinerary_legs", sql(f"SELECT ship_key, idx, from_place, to_place, left_at, reached_at, {rsql('(EPOCH(DATE_TRUNC(' + chr(39) + 'second' + chr(39) + ', reached_at)) - EPOCH(DATE_TRUNC(' + chr(39) + 'second' + chr(39) + ', left_at))) / 86400')} AS days FROM ilegs", **ITINERARY))
def win24_itinerary_legs(s, d):
    return ntz(O.itinerary_legs(itinerary(s, d)).withColumn("days", rounded("days")), "left_at", "reached_at")


@add("agg38_operator_lanes", sql(f"SELECT CAST(LAST_DAY(CAST(left_at AS DATE)) AS DATE) AS month, from_place, to_place, operator, COUNT(*) AS legs, COUNT(DISTINCT ship_key) AS ships, {rsql('SUM(capacity)')} AS capacity FROM ilegs JOIN (SELECT ship_key, CAST(ship_key % 5 AS VARCHAR) AS operator, MAX(dwt) AS capacity FROM port_events GROUP BY ALL) USING (ship_key) WHERE from_place IS NOT NULL AND to_place IS NOT NULL GROUP BY ALL", **ITINERARY))
def agg38_operators(s, d):
    ships = port_events(s, d).groupBy("ship_key", (F.col("ship_key") % 5).cast("string").alias("operator")).agg(F.max("dwt").alias("capacity"))
    return O.operator_lanes(O.itinerary_legs(itinerary(s, d)), ships).withColumn("capacity", rounded("capacity"))


@add("win25_typical_route", sql("WITH_ROUTE", **STOPS))
def win25(s, d):
    return O.typical_route(stops_legs(s, d)[1], 0)


S["win25_typical_route"] = "WITH RECURSIVE " + sql("SELECT ARG_MAX(r, LENGTH(r)) AS route FROM rt", **STOPS, nx="SELECT from_place, ARG_MAX(to_place, (c, -to_place)) AS nxt FROM (SELECT from_place, to_place, COUNT(*) AS c FROM legs WHERE to_place IS NOT NULL GROUP BY ALL) GROUP BY 1", rt="SELECT 1 AS i, 0 AS p, '0' AS r, [0] AS seen UNION ALL SELECT i + 1, nxt, r || '>' || nxt, seen || [nxt] FROM rt JOIN nx ON nx.from_place = rt.p WHERE i <= 7 AND NOT LIST_CONTAINS(seen, nxt)").removeprefix("WITH ")


@add("win26_rotations", sql("SELECT ship_key, " + rsql("cycle") + " AS cycle, STRING_AGG(CAST(place AS VARCHAR), '|' ORDER BY f) AS ports FROM (SELECT s.ship_key, c.cycle, s.place, MIN(s.start) AS f FROM stops s JOIN c USING (ship_key) JOIN (SELECT ship_key, MAX(start) AS t FROM stops GROUP BY 1) l USING (ship_key) WHERE EPOCH(DATE_TRUNC('second', t)) - EPOCH(DATE_TRUNC('second', s.start)) <= cycle * 86400 GROUP BY ALL) GROUP BY ship_key, cycle", **STOPS, c="SELECT ship_key, MEDIAN(gap) AS cycle FROM (SELECT ship_key, (EPOCH(DATE_TRUNC('second', start)) - EPOCH(DATE_TRUNC('second', LAG(start) OVER (PARTITION BY ship_key, place ORDER BY start)))) / 86400 AS gap FROM stops) WHERE gap >= 1 GROUP BY 1"))
def win26(s, d):
    return O.rotations(stops_legs(s, d)[0], 1).withColumn("cycle", rounded("cycle"))


@add("agg39_weeks_to_months", sql(f"SELECT symbol, CAST(LAST_DAY(day) AS DATE) AS month, {rsql('SUM(v / 7)')} AS value FROM (SELECT symbol, CAST(we - CAST(i AS INT) AS DATE) AS day, v FROM w, GENERATE_SERIES(0, 6) g(i)) GROUP BY ALL HAVING COUNT(DISTINCT day) = DAY(LAST_DAY(ANY_VALUE(day)))", w="SELECT symbol, CAST(DATE_TRUNC('week', date) + INTERVAL 6 DAY AS DATE) AS we, SUM(value) AS v FROM bars GROUP BY ALL"))
def agg39(s, d):
    weeks = bars(s, d).groupBy("symbol", F.date_add(F.date_trunc("week", "date").cast("date"), 6).alias("we")).agg(F.sum("value").alias("v"))
    return O.weekly_to_months(weeks, "symbol", "we", "v").withColumn("value", rounded("value"))


@add("agg40_share_allocation", sql(f"SELECT t, item, {rsql('CASE WHEN MIN(w) OVER p > 0 THEN total * w / SUM(w) OVER p END')} AS part FROM (SELECT t, item, SUM(CASE WHEN quarter = 4 AND item LIKE '1-%' AND year % 3 = 0 THEN 0 ELSE value END) AS w FROM facts GROUP BY ALL) JOIN (SELECT t, SUM(value) AS total FROM facts GROUP BY t) USING (t) WINDOW p AS (PARTITION BY t)"))
def agg40(s, d):
    f = facts(s, d)
    weight = f.groupBy("t", "item").agg(F.sum(F.when((F.col("quarter") == 4) & F.col("item").startswith("1-") & (F.col("year") % 3 == 0), 0.0).otherwise(F.col("value"))).alias("weight"))
    return O.allocated(f.groupBy("t").agg(F.sum("value").alias("total")), weight, ["t"]).select("t", "item", rounded("part").alias("part"))


MON = "SELECT symbol, CAST(LAST_DAY(date) AS DATE) AS month, CAST(YEAR(date) AS INT) AS year, CAST(MONTH(date) AS INT) AS m, SUM(value) AS v, SUM(volume) AS x1, CAST(COUNT(*) AS DOUBLE) AS x2 FROM bars GROUP BY ALL"


def monthly(s, d):
    g = bars(s, d).groupBy("symbol", F.last_day("date").alias("month"), F.year("date").alias("year"), F.month("date").alias("m"))
    return g.agg(F.sum("value").alias("v"), F.sum("volume").alias("x1"), F.count("*").cast("double").alias("x2"))


STEPS = "SELECT symbol, year, m, CASE WHEN LAG(m) OVER w = m - 1 THEN GREATEST(cum - LAG(cum) OVER w, 0) WHEN m = 1 THEN GREATEST(cum, 0) END AS monthly FROM (SELECT *, SUM(v) OVER (PARTITION BY symbol, year ORDER BY m) AS cum FROM mon) WHERE symbol % 7 <> m WINDOW w AS (PARTITION BY symbol, year ORDER BY m)"


@add("win11_from_cumulative", sql(f"SELECT symbol, year, m, {rsql('monthly')} AS monthly FROM steps", mon=MON, steps=STEPS))
def win11(s, d):
    from pyspark.sql import Window

    cum = monthly(s, d).withColumn("cum", F.sum("v").over(Window.partitionBy("symbol", "year").orderBy("m"))).where("symbol % 7 <> m")
    return O.from_cumulative(cum, ["symbol"], "m", "cum").select("symbol", "year", "m", rounded("monthly").alias("monthly"))


@add("win12_year_to_date", sql(f"SELECT symbol, month, {rsql('SUM(v) OVER (PARTITION BY symbol, year ORDER BY m)')} AS ytd FROM mon", mon=MON))
def win12(s, d):
    from pyspark.sql import Window

    return monthly(s, d).select("symbol", "month", rounded(F.sum("v").over(Window.partitionBy("symbol", "year").orderBy("m"))).alias("ytd"))


@add("win21_seasonality", sql(f"SELECT symbol, m, {rsql('GREATEST(LEAST(f / AVG(f) OVER (PARTITION BY symbol), 1.35), 0.7)')} AS factor FROM (SELECT symbol, m, MEDIAN(r) AS f FROM (SELECT *, CASE WHEN COUNT(v) OVER w = 12 THEN v / NULLIF(AVG(v) OVER w, 0) END AS r FROM mon WINDOW w AS (PARTITION BY symbol ORDER BY month ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)) GROUP BY ALL)", mon=MON))
def win21(s, d):
    return O.seasonality(monthly(s, d), "symbol", "v").withColumn("factor", rounded("factor"))


@add("win27_block_allocation", sql(f"SELECT year, symbol, m, {rsql('CASE WHEN MIN(x2) OVER p > 0 THEN SUM(v) OVER p * x2 / SUM(x2) OVER p END')} AS part FROM mon WINDOW p AS (PARTITION BY symbol, year)", mon=MON))
def win27(s, d):
    mon = monthly(s, d)
    return O.allocated(mon.groupBy("symbol", "year").agg(F.sum("v").alias("total")), mon.select("symbol", "year", "m", F.col("x2").alias("weight")), ["symbol", "year"]).select("year", "symbol", "m", rounded("part").alias("part"))


def nnls(frame: str) -> str:
    s = {k: f"SUM({e}) OVER {frame}" for k, e in {"a": "x1 * x1", "b": "x1 * x2", "c": "x2 * x2", "d": "x1 * v", "e": "x2 * v"}.items()}
    return f"SELECT *, COUNT(v) OVER {frame} AS n, {', '.join(f'{e} AS s{k}' for k, e in s.items())} FROM mon"


COEF = """SELECT *, CASE WHEN sa * sc - sb * sb > 1e-9 AND (sd * sc - se * sb) / (sa * sc - sb * sb) >= 0 AND (se * sa - sd * sb) / (sa * sc - sb * sb) >= 0 THEN (sd * sc - se * sb) / (sa * sc - sb * sb) WHEN COALESCE(POW(GREATEST(sd, 0), 2) / NULLIF(sa, 0), 0) >= COALESCE(POW(GREATEST(se, 0), 2) / NULLIF(sc, 0), 0) THEN GREATEST(sd, 0) / NULLIF(sa, 0) ELSE 0 END AS b1,
CASE WHEN sa * sc - sb * sb > 1e-9 AND (sd * sc - se * sb) / (sa * sc - sb * sb) >= 0 AND (se * sa - sd * sb) / (sa * sc - sb * sb) >= 0 THEN (se * sa - sd * sb) / (sa * sc - sb * sb) WHEN COALESCE(POW(GREATEST(sd, 0), 2) / NULLIF(sa, 0), 0) >= COALESCE(POW(GREATEST(se, 0), 2) / NULLIF(sc, 0), 0) THEN 0 ELSE GREATEST(se, 0) / NULLIF(sc, 0) END AS b2 FROM """


@add("mod2_walk_forward", sql(f"SELECT symbol, month, {rsql('CASE WHEN n >= 6 THEN b1 * x1 + b2 * x2 END', 2)} AS predicted, {rsql('LAG(v) OVER (PARTITION BY symbol ORDER BY month)', 2)} AS naive FROM cf", mon=MON, su=nnls("(PARTITION BY symbol ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"), cf=COEF + "su"))
def mod2(s, d):
    return O.walk_forward(monthly(s, d), "symbol", "month", "x1", "x2", "v").select("symbol", "month", rounded("predicted", 2).alias("predicted"), rounded("naive", 2).alias("naive"))


@add("mod5_sum_of_models", sql(f"SELECT month, n, {rsql('p', 2)} AS predicted, {rsql('a', 2)} AS actual, {rsql('p / NULLIF(a, 0) - 1', 6)} AS error FROM (SELECT month, COUNT(*) AS n, SUM(v0) AS p, SUM(v) AS a FROM (SELECT *, LAG(v) OVER (PARTITION BY symbol ORDER BY month) AS v0 FROM mon) WHERE v0 IS NOT NULL GROUP BY month) WHERE n = (SELECT COUNT(DISTINCT symbol) FROM mon)", mon=MON))
def mod5(s, d):
    from pyspark.sql import Window

    p = monthly(s, d).withColumn("predicted", F.lag("v").over(Window.partitionBy("symbol").orderBy("month"))).where("predicted IS NOT NULL").withColumnRenamed("v", "actual")
    out = O.sum_of_models(p, "symbol", "month")
    return out.select("month", "n", rounded("predicted", 2).alias("predicted"), rounded("actual", 2).alias("actual"), rounded("error", 6).alias("error"))


@add("agg53_quarters", sql(f"SELECT a.symbol, a.t, {rsql('a.value')} AS value, {rsql('a.value / NULLIF(b.value, 0) - 1', 6)} AS yoy FROM qq a LEFT JOIN qq b ON a.symbol = b.symbol AND a.t = b.t + 4", mon=MON, qq="SELECT symbol, CAST(YEAR(month) * 4 + QUARTER(month) - 1 AS INT) AS t, SUM(v) AS value FROM mon GROUP BY ALL HAVING COUNT(*) = 3"))
def agg53(s, d):
    return O.quarters_of_months(monthly(s, d), "symbol", "month", "v").select("symbol", "t", rounded("value").alias("value"), rounded("yoy", 6).alias("yoy"))


@add("agg41_container_months", sql(f"SELECT symbol, year, m, src, {rsql('v')} AS v FROM (SELECT symbol, year, m, 1 AS src, v FROM mon WHERE m % 3 = 0 UNION ALL SELECT symbol, year, m, 2, v * 2 FROM mon) QUALIFY ROW_NUMBER() OVER (PARTITION BY symbol, year, m ORDER BY src) = 1", mon=MON))
def agg41(s, d):
    mon = monthly(s, d)
    both = mon.where("m % 3 = 0").select("symbol", "year", "m", F.lit(1).alias("src"), "v").unionByName(mon.select("symbol", "year", "m", F.lit(2).alias("src"), (F.col("v") * 2).alias("v")))
    return both.groupBy("symbol", "year", "m").agg(F.min("src").alias("src"), rounded(F.min_by("v", "src")).alias("v"))


@add("agg56_confirmed", sql(f"SELECT symbol, month, {rsql('CASE WHEN symbol % 3 = 0 AND m = 6 THEN v * 1.2 WHEN symbol % 3 = 0 AND m = 7 THEN v * 1.1 ELSE v END')} AS v, {rsql('CASE WHEN symbol % 3 = 0 AND m = 6 THEN v * 0.2 WHEN symbol % 3 = 0 AND m = 7 THEN v * 0.1 ELSE 0 END')} AS delta FROM mon", mon=MON))
def agg56(s, d):
    mon = monthly(s, d)
    some = mon.where("symbol % 3 = 0 AND m IN (6, 7)")
    confirmed = some.select("symbol", "month", (F.col("v") * 1.1).alias("confirmed"), F.lit(1).alias("priority")).unionByName(some.where("m = 6").select("symbol", "month", (F.col("v") * 1.2).alias("confirmed"), F.lit(2).alias("priority")))
    return O.with_confirmed(mon, confirmed, ["symbol", "month"], "v", "priority").select("symbol", "month", rounded("v").alias("v"), rounded("delta").alias("delta"))


@add("agg57_block_totals", sql(f"SELECT symbol, year, {rsql('CASE WHEN COUNT(*) FILTER (WHERE m <= 6) = 6 THEN SUM(v) FILTER (WHERE m <= 6) ELSE SUM(v) END')} AS best FROM mon GROUP BY ALL", mon=MON))
def agg57(s, d):
    mon = monthly(s, d)
    blocks = mon.groupBy("symbol", "year").agg(F.sum("v").alias("total")).select("symbol", F.make_date("year", F.lit(1), F.lit(1)).alias("first"), F.make_date("year", F.lit(6), F.lit(30)).alias("last"), "total")
    out = O.block_totals(blocks, mon.select("symbol", "month", F.col("v").alias("value")), "symbol")
    return out.select("symbol", F.year("first").alias("year"), rounded("best").alias("best"))


@add("agg58_series_table", sql(f"SELECT month, {rsql('SUM(v)')} AS flow, {rsql('AVG(x1)')} AS stock FROM mon GROUP BY month", mon=MON))
def agg58(s, d):
    return monthly(s, d).groupBy("month").agg(rounded(F.sum("v")).alias("flow"), rounded(F.avg("x1")).alias("stock"))
