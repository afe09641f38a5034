"""Table-maintenance queries over the driver tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tables as O
from ..sources.files import csv_with_mark, materialised, scan_csv, scan_parquet, star_publish
from ..sources.views import bars, facts, flows, port_events, rounded, rsql, sql, table

Q, S = {}, {}


def add(name, statement):
    def put(run):
        Q[name], S[name] = run, statement
        return run

    return put


@add("src1_typed_csv_scan", sql("SELECT CAST(YEAR(day) AS INT) AS year, COUNT(*) AS n, COUNT(close) AS priced, " + rsql("SUM(close)") + " AS total, CAST(MIN(day) AS DATE) AS first FROM (SELECT date AS day, close FROM bars) GROUP BY 1"))
def src1(s, d):
    """Bars as spreadsheets write them (a byte order mark, days as day/month/year), read by a schema."""
    path = csv_with_mark(s, bars(s, d).select("symbol", F.date_format("date", "dd/MM/yyyy").alias("day"), "close"))
    back = scan_csv(s, path, "symbol long, day string, close double", {"day": "dd/MM/yyyy"})
    return back.groupBy(F.year("day").alias("year")).agg(F.count("*").alias("n"), F.count("close").alias("priced"), rounded(F.sum("close")).alias("total"), F.min("day").alias("first"))


@add("src18_presented_by_year", sql("SELECT year, symbol, sessions, " + rsql("high") + " AS high, " + rsql("turnover") + " AS turnover FROM (SELECT CAST(YEAR(date) AS INT) AS year, symbol, COUNT(*) AS sessions, MAX(close) AS high, SUM(value) AS turnover FROM bars GROUP BY ALL) WHERE year >= 1997"))
def src18(s, d):
    """A yearly presentation table, stored by year; a page reads only the folders of its years."""
    per = bars(s, d).groupBy(F.year("date").alias("year"), "symbol").agg(F.count("*").alias("sessions"), rounded(F.max("close")).alias("high"), rounded(F.sum("value")).alias("turnover"))
    return materialised(s, per, "year").where("year >= 1997").select("year", "symbol", "sessions", "high", "turnover")


@add("src2_filtered_scan", sql("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_suppkey IN (1, 3, 5) AND l_shipdate >= TIMESTAMP '1996-01-01'"))
def src2(s, d):
    return scan_parquet(s, f"{d}/lineitem.parquet", "l_suppkey", [1, 3, 5], ["l_orderkey", "l_linenumber", "l_quantity"], F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))


@add("src5_upsert", sql("SELECT l_partkey AS part, l_suppkey AS supp, batch, l_orderkey AS seq, l_quantity AS qty FROM x QUALIFY ROW_NUMBER() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY batch DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC) = 1", x="SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE 0 END AS batch FROM lineitem"))
def src5(s, d):
    x = table(s, d, "lineitem").select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), (F.col("l_orderkey") % 3 == 0).cast("int").alias("batch"), F.col("l_orderkey").alias("seq"), F.col("l_quantity").alias("qty"), F.struct("l_orderkey", "l_linenumber", "l_quantity").alias("ord"))
    return O.upsert(x.where("batch = 0"), x.where("batch = 1"), ["part", "supp"], "ord").drop("ord")


@add("src6_block_replace", sql("SELECT ticker, item, t, " + rsql("value") + " AS value FROM (SELECT * FROM facts WHERE NOT (ticker % 4 = 0) UNION ALL SELECT ticker, item, year, quarter, t, value * 2 FROM facts WHERE ticker % 4 = 0 AND quarter = 1)"))
def src6(s, d):
    f = facts(s, d)
    new = f.where("ticker % 4 = 0 AND quarter = 1").withColumn("value", F.col("value") * 2)
    return O.replace_blocks(f, new, ["ticker"]).select("ticker", "item", "t", rounded("value").alias("value"))


@add("src7_prefer_live", sql(f"SELECT symbol, date, {rsql('volume')} AS volume FROM bars WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.symbol = bars.symbol AND bars.date BETWEEN lo AND hi) UNION ALL SELECT symbol, date, {rsql('volume + 1')} FROM live", live="SELECT * FROM bars WHERE symbol % 2 = 0 AND date BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'", b="SELECT symbol, MIN(date) AS lo, MAX(date) AS hi FROM live GROUP BY symbol"))
def src7(s, d):
    b = bars(s, d).select("symbol", "date", "volume")
    live = b.where("symbol % 2 = 0 AND date BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'").withColumn("volume", F.col("volume") + 1)
    return O.prefer_live_range(b, live, "symbol", "date").select("symbol", "date", rounded("volume").alias("volume"))


@add("src7_prefer_live_keys", sql(f"SELECT code, date, {rsql('CASE WHEN date >= DATE 1997 THEN total_value * 2 ELSE total_value END'.replace('DATE 1997', chr(68) + 'ATE ' + chr(39) + '1997-01-01' + chr(39)))} AS total_value FROM flows"))
def src7_keys(s, d):
    f = flows(s, d).select("code", "date", "total_value")
    live = f.where("date >= DATE '1997-01-01'").withColumn("total_value", F.col("total_value") * 2)
    return O.prefer_live(f, live, ["code", "date"]).select("code", "date", rounded("total_value").alias("total_value"))


@add("src8_article_merge", sql("SELECT user_id, MIN(event_id) AS first_seen, STRING_AGG(DISTINCT event_type, ',' ORDER BY event_type) AS tags, MIN_BY(CASE WHEN value > 50 THEN props END, CASE WHEN value > 50 AND props IS NOT NULL THEN event_id END) AS lead, COUNT(*) AS times FROM events GROUP BY user_id"))
def src8(s, d):
    e = table(s, d, "events").withColumn("props", F.when(F.col("value") > 50, F.col("props")))
    return O.merge_articles(e, "user_id", "event_id", "event_type", "props")


@add("src9_snapshot_archive", sql("SELECT user_id, MAX_BY(value, event_id) FILTER (WHERE event_type = 'view') AS seen, MAX_BY(value, event_id) FILTER (WHERE event_type = 'purchase') AS bought FROM events GROUP BY user_id"))
def src9(s, d):
    e = table(s, d, "events")
    wide = e.select("user_id", "event_id", *[F.when(F.col("event_type") == k, F.col("value")).alias(n) for k, n in (("view", "seen"), ("purchase", "bought"))])
    return O.archive(wide, ["user_id"], "event_id", ["seen", "bought"])


OLDNEW = {
    "o": "SELECT s_suppkey AS k, s_nationkey AS a, CAST(ROUND(s_acctbal) AS BIGINT) AS b FROM supplier WHERE s_suppkey % 7 <> 0",
    "n": "SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 = 0 THEN s_nationkey + 1 ELSE s_nationkey END AS a, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE CAST(ROUND(s_acctbal) AS BIGINT) END AS b FROM supplier WHERE s_suppkey % 11 <> 0",
}


def oldnew(s, d):
    k = F.col("s_suppkey")
    sup = table(s, d, "supplier").select(k.alias("k"), F.col("s_nationkey").alias("a"), F.round("s_acctbal").cast("long").alias("b"))
    new = sup.where("k % 11 <> 0").select("k", F.when(F.col("k") % 3 == 0, F.col("a") + 1).otherwise(F.col("a")).alias("a"), F.when(F.col("k") % 5 != 0, F.col("b")).alias("b"))
    return sup.where("k % 7 <> 0"), new


@add("src10_change_log", sql("SELECT k, kind, f.field AS field, f.b AS before, f.a AS after FROM (SELECT COALESCE(o.k, n.k) AS k, CASE WHEN o.k IS NULL THEN 'new' WHEN n.k IS NULL THEN 'gone' ELSE 'changed' END AS kind, UNNEST([{'field': 'a', 'b': CAST(o.a AS VARCHAR), 'a': CAST(n.a AS VARCHAR)}, {'field': 'b', 'b': CAST(o.b AS VARCHAR), 'a': CAST(n.b AS VARCHAR)}]) AS f FROM o FULL JOIN n ON o.k = n.k) WHERE kind <> 'changed' OR f.b IS DISTINCT FROM f.a", **OLDNEW))
def src10(s, d):
    return O.change_log(*oldnew(s, d), "k", ["a", "b"])


@add("src10_master", sql("SELECT COALESCE(n.k, o.k) AS k, CASE WHEN n.k IS NOT NULL THEN n.a ELSE o.a END AS a, CASE WHEN n.k IS NOT NULL THEN n.b ELSE o.b END AS b, CASE WHEN o.k IS NOT NULL THEN 1 ELSE 9 END AS first_seen, CASE WHEN n.k IS NOT NULL THEN 9 ELSE 5 END AS last_seen, n.k IS NULL AS gone FROM o FULL JOIN n ON o.k = n.k", **OLDNEW))
def src10_master(s, d):
    old, new = oldnew(s, d)
    return O.master(old.withColumns({"first_seen": F.lit(1), "last_seen": F.lit(5)}), new, "k", ["a", "b"], 9)


@add("src11_listing_upsert", sql("SELECT l_partkey AS part, CAST(MIN(l_shipdate) AS DATE) AS first_seen, CAST(DATE_TRUNC('month', MIN(l_shipdate)) AS DATE) AS month, MAX_BY(l_quantity, (l_shipdate, l_orderkey, l_linenumber)) AS qty FROM lineitem GROUP BY l_partkey"))
def src11(s, d):
    x = table(s, d, "lineitem").groupBy(F.col("l_partkey").alias("part")).agg(F.min("l_shipdate").cast("date").alias("first_seen"), F.max_by("l_quantity", F.struct("l_shipdate", "l_orderkey", "l_linenumber")).alias("qty"))
    return x.select("part", "first_seen", F.trunc("first_seen", "month").alias("month"), "qty")


@add("src12_unpivot", sql("SELECT l_orderkey, l_linenumber, metric, value FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0.05 THEN l_discount END AS discount, l_quantity AS quantity, l_tax AS tax FROM lineitem) ON discount, quantity, tax INTO NAME metric VALUE value)"))
def src12(s, d):
    x = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_discount") > 0.05, F.col("l_discount")).alias("discount"), F.col("l_quantity").alias("quantity"), F.col("l_tax").alias("tax"))
    return O.long_form(x, ["l_orderkey", "l_linenumber"], ["discount", "quantity", "tax"])


@add("src13_stat_cube", sql("SELECT ticker, item || '/v' AS series, CAST(year AS VARCHAR) || '-Q' || CAST(quarter AS VARCHAR) AS period, 'Q' AS freq, " + rsql("value") + " AS value FROM facts"))
def src13(s, d):
    """Each ticker's facts as one JSON cube (items x quarters x a single measure), and back to rows."""
    f = facts(s, d).withColumn("period", F.concat_ws("-Q", F.col("year").cast("string"), F.col("quarter").cast("string")))
    cells = f.groupBy("ticker").agg(F.array_sort(F.collect_set("item")).alias("items"), F.array_sort(F.collect_set("period")).alias("periods"), F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "item", "period"), "value"))).alias("m"))
    flat = F.flatten(F.transform("items", lambda i: F.transform("periods", lambda p: F.try_element_at("m", F.concat_ws("|", i, p)))))
    cube = F.struct(F.array(F.lit("item"), F.lit("time"), F.lit("measure")).alias("id"), F.array(F.size("items"), F.size("periods"), F.lit(1)).alias("size"), F.array(F.col("items"), F.col("periods"), F.array(F.lit("v"))).alias("labels"), flat.alias("value"))
    rows = O.cube_rows(cells.select("ticker", F.to_json(cube, {"ignoreNullFields": "false"}).alias("json")), "json", "ticker")
    return rows.withColumn("value", rounded("value"))


@add("src15_star_latest", sql("SELECT ticker, item, t, " + rsql("value") + " AS value FROM facts WHERE t = (SELECT MAX(t) FROM (SELECT t, COUNT(DISTINCT ticker) AS n FROM facts GROUP BY t) WHERE n >= 0.7 * (SELECT MAX(n) FROM (SELECT COUNT(DISTINCT ticker) AS n FROM facts GROUP BY t)))"))
def src15(s, d):
    return O.star_views(facts(s, d), "ticker", "t").select("ticker", "item", "t", rounded("value").alias("value"))


@add("src16_coverage", sql("SELECT symbol, COUNT(*) AS n_rows, COUNT(DISTINCT date) AS days, MAX(date) AS last_date, DATE_DIFF('day', MAX(date), DATE '2001-12-31') AS age, DATE_DIFF('day', MAX(date), DATE '2001-12-31') > 30 AS stale FROM bars GROUP BY symbol"))
def src16(s, d):
    return O.coverage(bars(s, d), "symbol", "date", "2001-12-31", 30)


@add("src17_patched_totals", sql(f"SELECT item, t, {rsql('SUM(CASE WHEN ticker = 3 THEN value * 1.5 ELSE value END)')} AS value FROM facts GROUP BY item, t"))
def src17(s, d):
    f = facts(s, d)
    totals = f.groupBy("item", "t").agg(F.sum("value").alias("value"))
    old = f.where("ticker = 3")
    return O.patch_totals(totals, old, old.withColumn("value", F.col("value") * 1.5), ["item", "t"], "value").withColumn("value", rounded("value"))


@add("src19_latest_exports", sql("SELECT l_suppkey, export, COUNT(*) AS n FROM (SELECT *, CAST(YEAR(l_shipdate) AS INT) AS export FROM lineitem) x WHERE export = (SELECT MAX(CAST(YEAR(l_shipdate) AS INT)) FROM lineitem y WHERE y.l_suppkey = x.l_suppkey) GROUP BY ALL"))
def src19(s, d):
    x = table(s, d, "lineitem").withColumn("export", F.year("l_shipdate"))
    return O.latest_exports(x, ["l_suppkey"], "export").groupBy("l_suppkey", "export").agg(F.count("*").alias("n"))


@add("src20_append_only", sql("SELECT ticker, item, t, " + rsql("CASE WHEN ticker % 2 = 0 AND t >= 7988 OR ticker % 5 = 0 THEN value * 3 ELSE value END") + " AS value FROM facts WHERE ticker % 2 = 0 OR ticker % 5 <> 0 OR TRUE"))
def src20(s, d):
    f = facts(s, d).select("ticker", "item", "t", "value")
    new = f.where("ticker % 2 = 0 OR ticker % 5 = 0").withColumn("value", F.col("value") * 3)
    return O.append_only(f.where("ticker % 5 <> 0"), new, ["ticker", "item", "t"], ["value"], "t", 7988).withColumn("value", rounded("value"))


@add("src21_put_day", sql("SELECT event_id, user_id, day FROM (SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events) WHERE NOT (user_id % 5 = 0) AND event_id % 100 <> 0 UNION ALL SELECT event_id, user_id % 5, CAST(ts AS DATE) FROM events WHERE event_id % 100 = 0"))
def src21(s, d):
    old = table(s, d, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("day"))
    new = old.where("event_id % 100 = 0").withColumn("user_id", F.col("user_id") % 5)
    kept = O.put_day(old.where("user_id % 5 <> 0"), new, ["user_id", "day"], "event_id")
    return kept


S["src21_put_day"] = sql("SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.user_id = o.user_id AND n.day = o.day) AND event_id NOT IN (SELECT event_id FROM n) UNION ALL SELECT * FROM n", o="SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events WHERE user_id % 5 <> 0", n="SELECT event_id, user_id % 5 AS user_id, CAST(ts AS DATE) AS day FROM events WHERE event_id % 100 = 0")


@add("src22_due_days", sql("SELECT s.symbol, c.day, k.at IS NULL AS missing FROM (SELECT DISTINCT symbol FROM bars) s, (SELECT CAST(UNNEST(GENERATE_SERIES(DATE '1996-01-01', DATE '1996-03-31', INTERVAL 1 DAY)) AS DATE) AS day) c LEFT JOIN k ON k.symbol = s.symbol AND k.day = c.day WHERE k.at IS NULL OR k.at < c.day + 2 AND DATE_DIFF('day', k.at, DATE '1996-04-10') > 30", k="SELECT symbol, date AS day, CAST(date + CAST(volume % 4 AS INT) AS DATE) AS at FROM bars"))
def src22(s, d):
    f = bars(s, d).select("symbol", F.col("date").alias("day"), F.date_add("date", (F.col("volume") % 4).cast("int")).alias("at"))
    return O.due_days(f, "symbol", "day", "at", "1996-01-01", "1996-03-31", "1996-04-10", 30)


@add("src23_calls_upsert", sql("SELECT ship_key, place_to, MAX_BY(ts + INTERVAL 7 HOUR, event_id) AS local_time, MAX(event_id) AS event_id FROM port_events WHERE ts <= (SELECT MAX(ts) FROM port_events) - INTERVAL 1 DAY GROUP BY ship_key, place_to"))
def src23(s, d):
    e = port_events(s, d).withColumn("ts", F.col("ts").cast("timestamp"))
    now = e.agg(F.max("ts").alias("m")).first()["m"]
    import datetime

    out = O.merge_calls(e, ["ship_key", "place_to"], "ts", "Asia/Ho_Chi_Minh", now - datetime.timedelta(days=3), "event_id")
    return out.withColumn("local_time", F.col("local_time").cast("timestamp_ntz"))


@add("src24_second_source", sql(f"SELECT code, date, {rsql('buy_val - sell_val')} AS net, 1 AS source FROM flows WHERE date <= DATE '1997-06-30' UNION ALL SELECT code, date, {rsql('total_value')}, 2 FROM flows WHERE date > (SELECT MAX(date) FROM flows WHERE date <= DATE '1997-06-30')"))
def src24(s, d):
    f = flows(s, d)
    first = f.where("date <= DATE '1997-06-30'").select("code", "date", rounded(F.col("buy_val") - F.col("sell_val")).alias("net"))
    return O.second_source_after(first, f.select("code", "date", rounded("total_value").alias("net")), "date")


@add("set1_union_by_name", sql("SELECT c_custkey AS k, c_name AS name, c_mktsegment AS segment, NULL AS nation FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier"))
def set1(s, d):
    c = table(s, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return c.unionByName(table(s, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")), allowMissingColumns=True)


@add("set2_new_and_gone", sql("SELECT k, 'new' AS what FROM n WHERE k NOT IN (SELECT k FROM o) UNION ALL SELECT k, 'gone' FROM o WHERE k NOT IN (SELECT k FROM n)", **OLDNEW))
def set2(s, d):
    old, new = oldnew(s, d)
    return new.join(old, "k", "left_anti").select("k", F.lit("new").alias("what")).unionByName(old.join(new, "k", "left_anti").select("k", F.lit("gone").alias("what")))


@add("set3_in_both", sql("SELECT k FROM o INTERSECT SELECT k FROM n", **OLDNEW))
def set3(s, d):
    old, new = oldnew(s, d)
    return old.select("k").intersect(new.select("k"))


@add("set4_exact_duplicates", sql("SELECT DISTINCT ship_key, section, place_from, CAST(ts AS DATE) AS day FROM port_events"))
def set4(s, d):
    return port_events(s, d).select("ship_key", "section", "place_from", F.col("ts").cast("date").alias("day")).dropDuplicates(["ship_key", "section", "place_from", "day"])


@add("src3_csv_round_trip", sql("SELECT o_orderstatus AS status, COUNT(*) AS n, " + rsql("SUM(o_totalprice)") + " AS total FROM orders GROUP BY 1"))
def src3(s, d):
    """Orders written as CSV with a byte order mark's encoding, read back by schema and written as Parquet."""
    back = star_publish(s, table(s, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"))
    return back.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"), rounded(F.sum("o_totalprice")).alias("total"))


@add("src4_event_store", sql("SELECT CAST(DATE_TRUNC('month', ts) AS DATE) AS month, section, COUNT(*) AS n FROM port_events GROUP BY ALL"))
def src4(s, d):
    from ..sources.files import event_store

    store = event_store(s, port_events(s, d).withColumn("month", F.trunc("ts", "month")), ["month", "section"])
    return store.groupBy("month", "section").agg(F.count("*").alias("n"))
