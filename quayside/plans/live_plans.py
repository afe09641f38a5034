"""Streaming queries: each replays the events table as a stream; the SQL says what the batch would give."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tables as T
from ..sources.files import shared_path
from ..sources.views import bars, instruments, port_events, rounded, rsql, sql
from ..streaming import live as L
from .port_plans import S as PORT_SQL

CALLS_SQL = PORT_SQL["win22_calls"]
Q, S = {}, {}


def add(name, statement=None):
    def put(run):
        Q[name], S[name] = run, statement
        return run

    return put


def events(s, d):
    return L.file_stream(s, f"{d}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def messages(s, d):
    """Events as feed messages: clicks and purchases are ticks, views quotes, the rest flows; prices in tenths."""
    kind = F.when(F.col("event_type").isin("click", "purchase"), "tick").when(F.col("event_type") == "view", "quote").otherwise("flow")
    body = F.struct(kind.alias("T"), F.col("user_id").alias("symbol"), F.col("ts"), (F.col("value") / 10).alias("price"), (F.col("event_id").cast("decimal(19,0)") * F.when(F.col("event_id") % 10 == 0, 9007199254740).otherwise(1).cast("decimal(18,0)")).alias("volume"), (F.col("value") / 10).alias("bid"), (F.col("value") / 5).alias("ask"), F.col("value").alias("net"))
    return events(s, d).select(F.to_json(body).alias("msg"))


def ticks(s, d):
    return events(s, d).where(F.col("event_type").isin("click", "purchase")).select(F.col("user_id").alias("symbol"), "ts", F.col("value").alias("price"))


@add("str1_demultiplexed", sql("SELECT user_id AS symbol, " + rsql("value", 2) + " AS price, CASE WHEN event_id % 10 <> 0 THEN event_id WHEN event_id <= 1000 THEN event_id * 9007199254740 END AS volume FROM events WHERE event_type IN ('click', 'purchase')"))
def str1(s, d):
    out = L.replay(L.demultiplexed(messages(s, d), "tick"), "append")
    return out.select("symbol", rounded("price", 2).alias("price"), "volume")


@add("str2_micro_batch_upsert", sql("SELECT user_id AS symbol, event_type, MAX(event_id) AS event_id, MAX_BY(value, event_id) AS value FROM events GROUP BY ALL"))
def str2(s, d):
    """Batches land as they come; the keyed upsert keeps the last row per key."""
    landed = L.replay(events(s, d).select(F.col("user_id").alias("symbol"), "event_type", "event_id", "value"), "append")
    return T.upsert(landed.where("false"), landed, ["symbol", "event_type"], "event_id")


@add("str3_latest_state", sql("SELECT symbol, MAX(ts) AS ts, " + rsql("MAX_BY(price, (ts, price))") + " AS price, COUNT(*) AS n FROM ticks GROUP BY symbol"))
def str3(s, d):
    out = L.replay(L.latest(ticks(s, d)), "update", ["symbol"])
    return out.select("symbol", F.col("ts").cast("timestamp_ntz").alias("ts"), rounded("price").alias("price"), "n")


@add("str4_minute_bars", sql("SELECT symbol, DATE_TRUNC('minute', ts) AS minute, " + ", ".join(f"{rsql(e)} AS {n}" for n, e in {"open": "MIN_BY(price, (ts, price))", "high": "MAX(price)", "low": "MIN(price)", "close": "MAX_BY(price, (ts, price))"}.items()) + ", COUNT(*) AS n FROM ticks GROUP BY ALL"))
def str4(s, d):
    out = L.replay(L.minute_bars(ticks(s, d), late="400 days"), "update", ["symbol", "minute"])
    return out.select("symbol", F.col("minute").cast("timestamp_ntz").alias("minute"), *[rounded(c).alias(c) for c in ("open", "high", "low", "close")], "n")


REFS = {"lastt": "SELECT symbol, MAX(ts) AS ts, MAX_BY(price, (ts, price)) AS price FROM ticks GROUP BY symbol", "refs": "SELECT symbol, AVG(price) AS ref FROM ticks GROUP BY symbol"}


def base(s, d):
    e = s.read.parquet(f"{d}/events.parquet").where(F.col("event_type").isin("click", "purchase"))
    per = e.groupBy(F.col("user_id").alias("symbol")).agg(F.max(F.when(F.col("event_id") % 2 == 0, F.col("ts"))).cast("timestamp").alias("ts"), F.max_by("value", F.when(F.col("event_id") % 2 == 0, F.struct("ts", "value"))).alias("price"), F.avg("value").alias("ref"))
    return per


@add("str5_board", sql("SELECT symbol, ts, " + rsql("price") + " AS price, " + rsql("price / NULLIF(ref, 0) - 1", 6) + " AS change FROM lastt JOIN refs USING (symbol)", **REFS))
def str5(s, d):
    fast = L.replay(L.latest(ticks(s, d)), "update", ["symbol"])
    out = L.board(base(s, d), fast)
    return out.select("symbol", F.col("ts").cast("timestamp_ntz").alias("ts"), rounded("price").alias("price"), rounded("change", 6).alias("change"))


@add("str6_venue_summary", sql("SELECT CAST(symbol % 3 AS VARCHAR) AS exchange, COUNT(*) FILTER (WHERE price > ref) AS advances, COUNT(*) FILTER (WHERE price < ref) AS declines, COUNT(*) FILTER (WHERE price / ref - 1 >= 0.07) AS at_ceiling, COUNT(*) FILTER (WHERE price / ref - 1 <= -0.07) AS at_floor, COUNT(*) AS n FROM lastt JOIN refs USING (symbol) GROUP BY ALL", **REFS))
def str6(s, d):
    fast = L.replay(L.latest(ticks(s, d)), "update", ["symbol"]).select("symbol", "price")
    refs = base(s, d).select("symbol", "ref", (F.col("symbol") % 3).cast("string").alias("exchange"))
    return L.venue_summary(fast, refs)


@add("str7_today_overlay", sql("SELECT day, n, " + rsql("v") + " AS v FROM (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n, SUM(price) AS v FROM ticks GROUP BY 1) WHERE day <= (SELECT MAX(CAST(ts AS DATE)) FROM ticks)"))
def str7(s, d):
    """Days before the last one from the table, the last one from the stream."""
    daily = F.col("ts").cast("date").alias("day")
    live = L.replay(ticks(s, d).groupBy(daily).agg(F.count("*").alias("n"), F.sum("price").alias("v")), "update", ["day"])
    stored = s.read.parquet(f"{d}/events.parquet").where(F.col("event_type").isin("click", "purchase")).groupBy(daily).agg(F.count("*").alias("n"), F.sum("value").alias("v"))
    day = stored.agg(F.max("day").alias("day")).first()["day"]
    return L.with_today(stored, live.where(F.col("day") == F.lit(day)), "day", day).withColumn("v", rounded("v"))


@add("str8_breadth_today", sql("SELECT exchange, COUNT(*) FILTER (WHERE price > close) AS advances, COUNT(*) FILTER (WHERE price <= close) AS others FROM lastt JOIN (SELECT symbol, MAX_BY(close, date) AS close FROM bars GROUP BY 1) USING (symbol) JOIN instruments USING (symbol) GROUP BY exchange", lastt=REFS["lastt"].replace("price, (ts, price)", "price * 20, (ts, price)")))
def str8(s, d):
    """Stream-static: live prices against the last stored closes, per venue."""
    fast = L.replay(L.latest(ticks(s, d)), "update", ["symbol"]).select("symbol", (F.col("price") * 20).alias("price"))
    stored = bars(s, d).groupBy("symbol").agg(F.max_by("close", "date").alias("close")).join(instruments(s, d), "symbol")
    return fast.join(stored, "symbol").groupBy("exchange").agg(F.count_if(F.col("price") > F.col("close")).alias("advances"), F.count_if(F.col("price") <= F.col("close")).alias("others"))


@add("str9_seeded_once", sql("SELECT event_id FROM events WHERE event_id % 4 <> 0"))
def str9(s, d):
    """The feed repeats every event; a restart was seeded with a quarter of them."""
    e = events(s, d).select("event_id", "ts")
    twice = e.unionByName(e)
    seen = s.read.parquet(f"{d}/events.parquet").where("event_id % 4 = 0").select("event_id")
    return L.replay(L.once(twice, "event_id", seen, "400 days"), "append").select("event_id")


#: Events of a stream's file at most, or a few more.
FILE_EVENTS = 200_000


def shuffled_replay(s, d, batches=6):
    """The port events as a stream that comes out of order: by time in `batches` steps of one or, where they are large, several files, a third of the events one step late, every tenth again in the next; and a last event of no ship, far ahead, that lets all others pass."""
    e = port_events(s, d).withColumn("ts", F.col("ts").cast("timestamp"))
    ends = e.agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"))
    share = (F.unix_micros("ts") - F.unix_micros("t0")) / (F.unix_micros("t1") - F.unix_micros("t0") + 1)
    part = F.floor(share * (batches - 1)) + F.when(F.pmod(F.hash("event_id"), F.lit(3)) == 0, 1).otherwise(0)
    again = F.when(F.col("event_id") % 10 == 0, F.array(F.col("part"), F.least(F.col("part") + 1, F.lit(batches - 1)))).otherwise(F.array("part"))
    dealt = e.join(F.broadcast(ends)).withColumn("part", part).withColumn("part", F.explode(again)).drop("t0", "t1")
    path, files = shared_path(s, "shuffled"), -(-e.count() // (batches * FILE_EVENTS)) or 1
    for k in range(batches):  # files are taken in the order of their times, those of a step together
        step = dealt.where(F.col("part") == k).drop("part")
        (step.coalesce(1) if files == 1 else step.repartition(files, "event_id")).write.mode("append").parquet(path)
    last = ends.select(F.lit(-1).cast("long").alias("event_id"), F.lit(-1).cast("long").alias("ship_key"), (F.col("t1") + F.expr("INTERVAL 1000 DAYS")).alias("ts"), F.lit("arrive").alias("section"), F.lit(0).alias("place_from"), F.lit(0).alias("place_to"), F.lit(0.0).cast("double").alias("dwt"))
    last.select(*dealt.drop("part").columns).coalesce(1).write.mode("append").parquet(path)
    return L.file_stream(s, path, files)


@add("str10_streaming_calls", CALLS_SQL)
def str10(s, d):
    """A shuffled and repeated stream of events gives the calls of the batch job."""
    out = L.replayed_calls(shuffled_replay(s, d), "8 days")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("arrival", "departure")})


#: Messages of the feed that one task writes and reads, about.
TASK_MESSAGES = 100_000
#: Messages of all types from the events: the type by the event's number, quantities and prices by its value.
KINDS = ["mi", "emi", "t", "te", "q", "b", "bc", "f", "ii", "e", "sd", "s", "hello"]


def feed(s, d):
    id_, v, ts = F.col("event_id"), F.col("value"), F.col("ts")
    code = F.element_at(F.array(*[F.lit(k) for k in KINDS]), (id_ % len(KINDS) + 1).cast("int"))
    symbol = F.when(F.col("user_id") % 7 == 0, F.concat(F.lit("VN30F"), F.col("user_id"))).otherwise(F.concat(F.lit("S"), F.col("user_id")))
    level = F.array(F.struct(v.alias("price"), id_.alias("qtty")), F.struct((v - 1).alias("price"), (id_ + 1).alias("qtty")))
    limit = F.when(id_ % 2 == 0, F.lit("18446744073686833152")).otherwise(id_.cast("string"))
    item = F.struct(symbol.alias("symbol"), v.alias("influence"), (v / 10).alias("proportion"), id_.alias("totalVolumeTraded"))
    body = F.struct(
        code.alias("T"), symbol.alias("symbol"), F.lit("G1").alias("boardId"), v.alias("matchPrice"), id_.alias("matchQtty"), v.alias("valueIndexes"), F.concat(F.lit("I"), F.col("user_id") % 3).alias("indexName"), id_.alias("totalVolumeTraded"), level.alias("bid"), level.alias("offer"),
        (F.unix_timestamp(ts) * F.when(id_ % 3 == 0, 1000).otherwise(1)).alias("time"), v.alias("close"), id_.alias("volume"), v.alias("buyTradedAmount"), limit.alias("foreignerOrderLimitQuantity"), F.array(item, item).alias("Data"), v.alias("expectedTradePrice"), F.lit("not a number").alias("expectedTradeQuantity"), v.alias("basicPrice"), F.lit("open").alias("eventId"),
    )
    # A file's few splits are too few tasks for messages that are written and read as text.
    tasks = -(-s.read.parquet(f"{d}/events.parquet").count() // TASK_MESSAGES) or 1
    return events(s, d).repartition(tasks, "event_id").select(ts.alias("ts_recv"), F.concat(F.lit("c"), F.col("user_id") % 2).alias("conn"), F.to_json(body).alias("msg"))


#: Per table, what the check sums and what it counts.
SUMS = {"market_index": ("value", "index_name"), "estimated_index": ("total_vol", "index_name"), "ticks": ("qty", "symbol"), "quotes": ("bid2_qty", "symbol"), "bars_1m": ("t", "symbol"), "foreign_flow": ("room_limit", "symbol"), "influence": ("proportion", "symbol"), "expected": ("exp_qty", "symbol"), "secdef": ("ref", "symbol"), "sessions": ("event", "event"), "raw_log": ("conn", "conn"), "events": ("conn", "conn")}
QTY = "event_id * CASE WHEN user_id % 7 = 0 THEN 1 ELSE 10 END"
FEED_ROWS = {"market_index": ("0", "value", "user_id % 3"), "estimated_index": ("1", "event_id", "user_id % 3"), "ticks": ("2, 3", QTY, "user_id"), "quotes": ("4", QTY.replace("event_id", "(event_id + 1)"), "user_id"), "bars_1m": ("5, 6", "EPOCH(DATE_TRUNC('second', ts))", "user_id"), "foreign_flow": ("7", "CASE WHEN event_id % 2 = 0 THEN -22718464 ELSE event_id END", "user_id"), "expected": ("9", "NULL", "user_id"), "secdef": ("10", "value", "user_id"), "sessions": ("11", "NULL", "1"), "events": ("12", "NULL", "user_id % 2"), "raw_log": (", ".join(map(str, range(13))), "NULL", "user_id % 2")}


@add("str1_feed_tables", " UNION ALL ".join([f"SELECT '{t}' AS feed, COUNT(*) AS n, COUNT(DISTINCT {who}) AS names, {rsql(f'CAST(SUM({what}) AS DOUBLE)', 2)} AS total FROM events WHERE event_id % 13 IN ({which})" for t, (which, what, who) in FEED_ROWS.items()] + [f"SELECT 'influence', 2 * COUNT(*), COUNT(DISTINCT user_id), {rsql('CAST(2 * SUM(value / 10) AS DOUBLE)', 2)} FROM events WHERE event_id % 13 = 8"]))
def str1_feed(s, d):
    """Twelve tables out of one replay; per table its rows, names and a sum."""
    stored = L.demultiplexer(feed(s, d))
    parts = []
    for name, (what, who) in SUMS.items():
        total = F.lit(None).cast("double") if what in ("event", "conn") else F.sum(what).cast("double")
        parts.append(L.feed_table(stored, name).agg(F.lit(name).alias("feed"), F.count("*").alias("n"), F.countDistinct(who).alias("names"), rounded(total, 2).alias("total")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
