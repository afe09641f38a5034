"""Live board: transformations that run alike on streams and on batches, and their runner.

Messages carry a type code `T`; ticks are (symbol, ts, price). State is bounded by watermarks or by one row per key.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.ports import CALL_COLUMNS, CALL_SCHEMA, MOST_DAYS, SECTIONS, Pairing
from ..sources.files import shared_path

#: Types of messages and the fields that each has.
MESSAGES = {
    "tick": "symbol long, ts timestamp, price double, volume long",
    "quote": "symbol long, ts timestamp, bid double, ask double",
    "flow": "symbol long, ts timestamp, net double",
}
LARGEST = 9_007_199_254_740_992


def file_stream(spark: SparkSession, path: str, files_per_batch: int = 4) -> DataFrame:
    """A Parquet folder or file as a stream, a few files per micro-batch."""
    schema = spark.read.parquet(path).schema
    path = f"{path[:-1]}[{path[-1]}]"  # as a pattern a single file will do, too
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def replay(stream: DataFrame, mode: str, keys: list[str] | None = None) -> DataFrame:
    """Run a stream over what is there now; with keys, the last row that any batch gave for a key.

    Each batch is written under its own number, so a batch that is run again after a failure replaces itself.
    """
    spark = stream.sparkSession
    table, progress = shared_path(spark, "live"), shared_path(spark, "progress")
    spark.createDataFrame([], stream.schema).write.parquet(f"{table}/batch=-1")

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={number}")

    query = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", progress).foreachBatch(put).start()
    query.awaitTermination()
    out = spark.read.parquet(table)
    columns = [c for c in out.columns if c != "batch"]
    if not keys:
        return out.select(*columns)
    return out.groupBy(*keys).agg(F.max_by(F.struct(*columns), "batch").alias("r")).select("r.*")


def demultiplexed(messages: DataFrame, kind: str) -> DataFrame:
    """The messages of one type with typed fields; prices come in tenths; volumes beyond 53 bits become null."""
    # Volumes are read as text: a number beyond 64 bits must not cost the message its other fields.
    fields = MESSAGES[kind].replace("volume long", "volume string")
    read = messages.where(F.get_json_object("msg", "$.T") == kind).select(F.from_json("msg", fields).alias("m")).select("m.*")
    scaled = {c: F.col(c) * 10 for c in ("price", "bid", "ask") if c in read.columns}
    volume = F.col("volume").try_cast("long")
    guarded = {"volume": F.when(volume.between(-LARGEST, LARGEST), volume)} if "volume" in read.columns else {}
    return read.withColumns(scaled | guarded)


def latest(ticks: DataFrame) -> DataFrame:
    """Latest price per symbol; one row of state per symbol."""
    return ticks.groupBy("symbol").agg(F.max("ts").alias("ts"), F.max_by("price", F.struct("ts", "price")).alias("price"), F.count("*").alias("n"))


def minute_bars(ticks: DataFrame, width: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Open, high, low, close and count per symbol and minute; late ticks change their bar until the watermark passes."""
    w = F.window("ts", width)
    at = F.struct("ts", "price")
    bars = ticks.withWatermark("ts", late).groupBy("symbol", w.alias("w")).agg(F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.count("*").alias("n"))
    return bars.select("symbol", F.col("w.start").alias("minute"), "open", "high", "low", "close", "n")


def board(base: DataFrame, fast: DataFrame) -> DataFrame:
    """The slow snapshot (symbol, ts, price, ref) with fast prices where they are newer, and the change against ref."""
    f = fast.select("symbol", F.col("ts").alias("fts"), F.col("price").alias("fprice"))
    joined = base.join(f, "symbol", "full_outer")
    newer = F.col("fts").isNotNull() & (F.col("ts").isNull() | (F.col("fts") > F.col("ts")))
    price = F.when(newer, F.col("fprice")).otherwise(F.col("price"))
    return joined.select("symbol", F.when(newer, F.col("fts")).otherwise(F.col("ts")).alias("ts"), price.alias("price"), (F.try_divide(price, "ref") - 1).alias("change"))


def venue_summary(states: DataFrame, refs: DataFrame, ceiling: float = 0.07) -> DataFrame:
    """Advances, declines, names at the ceiling and the floor per venue, against reference prices."""
    move = F.col("price") / F.col("ref") - 1
    joined = states.join(refs, "symbol")
    return joined.groupBy("exchange").agg(F.count_if(move > 0).alias("advances"), F.count_if(move < 0).alias("declines"), F.count_if(move >= ceiling).alias("at_ceiling"), F.count_if(move <= -ceiling).alias("at_floor"), F.count("*").alias("n"))


def with_today(history: DataFrame, today: DataFrame, date: str, day) -> DataFrame:
    """History before today, and today's computed rows."""
    return history.where(F.col(date) < F.lit(day).cast("date")).unionByName(today)


def once(events: DataFrame, key: str, seen: DataFrame | None = None, late: str = "30 days") -> DataFrame:
    """Events whose key didn't occur within the watermark, nor in what a restart was seeded with."""
    fresh = events if seen is None else events.join(seen.select(key).distinct(), key, "left_anti")
    return fresh.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


#: The feed's message types and fields. Table, type codes, then `column type field`; a lot is ten shares.
FEED = {
    "market_index": ("mi", "index_name string indexName, value double valueIndexes, prior double priorValueIndexes, high double highestValueIndexes, low double lowestValueIndexes, change double changedValue, change_pct double changedRatio, advances int fluctuationUpIssueCount, declines int fluctuationDownIssueCount, unchanged int fluctuationSteadinessIssueCount, ceiling int fluctuationUpperLimitIssueCount, floor int fluctuationLowerLimitIssueCount, up_vol long fluctuationUpIssueVolume, down_vol long fluctuationDownIssueVolume, flat_vol long fluctuationSteadinessIssueVolume, matched_val double contauctAccTrdVal, matched_vol long contauctAccTrdVol, block_val double blkTrdAccTrdVal, block_vol long blkTrdAccTrdVol, total_val double grossTradeAmount, total_vol long totalVolumeTraded, session_id string tradingSessionId, time string transactTime"),
    "estimated_index": ("emi", "index_name string indexName, value double valueIndexes, change double changedValue, change_pct double changedRatio, advances int fluctuationUpIssueCount, declines int fluctuationDownIssueCount, unchanged int fluctuationSteadinessIssueCount, total_val double grossTradeAmount, total_vol long totalVolumeTraded, time string time"),
    "ticks": ("t te", "symbol string symbol, board string boardId, price double matchPrice, qty lots matchQtty, side string side, avg_price double avgPrice, total_vol lots totalVolumeTraded, total_val double grossTradeAmount, high double highestPrice, low double lowestPrice, open double openPrice, session_id string tradingSessionId, time string time"),
    "quotes": ("q", "symbol string symbol, board string boardId, bid1 double bid.0.price, bid1_qty lots bid.0.qtty, bid2 double bid.1.price, bid2_qty lots bid.1.qtty, bid3 double bid.2.price, bid3_qty lots bid.2.qtty, ask1 double offer.0.price, ask1_qty lots offer.0.qtty, ask2 double offer.1.price, ask2_qty lots offer.1.qtty, ask3 double offer.2.price, ask3_qty lots offer.2.qtty, total_bid lots totalBidQtty, total_ask lots totalOfferQtty, time string time"),
    "bars_1m": ("b bc", "symbol string symbol, t seconds time, open double open, high double high, low double low, close double close, volume long volume, last_updated long lastUpdated"),
    "foreign_flow": ("f", "symbol string symbol, board string boardId, buy_vol long buyVolume, buy_val double buyTradedAmount, sell_vol long sellVolume, sell_val double sellTradedAmount, total_buy_vol long totalBuyVolume, total_buy_val double totalBuyTradedAmount, total_sell_vol long totalSellVolume, total_sell_val double totalSellTradedAmount, room_limit long foreignerOrderLimitQuantity, room_left long foreignerBuyPossibleQuantity, time string transactTime"),
    "influence": ("ii", "index_name string indexName, symbol string Data.symbol, influence double Data.influence, influence_pct double Data.influenceRatio, proportion double Data.proportion, change_pct double Data.changeRatio, change double Data.changeValue, price double Data.price, total_val double Data.grossTradeAmount, total_vol double Data.totalVolumeTraded, time string Data.time"),
    "expected": ("e", "symbol string symbol, board string boardId, close_price double closePrice, exp_price double expectedTradePrice, exp_qty long expectedTradeQuantity, time string time"),
    "secdef": ("sd", "symbol string symbol, board string boardId, market string marketId, ref double basicPrice, ceiling double ceilingPrice, floor double floorPrice, status string securityStatus, time string time"),
    "sessions": ("s", "market string marketId, board string boardId, event string eventId, session_id string tradingSessionId, prod_grp string tscProdGrpId, time string time"),
}
FUTURES = "VN30F"
#: Rows of these tables replace older ones of their keys.
FEED_KEYS = {"bars_1m": ["symbol", "t"], "influence": ["index_name", "symbol"], "secdef": ["symbol", "board"]}


def whole_number(text: Column) -> Column:
    """A number's whole part as a long; unsigned numbers of 64 bits that wrapped around are turned back, others beyond 64 bits are null."""
    exact = text.try_cast("decimal(38,4)")
    whole = F.when(exact >= 0, F.floor(exact)).otherwise(F.ceil(exact)).cast("decimal(38,0)")
    top = F.lit(9223372036854775807).cast("decimal(38,0)")
    turned = F.when(whole > top, whole - F.lit("18446744073709551616").cast("decimal(38,0)")).otherwise(whole)
    return turned.try_cast("long")


def typed(row: Column, symbol: Column, kind: str, field: str) -> Column:
    """One field of a message, whose values are all text, in its type."""
    text = row
    for part in field.split("."):
        text = F.get(text, int(part)) if part.isdigit() else text[part]
    if kind in ("long", "int"):
        number = whole_number(text)
        return number if kind == "long" else number.try_cast("int")
    if kind == "lots":
        return F.when(symbol.startswith(FUTURES), whole_number(text)).otherwise(F.try_multiply(whole_number(text), F.lit(10)))
    if kind == "seconds":
        number = whole_number(text)
        return F.when(number > 10**12, F.floor(number / 1000)).otherwise(number)
    return text.try_cast(kind)


def message_schema(fields: str) -> str:
    """The schema of a message with all values as text."""
    plain, nested, listed = [], [], []
    for name in dict.fromkeys(f.split()[2] for f in fields.split(", ")):
        first, _, rest = name.partition(".")
        if not rest:
            plain.append(first)
        elif rest[0].isdigit():
            listed.append(first)
        else:
            nested.append(rest)
    each = [f"`{n}` string" for n in plain] + [f"`{n}` array<struct<price:string,qtty:string>>" for n in dict.fromkeys(listed)]
    return ", ".join(each + ([f"Data array<struct<{','.join(f'{n}:string' for n in nested)}>>"] if nested else []))


def parsed(messages: DataFrame) -> DataFrame:
    """`ts_recv, conn, msg, table` and one struct per table, null in rows of other tables; what has no known type is an event of the connection."""
    code = F.col("code")  # a column of its own: read out of a message once, not for each table
    table = F.lit("events")
    out = messages.withColumn("code", F.get_json_object("msg", "$.T"))
    for name, (codes, fields) in FEED.items():
        mine = code.isin(*codes.split())
        table = F.when(mine, name).otherwise(table)
        # Other rows are parsed as null, so each message is read by one schema only.
        out = out.withColumn(name, F.from_json(F.when(mine, F.col("msg")), message_schema(fields)))
    return out.withColumn("table", table)


def feed_table(stored: DataFrame, name: str) -> DataFrame:
    """A table of what `demultiplexer` wrote, typed, with the time of receipt; only its own columns are read."""
    rows = stored.where(F.col("table") == name)
    if name in ("raw_log", "events"):
        return (stored if name == "raw_log" else rows).select("ts_recv", "conn", "msg")
    specs = [f.split() for f in FEED[name][1].split(", ")]
    if any(field.startswith("Data.") for _, _, field in specs):
        rows = rows.select("ts_recv", name, F.explode(f"{name}.Data").alias("_item"))
    symbol = F.col(f"{name}.symbol") if any(c == "symbol" and not f.startswith("Data.") for c, _, f in specs) else F.lit(None).cast("string")
    columns = [typed(F.col("_item"), symbol, kind, field[5:]).alias(c) if field.startswith("Data.") else typed(F.col(name), symbol, kind, field).alias(c) for c, kind, field in specs]
    extra = [F.timestamp_seconds("t").alias("time"), (F.col("code") == "bc").alias("closed")] if name == "bars_1m" else []
    return rows.select("ts_recv", *(["code"] if extra else []), *columns).select("ts_recv", *[c for c, *_ in specs], *extra)


def demultiplexer(messages: DataFrame) -> DataFrame:
    """A stream of messages (ts_recv, conn, msg) split into the tables of the feed in one pass.

    Each micro-batch is parsed and written once, by table and batch number, so a batch that is run again replaces itself;
    `feed_table` reads one table out of it. Wrong numbers become null, never an error.
    """
    spark = messages.sparkSession
    path, progress = shared_path(spark, "feed"), shared_path(spark, "progress")

    def put(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "table").parquet(path)

    query = parsed(messages).writeStream.trigger(availableNow=True).option("checkpointLocation", progress).foreachBatch(put).start()
    query.awaitTermination()
    return spark.read.parquet(path)


#: Days without an event after which a call that only shifts told of is given up: what bounds the state of such a ship.
IDLE_DAYS = 400
DAY_US = 86_400_000_000


class ShipState:
    """Port calls of one ship: events wait until the watermark has passed them, and are then taken in order.

    So neither the order in which events come nor repeats within the watermark's delay matter; later ones are dropped as
    late. Times are microseconds; a waiting event is (time, place of its section in SECTIONS, event id, from, to).
    """

    def __init__(self, ship: int, waiting: list = (), call: list | None = None):
        self.ship, self.pairing, self.last, self.waiting = ship, Pairing(ship), None, [tuple(w) for w in waiting]
        if call:
            arrival, *rest, self.last = call
            self.pairing.open = dict(zip(Pairing.FIELDS, (None if arrival is None else pd.Timestamp(arrival, unit="us"), *rest)))

    def ends(self) -> int:
        arrival = self.pairing.open["arrival"]
        return self.last + IDLE_DAYS * DAY_US if arrival is None else arrival.value // 1000 + (MOST_DAYS + 1) * DAY_US

    def release(self, watermark: int) -> list[tuple]:
        """Take what the watermark, in microseconds, has passed, in order, and close a call that it has outlived."""
        self.waiting.sort()
        due = bisect_right(self.waiting, watermark, key=lambda w: w[0])
        out, taken = [], set()
        for ts, rank, _, a, b in self.waiting[:due]:
            if (ts, rank, a, b) not in taken:
                taken.add((ts, rank, a, b))
                out += self.pairing.take(pd.Timestamp(ts, unit="us"), SECTIONS[rank], a, b)
                self.last = ts
        self.waiting = self.waiting[due:]
        if self.pairing.open and self.ends() <= watermark:
            out.append(self.pairing.close(last=True))
        return out

    def next(self) -> int | None:
        """When the ship has to be looked at again; nothing if nothing is left of it."""
        times = [min(self.waiting)[0]] if self.waiting else []
        return min(times + ([self.ends()] if self.pairing.open else []), default=None)

    def stored(self) -> tuple:
        if not (now := self.pairing.open):
            return self.waiting, None
        return self.waiting, (None if now["arrival"] is None else now["arrival"].value // 1000, *[now[f] for f in Pairing.FIELDS[1:]], self.last)


def ship_calls(key, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The calls of a group of ships that the watermark has passed; its state is read and written once per batch."""
    ships = {int(k): ShipState(int(k), *v) for k, v in json.loads(state.get[0]).items()} if state.exists else {}
    for part in rows:
        for ship, *event in zip(*(part[c].tolist() for c in ("ship_key", "us", "rank", "event_id", "place_from", "place_to"))):
            if ship not in ships:
                ships[ship] = ShipState(ship)
            ships[ship].waiting.append(tuple(event))
    watermark, out, times = state.getCurrentWatermarkMs(), [], []
    for ship, kept in list(ships.items()):
        at = kept.next()
        if at <= watermark * 1000:
            out += kept.release(watermark * 1000)
            at = kept.next()
        times.append(at) if at is not None else ships.pop(ship)
    if times:
        state.update((json.dumps({k: v.stored() for k, v in ships.items()}),))
        state.setTimeoutTimestamp(max(min(times) // 1000, watermark) + 1)
    else:
        state.remove()
    if out:
        made = pd.DataFrame(out, columns=list(CALL_COLUMNS))
        yield made.astype({c: "Int32" for c in ("origin", "first_berth", "last_berth", "n_shifts", "destination", "n_revisions")} | {c: "datetime64[us]" for c in ("arrival", "departure")} | {"ship_key": "int64", "hours_in_port": "float64"})


def streaming_calls(events: DataFrame, late: str = "3 days", groups: int = 512) -> DataFrame:
    """Port calls of a stream of events: the batch job's calls, whatever the order of events and repeats within `late`.

    Ships are dealt to `groups` groups of one row of state each, as a call of Python per ship and batch costs far more than
    its few events; a row holds the open calls and the events not yet passed of its ships.
    """
    ts = F.col("ts").cast("timestamp")
    rank = F.array_position(F.array(*[F.lit(x) for x in SECTIONS]), F.col("section")) - 1
    used = events.where(F.col("section").isin(*SECTIONS)).select(F.pmod(F.xxhash64("ship_key"), F.lit(groups)).alias("group"), "ship_key", ts.alias("ts"), F.unix_micros(ts).alias("us"), rank.alias("rank"), "event_id", "place_from", "place_to")
    return used.withWatermark("ts", late).groupBy("group").applyInPandasWithState(ship_calls, CALL_SCHEMA, "ships string", "append", GroupStateTimeout.EventTimeTimeout)


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def replayed_calls(events: DataFrame, late: str = "3 days") -> DataFrame:
    """`streaming_calls` run over what is there, its state in the store on disk."""
    spark = events.sparkSession
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        return replay(streaming_calls(events, late), "append")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
