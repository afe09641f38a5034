"""Port operators: calls from events, berth visits, stops and legs, lanes, rotations, volume models.

Events are (event_id, ship_key, ts, section, place_from, place_to, dwt). Calls are found by windows over a ship's events
and one aggregation per call, so a busy ship is sorted, not held; its stateful stream is in `streaming.live`.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .temporal import carried, carried_sum, stored

REVISION_DAYS, MOST_DAYS = 3, 45
SECTIONS = ("arrive", "shift", "depart")
CALL_COLUMNS = ("ship_key", "arrival", "origin", "first_berth", "berths", "last_berth", "n_shifts", "departure", "destination", "hours_in_port", "status", "n_revisions")
CALL_SCHEMA = "ship_key long, arrival timestamp, origin int, first_berth int, berths string, last_berth int, n_shifts int, departure timestamp, destination int, hours_in_port double, status string, n_revisions int"


class Pairing:
    """State of one ship in a stream: the open call, and the calls that are done.

    An arrival from the same origin at the same berth within REVISION_DAYS of the open one, before any shift, replaces
    its date; any other closes the open call. A shift or departure more than MOST_DAYS after the arrival closes the call
    too, and belongs to a call without arrival, as one without an open call does. A departure closes its call.
    """

    FIELDS = ("arrival", "origin", "berths", "shifts", "revisions")

    def __init__(self, ship: int, state: dict | None = None):
        self.ship, self.open = ship, state

    def close(self, departure=None, destination: int | None = None, last: bool = False) -> tuple:
        call, self.open = self.open, None
        arrival, berths = call["arrival"], call["berths"]
        status = ("complete" if arrival is not None else "no_arrival") if departure is not None else "shift_only" if arrival is None and last else "no_departure"
        hours = round((departure - arrival).total_seconds() / 3600, 1) if departure is not None and arrival is not None else None
        return (self.ship, arrival, call["origin"], berths[0], "|".join(map(str, berths)), berths[-1], call["shifts"], departure, destination, hours, status, call["revisions"])

    def begin(self, arrival, origin: int | None, berth: int) -> None:
        self.open = {"arrival": arrival, "origin": origin, "berths": [berth], "shifts": 0, "revisions": 0}

    def touch(self, berth: int) -> None:
        if berth not in self.open["berths"]:
            self.open["berths"].append(berth)

    def take(self, ts, section: str, place_from: int, place_to: int) -> Iterator[tuple]:
        now, since = self.open, self.open and self.open["arrival"]
        if section == "arrive":
            again = now and since is not None and not now["shifts"] and (now["origin"], now["berths"][0]) == (place_from, place_to) and (ts - since).days <= REVISION_DAYS
            if again:
                now["arrival"], now["revisions"] = ts, now["revisions"] + 1
                return
            if now:
                yield self.close()
            self.begin(ts, place_from, place_to)
            return
        if now and since is not None and (ts - since).days > MOST_DAYS:
            yield self.close()
        if not self.open:
            self.begin(None, None, place_from)
        if section == "shift":
            self.open["shifts"] += 1
            self.touch(place_to)
        else:
            self.touch(place_from)
            yield self.close(ts, place_to)


def whole_days(later: Column, earlier: Column) -> Column:
    return F.floor((F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(86_400_000_000))


def calls_from_events(events: DataFrame) -> DataFrame:
    """Calls per ship from its events in time order (ties: arrivals, shifts, departures, then event id).

    A call begins after a departure, and at an arrival that doesn't revise the one just before it: same origin and berth,
    within REVISION_DAYS. What follows an arrival by more than MOST_DAYS is a call of its own, without arrival. Two
    windows over a ship and one aggregation per call; nothing of a ship is held at once.
    """
    rank = F.array_position(F.array(*[F.lit(x) for x in SECTIONS]), F.col("section"))
    used = events.where(F.col("section").isin(*SECTIONS)).groupBy("ship_key", F.col("ts").cast("timestamp").alias("ts"), "section", "place_from", "place_to").agg(F.min("event_id").alias("event_id"))
    w = Window.partitionBy("ship_key").orderBy("ts", rank, "event_id")
    before = {c: F.lag(c).over(w) for c in ("section", "place_from", "place_to", "ts")}
    revises = (before["section"] == "arrive") & (before["place_from"] == F.col("place_from")) & (before["place_to"] == F.col("place_to")) & (whole_days(F.col("ts"), before["ts"]) <= REVISION_DAYS)
    arrives = F.col("section") == "arrive"
    opens = before["section"].isNull() | (before["section"] == "depart") | (arrives & ~F.coalesce(revises, F.lit(False)))
    marked = used.select("*", rank.alias("rank"), opens.cast("int").alias("opens"), F.lead("ts").over(w).isNull().alias("last"))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    numbered = marked.withColumn("part", F.sum("opens").over(upto))
    # The arrivals of a part are its first events, so the newest one so far is the part's.
    since = F.max(F.when(arrives, F.col("ts"))).over(Window.partitionBy("ship_key", "part").orderBy("ts", "rank", "event_id").rowsBetween(Window.unboundedPreceding, 0))
    split = numbered.withColumn("late", F.coalesce(~arrives & (whole_days(F.col("ts"), since) > MOST_DAYS), F.lit(False)))
    first = F.struct("ts", "rank", "event_id")
    touched = F.array_sort(F.collect_list(F.struct("ts", "rank", "event_id", F.when(F.col("section") == "depart", F.col("place_from")).otherwise(F.col("place_to")).alias("place"))))
    calls = split.groupBy("ship_key", "part", "late").agg(
        F.max(F.when(arrives, F.col("ts"))).alias("arrival"),
        F.max(F.when(arrives, F.col("place_from"))).alias("origin"),
        F.min_by(F.when(arrives, F.col("place_to")).otherwise(F.col("place_from")), first).alias("first_berth"),
        F.transform(touched, lambda t: t["place"]).alias("touched"),
        F.count_if(F.col("section") == "shift").cast("int").alias("n_shifts"),
        F.max(F.when(F.col("section") == "depart", F.col("ts"))).alias("departure"),
        F.max(F.when(F.col("section") == "depart", F.col("place_to"))).alias("destination"),
        F.greatest(F.count_if(arrives) - 1, F.lit(0)).cast("int").alias("n_revisions"),
        F.bool_or("last").alias("last"),
    )
    berths = F.array_distinct(F.concat(F.array("first_berth"), F.col("touched")))
    arrived, left = F.col("arrival").isNotNull(), F.col("departure").isNotNull()
    status = F.when(arrived & left, "complete").when(left, "no_arrival").when(~arrived & F.col("last"), "shift_only").otherwise("no_departure")
    hours = F.round((F.unix_micros("departure") - F.unix_micros("arrival")) / 3.6e9, 1)
    out = calls.withColumns({"berths": berths, "status": status, "hours_in_port": hours})
    return out.withColumns({"last_berth": F.element_at("berths", -1), "berths": F.array_join(F.transform("berths", lambda b: b.cast("string")), "|")}).select(*CALL_COLUMNS)


def calls_by_id(events: DataFrame, call: str) -> DataFrame:
    """Feeds with a voyage id: last arrival, last departure and the berths in order, by plain aggregation."""
    berths = F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", "place_to"))), lambda b: b["place_to"].cast("string"))
    return events.groupBy(call).agg(F.max(F.when(F.col("section") == "arrive", F.col("ts"))).alias("arrival"), F.max(F.when(F.col("section") == "depart", F.col("ts"))).alias("departure"), F.array_join(berths, "|").alias("berths"))


def port_days(events: DataFrame) -> DataFrame:
    """Arrivals, departures and shifts in and out per place and day; a shift counts at both of its places."""
    day, size = F.col("ts").cast("date"), F.col("dwt")
    sides = F.when(F.col("section") == "arrive", F.array(F.struct(F.col("place_to").alias("place"), F.lit("arrive").alias("what")))).when(F.col("section") == "depart", F.array(F.struct(F.col("place_from").alias("place"), F.lit("depart").alias("what")))).when(F.col("section") == "shift", F.array(F.struct(F.col("place_from").alias("place"), F.lit("out").alias("what")), F.struct(F.col("place_to").alias("place"), F.lit("in").alias("what"))))
    each = events.select(day.alias("day"), size.alias("dwt"), F.explode(sides).alias("s")).select("day", "dwt", "s.*")
    kinds = ["arrive", "depart", "in", "out"]
    return each.groupBy("place", "day").agg(*[F.count_if(F.col("what") == k).alias(f"n_{k}") for k in kinds], F.sum(F.when(F.col("what") == "arrive", F.col("dwt")).otherwise(0.0)).alias("dwt_in"))


def visits(calls: DataFrame, anchorages: list[str]) -> DataFrame:
    """One row per call and berth, without anchorages."""
    each = calls.select("*", F.posexplode(F.split("berths", r"\|")).alias("k", "berth"))
    return each.where(~F.col("berth").isin(anchorages))


def month_by_operator(rows: DataFrame, operator: Column, size_class: Column) -> DataFrame:
    return rows.groupBy(F.last_day(F.col("ts").cast("date")).alias("month"), operator.alias("operator"), size_class.alias("size_class")).agg(F.count("*").alias("n"), F.countDistinct("ship_key").alias("ships"), F.sum("dwt").alias("dwt"))


def vessel_profiles(events: DataFrame, as_of: str) -> DataFrame:
    """Per ship: calls in all and in twelve months, largest size, most common berth (ties: smallest), first and last."""
    since = F.add_months(F.lit(as_of).cast("date"), -12)
    per_berth = events.groupBy("ship_key", "place_to").agg(F.count("*").alias("c"), F.count_if(F.col("ts").cast("date") > since).alias("recent"), F.max("dwt").alias("dwt"), F.min("ts").alias("t0"), F.max("ts").alias("t1"))
    return per_berth.groupBy("ship_key").agg(F.sum("c").alias("calls"), F.sum("recent").alias("calls_12m"), F.max("dwt").alias("largest"), F.max_by("place_to", F.struct("c", -F.col("place_to"))).alias("berth"), F.min("t0").alias("first_seen"), F.max("t1").alias("last_seen"))


def top_and_others(rows: DataFrame, period: str, entity: str, value: str, n: int) -> DataFrame:
    """The n largest entities by total and the others as one, with shares per period."""
    totals = rows.groupBy(entity).agg(F.sum(value).alias("_total"))
    best = totals.orderBy(F.desc("_total"), entity).limit(n).select(entity, F.lit(True).alias("_top"))
    named = rows.join(best, entity, "left").withColumn("name", F.when(F.col("_top"), F.col(entity).cast("string")).otherwise("other"))
    per = named.groupBy(period, "name").agg(F.sum(value).alias("value"))
    return per.withColumn("share", F.try_divide(100 * F.col("value"), F.sum("value").over(Window.partitionBy(period))))


def period_compare(rows: DataFrame, entity: str, date: str, value: str, as_of: str, n: int) -> DataFrame:
    """Last n days against the n before and the same days a year ago."""
    day = F.lit(as_of).cast("date")

    def part(first: Column, last: Column) -> Column:
        return F.sum(F.when((F.col(date) > first) & (F.col(date) <= last), F.col(value)).otherwise(0.0))

    year = F.add_months(day, -12)
    return rows.groupBy(entity).agg(part(F.date_sub(day, n), day).alias("now"), part(F.date_sub(day, 2 * n), F.date_sub(day, n)).alias("before"), part(F.date_sub(year, n), year).alias("year_ago"))


def period_kpis(visits: DataFrame, group: str, day: str, measures: list[str], hours: str, ship: str, as_of: str, n: int = 30) -> DataFrame:
    """Per group: each measure's sum over the last n days, the n before and the same n of 365 days ago, with both changes (null against
    zero); median hours of the first two with their difference; and the different ships of the last n days.

    A median holds one counter per different value of a group.
    """
    end = F.date_add(F.lit(as_of).cast("date"), 1)

    def within(ago: int) -> Column:
        return (F.col(day) >= F.date_sub(end, ago + n)) & (F.col(day) < F.date_sub(end, ago))

    spans = {"now": within(0), "before": within(n), "year_ago": within(365)}
    sums = [F.coalesce(F.sum(F.when(w, F.col(m))), F.lit(0.0)).alias(f"{m}_{s}") for m in measures for s, w in spans.items()]
    medians = [F.median(F.when(spans[s], F.col(hours))).alias(f"hours_{s}") for s in ("now", "before")]
    ships = F.countDistinct(F.when(spans["now"], F.col(ship))).alias("ships")
    per = visits.where(spans["now"] | spans["before"] | spans["year_ago"]).groupBy(group).agg(*sums, *medians, ships)
    changes = {f"{m}_{c}": F.try_divide(F.col(f"{m}_now") - F.col(f"{m}_{s}"), F.col(f"{m}_{s}")) for m in measures for c, s in (("change", "before"), ("yearly", "year_ago"))}
    return per.withColumns(changes | {"hours_change": F.col("hours_now") - F.col("hours_before")})


def running_yoy(rows: DataFrame, date: str, value: str, as_of: str) -> DataFrame:
    """Yearly totals against the year before, the running year against the same number of its days."""
    day = F.lit(as_of).cast("date")
    cut = F.dayofyear(day)
    totals = rows.where(F.col(date) <= day).groupBy(F.year(date).alias("year")).agg(F.sum(value).alias("total"), F.sum(F.when(F.dayofyear(date) <= cut, F.col(value)).otherwise(0.0)).alias("same_days"))
    w = Window.orderBy("year")
    base = F.when(F.col("year") == F.year(day), F.lag("same_days").over(w)).otherwise(F.lag("total").over(w))
    return totals.withColumn("yoy", F.try_divide("total", base) - 1).drop("same_days")


def stops_and_legs(events: DataFrame, gap_days: int) -> tuple[DataFrame, DataFrame]:
    """Consecutive events of a ship at one place within the gap are one stop; a leg leads to the next stop."""
    w = Window.partitionBy("ship_key").orderBy("ts", "event_id")
    apart = (F.col("place_to") != F.lag("place_to").over(w)) | (F.unix_timestamp("ts") - F.unix_timestamp(F.lag("ts").over(w)) > gap_days * 86400)
    marked = events.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("stop", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    stops = marked.groupBy("ship_key", "stop").agg(F.min("place_to").alias("place"), F.min("ts").alias("start"), F.max("ts").alias("end"), F.count("*").alias("events"))
    order = Window.partitionBy("ship_key").orderBy("stop")
    legs = stops.select("ship_key", "stop", F.col("place").alias("from_place"), F.lead("place").over(order).alias("to_place"), F.col("end").alias("left_at"), F.lead("start").over(order).alias("reached_at")).where("to_place IS NOT NULL")
    return stops, legs


#: Days within which a real stop confirms an inferred one, stops of that many rows away count, and hours that keep two real stops at one port together.
CONFIRM_DAYS, CONFIRM_ROWS, MERGE_HOURS = 10, 3, 48


def stops_of_calls(calls: DataFrame) -> DataFrame:
    """Stops that calls tell of: the call itself, its origin a minute before the arrival and its destination a minute after the departure, both inferred."""
    minute = F.expr("INTERVAL 1 MINUTE")
    none = F.lit(None).cast("timestamp")

    def stop(t: Column, port: str, side: str, arrive: Column = none, depart: Column = none) -> Column:
        return F.struct(t.alias("t"), F.col(port).alias("port"), F.lit(side).alias("side"), arrive.alias("arrive"), depart.alias("depart"), F.col("port").alias("home"))

    at = F.coalesce("arrival", "departure")
    arrival, departure = F.col("arrival"), F.col("departure")
    stops = F.array(
        F.when(F.col("origin").isNotNull() & arrival.isNotNull(), stop(arrival - minute, "origin", "origin")),
        F.when(at.isNotNull(), stop(at, "port", "call", arrival, departure)),
        F.when(F.col("destination").isNotNull() & departure.isNotNull(), stop(departure + minute, "destination", "to")),
    )
    each = calls.withColumn("port", F.col("first_berth")).select("ship_key", F.explode(stops).alias("s"))
    return each.where("s IS NOT NULL").select("ship_key", "s.*")


def itinerary(calls: DataFrame, region: Column, piece_days: int = 60) -> DataFrame:
    """Stops of ships in order: `ship_key, idx, port, start, arrive, depart, inferred, rows`; a port is null where a ship was somewhere unknown.

    An inferred stop goes if one of the next three stops (for an origin: of the three before) is a real one of the same
    `region` (null: none) within ten days, and no stop at the port that it was inferred from comes first. Then neighbouring stops at one port are one, unless
    both are real and more than two days lie between them: the ship was elsewhere, and a stop without port stands between.
    A real stop without a departure counts as left when it arrived.

    A ship's stops are dealt out by pieces of time. Neighbours are looked up in windows of one piece and the ten days on
    either side of it; what crosses pieces, the last stop, the last real one and the running numbers, is carried. Each of these
    steps reads its rows twice, so three of them are stored: calls are found once.
    """
    seconds = piece_days * 86400
    epoch = F.unix_timestamp("t")
    raw = stops_of_calls(calls).withColumns({"inferred": F.col("side") != "call", "region": region, "rank": F.array_position(F.array(F.lit("origin"), F.lit("call"), F.lit("to")), F.col("side"))})
    raw = raw.withColumn("order", F.struct("t", "rank", F.coalesce("port", F.lit(-1)).alias("port"), F.coalesce("home", F.lit(-1)).alias("home")))
    own = F.floor(epoch / seconds)
    reach = (CONFIRM_DAYS + 1) * 86400
    spread = raw.withColumn("own", own).withColumn("piece", F.explode(F.array_distinct(F.array(F.floor((epoch - reach) / seconds), own, F.floor((epoch + reach) / seconds)))))
    w = Window.partitionBy("ship_key", "piece").orderBy("order")

    def confirmed(step: int) -> Column:
        """Whether a neighbour on that side confirms a stop, before one at the port that it was inferred from ends the search."""
        out = F.lit(False)
        for k in range(CONFIRM_ROWS, 0, -1):
            see = [F.lag(c, k).over(w) if step < 0 else F.lead(c, k).over(w) for c in ("port", "inferred", "region", "t")]
            days = F.floor((F.unix_timestamp(see[3]) - epoch) / 86400.0)
            # The search ends at the home port and at the first real stop of the region, near enough or not.
            out = F.when(see[0].isNull() & see[3].isNull(), False).when(see[0] == F.col("home"), False).when(~see[1] & (see[2] == F.col("region")), F.abs(days) <= CONFIRM_DAYS).otherwise(out)
        return out

    drop = F.col("inferred") & F.col("region").isNotNull() & F.when(F.col("side") == "to", confirmed(1)).otherwise(confirmed(-1))
    kept = stored(spread.withColumn("_drop", F.coalesce(drop, F.lit(False))).where((F.col("piece") == F.col("own")) & ~F.col("_drop")).drop("own", "_drop", "region", "side"))

    by, order = ["ship_key"], ["order"]
    seen = carried(kept, by, "piece", order, {"before": F.struct("port")})
    turned = carried_sum(seen, by, "piece", order, F.coalesce((F.col("before.port").isNull() | (F.col("before.port") != F.col("port"))).cast("int"), F.lit(1)), "run")
    left_at = F.coalesce("depart", "arrive", "t")
    real = carried(stored(turned), by, "piece", order, {"real": F.when(~F.col("inferred"), F.struct("run", left_at.alias("left_at")))})
    apart = ~F.col("inferred") & (F.col("real.run") == F.col("run")) & (F.unix_timestamp(F.coalesce("arrive", "depart", "t")) - F.unix_timestamp("real.left_at") > MERGE_HOURS * 3600)
    broken = real.withColumn("gap", F.coalesce(apart, F.lit(False)))
    fresh = F.coalesce((F.col("before.port").isNull() | (F.col("before.port") != F.col("port"))), F.lit(True))
    # A gap takes a number of its own, the one before the stop that follows it.
    numbered = stored(carried_sum(broken, by, "piece", order, F.when(F.col("gap"), 2).otherwise(fresh.cast("int")), "idx").drop("before", "order", "run"))
    stops = numbered.groupBy("ship_key", "idx").agg(
        F.first("port").alias("port"), F.coalesce(F.min(F.when(~F.col("inferred"), F.col("t"))), F.min("t")).alias("start"), F.min("arrive").alias("arrive"), F.max("depart").alias("depart"), F.bool_and("inferred").alias("inferred"), F.count("*").alias("rows")
    )
    gone = F.col("real.left_at") + F.expr("INTERVAL 1 MINUTE")
    gaps = numbered.where("gap").select("ship_key", (F.col("idx") - 1).alias("idx"), F.lit(None).cast("int").alias("port"), gone.alias("start"), F.lit(None).cast("timestamp").alias("arrive"), F.lit(None).cast("timestamp").alias("depart"), F.lit(True).alias("inferred"), F.lit(0).cast("long").alias("rows"))
    return stops.unionByName(gaps)


def itinerary_legs(stops: DataFrame) -> DataFrame:
    """From each stop to the next, with the days between leaving and reaching; the numbers of an itinerary have no holes, so this is a plain join."""
    to = stops.select("ship_key", (F.col("idx") - 1).alias("idx"), F.col("port").alias("to_place"), F.coalesce("arrive", "start").alias("reached_at"))
    left_at = F.coalesce("depart", "arrive", "start")
    legs = stops.join(to, ["ship_key", "idx"]).select("ship_key", "idx", F.col("port").alias("from_place"), "to_place", left_at.alias("left_at"), "reached_at")
    return legs.withColumn("days", (F.unix_timestamp("reached_at") - F.unix_timestamp("left_at")) / 86400.0)


def operator_lanes(legs: DataFrame, ships: DataFrame) -> DataFrame:
    """Per month, lane and operator (`ships`: ship_key, operator, capacity): legs, ships and the capacity carried; unknown ports are no lanes."""
    joined = legs.where("from_place IS NOT NULL AND to_place IS NOT NULL").join(ships, "ship_key", "left")
    return joined.groupBy(F.last_day(F.col("left_at").cast("date")).alias("month"), "from_place", "to_place", "operator").agg(F.count("*").alias("legs"), F.countDistinct("ship_key").alias("ships"), F.sum("capacity").alias("capacity"))


def lanes(legs: DataFrame) -> DataFrame:
    return legs.groupBy(F.last_day(F.col("left_at").cast("date")).alias("month"), "from_place", "to_place").agg(F.count("*").alias("legs"), F.countDistinct("ship_key").alias("ships"))


def typical_route(legs: DataFrame, home: int, steps: int = 7) -> DataFrame:
    """From the home port, always the most frequent next port (ties: smallest), while it isn't on the route yet.

    The transition table has one row per port, so the bounded walk joins small tables only.
    """
    counts = legs.groupBy("from_place", "to_place").agg(F.count("*").alias("n"))
    best = counts.groupBy("from_place").agg(F.max_by("to_place", F.struct("n", -F.col("to_place"))).alias("next"))
    route = best.where(F.col("from_place") == home).select(F.array(F.col("from_place")).alias("route"))
    for _ in range(steps):
        step = route.join(best, F.element_at("route", -1) == F.col("from_place"), "left")
        go = F.col("next").isNotNull() & ~F.array_contains("route", F.col("next"))
        route = step.select(F.when(go, F.concat("route", F.array("next"))).otherwise(F.col("route")).alias("route"))
    return route.select(F.array_join(F.transform("route", lambda p: p.cast("string")), ">").alias("route"))


def rotations(stops: DataFrame, least_days: float = 7) -> DataFrame:
    """Per ship: the median gap of returns to a port of at least `least_days`, and the ports of the last such cycle."""
    w = Window.partitionBy("ship_key", "place").orderBy("start")
    gap = (F.unix_timestamp("start") - F.unix_timestamp(F.lag("start").over(w))) / 86400
    gaps = stops.withColumn("gap", gap).where(F.col("gap") >= least_days).groupBy("ship_key").agg(F.median("gap").alias("cycle"))
    last = stops.groupBy("ship_key").agg(F.max("start").alias("t"))
    inside = stops.join(gaps, "ship_key").join(last, "ship_key").where(F.unix_timestamp("t") - F.unix_timestamp("start") <= F.col("cycle") * 86400)
    ports = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("start", "place"))), lambda s: s["place"]))
    return inside.groupBy("ship_key", "cycle").agg(F.array_join(F.transform(ports, lambda p: p.cast("string")), "|").alias("ports"))


def weekly_to_months(weeks: DataFrame, key: str, end: str, value: str) -> DataFrame:
    """Weekly values spread over their seven days and summed by calendar month; months without all days are left out.

    A week is one row per month that it touches. The days seen of a month are the bits of a number, so that none counts twice.
    """
    first, last = F.date_sub(end, 6), F.col(end)
    months = F.explode(F.array_distinct(F.array(F.last_day(first), F.last_day(last)))).alias("month")
    parts = weeks.select(key, first.alias("_first"), last.alias("_last"), F.col(value).alias("_v"), months)
    begin, stop = F.greatest("_first", F.trunc("month", "month")), F.least("_last", "month")
    n = F.datediff(stop, begin) + 1
    seen = F.call_function("shiftleft", F.lit(127).cast("long").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), n) - 1), F.dayofmonth(begin) - 1)
    months = parts.groupBy(key, "month").agg(F.sum(F.col("_v") / 7 * n).alias("value"), F.bit_count(F.bit_or(seen)).alias("days"))
    return months.where(F.col("days") == F.dayofmonth("month")).drop("days")


def allocated(totals: DataFrame, weights: DataFrame, keys: list[str]) -> DataFrame:
    """Totals split by the weights' shares, only where every weight is positive."""
    w = Window.partitionBy(*keys)
    shares = weights.withColumn("_all", F.min("weight").over(w)).withColumn("_share", F.when(F.col("_all") > 0, F.col("weight") / F.sum("weight").over(w)))
    return totals.join(shares, keys).withColumn("part", F.col("total") * F.col("_share")).drop("_all", "_share", "weight")


def from_cumulative(df: DataFrame, keys: list[str], month_no: str, value: str) -> DataFrame:
    """Monthly values as differences of cumulative ones of adjacent months within a year; never negative."""
    w = Window.partitionBy(*keys, "year").orderBy(month_no)
    before = F.when(F.lag(month_no).over(w) == F.col(month_no) - 1, F.lag(value).over(w)).when(F.col(month_no) == 1, 0.0)
    step = F.col(value) - before
    return df.withColumn("monthly", F.when(step.isNotNull(), F.greatest(step, F.lit(0.0))))


def seasonality(monthly: DataFrame, key: str, value: str) -> DataFrame:
    """Per calendar month the median ratio to the centred mean of twelve months, normalised and kept in 0.7 to 1.35."""
    w = Window.partitionBy(key).orderBy("month").rowsBetween(-6, 5)
    ratio = F.when(F.count(value).over(w) == 12, F.try_divide(F.col(value), F.avg(value).over(w)))
    per = monthly.withColumn("ratio", ratio).groupBy(key, F.month("month").alias("m")).agg(F.median("ratio").alias("f"))
    mean = F.avg("f").over(Window.partitionBy(key))
    return per.withColumn("factor", F.greatest(F.least(F.col("f") / mean, F.lit(1.35)), F.lit(0.7))).drop("f")


def no_intercept(s11: Column, s12: Column, s22: Column, s1y: Column, s2y: Column) -> Column:
    """Non-negative least squares on two variables in closed form: inside, or the better single variable."""
    det = s11 * s22 - s12 * s12
    b1, b2 = F.try_divide(s1y * s22 - s2y * s12, det), F.try_divide(s2y * s11 - s1y * s12, det)
    one, two = F.try_divide(F.greatest(s1y, F.lit(0.0)), s11), F.try_divide(F.greatest(s2y, F.lit(0.0)), s22)
    # The squared error falls by s1y^2 / s11 for the first variable alone.
    first = F.coalesce(F.try_divide(F.pow(F.greatest(s1y, F.lit(0.0)), 2), s11), F.lit(0.0)) >= F.coalesce(F.try_divide(F.pow(F.greatest(s2y, F.lit(0.0)), 2), s22), F.lit(0.0))
    inside = (det > 1e-9) & (b1 >= 0) & (b2 >= 0)
    return F.when(inside, F.struct(b1.alias("b1"), b2.alias("b2"))).when(first, F.struct(one.alias("b1"), F.lit(0.0).alias("b2"))).otherwise(F.struct(F.lit(0.0).alias("b1"), two.alias("b2")))


def walk_forward(df: DataFrame, key: str, order: str, x1: str, x2: str, y: str, least: int = 6, window: int | None = None) -> DataFrame:
    """Each month predicted from the months before it (all, or the last `window`), for all groups in one window pass."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding if window is None else -window, -1)

    def s(expr: Column) -> Column:
        return F.sum(expr).over(w)

    a, b, c = F.col(x1), F.col(x2), F.col(y)
    fit = no_intercept(s(a * a), s(a * b), s(b * b), s(a * c), s(b * c))
    out = df.withColumn("fit", F.when(F.count(y).over(w) >= least, fit)).withColumn("predicted", F.col("fit.b1") * a + F.col("fit.b2") * b)
    naive = F.lag(y).over(Window.partitionBy(key).orderBy(order))
    return out.withColumns({"naive": naive, "error": F.abs(F.try_divide(F.col("predicted") - c, c)), "naive_error": F.abs(F.try_divide(naive - c, c))}).drop("fit")


def sum_of_models(predictions: DataFrame, key: str, month: str) -> DataFrame:
    """Totals of months in which every group has a prediction, and the error of the total."""
    groups = predictions.agg(F.countDistinct(key).alias("_n"))
    per = predictions.groupBy(month).agg(F.count("*").alias("n"), F.sum("predicted").alias("predicted"), F.sum("actual").alias("actual"))
    both = per.join(F.broadcast(groups)).where(F.col("n") == F.col("_n")).drop("_n")
    return both.withColumn("error", F.try_divide("predicted", "actual") - 1)


def quarters_of_months(df: DataFrame, key: str, month: str, value: str) -> DataFrame:
    """Quarter sums of complete quarters, with growth against the same quarter a year before."""
    per = df.groupBy(key, (F.year(month) * 4 + F.quarter(month) - 1).alias("t")).agg(F.sum(value).alias("value"), F.count("*").alias("n")).where("n = 3").drop("n")
    past = per.select(key, (F.col("t") + 4).alias("t"), F.col("value").alias("base"))
    return per.join(past, [key, "t"], "left").withColumn("yoy", F.try_divide("value", "base") - 1).drop("base")


def with_confirmed(monthly: DataFrame, confirmed: DataFrame, keys: list[str], value: str, priority: str) -> DataFrame:
    """Confirmed values override a month (the highest priority wins)."""
    best = confirmed.groupBy(*keys).agg(F.max_by("confirmed", priority).alias("_c"))
    return monthly.join(best, keys, "left").withColumn("delta", F.coalesce(F.col("_c") - F.col(value), F.lit(0.0))).withColumn(value, F.coalesce("_c", value)).drop("_c")


def block_totals(blocks: DataFrame, exact: DataFrame, key: str) -> DataFrame:
    """Totals of multi-month blocks: their own total, or the sum of their months if all are known exactly."""
    months = blocks.select(key, "first", "last", "total", F.explode(F.sequence(F.trunc("first", "month"), F.trunc("last", "month"), F.expr("INTERVAL 1 MONTH"))).alias("m"))
    joined = months.join(exact.select(key, F.trunc("month", "month").alias("m"), "value"), [key, "m"], "left")
    out = joined.groupBy(key, "first", "last", "total").agg(F.count("*").alias("months"), F.count("value").alias("known"), F.sum("value").alias("sum"))
    return out.withColumn("best", F.when(F.col("known") == F.col("months"), F.col("sum")).otherwise(F.col("total")))
