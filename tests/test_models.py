"""Nowcasts, itineraries and the feed against plain loops, one terminal, ship and message after the other."""

import datetime as dt
import json
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.operators import nowcast, ports
from quayside.plans import nowcast_plans
from quayside.sources.views import berth_visits, terminal_volumes
from quayside.streaming import live


def fit(rows):
    """Least squares on two variables without negative coefficients."""
    x, y = np.array([r[:2] for r in rows], float), np.array([r[2] for r in rows], float)
    best = np.linalg.lstsq(x, y, rcond=None)[0]
    if (best >= 0).all():
        return best
    best, error = np.zeros(2), (y**2).sum()
    for j in (0, 1):
        c = np.zeros(2)
        c[j] = max(x[:, j] @ y / (x[:, j] @ x[:, j]), 0)
        if ((y - x @ c) ** 2).sum() < error:
            best, error = c, ((y - x @ c) ** 2).sum()
    return best


def bias(rows, c):
    ratios = [y / (c[0] * h + c[1] * t) for h, t, y in rows[-3:] if c[0] * h + c[1] * t > 0]
    return min(max(statistics.mean(ratios), 0.7), 1.4) if ratios else 1.0


def year_ago(series, month, others):
    past = [series.get(m - 12) for m in others]
    if series.get(month - 12) is None or None in past or statistics.mean(past) <= 0:
        return None
    return min(max(series[month - 12] / statistics.mean(past), 0.7), 1.35)


def test_backtest_against_a_loop(spark, sf):
    f = nowcast_plans.features(spark, sf)
    train = nowcast.training(f, terminal_volumes(spark, sf), "terminal").orderBy("mno").collect()
    whole = f.where("NOT partial AND teu > 0").orderBy("mno").collect()
    got = {(r["terminal"], r["mno"]): r for r in nowcast_plans.walk(spark, sf).collect()}
    scores = {r["terminal"]: r for r in nowcast.backtest(nowcast_plans.walk(spark, sf), "terminal").collect()}
    for terminal in sorted({r["terminal"] for r in train})[:3]:
        own = [r for r in train if r["terminal"] == terminal]
        rows = [(r["hours"], r["teu"], r["actual"]) for r in own]
        seen = [r for r in whole if r["terminal"] == terminal]
        ratios = {}
        for i in range(6, len(seen) - 5):
            r = seen[i]["teu"] / statistics.mean(s["teu"] for s in seen[i - 6 : i + 6])
            if 0.4 < r < 2.5:
                ratios.setdefault(seen[i]["mno"] % 12, []).append((seen[i]["mno"] // 12, r))
        season = {m: statistics.median(v for _, v in r) for m, r in ratios.items()}
        years = {y for r in ratios.values() for y, _ in r}
        season = {m: v / statistics.mean(season.values()) for m, v in season.items()} if len(season) == 12 and len(years) >= 2 else None
        actual, share = {r["mno"]: r["actual"] for r in own}, {r["mno"]: r["actual"] / r["teu"] for r in own}
        table = []
        for i in range(12, len(own)):
            month, before = own[i]["mno"], [r["mno"] for r in own[i - 3 : i]]
            told = {}
            for name, n in (("every", i), ("last12", 12), ("last6", 6)):
                c = fit(rows[i - n : i])
                told[name] = (c[0] * rows[i][0] + c[1] * rows[i][1]) * bias(rows[i - n : i], c)
            factors = [year_ago(actual, month, before)]
            factors.append(min(max(season[month % 12] / statistics.mean(season[m % 12] for m in before), 0.7), 1.35) if season else None)
            factors = [x for x in factors if x is not None]
            told["ma3"] = statistics.mean(actual[m] for m in before) * (statistics.mean(factors) if factors else 1.0)
            told["use"] = statistics.mean(share[m] for m in before) * (year_ago(share, month, before) or 1.0) * rows[i][1]
            r = got[terminal, month]
            assert {k: r[k] for k in told} == pytest.approx(told, rel=1e-6)
            table.append((told, rows[i][2]))
        errors = {n: [abs(t[n] / y - 1) for t, y in table] for n in ("every", "last12", "last6")}
        best = min(errors, key=lambda n: statistics.mean(errors[n]) + statistics.mean(errors[n][-6:]))
        ensemble = [abs((t[best] + t["ma3"] + t["use"]) / 3 / y - 1) for t, y in table]
        s = scores[terminal]
        assert s["best"] == best and s["ensemble"] == pytest.approx(statistics.mean(ensemble), rel=1e-6) and s["band"] == pytest.approx(np.quantile(ensemble, 0.8), rel=1e-6)


def test_features_by_hand(spark):
    d = dt.date
    rows = [("a", d(2024, 1, 9), 100.0, 1000.0, 10.0), ("a", d(2024, 2, 1), 200.0, 2000.0, 90.0), ("a", d(2024, 2, 3), None, 500.0, None), ("a", d(2024, 4, 10), 0.0, 300.0, 5.0), ("a", d(2024, 4, 19), 100.0, 1.0, 5.0), ("b", d(2024, 3, 2), None, 7.0, 1.0)]
    visits = spark.createDataFrame(rows, "k string, day date, teu double, dwt double, hours double")
    got = {(r["k"], r["mno"] - 2024 * 12): (r["calls"], r["teu"], r["hours"], r["days_obs"], r["partial"]) for r in nowcast.month_features(visits, "k", F.lit("2024-04-20").cast("date")).collect()}
    # The first month of a begins after its fifth day; the last two days don't count; the ratio of a is 10.
    assert got == {("a", 1): (2, 250.0, 80.0, 29, False), ("a", 2): (0, 0.0, 0.0, 31, False), ("a", 3): (1, 30.0, 5.0, 18, True), ("b", 2): (1, 0.0, 1.0, 31, False)}


def test_shrinking_and_pools_by_hand(spark):
    train = spark.createDataFrame([("a", k, float(h), float(t), 2.0 * h + 3.0 * t) for k, (h, t) in enumerate([(1, 2), (2, 1), (3, 5), (4, 4)])] + [("b", k, float(h), float(h), 4.0 * h) for k, h in enumerate([1, 2, 3])], "k string, mno int, hours double, teu double, actual double")
    priors = spark.createDataFrame([("a", 2.0, 3.0), ("b", 1.0, 1.0)], "k string, p1 double, p2 double")
    got = {r["k"]: r for r in nowcast.shrunk(train, priors, "k").collect()}
    x = np.array([[1, 1], [2, 2], [3, 3]], float)
    pull = np.diag(6 * (x**2).mean(axis=0))
    b = np.ones(2) + np.linalg.solve(x.T @ x + pull, x.T @ (4 * x[:, 0] - x @ np.ones(2)))
    assert (got["a"]["b1"], got["a"]["b2"]) == pytest.approx((2.0, 3.0)) and (got["b"]["b1"], got["b"]["b2"]) == pytest.approx(tuple(b))
    pools = {r["class"]: r for r in nowcast.pooled(train, spark.createDataFrame([("a", "x"), ("b", "y")], "k string, class string"), "k").collect()}
    assert set(pools) == {"all"} and pools["all"]["keys"] == 2 and pools["all"]["months"] == 7


def plain_itinerary(calls, region):
    """Stops of one ship by the rule, one after the other."""
    minute = dt.timedelta(minutes=1)
    raw = []
    for arrival, departure, origin, destination, port in calls:
        if origin is not None and arrival:
            raw.append((arrival - minute, 1, origin, port, None, None))
        if arrival or departure:
            raw.append((arrival or departure, 2, port, port, arrival, departure))
        if destination is not None and departure:
            raw.append((departure + minute, 3, destination, port, None, None))
    raw.sort(key=lambda r: r[:4])
    kept = []
    for i, (t, rank, port, home, *_) in enumerate(raw):
        gone = False
        if rank != 2 and region(port) is not None:
            for j in range(i + 1, min(i + 4, len(raw))) if rank == 3 else range(i - 1, max(i - 4, -1), -1):
                if raw[j][2] == home:
                    break
                if raw[j][1] == 2 and region(raw[j][2]) == region(port):
                    gone = abs((raw[j][0] - t).days) <= 10
                    break
        if not gone:
            kept.append(raw[i])
    out = []
    last_real = None
    for t, rank, port, _, arrive, depart in kept:
        real = rank == 2
        if out and out[-1]["port"] == port:
            if real and last_real is not None and (arrive or depart or t) - last_real > dt.timedelta(days=2):
                out.append({"port": None, "start": last_real + minute, "arrive": None, "depart": None, "inferred": True, "rows": 0})
            else:
                p = out[-1]
                if real and p["inferred"]:
                    p["start"], p["inferred"] = t, False
                p["arrive"] = min(filter(None, (p["arrive"], arrive)), default=None)
                p["depart"] = max(filter(None, (p["depart"], depart)), default=None)
                p["rows"] += 1
                last_real = (depart or arrive or t) if real else last_real
                continue
        if not out or out[-1]["port"] != port and out[-1]["port"] is not None or out[-1]["port"] is None and out[-2]["port"] != port:
            last_real = None
        out.append({"port": port, "start": t, "arrive": arrive, "depart": depart, "inferred": not real, "rows": 1})
        last_real = (depart or arrive or t) if real else last_real
    return [tuple(o.values()) for o in out]


def test_itineraries_against_a_loop(spark):
    """One ship has most of the calls, over many pieces of time; short pieces and long ones say the same."""
    rnd = random.Random(4)
    calls = {}
    for ship, n in ((1, 400), (2, 12), (3, 1)):
        t, own = dt.datetime(2023, 1, 1), []
        for _ in range(n):
            t += dt.timedelta(hours=rnd.randrange(2, 300))
            arrival = t if rnd.random() < 0.9 else None
            t += dt.timedelta(hours=rnd.randrange(1, 60))
            departure = t if rnd.random() < 0.9 or arrival is None else None
            own.append((arrival, departure, rnd.choice([None, 0, 1, 2, 3, 4]), rnd.choice([None, 0, 1, 2, 3, 4]), rnd.choice([0, 1, 3, 4])))
        calls[ship] = own
    rows = [(s, a, d, o, x, p) for s, own in calls.items() for a, d, o, x, p in own]
    df = spark.createDataFrame(rows, "ship_key long, arrival timestamp, departure timestamp, origin int, destination int, first_berth int")
    expected = {s: plain_itinerary(own, lambda p: p // 2 if p < 4 else None) for s, own in calls.items()}
    region = F.when(F.col("port") < 4, F.floor(F.col("port") / 2))
    for piece_days in (20, 5000):
        stops = ports.itinerary(df, region, piece_days)
        got = {}
        for r in stops.orderBy("ship_key", "idx").collect():
            got.setdefault(r["ship_key"], []).append(tuple(r[2:]))
        assert got == expected
        assert [r["idx"] for r in stops.where("ship_key = 1").orderBy("idx").collect()] == list(range(1, len(expected[1]) + 1))
    assert any(o[0] is None for o in expected[1])
    legs = ports.itinerary_legs(ports.itinerary(df, region)).where("ship_key = 1").count()
    assert legs == len(expected[1]) - 1
    pieces = df.groupBy("ship_key", F.floor(F.unix_timestamp(F.coalesce("arrival", "departure")) / (60 * 86400))).count()
    assert pieces.agg(F.max("count")).first()[0] < 40


def test_feed_message_by_message(spark):
    messages = [
        {"T": "t", "symbol": "HPG", "matchPrice": 27.5, "matchQtty": 120, "totalVolumeTraded": "18446744073686833152"}, {"T": "te", "symbol": "VN30F1M", "matchQtty": 7}, {"T": "q", "symbol": "HPG", "bid": [{"price": 1.5, "qtty": 3}], "offer": []},
        {"T": "bc", "symbol": "HPG", "time": 1700000000000, "close": "x", "volume": 10.9}, {"T": "b", "symbol": "HPG", "time": 1700000060}, {"T": "f", "symbol": "HPG", "foreignerOrderLimitQuantity": 18446744073686833152, "buyVolume": -3}, {"T": "ii", "indexName": "VN", "Data": [{"symbol": "A", "influence": 0.5}, {"symbol": "B"}]}, {"T": "ii", "indexName": "VN"}, {"T": "?"}, {},
    ]
    path = live.shared_path(spark, "messages")
    rows = [(dt.datetime(2024, 1, 1, 9, k), "c", json.dumps(m)) for k, m in enumerate(messages)] + [(dt.datetime(2024, 1, 1, 10), "c", "broken {")]
    spark.createDataFrame(rows, "ts_recv timestamp, conn string, msg string").repartition(3).write.parquet(path)
    stored = live.demultiplexer(live.file_stream(spark, path, 1))
    tables = {n: [r.asDict() for r in live.feed_table(stored, n).orderBy("ts_recv").collect()] for n in [*live.FEED, "raw_log", "events"]}
    assert {n: len(v) for n, v in tables.items()} == {"market_index": 0, "estimated_index": 0, "ticks": 2, "quotes": 1, "bars_1m": 2, "foreign_flow": 1, "influence": 2, "expected": 0, "secdef": 0, "sessions": 0, "raw_log": 11, "events": 3}
    assert [(t["symbol"], t["price"], t["qty"], t["total_vol"]) for t in tables["ticks"]] == [("HPG", 27.5, 1200, -227184640), ("VN30F1M", None, 7, None)]
    assert (tables["quotes"][0]["bid1"], tables["quotes"][0]["bid1_qty"], tables["quotes"][0]["bid2"], tables["quotes"][0]["ask1"]) == (1.5, 30, None, None)
    assert [(b["t"], b["close"], b["volume"], b["closed"]) for b in tables["bars_1m"]] == [(1700000000, None, 10, True), (1700000060, None, None, False)]
    assert (tables["foreign_flow"][0]["room_limit"], tables["foreign_flow"][0]["buy_vol"]) == (-22718464, -3)
    assert [(i["index_name"], i["symbol"], i["influence"]) for i in tables["influence"]] == [("VN", "A", 0.5), ("VN", "B", None)]
