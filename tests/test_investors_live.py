"""Signals, insiders, drivers, port figures, blocks of months and the live board's overlays by plain loops on small fixtures."""

import datetime as dt
import random
import statistics

import numpy as np
import pandas as pd
import pytest

from quayside.operators import investors, nowcast, ports, signals, statements
from quayside.streaming import overlays

D = dt.date


def days(n, start=D(2020, 1, 1)):
    return [start + dt.timedelta(days=k) for k in range(n)]


def test_signal_table_against_a_loop(spark):
    rng = random.Random(5)
    sessions = [d for d in days(700) if d.weekday() < 5]
    pe = [(d, None if rng.random() < 0.05 else 10 + rng.random() * 5) for d in sessions]
    bars = [(s, d, 100.0 + s + rng.random()) for s in range(4) for d in sessions if rng.random() < 0.9]
    quarters = [D(2019, 12, 31), D(2020, 3, 31), D(2020, 6, 30), D(2020, 9, 30), D(2020, 12, 31), D(2021, 3, 31), D(2021, 6, 30)]
    figures = [(s, q, None if rng.random() < 0.2 else 50.0 + rng.random(), rng.uniform(-5, 5)) for s in range(4) for q in quarters]
    turnover = [(d, 100 * rng.random()) for d in sessions]
    got = signals.signal_table(
        spark.createDataFrame(pe, "date date, pe double"), spark.createDataFrame(bars, "symbol long, date date, cap double"), spark.createDataFrame(figures, "symbol long, quarter_end date, equity double, profit double"),
        spark.createDataFrame(turnover, "date date, value double"), spans=(40, 60), thresholds=(1.0, 1.4), least=3,
    )
    rows = {r["date"]: r for r in got.collect()}
    known = [(d, v) for d, v in pe if v is not None]
    assert min(rows) == known[39][0] and len(rows) == len([d for d in {d for _, d, _ in bars} if d >= known[39][0]])

    def z(values, n):
        return None if len(values) < n else (values[-1] - statistics.mean(values[-n:])) / statistics.stdev(values[-n:])

    lag = dt.timedelta(days=45)
    pb = []
    for d in sessions:
        pairs = []
        for s, _, cap in [b for b in bars if b[1] == d]:
            told = [(q, e) for t, q, e, _ in figures if t == s and e is not None and q + lag <= d]
            if told:
                pairs.append((cap, max(told)[1]))
        if len(pairs) >= 3:
            pb.append((d, sum(c for c, _ in pairs) / sum(e for _, e in pairs)))
    profit = {q: sum(p for _, t, _, p in figures if t == q) for q in quarters}
    by_quarter = {}
    for d, v in turnover:
        total, last = by_quarter.get((d.year, (d.month - 1) // 3), (0, d))
        by_quarter[d.year, (d.month - 1) // 3] = (total + v, max(last, d))
    ordered = [by_quarter[k] for k in sorted(by_quarter)]
    before, seen = None, 0
    for d in sorted(rows):
        r = rows[d]
        values = [v for x, v in known if x <= d]
        zs = [z(values, n) for n in (40, 60)]
        assert (r["pe"], r["z_short"], r["z_long"]) == pytest.approx((values[-1], *zs))
        books = [v for x, v in pb if x <= d]
        assert (r["pb"], r["z_pb"]) == pytest.approx((books[-1] if books else None, z(books, 40) if books else None))
        done = [k for k, (_, last) in enumerate(ordered) if last <= d]
        quiet = bool(done) and done[-1] > 0 and ordered[done[-1]][0] < ordered[done[-1] - 1][0]
        out = [k for k, q in enumerate(quarters) if q + lag <= d]
        qoq = bool(out) and out[-1] >= 1 and profit[quarters[out[-1]]] > profit[quarters[out[-1] - 1]]
        yoy = bool(out) and out[-1] >= 4 and profit[quarters[out[-1]]] > profit[quarters[out[-1] - 4]]
        tier = 2 if quiet and qoq else 1 if quiet and yoy else 0
        low = [any(x is not None and x <= -k for x in zs) for k in (1.0, 1.4)]
        assert (r["quiet"], r["profit_qoq"], r["profit_yoy"], r["tier"]) == (quiet, qoq, yoy, tier)
        assert (r["buy1"], r["buy2"]) == (low[0] and tier >= 1, low[1] and tier >= 2)
        now = quarters[out[-1]] if out else None
        assert r["new_quarter"] == (now if now != before else None) and r["new_rose"] == (now != before and qoq)
        before, seen = now, seen + r["buy1"]
    assert seen > 0


def test_growth_leaves_spikes_out(spark):
    rows = [("a", D(2020, 1, 1), 10.0), ("a", D(2020, 6, 1), 100.0), ("a", D(2020, 9, 1), 11.0), ("a", D(2021, 1, 1), 12.0), ("a", D(2021, 8, 1), None), ("a", D(2021, 9, 2), 22.0)]
    got = {r["date"]: (r["v"], r["v_growth"]) for r in signals.basket_growth(spark.createDataFrame(rows, "k string, date date, v double"), ["k"], ["v"]).collect()}
    assert got[D(2020, 6, 1)] == (None, None) and got[D(2021, 8, 1)] == (None, None)
    assert got[D(2021, 1, 1)] == pytest.approx((12.0, 20.0)) and got[D(2021, 9, 2)] == pytest.approx((22.0, 100.0)) and got[D(2020, 1, 1)] == (10.0, None)
    last = signals.latest_growth(spark.createDataFrame(rows, "k string, date date, v double"), "k", "v", [], "2021-08-31").collect()
    assert [(r["k"], r["v"]) for r in last] == [("a", 12.0)] and last[0]["growth"] == pytest.approx(20.0)


def test_investors_by_hand(spark):
    schema = "code long, date date, buy_val double, sell_val double, net_match double, total_value double, owned double"
    flows = spark.createDataFrame([(1, D(2024, 1, 1), 10.0, 4.0, None, 100.0, None), (1, D(2024, 1, 2), 0.0, 5.0, None, None, 0.1), (1, D(2024, 1, 3), 3.0, 3.0, None, 20.0, 0.3), (2, D(2024, 1, 1), 0.0, 0.0, 1.0, 9.0, 0.2), (3, D(2024, 1, 1), 0.0, 7.0, 2.0, 7.0, None)], schema)
    names = spark.createDataFrame([(k, "X", "s") for k in (1, 2, 3)], "symbol long, exchange string, sector string")
    got = {r["code"]: r for r in investors.drilldown(flows, names).collect()}
    assert set(got) == {1, 3} and (got[1]["net"], got[1]["net_match"], got[1]["up_days"], got[1]["down_days"]) == (1.0, None, 1, 1)
    assert (got[1]["owned_first"], got[1]["owned_last"], got[1]["owned_change"]) == pytest.approx((10.0, 30.0, 20.0)) and got[1]["share"] == pytest.approx(50 * 25 / 120)
    house = spark.createDataFrame([(1, D(2024, 1, 1), 2.0, 1.0), (3, D(2024, 1, 1), 5.0, 0.0), (4, D(2024, 1, 1), 5.0, 5.0)], "code long, date date, buy_val double, sell_val double")
    both = {r["code"]: (r["first"], r["second"], r["total"], r["way"]) for r in investors.two_investors(flows, house).collect()}
    assert both == {1: (1.0, 1.0, 2.0, "same"), 3: (-7.0, 5.0, -2.0, "opposite"), 4: (0.0, 0.0, 0.0, "one side")}


DEAL = "symbol long, person string, role string, kind string, announced date, from_day date, to_day date, plan_buy double, plan_sell double, done_on date, done_buy double, done_sell double, net_volume double, value double"


def deal(symbol, person, value, on, plan=(0.0, 0.0), kind="done", to=D(2024, 2, 1)):
    bought, sold = (10.0, 0.0) if (value or 0) > 0 else (0.0, 10.0)
    return (symbol, person, "", kind, D(2024, 1, 1), D(2024, 1, 2), to, *plan, on, *((bought, sold, bought - sold) if on else (None, None, None)), value)


def test_insiders_by_hand(spark):
    rows = [deal(1, "a", 5.0, D(2024, 1, 5)), deal(1, "b", -9.0, D(2024, 1, 6)), deal(1, "c", 9.0, D(2024, 1, 6)), deal(2, "a", -3.0, D(2024, 1, 5)), deal(2, "a", None, D(2024, 1, 5)), deal(3, "a", 0.04, D(2024, 1, 5)), deal(4, "x", None, None, (100.0, 0.0), "registered"), deal(5, "y", None, None, (0.0, 50.0), "registered", D(2024, 1, 28)), deal(6, "z", None, None, (0.0, 50.0), "registered", D(2024, 1, 27)), deal(7, "z", None, None, (0.0, 0.0), "registered")]
    table = spark.createDataFrame(rows, DEAL)
    market = {r["done_on"]: (r["net"], r["bought"], r["sold"], r["deals"]) for r in investors.deals_by_day(table).collect()}
    assert market == {D(2024, 1, 5): (pytest.approx(2.04), pytest.approx(5.04), -3.0, 3), D(2024, 1, 6): (0.0, 9.0, -9.0, 2)}
    top = [(r["side"], r["symbol"], r["net"], r["person"], r["largest"]) for r in investors.top_deals(table, "2024-01-01", "2024-01-31", 5).collect()]
    assert sorted(top) == [("bought", 1, 5.0, "c", 9.0), ("sold", 2, -3.0, "a", -3.0)]  # equal sizes: the later name; 0.04 is nought
    bars = spark.createDataFrame([(4, D(2024, 1, 30), 2.0), (5, D(2023, 11, 1), 9.0)], "symbol long, date date, close double")
    open_ = {r["symbol"]: r["value"] for r in investors.open_registrations(table, bars, "2024-01-31").collect()}
    assert open_ == {4: 200.0, 5: None}
    months = {r["symbol"]: (r["bought"], r["sold"], r["volume_buy"], r["volume_sell"]) for r in investors.deals_by_month(table).collect()}
    assert months[1] == (14.0, -9.0, 20.0, 10.0) and months[2] == (0.0, -3.0, 0.0, 10.0)


def test_drivers_by_hand(spark):
    sessions = days(12)
    caps = [(d, 1000.0 if k == 11 else 10.0 + k) for k, d in enumerate(sessions)] + [(D(2020, 8, 1), 77.0)]
    flows = [(d, 1.0) for d in sessions] + [(D(2020, 4, 1), 5.0)]
    rates = [("held", D(2020, 1, 3), "a", 4.0), ("held", D(2020, 1, 3), "b", 5.0), ("held", D(2020, 7, 3), "a", 6.0), ("mean", D(2020, 1, 3), "a", 1.0), ("mean", D(2020, 1, 4), "a", 2.0), ("mean", D(2020, 2, 4), "a", None)]
    known = [("flow_net", 2020 * 4 + 1, 9.0), ("flow_net", 2020 * 4, 9.0), ("old", 1, 2.0)]
    got = statements.driver_series(spark.createDataFrame(flows, "date date, net double"), spark.createDataFrame(rates, "series string, date date, source string, value double"), spark.createDataFrame(caps, "date date, cap double"), spark.createDataFrame(known, "series string, t int, value double"), ("held",), 10)
    table = {(r["series"], r["t"] - 2020 * 4): r["value"] for r in got.collect()}
    assert table == pytest.approx({("flow_net", 0): 12.0, ("flow_net", 1): 9.0, ("held", 0): 0.05, ("held", 1): 0.05, ("held", 2): 0.06, ("mean", 0): 0.015, ("cap", 0): 20.0, ("old", 1 - 8080): 2.0})


def test_port_figures_by_hand(spark):
    last = D(2024, 6, 30)
    visits = [("a", "s1", last, 1.0, 10.0), ("a", "s1", last - dt.timedelta(29), 1.0, 20.0), ("a", "s2", last - dt.timedelta(30), 1.0, 6.0), ("a", "s3", last - dt.timedelta(59), 1.0, None), ("a", "s3", last - dt.timedelta(60), 1.0, 99.0), ("a", "s9", last - dt.timedelta(365), 1.0, 1.0), ("b", "s1", last - dt.timedelta(394), 1.0, 1.0), ("c", "s1", last - dt.timedelta(395), 1.0, 1.0)]
    got = {r["k"]: r for r in ports.period_kpis(spark.createDataFrame(visits, "k string, ship string, day date, calls double, hours double"), "k", "day", ["calls"], "hours", "ship", str(last)).collect()}
    a = got["a"]
    assert set(got) == {"a", "b"} and (a["calls_now"], a["calls_before"], a["calls_year_ago"], a["calls_change"], a["calls_yearly"]) == (2.0, 2.0, 1.0, 0.0, 1.0)
    assert (a["hours_now"], a["hours_before"], a["hours_change"], a["ships"]) == (15.0, 6.0, 9.0, 1) and got["b"]["calls_change"] is None


def test_blocks_of_months_against_least_squares(spark):
    rng = np.random.default_rng(3)
    first = 2010 * 12
    h, t = rng.uniform(50, 100, 40), rng.uniform(500, 900, 40)
    y = 4 * h + 1.5 * t + rng.normal(0, 40, 40)
    hidden = set(range(20, 24))
    features = spark.createDataFrame([("a", first + k, float(h[k]), float(t[k]), False) for k in range(40)], "k string, mno int, hours double, teu double, partial boolean")
    actual = spark.createDataFrame([("a", first + k, float(y[k])) for k in range(40) if k not in hidden], "k string, mno int, actual double")
    blocks = spark.createDataFrame([("a", [first + k for k in sorted(hidden)], float(sum(y[k] for k in hidden))), ("a", [first + 39, first + 40], 5.0), ("a", [first], 0.0)], "k string, months array<int>, total double")
    got = {r["mno"] - first: r for r in nowcast.walked(nowcast.training(features, actual, "k"), features, "k", blocks).collect()}
    whole = [k for k in range(40) if k not in hidden]
    for i in range(12, len(whole)):
        now = whole[i]
        for name, n in (("every", i), ("last12", 12), ("last6", 6)):
            used = whole[i - n : i]
            x, z = [[h[k], t[k]] for k in used], [y[k] for k in used]
            if now > 23 and (name == "every" or used[0] <= 20):
                ks = sorted(hidden)
                x.append([2 * np.mean(h[ks]), 2 * np.mean(t[ks])])
                z.append(2 * np.mean(y[ks]))
            c = np.linalg.lstsq(np.array(x), np.array(z), rcond=None)[0]
            if (c < 0).any():
                continue
            ratio = np.mean([y[k] / (c @ [h[k], t[k]]) for k in used[-3:]])
            assert got[now][name] == pytest.approx(c @ [h[now], t[now]] * min(max(ratio, 0.7), 1.4), rel=1e-6)


BOARD = "symbol long, exchange string, sector string, shares double, kind string, price double, ref double, ceiling double, floor double, open double, high double, low double, volume long, value double, buy_val double, sell_val double"


def name(symbol, price, ref, exchange="X", kind="share", shares=1.0, value=10.0, buy=4.0, sell=1.0):
    return (symbol, exchange, "s", shares, kind, price, ref, 11.0, 9.0, price, price, price, 1, value, buy, sell)


def test_overlays_by_hand(spark):
    board = spark.createDataFrame([name(1, 11.0, 10.0), name(2, 9.0, 10.0), name(3, 10.0, 10.0, "Y"), name(4, None, 10.0, "Y", value=None, buy=None, sell=None), name(5, 10.5, 10.0, "Y", "fund"), name(6, 10.5, None, "Y", None)], BOARD)
    totals = {r["exchange"]: r for r in overlays.venue_totals(board, 5, 3).collect()}
    x, y = totals["X"], totals["Y"]
    assert (x["n"], x["advances"], x["declines"], x["unchanged"], x["at_ceiling"], x["at_floor"], x["value"], x["net"], x["basis"]) == (2, 1, 1, 0, 1, 1, 20.0, 6.0, 0.5)
    assert (y["n"], y["advances"], y["unchanged"], y["value"]) == (3, 0, 1, 20.0) and overlays.venue_totals(board, 99, 3).first()["basis"] is None
    counts = overlays.counts_today(board).first()
    assert (counts["adv"], counts["decl"], counts["unch"], counts["traded"], counts["balance"]) == (2, 1, 1, 4, 1)
    history = spark.createDataFrame([(D(2024, 1, k), float(k), None, None) for k in (1, 2, 3, 5)], "date date, total double, ma3 double, ma4 double")
    turn = {r["date"]: r for r in overlays.turnover_today(history, board, "2024-01-05", (3, 4)).collect()}
    assert len(turn) == 4 and turn[D(2024, 1, 5)]["total"] == 50.0 and (turn[D(2024, 1, 5)]["ma3"], turn[D(2024, 1, 5)]["ma4"]) == pytest.approx((55 / 3, 14.0))
    assert overlays.turnover_today(history, board, "2024-01-03", (3, 4)).where("date = '2024-01-03'").first()["ma4"] is None
    flows = spark.createDataFrame([(D(2024, 1, 1), "X", 2.0), (D(2024, 1, 5), "X", 100.0)], "date date, exchange string, net double")
    got = {(r["date"].day, r["exchange"]): (r["net"], r["cumulative"]) for r in overlays.flows_today(flows, board, "2024-01-05").collect()}
    assert got == {(1, "X"): (2.0, None), (5, "X"): (6.0, 8.0), (5, "Y"): (9.0, 9.0)}
    assert overlays.investors_today(board).first().asDict() == {"reported": 12.5, "others": 37.5}
    ratios = {r["exchange"]: r["ratio"] for r in overlays.cap_ratios(board, "exchange", 2).collect()}
    assert ratios == {"X": 1.0, "Y": 1.025} and {r["exchange"]: r["ratio"] for r in overlays.cap_ratios(board, "exchange", 3).collect()} == {"X": None, "Y": None}
    old = spark.createDataFrame([("Y", D(2024, 1, 1), 10.0, 3.0), ("Y", D(2024, 1, 2), None, 4.0), ("Z", D(2024, 1, 2), 1.0, 1.0), ("Y", D(2024, 1, 5), 1.0, 1.0)], "exchange string, date date, pe double, pb double")
    for carried, pe in ((True, 10.25), (False, None)):
        rows = {(r["exchange"], r["date"].day): (r["pe"], r["pb"]) for r in overlays.scaled_today(old, overlays.cap_ratios(board, "exchange", 2), "exchange", ["pe", "pb"], "2024-01-05", carried).collect()}
        assert rows[("Y", 5)] == pytest.approx((pe, 4.1)) and len(rows) == 4
    none = board.where("false")
    assert overlays.turnover_today(history, none, "2024-01-05", (3, 4)).count() == 3 and overlays.counts_today(none).first()["pct_adv"] is None and overlays.venue_totals(none, 1, 2).count() == 0


def test_levels_against_a_loop(spark):
    rng = random.Random(2)
    sessions = days(30)
    bars = [(s, d, 10 + 5 * rng.random()) for s in range(6) for d in sessions if rng.random() < (0.9 if s < 4 else 0.15)]
    board = spark.createDataFrame([name(s, 10 + 5 * rng.random(), 10.0) for s in range(0, 6, 2)], BOARD)
    live = {r["symbol"]: r["price"] for r in board.collect()}
    got = {(r["symbol"], r["w"]): (r["p"], r["ma"]) for r in overlays.levels_today(board, spark.createDataFrame(bars, "symbol long, date date, close double"), "2020-03-01", (5, 10), 3).collect()}
    last = {d for _, d, _ in bars}
    order = sorted(last)
    expected = {}
    for s in range(6):
        own, px = {d: c for t, d, c in bars if t == s}, []
        for k, d in enumerate(order):
            near = [own[x] for x in order[max(0, k - 3) : k + 1] if x in own]
            px.append(near[-1] if near else None)
        p = live.get(s, px[-1])
        for w in (5, 10):
            past = px[-(w - 1) :]
            if p is not None and None not in past and len(past) == w - 1:
                expected[s, w] = (p, (sum(past) + p) / w)
    assert got.keys() == expected.keys() and all(got[k] == pytest.approx(expected[k]) for k in got) and len(got) >= 6
