"""Hand-computed traps and brute-force versions for what SQL would get wrong in the same way, or can't say."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quayside.operators import bonds, clean, joins, macro, market, ports, statements, tables, temporal, text
from quayside.plans import port_plans, text_plans
from quayside.sources.views import port_events


def days(n, first="2024-01-01"):
    start = dt.date.fromisoformat(first)
    return [start + dt.timedelta(days=k) for k in range(n)]


def one(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_asof_never_looks_forward_and_keeps_tolerance(spark):
    left = spark.createDataFrame([("a", d) for d in map(dt.date.fromisoformat, ("2024-01-01", "2024-01-05", "2024-01-15", "2024-01-16"))], "k string, d date")
    right = spark.createDataFrame([("a", dt.date(2024, 1, 5), 1.0), ("b", dt.date(2024, 1, 1), 9.0)], "k string, r date, v double")
    out = temporal.asof_join(left, right, "k", "d", "r", ["v"], tolerance_days=10)
    assert sorted(one(out, "d", "v")) == [(dt.date(2024, 1, 1), None), (dt.date(2024, 1, 5), 1.0), (dt.date(2024, 1, 15), 1.0), (dt.date(2024, 1, 16), None)]


def test_fill_limit_counts_sessions(spark):
    calendar = [("m", d, 1.0) for d in days(23)]
    own = [("x", days(23)[0], 5.0), ("x", days(23)[22], 6.0)]
    grid = market.price_grid(spark.createDataFrame([(s, d, c, 1.0, c) for s, d, c in calendar + own], "symbol string, date date, close double, volume double, value double"))
    px = [r["px"] for r in grid.where("symbol = 'x'").orderBy("date").collect()]
    assert px[:21] == [5.0] * 21 and px[21] is None and px[22] == 6.0


def test_breadth_return_across_a_gap(spark):
    rows = [("m", d, 1.0) for d in days(4)] + [("x", days(4)[0], 5.0), ("x", days(4)[3], 4.0)]
    out = market.breadth(spark.createDataFrame([(s, d, c, 1.0, c) for s, d, c in rows], "symbol string, date date, close double, volume double, value double"))
    last = out.orderBy(F.desc("date")).first()
    assert (last["adv"], last["decl"], last["unch"], last["ad_line"]) == (0, 1, 1, -1)


def test_trailing_sum_needs_contiguity(spark):
    q = [("a", t, v) for t, v in zip((1, 2, 3, 4), (1.0, -2.0, 3.0, 4.0))] + [("b", t, 1.0) for t in (1, 2, 4, 5)]
    df = spark.createDataFrame(q, "k string, t int, v double")
    out = df.select("k", "t", temporal.trailing_sum("v", ["k"], "t").alias("s"))
    assert [r["s"] for r in out.orderBy("k", "t").collect()] == [None, None, None, 6.0, None, None, None, None]


def test_growth_over_absolute_base(spark):
    df = spark.createDataFrame([("a", 1, -10.0), ("a", 2, 5.0)], "k string, t int, v double")
    assert df.select(statements.growth(df, ["k"], "t", "v", 1).alias("g")).collect()[1]["g"] == 1.5


def test_upsert_drops_null_keys_and_is_idempotent(spark):
    old = spark.createDataFrame([(1, 1, "a"), (None, 1, "x"), (2, 1, "b")], "k int, s int, v string")
    new = spark.createDataFrame([(1, 0, "c", 7)], "k int, s int, v string, w int")
    first = tables.upsert(old, new, ["k"], "s")
    assert sorted(one(first, "k", "v", "w")) == [(1, "c", 7), (2, "b", None)]
    again = tables.upsert(first, new, ["k"], "s")
    assert sorted(one(again, "k", "v", "w")) == sorted(one(first, "k", "v", "w"))


def test_archive_nulls_do_not_erase(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, None)], "k string, s int, v double")
    assert one(tables.archive(df, ["k"], "s", ["v"]), "v") == [(5.0,)]


def test_unit_errors_leave_edges(spark):
    rows = [("a", t, v) for t, v in enumerate((1e6, 2.0, 2000.0, 2.0, 100.0))]
    out = clean.unit_errors(spark.createDataFrame(rows, "k string, t int, v double"), ["k"], "t", "v")
    assert [r["what"] for r in out.orderBy("t").collect()] == ["ok", "ok", "fixed", "ok", "ok"]


def test_robust_filter_small_groups_and_zero_spread(spark):
    df = spark.createDataFrame([("a", 10.0)] * 4 + [("a", 12.0), ("b", 10.0), ("b", 19.0)], "k string, v double")
    assert sorted(one(clean.robust(df, ["k"], "v"), "k", "v")) == [("a", 10.0)] * 4 + [("a", 12.0), ("b", 10.0), ("b", 19.0)]


def test_interpolation_is_flat_outside(spark):
    df = spark.range(1).select(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((1.0, 2.0), (3.0, 6.0))]).alias("p"))
    out = df.select(*[temporal.interpolated(F.col("p"), F.lit(x)) for x in (0.5, 2.0, 9.0)]).first()
    assert tuple(out) == (2.0, 4.0, 6.0)


def test_yield_of_a_par_bond_and_without_a_root(spark):
    lots = spark.createDataFrame([(1, 1, dt.date(2020, 1, 1), 12, 0.0, 1.0)], "lot int, issuer int, issue date, months int, coupon double, amount double")
    trades = spark.createDataFrame([(1, 1, dt.date(2020, 1, 1), 90.0, 1.0), (1, 2, dt.date(2020, 1, 1), 1e6, 1.0)], "lot int, line int, date date, price double, traded double")
    got = {r["line"]: r["ytm"] for r in bonds.with_yields(lots, trades).collect()}
    assert got[1] == pytest.approx((100 / 90) ** (365 / 366) - 1, abs=1e-9) and got[2] is None


def test_non_negative_least_squares_boundary(spark):
    # The best second coefficient would be negative.
    rows = [("a", k, float(k), 1.0, 2.0 * k - 1) for k in range(1, 9)]
    df = spark.createDataFrame(rows, "k string, t int, x1 double, x2 double, y double")
    fit = df.agg(ports.no_intercept(*[F.expr(f"sum({e})") for e in ("x1 * x1", "x1 * x2", "x2 * x2", "x1 * y", "x2 * y")]).alias("f")).select("f.*").first()
    expected = sum(r[2] * r[4] for r in rows) / sum(r[2] ** 2 for r in rows)
    assert fit["b2"] == 0 and fit["b1"] == pytest.approx(expected)


def test_weekly_values_split_over_months(spark):
    weeks = spark.createDataFrame([("a", dt.date(2024, 1, 7) + dt.timedelta(days=7 * k), 7.0) for k in range(9)], "k string, e date, v double")
    assert sorted(one(ports.weekly_to_months(weeks, "k", "e", "v"), "month", "value")) == [(dt.date(2024, 1, 31), pytest.approx(31.0)), (dt.date(2024, 2, 29), pytest.approx(29.0))]


def brute_calls(events):
    """Call after call by looking ahead in a ship's ordered events; shares no code with the library."""
    rank, out = {"arrive": 0, "shift": 1, "depart": 2}, []
    events = events[events.section.isin(list(rank))].copy()
    events["rank"] = events.section.map(rank)
    for ship, rows in events.sort_values("event_id").drop_duplicates(["ship_key", "ts", "section", "place_from", "place_to"]).groupby("ship_key"):
        todo = list(rows.sort_values(["ts", "rank", "event_id"]).itertuples())
        while todo:
            arrival = origin = departure = destination = None
            shifts = revisions = 0
            if todo[0].section == "arrive":
                e = todo.pop(0)
                arrival, origin, berths = e.ts, e.place_from, [e.place_to]
                while todo and todo[0].section == "arrive" and (todo[0].place_from, todo[0].place_to) == (origin, berths[0]) and (todo[0].ts - arrival) // pd.Timedelta(days=1) <= 3:
                    arrival, revisions = todo.pop(0).ts, revisions + 1
            else:
                berths = [todo[0].place_from]
            while todo and todo[0].section != "arrive" and (arrival is None or (todo[0].ts - arrival) // pd.Timedelta(days=1) <= 45):
                e = todo.pop(0)
                place = e.place_to if e.section == "shift" else e.place_from
                berths += [place] * (place not in berths)
                if e.section == "depart":
                    departure, destination = e.ts, e.place_to
                    break
                shifts += 1
            status = {(True, True): "complete", (False, True): "no_arrival", (True, False): "no_departure"}.get((arrival is not None, departure is not None)) or ("no_departure" if todo else "shift_only")
            hours = round((departure - arrival) / pd.Timedelta(hours=1), 1) if arrival is not None and departure is not None else None
            out.append((ship, arrival, origin, berths[0], "|".join(map(str, berths)), berths[-1], shifts, departure, destination, hours, status, revisions))
    return out


def call_text(rows):
    def cell(v):
        return "~" if v is None or v is pd.NaT or v is pd.NA or v != v else str(pd.Timestamp(v))[:19] if isinstance(v, (dt.datetime, pd.Timestamp)) else f"{float(v):.1f}" if isinstance(v, (int, float)) or hasattr(v, "dtype") else str(v)

    return sorted(tuple(map(cell, r)) for r in rows)


def day(n, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n, hours=hour)


#: (ship, day, section, from, to): revisions, calls of another berth, origin or after a shift, long stays, lone events.
TRAPS = [
    (1, 0, "arrive", 9, 1), (1, 2, "arrive", 9, 1), (1, 5, "arrive", 9, 1), (1, 6, "shift", 1, 3), (1, 7, "depart", 3, 8),
    (2, 0, "arrive", 9, 1), (2, 2, "arrive", 9, 2), (2, 3, "arrive", 8, 2), (2, 4, "shift", 2, 4), (2, 5, "arrive", 8, 2), (2, 5, "arrive", 8, 2), (2, 51, "depart", 2, 7),
    (3, 0, "shift", 4, 5), (3, 60, "shift", 5, 6), (3, 120, "depart", 6, 2), (3, 121, "depart", 6, 2),
    (4, 0, "shift", 4, 5), (4, 1, "arrive", 1, 1), (4, 46, "depart", 1, 3), (4, 50, "arrive", 2, 2), (4, 96, "shift", 2, 3),
    (5, 0, "shift", 1, 2), (6, 0, "arrive", 1, 2), (6, 4, "arrive", 1, 2), (6, 4, "pass", 1, 2),
]


def test_call_pairing_traps(spark):
    rows = [(k, ship, day(n), section, a, b) for k, (ship, n, section, a, b) in enumerate(TRAPS)]
    events = spark.createDataFrame(rows, "event_id long, ship_key long, ts timestamp, section string, place_from int, place_to int")
    got = [tuple(r) for r in ports.calls_from_events(events).collect()]
    assert call_text(got) == call_text(brute_calls(events.toPandas()))
    by_ship = {s: [r for r in sorted(got, key=lambda r: str(r[1] or r[7])) if r[0] == s] for s in range(1, 7)}
    assert by_ship[1] == [(1, day(5), 9, 1, "1|3", 3, 1, day(7), 8, 48.0, "complete", 2)]
    assert [r[10] for r in by_ship[2]] == ["no_departure", "no_departure", "no_departure", "no_departure", "no_arrival"]
    assert sorted(r[10] for r in by_ship[3]) == ["no_arrival", "no_arrival"] and by_ship[5][0][10] == "shift_only" and by_ship[6][0][10] == "no_departure"
    # The stream's state machine says the same of each ship.
    for ship in range(1, 7):
        machine, out = ports.Pairing(ship), []
        for r in sorted({r[1:]: r for r in rows if r[1] == ship and r[3] != "pass"}.values(), key=lambda r: (r[2], ports.SECTIONS.index(r[3]), r[0])):
            out += machine.take(pd.Timestamp(r[2]), *r[3:])
        out += [machine.close(last=True)] if machine.open else []
        assert call_text(out) == call_text(by_ship[ship])


def test_calls_match_the_plain_loop(spark, sf):
    got = [tuple(r) for r in port_plans.Q["win22_calls"](spark, sf).collect()]
    assert call_text(got) == call_text(brute_calls(port_events(spark, sf).toPandas()))


def test_a_shuffled_and_repeated_stream_gives_the_same_calls(spark):
    """The traps, dealt over six batches with events late by one and repeats, in event-time order again."""
    from quayside.sources.files import shared_path
    from quayside.streaming import live

    rows = [(k, ship, day(n), section, a, b) for k, (ship, n, section, a, b) in enumerate(TRAPS)] + [(100 + k, 7, day(k // 3, 8 * (k % 3)), s, 1 + k % 2, 2 + k % 3) for k, s in enumerate(["arrive", "shift", "depart", "depart", "arrive"] * 12)]
    schema = "event_id long, ship_key long, ts timestamp, section string, place_from int, place_to int"
    expected = call_text([tuple(r) for r in ports.calls_from_events(spark.createDataFrame(rows, schema)).collect()])
    path = shared_path(spark, "dealt")
    span = max(r[2] for r in rows) - day(0)
    parts = [[] for _ in range(7)]
    for r in rows:
        part = int((r[2] - day(0)) / span * 4.99) + (r[0] % 3 == 0)
        parts[part].append(r)
        if r[0] % 4 == 0:
            parts[min(part + 1, 5)].append((r[0] + 10_000, *r[1:]))
    parts[6] = [(-1, -1, day(2000), "arrive", 0, 0)]
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    got = live.replayed_calls(live.file_stream(spark, path, 1), "60 days")
    assert call_text([tuple(r) for r in got.collect()]) == expected


def test_titles_that_share_no_word_and_chains_of_them(spark):
    """Errors in every word, a title that comes again every day for months, and one again after a long time."""
    a, b = "abcdefghi jklmnopqr stuvwxyza bcdefghij klmnopqrs tuvwxyzab", "abcdefghx jklmnopqx stuvwxyzx bcdefghix klmnopqrx tuvwxyzax"
    rows = [(1, a, 10), (2, b, 30), (3, "something else", 11), (4, None, 12), (5, "", 12)] + [(100 + k, f"the same again, part {k}", 24 * k) for k in range(100)] + [(300, "far away in time", 0), (301, "far away in time", 90)]
    got = {r["doc_id"]: r["grp"] for r in text.near_duplicates(spark.createDataFrame(rows, "doc_id long, title string, hour_no long")).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 300: 300, 301: 300} | {100 + k: 100 for k in range(100)}


def distance(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        line, before = [i], line
        for j, y in enumerate(b, 1):
            line.append(min(before[j] + 1, line[-1] + 1, before[j - 1] + (x != y)))
    return line[-1]


def inside(short, long):
    """Fewest edits between a text and any part of another, by the plain table."""
    line = [0] * (len(long) + 1)
    for i, x in enumerate(short, 1):
        line, before = [i], line
        for j, y in enumerate(long, 1):
            line.append(min(before[j] + 1, line[-1] + 1, before[j - 1] + (x != y)))
    return min(line)


def test_edits_inside_against_the_plain_table():
    import random

    rnd = random.Random(7)
    for _ in range(300):
        short, long = ("".join(rnd.choice("abc") for _ in range(rnd.randrange(1, n))) for n in (70, 90))
        assert text.edits_inside(short, long) == inside(short, long)


def first_matches(rows):
    """Groups by the rule, one title after the other: the most similar of the 36 hours before, else one it stands within."""
    group, seen = {}, []
    for hour, i, k in sorted(rows):
        near = [(h, j, m) for h, j, m in seen if hour - h <= 36 and k and m]
        like = [(-(1 - distance(k, m) / max(len(k), len(m))), h, j) for h, j, m in near]
        alike = [x for x in like if -x[0] >= 0.86]
        if not alike:
            within = {j for h, j, m in near if min(len(k), len(m)) >= 40 and inside(*sorted((k, m), key=len)) <= 0.05 * min(len(k), len(m)) + 1e-9}
            alike = [x for x in like if x[2] in within]
        group[i] = group[min(alike)[2]] if alike else (k[:90] if k else i)
        seen.append((hour, i, k))
    first = {}
    for i in sorted(group):
        first.setdefault(group[i], i)
    return {i: first[g] for i, g in group.items()}


def test_titles_within_others(spark):
    short = "a title of more than forty letters that stays"
    rows = [(1, short, 0), (2, short.replace("forty", "fxrty") + " and goes on and on with many more words about it all", 5), (3, "before it all " * 3 + short, 7), (4, "a short one", 8), (5, "a short one that is longer", 9), (6, short, 60), (7, short + " and goes on and on with many more words about it all", 70)]
    got = {r["doc_id"]: r["grp"] for r in text.near_duplicates(spark.createDataFrame(rows, "doc_id long, title string, hour_no long")).collect()}
    assert got == first_matches([(h, i, k) for i, k, h in rows]) and got[2] == got[3] == 1 and got[5] == 5


def test_nearest_in_time_within_the_tolerance(spark):
    left = spark.createDataFrame([(k, "x", day(0, 7 * k)) for k in range(30)], "id int, k string, t timestamp")
    right = spark.createDataFrame([("x", day(0, 11 * k), k) for k in range(9)] + [("y", day(0), 99)], "k string, r timestamp, v int")
    for r in temporal.nearest_join(left, right, "k", "id", "t", "r", ["v"], 0.25).collect():
        near = sorted((abs(11 * k - 7 * r["id"]), 11 * k, k) for k in range(9) if abs(11 * k - 7 * r["id"]) <= 6)
        assert r["v"] == (near[0][2] if near else None)


def test_ranges_and_means_of_the_last_rows(spark):
    import random

    rnd = random.Random(2)
    rows = [(s, k, None if rnd.random() < 0.2 else float(rnd.randrange(50))) for s in "ab" for k in range(37)]
    df = spark.createDataFrame(rows, "s string, k int, v double")
    out = temporal.with_running_means(temporal.with_range(df, "v", "s", "k", 7, "lo", "hi", "n"), "v", "s", "k", {"m": 5})
    for r in out.collect():
        last = [v for s, k, v in rows if s == r["s"] and r["k"] - 7 < k <= r["k"] and v is not None]
        five = [v for s, k, v in rows if s == r["s"] and r["k"] - 5 < k <= r["k"] and v is not None]
        assert (r["lo"], r["hi"], r["n"]) == (min(last, default=None), max(last, default=None), len(last))
        assert r["m"] == (pytest.approx(sum(five) / 5) if len(five) == 5 else None)


def test_derived_series_of_a_name_among_many(spark):
    """Ten thousand other series change nothing, and none is looked through for its name."""
    many = spark.range(10_001).select(F.concat(F.lit("s"), F.col("id")).alias("series_id"), F.lit(dt.date(2024, 1, 1)).alias("date"), F.col("id").cast("double").alias("value"))
    assert one(macro.derived(many, {"x": ("s10000", "greatest(s10000, s3) - s9999")}), "value") == [(1.0,)]


def test_near_duplicate_titles_against_a_loop(spark, sf):
    from quayside.functions.text import key
    from quayside.sources.views import headlines

    titles = headlines(spark, sf).unionByName(headlines(spark, sf).withColumns({"doc_id": F.col("doc_id") + 1000, "hour_no": F.col("hour_no") + 30, "title": F.concat(F.substring("title", 1, 25), F.lit("x"), F.substring("title", 26, 99))}))
    got = {r["doc_id"]: r["grp"] for r in text.near_duplicates(titles).collect()}
    assert got == first_matches([(r["hour_no"], r["doc_id"], r["k"]) for r in titles.select("doc_id", "hour_no", key(F.col("title")).alias("k")).collect()])


def test_port_clusters_against_a_loop(spark, sf):
    """A set joins the most similar leader, not the first one that is similar enough."""
    rows = text_plans.Q["txt10_port_clusters"](spark, sf).toPandas()
    ordered = sorted(rows.itertuples(), key=lambda r: (-r.freq, r.ports))
    leaders, expected = [], {}
    for r in ordered:
        own = set(r.ports.split("|"))
        score = [(len(own & other) / len(own | other), -k, name) for k, (name, other) in enumerate(leaders)]
        if score and max(score)[0] >= 0.6:
            expected[r.ports] = max(score)[2]
        else:
            leaders.append((r.ports, own))
            expected[r.ports] = r.ports
    assert dict(zip(rows.ports, rows.cluster)) == expected


def test_a_set_joins_the_most_similar_leader(spark):
    """1|2|3|4|5 and 1|2|3|6|7 lead; 1|2|3|6|7|8 is nearer to the second, though the first is similar enough for a low bound."""
    rows = [("1|2|3|4|5",)] * 3 + [("1|2|3|6|7",)] * 2 + [("1|2|3|6|7|8",)]
    got = {r["ports"]: r["cluster"] for r in text.port_clusters(spark.createDataFrame(rows, "ports string"), 0.375).collect()}
    assert got == {"1|2|3|4|5": "1|2|3|4|5", "1|2|3|6|7": "1|2|3|4|5", "1|2|3|6|7|8": "1|2|3|4|5"}
    got = {r["ports"]: r["cluster"] for r in text.port_clusters(spark.createDataFrame(rows, "ports string"), 0.43).collect()}
    assert got == {"1|2|3|4|5": "1|2|3|4|5", "1|2|3|6|7": "1|2|3|6|7", "1|2|3|6|7|8": "1|2|3|6|7"}


def test_keyword_counts_once_per_field_longest_first(spark):
    kw = spark.createDataFrame([("oil", "e", 1.0, False), ("crude oil", "e", 3.0, False), ("Oil", "n", 5.0, True), ("rude", "x", 9.0, False)], "keyword string, category string, weight double, exact boolean")
    docs = spark.createDataFrame([(1, "Crude oil, crude oil", "oil oil"), (2, "nothing", "here"), (3, "crude oil and oil", None), (4, "", "The Oil, boiling"), (5, None, None)], "doc_id int, title string, lead string")
    got = {r["doc_id"]: (r["categories"], r["main"], r["score"]) for r in text.tagged(docs, kw, 1.0).collect()}
    # In 3 the shorter one stands alone elsewhere, so it counts; in 4 once as it is and once normalised.
    assert got == {1: ("e", "e", 7.0), 3: ("e", "e", 8.0), 4: ("e,n", "n", 5.0)}


def test_phrases_against_plain_counts(spark, sf):
    from collections import Counter

    docs = text_plans.mined(spark, sf)
    rows = [r["words"].split(" ") for r in docs.collect() if r["words"]]
    df = Counter(p for w in rows for p in {" ".join(w[i : i + n]) for n in (2, 3, 4) for i in range(len(w) - n + 1)})
    df = {p: n for p, n in df.items() if n >= 4}
    longer = {}
    for p, n in df.items():
        w = p.split(" ")
        if len(w) > 2:
            for part in (" ".join(w[1:]), " ".join(w[:-1])):
                longer[part] = max(longer.get(part, 0), n)
    expected = {p: n for p, n in df.items() if longer.get(p, 0) < 0.8 * n}
    assert {r["phrase"]: r["df"] for r in text.phrases(docs, 4).collect()} == expected


def test_names_and_aliases_without_all_pairs(spark):
    aliases = [("alpha bank", "A"), ("alpha", "S"), ("betaworks", "B"), ("", "none"), ("ab", "short")]
    names = ["the alpha bank of x", "alpha", "alpah bank", "betawrks", "gamma", "", None, "ac"]
    got = {r["name"]: r["canonical"] for r in joins.canonical_names(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame(aliases, "alias string, canonical string"), 0.8).collect()}
    assert got == {"the alpha bank of x": "A", "alpha": "S", "alpah bank": "A", "betawrks": "B", "gamma": None, "": None, None: None, "ac": None}


def series(spark, named):
    return spark.createDataFrame([(e, t, float(v)) for e, values in named.items() for t, v in enumerate(values) if v is not None], "e string, t int, v double")


def test_renames_need_every_common_period(spark):
    """Eight equal and five unlike periods are no rename; values 0.002 apart are equal wherever rounding puts them."""
    base = [100.0 * k + 0.0049 for k in range(1, 14)]
    named = {"a": base, "b": base[:8] + [v + 1 for v in base[8:]], "c": [v + 0.002 for v in base], "d": [0.0] * 13, "e": [0.0] * 13, "f": base[:7] + [None] * 6}
    files = spark.createDataFrame([(e, dt.date(2024, 1, k)) for k, e in enumerate("cabdef", 1)], "e string, file_date date")
    got = {(r["old"], r["new"], r["common"], r["current"]) for r in joins.renamed(series(spark, named), files, "e", "t", "v").collect()}
    assert got == {("c", "a", 13, "a")}


def test_renames_form_chains_and_copies_one_line(spark):
    """Six equal series are a line by age, not fifteen pairs; each ends at the newest."""
    named = {f"n{k}": [float(3 * t + 1) for t in range(9)] for k in range(6)}
    files = spark.createDataFrame([(f"n{k}", dt.date(2024, 1, 1 + k)) for k in range(6)], "e string, file_date date")
    got = sorted((r["old"], r["new"], r["current"]) for r in joins.renamed(series(spark, named), files, "e", "t", "v").collect())
    assert got == [(f"n{k}", f"n{k + 1}", "n5") for k in range(5)]


def test_back_adjustment_by_hand(spark):
    d = days(6)
    source = spark.createDataFrame([("x", d[k], c, r) for k, (c, r) in enumerate([(10.0, None), (10.0, 10.0), (8.0, 8.0), (8.0, 8.0), (4.0, 4.0), (4.0, 4.01)])] + [("y", d[0], 5.0, 5.0), ("y", d[1], 5.0, 4.0)], "symbol string, date date, close double, ref double")
    other = spark.createDataFrame([("x", d[1], 5.0), ("x", d[2], 8.0)], "symbol string, date date, close double")
    venues = spark.createDataFrame([("x", "main"), ("y", "side")], "symbol string, exchange string")
    got = {(r["symbol"], r["date"]): r["factor"] for r in market.back_adjusted(source, other, venues, ("main",)).collect()}
    # 0.5 back and on the first common day, 1.0 from the second; the halving at the fifth day is an event, one of 0.25 % is none; y's venue has no events.
    expected = {("x", d[0]): 0.25, ("x", d[1]): 0.25, ("x", d[2]): 0.5, ("x", d[3]): 0.5, ("x", d[4]): 1.0, ("x", d[5]): 1.0, ("y", d[0]): 1.0, ("y", d[1]): 1.0}
    assert got == pytest.approx(expected)


def test_asof_by_pieces_spreads_a_hot_key(spark):
    """A key of most rows is as many windows as it has pieces, and finds the same."""
    n = 6000
    left = spark.range(n).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") * 7 % 5000).cast("int")).alias("d"), "id")
    right = spark.range(400).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), F.date_add(F.lit("2000-02-01").cast("date"), (F.col("id") * 11 % 4000).cast("int")).alias("r"), F.col("id").alias("v")).dropDuplicates(["k", "r"])
    none = spark.createDataFrame([(None, dt.date(2001, 1, 1), -1)], "k string, d date, id long")
    nothing = spark.createDataFrame([(None, dt.date(2000, 6, 1), -2)], "k string, r date, v long")
    left, right = left.unionByName(none), right.unionByName(nothing)
    whole = temporal.asof_join(left, right, "k", "d", "r", ["v"], matched_time="m")
    dealt = temporal.asof_join(left, right, "k", "d", "r", ["v"], matched_time="m", piece_days=90)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, whole.collect()))
    sizes = [r["n"] for r in left.groupBy("k", F.floor(F.unix_date("d") / 90)).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < n / 40


def test_derived_series_only_where_the_main_input_has_one(spark):
    rows = [("a", days(3)[0], 1.0), ("b", days(3)[1], 5.0), ("a", days(3)[2], 2.0)]
    out = macro.derived(spark.createDataFrame(rows, "series_id string, date date, value double"), {"x": ("a", "a + b")})
    assert one(out, "date", "value") == [(days(3)[2], 7.0)]


def test_ambiguous_codes_need_their_context_right_before_them(spark):
    """A context word elsewhere in the text, too far away or behind the code doesn't count; any place of the code may."""
    rows = [(1, "share La rose"), (2, "La rose, a share of it"), (3, "share of a company named La rose"), (4, "La share La"), (5, None), (6, ""), (7, "Xy La"), (8, "Ab Cd Ef Gh Ij Kl".replace(" ", " , "))]
    docs = spark.createDataFrame(rows, "doc_id long, t string")
    got = one(text.mentions(docs, "t", "[A-Z][a-z]", ["La"], "share"), "doc_id", "code", "weight")
    assert sorted(got) == [(1, "La", 1.0), (4, "La", 1.0), (7, "Xy", 1.0), *[(8, c, 0.5) for c in ("Ab", "Cd", "Ef", "Gh", "Ij", "Kl")]]
