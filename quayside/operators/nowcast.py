"""Volume nowcasts of terminals: monthly features of visits, walk-forward regressions, ensembles, pooled and shrunk coefficients.

Months are numbered by year * 12 + month - 1 (`mno`). A terminal has a few hundred of them, so its history fits one row:
season factors look values up in maps of it. All terminals go through the same windows and aggregations at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ports import no_intercept

#: Fixed values of the models: rows before the first backtest, windows, months and bounds of the bias factor, recent months,
#: bounds of season factors, quantile of the bands, days from which a running month counts, strength of a prior.
MIN_TRAIN, WINDOWS, BIAS_MONTHS, BIAS_BOUNDS, RECENT = 12, {"every": None, "last12": 12, "last6": 6}, 3, (0.7, 1.4), 6
SEASON_BOUNDS, BAND, LEAST_DAYS, PRIOR = (0.7, 1.35), 0.8, 5, 6.0
#: After every month.
LAST_MONTH = 2**31 - 1


def month_number(day: Column | str) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def month_end(mno: Column) -> Column:
    return F.last_day(F.make_date(F.floor(mno / 12).cast("int"), (mno % 12 + 1).cast("int"), F.lit(1)))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once, however often `use` names it."""
    return F.transform(F.array(value), use)[0]


def clip(value: Column, bounds: tuple[float, float]) -> Column:
    """Null stays null."""
    return once(value, lambda v: F.when(v < bounds[0], bounds[0]).when(v > bounds[1], bounds[1]).otherwise(v))


def month_features(visits: DataFrame, key: str, last_day: Column, lag_days: int = 2, most_hours: float = 80.0, first_day: int = 5) -> DataFrame:
    """Per key and month `calls, teu, hours, days_month, days_obs, partial` from visits (key, day, teu, dwt, hours).

    The last `lag_days` are left out, as ships of theirs haven't left yet. Capacity that is missing comes from the tonnage by
    the key's median ratio; hours of a visit count up to `most_hours`. Months without visits are zero; a first month that
    begins after its day `first_day` is dropped if others follow. The month of the last day is partial unless complete.
    """
    until = F.date_sub(last_day, lag_days)
    seen = visits.where(F.col("day") <= until)
    ratio = seen.where("teu > 0 AND dwt > 0").groupBy(key).agg(F.median(F.col("dwt") / F.col("teu")).alias("_ratio"))
    missing = F.col("teu").isNull() | (F.col("teu") <= 0)
    filled = seen.join(ratio, key, "left").withColumn("teu", F.when(missing & F.col("_ratio").isNotNull(), F.col("dwt") / F.col("_ratio")).otherwise(F.col("teu")))
    per = filled.groupBy(key, month_number("day").alias("mno")).agg(F.count("*").alias("calls"), F.coalesce(F.sum("teu"), F.lit(0.0)).alias("teu"), F.coalesce(F.sum(F.when(F.col("hours") > most_hours, most_hours).otherwise(F.col("hours"))), F.lit(0.0)).alias("hours"))
    ends = seen.groupBy(key).agg(F.min("day").alias("_first"), F.max("day").alias("_last"))
    begin, stop = month_number("_first"), month_number("_last")
    begin = F.when((F.dayofmonth("_first") > first_day) & (stop > begin), begin + 1).otherwise(begin)
    months = ends.select(key, F.explode(F.sequence(begin, stop)).alias("mno"))
    dense = months.join(per, [key, "mno"], "left").na.fill(0, ["calls", "teu", "hours"])
    days = F.dayofmonth(month_end(F.col("mno")))
    observed = F.when(F.col("mno") == month_number(until), F.dayofmonth(until)).otherwise(days)
    out = dense.withColumns({"days_month": days, "days_obs": observed})
    return out.withColumn("partial", F.col("days_obs") < F.col("days_month"))


def training(features: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Whole months with a published figure (key, mno, actual)."""
    return features.where("NOT partial").join(actual, [key, "mno"]).where("actual > 0 AND teu > 0")


def block_rows(features: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
    """Figures known for several months together (key, months, total) as one row per key: `blocks` of first and last month, number
    of months, mean features and mean figure. Blocks with a month that isn't whole or has no capacity don't count."""
    whole = features.where("NOT partial AND teu > 0").select(key, F.col("mno").alias("_m"), "hours", "teu")
    asked = blocks.where("total > 0").withColumn("_k", F.size("months")).withColumn("_m", F.explode("months"))
    found = asked.join(whole, [key, "_m"]).groupBy(key, "months", "total", "_k").agg(F.count("*").alias("_n"), F.avg("hours").alias("h"), F.avg("teu").alias("t")).where("_n = _k")
    each = F.struct(F.array_min("months").alias("first"), F.array_max("months").alias("last"), F.col("_k").cast("double").alias("k"), "h", "t", (F.col("total") / F.col("_k")).alias("y"))
    return found.groupBy(key).agg(F.collect_list(each).alias("blocks"))


def fitted(frame, before: Column | None = None, since: bool = False) -> Column:
    """Coefficients of a frame's months and, where rows have `blocks`, of those that end before `before` and, with `since`, begin in the frame.

    A block of k months counts as k months of its means.
    """
    h, t, y = F.col("hours"), F.col("teu"), F.col("actual")
    sums = [F.sum(e).over(frame) for e in (h * h, h * t, t * t, h * y, t * y)]
    if before is not None:
        begin = F.first("mno").over(frame)
        used = F.filter(F.coalesce("blocks", F.array()), lambda b: (b["last"] < before) & ((b["first"] >= begin) if since else F.lit(True)))

        pairs = (("h", "h"), ("h", "t"), ("t", "t"), ("h", "y"), ("t", "y"))
        none = F.struct(*[F.lit(0.0).alias(a + b) for a, b in pairs])
        added = F.aggregate(used, none, lambda total, x: F.struct(*[(total[a + b] + x["k"] * x[a] * x[b]).alias(a + b) for a, b in pairs]))
        return once(added, lambda more: no_intercept(*[total + more[a + b] for total, (a, b) in zip(sums, pairs)]))
    return no_intercept(*sums)


def bias(coef: Column, at: list[tuple[Column, Column, Column]]) -> Column:
    """Mean of published over modelled of some months (hours, teu, actual) with a positive model, within bounds; 1 without any."""
    told = F.array(*[F.struct((coef["b1"] * h + coef["b2"] * t).alias("m"), y.alias("y")) for h, t, y in at])
    ratios = F.filter(F.transform(told, lambda x: F.when(x["m"] > 0, x["y"] / x["m"])), lambda r: r.isNotNull())
    mean = once(ratios, lambda known: F.try_divide(F.aggregate(known, F.lit(0.0), lambda total, r: total + r), F.size(known)))
    return F.coalesce(clip(mean, BIAS_BOUNDS), F.lit(1.0))


def season_index(features: DataFrame, key: str, least_years: int = 2) -> DataFrame:
    """Per key a map from calendar month (0 to 11) to the season of its capacity: median ratio to the centred mean of twelve months, around 1; keys without all months or years have none."""
    w = Window.partitionBy(key).orderBy("mno").rowsBetween(-6, 5)
    whole = features.where("NOT partial AND teu > 0")
    ratio = F.when(F.count("teu").over(w) == 12, F.col("teu") / F.avg("teu").over(w))
    used = whole.withColumn("r", ratio).where("r > 0.4 AND r < 2.5")
    years = used.groupBy(key).agg(F.countDistinct(F.floor(F.col("mno") / 12)).alias("years"))
    per = used.groupBy(key, (F.col("mno") % 12).alias("m")).agg(F.median("r").alias("s"))
    mean = F.avg("s").over(Window.partitionBy(key))
    whole_year = per.withColumn("s", F.col("s") / mean).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("m", "s"))).alias("season")).where(F.size("season") == 12)
    return whole_year.join(years.where(F.col("years") >= least_years), key, "left_semi")


def year_ago_ratio(history: Column, mno: Column, months: Column) -> Column:
    """Last year's value of a month over the mean of last year's values of others, within bounds; null unless all are known."""
    past = F.transform(months, lambda x: F.try_element_at(history, x - 12))
    mean = once(past, lambda p: F.aggregate(p, F.lit(0.0), lambda s, x: s + x) / F.size(p))  # null where one isn't known
    return once(mean, lambda m: F.when(m > 0, clip(F.try_element_at(history, mno - 12) / m, SEASON_BOUNDS)))


def season_factor(history: Column, season: Column, mno: Column, months: Column) -> Column:
    """Season of a month against others: mean of last year's ratio and of the capacity's index, as far as known, else 1."""
    of = F.transform(months, lambda x: F.try_element_at(season, x % 12))
    mean = once(of, lambda p: F.aggregate(p, F.lit(0.0), lambda s, x: s + x) / F.size(p))
    long = once(mean, lambda m: F.when(m > 0, clip(F.try_element_at(season, mno % 12) / m, SEASON_BOUNDS)))
    both = F.struct(year_ago_ratio(history, mno, months).alias("own"), long.alias("long"))
    return once(both, lambda x: F.coalesce((x["own"] + x["long"]) / 2, x["own"], x["long"], F.lit(1.0)))


def histories(train: DataFrame, key: str) -> DataFrame:
    """Per key the maps of published figures and of their share in capacity, by month."""
    share = F.collect_list(F.struct("mno", (F.col("actual") / F.col("teu")).alias("v")))
    return train.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("mno", "actual"))).alias("history"), F.map_from_entries(share).alias("shares"))


def walked(train: DataFrame, features: DataFrame, key: str, blocks: DataFrame | None = None) -> DataFrame:
    """Backtest months per key, each told from the months before it only, and from `blocks` (see `block_rows`) that ended before it.

    Per window one regression on hours and capacity, times its bias in the last months; the month before (`naive`); the mean
    of the last three times their season (`ma3`); and the mean use of capacity in them, times its season and the month's
    capacity (`use`).
    """
    w = Window.partitionBy(key).orderBy("mno")
    lags = [tuple(F.lag(c, k).over(w) for c in ("hours", "teu", "actual")) for k in range(1, BIAS_MONTHS + 1)]
    out = train.withColumns({"idx": F.row_number().over(w), "rows": F.count("*").over(Window.partitionBy(key)), "naive": lags[0][2]})
    if blocks is not None:
        out = out.join(block_rows(features, blocks, key), key, "left")
    for name, n in WINDOWS.items():
        frame = w.rowsBetween(Window.unboundedPreceding if n is None else -n, -1)
        past = {f"_{c}{k}": value for k, lag in enumerate(lags) for c, value in zip("hty", lag)}
        out = out.withColumns({"_fit": fitted(frame, None if blocks is None else F.col("mno"), n is not None), **past})
        at = [tuple(F.col(f"_{c}{k}") for c in "hty") for k in range(len(lags))]
        out = out.withColumn(name, once(F.col("_fit"), lambda fit: (fit["b1"] * F.col("hours") + fit["b2"] * F.col("teu")) * bias(fit, at))).drop("_fit", *past)
    last3 = w.rowsBetween(-3, -1)
    out = out.withColumns({"_y3": F.avg("actual").over(last3), "_u3": F.avg(F.col("actual") / F.col("teu")).over(last3), "_months": F.collect_list("mno").over(last3)})
    told = out.where((F.col("idx") > MIN_TRAIN) & (F.col("rows") >= MIN_TRAIN + 3)).join(histories(train, key), key).join(season_index(features, key), key, "left")
    use = F.col("_u3") * F.coalesce(year_ago_ratio(F.col("shares"), F.col("mno"), F.col("_months")), F.lit(1.0)) * F.col("teu")
    ma3 = F.col("_y3") * season_factor(F.col("history"), F.col("season"), F.col("mno"), F.col("_months"))
    return told.select(key, "mno", "idx", "rows", "actual", "hours", "teu", *WINDOWS, "naive", ma3.alias("ma3"), F.coalesce(use, ma3).alias("use"))


def backtest(walk: DataFrame, key: str) -> DataFrame:
    """Per key the mean errors of each model over all its backtest months and the last six, and the best regression by the mean of both; then of the ensemble with that."""

    def error(c: Column) -> Column:
        return F.abs(c / F.col("actual") - 1)

    recent = F.col("idx") > F.col("rows") - RECENT
    names = [*WINDOWS, "naive", "use"]
    both = [c for n in names for c in (F.avg(error(F.col(n))).alias(n), F.avg(F.when(recent, error(F.col(n)))).alias(f"{n}_recent"))]
    # The ensemble with each regression, so that the best one's needs no second pass.
    off = {n: error((F.col(n) + F.col("ma3") + F.col("use")) / 3) for n in WINDOWS}
    ensembles = [F.struct(F.avg(e).alias("ensemble"), F.avg(F.when(recent, e)).alias("ensemble_recent"), F.percentile(e, BAND).alias("band")).alias(f"_{n}") for n, e in off.items()]
    means = walk.groupBy(key).agg(*both, *ensembles, F.count("*").alias("months"))
    best = F.array_min(F.array(*[F.struct((F.col(n) / 2 + F.col(f"{n}_recent") / 2).alias("score"), F.lit(k).alias("k"), F.lit(n).alias("n")) for k, n in enumerate(WINDOWS)]))["n"]
    chosen = means.withColumn("best", best)
    own = F.coalesce(*[F.when(F.col("best") == n, F.col(f"_{n}")) for n in WINDOWS])
    return chosen.withColumn("_own", own).select("*", "_own.*").drop("_own", *[f"_{n}" for n in WINDOWS])


def nowcast(features: DataFrame, actual: DataFrame, scores: DataFrame, key: str, blocks: DataFrame | None = None) -> DataFrame:
    """Estimates after the last published month: whole months told by their features, the running month, and the months to the end of the next one's quarter.

    A whole month is the mean of the regression, the last three published figures times their season, and the use of
    capacity times its season and the month's capacity. A month ahead takes the mean features of the last three whole months
    times their season instead. The running month weighs both by its share of days, from `LEAST_DAYS` days on. Bands are the
    backtest's `band`, half as wide again without features, and a quarter wider with each month ahead.
    """
    train = training(features, actual, key)
    w = Window.partitionBy(key).orderBy("mno")
    sums = train.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("mno"))))
    if blocks is not None:
        sums = sums.join(block_rows(features, blocks, key), key, "left")
    for name, n in WINDOWS.items():
        frame = w.rowsBetween(Window.unboundedPreceding if n is None else 1 - n, 0)
        sums = sums.withColumn(name, fitted(frame, None if blocks is None else F.lit(LAST_MONTH), n is not None))
    lags = [tuple(F.col(c) if not k else F.lag(c, k).over(w) for c in ("hours", "teu", "actual")) for k in range(BIAS_MONTHS)]
    sums = sums.join(scores.select(key, "best", "band"), key)
    sums = sums.withColumn("coef", F.coalesce(*[F.when(F.col("best") == n, F.col(n)) for n in WINDOWS]))
    last3 = w.rowsBetween(-2, 0)
    past = {f"_{c}{k}": value for k, lag in enumerate(lags) for c, value in zip("hty", lag)}
    at = [tuple(F.col(f"_{c}{k}") for c in "hty") for k in range(len(lags))]
    sums = sums.withColumns(past).withColumn("adj", once(F.col("coef"), lambda fit: bias(fit, at)))
    sums = sums.withColumns({"y3": F.avg("actual").over(last3), "u3": F.avg(F.col("actual") / F.col("teu")).over(last3), "A": F.collect_list("mno").over(last3)}).where("_r = 1")
    whole = features.where("NOT partial").withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("mno")))).where("_r <= 3")
    base = whole.groupBy(key).agg(F.avg("hours").alias("bh"), F.avg("teu").alias("bt"), F.array_sort(F.collect_list("mno")).alias("B"))
    ends = features.groupBy(key).agg(F.max("mno").alias("cur"))
    known = actual.groupBy(key).agg(F.max("mno").alias("published"))
    per = sums.select(key, "coef", "band", "adj", "y3", "u3", "A").join(base, key).join(ends, key).join(known, key).join(histories(train, key), key).join(season_index(features, key), key, "left")
    # The month after the last one with features, to the end of that one's quarter.
    ahead = per.select(key, F.explode(F.sequence(F.col("cur") + 1, F.floor((F.col("cur") + 1) / 3) * 3 + 2)).alias("mno"))
    shown = features.join(actual, [key, "mno"], "left").join(known, key).where("actual IS NULL AND (partial OR mno > published)").select(key, "mno", "hours", "teu", "days_month", "days_obs", "partial")
    last = shown.join(ends, key).where("NOT partial OR mno = cur").drop("cur")
    rows = last.unionByName(ahead.select(key, F.col("mno").cast("int").alias("mno")), allowMissingColumns=True).join(per, key)
    h, t, mno = F.col("hours"), F.col("teu"), F.col("mno")
    seas_b = season_factor(F.col("history"), F.col("season"), mno, F.col("B"))
    seas_a = season_factor(F.col("history"), F.col("season"), mno, F.col("A"))
    use = F.coalesce(year_ago_ratio(F.col("shares"), mno, F.col("A")), F.lit(1.0)) * F.col("u3")
    plain = (F.col("coef.b1") * F.col("bh") + F.col("coef.b2") * F.col("bt")) * seas_b * F.col("adj")
    calm = F.col("y3") * seas_a
    forecast = (plain + calm + F.col("u3") * F.col("bt") * seas_b) / 3
    weight = F.when(F.col("partial") & (F.col("days_obs") < LEAST_DAYS), 0.0).when(F.col("partial"), F.col("days_obs") / F.col("days_month")).otherwise(1.0)
    # A running month's features are raised to the whole month.
    scale = F.when(F.col("partial"), F.col("days_month") / F.greatest("days_obs", F.lit(1))).otherwise(1.0)
    modelled = (F.col("coef.b1") * h + F.col("coef.b2") * t) * scale * F.col("adj")
    marked = rows.withColumns({"forecast": forecast, "w": F.when(t.isNull(), 0.0).otherwise(weight)})
    regression = F.col("w") * modelled + (1 - F.col("w")) * plain
    third = F.when(t > 0, F.col("w") * use * t * scale + (1 - F.col("w")) * F.col("forecast"))
    told = F.when(third.isNull(), (regression + calm) / 2).otherwise((regression + calm + third) / 3)
    kind = F.when(t.isNull(), "forecast").when(F.col("partial"), "running").otherwise("nowcast")
    out = marked.withColumns({"kind": kind, "est": F.when(t.isNull(), F.col("forecast")).otherwise(told), "h": F.when(t.isNull(), mno - F.col("cur")).otherwise(1)})
    width = F.col("band") * (1.5 - 0.5 * F.col("w")) * (1 + 0.25 * (F.col("h") - 1))
    return out.select(key, month_end(mno).alias("month"), "kind", "est", (F.col("est") * (1 - width)).alias("low"), (F.col("est") * (1 + width)).alias("high"))


def terminal_classes(features: DataFrame, key: str, ship: float = 4000, capacity: float = 50_000, months: int = 12) -> DataFrame:
    """deep: mean ship of `ship` or more; large: `capacity` a month or more; small: the others; by the last whole months."""
    last = features.where("NOT partial").withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("mno")))).where(F.col("_r") <= months)
    size = last.groupBy(key).agg(F.try_divide(F.sum("teu"), F.sum("calls")).alias("ship"), F.avg("teu").alias("capacity"))
    return size.select(key, F.when(F.col("ship") >= ship, "deep").when((F.col("capacity") >= capacity) & F.col("ship").isNotNull(), "large").otherwise("small").alias("class"))


SUMS = {"s11": ("hours", "hours"), "s12": ("hours", "teu"), "s22": ("teu", "teu"), "s1y": ("hours", "actual"), "s2y": ("teu", "actual")}


def pooled(train: DataFrame, classes: DataFrame, key: str, window: int = 12) -> DataFrame:
    """One pair of coefficients per class, and of all keys together (`all`), of the last `window` months of each key with three or more.

    Where a coefficient isn't positive, both are half of what either variable alone gives. Classes of one key have none.
    """
    newest = Window.partitionBy(key).orderBy(F.desc("mno"))
    last = train.withColumns({"_r": F.row_number().over(newest), "_n": F.count("*").over(Window.partitionBy(key))}).where((F.col("_r") <= window) & (F.col("_n") >= 3))
    each = last.join(classes, key).withColumn("class", F.explode(F.array("class", F.lit("all"))))
    sums = each.groupBy("class").agg(F.countDistinct(key).alias("keys"), F.count("*").alias("months"), *[F.sum(F.col(a) * F.col(b)).alias(n) for n, (a, b) in SUMS.items()]).where("keys > 1")
    fit = sums.withColumn("fit", no_intercept(*[F.col(n) for n in SUMS]))
    alone = F.struct((F.col("s1y") / F.col("s11") / 2).alias("b1"), (F.col("s2y") / F.col("s22") / 2).alias("b2"))
    fit = fit.withColumn("fit", F.when((F.col("fit.b1") > 0) & (F.col("fit.b2") > 0), F.col("fit")).otherwise(alone)).select("class", "keys", "months", "fit.b1", "fit.b2")
    error = F.avg(F.abs((F.col("b1") * F.col("hours") + F.col("b2") * F.col("teu")) / F.col("actual") - 1))
    return fit.join(each.join(fit, "class").groupBy("class").agg(error.alias("error")), "class")


def shrunk(train: DataFrame, priors: DataFrame, key: str, strength: float = PRIOR, tries: int = 8) -> DataFrame:
    """A key's own coefficients, drawn to its prior (key, p1, p2) as if by `strength` months of it.

    The pull doubles until both are positive; after `tries` times the prior stands.
    """
    sums = train.groupBy(key).agg(F.count("*").alias("n"), *[F.sum(F.col(a) * F.col(b)).alias(n) for n, (a, b) in SUMS.items()]).join(priors, key)
    r1 = F.col("s1y") - F.col("s11") * F.col("p1") - F.col("s12") * F.col("p2")
    r2 = F.col("s2y") - F.col("s12") * F.col("p1") - F.col("s22") * F.col("p2")
    found = F.struct(F.col("p1").alias("b1"), F.col("p2").alias("b2"), F.lit(None).cast("double").alias("pull"))
    for k in reversed(range(tries)):
        pull = strength * 2**k
        a, d = F.col("s11") * (1 + pull / F.col("n")), F.col("s22") * (1 + pull / F.col("n"))
        det = a * d - F.col("s12") * F.col("s12")
        b1, b2 = F.col("p1") + (r1 * d - r2 * F.col("s12")) / det, F.col("p2") + (r2 * a - r1 * F.col("s12")) / det
        found = F.when((b1 > 0) & (b2 > 0), F.struct(b1.alias("b1"), b2.alias("b2"), F.lit(float(pull)).alias("pull"))).otherwise(found)
    return sums.select(key, "n", found.alias("f")).select(key, "n", "f.b1", "f.b2", "f.pull")
