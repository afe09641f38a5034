"""Cleaning and data-quality operators: repairs, outlier filters, gates, consistency checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import checkpointed


def unit_scale(value: Column, volume: Column, limit: float = 100, scale: float = 1e6) -> Column:
    """Values that are more than `limit` times the volume are in raw currency: divided by `scale`."""
    return F.when(F.try_divide(value, volume) > limit, value / scale).otherwise(value)


def repaired(df: DataFrame, key: str, value: str, low: float, high: float) -> DataFrame:
    """Implausible values become the median of the entity's plausible ones (null if it has none)."""
    good = F.col(value).between(low, high)
    medians = df.where(good).groupBy(key).agg(F.median(value).alias("_median"))
    return df.join(medians, key, "left").withColumn("repaired", F.when(good, F.col(value)).otherwise(F.col("_median"))).drop("_median")


def despiked(df: DataFrame, key: str | list[str], order: str, value: str, tolerance: float) -> DataFrame:
    """Without the points that deviate by more than `tolerance` from both neighbours."""
    w = Window.partitionBy(key).orderBy(order)
    spike = [F.abs(F.try_divide(F.col(value), f(value).over(w)) - 1) > tolerance for f in (F.lag, F.lead)]
    return df.withColumn("_spike", F.coalesce(spike[0] & spike[1], F.lit(False))).where("NOT _spike").drop("_spike")


def corrected(df: DataFrame, fixes: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Fixes (keys, wrong, right) apply only where the value still is the known wrong one."""
    same = F.abs(F.col(value) - F.col("wrong")) <= 1e-6 * F.greatest(F.abs("wrong"), F.lit(1.0))
    joined = df.join(fixes, keys, "left")
    return joined.withColumn("fixed", F.coalesce(same, F.lit(False))).withColumn(value, F.when(F.col("fixed"), F.col("right")).otherwise(F.col(value))).drop("wrong", "right")


def unit_errors(facts: DataFrame, keys: list[str], t: str, value: str, low: float = 500, high: float = 5000, flag: float = 30, least: float = 100, absurd: float = 100_000) -> DataFrame:
    """Values a thousand times the median of both adjacent periods: repaired from `low` to `high` times, and from 100 times on if they reach
    the `absurd` level; flagged from `flag` times on. Values below `least` are left alone.

    The neighbours must be the periods right before and after; the first and last periods stay untouched.
    """
    w = Window.partitionBy(*keys).orderBy(t)
    adjacent = (F.lag(t).over(w) == F.col(t) - 1) & (F.lead(t).over(w) == F.col(t) + 1)
    base = (F.abs(F.lag(value).over(w)) + F.abs(F.lead(value).over(w))) / 2
    ratio = F.when(adjacent & (base > 0) & (F.abs(value) >= least), F.abs(value) / base)
    what = F.when(ratio.between(low, high) | ((ratio >= 100) & (F.abs(value) >= absurd)), "fixed").when(ratio >= flag, "review").otherwise("ok")
    return facts.withColumn("ratio", ratio).withColumn("what", what).withColumn("value_fixed", F.when(F.col("what") == "fixed", F.col(value) / 1000).otherwise(F.col(value)))


#: Groups whose figures are sent to all tasks, at most; more are joined by shuffles.
MOST_GROUPS = 200_000
#: Of a group's rows a sketch of quantiles misplaces one in so many at most.
SKETCH = 10_000


def medians(df: DataFrame, keys: list[str], value: str, name: str, count: str) -> DataFrame:
    """Per group, kept as a table of one row each: the exact median of its values and their number.

    A sketch gives two bounds that the median lies between; values below are only counted, and only those between, a
    thousandth or so, are shuffled. Ranks say whether the bounds held: where they did not, all values of the group are taken.
    """
    values = df.select(*keys, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    bounds = values.groupBy(*keys).agg(F.percentile_approx("_v", [0.5 - 3 / SKETCH, 0.5 + 3 / SKETCH], SKETCH).alias("_b"))
    bounds = checkpointed(bounds)
    low, high = F.col("_b")[0], F.col("_b")[1]
    part = F.when(F.col("_v") < low, 0).when(F.col("_v") <= high, 1).otherwise(2)
    counted = with_figures(values, bounds, keys).groupBy(*keys, part.alias("_part"), F.when(part == 1, F.col("_v")).alias("_at")).agg(F.count("*").alias("_k"))
    group = Window.partitionBy(*keys)
    upto = F.sum("_k").over(group.orderBy("_part", "_at").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.select(*keys, "_part", "_at", upto.alias("_upto"), F.sum("_k").over(group).alias("_n"))
    # The first value whose rank reaches that of each middle row; rows are numbered from 1.
    row = F.struct("_part", "_at")
    middle = [F.min(F.when(F.col("_upto") >= F.floor((F.col("_n") + k) / 2), row)) for k in (1, 2)]
    found = ranked.groupBy(*keys).agg(F.max("_n").alias(count), *[m.alias(f"_m{k}") for k, m in enumerate(middle)])
    a, b = F.col("_m0._at"), F.col("_m1._at")
    held = (F.col("_m0._part") == 1) & (F.col("_m1._part") == 1)
    out = checkpointed(found.select(*keys, F.when(held, F.when(a == b, a).otherwise(0.5 * a + 0.5 * b)).alias(name), count))
    open_ = out.where(F.col(name).isNull())
    if open_.isEmpty():
        return out
    rest = values.join(open_.select(*keys), keys, "left_semi").groupBy(*keys).agg(F.median("_v").alias(name), F.count("*").alias(count))
    return checkpointed(out.where(F.col(name).isNotNull()).unionByName(rest))


def with_figures(df: DataFrame, figures: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with their group's figures, a kept table of one row per group; rows stay where they are while groups are few."""
    return df.join(F.broadcast(figures) if figures.count() <= MOST_GROUPS else figures, keys)


def robust(df: DataFrame, keys: list[str], value: str, low: float = 0.5, high: float = 2.0, width: float = 3.5, least: int = 4) -> DataFrame:
    """Within [low, high] times the median, then within `width` robust deviations, if at least `least` rows are left.

    Medians are made group by group as tables, so rows are not shuffled by group, and a large group is no task of its own.
    """
    first = with_figures(df, medians(df, keys, value, "_m", "_all"), keys).where(F.col(value).between(low * F.col("_m"), high * F.col("_m"))).drop("_m", "_all")
    centred = with_figures(first, medians(first, keys, value, "_c", "_n"), keys).withColumn("_d", F.abs(F.col(value) - F.col("_c")))
    spread = medians(centred, keys, "_d", "_s", "_all")
    keep = (F.col("_n") < least) | (F.col("_s") == 0) | (F.col("_d") <= width * (1.4826 * F.col("_s")))
    return with_figures(centred, spread, keys).where(keep).drop("_c", "_n", "_d", "_s", "_all")


def trimmed(df: DataFrame, keys: list[str], value: str, width: float = 1.5, least: int = 5, left: int = 2) -> DataFrame:
    """Within `width` quartile ranges of the quartiles, for groups of at least `least`; never below `left` rows."""
    quarts = df.groupBy(*keys).agg(F.percentile(value, 0.25).alias("_q1"), F.percentile(value, 0.75).alias("_q3"), F.count("*").alias("_n"))
    reach = width * (F.col("_q3") - F.col("_q1"))
    inside = df.join(quarts, keys).withColumn("_in", (F.col("_n") < least) | F.col(value).between(F.col("_q1") - reach, F.col("_q3") + reach))
    kept = inside.groupBy(*keys).agg(F.count_if("_in").alias("_kept"))
    return inside.join(kept, keys).where(F.col("_in") | (F.col("_kept") < left)).select(*df.columns)


def holdings_volume(before: Column, after: Column, stated: Column) -> Column:
    """The volume that the holdings imply, if it contradicts the stated one."""
    implied = F.abs(after - before)
    return F.when(stated.isNull() | (stated <= 0) | (F.greatest(stated, implied) > 1.01 * F.least(stated, implied)), implied).otherwise(stated)


def whole_periods(df: DataFrame, period: Column, date: str, measures: list[Column]) -> DataFrame:
    """Sums by period without the first one if it is partial; the running one is marked."""
    bounds = df.agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    summed = df.groupBy(period.alias("period")).agg(*measures)
    marked = summed.join(F.broadcast(bounds)).withColumn("running", F.last_day("_hi") == F.last_day("period"))
    return marked.where((F.trunc("period", "month") >= F.trunc("_lo", "month")) & ((F.trunc("period", "month") > F.col("_lo")) | (F.trunc("_lo", "month") == F.col("_lo")))).drop("_lo", "_hi")


def converted(series: DataFrame, units: DataFrame) -> DataFrame:
    """Values times the factor from their unit to the target; units without a factor stay null. Units is a small table."""
    return series.join(units, "unit", "left").withColumn("converted", F.col("value") * F.col("factor"))


def completeness(facts: DataFrame, keys: list[str], t: str, item: str, share: float = 0.9) -> DataFrame:
    """Items per entity and period against the period before; incomplete below `share`."""
    n = facts.groupBy(*keys, t).agg(F.countDistinct(item).alias("items"))
    before = F.lag("items").over(Window.partitionBy(*keys).orderBy(t))
    return n.withColumn("before", before).withColumn("incomplete", F.coalesce(F.col("items") < share * F.col("before"), F.lit(False)))


def identity_gap(facts: DataFrame, keys: list[str], item: str, value: str, total: str, parts: list[str]) -> DataFrame:
    """An identity per key: one item against the sum of others."""
    side = F.sum(F.when(F.col(item) == total, F.col(value)))
    others = F.sum(F.when(F.col(item).isin(parts), F.col(value)))
    out = facts.groupBy(*keys).agg(side.alias("total"), others.alias("parts"))
    return out.withColumn("balanced", F.abs(F.col("total") - F.col("parts")) <= 0.015 * F.abs("total"))


def formula_checks(facts: DataFrame, formulas: DataFrame, keys: list[str], item: str, value: str) -> DataFrame:
    """Formulas such as "a = b + c - d" over items: the computed sum against the stated value, per key."""
    terms = F.expr(r"regexp_extract_all(formula, '(^|[=+-])\\s*([^=+-]+)', 0)")
    parsed = formulas.select("formula", F.posexplode(terms).alias("k", "term"))
    parsed = parsed.select("formula", "k", F.trim(F.regexp_replace("term", "^[=+-]", "")).alias(item), F.when(F.col("term").startswith("-"), -1).otherwise(1).alias("sign"))
    joined = facts.join(parsed, item)
    stated, computed = F.sum(F.when(F.col("k") == 0, F.col(value))), F.sum(F.when(F.col("k") > 0, F.col("sign") * F.col(value)))
    out = joined.groupBy("formula", *keys).agg(stated.alias("stated"), computed.alias("computed"))
    return out.withColumn("matches", F.abs(F.col("stated") - F.col("computed")) <= 0.005 * F.abs("stated"))


def year_chain(facts: DataFrame, keys: list[str], year: str, value: str, prior: str) -> DataFrame:
    """How often the prior-year figure of year N is the figure of year N - 1."""
    last = facts.select(*keys, (F.col(year) + 1).alias(year), F.col(value).alias("_last"))
    joined = facts.join(last, [*keys, year])
    match = F.abs(F.col(prior) - F.col("_last")) <= 1e-6 * F.greatest(F.abs("_last"), F.lit(1.0))
    return joined.groupBy(year).agg(F.count("*").alias("pairs"), F.count_if(match).alias("matches"))


def layouts(facts: DataFrame, entity: str, period: str, item: str) -> DataFrame:
    """Whether all periods of an entity list the same items: number of different layouts."""
    each = facts.groupBy(entity, period).agg(F.sha1(F.array_join(F.array_sort(F.collect_set(item)), "|")).alias("layout"))
    return each.groupBy(entity).agg(F.countDistinct("layout").alias("layouts"), F.count("*").alias("periods"))


def against_expected(got: DataFrame, expected: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """Values against expected samples: missing, unexpected (expected blank), different or ok."""
    joined = got.withColumnRenamed("value", "_got").join(expected.withColumn("_is", F.lit(True)), keys, "full_outer")
    near = F.abs(F.col("_got") - F.col("expected")) <= tolerance * F.greatest(F.abs("expected"), F.lit(1.0))
    verdict = F.when(F.col("_is").isNull(), "extra").when(F.col("expected").isNull(), F.when(F.col("_got").isNull(), "ok").otherwise("unexpected")).when(F.col("_got").isNull(), "missing").when(near, "ok").otherwise("different")
    return joined.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


def best_version(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One version per key: the largest by the given order."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_row")).select("_row.*")
