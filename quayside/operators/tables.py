"""Maintenance of long tables: upserts, block replacement, archives, slowly changing masters, unpivots, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Old and new rows by key, keeping the new batch's row, then the largest `order`; null keys go, new columns fill.

    Nested maxima instead of a sort: the aggregation combines before it shuffles.
    """
    both = old.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)), allowMissingColumns=True)
    both = both.dropna(subset=keys)
    columns = [c for c in both.columns if c != "_batch"]
    return both.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct("_batch", order)).alias("_row")).select("_row.*")


def replace_blocks(old: DataFrame, new: DataFrame, block: list[str]) -> DataFrame:
    """New blocks replace old blocks whole."""
    return old.join(new.select(*block).distinct(), block, "left_anti").unionByName(new, allowMissingColumns=True)


def prefer_live(pipeline: DataFrame, live: DataFrame, keys: list[str]) -> DataFrame:
    """Live rows replace pipeline rows with the same key."""
    return pipeline.join(live.select(*keys).distinct(), keys, "left_anti").unionByName(live)


def prefer_live_range(pipeline: DataFrame, live: DataFrame, key: str, date: str) -> DataFrame:
    """Per key, live rows inside their own first and last dates; pipeline rows before and after."""
    bounds = live.groupBy(key).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    outside = pipeline.join(bounds, key, "left").where(F.col("_lo").isNull() | (F.col(date) < F.col("_lo")) | (F.col(date) > F.col("_hi")))
    return outside.drop("_lo", "_hi").unionByName(live)


def merge_articles(rows: DataFrame, key: str, seen: str, tag: str, lead: str) -> DataFrame:
    """First-seen row per key, all tags, and the earliest non-null lead."""
    first_lead = F.min_by(lead, F.when(F.col(lead).isNotNull(), F.col(seen)))
    return rows.groupBy(key).agg(F.min(seen).alias("first_seen"), F.array_join(F.array_sort(F.collect_set(tag)), ",").alias("tags"), first_lead.alias("lead"), F.count("*").alias("times"))


def archive(snapshots: DataFrame, keys: list[str], snapshot: str, columns: list[str]) -> DataFrame:
    """Per key and column the value of the newest snapshot that had one: nulls never erase."""
    return snapshots.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(snapshot))).alias(c) for c in columns])


def change_log(old: DataFrame, new: DataFrame, key: str, watched: list[str]) -> DataFrame:
    """One row per watched field that differs, null-safe; whole rows that came or went are marked."""
    o = old.select(key, F.lit(True).alias("_o"), *[F.col(c).alias(f"_o_{c}") for c in watched])
    n = new.select(key, F.lit(True).alias("_n"), *[F.col(c).alias(f"_n_{c}") for c in watched])
    both = o.join(n, key, "full_outer")
    kind = F.when(F.col("_o").isNull(), "new").when(F.col("_n").isNull(), "gone").otherwise("changed")
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"_o_{c}").cast("string").alias("before"), F.col(f"_n_{c}").cast("string").alias("after")) for c in watched])
    return both.select(key, kind.alias("kind"), F.explode(fields).alias("f")).select(key, "kind", "f.*").where((F.col("kind") == "changed") & ~F.col("before").eqNullSafe(F.col("after")) | (F.col("kind") != "changed"))


def master(old: DataFrame, new: DataFrame, key: str, columns: list[str], today) -> DataFrame:
    """Slowly changing master: new values win, first_seen is kept, rows that disappeared keep their last_seen."""
    o, n = old.alias("o"), new.alias("n")
    both = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    present = F.col(f"n.{key}").isNotNull()
    picked = [F.when(present, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in columns]
    return both.select(F.coalesce(f"n.{key}", f"o.{key}").alias(key), *picked, F.coalesce("o.first_seen", F.lit(today)).alias("first_seen"), F.when(present, F.lit(today)).otherwise(F.col("o.last_seen")).alias("last_seen"), (~present).alias("gone"))


def long_form(wide: DataFrame, ids: list[str], values: list[str], name: str = "metric") -> DataFrame:
    """Unpivot without the blank cells."""
    return wide.unpivot(ids, values, name, "value").where("value IS NOT NULL")


CUBE = T.StructType([T.StructField("id", T.ArrayType(T.StringType())), T.StructField("size", T.ArrayType(T.IntegerType())), T.StructField("labels", T.ArrayType(T.ArrayType(T.StringType()))), T.StructField("value", T.ArrayType(T.DoubleType()))])


def cube_rows(cubes: DataFrame, json: str, key: str) -> DataFrame:
    """A JSON statistics cube as rows: the flat position is a mixed-radix number of the dimensions' positions.

    The time dimension is the one whose labels are years, year-quarters or year-months.
    """
    c = cubes.select(key, F.from_json(json, CUBE).alias("c")).select(key, "c.*", F.posexplode("c.value").alias("at", "v")).where("v IS NOT NULL")
    place = F.transform("size", lambda n, k: F.floor(F.col("at") / F.aggregate(F.slice("size", k + 2, F.size("size")), F.lit(1), lambda a, x: a * x)) % n)
    named = F.zip_with("labels", place, lambda l, p: F.element_at(l, (p + 1).cast("int")))
    time = F.lit("^[12][0-9]{3}(-?(Q[1-4]|M?[0-9]{2}))?$")
    read = c.withColumn("names", named)
    when = F.array_max(F.filter("names", lambda x: F.regexp_like(x, time)))
    series = F.array_join(F.filter("names", lambda x: ~F.regexp_like(x, time)), "/")
    freq = F.when(when.contains("Q"), "Q").when(F.length(when) > 4, "M").otherwise("Y")
    return read.select(key, series.alias("series"), when.alias("period"), freq.alias("freq"), F.col("v").alias("value"))


def coverage(df: DataFrame, group: str, date: str, as_of, stale_days: int) -> DataFrame:
    """Rows, days, last date, age and a stale flag per group. The days seen of a month are the bits of a number, so that no task holds a row per day."""
    seen = F.bit_or(F.call_function("shiftleft", F.lit(1), F.dayofmonth(date) - 1))
    months = df.groupBy(group, F.trunc(date, "month").alias("_month")).agg(F.count("*").alias("_n"), F.bit_count(seen).alias("_days"), F.max(date).alias("_last"))
    age = F.datediff(F.lit(as_of).cast("date"), F.max("_last"))
    days = F.coalesce(F.sum(F.col("_days").cast("long")), F.lit(0).cast("long"))
    return months.groupBy(group).agg(F.sum("_n").alias("n_rows"), days.alias("days"), F.max("_last").alias("last_date"), age.alias("age"), (age > stale_days).alias("stale"))


def patch_totals(totals: DataFrame, old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Totals after one entity's rows were replaced: only the touched keys are subtracted from and added to."""
    delta = new.select(*keys, F.col(value).alias("d")).unionByName(old.select(*keys, (-F.col(value)).alias("d"))).groupBy(*keys).agg(F.sum("d").alias("d"))
    return totals.join(delta, keys, "full_outer").select(*keys, (F.coalesce(value, F.lit(0.0)) + F.coalesce("d", F.lit(0.0))).alias(value))


def latest_exports(rows: DataFrame, keys: list[str], export: str) -> DataFrame:
    """Only the rows of each key's newest export; older exports hold the same history."""
    newest = rows.groupBy(*keys).agg(F.max(export).alias(export))
    return rows.join(newest, [*keys, export], "left_semi")


def append_only(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str], period: str, cutoff: int) -> DataFrame:
    """Unseen keys are added; known keys change only from period `cutoff` on; the rest is frozen."""
    o, n = old.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in columns], F.lit(True).alias("_o")), new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in columns], F.lit(True).alias("_n"))
    both = o.join(n, keys, "full_outer")
    take = F.col("_n").isNotNull() & (F.col("_o").isNull() | (F.col(period) >= cutoff))
    return both.select(*keys, *[F.when(take, F.col(f"_n_{c}")).otherwise(F.col(f"_o_{c}")).alias(c) for c in columns])


def put_day(old: DataFrame, new: DataFrame, block: list[str], record: str) -> DataFrame:
    """Replace a block, and rows elsewhere whose record moved into it."""
    kept = old.join(new.select(*block).distinct(), block, "left_anti").join(new.select(record).distinct(), record, "left_anti")
    return kept.select(*new.columns).unionByName(new)


def due_days(fetched: DataFrame, entity: str, day: str, fetched_on: str, first, last, now, ttl_days: int) -> DataFrame:
    """Days to fetch again: missing, or fetched before they were final and longer ago than the time to live."""
    wanted = fetched.select(entity).distinct().withColumn(day, F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))))
    asked = F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    known = fetched.where(asked).groupBy(entity, day).agg(F.max(fetched_on).alias("_at"))
    joined = wanted.join(known, [entity, day], "left")
    not_final = (F.col("_at") < F.date_add(day, 2)) & (F.datediff(F.lit(now).cast("date"), "_at") > ttl_days)
    return joined.where(F.col("_at").isNull() | not_final).select(entity, day, F.col("_at").isNull().alias("missing"))


def merge_calls(rows: DataFrame, keys: list[str], time: str, zone: str, now, order: str, ahead_days: int = 2) -> DataFrame:
    """Local times; rows dated further ahead are dropped; last row per key."""
    local = rows.withColumn("local_time", F.from_utc_timestamp(time, zone))
    kept = local.where(F.col(time) <= F.lit(now).cast("timestamp") + F.expr(f"INTERVAL {ahead_days} DAYS"))
    return kept.groupBy(*keys).agg(F.max_by("local_time", order).alias("local_time"), F.max(order).alias(order))


def second_source_after(first: DataFrame, second: DataFrame, date: str) -> DataFrame:
    """The second provider's rows only after the first one's last date."""
    cut = first.agg(F.max(date).alias("_cut"))
    later = second.join(F.broadcast(cut), F.col("_cut").isNull() | (F.col(date) > F.col("_cut"))).drop("_cut")
    return first.withColumn("source", F.lit(1)).unionByName(later.withColumn("source", F.lit(2)))


def star_views(facts: DataFrame, ticker: str, t: str, share: float = 0.7) -> DataFrame:
    """The facts of the latest period with at least `share` of the peak number of companies."""
    per = facts.groupBy(t).agg(F.countDistinct(ticker).alias("n"))
    good = per.withColumn("peak", F.max("n").over(Window.partitionBy())).where(F.col("n") >= share * F.col("peak"))
    newest = good.agg(F.max(t).alias(t))
    return facts.join(F.broadcast(newest), t, "left_semi")
