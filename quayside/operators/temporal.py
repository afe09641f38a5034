"""Time-aware joins and windows that the other operators are built from.

Windows here are partitioned by entity; their frames count rows or sessions. Session calendars are small tables (days),
so they are joined by broadcast under Spark's own size check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.files import shared_path


def asof_join(left: DataFrame, right: DataFrame, key: str | list[str], left_time: str, right_time: str, columns: list[str], *, tolerance_days: int | None = None, matched_time: str | None = None, piece_days: int | None = None) -> DataFrame:
    """The newest right row at or before each left row's time, by key; never a later one. One shuffle on the key.

    `tolerance_days` drops matches that are older. The right side must be unique by key and time; its columns replace
    left columns of the same name. With `piece_days` a key's rows are dealt out by pieces of so many days, each a window of
    its own, and what the newest right row of the pieces before was is carried into each: a hot key is as many tasks as it
    has pieces, for one more aggregation and a window over pieces.
    """
    keys = [key] if isinstance(key, str) else key
    r = F.struct(F.col(right_time).alias("_at"), *columns)
    events = right.select(*keys, F.col(right_time).alias("_time"), F.lit(0).alias("_side"), r.alias("_right"), F.lit(None).cast(left.select(F.struct("*").alias("s")).schema["s"].dataType).alias("_left"))
    asks = left.select(*keys, F.col(left_time).alias("_time"), F.lit(1).alias("_side"), F.lit(None).cast(events.schema["_right"].dataType).alias("_right"), F.struct("*").alias("_left"))
    both, by = events.unionByName(asks), keys
    if piece_days:
        piece = F.floor(F.unix_date(F.col("_time").cast("date")) / piece_days).alias("_piece")
        both, by = both.select("*", piece), [*keys, "_piece"]
    w = Window.partitionBy(*by).orderBy("_time", "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_found", F.last("_right", ignorenulls=True).over(w)).where("_side = 1")
    if piece_days:
        newest = both.groupBy(*by).agg(F.max_by("_right", F.when(F.col("_side") == 0, F.col("_time"))).alias("_newest"))
        before = F.last("_newest", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1))
        carried = newest.select(*[F.col(c).alias(f"_by{k}") for k, c in enumerate(by)], before.alias("_before"))
        same = [F.col(c).eqNullSafe(F.col(f"_by{k}")) for k, c in enumerate(by)]
        found = found.join(carried, same, "left").withColumn("_found", F.coalesce("_found", "_before"))
    near = F.lit(True) if tolerance_days is None else F.datediff("_time", "_found._at") <= tolerance_days
    picked = [F.when(near, F.col(f"_found.{c}")).alias(c) for c in columns]
    more = [F.when(near, F.col("_found._at")).alias(matched_time)] if matched_time else []
    made = {*columns, matched_time}
    return found.select(*[F.col(f"_left.{c}").alias(c) for c in left.columns if c not in made], *picked, *more)


def stored(df: DataFrame) -> DataFrame:
    """The rows as a table in a folder that all executors see, for what is read more than once and dear to make again."""
    path = shared_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def carried(df: DataFrame, keys: list[str], piece: str, order: list, values: dict[str, Column]) -> DataFrame:
    """`df` with, per name, the last non-null of a value in the rows before a row, in the order of `piece`, then `order`.

    Rows of a key are windows of one piece each; the last values of a piece go to the later ones by a table of one row per
    key and piece. So a hot key is as many tasks as it has pieces.
    """
    local = Window.partitionBy(*keys, piece).orderBy(*order)
    inside = local.rowsBetween(Window.unboundedPreceding, -1)
    marked = df.withColumns({f"_v_{n}": v for n, v in values.items()})
    # Null only where nothing was there: the value itself is in a struct.
    boxed = {n: F.when(F.col(f"_v_{n}").isNotNull(), F.struct(F.col(f"_v_{n}").alias("v"))) for n in values}
    within = marked.withColumns({f"_l_{n}": F.last(b, ignorenulls=True).over(inside) for n, b in boxed.items()})
    place = F.struct(*order)
    ends = marked.groupBy(*keys, piece).agg(*[F.max_by(b, F.when(F.col(f"_v_{n}").isNotNull(), place)).alias(f"_e_{n}") for n, b in boxed.items()])
    earlier = Window.partitionBy(*keys).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select(*[F.col(c).alias(f"_k_{c}") for c in (*keys, piece)], *[F.last(f"_e_{n}", ignorenulls=True).over(earlier).alias(f"_b_{n}") for n in values])
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in (*keys, piece)]
    joined = within.join(before, same, "left")
    return joined.select(*df.columns, *[F.coalesce(f"_l_{n}", f"_b_{n}")["v"].alias(n) for n in values])


def carried_sum(df: DataFrame, keys: list[str], piece: str, order: list, value: Column, name: str) -> DataFrame:
    """`df` with the running sum of a value up to each row, in the order of `piece`, then `order`; see `carried`."""
    upto = Window.partitionBy(*keys, piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    marked = df.withColumn("_v", value)
    sums = marked.groupBy(*keys, piece).agg(F.sum("_v").alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*[F.col(c).alias(f"_k_{c}") for c in (*keys, piece)], F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in (*keys, piece)]
    return marked.withColumn("_own", F.sum("_v").over(upto)).join(before, same, "left").select(*df.columns, (F.col("_own") + F.col("_before")).alias(name))


def nearest_join(left: DataFrame, right: DataFrame, key: str, left_id: str, left_time: str, right_time: str, columns: list[str], tolerance: float) -> DataFrame:
    """The right row nearest in time within `tolerance` days on either side, one per left row; ties go to the earlier.

    Rows meet by key and slots of time as long as the tolerance: a right row in its own, a left row in that and both
    next to it. So a key's rows are spread, and only rows within two tolerances of each other are compared.
    """
    seconds = max(1, int(tolerance * 86400))
    r = right.select(key, F.col(right_time).alias("_rt"), F.floor(F.unix_timestamp(right_time) / seconds).alias("_slot"), *columns)
    own = F.floor(F.unix_timestamp(left_time) / seconds)
    asked = left.select(left_id, key, F.col(left_time).alias("_lt"), F.explode(F.array(own - 1, own, own + 1)).alias("_slot"))
    gap = F.abs(F.unix_timestamp("_rt") - F.unix_timestamp("_lt")) / 86400.0
    near = asked.join(r, [key, "_slot"]).withColumn("_gap", gap).where(F.col("_gap") <= tolerance)
    best = near.groupBy(left_id).agg(F.min_by(F.struct("_rt", "_gap", *columns), F.struct("_gap", "_rt", *columns)).alias("_b"))
    return left.join(best, left_id, "left").select(*left.columns, F.col("_b._rt").alias("matched_at"), F.col("_b._gap").alias("gap_days"), *[F.col(f"_b.{c}").alias(c) for c in columns])


def sessions(df: DataFrame, date: str = "date") -> DataFrame:
    """The distinct days in order, numbered from 1; a table of days is small whatever the input."""
    return df.select(date).distinct().withColumn("sess", F.row_number().over(Window.orderBy(date)))


#: Cells of a grid that one task is given, about; a cell takes some hundred bytes where it is sorted.
TASK_CELLS = 500_000


def dense_grid(df: DataFrame, entity: str = "symbol", date: str = "date") -> DataFrame:
    """Every entity on every session between its first and last row; values are null where it has none.

    A row becomes the cells up to the entity's next one, in the task that has the entity: rows are shuffled by entity, cells
    never. So many tasks share the entities that none makes more than about TASK_CELLS, whatever the number of entities.
    """
    days = F.broadcast(sessions(df, date))  # one row per day
    size = df.agg(F.approx_count_distinct(entity).alias("n"), F.approx_count_distinct(date).alias("days")).first()
    numbered = df.join(days, date).repartition(-(-size["n"] * size["days"] // TASK_CELLS) or 1, entity)
    ahead = F.lead("sess").over(Window.partitionBy(entity).orderBy("sess"))
    until = F.greatest(F.coalesce(ahead - 1, "sess"), "sess")
    values = [c for c in df.columns if c not in (entity, date)]
    spread = numbered.select(entity, F.col("sess").alias("_own"), *values, until.alias("_until")).select(entity, "_own", *values, F.explode(F.sequence("_own", "_until")).alias("sess"))
    has = (F.col("sess") == F.col("_own")) & F.col(entity).isNotNull()
    return spread.join(days, "sess").select(entity, date, "sess", *[F.when(has, F.col(c)).alias(c) for c in values])


def filled(value: Column | str, key: str, order: str, limit: int | None = None) -> Column:
    """Forward fill; with a limit, only over that many steps of `order` since the last value."""
    value = F.col(value) if isinstance(value, str) else value
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(value, ignorenulls=True).over(w)
    if limit is None:
        return last
    seen = F.last(F.when(value.isNotNull(), F.col(order)), ignorenulls=True).over(w)
    return F.when(F.col(order) - seen <= limit, last)


def full_mean(value: str, w, n: int) -> Column:
    """Mean of `n` rows up to the current one, null until there are as many values."""
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(value).over(frame) == n, F.avg(value).over(frame))


def with_running_means(df: DataFrame, value: str, key: str, order: str, means: dict[str, int]) -> DataFrame:
    """Means of the last n rows, null until there are n values; from running sums, so a long window costs no more than a short one."""
    w = Window.partitionBy(key).orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    summed = df.select("*", F.sum(value).over(upto).alias("_s"), F.count(value).over(upto).alias("_c"))
    past = {n: (F.coalesce(F.lag("_s", n).over(w), F.lit(0.0)), F.coalesce(F.lag("_c", n).over(w), F.lit(0))) for n in means.values()}
    out = {name: F.when(F.col("_c") - past[n][1] == n, (F.col("_s") - past[n][0]) / n) for name, n in means.items()}
    return summed.select(*df.columns, *[c.alias(name) for name, c in out.items()])


def with_range(df: DataFrame, value: str, key: str, order: str, rows: int, low: str, high: str, count: str) -> DataFrame:
    """Smallest and largest value, and number of values, of the last `rows` rows.

    Extremes of the last 4, 16, 64, ... rows are those of at most four shorter runs, one ending at the row and the others before
    it. So rows stand in one order and are sorted once, and the work grows with the logarithm of `rows`.
    """
    w = Window.partitionBy(key).orderBy(order)
    out = df.select("*", F.count(value).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_c"), F.col(value).alias("_l"), F.col(value).alias("_h"))
    n = 1
    while n < rows:
        wider = min(4 * n, rows)
        back = sorted({*[k * n for k in (1, 2, 3) if (k + 1) * n <= wider], wider - n})
        out = out.withColumns({c: of(c, *[F.lag(c, k).over(w) for k in back]) for c, of in (("_l", F.least), ("_h", F.greatest))})
        n = wider
    return out.select(*df.columns, F.col("_l").alias(low), F.col("_h").alias(high), (F.col("_c") - F.coalesce(F.lag("_c", rows).over(w), F.lit(0))).alias(count))


def guarded_lag(value: str, keys: list[str], t: str, n: int) -> Column:
    """The value of period t - n, null unless that period is exactly n rows back."""
    w = Window.partitionBy(*keys).orderBy(t)
    return F.when(F.lag(t, n).over(w) == F.col(t) - n, F.lag(value, n).over(w))


def trailing_sum(value: str, keys: list[str], t: str, n: int = 4) -> Column:
    """Sum over n periods, only if they are contiguous and all have values."""
    w = Window.partitionBy(*keys).orderBy(t)
    frame = w.rowsBetween(-(n - 1), 0)
    whole = (F.lag(t, n - 1).over(w) == F.col(t) - (n - 1)) & (F.count(value).over(frame) == n)
    return F.when(whole, F.sum(value).over(frame))


def running_product(factor: Column, w) -> Column:
    """Product of positive factors over a frame."""
    return F.exp(F.sum(F.log(factor)).over(w))


def interpolated(points: Column, x: Column) -> Column:
    """Linear interpolation at x in a sorted array of (x, y); flat beyond both ends; null for an empty array."""
    low = F.filter(points, lambda p: p["x"] <= x)
    high = F.filter(points, lambda p: p["x"] > x)
    a, b = F.element_at(low, -1), F.element_at(high, 1)
    between = a["y"] + (b["y"] - a["y"]) * (x - a["x"]) / (b["x"] - a["x"])
    return F.when(F.size(points) == 0, None).when(F.size(low) == 0, b["y"]).when(F.size(high) == 0, a["y"]).otherwise(between)


def horizon_prices(bars: DataFrame, horizons: DataFrame, key: str = "symbol", date: str = "date", value: str = "close") -> DataFrame:
    """Price of every entity at each cut-off: its last value at or before it. Horizons are a few rows."""
    seen = bars.join(F.broadcast(horizons), F.col(date) <= F.col("cutoff"))
    return seen.groupBy(key, "horizon").agg(F.max_by(value, date).alias("price"))
