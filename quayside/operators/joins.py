"""Enrichment and resolution joins: cascades, ordered rules, fuzzy matches within blocks, overlays.

Rule and unit tables are passed as Python lists and become part of the plan; dimension tables are joined plainly, so
adaptive execution broadcasts them only if their measured size allows it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import similarity
from .text import automaton, checkpointed, rules_of


def first_of(sources: list[tuple[str, Column]]) -> Column:
    """Struct of the first non-null value and the name of its source; null if all are null."""
    out = F.lit(None)
    for name, value in reversed(sources):
        pair = F.struct(value.alias("value"), F.lit(name).alias("source"))
        out = F.when(value.isNotNull(), pair).otherwise(out) if out is not None else pair
    return out


def resolve_entities(rows: DataFrame, register: DataFrame, number: str, second: str, name: str, size: str, within: float = 0.2) -> DataFrame:
    """Register ids by number, else by second number, else by a name that is unique there and has a like size."""
    by_number = register.groupBy(number).agg(F.min("reg_id").alias("_a"))
    by_second = register.groupBy(second).agg(F.min("reg_id").alias("_b"))
    by_name = register.groupBy(name).agg(F.min("reg_id").alias("_c"), F.count("*").alias("_n"), F.min(size).alias("_size")).where("_n = 1")
    joined = rows.join(by_number, number, "left").join(by_second, second, "left").join(by_name, name, "left")
    near = F.abs(F.col(size) - F.col("_size")) <= within * F.col("_size")
    found = first_of([("number", F.col("_a")), ("second", F.col("_b")), ("name", F.when(near, F.col("_c")))])
    return joined.select(*rows.columns, found["value"].alias("reg_id"), found["source"].alias("matched_by"))


def ordered_rules(text: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """Label of the first rule whose pattern occurs."""
    out = F.lit(default)
    for pattern, label in reversed(rules):
        out = F.when(text.rlike(pattern), label).otherwise(out)
    return out


def token_match(left: DataFrame, right: DataFrame, block: str, least: float = 0.6, common: int = 2) -> DataFrame:
    """Best right row per left row by token Jaccard within a block; fewer than `common` shared tokens cap it below 0.6.

    `left` and `right` have (id, block, tokens: array of distinct strings). Rows of a block with equal tokens are one set, met
    by the smallest id; a set that stands on both sides is its own best match. Only the other sets look for theirs, by an
    inverted index on (block, token); sizes travel with the postings, so no pair is looked at that shares nothing.
    """
    rows = left.select("id", block, F.sort_array("tokens").alias("set"))
    sets = rows.select(block, "set").distinct()
    heads = right.select("id", block, F.sort_array("tokens").alias("set")).groupBy(block, "set").agg(F.min("id").alias("r_id"))
    whole = (F.size("set") >= max(common, 1)) & ~F.exists("set", lambda x: x.isNull()) & F.lit(least <= 1)
    equal = sets.where(whole).join(heads, [block, "set"]).select(block, "set", "r_id", F.lit(1.0).alias("score"))
    other = sets.join(equal.select(block, "set"), [block, "set"], "left_anti")
    lp = other.select(block, F.col("set").alias("l_set"), F.explode("set").alias("token"))
    rp = heads.select(block, "r_id", F.size("set").alias("rs"), F.explode("set").alias("token"))
    shared = lp.join(rp, [block, "token"]).groupBy(block, "l_set", "r_id").agg(F.count("*").alias("n"), F.first("rs").alias("rs"))
    jaccard = F.col("n") / (F.size("l_set") + F.col("rs") - F.col("n"))
    scored = shared.withColumn("score", F.when(F.col("n") < common, F.least(jaccard, F.lit(0.59))).otherwise(jaccard)).where(F.col("score") >= least)
    best = scored.groupBy(block, F.col("l_set").alias("set")).agg(F.max_by("r_id", F.struct("score", -F.col("r_id"))).alias("r_id"), F.max("score").alias("score"))
    return rows.join(equal.unionByName(best), [block, "set"]).select(F.col("id").alias("l_id"), "r_id", "score")


def reference_cascade(rows: DataFrame, value: str, levels: list[list[str]], least: int) -> DataFrame:
    """A reference value per row: its own, else the median of the narrowest level with enough rows, with its source."""
    out, sources = rows, [("own", F.col(value))]
    for k, keys in enumerate(levels):
        name = "_".join(keys) or "all"
        medians = rows.groupBy(*keys).agg(F.median(value).alias(f"_m{k}"), F.count(value).alias(f"_n{k}"))
        out = out.join(medians, keys, "left") if keys else out.join(F.broadcast(medians))
        sources.append((name, F.when(F.col(f"_n{k}") >= least, F.col(f"_m{k}"))))
    found = first_of(sources)
    return out.select(*rows.columns, found["value"].alias("reference"), found["source"].alias("source"))


def overlay(official: DataFrame, second: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The official series; the second source only where it has nothing."""
    o, s = official.select(*keys, F.col(value).alias("_o")), second.select(*keys, F.col(value).alias("_s"))
    return o.join(s, keys, "full_outer").select(*keys, F.coalesce("_o", "_s").alias(value), F.when(F.col("_o").isNotNull(), "official").otherwise("second").alias("origin"))


def step_values(steps: DataFrame, key: str, since: str, value: str, first, last) -> DataFrame:
    """The value in force at each month end of [first, last], by key."""
    until = F.lead(since).over(Window.partitionBy(key).orderBy(since))
    spans = steps.select(key, F.col(since).alias("_from"), until.alias("_to"), value)
    months = F.explode(F.transform(F.sequence(F.trunc(F.greatest(F.col("_from"), F.lit(first).cast("date")), "month"), F.trunc(F.least(F.coalesce("_to", F.lit(last).cast("date")), F.lit(last).cast("date")), "month"), F.expr("INTERVAL 1 MONTH")), lambda m: F.last_day(m)))
    inside = spans.where((F.col("_from") <= F.last_day(F.lit(last).cast("date"))) & (F.coalesce("_to", F.lit(last).cast("date")) >= F.lit(first).cast("date")) & (F.trunc(F.greatest(F.col("_from"), F.lit(first).cast("date")), "month") <= F.trunc(F.least(F.coalesce("_to", F.lit(last).cast("date")), F.lit(last).cast("date")), "month")))
    return inside.select(key, months.alias("month"), "_from", "_to", value).where((F.col("month") >= F.col("_from")) & (F.col("_to").isNull() | (F.col("month") < F.col("_to")))).select(key, "month", value)


def renamed(series: DataFrame, files: DataFrame, entity: str, period: str, value: str, least: int = 8, near: float = 0.01) -> DataFrame:
    """`old, new, common, current`: entities whose series (entity, period, value) agree, so that one was renamed.

    Two series agree if they have at least `least` common periods, all values of these lie less than `near` apart, and not
    all of them are zero. The new name is that of the newer file (`files`: entity, file_date), then of the longer series,
    then the one that sorts later; `current` is the last name of a chain of renames (the newest of several; ties: the last in order).

    Entities of equal series are one node, and only its members next to each other in age are compared, so copies aren't
    paired with each other. Nodes meet where they agree on a value other than zero, by steps of `near`; what meets is then
    counted over all common periods, agreeing and not.
    """
    rows = series.where(F.col(value).isNotNull()).groupBy(F.col(entity).alias("e"), F.col(period).alias("p")).agg(F.max(value).alias("v"))
    ages = rows.groupBy("e").agg(F.count("*").alias("n"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "v"))), lambda x: F.concat_ws("=", x["p"], x["v"])), ";"), 256).alias("node"), F.max(F.abs("v")).alias("size"))
    dated = ages.join(files.select(F.col(entity).alias("e"), F.col("file_date").alias("at")), "e", "left").withColumn("age", F.struct(F.coalesce(F.col("at").cast("string"), F.lit("")), "n", "e"))
    dated = dated.where(F.col("n") >= least)
    own = dated.select("e", "node", "n", "size", "age", F.lead("e").over(Window.partitionBy("node").orderBy("age")).alias("next"))
    equal = own.where(F.col("next").isNotNull() & (F.col("size") > near)).select(F.col("e").alias("old"), F.col("next").alias("new"), F.col("n").alias("common"))
    # A node is met by its newest member.
    heads = own.where("next IS NULL").select("e", "age")
    short = rows.join(heads, "e").select("e", "age", "p", "v")
    step = F.floor(F.col("v") / near)
    left = short.where(F.abs("v") > near / 2).select("e", "p", "v", F.explode(F.array(step - 1, step, step + 1)).alias("b"))
    right = short.where(F.abs("v") > near / 2).select(F.col("e").alias("e2"), "p", F.col("v").alias("v2"), step.alias("b"))
    met = left.join(right, ["p", "b"]).where((F.col("e") < F.col("e2")) & (F.abs(F.col("v") - F.col("v2")) < near)).select("e", "e2").distinct()
    both = met.join(short, "e").join(short.select(F.col("e").alias("e2"), F.col("age").alias("age2"), "p", F.col("v").alias("v2")), ["e2", "p"])
    agree = F.count_if(F.abs(F.col("v") - F.col("v2")) < near)
    counted = both.groupBy("e", "e2", "age", "age2").agg(F.count("*").alias("common"), agree.alias("agree"), F.max(F.abs("v")).alias("size"))
    sure = counted.where((F.col("common") >= least) & (F.col("agree") == F.col("common")) & (F.col("size") > near))
    later = F.col("age2") > F.col("age")
    pairs = equal.unionByName(sure.select(F.when(later, F.col("e")).otherwise(F.col("e2")).alias("old"), F.when(later, F.col("e2")).otherwise(F.col("e")).alias("new"), "common"))
    # Names follow the newest of their new names, doubling the steps until none moves.
    ages_of = dated.select(F.col("e").alias("new"), "age")
    to = pairs.join(ages_of, "new").groupBy(F.col("old").alias("name")).agg(F.max_by("new", "age").alias("to"))
    while True:
        jumped = checkpointed(to.join(to.select(F.col("name").alias("to"), F.col("to").alias("end")), "to", "left").select("name", F.coalesce("end", "to").alias("to"), F.col("end").isNotNull().alias("moved")))
        to = jumped.select("name", "to")
        if jumped.where("moved").isEmpty():
            break
    return pairs.join(to.select(F.col("name").alias("old"), F.col("to").alias("current")), "old")


def merge_disclosures(rows: DataFrame, keys: list[str], date: str, estimated: str, source: str) -> DataFrame:
    """One row per key: the earliest real date before any estimated one; the other sources stay as a list."""
    best = F.min_by(F.struct(date, source, estimated), F.struct(estimated, date, source))
    out = rows.groupBy(*keys).agg(best.alias("b"), F.array_sort(F.collect_set(source)).alias("sources"))
    return out.select(*keys, F.col(f"b.{date}").alias(date), F.col(f"b.{source}").alias(source), F.col(f"b.{estimated}").alias(estimated), F.array_join("sources", ",").alias("sources"))


def two_signals(rows: DataFrame, key: str, first: Column, second: Column, tag: str) -> DataFrame:
    """Keys flagged by either of two signals, with the tags of the first."""
    a = rows.where(first).groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(tag)), ",").alias("tags"))
    b = rows.where(second).select(key).distinct().withColumn("_b", F.lit(True))
    return a.join(b, key, "full_outer").select(key, F.col("tags"), F.col("tags").isNotNull().alias("by_first"), F.coalesce("_b", F.lit(False)).alias("by_second"))


def to_process(rows: DataFrame, done: DataFrame, redo: DataFrame, key: str) -> DataFrame:
    """Rows not processed yet, and processed ones flagged to be done again."""
    return rows.join(done, key, "left_anti").unionByName(rows.join(done, key, "left_semi").join(redo, key, "left_semi"))


def overridden(rows: DataFrame, manual: DataFrame, key: str, columns: list[str], only_if_empty: list[str]) -> DataFrame:
    """Non-empty manual fields win; those in `only_if_empty` only fill."""
    m = manual.select(key, *[F.nullif(F.col(c).cast("string"), F.lit("")).alias(f"_m_{c}") for c in columns + only_if_empty])
    joined = rows.join(m, key, "left")
    picked = {c: F.coalesce(f"_m_{c}", c) for c in columns} | {c: F.coalesce(F.nullif(c, F.lit("")), F.col(f"_m_{c}")) for c in only_if_empty}
    touched = F.greatest(*[F.col(f"_m_{c}").isNotNull() for c in columns + only_if_empty])
    return joined.withColumn("manual", touched).withColumns(picked).select(*rows.columns, "manual")


def canonical_names(names: DataFrame, aliases: DataFrame, least: float = 0.86) -> DataFrame:
    """Canonical form of each distinct name: the longest alias contained in it (ties: the first in order), else the most similar alias.

    `aliases` (alias, canonical) is a rule table. One automaton finds the aliases in a name and, with it, segments of them:
    an alias that a name is similar to differs by k edits at most, so one of k + 1 segments of it is in the name. Only
    aliases met so, of a like length, are compared; an alias too short for so many segments is compared with all names.
    """
    rules = names.sparkSession.sparkContext.broadcast(rules_of(aliases, "alias", "canonical"))

    def segments(alias: str) -> list[str]:
        n = len(alias)
        parts = int((1 - least) * n / max(least, 1e-9) + 1e-9) + 1
        cuts = [k * n // parts for k in range(parts + 1)]
        return [alias[a:b] for a, b in zip(cuts, cuts[1:])]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: dict[str, list[str]] = {}
        partly: dict[str, set[str]] = {}
        always = set()
        for alias, canonical in rules.value:
            if alias:
                whole.setdefault(alias, []).append(canonical)
                for part in segments(alias):
                    always.add(alias) if not part else partly.setdefault(part, set()).add(alias)
        contained, met = automaton(list(whole)), automaton(list(partly))
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for name in batch.column(0).to_pylist():
                inside = {alias for _, alias in contained.iter(name)} if contained and name else set()
                if inside:
                    found = [(True, min(inside, key=lambda a: (-len(a), a)))]
                else:
                    near = always.union(*(partly[part] for _, part in met.iter(name))) if met and name else always
                    found = [(False, a) for a in near if min(len(a), len(name or "")) >= least * max(len(a), len(name or ""))]
                for is_in, alias in found or [(False, None)]:
                    for canonical in whole.get(alias, [None]):
                        for column, value in zip(out, (name, alias, canonical, is_in)):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.string(), pa.string(), pa.bool_()))], ["name", "alias", "canonical", "inside"])

    met = names.select("name").distinct().mapInArrow(each, "name string, alias string, canonical string, inside boolean")
    score = F.when(F.col("inside"), 2.0).otherwise(similarity(F.col("name"), F.col("alias")))
    scored = met.withColumn("score", score)
    best = scored.groupBy("name").agg(F.max("score").alias("score"), F.min_by("canonical", F.struct((-F.col("score")).alias("s"), "alias", "canonical")).alias("canonical"))
    return best.select("name", F.when(F.col("score") >= least, F.col("canonical")).alias("canonical"))
