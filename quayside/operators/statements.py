"""Financial-statement operators: contiguous trailing sums, growth, ratio registries, industry and group totals.

Facts are rows of (ticker, item, year, quarter, t, value), t numbering quarters without gaps. Pivots take their list of
items as an argument, so they need no extra job to find it; ratios are expressions of the pivoted items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .temporal import asof_join, filled, guarded_lag, trailing_sum


def wide_items(facts: DataFrame, keys: list[str], items: dict[str, str]) -> DataFrame:
    """One row per key with a column per item; `items` maps column names to item codes."""
    cells = [F.sum(F.when(F.col("item") == code, F.col("value"))).alias(name) for name, code in items.items()]
    return facts.groupBy(*keys).agg(*cells)


def growth(df: DataFrame, keys: list[str], t: str, value: str, n: int) -> Column:
    """Change against exactly n periods before, over the absolute base; null without that period or with base 0."""
    base = guarded_lag(value, keys, t, n)
    return F.try_divide(F.col(value) - base, F.abs(base))


def mean_of_ends(keys: list[str], t: str, value: str, n: int) -> Column:
    """Mean of the balance now and exactly n periods before."""
    return (F.col(value) + guarded_lag(value, keys, t, n)) / 2


#: Named expressions over the items a (assets), b (liabilities), c (income), d (costs), e (cash) and their trailing sums.
RATIOS = {
    "equity": "a - b",
    "leverage": "try_divide(a, a - b)",
    "margin": "try_divide(c - d, c)",
    "cost_income": "try_divide(d, c)",
    "turnover": "try_divide(c, a)",
    "cash_share": "try_divide(e, a)",
    "debt_share": "try_divide(b, a)",
    "roa": "try_divide(c_ttm - d_ttm, a_mean)",
    "roe": "try_divide(c_ttm - d_ttm, a_mean - b_mean)",
    "margin_ttm": "try_divide(c_ttm - d_ttm, c_ttm)",
    "cash_cover": "try_divide(e, b)",
    "spread": "try_divide(c_ttm, a_mean) - try_divide(d_ttm, b_mean)",
}


def ratio_set(wide: DataFrame, key: str, t: str, ratios: dict[str, str] = RATIOS) -> DataFrame:
    """All ratios in one projection over trailing sums and means of ends."""
    base = wide.select("*", *[trailing_sum(c, [key], t).alias(f"{c}_ttm") for c in "cd"], *[mean_of_ends([key], t, c, 4).alias(f"{c}_mean") for c in "ab"])
    return base.select(key, t, *[F.expr(e).alias(n) for n, e in ratios.items()])


def _some(*columns: str) -> str:
    """Sum of what is there; null if nothing is."""
    return f"CASE WHEN COALESCE({', '.join(columns)}) IS NOT NULL THEN {' + '.join(f'COALESCE({c}, 0)' for c in columns)} END"


def _percent(top: str, bottom: str) -> str:
    return f"CASE WHEN ABS({bottom}) > 0 THEN ({top}) / ({bottom}) * 100 END"


def _over(top: str, bottom: str) -> str:
    return f"({top}) / NULLIF({bottom}, 0)"


#: Costs come as negative figures.
COSTS = "fvtpl_loss provision_borrow_cost brokerage_cost op_cost interest_expense selling_exp ga_exp".split()
#: Figures of a period from its items; amounts are in thousand millions, shares in millions of 10,000 each.
DERIVED = {
    "interest_cost": "CASE WHEN interest_expense > 0 THEN interest_expense ELSE provision_borrow_cost END",
    "net_fvtpl": "COALESCE(fvtpl_gain, 0) - COALESCE(fvtpl_loss, 0)",
    "borrowings": _some("st_borrow", "st_bonds", "lt_borrow", "lt_bonds"),
    "margin_book": "CASE WHEN margin_loans > 0 THEN margin_loans ELSE loans END",
    "invest_book": _some("fvtpl", "afs_st", "htm_st"),
    "shares_mn": "charter_capital * 1e9 / 1e4 / 1e6",
    "opex": _some("selling_exp", "ga_exp"),
    "net_brokerage": "COALESCE(brokerage_rev, 0) - COALESCE(brokerage_cost, 0)",
    "total_income": _some("op_revenue", "fin_income"),
    "ib_rev": _some("underwriting_rev", "advisory_rev", "fin_advisory_rev"),
    "npat_incl_oci": "npat + COALESCE(oci_afs, 0)",
}
#: What is summed over four quarters, what is averaged with the year before, and what is compared with earlier periods.
SUMMED = "npat npat_parent npat_incl_oci pbt op_revenue loan_income interest_cost net_brokerage net_fvtpl brokerage_rev op_cost opex total_income fvtpl_gain ib_rev".split()
AVERAGED = ["equity", "total_assets", "loans", "borrowings"]
COMPARED = ["npat", "op_revenue", "margin_book", "equity"]
#: Ratios over items, derived figures, x_ttm, x_avg, x_year (a year before) and x_last (the period before).
SECURITIES_RATIOS = {
    "bvps": _over("equity_parent * 1e9", "shares_mn * 1e6"), "eps_ttm": _over("npat_parent_ttm * 1e9", "shares_mn * 1e6"), "roe": _percent("npat_ttm", "equity_avg"), "roa": _percent("npat_ttm", "total_assets_avg"), "roe_incl_oci": _percent("npat_incl_oci_ttm", "equity_avg"),
    "net_margin": _percent("npat_ttm", "op_revenue_ttm"), "pbt_margin": _percent("pbt_ttm", "op_revenue_ttm"), "leverage": "CASE WHEN equity > 0 THEN total_assets / equity END", "debt_to_equity": "CASE WHEN equity > 0 THEN borrowings / equity END",
    "margin_to_equity": _percent("margin_book", "equity"), "margin_to_assets": _percent("margin_book", "total_assets"), "invest_to_assets": _percent("invest_book", "total_assets"), "cash_to_assets": _percent("cash", "total_assets"),
    "loan_yield": _percent("loan_income_ttm", "loans_avg"), "cost_of_funds": _percent("interest_cost_ttm", "borrowings_avg"), "lending_spread": f"({_percent('loan_income_ttm', 'loans_avg')}) - ({_percent('interest_cost_ttm', 'borrowings_avg')})",
    "brokerage_margin": _percent("net_brokerage_ttm", "brokerage_rev_ttm"), "cir": _percent("COALESCE(op_cost_ttm, 0) + COALESCE(opex_ttm, 0)", "total_income_ttm"), "opex_to_income": _percent("opex_ttm", "total_income_ttm"), "brokerage_fee_rate": _percent("brokerage_rev", "trading_value_investors"),
    "mix_brokerage": _percent("brokerage_rev_ttm", "op_revenue_ttm"), "mix_lending": _percent("loan_income_ttm", "op_revenue_ttm"), "mix_fvtpl": _percent("fvtpl_gain_ttm", "op_revenue_ttm"), "mix_ib": _percent("ib_rev_ttm", "op_revenue_ttm"),
    "g_npat_yoy": _percent("npat - npat_year", "ABS(npat_year)"), "g_revenue_yoy": _percent("op_revenue - op_revenue_year", "ABS(op_revenue_year)"), "g_margin_yoy": _percent("margin_book - margin_book_year", "margin_book_year"), "g_margin_qoq": _percent("margin_book - margin_book_last", "margin_book_last"), "g_equity_yoy": _percent("equity - equity_year", "equity_year"),
}


def securities_ratios(items: DataFrame, names: list[str]) -> DataFrame:
    """Derived figures, trailing sums and ratios per (ticker, freq, t) of items (ticker, freq, t, item, value); `names` are the items.

    Quarters are summed over four in a row, years are their own sums. A mean of balances takes the one a year before, or
    only the present one where that is missing; growth needs it. Ratios are percentages, null where the base is zero or missing.
    """
    cells = [F.sum(F.when(F.col("item") == n, F.col("value"))).alias(n) for n in names]
    wide = items.groupBy("ticker", "freq", "t").agg(*cells)
    base = wide.withColumns({c: F.abs(c) for c in COSTS}).withColumns({n: F.expr(e) for n, e in DERIVED.items()})
    keys = ["ticker", "freq"]
    quarterly = F.col("freq") == "Q"

    def year_ago(c: str) -> Column:
        return F.when(quarterly, guarded_lag(c, keys, "t", 4)).otherwise(guarded_lag(c, keys, "t", 1))

    more = {f"{c}_ttm": F.when(quarterly, trailing_sum(c, keys, "t")).otherwise(F.col(c)) for c in SUMMED}
    more |= {f"{c}_avg": (F.col(c) + F.coalesce(year_ago(c), F.col(c))) / 2 for c in AVERAGED}
    more |= {f"{c}_year": year_ago(c) for c in COMPARED} | {"margin_book_last": guarded_lag("margin_book", keys, "t", 1)}
    out = base.select("*", *[e.alias(n) for n, e in more.items()])
    return out.select("ticker", "freq", "t", *DERIVED, *[f"{c}_ttm" for c in SUMMED], "equity", "total_assets", *[F.expr(e).alias(n) for n, e in SECURITIES_RATIOS.items()])


def securities_summary(ratios: DataFrame) -> DataFrame:
    """Per frequency and period of `securities_ratios`: companies, summed sizes, median ratios, and the industry's own return on equity, margin lending and net margin."""
    sums = {c: F.sum(c) for c in ("equity", "total_assets", "margin_book", "npat_ttm", "op_revenue_ttm")}
    out = ratios.groupBy("freq", "t").agg(F.countDistinct("ticker").alias("companies"), *[e.alias(f"sum_{c}") for c, e in sums.items()], *[F.median(c).alias(f"med_{c}") for c in ("roe", "leverage", "net_margin", "cir")])
    return out.withColumns({n: F.expr(_percent(a, b)) for n, (a, b) in {"ind_roe_ttm": ("sum_npat_ttm", "sum_equity"), "ind_margin_to_equity": ("sum_margin_book", "sum_equity"), "ind_net_margin_ttm": ("sum_npat_ttm", "sum_op_revenue_ttm")}.items()})


def size_classes(ratios: DataFrame) -> DataFrame:
    """Each company's last quarterly equity and its class: small up to the 33 % quantile of all, medium up to 66 %, else large."""
    last = ratios.where("freq = 'Q' AND equity IS NOT NULL").groupBy("ticker").agg(F.max("t").alias("t"), F.max_by("equity", "t").alias("equity"))
    bounds = last.agg(F.percentile("equity", 0.33).alias("_low"), F.percentile("equity", 0.66).alias("_high"))
    return last.join(F.broadcast(bounds)).select("ticker", "t", "equity", F.when(F.col("equity") <= F.col("_low"), "small").when(F.col("equity") <= F.col("_high"), "medium").otherwise("large").alias("size"))


TOKENS = {"ttm": lambda c, k, t: trailing_sum(c, k, t), "avg": lambda c, k, t: mean_of_ends(k, t, c, 4), "lag": lambda c, k, t: guarded_lag(c, k, t, 4)}


def metrics(wide: DataFrame, key: str, t: str, formulas: dict[str, str]) -> DataFrame:
    """Formulas over item columns with the tokens ttm(x), avg(x) and lag(x), each computed once as a window."""
    import re

    used = sorted({(m[1], m[2]) for f in formulas.values() for m in re.finditer(r"\b(ttm|avg|lag)\((\w+)\)", f)})
    based = wide.select("*", *[TOKENS[token](c, [key], t).alias(f"_{token}_{c}") for token, c in used])
    spelled = {n: re.sub(r"\b(ttm|avg|lag)\((\w+)\)", r"_\1_\2", f) for n, f in formulas.items()}
    return based.select(key, t, *[F.expr(f).alias(n) for n, f in spelled.items()])


def parents(items: DataFrame, statement: str, order: str, level: str, name: str) -> DataFrame:
    """Parent of each line: the nearest line above with a smaller indent.

    Statements have tens of lines, so the range join within a statement stays small.
    """
    above = items.select(statement, F.col(order).alias("_o"), F.col(level).alias("_l"), F.col(name).alias("_n"))
    found = items.join(above, statement).where((F.col("_o") < F.col(order)) & (F.col("_l") < F.col(level)))
    best = found.groupBy(statement, order).agg(F.max_by("_n", "_o").alias("parent"))
    return items.join(best, [statement, order], "left")


def industry_statement(facts: DataFrame, groups: DataFrame) -> DataFrame:
    """Sum and number of companies by group, item and period."""
    return facts.join(groups, "ticker").groupBy("grp", "item", "t").agg(F.sum("value").alias("value"), F.countDistinct("ticker").alias("companies"))


def same_member_ratio(facts: DataFrame, top: str, bottom: str, share: float) -> DataFrame:
    """Ratio of two items over the members that report both, for periods with at least `share` of the peak members."""
    both = wide_items(facts, ["ticker", "t"], {"top": top, "bottom": bottom}).where("top IS NOT NULL AND bottom IS NOT NULL")
    per = both.groupBy("t").agg(F.sum("top").alias("top"), F.sum("bottom").alias("bottom"), F.count("*").alias("members"))
    peak = F.max("members").over(Window.partitionBy())
    return per.withColumn("peak", peak).where(F.col("members") >= share * F.col("peak")).select("t", "members", F.try_divide("top", "bottom").alias("ratio"))


def funding_gap(facts: DataFrame, t0: int, t1: int) -> DataFrame:
    """Change of each item between two periods and its share of the sum of changes."""
    ends = facts.where(F.col("t").isin(t0, t1)).groupBy("item").agg(F.sum(F.when(F.col("t") == t0, F.col("value"))).alias("v0"), F.sum(F.when(F.col("t") == t1, F.col("value"))).alias("v1"))
    change = F.coalesce("v1", F.lit(0.0)) - F.coalesce("v0", F.lit(0.0))
    changed = ends.withColumn("change", change)
    return changed.withColumn("share", F.try_divide("change", F.sum("change").over(Window.partitionBy())))


def group_mean(rows: DataFrame, group: str, member: str, value: str, least: int = 2) -> DataFrame:
    """Mean over members, with their list, for groups of at least `least`."""
    out = rows.groupBy(group).agg(F.avg(value).alias("mean"), F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set(member)), ",").alias("members"))
    return out.where(F.col("n") >= least)


def fixed_panel(facts: DataFrame, share: float = 0.9) -> DataFrame:
    """Sums per period over all companies, for periods in which at least `share` of the panel reports, and their TTM."""
    panel = facts.agg(F.countDistinct("ticker").alias("panel"))
    per = facts.groupBy("t").agg(F.sum("value").alias("value"), F.countDistinct("ticker").alias("n"))
    kept = per.join(F.broadcast(panel)).where(F.col("n") >= share * F.col("panel")).drop("panel")
    return kept.withColumn("k", F.lit(1)).withColumn("ttm", trailing_sum("value", ["k"], "t")).drop("k")


def group_years(facts: DataFrame, groups: DataFrame) -> DataFrame:
    """Flows of a year: the sum of its four quarters if all are there; balances: the fourth quarter."""
    joined = facts.join(groups, "ticker").groupBy("grp", "item", "year", "quarter").agg(F.sum("value").alias("value"))
    flow = F.when(F.count("*") == 4, F.sum("value"))
    return joined.groupBy("grp", "item", "year").agg(flow.alias("flow"), F.max(F.when(F.col("quarter") == 4, F.col("value"))).alias("balance"))


def industry_summary(ratios: DataFrame) -> DataFrame:
    """Per period: summed size, median ratios and the bounds of the size classes."""
    return ratios.groupBy("t").agg(F.sum("equity").alias("equity"), F.median("leverage").alias("leverage"), F.median("margin").alias("margin"), F.percentile("equity", 0.33).alias("p33"), F.percentile("equity", 0.66).alias("p66"))


def statement_feed(facts: DataFrame, quarters: list[int], blank: bool = False) -> DataFrame:
    """Wide feed: one column per quarter of the year, and the sum of those there; missing quarters are 0, or null with `blank`."""
    wide = facts.groupBy("ticker", "item", "year").pivot("quarter", quarters).agg(F.sum("value"))
    total = F.when(F.coalesce(*[F.col(str(q)) for q in quarters]).isNotNull(), sum((F.coalesce(F.col(str(q)), F.lit(0.0)) for q in quarters), F.lit(0.0)))
    out = wide.select("ticker", "item", "year", *[F.col(str(q)).alias(f"q{q}") for q in quarters], total.alias("total"))
    return out if blank else out.na.fill(0.0)


def ticker_statement(facts: DataFrame, ticker: int, periods: list[int]) -> DataFrame:
    """One company's statement: a row per item, a column per period asked for, null where nothing was reported."""
    return facts.where(F.col("ticker") == ticker).groupBy("item").pivot("t", periods).agg(F.sum("value"))


def market_drivers(bars: DataFrame, least_sessions: int) -> DataFrame:
    """Quarterly drivers of daily values: sum, daily mean, sessions (null below `least_sessions`) and the last value.

    Days far from the centred median of 21 sessions (below half or above twice) don't count.
    """
    daily = bars.groupBy("date").agg(F.sum("value").alias("v"))
    # A window has no median with a frame: the frame's values are sorted as an array of 21 at most.
    near = F.array_sort(F.collect_list("v").over(Window.orderBy("date").rowsBetween(-10, 10)))
    half = (F.size(near) + 1) / 2
    around = (F.element_at(near, F.floor(half).cast("int")) + F.element_at(near, F.ceil(half).cast("int"))) / 2
    kept = daily.withColumn("m", around).where(F.col("v").between(0.5 * F.col("m"), 2 * F.col("m")))
    per = kept.groupBy((F.year("date") * 4 + F.quarter("date") - 1).alias("t")).agg(F.sum("v").alias("total"), F.avg("v").alias("mean"), F.count("*").alias("sessions"), F.max_by("v", "date").alias("last"))
    return per.withColumn("total", F.when(F.col("sessions") >= least_sessions, F.col("total")))


def traded_by_quarter(values: DataFrame) -> DataFrame:
    """Per venue and quarter of (venue, date, value): turnover, its mean per session, and the sessions; days without any don't count."""
    quarter = (F.year("date") * 4 + F.quarter("date") - 1).alias("t")
    return values.where("value > 0").groupBy("venue", quarter).agg(F.sum("value").alias("total"), F.avg("value").alias("mean"), F.count("*").alias("sessions"))


def driver_series(flows: DataFrame, rates: DataFrame, caps: DataFrame, known: DataFrame, held: tuple[str, ...], least_sessions: int = 50) -> DataFrame:
    """Drivers by quarter as (series, t, value).

    `flow_net` sums (date, net), in quarters of `least_sessions` at least; `flow_year` sums four of them. Rates (series, date, source, value) count once
    a day, by the last source's name, in percent: their mean, or for series in `held` the last one, carried on into quarters
    without any. `cap` is the last of (date, cap) in a quarter that lies within half and twice the centred median of 21
    sessions, of which 5 must be there. Fixed history `known` (series, t, value) fills what is missing.
    """
    quarter = (F.year("date") * 4 + F.quarter("date") - 1).alias("t")
    net = flows.groupBy(quarter).agg(F.sum("net").alias("value"), F.count("*").alias("_n")).where(F.col("_n") >= least_sessions).select(F.lit("flow_net").alias("series"), "t", "value")
    year = net.select(F.lit("flow_year").alias("series"), "t", trailing_sum("value", ["series"], "t").alias("value")).where("value IS NOT NULL")
    once = rates.where("value IS NOT NULL").groupBy("series", "date").agg((F.max_by("value", "source") / 100).alias("value"))
    per = once.groupBy("series", quarter).agg(F.avg("value").alias("_mean"), F.max_by("value", "date").alias("_last"))
    means = per.where(~F.col("series").isin(*held)).select("series", "t", F.col("_mean").alias("value"))
    lives = per.where(F.col("series").isin(*held)).groupBy("series").agg(F.min("t").alias("_a"), F.max("t").alias("_b"))
    whole = lives.select("series", F.explode(F.sequence("_a", "_b")).alias("t")).join(per.select("series", "t", "_last"), ["series", "t"], "left")
    lasts = whole.select("series", "t", filled("_last", "series", "t").alias("value"))
    # A frame's values are sorted as an array of 21 at most, as a median takes no frame.
    near = F.array_sort(F.collect_list("cap").over(Window.orderBy("date").rowsBetween(-10, 10)))
    half = (F.size(near) + 1) / 2
    median = F.when(F.size(near) >= 5, (F.element_at(near, F.floor(half).cast("int")) + F.element_at(near, F.ceil(half).cast("int"))) / 2)
    sound = caps.where("cap IS NOT NULL").withColumn("_m", median).where((F.col("cap") > 0.5 * F.col("_m")) & (F.col("cap") < 2 * F.col("_m")))
    cap = sound.groupBy(quarter).agg(F.max_by("cap", "date").alias("value")).select(F.lit("cap").alias("series"), "t", "value")
    made = net.unionByName(year).unionByName(means).unionByName(lasts).unionByName(cap)
    fixed = known.select("series", "t", F.col("value").alias("_fixed"))
    return made.join(fixed, ["series", "t"], "full_outer").select("series", "t", F.coalesce("value", "_fixed").alias("value"))


def report_order(facts: DataFrame, items: list[str]) -> DataFrame:
    """Rows with their place in the report: item order first, then time."""
    place = F.array_position(F.array(*[F.lit(i) for i in items]), F.col("item"))
    return facts.withColumn("place", F.when(place == 0, len(items) + 1).otherwise(place)).orderBy("place", "t", "ticker")


def industry_pe(bars: DataFrame, shares: DataFrame, published: DataFrame, least: int) -> DataFrame:
    """Daily price over published earnings per industry: as-of join, then sums over the same members."""
    priced = asof_join(bars.join(shares, "symbol"), published, "ticker", "date", "known", ["value"])
    cap = F.col("close") * F.col("shares")
    has = F.col("value").isNotNull()
    out = priced.groupBy("exchange", "date").agg(F.sum(F.when(has, cap)).alias("cap"), F.sum("value").alias("earnings"), F.count_if(has).alias("members"))
    return out.where(F.col("members") >= least).withColumn("pe", F.when(F.col("earnings") > 0, F.col("cap") / F.col("earnings")))
