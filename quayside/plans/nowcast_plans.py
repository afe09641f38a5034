"""Volume nowcasts over the visits of terminals, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import nowcast as N
from ..operators.text import checkpointed
from ..sources.views import berth_visits, rounded, rsql, sql, terminal_volumes
from .port_plans import COEF

Q, S = {}, {}


def add(name, statement=None):
    def put(run):
        Q[name], S[name] = run, statement
        return run

    return put


LAST_DAY = "2001-10-20"


def features(s, d):
    return N.month_features(berth_visits(s, d), "terminal", F.lit(LAST_DAY).cast("date"))


def inputs(s, d):
    """Features and published figures, kept: the models read each many times, and it is a row per terminal and month where a visit is one."""
    return checkpointed(features(s, d)), checkpointed(terminal_volumes(s, d))


FEATURES = {
    "seen": "SELECT * FROM berth_visits WHERE day <= DATE '2001-10-18'",
    "rat": "SELECT terminal, MEDIAN(dwt / teu) AS r FROM seen WHERE teu > 0 AND dwt > 0 GROUP BY 1",
    "perm": "SELECT terminal, CAST(YEAR(day) * 12 + MONTH(day) - 1 AS INT) AS mno, COUNT(*) AS calls, SUM(CASE WHEN (teu IS NULL OR teu <= 0) AND r IS NOT NULL THEN dwt / r ELSE teu END) AS teu, SUM(CASE WHEN hours > 80 THEN 80 ELSE hours END) AS hours FROM seen LEFT JOIN rat USING (terminal) GROUP BY ALL",
    "ext": "SELECT terminal, DAY(MIN(day)) AS d0, CAST(YEAR(MIN(day)) * 12 + MONTH(MIN(day)) - 1 AS INT) AS m0, CAST(YEAR(MAX(day)) * 12 + MONTH(MAX(day)) - 1 AS INT) AS m1 FROM seen GROUP BY 1",
    "mons": "SELECT terminal, CAST(UNNEST(RANGE(m0 + CASE WHEN d0 > 5 AND m1 > m0 THEN 1 ELSE 0 END, m1 + 1)) AS INT) AS mno FROM ext",
    "dated": "SELECT *, CAST(DAY(LAST_DAY(MAKE_DATE(mno // 12, mno % 12 + 1, 1))) AS INT) AS days_month FROM mons",
    "feat": "SELECT terminal, mno, COALESCE(calls, 0) AS calls, COALESCE(teu, 0) AS teu, COALESCE(hours, 0) AS hours, days_month, CASE WHEN mno = 24021 THEN 18 ELSE days_month END AS days_obs, mno = 24021 AS partial FROM dated LEFT JOIN perm USING (terminal, mno)",
    "trn": "SELECT f.*, a.actual FROM feat f JOIN terminal_volumes a USING (terminal, mno) WHERE NOT partial AND actual > 0 AND teu > 0",
}


@add("mod1_month_features", sql(f"SELECT terminal, mno, calls, {rsql('teu')} AS teu, {rsql('hours')} AS hours, days_month, days_obs, partial FROM feat", **FEATURES))
def mod1(s, d):
    return features(s, d).select("terminal", "mno", "calls", rounded("teu").alias("teu"), rounded("hours").alias("hours"), "days_month", "days_obs", "partial")


W = "PARTITION BY terminal ORDER BY mno"
FRAMES = {"every": "UNBOUNDED PRECEDING", "last12": "{n} PRECEDING", "last6": "{n} PRECEDING"}
LENGTHS = {"every": 0, "last12": 12, "last6": 6}


def _sums(name: str, upto: str) -> str:
    n = LENGTHS[name] - (upto == "CURRENT ROW")
    frame = f"({W} ROWS BETWEEN {FRAMES[name].format(n=n)} AND {upto})"
    parts = {"sa": "hours * hours", "sb": "hours * teu", "sc": "teu * teu", "sd": "hours * actual", "se": "teu * actual"}
    return "SELECT *, " + ", ".join(f"SUM({e}) OVER {frame} AS {k}" for k, e in parts.items()) + " FROM trn"


def _bias(first: int) -> str:
    at = [(f"LAG(hours, {k}) OVER w", f"LAG(teu, {k}) OVER w", f"LAG(actual, {k}) OVER w") if k else ("hours", "teu", "actual") for k in range(first, first + 3)]
    ratios = ", ".join(f"CASE WHEN b1 * {h} + b2 * {t} > 0 THEN {y} / (b1 * {h} + b2 * {t}) END" for h, t, y in at)
    return f"COALESCE(LEAST(GREATEST(LIST_AVG(LIST_FILTER([{ratios}], lambda x: x IS NOT NULL)), CASE WHEN TRUE THEN 0.7 END), 1.4), 1.0)"


def _clip(x: str) -> str:
    return f"CASE WHEN ({x}) IS NOT NULL THEN LEAST(GREATEST({x}, 0.7), 1.35) END"


def _year_ago(hist: str, mno: str, months: str) -> str:
    past = f"LIST_TRANSFORM({months}, lambda x: {hist}[x - 12])"
    sure = f"LEN({months}) > 0 AND LEN(LIST_FILTER({past}, lambda v: v IS NOT NULL)) = LEN({months}) AND LIST_AVG({past}) > 0"
    return f"CASE WHEN {sure} THEN {_clip(f'{hist}[{mno} - 12] / LIST_AVG({past})')} END"


def _season(mno: str, months: str) -> str:
    own = _year_ago("history", mno, months)
    of = f"LIST_AVG(LIST_TRANSFORM({months}, lambda x: season[x % 12]))"
    long = f"CASE WHEN {of} > 0 THEN {_clip(f'season[{mno} % 12] / {of}')} END"
    return f"COALESCE((({own}) + ({long})) / 2, {own}, {long}, 1.0)"


WALK = {
    **FEATURES,
    **{f"su_{n}": _sums(n, "1 PRECEDING") for n in FRAMES},
    **{f"cf_{n}": COEF + f"su_{n}" for n in FRAMES},
    **{f"pr_{n}": f"SELECT terminal, mno, CASE WHEN b1 IS NOT NULL THEN (b1 * hours + b2 * teu) * {_bias(1)} END AS {n} FROM cf_{n} WINDOW w AS ({W})" for n in FRAMES},
    "seas0": f"SELECT terminal, mno, teu, CASE WHEN COUNT(teu) OVER z = 12 THEN teu / AVG(teu) OVER z END AS r FROM feat WHERE NOT partial AND teu > 0 WINDOW z AS ({W} ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)",
    "seas1": "SELECT * FROM seas0 WHERE r > 0.4 AND r < 2.5",
    "seas2": "SELECT terminal, m, s / AVG(s) OVER (PARTITION BY terminal) AS s FROM (SELECT terminal, mno % 12 AS m, MEDIAN(r) AS s FROM seas1 GROUP BY ALL)",
    "seas": "SELECT terminal, MAP(LIST(m), LIST(s)) AS season FROM seas2 WHERE terminal IN (SELECT terminal FROM seas1 GROUP BY 1 HAVING COUNT(DISTINCT mno // 12) >= 2) GROUP BY 1 HAVING COUNT(*) = 12",
    "hist": "SELECT terminal, MAP(LIST(mno), LIST(actual)) AS history, MAP(LIST(mno), LIST(actual / teu)) AS shares FROM trn GROUP BY 1",
    "base0": f"SELECT *, ROW_NUMBER() OVER w AS idx, COUNT(*) OVER (PARTITION BY terminal) AS n, LAG(actual) OVER w AS naive, AVG(actual) OVER p AS y3, AVG(actual / teu) OVER p AS u3, LIST(mno) OVER p AS months FROM trn WINDOW w AS ({W}), p AS ({W} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)",
    "base1": f"SELECT b.*, every, last12, last6, y3 * {_season('mno', 'months')} AS ma3, u3 * COALESCE({_year_ago('shares', 'mno', 'months')}, 1.0) * teu AS use FROM base0 b JOIN pr_every USING (terminal, mno) JOIN pr_last12 USING (terminal, mno) JOIN pr_last6 USING (terminal, mno) JOIN hist USING (terminal) LEFT JOIN seas USING (terminal) WHERE idx > 12 AND n >= 15",
    "scor": "SELECT terminal, COUNT(*) AS months, " + ", ".join(f"AVG(ABS({c} / actual - 1)) AS {c}, AVG(ABS({c} / actual - 1)) FILTER (WHERE idx > n - 6) AS {c}_recent" for c in ("every", "last12", "last6", "naive", "use")) + " FROM base1 GROUP BY 1",
    "best": "SELECT *, CASE WHEN every + every_recent <= LEAST(last12 + last12_recent, last6 + last6_recent) THEN 'every' WHEN last12 + last12_recent <= last6 + last6_recent THEN 'last12' ELSE 'last6' END AS best FROM scor",
    "enss": "SELECT x.terminal, x.idx, x.n, x.actual, ((CASE b.best WHEN 'every' THEN x.every WHEN 'last12' THEN x.last12 ELSE x.last6 END) + x.ma3 + x.use) / 3 AS ensemble FROM base1 x JOIN best b USING (terminal)",
    "ensm": "SELECT terminal, AVG(ABS(ensemble / actual - 1)) AS ensemble, AVG(ABS(ensemble / actual - 1)) FILTER (WHERE idx > n - 6) AS ensemble_recent, QUANTILE_CONT(ABS(ensemble / actual - 1), 0.8) AS band FROM enss GROUP BY 1",
}
SHOWN = ["every", "last12", "last6", "naive", "use"]
COLUMNS = [*SHOWN, *[f"{c}_recent" for c in SHOWN], "ensemble", "ensemble_recent", "band"]


def walk(s, d):
    f, a = inputs(s, d)
    return N.walked(N.training(f, a, "terminal"), f, "terminal")


@add("mod2_backtest", sql("SELECT terminal, months, best, " + ", ".join(f"{rsql(c, 6)} AS {c}" for c in COLUMNS) + " FROM best JOIN ensm USING (terminal)", **WALK))
def mod2_backtest(s, d):
    """Out-of-sample errors: three windows with bias, the month before, the use of capacity, and the ensemble."""
    return N.backtest(walk(s, d), "terminal").select("terminal", "months", "best", *[rounded(c, 6).alias(c) for c in COLUMNS])


#: Months of 1998 of which only the total is taken as known.
BLOCK = (1998 * 12 + 7, 1998 * 12 + 11)
LEFT = {n: f"b.terminal = x.terminal AND b.m1 < x.mno{'' if n == 'every' else ' AND b.m0 >= x.lo'}" for n in FRAMES}
BLOCKS = {
    **FEATURES,
    "trn": f"SELECT f.*, a.actual FROM feat f JOIN terminal_volumes a USING (terminal, mno) WHERE NOT partial AND actual > 0 AND teu > 0 AND mno NOT BETWEEN {BLOCK[0]} AND {BLOCK[1]}",
    "tot": f"SELECT terminal, LIST(mno) AS months, SUM(actual) AS total FROM terminal_volumes WHERE mno BETWEEN {BLOCK[0]} AND {BLOCK[1]} GROUP BY terminal",
    "blk": "SELECT terminal, MIN(mno) AS m0, MAX(mno) AS m1, COUNT(*)::DOUBLE AS k, AVG(hours) AS h, AVG(teu) AS t, ANY_VALUE(total) / COUNT(*) AS y FROM (SELECT terminal, total, LEN(months) AS n, UNNEST(months) AS mno FROM tot WHERE total > 0) JOIN feat USING (terminal, mno) WHERE NOT partial AND teu > 0 GROUP BY terminal HAVING COUNT(*) = ANY_VALUE(n)",
    **{f"s0_{n}": f"SELECT *, MIN(mno) OVER ({W} ROWS BETWEEN {FRAMES[n].format(n=LENGTHS[n])} AND 1 PRECEDING) AS lo FROM ({_sums(n, '1 PRECEDING')})" for n in FRAMES},
    **{f"su_{n}": "SELECT x.* REPLACE (" + ", ".join(f"x.{c} + COALESCE(b.k * b.{p[0]} * b.{p[1]}, 0) AS {c}" for c, p in {"sa": "hh", "sb": "ht", "sc": "tt", "sd": "hy", "se": "ty"}.items()) + f") FROM s0_{n} x LEFT JOIN blk b ON {LEFT[n]}" for n in FRAMES},
    **{k: v for k, v in WALK.items() if k not in FEATURES and not k.startswith("su_")},
}


@add("mod2_backtest_blocks", sql("SELECT terminal, months, best, " + ", ".join(f"{rsql(c, 6)} AS {c}" for c in COLUMNS) + " FROM best JOIN ensm USING (terminal)", **BLOCKS))
def mod2_backtest_blocks(s, d):
    """The same where five months of 1998 are known by their total only."""
    f, a = inputs(s, d)
    inside = F.col("mno").between(*BLOCK)
    blocks = a.where(inside).groupBy("terminal").agg(F.collect_list("mno").alias("months"), F.sum("actual").alias("total"))
    walk_ = N.walked(N.training(f, a.where(~inside), "terminal"), f, "terminal", blocks)
    return N.backtest(walk_, "terminal").select("terminal", "months", "best", *[rounded(c, 6).alias(c) for c in COLUMNS])


PICK = "CASE best WHEN 'every' THEN {e} WHEN 'last12' THEN {a} ELSE {b} END"
NOW = {
    **WALK,
    **{f"fu_{n}": _sums(n, "CURRENT ROW") for n in FRAMES},
    **{f"ff_{n}": f"SELECT terminal, mno, b1, b2, {_bias(0)} AS adj FROM ({COEF} fu_{n}) WINDOW w AS ({W})" for n in FRAMES},
    "tail": f"SELECT terminal, mno AS last_mno, AVG(actual) OVER p AS y3, AVG(actual / teu) OVER p AS u3, LIST(mno) OVER p AS ma FROM trn WINDOW p AS ({W} ROWS 2 PRECEDING) QUALIFY ROW_NUMBER() OVER (PARTITION BY terminal ORDER BY mno DESC) = 1",
    "coef": "SELECT t.*, band, " + ", ".join(f"{PICK.format(e=f'e.{c}', a=f'a.{c}', b=f'b.{c}')} AS {c}" for c in ("b1", "b2", "adj")) + " FROM tail t JOIN best USING (terminal) JOIN ensm USING (terminal) JOIN ff_every e ON e.terminal = t.terminal AND e.mno = t.last_mno JOIN ff_last12 a ON a.terminal = t.terminal AND a.mno = t.last_mno JOIN ff_last6 b ON b.terminal = t.terminal AND b.mno = t.last_mno",
    "bas": "SELECT terminal, AVG(hours) AS bh, AVG(teu) AS bt, LIST(mno ORDER BY mno) AS mb FROM (SELECT * FROM feat WHERE NOT partial QUALIFY ROW_NUMBER() OVER (PARTITION BY terminal ORDER BY mno DESC) <= 3) GROUP BY 1",
    "cur": "SELECT terminal, MAX(mno) AS cur FROM feat GROUP BY 1",
    "pub": "SELECT terminal, MAX(mno) AS published FROM terminal_volumes GROUP BY 1",
    "target": "SELECT f.terminal, f.mno, f.hours, f.teu, f.days_month, f.days_obs, f.partial FROM feat f JOIN pub USING (terminal) JOIN cur USING (terminal) LEFT JOIN terminal_volumes v ON v.terminal = f.terminal AND v.mno = f.mno WHERE v.actual IS NULL AND (f.partial OR f.mno > published) AND (NOT f.partial OR f.mno = cur) UNION ALL SELECT terminal, CAST(UNNEST(RANGE(cur + 1, ((cur + 1) // 3) * 3 + 3)) AS INT), NULL, NULL, NULL, NULL, NULL FROM cur",
    "fc": f"SELECT t.*, c.*, bt, cur, y3 * {_season('mno', 'ma')} AS calm, (b1 * bh + b2 * bt) * adj * {_season('mno', 'mb')} AS plain, u3 * bt * {_season('mno', 'mb')} AS third, u3 * COALESCE({_year_ago('shares', 'mno', 'ma')}, 1.0) AS own_use, CASE WHEN teu IS NULL THEN 0 WHEN partial AND days_obs < 5 THEN 0 WHEN partial THEN days_obs / days_month ELSE 1.0 END AS w, CASE WHEN partial THEN days_month / GREATEST(days_obs, 1) ELSE 1.0 END AS scale FROM target t JOIN coef c USING (terminal) JOIN bas USING (terminal) JOIN cur USING (terminal) JOIN hist USING (terminal) LEFT JOIN seas USING (terminal)",
    "told": "SELECT *, (plain + calm + third) / 3 AS forecast, w * (b1 * hours + b2 * teu) * scale * adj + (1 - w) * plain AS reg FROM fc",
    "est": "SELECT *, CASE WHEN teu IS NULL THEN forecast WHEN teu > 0 THEN (reg + calm + w * own_use * teu * scale + (1 - w) * forecast) / 3 ELSE (reg + calm) / 2 END AS est, CASE WHEN teu IS NULL THEN 'forecast' WHEN partial THEN 'running' ELSE 'nowcast' END AS kind, band * (1.5 - 0.5 * w) * (1 + 0.25 * (CASE WHEN teu IS NULL THEN mno - cur ELSE 1 END - 1)) AS width FROM told",
}


@add("mod3_ensemble", sql(f"SELECT terminal, CAST(LAST_DAY(MAKE_DATE(mno // 12, mno % 12 + 1, 1)) AS DATE) AS month, kind, {rsql('est', 2)} AS est, {rsql('est * (1 - width)', 2)} AS low, {rsql('est * (1 + width)', 2)} AS high FROM est", **NOW))
def mod3(s, d):
    f, a = inputs(s, d)
    scores = N.backtest(N.walked(N.training(f, a, "terminal"), f, "terminal"), "terminal")
    return N.nowcast(f, a, scores, "terminal").withColumns({c: rounded(c, 2) for c in ("est", "low", "high")})


#: Ships and capacities of the view are smaller than real ones, and so are the bounds of the classes.
CLASSES = {
    **FEATURES,
    "cls": "SELECT terminal, CASE WHEN ship >= 2600 THEN 'deep' WHEN cap >= 18000 THEN 'large' ELSE 'small' END AS class FROM (SELECT terminal, SUM(teu) / NULLIF(SUM(calls), 0) AS ship, AVG(teu) AS cap FROM (SELECT * FROM feat WHERE NOT partial QUALIFY ROW_NUMBER() OVER (PARTITION BY terminal ORDER BY mno DESC) <= 12) GROUP BY 1)",
    "lst": "SELECT t.*, UNNEST([class, 'all']) AS class FROM (SELECT *, COUNT(*) OVER (PARTITION BY terminal) AS n FROM trn QUALIFY ROW_NUMBER() OVER (PARTITION BY terminal ORDER BY mno DESC) <= 12) t JOIN cls USING (terminal) WHERE n >= 3",
    "psum": "SELECT class, COUNT(DISTINCT terminal) AS keys, COUNT(*) AS months, SUM(hours * hours) AS sa, SUM(hours * teu) AS sb, SUM(teu * teu) AS sc, SUM(hours * actual) AS sd, SUM(teu * actual) AS se FROM lst GROUP BY 1 HAVING COUNT(DISTINCT terminal) > 1",
    "pcf": COEF + "psum",
    "pool": "SELECT class, keys, months, CASE WHEN b1 > 0 AND b2 > 0 THEN b1 ELSE sd / sa / 2 END AS b1, CASE WHEN b1 > 0 AND b2 > 0 THEN b2 ELSE se / sc / 2 END AS b2 FROM pcf",
    "own": "SELECT terminal, COUNT(*) AS n, SUM(hours * hours) AS sa, SUM(hours * teu) AS sb, SUM(teu * teu) AS sc, SUM(hours * actual) AS sd, SUM(teu * actual) AS se FROM trn GROUP BY 1",
    "pri": "SELECT o.*, COALESCE(p.b1, q.b1) AS p1, COALESCE(p.b2, q.b2) AS p2 FROM own o JOIN cls USING (terminal) LEFT JOIN pool p USING (class) JOIN pool q ON q.class = 'all'",
    "tries": "SELECT *, 6 * POW(2, k) AS pull, sa * (1 + 6 * POW(2, k) / n) AS da, sc * (1 + 6 * POW(2, k) / n) AS dc, sd - sa * p1 - sb * p2 AS r1, se - sb * p1 - sc * p2 AS r2 FROM pri, RANGE(8) g(k)",
    "solved": "SELECT *, p1 + (r1 * dc - r2 * sb) / (da * dc - sb * sb) AS c1, p2 + (r2 * da - r1 * sb) / (da * dc - sb * sb) AS c2 FROM tries",
    "firsts": "SELECT * FROM solved WHERE c1 > 0 AND c2 > 0 QUALIFY ROW_NUMBER() OVER (PARTITION BY terminal ORDER BY k) = 1",
}


def classed(s, d):
    f, a = inputs(s, d)
    train, classes = N.training(f, a, "terminal"), N.terminal_classes(f, "terminal", 2600, 18_000)
    return train, classes, N.pooled(train, classes, "terminal")


@add("mod4_pooled", sql(f"SELECT p.class, p.keys, p.months, {rsql('p.b1')} AS b1, {rsql('p.b2')} AS b2, {rsql('e.error', 6)} AS error FROM pool p JOIN (SELECT class, AVG(ABS((b1 * hours + b2 * teu) / actual - 1)) AS error FROM lst JOIN pool USING (class) GROUP BY 1) e USING (class)", **CLASSES))
def mod4(s, d):
    return classed(s, d)[2].select("class", "keys", "months", rounded("b1").alias("b1"), rounded("b2").alias("b2"), rounded("error", 6).alias("error"))


@add("mod4_shrunk", sql(f"SELECT p.terminal, p.n, {rsql('COALESCE(f.c1, p.p1)')} AS b1, {rsql('COALESCE(f.c2, p.p2)')} AS b2, f.pull FROM pri p LEFT JOIN firsts f USING (terminal)", **CLASSES))
def mod4_shrunk(s, d):
    train, classes, pools = classed(s, d)
    own = classes.join(pools.select("class", "b1", "b2"), "class", "left")
    every = pools.where("class = 'all'").select(F.col("b1").alias("a1"), F.col("b2").alias("a2"))
    priors = own.join(F.broadcast(every)).select("terminal", F.coalesce("b1", "a1").alias("p1"), F.coalesce("b2", "a2").alias("p2"))
    return N.shrunk(train, priors, "terminal").withColumns({c: rounded(c) for c in ("b1", "b2")})
