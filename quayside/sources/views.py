"""Domain views over the driver tables: the library's operators run on these rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, date, close, volume, value: one row per symbol and session with trades."""
    lines = table(spark, sf_dir, "lineitem")
    daily = lines.groupBy(F.col("l_suppkey").alias("symbol"), F.col("l_shipdate").cast("date").alias("date"))
    summed = daily.agg(F.sum("l_extendedprice").alias("value"), F.sum("l_quantity").alias("volume"))
    return summed.select("symbol", "date", (F.col("value") / F.col("volume")).alias("close"), "volume", "value")


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation, region = (table(spark, sf_dir, n) for n in ("supplier", "nation", "region"))
    placed = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).join(region, nation.n_regionkey == region.r_regionkey)
    return placed.select(F.col("s_suppkey").alias("symbol"), F.col("r_name").alias("exchange"), F.col("n_name").alias("sector"), (1000.0 * (F.col("s_suppkey") + 1)).alias("shares"))


def fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, earnings, book, dividends, expected: some missing, some losses."""
    s = F.col("s_suppkey")
    earnings, book = F.when(s % 9 != 0, (s % 13 - 3) * F.lit(1e6)), F.when(s % 8 != 0, (s % 11 + 1) * F.lit(1e7))
    return table(spark, sf_dir, "supplier").select(s.alias("symbol"), earnings.alias("earnings"), book.alias("book"), F.when(s % 5 != 0, (s % 7) * F.lit(1e5)).alias("dividends"), F.when(s % 4 != 0, (s % 17 - 2) * F.lit(1e6)).alias("expected"))


def quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, date, close, ref: bars with a reference price where a day has more than two trades: the close before, moved as the plain mean stands to the close."""
    daily = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("symbol"), F.col("l_shipdate").cast("date").alias("date"))
    summed = daily.agg(F.sum("l_extendedprice").alias("value"), F.sum("l_quantity").alias("volume"), F.count("*").alias("n"), F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("mean"))
    closed = summed.withColumn("close", F.col("value") / F.col("volume"))
    before = F.lag("close").over(Window.partitionBy("symbol").orderBy("date"))
    return closed.select("symbol", "date", "close", F.when(F.col("n") > 2, before * F.col("mean") / F.col("close")).alias("ref"))


def second_closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, date, close of a second, adjusted source: four symbols in five, up to the end of 1999, halved before 1998, without Januaries."""
    b, day = bars(spark, sf_dir), F.col("date")
    kept = b.where((F.col("symbol") % 5 != 0) & (day <= F.lit("1999-12-31").cast("date")) & (F.month(day) != 1))
    return kept.select("symbol", "date", F.when(F.year(day) < 1998, F.col("close") / 2).otherwise(F.col("close")).alias("close"))


def tranches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lot, symbol, entry, invested: ten lots, each member bought in three steps of half a year."""
    s, k = F.col("s_suppkey"), F.col("k")
    steps = table(spark, sf_dir, "supplier").select(s, F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k"))
    return steps.select((s % 10).alias("lot"), s.alias("symbol"), F.add_months(F.lit("1995-06-30").cast("date"), 6 * k).alias("entry"), ((k + 1) * 100.0).alias("invested"))


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """code, date, buy_val, sell_val, total_value."""
    price, flag = F.col("l_extendedprice"), F.col("l_returnflag")
    daily = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("code"), F.col("l_shipdate").cast("date").alias("date"))
    return daily.agg(F.sum(F.when(flag == "R", price).otherwise(0.0)).alias("buy_val"), F.sum(F.when(flag == "A", price).otherwise(0.0)).alias("sell_val"), F.sum(price).alias("total_value"))


def foreign_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """code, date, buy_val, sell_val, net_match, total_value, owned: matched trades are those of finished lines; three days in four tell what is owned."""
    price, flag, day = F.col("l_extendedprice"), F.col("l_returnflag"), F.col("l_shipdate").cast("date")
    bought, sold = F.when(flag == "R", price).otherwise(0.0), F.when(flag == "A", price).otherwise(0.0)
    daily = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("code"), day.alias("date"))
    owned = F.when(F.dayofmonth("date") % 4 != 0, F.col("_owned"))
    out = daily.agg(F.sum(bought).alias("buy_val"), F.sum(sold).alias("sell_val"), F.sum(F.when(F.col("l_linestatus") == "F", bought - sold)).alias("net_match"), F.sum(price).alias("total_value"), F.avg("l_tax").alias("_owned"))
    return out.withColumn("owned", owned).drop("_owned")


def house_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """code, date, buy_val, sell_val of brokers' own trades; only names they traded have rows."""
    price, status = F.col("l_extendedprice"), F.col("l_linestatus")
    own = table(spark, sf_dir, "lineitem").where("l_returnflag = 'N'").groupBy(F.col("l_suppkey").alias("code"), F.col("l_shipdate").cast("date").alias("date"))
    return own.agg(F.sum(F.when(status == "O", price).otherwise(0.0)).alias("buy_val"), F.sum(F.when(status == "F", price).otherwise(0.0)).alias("sell_val"))


def insider_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deals of insiders, one per line: those neither returned nor finished are only registered; a part has no value."""
    day, volume = F.col("l_shipdate").cast("date"), F.col("l_quantity")
    open_ = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")
    buys = F.col("l_tax") >= 0.04
    signed, plan = F.when(buys, volume).otherwise(-volume), F.ceil(volume / 10) * 10.0
    number = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("symbol"), F.concat(F.lit("P"), F.col("l_partkey")).alias("person"), F.when(number == 1, "chair").when(number == 2, "director").otherwise("").alias("role"), F.when(open_, "registered").otherwise("done").alias("kind"),
        day.alias("announced"), F.date_add(day, 3).alias("from_day"), F.date_add(day, 33).alias("to_day"), F.when(buys, plan).otherwise(0.0).alias("plan_buy"), F.when(buys, 0.0).otherwise(plan).alias("plan_sell"),
        F.when(~open_, F.date_add(day, 10)).alias("done_on"), F.when(~open_, F.when(buys, volume).otherwise(0.0)).alias("done_buy"), F.when(~open_, F.when(buys, 0.0).otherwise(volume)).alias("done_sell"),
        F.when(~open_, signed).alias("net_volume"), F.when(~open_ & (F.col("l_discount") > 0), signed * F.col("l_extendedprice") / 1e5).alias("value"),
    )


def quarter_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, quarter_end, equity, profit: equity is missing in quarters of one trade."""
    ends = F.last_day(F.add_months(F.trunc(F.col("l_shipdate").cast("date"), "quarter"), 2))
    per = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("symbol"), ends.alias("quarter_end"))
    return per.agg(F.when(F.count("*") > 1, 3 * F.sum("l_extendedprice")).alias("equity"), F.sum(F.col("l_extendedprice") * (F.col("l_discount") - 0.05)).alias("profit"))


def rate_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """series, date, source, value in percent: one series has no quotes in the second and the fourth quarter."""
    day = F.col("o_orderdate").cast("date")
    quoted_ = table(spark, sf_dir, "orders").where((F.col("o_orderpriority") != "5-LOW") | (F.quarter(day) % 2 == 1))
    return quoted_.groupBy(F.col("o_orderpriority").alias("series"), day.alias("date"), F.col("o_orderstatus").alias("source")).agg((F.avg("o_totalprice") / 1e5).alias("value"))


def ship_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """terminal, ship, day, calls, teu, dwt, hours: a line is a visit."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("terminal"), F.col("l_partkey").alias("ship"), F.col("l_shipdate").cast("date").alias("day"), F.lit(1.0).alias("calls"), (F.col("l_quantity") * 100).alias("teu"), F.col("l_extendedprice").alias("dwt"), F.when(F.col("l_discount") > 0, F.col("l_tax") * 1200 + F.col("l_quantity")).alias("hours"))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ticker, item, year, quarter, t, value; t numbers quarters without gaps."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    day = F.col("o_orderdate")
    placed = orders.join(customer, orders.o_custkey == customer.c_custkey)
    summed = placed.groupBy(F.col("c_nationkey").alias("ticker"), F.col("o_orderpriority").alias("item"), F.year(day).alias("year"), F.quarter(day).alias("quarter")).agg(F.sum("o_totalprice").alias("value"))
    return summed.withColumn("t", F.col("year") * 4 + F.col("quarter") - 1)


#: Items of securities statements, as they are numbered in `securities_items`.
SECURITIES = (
    "total_assets equity equity_parent charter_capital cash loans margin_loans fvtpl afs_st htm_st st_borrow st_bonds lt_borrow lt_bonds op_revenue fin_income brokerage_rev brokerage_cost "
    "loan_income fvtpl_gain fvtpl_loss underwriting_rev advisory_rev fin_advisory_rev interest_expense provision_borrow_cost op_cost selling_exp ga_exp pbt npat npat_parent oci_afs trading_value_investors"
).split()


def securities_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ticker, freq (Q or Y), t, item, value: an item is a priority, segment and status of orders; costs are negative, some cells are missing. Years are sums of quarters; t numbers the periods of a frequency."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    number = (key % len(SECURITIES)).cast("int")
    item = F.element_at(F.array(*[F.lit(n) for n in SECURITIES]), number + 1)
    signed = F.when(item.rlike("cost|loss|exp"), -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    placed = orders.join(customer, orders.o_custkey == customer.c_custkey).select(F.col("c_nationkey").alias("ticker"), item.alias("item"), F.year(day).alias("year"), (F.year(day) * 4 + F.quarter(day) - 1).alias("q"), signed.alias("value"))
    quarters = placed.groupBy("ticker", F.lit("Q").alias("freq"), F.col("q").alias("t"), "item").agg(F.sum("value").alias("value"))
    return quarters.unionByName(placed.groupBy("ticker", F.lit("Y").alias("freq"), F.col("year").alias("t"), "item").agg(F.sum("value").alias("value")))


def valued_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, sector, date, close, cap, earnings, book: earnings are missing in one year of seven, book values before a symbol's first season."""
    joined = bars(spark, sf_dir).join(instruments(spark, sf_dir), "symbol").join(fundamentals(spark, sf_dir).select("symbol", F.coalesce("earnings", F.lit(5e5)).alias("e"), F.coalesce("book", F.lit(2e7)).alias("b")), "symbol")
    year, live = F.year("date"), F.col("date") >= F.date_add(F.lit("1995-01-01").cast("date"), ((F.col("symbol") * 37) % 400).cast("int"))
    return joined.select("symbol", "sector", "date", "close", (F.col("close") * F.col("shares")).alias("cap"), F.when((F.col("symbol") + year) % 7 != 0, F.col("e") * (year - 1990)).alias("earnings"), F.when(live, F.col("b") * (year - 1990)).alias("book"))


def official_turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """exchange, date, value: what the venues say, a little more than their bars; not on the 10th, 20th and 30th, nor by ASIA in a month's first days."""
    day = F.dayofmonth("date")
    daily = bars(spark, sf_dir).join(instruments(spark, sf_dir), "symbol").groupBy("exchange", "date").agg((F.sum("value") * 1.02).alias("value"))
    return daily.where((day % 10 != 0) & ~((F.col("exchange") == "ASIA") & (day <= 3)))


def fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.trunc("o_orderdate", "month")
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("currency"), month.alias("date")).agg((F.avg("o_totalprice") / 1000).alias("rate"))


def port_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    section = F.when(kind == "view", "arrive").when(kind == "click", "shift").when(kind == "purchase", "depart").otherwise("pass")
    return table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("ship_key"), "ts", section.alias("section"), (F.col("event_id") % 7).cast("int").alias("place_from"), (F.col("event_id") % 11).cast("int").alias("place_to"), F.col("value").alias("dwt"))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "purchase")).select(F.col("user_id").alias("symbol"), "ts", F.col("value").alias("price"))


def berth_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """terminal, day, teu, dwt, hours: a line is a visit; a fifth of them don't say their capacity."""
    day = F.col("l_shipdate").cast("date")
    teu = F.when(F.col("l_discount") >= 0.02, F.col("l_quantity") * 100)
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("terminal"), day.alias("day"), teu.alias("teu"), F.col("l_extendedprice").alias("dwt"), (F.col("l_tax") * 1200).alias("hours"))


def terminal_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """terminal, mno, actual: published volumes up to July 2001."""
    day = F.col("l_shipdate")
    months = table(spark, sf_dir, "lineitem").where(day < F.lit("2001-08-01")).groupBy(F.col("l_suppkey").alias("terminal"), (F.year(day) * 12 + F.month(day) - 1).alias("mno"))
    return months.agg(F.sum(F.col("l_quantity") * (50 + 500 * F.col("l_tax"))).alias("actual"))


def lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(key.alias("lot"), F.col("o_custkey").alias("issuer"), F.col("o_orderdate").cast("date").alias("issue"), (24 + 12 * (key % 5)).cast("int").alias("months"), (5.0 + key % 6).alias("coupon"), F.col("o_totalprice").alias("amount"))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("lot"), F.col("l_linenumber").alias("line"), F.col("l_shipdate").cast("date").alias("date"), (95.0 + F.col("l_quantity") / 5.0).alias("price"), F.col("l_extendedprice").alias("traded"))


def listings(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """prid, district, project_id, posted, ppm2, area, bed; with `file` and `row` if asked for, a line's place in the table."""
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    if more:
        lines = lines.withColumns({"file": F.col("_metadata.file_path"), "row": F.col("_metadata.row_index")})
    joined = lines.join(part, lines.l_partkey == part.p_partkey)
    return joined.select(*more, (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("prid"), F.col("p_brand").alias("district"), F.col("l_partkey").alias("project_id"), F.col("l_shipdate").cast("date").alias("posted"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("ppm2"), F.col("p_size").alias("area"), (1 + F.col("l_linenumber") % 4).alias("bed"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, title, text, lang, source, hour_no: one article per hour of a synthetic clock.

    The tables have no titles; a text's first 120 characters stand for one.
    """
    return table(spark, sf_dir, "documents").select("doc_id", F.substring("text", 1, 120).alias("title"), "text", "lang", "source", F.col("doc_id").alias("hour_no"))


def headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, title, hour_no: the titles of web pages; twenty come in an hour."""
    title = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), title.alias("title"), F.floor(F.col("page_id") / 20).alias("hour_no"))


#: The same views as common table expressions for the checks.
SQL = {
    "bars": "SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date, SUM(l_extendedprice) / SUM(l_quantity) AS close, SUM(l_quantity) AS volume, SUM(l_extendedprice) AS value FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)",
    "instruments": "SELECT s.s_suppkey AS symbol, r.r_name AS exchange, n.n_name AS sector, 1000.0::DOUBLE * (s.s_suppkey + 1) AS shares FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey",
    "fundamentals": "SELECT s_suppkey AS symbol, CASE WHEN s_suppkey % 9 <> 0 THEN (s_suppkey % 13 - 3) * 1e6 END AS earnings, CASE WHEN s_suppkey % 8 <> 0 THEN (s_suppkey % 11 + 1) * 1e7 END AS book, CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey % 7 * 1e5 END AS dividends, CASE WHEN s_suppkey % 4 <> 0 THEN (s_suppkey % 17 - 2) * 1e6 END AS expected FROM supplier",
    "quoted": "SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date, SUM(l_extendedprice) / SUM(l_quantity) AS close, CASE WHEN COUNT(*) > 2 THEN LAG(SUM(l_extendedprice) / SUM(l_quantity)) OVER (PARTITION BY l_suppkey ORDER BY CAST(l_shipdate AS DATE)) * AVG(l_extendedprice / l_quantity) / (SUM(l_extendedprice) / SUM(l_quantity)) END AS ref FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)",
    "second_closes": "SELECT symbol, date, CASE WHEN YEAR(date) < 1998 THEN close / 2 ELSE close END AS close FROM (SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date, SUM(l_extendedprice) / SUM(l_quantity) AS close FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)) WHERE symbol % 5 <> 0 AND date <= DATE '1999-12-31' AND MONTH(date) <> 1",
    "tranches": "SELECT s_suppkey % 10 AS lot, s_suppkey AS symbol, CAST(DATE '1995-06-30' + TO_MONTHS(CAST(6 * k AS INT)) AS DATE) AS entry, (k + 1) * 100.0::DOUBLE AS invested FROM supplier, RANGE(3) g(k)",
    "flows": "SELECT l_suppkey AS code, CAST(l_shipdate AS DATE) AS date, SUM(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END) AS buy_val, SUM(CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE 0 END) AS sell_val, SUM(l_extendedprice) AS total_value FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)",
    "foreign_flows": "SELECT l_suppkey AS code, CAST(l_shipdate AS DATE) AS date, SUM(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END) AS buy_val, SUM(CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE 0 END) AS sell_val, SUM(CASE WHEN l_linestatus = 'F' THEN CASE l_returnflag WHEN 'R' THEN l_extendedprice WHEN 'A' THEN -l_extendedprice ELSE 0 END END) AS net_match, SUM(l_extendedprice) AS total_value, CASE WHEN DAY(CAST(l_shipdate AS DATE)) % 4 <> 0 THEN AVG(l_tax) END AS owned FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)",
    "house_flows": "SELECT l_suppkey AS code, CAST(l_shipdate AS DATE) AS date, SUM(CASE WHEN l_linestatus = 'O' THEN l_extendedprice ELSE 0 END) AS buy_val, SUM(CASE WHEN l_linestatus = 'F' THEN l_extendedprice ELSE 0 END) AS sell_val FROM lineitem WHERE l_returnflag = 'N' GROUP BY ALL",
    "insider_deals": "SELECT symbol, person, role, CASE WHEN open THEN 'registered' ELSE 'done' END AS kind, announced, announced + 3 AS from_day, announced + 33 AS to_day, CASE WHEN buys THEN plan ELSE 0 END AS plan_buy, CASE WHEN buys THEN 0 ELSE plan END AS plan_sell, CASE WHEN NOT open THEN announced + 10 END AS done_on, CASE WHEN NOT open THEN CASE WHEN buys THEN q ELSE 0 END END AS done_buy, CASE WHEN NOT open THEN CASE WHEN buys THEN 0 ELSE q END END AS done_sell, CASE WHEN NOT open THEN CASE WHEN buys THEN q ELSE -q END END AS net_volume, CASE WHEN NOT open AND l_discount > 0 THEN CASE WHEN buys THEN q ELSE -q END * l_extendedprice / 1e5 END AS value FROM (SELECT l_suppkey AS symbol, 'P' || l_partkey AS person, CASE l_linenumber WHEN 1 THEN 'chair' WHEN 2 THEN 'director' ELSE '' END AS role, CAST(l_shipdate AS DATE) AS announced, l_quantity AS q, CEIL(l_quantity / 10) * 10 AS plan, l_tax >= 0.04 AS buys, l_returnflag = 'N' AND l_linestatus = 'O' AS open, l_discount, l_extendedprice FROM lineitem)",
    "quarter_figures": "SELECT l_suppkey AS symbol, LAST_DAY(CAST(DATE_TRUNC('quarter', CAST(l_shipdate AS DATE)) + INTERVAL 2 MONTH AS DATE)) AS quarter_end, CASE WHEN COUNT(*) > 1 THEN 3 * SUM(l_extendedprice) END AS equity, SUM(l_extendedprice * (l_discount - 0.05::DOUBLE)) AS profit FROM lineitem GROUP BY ALL",
    "rate_quotes": "SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS date, o_orderstatus AS source, AVG(o_totalprice) / 1e5 AS value FROM orders WHERE o_orderpriority <> '5-LOW' OR QUARTER(o_orderdate) % 2 = 1 GROUP BY ALL",
    "ship_visits": "SELECT l_suppkey AS terminal, l_partkey AS ship, CAST(l_shipdate AS DATE) AS day, 1.0::DOUBLE AS calls, l_quantity * 100 AS teu, l_extendedprice AS dwt, CASE WHEN l_discount > 0 THEN l_tax * 1200 + l_quantity END AS hours FROM lineitem",
    "facts": "SELECT c_nationkey AS ticker, o_orderpriority AS item, CAST(YEAR(o_orderdate) AS INT) AS year, CAST(QUARTER(o_orderdate) AS INT) AS quarter, CAST(YEAR(o_orderdate) * 4 + QUARTER(o_orderdate) - 1 AS INT) AS t, SUM(o_totalprice) AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL",
    "securities_items": "SELECT ticker, 'Q' AS freq, q AS t, item, SUM(value) AS value FROM (SELECT c_nationkey AS ticker, CAST(YEAR(o_orderdate) AS INT) AS y, CAST(YEAR(o_orderdate) * 4 + QUARTER(o_orderdate) - 1 AS INT) AS q, item, CASE WHEN REGEXP_MATCHES(item, 'cost|loss|exp') THEN -o_totalprice ELSE o_totalprice END AS value FROM (SELECT *, ([" + ", ".join(f"'{n}'" for n in SECURITIES) + "])[1 + o_orderkey % " + str(len(SECURITIES)) + "] AS item FROM orders JOIN customer ON o_custkey = c_custkey)) GROUP BY ALL UNION ALL SELECT c_nationkey, 'Y', CAST(YEAR(o_orderdate) AS INT), item, SUM(CASE WHEN REGEXP_MATCHES(item, 'cost|loss|exp') THEN -o_totalprice ELSE o_totalprice END) FROM (SELECT *, ([" + ", ".join(f"'{n}'" for n in SECURITIES) + "])[1 + o_orderkey % " + str(len(SECURITIES)) + "] AS item FROM orders JOIN customer ON o_custkey = c_custkey) GROUP BY ALL",
    "valued_bars": "SELECT b.symbol, i.sector, b.date, b.close, b.close * i.shares AS cap, CASE WHEN (b.symbol + YEAR(b.date)) % 7 <> 0 THEN COALESCE(f.earnings, 5e5) * (YEAR(b.date) - 1990) END AS earnings, CASE WHEN b.date >= DATE '1995-01-01' + CAST((b.symbol * 37) % 400 AS INT) THEN COALESCE(f.book, 2e7) * (YEAR(b.date) - 1990) END AS book FROM bars b JOIN instruments i ON i.symbol = b.symbol JOIN fundamentals f ON f.symbol = b.symbol",
    "official_turnover": "SELECT exchange, date, SUM(value) * 1.02 AS value FROM bars JOIN instruments USING (symbol) WHERE DAY(date) % 10 <> 0 AND NOT (exchange = 'ASIA' AND DAY(date) <= 3) GROUP BY ALL",
    "fx": "SELECT o_orderstatus AS currency, CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS date, AVG(o_totalprice) / 1000 AS rate FROM orders GROUP BY ALL",
    "port_events": "SELECT event_id, user_id AS ship_key, ts, CASE event_type WHEN 'view' THEN 'arrive' WHEN 'click' THEN 'shift' WHEN 'purchase' THEN 'depart' ELSE 'pass' END AS section, CAST(event_id % 7 AS INT) AS place_from, CAST(event_id % 11 AS INT) AS place_to, value AS dwt FROM events",
    "ticks": "SELECT user_id AS symbol, ts, value AS price FROM events WHERE event_type IN ('click', 'purchase')",
    "berth_visits": "SELECT l_suppkey AS terminal, CAST(l_shipdate AS DATE) AS day, CASE WHEN l_discount >= 0.02 THEN l_quantity * 100 END AS teu, l_extendedprice AS dwt, l_tax * 1200 AS hours FROM lineitem",
    "terminal_volumes": "SELECT l_suppkey AS terminal, CAST(YEAR(l_shipdate) * 12 + MONTH(l_shipdate) - 1 AS INT) AS mno, SUM(l_quantity * (50 + 500 * l_tax)) AS actual FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-08-01' GROUP BY ALL",
    "lots": "SELECT o_orderkey AS lot, o_custkey AS issuer, CAST(o_orderdate AS DATE) AS issue, CAST(24 + 12 * (o_orderkey % 5) AS INT) AS months, 5.0::DOUBLE + o_orderkey % 6 AS coupon, o_totalprice AS amount FROM orders",
    "trades": "SELECT l_orderkey AS lot, l_linenumber AS line, CAST(l_shipdate AS DATE) AS date, 95.0::DOUBLE + l_quantity / 5.0::DOUBLE AS price, l_extendedprice AS traded FROM lineitem",
    "listings": "SELECT l_orderkey * 10 + l_linenumber AS prid, p.p_brand AS district, l_partkey AS project_id, CAST(l_shipdate AS DATE) AS posted, l_extendedprice / l_quantity AS ppm2, p.p_size AS area, 1 + l_linenumber % 4 AS bed FROM lineitem JOIN part p ON l_partkey = p.p_partkey",
    "headlines": "SELECT page_id AS doc_id, REGEXP_EXTRACT(html, '(?s)<title>(.*?)</title>', 1) AS title, page_id // 20 AS hour_no FROM pages",
    "articles": "SELECT doc_id, SUBSTRING(text, 1, 120) AS title, text, lang, source, doc_id AS hour_no FROM documents",
}


def sql(body: str, **ctes: str) -> str:
    """`body` with the views that it or the given expressions name, as one statement."""
    import re

    text = " ".join([body, *ctes.values()])
    named: set[str] = set()
    # Views that a view names come along, before it.
    while more := {name for name in SQL if name not in named and re.search(rf"\b{name}\b", text)}:
        named |= more
        text = " ".join(SQL[name] for name in more)
    order: list[str] = []
    while rest := [name for name in SQL if name in named and name not in order]:
        order += [name for name in rest if not any(o != name and re.search(rf"\b{o}\b", SQL[name]) for o in rest)]
    used = [f"{name} AS ({SQL[name]})" for name in order]
    parts = used + [f"{name} AS ({q})" for name, q in ctes.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def rounded(column, places: int = 4):
    """Rounded after a shift that keeps exact ties from falling either way; `rsql` is the same in SQL."""
    return F.round(F.col(column) + 1e-9 if isinstance(column, str) else column + 1e-9, places)


def rsql(expression: str, places: int = 4) -> str:
    value = f"ROUND(({expression}) + 1e-9, {places})"
    return f"COALESCE(NULLIF({value}, 0), CASE WHEN ({expression}) IS NOT NULL THEN 0.0 END)"  # no negative zero
