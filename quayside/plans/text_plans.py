"""Text queries, each with its SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import ports as P
from ..operators import text as O
from .port_plans import STOPS as P_STOPS
from ..sources.views import articles, headlines, port_events, rounded, rsql, sql, table

Q, S = {}, {}


def add(name, statement=None):
    def put(run):
        Q[name], S[name] = run, statement
        return run

    return put


KEY = "TRIM(REGEXP_REPLACE(TRANSLATE(LOWER(REGEXP_REPLACE({}, '<[^>]*>', ' ', 'g')), '" + X.MARKED + "', '" + X.PLAIN + "'), '[^a-z0-9]+', ' ', 'g'))"
WORDS = [("the", "c1", 1.0, False), ("and the", "c1", 2.0, False), ("of", "c2", 1.0, False), ("is", "c2", 0.5, False), ("la", "c3", 1.0, False), ("de la", "c3", 1.5, False), ("der", "c4", 1.0, False), ("Das", "c4", 1.5, True), ("The", "c5", 2.0, True)]
VALUES = ", ".join(f"('{k}', '{c}', {w}::DOUBLE, {x})" for k, c, w, x in WORDS)


def keywords(s):
    return s.createDataFrame(WORDS, "keyword string, category string, weight double, exact boolean")


def fields(s, d):
    return articles(s, d).select("doc_id", "title", F.substr("text", F.lit(121)).alias("lead"))


def _longest_first(exact: bool) -> str:
    return "|".join(sorted((k for k, _, _, x in WORDS if x == exact), key=lambda k: (-len(k), k)))


#: The longest keyword at each place, from left to right; words of the exact list stand between two blanks each.
TAGGED = {
    "kw": f"SELECT * FROM (VALUES {VALUES}) v(keyword, category, weight, exact)",
    "fld": "SELECT doc_id, 2.0::DOUBLE AS w, SUBSTRING(text, 1, 120) AS t FROM documents UNION ALL SELECT doc_id, 1.0, SUBSTRING(text, 121) FROM documents",
    "hit": f"SELECT doc_id, w, FALSE AS exact, UNNEST(LIST_DISTINCT(REGEXP_EXTRACT_ALL({KEY.format('t')}, '\\b(?:{_longest_first(False)})\\b'))) AS keyword FROM fld UNION ALL SELECT doc_id, w, TRUE, UNNEST(LIST_DISTINCT(REGEXP_EXTRACT_ALL('  ' || REGEXP_REPLACE(REGEXP_REPLACE(t, '<[^>]*>', ' ', 'g'), '[^\\p{{L}}\\p{{N}}_]+', '  ', 'g') || '  ', ' ({_longest_first(True)}) ', 1))) FROM fld",
    "scored": "SELECT doc_id, category, SUM(w * weight) AS score FROM hit JOIN kw USING (keyword, exact) GROUP BY ALL HAVING SUM(w * weight) >= 2",
}


@add("txt1_tagging", sql("SELECT doc_id, STRING_AGG(category, ',' ORDER BY category) AS categories, ARG_MIN(category, (-score, category)) AS main, " + rsql("MAX(score)") + " AS score FROM scored GROUP BY doc_id", **TAGGED))
def txt1(s, d):
    return O.tagged(fields(s, d), keywords(s), 2.0).withColumn("score", rounded("score"))


@add("txt2_mentions", sql("SELECT doc_id, code, CASE WHEN LEN(codes) > 5 THEN 0.5 ELSE 1.0 END AS weight FROM (SELECT doc_id, codes, UNNEST(codes) AS code FROM (SELECT doc_id, LIST_FILTER(LIST_DISTINCT(REGEXP_EXTRACT_ALL(text, '(?:^| )([A-Z][a-z])(?: |$)', 1)), lambda c: c NOT IN ('La', 'Of') OR (c = 'La' AND REGEXP_MATCHES(text, '(?s)(?:tion).{0,14}(?:^| )(?:La)(?: |$)')) OR (c = 'Of' AND REGEXP_MATCHES(text, '(?s)(?:tion).{0,14}(?:^| )(?:Of)(?: |$)'))) AS codes FROM documents))"))
def txt2(s, d):
    return O.mentions(articles(s, d), "text", "[A-Z][a-z]", ["La", "Of"], "tion")


@add("txt3_title_keys", sql("SELECT doc_id, SHA1(SUBSTRING(" + KEY.format("title") + ", 1, 90)) AS title_key FROM headlines"))
def txt3(s, d):
    return headlines(s, d).select("doc_id", O.title_key(F.col("title")).alias("title_key"))


#: All pairs of titles within the hours, each with its best earlier one; a part of a title is any run of a length that few edits can give.
PARENTS = {
    "kt": f"SELECT doc_id, hour_no, {KEY.format('title')} AS k FROM headlines",
    "pairs": "SELECT a.doc_id, b.doc_id AS other, b.hour_no AS h2, a.k, b.k AS k2, 1 - LEVENSHTEIN(a.k, b.k) / GREATEST(LENGTH(a.k), LENGTH(b.k)) AS sim FROM kt a JOIN kt b ON b.hour_no >= a.hour_no - 36 AND (b.hour_no, b.doc_id) < (a.hour_no, a.doc_id) WHERE LENGTH(a.k) > 0 AND LENGTH(b.k) > 0",
    "alike": "SELECT doc_id, FIRST(other ORDER BY sim DESC, h2, other) AS parent FROM pairs WHERE sim >= 0.86 GROUP BY 1",
    "longer": "SELECT *, CASE WHEN LENGTH(k) <= LENGTH(k2) THEN k ELSE k2 END AS sh, CASE WHEN LENGTH(k) <= LENGTH(k2) THEN k2 ELSE k END AS lo FROM pairs WHERE LEAST(LENGTH(k), LENGTH(k2)) >= 40 AND doc_id NOT IN (SELECT doc_id FROM alike)",
    "inside": "SELECT * FROM longer WHERE LEN(LIST_FILTER(RANGE(1, LENGTH(lo) + 1), lambda p: LEN(LIST_FILTER(RANGE(LENGTH(sh) - 4, LENGTH(sh) + 5), lambda z: LEVENSHTEIN(sh, SUBSTRING(lo, p, z)) <= 0.05 * LENGTH(sh))) > 0)) > 0",
    "within": "SELECT doc_id, FIRST(other ORDER BY sim DESC, h2, other) AS parent FROM inside GROUP BY 1",
    "par": "SELECT kt.doc_id, k, COALESCE(a.parent, w.parent) AS parent FROM kt LEFT JOIN alike a USING (doc_id) LEFT JOIN within w USING (doc_id)",
    "up": "SELECT doc_id, doc_id AS root, parent, k FROM par UNION ALL SELECT u.doc_id, p.doc_id, p.parent, p.k FROM up u JOIN par p ON p.doc_id = u.parent",
    "tops": "SELECT doc_id, SUBSTRING(k, 1, 90) AS rk FROM up WHERE parent IS NULL",
}


def recursive(body: str, **ctes: str) -> str:
    return sql(body, **ctes).replace("WITH ", "WITH RECURSIVE ", 1)


@add("txt4_near_duplicates", recursive("SELECT doc_id, CASE WHEN rk = '' THEN doc_id ELSE MIN(doc_id) OVER (PARTITION BY rk) END AS grp FROM tops", **PARENTS))
def txt4(s, d):
    """Similar titles within 36 hours, and titles within others; checked against a plain loop in the tests, too."""
    return O.near_duplicates(headlines(s, d))


@add("txt5_attention", sql("SELECT doc_id, " + rsql("n_chars % 7 + CASE WHEN n_chars % 2 = 0 THEN 1 ELSE 0 END + LEAST(sources - 1, 4)") + " AS attention FROM documents JOIN (SELECT lang, n_chars % 50 AS g, COUNT(DISTINCT source) AS sources FROM documents GROUP BY ALL) x ON x.lang = documents.lang AND x.g = n_chars % 50"))
def txt5(s, d):
    a = table(s, d, "documents").select("doc_id", "source", F.concat_ws("-", "lang", (F.col("n_chars") % 50).cast("string")).alias("grp"), (F.col("n_chars") % 7).alias("event"), (F.col("n_chars") % 2 == 0).cast("int").alias("has_entity"))
    return O.attention(a, "grp").select("doc_id", rounded(F.col("attention").cast("double")).alias("attention"))


NG = f"SELECT MIN(doc_id) AS doc_id, ARG_MIN(lang, doc_id) AS category, STRING_SPLIT(k, ' ') AS ws FROM (SELECT doc_id, lang, {KEY.format('text')} AS k FROM documents) GROUP BY k"
GRAM = "SELECT DISTINCT doc_id, category, ARRAY_TO_STRING(ws[i:i + n - 1], ' ') AS phrase, n FROM ng, GENERATE_SERIES(2, 4) k(n), LATERAL (SELECT UNNEST(GENERATE_SERIES(1, LEN(ws) - n + 1)) AS i) WHERE LEN(ws) >= n"
MINED = {
    "ng": NG,
    "gr": GRAM,
    "dfs": "SELECT phrase, n, COUNT(*) AS df FROM gr GROUP BY ALL HAVING COUNT(*) >= 4",
    "lng": "SELECT phrase, MAX(df) AS long_df FROM (SELECT ARRAY_TO_STRING(STRING_SPLIT(phrase, ' ')[:n - 1], ' ') AS phrase, df FROM dfs WHERE n > 2 UNION ALL SELECT ARRAY_TO_STRING(STRING_SPLIT(phrase, ' ')[2:], ' '), df FROM dfs WHERE n > 2) GROUP BY 1",
    "mined": "SELECT d.phrase, d.df FROM dfs d LEFT JOIN lng USING (phrase) WHERE long_df IS NULL OR long_df < 0.8 * d.df",
}


def words(s, d):
    return articles(s, d).select("doc_id", F.col("lang").alias("category"), F.split(X.key(F.col("text")), " ").alias("words"))


def mined(s, d):
    """Documents of words joined by blanks, each text once, dealt out evenly and kept: what is counted is many times what is read."""
    texts = articles(s, d).select("doc_id", F.col("lang").alias("category"), X.key(F.col("text")).alias("words"))
    return O.once_each(O.kept(texts.repartition(int(s.conf.get("spark.sql.shuffle.partitions")))))


@add("txt6_phrases", sql("SELECT phrase, df FROM mined", **MINED))
def txt6(s, d):
    return O.phrases(mined(s, d), 4)


LIFTED = {
    "sizes": "SELECT category, COUNT(*) AS docs FROM ng GROUP BY 1",
    "per": "SELECT g.category, g.phrase, COUNT(*) AS n, ANY_VALUE(m.df) AS df FROM gr g JOIN mined m ON m.phrase = g.phrase GROUP BY g.category, g.phrase",
    "lft": "SELECT *, (n / docs) / (df / (SELECT COUNT(*) FROM ng)) AS lift FROM per JOIN sizes USING (category)",
    "rnk": "SELECT *, ROW_NUMBER() OVER (PARTITION BY category ORDER BY lift DESC, n DESC, phrase) AS rank FROM lft WHERE lift >= 1.2",
}


@add("txt6_lift", sql("SELECT category, phrase, n, df, " + rsql("lift") + " AS lift, CAST(rank AS INT) AS rank FROM rnk WHERE rank <= 40", **MINED, **LIFTED))
def txt6_lift(s, d):
    w = mined(s, d)
    return O.lifted(w, O.phrases(w, 4), 1.2, 40).withColumn("lift", rounded("lift"))


@add("txt6_gaps", sql("SELECT g.phrase, COUNT(*) AS n, ANY_VALUE(m.df) AS df FROM gr g JOIN mined m ON m.phrase = g.phrase WHERE g.doc_id NOT IN (SELECT doc_id FROM scored) GROUP BY g.phrase HAVING COUNT(*) >= 3", **MINED, **TAGGED))
def txt6_gaps(s, d):
    """Phrases of documents that the dictionary of txt1 gives no category."""
    w = mined(s, d)
    return O.gaps(w, O.phrases(w, 4), O.tagged(fields(s, d), keywords(s), 2.0))


@add("txt7_pattern_events", sql("SELECT source, COUNT(*) AS n, STRING_AGG(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT source, UNNEST(LIST_FILTER([CASE WHEN REGEXP_MATCHES(text, 'password|secret') THEN 'secret' END, CASE WHEN REGEXP_MATCHES(text, '[Ll]icen[sc]e') THEN 'licence' END, CASE WHEN REGEXP_MATCHES(text, '[0-9]{6}') THEN 'digits' END], lambda x: x IS NOT NULL)) AS label FROM documents) GROUP BY source"))
def txt7(s, d):
    return O.pattern_events(table(s, d, "documents"), "doc_id", "source", "text", {"secret": "password|secret", "licence": "[Ll]icen[sc]e", "digits": "[0-9]{6}"})


@add("txt8_watch_list", sql("SELECT doc_id FROM documents WHERE LIST_HAS_ANY(STRING_SPLIT(" + KEY.format("text") + ", ' '), ['ouon', 'tionre', 'erinea'])"))
def txt8(s, d):
    return O.watched(words(s, d), "words", ["ouon", "tionre", "erinea"]).select("doc_id")


CLOCK = "SELECT doc_id, lang AS topic, n_chars % 97 AS score, n_chars % 5 AS sources, n_chars % 61 AS grp, source, CAST(FLOOR(doc_id * 720 / (SELECT MAX(doc_id) + 1 FROM documents)) AS BIGINT) AS hour_no FROM documents"


@add("txt9_digest", sql("SELECT doc_id, topic, score FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY topic ORDER BY score DESC, sources DESC, hour_no DESC, doc_id DESC) AS r FROM (SELECT * FROM clock WHERE hour_no BETWEEN 630 AND 720 AND source <> (SELECT MIN(source) FROM documents) QUALIFY ROW_NUMBER() OVER (PARTITION BY grp ORDER BY score DESC, sources DESC, hour_no DESC, doc_id DESC) = 1)) WHERE r <= 7 ORDER BY score DESC, sources DESC, hour_no DESC, doc_id DESC LIMIT 22", clock=CLOCK))
def txt9(s, d):
    """All articles lie on a clock of 720 hours; the digest takes the last 90 of them, but for one source that was used up."""
    n, docs = F.col("n_chars"), table(s, d, "documents")
    ends = docs.agg((F.max("doc_id") + 1).alias("ids"), F.min("source").alias("used_source"))
    rows = docs.join(F.broadcast(ends)).select("doc_id", F.col("lang").alias("topic"), (n % 97).alias("score"), (n % 5).alias("sources"), F.floor(F.col("doc_id") * 720 / F.col("ids")).alias("hour_no"), (n % 61).alias("grp"), (F.col("source") == F.col("used_source")).alias("used"))
    return O.digest(rows.drop("used"), rows.where("used").select("doc_id"), 630, 720, 5, 15).select("doc_id", "topic", "score")


def port_sets(s, d):
    stops, _ = P.stops_and_legs(port_events(s, d).withColumn("ts", F.col("ts").cast("timestamp")), 2)
    week = F.date_trunc("week", "start").cast("date")
    return stops.groupBy("ship_key", week.alias("week")).agg(F.array_join(F.array_sort(F.collect_set(F.col("place").cast("string"))), "|").alias("ports"))


SETS = {**P_STOPS, "st": "SELECT ship_key, CAST(DATE_TRUNC('week', start) AS DATE) AS week, ARRAY_TO_STRING(LIST_SORT(LIST_DISTINCT(LIST(CAST(place AS VARCHAR)))), '|') AS ports FROM stops GROUP BY ALL",
        "ds": "SELECT ports, COUNT(*) AS freq, STRING_SPLIT(ports, '|') AS ps, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, ports) AS i FROM st GROUP BY ports"}
JAC = "LEN(LIST_INTERSECT(STRING_SPLIT(l, '|'), ps)) / LEN(LIST_DISTINCT(LIST_CONCAT(STRING_SPLIT(l, '|'), ps)))"
#: Sets in order, one per step, with the leaders so far; the best leader is the most similar one, then the first.
LED = "SELECT 0::BIGINT AS i, []::VARCHAR[] AS leaders, NULL::VARCHAR AS cluster UNION ALL SELECT i, CASE WHEN best IS NULL THEN LIST_APPEND(leaders, ports) ELSE leaders END, COALESCE(best, ports) FROM (SELECT d.i, d.ports, r.leaders, LIST_MAX(LIST_FILTER(LIST_TRANSFORM(r.leaders, lambda l, k: {'j': " + JAC + ", 'k': -k, 'l': l}), lambda x: x.j >= 0.6)).l AS best FROM led r JOIN ds d ON d.i = r.i + 1)"


CLUSTERED = {**SETS, "led": LED, "cl": "SELECT ds.ports, freq, cluster FROM ds JOIN led USING (i)"}


@add("txt10_port_clusters", recursive("SELECT ports, freq, cluster FROM cl", **CLUSTERED))
def txt10(s, d):
    """Leader clustering of port sets; checked against a plain loop in the tests, too."""
    return O.port_clusters(port_sets(s, d), 0.6)


NAMED = "SELECT st.ship_key, st.ports, CASE WHEN st.ship_key % 3 <> 0 THEN 'line ' || LEFT(ports, 1) END AS name, CASE WHEN st.ship_key % 4 <> 0 THEN CAST(st.ship_key % 5 AS VARCHAR) END AS operator FROM st"


@add("txt10_services", recursive("SELECT z.cluster, z.rows, z.ships, CASE WHEN 2 * nm.n >= z.rows THEN nm.name END AS service, co.core_ports, op.operator, " + rsql("op.n / op.known") + " AS operator_share FROM (SELECT cluster, COUNT(*) AS rows, COUNT(DISTINCT ship_key) AS ships FROM jn GROUP BY 1) z LEFT JOIN (SELECT cluster, name, n FROM (SELECT cluster, name, COUNT(*) AS n FROM jn WHERE name IS NOT NULL GROUP BY ALL) QUALIFY ROW_NUMBER() OVER (PARTITION BY cluster ORDER BY n DESC, name) = 1) nm USING (cluster) LEFT JOIN (SELECT cluster, operator, n, SUM(n) OVER (PARTITION BY cluster) AS known FROM (SELECT cluster, operator, COUNT(*) AS n FROM jn WHERE operator IS NOT NULL GROUP BY ALL) QUALIFY ROW_NUMBER() OVER (PARTITION BY cluster ORDER BY n DESC, operator) = 1) op USING (cluster) LEFT JOIN (SELECT cluster, STRING_AGG(port, '|' ORDER BY port) AS core_ports FROM (SELECT cluster, port, COUNT(*) AS n, ANY_VALUE(total) AS total FROM (SELECT cluster, UNNEST(STRING_SPLIT(ports, '|')) AS port, COUNT(*) OVER (PARTITION BY cluster) AS total FROM jn) GROUP BY ALL) WHERE 2 * n >= total GROUP BY 1) co USING (cluster)", **CLUSTERED, nd=NAMED, jn="SELECT nd.*, cl.cluster FROM nd JOIN cl USING (ports)"))
def txt10_services(s, d):
    sets = O.checkpointed(port_sets(s, d))
    ship = F.col("ship_key")
    rows = sets.select("ship_key", "ports", F.when(ship % 3 != 0, F.concat(F.lit("line "), F.substring("ports", 1, 1))).alias("name"), F.when(ship % 4 != 0, (ship % 5).cast("string")).alias("operator"))
    return O.services(rows, O.port_clusters(sets, 0.6)).withColumn("operator_share", rounded("operator_share"))


@add("txt11_inferred_operators", sql("SELECT p_partkey, COALESCE(op, CASE WHEN tot >= 2 AND n >= 0.3 * tot THEN o END) AS op, COALESCE(op IS NULL AND tot >= 2 AND n >= 0.3 * tot, FALSE) AS inferred FROM x LEFT JOIN (SELECT p_brand, ARG_MAX(op, (c, op)) AS o, MAX(c) AS n, SUM(c) AS tot FROM (SELECT p_brand, op, COUNT(*) AS c FROM x WHERE op IS NOT NULL GROUP BY ALL) GROUP BY 1) USING (p_brand)", x="SELECT p_partkey, p_brand, CASE WHEN p_partkey % 3 <> 0 THEN SPLIT_PART(p_type, ' ', 1) END AS op FROM part"))
def txt11(s, d):
    x = table(s, d, "part").select("p_partkey", "p_brand", F.when(F.col("p_partkey") % 3 != 0, F.split_part("p_type", F.lit(" "), F.lit(1))).alias("op"))
    return O.inferred(x, "p_brand", "op", 0.3).select("p_partkey", "op", "inferred")
