"""DuckDB SQL of the operators 11 and 12."""

from __future__ import annotations

#: The table of CRC-32 (its fixed polynomial reversed), entry by entry.
CRC_TABLE = """
bits(n, k, c) AS (
    SELECT range, 0, range FROM range(256)
    UNION ALL SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8)
"""


def crc32(byte_list: str) -> str:
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {byte_list}), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)"


def bytes_of(text: str) -> str:
    """The UTF-8 bytes of a text of code points below 2048."""
    return f"flatten(list_transform(string_split({text}, ''), lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [192 | (unicode(ch)::BIGINT >> 6), 128 | (unicode(ch)::BIGINT & 63)] END))"


BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _edit(state: str, cost: str, letter: str, out: str) -> str:
    """A state's struct after one more edit; null stays null."""
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || {letter}, 'o': {out}}} END"


def _put(state: str, cost: str, letter: str, text: str) -> str:
    return _edit(state, cost, letter, f"{state}.o || chr(10) || {text}")


def _least(*states: str) -> str:
    return f"list_min(list_filter([{', '.join(states)}], lambda v: v IS NOT NULL))"


#: One struct (cost, audit, output) per state, forwards over the turns: nothing put out, system, assistant last, user last.
OP11_SQL = f"""
WITH RECURSIVE {CRC_TABLE}, kinds AS (
    SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
           {crc32("list_transform(string_split(COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' '), ''), lambda ch: unicode(ch)::BIGINT)")} % 20 AS kind
    FROM conversations, crc
), changed AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS again
    FROM kinds WHERE kind <> 0
), placed AS (
    SELECT *, rtrim(text, {BLANKS}) AS body, substr(role, 1, 1) AS own, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), again) AS i,
           ROW_NUMBER() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, again) > 1 AS seen FROM changed
), faulty AS (
    SELECT *, CASE WHEN body = '' THEN 'blank' WHEN seen THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           LAG(own) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed
), turns AS (SELECT *, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS extra, fault IN ('blank', 'duplicate') AS forced FROM faulty
), steps AS (
    SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 'o': ''}} AS n, NULL::STRUCT(c INT, a VARCHAR, o VARCHAR) AS s, NULL::STRUCT(c INT, a VARCHAR, o VARCHAR) AS a, NULL::STRUCT(c INT, a VARCHAR, o VARCHAR) AS u
    FROM (SELECT DISTINCT conv_id FROM turns)
    UNION ALL
    SELECT conv_id, i,
           {_edit("n", "4", "'D'", "n.o")},
           {_least(_edit("s", "4", "'D'", "s.o"), "CASE WHEN own = 's' AND NOT forced THEN " + _put("n", "extra", "'K'", "role || ':' || text") + " END")},
           {_least(_edit("a1", "4", "'D'", "a1.o"), "CASE WHEN NOT forced THEN CASE WHEN own = 'a' THEN " + _put("u1", "extra", "'K'", "role || ':' || text") + " ELSE " + _put("u1", "extra + 3", "'R'", "'assistant:' || text") + " END END")},
           {_least(_edit("u1", "4", "'D'", "u1.o"), *["CASE WHEN NOT forced THEN CASE WHEN own = 'u' THEN " + _put(x, "extra", "'K'", "role || ':' || text") + " ELSE " + _put(x, "extra + 3", "'R'", "'user:' || text") + " END END" for x in ("n", "s", "a1")])}
    FROM (
        SELECT p.*, t.own, t.role, t.text, t.extra, t.forced, {_least("p.a", _put("p.u1", "3", "'I'", "'assistant:'"))} AS a1
        FROM (SELECT conv_id, i + 1 AS i, n, s, a, {_least("u", *[_put(x, "3", "'I'", "'user:'") for x in "nsa"])} AS u1 FROM steps) p JOIN turns t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.i
    )
), ends AS (
    SELECT conv_id, {_least("n", "a", _put("u1", "3", "'I'", "'assistant:'"))} AS best
    FROM (SELECT *, {_least("u", _put("s", "3", "'I'", "'user:'"))} AS u1 FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY i DESC) AS latest FROM steps) WHERE latest = 1)
), counted AS (
    SELECT conv_id, COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps, COUNT(*) FILTER (WHERE fault = 'blank') AS blank, COUNT(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
           COUNT(*) FILTER (WHERE fault = 'truncated') AS truncated, COUNT(*) FILTER (WHERE before IS NOT NULL AND before || own NOT IN ('su', 'ua', 'au')) AS illegal
    FROM turns GROUP BY conv_id
)
SELECT d.conv_id, COALESCE(gaps, 0) AS gaps, COALESCE(blank, 0) AS blank, COALESCE(duplicate, 0) AS duplicate, COALESCE(truncated, 0) AS truncated, COALESCE(illegal, 0) AS illegal,
       CAST(COALESCE(best.c, 0) AS BIGINT) AS cost, COALESCE(best.a, '') AS audit, sha256(substr(COALESCE(best.o, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM d.conv_id
"""

#: Words are near if both lose the same code point of the same place to the same rest (replaced), or one loses one and is the other.
OP12_SQL = f"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), counted AS (SELECT COALESCE(CAST(doc_id AS VARCHAR), '') AS doc, run, COUNT(*) AS n FROM runs GROUP BY ALL
), hashed AS (SELECT *, {crc32(bytes_of("doc || ':' || run"))} AS h FROM counted, crc
), words AS (
    SELECT word, CAST(SUM(n) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING SUM(n) >= 5
), without AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)
), near AS (
    SELECT DISTINCT a.word, b.word AS other, a.n, b.n AS other_n FROM without a JOIN without b ON a.p = b.p AND a.rest = b.rest AND length(a.word) = length(b.word) AND a.word <> b.word
    UNION SELECT DISTINCT b.word, a.word, b.n, a.n FROM words a JOIN without b ON a.word = b.rest
    UNION SELECT DISTINCT a.word, b.word, a.n, b.n FROM words a JOIN without b ON a.word = b.rest
), best AS (
    SELECT word, COUNT(*) AS n_near, FIRST(other ORDER BY other_n DESC, other) AS other, MAX(other_n) AS other_n FROM near GROUP BY word
), formed AS (
    SELECT w.word, w.n, COALESCE(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 5 * w.n THEN b.other END AS form, CASE WHEN b.other_n >= 5 * w.n THEN b.other_n END AS form_n FROM words w LEFT JOIN best b USING (word)
), chains AS (
    SELECT word, word AS root, form AS next FROM formed
    UNION ALL SELECT c.word, f.word, f.form FROM chains c JOIN formed f ON f.word = c.next
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, c.root FROM formed f JOIN chains c ON c.word = f.word AND c.next IS NULL
"""
