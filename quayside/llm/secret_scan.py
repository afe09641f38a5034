"""Secret scans with DataFrame functions only: fixed patterns, and windows of high entropy in candidate strings.

Pattern matches are leftmost and non-overlapping per kind, with their places in code points. An expression that is
anchored where the last match ended takes the text up to the next match as one group and the match as another; running
sums of the lengths give the places. No array or string grows by appending, so the time is linear in the text, but for a
logarithm of the number of matches.

The entropy kind looks at candidate strings: runs of base64 or URL-safe characters of at least `window` characters that
hold a letter and a digit. A window slides over the candidate; the sum of c log2 c over the counts of its characters is
kept up to date by the character that enters and the one that leaves, so each step costs the same. The limit depends on
the character class (hexadecimal digits, one case with digits, or mixed). Pattern spans are cut out of a candidate
first; each part that is left and still is a candidate is reported whole if a window reaches its class's limit. The
allow-list takes out a part only as a whole; its words (example, ...) take out the windows that touch them, so what stands
beside such a word is looked at like any part.

Null and empty texts have no spans; ids may be null or repeat; repeated rows repeat; tables may be empty; further
columns are ignored, whatever their names. Texts and candidates may be of any length. Kinds that start at one place come
in the order of `KINDS`. Everything is per row: there is no shuffle, so no key can be hot.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick

#: Fixed patterns of the base kinds; the group that must be long enough is the last one.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]+)"
HEX = r"([0-9a-f]+)"
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "entropy")
#: Least entropy in bits per character of a window of 20, by class of the candidate's characters.
LIMITS = {"hex": 3.1, "one_case": 3.6, "mixed": 3.9}
#: What looks random and is none, as a whole: hyphenated ids, runs of one or two characters, integrity hashes of their lengths.
ALLOWED = r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$|^(.{1,2})\2+$|^sha(1-.{27}|256-.{43}|384-.{64}|512-.{86})={0,2}$"
#: Words of example keys; no window that touches one counts.
EXAMPLE = r"(?i)(example|sample|placeholder)"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, by an array of one."""
    return F.element_at(F.transform(F.array(value), use), 1)


def scanned(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Running results of an associative `op` over an array, by doubling: n log n steps, and no array grows by appending."""

    def doubled(done: Column, k: Column) -> Column:
        ahead = F.concat(F.slice(done, 1, F.least(k, F.size(done))), F.zip_with(F.slice(done, 1, F.greatest(F.size(done) - k, F.lit(0))), F.slice(done, k + 1, F.size(done)), op))
        return ahead

    steps = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")), lambda k: F.pow(F.lit(2.0), k).cast("int"))
    return F.when(F.size(values) < 2, values).otherwise(F.aggregate(steps, values, doubled))


def located(text: Column, pattern: str, first: Column | None = None) -> Column:
    """Array of (start, end, value) of all matches; `pattern` has one group, whose text is the value; places count from `first`, else 0."""
    whole = r"\G(?s:(.*?))(" + pattern + ")"
    gaps, found, values = (F.regexp_extract_all(text, F.lit(whole), F.lit(k)) for k in (1, 2, 3))
    first = F.lit(0) if first is None else first
    sizes = F.zip_with(gaps, found, lambda gap, match: F.char_length(gap) + F.char_length(match))
    ends = scanned(sizes, lambda a, b: a + b)
    parts = F.arrays_zip(ends.alias("end"), found.alias("match"), values.alias("value"))
    return F.transform(parts, lambda p: F.struct((first + p["end"] - F.char_length(p["match"])).alias("start"), (first + p["end"]).alias("end"), p["value"].alias("value")))


def none_of(kind_type: str = "array<struct<start:int,end:int,value:string>>") -> Column:
    return F.array().cast(kind_type)


def pattern_spans(text: Column, pattern: str, least: int, hint: Column) -> Column:
    """Matches whose group has `least` characters; `hint` is a cheap test without which there can be none."""
    long_enough = F.filter(located(text, pattern), lambda m: F.char_length(m["value"]) >= least)
    return F.when(hint, long_enough).otherwise(none_of())


def pieces_of(value: Column, size: int, overlap: int) -> Column:
    """An ASCII string in pieces of up to `size` characters, each with the last `overlap` ones before it."""
    step = size - overlap
    data = F.encode(value, "UTF-8")
    starts = F.sequence(F.lit(0), F.greatest(F.char_length(value) - overlap - 1, F.lit(0)), F.lit(step))
    return bound(data, lambda d: F.transform(starts, lambda at: F.decode(F.substring(d, at + 1, F.lit(size)), "UTF-8")))


def window_entropy(value: Column, window: int) -> Column:
    """The largest Shannon entropy, in bits per character, of `window` characters in a row of an ASCII string of as many.

    With c of a character among the others of a window, the sum of c log2 c grows by a fixed value as it enters and falls
    by one as it leaves; c is counted in the characters that stay. Values are whole numbers of 1e-12, so every order of
    adding gives the same sum. Pieces of the value keep each look at a character short.
    """
    terms = [round(1e12 * c * math.log2(c)) if c else 0 for c in range(window + 2)]
    change = F.array(*[F.lit(b - a) for a, b in pairwise(terms)])

    def least_sum(piece: Column) -> Column:
        def times(char: Column, among: Column) -> Column:
            return F.char_length(among) - F.char_length(F.replace(among, char, F.lit("")))

        def moved(at: Column) -> Column:
            begin = F.greatest(at - window + 1, F.lit(1))
            stay, enter = F.substring(piece, begin, at - begin), F.substring(piece, at, F.lit(1))
            gain = bound(stay, lambda s: F.element_at(change, times(enter, s) + 1) - F.when(at > window, F.element_at(change, times(F.substring(piece, at - window, F.lit(1)), s) + 1)).otherwise(F.lit(0)))
            return gain

        def step(state: Column, at: Column) -> Column:
            return bound(state["sum"] + moved(at), lambda total: F.struct(total.alias("sum"), F.when(at >= window, F.least(state["least"], total)).otherwise(state["least"]).alias("least")))

        start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(1 << 62).alias("least"))
        return F.aggregate(F.sequence(F.lit(1), F.char_length(piece)), start, step, lambda state: state["least"])

    smallest = F.array_min(F.transform(pieces_of(value, 12 * window, window - 1), least_sum))
    return F.log2(F.lit(float(window))) - smallest / (1e12 * window)


def free_places(spans: Column, first: Column, last: Column) -> Column:
    """(start, end) of what lies between first and last and beside the spans (start, end, ...), in order; empty where spans touch."""

    def cut(own: Column) -> Column:
        reach = scanned(F.transform(own, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
        ends = F.concat(F.array(first), reach)
        starts = F.concat(F.transform(own, lambda s: s["start"]), F.array(last))
        gaps = F.zip_with(ends, starts, lambda e, s: F.struct(e.alias("start"), s.alias("end")))
        return F.filter(gaps, lambda g: g["end"] >= g["start"])

    return bound(F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))), cut)


def texts_at(text: Column, places: Column, first: Column) -> Column:
    """(start, end, value) of places in a text that begins at `first`. Four bytes a character make every look equally cheap."""

    def read(wide: Column) -> Column:
        return F.transform(places, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), F.decode(F.substring(wide, 4 * (p["start"] - first) + 1, 4 * (p["end"] - p["start"])), "UTF-32").alias("value")))

    return bound(F.encode(text, "UTF-32"), read)


def parts_beside(text: Column, spans: Column, first: Column, least: int) -> Column:
    """(start, end, value) of the parts of a text, which begins at `first`, beside the spans, of `least` characters or more."""
    last = first + F.char_length(text)
    whole = F.array(F.struct(first.alias("start"), last.alias("end"), text.alias("value")))
    long_enough = F.filter(free_places(spans, first, last), lambda p: p["end"] - p["start"] >= least)
    return F.when(F.size(spans) == 0, whole).otherwise(texts_at(text, long_enough, first))


def entropy_spans(text: Column, taken: Column, window: int) -> Column:
    """Candidates beside the `taken` spans, not allowed, with a window at their class's limit that touches no word of examples."""
    run = rf"([A-Za-z0-9+/_=-]{{{window},}})"

    def candidate(value: Column) -> Column:
        return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~value.rlike(ALLOWED)

    free = F.flatten(F.transform(parts_beside(text, taken, F.lit(0), window), lambda p: located(p["value"], run, p["start"])))
    fit = F.filter(free, lambda m: candidate(m["value"]))

    def limit(value: Column) -> Column:
        one_case = value.rlike("^[^a-z]*$") | value.rlike("^[^A-Z]*$")
        return F.when(value.rlike("^[0-9a-fA-F]+$"), LIMITS["hex"]).when(one_case, LIMITS["one_case"]).otherwise(LIMITS["mixed"])

    def random(value: Column) -> Column:
        return candidate(value) & (window_entropy(value, window) >= limit(value))

    def random_beside_words(m: Column) -> Column:
        return F.exists(parts_beside(m["value"], located(m["value"], EXAMPLE, m["start"]), m["start"], window), lambda p: (F.char_length(p["value"]) >= window) & random(p["value"]))

    return F.filter(fit, lambda m: F.when(m["value"].rlike(EXAMPLE), random_beside_words(m)).otherwise(random(m["value"])))


def spans_of(text: Column, window: int = 20) -> dict[str, Column]:
    """Columns by kind; `entropy` refers to the columns assign, access and hex of the same frame."""
    return {
        "assign": pattern_spans(text, ASSIGN, 8, text.rlike("(?i)password|passwd|secret|token|api_?key")),
        "access": pattern_spans(text, ACCESS, 16, text.contains("AKIA")),
        "hex": pattern_spans(text, HEX.replace("+", "{32,}"), 32, text.rlike("[0-9a-f]{32}")),
        "entropy": F.when(text.rlike(rf"[A-Za-z0-9+/_=-]{{{window}}}"), entropy_spans(text, F.concat("assign", "access", "hex"), window)).otherwise(none_of()),
    }


def scan(docs: DataFrame, *, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, text` and the span arrays `assign, access, hex, entropy` of (start, end, value)."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    by_kind = spans_of(F.coalesce("text", F.lit("")), window)
    patterns = rows.withColumns({kind: by_kind[kind] for kind in BASE_KINDS})
    return patterns.withColumn("entropy", by_kind["entropy"])


def in_order(kinds: tuple[str, ...]) -> Column:
    """(start, rank of kind, end, kind) of all spans of these kinds, sorted."""

    def of(kind: str) -> Column:
        return F.transform(kind, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")))

    return F.array_sort(F.concat(*[of(kind) for kind in kinds]))


def joined(kinds: tuple[str, ...]) -> Column:
    return F.array_join(F.transform(in_order(kinds), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame, **options) -> DataFrame:
    """The digest of `scan`: counts of base spans, their hash, and all spans in one string."""
    found = scan(docs, **options)
    counts = [F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts[:3], F.sha2(joined(BASE_KINDS), 256).alias("base_sha256"), joined(KINDS).alias("spans"), counts[3])


def redacted(docs: DataFrame, *, window: int = 20, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """The documents, all their columns, with every span of any kind masked in the text; spans that overlap are one."""
    text = F.coalesce(docs[text_col], F.lit(""))
    by_kind = spans_of(text, window)

    def masked(spans: Column) -> Column:
        kept = texts_at(text, free_places(spans, F.lit(0), F.char_length(text)), F.lit(0))
        return F.when(F.size(spans) > 0, F.array_join(F.transform(kept, lambda p: p["value"]), mask)).otherwise(docs[text_col])

    runs = text.rlike(rf"[A-Za-z0-9+/_=-]{{{window}}}")
    base = F.concat(*[by_kind[kind] for kind in BASE_KINDS])
    hidden = bound(base, lambda taken: bound(F.when(runs, F.concat(taken, entropy_spans(text, taken, window))).otherwise(taken), masked))
    return docs.select(*[hidden.alias(c) if c == text_col else docs[c] for c in docs.columns])
