"""News-text operators: dictionary tagging, duplicates, phrase mining, digests, clusters of port sets.

Dictionaries are rule tables of a stated largest size; all their phrases are looked for at once by one automaton per
worker, over Arrow batches, so texts are read once and only results are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import groupby

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import key, similarity

#: Rules that an automaton takes; it is held by every worker.
MOST_RULES = 1_000_000


def rules_of(table: DataFrame, *columns: str) -> list[tuple]:
    """The rows of a rule table, of at most `MOST_RULES`."""
    rows = [tuple(r) for r in table.select(*columns).limit(MOST_RULES + 1).collect()]
    if len(rows) > MOST_RULES:
        raise ValueError(f"a rule table has at most {MOST_RULES} rows")
    return rows


def automaton(phrases: list[str]) -> ahocorasick.Automaton | None:
    """One automaton for all phrases; none if there are no phrases."""
    made = ahocorasick.Automaton()
    for phrase in phrases:
        if phrase:
            made.add_word(phrase, phrase)
    if not len(made):
        return None
    made.make_automaton()
    return made


def is_word(c: str) -> bool:
    return c.isalnum() or c == "_"


def whole_words(text: str, found: ahocorasick.Automaton | None) -> Iterator[str]:
    """The phrases in a text that begin and end at words' ends, from left to right, the longest at each place, none within another."""
    if found is None or not text:
        return
    hits = []
    for last, phrase in found.iter(text):
        start = last + 1 - len(phrase)
        if (not start or not is_word(text[start - 1])) and (last + 1 == len(text) or not is_word(text[last + 1])):
            hits.append((start, -last, phrase))
    end = 0
    for start, last, phrase in sorted(hits):
        if start >= end:
            end = 1 - last
            yield phrase


def tagged(articles: DataFrame, keywords: DataFrame, threshold: float) -> DataFrame:
    """Category scores of articles (doc_id, title, lead): each keyword once per field (title 2, lead 1), the longest at each place.

    `keywords` has (keyword, category, weight, exact): exact ones are looked for in the text as it is, the others, normalised,
    in its normalised form; either as whole words. One inside a longer one doesn't count there, but elsewhere it may. A
    category counts from `threshold`, the main one is the largest (ties: name). No row is shuffled.
    """
    rules = rules_of(keywords, "keyword", "category", "weight", "exact")
    shared = articles.sparkSession.sparkContext.broadcast(rules)
    bare = [F.regexp_replace(F.col(c), "<[^>]*>", " ") for c in ("title", "lead")]
    fields = articles.select("doc_id", *[key(F.col(c)).alias(f"{c}_key") for c in ("title", "lead")], *[b.alias(f"{c}_raw") for c, b in zip(("title", "lead"), bare)])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_kind = [{}, {}]
        for keyword, category, weight, exact in shared.value:
            by_kind[bool(exact)].setdefault(keyword, []).append((category, weight))
        automata = [automaton(list(words)) for words in by_kind]
        for whole in batches:
            for first in range(0, whole.num_rows, 1000):
                batch = whole.slice(first, 1000)
                out: list[list] = [[], [], [], []]
                columns = [c.to_pylist() for c in batch.columns]
                for doc_id, title, lead, title_raw, lead_raw in zip(*columns):
                    scores: dict[str, float] = {}
                    for weight, texts in ((2.0, (title, title_raw)), (1.0, (lead, lead_raw))):
                        for exact, text in enumerate(texts):
                            for phrase in set(whole_words(text or "", automata[exact])):
                                for category, w in by_kind[exact][phrase]:
                                    scores[category] = scores.get(category, 0.0) + weight * w
                    counted = {c: v for c, v in scores.items() if v >= threshold}
                    if counted:
                        main = min(counted, key=lambda c: (-counted[c], c))
                        for column, value in zip(out, (doc_id, ",".join(sorted(counted)), main, counted[main])):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.schema.field(0).type), pa.array(out[1], pa.string()), pa.array(out[2], pa.string()), pa.array(out[3], pa.float64())], ["doc_id", "categories", "main", "score"])

    return fields.mapInArrow(each, f"doc_id {dict(articles.dtypes)['doc_id']}, categories string, main string, score double")


def mentions(articles: DataFrame, text: str, code: str, ambiguous: list[str], context: str, reach: int = 14) -> DataFrame:
    """Codes named in a text as words of their own; half weight beyond five codes.

    `code` and `context` are patterns. An ambiguous code counts only if, before one of its places, a context word ends at
    most `reach` characters away. Null and empty texts name nothing.
    """
    codes = F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?:^| )({code})(?: |$)"), F.lit(1)))
    meant = [F.when(F.col(text).rlike(f"(?s)(?:{context}).{{0,{reach}}}(?:^| )(?:{a})(?: |$)"), F.lit(a)) for a in ambiguous]
    allowed = F.array_compact(F.array(*meant)) if ambiguous else F.array().cast("array<string>")
    kept = F.filter(codes, lambda c: ~c.isin(ambiguous) | F.array_contains(allowed, c))
    out = articles.select("doc_id", kept.alias("codes")).where(F.size("codes") > 0)
    return out.select("doc_id", F.explode("codes").alias("code"), F.when(F.size("codes") > 5, 0.5).otherwise(1.0).alias("weight"))


def title_key(title: Column, length: int = 90) -> Column:
    return F.sha1(F.substring(key(title), 1, length))


#: Length of the character runs by which similar titles meet, and how many of them two titles share at most for it.
RUN, SHARED = 3, 8
#: Least length of a title that may stand within another, the share of it that must, and the length of runs by which they meet.
LEAST_INSIDE, INSIDE, INNER = 40, 0.95, 12


def edits_inside(short: str, long: str) -> int:
    """Fewest edits between a text and any part of another, with the columns of the edit table as bits of one number."""
    n = len(short)
    full, top = (1 << n) - 1, 1 << (n - 1)
    places: dict[str, int] = {}
    for i, c in enumerate(short):
        places[c] = places.get(c, 0) | 1 << i
    more, less, here, best = full, 0, n, n
    for c in long:
        same = places.get(c, 0)
        diagonal = same | less
        level = (((same & more) + more) ^ more) | same
        up, down = (less | ~(level | more)) & full, more & level
        here += bool(up & top) - bool(down & top)
        best = min(best, here)
        up, down = up << 1 & full, down << 1 & full
        more, less = (down | ~(diagonal | up)) & full, up & diagonal
    return best


def title_pairs(nodes: DataFrame, least: float) -> DataFrame:
    """`node, node2` of titles that could be similar, in one slot or the next, both ways.

    Two titles of at most n characters differ by k = (1 - least) n edits at most, and an edit changes `RUN` of a title's
    character runs. So of any k RUN + 1 runs of a title one is in the other too, no more than k places off: the rarest are
    taken, and titles meet by slot, run and place. No pair is lost.
    """
    places = F.sequence(F.lit(1), F.greatest(F.col("n") - RUN + 1, F.lit(1)))
    runs = nodes.where(F.col("n") >= RUN).withColumn("p", F.explode(places)).withColumn("run", F.substr("k", F.col("p"), F.lit(RUN)))
    rarity = runs.groupBy("run").agg(F.count("*").alias("df"))
    # The longer of two similar titles has at most n / least characters; rounding may not take an edit away.
    edits = F.floor((1 - least) * F.col("n") / least + 1e-9)
    rank = F.rank().over(Window.partitionBy("node").orderBy("df", "run"))  # a run that is in is so wherever it stands
    rare = runs.join(rarity, "run").withColumn("edits", edits).withColumn("m", F.least(F.lit(SHARED), F.col("n") - RUN + 1 - F.col("edits") * RUN)).withColumn("r", rank).where(F.col("r") <= F.col("edits") * RUN + F.col("m"))
    a = rare.select("node", "slot", "n", "run", "p", "edits", "m").withColumn("_slot", F.explode(F.array(F.col("slot"), F.col("slot") + 1)))
    b = a.select("run", "_slot", *[F.col(c).alias(f"{c}2") for c in ("node", "slot", "n", "p", "edits", "m")])
    close = (F.col("_slot") == F.greatest("slot", "slot2")) & (F.col("node") < F.col("node2"))
    close &= (F.abs(F.col("p") - F.col("p2")) <= F.greatest("edits", "edits2")) & (F.abs(F.col("n") - F.col("n2")) <= (1 - least) * F.greatest("n", "n2") + 1e-9)
    met = a.join(b, ["run", "_slot"]).where(close).groupBy("node", "node2").agg(F.countDistinct("p").alias("matches"), F.min(F.least("m", "m2")).alias("m")).where("matches >= m")
    return met.select("node", "node2").unionByName(met.select(F.col("node2").alias("node"), F.col("node").alias("node2")))


def inner_pairs(nodes: DataFrame) -> DataFrame:
    """`node, node2` of titles of `LEAST_INSIDE` characters or more, of which one may stand within the other, in one slot or the next, both ways.

    The shorter may differ from a part of the longer by k edits; of k + 1 segments of it one is there unchanged. So the first
    `INNER` characters of each segment, or all of a shorter one, meet all runs of that length of the longer.
    """
    long_enough = nodes.where(F.col("n") >= LEAST_INSIDE).withColumn("parts", F.floor((1 - INSIDE) * F.col("n") + 1e-9).cast("int") + 1)
    width = F.least(F.lit(INNER), F.floor(F.col("n") / F.col("parts"))).cast("int")
    slots = F.explode(F.array(F.col("slot"), F.col("slot") + 1))
    begins = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.floor(k * F.col("n") / F.col("parts")).cast("int") + 1)
    short = long_enough.withColumn("_slot", slots).withColumn("w", width).withColumn("at", F.explode(begins)).select("node", "slot", "n", "_slot", "w", F.substr("k", F.col("at"), F.col("w")).alias("run"))
    widths = long_enough.select(width.alias("w")).distinct()
    longer = long_enough.withColumn("_slot", slots).join(F.broadcast(widths), F.col("w") <= F.col("n")).withColumn("at", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("w") + 1)))
    longer = longer.select(F.col("node").alias("node2"), F.col("slot").alias("slot2"), F.col("n").alias("n2"), "_slot", "w", F.substr("k", F.col("at"), F.col("w")).alias("run"))
    met = short.join(longer, ["_slot", "w", "run"]).where((F.col("_slot") == F.greatest("slot", "slot2")) & (F.col("node") != F.col("node2")) & (F.col("n") <= F.col("n2"))).select("node", "node2").distinct()
    return met.unionByName(met.select(F.col("node2").alias("node"), F.col("node").alias("node2"))).distinct()


def inside_of(pairs: DataFrame) -> DataFrame:
    """The pairs (.., k, k2) of which the shorter stands within the longer, but for the edits allowed."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("k").to_pylist(), batch.column("k2").to_pylist(), strict=True):
                short, long = sorted((a, b), key=len)
                keep.append(edits_inside(short, long) <= (1 - INSIDE) * len(short) + 1e-9)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(each, pairs.schema)


def near_duplicates(articles: DataFrame, hours: int = 36, least: float = 0.86) -> DataFrame:
    """Group id per article: each title joins the group of the most similar one (`least` or more) of the `hours` before it, ties to the
    earliest; without one, of the most similar one that it stands within, or that stands within it; else it has its own.
    Groups whose first titles have one title key are one, and bear their smallest article's id.

    Equal titles of one slot of `hours` are one node with its first article and last hour. A node's first article decides;
    the others have an equal title before them. So a node's parent is a node of its slot that began before it, or one of
    the slot before whose last article is near enough. Articles without title are their own group.
    """
    slot = F.floor(F.col("hour_no") / hours)
    keyed = articles.select("doc_id", "hour_no", key(F.col("title")).alias("k")).withColumn("slot", slot)
    nodes = keyed.where(F.length("k") > 0).groupBy("k", "slot").agg(F.min(F.struct("hour_no", "doc_id")).alias("f"), F.max("hour_no").alias("last"))
    nodes = checkpointed(nodes.select(F.col("f.doc_id").alias("node"), "k", "slot", F.col("f.hour_no").alias("first"), "last", F.length("k").alias("n")))
    other = nodes.select(*[F.col(c).alias(f"{c}2") for c in ("node", "k", "slot", "first", "last")])
    own_before = nodes.join(nodes.select("k", (F.col("slot") + 1).alias("slot"), F.col("node").alias("node2")), ["k", "slot"]).select("node", "node2")
    earlier = ((F.col("slot") == F.col("slot2")) & (F.struct("first2", "node2") < F.struct(F.col("first").alias("first2"), F.col("node").alias("node2")))) | ((F.col("slot2") == F.col("slot") - 1) & (F.col("last2") >= F.col("first") - hours))

    def met(pairs: DataFrame) -> DataFrame:
        return pairs.join(nodes, "node").join(other, "node2").where(earlier)

    def parent(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("node").agg(F.min_by("node2", F.struct((-similarity(F.col("k"), F.col("k2"))).alias("s"), "first2", "node2")).alias("to"))

    alike = met(title_pairs(nodes, least).unionByName(own_before).distinct()).where(similarity(F.col("k"), F.col("k2")) >= least)
    first = checkpointed(parent(alike))
    rest = met(inner_pairs(nodes)).join(first, "node", "left_anti")
    within = parent(inside_of(rest.select("node", "node2", "k", "k2", "first2")))
    to = nodes.select("node").join(first.unionByName(within), "node", "left").select("node", F.coalesce("to", "node").alias("to"))
    while True:  # parents are earlier, so each chain ends; steps double
        jumped = checkpointed(to.join(to.select(F.col("node").alias("to"), F.col("to").alias("end")), "to").select("node", F.col("end").alias("to"), (F.col("end") != F.col("to")).alias("moved")))
        to = jumped.select("node", "to")
        if jumped.where("moved").isEmpty():
            break
    roots = to.join(nodes.select(F.col("node").alias("to"), F.substring("k", 1, 90).alias("root_key")), "to").select("node", "root_key")
    named = keyed.join(nodes.select("k", "slot", "node"), ["k", "slot"], "left").join(roots, "node", "left")
    ids = named.where("root_key IS NOT NULL").groupBy("root_key").agg(F.min("doc_id").alias("grp"))
    return named.join(ids, "root_key", "left").select("doc_id", F.coalesce("grp", "doc_id").alias("grp"))


def checkpointed(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        from ..sources.files import shared_path

        spark.sparkContext.setCheckpointDir(shared_path(spark, "steps"))
    return df.checkpoint()


def attention(articles: DataFrame, group: str) -> DataFrame:
    """Event score, plus one for a named entity, plus the other sources of the group, four at most."""
    sources = articles.groupBy(group).agg(F.countDistinct("source").alias("sources"))
    return articles.join(sources, group).withColumn("attention", F.col("event") + F.col("has_entity") + F.least(F.col("sources") - 1, F.lit(4)))


#: Bytes of text that a task takes at once, hashes that it holds, runs that are added up at once, and ids that are sent to all tasks, at most.
MOST_AT_ONCE, MOST_HASHES, MOST_RUNS, MOST_IDS = 4 << 20, 4 << 20, 4 << 20, 1_000_000
#: Bits of a hash that name its part, bits that are kept below them, and bits that name a part of the counts.
PART, REST, COUNT_PART = 12, 24, 9
#: Odd numbers: the base of hashes of bytes, and one by which they are mixed.
BASE, MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)


def kept(df: DataFrame) -> DataFrame:
    """The rows as a compressed table in a folder that all executors see; the files of its shuffles go when it is written."""
    from ..sources.files import shared_path

    spark, setting = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path, before = shared_path(spark, "kept"), spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        df.select("*").write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(setting, before)
    return spark.read.schema(df.schema).parquet(path)


def once_each(docs: DataFrame) -> DataFrame:
    """`doc_id, words, ...` without later documents of the same words; only hashes and ids are compared."""
    hashed = kept(docs.select("doc_id", F.xxhash64("words").alias("h"), F.xxhash64(F.reverse("words")).alias("h2")))
    firsts = hashed.groupBy("h", "h2").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    later = kept(hashed.join(firsts, ["h", "h2"]).where(F.col("doc_id") != F.col("first")).select("doc_id"))
    # Texts stay where they are while the ids are few.
    return docs.join(F.broadcast(later), "doc_id", "left_anti") if later.count() <= MOST_IDS else kept(docs.join(later, "doc_id", "left_anti"))


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and the last ends; nulls are empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, at, data = texts.buffers()
    ends = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def words_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of texts: the number of the text, the first byte and the one after the last."""
    blanks = np.flatnonzero(data == 32)
    n = np.bincount(np.searchsorted(ends, blanks, side="right") - 1, minlength=len(ends) - 1) + 1
    return np.repeat(np.arange(len(n)), n), np.sort(np.concatenate([ends[:-1], blanks + 1]), kind="stable"), np.sort(np.concatenate([blanks, ends[1:]]), kind="stable")


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def hasher(data: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """64-bit hashes of parts of bytes, by their first byte and the one after the last: sums of powers, moved to the first."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data))[:-1], dtype=np.uint64)])
    back = powers(pow(BASE, -1, 1 << 64), len(data))
    return lambda start, end: (sums[end] - sums[start]) * back[start]


def first_bits(h: np.ndarray) -> np.ndarray:
    """Hashes mixed, and of these the first bits: those of the part and of the rest."""
    return ((h ^ (h >> np.uint64(32))) * MIX) >> np.uint64(64 - PART - REST)


def at_most(h: np.ndarray, n: int) -> np.ndarray:
    """Sorted numbers, each n times at most."""
    return h[np.concatenate([np.ones(min(n, len(h)), bool), h[n:] != h[:-n]])]


def packed(h: np.ndarray) -> pa.RecordBatch:
    """Sorted cut hashes as a row per part: what is kept of the rest, three bytes each."""
    low = np.ascontiguousarray(h.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : REST // 8])
    ends = np.searchsorted(h, np.arange((1 << PART) + 1, dtype=np.uint64) << np.uint64(REST)).astype(np.int32)
    rests = pa.Array.from_buffers(pa.binary(), 1 << PART, [None, pa.py_buffer(ends * np.int32(REST // 8)), pa.py_buffer(low)])
    some = pa.array(np.flatnonzero(np.diff(ends)).astype(np.int32))
    return pa.RecordBatch.from_arrays([some, rests.take(some)], ["part", "rests"])


def by_group(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[list]]]:
    """Rows in a row whose first `keys` values are equal: these values, and the others of each row."""
    rows = (r for batch in batches for r in zip(*(c.to_pylist() if k < keys else c for k, c in enumerate(batch.columns))))
    for key_, group in groupby(rows, lambda r: r[:keys]):
        yield key_, (r[keys:] for r in group)


def often(hashes: DataFrame, least: int) -> DataFrame:
    """Per part a row of bits for the hashes that occur `least` times, some sixteen bits each: `part, size, bits`."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part,), rows in by_group(batches, 1):
            three = np.frombuffer(b"".join(r[0].as_buffer() for r in rows), np.uint8).reshape(-1, REST // 8).astype(np.uint32)
            rest = np.sort(three[:, 0] | three[:, 1] << np.uint32(8) | three[:, 2] << np.uint32(16))
            found = np.unique(rest[least - 1 :][rest[least - 1 :] == rest[: max(len(rest) - least + 1, 0)]])
            if len(found):
                size = min(max((16 * len(found) - 1).bit_length(), 3), 29 - PART)
                bits = np.zeros(1 << size, bool)
                bits[found >> np.uint32(REST - size)] = True
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([size], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()])], ["part", "size", "bits"])

    return hashes.repartition("part").sortWithinPartitions("part").mapInArrow(each, "part int, size int, bits binary")


def sieve(of: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bits of hashes that occur `often`: what isn't there is none. Of each part, where its bits begin and what to shift the rest by.

    It grows with what it holds, to 64 MB at most; a full one only sifts less.
    """
    found = kept(of).toArrow()
    first, shift = np.zeros(1 << PART, np.int64), np.full(1 << PART, REST, np.uint64)
    part, size = (found.column(k).to_numpy().astype(np.int64) for k in (0, 1))
    # Parts without a hash look at the first bit, which is not set.
    first[part], shift[part] = 8 + np.cumsum(1 << size) - (1 << size), (REST - size).astype(np.uint64)
    return first, shift, np.frombuffer(b"".join([b"\0", *(v.as_buffer() for v in found.column(2))]), np.uint8)


def sifted(h: np.ndarray, bits: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Which hashes of runs the sieve holds back."""
    first, shift, held = bits
    h = first_bits(h)
    part = (h >> np.uint64(REST)).astype(np.int64)
    bit = first[part] + ((h & np.uint64((1 << REST) - 1)) >> shift[part]).astype(np.int64)
    return (held[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def numbered(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers from 0 for values, equal ones for equal values, and the value of each."""
    found = values.dictionary_encode(null_encoding="encode")
    return found.indices.to_numpy().astype(np.int64), found.dictionary


def in_pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of some `MOST_AT_ONCE` bytes of its first column, of one row at least."""
    piece = np.cumsum(pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy().astype(np.int64)) // MOST_AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for first, last in zip(cuts, cuts[1:]):
        if last > first:
            yield batch.slice(first, last - first)


def pair_hashes(docs: DataFrame, least: int) -> DataFrame:
    """The bits of the pairs of neighbouring words that `least` documents have, and of some more; three bytes for a pair are shuffled."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for whole in batches:
            for batch in in_pieces(whole):
                data, ends = bytes_of(batch.column(0))
                text, start, end = words_of(data, ends)
                at = np.flatnonzero(text[:-1] == text[1:])
                below = np.uint64(64 - PART - REST)
                once = np.sort(first_bits(hasher(data)(start[at], end[at + 1])) << below | text[at].astype(np.uint64))
                held.append(at_most(at_most(once, 1) >> below, least))
                if sum(map(len, held)) >= MOST_HASHES:
                    yield packed(at_most(np.sort(np.concatenate(held)), least))
                    held = []
        if held:
            yield packed(at_most(np.sort(np.concatenate(held)), least))

    return often(docs.select("words").mapInArrow(each, "part int, rests binary"), least)


def phrase_hashes(found: DataFrame) -> DataFrame:
    """The bits of all phrases."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = bytes_of(batch.column(0))
            yield packed(np.sort(first_bits(hasher(data)(ends[:-1], ends[1:]))))

    return often(found.select("phrase").mapInArrow(each, "part int, rests binary"), 1)


def texts_of(sizes: np.ndarray, data) -> pa.Array:
    """Texts of so many bytes each."""
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)), pa.py_buffer(data))


def counted(docs: DataFrame, columns: list[str], lengths: list[int], bits, parts: int | None = None, least: int = 1) -> DataFrame:
    """Per value of `columns` and run of so many words, the number of documents with it, if there are `least`.

    Only runs count that a sieve (its broadcast) holds back or, with `parts`, whose runs of that many words it does. What is
    left is told apart by its text, and only that is made. Tasks add up what they take at once, and shuffle it packed: texts
    and counts, compressed, in a row per part of the runs.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in in_pieces(whole):
                data, ends = bytes_of(batch.column(0))
                text, start, end = words_of(data, ends)
                hashes, starts, sizes = hasher(data), [], []
                docs_of = []
                known = {}
                for n in sorted({*lengths, *([parts] if parts else [])}):
                    at = np.flatnonzero(text[: max(len(text) - n + 1, 0)] == text[n - 1 :])
                    if parts and n > parts:
                        at = at[np.logical_and.reduce([known[parts][at + k] for k in range(n - parts + 1)])]
                    else:
                        at = at[sifted(hashes(start[at], end[at + n - 1]), bits.value)]
                    known[n] = np.zeros(len(text), bool)
                    known[n][at] = True
                    if n in lengths:
                        docs_of.append(text[at])
                        starts.append(start[at])
                        sizes.append(end[at + n - 1] - start[at])
                doc, first, size = (np.concatenate(x) for x in (docs_of, starts, sizes))
                if not len(doc):
                    continue
                until = np.cumsum(size)
                run, phrases_ = numbered(texts_of(size, data[np.repeat(first - (until - size), size) + np.arange(until[-1])]))
                some = np.empty(len(phrases_), np.int64)
                some[run] = np.arange(len(run))
                part = (first_bits(hashes(first[some], (first + size)[some])) >> np.uint64(PART + REST - COUNT_PART)).astype(np.int64)
                once = pc.unique(pa.array(doc * len(phrases_) + run)).to_numpy()
                doc, run = once // len(phrases_), once % len(phrases_)
                group = np.zeros(batch.num_rows, np.int64)
                for c in batch.columns[1:]:
                    other, values = numbered(c)
                    group, _ = numbered(pa.array(group * len(values) + other))
                cell, cells = numbered(pa.array(group[doc] * len(phrases_) + run))
                one = np.empty(len(cells), np.int64)
                one[cell] = np.arange(len(cell))
                row = (group[doc[one]] << COUNT_PART) + part[run[one]]
                order = np.argsort(row, kind="stable")
                row, one, n = row[order], one[order], np.bincount(cell, minlength=len(cells))[order]
                made, until = bytes_of(phrases_.take(pa.array(run[one])))
                begin = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                stop = np.append(begin[1:], len(row))
                own = [c.take(pa.array(doc[one[begin]])) for c in batch.columns[1:]]
                numbers = [pa.compress(np.concatenate([np.diff(until[a : b + 1]), n[a:b]]).astype("<u4").tobytes(), "zstd", asbytes=True) for a, b in zip(begin, stop)]
                texts = [pa.compress(made[until[a] : until[b]].tobytes(), "zstd", asbytes=True) for a, b in zip(begin, stop)]
                yield pa.RecordBatch.from_arrays([pa.array(row[begin].astype(np.int32) & np.int32((1 << COUNT_PART) - 1)), *own, pa.array((stop - begin).astype(np.int32)), pa.array((until[stop] - until[begin]).astype(np.int32)), pa.array(numbers, pa.binary()), pa.array(texts, pa.binary())], names)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, *own), rows in by_group(batches, 1 + len(columns)):
            phrases_, sums = texts_of(np.zeros(0, np.int64), b""), np.zeros(0, np.int64)
            more, counts = [], []
            for last, (k, size, numbers, texts) in marked_last(rows):
                k, size = k.as_py(), size.as_py()
                numbers = np.frombuffer(pa.decompress(numbers.as_buffer(), 8 * k, "zstd"), "<u4")
                more.append(texts_of(numbers[:k], pa.decompress(texts.as_buffer(), size, "zstd") if size else b""))
                counts.append(numbers[k:])
                if last or sum(map(len, counts)) >= MOST_RUNS:
                    run, phrases_ = numbered(pa.concat_arrays([phrases_, *more]))
                    sums = np.bincount(run, np.concatenate([sums, *counts]), len(phrases_)).astype(np.int64)
                    more, counts = [], []
            keep = np.flatnonzero(sums >= least)
            for a in range(0, len(keep), 100_000):
                at = keep[a : a + 100_000]
                yield pa.RecordBatch.from_arrays([*(pa.array([v] * len(at), pa.string()) for v in own), phrases_.take(pa.array(at)).cast(pa.string()), pa.array(sums[at])], [*columns, "phrase", "n"])

    names = ["_part", *columns, "_rows", "_size", "_numbers", "_texts"]
    own_schema = [f"{c} string" for c in columns]
    rows = docs.select("words", *columns).mapInArrow(each, ", ".join(["_part int", *own_schema, "_rows int, _size int, _numbers binary, _texts binary"]))
    return rows.repartition("_part").sortWithinPartitions("_part", *columns).mapInArrow(added, ", ".join([*own_schema, "phrase string", "n long"]))


def marked_last(rows: Iterator) -> Iterator[tuple[bool, object]]:
    """Each row, and whether it is the last."""
    rows = iter(rows)
    held = next(rows, None)
    while held is not None:
        following = next(rows, None)
        yield following is None, held
        held = following


def phrases(docs: DataFrame, least: int, cut: float = 0.8, longest: int = 4) -> DataFrame:
    """Document frequency of phrases of two to `longest` words; one inside a longer phrase with `cut` of its df is out.

    `docs` has (doc_id, words: the words joined by blanks), each text once. Pairs of words are counted as hashes first; only
    runs all of whose pairs are frequent are counted as texts at all, which a sieve tells the tasks.
    """
    bits = docs.sparkSession.sparkContext.broadcast(sieve(pair_hashes(docs, least)))
    df = by_length(longest, lambda n: counted(docs, [], [n], bits, 2, least)).withColumnRenamed("n", "df")
    words = F.split("phrase", " ")
    shorter = df.where(F.size(words) > 2).select(F.col("df").alias("long_df"), F.explode(F.array(F.array_join(F.slice(words, 1, F.size(words) - 1), " "), F.array_join(F.slice(words, 2, F.size(words) - 1), " "))).alias("phrase"))
    most = shorter.groupBy("phrase").agg(F.max("long_df").alias("long_df"))
    return kept(df.join(most, "phrase", "left").where(F.col("long_df").isNull() | (F.col("long_df") < cut * F.col("df"))).select("phrase", "df"))


def by_length(longest: int, counts: Callable[[int], DataFrame]) -> DataFrame:
    """Counts of runs of two to `longest` words, made and kept one length after the other: the shuffle of one is on disk at a time."""
    return reduce(DataFrame.unionByName, [kept(counts(n)) for n in range(2, longest + 1)])


def counts_of(docs: DataFrame, found: DataFrame, columns: list[str], longest: int = 4) -> DataFrame:
    """How many documents have each found phrase, per value of `columns`, with its df in all."""
    bits = docs.sparkSession.sparkContext.broadcast(sieve(phrase_hashes(found)))
    return by_length(longest, lambda n: counted(docs, columns, [n], bits)).join(found, "phrase")


def lifted(docs: DataFrame, found: DataFrame, least_lift: float, n: int) -> DataFrame:
    """Phrases that are `least_lift` times as frequent in a category as overall, the best n per category."""
    per = counts_of(docs, found, ["category"])
    sizes = kept(docs.groupBy("category").agg(F.count("*").alias("docs")))
    # Counts stay where they are while the categories are few: only each task's best are shuffled by category.
    sizes = F.broadcast(sizes) if sizes.count() <= MOST_IDS else sizes
    total = docs.agg(F.count("*").alias("total"))
    scored = per.join(sizes, "category").join(F.broadcast(total)).withColumn("lift", (F.col("n") / F.col("docs")) / (F.col("df") / F.col("total"))).where(F.col("lift") >= least_lift)
    rank = F.row_number().over(Window.partitionBy("category").orderBy(F.desc("lift"), F.desc("n"), "phrase"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= n).select("category", "phrase", "n", "df", "lift", "rank")


def gaps(docs: DataFrame, found: DataFrame, tags: DataFrame, least: int = 3) -> DataFrame:
    """Phrases of at least `least` documents that got no category: what the dictionary lacks."""
    return counts_of(kept(docs.join(tags.select("doc_id"), "doc_id", "left_anti")), found, []).where(F.col("n") >= least)


def pattern_events(rows: DataFrame, id_col: str, owner: str, text: str, patterns: dict[str, str]) -> DataFrame:
    """Labels of all patterns that occur, per row and rolled up per owner."""
    each = F.filter(F.array(*[F.when(F.col(text).rlike(p), F.lit(label)) for label, p in patterns.items()]), lambda x: x.isNotNull())
    hits = rows.select(id_col, owner, F.explode(each).alias("label"))
    return hits.groupBy(owner).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"))


def watched(rows: DataFrame, words: str, watch: list[str]) -> DataFrame:
    return rows.where(F.arrays_overlap(words, F.array(*[F.lit(w) for w in watch])))


def digest(rows: DataFrame, used: DataFrame, first: int, last: int, per_topic: int, most: int) -> DataFrame:
    """Rows in the window that weren't used, one per group, by score, sources and time, capped per topic and in all.

    The caps grow by half beyond 30 hours and double beyond 96.
    """
    hours = last - first
    scale = 1.0 if hours <= 30 else 1.5 if hours <= 96 else 2.0
    fresh = rows.where(F.col("hour_no").between(first, last)).join(used, "doc_id", "left_anti")
    one = fresh.groupBy("grp").agg(F.max_by(F.struct(*fresh.columns), F.struct("score", "sources", "hour_no", "doc_id")).alias("r")).select("r.*")
    order = [F.desc("score"), F.desc("sources"), F.desc("hour_no"), F.desc("doc_id")]
    ranked = one.withColumn("rank", F.row_number().over(Window.partitionBy("topic").orderBy(*order))).where(F.col("rank") <= int(per_topic * scale))
    return ranked.orderBy(*order).limit(int(most * scale))


def similar_sets(sets: DataFrame, least: float) -> DataFrame:
    """`a, b, jaccard`: the pairs of distinct sets (id, items) of Jaccard similarity `least` or more, a < b.

    A set's items are ordered by rarity. Two similar sets share one of the first n - ceil(least n) + 1 items of either, so only
    these meet, and only sets of a like size; what meets is compared exactly. A common item alone brings nothing together.
    """
    each = sets.select("id", F.explode("items").alias("item"))
    rarity = each.groupBy("item").agg(F.count("*").alias("df"))
    ordered = each.join(rarity, "item").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "item"))).alias("o"))
    n = F.size("o")
    first = F.slice("o", F.lit(1), (n - F.ceil(n * least - 1e-9) + 1).cast("int"))
    short = ordered.select("id", n.alias("n"), F.explode(F.transform(first, lambda x: x["item"])).alias("item"))
    a, b = short.alias("a"), short.alias("b")
    near = (F.col("a.item") == F.col("b.item")) & (F.col("a.id") < F.col("b.id")) & (F.least("a.n", "b.n") >= least * F.greatest("a.n", "b.n") - 1e-9)
    met = a.join(b, near).select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()
    left, right = (sets.select(F.col("id").alias(c), F.col("items").alias(f"items_{c}")) for c in "ab")
    both = F.size(F.array_intersect("items_a", "items_b"))
    return met.join(left, "a").join(right, "b").select("a", "b", (both / (F.size("items_a") + F.size("items_b") - both)).alias("jaccard")).where(F.col("jaccard") >= least)


def port_clusters(sets: DataFrame, least: float) -> DataFrame:
    """`ports, freq, cluster`: leader clustering of distinct port sets (ports: joined by bars). In order of frequency, then of the text, a set joins the most similar
    leader before it (ties: the earliest), or leads a cluster, named by its ports, itself.

    A set's only possible leaders are similar sets before it. Leaders are found in rounds: a set all of whose earlier
    similar sets are followers is a leader; one with an earlier leader is a follower.
    """
    distinct = checkpointed(sets.groupBy("ports").agg(F.count("*").alias("freq")).withColumn("place", F.struct((-F.col("freq")).alias("f"), "ports")))
    similar = similar_sets(distinct.select(F.col("ports").alias("id"), F.array_distinct(F.split("ports", r"\|")).alias("items")), least)
    place = distinct.select("ports", "place")
    placed = similar.join(place.select(F.col("ports").alias("a"), F.col("place").alias("pa")), "a").join(place.select(F.col("ports").alias("b"), F.col("place").alias("pb")), "b")
    a_first = F.col("pa") < F.col("pb")
    pairs = checkpointed(placed.select(F.when(a_first, F.col("b")).otherwise(F.col("a")).alias("ports"), F.when(a_first, F.col("a")).otherwise(F.col("b")).alias("before"), F.least("pa", "pb").alias("place"), "jaccard"))
    state = distinct.select("ports", F.lit(None).cast("boolean").alias("leader"))
    while True:
        seen = pairs.join(state.select(F.col("ports").alias("before"), F.col("leader").alias("l")), "before").groupBy("ports").agg(F.bool_or("l").alias("any_leader"), F.count_if(F.col("l").isNull()).alias("open"))
        joined = state.join(seen, "ports", "left")
        decided = F.when(F.col("leader").isNotNull(), F.col("leader")).when(F.col("any_leader"), False).when(F.coalesce("open", F.lit(0)) == 0, True)
        state = checkpointed(joined.select("ports", decided.alias("leader")))
        if state.where("leader IS NULL").isEmpty():
            break
    leaders = state.where("leader").select(F.col("ports").alias("before"))
    best = pairs.join(leaders, "before").groupBy("ports").agg(F.min_by("before", F.struct((-F.col("jaccard")).alias("j"), "place")).alias("best"))
    joined = distinct.join(state, "ports").join(best, "ports", "left")
    return joined.select("ports", "freq", F.when(F.col("leader"), F.col("ports")).otherwise(F.col("best")).alias("cluster"))


def services(rows: DataFrame, clusters: DataFrame) -> DataFrame:
    """Per cluster of ships' rows (ship_key, ports, name, operator; names and operators may be null): ships, its name if at least half of the
    rows bear it, ports of at least half of the rows, and the most common operator with its share of the known ones."""
    joined = rows.join(clusters.select("ports", "cluster"), "ports")
    sizes = joined.groupBy("cluster").agg(F.count("*").alias("rows"), F.countDistinct("ship_key").alias("ships"))

    def most(column: str) -> DataFrame:
        counts = joined.where(F.col(column).isNotNull()).groupBy("cluster", column).agg(F.count("*").alias("n"))
        return counts.groupBy("cluster").agg(F.min_by(column, F.struct((-F.col("n")).alias("o"), column)).alias(f"_{column}"), F.max("n").alias(f"_n_{column}"), F.sum("n").alias(f"_known_{column}"))

    ports = joined.select("cluster", F.explode(F.array_distinct(F.split("ports", r"\|"))).alias("port")).groupBy("cluster", "port").agg(F.count("*").alias("n"))
    core = ports.join(sizes, "cluster").where(2 * F.col("n") >= F.col("rows")).groupBy("cluster").agg(F.array_join(F.array_sort(F.collect_list("port")), "|").alias("core_ports"))
    out = sizes.join(most("name"), "cluster", "left").join(most("operator"), "cluster", "left").join(core, "cluster", "left")
    named = F.when(2 * F.col("_n_name") >= F.col("rows"), F.col("_name"))
    return out.select("cluster", "rows", "ships", named.alias("service"), "core_ports", F.col("_operator").alias("operator"), F.try_divide("_n_operator", "_known_operator").alias("operator_share"))


def inferred(rows: DataFrame, cluster: str, operator: str, least: float, known: int = 2) -> DataFrame:
    """Unknown operators take the cluster's most common one if it has the share `least` of at least `known` known rows."""
    counts = rows.where(F.col(operator).isNotNull()).groupBy(cluster, operator).agg(F.count("*").alias("n"))
    best = counts.groupBy(cluster).agg(F.max_by(operator, F.struct("n", operator)).alias("_op"), F.max("n").alias("_n"), F.sum("n").alias("_all"))
    sure = best.where((F.col("_all") >= known) & (F.col("_n") >= least * F.col("_all"))).select(cluster, "_op")
    return rows.join(sure, cluster, "left").withColumn("inferred", F.col(operator).isNull() & F.col("_op").isNotNull()).withColumn(operator, F.coalesce(operator, "_op")).drop("_op")
