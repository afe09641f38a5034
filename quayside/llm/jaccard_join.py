"""N-gram Jaccard join with adaptive multi-match prefixes, resolved to components.

A document is the set of its distinct word shingles, as 64-bit hashes. Documents with the same set are one node, told
apart by a 128-bit hash of it: a node's id is the first half; where sets of unlike second halves share it, which is looked
up for all of them, their ids are the second halves. Two nodes link when their sets' Jaccard similarity reaches the
threshold t.

1. In any order of all shingles, the first n - o + l of two linked nodes share at least l, where o = ceil(t n) and n is a
   set's size. With the order of the hashes and l = n / 10, these prefixes (a fifth of all shingles for t = 0.9) go
   through one exchange that finds those which another node of a size within t has too; a node with fewer of them than
   l is out. For most corpora nearly all nodes end here. The texts of the others are fetched again by their first ids.
2. All shingles of the nodes that stayed are looked at in the same way; as linked sets share at least t of either's
   shingles, a node needs as many that another of like size has. They are ordered by rarity; those of one node alone come first, and their number is
   known without listing them. With overlap bound o = ceil(t n), the first n - o + l shingles of two linked nodes share
   at least l, for any l. Each node chooses the l that makes its estimated cost least: postings it scans, plus
   candidates to verify, of which each needs l postings. A pair needs min(l) shared prefix shingles.
3. Prefix postings are first linked to one pivot per shingle, which joins the bulk of any group of near copies with one
   row per posting. Shingles whose nodes are all in one component are then done. For the others pairs of different
   components are made, in the numbers of shared prefix shingles required, and verified exactly. Three bounds keep the
   join from giving out pairs that can't link: the sizes, the matches before a shingle plus the room behind it, and the
   sum of the smaller counts of a histogram of either set, by hash, which is never less than the overlap. No pair is
   dropped that could join two components.

Ids may repeat: a row's component follows from its text. Rows without an id have no component and link nothing. Null, empty and blank texts have
no shingles and link with nothing: each such row is its own component. A text of fewer words than a shingle has, is one
shingle. Repeated rows link with each other. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import durable, pick, shuffle_width, utf8
from .components import components

#: Counts in the histogram of a set; a power of two.
PROFILE = 64

#: Odd multipliers that mix the hashes of a shingle's words.
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


class WordHashes(dict):
    """64-bit hashes of words, kept until `most` are known."""

    most = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: bytes, width: int, known: WordHashes) -> np.ndarray:
    """The sorted distinct shingle hashes (signed) of a text; words are split at ASCII white space, A-Z in lower case."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.int64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64).view(np.int64)
    h = np.array([known[w] for w in words], np.uint64)
    n = len(h) - width + 1
    mixed = np.zeros(n, np.uint64)
    for k in range(width):
        mixed = (mixed ^ (h[k : k + n] * MULTIPLIERS[k % 5])) * MULTIPLIERS[(k + 1) % 5]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed.view(np.int64))


class Nodes(NamedTuple):
    """How shingle sets are named: `bits` of the first half of a 128-bit hash (fewer than 64 only to test), or the second
    half where the first is one of `shared`, which unlike sets have in common, as first halves or as what others took."""

    bits: int = 64
    shared: frozenset[int] = frozenset()

    def halves(self, found: np.ndarray) -> tuple[int, int]:
        whole = xxhash.xxh3_128_intdigest(found.tobytes())
        return (whole >> (128 - self.bits)) - (1 << (self.bits - 1)), (whole & ((1 << 64) - 1)) - (1 << 63)

    def of(self, found: np.ndarray) -> int:
        first, second = self.halves(found)
        return second if first in self.shared else first


def rows_with_nodes(rows: DataFrame, width: int, names: Nodes) -> DataFrame:
    """`doc_id, n_shingles, node, second` per row: both halves of the set's hash, null without shingles."""

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            sets = [shingles(text, width, known) for text in utf8(batch, "text")]
            halves = [names.halves(s) if len(s) else (None, None) for s in sets]
            columns = [[len(s) for s in sets], [first for first, _ in halves], [second for _, second in halves]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in columns]], ["doc_id", "n_shingles", "node", "second"])

    return rows.mapInArrow(sized, StructType([rows.schema["doc_id"]]).add("n_shingles", "long").add("node", "long").add("second", "long"))


#: Shared halves that are told to the tasks; more than this of 64 bits would mean a broken hash.
MOST_SHARED = 10_000_000


def named(rows: DataFrame, width: int, bits: int) -> tuple[DataFrame, DataFrame, Nodes]:
    """`doc_id, n_shingles, node` per row, `node, n, first_id` per node, and their naming.

    Of d unlike sets about d * d / 2**65 pairs share a first half (three at 10**10 sets, 27,000 at 10**12): these halves,
    and nothing else, pass through the driver. A set that took its second half may meet another's first one; so names are
    looked at until none is shared.
    """
    names = Nodes(bits)
    halves = durable(rows_with_nodes(rows, width, names))
    nodes = halves
    while True:
        per_node = nodes.where("node IS NOT NULL").groupBy("node").agg(F.max("n_shingles").alias("n"), F.min("doc_id").alias("first_id"), F.min("second").alias("low"), F.max("second").alias("high"))
        sized = durable(per_node)
        shared = [row[0] for row in sized.where("low != high").select("node").limit(MOST_SHARED + 1).collect()]
        if not shared:
            return nodes.drop("second"), sized.drop("low", "high"), names
        if len(shared) > MOST_SHARED:
            raise RuntimeError("too many unlike sets share half of a 128-bit hash")
        names = names._replace(shared=names.shared | frozenset(shared))
        marked = rows.sparkSession.createDataFrame([(h,) for h in names.shared], "node long").withColumn("_shared", F.lit(True))
        taken = halves.join(marked, "node", "left")
        nodes = durable(taken.select("doc_id", "n_shingles", F.when(F.col("_shared"), F.col("second")).otherwise(F.col("node")).alias("node"), "second"))


def first_matches(n: int) -> int:
    """How many matches the prefixes in hash order are made for; grows with n."""
    return (n + 9) // 10


def postings(rows: DataFrame, width: int, percent: int, names: Nodes) -> DataFrame:
    """`shingle, node, n` of prefixes in hash order; a task gives a node once, however many copies it sees (of a million)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = WordHashes(), set()
        for batch in batches:
            sets = []
            for text in utf8(batch, "text"):
                own = shingles(text, width, known)
                if len(own) and (node := names.of(own)) not in seen:
                    if len(seen) >= 1_000_000:
                        seen.clear()
                    seen.add(node)
                    sets.append((node, len(own), own[: len(own) - (len(own) * percent + 99) // 100 + first_matches(len(own))]))
            yield listed(sets)

    return rows.select("text").mapInArrow(each, "shingle long, node long, n long")


def listed(sets: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    """Rows of (node, n, shingles)."""
    times = [len(s) for _, _, s in sets]
    columns = [np.concatenate([np.zeros(0, np.int64), *[s for _, _, s in sets]]), *[np.repeat(np.array([x[k] for x in sets], np.int64), times) for k in (0, 1)]]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["shingle", "node", "n"])


def of_like_size(dealt: DataFrame, percent: int) -> DataFrame:
    """The rows (shingle, node, n) whose shingle another node has that is small and large enough to link."""
    w = Window.partitionBy("shingle").orderBy("n")
    smaller, larger = 100 * F.lag("n").over(w) >= percent * F.col("n"), 100 * F.col("n") >= percent * F.lead("n").over(w)
    return dealt.withColumn("_near", F.coalesce(smaller, F.lit(False)) | F.coalesce(larger, F.lit(False))).where("_near").drop("_near")


def overlap_of(n: Column, percent: int) -> Column:
    """The least overlap with any set, ceil(t n), in whole numbers."""
    return F.floor((n * percent + 99) / 100)


def members(rows: DataFrame, wanted: DataFrame, width: int, names: Nodes) -> DataFrame:
    """`shingle, node, n` of the wanted nodes (node, first_id), from the text of the row with that id."""
    texts = rows.join(wanted.select("node", F.col("first_id").alias("doc_id")), "doc_id").select("node", "text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = WordHashes(), set()
        for batch in batches:
            sets = []
            for node, text in zip(batch.column(0).to_pylist(), utf8(batch, "text"), strict=True):
                # An id that repeats may have other texts, which aren't listed, or the same again, listed once (of a million).
                if node not in seen and names.of(own := shingles(text, width, known)) == node:
                    if len(seen) >= 1_000_000:
                        seen.clear()
                    seen.add(node)
                    sets.append((node, len(own), own))
            yield listed(sets)

    return texts.mapInArrow(each, "shingle long, node long, n long")


def survivors(rows: DataFrame, sized: DataFrame, width: int, percent: int, names: Nodes) -> DataFrame:
    """`node, n, shared: array of (df, shingle) by rarity` of the nodes that can link at all."""
    n_tasks = shuffle_width(rows.sparkSession)
    dealt = postings(rows, width, percent, names).repartition(n_tasks, "shingle").dropDuplicates(["shingle", "node", "n"])
    # A partner may be smaller, and then asks for the fewer matches of its own size.
    least = F.floor((overlap_of(F.col("n"), percent) + 9) / 10)
    matched = of_like_size(dealt, percent).groupBy("node", "n").agg(F.count("*").alias("matches")).where(F.col("matches") >= least)
    wanted = durable(matched.select("node").join(sized.select("node", "first_id"), "node"))
    whole = members(rows, wanted, width, names).repartition(n_tasks, "shingle").dropDuplicates(["shingle", "node", "n"])
    counted = of_like_size(whole, percent).withColumn("df", F.count("*").over(Window.partitionBy("shingle")))
    listed = counted.groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("shared"))
    return durable(listed.where(F.size("shared") >= overlap_of(F.col("n"), percent)))


def prefixes(kept: DataFrame, percent: int, most: int) -> DataFrame:
    """`node, n, l, place, rank, shingle` with each node's own l, at most `most`; rank leaves out the shingles that no other node has."""
    alone = F.col("n") - F.size("shared")

    def length(l: Column) -> Column:
        return F.least(F.col("n") - overlap_of(F.col("n"), percent) + l, F.col("n")) - alone

    def cost(l: Column) -> Column:
        scanned = F.aggregate(F.slice("shared", F.lit(1), F.greatest(length(l), F.lit(0)).cast("int")), F.lit(0.0), lambda sum_, s: sum_ + s["df"])
        return F.struct((scanned * (1 + F.lit(4.0) / l)).alias("cost"), l.cast("long").alias("l"))

    chosen = kept.withColumn("l", F.least(F.array_min(F.transform(F.sequence(F.lit(1), F.lit(most)), cost))["l"], overlap_of(F.col("n"), percent)))
    first = F.slice("shared", F.lit(1), F.greatest(length(F.col("l")), F.lit(0)).cast("int"))
    placed = chosen.select("node", "n", "l", alone.alias("alone"), F.posexplode(first).alias("k", "s"))
    return placed.select("node", "n", "l", (F.col("alone") + F.col("k")).alias("place"), F.col("k").alias("rank"), "s.shingle")


def verified(pairs: DataFrame, kept: DataFrame, percent: int) -> DataFrame:
    """The pairs `a, b` that link: exact overlap of the shared shingles against the union of the whole sets."""
    sets = kept.select("node", "n", F.transform("shared", lambda s: s["shingle"]).alias("set"))
    left, right = (sets.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("set").alias(f"set_{c}")) for c in "ab")
    both = F.size(F.array_intersect("set_a", "set_b"))
    return pairs.join(left, "a").join(right, "b").where(100 * both >= percent * (F.col("n_a") + F.col("n_b") - both)).select("a", "b")


def profiles(kept: DataFrame) -> DataFrame:
    """`node, profile`: how many of a node's shared shingles have each value of their last bits."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [np.bincount(np.asarray(own.as_py(), np.int64) & (PROFILE - 1), minlength=PROFILE).tolist() for own in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.list_(pa.int32()))], ["node", "profile"])

    return kept.select("node", F.transform("shared", lambda s: s["shingle"]).alias("own")).mapInArrow(each, "node long, profile array<int>")


def links(kept: DataFrame, percent: int, most: int) -> DataFrame:
    """Edges that have the same components as all links between nodes."""
    lists = durable(prefixes(kept, percent, most))
    # Pivot: the node whose prefix reaches the shingle first, that is, with the fewest shingles of its own.
    pivots = lists.groupBy("shingle").agg(F.min_by("node", F.struct("place", "node")).alias("a"), F.count("*").alias("m")).where("m > 1")
    starts = lists.join(pivots, "shingle").where("node != a").select("a", F.col("node").alias("b")).distinct()
    edges = durable(verified(starts, kept, percent))
    labels = components(edges)
    labelled = lists.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = durable(labelled)
    unlike = labelled.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("shingle")
    open_ = labelled.join(unlike, "shingle", "left_semi")
    open_ = durable(open_.join(profiles(kept.join(open_.select("node").distinct(), "node", "left_semi")), "node"))
    a, b = open_.alias("a"), open_.alias("b")
    least_overlap = F.ceil((F.col("a.n") + F.col("b.n")) * percent / (100.0 + percent) - 1e-9)
    room = F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place"))
    near = (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.component") != F.col("b.component"))
    near &= (100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n"))
    # Of the first l matches, each has at most l - 1 before it, and no more than its ranks say; behind it must be room for the rest of the overlap.
    near &= room + F.least(F.col("a.l") - 1, F.col("b.l") - 1, "a.rank", "b.rank") >= least_overlap
    near &= F.aggregate(F.zip_with("a.profile", "b.profile", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y) >= least_overlap
    matched = a.join(b, near).groupBy(F.col("a.node").alias("a"), F.col("b.node").alias("b")).agg(F.count("*").alias("matches"), F.first(F.least("a.l", "b.l")).alias("need"))
    rest = matched.where("matches >= need").select("a", "b")
    return edges.unionByName(durable(verified(rest, kept, percent)))


def jaccard_components(docs: DataFrame, *, width: int = 5, percent: int = 80, most_matches: int = 8, node_bits: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, n_shingles, component_id` per row: the smallest id that links reach, over similarity percent / 100."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    nodes, sized, names = named(rows, width, node_bits)
    kept = survivors(rows, sized, width, percent, names)
    linked = components(links(kept, percent, most_matches)).join(sized, "node")
    least = linked.groupBy("component").agg(F.min("first_id").alias("least_id"))
    moved = linked.join(least, "component").select("node", "least_id")
    first = sized.join(moved, "node", "left").select("node", F.coalesce("least_id", "first_id").alias("component_id"))
    return nodes.join(first, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, all their columns, one row of each group of copies: one of its smallest id, a null id only if there is no other.

    Rows are told apart by id and text, so a row goes by its own text only; those equal in both are aggregated to one.
    Rows without shingles are copies of nothing and stay.
    """
    key = F.struct(docs[id_col].isNull().alias("none"), docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("hash"))
    # The caller's columns go in one, so that none can clash with those of this function.
    keyed = docs.select(key.alias("_key"), docs[text_col].alias("_text"), F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    groups = jaccard_components(keyed, id_col="_key", text_col="_text", **options).where("n_shingles > 0")
    fates = groups.groupBy(F.col("doc_id").alias("_key")).agg(F.bool_or(F.col("component_id") != F.col("doc_id")).alias("_copy"), F.count("*").alias("_times"))
    fates = durable(fates.where("_copy OR _times > 1"))
    kept = keyed.join(fates, "_key", "left_anti").select("_row.*")
    repeated = fates.where("NOT _copy").select("_key")
    if repeated.isEmpty():
        return kept
    once = keyed.join(repeated, "_key", "left_semi").groupBy("_key").agg(F.first("_row").alias("_row"))
    return kept.unionByName(once.select("_row.*"))
