"""Spelling variants: words one edit apart, found by a frontier of states over a trie kept as an edge table.

An edit leaves the first or the second half of a word as it is. So there are two tries, of the words and of the words
read backwards, and a word's search enters each where its unchanged half ends, at its last branching before that. It looks
for words one letter longer, and for those with one letter replaced by a later one; turned round, these are all pairs.
Chains of the trie without a branching are one edge with a label, so the number of levels follows the branchings below
the half, not the length of words. Nodes are hashes of what they spell; two that collide only give more candidates, and
the pairs found are compared once more, exactly.

A level joins the states (word, side, what follows in the word, node, edits) with the edges of their nodes: the label is
matched with what follows, with no edit or, once, with one; an edge knows the letters that go on from its end, so a state
which none of them fits is dropped at once. States that reach the end of another word with one edit are neighbours; the
others go on until none is left. A node has at most one edge per letter of the alphabet, and a node that many words enter
is one side of a plain join, which adaptive execution splits.

Null texts have no words; in checksums a null id is empty. Repeated rows count again. Very long texts are read whole and very long
words go through like others. Ties of the largest count go to the word that sorts first. Empty tables give empty results;
further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, pick, utf8
from .components import followed

#: An odd multiplier of the hashes of each side.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def vocabulary(docs: DataFrame, *, every: int = 199, least_length: int = 6, least: int = 5, most_held: int = 500_000) -> DataFrame:
    """`word, n`: the runs of letters, a planted deletion in one of `every`, that are long and frequent enough.

    A task adds up its words until it holds `most_held` of them, so the shuffle follows the vocabulary more than the texts.
    """
    # A-Z are lowered before; a shorter run can't become a word.
    run = re.compile("[a-z\u00c0-\u00ff]{%d,}" % least_length)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[str] = Counter()

        def emptied() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], ["word", "n"])
            words.clear()
            return batch

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), utf8(batch, "text"), strict=True):
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                found = Counter(run.findall(text.lower().decode()))
                for word in [w for w in found if not zlib.crc32(w.encode(), start) % every]:
                    n, place = found.pop(word), zlib.crc32(word.encode(), start) % len(word)
                    words[word[:place] + word[place + 1 :]] += n
                words.update(found)
                if len(words) >= most_held:
                    yield emptied()
        yield emptied()

    summed = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return summed.where((F.char_length("word") >= least_length) & (F.col("n") >= least))


def hashes(words: list[str]) -> Iterator[tuple[str, int, np.ndarray, np.ndarray]]:
    """(word, side, hash of every beginning, the empty one first, code point behind it or 0) of each word and its reverse."""
    powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
    for word in words:
        code = np.frombuffer(word.encode("utf-32-le"), np.uint32)
        for side in (0, 1):
            if len(powers[side]) < len(code):
                powers[side] = np.cumprod(np.full(2 * len(code), BASES[side], np.uint64))
            letters = code if not side else code[::-1]
            sums = np.cumsum((letters.astype(np.uint64) + np.uint64(1)) * powers[side][: len(code)])
            yield word, side, np.concatenate([np.array([side], np.uint64), sums]).view(np.int64), np.append(letters, 0).astype(np.int32)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[list[str]]:
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.column(0).slice(first, rows).to_pylist()


def branchings(words: DataFrame) -> DataFrame:
    """`node` of the beginnings that go on in more than one way."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in sliced(batches):
            found = list(hashes(words))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found])) for k in (2, 3)], ["node", "code"])

    letters = words.select("word").mapInArrow(each, "node long, code int")
    return letters.groupBy("node").agg(F.min("code").alias("low"), F.max("code").alias("high")).where("low < high").select("node")


def prefixes(words: DataFrame) -> DataFrame:
    """`word, side, nodes`: of each word and its reverse, the hash of every beginning, the empty one first."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in sliced(batches):
            found = list(hashes(words))
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found]), pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.list_(pa.int64()))], ["word", "side", "nodes"])

    return words.select("word").mapInArrow(each, "word string, side int, nodes array<long>")


def spelled(word: Column, side: Column) -> Column:
    return F.when(side == 0, word).otherwise(F.reverse(word))


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges `node, label, child, ends` (the word that ends at the child, or null), `next` (the letters that go on there), and where searches begin: `word, side, rest, node`."""
    # Rows per letter carry 128 bits of a word, not the word, so a long one doesn't cost its square.
    name = ["last", "own", "side"]
    read = prefixes(words).withColumns({"last": F.element_at("nodes", -1), "own": F.xxhash64("word")})
    letters = read.select(*name, F.posexplode("nodes").alias("at", "node"))
    marked = letters.join(branchings(words), "node", "left_semi").groupBy(*name).agg(F.array_sort(F.collect_list(F.struct("at", "node"))).alias("marks"))
    length = F.char_length("word")
    ends = read.select("word", *name, F.element_at("nodes", 1).alias("first"))
    stops = ends.join(marked, name, "left").withColumn("marks", F.coalesce("marks", F.array().cast("array<struct<at:int,node:bigint>>")))
    # The root and a word's own end are stops, branching or not.
    around = F.array_distinct(F.concat(F.array(F.struct(F.lit(0).alias("at"), F.col("first").alias("node"))), "marks", F.array(F.struct(length.cast("int").alias("at"), F.col("last").alias("node")))))
    stops = durable(stops.select("word", "side", spelled(F.col("word"), F.col("side")).alias("text"), around.alias("stops")))
    steps = F.transform(F.sequence(F.lit(1), F.size("stops") - 1), lambda k: F.struct(F.element_at("stops", k).alias("a"), F.element_at("stops", k + 1).alias("b")))
    cut = stops.select("word", "text", F.explode(steps).alias("s"))
    a, b = F.col("s.a.at"), F.col("s.b.at")
    edges = cut.select(F.col("s.a.node").alias("node"), F.substring("text", a + 1, b - a).alias("label"), F.col("s.b.node").alias("child"), F.when(b == length, F.col("word")).alias("ends"))
    # One edge in many words is one row; one that ends a word keeps it.
    edges = edges.groupBy("node", "label", "child").agg(F.collect_set("ends").alias("ends")).select("node", "label", "child", F.explode_outer("ends").alias("ends"))
    follow = edges.groupBy(F.col("node").alias("child")).agg(F.array_join(F.collect_set(F.substring("label", 1, 1)), "").alias("next"))
    edges = edges.join(follow, "child", "left").select("node", "label", "child", "ends", F.coalesce("next", F.lit("")).alias("next"))
    begin = F.element_at(F.filter("stops", lambda s: s["at"] <= F.floor(length / 2)), -1)
    begins = stops.select("word", "side", "text", begin.alias("s")).select("word", "side", F.substring("text", F.col("s.at") + 1, length).alias("rest"), F.col("s.node").alias("node"))
    return durable(edges), begins


def neighbours(words: DataFrame) -> DataFrame:
    """`word, other`: all pairs of words one inserted, deleted or replaced code point apart, both ways."""
    edges, begins = trie(words)
    frontier = begins.withColumn("edits", F.lit(0))
    rest, label, size = F.col("rest"), F.col("label"), F.char_length("label")
    same = F.when(F.startswith(rest, label), F.struct(F.substring(rest, size + 1, F.char_length(rest)).alias("rest"), F.col("edits").alias("edits")))
    found = []
    while True:

        def edited(fewer: int) -> Column:
            """What follows and one edit, if the label fits with one letter replaced by a later one, or (fewer = 1) with one more letter than the word; else null."""
            piece = F.substring(rest, F.lit(1), size - fewer)
            once = (size == 1) | (F.levenshtein(label, piece, 1) == 1)
            fits = (F.col("edits") == 0) & (F.char_length(rest) >= size - fewer) & ((piece < label) if not fewer else F.lit(True)) & once
            return F.when(fits, F.struct(F.substring(rest, size - fewer + 1, F.char_length(rest)).alias("rest"), F.lit(1).alias("edits")))

        tried = frontier.join(edges, "node").select("word", "side", "child", "ends", "next", F.explode(F.array(same, edited(0), edited(1))).alias("s")).where("s IS NOT NULL")
        moved = tried.select("word", "side", F.col("s.rest").alias("rest"), F.col("child").alias("node"), F.col("s.edits").alias("edits"), "ends", "next")
        at_end = F.col("rest") == ""
        # A state is another word's end, or goes on by a letter that an edge begins with; without an edit yet, by any.
        there = at_end & (F.col("edits") == 1) & F.col("ends").isNotNull()
        on = (F.col("next") != "") & F.when(F.col("edits") == 1, ~at_end & F.contains("next", F.substring("rest", 1, 1))).otherwise(True)
        moved = durable(moved.select("word", "side", "rest", "node", "edits", F.when(there, F.col("ends")).alias("ends"), on.alias("on")).where("ends IS NOT NULL OR on"))
        found.append(moved.where("ends IS NOT NULL").select("word", F.col("ends").alias("other")))
        # An edge that ends several words (of one hash) is listed for each; the state behind it is one.
        frontier = moved.where("on").select("word", "side", "rest", "node", "edits")
        if frontier.isEmpty():
            break
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other")))
    return both.distinct().where(F.levenshtein("word", "other", 1) == 1)


def variants(docs: DataFrame, *, ratio: int = 5, id_col: str = "doc_id", text_col: str = "text", **limits: int) -> DataFrame:
    """`word, n, n_near, form, form_n, root` of every word: its near words, the one `ratio` times as frequent that it is a form of, and the last of those."""
    words = durable(vocabulary(pick(docs, doc_id=id_col, text=text_col), **limits))
    others = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    near = neighbours(words).join(others, "other").groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("order"), "other")).alias("best"))
    joined = words.join(near, "word", "left")
    large = -F.col("best.order") >= ratio * F.col("n")
    formed = durable(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(large, F.col("best.other")).alias("form"), F.when(large, -F.col("best.order")).alias("form_n")))
    ends = followed(formed.select(F.col("word").alias("node"), F.coalesce("form", "word").alias("to")))
    return formed.join(ends.select(F.col("node").alias("word"), F.col("to").alias("root")), "word")
