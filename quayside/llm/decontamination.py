"""Benchmark decontamination as a prefix-filtered set join of item windows with documents.

A window is `width` consecutive words of an item (all its words if it has fewer). Seen as a set of word shingles, a
window occurs in a document only if all its shingles do, so one shingle is a sufficient prefix; the rarest is taken.

1. Windows are made per item and numbered over their distinct words; windows are handled in blocks of at most
   `block_windows`, one at a time, so what the driver holds and broadcasts is bounded whatever the benchmark's size.
2. One pass over all documents counts in how many of them each shingle of a block occurs (partial sums, one row per
   shingle). Shingles are ordered by that rarity, and each window keeps its rarest with the shingle's position in it.
3. A second pass finds the prefix shingles in every whole document. A hit at word p of a shingle at position o asks for
   a window starting at p - o: positions before the start or beyond the end are out (position and length bound), and
   the rest is verified word by word over the item-sized window.

Null texts have no words; an item without words has no windows; items with a null id are left out; an item id that
occurs again adds its windows to the id; repeated documents give repeated rows; empty tables give no hits or no rows;
the input's further columns are ignored. Very long texts are searched whole. Of a window's shingles that are equally rare
the one with the smallest code is its prefix.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from .common import durable, pick, utf8

#: Bytes that belong to words stay (A-Z in lower case); all others become blanks.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Block:
    """The windows of some items as word numbers, grouped by length; 0 stands for any word that no window has.

    Shingles are coded exactly: up to three word numbers below 2**21 in one 64-bit integer.
    """

    def __init__(self, windows: list[tuple[str, tuple[bytes, ...]]], shingle: int):
        self.number: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, window in windows:
            owners.setdefault(tuple(self.number.setdefault(w, len(self.number) + 1) for w in window), set()).add(item)
        assert len(self.number) < 1 << 21, "lower block_windows"
        self.shingle = shingle
        self.windows = list(owners)
        self.owners = [sorted(owners[w]) for w in self.windows]

    def sizes(self) -> set[int]:
        return {min(self.shingle, len(w)) for w in self.windows}

    def codes(self, ids: np.ndarray, size: int) -> np.ndarray:
        """The shingle starting at each place; 0 where a word is unknown."""
        if len(ids) < size:
            return np.zeros(0, np.int64)
        at = [ids[k : len(ids) - size + 1 + k] for k in range(size)]
        code, known = np.zeros(len(at[0]), np.int64), np.ones(len(at[0]), bool)
        for part in at:
            code, known = code << 21 | part, known & (part > 0)
        return np.where(known, code, 0)

    def document(self, text: bytes) -> np.ndarray:
        number = self.number
        return np.array([number.get(w, 0) for w in words(text)], np.int64)

    def all_codes(self) -> dict[int, np.ndarray]:
        out = {}
        for size in self.sizes():
            found = [self.codes(np.array(w, np.int64), size) for w in self.windows if min(self.shingle, len(w)) == size]
            out[size] = np.unique(np.concatenate(found))
        return out


class Prefixes:
    """Each window under its rarest shingle, ready to be looked up."""

    def __init__(self, block: Block, rarity: dict[tuple[int, int], int]):
        self.block, self.tables = block, {}
        for size in block.sizes():
            rows = []
            for w, window in enumerate(block.windows):
                if min(block.shingle, len(window)) == size:
                    codes = block.codes(np.array(window, np.int64), size).tolist()
                    offset = min(range(len(codes)), key=lambda o: (rarity.get((size, codes[o]), 0), codes[o], o))
                    rows.append((codes[offset], len(window), offset, w))
            rows.sort()
            first: dict[int, tuple[int, int]] = {}
            for i, r in enumerate(rows):
                first[r[0]] = (first.get(r[0], (i,))[0], i + 1)
            self.tables[size] = (np.array(sorted(first), np.int64), first, rows)

    def occurrences(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, int]]:
        """(window, starts, length) of every window that occurs among a document's word numbers."""
        for size, (keys, first, rows) in self.tables.items():
            codes = self.block.codes(ids, size)
            places = np.flatnonzero(np.isin(codes, keys)) if len(codes) else codes
            if not len(places):
                continue
            order = np.argsort(codes[places], kind="stable")
            places = places[order]
            found, begins = np.unique(codes[places], return_index=True)
            for code, own in zip(found.tolist(), np.split(places, begins[1:]), strict=True):
                for _, n, offset, w in rows[slice(*first[code])]:
                    starts = own - offset
                    starts = starts[(starts >= 0) & (starts + n <= len(ids))]
                    window = self.block.windows[w]
                    for k in range(n):
                        starts = starts[ids[starts + k] == window[k]]
                        if not len(starts):
                            break
                    else:
                        yield w, starts, n


def item_windows(items: DataFrame, width: int, id_col: str, text_col: str) -> Iterator[tuple[str, tuple[bytes, ...]]]:
    """The distinct windows of all items, streamed partition by partition."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for item, text in zip(batch.column(0).to_pylist(), utf8(batch, "text"), strict=True):
                w = words(text)
                for s in range(max(1, len(w) - width + 1)) if w else ():
                    ids.append(item), out.append(b" ".join(w[s : s + width]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(out, pa.binary())], ["item", "window"])

    rows = items.select(items[id_col].cast("string").alias("item"), items[text_col].alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    made = durable(rows.mapInArrow(cut, "item string, window binary").distinct().orderBy("item", "window"))
    for row in made.toLocalIterator():
        yield row["item"], tuple(bytes(row["window"]).split())


def rarity(rows: DataFrame, block: Block) -> dict[tuple[int, int], int]:
    """In how many documents each shingle of the block occurs; over all documents, one row per shingle comes back."""
    shared = rows.sparkSession.sparkContext.broadcast((block, block.all_codes()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, wanted = shared.value
        totals = {size: np.zeros(len(codes), np.int64) for size, codes in wanted.items()}
        for batch in batches:
            for text in utf8(batch, "text"):
                ids = block.document(text)
                if ids.any():
                    for size, codes in wanted.items():
                        own = np.unique(block.codes(ids, size))
                        totals[size][np.flatnonzero(np.isin(codes, own))] += 1
        for size, codes in wanted.items():
            seen = np.flatnonzero(totals[size])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), size), pa.int32()), pa.array(codes[seen]), pa.array(totals[size][seen])], ["size", "code", "n"])

    if not block.windows:
        return {}
    counts = rows.select("text").mapInArrow(count, "size int, code long, n long").groupBy("size", "code").agg(F.sum("n").alias("n"))
    found = {(r["size"], r["code"]): r["n"] for r in counts.collect()}
    shared.destroy()
    return found


def find_windows(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`doc_id, n_words, spans, items` per document: merged word spans [start, end) that are hit, and the items found."""
    return searched(pick(docs, doc_id=id_col, text=text_col), items, **options).drop("text")


SPANS = ArrayType(StructType().add("start", LongType()).add("end", LongType()))
SPANS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def merged(n_words: int, found: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[dict]:
    """Word spans [start, end) of a document that any of the found (starts, ends) cover."""
    edges = np.zeros(n_words + 1, np.int64)
    for starts, ends in found:
        np.add.at(edges, starts, 1)
        np.add.at(edges, ends, -1)
    hit = np.diff(np.concatenate([[0], (np.cumsum(edges) > 0).astype(np.int8), [0]]))
    return [{"start": s, "end": e} for s, e in zip(np.flatnonzero(hit == 1).tolist(), np.flatnonzero(hit == -1).tolist(), strict=True)]


def search_block(rows: DataFrame, prefixes, *, only_hits: bool) -> DataFrame:
    """The rows, of any first column and `text`, with `n_words, spans, items` of one block (a broadcast); `only_hits` gives only rows with spans, without texts."""
    first = rows.columns[0]
    fields = [rows.schema[first]] if only_hits else list(rows.schema)
    schema = StructType(list(fields)).add("n_words", LongType()).add("spans", SPANS).add("items", ArrayType(StringType()))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = prefixes.value
        for batch in batches:
            n_words, spans, items = [], [], []
            for text in utf8(batch, "text"):
                ids = own.block.document(text)
                found = list(own.occurrences(ids)) if ids.any() else []
                n_words.append(len(ids))
                spans.append(merged(len(ids), ((starts, starts + n) for _, starts, n in found)) if found else [])
                items.append(sorted({item for w, _, _ in found for item in own.block.owners[w]}))
            columns = [pa.array(n_words, pa.int64()), pa.array(spans, SPANS_ARROW), pa.array(items, pa.list_(pa.string()))]
            made = pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in fields], *columns], schema.names)
            yield made.filter(pa.array([bool(s) for s in spans], pa.bool_())) if only_hits else made

    return rows.mapInArrow(search, schema)


def combined(hits: DataFrame) -> DataFrame:
    """One row per key of the hits of several blocks: a row per block at most, so groups are small."""
    listed = hits.groupBy("key").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for n, own in zip(batch.column("n_words").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                spans.append(merged(n, [(np.array([s["start"] for s in own]), np.array([s["end"] for s in own]))]))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(spans, SPANS_ARROW), batch.column("items")], ["key", "spans", "items"])

    return listed.mapInArrow(join, StructType([listed.schema["key"]]).add("spans", SPANS).add("items", ArrayType(StringType())))


def searched(rows: DataFrame, items: DataFrame, *, width: int = 10, shingle: int = 3, block_windows: int = 100_000, item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows, of any first column and `text`, with `n_words, spans, items`: what is found stays with its row.

    A benchmark of one block is one pass, and nothing of a document is shuffled. With more blocks the texts that a block
    hits (by a hash of the text, so ids don't matter) are written to the shared folder before the next block is made and
    this one is dropped everywhere; they are joined to the rows in the end.
    """
    spark, first = rows.sparkSession, rows.columns[0]
    blocks = batched(item_windows(items, width, item_id_col, item_text_col), block_windows)
    key = F.sha2(F.coalesce("text", F.lit("")), 256).alias("key")
    hits, windows = [], next(blocks, ())
    while True:
        following = next(blocks, None)
        block = Block(list(windows), shingle)
        shared = spark.sparkContext.broadcast(Prefixes(block, rarity(rows, block)))
        if following is None and not hits:
            return search_block(rows, shared, only_hits=False)
        hits.append(durable(search_block(rows.select(key, "text").where("text IS NOT NULL"), shared, only_hits=True).dropDuplicates(["key"])))
        shared.destroy()
        if following is None:
            break
        windows = following
    found = combined(functools.reduce(DataFrame.unionByName, hits))
    empty = spark.sparkContext.broadcast(Prefixes(Block([], shingle), {}))
    counted = search_block(rows, empty, only_hits=False).drop("spans", "items").withColumn("key", key)
    joined = counted.join(found, "key", "left")
    none = F.array().cast(SPANS), F.array().cast("array<string>")
    return joined.select(first, "text", "n_words", F.coalesce("spans", none[0]).alias("spans"), F.coalesce("items", none[1]).alias("items"))


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Digest of `find_windows`: words, hit words, items found and their hash, and the verdict."""
    found = find_windows(docs, items, **options)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The documents, all their columns, in which no window of any item occurs; each row is judged by its own text, whatever its id."""
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*[docs[c] for c in others]).alias("others"), docs[text_col].alias("text"))
    clean = searched(rows, items, **options).where(F.size("spans") == 0)
    return clean.select(*[F.col("text").alias(c) if c == text_col else F.col("others")[c].alias(c) for c in docs.columns])
