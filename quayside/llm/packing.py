"""Best-fit packing of token pieces into sequences of fixed capacity.

1. Every document becomes token ids and an end id; documents longer than the capacity are cut into full pieces, the
   first piece taking what is left over. Texts never leave this pass: it yields lengths and checksums.
2. The pieces' lengths are counted. There are at most `capacity` lengths, so the histogram fits the driver at any scale.
3. Over the histogram, the configuration linear program (a configuration is a multiset of lengths that fits) is solved by
   multiplicative weights: lengths whose demand is behind get larger weights, a knapsack dynamic program prices the best
   configuration, and configurations are mixed in.
4. The fractional plan is rounded down, and the demand left over is solved again until little is left or a plan rounds
   to nothing; best fit, longest first, packs what then remains. The programme's dual bounds the number of sequences from
   below (`Plan.lower_bound`).
5. The pieces of a length are numbered 0, 1, ... by salted ranks (no task holds a whole length), and a number's place
   follows from the plan's slots.

Null text is an empty document: one piece with the end id alone. Repeated rows are packed as often as they occur, ties
are ordered by id and text checksum, an empty table gives an empty result, further input columns are ignored. A very long
text is encoded whole and becomes many pieces, which a task holds at once.
"""

from __future__ import annotations

import functools
import json
import math
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, pick, shuffle_width, utf8

#: Fixed pattern of the byte-level pre-tokeniser.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Before these places it always starts a new pre-token.
BREAKS = re.compile(r"(?<=\S)(?= \S)")


@functools.lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=2)
def _ranked(path: str):
    """The file's merges as ranks for tiktoken, if its ids number bytes and merges in that order; else None."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    ids = model["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    if any(ids.get(a + b) != 256 + k for k, (a, b) in enumerate(merges)):
        return None
    # The byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes follow from 256 on.
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    byte_of = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}
    ranks = {bytes(byte_of[c] for c in s): i for s, i in ids.items() if i < 256 + len(merges)}
    # Ranks join any two neighbours that spell a vocabulary string, the file only listed pairs. Both do the same if every
    # string encodes alone as itself: in its place only its own listed pair can then come to stand side by side.
    model_of_file = _tokenizer(path).model
    if any([t.id for t in model_of_file.tokenize(s)] != [i] for s, i in ids.items() if i < 256 + len(merges)):
        return None
    return tiktoken.Encoding("merges", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes, by way of recurring chunks.

    A byte-level pre-token holds a space only as its first character, and a lone line feed between other characters is
    one of its own. So a text may be cut around such line feeds, and before every lone space between other characters;
    texts with other white space in a row are cut by `BREAKS`, which is the rule for spaces exactly. Known chunks stay
    for the worker's life, until there are `most` of them.
    """

    def __init__(self, path: str, most: int = 700_000):
        self.tok, self.most = _tokenizer(path), most
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.first: dict[str, bytes | None] = {}  # chunks at the start of a line
        self.later: dict[str, bytes | None] = {}  # chunks after a space, without it; None: white space at an end
        self.feed = self.ids(["\n"])[0]
        self.ranked = _ranked(path)

    def ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def chunk_ids(self, chunk: str) -> bytes:
        """Short Latin chunks by the same merges as ranks, which costs less per call; others by the tokenizer itself."""
        if self.ranked and max(chunk) < "\u0250":
            return array("I", self.ranked.encode_ordinary(chunk)).tobytes()
        return self.ids([chunk])[0]

    def learn(self, table: dict[str, bytes | None], space: str, chunks: list[str]) -> None:
        new = [c for c in set(chunks) if c not in table]
        whole = [c for c in new if c and not c[0].isspace() and not c[-1].isspace()]
        table.update(dict.fromkeys(new))
        table.update((c, self.chunk_ids(space + c)) for c in whole)

    def line(self, text: str) -> bytes:
        chunks = text.split(" ")
        try:
            return b"".join([self.first[chunks[0]], *map(self.later.__getitem__, chunks[1:])])
        except KeyError:
            self.learn(self.first, "", chunks[:1])
            self.learn(self.later, " ", chunks[1:])
            return b"".join([self.first[chunks[0]], *map(self.later.__getitem__, chunks[1:])])

    def encode(self, text: str) -> bytes:
        if len(self.first) + len(self.later) > self.most:
            self.first.clear()
            self.later.clear()
        if not text or any(s in text for s in self.special):
            return self.ids([text])[0]
        try:
            return self.feed.join([self.line(x) for x in text.split("\n")])
        except TypeError:  # a chunk is None: white space in a row
            return b"".join(self.ids(BREAKS.split(text)))


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def token_pieces(docs: DataFrame, tokenizer_path: str, *, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """`doc_id, piece, start, length, ids_crc32` (and `ids`, with_ids) of every piece of every document."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    end = np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        for batch in batches:
            at, piece, start, length, crc, kept = [], [], [], [], [], []
            for row, text in enumerate(utf8(batch, "text")):
                ids = encoder.encode(text.decode()) + end
                n = len(ids) // 4
                head = (n - 1) % capacity + 1
                for k, s in enumerate([0, *range(head, n, capacity)]):
                    size = head if k == 0 else capacity
                    part = ids[4 * s : 4 * (s + size)]
                    at.append(row), piece.append(k), start.append(s), length.append(size), crc.append(zlib.crc32(part))
                    if with_ids:
                        kept.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.list_(pa.int32()))] * with_ids, names)

    return rows.mapInArrow(cut, f"doc_id {dict(rows.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def price(weight: np.ndarray, demand: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """Counts per length of the configuration of largest total weight (a knapsack by dynamic programming), and that weight.

    The counts are cut to the demand; the weight is of the uncut configuration, so no configuration has more.
    """
    value = np.full(capacity + 1, -np.inf)
    value[lengths] = weight
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        gain = value[1 : room + 1] + best[room - 1 :: -1]
        k = int(gain.argmax())
        if gain[k] > best[room - 1]:
            best[room], last[room] = gain[k], k + 1
        else:
            best[room] = best[room - 1]
    where = {int(n): i for i, n in enumerate(lengths)}
    counts, room = np.zeros(len(lengths), np.int64), capacity
    while room > 0:
        if last[room]:
            counts[where[int(last[room])]] += 1
            room -= int(last[room])
        else:
            room -= 1
    return np.minimum(counts, demand), float(best[capacity])


def fractional_plan(lengths: np.ndarray, demand: np.ndarray, capacity: int, rounds: int, rate: float) -> tuple[dict[tuple[int, ...], float], float]:
    """How often to use which configuration (counts per length), by multiplicative weights, and a lower bound of the programme.

    The weights start at each length's share of the capacity. A round prices one configuration and uses it as often as
    raises no length's served share by more than `rate`; a length's weight then falls by its served share. The mix is
    scaled so that on average the demand is met once. The weights over the best configuration's weight are a solution of
    the dual, so in every round the demand's weight over it bounds the number of sequences from below; the largest counts.
    """
    bound = float((demand * lengths).sum()) / capacity
    served, weight = np.zeros(len(lengths)), lengths / capacity
    uses: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        own = weight * np.exp(-(served - served.min()))
        counts, most = price(own, demand, lengths, capacity)
        bound = max(bound, float((own * demand).sum()) / most) if most > 0 else bound
        used = counts > 0
        if not used.any():
            break
        times = rate * float((demand[used] / counts[used]).min())
        served += times * counts / demand
        uses[tuple(counts)] = uses.get(tuple(counts), 0.0) + times
    total = float((served * demand * lengths).sum() / (demand * lengths).sum()) or 1.0
    return {counts: times / total for counts, times in uses.items()}, bound


def best_fit_longest_first(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """(counts by length index, times) for what rounding left: longest first, filled up with the longest that fit.

    Equal fillings are made at once, so the work follows the number of lengths and not of pieces.
    """
    left, out = demand.copy(), []
    while (open_ := np.flatnonzero(left)).size:
        counts: dict[int, int] = {}
        room = capacity
        for i in open_[::-1]:
            n = min(int(left[i]), room // int(lengths[i]))
            if n:
                counts[int(i)] = n
                room -= n * int(lengths[i])
            if room < lengths[open_[0]]:
                break
        times = min(int(left[i]) // n for i, n in counts.items())
        for i, n in counts.items():
            left[i] -= n * times
        out.append((counts, times))
    return out


@dataclass
class Plan:
    """`rows`: (pairs of length and count in one sequence, number of such sequences), which serve the histogram exactly.

    No packing of the histogram has fewer than `lower_bound` sequences; `by_best_fit` of them were left by rounding.
    """

    rows: list[tuple[list[tuple[int, int]], int]]
    lower_bound: int
    by_best_fit: int

    @property
    def sequences(self) -> int:
        return sum(times for _, times in self.rows)


def planned(histogram: dict[int, int], capacity: int, *, rounds: int = 200, rate: float = 0.1, tolerance: float = 0.002) -> Plan:
    """The plan of a histogram of lengths.

    What rounding left is solved again for as long as that, with best fit for the rest, makes fewer sequences in all, until
    the rest is below `tolerance` of all sequences or a plan rounds to nothing.
    """
    lengths = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[int(n)] for n in lengths], np.int64)
    out: list[tuple[dict[int, int], int]] = []
    full, bound = 0, 0.0
    if lengths.size and lengths[-1] == capacity:
        full = int(demand[-1])
        out.append(({len(lengths) - 1: 1}, full))
        demand[-1] = 0
    best: tuple[int, list, list] | None = None
    while True:
        live = np.flatnonzero(demand)
        if bound or live.size < 2:
            rest = [({int(live[i]): n for i, n in counts.items()}, times) for counts, times in best_fit_longest_first(lengths[live], demand[live], capacity)] if live.size else []
            total = sum(times for _, times in out + rest)
            if best is not None and total >= best[0]:
                break
            best = (total, list(out), rest)
            if live.size < 2 or (demand * lengths).sum() < tolerance * capacity * (full + bound):
                break
        rounded = 0
        uses, least = fractional_plan(lengths[live], demand[live], capacity, rounds, rate)
        bound = bound or least
        for counts, times in sorted(uses.items(), key=lambda x: -x[1]):
            used = {int(live[i]): n for i, n in enumerate(counts) if n}
            # A configuration with more room left than the shortest length is left to best fit.
            if capacity - sum(n * int(lengths[i]) for i, n in used.items()) >= lengths[live[0]]:
                continue
            whole = min([int(times), *[int(demand[i]) // n for i, n in used.items()]])
            if whole:
                rounded += whole
                out.append((used, whole))
                for i, n in used.items():
                    demand[i] -= n * whole
        if not rounded and best is not None:
            break
    bound = bound or float((demand * lengths).sum()) / capacity
    _, out, rest = best
    rows = [([(int(lengths[i]), int(n)) for i, n in sorted(counts.items(), reverse=True)], int(times)) for counts, times in out + rest]
    return Plan(rows, full + math.ceil(bound - 1e-6), sum(times for _, times in rest))


def plan(histogram: dict[int, int], capacity: int, **options) -> list[tuple[list[tuple[int, int]], int]]:
    return planned(histogram, capacity, **options).rows


def ranked(pieces: DataFrame, salts: int) -> DataFrame:
    """`rank` from 0 among the pieces of a length, without one task per length.

    The salt is a hash of the piece, so ranks are the same however tasks are run again; the pieces of (length, salt) are
    numbered on their own and shifted by the count of the smaller salts.
    """
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    counts = salted.groupBy("length", "salt").count()
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("shift"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    return salted.withColumn("own", F.row_number().over(own)).join(shifts, ["length", "salt"]).withColumn("rank", F.col("own") - 1 + F.col("shift")).drop("salt", "own", "shift")


def pack(pieces: DataFrame, *, capacity: int = 2048) -> DataFrame:
    """The pieces with `sequence_id` and `offset`. At most `capacity` histogram rows reach the driver."""
    spark = pieces.sparkSession
    pieces = durable(pieces)
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, first_sequence = [], 0
    taken: dict[int, int] = {}
    for pairs, times in plan(histogram, capacity):
        offset = 0
        for length, n in pairs:
            first = taken.get(length, 0)
            slots.append((length, first, first + n * times, n, first_sequence, offset))
            taken[length] = first + n * times
            offset += n * length
        first_sequence += times
    schema = "slot_length long, first_rank long, end_rank long, per_sequence long, first_sequence long, first_offset long"
    # The plan has at most as many rows as configurations times lengths in one: bounded by `capacity` and the rounds.
    places = F.broadcast(spark.createDataFrame(slots, schema))
    numbered = ranked(pieces, 4 * shuffle_width(spark))
    inside = F.col("rank") - F.col("first_rank")
    return (
        numbered.join(places, (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank")))
        .withColumn("sequence_id", F.col("first_sequence") + F.floor(inside / F.col("per_sequence")))
        .withColumn("offset", F.col("first_offset") + F.pmod(inside, F.col("per_sequence")) * F.col("length"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def sequences(packed: DataFrame, pieces_with_ids: DataFrame) -> DataFrame:
    """`sequence_id, input_ids` ready for training; a group holds `capacity` ids at most."""
    ids = pieces_with_ids.select("doc_id", "piece", "ids_crc32", "ids").dropDuplicates(["doc_id", "piece", "ids_crc32"])
    joined = packed.join(ids, ["doc_id", "piece", "ids_crc32"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return joined.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("input_ids"))
