"""Repair of conversations: faults, the cheapest edits to alternating roles, and what the repaired turns hash to.

Turns are dealt out by ranges of (conversation, turn, role, md5 of the text) and sorted, so a large conversation spreads over
many partitions, and small ones are done in one pass where they lie. The first and the last conversation of a partition,
which may go on beyond it, and any of more than `PIECE` turns, are written out in pieces. Each piece gives its least
costs between the four states of `alternation`; chained from the end, these tell each piece what the rest costs; with that it chooses
its edits for each state it may begin in, and one pass in order puts the choices together. That last pass reads a
conversation's pieces as a stream in one task, as SHA-256 over the repaired turns allows no other way, and holds no turn
but the current one; only the audit, which is one value of the result, grows.

Rows: null conversations are one conversation; in checksums, roles and texts null is one blank; turns order null first.
Rows of one turn go by role, then by the md5 of their text. Repeated rows are duplicates of the first. Very long texts are handled
as they are; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from . import alternation as A
from .common import durable, pick, shuffle_width

BLANKS = " \t\n\x0b\x0c\r"
#: Turns, and characters, of one conversation that a task holds at most before it goes on in pieces.
PIECE, CHARACTERS = 4096, 1 << 25
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
OPEN = "piece long, seq long, turn long, role string, text string, dropped boolean, digest string"


def damaged(rows: DataFrame) -> DataFrame:
    """`conv_id, turn, role, text, dropped, digest`: each turn damaged by the checksum of its conversation and number."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kinds = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("_kind"))
    text = F.when(F.col("_kind") <= 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    changed = kinds.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("_kind") == 0).alias("dropped"), F.explode(times))
    return changed.drop("col").withColumn("digest", F.md5(F.col("text").cast("binary")))


def fault(role: str, text: str, seen: bool) -> str:
    """The first fault of a turn: blank, duplicate, truncated or none."""
    body = text.rstrip(BLANKS)
    return "blank" if not body else "duplicate" if seen else "truncated" if body[-1] not in ".!?" else ""


def code_of(role: str, found: str) -> int:
    return A.code_of(role, found == "truncated", found in ("blank", "duplicate"))


class Report:
    """What is said of one conversation, turn by turn in order."""

    def __init__(self):
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost", "turns"), 0)
        self.low = self.high = self.before = None
        self.state, self.audit, self.hash, self.some = A.NONE, [], hashlib.sha256(), False

    def _put(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.some else "") + f"{role}:{text}").encode())
        self.some = True
        self.state = {"s": A.SYSTEM, "u": A.USER, "a": A.ASSISTANT}[role[0]]

    def _next(self) -> str:
        return "assistant" if self.state == A.USER else "user"

    def insert(self, times: int) -> None:
        for _ in range(times):
            self._put(self._next(), "")
        self.counts["cost"] += A.INSERT * times
        self.audit.append("I" * times)

    def turn(self, turn: int | None, role: str, text: str, found: str, letter: str) -> None:
        if turn is not None and turn != self.high:
            self.low, self.high = turn if self.low is None else self.low, turn
            self.counts["turns"] += 1
        if self.before is not None:
            self.counts["illegal"] += self.before + role[:1] not in ("su", "ua", "au")
        self.before = role[:1]
        if found:
            self.counts[found] += 1
        if letter == "D":
            self.counts["cost"] += A.DELETE
        else:
            self.counts["cost"] += (A.REROLE if letter == "R" else A.KEEP) + (A.TRUNCATED if found == "truncated" else 0)
            self._put(role if letter == "K" else self._next(), text)
        self.audit.append(letter)

    def row(self) -> tuple:
        self.insert(len(A.END_LETTERS[self.state]))
        c = self.counts
        gaps = 0 if self.low is None else self.high - self.low + 1 - c["turns"]
        return (gaps, c["blank"], c["duplicate"], c["truncated"], c["illegal"], c["cost"], "".join(self.audit), self.hash.hexdigest())


def edits(audit: str) -> Iterator[tuple[int, str]]:
    """(insertions before it, letter) of each turn."""
    inserted = 0
    for letter in audit:
        if letter == "I":
            inserted += 1
        else:
            yield inserted, letter
            inserted = 0


def report_of(turns: list[tuple]) -> tuple:
    """The report of a whole conversation of (turn, role, text, dropped, digest), in order."""
    live, seen = [], set()
    for turn, role, text, dropped, digest in turns:
        if not dropped:
            live.append((turn, role, text, fault(role, text, (role, digest) in seen)))
            seen.add((role, digest))
    report = Report()
    if live:
        ((audit, _),) = A.run_audit([code_of(role, found) for _, role, _, found in live], (A.NONE,), A.END_COSTS)
        for (inserted, letter), row in zip(edits(audit), live, strict=True):
            report.insert(inserted)
            report.turn(*row, letter)
    return report.row()


def batches_of(rows: Iterable[tuple], schema: pa.Schema, most: int = 2000) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded size."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= most or size > CHARACTERS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for first in range(0, batch.num_rows, 2000):
            yield from zip(*[c.to_pylist() for c in batch.slice(first, 2000).columns])


def mapped(df: DataFrame, each: Callable[[Iterator[tuple]], Iterable[tuple]], more: str) -> DataFrame:
    """`each` over the rows of a partition; it gives rows of the conversation and the columns `more`."""
    schema = StructType([StructField("conv_id", df.schema["conv_id"].dataType), *StructType.fromDDL(more).fields])
    arrow = to_arrow_schema(schema)
    return df.mapInArrow(lambda batches: batches_of(each(rows_of(batches)), arrow), schema)


def sorted_by(df: DataFrame, *columns) -> DataFrame:
    """All rows of a conversation in one partition, in the order of the columns."""
    return df.repartition(shuffle_width(df.sparkSession), "conv_id").sortWithinPartitions("conv_id", *columns)


def grouped(rows: Iterator[tuple], width: int = 1) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    return groupby(rows, key=lambda row: row[:width])


def first_pass(rows: Iterator[tuple], most: int) -> Iterator[tuple]:
    """Reports of the conversations that lie within a partition; the others' turns, in pieces of at most `most`."""
    part = TaskContext.get().partitionId() << 32
    nothing, none = (None,) * 8, (None,) * 7
    held: list[tuple] = []
    size, count, whole = 0, 0, False  # of the current conversation; the first of a partition may have begun before
    conv = started = None

    def pieces(turns: list[tuple], at: int) -> Iterator[tuple]:
        for k, turn in enumerate(turns, at):
            yield (conv, *nothing, part + k // most, k, *turn)

    for conv_now, *turn in rows:
        if not started or conv_now != conv:
            if held and whole:
                yield (conv, *report_of(held), *none)
            elif held:
                yield from pieces(held, count)
            # Pieces of a conversation are numbered from 0 in each partition.
            conv, held, size, count, whole, started = conv_now, [], 0, 0, bool(started), True
        held.append(tuple(turn))
        size += len(turn[2])
        if len(held) >= most or size > CHARACTERS:
            yield from pieces(held, count)
            held, size, count, whole = [], 0, count + len(held), False
    yield from pieces(held, count)


def first_turns(turns: DataFrame) -> DataFrame:
    """The turns of conversations in pieces, with `seen`: whether role and text stood in an earlier turn, or earlier in this one."""
    place = F.struct("piece", "seq")
    live = turns.where("NOT dropped").groupBy("conv_id", "role", "digest").agg(F.min(place).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    firsts = live.select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), "_first")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    return turns.join(firsts, same, "left").withColumn("seen", F.coalesce(F.col("_first") < place, F.lit(False))).select(*turns.columns, "seen")


def codes_in(rows: Iterable[tuple]) -> list[int]:
    """Codes of the live turns of a piece: rows of (conv, piece, seq, turn, role, text, dropped, seen)."""
    return [code_of(role, fault(role, text, seen)) for *_, role, text, dropped, seen in rows if not dropped]


def costs_of_pieces(rows: Iterator[tuple]) -> Iterator[tuple]:
    for key, piece in grouped(rows, 2):
        yield (*key, [c for row in A.run_costs(codes_in(piece)) for c in row])


def costs_after(rows: Iterator[tuple]) -> Iterator[tuple]:
    """What the pieces after each piece cost from each state; pieces come last first."""
    for _, pieces in grouped(rows):
        rest = A.END_COSTS
        for conv, piece, costs in pieces:
            yield conv, piece, rest
            rest = [min(A.FAR, *(costs[4 * e + x] + rest[x] for x in range(4))) for e in range(4)]


def choices(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Per piece the audits and states after it, for each state before it; rows end in what the rest costs."""
    for key, piece in grouped(rows, 2):
        turns = list(piece)
        found = A.run_audit(codes_in(t[:-1] for t in turns), (0, 1, 2, 3), turns[0][-1])
        yield (*key, -1, None, None, None, True, False, [a for a, _ in found], [x for _, x in found])


def put_together(rows: Iterator[tuple]) -> Iterator[tuple]:
    for (conv,), turns in grouped(rows):
        report = Report()
        todo: Iterator[tuple[int, str]] = iter(())
        for _, _, seq, turn, role, text, dropped, seen, audits, _after in turns:
            if seq < 0:
                todo = edits(audits[report.state])
            elif not dropped:
                inserted, letter = next(todo)
                report.insert(inserted)
                report.turn(turn, role, text, fault(role, text, seen), letter)
        yield (conv, *report.row())


def repair(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", piece: int = PIECE) -> DataFrame:
    """`conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256` per conversation, after the damage."""
    turns = damaged(pick(conversations, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)).select("conv_id", "turn", "role", "text", "dropped", "digest")
    keys = ["conv_id", "turn", "role", "digest"]
    dealt = turns.repartitionByRange(shuffle_width(turns.sparkSession), *keys).sortWithinPartitions(*keys)
    passed = durable(mapped(dealt, lambda rows: first_pass(rows, piece), f"{REPORT}, {OPEN}"))
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    done = passed.where("piece IS NULL").select(*names)
    open_ = durable(first_turns(passed.where("piece IS NOT NULL").select("conv_id", "piece", "seq", "turn", "role", "text", "dropped", "digest")).drop("digest"))
    n = shuffle_width(turns.sparkSession)

    def by_piece(df: DataFrame) -> DataFrame:
        return df.repartition(n, "conv_id", "piece").sortWithinPartitions("conv_id", "piece", "seq")

    costs = mapped(by_piece(open_), costs_of_pieces, "piece long, costs array<long>")
    rest = mapped(sorted_by(costs, F.col("piece").desc()), costs_after, "piece long, rest array<long>")
    rest = durable(rest).select(F.col("conv_id").alias("_conv"), F.col("piece").alias("_piece"), "rest")
    with_rest = open_.join(rest, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("piece") == F.col("_piece"))).select(*open_.columns, "rest")
    chosen = mapped(by_piece(with_rest), choices, "piece long, seq long, turn long, role string, text string, dropped boolean, seen boolean, audits array<string>, after array<long>")
    both = chosen.unionByName(open_, allowMissingColumns=True)
    return done.unionByName(mapped(sorted_by(both, "piece", "seq"), put_together, REPORT))
