"""Quality classifier from weak labels.

Eight heuristics vote good, bad or neither on every document, or are unable to. Documents with the same votes are one
pattern (4^8 at most), so one aggregation over all documents gives all that expectation-maximisation needs; it estimates how often each
heuristic votes what for either class, and the posterior of every pattern. The posteriors then are the labels of a
hashed linear scorer, fitted on a bounded sample of documents (`fit_rows` at most, by a hash of the id), which scores all
texts.

Nulls and empty texts get no votes and score 0 (not kept). Ids may be null or repeat; repeated rows score alike; tables
may be empty; columns other than id and text are ignored. Very long texts are read whole. A score equal to the threshold
is kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, utf8

BAD, GOOD, NONE, UNABLE = range(4)
BITS = 16
LETTERS = re.compile(rb"[A-Za-z\x80-\xff]+")
LABELLERS = ("symbols", "capitals", "variety", "repeats", "stops", "lines", "lengths", "shape")
ODD = bytes(range(33, 127)).translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789.,;:'\"()-?")
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
SHAPE = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))
RUNS = re.compile(rb"(.)\1+", re.DOTALL)


def share_of(text: bytes, some: bytes) -> float:
    return (len(text) - len(text.translate(None, some))) / max(1, len(text))


def between(value: float, bad_below: float, good_from: float, good_to: float, bad_above: float) -> int:
    return BAD if value < bad_below or value > bad_above else GOOD if good_from <= value <= good_to else NONE


def votes(text: bytes) -> list[int]:
    """One vote per labeller; those that need words are unable to on texts of fewer than eight."""
    words = text.split()
    n = len(words)
    if not n:
        return [UNABLE] * len(LABELLERS)
    upper, lower = share_of(text, UPPER), share_of(text, LOWER)
    lines = [x for x in text.split(b"\n") if x]
    enough = n >= 8
    ends = sum(w[-1:] in (b".", b"?") for w in words) / n
    repeats = sum(a == b for a, b in pairwise(words)) / n
    return [
        between(share_of(text, ODD), 0, 0, 0.01, 0.05),
        between(upper / max(upper + lower, 1e-9), 0, 0, 0.15, 0.4),
        between(len(set(words)) / n, 0.3 if n < 2000 else 0.1, 0.45, 1, 1) if enough else UNABLE,
        between(repeats, 0, 0, 0.02, 0.1) if enough else UNABLE,
        between(ends, 0.01, 0.03, 0.35, 0.6) if enough else UNABLE,
        between(len(set(lines)) / len(lines), 0.5, 0.9, 1, 1) if len(lines) > 2 else UNABLE,
        between(len(text) / n, 3, 4, 9, 14) if enough else UNABLE,
        between(sum(w.isalpha() or w[:-1].isalpha() or not w.isascii() for w in words) / n, 0.7, 0.9, 1, 1) if enough else UNABLE,
    ]


def pattern_of(own: list[int]) -> int:
    return sum(v << 2 * k for k, v in enumerate(own))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Posterior of good for each pattern, by expectation-maximisation over (patterns, labellers) votes."""
    voted = patterns < NONE
    # To begin with, the share of good votes; better-than-chance labellers keep the classes from changing places.
    p = np.where(voted.any(axis=1), ((patterns == GOOD).sum(axis=1) + 1) / (voted.sum(axis=1) + 2), 0.5)
    for _ in range(rounds):
        prior = (counts * p).sum() / counts.sum()
        logs = np.zeros((2, len(patterns)))
        for k, weight in ((GOOD, p), (BAD, 1 - p)):
            table = np.stack([((counts * weight)[:, None] * (patterns == v)).sum(axis=0) for v in (BAD, GOOD, NONE)]) + 1.0
            # Who can't vote says nothing: short texts, on which few can, aren't bad for that.
            table = np.concatenate([table / table.sum(axis=0), np.ones((1, patterns.shape[1]))])
            logs[k] = np.log(table)[patterns, np.arange(patterns.shape[1])].sum(axis=1) + np.log(max(prior if k == GOOD else 1 - prior, 1e-9))
        new = 1 / (1 + np.exp(np.clip(logs[BAD] - logs[GOOD], -50, 50)))
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return p


class Slots(dict):
    """The hash slots of a word: itself without case and marks, and its shape."""

    most = 300_000

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= self.most:
            self.clear()
        plain = b"".join(LETTERS.findall(word)).lower()
        shape = RUNS.sub(rb"\1+", word.translate(SHAPE))
        value = self[word] = (xxhash.xxh3_64_intdigest(plain, 1) >> 64 - BITS, xxhash.xxh3_64_intdigest(shape, 2) >> 64 - BITS)
        return value


def features(text: bytes, slots: Slots) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values: square roots of the shares of words, shapes and immediate repeats."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    found = np.array([slots[w] for w in words], np.int64)
    again = np.concatenate([[False], found[1:, 0] == found[:-1, 0]])
    every = np.concatenate([found[:, 0], found[:, 1], np.where(again, 1, 0)])
    at, n = np.unique(every, return_counts=True)
    return at, np.sqrt(n / len(words)).astype(np.float32)


def voted(rows: DataFrame) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pattern_of(votes(t)) for t in utf8(batch, "text")], pa.int32())], ["doc_id", "pattern"])

    return rows.mapInArrow(each, f"doc_id {dict(rows.dtypes)['doc_id']}, pattern int")


def posteriors(rows: DataFrame) -> tuple[dict[int, float], int]:
    """Posterior by vote pattern, and the number of rows; 4^8 sums at most reach the driver."""
    sums = {r["pattern"]: r["n"] for r in voted(rows).groupBy("pattern").agg(F.count("*").alias("n")).collect()}
    if not sums:
        return {}, 0
    codes = np.array(sorted(sums))
    patterns = codes[:, None] >> 2 * np.arange(len(LABELLERS)) & 3
    counts = np.array([sums[int(c)] for c in codes], float)
    return dict(zip(codes.tolist(), estimate(patterns, counts).tolist(), strict=True)), int(counts.sum())


def fit(sample: list[tuple[np.ndarray, np.ndarray]], targets: np.ndarray, *, epochs: int = 12, rate: float = 2.0, decay: float = 1e-6) -> np.ndarray:
    """Logistic regression on soft labels by stochastic gradients in a fixed order; the last weight is the offset."""
    w = np.zeros((1 << BITS) + 1)
    order = np.random.default_rng(7)
    for epoch in range(epochs):
        step = rate / (1 + epoch)
        for i in order.permutation(len(sample)):
            at, value = sample[i]
            p = 1 / (1 + np.exp(-np.clip(w[at] @ value + w[-1], -30, 30)))
            w[at] -= step * ((p - targets[i]) * value + decay * w[at])
            w[-1] -= 0.1 * step * (p - targets[i])
    return w


def sampled(rows: DataFrame, by_pattern: dict[int, float], total: int, fit_rows: int) -> tuple[list, np.ndarray]:
    """Features and posteriors of `fit_rows` documents at most: those of the smallest hashes of id and length.

    A first cut at twice the share asked for keeps the rows that are looked at few; the limit then holds exactly, also
    where a third of all rows have one hash. Every task gives its `fit_rows` smallest at most.
    """
    h = F.xxhash64("doc_id", F.length("text")).bitwiseAND(F.lit((1 << 63) - 1))
    share = min(1.0, 2 * fit_rows / max(1, total))
    picked = rows.withColumn("hash", h).where(F.col("hash") <= F.lit(int(share * ((1 << 63) - 1)) if share < 1 else (1 << 63) - 1))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = Slots()
        for batch in batches:
            made = [(pattern_of(votes(t)), *features(t, slots)) for t in utf8(batch, "text")]
            columns = [batch.column(0), pa.array([m[0] for m in made], pa.int32()), pa.array([m[1].astype(np.int32) for m in made], pa.list_(pa.int32())), pa.array([m[2] for m in made], pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(columns, ["hash", "pattern", "at", "value"])

    made = picked.select("hash", "text").mapInArrow(each, "hash long, pattern int, at array<int>, value array<float>")
    found = sorted((r["pattern"], tuple(r["at"]), tuple(r["value"])) for r in made.orderBy("hash", "pattern", "at").limit(fit_rows).collect())
    return [(np.array(at, np.int64), np.array(value, np.float32)) for _, at, value in found], np.array([by_pattern.get(p, 0.5) for p, _, _ in found])


def classify(docs: DataFrame, *, fit_rows: int = 4000, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, weak_label, score, keep`: posterior of the votes, the scorer's probability of good, and the verdict."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    by_pattern, total = posteriors(rows)
    weights = fit(*sampled(rows, by_pattern, total, fit_rows)).astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast((weights, by_pattern))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (weights, by_pattern), slots = shared.value, Slots()
        for batch in batches:
            weak, score = [], []
            for text in utf8(batch, "text"):
                at, value = features(text, slots)
                weak.append(by_pattern.get(pattern_of(votes(text)), 0.5))
                score.append(float(1 / (1 + np.exp(-np.clip(weights[at] @ value + weights[-1], -30, 30)))) if len(at) else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(weak), pa.array(score), pa.array([s >= threshold for s in score], pa.bool_())], ["doc_id", "weak_label", "score", "keep"])

    return rows.mapInArrow(scored, f"doc_id {dict(rows.dtypes)['doc_id']}, weak_label double, score double, keep boolean")
