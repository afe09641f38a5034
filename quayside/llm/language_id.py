"""Language identification of texts and of their spans.

Training counts hashed letter trigrams per language, and the letters of each script per language, over all training rows
in one pass; tasks send sums, so the model's size is languages times buckets whatever the corpus.

Prediction: the script of a word narrows the candidates to languages that use it; the word scores each candidate by its
trigrams' log probabilities; a Viterbi pass over the words, with a penalty for switching, labels every word, so that
mixed texts fall into spans. A document's language is the one that most of its letters got, its score their share.

Null texts and texts without a letter are `und` with score 0, as is everything if no row has a language. Ties go to the
language that sorts first. Ids may be null or repeat, repeated rows get equal results, tables may be empty, further
columns are ignored. Very long texts are read whole; a task holds one text's scores, languages times words, at a time.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, pick, utf8

#: First code points of the scripts told apart; each reaches to the next entry. Fixed values.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0780, "other"),
    (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x2DE0, "cyrillic"), (0x2E00, "other"), (0x3040, "kana"),
    (0x3100, "han"), (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"), (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0x20000, "han"), (0x32000, "other"),
)
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
BUCKETS = 1 << 15


@functools.cache
def _letters() -> np.ndarray:
    """Of each code point: 0 if it is no letter, else 1 + the number of its script."""
    table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.uint8, 0x110000)
    for (first, name), (last, _) in zip(SCRIPTS, [*SCRIPTS[1:], (0x110000, "")], strict=True):
        table[first:last] *= 1 + SCRIPT_NAMES.index(name)
    return table


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, bucket) of every trigram with a letter, and per word the letters of each script.

    Words are set in blanks; what is no letter is a blank too.
    """
    text = " " + "  ".join(words).lower() + " "
    # Lower case can change lengths, so word numbers are counted on the double blanks, which no word contains.
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    script = _letters()[code]
    blank = code == 32
    begins = np.zeros(len(code), np.int64)
    begins[1:] = blank[1:] & blank[:-1]
    number = np.cumsum(begins)
    code = np.where(script > 0, code, 32)
    h = (code[:-2] * 0x9E3779B1 + code[1:-1] * 0x85EBCA77 + code[2:] * 0xC2B2AE3D) & 0xFFFFFFFF
    h = ((h ^ h >> 15) * 0x2C1B3C6D & 0xFFFFFFFF) >> 17
    inside = (script[1:-1] > 0) | (script[:-2] > 0) & (script[2:] > 0)
    letters = np.zeros((len(words), len(SCRIPT_NAMES)), np.int64)
    at = (script > 0).nonzero()[0]
    np.add.at(letters, (number[at], script[at].astype(np.int64) - 1), 1)
    return number[1:-1][inside], h[inside], letters


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # (buckets, languages)
    allowed: np.ndarray  # (scripts, languages)


def counts_of(rows: DataFrame, most_words: int = 300_000) -> DataFrame:
    """`lang, kind, slot, n`: trigrams by bucket (kind t) and letters by script (kind s), over rows of `text, lang`."""

    def summed(lang: str, words: Counter) -> pa.RecordBatch:
        number, bucket, letters = trigrams(list(words))
        times = np.fromiter(words.values(), np.int64, len(words))
        grams = np.bincount(bucket, times[number], BUCKETS).astype(np.int64)
        scripts = (letters * times[:, None]).sum(axis=0)
        slots = np.concatenate([grams.nonzero()[0], scripts.nonzero()[0]])
        n_grams = np.count_nonzero(grams)
        kinds = ["t"] * n_grams + ["s"] * (len(slots) - n_grams)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(slots), pa.string()), pa.array(kinds, pa.string()), pa.array(slots, pa.int64()), pa.array(np.concatenate([grams[grams > 0], scripts[scripts > 0]]), pa.int64())], ["lang", "kind", "slot", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(1).to_pylist(), utf8(batch, "text"), strict=True):
                words.setdefault(lang, Counter()).update(text.decode().split())
                if len(words[lang]) > most_words:
                    yield summed(lang, words.pop(lang))
        for lang, own in words.items():
            if own:
                yield summed(lang, own)

    return rows.select("text", "lang").mapInArrow(count, "lang string, kind string, slot long, n long").groupBy("lang", "kind", "slot").agg(F.sum("n").alias("n"))


def train(rows: DataFrame, *, most_languages: int = 256, script_share: float = 0.01) -> Model:
    """A model of rows `text, lang`. At most languages x (buckets + scripts) counts reach the driver."""
    counts = durable(counts_of(rows.where("text IS NOT NULL AND lang IS NOT NULL")))
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().limit(most_languages + 1).collect())
    if len(languages) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    grams, scripts = np.zeros((BUCKETS, len(languages))), np.zeros((len(SCRIPT_NAMES), len(languages)))
    at = {lang: i for i, lang in enumerate(languages)}
    # Row after row into the arrays, which are all that the driver holds.
    for r in counts.toLocalIterator():
        (grams if r["kind"] == "t" else scripts)[r["slot"], at[r["lang"]]] = r["n"]
    smooth = 0.5
    logs = np.log((grams + smooth) / (grams.sum(axis=0) + smooth * BUCKETS)).astype(np.float32)
    allowed = scripts >= script_share * np.maximum(scripts.sum(axis=0), 1)
    allowed[~allowed.any(axis=1)] = True  # a script that no language has narrows nothing
    return Model(languages, logs, allowed)


class WordScores:
    """Score rows of words; kept until `most` are known."""

    def __init__(self, model: Model, most: int = 300_000):
        self.model, self.most = model, most
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.scores = np.zeros((1024, len(self.model.languages)), np.float32)
        self.letters = np.zeros(1024, np.int64)

    def numbers(self, words: list[str]) -> np.ndarray:
        missing = list({w for w in words if w not in self.at})
        if len(self.at) + len(missing) > self.most:
            self.clear()
            missing = list(set(words))
        if missing:
            n, end = len(self.at), len(self.at) + len(missing)
            if end > len(self.letters):
                room = max(end, 2 * len(self.letters))
                self.scores = np.concatenate([self.scores, np.zeros((room - len(self.scores), self.scores.shape[1]), np.float32)])
                self.letters = np.concatenate([self.letters, np.zeros(room - len(self.letters), np.int64)])
            number, bucket, letters = trigrams(missing)
            own = self.scores[n:end]
            for k in range(own.shape[1]):
                own[:, k] = np.bincount(number, self.model.logs[bucket, k], len(missing))
            total = letters.sum(axis=1)
            own[~self.model.allowed[letters.argmax(axis=1)] & (total > 0)[:, None]] -= 50
            self.letters[n:end] = total
            self.at.update(zip(missing, range(n, end), strict=True))
        return np.fromiter((self.at[w] for w in words), np.int64, len(words))


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """Labels (texts, words) of the best paths; `scores` is (texts, words, languages), padded with zeros."""
    texts, steps, languages = scores.shape
    stays = np.ones((steps, texts, languages), bool)
    best_before = np.zeros((steps, texts), np.int64)
    value = scores[:, 0].copy()
    for t in range(1, steps):
        best = value.argmax(axis=1)
        switched = value[np.arange(texts), best] - penalty
        np.greater_equal(value, switched[:, None], out=stays[t])
        best_before[t] = best
        # Beyond a text's end its padding adds nothing, and the best path never pays for a switch there.
        value = np.maximum(value, switched[:, None]) + scores[:, t]
    labels = np.zeros((texts, steps), np.int64)
    now = value.argmax(axis=1)
    every = np.arange(texts)
    for t in range(steps - 1, -1, -1):
        labels[:, t] = now
        now = np.where(stays[t, every, now], now, best_before[t])
    return labels


def label_texts(texts: list[str], known: WordScores, penalty: float, cells: int = 200_000) -> list[tuple[np.ndarray, np.ndarray]]:
    """(labels, letters) of the words of each text, in groups of texts of like length."""
    numbers, out = [], [None] * len(texts)
    order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
    group: list[int] = []

    def finish() -> None:
        longest = max(len(n) for n in numbers)
        scores = np.zeros((len(group), max(longest, 1), len(known.model.languages)), np.float32)
        for k, n in enumerate(numbers):
            scores[k, : len(n)] = n_scores[k]
        labels = viterbi(scores, np.array([len(n) for n in numbers]), penalty)
        for k, i in enumerate(group):
            out[i] = (labels[k, : len(numbers[k])], n_letters[k])
        for x in (group, numbers, n_scores, n_letters):
            x.clear()

    n_scores, n_letters = [], []
    for i in order:
        own = known.numbers(texts[i].split())
        if group and (len(group) + 1) * max(len(own), *(len(n) for n in numbers[-1:])) > cells:
            finish()
        group.append(i), numbers.append(own), n_scores.append(known.scores[own]), n_letters.append(known.letters[own])
    if group:
        finish()
    return out


def predictions(texts: list[str], model: Model, known: WordScores, penalty: float) -> tuple[list[str], list[float], list[list[dict]]]:
    """Language, score and spans of each text."""
    langs, scores, spans = [], [], []
    found = label_texts(texts, known, penalty) if model.languages else [(np.zeros(0, np.int64),) * 2] * len(texts)
    for labels, letters in found:
        by_language = np.bincount(labels, letters, len(model.languages)) if len(labels) else np.zeros(1)
        total = by_language.sum()
        langs.append(model.languages[by_language.argmax()] if total else "und")
        scores.append(float(by_language.max() / total) if total else 0.0)
        cuts = [0, *(np.diff(labels).nonzero()[0] + 1).tolist(), len(labels)] if total else [0]
        spans.append([{"start": s, "end": e, "lang": model.languages[labels[s]]} for s, e in zip(cuts, cuts[1:], strict=False)])
    return langs, scores, spans


def identify(docs: DataFrame, model: Model, *, penalty: float = 12.0, id_col: str = "doc_id", text_col: str = "text", with_spans: bool = False) -> DataFrame:
    """`doc_id, lang_pred, score` and, with_spans, `spans` of (first word, end word, lang); words are split at white space."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "lang_pred", "score"] + ["spans"] * with_spans
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known = WordScores(model)
        for whole in batches:
            for first in range(0, whole.num_rows, 1000):
                batch = whole.slice(first, 1000)
                langs, scores, spans = predictions([t.decode() for t in utf8(batch, "text")], model, known, penalty)
                columns = [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(spans, spans_type)] * with_spans, names)

    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, lang_pred string, score double"
    return rows.mapInArrow(predict, schema + ", spans array<struct<start:long,end:long,lang:string>>" * with_spans)


def held_out(doc_id: Column) -> Column:
    """One id in four by its checksum; a null id isn't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def model_of(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Trained on all rows with a language that aren't held out."""
    return train(docs.where(~held_out(docs[id_col])).select(docs[text_col].alias("text"), docs[lang_col].alias("lang")))


def known_language_only(docs: DataFrame, model: Model, *, least_score: float = 0.5, penalty: float = 12.0, text_col: str = "text") -> DataFrame:
    """The documents, all their columns, whose language is known with `least_score`; each row is judged by its own text, whatever its id."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known = WordScores(model)
        for whole in batches:
            for first in range(0, whole.num_rows, 1000):
                batch = whole.slice(first, 1000)
                langs, scores, _ = predictions([t.decode() for t in utf8(batch, text_col)], model, known, penalty)
                yield batch.filter(pa.array([lang != "und" and score >= least_score for lang, score in zip(langs, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
