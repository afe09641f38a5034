"""Personal data: spans of fixed patterns, and further ones by a semi-Markov conditional random field.

The field scores whole spans. Regions that could hold personal data (many digits, an at sign or its spelled form) are cut
into tokens; every stretch of tokens that has the make of an e-mail, an address, a card or a phone number is a candidate
segment with features of the whole span (digit groups, separators, checksum, what it is glued to, words before it), and
every other token is a segment of its own without a label. A dynamic programme over the tokens, whose entities are
bounded in digits or tokens, chooses boundaries and types of a region jointly, by segment scores and by scores of adjacent
labels. A span of the field is added where it doesn't overlap one of the fixed patterns, which always stay.

Weights come from the corpus: regions of a sample of distinct texts (`fit_rows` at most, those of the smallest hashes,
and of those `fit_regions` regions of up to 300 characters) are labelled by the fixed patterns. Each labelled span is also shown respelled as people write it to keep
machines off (`respelled`), with the same label, and broken (`broken`: a wrong checksum, a part over 255), without one. Their likelihood is
raised by forward and backward sums. Without examples nothing is added.

Null and empty texts have no spans; ids may be null or repeat; repeated rows get equal results; ties go to fewer labels.
Very long texts are read whole and regions of any length are decoded in time linear in them; empty tables give empty
results; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, utf8

KINDS = ("email", "ip", "card", "phone")
NO_LABEL = "none"
#: The fixed patterns. Possessive repeats and a look behind keep them linear in long runs; they match the same.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Where personal data may be: seven digits with up to three separators between each two, an address with dots in brackets, or an at sign, plain or spelled.
NUMERIC = re.compile(r"\+?\(?(?:[0-9][\x20().+/\[\]-]{0,3}){7,}")
DEFANGED = re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])")
AT = re.compile(r"\x20?(?:@|[\[(]at[\])]|(?<=\x20)at(?=\x20))\x20?", re.IGNORECASE)
SEED = re.compile(r"@|[\[(][Aa][Tt][\])]|\x20at\x20[A-Za-z0-9-]{1,63}\x20dot\x20")
SPELLED_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[(](?:dot|\.)[\])]\x20?|\x20dot\x20)[A-Za-z0-9-]{1,63}){1,8}", re.IGNORECASE)
TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|.", re.DOTALL)
WORD_BEFORE = re.compile(r"([A-Za-z]+)[^A-Za-z0-9]{0,3}\Z")
MOST_TOKENS = 48


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def passes_luhn(digits: str) -> bool:
    odd = [int(d) for d in digits[::-1]]
    return (sum(odd[::2]) + sum(2 * d - 9 * (d > 4) for d in odd[1::2])) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The fixed patterns' spans, by kind, then start."""
    out = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            end = domain.end()
            out.append(Span("email", start, end))
        at = text.find("@", max(at + 1, end))
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            out.append(Span("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and passes_luhn(digits):
            out.append(Span("card", *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(Span("phone", *m.span()))
    return out


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches that could hold personal data, in order and apart."""
    found = [m.span() for pattern in (NUMERIC, DEFANGED) for m in pattern.finditer(text)]
    for seed in SEED.finditer(text):
        mark = AT.match(text, seed.start() - (text[seed.start() - 1 : seed.start()] == " "))
        if not mark:
            continue
        start = mark.start()
        while start and text[start - 1] in LOCAL and mark.start() - start < 64:
            start -= 1
        domain = SPELLED_DOMAIN.match(text, mark.end())
        if start < mark.start() and domain:
            found.append((start, domain.end()))
    out: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


class Segment(NamedTuple):
    """Tokens first.. up to last (exclusive) with a label, and the features that score them."""

    first: int
    last: int
    kind: str
    features: tuple[str, ...]


class Region:
    """Tokens of a stretch of text and all candidate segments, by the token they end before."""

    def __init__(self, text: str, start: int, end: int):
        self.starts = [start + m.start() for m in TOKEN.finditer(text[start:end])] + [end]
        self.text = text
        self.tokens = [text[a:b] for a, b in zip(self.starts, self.starts[1:])]
        self.ending: list[list[Segment]] = [[] for _ in range(len(self.tokens) + 1)]
        for k, token in enumerate(self.tokens):
            shape = "digits" if token.isdigit() else "letters" if token.isalpha() else "at" if token == "@" else "other"
            self.ending[k + 1].append(Segment(k, k + 1, NO_LABEL, (f"token {shape}",)))
            if token[0].isdigit() or token in "+(" or token.isalpha():
                self._from(k)

    def _from(self, first: int) -> None:
        digits, groups, letters, at = "", [], False, False
        for last in range(first, min(len(self.tokens), first + MOST_TOKENS)):
            token = self.tokens[last]
            if "0" <= token[0] <= "9":
                if len(digits) + len(token) > 19 and not letters:
                    break
                digits += token
                groups.append(token)
            elif token.isalpha():
                letters = True
                at = at or token.lower() == "at"
            else:
                at = at or token == "@"
                continue
            # A span ends in a letter or a digit; one with letters is an e-mail, and e-mails have an at.
            if letters:
                if at and self.tokens[first][0].isalnum():
                    self._add(first, last + 1, "email", digits, groups)
            else:
                # An address has dots between its parts; phones and cards have few groups.
                if len(groups) == 4 and self.tokens[first].isdigit() and self.tokens[first : last + 1].count(".") == 3:
                    self._add(first, last + 1, "ip", digits, groups)
                if 8 <= len(digits) <= 15 and len(groups) <= 6:
                    self._add(first, last + 1, "phone", digits, groups)
                if 16 <= len(digits) <= 19 and len(groups) <= 8 and self.tokens[first].isdigit():
                    self._add(first, last + 1, "card", digits, groups)

    def _add(self, first: int, last: int, kind: str, digits: str, groups: list[str]) -> None:
        start, end = self.starts[first], self.starts[last]
        whole, before, after = self.text[start:end], self.text[max(0, start - 24) : start], self.text[end : end + 2]
        found = ["bias"]
        between = {re.sub(r"[\[\]()\x20]", "", s) or s.strip()[:1] or s[:1] for s in re.split(r"[A-Za-z0-9]+", whole)[1:-1]}
        if before[-1:].isalnum():
            found.append("glued before")
        if after[:1].isalnum():
            found.append("glued behind")
        if before[-1:] in tuple("+.-/(") or before[-2:-1].isdigit() and before[-1:] == " ":
            found.append("goes on before")
        if after[:1] in tuple("-/") or after[1:].isdigit() and not after[:1].isalnum():
            found.append("goes on behind")
        if word := WORD_BEFORE.search(before):
            word = word.group(1).lower()
            for hint in ("call", "tel", "phone", "mobil", "card", "visa", "server", "host", "addr", "mail", "contact"):
                if word.startswith(hint):
                    found.append(f"after {hint}")
        if kind == "email":
            mark = AT.search(whole)
            name, domain = (whole[: mark.start()], whole[mark.end() :]) if mark else ("", "")
            found.append("at spelled" if mark and "@" not in mark.group() else "at sign" if mark else "at missing")
            parts = re.split(r"\.|\x20?[\[(](?:dot|\.)[\])]\x20?|\x20dot\x20", domain, flags=re.IGNORECASE)
            found.append("name whole" if name and set(name) <= LOCAL else "name broken")
            found.append("domain whole" if len(parts) > 1 and all(p and p.replace("-", "").isalnum() for p in parts) else "domain broken")
            if parts[-1].isalpha() and 2 <= len(parts[-1]) <= 24:
                found.append("ends in letters")
        else:
            found += [f"digits {min(len(digits), 20)}", f"groups {min(len(groups), 6)}", f"begins {whole[0] if whole[0] in '+(' else 'digit'}"]
            found.append(f"between {''.join(sorted(between))[:4]}" if len(between) < 4 else "between many")
            found.append("sizes " + "-".join(str(min(len(g), 5)) for g in groups[:6]))
            if kind == "card":
                found.append("checks" if passes_luhn(digits) else "fails")
            if kind == "ip":
                found.append("fits" if all(len(g) <= 3 and int(g) <= 255 for g in groups) else "too large")
        self.ending[last].append(Segment(first, last, kind, tuple(f"{kind} {f}" for f in found)))


class Field:
    """A semi-Markov conditional random field: weights of features and of adjacent labels."""

    def __init__(self, weights: dict[str, float] | None = None):
        # Before any example, an entity costs more than its tokens without a label.
        self.weights = defaultdict(float, weights or {f"{k} bias": -4.0 for k in KINDS})

    def _score(self, segment: Segment) -> float:
        return sum(self.weights[f] for f in segment.features)

    @staticmethod
    def _between(before: str, kind: str) -> str:
        return f"{before} > {kind}"

    def decode(self, region: Region) -> list[Span]:
        """The spans of the best labelling."""
        best: list[dict[str, tuple[float, Segment | None, str]]] = [{NO_LABEL: (0.0, None, "")}]
        for segments in region.ending[1:]:
            here: dict[str, tuple[float, Segment | None, str]] = {}
            for segment in segments:
                own = self._score(segment)
                for before, (score, *_) in best[segment.first].items():
                    value = score + own + self.weights.get(self._between(before, segment.kind), 0.0)
                    if segment.kind not in here or value > here[segment.kind][0]:
                        here[segment.kind] = (value, segment, before)
            best.append(here)
        at, out = len(best) - 1, []
        label = max(sorted(best[at], key=lambda k: k != NO_LABEL), key=lambda k: best[at][k][0])
        while at:
            _, segment, before = best[at][label]
            if label != NO_LABEL:
                out.append(Span(label, region.starts[segment.first], region.starts[segment.last]))
            at, label = segment.first, before
        return out[::-1]

    def _sums(self, region: Region):
        """Forward and backward log sums per place and label, and the segments with their scores."""
        n = len(region.tokens)
        scored = [[(s, self._score(s)) for s in segments] for segments in region.ending]
        ahead: list[dict[str, float]] = [{NO_LABEL: 0.0}] + [{} for _ in range(n)]
        for at in range(1, n + 1):
            for s, own in scored[at]:
                for before, value in ahead[s.first].items():
                    _raise(ahead[at], s.kind, value + own + self.weights.get(self._between(before, s.kind), 0.0))
        back: list[dict[str, float]] = [{} for _ in range(n)] + [dict.fromkeys(ahead[n], 0.0)]
        for at in range(n, 0, -1):
            for s, own in scored[at]:
                for before in ahead[s.first]:
                    _raise(back[s.first], before, back[at][s.kind] + own + self.weights.get(self._between(before, s.kind), 0.0))
        return scored, ahead, back

    def gradient(self, region: Region, gold: set[tuple[int, int, str]]) -> dict[str, float]:
        """Features of the gold labelling less those expected."""
        scored, ahead, back = self._sums(region)
        total = back[0][NO_LABEL]
        out: dict[str, float] = defaultdict(float)
        for segments in scored:
            for s, own in segments:
                for before, value in ahead[s.first].items():
                    link = self._between(before, s.kind)
                    p = math.exp(value + own + self.weights.get(link, 0.0) + back[s.last][s.kind] - total)
                    if p > 1e-6:
                        out[link] -= p
                        for f in s.features:
                            out[f] -= p
        at, before = 0, NO_LABEL
        starts = {first: (last, kind) for first, last, kind in gold}
        while at < len(region.tokens):
            last, kind = starts.get(at, (at + 1, NO_LABEL))
            s = next(s for s in region.ending[last] if s.first == at and s.kind == kind)
            out[self._between(before, kind)] += 1
            for f in s.features:
                out[f] += 1
            at, before = last, kind
        return out

    def fit(self, examples: list[tuple[Region, set[tuple[int, int, str]]]], rounds: int = 12, rate: float = 0.5, decay: float = 1e-3) -> Field:
        """Raise the likelihood of the examples, one at a time, by steps that shrink with a weight's own past gradients."""
        squares: dict[str, float] = defaultdict(float)
        for _ in range(rounds):
            for region, gold in examples:
                for f, g in self.gradient(region, gold).items():
                    g -= decay * self.weights[f]
                    squares[f] += g * g
                    if g:
                        self.weights[f] += rate * g / math.sqrt(squares[f])
        return self


def _raise(sums: dict[str, float], key: str, value: float) -> None:
    """log(exp(sums[key]) + exp(value)) in place."""
    if key not in sums:
        sums[key] = value
    else:
        high, low = max(sums[key], value), min(sums[key], value)
        sums[key] = high + math.log1p(math.exp(low - high))


def respelled(kind: str, span: str) -> list[str]:
    """A span as it is written past fixed patterns."""
    digits = re.sub("[^0-9]", "", span)
    if kind == "email":
        name, _, domain = span.partition("@")
        return [f"{name}{at}{domain.replace('.', dot)}" for at, dot in ((" (at) ", " (dot) "), ("[at]", "[dot]"), (" at ", " dot "), (" @ ", "."), ("(at)", "."))]
    if kind == "ip":
        return [span.replace(".", "[.]"), span.replace(".", "(.)")]
    if kind == "card":
        return [sep.join(digits[k : k + 4] for k in range(0, len(digits), 4)) for sep in (".", "/")]
    if len(digits) < 10:
        return []
    a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
    return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}"]


def broken(kind: str, span: str) -> list[str]:
    """A span changed so that it is none."""
    digits = re.sub("[^0-9]", "", span)
    if kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + 1) % 10)
        return [wrong, *respelled("card", wrong)]
    if kind == "ip":
        large = ".".join(str(int(part[-3:]) + 256) for part in span.split("."))
        return [large, large.replace(".", "[.]")]
    if kind == "phone":
        return [digits, digits[-8:], f"{digits[:4]}-{digits[4:6]}-{digits[6:8]} {digits[-2:]}", f"978-{digits[:1]}-{digits[1:3]}-{digits[3:9]}-{digits[-1:]}"]
    return [span.replace("@", " at ").partition(" at ")[2].replace(".", " ")]


def examples_of(text: str, start: int, end: int) -> list[tuple[Region, set[tuple[int, int, str]]]]:
    """The region as the fixed patterns label it, and its labelled spans respelled and broken where they stand."""
    out = []

    def add(text: str, spans: list[Span], start: int, end: int) -> None:
        region = Region(text, start, end)
        place = {at: k for k, at in enumerate(region.starts)}
        gold = {(place[s.start], place[s.end], s.kind) for s in spans if s.start in place and s.end in place}
        # What the patterns found must be candidates, each token in one of them.
        if len(gold) == len(spans) and all(any((s.first, s.kind) == (first, kind) for s in region.ending[last]) for first, last, kind in gold):
            out.append((region, gold))

    taken: list[Span] = []
    for span in base_spans(text):
        if start <= span.start and span.end <= end and all(span.end <= t.start or span.start >= t.end for t in taken):
            taken.append(span)
    add(text, taken, start, end)
    if len(taken) == 1:
        ((kind, a, b),) = taken
        for label, forms in ((True, respelled(kind, text[a:b])), (False, broken(kind, text[a:b]))):
            for form in forms:
                changed = text[:a] + form + text[b:]
                for first, last in regions(changed):
                    if first <= a and a + len(form) <= last:
                        add(changed, [Span(kind, a, a + len(form))] if label else [], first, last)
    return out


def trained(docs: DataFrame, *, fit_rows: int = 20_000, fit_regions: int = 400) -> Field:
    """The field fitted on regions of a bounded sample of distinct texts (`doc_id, text`)."""
    share = min(1.0, fit_rows / max(1, docs.count()))
    hashed = docs.where("text IS NOT NULL").select("text", F.xxhash64("text").alias("h")).where(F.abs(F.col("h") / F.lit(2.0**63)) <= share).dropDuplicates(["h"])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, h in zip(utf8(batch, "text"), batch.column(1).to_pylist(), strict=True):
                text = text.decode()
                for start, end in regions(text):
                    if end - start <= 300:
                        piece = text[max(0, start - 24) : end + 8]
                        at = min(start, 24)
                        labelled = any(s.start >= at and s.end <= at + end - start for s in base_spans(piece))
                        rows.append((h, start, at, end - start, piece, labelled))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()))], ["h", "start", "at", "size", "piece", "labelled"])

    rows = hashed.mapInArrow(found, "h long, start long, at long, size long, piece string, labelled boolean")
    half = [rows.where(F.col("labelled") == flag).orderBy("h", "start").limit(fit_regions // 2).collect() for flag in (True, False)]
    examples = [e for r in sorted(half[0] + half[1], key=lambda r: (r["h"], r["start"])) for e in examples_of(r["piece"], r["at"], r["at"] + r["size"])]
    return Field().fit(examples)


def spans_of(text: str, field: Field) -> list[tuple[Span, bool]]:
    """(span, whether the field added it), by kind, then start."""
    base = base_spans(text)
    out = [(s, False) for s in base]
    taken = sorted((s.start, s.end) for s in base)
    reach, ends = 0, []
    for _, end in taken:
        reach = max(reach, end)
        ends.append(reach)
    for start, end in regions(text):
        for s in field.decode(Region(text, start, end)):
            k = bisect_left(taken, (s.end,))
            if not k or ends[k - 1] <= s.start:
                out.append((s, True))
    return sorted(out, key=lambda x: (KINDS.index(x[0].kind), x[0].start))


def personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **fit: int) -> DataFrame:
    """`doc_id, spans`: array of (kind, start, end, added) in code points, by kind as listed, then start."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(dict(trained(rows, **fit).weights))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(shared.value)
        for batch in batches:
            found = [[{"kind": s.kind, "start": s.start, "end": s.end, "added": added} for s, added in spans_of(text.decode(), field)] for text in utf8(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "spans"])

    return rows.mapInArrow(each, f"doc_id {dict(rows.dtypes)['doc_id']}, spans array<struct<kind:string,start:long,end:long,added:boolean>>")


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts and hash of the fixed patterns' spans, and all spans as text."""
    base = F.filter("spans", lambda s: ~s["added"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
