"""Conversation repair, spelling variants and personal data against brute force, on the driver's tables and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quayside.llm import alternation, conversations, personal_data, queries, spelling

# --- 11: conversations

BLANK = " \t\n\x0b\x0c\r"


def brute_conversation(rows):
    """Everything the contract asks of one conversation's rows (turn, role, text) after the damage, in order."""
    turns = [t for t, _, _ in rows if t is not None]
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(BLANK)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if text.rstrip(BLANK)[-1] not in ".!?" else "")
        seen.add((role, text))
    # Cheapest (cost, audit, roles and texts) per state, forwards: what was put out last.
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(best):
        best = dict(best)
        for _ in range(2):
            for state, (cost, audit, out) in list(best.items()):
                n = after[state]
                found = (cost + 3, audit + "I", [*out, (names[n], "")])
                best[n] = min(best.get(n, found), found, key=lambda x: x[:2])
        return best

    best = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults):
        step = defaultdict(list)
        for state, (cost, audit, out) in inserted(best).items():
            step[state].append((cost + 4, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            if state == "" and role[:1] == "s":
                step["s"].append((cost + more, audit + "K", [*out, (role, text)]))
            n = after[state]
            if role[:1] == n:
                step[n].append((cost + more, audit + "K", [*out, (role, text)]))
            else:
                step[n].append((cost + more + 3, audit + "R", [*out, (names[n], text)]))
        best = {state: min(found, key=lambda x: x[:2]) for state, found in step.items()}
    cost, audit, out = min((v for state, v in inserted(best).items() if state in ("", "a")), key=lambda x: x[:2])
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (_, a, _), (_, b, _) in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = Counter(faults)
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


def damaged(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        own = by[conv]
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest())) for c, own in by.items()}


def repaired(df, **options):
    return {r["conv_id"]: tuple(r)[1:] for r in conversations.repair(df, **options).collect()}


def test_repair_against_brute_force(spark, sf):
    table = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    expected = {c: brute_conversation(own) for c, own in damaged(rows).items()}
    assert {r["conv_id"]: tuple(r[k] for k in r.asDict() if k != "conv_id") for r in queries.op11_conversation_repair(spark, sf).collect()} == expected
    assert repaired(table, piece=1) == expected


def test_repair_of_odd_rows(spark):
    """Nulls everywhere, odd roles, equal turns and rows, a long conversation in pieces, a very long text, columns of clashing names."""
    rnd = random.Random(3)
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (1, None, "system", "Be kind."), (1, 4, "tool", "x"), (1, 4, "tool", "x"), (1, 4, "assistant", "y."), (1, 2**40, "", "z!"), (2, 0, "user", " \t\n"), (3, None, None, None), (4, 0, "assistant", "word " * 200_000 + ".")]
    rows += [(5, k // 2, rnd.choice(["user", "assistant", "system", "uncle", "x"]), rnd.choice(["yes.", "no", "a?", "", "b" + str(k) + "."])) for k in range(700)]
    schema = "conv_id long, turn long, role string, text string, piece int, seq int, digest string, seen string"
    df = spark.createDataFrame([(*r, 1, 2, "d", "s") for r in rows], schema)
    expected = {c: brute_conversation(own) for c, own in damaged(rows).items()}
    for piece in (4096, 100, 7):
        assert repaired(df, piece=piece) == expected
    assert conversations.repair(df.limit(0)).count() == 0


def test_dropped_conversations_are_returned(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = repaired(spark.createDataFrame([(conv, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string"))
    assert got == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_runs_in_blocks_are_the_whole_run():
    rnd = random.Random(5)
    for _ in range(60):
        codes = [rnd.choice([0, 1, 1, 2, 2, 3]) + 4 * (rnd.random() < 0.2) + 8 * (rnd.random() < 0.1) for _ in range(rnd.randrange(65, 200))]
        cut = rnd.randrange(1, len(codes))
        ((whole, end),) = alternation.run_audit(codes, (0,), alternation.END_COSTS)
        costs = alternation.run_costs(codes[cut:])
        rest = [min(c + e for c, e in zip(row, alternation.END_COSTS)) for row in costs]
        ((first, state),) = alternation.run_audit(codes[:cut], (0,), rest)
        second, last = alternation.run_audit(codes[cut:], (0, 1, 2, 3), alternation.END_COSTS)[state]
        assert (first + second, last) == (whole, end)


# --- 12: spelling


def brute_variants(rows, every=199, least_length=6, least=5, ratio=5):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: k for w, k in counts.items() if len(w) >= least_length and k >= least}
    without = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            without[w[:i] + w[i + 1 :]].add((i, w))
    near = defaultdict(set)
    for w in n:
        near[w] |= {v for _, v in without.get(w, ())}
        for i in range(len(w)):
            rest = w[:i] + w[i + 1 :]
            near[w] |= {v for j, v in without[rest] if j == i} | ({rest} & n.keys())
        near[w].discard(w)
    form = {w: min(near[w], key=lambda v: (-n[v], v)) for w in n if near[w]}
    form = {w: v for w, v in form.items() if n[v] >= ratio * n[w]}
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (n[w], len(near[w]), form.get(w), n.get(form.get(w)), root)
    return out


def variants(df, **options):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in spelling.variants(df, **options).collect()}


def test_variants_against_brute_force(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in queries.op12_spelling_variants(spark, sf).collect()}
    assert got == brute_variants(rows) and any(v[2] for v in got.values())


def test_variants_of_dense_and_long_words(spark):
    """Words of two letters are near in many ways at once; very long ones differ at either end or in the middle."""
    rnd = random.Random(11)
    words = {"".join(rnd.choice("ab") for _ in range(rnd.randrange(1, 9))) for _ in range(300)}
    long = "".join(rnd.choice("abcdefgh") for _ in range(30_000))
    words |= {long, long[:-1], long[1:], long[:15_000] + "z" + long[15_001:], "\u00e9" + long, long[:20_000] + long[20_001:]}
    rows = [(k, " ".join([w] * rnd.choice([1, 2, 9, 60]))) for k, w in enumerate(sorted(words))] + [(None, None), (None, "ab ab"), (7, ""), (7, "Abab ABAB abab"), (7, "Abab ABAB abab")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    options = {"every": 7, "least_length": 2, "least": 2}
    assert variants(df, **options) == brute_variants(rows, **options)
    assert variants(df.limit(0)) == {}


# --- 13: personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            fits = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False, "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}
            if fits[kind]:
                out.append((kind, *m.span()))
    return out


def check_personal(df, rows):
    by = defaultdict(list)
    for doc, text in df:
        by[doc].append(brute_spans(text or ""))
    seen = Counter()
    for r in rows:
        spans = [tuple(s.split(":")) for s in r["spans"].split(",") if s]
        matched = [b for b in by[r["doc_id"]] if hashlib.sha256(",".join(f"{k}:{a}:{e}" for k, a, e in b).encode()).hexdigest() == r["base_sha256"]]
        assert matched
        base = matched[0]
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in base) for k in PATTERNS]
        assert {(k, str(a), str(e)) for k, a, e in base} <= set(spans)
        assert spans == sorted(spans, key=lambda s: (list(PATTERNS).index(s[0]), int(s[1])))
        added = [(k, int(a), int(e)) for k, a, e in spans if (k, int(a), int(e)) not in base]
        assert all(e <= a2 or a >= e2 for _, a, e in added for _, a2, e2 in base)
        seen.update(k for k, *_ in added)
    return seen


def test_personal_data_against_the_patterns(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.op13_personal_data(spark, sf).collect()
    assert len(got) == len(rows)
    assert sum(check_personal(rows, got).values()) <= 0.1 * sum(r[f"n_{k}"] for r in got for k in PATTERNS)


ODD = [
    (1, None), (2, ""), (3, "a@b.c@d.e +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 1.2.3.4.5.6.7.8 999.1.1.1 0001.02.3.4"), (4, "1" * 5000 + " 4111 1111 1111 1111 4111-1111-1111-1112"), (5, "x" * 3000 + "@" + "y" * 3000),
    (6, "+" * 3000 + "1 " * 3000), (7, "caf\u00e9 @ \u00e9a@b.c \u0661\u0662 +\u0661 +49 (30) 1234-5678 😀 8.8.8.8"), (7, "a@b.c"), (7, "a@b.c"), (None, "a@b.c"), (8, "1.1.1." * 3000),
]


def test_personal_data_of_odd_rows(spark, sf):
    df = spark.createDataFrame([(*r, "x", 1) for r in ODD], "doc_id long, text string, spans string, kind int")
    got = personal_data.digest(personal_data.personal_data(df)).collect()
    assert len(got) == len(ODD)
    check_personal(ODD, got)
    assert personal_data.personal_data(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def field(spark):
    return personal_data.trained(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"))


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ("call (743) 555-3824 now", [("phone", "(743) 555-3824")]), ("jane.doe (at) mail5 (dot) example (dot) com wrote", [("email", "jane.doe (at) mail5 (dot) example (dot) com")]), ("at 10[.]20[.]30[.]40 and", [("ip", "10[.]20[.]30[.]40")]),
        ("pay 4111.1111.1111.1111 today", [("card", "4111.1111.1111.1111")]), ("pay 4111.1111.1111.1112 today", []), ("on 2024-01-31 10:22 for 12345678 pieces", []), ("numbers 1 2 3 4 5 6 7 8 9 10", []), ("", []),
    ],
)
def test_the_field_adds_respelled_data(field, text, spans):
    assert [(s.kind, text[s.start : s.end]) for s, added in personal_data.spans_of(text, field) if added] == spans


def test_decoding_finds_the_best_labelling():
    """The dynamic programme against all labellings of a small region."""
    rnd = random.Random(2)
    text = "+1 20 (30) 4567-8901 2 3"
    region = personal_data.Region(text, 0, len(text))
    starting = defaultdict(list)
    for segments in region.ending:
        for s in segments:
            starting[s.first].append(s)
    for _ in range(20):
        weights = {f: rnd.gauss(0, 1) for segments in region.ending for s in segments for f in s.features}
        kinds = [personal_data.NO_LABEL, *personal_data.KINDS]
        weights |= {f"{a} > {b}": rnd.gauss(0, 1) for a in kinds for b in kinds}
        field = personal_data.Field(weights)

        def best(at, before):
            if at == len(region.tokens):
                return 0.0, []
            found = []
            for s in starting[at]:
                score, rest = best(s.last, s.kind)
                own = sum(weights[f] for f in s.features) + weights[f"{before} > {s.kind}"]
                found.append((own + score, [(s.kind, region.starts[s.first], region.starts[s.last])] * (s.kind != personal_data.NO_LABEL) + rest))
            return max(found, key=lambda x: x[0])

        assert [tuple(s) for s in field.decode(region)] == best(0, personal_data.NO_LABEL)[1]


def test_the_gradient_is_that_of_the_likelihood():
    text = "+1 20 (30) 4567-8901 2"
    region = personal_data.Region(text, 0, len(text))
    gold = {(s.first, s.last, s.kind) for s in region.ending[-1] if s.kind == "phone" and s.first == 0}
    field = personal_data.Field({f: 0.1 * k for k, f in enumerate(sorted({f for e in region.ending for s in e for f in s.features}))})

    def likelihood():
        ahead = field._sums(region)[1]
        gold_score = sum(field._score(s) for s in region.ending[-1] if (s.first, s.last, s.kind) in gold) + field.weights.get("none > phone", 0.0)
        import math

        return gold_score - math.log(sum(math.exp(v) for v in ahead[-1].values()))

    gradient = field.gradient(region, gold)
    for f in ["phone bias", "none > phone", "token digits", "phone digits 11"]:
        before, h = field.weights[f], 1e-5
        field.weights[f] = before + h
        up = likelihood()
        field.weights[f] = before - h
        down = likelihood()
        field.weights[f] = before
        assert gradient[f] == pytest.approx((up - down) / (2 * h), abs=1e-4)


def test_stages_let_columns_of_any_name_pass(spark):
    """Names that the operators use themselves, in the stages that return the columns of documents."""
    import corpus_pipeline

    names = ["_key", "_row", "_text", "_copy", "_times", "node", "shingle", "h", "spans", "_hit", "length"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 60").select("*", *[F.col("doc_id").alias(n) for n in names])
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        assert all(r[n] == r["doc_id"] for r in out.collect() for n in names), name
        assert stage(spark, empty, "/root/testdata/sf0.001").count() == 0
    assert corpus_pipeline.STAGES[4][1](spark, docs, "/root/testdata/sf0.001").count() >= docs.count()
    assert corpus_pipeline.STAGES[4][1](spark, empty, "/root/testdata/sf0.001").count() == 0
