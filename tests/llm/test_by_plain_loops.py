"""Parts of the training-data operators against plain loops, on small fixtures."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from quayside.llm import decontamination, language_id, packing, quality, url_filters, warc_zip

RND = random.Random(5)


# --- 2: url filters


def loop_rule(host, path, rules):
    fits = []
    for rule, verdict in rules:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), h, "/" + p, verdict == "allow", rule, verdict))
    return max(fits)[4:] if fits else (None, "allow")


def test_many_rules_are_joined_and_ties_are_settled(spark):
    names = ["a", "b", "co", "x"]
    rules = list({(".".join(RND.choices(names, k=RND.randrange(1, 4))) + "/" + "".join(RND.choices("pq/", k=RND.randrange(0, 3))), RND.choice(["allow", "block"])) for _ in range(400)})
    assert len(rules) > url_filters.FEW_RULES
    # Ties: one rule with both verdicts, and two equally long rules for one page.
    rules += [("q.a.b/xy", "allow"), ("q.a.b/xy", "block"), ("a.b/xyzz", "block")]
    rows = [(k, "http://" + ".".join(RND.choices(names + ["q"], k=RND.randrange(1, 5))) + "/" + "".join(RND.choices("pq/", k=RND.randrange(0, 5))), None, "x", "y", "z") for k in range(500)]
    rows += [(900, "http://q.a.b/xyzz", None, "x", "y", "z"), (None, None, None, "x", "y", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, rule string, node string")
    for some in (rules, rules[-60:]):
        got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filters.judge(pages, some).collect()}
        for i, url, *_ in rows:
            host, path = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url).groups() if url else ("", "")
            assert got[i] == loop_rule(host, path, some)


def test_references_in_links(spark):
    pages = spark.createDataFrame([("http://a.test/p", '<link rel="canonical" href="/q?x=1&amp;y=2">')], "url string, html string")
    assert [r["b"] for r in url_filters.alias_edges(pages).collect()] == ["a.test/q?x=1&y=2"]


def test_judging_an_empty_table(spark):
    assert url_filters.judge(spark.createDataFrame([], "page_id long, url string, html string"), [("net/", "block")]).count() == 0


# --- 3: packing


@pytest.mark.parametrize("seed", range(3))
def test_the_lower_bound_is_one(seed):
    """No packing has fewer sequences than the bound: compared with the best of all packings of a few pieces."""
    rng = random.Random(seed)
    lengths = [rng.randrange(3, 17) for _ in range(9)]

    def fewest(left, bins):
        if not left:
            return len(bins)
        best = len(bins) + len(left)
        for k in range(len(bins) + 1):
            room = bins[k] if k < len(bins) else 16
            if room >= left[0]:
                best = min(best, fewest(left[1:], bins[:k] + [room - left[0]] + bins[k + 1 :]))
        return best

    made = packing.planned(dict(Counter(lengths)), 16)
    least = fewest(sorted(lengths, reverse=True), [])
    assert math.ceil(sum(lengths) / 16) <= made.lower_bound <= least <= made.sequences <= least + 1


# --- 4: decontamination


def test_blocks_of_windows_give_what_one_block_gives(spark):
    words = [f"w{k}" for k in range(30)]
    items = [(k, " ".join(RND.choices(words, k=RND.randrange(1, 14)))) for k in range(40)]
    docs = [(k % 7 or None, " ".join(RND.choices(words, k=60)) + " " + RND.choice(items)[1], "c") for k in range(60)] + [(1, None, "c"), (2, "", "c")]
    rows = spark.createDataFrame(docs, "doc_id long, text string, spans string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one, many = (Counter(map(tuple, decontamination.contamination(rows, bench, width=3, block_windows=n).collect())) for n in (100_000, 37))
    assert one == many and sum(r[2] > 0 for r in one) > 30
    kept = [sorted(map(str, decontamination.drop_contaminated(rows, bench, width=5, block_windows=n).collect())) for n in (100_000, 37)]
    assert kept[0] == kept[1]


# --- 8: languages


def loop_predict(text, model, penalty):
    """A language per word by the best of all paths, word after word; then the language of most letters."""
    words, scores, letters = text.split(), [], []
    for word in words:
        number, bucket, found = language_id.trigrams([word])
        own = [sum(float(model.logs[b, k]) for b in bucket) for k in range(len(model.languages))]
        if found.sum():
            allowed = model.allowed[int(found[0].argmax())]
            own = [s if a else s - 50 for s, a in zip(own, allowed)]
        scores.append(own), letters.append(int(found.sum()))
    if not sum(letters):
        return "und", 0.0
    paths = [(s, [k]) for k, s in enumerate(scores[0])]
    for own in scores[1:]:
        best = max(range(len(paths)), key=lambda k: paths[k][0])
        paths = [max((paths[k], (paths[best][0] - penalty, paths[best][1])), key=lambda p: p[0]) for k in range(len(paths))]
        paths = [(value + own[k], path + [k]) for k, (value, path) in enumerate(paths)]
    path = max(paths, key=lambda p: p[0])[1]
    counts = [sum(n for k, n in zip(path, letters) if k == lang) for lang in range(len(model.languages))]
    return model.languages[counts.index(max(counts))], max(counts) / sum(counts)


def test_predictions_against_loops(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language_id.model_of(docs)
    rows = [(k, (r["text"] or "")[:600]) for k, r in enumerate(docs.limit(60).collect())]
    rows += [(100, "слово и words the of 中文 это mixed"), (101, "123 !!"), (102, "Ünïcödé the of and der die das " * 5)]
    got = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    for r, (_, text) in zip(sorted(got, key=lambda r: r["doc_id"]), rows):
        lang, score = loop_predict(text, model, 12.0)
        assert r["lang_pred"] == lang and r["score"] == pytest.approx(score, abs=1e-6)


def test_counts_against_loops(spark):
    rows = [("aa bb aa", "x"), ("cc", "y"), (None, "x"), ("dd", None)]
    got = {(r["lang"], r["kind"], r["slot"]): r["n"] for r in language_id.counts_of(spark.createDataFrame(rows[:2], "text string, lang string")).collect()}
    expected = Counter()
    for text, lang in rows[:2]:
        for word in text.split():
            for bucket in language_id.trigrams([word])[1]:
                expected[lang, "t", int(bucket)] += 1
            expected[lang, "s", language_id.SCRIPT_NAMES.index("latin")] += len(word)
    assert got == expected


def test_languages_of_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    none = docs.limit(0)
    assert language_id.identify(none, language_id.model_of(none)).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(docs, language_id.model_of(none)).collect()} == {"und"}
    assert language_id.known_language_only(none, language_id.model_of(docs)).columns == docs.columns


# --- 9: web archives


def test_archives_with_many_shared_digests(spark, sf):
    """Where the shared digests are too many to broadcast, large payloads are shuffled; the records are the same."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    pages = pages.unionByName(pages.selectExpr("page_id + 100000 AS page_id", "url", "html"))
    rows = pages.select("page_id", "url", "html")
    some, none = (Counter(tuple(r) for r in warc_zip.decisions(rows, 1000, most).collect()) for most in (10**6, 0))
    assert some == none and any(r[-1] is not None for r in some)


def test_archives_ignore_clashing_columns(spark):
    rows = [(1, "http://a/", "x" * 2000, "f", "n"), (2, None, "x" * 2000, "f", "n"), (2, None, "x" * 2000, "f", "n"), (3, "u", None, "f", "n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, first string, payload_digest string")
    got = Counter(tuple(r) for r in warc_zip.archived(pages).collect())
    digest = hashlib.sha1(b"x" * 2000).hexdigest()
    assert got == Counter([(1, 2000, digest, "revisit", 2), (2, 2000, digest, "response", None), (2, 2000, digest, "response", None), (3, 0, hashlib.sha1(b"").hexdigest(), "response", None)])


# --- 10: quality


def loop_classify(texts, fit_rows):
    """Votes, estimation, fitting and scores with dictionaries and loops."""
    own = [quality.votes(t.encode()) for t in texts]
    counts = Counter(map(tuple, own))
    patterns = sorted(counts, key=quality.pattern_of)
    p = {v: (sum(x == quality.GOOD for x in v) + 1) / (sum(x < quality.NONE for x in v) + 2) if any(x < quality.NONE for x in v) else 0.5 for v in patterns}
    for _ in range(100):
        prior = sum(counts[v] * p[v] for v in patterns) / sum(counts.values())
        logs = {}
        for good in (True, False):
            table = [{x: 1.0 for x in (0, 1, 2)} for _ in quality.LABELLERS]
            for v in patterns:
                for k, x in enumerate(v):
                    if x != quality.UNABLE:
                        table[k][x] += counts[v] * (p[v] if good else 1 - p[v])
            for v in patterns:
                logs[v, good] = sum(math.log(table[k][x] / sum(table[k].values())) for k, x in enumerate(v) if x != quality.UNABLE) + math.log(max(prior if good else 1 - prior, 1e-9))
        new = {v: 1 / (1 + math.exp(max(-50, min(50, logs[v, False] - logs[v, True])))) for v in patterns}
        moved = max(abs(new[v] - p[v]) for v in patterns)
        if moved < 1e-9:
            break
        p = new
    slots = quality.Slots()

    def feature(text):
        words = text.encode().split()
        n = Counter()
        for k, w in enumerate(words):
            n.update(slots[w])
            n[int(k > 0 and slots[w][0] == slots[words[k - 1]][0])] += 1
        return {s: float(np.float32(math.sqrt(c / len(words)))) for s, c in n.items()}

    every = [(quality.pattern_of(v), feature(t)) for v, t in zip(own, texts)]
    sample = sorted((code, tuple(sorted(f)), tuple(f[k] for k in sorted(f))) for code, f in every)
    target = {quality.pattern_of(v): p[v] for v in patterns}
    w, offset, order = Counter(), 0.0, np.random.default_rng(7)
    for epoch in range(12):
        step = 2.0 / (1 + epoch)
        for i in order.permutation(len(sample)):
            code, at, value = sample[i]
            score = 1 / (1 + math.exp(-max(-30, min(30, sum(w[k] * x for k, x in zip(at, value)) + offset))))
            for k, x in zip(at, value):
                w[k] -= step * ((score - target[code]) * x + 1e-6 * w[k])
            offset -= 0.1 * step * (score - target[code])
    return [(target[code], 1 / (1 + math.exp(-max(-30, min(30, sum(w[k] * x for k, x in f.items()) + offset)))) if f else 0.0) for code, f in every]


def test_classifier_against_loops(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(k, (r["text"] or "")[:1500]) for k, r in enumerate(docs.limit(80).collect())] + [(100, ""), (101, "x")]
    got = {r["doc_id"]: r for r in quality.classify(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for (i, _), (weak, score) in zip(rows, loop_classify([t for _, t in rows], 4000)):
        assert got[i]["weak_label"] == pytest.approx(weak, abs=1e-6) and got[i]["score"] == pytest.approx(score, abs=1e-3)


def test_the_sample_has_a_bound(spark):
    """Also where one row is most of the table."""
    rows = spark.createDataFrame([(1, "the same words again and again here now")] * 300 + [(k, f"other words {k}") for k in range(200)], "doc_id long, text string")
    by_pattern, total = quality.posteriors(rows)
    sample, targets = quality.sampled(rows, by_pattern, total, 50)
    assert total == 500 and len(sample) == len(targets) <= 50
