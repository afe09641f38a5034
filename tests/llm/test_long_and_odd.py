"""Control characters, very long texts and other cases that the tables at hand don't hold."""

import base64
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quayside.llm import secret_scan, token_counts
from quayside.llm.queries import tokenizer_path

RND = random.Random(11)


def test_token_counts_of_all_ascii_characters(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    letters = [chr(k) for k in range(128)] + list("éßİ́\u0085xS' ")
    texts = [f"x{chr(k)} y{chr(k)}" for k in range(128)] + ["".join(RND.choice(letters) for _ in range(RND.randrange(1, 14))) for _ in range(3000)] + ["<|endoftext|", "a" * 300_000]
    got = token_counts.count_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path)
    assert {r["doc_id"]: r["n_tokens"] for r in got.collect()} == {i: len(tok.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_token_counts_refuse_other_files():
    with pytest.raises(ValueError):
        token_counts.checked(tokenizer_path("byte_bpe_50k.json"))


def brute_entropy_spans(text, taken, window=20):
    """Plain loops: runs beside the taken spans, windows by counting anew, words of examples by place."""
    import math
    import re

    free, at = [], 0
    for s, e in sorted(taken):
        free.append((at, s))
        at = max(at, e)
    free.append((at, len(text)))
    out = []

    def high(value):
        limit = 3.1 if re.fullmatch("[0-9a-fA-F]+", value) else 3.6 if value.upper() == value or value.lower() == value else 3.9
        good = re.search("[0-9]", value) and re.search("[A-Za-z]", value) and not re.search(secret_scan.ALLOWED, value)
        sums = [sum(c * math.log2(c) for c in Counter(value[k : k + window]).values()) for k in range(len(value) - window + 1)]
        return bool(good) and bool(sums) and math.log2(window) - min(sums) / window >= limit - 1e-9

    for first, last in free:
        for m in re.finditer(rf"[A-Za-z0-9+/_=-]{{{window},}}", text[first:last] if last - first >= window else ""):
            words = [(w.start(), w.end()) for w in re.finditer(secret_scan.EXAMPLE, m[0])]
            cuts = [0, *[x for w in words for x in w], len(m[0])]
            whole = re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]) and not re.search(secret_scan.ALLOWED, m[0])
            if whole and any(high(m[0][a:b]) for a, b in zip(cuts[::2], cuts[1::2])):
                out.append((first + m.start(), first + m.end()))
    return out


def some_text(n):
    kinds = [lambda: base64.b64encode(RND.randbytes(RND.randrange(6, 60))).decode(), lambda: RND.randbytes(RND.randrange(4, 40)).hex(), lambda: "é words", lambda: f"password={RND.randbytes(6).hex()}", lambda: "AKIA" + "".join(RND.choices("ABC123", k=RND.randrange(8, 20))), lambda: "my-example-key/", lambda: "a1" * 30]
    return "".join(RND.choice(kinds)() + RND.choice(["", " ", "/", "\n"]) for _ in range(n))


def test_entropy_spans_against_plain_loops(spark):
    texts = [some_text(RND.randrange(1, 40)) for _ in range(150)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secret_scan.scan(rows).collect():
        taken = [(m["start"], m["end"]) for kind in secret_scan.BASE_KINDS for m in r[kind]]
        assert [(m["start"], m["end"]) for m in r["entropy"]] == brute_entropy_spans(r["text"], taken)
        assert all(r["text"][m["start"] : m["end"]].endswith(m["value"]) for kind in secret_scan.KINDS for m in r[kind])


def test_redaction_against_plain_loops(spark):
    texts = [some_text(RND.randrange(1, 30)) for _ in range(60)]
    # Columns with the names of spans stay as they are.
    rows = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in enumerate(texts)], "doc_id long, text string, assign string, entropy string, _span_hex string")
    spans = {r["doc_id"]: sorted((m["start"], m["end"]) for kind in secret_scan.KINDS for m in r[kind]) for r in secret_scan.scan(rows).collect()}
    for r in secret_scan.redacted(rows).collect():
        text, out, at = texts[r["doc_id"]], "", 0
        for s, e in spans[r["doc_id"]]:
            if s >= at:
                out += text[at:s] + "[secret]"
            at = max(at, e)
        assert r["text"] == out + text[at:] and (r["assign"], r["entropy"], r["_span_hex"]) == ("a", "b", "c")


def test_secrets_of_a_long_run_and_of_many_matches(spark):
    """Half a million characters of base64, and 20,000 matches: time follows the text, and every place is right."""
    long = base64.b64encode(RND.randbytes(375_000)).decode()
    many = "é password=abcdefgh " * 20_000
    rows = spark.createDataFrame([(1, long), (2, many)], "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in secret_scan.secrets(rows).collect()}
    assert got[1] == f"entropy:0:{len(long.rstrip('='))}" or got[1] == f"entropy:0:{len(long)}"
    assert got[2] == ",".join(f"assign:{20 * k + 2}:{20 * k + 19}" for k in range(20_000))
    masked = {r["doc_id"]: r["text"] for r in secret_scan.redacted(rows).collect()}
    assert masked[1] == "[secret]" and masked[2] == "é [secret] " * 20_000


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 9, 100])
def test_running_results_by_doubling(spark, n):
    import itertools

    values = [RND.randrange(-9, 9) for _ in range(n)]
    row = spark.createDataFrame([(values,)], "v array<int>").select(secret_scan.scanned(F.col("v"), lambda a, b: a + b).alias("sums"), secret_scan.scanned(F.col("v"), lambda a, b: F.greatest(a, b)).alias("most")).first()
    assert row["sums"] == list(itertools.accumulate(values)) and row["most"] == list(itertools.accumulate(values, max))


# --- media


def known_alpha(path):
    """The alpha plane of an 8-bit palette, grey-alpha or RGBA picture file, by plain loops over its filtered rows."""
    import zlib

    data, at, packed, table = path.read_bytes(), 8, b"", b""
    while at < len(data):
        n, kind = int.from_bytes(data[at : at + 4], "big"), data[at + 4 : at + 8]
        body = data[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            width, height, depth, colour = int.from_bytes(body[:4], "big"), int.from_bytes(body[4:8], "big"), body[8], body[9]
        packed += body if kind == b"IDAT" else b""
        table = body if kind == b"tRNS" else table
        at += 12 + n
    channels = {3: 1, 4: 2, 6: 4}[colour]
    size = max(1, channels * depth // 8)
    raw, row, rows = zlib.decompress(packed), bytes((width * channels * depth + 7) // 8), []
    for y in range(height):
        way, line = raw[y * (len(row) + 1)], bytearray(raw[y * (len(row) + 1) + 1 : (y + 1) * (len(row) + 1)])
        for x in range(len(line)):
            a, b, c = line[x - size] if x >= size else 0, row[x], row[x - size] if x >= size else 0
            p = a + b - c
            paeth = min((a, b, c), key=lambda v: abs(p - v))
            line[x] = (line[x] + [0, a, b, (a + b) // 2, paeth][way]) & 255
        row = bytes(line)
        values = [row[x * depth // 8] >> 8 - depth - x * depth % 8 & (1 << depth) - 1 for x in range(width * channels)] if depth < 8 else list(row)
        rows.append([table[v] if v < len(table) else 255 for v in values] if colour == 3 else values[channels - 1 :: channels])
    return rows


def test_a_picture_made_elsewhere():
    """The standard library's sample files: one picture, whose alpha plane one of them holds as a lossless stream."""
    import pathlib
    import test

    from quayside.llm import webp

    folders = [f for f in (pathlib.Path(test.__file__).parent / "test_email" / "data", pathlib.Path(test.__file__).parent / "imghdrdata") if (f / "python.webp").exists()]
    if not folders:
        pytest.skip("this Python comes without its test files")
    data = (folders[0] / "python.webp").read_bytes()
    at = data.index(b"ALPH")
    chunk = data[at + 8 : at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")]
    assert chunk[0] & 15 == 1  # lossless, without a filter
    head = 0x2F | 15 << 8 | 15 << 22
    picture = webp.decode_stream(head.to_bytes(5, "little") + chunk[1:])
    assert picture[:, :, 2].tolist() == known_alpha(folders[0] / "python.png")


@pytest.mark.parametrize("seed", range(12))
def test_batches_of_pictures(seed):
    """What a batch stores, either decoder reads; what the other encoder stores, the batch reads."""
    import numpy as np

    from quayside.llm import webp, webp_batch

    rng = np.random.default_rng(seed)
    pictures = []
    for k in range(40):
        h, w = rng.integers(1, 22), rng.choice([1, 2, 7, 40, 192])
        made = rng.integers(0, rng.choice([2, 3, 17, 60, 256]), (h, w, 3))
        if k % 5 == 1:
            made = np.cumsum(made % 3, axis=k % 2)  # smooth: predictors
        elif k % 5 == 2:
            made[:, :, 0], made[:, :, 2] = made[:, :, 1] // 2, made[:, :, 1] * 3  # cross-colour
        elif k % 5 == 3:
            made = np.tile(made[:1, : max(1, w // 3)], (h, 4, 1))[:, :w]  # repeats
        pictures.append((made % 256).astype(np.uint8))
    files = webp_batch.encode_many(pictures)
    for read in (webp_batch.decode_many([webp.streams(f)[0] for f in files]), [webp.decode(f)[0] for f in files]):
        assert all((r[:, :, 1:] == p).all() and (r[:, :, 0] == 255).all() for r, p in zip(read, pictures))
    others = [np.concatenate([np.full((*p.shape[:2], 1), 255 if k % 7 else k, np.uint8), p], 2) for k, p in enumerate(pictures)]
    options = [{"predictor": int(k % 14), "cache_bits": k % 12} if k % 3 == 0 else {"references": True, "cache_bits": k % 11, "subtract_green": k % 2 == 1} if k % 3 == 1 else {"cross_colour": (3, -100, 77)} for k in range(40)]
    read = webp_batch.decode_many([webp.streams(webp.encode(p, **o))[0] for p, o in zip(others, options)])
    assert all((r == p).all() for r, p in zip(read, others))


def test_the_stored_pictures_use_the_whole_method():
    """Of texts: prefix codes of several lengths, references, caches, and transforms where they pay."""
    import numpy as np

    from quayside.llm import media, webp, webp_batch

    texts = [some_text(60).encode() for _ in range(60)] + [b"", b"a short one", b"same line again, and more of it\n" * 300, bytes(range(128)) * 40, b"".join(bytes([k % 97 + 30] * 3) for k in range(4000))]
    stored = media.to_media([media.padded(t) for t in texts])
    assert [p.tobytes() for p in media.from_media(stored)] == [media.padded(t) for t in texts]
    parsed = [webp_batch.Parsed(s) for m in stored for s in webp.streams(m)]
    assert sum(len(set(p.lengths[0]) - {0}) > 2 for p in parsed) > 60
    assert any(p.cache_bits for p in parsed) and any(max(p.lengths[4]) > 0 for p in parsed)
    assert {kind for p in parsed for kind, *_ in p.undo} >= {webp.PREDICTOR, webp.COLOUR_INDEXING}


def test_batches_refuse_damage():
    import numpy as np

    from quayside.llm import webp, webp_batch

    (file,) = webp_batch.encode_many([np.random.default_rng(1).integers(0, 255, (9, 40, 3)).astype(np.uint8)])
    (stream,) = webp.streams(file)
    for cut in (11, 40, len(stream) // 2, len(stream) - 3):
        with pytest.raises(Exception):
            webp_batch.decode_many([stream[:cut]])


@pytest.mark.parametrize("seed", range(4))
def test_huffman_lengths_are_the_best(seed):
    """Against merging by a heap, wherever that needs no more bits a code than allowed."""
    import numpy as np

    from quayside.llm import webp, webp_batch

    rng = np.random.default_rng(seed)
    counts = (rng.integers(0, rng.choice([2, 9, 200], (60, 1)), (60, 50)) * (rng.random((60, 50)) < rng.random((60, 1)))).astype(np.int64)
    counts[0], counts[1, 1:] = 0, 0
    for own, lengths in zip(counts, webp_batch.huffman_lengths(counts)):
        best = webp.code_lengths(own, 15)
        assert lengths.max() <= webp_batch.MOST_BITS and ((lengths > 0) == (own > 0)).all()
        if best.max() <= webp_batch.MOST_BITS:
            assert (own * lengths).sum() == (own * best).sum()
