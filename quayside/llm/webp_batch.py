"""Many small lossless WebP pictures at once: each step of coding and decoding is done for all pictures of a batch by arrays.

The encoder chooses per picture among a palette (up to 16 colours), subtract-green, a predictor (left or top), cross-colour
factors by regression, and none, by the entropy of what each leaves; replaces repeated pixels by back-references and, where
it pays, by a colour cache; and stores Huffman-coded symbols. The decoder reads what is stored, as any reader must: it parses
each stream's head with `webp`, decodes one symbol of every picture per step by tables, resolves references and caches, and
undoes the transforms. Streams with an entropy image, with several alpha values or longer codes go through `webp` alone.
"""

from __future__ import annotations

import functools

import numpy as np

from . import webp
from .webp import CACHE_FACTOR, COLOUR_INDEXING, CROSS_COLOUR, PREDICTOR, SUBTRACT_GREEN

#: Pixels of a picture at most, so that one reference can span it, and bits of a code at most.
MOST_PIXELS, MOST_BITS = 4096, 10
#: Bits of the encoder's colour cache, and all symbols of the green alphabet with it.
CACHE_BITS = 6
LITERALS, LENGTHS, DISTANCES = 256, 24, 40
GREENS = LITERALS + LENGTHS + (1 << CACHE_BITS)
BLOCK = 9
REVERSED = sum(((np.arange(1 << MOST_BITS) >> k & 1) << MOST_BITS - 1 - k) for k in range(MOST_BITS))
#: c log2 c of all counts that a picture can have.
C_LOG_C = np.concatenate([[0.0], np.arange(1, MOST_PIXELS + 2) * np.log2(np.arange(1, MOST_PIXELS + 2))])


def _prefix_table(most: int) -> np.ndarray:
    """(symbol, further bits, their count) of every length or distance value up to `most`, by value."""
    value = np.arange(-1, most)
    value[:2] = 0
    top = np.floor(np.log2(np.maximum(value, 1))).astype(np.int64)
    large = value >= 4
    more = np.where(large, top - 1, 0)
    symbol = np.where(large, 2 * top + (value >> np.maximum(top - 1, 0) & 1), value)
    return np.stack([symbol, np.where(large, value & (1 << more) - 1, 0), more])


PREFIXES = _prefix_table(MOST_PIXELS + len(webp.NEIGHBOURS))
#: Of each length or distance symbol: its further bits, and the value of the symbol without them, from 1.
MORE_BITS = np.array([0] * 4 + [s - 2 >> 1 for s in range(4, DISTANCES)], np.int64)
FIRST_VALUE = np.array([1, 2, 3, 4] + [(2 + (s & 1) << (s - 2 >> 1)) + 1 for s in range(4, DISTANCES)], np.int64)


# --- what both need ---------------------------------------------------------------------------------------------------


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and symbols of all codes in the order of (row, code), and where each code starts in units of the longest code's."""
    order = np.where(lengths > 0, lengths, 255).astype(np.uint8).argsort(axis=1, kind="stable")
    sizes = np.take_along_axis(lengths, order, 1)
    row, k = np.nonzero(sizes)
    share = np.where(sizes > 0, 1 << np.maximum(MOST_BITS - sizes, 0), 0)
    first = np.cumsum(share, axis=1) - share
    return row, order[row, k], first[row, k]


def slots_of(argb: np.ndarray, bits) -> np.ndarray:
    """Places of colours in a cache."""
    return (argb.astype(np.uint32) * np.uint32(CACHE_FACTOR)) >> np.asarray(32 - bits, np.uint32)


# --- encoding ---------------------------------------------------------------------------------------------------------


def huffman_lengths(counts: np.ndarray) -> np.ndarray:
    """Code lengths of at most `MOST_BITS` bits for each row of counts; a row's only symbol has length 1."""
    counts = counts.astype(np.int64)
    out = np.zeros(counts.shape, np.int64)
    rows, floor = np.arange(len(counts)), 1
    while len(rows):
        own = np.where(counts[rows] > 0, np.maximum(counts[rows], floor), 0)
        out[rows] = _merged_lengths(own)
        rows = rows[out[rows].max(axis=1, initial=0) > MOST_BITS]
        floor *= 2
    return out


def _merged_lengths(counts: np.ndarray) -> np.ndarray:
    """Huffman's lengths by two queues, all rows in step: leaves in ascending order, and inner nodes in the order made."""
    rows, alphabet = counts.shape
    used = (counts > 0).sum(axis=1)
    width = int(used.max(initial=0))
    if width == 0:
        return np.zeros_like(counts)
    big = 1 << 40
    # Ascending, unused ones last.
    order = np.where(counts > 0, counts, big).argsort(axis=1)[:, : width + 1]
    order = np.pad(order, ((0, 0), (0, max(0, width + 1 - order.shape[1]))))
    leaves = np.take_along_axis(np.where(counts > 0, counts, big), order, 1)
    leaves[np.arange(leaves.shape[1])[None, :] >= used[:, None]] = big
    inner = np.full((rows, width + 1), big, np.int64)
    leaf_parent, inner_parent = np.zeros((rows, width + 1), np.int64), np.zeros((rows, width + 1), np.int64)
    by_used = np.argsort(-used, kind="stable")
    leaf_at, inner_at = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    descending = used[by_used]
    for k in range(width - 1):
        live = by_used[: int(np.searchsorted(-descending, -(k + 1), "left"))]
        total = np.zeros(len(live), np.int64)
        for _ in range(2):
            a, b = leaf_at[live], inner_at[live]
            leaf, node = leaves[live, a], inner[live, b]
            from_leaf = leaf <= node
            total += np.where(from_leaf, leaf, node)
            some, rest = live[from_leaf], live[~from_leaf]
            leaf_parent[some, a[from_leaf]] = k
            inner_parent[rest, b[~from_leaf]] = k
            leaf_at[some] += 1
            inner_at[rest] += 1
        inner[live, k] = total
    depth = np.zeros((rows, width + 1), np.int64)
    for k in range(width - 3, -1, -1):
        live = by_used[: int(np.searchsorted(-descending, -(k + 2), "left"))]
        depth[live, k] = depth[live, inner_parent[live, k]] + 1
    sizes = np.take_along_axis(depth, leaf_parent, 1) + 1
    sizes[np.arange(width + 1)[None, :] >= used[:, None]] = 0
    out = np.zeros((rows, alphabet), np.int64)
    row, k = np.nonzero(sizes)
    out[row, order[row, k]] = sizes[row, k]
    return out


def bits_of(counts: np.ndarray) -> np.ndarray:
    """Bits that an ideal code needs for each row of counts."""
    total = counts.sum(axis=1)
    return C_LOG_C[np.minimum(total, MOST_PIXELS)] - C_LOG_C[counts].sum(axis=1)


class Flat:
    """The pixels of main images one after the other, by channel."""

    def __init__(self, images: list[np.ndarray], widths: np.ndarray):
        self.n = np.array([len(i) for i in images])
        self.value = np.concatenate(images).astype(np.int32)
        self.picture = np.repeat(np.arange(len(images), dtype=np.int32), self.n)
        self.first = np.cumsum(self.n) - self.n
        self.own = np.arange(len(self.value), dtype=np.int32) - np.repeat(self.first, self.n).astype(np.int32)
        self.widths = widths

    def counts(self, channel: np.ndarray) -> np.ndarray:
        return np.bincount(self.picture << 8 | channel, minlength=len(self.n) << 8).reshape(-1, 256)

    def left(self, channel: np.ndarray) -> np.ndarray:
        """What is left of a channel after prediction from the left, in a first column from the top."""
        out = channel.copy()
        out[1:] -= channel[:-1]
        at = np.concatenate([np.arange(f, f + n, w) for f, n, w in zip(self.first.tolist(), self.n.tolist(), self.widths.tolist())])
        width = self.widths[self.picture[at]]
        out[at] = channel[at] - np.where(self.own[at] > 0, channel[at - width], 0).astype(np.uint8)
        return out

    def top(self, channel: np.ndarray) -> np.ndarray:
        """What is left of a channel after prediction from the top, in a first row from the left."""
        out = channel.copy()
        for w in np.unique(self.widths).tolist():
            out[w:] = np.where(self.widths[self.picture[w:]] == w, channel[w:] - channel[:-w], out[w:]) if len(np.unique(self.widths)) > 1 else channel[w:] - channel[:-w]
        size = np.minimum(self.widths, self.n)
        at = np.repeat(self.first - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        out[at] = channel[at] - np.where(self.own[at] > 0, channel[at - 1], 0).astype(np.uint8)
        return out


@functools.lru_cache(maxsize=1 << 12)
def _transform_head(kind: int, argb: tuple[int, int, int, int] | None) -> tuple[np.ndarray, np.ndarray]:
    """The bits that announce a transform, whose one block has the values `argb`."""
    out = webp.BitWriter()
    out.puts(np.array([1, kind]), np.array([1, 2]))
    if argb is not None:
        out.put(BLOCK - 2, 3)
        webp._write_image(out, np.array([argb], np.uint8), False)
    return np.concatenate(out.values), np.concatenate(out.sizes)


def transformed(flat: Flat, fixed: np.ndarray) -> tuple[list[np.ndarray], list[list[tuple[np.ndarray, np.ndarray]]], np.ndarray]:
    """(red, green, blue) of all pixels after the transform chosen for each picture, its bits, and the alpha value left.

    `fixed` pictures (palettes) keep their pixels.
    """
    red, green, blue = ((flat.value >> k).astype(np.uint8) for k in (16, 8, 0))
    g, r, b = (c.view(np.int8).astype(np.float64) for c in (green, red, blue))
    mean = np.add.reduceat(g, flat.first) / flat.n
    spread = np.maximum(np.add.reduceat(g * g, flat.first) - flat.n * mean * mean, 1)
    to_red, to_blue = (np.clip(np.rint(32 * (np.add.reduceat(g * c, flat.first) - mean * np.add.reduceat(c, flat.first)) / spread), -128, 127).astype(np.int16) for c in (r, b))
    part = green.view(np.int8).astype(np.int16)
    crossed = [(c - (np.repeat(to, flat.n) * part >> 5).astype(np.uint8)) for c, to in ((red, to_red), (blue, to_blue))]
    options = [(red, green, blue), (red - green, green, blue - green), tuple(map(flat.left, (red, green, blue))), tuple(map(flat.top, (red, green, blue))), (crossed[0], green, crossed[1])]
    heads = [0, 3, 110, 110, 130]
    known: dict[int, np.ndarray] = {}
    cost = np.stack([sum(known[id(c)] if id(c) in known else known.setdefault(id(c), bits_of(flat.counts(c))) for c in three) + head for three, head in zip(options, heads)])
    chosen = np.where(fixed, 0, cost.argmin(axis=0))
    out = [c.copy() for c in options[0]]
    for way in range(1, len(options)):
        if (chosen == way).any():
            here = np.repeat(chosen == way, flat.n)
            for k in range(3):
                np.copyto(out[k], options[way][k], where=here)
    bits: list[list[tuple[np.ndarray, np.ndarray]]] = []
    for k, way in enumerate(chosen.tolist()):
        if way == 1:
            bits.append([_transform_head(SUBTRACT_GREEN, None)])
        elif way in (2, 3):
            bits.append([_transform_head(PREDICTOR, (255, 0, way - 1, 0))])
        elif way == 4:
            bits.append([_transform_head(CROSS_COLOUR, (255, 0, int(to_blue[k]) & 255, int(to_red[k]) & 255))])
        else:
            bits.append([])
    return out, bits, np.where((chosen == 2) | (chosen == 3), 0, 255)


def _last_alike(keys: np.ndarray, picture: np.ndarray) -> np.ndarray:
    """For each place the nearest place before it with an equal key, in its own picture; -1 if there is none."""
    order = keys.argsort(kind="stable")
    same = (keys[order[1:]] == keys[order[:-1]]) & (picture[order[1:]] == picture[order[:-1]])
    out = np.full(len(keys), -1)
    out[order[1:][same]] = order[:-1][same]
    return out


def references(value: np.ndarray, flat: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, distance) of repeats of three pixels or more, none overlapping another, in order."""
    n = len(value)
    none = np.zeros(0, np.int64)
    if n < 3:
        return none, none, none
    three = [value[:-2], value[1:-1], value[2:]]
    own = value.view(np.uint32)
    mixed = own[:-2] * np.uint32(0x9E3779B1) ^ own[1:-1] * np.uint32(0x85EBCA77) ^ own[2:] * np.uint32(0xC2B2AE3D)
    before = _last_alike((mixed ^ mixed >> np.uint32(15)).astype(np.uint16), flat.picture[:-2])
    whole = flat.own[:-2] + 2 < flat.n[flat.picture[:-2]]
    good = (before >= 0) & whole
    for part in three:
        good &= part[before] == part
    at = np.flatnonzero(good)
    if not len(at):
        return none, none, none
    distance = at - before[at]
    opens = np.ones(len(at), bool)
    opens[1:] = (at[1:] != at[:-1] + 1) | (distance[1:] != distance[:-1]) | (flat.picture[at[1:]] != flat.picture[at[:-1]])
    begin = np.flatnonzero(opens)
    runs = np.diff(np.append(begin, len(at)))
    start, distance = at[begin], distance[begin]
    end = start + runs + 2
    start[1:] = np.maximum(start[1:], np.maximum.accumulate(end)[:-1])
    kept = end - start >= 3
    return start[kept], (end - start)[kept], distance[kept]


def _code_tokens(lengths: np.ndarray, alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, value, size) of the bits that store each row's code lengths, over the first `alphabet` symbols."""
    used = (lengths > 0).sum(axis=1)
    highest = lengths.shape[1] - 1 - (lengths[:, ::-1] > 0).argmax(axis=1)
    lowest = (lengths > 0).argmax(axis=1)
    simple = (used <= 2) & ((used == 0) | (highest < 256))
    rows = np.flatnonzero(simple)
    two = used[rows] == 2
    zero = np.where(used[rows] == 0, 0, lowest[rows])
    value = 1 | two << 1 | 1 << 2 | zero << 3 | np.where(two, highest[rows], 0) << 11
    parts = [(rows, value, np.where(two, 19, 11))]
    rows = np.flatnonzero(~simple)
    if len(rows):
        # Not simple, all 19 lengths of the fixed code for lengths, no bound on symbols.
        head = sum(int(webp._OWN_LENGTHS[s]) << 3 * k for k, s in enumerate(webp.CODE_LENGTH_ORDER)) << 5 | (19 - 4) << 1
        parts += [(rows, np.full(len(rows), head & (1 << 31) - 1), np.full(len(rows), 31)), (rows, np.full(len(rows), head >> 31), np.full(len(rows), 32))]
        inside = np.arange(lengths.shape[1])[None, :] < alphabet[rows][:, None]
        flat, row = lengths[rows][inside], np.repeat(rows, alphabet[rows])
        # Runs: every length is one by itself, zeros in a row are one.
        opens = np.ones(len(flat), bool)
        opens[1:] = (flat[1:] > 0) | (flat[:-1] > 0) | (row[1:] != row[:-1])
        begin = np.flatnonzero(opens)
        size = np.diff(np.append(begin, len(flat)))
        length, row = flat[begin], row[begin]
        many, rest = np.where(length == 0, size // 138, 0), np.where(length == 0, size % 138, 1)
        tokens = many + np.where((length == 0) & (rest >= 3), 1, rest)
        each = np.repeat(np.arange(len(begin)), tokens)
        nth = np.arange(len(each)) - np.repeat(np.cumsum(tokens) - tokens, tokens)
        length, rest = length[each], rest[each]
        long = nth < many[each]
        symbol = np.where(length > 0, length, np.where(long | (rest > 10), 18, np.where(rest >= 3, 17, 0)))
        further = np.where(symbol == 18, np.where(long, 127, rest - 11), np.where(symbol == 17, rest - 3, 0))
        bits = np.where(symbol == 18, 7, np.where(symbol == 17, 3, 0))
        parts.append((row[each], webp._OWN_CODES[symbol] | further << webp._OWN_LENGTHS[symbol], webp._OWN_LENGTHS[symbol] + bits))
    return tuple(np.concatenate(c) for c in zip(*parts))


def packed(picture: np.ndarray, value: np.ndarray, size: np.ndarray, pictures: int) -> list[bytes]:
    """The streams of all pictures from (picture, value, size) tokens, each picture's in order."""
    order = picture.astype(np.uint16 if pictures <= 1 << 16 else np.int64).argsort(kind="stable")
    picture, value, size = picture[order], value[order].astype(np.int64), size[order].astype(np.int64)
    bits = np.bincount(picture, size, pictures).astype(np.int64)
    n_bytes = (bits + 7) // 8
    first = np.cumsum(n_bytes) - n_bytes
    start = np.cumsum(size) - size
    start += (8 * first - (np.cumsum(bits) - bits))[picture]
    word, shift, total = start >> 5, start & 31, int(n_bytes.sum())
    words = total // 4 + 4
    # Values don't overlap, so a word of 32 bits is the sum of what each value adds to it, exactly.
    out = np.bincount(word, value << shift & 0xFFFFFFFF, words)
    high = value >> 32 - shift
    out[1:] += np.bincount(word, high & 0xFFFFFFFF, words)[:-1]
    if len(far := np.flatnonzero(high >> 32)):
        out[2:] += np.bincount(word[far], high[far] >> 32, words)[:-2]
    out = out.astype(np.uint32).astype("<u4").view(np.uint8)
    data = out[:total].tobytes()
    return [data[a : a + n] for a, n in zip(first.tolist(), n_bytes.tolist())]


def _palette(values: np.ndarray, width: int) -> tuple[np.ndarray, int, tuple[np.ndarray, np.ndarray]] | None:
    """Indices of a picture of up to 16 colours as a main image, its width, and the bits of the transform."""
    if len(set(values[:64].tolist())) > 16:
        return None
    colours, index = np.unique(values, return_inverse=True)
    if len(colours) > 16:
        return None
    out = webp.BitWriter()
    out.puts(np.array([1, COLOUR_INDEXING, len(colours) - 1]), np.array([1, 2, 8]))
    table = np.stack([np.full(len(colours), 255), colours >> 16, colours >> 8 & 255, colours & 255], 1).astype(np.uint8)
    steps = table.copy()
    steps[1:] -= table[:-1]
    webp._write_image(out, steps, False)
    n = webp._bundled(len(colours))
    across = (width + (1 << n) - 1) >> n
    index = np.pad(index.reshape(-1, width), ((0, 0), (0, (across << n) - width))).reshape(-1, 1 << n)
    image = (index << (8 >> n) * np.arange(1 << n)).sum(axis=1) << 8
    return image, across, (np.concatenate(out.values), np.concatenate(out.sizes))


def encode_many(pictures: list[np.ndarray]) -> list[bytes]:
    """One WebP file for each opaque picture (height, width, 3) of up to `MOST_PIXELS` pixels."""
    if not pictures:
        return []
    images, widths, palettes = [], [], []
    for picture in pictures:
        height, width = picture.shape[:2]
        if not 0 < height * width <= MOST_PIXELS:
            raise ValueError(f"a picture of this batch has up to {MOST_PIXELS} pixels")
        three = picture.reshape(-1, 3).astype(np.int64)
        values = three[:, 0] << 16 | three[:, 1] << 8 | three[:, 2]
        found = _palette(values, width)
        images.append(found[0] if found else values), widths.append(found[1] if found else width), palettes.append(found and found[2])
    flat = Flat(images, np.array(widths))
    count = len(pictures)
    (red, green, blue), transforms, alpha = transformed(flat, np.array([p is not None for p in palettes]))
    value = red.astype(np.int32) << 16 | green.astype(np.int32) << 8 | blue
    start, length, distance = references(value, flat)
    covered = np.zeros(len(value) + 1, np.int8)
    np.add.at(covered, start, 1)
    np.add.at(covered, start + length, -1)
    literal = np.cumsum(covered[:-1], dtype=np.int8) == 0
    slot = slots_of(np.repeat(alpha.astype(np.uint32) << np.uint32(24), flat.n) | value.view(np.uint32), CACHE_BITS).astype(np.int64)
    before = _last_alike(slot.astype(np.uint8), flat.picture)
    hit = literal & (before >= 0) & (value[before] == value)
    lengths, distances = PREFIXES[:, length], PREFIXES[:, distance + len(webp.NEIGHBOURS)]
    starts_of = flat.picture[start]

    def histogram(picture: np.ndarray, symbol: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(picture * size + symbol, minlength=count * size).reshape(count, size)

    referred = histogram(starts_of, LITERALS + lengths[0], GREENS)

    at = flat.picture[literal]
    plain = (referred + histogram(at, green[literal], GREENS), histogram(at, red[literal], 256), histogram(at, blue[literal], 256))
    at = flat.picture[hit]
    mixed = (plain[0] - histogram(at, green[hit], GREENS) + histogram(at, LITERALS + LENGTHS + slot[hit], GREENS), plain[1] - histogram(at, red[hit], 256), plain[2] - histogram(at, blue[hit], 256))
    # A symbol in use costs about five bits in the head of a picture.
    cost = [sum(bits_of(c) + 5 * (c > 0).sum(axis=1) for c in three) for three in (plain, mixed)]
    cached = cost[1] + 20 < cost[0]
    hit &= cached[flat.picture]
    shown = literal & ~hit
    counts = [np.where(cached[:, None], b, a) for a, b in zip(plain, mixed)]
    code_lengths = [huffman_lengths(c) for c in (*counts, histogram(starts_of, distances[0], DISTANCES))]
    codes, sizes = [], []
    for own in code_lengths:
        code = np.zeros(own.shape, np.int64)
        row, symbol, first = canonical(own)
        code[row, symbol] = REVERSED[first]
        codes.append(code)
        # A code of a single symbol takes no bits.
        sizes.append(np.where((own > 0).sum(axis=1, keepdims=True) > 1, own, 0))
    codes = [np.where(s > 0, c, 0) for c, s in zip(codes, sizes)]

    # Tokens: heads, codes, then pixels and references by their places.
    heads = []
    for k, picture in enumerate(pictures):
        height, width = picture.shape[:2]
        begin = (np.array([0x2F | width - 1 << 8 | height - 1 << 22]), np.array([40]))
        end = (np.array([int(cached[k]) << 1 | (CACHE_BITS << 2 if cached[k] else 0)]), np.array([7 if cached[k] else 3]))
        heads.append([begin, *([palettes[k]] if palettes[k] else []), *transforms[k], end])
    of_head = np.repeat(np.arange(count), [sum(len(v) for v, _ in h) for h in heads])
    tokens = [(of_head, np.concatenate([v for h in heads for v, _ in h]), np.concatenate([s for h in heads for _, s in h]))]
    alphas = np.zeros((count, 256), np.int64)
    alphas[np.arange(count), alpha] = 1
    greens = np.where(cached, GREENS, LITERALS + LENGTHS)
    for own, alphabet in zip((*code_lengths[:3], alphas, code_lengths[3]), (greens, 256, 256, 256, DISTANCES)):
        tokens.append(_code_tokens(own, np.broadcast_to(alphabet, count)))
    picture = flat.picture
    body_value, body_size = np.zeros(len(value), np.int64), np.zeros(len(value), np.int64)
    p = picture[shown]
    for which, channel in ((0, green), (1, red), (2, blue)):
        symbol = channel[shown]
        body_value[shown] |= codes[which][p, symbol] << body_size[shown]
        body_size[shown] += sizes[which][p, symbol]
    symbol = LITERALS + LENGTHS + slot[hit]
    body_value[hit], body_size[hit] = codes[0][picture[hit], symbol], sizes[0][picture[hit], symbol]
    for which, (symbol, further, more) in ((0, lengths), (3, distances)):
        symbol = symbol + (LITERALS if which == 0 else 0)
        body_value[start] |= (codes[which][starts_of, symbol] | further << sizes[which][starts_of, symbol]) << body_size[start]
        body_size[start] += sizes[which][starts_of, symbol] + more
    at = np.zeros(len(value), bool)
    at[start] = True
    at |= literal
    tokens.append((picture[at], body_value[at], body_size[at]))
    return [webp.wrapped(s) for s in packed(*(np.concatenate(c) for c in zip(*tokens)), count)]


# --- decoding ---------------------------------------------------------------------------------------------------------


def _tables(lengths: list[bytes], alphabet: int) -> np.ndarray:
    """For each code, symbol << 4 | size by the next `MOST_BITS` bits."""
    rows = np.zeros((len(lengths), alphabet), np.int64)
    for k, own in enumerate(lengths):
        rows[k, : len(own)] = np.frombuffer(own, np.uint8)
    used = (rows > 0).sum(axis=1)
    if rows.max(initial=0) > MOST_BITS:
        raise ValueError("code too long")
    out = np.zeros((len(lengths), 1 << MOST_BITS), np.int16)
    single = np.flatnonzero(used <= 1)
    out[single] = (rows[single].argmax(axis=1) << 4)[:, None]
    many = np.flatnonzero(used > 1)
    if len(many):
        own = rows[many]
        if (np.where(own > 0, 1 << MOST_BITS - own, 0).sum(axis=1) != 1 << MOST_BITS).any():
            raise ValueError("incomplete prefix code")
        row, symbol, _ = canonical(own)
        size = own[row, symbol]
        by_code = np.repeat((symbol << 4 | size).astype(np.int16), 1 << MOST_BITS - size).reshape(len(many), -1)
        out[many] = by_code[:, REVERSED]
    return out


class Parsed:
    """A stream up to its pixels; `plain` says whether `decode_many` takes it."""

    def __init__(self, data: bytes):
        bits = webp.Bits(data)
        self.width, self.height, self.across, self.undo = webp.read_head(bits)
        self.cache_bits = bits.read(4) if bits.read(1) else 0
        self.plain = self.cache_bits <= 11 and not bits.read(1)
        if self.plain:
            greens = LITERALS + LENGTHS + (1 << self.cache_bits if self.cache_bits else 0)
            self.lengths = [webp.read_lengths(bits, n) for n in (greens, 256, 256, 256, DISTANCES)]
            alpha = [s for s, n in enumerate(self.lengths[3]) if n] or [0]
            self.alpha = alpha[0]
            self.plain = len(alpha) == 1 and max(map(max, self.lengths)) <= MOST_BITS and greens <= 1 << 11
        self.at, self.end = bits.at, 8 * len(data)


def decode_many(data: list[bytes]) -> list[np.ndarray]:
    """The pictures (height, width, 4) of lossless streams."""
    parsed = [Parsed(d) for d in data]
    out: list[np.ndarray | None] = [None if p.plain else webp.decode_stream(d) for p, d in zip(parsed, data)]
    some = [k for k, p in enumerate(parsed) if p.plain]
    for k, pixels in zip(some, _main_images([parsed[k] for k in some], [data[k] for k in some])):
        argb = np.stack([pixels >> 24, pixels >> 16 & 255, pixels >> 8 & 255, pixels & 255], 1).astype(np.uint8)
        out[k] = webp.undone(argb, parsed[k].height, parsed[k].undo)
    return out


def _main_images(parsed: list[Parsed], data: list[bytes]) -> list[np.ndarray]:
    """The pixels of all main images as numbers of 32 bits."""
    if not parsed:
        return []
    n = np.array([p.across * p.height for p in parsed])
    first = np.cumsum(n) - n
    joined = np.frombuffer(b"".join(data) + bytes(64), np.uint8)
    words = np.ndarray(len(joined) - 8, "<i8", joined, strides=(1,))
    begin = 8 * (np.cumsum([len(d) for d in data]) - [len(d) for d in data])
    alphabet = max(len(p.lengths[0]) for p in parsed)
    tables = np.concatenate([_tables([p.lengths[c] for p in parsed], size) for c, size in ((0, max(alphabet, LITERALS + LENGTHS)), (1, 256), (2, 256), (4, DISTANCES))]).reshape(-1)
    step = len(parsed) << MOST_BITS
    mask = (1 << MOST_BITS) - 1
    alpha = np.array([p.alpha for p in parsed], np.int64) << 24
    value, slot, source = np.zeros(int(n.sum()), np.int64), np.zeros(int(n.sum()), np.int16), np.arange(int(n.sum()))
    lane = np.arange(len(parsed))
    bit, stop = begin + [p.at for p in parsed], begin + [p.end for p in parsed]
    at, end, base = first.copy(), first + n, lane << MOST_BITS
    refs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(lane):
        # At most 57 of the bits are used, so what a shift brings in from above doesn't matter.
        ahead = words[bit >> 3] >> (bit & 7)
        green = tables.take(base + (ahead & mask))
        used = green & 15
        ahead >>= used
        symbol = (green >> 4).astype(np.int64)
        red = tables.take(step + base + (ahead & mask))
        after = ahead >> (red & 15)
        blue = tables.take(2 * step + base + (after & mask))
        value[at] = alpha[lane] | (red >> 4).astype(np.int64) << 16 | symbol << 8 | blue >> 4
        more = ((red & 15) + (blue & 15)).astype(np.int64)
        moved = np.ones(len(lane), np.int64)
        if (other := np.flatnonzero(symbol >= LITERALS)).size:
            more[other] = 0
            kind = symbol[other] - LITERALS
            by_cache = kind >= LENGTHS
            slot[at[other[by_cache]]] = kind[by_cache] - LENGTHS + 1
            back = other[~by_cache]
            if back.size:
                kind, rest = kind[~by_cache], ahead[back]
                own_bits = MORE_BITS[kind]
                length = FIRST_VALUE[kind] + (rest & (1 << own_bits) - 1)
                rest >>= own_bits
                code = tables[3 * step + base[back] + (rest & mask)].astype(np.int64)
                rest >>= code & 15
                far_bits = MORE_BITS[code >> 4]
                far = FIRST_VALUE[code >> 4] + (rest & (1 << far_bits) - 1)
                near = np.flatnonzero(far <= len(webp.NEIGHBOURS))
                far -= len(webp.NEIGHBOURS)
                for i in near.tolist():
                    far[i] = webp._distance(int(far[i]) + len(webp.NEIGHBOURS), parsed[int(lane[back[i]])].across)
                if (far > at[back] - first[lane[back]]).any() or (at[back] + length > end[back]).any():
                    raise ValueError("back-reference out of the image")
                more[back] = own_bits + (code & 15) + far_bits
                moved[back] = length
                refs.append((at[back], length, far))
        bit = bit + used + more
        at = at + moved
        live = at < end
        if not live.all():
            if (bit > stop).any():
                raise ValueError("bit stream ends early")
            lane, bit, stop, at, end, base = (x[live] for x in (lane, bit, stop, at, end, base))
    _resolve(value, slot, source, refs, first, n, np.array([p.cache_bits for p in parsed]))
    return np.split(value, first[1:])


def _resolve(value: np.ndarray, slot: np.ndarray, source: np.ndarray, refs: list, first: np.ndarray, n: np.ndarray, cache_bits: np.ndarray) -> None:
    """Fill in the pixels of back-references and of caches."""
    place = np.zeros(0, np.int64)
    if refs:
        start, length, far = (np.concatenate(c) for c in zip(*refs))
        begin = np.cumsum(length) - length
        place = np.repeat(start, length) + np.arange(int(length.sum())) - np.repeat(begin, length)
        source[place] = place - np.repeat(far, length)
    with_cache = np.flatnonzero(cache_bits > 0)
    if with_cache.size:
        # A cache depends on every pixel before: all pictures with one go pixel by pixel, in step.
        lanes = with_cache[np.argsort(-n[with_cache], kind="stable")]
        room = int(cache_bits.max())
        shift, own, base = (32 - cache_bits[lanes]).astype(np.uint32), np.arange(len(lanes)) << room, first[lanes]
        cache = np.zeros(len(lanes) << room, np.int64)
        sizes = -n[lanes]
        for k in range(int(n[lanes[0]])):
            m = int(np.searchsorted(sizes, -k, "left"))
            i = base[:m] + k
            colour = value[source[i]]
            wanted = slot[i]
            if wanted.any():
                colour = np.where(wanted > 0, cache[own[:m] + np.maximum(wanted, 1) - 1], colour)
            value[i] = colour
            cache[own[:m] + ((colour.astype(np.uint32) * np.uint32(CACHE_FACTOR)) >> shift[:m])] = colour
    if place.size:
        # References to references are followed, twice as far each time.
        to = source[place]
        while True:
            source[place] = to
            further = source[to]
            if (further == to).all():
                break
            to = further
        value[place] = value[to]
