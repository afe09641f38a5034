"""Lossless WebP for pixel arrays: a complete decoder and an encoder, with numpy.

Pixels are `uint8` arrays (height, width, 4) in the order alpha, red, green, blue. The decoder handles prefix codes (one
group or a group per block of an entropy image), back-references, the colour cache, and the predictor, cross-colour,
subtract-green and colour-indexing transforms. Runs of plain literals are decoded by arrays: the length of the pixel
that would start at each bit is looked up for all bits at once, and the true starts are found by following the lengths.
"""

from __future__ import annotations

import functools
import heapq
import struct

import numpy as np

MOST_SIDE = 16384
#: The encoder's longest codes (the format has up to 15 bits): short codes keep the decoder's tables small.
MOST_BITS = 11
#: Fixed values of the format: order in which code-length lengths are stored, and the 2-D neighbours of short distances.
CODE_LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
NEIGHBOURS = (
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2), (0, 3), (3, 0), (1, 3),
    (-1, 3), (3, 1), (-3, 1), (2, 3), (-2, 3), (3, 2), (-3, 2), (0, 4), (4, 0), (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3),
    (2, 4), (-2, 4), (4, 2), (-4, 2), (0, 5), (3, 4), (-3, 4), (4, 3), (-4, 3), (5, 0), (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5),
    (-2, 5), (5, 2), (-5, 2), (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1),
    (2, 6), (-2, 6), (6, 2), (-6, 2), (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3), (0, 7), (7, 0), (1, 7),
    (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1), (4, 6), (-4, 6), (6, 4), (-6, 4), (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7),
    (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5), (8, 0), (4, 7), (-4, 7), (7, 4), (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6),
    (8, 3), (5, 7), (-5, 7), (7, 5), (-7, 5), (8, 4), (6, 7), (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
)
CACHE_FACTOR = 0x1E35A7BD
#: Beyond any window of bits.
STOP = 1 << 40
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, COLOUR_INDEXING = range(4)


# --- prefix codes -----------------------------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, most: int = 15) -> np.ndarray:
    """Huffman code lengths of at most `most` bits; 0 for symbols that don't occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    most = max(most, len(used).bit_length() + 2)
    floor = 1
    while True:
        heap = [(max(int(counts[s]), floor), i, None) for i, s in enumerate(used)]
        heapq.heapify(heap)
        tie = len(heap)
        while len(heap) > 1:
            a = heapq.heappop(heap)
            heapq.heapreplace(heap, (a[0] + heap[0][0], tie, (a, heap[0])))
            tie += 1
        stack, deepest = [(heap[0], 0)], 0
        while stack:
            (_, at, below), depth = stack.pop()
            if below is None:
                lengths[used[at]] = depth
                deepest = max(deepest, depth)
            else:
                stack += [(below[0], depth + 1), (below[1], depth + 1)]
        if deepest <= most:
            return lengths
        floor *= 2


def fixed_lengths(counts: np.ndarray) -> np.ndarray:
    """One length for all symbols in use, filled up with unused symbols to a complete code; Huffman's if there are too few.

    Some bits more than Huffman's, but every symbol's place in the stream is known, so arrays read and write it.
    """
    used = counts > 0
    n = int(used.sum())
    size = max(n - 1, 0).bit_length()
    if n < 2 or 1 << size > len(counts):
        return code_lengths(counts, MOST_BITS)
    # Unused symbols among the used ones come first: longer runs of equal lengths make shorter headers.
    spare = (~used).nonzero()[0]
    spare = np.concatenate([spare[spare >= 32], spare[spare < 32]])
    used[spare[: (1 << size) - n]] = True
    return np.where(used, size, 0)


#: The 16 bits of every number in reversed order.
_REVERSED = sum(((np.arange(1 << 16) >> k & 1) << 15 - k) for k in range(16))


def _canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols that have codes in the order of their codes, and their lengths."""
    used = lengths.nonzero()[0]
    order = used[lengths[used].argsort(kind="stable")]
    return order, lengths[order]


def reversed_codes(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes with the first bit lowest, as the bit stream holds them."""
    out = np.zeros(len(lengths), np.int64)
    order, sizes = _canonical(lengths)
    if len(order):
        # In units of the longest possible code, each code starts where the ones before it end.
        first = np.cumsum(1 << 15 - sizes) - (1 << 15 - sizes)
        out[order] = _REVERSED[first << 1]
    return out


class PrefixCode:
    """A table from the next `bits` bits to symbol and length. A code of one symbol takes no bits."""

    def __init__(self, lengths: np.ndarray):
        order, sizes = _canonical(lengths)
        if len(order) < 2:
            self.bits, self.symbols, self.sizes = 0, np.array([order[0] if len(order) else 0]), np.zeros(1, np.uint8)
        else:
            self.bits = int(sizes[-1])
            share = 1 << self.bits - sizes
            if int(share.sum()) != 1 << self.bits:
                raise ValueError("incomplete prefix code")
            by_stream = _REVERSED[: 1 << self.bits] >> 16 - self.bits
            self.symbols, self.sizes = order.repeat(share)[by_stream], sizes.astype(np.uint8).repeat(share)[by_stream]
        self.mask = (1 << self.bits) - 1
        self.jumps = np.where(self.symbols < 256, self.sizes.astype(np.int64), np.int64(STOP))
        self.fixed = int(self.sizes[0]) if (self.sizes == self.sizes[0]).all() else None
        self.literal = int((self.symbols >= 256).sum()) << 6 < len(self.symbols)
        self._plain = None

    def plain(self) -> tuple[list[int], list[int]]:
        if self._plain is None:
            self._plain = self.symbols.tolist(), self.sizes.tolist()
        return self._plain

    def read(self, bits: Bits) -> int:
        symbols, sizes = self.plain()
        at = bits.peek(self.bits)
        bits.at += sizes[at]
        return symbols[at]


# --- bits -------------------------------------------------------------------------------------------------------------


class Bits:
    def __init__(self, data: bytes):
        self.data, self.at, self.end = data + bytes(8), 0, 8 * len(data)

    def peek(self, n: int) -> int:
        byte, shift = divmod(self.at, 8)
        return int.from_bytes(self.data[byte : byte + 8], "little") >> shift & (1 << n) - 1

    def read(self, n: int) -> int:
        value = self.peek(n)
        self.at += n
        if self.at > self.end:
            raise ValueError("bit stream ends early")
        return value

    def words(self, first: int, last: int) -> np.ndarray:
        """The 16 bits that follow each bit from `first` up to `last`."""
        byte, stop = first // 8, (last + 7) // 8
        raw = np.frombuffer(self.data, np.uint8)
        raw = np.concatenate([raw[byte : stop + 4], np.zeros(max(0, stop + 4 - len(raw)), np.uint8)]).astype(np.uint32)
        three = raw[:-2] | raw[1:-1] << 8 | raw[2:] << 16
        every = (three[: stop - byte, None] >> np.arange(8, dtype=np.uint32)) & 0xFFFF
        return every.reshape(-1)[first - 8 * byte : last - 8 * byte]


class BitWriter:
    """Values and their bit counts, packed at the end, lowest bit first."""

    def __init__(self):
        self.values: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []

    def put(self, value: int, n: int) -> None:
        self.puts(np.array([value], np.int64), np.array([n], np.int64))

    def puts(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.values.append(values.astype(np.int64))
        self.sizes.append(sizes.astype(np.int64))

    def bytes(self) -> bytes:
        """Values of up to 45 bits don't overlap, so the bytes are the sums of what each value adds to them."""
        values, sizes = np.concatenate(self.values), np.concatenate(self.sizes)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        total = (int(ends[-1]) + 7) // 8
        values, byte = values << (starts & 7), starts >> 3
        out = np.zeros(total + 7)
        for k in range((int(sizes.max()) + 14) // 8):
            part = np.bincount(byte, values >> 8 * k & 255)
            out[k : k + len(part)] += part
        return out[:total].astype(np.uint8).tobytes()


# --- decoding ---------------------------------------------------------------------------------------------------------


@functools.lru_cache(maxsize=512)
def _shared_code(lengths: bytes) -> PrefixCode:
    """Codes with the same lengths share their tables."""
    return PrefixCode(np.frombuffer(lengths, np.uint8).astype(np.int64))


@functools.lru_cache(maxsize=512)
def _length_code(stored: int, n: int) -> PrefixCode:
    """The code for code lengths, from the three bits of each of its first n lengths."""
    own = bytearray(19)
    for k in range(n):
        own[CODE_LENGTH_ORDER[k]] = stored >> 3 * k & 7
    return _shared_code(bytes(own))


def _read_code(bits: Bits, alphabet: int) -> PrefixCode:
    return _shared_code(read_lengths(bits, alphabet))


def read_lengths(bits: Bits, alphabet: int) -> bytes:
    """The code lengths of an alphabet's symbols, as far as they are stored."""
    if bits.read(1):
        lengths = bytearray(alphabet)
        n = bits.read(1) + 1
        lengths[bits.read(8 if bits.read(1) else 1)] = 1
        if n == 2:
            lengths[bits.read(8)] = 1
        return bytes(lengths)
    n = bits.read(4) + 4
    code = _length_code(bits.peek(3 * n), n)
    bits.at += 3 * n
    left = alphabet
    if bits.read(1):
        left = 2 + bits.read(2 + 2 * bits.read(3))
        if left > alphabet:
            raise ValueError("too many code lengths")
    symbols, sizes = code.plain()
    data, mask, place, found, before = bits.data, code.mask, bits.at, [], 8
    ahead, held = 0, 0  # the bits that follow, and how many of them; 12 are looked at, at most
    while len(found) < alphabet and left > 0:
        left -= 1
        if held < 16:
            ahead, held = int.from_bytes(data[place >> 3 : (place >> 3) + 32], "little") >> (place & 7), 256 - (place & 7)
        k = ahead & mask
        n, size = symbols[k], sizes[k]
        ahead >>= size
        if n < 16:
            found.append(n)
            before = n or before
        else:
            more, least = ((2, 3), (3, 3), (7, 11))[n - 16]
            found += [before if n == 16 else 0] * (least + (ahead & (1 << more) - 1))
            ahead >>= more
            size += more
        place += size
        held -= size
    bits.at = place
    if len(found) > alphabet or place > bits.end:
        raise ValueError("code lengths overrun")
    return bytes(found)


def _prefixed(symbol: int, bits: Bits) -> int:
    """The value of a length or distance symbol with its further bits, from 1."""
    if symbol < 4:
        return symbol + 1
    more = symbol - 2 >> 1
    return (2 + (symbol & 1) << more) + bits.read(more) + 1


def _distance(code: int, width: int) -> int:
    if code > len(NEIGHBOURS):
        return code - len(NEIGHBOURS)
    x, y = NEIGHBOURS[code - 1]
    return max(1, x + y * width)


def _fixed_literals(bits: Bits, group: list[PrefixCode], out: np.ndarray, at: int, most: int) -> int:
    """`_literals` where each code has one length, so that pixels are equally long."""
    sizes = [group[c].bits for c in (0, 1, 2, 3)]
    pixel, done = sum(sizes), 0
    while done < most:
        n = min(most - done, (bits.end - bits.at) // pixel, 1 << 16)
        if n <= 0:
            return done
        byte, shift = divmod(bits.at, 8)
        raw = np.frombuffer(bits.data, np.uint8, (shift + n * pixel + 7) // 8, byte)
        each = np.unpackbits(raw, bitorder="little")[shift : shift + n * pixel].reshape(n, pixel)
        first = 0
        for channel, code in ((2, group[0]), (1, group[1]), (3, group[2]), (0, group[3])):
            value = each[:, first].astype(np.int64) if code.bits else np.zeros(n, np.int64)
            for k in range(1, code.bits):
                value |= each[:, first + k].astype(np.int64) << k
            first += code.bits
            symbol = code.symbols[value]
            if channel == 2 and (other := (symbol >= 256).nonzero()[0]).size:
                n = int(other[0])
                each, symbol = each[:n], symbol[:n]
            out[at + done : at + done + n, channel] = symbol
        bits.at += n * pixel
        done += n
        if len(each) < min(most - done + n, 1 << 16):
            return done
    return done


def _literals(bits: Bits, group: list[PrefixCode], out: np.ndarray, at: int, most: int, window: int = 1 << 17) -> int:
    """Decode literals from `at` until another kind of symbol or `most` pixels; how many were read."""
    green, red, blue, alpha = group[:4]
    if not green.bits + red.bits + blue.bits + alpha.bits:
        # Every code has one symbol: pixels take no bits at all.
        if green.symbols[0] >= 256:
            return 0
        out[at : at + most] = [code.symbols[0] for code in (alpha, red, green, blue)]
        return most
    if all(code.fixed is not None for code in (green, red, blue, alpha)):
        return _fixed_literals(bits, group, out, at, most)
    done = 0
    # Few pixels are looked at first: where other symbols are frequent, wide windows would be wasted.
    span = min(window, 24 * most, 1 << 15) if green.literal else 4096
    while done < most and bits.at < bits.end:
        first = bits.at
        n = min(bits.end - first, span)
        ahead = bits.words(first, first + n + 64)
        # How far each bit is from the end of the code that starts there; a symbol other than a literal goes nowhere.
        step = green.jumps[ahead[:n] & green.mask]
        here = np.arange(n)
        end = here + step
        known: dict[int, np.ndarray] = {}
        for code in (red, blue, alpha):
            if code.bits:
                if id(code) not in known:
                    known[id(code)] = code.sizes[ahead & code.mask]
                end += known[id(code)].take(end, mode="clip")
        following = end.tolist()
        starts, p, room = [], 0, most - done
        # A pixel that ends beyond the window is left to the next window, unless the stream ends there.
        limit = n if first + n == bits.end else n - 60
        while p < limit and len(starts) < room:
            q = following[p]
            if q >= STOP:
                break
            starts.append(p)
            p = q
        if starts:
            k = np.array(starts)
            part = out[at + done : at + done + len(k)]
            for channel, code in ((2, green), (1, red), (3, blue), (0, alpha)):
                if code.bits:
                    v = ahead[k] & code.mask
                    part[:, channel] = code.symbols[v]
                    k = k + code.sizes[v]
                else:
                    part[:, channel] = code.symbols[0]
            bits.at = first + p
            done += len(starts)
        if p < limit and done < most:
            return done
        span = window
    return done


def _image(bits: Bits, width: int, height: int, top: bool) -> np.ndarray:
    """A spatially coded image as (pixels, 4); `top` for the main image, which may have an entropy image."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    if cache_bits > 11:
        raise ValueError("colour cache too large")
    groups_of, block = None, 0
    if top and bits.read(1):
        block = bits.read(3) + 2
        across, down = (width + (1 << block) - 1) >> block, (height + (1 << block) - 1) >> block
        meta = _image(bits, across, down, False)
        groups_of = (meta[:, 1].astype(np.int64) << 8 | meta[:, 2]).reshape(down, across)
    cache_size = 1 << cache_bits if cache_bits else 0
    groups = [[_read_code(bits, n) for n in (280 + cache_size, 256, 256, 256, 40)] for _ in range(int(groups_of.max()) + 1 if groups_of is not None else 1)]
    total = width * height
    out = np.zeros((total, 4), np.uint8)
    cache = np.zeros((cache_size, 4), np.uint8)
    cached = 0  # pixels before this are in the cache

    def remember(upto: int) -> None:
        nonlocal cached
        if cache_size and upto > cached:
            new = out[cached:upto]
            value = new[:, 0].astype(np.uint64) << 24 | new[:, 1].astype(np.uint64) << 16 | new[:, 2].astype(np.uint64) << 8 | new[:, 3]
            slot = (value * CACHE_FACTOR & 0xFFFFFFFF) >> (32 - cache_bits)
            last = len(slot) - 1 - np.unique(slot[::-1], return_index=True)[1]  # of equal slots the last pixel stays
            cache[slot[last]] = new[last]
            cached = upto

    at = 0
    while at < total:
        group, run = groups[0], total - at
        if groups_of is not None:
            y, x = divmod(at, width)
            group = groups[groups_of[y >> block, x >> block]]
            run = min(run, width - x, (1 << block) - (x & (1 << block) - 1))
        read = _literals(bits, group, out, at, run)
        at += read
        if read == run:
            continue
        if bits.at >= bits.end and group[0].bits:
            raise ValueError("bit stream ends early")
        symbol = group[0].read(bits)
        if symbol < 256:  # the last pixels of a stream, too near its end for the arrays
            out[at, 2] = symbol
            for channel, code in ((1, 1), (3, 2), (0, 3)):
                out[at, channel] = group[code].read(bits)
            at += 1
        elif symbol < 280:
            length = _prefixed(symbol - 256, bits)
            distance = _distance(_prefixed(group[4].read(bits), bits), width)
            if distance > at or at + length > total:
                raise ValueError("back-reference out of the image")
            for done in range(0, length, distance):
                n = min(distance, length - done)
                out[at + done : at + done + n] = out[at + done - distance : at + done - distance + n]
            at += length
        else:
            remember(at)
            if symbol - 280 >= cache_size:
                raise ValueError("colour cache index out of range")
            out[at] = cache[symbol - 280]
            at += 1
    if bits.at > bits.end:
        raise ValueError("bit stream ends early")
    return out


def _select(left: list[int], up: list[int], corner: list[int]) -> list[int]:
    by_left = sum(abs(u - c) for u, c in zip(up, corner, strict=True))
    by_up = sum(abs(a - c) for a, c in zip(left, corner, strict=True))
    return left if by_left < by_up else up


def _predict(mode: int, a: list[int], t: list[int], tr: list[int], tl: list[int]) -> list[int]:
    """Prediction from left, top, top-right and top-left pixels; modes are numbered as in the format."""

    def mean(p, q):
        return [x + y >> 1 for x, y in zip(p, q, strict=True)]

    def clip(v):
        return 0 if v < 0 else 255 if v > 255 else v

    match mode:
        case 0:
            return [255, 0, 0, 0]
        case 1:
            return a
        case 2:
            return t
        case 3:
            return tr
        case 4:
            return tl
        case 5:
            return mean(mean(a, tr), t)
        case 6:
            return mean(a, tl)
        case 7:
            return mean(a, t)
        case 8:
            return mean(tl, t)
        case 9:
            return mean(t, tr)
        case 10:
            return mean(mean(a, tl), mean(t, tr))
        case 11:
            return _select(a, t, tl)
        case 12:
            return [clip(x + y - z) for x, y, z in zip(a, t, tl, strict=True)]
        case 13:
            half = mean(a, t)
            # The division rounds towards zero.
            return [clip(m + int((m - z) / 2)) for m, z in zip(half, tl, strict=True)]
    return [255, 0, 0, 0]


def _each_prediction(pixels: np.ndarray, width: int, modes: np.ndarray, block: int, sign: int) -> np.ndarray:
    """Add (sign 1, to decode) or subtract (sign -1, to encode) the predictions."""
    height = len(pixels) // width
    if sign > 0 and (modes == modes.flat[0]).all() and modes.flat[0] in (1, 2):
        # Sums along the first row and column, then along all rows (left) or columns (top).
        out = pixels.reshape(height, width, 4).copy()
        out[0, 0, 0] += 255
        first, second = (1, 0) if modes.flat[0] == 2 else (0, 1)
        edge = (slice(0, 1), slice(None)) if first == 1 else (slice(None), slice(0, 1))
        out[edge] = np.cumsum(out[edge], axis=first, dtype=np.uint8)
        return np.cumsum(out, axis=second, dtype=np.uint8).reshape(-1, 4)
    source = pixels.tolist()
    known: list[list[int]] = [] if sign > 0 else source
    out: list[list[int]] = known if sign > 0 else []
    for at in range(width * height):
        y, x = divmod(at, width)
        if at == 0:
            p = [255, 0, 0, 0]
        elif y == 0:
            p = known[at - 1]
        elif x == 0:
            p = known[at - width]
        else:
            # Right of the last column the format takes the leftmost pixel of the current row.
            p = _predict(int(modes[y >> block, x >> block]), known[at - 1], known[at - width], known[at - width + 1], known[at - width - 1])
        out.append([s + sign * q & 255 for s, q in zip(source[at], p, strict=True)])
    return np.array(out, np.uint8).reshape(-1, 4)


def _cross_colour(pixels: np.ndarray, width: int, elements: np.ndarray, block: int, sign: int) -> np.ndarray:
    """Elements hold red-to-blue, green-to-blue and green-to-red factors in red, green and blue."""
    height = len(pixels) // width
    y, x = np.divmod(np.arange(width * height), width)
    factor = elements[y >> block, x >> block].astype(np.int8).astype(np.int32)
    signed = pixels.astype(np.int8).astype(np.int32)
    out = pixels.copy()
    red = pixels[:, 1] + sign * (factor[:, 3] * signed[:, 2] >> 5)
    out[:, 1] = red
    true_red = (red if sign > 0 else pixels[:, 1]).astype(np.uint8).astype(np.int8).astype(np.int32)
    out[:, 3] = pixels[:, 3] + sign * ((factor[:, 2] * signed[:, 2] >> 5) + (factor[:, 1] * true_red >> 5))
    return out


def _bundled(colours: int) -> int:
    """By how many bits the width shrinks when indices share a pixel."""
    return 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0


def read_head(bits: Bits) -> tuple[int, int, int, list[tuple]]:
    """Width, height, width of the main image, and the transforms to undo, of a stream up to its main image."""
    if bits.read(8) != 0x2F:
        raise ValueError("no lossless signature")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise ValueError("unknown version")
    undo, across, seen = [], width, set()
    while bits.read(1):
        kind = bits.read(2)
        if kind in seen:
            raise ValueError("a transform occurs twice")
        seen.add(kind)
        if kind in (PREDICTOR, CROSS_COLOUR):
            block = bits.read(3) + 2
            w, h = (across + (1 << block) - 1) >> block, (height + (1 << block) - 1) >> block
            undo.append((kind, across, block, _image(bits, w, h, False).reshape(h, w, 4)))
        elif kind == COLOUR_INDEXING:
            n = bits.read(8) + 1
            palette = np.cumsum(_image(bits, n, 1, False), axis=0, dtype=np.uint8)
            undo.append((kind, across, _bundled(n), palette))
            across = (across + (1 << _bundled(n)) - 1) >> _bundled(n)
        else:
            undo.append((kind, across, 0, None))
    return width, height, across, undo


def undone(pixels: np.ndarray, height: int, undo: list[tuple]) -> np.ndarray:
    """The picture (height, width, 4) of a main image, by its transforms, the last one first."""
    for kind, w, n, more in reversed(undo):
        if kind == PREDICTOR:
            pixels = _each_prediction(pixels, w, more[:, :, 2] & 15, n, 1)
        elif kind == CROSS_COLOUR:
            pixels = _cross_colour(pixels, w, more, n, 1)
        elif kind == SUBTRACT_GREEN:
            pixels = pixels.copy()
            pixels[:, 1] += pixels[:, 2]
            pixels[:, 3] += pixels[:, 2]
        else:
            size = 8 >> n
            index = pixels[:, 2].reshape(height, -1)
            index = (index[:, :, None] >> (size * np.arange(1 << n)).astype(np.uint8) & ((1 << size) - 1)).reshape(height, -1)[:, :w]
            full = np.zeros((256, 4), np.uint8)
            full[: len(more)] = more
            pixels = full[index.reshape(-1)]
    return pixels.reshape(height, -1, 4)


def decode_stream(data: bytes) -> np.ndarray:
    bits = Bits(data)
    width, height, across, undo = read_head(bits)
    return undone(_image(bits, across, height, True), height, undo)


def streams(data: bytes) -> list[bytes]:
    """The lossless streams of one or more WebP files, one after the other."""
    out, at = [], 0
    while at < len(data):
        riff, size, webp = struct.unpack_from("<4sI4s", data, at)
        if riff != b"RIFF" or webp != b"WEBP" or at + 8 + size > len(data):
            raise ValueError("no WebP file")
        end, at = at + 8 + size, at + 12
        found = len(out)
        while at + 8 <= end:
            kind, n = struct.unpack_from("<4sI", data, at)
            if at + 8 + n > end:
                raise ValueError("a chunk ends beyond its file")
            if kind == b"VP8L":
                out.append(data[at + 8 : at + 8 + n])
            at += 8 + n + (n & 1)
        if len(out) == found:
            raise ValueError("no lossless picture")
        at = end
    return out


def pixels_of(stream: bytes) -> int:
    """How many pixels a stream says it has."""
    said = int.from_bytes(stream[1:5], "little")
    return ((said & 0x3FFF) + 1) * ((said >> 14 & 0x3FFF) + 1)


def decode(data: bytes) -> list[np.ndarray]:
    """All pictures of one or more WebP files, one after the other."""
    return [decode_stream(stream) for stream in streams(data)]


def wrapped(stream: bytes) -> bytes:
    """A lossless stream as a WebP file."""
    body = b"VP8L" + struct.pack("<I", len(stream)) + stream + bytes(len(stream) & 1)
    return b"RIFF" + struct.pack("<I", 4 + len(body)) + b"WEBP" + body


# --- encoding ---------------------------------------------------------------------------------------------------------

#: Lengths that the encoder gives the code-length symbols: 0-9 and 16-18 in four bits, 10-15 in five.
_OWN_LENGTHS = np.array([4] * 10 + [5] * 6 + [4] * 3, np.int64)
_OWN_CODES = reversed_codes(_OWN_LENGTHS)


def _write_code(out: BitWriter, lengths: np.ndarray) -> None:
    values, sizes = _code_header(lengths.astype(np.uint8).tobytes())
    out.puts(values, sizes)


@functools.lru_cache(maxsize=4096)
def _code_header(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The bits that store a code's lengths; equal codes recur within a picture and among pictures."""
    out, lengths = BitWriter(), np.frombuffer(packed, np.uint8).astype(np.int64)
    _put_lengths(out, lengths)
    return np.concatenate(out.values), np.concatenate(out.sizes)


def _put_lengths(out: BitWriter, lengths: np.ndarray) -> None:
    used = np.flatnonzero(lengths)
    if len(used) <= 2 and (not len(used) or used[-1] < 256):
        symbols = used.tolist() or [0]
        out.put(1 | (len(symbols) - 1) << 1, 2)
        out.put(1, 1)
        for s in symbols:
            out.put(s, 8)
        return
    out.put(0, 1)
    out.put(19 - 4, 4)
    for s in CODE_LENGTH_ORDER:
        out.put(int(_OWN_LENGTHS[s]), 3)
    out.put(0, 1)
    symbols, more = [], []
    bounds = [0, *(np.diff(lengths).nonzero()[0] + 1).tolist(), len(lengths)]
    before = 8
    for first, last in zip(bounds, bounds[1:], strict=False):
        n, value = last - first, int(lengths[first])
        if value and value != before:
            symbols.append(value), more.append((0, 0))
            n, before = n - 1, value
        while n:
            # Runs are stored as repeats: of zeros up to 138, of the length before up to 6.
            least, most, symbol, size = (3, 6, 16, 2) if value else (11, 138, 18, 7) if n > 10 else (3, 10, 17, 3)
            if n < least:
                symbols += [value] * n
                more += [(0, 0)] * n
                break
            k = min(n, most)
            symbols.append(symbol), more.append((k - least, size))
            n -= k
    own = np.array(symbols)
    further = np.array(more)
    out.puts(_OWN_CODES[own] | further[:, 0] << _OWN_LENGTHS[own], _OWN_LENGTHS[own] + further[:, 1])


def _prefix_of(value: int) -> tuple[int, int, int]:
    """Symbol, further bits and their count for a length or distance value from 1."""
    if value <= 4:
        return value - 1, 0, 0
    v = value - 1
    top = v.bit_length() - 1
    return 2 * top + (v >> top - 1 & 1), v & (1 << top - 1) - 1, top - 1


def _tokens(pixels: np.ndarray, cache_bits: int, references: bool) -> list[tuple]:
    """("p", at, n) literals, ("r", length, distance) references, ("c", index) cached colours."""
    n = len(pixels)
    if not cache_bits and not references:
        # Only the run of equal pixels at the end (padding) becomes a reference.
        differ = np.flatnonzero((pixels != pixels[-1]).any(axis=1))
        first = int(differ[-1]) + 2 if len(differ) else 1
        out, run = [("p", 0, min(first, n))], n - first
        while run > 0:
            step = min(run, 4096)
            out.append(("r", step, 1))
            run -= step
        return out
    values = [tuple(p) for p in pixels.tolist()]
    out, at, cache, last = [], 0, {}, {}
    while at < n:
        if references and at + 3 <= n and (before := last.get(tuple(values[at : at + 3]))) is not None:
            length = 0
            while at + length < n and length < 4096 and values[before + length] == values[at + length]:
                length += 1
            out.append(("r", length, at - before))
        else:
            length = 1
            a, r, g, b = values[at]
            slot = ((a << 24 | r << 16 | g << 8 | b) * CACHE_FACTOR & 0xFFFFFFFF) >> 32 - cache_bits if cache_bits else 0
            out.append(("c", slot) if cache_bits and cache.get(slot) == values[at] else ("p", at, 1))
        for k in range(at, at + length):
            last[tuple(values[k : k + 3])] = k
            if cache_bits:
                a, r, g, b = values[k]
                cache[((a << 24 | r << 16 | g << 8 | b) * CACHE_FACTOR & 0xFFFFFFFF) >> 32 - cache_bits] = values[k]
        at += length
    return out


def _write_image(out: BitWriter, pixels: np.ndarray, top: bool, cache_bits: int = 0, references: bool = False, fixed: bool = False) -> None:
    tokens = _tokens(pixels, cache_bits, references)
    out.put(1 if cache_bits else 0, 1)
    if cache_bits:
        out.put(cache_bits, 4)
    if top:
        out.put(0, 1)
    literal = np.concatenate([np.arange(t[1], t[1] + t[2]) for t in tokens if t[0] == "p"] or [np.zeros(0, np.int64)])
    shown = pixels[literal]
    counts = [np.bincount(shown[:, c], minlength=256) for c in (2, 1, 3, 0)]
    if fixed:
        # One set of symbols for the three colours, as bytes of a payload are alike in all of them.
        counts[0] = counts[1] = counts[2] = counts[0] + counts[1] + counts[2]
    green = np.concatenate([counts[0], np.zeros(24 + (1 << cache_bits if cache_bits else 0), np.int64)])
    distances = np.zeros(40, np.int64)
    for t in tokens:
        if t[0] == "r":
            green[256 + _prefix_of(t[1])[0]] += 1
            distances[_prefix_of(t[2] + len(NEIGHBOURS))[0]] += 1
        elif t[0] == "c":
            green[280 + t[1]] += 1
    choose = fixed_lengths if fixed else lambda c: code_lengths(c, MOST_BITS)
    colours = [choose(counts[1])] * 2 if fixed else [choose(c) for c in counts[1:3]]
    lengths = [choose(green), *colours, choose(counts[3]), choose(distances)]
    for n in lengths:
        _write_code(out, n)
    # A code of a single symbol takes no bits.
    sizes = [n if np.count_nonzero(n) > 1 else np.zeros_like(n) for n in lengths]
    codes = [reversed_codes(n) for n in lengths]
    for t in tokens:
        if t[0] == "p":
            part = pixels[t[1] : t[1] + t[2]]
            value, size = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
            for i, c in enumerate((2, 1, 3, 0)):
                if sizes[i].any():
                    value |= codes[i].take(part[:, c]) << size
                    size += sizes[i].take(part[:, c])
            out.puts(value, size)
        elif t[0] == "c":
            out.put(int(codes[0][280 + t[1]]), int(sizes[0][280 + t[1]]))
        else:
            for base, which, value in ((256, 0, t[1]), (0, 4, t[2] + len(NEIGHBOURS))):
                symbol, more, n = _prefix_of(value)
                out.put(int(codes[which][base + symbol]), int(sizes[which][base + symbol]))
                out.put(more, n)


def encode(picture: np.ndarray, *, predictor: int | None = None, cross_colour: tuple[int, int, int] | None = None, subtract_green: bool = False, palette: bool | None = None, cache_bits: int = 0, references: bool = False, fixed: bool = False, block: int = 3) -> bytes:
    """One WebP file. `palette` None: whenever a picture has at most 16 colours. `fixed`: codes of one length."""
    height, width = picture.shape[:2]
    if not 0 < max(height, width) <= MOST_SIDE:
        raise ValueError("sides from 1 to 16384")
    pixels = picture.reshape(-1, 4)
    out = BitWriter()
    out.put(0x2F, 8)
    out.puts(np.array([width - 1, height - 1, int((pixels[:, 0] != 255).any()), 0]), np.array([14, 14, 1, 3]))
    if palette or palette is None and len(set(pixels[:64].reshape(-1, 4).view(np.uint32).reshape(-1).tolist())) <= 16:
        colours = np.unique(np.ascontiguousarray(pixels).view(">u4").reshape(-1))
        palette = len(colours) <= (256 if palette else 16)
    else:
        palette = False

    def header(kind: int, blocks: int | None = None) -> None:
        out.puts(np.array([1, kind]), np.array([1, 2]))
        if blocks is not None:
            out.put(blocks - 2, 3)

    w = width
    if palette:
        header(COLOUR_INDEXING)
        out.put(len(colours) - 1, 8)
        table = colours.astype(">u4").view(np.uint8).reshape(-1, 4)
        steps = table.copy()
        steps[1:] -= table[:-1]
        _write_image(out, steps, False)
        index = np.searchsorted(colours, np.ascontiguousarray(pixels).view(">u4").reshape(-1)).astype(np.uint8).reshape(height, width)
        n = _bundled(len(colours))
        w = (width + (1 << n) - 1) >> n
        index = np.pad(index, ((0, 0), (0, (w << n) - width))).reshape(height, w, 1 << n)
        pixels = np.zeros((height * w, 4), np.uint8)
        pixels[:, 0] = 255
        pixels[:, 2] = (index << ((8 >> n) * np.arange(1 << n)).astype(np.uint8)).sum(axis=2).reshape(-1)
    if subtract_green:
        header(SUBTRACT_GREEN)
        pixels = pixels.copy()
        pixels[:, 1] -= pixels[:, 2]
        pixels[:, 3] -= pixels[:, 2]
    across, down = (w + (1 << block) - 1) >> block, (height + (1 << block) - 1) >> block
    if cross_colour:
        header(CROSS_COLOUR, block)
        elements = np.zeros((down, across, 4), np.uint8)
        elements[:] = [255, *[c & 255 for c in cross_colour]]
        _write_image(out, elements.reshape(-1, 4), False)
        pixels = _cross_colour(pixels, w, elements, block, -1)
    if predictor is not None:
        header(PREDICTOR, block)
        # A mode from 0 to 13 for all blocks; -1 lets the blocks take turns.
        modes = np.full((down, across), predictor) if predictor >= 0 else np.arange(down * across).reshape(down, across) % 14
        shown = np.zeros((down * across, 4), np.uint8)
        shown[:, 0], shown[:, 2] = 255, modes.reshape(-1)
        _write_image(out, shown, False)
        pixels = _each_prediction(pixels, w, modes, block, -1)
    out.put(0, 1)
    _write_image(out, pixels, True, cache_bits, references, fixed)
    return wrapped(out.bytes())
