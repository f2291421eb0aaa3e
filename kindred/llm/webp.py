"""Lossless WebP (RFC 9649): a whole decoder over NumPy, and an encoder that can use each of its tools."""

from __future__ import annotations

import struct
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

# Fixed values of the format.
SIGNATURE = 0x2F
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, COLOUR_INDEXING = 0, 1, 2, 3
LENGTH_CODES, DISTANCE_CODES = 24, 40
LENGTH_ORDER = [17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15]
CACHE_FACTOR = 0x1E35A7BD
MAX_SIDE, MAX_COPY = 16384, 4096
# Near places by distance code, as steps to the left and up.
NEAR = [
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2),
    (0, 3), (3, 0), (1, 3), (-1, 3), (3, 1), (-3, 1), (2, 3), (-2, 3), (3, 2), (-3, 2), (0, 4), (4, 0),
    (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3), (2, 4), (-2, 4), (4, 2), (-4, 2), (0, 5), (3, 4),
    (-3, 4), (4, 3), (-4, 3), (5, 0), (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5), (-2, 5), (5, 2), (-5, 2),
    (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1),
    (2, 6), (-2, 6), (6, 2), (-6, 2), (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3),
    (0, 7), (7, 0), (1, 7), (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1), (4, 6), (-4, 6), (6, 4), (-6, 4),
    (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7), (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5),
    (8, 0), (4, 7), (-4, 7), (7, 4), (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6), (8, 3), (5, 7), (-5, 7),
    (7, 5), (-7, 5), (8, 4), (6, 7), (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
]

_REVERSED: dict[int, np.ndarray] = {}


def _reversed_bits(width: int) -> np.ndarray:
    if width not in _REVERSED:
        numbers, out = np.arange(1 << width), np.zeros(1 << width, np.int64)
        for k in range(width):
            out |= ((numbers >> k) & 1) << (width - 1 - k)
        _REVERSED[width] = out
    return _REVERSED[width]


class WebpError(ValueError):
    """The bytes are no lossless WebP image."""


class _Bits:
    """Reads numbers from the lowest bit on; bits behind the end are 0."""

    def __init__(self, data: bytes):
        self.data, self.at = data + bytes(24), 0
        #: The last code lengths read: their bits, how many, the lengths, whether they were counted, and where they end.
        self.table = None

    def peek(self, n: int) -> int:
        byte, shift = self.at >> 3, self.at & 7
        return (int.from_bytes(self.data[byte : byte + (n + 14 >> 3)], "little") >> shift) & ((1 << n) - 1)

    def read(self, n: int) -> int:
        byte, shift = self.at >> 3, self.at & 7
        self.at += n
        if byte + 24 > len(self.data):
            raise WebpError("the image ends too early")
        return (int.from_bytes(self.data[byte : byte + 5], "little") >> shift) & ((1 << n) - 1)


@dataclass
class _Prefix:
    """A prefix code: by the next `width` bits, a symbol and how many of the bits are its own."""

    lengths: np.ndarray
    width: int = 0
    symbols: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int32))
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(1, np.uint8))

    def __post_init__(self):
        used = np.flatnonzero(self.lengths)
        if len(used) <= 1:
            self.symbols = np.array([used[0] if len(used) else 0], np.int32)
            self.lists = None
            return
        sizes = self.lengths[used]
        order = np.argsort(sizes, kind="stable")
        used, sizes = used[order], sizes[order].astype(np.int64)
        self.width = int(sizes[-1])
        spans = 1 << (self.width - sizes)
        if int(spans.sum()) != 1 << self.width:
            raise WebpError("a prefix code isn't complete")
        places = _reversed_bits(self.width)
        self.symbols = np.repeat(used, spans)[places].astype(np.int32)
        self.sizes = np.repeat(sizes, spans)[places].astype(np.uint8)
        self.lists = None

    def read(self, bits: _Bits) -> int:
        if not self.width:
            return int(self.symbols[0])
        if self.lists is None:
            self.lists = (self.symbols.tolist(), self.sizes.tolist())
        k = bits.read(self.width)
        bits.at += self.lists[1][k] - self.width
        return self.lists[0][k]


@lru_cache(256)
def _outer_code(lengths: bytes) -> tuple[list[int], list[int], int]:
    code = _Prefix(np.frombuffer(lengths, np.uint8))
    return code.symbols.tolist(), code.sizes.tolist(), (1 << code.width) - 1


def _read_lengths(bits: _Bits, size: int) -> np.ndarray:
    lengths = np.zeros(size, np.uint8)
    if bits.read(1):
        two, wide = bits.read(1), bits.read(1)
        symbols = [bits.read(8 if wide else 1)] + ([bits.read(8)] if two else [])
        if max(symbols) >= size:
            raise WebpError("a symbol outside its alphabet")
        lengths[symbols] = 1
        return lengths
    start = bits.at
    if bits.table is not None and (size == len(bits.table[2]) or bits.table[3] and size >= bits.table[4]):
        pattern, n, known, _, top = bits.table
        if bits.peek(n) == pattern:
            bits.at += n
            lengths[:top] = known[:top]
            return lengths
    outer = np.zeros(19, np.uint8)
    shown = 4 + bits.read(4)
    packed = bits.peek(3 * shown)
    bits.at += 3 * shown
    for k in range(shown):
        outer[LENGTH_ORDER[k]] = packed >> (3 * k) & 7
    symbols, sizes, mask = _outer_code(outer.tobytes())
    counted = bits.read(1)
    left = 2 + bits.read(2 + 2 * bits.read(3)) if counted else size
    at, last, out = 0, 8, []
    held, have = 0, 0
    base = bits.at
    data, byte = bits.data, base >> 3
    held, have = int.from_bytes(data[byte : byte + 8], "little") >> (base & 7), 64 - (base & 7)
    byte += 8
    while at < size and left > 0:
        left -= 1
        if have < 32:
            held |= int.from_bytes(data[byte : byte + 8], "little") << have
            byte, have = byte + 8, have + 64
        k = held & mask
        s, used = symbols[k], sizes[k]
        held >>= used
        if s < 16:
            out.append(s)
            last = s or last
            at += 1
        else:
            if s == 16:
                run, value, extra = 3 + (held & 3), last, 2
            elif s == 17:
                run, value, extra = 3 + (held & 7), 0, 3
            else:
                run, value, extra = 11 + (held & 127), 0, 7
            held >>= extra
            used += extra
            out += [value] * run
            at += run
        have -= used
    bits.at = 8 * byte - have
    if at > size or bits.at > 8 * len(data):
        raise WebpError("code lengths run over their alphabet")
    lengths[:at] = out
    bits.table = None
    n = bits.at - start
    spent = bits.at
    bits.at = start
    bits.table = (bits.peek(n), n, lengths, counted, at)
    bits.at = spent
    return lengths


def _read_number(bits: _Bits, code: int) -> int:
    if code < 4:
        return code + 1
    extra = (code - 2) >> 1
    return ((2 + (code & 1)) << extra) + bits.read(extra) + 1


def _blocks(size: int, bits: int) -> int:
    return (size + (1 << bits) - 1) >> bits


def _read_image(bits: _Bits, width: int, height: int, main: bool) -> np.ndarray:
    """Colours (ARGB numbers) of an entropy-coded image."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    if cache_bits > 11:
        raise WebpError("the colour cache is too large")
    groups, meta_bits, meta = 1, 0, None
    if main and bits.read(1):
        meta_bits = bits.read(3) + 2
        meta = (_read_image(bits, _blocks(width, meta_bits), _blocks(height, meta_bits), False) >> 8) & 0xFFFF
        meta = meta.reshape(_blocks(height, meta_bits), -1)
        groups = int(meta.max()) + 1
    cache = 1 << cache_bits if cache_bits else 0
    sizes = (256 + LENGTH_CODES + cache, 256, 256, 256, DISTANCE_CODES)
    made: dict[bytes, _Prefix] = {}

    def prefix(n: int) -> _Prefix:
        lengths = _read_lengths(bits, n)
        key = lengths.tobytes().rstrip(b"\0")
        if key not in made:
            made[key] = _Prefix(lengths)
        return made[key]

    codes = [[prefix(n) for n in sizes] for _ in range(groups)]
    if groups == 1 and not codes[0][0].lengths[256:].any() and not cache:
        return _read_literals(bits, codes[0], width * height)
    return _read_symbols(bits, codes, width, height, cache_bits, meta, meta_bits)


def _read_literals(bits: _Bits, codes: list[_Prefix], count: int) -> np.ndarray:
    """All pixels of an image without copies or cache at once.

    For every bit of the data it is worked out where a pixel that began there would end; then the
    pixels are followed, sixteen at a time.
    """
    first = bits.at >> 3
    raw = np.frombuffer(bits.data, np.uint8)[first:].astype(np.int64)
    n = len(raw) - 3
    window = raw[:n] | raw[1 : n + 1] << 8 | raw[2 : n + 2] << 16
    window = (window[:, None] >> np.arange(8)).ravel()
    end = len(window) - 1
    places = np.arange(len(window))
    ends: dict[int, np.ndarray] = {}
    after = None
    for code in codes[:4]:
        if code.width:
            if id(code) not in ends:
                ends[id(code)] = np.minimum(places + code.sizes[window & ((1 << code.width) - 1)], end)
            step = ends[id(code)]
            after = step if after is None else step[after]
    start = bits.at - 8 * first
    if after is None:
        at = np.full(count, start)
    else:
        jump = after
        for _ in range(4):
            jump = jump[jump]
        rows = np.empty((count + 15) // 16, np.int64)
        p = start
        for k in range(len(rows)):
            rows[k] = p
            p = jump[p]
        at = np.empty((len(rows), 16), np.int64)
        for k in range(16):
            at[:, k] = rows
            rows = after[rows]
        at = at.ravel()[:count]
    channels = []
    for code in codes[:4]:
        if not code.width:
            channels.append(np.full(count, code.symbols[0], np.int64))
        else:
            channels.append(code.symbols[window[at] & ((1 << code.width) - 1)].astype(np.int64))
            at = ends[id(code)][at]
    if count:
        last = int(at[-1])
        if last > 8 * (len(bits.data) - 24 - first):
            raise WebpError("the image ends too early")
        bits.at = 8 * first + last
    green, red, blue, alpha = channels
    return alpha << 24 | red << 16 | green << 8 | blue


def _read_symbols(bits: _Bits, codes: list, width: int, height: int, cache_bits: int, meta, meta_bits: int) -> np.ndarray:
    """Pixel by pixel: literals, copies of earlier pixels, and colours from the cache."""
    count, out = width * height, []
    cache, shift = [0] * (1 << cache_bits), 32 - cache_bits
    group = codes[0]
    while len(out) < count:
        at = len(out)
        if meta is not None:
            group = codes[int(meta[(at // width) >> meta_bits, (at % width) >> meta_bits])]
        s = group[0].read(bits)
        if s < 256:
            red, blue, alpha = group[1].read(bits), group[2].read(bits), group[3].read(bits)
            new = [alpha << 24 | red << 16 | s << 8 | blue]
        elif s < 256 + LENGTH_CODES:
            length = _read_number(bits, s - 256)
            far = _read_number(bits, group[4].read(bits))
            if far > len(NEAR):
                far -= len(NEAR)
            else:
                x, y = NEAR[far - 1]
                far = max(1, x + y * width)
            if far > at or at + length > count:
                raise WebpError("a copy reaches outside the image")
            if far >= length:
                new = out[at - far : at - far + length]
            else:
                base = out[at - far :]
                new = (base * (length // far + 1))[:length]
        else:
            new = [cache[s - 256 - LENGTH_CODES]]
        out += new
        if cache_bits:
            for c in new:
                cache[(CACHE_FACTOR * c & 0xFFFFFFFF) >> shift] = c
    return np.array(out, np.int64)


def _channels(colours: np.ndarray) -> np.ndarray:
    """Colours as whole numbers to (..., 4) of red, green, blue, alpha."""
    return np.stack([colours >> 16 & 255, colours >> 8 & 255, colours & 255, colours >> 24 & 255], axis=-1)


def _colours(pixels: np.ndarray) -> np.ndarray:
    p = pixels.astype(np.int64)
    return p[..., 3] << 24 | p[..., 0] << 16 | p[..., 1] << 8 | p[..., 2]


def _predicted(mode: int, left, top, right, corner):
    """What a pixel is predicted as, from those to its left, above, above right and above left."""
    if mode == 0:
        out = np.zeros_like(top)
        out[..., 3] = 255
        return out
    if mode < 5:
        return (left, top, right, corner)[mode - 1]
    if mode == 5:
        return ((left + right) // 2 + top) // 2
    if mode < 10:
        a, b = ((left, corner), (left, top), (corner, top), (top, right))[mode - 6]
        return (a + b) // 2
    if mode == 10:
        return ((left + corner) // 2 + (top + right) // 2) // 2
    if mode == 11:
        nearer = np.abs(top - corner).sum(axis=-1, keepdims=True) < np.abs(left - corner).sum(axis=-1, keepdims=True)
        return np.where(nearer, left, top)
    if mode == 12:
        return np.clip(left + top - corner, 0, 255)
    mean = (left + top) // 2
    gap = mean - corner
    return np.clip(mean + np.sign(gap) * (np.abs(gap) // 2), 0, 255)


def _unpredict(pixels: np.ndarray, modes: np.ndarray, bits: int) -> np.ndarray:
    """Add to each pixel what was predicted; along a row one after the other where the left pixel matters."""
    height, width, _ = pixels.shape
    out = pixels.copy()
    out[0, 0] = (out[0, 0] + (0, 0, 0, 255)) & 255
    out[0] = np.cumsum(out[0], axis=0) & 255
    for y in range(1, height):
        row, above = out[y], out[y - 1]
        row[0] = (row[0] + above[0]) & 255
        kinds = modes[y >> bits]
        for block in range(len(kinds)):
            low, high = max(1, block << bits), min(width, (block + 1) << bits)
            if low >= high:
                continue
            mode = int(kinds[block])
            if mode in (0, 2, 3, 4, 8, 9):
                right = np.concatenate([above[low + 1 : high + 1], row[:1]])[: high - low]
                row[low:high] = (row[low:high] + _predicted(mode, None, above[low:high], right, above[low - 1 : high - 1])) & 255
            elif mode == 1:
                row[low:high] = (np.cumsum(row[low:high], axis=0) + row[low - 1]) & 255
            else:
                for x in range(low, high):
                    right = above[x + 1] if x + 1 < width else row[0]
                    row[x] = (row[x] + _predicted(mode, row[x - 1], above[x], right, above[x - 1])) & 255
    return out


def predictions(pixels: np.ndarray, modes: np.ndarray, bits: int) -> np.ndarray:
    """The same for all pixels of a known image."""
    height, width, _ = pixels.shape
    out = np.zeros_like(pixels)
    out[0, 0] = (0, 0, 0, 255)
    out[0, 1:] = pixels[0, :-1]
    out[1:, 0] = pixels[:-1, 0]
    if height > 1 and width > 1:
        above = pixels[:-1]
        right = np.concatenate([above[:, 2:], pixels[1:, :1]], axis=1)
        kinds = np.repeat(np.repeat(modes, 1 << bits, 0), 1 << bits, 1)[1:height, 1:width]
        for mode in np.unique(kinds):
            guess = _predicted(int(mode), pixels[1:, :-1], above[:, 1:], right, above[:, :-1])
            out[1:, 1:][kinds == mode] = guess[kinds == mode]
    return out


def _delta(factor: np.ndarray, colour: np.ndarray) -> np.ndarray:
    signed = lambda v: (v ^ 128) - 128
    return (signed(factor) * signed(colour)) >> 5


def _cross(pixels: np.ndarray, elements: np.ndarray, bits: int, sign: int) -> np.ndarray:
    """Add (sign 1) or take away (-1) what red and blue owe to green, and blue to red, by each block's factors."""
    height, width, _ = pixels.shape
    e = np.repeat(np.repeat(_channels(elements), 1 << bits, 0), 1 << bits, 1)[:height, :width]
    red_to_blue, green_to_blue, green_to_red = e[..., 0], e[..., 1], e[..., 2]
    out = pixels.copy()
    green = pixels[..., 1]
    out[..., 0] = (pixels[..., 0] + sign * _delta(green_to_red, green)) & 255
    true_red = out[..., 0] if sign > 0 else pixels[..., 0]
    out[..., 2] = (pixels[..., 2] + sign * (_delta(green_to_blue, green) + _delta(red_to_blue, true_red))) & 255
    return out


def uncrossed(pixels: np.ndarray, factors: tuple[int, int, int], bits: int) -> np.ndarray:
    """What is left of an image when red and blue are freed by one set of factors (red to blue, green to blue, green to red)."""
    return _cross(pixels, _elements(factors, pixels.shape, bits), bits, -1)


def _elements(factors: tuple[int, int, int], shape: tuple, bits: int) -> np.ndarray:
    red_to_blue, green_to_blue, green_to_red = (f & 255 for f in factors)
    return np.full((_blocks(shape[0], bits), _blocks(shape[1], bits)), 255 << 24 | red_to_blue << 16 | green_to_blue << 8 | green_to_red, np.int64)


def _bundle_bits(colours: int) -> int:
    return 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0


def _unbundled(indexed: np.ndarray, table: np.ndarray, width: int) -> np.ndarray:
    bits = _bundle_bits(len(table))
    green = indexed >> 8 & 255
    if bits:
        each = 8 >> bits
        shifts = np.arange(1 << bits) * each
        green = ((green[..., None] >> shifts) & ((1 << each) - 1)).reshape(green.shape[0], -1)[:, :width]
    return np.where(green < len(table), table[np.minimum(green, len(table) - 1)], 0)


def decode_image(data: bytes) -> np.ndarray:
    """Pixels of one lossless image, without its container: height x width x 4 of red, green, blue, alpha."""
    bits = _Bits(data)
    if bits.read(8) != SIGNATURE:
        raise WebpError("not a lossless image")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise WebpError("an unknown version")
    undo, now = [], width
    while bits.read(1):
        kind = bits.read(2)
        if kind in {u[0] for u in undo}:
            raise WebpError("a transform occurs twice")
        if kind in (PREDICTOR, CROSS_COLOUR):
            size = bits.read(3) + 2
            undo.append((kind, size, _read_image(bits, _blocks(now, size), _blocks(height, size), False).reshape(_blocks(height, size), -1), now))
        elif kind == SUBTRACT_GREEN:
            undo.append((kind, 0, None, now))
        else:
            n = bits.read(8) + 1
            table = np.cumsum(_channels(_read_image(bits, n, 1, False)), axis=0) & 255
            undo.append((kind, 0, _colours(table), now))
            now = _blocks(now, _bundle_bits(n))
    colours = _read_image(bits, now, height, True).reshape(height, now)
    for kind, size, extra, was in reversed(undo):
        if kind == COLOUR_INDEXING:
            colours = _unbundled(colours, extra, was)
            continue
        pixels = _channels(colours)
        if kind == SUBTRACT_GREEN:
            pixels[..., 0] = (pixels[..., 0] + pixels[..., 1]) & 255
            pixels[..., 2] = (pixels[..., 2] + pixels[..., 1]) & 255
        elif kind == CROSS_COLOUR:
            pixels = _cross(pixels, extra, size, 1)
        else:
            pixels = _unpredict(pixels, extra >> 8 & 255, size)
        colours = _colours(pixels)
    return _channels(colours).astype(np.uint8)


def images_of(data: bytes):
    """Pixels of each file in a run of WebP files."""
    at = 0
    while at < len(data):
        if data[at : at + 4] != b"RIFF" or data[at + 8 : at + 12] != b"WEBP":
            raise WebpError("not a WebP file")
        stop = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
        chunk, found = at + 12, None
        while chunk + 8 <= min(stop, len(data)):
            name, size = data[chunk : chunk + 4], int.from_bytes(data[chunk + 4 : chunk + 8], "little")
            if name == b"VP8L":
                found = data[chunk + 8 : chunk + 8 + size]
                if len(found) < size:
                    raise WebpError("the file ends too early")
            chunk += 8 + size + (size & 1)
        if found is None:
            raise WebpError("no lossless image in the file")
        try:
            yield decode_image(found)
        except (IndexError, ValueError, struct.error) as e:
            raise e if isinstance(e, WebpError) else WebpError("the image is broken") from e
        at = stop + (stop & 1)


@dataclass
class Tools:
    """What the encoder uses. modes: a predictor for each block, or one for all; factors: cross-colour (red to blue, green to blue, green to red)."""

    palette: bool = False
    subtract_green: bool = False
    modes: np.ndarray | int | None = None
    factors: tuple[int, int, int] | None = None
    block_bits: int = 4
    copies: bool = False
    cache_bits: int = 0
    meta_bits: int = 0


class _Out:
    """Writes numbers of at most 48 bits from the lowest bit on; all are packed at the end."""

    def __init__(self):
        self.parts, self.values, self.sizes = [], [], []

    def put(self, value: int, size: int) -> None:
        self.values.append(value)
        self.sizes.append(size)

    def many(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.parts += [(np.array(self.values, np.uint64), np.array(self.sizes, np.int64)), (values.astype(np.uint64), sizes)]
        self.values, self.sizes = [], []

    def data(self) -> bytes:
        self.many(np.zeros(0, np.uint64), np.zeros(0, np.int64))
        values, sizes = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        stops = np.cumsum(sizes)
        total = int(stops[-1])
        starts = stops - sizes
        word, shift = starts >> 6, (starts & 63).astype(np.uint64)
        out = np.zeros((total >> 6) + 2, np.uint64)
        firsts = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
        out[word[firsts]] = np.add.reduceat(values << shift, firsts)
        over = (starts & 63) + sizes > 64
        out[word[over] + 1] += values[over] >> (np.uint64(64) - shift[over])
        return out.tobytes()[: (total + 7) >> 3]


def code_lengths(counts: np.ndarray, limit: int = 12) -> np.ndarray:
    """Lengths of a complete prefix code near the entropy: Shannon's, with what they leave over given to the shortest that can use it."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    share = len(used) / (1 << (limit - 1))
    p = (1 - share) * counts[used] / counts[used].sum() + share / len(used)
    sizes = np.maximum(1, np.ceil(-np.log2(p))).astype(int)
    order = np.argsort(sizes, kind="stable")
    listed = sizes[order].tolist()
    left = (1 << limit) - sum(1 << (limit - s) for s in listed)
    while left:
        for k, s in enumerate(listed):
            gain = 1 << (limit - s)
            if s > 1 and gain <= left:
                listed[k] -= 1
                left -= gain
    lengths[used[order]] = listed
    return lengths


def _codes(lengths: np.ndarray) -> np.ndarray:
    """The bits of each symbol, the first to be read lowest."""
    out = np.zeros(len(lengths), np.int64)
    used = np.flatnonzero(lengths)
    if len(used) <= 1:
        return out
    order = used[np.argsort(lengths[used], kind="stable")]
    sizes = lengths[order].astype(np.int64)
    top = int(sizes[-1])
    starts = np.concatenate([[0], np.cumsum(1 << (top - sizes))[:-1]])
    out[order] = _reversed_bits(top)[starts]
    return out


#: One code for all code lengths: those that are rare in practice have five bits, the others four.
_OUTER_SIZES = [5 if k in (1, 2, 13, 14, 15, 16) else 4 for k in range(19)]
_OUTER_BITS = _codes(np.array(_OUTER_SIZES, np.uint8)).tolist()


def _put_lengths(out: _Out, lengths: np.ndarray) -> None:
    used = np.flatnonzero(lengths)
    if len(used) <= 1 and (not len(used) or used[0] < 256):
        symbol = int(used[0]) if len(used) else 0
        out.put(1, 1)
        out.put(0, 1)
        out.put(symbol > 1, 1)
        out.put(symbol, 8 if symbol > 1 else 1)
        return
    runs = []
    at = 0
    for k in used.tolist():
        gap = k - at
        while gap:
            if gap < 3:
                runs.append((0, 0, 0))
                gap -= 1
            elif gap < 11:
                runs.append((17, gap - 3, 3))
                gap = 0
            else:
                step = min(gap, 138)
                runs.append((18, step - 11, 7))
                gap -= step
        runs.append((int(lengths[k]), 0, 0))
        at = k + 1
    out.put(0, 1)
    out.put(19 - 4, 4)
    for k in LENGTH_ORDER:
        out.put(_OUTER_SIZES[k], 3)
    rest = len(lengths) > at
    out.put(rest, 1)
    if rest:
        n = len(runs) - 2
        wide = max(0, (max(n.bit_length(), 2) - 1) // 2)
        out.put(wide, 3)
        out.put(n, 2 + 2 * wide)
    for symbol, extra, size in runs:
        out.put(_OUTER_BITS[symbol] | extra << _OUTER_SIZES[symbol], _OUTER_SIZES[symbol] + size)


def _number(value: int) -> tuple[int, int, int]:
    """Prefix code, extra bits and their number, of a length or distance."""
    if value <= 4:
        return value - 1, 0, 0
    x = value - 1
    high = x.bit_length() - 1
    return 2 * high + (x >> (high - 1) & 1), x & ((1 << (high - 1)) - 1), high - 1


def _symbols(colours: list[int], width: int, copies: bool, cache_bits: int) -> list[tuple]:
    """Literals (colour,), copies (length, distance code) and cache entries (index, None, None), greedily."""
    near = {}
    for k, (x, y) in enumerate(NEAR):
        near.setdefault(max(1, x + y * width), k + 1)
    last, out, at, n = {}, [], 0, len(colours)
    cache, shift = [0] * (1 << cache_bits), 32 - cache_bits

    def note(k):
        if cache_bits:
            cache[(CACHE_FACTOR * colours[k] & 0xFFFFFFFF) >> shift] = colours[k]
        if copies and k + 1 < n:
            last[(colours[k], colours[k + 1])] = k

    while at < n:
        start = last.get((colours[at], colours[at + 1])) if copies and at + 1 < n else None
        length = 0
        if start is not None:
            while at + length < n and length < MAX_COPY and colours[start + length] == colours[at + length]:
                length += 1
        if length >= 3:
            far = at - start
            out.append((length, near.get(far, far + len(NEAR))))
            for k in range(at, at + length):
                note(k)
            at += length
            continue
        slot = (CACHE_FACTOR * colours[at] & 0xFFFFFFFF) >> shift if cache_bits else 0
        out.append((slot, None, None) if cache_bits and cache[slot] == colours[at] else (colours[at],))
        note(at)
        at += 1
    return out


def _put_image(out: _Out, colours: np.ndarray, main: bool, tools: Tools) -> None:
    height, width = colours.shape
    flat = colours.ravel()
    out.put(tools.cache_bits > 0, 1)
    if tools.cache_bits:
        out.put(tools.cache_bits, 4)
    owner = np.zeros(len(flat), np.int64)
    groups = 1
    if main:
        out.put(tools.meta_bits > 0, 1)
        if tools.meta_bits:
            out.put(tools.meta_bits - 2, 3)
            blocks = np.arange(_blocks(height, tools.meta_bits) * _blocks(width, tools.meta_bits)).reshape(_blocks(height, tools.meta_bits), -1)
            blocks %= 7
            groups = int(blocks.max()) + 1
            _put_image(out, blocks << 8 | 255 << 24, False, Tools())
            owner = np.repeat(np.repeat(blocks, 1 << tools.meta_bits, 0), 1 << tools.meta_bits, 1)[:height, :width].ravel()
    size = 256 + LENGTH_CODES + (1 << tools.cache_bits if tools.cache_bits else 0)
    if not tools.copies and not tools.cache_bits and groups == 1:
        channels = [flat >> 8 & 255, flat >> 16 & 255, flat & 255, flat >> 24 & 255]
        # One code for all channels where none is constant: cheaper to make, and text has no channels.
        counts = [np.bincount(c, minlength=256) for c in channels]
        if all((c > 0).sum() > 1 for c in counts):
            shared = code_lengths(sum(counts))
            lengths = [shared] * 4
        else:
            lengths = [code_lengths(c) for c in counts]
        mark = len(out.values)
        _put_lengths(out, np.concatenate([lengths[0], np.zeros(size - 256, np.uint8)]))
        for before, own in zip(lengths, lengths[1:], strict=False):
            if own is before and not own[255]:
                out.values += out.values[mark:]
                out.sizes += out.sizes[mark:]
                mark += (len(out.values) - mark) // 2
            else:
                mark = len(out.values)
                _put_lengths(out, own)
        _put_lengths(out, np.zeros(DISTANCE_CODES, np.uint8))
        made = {id(own): (_codes(own), own.astype(np.int64) * (np.count_nonzero(own) > 1)) for own in lengths}
        value, width = np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int64)
        for own, c in zip(lengths, channels, strict=True):
            codes, sizes = made[id(own)]
            value |= codes[c] << width
            width += sizes[c]
        out.many(value, width)
        return
    listed, at, steps = _symbols(flat.tolist(), width, tools.copies, tools.cache_bits), 0, []
    counts = [[np.zeros(n, np.int64) for n in (size, 256, 256, 256, DISTANCE_CODES)] for _ in range(groups)]
    for s in listed:
        g = int(owner[at])
        if len(s) == 1:
            c = s[0]
            parts = [(0, c >> 8 & 255, 0, 0), (1, c >> 16 & 255, 0, 0), (2, c & 255, 0, 0), (3, c >> 24 & 255, 0, 0)]
        elif len(s) == 2:
            a, b = _number(s[0]), _number(s[1])
            parts = [(0, 256 + a[0], a[1], a[2]), (4, *b)]
        else:
            parts = [(0, 256 + LENGTH_CODES + s[0], 0, 0)]
        for code, symbol, _, _ in parts:
            counts[g][code][symbol] += 1
        steps.append((g, parts))
        at += s[0] if len(s) == 2 else 1
    lengths = [[code_lengths(c) for c in five] for five in counts]
    for five in lengths:
        for own in five:
            _put_lengths(out, own)
    codes = [[_codes(own).tolist() for own in five] for five in lengths]
    sizes = [[(own.astype(int) * int((own > 0).sum() > 1)).tolist() for own in five] for five in lengths]
    values, widths = [], []
    for g, parts in steps:
        for code, symbol, extra, more in parts:
            values += (codes[g][code][symbol], extra)
            widths += (sizes[g][code][symbol], more)
    out.many(np.array(values, np.int64), np.array(widths, np.int64))


def encode_image(pixels: np.ndarray, tools: Tools = Tools()) -> bytes:
    """One lossless image, without container, of height x width x 4 samples (red, green, blue, alpha)."""
    height, width, _ = pixels.shape
    if not (0 < width <= MAX_SIDE and 0 < height <= MAX_SIDE):
        raise ValueError(f"an image of {width} x {height} isn't possible")
    out = _Out()
    for value, size in ((SIGNATURE, 8), (width - 1, 14), (height - 1, 14), (1, 1), (0, 3)):
        out.put(value, size)
    own = pixels.astype(np.int64)
    plain = Tools()
    if tools.subtract_green:
        out.put(1 | SUBTRACT_GREEN << 1, 3)
        own[..., 0] = (own[..., 0] - own[..., 1]) & 255
        own[..., 2] = (own[..., 2] - own[..., 1]) & 255
    shape = (_blocks(height, tools.block_bits), _blocks(width, tools.block_bits))
    if tools.modes is not None:
        modes = np.broadcast_to(np.asarray(tools.modes, np.int64), shape)
        out.put(1 | PREDICTOR << 1 | (tools.block_bits - 2) << 3, 6)
        _put_image(out, modes << 8 | 255 << 24, False, plain)
        own = (own - predictions(own, modes, tools.block_bits)) & 255
    if tools.factors is not None:
        elements = _elements(tools.factors, own.shape, tools.block_bits)
        out.put(1 | CROSS_COLOUR << 1 | (tools.block_bits - 2) << 3, 6)
        _put_image(out, elements, False, plain)
        own = _cross(own, elements, tools.block_bits, -1)
    colours = _colours(own)
    if tools.palette:
        table, index = np.unique(colours, return_inverse=True)
        if len(table) > 256:
            raise ValueError("a palette has at most 256 colours")
        out.put(1 | COLOUR_INDEXING << 1 | (len(table) - 1) << 3, 11)
        steps = _channels(table)
        steps[1:] -= steps[:-1].copy()
        _put_image(out, _colours(steps & 255)[None], False, plain)
        index = index.reshape(height, width)
        bits = _bundle_bits(len(table))
        wide = _blocks(width, bits)
        padded = np.zeros((height, wide << bits), np.int64)
        padded[:, :width] = index
        shifts = np.arange(1 << bits) * (8 >> bits)
        colours = (padded.reshape(height, wide, 1 << bits) << shifts).sum(axis=-1) << 8 | 255 << 24
    out.put(0, 1)
    _put_image(out, colours, True, tools)
    return out.data()


def file_of(image: bytes) -> bytes:
    """A WebP file with one lossless image."""
    pad = b"\0" * (len(image) & 1)
    return b"RIFF" + struct.pack("<I", 12 + len(image) + len(pad)) + b"WEBPVP8L" + struct.pack("<I", len(image)) + image + pad
