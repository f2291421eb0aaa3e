"""Words, shingles and their 64-bit hashes over whole Arrow batches of text, by array arithmetic."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Every ASCII byte that is no letter.
NO_LETTER = np.arange(256) < 128
NO_LETTER[65:91] = NO_LETTER[97:123] = False
_BYTE = np.random.RandomState(20).randint(0, 2**32, 512).astype(np.uint64)
_BYTE = (_BYTE[:256] << np.uint64(32)) | _BYTE[256:]
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of MurmurHash3: every bit of the input moves every bit of the output."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 64)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for k, base in enumerate((BASE, inverse)):
            run = np.full(size, base, np.uint64)
            run[0] = 1
            _POWERS[k] = np.multiply.accumulate(run)
    return _POWERS[0], _POWERS[1]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column and where each text begins; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of about `most` bytes together; a longer text is alone. No text is split."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to
        at = to


def words(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased (A-Z) words between the bytes that are `apart`, by default ASCII white space.

    Returns 64-bit hashes, the number of words of each text, and where each word begins and ends.
    """
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64), none, none
    low = _LOWER[data]
    inside = ~apart[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < n]
    first[begins] = inside[begins]
    ends_at = begins[begins > 0] - 1
    last[ends_at] = inside[ends_at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[low] * up[:n], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    counts = np.diff(np.searchsorted(starts, offsets))
    return hashes, counts, starts, ends


def _factors(n: int) -> np.ndarray:
    """Odd numbers without a common pattern, one for each place."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * BASE) | np.uint64(1)


def grams(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each `width` neighbouring hashes, in order; the last width - 1 places are without meaning."""
    out = np.zeros(len(hashes), np.uint64)
    for k, factor in enumerate(_factors(min(width, len(hashes)))):
        out[: len(hashes) - k] += hashes[k:] * factor
    return mix(out)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text, the sorted distinct hashes of its `width`-word shingles; with fewer words, of the whole sequence; without words, none."""
    data, offsets = buffers(texts)
    for low, high in chunks(offsets):
        part = offsets[low : high + 1]
        hashes, counts, _, _ = words(data[part[0] : part[-1]], part - part[0])
        every = grams(hashes, width)
        at = 0
        for n in counts.tolist():
            if n >= width:
                yield np.unique(every[at : at + n - width + 1])
            elif n:
                short = hashes[at : at + n] * _factors(n)
                yield mix(short.sum(keepdims=True) + np.uint64(n))
            else:
                yield hashes[:0]
            at += n


BEGIN_WORD, END_WORD, SYMBOLS, SYMBOL_BITS = 256, 257, 258, 9


class Spelled:
    """Words as symbols: a begin, the lower-cased bytes, an end. `at` is each word's begin, `place` a symbol's place in its word."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        sizes = (ends - starts) + 2
        stops = np.cumsum(sizes)
        self.at = stops - sizes
        total = int(stops[-1]) if len(stops) else 0
        self.word = np.repeat(np.arange(len(starts), dtype=np.int32), sizes)
        self.place = (np.arange(total) - self.at[self.word]).astype(np.int32)
        self.symbols = np.zeros(total, np.uint64)
        inner = (self.place > 0) & (self.place < sizes[self.word] - 1)
        self.symbols[inner] = _LOWER[data[(starts[self.word] + self.place - 1)[inner]]]
        self.symbols[self.at] = BEGIN_WORD
        self.symbols[stops - 1] = END_WORD

    def codes(self, width: int) -> np.ndarray:
        """The `width` symbols up to each place as one number; of meaning where place + 1 >= width."""
        out = self.symbols.copy()
        for k in range(1, width):
            out[k:] |= self.symbols[:-k] << np.uint64(SYMBOL_BITS * k)
        return out


class Counter64:
    """Sorted keys with numbers, looked up by array."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values

    @classmethod
    def of(cls, keys: np.ndarray, weights: np.ndarray | None = None) -> Counter64:
        distinct, places = np.unique(keys, return_inverse=True)
        return cls(distinct, np.bincount(places, weights, len(distinct)).astype(np.float64))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, 0 where it is unknown."""
        if not len(self.keys):
            return np.zeros((len(keys), *self.values.shape[1:]))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        found = self.values[at]
        found[~known] = 0
        return found

    def known(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys


class Remembered:
    """Values of words by hash, kept from batch to batch of a task; at most `most` of them, then it begins anew."""

    def __init__(self, width: int, most: int = 1_000_000):
        self.table, self.width, self.most = Counter64(np.zeros(0, np.uint64), np.zeros((0, width))), width, most

    def __call__(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: np.ndarray, value) -> np.ndarray:
        """The value of each word; value(data, starts, ends) is asked once for each new one."""
        distinct, first, places = np.unique(hashes, return_index=True, return_inverse=True)
        new = ~self.table.known(distinct)
        if new.any():
            fresh = value(data, starts[first[new]], ends[first[new]])
            old = self.table if len(self.table.keys) + int(new.sum()) <= self.most else Counter64(np.zeros(0, np.uint64), np.zeros((0, self.width)))
            got = Counter64(distinct[new], fresh)
            here = self.table(distinct)
            here[new] = fresh
            keys = np.concatenate([old.keys, got.keys])
            order = np.argsort(keys, kind="stable")
            self.table = Counter64(keys[order], np.concatenate([old.values, got.values])[order])
        else:
            here = self.table(distinct)
        return here[places]
