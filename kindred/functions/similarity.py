"""String similarities that Spark lacks, as kernels over Arrow batches."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Texts recur in pairs: so many results of each kernel are kept in a worker.
CACHED = 100_000


@lru_cache(CACHED)
def jaro_winkler(a, b) -> float:
    """Jaro-Winkler of two sequences: 0 if either is empty; up to four equal first elements count a tenth each, above 0.7 only."""
    if not len(a) or not len(b):
        return 0.0
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    free = [True] * len(b)
    left = []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == x:
                free[j] = False
                left.append(x)
                break
    if not left:
        return 0.0
    right = [y for y, unused in zip(b, free, strict=True) if not unused]
    swaps = sum(x != y for x, y in zip(left, right, strict=True)) // 2
    m = len(left)
    score = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if score > 0.7:
        start = 0
        for x, y in zip(a[:4], b[:4], strict=False):
            if x != y:
                break
            start += 1
        score += 0.1 * start * (1 - score)
    return score


@lru_cache(4096)
def _windows(i: int, most: int) -> np.ndarray:
    """For each reach up to `most`, the bits of the places that the i-th element of a text may match."""
    return np.array([((1 << min(64, i + r + 1)) - 1) & ~((1 << min(64, max(0, i - r))) - 1) for r in range(most + 1)], dtype=np.uint64)


class Many:
    """Texts in bytes to compare with one text at a time: where each byte value stands is a word of bits. Longer texts than its 64 are compared one by one."""

    def __init__(self, texts: list[bytes]):
        self.texts, n = texts, len(texts)
        self.lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.long = np.flatnonzero(self.lengths > 64)
        self.codes = np.frombuffer(b"".join(t[:64].ljust(64, b"\0") for t in texts), dtype=np.uint8).reshape(n, 64)
        self.held = np.arange(64) < self.lengths[:, None]
        self.places = {int(x): np.packbits((self.codes == x) & self.held, axis=1, bitorder="little").view("<u8").ravel() for x in np.unique(self.codes[self.held])}

    def jaro_winkler(self, a: bytes) -> np.ndarray:
        """The same doubles as `jaro_winkler` of `a` and each text."""
        if not a:
            return np.zeros(len(self.texts))
        lengths = np.minimum(self.lengths, 64)
        reach = np.maximum(np.maximum(lengths, len(a)) // 2 - 1, 0)
        used, hits = np.zeros(len(self.texts), dtype=np.uint64), []
        for i, x in enumerate(a):
            if x not in self.places:
                continue
            met = self.places[x] & _windows(i, max(64, len(a)) // 2)[reach] & ~used
            low = met & (~met + np.uint64(1))
            used |= low
            hits.append((x, low != 0))
        m, swaps = np.bitwise_count(used).astype(np.int64), np.zeros(len(self.texts), dtype=np.int64)
        for x, hit in hits:
            low = np.where(hit, used & (~used + np.uint64(1)), np.uint64(0))
            swaps += hit & (self.places[x] & low == 0)
            used ^= low
        swaps //= 2
        with np.errstate(divide="ignore", invalid="ignore"):
            score = (m / len(a) + m / lengths + (m - swaps) / m) / 3
        score[m == 0] = 0.0
        first = np.frombuffer(a[:4], dtype=np.uint8)
        start = np.cumprod((self.codes[:, : len(first)] == first) & self.held[:, : len(first)], axis=1).sum(axis=1)
        score = np.where(score > 0.7, score + 0.1 * start * (1 - score), score)
        for k in self.long:
            score[k] = jaro_winkler(a, self.texts[k])
        return score


#: Pairs that are compared at once, so that their tables stay in the processor's cache.
ROWS = 2048


def _coded(texts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(t.ljust(64, b"\0") for t in texts), dtype=np.uint8).reshape(len(texts), 64)


def _jaro_winkler_short(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Of each pair of texts of 1 to 64 bytes, by words of bits of the places in `b`."""
    x, y = _coded(a), _coded(b)
    n, m = (np.array([len(t) for t in texts], dtype=np.int64) for texts in (a, b))
    inside = ~np.uint64(0) >> (64 - m).astype(np.uint64)
    reach = np.maximum(np.maximum(n, m) // 2 - 1, 0)
    used, hit = np.zeros(len(a), dtype=np.uint64), np.zeros(x.shape, dtype=bool)
    for i in range(n.max()):
        places = np.packbits(y == x[:, i, None], axis=1, bitorder="little").view("<u8").ravel()
        met = places & _windows(i, 32)[reach] & inside & ~used
        met[n <= i] = 0
        low = met & (~met + np.uint64(1))
        used |= low
        hit[:, i] = low != 0
    taken = np.unpackbits(used.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
    found = np.bitwise_count(used).astype(np.int64)
    swaps = np.bincount(np.repeat(np.arange(len(a)), found), x[hit] != y[taken], len(a)).astype(np.int64) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        score = (found / n + found / m + (found - swaps) / found) / 3
    score[found == 0] = 0.0
    place = np.arange(4)
    start = np.cumprod((x[:, :4] == y[:, :4]) & (place < n[:, None]) & (place < m[:, None]), axis=1).sum(axis=1)
    return np.where(score > 0.7, score + 0.1 * start * (1 - score), score)


def jaro_winkler_rows(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """The same doubles as `jaro_winkler` of each pair; pairs that recur are compared once, longer texts than 64 bytes one by one."""
    known: dict = {}
    at = [known.setdefault(pair, len(known)) for pair in zip(a, b, strict=True)]
    pairs = list(known)
    score = np.zeros(len(pairs))
    short = []
    for k, (x, y) in enumerate(pairs):
        if x and y and x != y and len(x) <= 64 and len(y) <= 64:
            short.append(k)
        else:
            score[k] = jaro_winkler(x, y)
    for low in range(0, len(short), ROWS):
        rows = short[low : low + ROWS]
        score[rows] = _jaro_winkler_short([pairs[k][0] for k in rows], [pairs[k][1] for k in rows])
    return score[at]


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows (Hyyro, 2004)."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        met = row & places.get(y, 0)
        row = (row + met | row - met) & full
    return len(a) - row.bit_count()


@lru_cache(CACHED)
def ratio(a: str, b: str) -> float:
    """0 to 100: twice the common subsequence over both lengths; two empty texts are equal."""
    if a == b:
        return 100.0
    return 200.0 * common_length(a, b) / (len(a) + len(b))


@lru_cache(CACHED)
def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


@lru_cache(CACHED)
def token_set_ratio(a: str, b: str) -> float:
    """The best of comparing the shared tokens, and these with either side's others; 0 if either side has no token."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and not (only_x and only_y):
        return 100.0
    full_x, full_y = f"{both} {only_x}".strip(), f"{both} {only_y}".strip()
    best = ratio(full_x, full_y)
    return max(best, ratio(both, full_x), ratio(both, full_y)) if both else best


def _best_window(short: str, long: str) -> float:
    n, best = len(short), 0.0
    letters = set(short)
    for at in range(1 - n, len(long)):
        window = long[max(0, at) : at + n]
        if window and (window[-1] in letters or window[0] in letters):
            best = max(best, ratio(short, window))
            if best == 100.0:
                break
    return best


@lru_cache(CACHED)
def partial_ratio(a: str, b: str) -> float:
    """The shorter text against the best of all windows of its length, and of shorter ones at the ends."""
    if not a and not b:
        return 100.0
    if not a or not b:
        return 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    best = _best_window(short, long)
    return max(best, _best_window(long, short)) if len(a) == len(b) and best < 100.0 else best


@F.pandas_udf(T.DoubleType())
def jaro_winkler_bytes(a: pd.Series, b: pd.Series) -> pd.Series:
    """Over UTF-8 bytes, as the blocking score has it."""
    whole = (a.notna() & b.notna()).to_numpy()
    out = np.full(len(a), np.nan)
    out[whole] = jaro_winkler_rows([x.encode() for x in a[whole]], [y.encode() for y in b[whole]])
    return pd.Series(out)


# What the kernels give, in order.
FUZZY = ["name_token_sort_ratio", "name_token_set_ratio", "name_jaro_winkler", "address_token_set_ratio", "address_partial_ratio", "legal_name_similarity"]


@F.pandas_udf(T.StructType([T.StructField(c, T.DoubleType()) for c in FUZZY]))
def fuzzy_features(name_1: pd.Series, name_2: pd.Series, address_1: pd.Series, address_2: pd.Series, legal_1: pd.Series, legal_2: pd.Series) -> pd.DataFrame:
    """The six pair features that need string kernels, in one pass over normalised texts."""
    rows = [
        (
            token_sort_ratio(a, b),
            token_set_ratio(a, b),
            100.0 * (jaro_winkler(a, b) if a or b else 1.0),
            token_set_ratio(c, d),
            partial_ratio(c, d),
            ratio(e, f) if e and f else 0.0,
        )
        for a, b, c, d, e, f in zip(name_1, name_2, address_1, address_2, legal_1, legal_2, strict=True)
    ]
    return pd.DataFrame(rows, columns=FUZZY, dtype="float64")
