"""Contiguous shards of the least possible largest size, over groups of copies that stay together."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.ranks import gapless
from kindred.session import settle

TOP_BITS = 16
STEP_BITS = 8
ROW_BYTES = 16


@dataclass
class Segments:
    """Neighbouring runs of the key order: a run has all keys whose upper bits, without `shift` lower ones, are `prefix`."""

    prefix: np.ndarray
    shift: np.ndarray
    total: np.ndarray
    groups: np.ndarray
    largest: int

    @property
    def first_key(self) -> np.ndarray:
        return self.prefix << self.shift

    @property
    def whole(self) -> np.ndarray:
        return self.groups <= 1


def _summary(groups: DataFrame, shift: int, inside: DataFrame | None = None) -> list:
    run = F.shiftright("key", shift)
    return (
        (inside if inside is not None else groups)
        .groupBy(run.alias("prefix"))
        .agg(F.sum("bytes").alias("total"), F.count("*").alias("groups"), F.max("bytes").alias("largest"))
        .collect()
    )


def _sorted(rows: list[tuple[int, int, int, int]], largest: int) -> Segments:
    rows.sort(key=lambda r: r[0] << r[1])
    columns = [np.array(c, dtype=np.int64) for c in zip(*rows, strict=True)] if rows else [np.zeros(0, np.int64)] * 4
    return Segments(*columns, largest=largest)


def forward(s: Segments, capacity: int, shards: int) -> list[int] | None:
    """Fill each shard as far as whole segments go; the segment at which each ends, or None where that needs more shards."""
    ends = np.concatenate([[0], np.cumsum(s.total)])
    at, cuts = 0, []
    for _ in range(shards):
        to = int(np.searchsorted(ends, ends[at] + capacity, "right")) - 1
        if to == at and at < len(s.total):
            return None
        cuts.append(to)
        at = to
    return cuts if at == len(s.total) else None


def backward(s: Segments, capacity: int, shards: int) -> list[int]:
    """The least segment at which each shard may end, so that those after it can hold the rest."""
    ends = np.concatenate([[0], np.cumsum(s.total)])
    at, starts = len(s.total), []
    for _ in range(shards):
        starts.append(at)
        at = int(np.searchsorted(ends, ends[at] - capacity, "left"))
    return starts[::-1]


def hopeful(s: Segments, capacity: int, shards: int) -> tuple[bool, set[int]]:
    """The same where a segment of many groups could be cut anywhere: False rules the capacity out. And the segments in doubt."""
    ends = np.concatenate([[0], np.cumsum(s.total)])
    low = high = 0
    place, doubt = 0, set()
    for _ in range(shards):
        to = place + capacity
        if to >= ends[-1]:
            return True, doubt
        high = int(np.searchsorted(ends, to, "right")) - 1
        place_next = int(ends[high]) if s.groups[high] <= 1 else to
        if place_next <= place:
            return False, doubt
        place = place_next
        low = min(max(low, int(np.searchsorted(ends, ends[low] + capacity, "right")) - 1), high)
        doubt.update(k for k in range(low, high + 1) if s.groups[k] > 1)
    return place >= ends[-1], doubt


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The least capacity with which `shards` runs of the key order hold all groups, and the key from which each shard after the first begins.

    groups: key long, bytes long, a row for each group. The driver gets sums of at most 2^16 runs of
    keys. Where a capacity can be neither confirmed nor ruled out with these, the runs at the cuts in
    doubt are split by 8 more bits of the key and summed anew, down to single groups; so the capacity
    is exact, and what the driver holds doesn't grow with the number of groups.
    """
    top = 64 - TOP_BITS
    rows = _summary(groups, top)
    if not rows:
        return 0, []
    largest = max(r.largest for r in rows)
    s = _sorted([(r.prefix, top, r.total, r.groups) for r in rows], largest)
    total = int(s.total.sum())
    low, high = max(largest, -(-total // shards)), max(largest, -(-total // shards)) + largest
    while low < high:
        middle = (low + high) // 2
        if forward(s, middle, shards) is not None:
            high = middle
            continue
        possible, doubt = hopeful(s, middle, shards)
        if not possible:
            low = middle + 1
            continue
        if not doubt:
            low = middle + 1
            continue
        s = _refined(groups, s, doubt)
    while (cuts := forward(s, high, shards)) is None:
        s = _refined(groups, s, hopeful(s, high, shards)[1])
    ends = np.concatenate([[0], np.cumsum(s.total)])
    least, at, keys = backward(s, high, shards), 0, []
    for k in range(1, shards):
        most = int(np.searchsorted(ends, ends[at] + high, "right")) - 1
        wish = total * k / shards
        near = int(np.searchsorted(ends, wish))
        near = near - 1 if near and wish - ends[near - 1] < ends[min(near, len(ends) - 1)] - wish else near
        at = min(max(near, least[k - 1], at), most)
        keys.append(int(s.first_key[at]) if at < len(s.total) else None)
    return high, [k for k in keys if k is not None]


def _refined(groups: DataFrame, s: Segments, doubt: set[int]) -> Segments:
    kept = [(int(s.prefix[k]), int(s.shift[k]), int(s.total[k]), int(s.groups[k])) for k in range(len(s.total)) if k not in doubt]
    for shift in {int(s.shift[k]) for k in doubt}:
        prefixes = [int(s.prefix[k]) for k in doubt if s.shift[k] == shift]
        finer = max(0, shift - STEP_BITS)
        inside = groups.where(F.shiftright("key", shift).isin(prefixes))
        kept += [(r.prefix, finer, r.total, r.groups if finer else 1) for r in _summary(groups, finer, inside)]
    return _sorted(kept, s.largest)


def shard_by_bytes(docs: DataFrame, shards: int = 40, salts: int = 64) -> DataFrame:
    """Put every row into one of `shards` shards of nearly equal bytes; rows of equal text stay together.

    docs: doc_id, text and any others, which are ignored. Returns doc_id, size (UTF-8 bytes plus 16;
    a null text has none), text_crc32 (of a null text: of no bytes), shard and slot, gapless from 0
    in each shard. Groups of equal text are ordered by a hash of the text, so that neighbours have
    nothing in common, and cut where the largest shard is as small as it can be; between the cuts
    that allow this, those nearest to equal sizes are taken. A group larger than an equal share has
    a shard that is as large. Texts whose 64-bit hashes agree would be kept together as well. Rows
    that repeat are rows of their own. An empty table has no rows.
    """
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.xxhash64("text").alias("key"),
    )
    groups = settle(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    _, keys = minimax_cuts(groups, shards)
    shard = F.lit(0)
    for k in keys:
        shard = shard + F.when(F.col("key") >= F.lit(k), 1).otherwise(0)
    return gapless(rows.withColumn("shard", shard.cast("int")), ["shard"], ["doc_id", "key"], "slot", salts)
