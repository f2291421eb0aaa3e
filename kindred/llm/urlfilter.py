"""Allow and block rules for URLs, held in cascades of Bloom filters that answer exactly for the corpus's keys."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.session import settle

MAX_LEVELS = 40
#: A byte of a filter holds so many bits, so that it is always a character of its own.
BYTE_BITS = 7


@dataclass
class Level:
    """One Bloom filter: `bits` places in `table`, and `hashes` places for a key."""

    bits: int
    hashes: int
    seed: int
    table: bytes

    def holds(self, key: Column) -> Column:
        table, found = F.lit(self.table), F.lit(True)
        for place in places(key, self.bits, self.hashes, self.seed):
            byte = F.ascii(F.substring(table, F.expr("1") + F.floor(place / BYTE_BITS).cast("int"), F.lit(1)).cast("string"))
            found = found & (F.call_function("getbit", byte, F.pmod(place, F.lit(BYTE_BITS)).cast("int")) == 1)
        return found


def places(key: Column, bits: int, hashes: int, seed: int) -> list[Column]:
    """Where a key's bits are: two 64-bit hashes, mixed (Kirsch and Mitzenmacher)."""
    first, second = F.xxhash64(key, F.lit(2 * seed)), F.xxhash64(key, F.lit(2 * seed + 1))
    return [F.pmod(F.pmod(first, F.lit(bits)) + F.lit(i) * F.pmod(second, F.lit(bits)), F.lit(bits)) for i in range(hashes)]


def _level(keys: DataFrame, count: int, rate: float, seed: int, max_bits: int) -> Level:
    """A filter of the one column `key`, for a rate of false positives. Only its bytes that have bits come to the driver."""
    bits = BYTE_BITS * max(1, math.ceil(-count * math.log(rate) / math.log(2) ** 2 / BYTE_BITS))
    if bits > max_bits:
        raise ValueError(f"{count} keys need a filter of {bits} bits; max_bits is {max_bits}")
    hashes = min(max(1, round(bits / max(count, 1) * math.log(2))), 12)
    place = keys.select(F.explode(F.array(*places(F.col("key"), bits, hashes, seed))).alias("p"))
    mask = F.expr(f"shiftleft(1, cast(p % {BYTE_BITS} as int))")
    found = place.groupBy(F.expr(f"p div {BYTE_BITS}").alias("at")).agg(F.bit_or(mask).alias("v")).toArrow()
    table = bytearray(bits // BYTE_BITS)
    for at, v in zip(found["at"].to_pylist(), found["v"].to_pylist(), strict=True):
        table[at] = v
    return Level(bits, hashes, seed, bytes(table))


def build_cascades(lists: dict[str, DataFrame], universe: DataFrame, rate: float = 0.01, max_bits: int = 1 << 26) -> dict[str, list[Level]]:
    """For each list, levels that tell its keys from all others in the universe, without error.

    lists, universe: one column `key` each; repeats and nulls don't matter. Level 0 encodes the listed
    keys. Each next one encodes those keys that the levels before it get wrong: keys of the universe
    that pass without being listed, then listed keys that pass among these, and so on until no key is
    wrong. The universe is read once, for the keys that pass some level 0, which are about `rate` of
    it; these are stored with the lists that they are in, found by grouping, and all later levels come
    from that small table. The filters are what the driver and each task hold: their bits are checked
    against `max_bits`, so a longer list needs a larger limit on purpose. An empty list has no levels.
    """
    own = {name: df.select("key").where(F.col("key").isNotNull()).distinct() for name, df in lists.items()}
    counts = {name: df.count() for name, df in own.items()}
    cascades = {name: [_level(own[name], counts[name], rate, 0, max_bits)] if counts[name] else [] for name in lists}
    in_none = [F.lit(False).alias(f"in_{name}") for name in lists]
    passing = universe.select("key").where(F.col("key").isNotNull())
    some = F.lit(False)
    for levels in cascades.values():
        for level in levels:
            some = some | level.holds(F.col("key"))
    tagged = passing.where(some).select("key", *in_none)
    for name, df in own.items():
        tagged = tagged.union(df.select("key", *[F.lit(other == name).alias(f"in_{other}") for other in lists]))
    small = settle(tagged.groupBy("key").agg(*[F.max(f"in_{name}").alias(f"in_{name}") for name in lists]), "keys")
    for name, levels in cascades.items():
        listed, wrong = F.col(f"in_{name}"), small
        while levels and len(levels) < MAX_LEVELS:
            # Odd levels encode keys that aren't listed, even ones listed keys, of those that pass all levels before.
            wrong = wrong.where(levels[-1].holds(F.col("key")))
            mine = wrong.where(listed if len(levels) % 2 == 0 else ~listed).select("key")
            count = mine.count()
            if not count:
                break
            levels.append(_level(mine, count, 0.5, len(levels), max_bits))
        else:
            if levels:
                raise ValueError("the cascade doesn't end")
    return cascades


def is_listed(key: Column, levels: list[Level]) -> Column:
    """Whether a key of the universe is listed: the number of levels that it passes is odd."""
    answer = F.lit(len(levels) % 2 == 1)
    for k in range(len(levels) - 1, -1, -1):
        answer = F.when(levels[k].holds(key), answer).otherwise(F.lit(k % 2 == 1))
    return answer


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty where the url is null or has no ://."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), upper, upper.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ? or #; empty where the url is null or has no ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """The rules that could fit: each end of the host at a dot, with each start of the path that is as long as some rule's path; the longest first, and of equally long ones the first as text."""
    labels = F.split(host, r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]), lambda p: p.isNotNull())
    both = F.flatten(F.transform(ends, lambda h: F.transform(starts, lambda p: F.struct((-F.length(h) - F.length(p)).alias("n"), F.concat(h, p).alias("key")))))
    return F.when(host != "", F.transform(F.array_sort(both), lambda x: x["key"])).otherwise(F.array().cast("array<string>"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], url: str = "url", rate: float = 0.01, max_bits: int = 1 << 26) -> DataFrame:
    """Add host, path, rule and verdict to every row.

    rules: (verdict, host and path), verdict allow or block; a rule's host is lower-cased as a url's
    is. A rule fits its host and all subdomains, if the path starts with the rule's; of those that
    fit, the longest text wins, and a rule with both verdicts blocks. Without one, rule is null and the
    verdict allow, since the cascades list nothing that fits. A url that is null or has no :// has an
    empty host and path, and no rule fits it. All candidate keys of all urls are the universe over
    which the cascade of each verdict is exact, so no page is joined with any rule; pages are read
    twice. Rows that repeat are judged each, and an empty table has no rows. A column of the input that
    is named like an added one is replaced.
    """
    spark = pages.sparkSession
    split = [(verdict, *text.partition("/")) for verdict, text in rules]
    lengths = sorted({len(slash + path) for _, _, slash, path in split})
    made = pages.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    keys = rule_keys(F.col("host"), F.col("path"), lengths)
    fixed = {v: [(_lowered(host) + slash + path,) for verdict, host, slash, path in split if verdict == v] for v in ("allow", "block")}
    lists = {v: spark.createDataFrame(texts, "key string") for v, texts in fixed.items()}
    cascades = build_cascades(lists, made.select(F.explode(keys).alias("key")), rate, max_bits)
    fits = F.get(F.filter(keys, lambda k: is_listed(k, cascades["allow"]) | is_listed(k, cascades["block"])), F.lit(0))
    return made.withColumn("rule", fits).withColumn("verdict", F.when(F.col("rule").isNotNull() & is_listed(F.col("rule"), cascades["block"]), "block").otherwise("allow"))


def _lowered(host: str) -> str:
    return "".join(c.lower() if c.isascii() else c for c in host)
