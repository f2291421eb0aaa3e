"""Gapless ranks within groups, without one task for each group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def gapless(df: DataFrame, group: list[str], order: list[str], name: str, salts: int = 64) -> DataFrame:
    """Add `name`: a number from 0 without gaps within each value of `group`.

    The rows of a group are dealt by a hash of `order` to `salts` parts that are numbered apart, and
    each part starts after the counts of those before it. So the largest window holds about a
    `salts`-th of a group, and a group of a third of all rows doesn't land in one task. Rows that tie
    in all of `order` are interchangeable. `df` must give the same rows each time it is read.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    keys = [*group, "_salt"]
    counts = salted.groupBy(*keys).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    placed = salted.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    same = [placed[k].eqNullSafe(starts[k]) for k in keys]
    joined = placed.join(starts, same[0] if len(same) == 1 else _all(same))
    kept = [placed[c] for c in df.columns]
    return joined.select(*kept, (F.col("_start") + F.col("_place") - 1).cast("long").alias(name))


def _all(conditions):
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
