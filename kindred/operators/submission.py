"""One output row for each record: its ids as a sorted, comma-separated list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators.selection import accepted
from kindred.session import shuffled

ID = "source1_entity_id"


def id_lists(ids: DataFrame, pairs: DataFrame, column: str, source_column: str = ID) -> DataFrame:
    """For each distinct entity_id, its distinct candidate ids, sorted; '' where it has none."""
    lists = pairs.groupBy(F.col(ID).alias(source_column)).agg(F.array_join(F.sort_array(F.collect_set("candidate_entity_id")), ",").alias(column))
    every = ids.select(F.col("entity_id").alias(source_column)).distinct()
    return every.join(shuffled(lists), source_column, "left").select(source_column, F.coalesce(column, F.lit("")).alias(column))


def candidate_submission(ids: DataFrame, pairs: DataFrame) -> DataFrame:
    return id_lists(ids, pairs, "candidate_entity_ids")


def threshold_submission(ids: DataFrame, pairs: DataFrame, threshold: float, source_column: str = ID, column: str = "matched_entity_ids") -> DataFrame:
    """Lists of the pairs with a probability of at least the threshold."""
    return id_lists(ids, pairs.where(F.col("probability") >= threshold), column, source_column)


def match_submission(ids: DataFrame, pairs: DataFrame, threshold: float, relative: float) -> DataFrame:
    """Lists of the pairs that pass the threshold and the relative floor."""
    return id_lists(ids, accepted(pairs, threshold, relative), "matched_entity_ids")
