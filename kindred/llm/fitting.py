"""Fit a model on a bounded sample, in one task of the cluster, and hand it to all tasks as bytes."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row_each(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """One row of docs (doc_id, text and others) for each doc_id of the bounded table ids, with the columns of both; of rows that share an id, the first by text."""
    rows = docs.join(F.broadcast(ids), "doc_id")
    rest = [c for c in rows.columns if c != "doc_id"]
    return rows.groupBy("doc_id").agg(F.min(F.struct("text", *[c for c in rest if c != "text"])).alias("row")).select("doc_id", *[F.col(f"row.{c}").alias(c) for c in rest])


def fit_in_task(sample: DataFrame, fit: Callable[[pa.Table], object]) -> bytes | None:
    """The pickled result of `fit` on the sample's rows, in the order of a hash of their texts; None without rows. The driver never holds the sample."""
    names = sample.columns
    sample = sample.repartition(1).sortWithinPartitions(F.xxhash64("text"), *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if rows:
            model = fit(pa.Table.from_batches(rows).select(names).combine_chunks())
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model, 5)], pa.binary())], names=["model"])

    found = sample.mapInArrow(run, "model binary").collect()
    return bytes(found[0].model) if found else None
