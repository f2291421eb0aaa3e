"""From raw documents to packed training sequences: each stage filters, cleans or packs all that the one before it kept.

All stages take null ids and null, empty and very long texts; repeated rows are rows of their own,
other columns are kept until packing, and an empty table gives an empty one. Stages that hand whole documents to
Python workers write what they return, since only then `settle` bounds the bytes that a worker gets at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import jaccard, packing, positional, pseudonyms, toxicity
from kindred.session import settle

#: SQL can't express the toxicity model, the pseudonyms and the token ids; the stages are tested one by one.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that the class-conditional models call toxic. Labels of a quarter of the ids stay unread.

    A text without words stays, equal texts go or stay together, and without labels of both classes all stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    train = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    return settle(toxicity.score_toxicity(docs, labels, train).where("predicted = 0").select(docs.columns), "stage")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near copies: five-word shingles, a similarity of 0.8 or more.

    Documents without words or without an id stay, and rows that repeat an id stay or go together.
    """
    return jaccard.one_of_each(docs, width=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that hold ten neighbouring words of a benchmark item, all of one of five to nine, or more than half of whose words stand in shorter ones.

    Documents without words or without an id stay, and so do all if the benchmark is empty.
    """
    return positional.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), width=10, short_share=0.5)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with pseudonyms for its personal numbers and dates under the key in the session's settings. Null and empty texts stay as they are."""
    return settle(pseudonyms.pseudonymise(docs, pseudonyms.key_of(spark)).select(docs.columns), "stage")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents in as few sequences of 4096 tokens as best fit finds. A null or empty text is a piece of its end id; pieces of one length are interchangeable."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("PII", hide_personal_data),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        docs = kept if hasattr(kept, "_kindred_path") else settle(kept, "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
