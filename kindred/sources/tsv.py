"""Tab-separated entity tables, truth and results: explicit schemas, whole files in parallel."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.session import delete, shared_folder

ENTITY_COLUMNS = ["entity_id", "business_name", "business_address"]
TRUTH_COLUMNS = ["source1_entity_id", "matched_entity_ids"]


def require_columns(df: DataFrame, required: Iterable[str], label: str) -> None:
    """Raise ValueError with the sorted names that are missing."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{label} lacks columns: {', '.join(missing)}")


def resolve_path(path: str, nested: str = "student_resource") -> str:
    """The path if it exists, else the same below `nested` if that exists, else the path."""
    below = os.path.join(nested, path)
    return path if os.path.exists(path) or not os.path.exists(below) else below


def require_files(paths: Iterable[str]) -> None:
    for path in paths:
        if not os.path.isfile(path):
            raise FileNotFoundError(f"a required file is missing: {path}")


def read_tsv(spark: SparkSession, path: str, columns: list[str], wanted: list[str], line_ends: bool = True) -> DataFrame:
    """Text columns as they are: an empty field is '', NA is text, quoted fields may hold tabs, quotes and line ends.

    A file that may hold line ends in a field is read by one task; without `line_ends`, by as many as it has blocks.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.schema(schema).options(sep="\t", header=True, quote='"', escape='"', multiLine=line_ends, enforceSchema=True).csv(path)
    return raw.select([F.coalesce(c, F.lit("")).alias(c) for c in wanted])


def read_entities(spark: SparkSession, path: str, line_ends: bool = True) -> DataFrame:
    """Id, name and address of an entity table; its country isn't read."""
    return read_tsv(spark, path, [*ENTITY_COLUMNS, "country"], ENTITY_COLUMNS, line_ends)


def read_vendors(spark: SparkSession, paths: Iterable[str], line_ends: bool = True) -> DataFrame:
    """Several entity tables as one; repeated rows stay."""
    return reduce(DataFrame.unionByName, [read_entities(spark, p, line_ends) for p in paths])


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, TRUTH_COLUMNS, TRUTH_COLUMNS)


def write_tsv(df: DataFrame, path: str, single_file: bool = True) -> None:
    """With a header; empty text is an empty field. As one file for tools that expect one, else as a folder of parts.

    Parts are written by all tasks in the shared folder and joined byte by byte.
    """
    options = {"sep": "\t", "header": not single_file, "emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    if not single_file:
        df.write.mode("overwrite").options(**options).csv(path)
        return
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/kindred/{spark.sparkContext.applicationId}/parts-{uuid.uuid4().hex}"
    df.write.options(**options).csv(folder)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs_path = jvm.org.apache.hadoop.fs.Path
    source, target = fs_path(folder), fs_path(str(path))
    parts, fs = source.getFileSystem(conf), target.getFileSystem(conf)
    out = fs.create(target, True)
    try:
        out.write(bytearray(("\t".join(df.columns) + "\n").encode()))
        # Parts are numbered as the partitions are, so the rows keep their order.
        for name in sorted(s.getPath().getName() for s in parts.listStatus(source) if s.getPath().getName().startswith("part-")):
            part = parts.open(fs_path(source, name))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, conf, False)
            finally:
                part.close()
    finally:
        out.close()
    delete(spark, folder)
    checksum = fs_path(str(Path(path).parent / f".{Path(path).name}.crc"))
    if fs.exists(checksum):
        fs.delete(checksum, False)


def register(df: DataFrame, name: str) -> None:
    """Make a frame visible to SQL."""
    df.createOrReplaceTempView(name)
