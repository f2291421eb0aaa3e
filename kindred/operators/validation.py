"""Format rules of result files, each as a relational check."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindred.session import shuffled

ID = "source1_entity_id"
HEADERS = {"matched_entity_ids": [ID, "matched_entity_ids"], "candidate_entity_ids": [ID, "candidate_entity_ids"]}
SHOWN = 5
MESSAGES = {
    "malformed_row": "rows without a TAB",
    "duplicate_row": "source1_entity_id on more than one row",
    "duplicate_id": "an id repeated inside the list of",
    "self_match": "Source 1 ids in a list",
    "wrong_prefix": "ids that don't begin with S2- or S3-",
    "unknown_id": "ids that aren't in the Source 2 and 3 files",
    "missing_id": "required Source 1 ids without a row",
    "unexpected_id": "rows for Source 1 ids that aren't in the test set",
}


class NotText(ValueError):
    """A file isn't UTF-8 text."""


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """line (from 1), value: partitions of a file are in its order, so each one's lines are counted on from those before."""
    lines = spark.read.option("wholetext", False).text(path)
    order = Window.orderBy("_part")
    parts = lines.select("value", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at"))
    sizes = parts.groupBy("_part").agg(F.count("*").alias("n"), F.min("_at").alias("first"))
    before = sizes.select("_part", "first", F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return parts.join(F.broadcast(before), "_part").select((F.col("before") + F.col("_at") - F.col("first") + 1).alias("line"), "value")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The distinct first fields, trimmed, of all lines after the header that aren't blank: id."""
    lines = numbered_lines(spark, path).where("line > 1").where(F.trim("value") != "")
    return lines.select(F.trim(F.split("value", "\t", 2)[0]).alias("id")).distinct()


def result_rows(lines: DataFrame) -> DataFrame:
    """line, source1_entity_id, ids (as they are, nothing trimmed) of the rows with a TAB after the header."""
    rows = lines.where((F.col("line") > 1) & F.contains("value", F.lit("\t")))
    at = F.locate("\t", F.col("value"))
    rest = F.expr("substring(value, locate('\t', value) + 1)")
    ids = F.when(F.trim(F.regexp_replace(rest, r"\s", "")) == "", F.array().cast("array<string>")).otherwise(F.split(rest, ","))
    return rows.select("line", F.expr("substring(value, 1, locate('\t', value) - 1)").alias(ID), ids.alias("ids"), at.alias("_at")).drop("_at")


def rule_violations(rows: DataFrame, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Every broken rule with its offender: rule, offender. rows: source1_entity_id, ids; required, known: id."""
    each = rows.select(ID, F.explode("ids").alias("id"))
    good = F.col("id").rlike("^S[23]-")
    found = [
        rows.groupBy(ID).count().where("count > 1").select(F.lit("duplicate_row").alias("rule"), F.col(ID).alias("offender")),
        rows.where(F.size("ids") != F.size(F.array_distinct("ids"))).select(F.lit("duplicate_id"), ID).distinct(),
        each.where(F.col("id").startswith("S1-")).select(F.lit("self_match"), "id").distinct(),
        each.where(~F.col("id").startswith("S1-") & ~good).select(F.lit("wrong_prefix"), "id").distinct(),
        required.join(shuffled(rows.select(F.col(ID).alias("id"))), "id", "left_anti").select(F.lit("missing_id"), "id").distinct(),
        rows.select(F.col(ID).alias("id")).join(shuffled(required), "id", "left_anti").select(F.lit("unexpected_id"), "id").distinct(),
    ]
    if known is not None:
        found.append(each.where(good).join(shuffled(known), "id", "left_anti").select(F.lit("unknown_id"), "id").distinct())
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


def last_lists(rows: DataFrame) -> DataFrame:
    """The ids of each record's last row: source1_entity_id, id."""
    return rows.groupBy(ID).agg(F.max_by("ids", "line").alias("ids")).select(ID, F.explode("ids").alias("id"))


def not_among_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Records with a matched id that isn't among their candidates."""
    return last_lists(matches).join(shuffled(last_lists(candidates)), [ID, "id"], "left_anti").select(ID).distinct()


def _shown(df: DataFrame, column: str) -> tuple[int, str]:
    n = df.count()
    first = [r[0] for r in df.orderBy(column).limit(SHOWN).collect()]
    return n, ", ".join(first) + (", ..." if n > SHOWN else "")


def row_counts(rows: DataFrame) -> tuple[int, int]:
    """How many rows there are, and how many of them have an empty list."""
    r = rows.agg(F.count("*").alias("rows"), F.count_if(F.size("ids") == 0).alias("empty")).first()
    return r.rows, r.empty


def _check_file(spark: SparkSession, path: str, column: str, required: DataFrame, known: DataFrame | None, errors: list[str], counts: dict[str, tuple[int, int]] | None) -> DataFrame | None:
    name = os.path.basename(path)
    if not os.path.isfile(path):
        errors.append(f"{path}: no such file")
        return None
    lines = numbered_lines(spark, path)
    if lines.where(~F.expr("is_valid_utf8(value)")).limit(1).count():
        raise NotText(path)
    header = lines.where("line = 1").first()
    if header is None:
        errors.append(f"{name}: the file is empty")
        return None
    if "\t" not in header.value and "," in header.value:
        errors.append(f"{name}: the file is COMMA-separated; it must be TAB-separated")
        return None
    columns = [c.strip().lower() for c in header.value.split("\t")]
    if columns != HEADERS[column]:
        errors.append(f"{name}: the header is {columns} and must be {HEADERS[column]}")
        return None
    malformed = lines.where((F.col("line") > 1) & ~F.contains("value", F.lit("\t")) & (F.trim("value") != ""))
    if n := malformed.count():
        for r in malformed.orderBy("line").limit(SHOWN).collect():
            errors.append(f"{name}: malformed row without a TAB at line {r.line}: {r.value!r}")
        if n > SHOWN:
            errors.append(f"{name}: {n - SHOWN} more {MESSAGES['malformed_row']}")
    rows = result_rows(lines)
    if counts is not None:
        counts[name] = row_counts(rows)
    broken = rule_violations(rows, required, known).persist()
    for r in broken.groupBy("rule").count().collect():
        n, shown = _shown(broken.where(F.col("rule") == r.rule).select("offender"), "offender")
        errors.append(f"{name}: {MESSAGES[r.rule]}: {n}: {shown}")
    broken.unpersist()
    return rows


def validate(
    spark: SparkSession, matching_path: str, candidate_path: str | None, test_dir: str, check_ids: bool = False, counts: dict[str, tuple[int, int]] | None = None
) -> tuple[list[str], list[str]]:
    """Check both result files against the test records: errors that make them invalid, and warnings. counts, if given, gets each file's rows and empty lists."""
    held: list[DataFrame] = []
    try:
        return _validated(spark, matching_path, candidate_path, test_dir, check_ids, counts, held)
    finally:
        for df in held:
            df.unpersist()


def _validated(spark, matching_path, candidate_path, test_dir, check_ids, counts, held) -> tuple[list[str], list[str]]:
    errors: list[str] = []
    warnings: list[str] = []
    source = os.path.join(test_dir, "test_source1.tsv")
    if not os.path.isfile(source):
        return [f"{source}: no such file"], []
    required, known = read_ids(spark, source).persist(), None
    held.append(required)
    if check_ids:
        paths = [os.path.join(test_dir, f"test_source{k}.tsv") for k in (2, 3)]
        absent = [p for p in paths if not os.path.isfile(p)]
        if absent:
            warnings.append(f"{absent[0]}: no such file; whether ids exist isn't checked")
        else:
            known = read_ids(spark, paths[0]).union(read_ids(spark, paths[1])).distinct().persist()
            held.append(known)
    else:
        warnings.append("whether ids exist isn't checked (check_ids is off)")
    matches = _check_file(spark, matching_path, "matched_entity_ids", required, known, errors, counts)
    candidates = None
    if candidate_path and os.path.isfile(candidate_path):
        candidates = _check_file(spark, candidate_path, "candidate_entity_ids", required, known, errors, counts)
    elif candidate_path:
        warnings.append(f"{candidate_path}: no such file; candidates aren't checked")
    if matches is not None and candidates is not None:
        n, shown = _shown(not_among_candidates(matches, candidates), ID)
        if n:
            warnings.append(f"{n} records have matches that aren't among their candidates: {shown}")
    return errors, warnings


def exit_code(spark: SparkSession, *paths, **options) -> int:
    """0 if both files are valid, else 1; prints what was found."""
    counts: dict[str, tuple[int, int]] = {}
    try:
        errors, warnings = validate(spark, *paths, counts=counts, **options)
    except (NotText, OSError) as e:
        print(f"FAIL: not UTF-8 text, or not readable: {e}")
        return 1
    for name, (rows, empty) in counts.items():
        print(f"{name}: {rows} rows ({empty} empty, {rows - empty} non-empty)")
    for w in warnings:
        print(f"WARNING: {w}")
    for e in errors:
        print(f"ERROR: {e}")
    print("FAIL" if errors else "PASS")
    return int(bool(errors))
