"""The command lines: python -m kindred.cli to train and predict, with validate or package first to check results or to zip them."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from kindred.operators import packaging, validation
from kindred.operators.model import Trees
from kindred.plans import linkage
from kindred.sources import tsv

# Fixed values, here and in the parsers: the interface's flags, defaults, files and layout of the archive.
RESULTS = ["output/matching_results.tsv", "output/candidate_pairs.tsv"]
SOURCES = "code/business_entity_resolution/src"
DOCUMENTS = ["code/business_entity_resolution/README.md", "code/business_entity_resolution/requirements.txt", "Documentation_template.md"]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--train-dir", default="dataset/train")
    p.add_argument("--test-dir", default="dataset/test")
    p.add_argument("--ground-truth", default="dataset/train/train_ground_truth.tsv")
    p.add_argument("--output-dir", default="output")
    p.add_argument("--n-splits", type=int, default=5)
    p.add_argument("--max-candidates", type=int, default=30)
    p.add_argument("--chunk-size", type=int, default=50_000, help="the most rows in an Arrow batch")
    p.add_argument("--max-training-groups", type=int, default=50_000)
    p.add_argument("--random-seed", type=int, default=42)
    p.add_argument("--iterations", type=int, default=50)
    p.add_argument("--report-sample-sensitivity", action="store_true")
    p.add_argument("--skip-validation", action="store_true")
    p.add_argument("--check-ids", action="store_true", help="validate also that all listed ids exist")
    p.add_argument("--one-line-records", action="store_true", help="no field holds a line end, so that files are read in parallel")
    return p


def validate(arguments: list[str], spark: SparkSession) -> int:
    p = argparse.ArgumentParser(prog="kindred.cli validate", description="Check result files; exit code 0 if they are valid.")
    p.add_argument("--matching", "-m", default=RESULTS[0])
    p.add_argument("--candidate", "-c", default=RESULTS[1])
    p.add_argument("--test-dir", "-t", default="dataset/test")
    p.add_argument("--check-ids", action="store_true")
    a = p.parse_args(arguments)
    return validation.exit_code(spark, a.matching, a.candidate, a.test_dir, check_ids=a.check_ids)


def package(arguments: list[str]) -> int:
    p = argparse.ArgumentParser(prog="kindred.cli package", description="Zip results, sources and documents.")
    p.add_argument("--team-name", required=True)
    p.add_argument("--output")
    p.add_argument("--root", default=".")
    a = p.parse_args(arguments)
    target = a.output or f"{a.root}/{a.team_name}_submission.zip"
    packaging.build_archive(a.root, target, RESULTS, SOURCES, DOCUMENTS)
    print(f"made {target}")
    return 0


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    given = sys.argv[1:] if arguments is None else arguments
    if given[:1] == ["package"]:
        return package(given[1:])
    a = None if given[:1] == ["validate"] else parser().parse_args(given)
    spark = spark or SparkSession.builder.appName("kindred").getOrCreate()
    if a is None:
        return validate(given[1:], spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(a.chunk_size))
    options = linkage.Options(
        a.train_dir, a.test_dir, a.ground_truth, a.output_dir, a.n_splits, a.max_candidates, a.max_training_groups, a.random_seed,
        a.skip_validation, a.check_ids, not a.one_line_records, Trees(a.iterations, seed=a.random_seed),
    )
    if a.report_sample_sensitivity:
        files = options.files()
        parts = tsv.read_entities(spark, files["train"][0], options.line_ends), tsv.read_vendors(spark, files["train"][1:], options.line_ends), tsv.read_truth(spark, files["truth"][0])
        linkage.sensitivity_report(*parts, options).show(truncate=False)
        return 0
    choice = linkage.run(spark, options)
    print(f"threshold {choice.threshold:.2f}, relative floor {choice.relative:.2f}: macro F0.5 {choice.selection_score:.6f} where chosen, {choice.heldout_score:.6f} held out")
    return 0


if __name__ == "__main__":
    sys.exit(main())
