"""Tab-separated files, the validator, the archive and the whole run."""

import zipfile

import pytest

from kindred import cli
from kindred.operators import packaging, validation
from kindred.operators.model import Trees
from kindred.plans import linkage
from kindred.sources import tsv


def test_entities_are_read_as_text(spark, tmp_path):
    path = tmp_path / "e.tsv"
    path.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tNA\t\tUS\nS1-2\t"a ""b""\tc"\t 5 \tDE\n', encoding="utf-8")
    assert [tuple(r) for r in tsv.read_entities(spark, str(path)).collect()] == [("S1-1", "NA", ""), ("S1-2", 'a "b"\tc', " 5 ")]
    assert tsv.read_vendors(spark, [str(path), str(path)]).count() == 4


def test_empty_lists_are_written_as_nothing(spark, tmp_path):
    df = spark.createDataFrame([("S1-1", ""), ("S1-2", "S2-1,S3-2")], "source1_entity_id string, matched_entity_ids string")
    path = tmp_path / "m.tsv"
    tsv.write_tsv(df.coalesce(1), str(path))
    assert path.read_text().splitlines() == ["source1_entity_id\tmatched_entity_ids", "S1-1\t", "S1-2\tS2-1,S3-2"]


def test_paths(tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    (tmp_path / "student_resource/x").mkdir(parents=True)
    assert tsv.resolve_path("x") == "student_resource/x" and tsv.resolve_path("y") == "y"
    with pytest.raises(FileNotFoundError):
        tsv.require_files(["y"])


@pytest.fixture
def results(tmp_path):
    (tmp_path / "test_source1.tsv").write_text("entity_id\tn\nS1-1\ta\nS1-2\tb\nS1-3\tc\n\n")
    (tmp_path / "test_source2.tsv").write_text("entity_id\tn\nS2-1\ta\n")
    (tmp_path / "test_source3.tsv").write_text("entity_id\tn\nS3-1\ta\n")

    def write(body, header="source1_entity_id\tmatched_entity_ids", name="m.tsv"):
        path = tmp_path / name
        path.write_bytes((header + "\n" + body).encode() if isinstance(body, str) else body)
        return str(path)

    return tmp_path, write


def test_valid_results_pass(spark, results):
    folder, write = results
    path = write("S1-1\tS2-1,S3-1\r\nS1-2\t\nS1-3\tS2-1\n\n")
    errors, warnings = validation.validate(spark, path, None, str(folder), check_ids=True)
    assert errors == [] and warnings == []
    assert validation.exit_code(spark, path, None, str(folder)) == 0


@pytest.mark.parametrize(
    "body, message",
    [
        ("S1-1\t\nS1-1\t\nS1-2\t\nS1-3\t\n", "more than one row"),
        ("S1-1\tS2-1,S2-1\nS1-2\t\nS1-3\t\n", "repeated inside"),
        ("S1-1\tS1-2\nS1-2\t\nS1-3\t\n", "Source 1 ids"),
        ("S1-1\tS2-1, S3-1\nS1-2\t\nS1-3\t\n", "don't begin"),
        ("S1-1\tS2-1,\nS1-2\t\nS1-3\t\n", "don't begin"),
        ("S1-1\tS2-9\nS1-2\t\nS1-3\t\n", "aren't in the Source 2"),
        ("S1-1\t\nS1-2\t\n", "without a row: 1: S1-3"),
        ("S1-1\t\nS1-2\t\nS1-3\t\nS1-4\t\n", "aren't in the test set: 1: S1-4"),
        ("S1-1\t\nno tab\nS1-2\t\nS1-3\t\n", "line 3"),
    ],
)
def test_each_broken_rule_is_an_error(spark, results, body, message):
    folder, write = results
    errors, _ = validation.validate(spark, write(body), None, str(folder), check_ids=True)
    assert len(errors) == 1 and message in errors[0]


def test_files_that_cannot_be_judged(spark, results):
    folder, write = results
    run = lambda path, candidates=None: validation.validate(spark, path, candidates, str(folder))
    assert "no such file" in run(str(folder / "none.tsv"))[0][0]
    assert "COMMA" in run(write("", "a,b"))[0][0]
    assert "header" in run(write("", "a\tb"))[0][0]
    (folder / "empty.tsv").write_text("")
    assert "empty" in run(str(folder / "empty.tsv"))[0][0]
    good = write("S1-1\tS2-1\nS1-2\t\nS1-3\t\n")
    assert any("no such file" in w for w in run(good, str(folder / "c.tsv"))[1])
    wide = write("S1-1\tS3-1\nS1-2\t\nS1-3\t\n", "source1_entity_id\tcandidate_entity_ids", "c.tsv")
    assert any("aren't among" in w for w in run(good, wide)[1])
    assert validation.exit_code(spark, write(b"source1_entity_id\tmatched_entity_ids\nS1-1\t\xff\xfe\n"), None, str(folder)) == 1
    assert validation.validate(spark, good, None, str(folder / "elsewhere"))[0]


def test_the_last_of_repeated_rows_counts(spark):
    rows = spark.createDataFrame([(1, "S1-1", ["S2-1"]), (2, "S1-1", ["S2-2"])], "line long, source1_entity_id string, ids array<string>")
    assert [tuple(r) for r in validation.last_lists(rows).collect()] == [("S1-1", "S2-2")]


def test_archive(tmp_path):
    for name in ("out/m.tsv", "out/c.tsv", "src/a.py", "README.md"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")
    target = str(tmp_path / "zip/all.zip")
    packaging.build_archive(str(tmp_path), target, ["out/m.tsv", "out/c.tsv"], "src", ["README.md"])
    assert sorted(zipfile.ZipFile(target).namelist()) == ["README.md", "out/c.tsv", "out/m.tsv", "src/a.py"]
    for lacking in (dict(results=["no.tsv"]), dict(source_folder="out"), dict(documents=["no.md"])):
        with pytest.raises(FileNotFoundError):
            packaging.build_archive(str(tmp_path), target, **({"results": ["out/m.tsv"], "source_folder": "src", "documents": ["README.md"]} | lacking))


def test_whole_run_from_files_to_files(spark, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    header = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
    for part in ("train", "test"):
        folder = tmp_path / "dataset" / part
        folder.mkdir(parents=True)
        for k in (1, 2, 3):
            rows = [f"S{k}-{i}\tName {i % 9} {'Inc' if k > 1 else ''}\t{i} Oak Street {i % 4}\tUS" for i in range(24)]
            (folder / f"{part}_source{k}.tsv").write_text(header + "\n".join(rows) + "\n")
    (tmp_path / "dataset/train/train_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{i}\tS2-{i},S3-{i}\n" for i in range(24)))
    with pytest.raises(FileNotFoundError):
        linkage.run(spark, linkage.Options(train_dir="elsewhere"))
    cli.main(["--n-splits", "2", "--iterations", "2", "--max-candidates", "6"], spark)
    lines = (tmp_path / "output/matching_results.tsv").read_text().splitlines()
    assert len(lines) == 25 and (tmp_path / "output/oof_predictions.tsv").exists()
    paths = [str(tmp_path / p) for p in ("output/matching_results.tsv", "output/candidate_pairs.tsv", "dataset/test")]
    assert validation.validate(spark, *paths, True) == ([], [])


def test_sensitivity_is_asked_for_by_flag(monkeypatch, spark):
    called = []
    monkeypatch.setattr(cli.linkage, "run", lambda *a: called.append("run") or linkage.Choice(0, 0, 0, 0))
    cli.main([], spark)
    assert called == ["run"] and not cli.parser().parse_args([]).report_sample_sensitivity
    assert Trees().iterations == 50


def test_counts_of_rows_and_the_first_malformed_lines(spark, results, capsys):
    folder, write = results
    path = write("S1-1\tS2-1\nS1-2\t\nS1-3\t \n" + "no tab\n" * 9)
    counts = {}
    errors, _ = validation.validate(spark, path, None, str(folder), counts=counts)
    assert counts == {"m.tsv": (3, 2)}
    assert sum("malformed row" in e for e in errors) == 5 and sum("4 more rows without a TAB" in e for e in errors) == 1
    assert validation.exit_code(spark, path, None, str(folder)) == 1
    assert "m.tsv: 3 rows (2 empty, 1 non-empty)" in capsys.readouterr().out


def test_commands(spark, results, tmp_path, monkeypatch, capsys):
    folder, write = results
    path = write("S1-1\tS2-1\nS1-2\tS3-7\nS1-3\t\n")
    given = ["validate", "-m", path, "-c", "none.tsv", "--test-dir", str(folder)]
    assert cli.main(given, spark) == 0 and "PASS" in capsys.readouterr().out
    assert cli.main([*given, "--check-ids"], spark) == 1 and "S3-7" in capsys.readouterr().out
    with pytest.raises(FileNotFoundError):
        cli.main(["package", "--team-name", "t", "--root", str(tmp_path)])
    for name in (*cli.RESULTS, f"{cli.SOURCES}/a/b.py", *cli.DOCUMENTS):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    assert cli.main(["package", "--team-name", "t", "--root", str(tmp_path)]) == 0
    assert sorted(zipfile.ZipFile(tmp_path / "t_submission.zip").namelist()) == sorted([*cli.RESULTS, f"{cli.SOURCES}/a/b.py", *cli.DOCUMENTS])


def test_one_file_of_many_parts_keeps_the_order(spark, tmp_path):
    rows = [(f"S1-{k}", "a\tb" if k == 5 else "") for k in range(40)]
    df = spark.createDataFrame(rows, "source1_entity_id string, matched_entity_ids string").repartitionByRange(7, "source1_entity_id").sortWithinPartitions("source1_entity_id")
    path = tmp_path / "m.tsv"
    for _ in range(2):
        tsv.write_tsv(df, str(path))
    back = tsv.read_tsv(spark, str(path), tsv.TRUTH_COLUMNS, tsv.TRUTH_COLUMNS)
    assert [tuple(r) for r in back.collect()] == sorted(rows) and sorted(p.name for p in tmp_path.iterdir()) == ["m.tsv"]
    tsv.write_tsv(df.limit(0), str(path))
    assert path.read_text() == "source1_entity_id\tmatched_entity_ids\n"
    plain = tmp_path / "p.tsv"
    plain.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join(f"S1-{k}\tn\ta\tc\n" for k in range(50)))
    assert tsv.read_entities(spark, str(plain), line_ends=False).count() == 50


def test_tables_of_the_run_are_below_one_folder_and_can_be_released(spark):
    from kindred import session

    table = session.settle(spark.range(5), "t")
    assert table.count() == 5 and spark.sparkContext.applicationId in table._kindred_path
    session.release(table)
    folder = spark._jvm.org.apache.hadoop.fs.Path(table._kindred_path)
    assert not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def test_equal_samples_are_trained_on_once(spark, monkeypatch):
    from types import SimpleNamespace

    from kindred.plans import linkage

    made = []
    frame = lambda n: SimpleNamespace(count=lambda: n)
    choice = SimpleNamespace(threshold=0.5, relative=0.9, selection_score=1.0, heldout_score=1.0)
    monkeypatch.setattr(linkage, "train", lambda source, vendors, truth, options, size: made.append(size) or SimpleNamespace(ids=frame(min(size, 30)), pairs=frame(7), choice=choice))
    report = linkage.sensitivity_report(spark.range(30), None, None, None, (20, 30, 40, 50)).collect()
    assert made == [20, 30]
    assert [tuple(r)[:3] for r in report] == [(20, 20, 7), (30, 30, 7), (40, 30, 7), (50, 30, 7)]
