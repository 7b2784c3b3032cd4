"""JSON through VARIANT, and files read as they arrive."""

import json
import os

import pytest

from citymart.sources import increments, landing, variants


def write(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / name.replace("__", ".")).write_text(text, encoding="utf-8")
    return str(folder)


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def test_types_in_common(spark, tmp_path):
    path = write(
        tmp_path,
        a__json='{"i": 1, "d": 1.5, "mix": 1, "n": {"a": 1}, "l": [1, 2.5], "none": null, "b": true}\n'
        '{"i": 3000000000, "d": 2, "mix": "x", "n": {"a": 2, "z": "é"}, "l": [], "a b": 1, "it\'s": 2, "dot.ted": 3}\n',
        b__json='[{"mix": {"deep": [1]}, "e": 1e3}, {"big": 123456789012345678901234}]',
    )
    df = landing.read_folder(spark, path)
    kinds = dict(df.dtypes)
    assert kinds == {
        "i": "bigint", "d": "double", "mix": "string", "n": "struct<a:bigint,z:string>", "l": "array<double>",
        "none": "string", "b": "boolean", "a b": "bigint", "it's": "bigint", "dot.ted": "bigint", "e": "double", "big": "double",
    }
    assert rows(df, "i", "d", "mix") == [(1, 1.5, "1"), (3000000000, 2.0, "x"), (None, None, '{"deep":[1]}'), (None, None, None)]
    second = [r for r in df.collect() if r["i"] == 3000000000][0]
    assert (second["a b"], second["it's"], second["dot.ted"], second["n"]["z"], second["l"]) == (1, 2, 3, "é", [])


def test_documents_lines_and_what_is_neither(spark, tmp_path):
    path = write(
        tmp_path,
        a__json='[\n {"i": 1},\n {"i": 2}\n]\n',
        b__json='{"i": 3}\nnot json\n\n{"i": 4}\n',
        c__json="",
        d__json='[]\n[{"i": 5}, {"i": 6}]\n7\n"text"\nnull\n[1, null, {"i": 8}]\n',
        e__json='{\n"i": 9, "n": [\n{"i": 0}\n]\n}',
        f__json='{"i": 10} {"i": 11}\n{"i": 12},\n',
    )
    df = landing.read_folder(spark, path)
    assert rows(df, "i", variants.CORRUPT) == sorted(
        [(i, None) for i in (1, 2, 3, 4, 5, 6, 8, 9)]
        + [(None, text) for text in ("not json", '{"i": 10} {"i": 11}', '{"i": 12},')],
        key=repr,
    )


def test_one_scan_of_files_of_lines(spark, tmp_path, monkeypatch):
    path = write(tmp_path, a__json='{"i": 1}\n{"i": 2}\n', b__json='[{"i": 3}]\n')
    staged = []
    real = variants.stage
    monkeypatch.setattr(variants, "stage", lambda df, name: staged.append(name) or real(df, name))
    df = landing.read_folder(spark, path)
    assert rows(df, "i") == [(1,), (2,), (3,)]
    assert staged == ["json-lines"]  # the raw files are read for this table only
    assert all("/json-lines-" in file for file in df.inputFiles())


def test_no_records(spark, tmp_path):
    with pytest.raises(ValueError, match="no CSV or JSON"):
        landing.read_folder(spark, write(tmp_path, a__json="[]", b__json="", c__json="\n\n"))


def test_csv_without_line_breaks_is_split(spark, tmp_path):
    path = write(tmp_path, a__csv="i,s\n1,x\n2,\"y, z\"\n")
    df = landing.read_folder(spark, path, multi_line=False)
    assert rows(df, "i", "s") == [(1, "x"), (2, "y, z")]


# ------------------------------------------------------------------ increments


def test_the_second_run_reads_only_the_new_file(spark, tmp_path):
    logs, target = tmp_path / "logs", str(tmp_path / "table")
    assert increments.ingested(spark, target).collect() == []
    write(logs, a__log="INFO start\nERROR one\n", x__txt="ERROR no log\n")
    assert increments.ingest_files(spark, str(logs), target, "*.log") == 2
    write(logs, b__log="error two\n", empty__log="")
    old = logs / "a.log"
    os.chmod(old, 0)  # whoever is not root could not read it again
    try:
        assert increments.ingest_files(spark, str(logs), target, "*.log") == 1
    finally:
        os.chmod(old, 0o644)
    assert increments.ingest_files(spark, str(logs), target, "*.log") == 0
    found = increments.search_ingested(spark, target, "eRRor")
    assert rows(found, "name", "line", "batch") == [("a.log", "ERROR one", 0), ("b.log", "error two", 1)]


def test_a_batch_that_runs_again_replaces_its_rows(spark, tmp_path, monkeypatch):
    logs, target = tmp_path / "logs", str(tmp_path / "table")
    write(logs, a__log="one\ntwo\n")
    write_batch, calls = increments.write_batch, []

    def broken(batch, path):
        calls.append(path)
        n = write_batch(batch, path)
        if len(calls) == 1:
            raise RuntimeError("driver lost after the write")
        return n

    monkeypatch.setattr(increments, "write_batch", broken)
    with pytest.raises(Exception, match="driver lost"):
        increments.ingest_files(spark, str(logs), target)
    assert increments.ingest_files(spark, str(logs), target) == 2
    assert len(calls) == 2 and calls[0] == calls[1]
    assert rows(increments.ingested(spark, target), "value") == [("one",), ("two",)]


def test_reports_as_they_come(spark, tmp_path):
    folder, target = tmp_path / "out", str(tmp_path / "table")
    for i, stamp in ((1, 1_000_000), (2, 2_000_000)):
        write(folder, **{f"r{i}__json": json.dumps({"run": i, "n": {"x": "é"}}, indent=1)})
        os.utime(folder / f"r{i}.json", (stamp, stamp))
        assert increments.ingest_files(spark, str(folder), target, whole=True) == 1
    got = increments.ingested_reports(spark, target, "run int, n struct<x: string>").collect()
    assert [(r["run"], r["n"]["x"]) for r in got] == [(2, "é"), (1, "é")]
