"""File readers, reports and logs."""

import pytest

from citymart.sources import landing, reports
from citymart.sources.files import entries


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def write(folder, **files):
    for name, text in files.items():
        (folder / name.replace("__", ".")).write_text(text)
    return str(folder)


def test_json_arrays_lines_and_empty(spark, tmp_path):
    path = write(
        tmp_path,
        a__json='[{"i": 1, "s": "x"}, {"i": 2}]',
        b__json='{"i": 3, "s": "y"}\n{"i": 4, "t": true}\n',
        c__json="[]",
        d__json='[\n {"i": 5}\n]\n',
        e__json='{\n "i": 6\n}\n',
    )
    got = landing.read_folder(spark, path)
    assert sorted(got.columns) == ["i", "s", "t"]
    assert rows(got.select("i", "s", "t")) == [
        (1, "x", None), (2, None, None), (3, "y", None), (4, None, True), (5, None, None), (6, None, None),
    ]


def test_csv_files_with_different_headers(spark, tmp_path):
    path = write(tmp_path, a__csv="i,v\n1,2\n", b__csv="v,i\n3.5,4\n", c__csv="i,name\n5,x\n", d__csv="i,v\n6,oops\n")
    got = landing.read_folder(spark, path)
    assert rows(got.select("i", "v", "name")) == [(1, "2", None), (4, "3.5", None), (5, None, "x"), (6, "oops", None)]


def test_number_in_one_file_and_text_in_another(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "j").mkdir()
    csv = write(tmp_path / "c", a__csv="id,v\n1,2\n")
    json = write(tmp_path / "j", a__json='[{"id": 2, "v": "two", "n": {"a": 1}}]')
    got = landing.read_files(spark, [e.path for e in entries(spark, csv)], [e.path for e in entries(spark, json)])
    assert rows(got.select("id", "v", "n.a")) == [(1, "2", None), (2, "two", 1)]


def test_folder_must_hold_one_kind(spark, tmp_path):
    with pytest.raises(ValueError, match="no CSV or JSON"):
        landing.read_folder(spark, str(tmp_path))
    with pytest.raises(ValueError, match="both"):
        landing.read_folder(spark, write(tmp_path, a__csv="i\n1\n", b__json="[]"))


def test_header_must_fit_the_schema(spark, tmp_path):
    path = write(tmp_path, a__csv="x,y\n1,2\n")
    assert rows(landing.read_csv(spark, path, "x int, y int")) == [(1, 2)]
    with pytest.raises(Exception, match="header"):
        landing.read_csv(spark, path, "x int, z int").collect()


@pytest.mark.parametrize("flip", [False, True])
def test_union_does_not_depend_on_order(spark, flip):
    frames = [
        spark.createDataFrame([(1, 2)], "a int, b int"),
        spark.createDataFrame([("x", 2.5)], "a string, c double"),
        spark.createDataFrame([(None, 7)], "c int, b bigint"),
        spark.createDataFrame([((1,),)], "s struct<p:int>"),
        spark.createDataFrame([(("z", 2),)], "s struct<p:string,q:int>"),
    ]
    got = landing.union_relaxed(frames[::-1] if flip else frames)
    assert rows(got.select("a", "b", "c", "s.p", "s.q")) == [
        ("1", 2, None, None, None),
        ("x", None, 2.5, None, None),
        (None, 7, None, None, None),
        (None, None, None, "1", None),
        (None, None, None, "z", 2),
    ]


def test_reports_newest_first(spark, tmp_path):
    import os

    for i, stamp in ((1, 1_000_000), (2, 2_000_000)):
        path = str(tmp_path / f"validation_report_{i}.json")
        reports.write_report(spark.range(i, i + 1).selectExpr("id", "struct(1 as x, 'é' as y) as n"), path)
        for entry in os.listdir(path):
            os.utime(os.path.join(path, entry), (stamp, stamp))
    got = reports.read_reports(spark, str(tmp_path / "*validation_report*")).collect()
    assert [r["id"] for r in got] == [2, 1]
    assert got[0]["n"]["y"] == "é" and "validation_report_2" in got[0]["file_path"]
    text = spark.read.text(str(tmp_path / "validation_report_1.json")).collect()
    assert len(text) > 3  # indented


def test_logs(spark, tmp_path):
    write(tmp_path, a__log="INFO start\nERROR Broken pipe\n", b__log="error: again\nfine\n", c__txt="ERROR no log\n")
    pattern = str(tmp_path / "*.log")
    assert {(r["name"], r["size"]) for r in reports.list_logs(spark, pattern).collect()} == {("a.log", 29), ("b.log", 18)}
    found = reports.search_logs(spark, pattern, "eRRor")
    assert {(r["name"], r["line"]) for r in found.collect()} == {("a.log", "ERROR Broken pipe"), ("b.log", "error: again")}
