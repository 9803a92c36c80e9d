"""Deliveries, versions and table exports where a load could lose or keep wrong rows."""

from __future__ import annotations

import pytest

from starmill.operators.dimensions import flatten_chain
from starmill.sources import (
    FileLedger,
    Tables,
    clear_scratch,
    delivery_names,
    read_delimited,
    read_table_export,
    scratch,
    written,
)
from starmill.sources.delimited import LINE, REASON, SOURCE_PATH
from starmill.streaming import load_arrived_files, load_changed_files, load_new_files

NAMES = ["COD. UF", "COD. MUNIC", "POPULAÇÃO"]


def write(path, text):
    path.write_text(text, encoding="utf-8")


def test_export_by_header_name(spark, tmp_path):
    write(tmp_path / "a.csv", 'ESTIMATIVAS;;;;\nUF;COD. UF;COD. MUNIC;NOME;POPULAÇÃO\nSP;35;15;"A; B";1.234 (3)\nRJ;33;16;C;\nnote;;;;\n')
    write(tmp_path / "b.csv", "TITLE\nPOPULAÇÃO;COD. MUNIC;COD. UF\n7;8;9\n")
    read = read_table_export(spark, str(tmp_path), NAMES).select([f"`{n}`" for n in NAMES])
    assert sorted(tuple(r) for r in read.collect()) == [("35", "15", "1.234 (3)"), ("9", "8", "7")]
    write(tmp_path / "c.csv", "1;2;3\n")
    with pytest.raises(Exception, match="no header row"):
        read_table_export(spark, str(tmp_path), NAMES).collect()


def test_files_of_one_name_are_two_deliveries():
    files = ["file:///in/sp/d%20x.csv", "file:/in/rj/d%20x.csv", "s3a://b/in/part-0.csv"]
    assert delivery_names(files) == {"/in/sp/d x.csv", "/in/rj/d x.csv", "b/in"}


def test_emptied_delivery_loses_its_rows(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    schema = "x bigint, d string"
    rows = spark.createDataFrame([(1, "/in/a b.csv"), (2, "/in/c.csv")], schema)
    tables.replace_deliveries("t", rows, "d")
    tables.replace_deliveries("t", rows.limit(0), "d", ["/in/a b.csv", "/in/unknown.csv"])
    assert [tuple(r) for r in tables.read("t", schema).collect()] == [(2, "/in/c.csv")]


def test_unfinished_versions_are_not_read(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    spark.range(3).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{tmp_path}/t/v000001")
    assert tables.read("t", "id bigint").isEmpty()
    tables.append("t", spark.range(2))
    assert tables.read("t", "id bigint").count() == 2


def test_doubled_key_fails_a_flattening(spark):
    base = spark.createDataFrame([(1, "a")], "k bigint, name string")
    parent = spark.createDataFrame([(1, "x"), (1, "y")], "k bigint, label string")
    with pytest.raises(Exception, match="k is not unique"):
        flatten_chain(base, [(parent, "k")]).collect()


def deliver(folder, number):
    """Files of two column orders, with quotes, a byte order mark, blank lines and short rows."""
    folder.mkdir()
    for i in range(number):
        if i % 2:
            write(folder / f"f {i}.csv", f'\ufeff"z";y;w;x\nz{i};;w;x{i}\n\n')
        else:
            write(folder / f"f {i}.csv", f'x;y;z\nx{i};"a;""b""";NA\n   \nonly{i}\n')
    expected = []
    for i in range(number):
        expected += [(f"x{i}", None, f"z{i}")] if i % 2 else [(f"x{i}", 'a;"b"', None), (f"only{i}", None, None)]
    return sorted(expected, key=str)


def triples(df):
    return sorted((tuple(r) for r in df.select("x", "y", "z").collect()), key=str)


def test_list_folder_and_stream_give_one_result(spark, tmp_path):
    folder = tmp_path / "in"
    expected = deliver(folder, 5)
    files = sorted(str(f) for f in folder.iterdir())
    assert triples(read_delimited(spark, str(folder), ["x", "y", "z"])) == expected
    assert triples(read_delimited(spark, files, ["x", "y", "z"])) == expected
    loaded = []
    load_new_files(
        spark, str(folder), {c: c for c in "xyz"}, lambda rows: loaded.extend(triples(rows)), str(tmp_path / "cp")
    )
    assert sorted(loaded, key=str) == expected


def test_jobs_do_not_follow_the_number_of_files(spark, tmp_path):
    def jobs(number):
        expected = deliver(tmp_path / f"in{number}", number)
        spark.sparkContext.setJobGroup(f"files {number}", "")
        try:
            assert triples(read_delimited(spark, str(tmp_path / f"in{number}"), ["x", "y", "z"])) == expected
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"files {number}"))

    assert jobs(2) == jobs(12)


def test_files_of_one_layout_are_read_without_a_join(spark, tmp_path):
    write(tmp_path / "a.csv", "x;y\n1;2\n")
    write(tmp_path / "b.csv", "x;y\n3;4\n")
    rows = read_delimited(spark, str(tmp_path), ["y"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and sorted(r["y"] for r in rows.collect()) == ["2", "4"]


def test_surplus_fields_stop_or_are_marked(spark, tmp_path):
    write(tmp_path / "a.csv", 'x;y\n1;2;3\n"4;4";5\n6\n"7;8\n')
    with pytest.raises(Exception, match="surplus fields"):
        read_delimited(spark, str(tmp_path), ["x"]).collect()
    marked = read_delimited(spark, str(tmp_path), ["x", "y"], ragged="mark").select("x", "y", REASON, LINE)
    assert sorted((tuple(r) for r in marked.collect()), key=str)[:3] == [
        ("1", "2", "surplus fields", "1;2;3"), ("4;4", "5", None, None), ("6", None, "missing fields", "6"),
    ]
    with pytest.raises(ValueError, match="ragged"):
        read_delimited(spark, str(tmp_path), ["x"], ragged="drop")


def test_a_missing_column_names_its_file(spark, tmp_path):
    write(tmp_path / "a.csv", "x;y\n1;2\n")
    write(tmp_path / "b.csv", "x;other\n1;2\n")
    write(tmp_path / "empty.csv", "")
    with pytest.raises(ValueError, match=r"\['y'\].*b.csv"):
        read_delimited(spark, str(tmp_path), ["x", "y"])
    assert read_delimited(spark, str(tmp_path / "empty.csv"), ["x"]).isEmpty()


def test_changed_files_are_loaded_until_they_were_loaded(spark, tmp_path):
    folder = tmp_path / "in [1]"
    folder.mkdir()
    write(folder / "a.csv", "x\n1\n")
    write(folder / "b.csv", "x\n2\n")
    ledger = FileLedger(spark, str(tmp_path / "ledger"))
    seen = []

    def load(rows, names):
        seen.append((sorted(r["x"] for r in rows.collect()), sorted(n[-5:] for n in names)))
        assert {r[0] for r in rows.select(SOURCE_PATH).distinct().collect()} <= set(names)

    def failing(rows, names):
        raise RuntimeError("stopped")

    place = str(folder).replace("[", "\\[").replace("]", "\\]")
    with pytest.raises(RuntimeError):
        load_changed_files(spark, place, {"x": "x"}, failing, ledger)
    assert len(load_changed_files(spark, place, {"x": "x"}, load, ledger)) == 2
    assert load_changed_files(spark, place, {"x": "x"}, load, ledger) == []
    write(folder / "a.csv", "y;x\n;3\n;4\n")
    write(folder / "b.csv", "")
    (folder / "c.csv").write_text("x\n5\n")
    load_arrived_files(spark, place, {"x": "x"}, load, str(tmp_path / "cp"), ledger)
    assert seen[0] == (["1", "2"], ["a.csv", "b.csv"])
    assert seen[-1] == ([], ["b.csv"])
    (folder / "c.csv").unlink()  # a file that is gone stays loaded
    assert load_changed_files(spark, place, {"x": "x"}, load, ledger) == []


def test_scratch_is_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "scratch_folder", lambda spark, label: f"{tmp_path}/app/{label}")
    assert written(spark.range(3), "t").count() == 3 and (tmp_path / "app").exists()
    clear_scratch(spark)
    clear_scratch(spark)
    assert not (tmp_path / "app").exists()
