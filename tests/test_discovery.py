"""Types and samples of tables of text, and rows that don't parse, on files made by hand."""

import pathlib

import pytest
from pyspark.sql import functions as F

from panelforge.sources import discovery


def test_types_are_the_least_that_hold_all_values(spark):
    rows = [("1", "1", "2024-01-01", "true", "", "a", "12345678901234567890"), (" -2 ", "2.5e3", "2024-01-02 10:00:00", "FALSE", None, "b", "1"), (None, "", None, None, " ", "1", "2")]
    df = spark.createDataFrame(rows, "i string, f string, t string, b string, none string, s string, wide string")
    got = {r["column_name"]: r for r in discovery.discover(df, "t").collect()}
    assert {c: r["type"] for c, r in got.items()} == {"i": "bigint", "f": "double", "t": "timestamp", "b": "boolean", "none": "string", "s": "string", "wide": "double"}
    assert (got["i"]["row_count"], got["i"]["null_count"], got["none"]["null_count"], got["none"]["longest"]) == (3, 1, 3, None)
    assert set(got["i"]["samples"]) <= {"1", " -2 "} and 1 <= len(got["i"]["samples"]) <= 3 and got["none"]["samples"] == []
    assert discovery.ddl(discovery.discover(df.select("i", "s"), "t")).first()["statement"] == "CREATE TABLE t (`i` bigint, `s` string NOT NULL)"
    assert [r["type"] for r in discovery.discover(df.limit(0), "t").collect()] == ["string"] * 7


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_lines_that_do_not_parse_are_kept_with_their_file(spark, tmp_path, fmt):
    good = {"csv": "a,b\n1,x\n2,y\n", "json": '{"a": 1, "b": "x"}\n{"a": 2, "b": "y"}\n'}[fmt]
    bad = {"csv": "a,b\nz,x\n3,y\n1,2,3\nz,x\n", "json": '{"a": "z"\n{"a": 3, "b": "y"}\nnothing\n{"a": "z"\n'}[fmt]
    pathlib.Path(tmp_path / "good").write_text(good)
    pathlib.Path(tmp_path / "bad").write_text(bad)
    checked = discovery.read_checked(spark, f"file://{tmp_path}", "a int, b string", fmt)
    assert sorted(r["a"] for r in checked.filter("corrupt_record is null").collect()) == [1, 2, 3]
    report = {r["file_name"]: r for r in discovery.bad_row_report(checked).collect()}
    assert (report["good"]["row_count"], report["good"]["bad_rows"], report["good"]["samples"]) == (2, 0, None)
    assert (report["bad"]["row_count"], report["bad"]["bad_rows"]) == (4, 3)
    assert sorted(report["bad"]["samples"]) == {"csv": ["1,2,3", "z,x"], "json": ["nothing", '{"a": "z"']}[fmt]
    assert len(discovery.bad_row_report(checked, samples=1).filter("bad_rows > 0").first()["samples"]) == 1
    assert checked.select(F.count("*")).first()[0] == 6
