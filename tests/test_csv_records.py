"""Quoted CSV that splits: equal to the whole-file reader at every cut."""

import random

import pytest

from arenalake.sources import sinks
from arenalake.sources.csv_records import read_split_csv
from tests.test_json_arrays import cut  # noqa: F401

SCHEMA = "a string, b string, c string"
TEXTS = ["plain", 'with "quotes"', "line\nbreak", "two\n\nbreaks\n", "\r\nboth\r", "comma, and", " outer ", "", None, "ä𝄞", '"', '""\n""', "\n"]


def whole(spark, path):
    """The reader that takes a file in one task."""
    options = {"header": True, "escape": '"', "multiLine": True}
    return spark.read.options(**options, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equals_the_whole_file_reader_at_every_cut(spark, tmp_path, cut):  # noqa: F811
    r = random.Random(5)
    rows = [tuple(r.choice(TEXTS) for _ in range(3)) for _ in range(60)]
    path = str(tmp_path / "a")
    sinks.write_snapshot_csv(spark.createDataFrame(rows, SCHEMA).repartition(3), path)
    expected = rows_of(whole(spark, path))
    assert len(expected) == 60 and rows_of(spark.createDataFrame(rows, SCHEMA).na.fill("")) == rows_of(whole(spark, path).na.fill(""))
    for size in (1, 13, 100_000):
        cut(size)
        found = read_split_csv(spark, path)
        assert found.columns == ["a", "b", "c"] and rows_of(found) == expected, size


def test_line_ends_blank_lines_and_files_without_rows(spark, tmp_path, cut):  # noqa: F811
    (tmp_path / "x.csv").write_bytes(b'a,b\r\n1,"x\r\ny"\r\n\r\n2,z\r\n')
    cut(3)
    assert rows_of(read_split_csv(spark, str(tmp_path / "x.csv"))) == [("1", "x\r\ny"), ("2", "z")]
    (tmp_path / "y.csv").write_text("a,b\n")
    assert read_split_csv(spark, str(tmp_path / "y.csv")).columns == ["a", "b"]
    assert read_split_csv(spark, str(tmp_path / "y.csv")).count() == 0


def test_large_file_is_read_by_many_tasks(spark, tmp_path, cut):  # noqa: F811
    path = str(tmp_path / "a")
    rows = spark.range(40_000).selectExpr("cast(id AS string) a", "concat('x\n', repeat('y', cast(id % 50 AS int))) b", "'c' c")
    sinks.write_snapshot_csv(rows.coalesce(1), path)
    cut(128 * 1024)
    spark.conf.set("spark.sql.files.openCostInBytes", "4m")
    assert spark.read.text(path).selectExpr("spark_partition_id() p").distinct().count() >= 8
    found = read_split_csv(spark, path)
    assert found.count() == 40_000 and found.selectExpr("count(distinct a)", "sum(length(b))").first()[:] == (40_000, 2 * 40_000 + 800 * sum(range(50)))
