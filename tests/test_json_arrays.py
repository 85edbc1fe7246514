"""Array files that split: equal to the whole-file reader at every cut."""

import json
import random

import pytest

from arenalake.sources.json_arrays import read_split_arrays
from arenalake.sources.json_files import read_json_array

TRICKY = [
    {"id": 1, "name": 'a "quoted" } { [ ] \\', "roles": ["x", "}"], "inner": {"a": {"b": [1, {"c": "}{"}]}}},
    {"id": 2},
    {},
    {"id": 3, "text": "ends with backslash \\\\", "more": "\\\"}"},
    [1, [2, {"deep": "]"}]],
    "only } text {",
    5,
    None,
    {"id": 4, "line": "break\nin text", "uni": "ä𝄞}"},
]


def texts(df):
    return sorted(r["t"] for r in df.selectExpr("to_json(record) AS t").collect())


def written(folder, *files):
    folder.mkdir(parents=True, exist_ok=True)
    for k, text in enumerate(files):
        (folder / f"{k}.json").write_text(text, encoding="utf-8")
    return str(folder)


@pytest.fixture
def cut(spark):
    """Sets the bytes of a split."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    known = {n: spark.conf.get(n, None) for n in names}

    def to(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], "64k")  # several splits a task
        spark.conf.set(names[2], 1)

    yield to
    for name, value in known.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_equals_the_whole_file_reader_cut_at_every_byte(spark, tmp_path, cut):
    path = written(tmp_path / "a", json.dumps(TRICKY, ensure_ascii=False), json.dumps(TRICKY, indent=1), " [ ] \n", json.dumps(TRICKY[:1]))
    expected = texts(read_json_array(spark, path))
    assert len(expected) == 2 * len(TRICKY) + 1
    for size in (1, 7, 100_000):
        cut(size)
        assert texts(read_split_arrays(spark, path)) == expected, size


def test_random_arrays(spark, tmp_path, cut):
    r = random.Random(7)

    def value(depth):
        kind = r.randrange(7 if depth else 4)
        if kind < 2:
            return "".join(r.choice('a"\\{}[],: é') for _ in range(r.randrange(6)))
        if kind == 2:
            return r.choice([None, True, 7, -1.5])
        if kind == 3:
            return {}
        if kind == 4:
            return [value(depth - 1) for _ in range(r.randrange(3))]
        return {str(k): value(depth - 1) for k in range(r.randrange(4))}

    for k in range(4):
        files = [json.dumps([value(3) for _ in range(r.randrange(12))], indent=r.choice([None, 2])) for _ in range(3)]
        path = written(tmp_path / str(k), *files)
        expected = texts(read_json_array(spark, path))
        cut(r.choice([1, 5, 11, 40]))
        assert texts(read_split_arrays(spark, path)) == expected, files


def test_one_array_a_line(spark, tmp_path, cut):
    lines = [[{"id": 1}, {"id": 2, "x": {"y": 1}}], [], [{"id": 3}], [], []]
    path = written(tmp_path / "a", "\n".join(map(json.dumps, lines)) + "\n")
    expected = texts(read_json_array(spark, path, one_array_per_line=True))
    for size in (1, 1000):
        cut(size)
        assert texts(read_split_arrays(spark, path)) == expected and len(expected) == 3


@pytest.mark.parametrize("text", ['{"id": 1}', '[{"id": 1}', '[{"id": "1}]', '[{"id": 1}]]', '[{"id": 1} {"id": 2}]', "[{}, }]"])
def test_other_files_fail(spark, tmp_path, text):
    path = written(tmp_path / "a", text)
    with pytest.raises(Exception, match="(?i)not a json array|malformed"):
        read_split_arrays(spark, path).selectExpr("to_json(record)").collect()


def test_large_array_is_read_by_many_tasks(spark, tmp_path, cut):
    path = written(tmp_path / "a", json.dumps([{"id": k, "name": "x" * (k % 70)} for k in range(60_000)]))
    cut(256 * 1024)
    pieces = spark.read.option("lineSep", "}").text(path)
    spark.conf.set("spark.sql.files.openCostInBytes", "4m")
    assert pieces.selectExpr("spark_partition_id() p").distinct().count() >= 8
    found = read_split_arrays(spark, path).selectExpr("variant_get(record, '$.id', 'bigint') AS id")
    assert found.selectExpr("count(*)", "count(distinct id)", "max(id)").first()[:] == (60_000, 60_000, 59_999)
