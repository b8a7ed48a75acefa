"""Records cut in parallel ranges against the csv module."""

import csv
import io
import random

import pytest

from tabloom.sources import tables as src
from tabloom.sources.csv_records import csv_records, ends_inside

CELLS = ["", "a", "ü,b", 'say "x"', "two\nlines", "\n\n", '"', '""', ' "lead', "x\r\ny", "end\n", "12", "a,\n,b"]


@pytest.fixture(params=[61, 1 << 20])
def ranges(spark, request):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def write(path, rows, end="\n"):
    with open(path, "w", newline="") as f:
        csv.writer(f, lineterminator=end).writerows(rows)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_equal_those_of_a_sequential_reader(spark, tmp_path, ranges, end):
    rng = random.Random(ranges)
    wanted = []
    for k in range(3):
        rows = [[f"{k}-{n}", *rng.choices(CELLS, k=3)] for n in range(60)]
        rows[7][2] = "long\n" * 90  # a cell over many ranges
        write(tmp_path / f"{k}.csv", [["id", 'a "b"', "c\nd", "e"], *rows], end)
        wanted += rows
    got = src.read_csv(spark, str(tmp_path), "id string, `a \"b\"` string, `c\nd` string, e string")
    null = lambda v: None if v.strip(" ") in src.NA_TOKENS else v
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([tuple(null(v) for v in r) for r in wanted], key=repr)
    lines = sum(1 for k in range(3) for _ in open(tmp_path / f"{k}.csv"))
    if ranges < 100:
        assert csv_records(spark, str(tmp_path)).count() == 180 and lines > 400


def test_states_beyond_the_broadcast_limit(spark, tmp_path, ranges):
    rows = [[str(n), "x\ny" * (n % 5), "z"] for n in range(200)]
    write(tmp_path / "t.csv", [["a", "b", "c"], *rows])
    def records(**how):
        return sorted(r["record"] for r in csv_records(spark, str(tmp_path / "t.csv"), **how).collect())

    buffer = io.StringIO()
    csv.writer(buffer, lineterminator="\x00").writerows(rows)
    assert records() == records(broadcast_bytes=0) == sorted(buffer.getvalue().split("\x00")[:-1])


def test_quotes_within_unquoted_cells_and_open_ends(spark, tmp_path, ranges):
    text = 'a,b\n5" pipe,1\n3" rod,"2\n"\n\nx,3\n"never closed,4\nmore'
    (tmp_path / "t.csv").write_text(text)
    got = [r["record"] for r in csv_records(spark, str(tmp_path / "t.csv")).collect()]
    assert sorted(got) == sorted(['5" pipe,1', '3" rod,"2\n"', "x,3", '"never closed,4\nmore'])
    (tmp_path / "head.csv").write_text("a,b\n")
    assert src.read_csv(spark, str(tmp_path / "head.csv"), "a string, b string").count() == 0


def test_line_states():
    for line, start, end in (("a,b", False, False), ("a,b", True, True), ('"a', False, True), ('a"b', False, False), ('a","b', True, True), ('""', True, True), ('"', True, False), ('x"",y', True, True), ('x",y', True, False), ('"",""', False, False)):
        assert ends_inside(line, start) is end, line


def test_one_file_is_read_by_many_tasks(spark, tmp_path, ranges):
    write(tmp_path / "t.csv", [["a", "b"], *[[n, "q\nr"] for n in range(500)]])
    df = src.read_csv(spark, str(tmp_path / "t.csv"), "a bigint, b string")
    if ranges < 100:
        assert df.rdd.getNumPartitions() > 8
    assert {r["a"] for r in df.collect()} == set(range(500))
