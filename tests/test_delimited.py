"""Delimited files cut into ranges anywhere: records, values and releases as one reader of whole files finds them."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from gridloom.operators.common import CheckFailed
from gridloom.session import scratch_path
from gridloom.sources import delimited, readers

VALUES = ["", "x", "a\nb", 'say "a, b"', "\n", '"', '""\n"', ",", " padded ", "é\u2028", "back\\", "a\r\nb", "\n\n\n", "1" * 40]


def write(path, header, rows, ending="\r\n", bom=False):
    with open(path, "w", newline="", encoding="utf-8") as out:
        out.write("\ufeff" if bom else "")
        w = csv.writer(out, lineterminator=ending, quoting=csv.QUOTE_MINIMAL)
        w.writerow(header)
        for row in rows:
            w.writerow(row)
            if len(row[0]) == 1:
                out.write(ending)  # an empty line


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return tmp_path_factory.mktemp("delimited files")


@pytest.fixture
def ranges(spark):
    """Ranges of so many bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    yield lambda size: (spark.conf.set(keys[0], str(size)), spark.conf.set(keys[1], "1"))
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize(("size", "listed"), [(13, 10**6), (64, 10**6), (10**6, 10**6), (37, 0)])
def test_records_of_any_range(spark, folder, ranges, monkeypatch, size, listed):
    monkeypatch.setattr(delimited, "LISTED", listed)
    r = random.Random(size)
    rows = [[str(i), r.choice(VALUES), r.choice(VALUES)] for i in range(60)]
    path = f"{folder}/one_{size}_{listed}.csv"
    write(path, ["id", 'na"me', "two\nlines"], rows, r.choice(["\n", "\r\n"]), bom=size == 64)
    ranges(size)
    found = readers.csv_scan_typed(spark, [("r", "2024-01-01", path)], {"two\nlines": "b", "id": "id", 'na"me': "a"})
    assert sorted((int(x.id), x.a or "", x.b or "") for x in found.collect()) == [(int(i), a, b) for i, a, b in rows]
    if size == 13:
        assert delimited.lines(spark, [path]).select("range").distinct().count() > 50


def test_a_large_file_is_work_for_several_tasks(spark, folder, ranges):
    path = f"{folder}/large.csv"
    write(path, ["id", "v"], [[str(i), f'note {i}\n"{i}"' if i % 3 else "plain"] for i in range(60_000)])
    ranges(200_000)
    spark.sparkContext.setJobGroup("large", "")
    found = readers.csv_scan_typed(spark, [("r", "2024-01-01", path)], {"id": "id", "v": "v"})
    assert found.agg(F.count("*"), F.sum(F.col("id").cast("long")), F.count_if(F.col("v").contains("\n"))).first()[:] == (60_000, 60_000 * 59_999 // 2, 40_000)
    spark.sparkContext.setJobGroup("", "")
    assert found.rdd.getNumPartitions() >= 5


def test_releases_are_one_scan(spark, folder):
    one, two = folder / "release one", folder / "two"
    one.mkdir()
    two.mkdir()
    write(one / "a.csv", ["x", "y"], [["1", "a"], ["2", ""]])
    write(one / "b.csv", ["extra", "y", "x"], [["?", "b", "3"]])
    write(two / "c.csv", ["y", "x"], [["c", "4"]])
    write(folder / "single.csv", ["x", "y"], [])
    releases = [("one", "2024-01-01", str(one)), ("two", "2024-02-01", f"file://{two}"), ("none", "2024-03-01", str(folder / "single.csv"))]
    found = readers.csv_scan_typed(spark, releases, {"x": "number", "y": "letter"}, {"number": F.col("number").cast("int")})
    assert sorted((r.benchmark_id, str(r.release_date), r.number, r.letter) for r in found.collect()) == [
        ("one", "2024-01-01", 1, "a"), ("one", "2024-01-01", 2, None), ("one", "2024-01-01", 3, "b"), ("two", "2024-02-01", 4, "c")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation [value") == 1  # the rest is small stored tables
    with pytest.raises(CheckFailed, match="one lacks required columns: extra"):
        readers.csv_scan_typed(spark, releases[:1], {"x": "number", "extra": "e"})


def test_quoted_empty_text_is_not_missing(spark, folder):
    path = scratch_path(spark, "quoted")
    with open(f"{folder}/quoted.csv", "w") as out:
        out.write('a,b\n"",\n,""\n"  ", x \n')
    path = f"{folder}/quoted.csv"
    rows = readers.csv_scan_typed(spark, [("r", "2024-01-01", path)], {"a": "a", "b": "b"}).collect()
    assert sorted(((r.a, r.b) for r in rows), key=str) == sorted([("", None), (None, ""), ("  ", " x ")], key=str)
