"""CSV fields with line feeds, against the reader that takes each file as a whole."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import functions as F

from orderlens.sources import quoted, readers

WORDS = ["a", "b\nc", 'say "hi"', '"', '""', "x,y", "\n", '\n"\n,', "", "long " * 30, ',"', '",\n"', "tab\t", "end\r\nmid", "ä\nö"]


@pytest.fixture
def small_blocks(spark):
    name, old = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set(name, "400")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield spark
    spark.conf.set(name, old)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def write(path, table, end="\n"):
    with open(path, "w", newline="") as file:
        csv.writer(file, lineterminator=end).writerows(table)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(3))
def test_like_a_whole_file_reader(small_blocks, tmp_path, end, seed):
    pick = random.Random(seed)
    table = [[str(i), pick.choice(WORDS), pick.choice(WORDS) + pick.choice(WORDS)] for i in range(300)]
    path = str(tmp_path / "t.csv")
    write(path, [["id", "note", "more"], *table], end)
    lines = quoted.lines_of(small_blocks, path)
    assert lines.rdd.getNumPartitions() > 10
    assert lines.select("_block").distinct().count() > 10
    assert quoted.has_open_lines(lines)
    found = quoted.table(lines)
    assert found.columns == ["id", "note", "more"]
    assert rows(found.na.fill("")) == sorted(map(tuple, table), key=repr)


def test_field_longer_than_many_blocks(small_blocks, tmp_path):
    long = "\n".join(f"line {i}, \"part\"" for i in range(500))
    table = [["1", "short"], ["2", long], ["3", "last"], ["4", long + "\n"]]
    path = str(tmp_path / "t.csv")
    write(path, [["id", "note"], *table])
    assert rows(quoted.table(quoted.lines_of(small_blocks, path))) == sorted(map(tuple, table), key=repr)


def test_many_files_each_with_a_header(small_blocks, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(4):
        write(folder / f"{k}.csv", [["id", "no\nte"], *([f"{k}-{i}", f"a\n{i}"] for i in range(40))])
    found = quoted.table(quoted.lines_of(small_blocks, str(folder)))
    assert found.columns == ["id", "no\nte"]
    assert rows(found) == sorted((f"{k}-{i}", f"a\n{i}") for k in range(4) for i in range(40))


def test_quotes_inside_unquoted_fields_are_letters(small_blocks, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,note\n1,5" pipe\n2,"a\nb"\n3,6" and 7"\n\n4,"c ""d"" e\n\nf"\n' + "5,9\" x\n" * 100)
    expected = [("1", '5" pipe'), ("2", "a\nb"), ("3", '6" and 7"'), ("4", 'c "d" e\n\nf')] + [("5", '9" x')] * 100
    assert rows(readers.read_csv(small_blocks, str(path))) == sorted(expected, key=repr)


def test_files_without_open_lines_take_the_plain_reader(spark, tmp_path, monkeypatch):
    path = tmp_path / "t.csv"
    path.write_text('id,note\n1,"x, ""y"""\n2,""\n3,"a",\n')
    monkeypatch.setattr(quoted, "table", lambda lines: pytest.fail("not needed"))
    assert rows(readers.read_csv(spark, str(path)).select("id", "note")) == [("1", 'x, "y"'), ("2", None), ("3", "a")]


def test_words_for_missing_values(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(' id , note \n1,"n/a"\n2,"n/a\n"\n3,\n')
    found = readers.read_csv(spark, str(path))
    assert found.columns == ["id", "note"]
    assert rows(found) == [("1", None), ("2", "n/a\n"), ("3", None)]


def test_only_lines_of_long_records_are_gathered(small_blocks, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,note\n" + "1,plain\n" * 200 + '2,"a\nb"\n')
    found = quoted.records(quoted.lines_of(small_blocks, str(path)))
    assert found.where(F.col("record") == '2,"a\nb"').count() == 1
    assert found.where("first").count() == 1 and found.count() == 202
