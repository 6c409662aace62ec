"""CSV files with quoted line breaks in pieces, against the reader of one task per file."""

import random

import pytest
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from spanlake.sources.files import read_csv
from spanlake.sources.records import (
    file_pieces,
    joined_records,
    judged_lines,
    numbered_lines,
    read_csv_records,
    record_parts,
)

SCHEMA = (
    StructType()
    .add("ID", LongType())
    .add("S", StringType())
    .add("N", DoubleType())
    .add("T T", StringType())
)


def same(spark, path):
    want = [tuple(r) for r in read_csv(spark, str(path), SCHEMA, multi_line=True).collect()]
    got = read_csv_records(spark, str(path), SCHEMA)
    assert got.columns == SCHEMA.names
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want))
    plain = read_csv(spark, str(path), SCHEMA, True, "bad")
    split = read_csv_records(spark, str(path), SCHEMA, "bad")
    bad = [df.where("bad IS NOT NULL").select("ID", "S", "bad") for df in (plain.cache(), split)]
    assert sorted(map(repr, bad[1].collect())) == sorted(map(repr, bad[0].collect()))
    plain.unpersist()
    return want


def astray(spark, path):
    lines = numbered_lines(spark, str(path))
    return judged_lines(lines, file_pieces(lines)).where("astray").count()


def cell(draw):
    text = "".join(draw.choices(["a", "é", " ", ",", '"', "\n", "\n\n", ""], k=draw.randrange(9)))
    return '"' + text.replace('"', '""') + '"' if draw.random() < 0.9 or set(text) & set(',"\n') else text


def write(path, draw, rows):
    lines = ['ID,"S\nS",N,"T T"']
    for i in range(rows):
        lines.append(f"{i},{cell(draw)},{draw.random():.3f},{cell(draw)}")
        if draw.random() < 0.1:
            lines.append(draw.choice(["", "7,short", "x,y,z,t,extra", ",,,", "8"]))
    path.write_text("\n".join(lines) + "\n" * draw.randrange(3), encoding="utf-8")


@pytest.fixture
def small_pieces(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("seed", range(4))
def test_records_equal_the_multi_line_reader(spark, tmp_path, small_pieces, seed):
    draw = random.Random(seed)
    for i in range(3):
        write(tmp_path / f"part {i}+%.csv", draw, 60 * i + 20)
    want = same(spark, tmp_path)
    assert any("\n" in (r[3] or "") for r in want)
    assert astray(spark, tmp_path) == 0


def test_one_file_takes_many_tasks(spark, tmp_path, small_pieces):
    write(tmp_path / "in.csv", random.Random(9), 300)
    lines = numbered_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 5
    assert lines.select("block").distinct().count() > 5
    same(spark, tmp_path)


def test_a_record_longer_than_pieces(spark, tmp_path, small_pieces):
    long = "\n".join(f'line {i} with ""quotes"", and commas' for i in range(200))
    (tmp_path / "in.csv").write_text(f'\n\nID,S,N,T\n1,"{long}",2,x\n2,b,3,"y\n"\n')
    assert len(same(spark, tmp_path)) == 2


@pytest.mark.parametrize(
    "line",
    ['1,5" pipe,2,x', '1,"a"b,2,x', '1,"open,2,x', "1,a\x01b,2,x", '1,"a\r\nb",2,x', '1, "a,2,x'],
)
def test_files_whose_quotes_do_not_tell(spark, tmp_path, small_pieces, line):
    good = "".join(f'{i},"g\n{i}",1,z\n' for i in range(90))
    (tmp_path / "a.csv").write_text("ID,S,N,T\n" + good)
    (tmp_path / "b b.csv").write_text("ID,S,N,T\n" + good + line + "\n" + good, newline="")
    assert len(same(spark, tmp_path)) >= 180
    assert astray(spark, tmp_path) > 0 and astray(spark, tmp_path / "a.csv") == 0


@pytest.mark.parametrize("text", ["", "\n", "ID,S,N,T\n", "ID,S,N,T", '"ID\n",S'])
def test_files_without_rows(spark, tmp_path, text):
    (tmp_path / "in.csv").write_text(text)
    assert same(spark, tmp_path) == []


def test_only_parts_of_records_are_exchanged(spark, tmp_path):
    write(tmp_path / "in.csv", random.Random(3), 300)
    lines = numbered_lines(spark, str(tmp_path))
    judged = judged_lines(lines, file_pieces(lines))
    parts = record_parts(judged)
    assert parts.count() > 300 and parts.where("NOT whole").count() == 0
    assert joined_records(parts).count() == parts.count() - 1
