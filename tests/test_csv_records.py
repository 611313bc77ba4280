"""S1/S10: quoted line breaks over many tasks, open quotes, and streams over files with headers of their own."""

import random

import pytest
from pyspark.sql import functions as F

from indicata.sources import csv_records
from indicata.sources.csv_text import overlong_rows, read_delimited, read_delimited_files, well_formed
from indicata.streaming.landing import read_landing, start_landing


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "97b", "spark.sql.files.openCostInBytes": "1b"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def field(r):
    return r.choice(['plain', '', '"a\nb"', '"x;y"', '"say ""hi""\n\n;"', 'st"ray', '"long\n' + "text\n" * r.randint(0, 60) + '"',
                     '""', '"q"', 'ñandú', '"\n"', '"tail""\n"'])


def rows_of(df, names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_equal_the_one_task_reader(spark, tmp_path, small_splits, end):
    r = random.Random(7)
    names = ["a", "b", "c"]
    for f in range(3):
        lines = [";".join(field(r) for _ in names) for _ in range(80)]
        (tmp_path / f"f{f}.csv").write_bytes((end.join(["a;b;c", *lines]) + (end if f else "")).encode())
    want = (spark.read.option("sep", ";").option("header", True).option("quote", '"').option("escape", '"')
            .option("multiLine", True).schema("a string, b string, c string").csv(str(tmp_path)))
    want = want.select(*[F.coalesce(n, F.lit("")).alias(n) for n in names])
    got = read_delimited(spark, str(tmp_path), multiline=True)
    assert rows_of(well_formed(got), names) == rows_of(want, names)
    assert overlong_rows(got).count() == 0
    parts = csv_records._lines(spark, str(tmp_path)).rdd.getNumPartitions()
    assert parts > 30   # one file is many tasks


def test_open_quotes_are_quarantined_whole(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text('name;city\n"ann\nmarie";rome\nbo;"os\nlo"\n x;y\nlast;"never\ncloses;\n', encoding="utf-8")
    got = read_delimited(spark, str(tmp_path), multiline=True)
    assert rows_of(well_formed(got), ["name", "city"]) == [(" x", "y"), ("ann\nmarie", "rome"), ("bo", "os\nlo")]
    assert [r._record for r in overlong_rows(got).collect()] == ['last;"never\ncloses;']
    # line by line nothing is cut silently: lines that leave a quote open are kept whole
    got = read_delimited(spark, str(tmp_path))
    assert sorted(r._record for r in overlong_rows(got).collect()) == ['"ann', 'bo;"os', 'last;"never']
    assert ("bo", "os") not in rows_of(well_formed(got), ["name", "city"])


def test_too_many_open_blocks_fail_loudly(spark, tmp_path, small_splits, monkeypatch):
    (tmp_path / "a.csv").write_text('a;b\n1;"' + "x\n" * 500 + '"\n', encoding="utf-8")
    assert well_formed(read_delimited(spark, str(tmp_path), multiline=True)).first().b == "x\n" * 500
    monkeypatch.setattr(csv_records, "MOST_INSIDE", 2)
    with pytest.raises(ValueError, match="outside of quotes"):
        read_delimited(spark, str(tmp_path), multiline=True)


def test_one_header_or_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a;b\n1;2\n", encoding="utf-8-sig")
    (tmp_path / "b.csv").write_text("b;a\n4;3\n5;6;7\n\x01;8\n", encoding="utf-8")
    with pytest.raises(ValueError, match="files of 2 headers"):
        read_delimited(spark, str(tmp_path))
    got = read_delimited_files(spark, str(tmp_path))
    assert rows_of(well_formed(got), ["a", "b"]) == [("1", "2"), ("3", "4"), ("8", "\x01")]
    assert [r._record for r in overlong_rows(got).collect()] == ["5;6;7"]
    with pytest.raises(ValueError, match="no data"):
        (tmp_path / "none").mkdir()
        read_delimited(spark, str(tmp_path / "none"))


def test_stream_reads_each_file_by_its_own_header(spark, tmp_path):
    landing = tmp_path / "drop"
    landing.mkdir()
    target, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "ckpt")

    def drop(name, text):
        (landing / name).write_text(text, encoding="utf-8")

    def run():
        start_landing(spark, str(landing), target, checkpoint, multiline=True).awaitTermination()

    drop("a.csv", "name;city\nann;rome\n\"two\nlines\";oslo\n")
    drop("b.csv", "city;name\nparis;bo\nbad;row;here\n")
    drop("empty.csv", "")
    run()
    drop("c.csv", "city;age;name\nrome;7;cy\n")
    run()   # a restart from the checkpoint
    run()   # nothing new
    drop("d.csv", "name\nlast\n")
    run()
    names = ["name", "city", "age"]
    streamed = read_landing(spark, target)
    batch = well_formed(read_delimited_files(spark, [str(landing / f"{x}.csv") for x in "abcd"], multiline=True))
    assert rows_of(streamed, names) == rows_of(batch, names) == [
        ("ann", "rome", ""), ("bo", "paris", ""), ("cy", "rome", "7"), ("last", "", ""), ("two\nlines", "oslo", "")]
    assert [r._record for r in spark.read.parquet(f"{target}_quarantine").collect()] == ["bad;row;here"]
    told = sorted((int(r.batch), r.column, r.change) for r in spark.read.parquet(f"{target}_columns").collect())
    assert told == [(0, "city", "new"), (0, "name", "new"), (1, "age", "new"), (2, "age", "missing"),
                    (2, "city", "missing")]


def test_a_repeated_batch_overwrites_itself(spark, tmp_path):
    landing = tmp_path / "drop"
    landing.mkdir()
    (landing / "a.csv").write_text("k;v\n1;x\n", encoding="utf-8")
    target = str(tmp_path / "bronze")
    for checkpoint in ("one", "two"):   # the same batch number again, as after a failure before its commit
        start_landing(spark, str(landing), target, str(tmp_path / checkpoint)).awaitTermination()
    assert read_landing(spark, target).count() == 1
