"""Records with line breaks inside quotes, split in parallel, against
Spark's own reader, which takes a whole file in one task."""

import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.sources import files, records


@pytest.fixture()
def small_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def whole_files(spark, path):
    reader = spark.read.option("header", True).option("mode", "FAILFAST").option("escape", '"').option("multiLine", True)
    return reader.csv(path)


def quoted(rng):
    kind = rng.randint(0, 6)
    words = ["plain", "", "a,b", 'say ""x""', "two\nlines", "\n\n\nblank", '""', "tail\n", "é中\r\nx", ",", "l" * rng.randint(0, 900)]
    if kind < 2:
        return rng.choice(["x", "12", "", " padded ", "word"])
    return '"' + "".join(rng.choice(words) for _ in range(rng.randint(0, 4))) + '"'


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_rows_as_the_whole_file_reader(spark, small_ranges, tmp_dir, end):
    rng = random.Random(4)
    os.makedirs(f"{tmp_dir}/c")
    for n in range(3):
        rows = [",".join([str(i), quoted(rng), quoted(rng)]) for i in range(n * 60 + (n > 0))]
        with open(f"{tmp_dir}/c/{n}.csv", "w", newline="", encoding="utf-8") as f:
            f.write(end.join(["id,a,b", *rows]) + (end if n != 1 else "") + end * n)
    path = f"{tmp_dir}/c"
    want = whole_files(spark, path)
    found = records.csv_records(spark, path)
    got = files.read_csv(spark, path, na_tokens=(), multi_line=True)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(got.columns).collect()))
    assert got.count() == 60 + 1 + 120 + 1
    # many ranges took part, also of one file
    assert found.groupBy("file").agg(F.count_distinct("block").alias("n")).agg(F.max("n")).first()[0] > 5


def test_one_record_over_many_ranges(spark, small_ranges, tmp_dir):
    text = "\n".join(f"line {i} " + "x" * 60 for i in range(400))
    with open(f"{tmp_dir}/one.csv", "w", newline="") as f:
        f.write(f'id,a\n1,before\n2,"{text}"\n3,after\n4,"{text[:900]}"\n')
    got = files.read_csv(spark, f"{tmp_dir}/one.csv", na_tokens=(), multi_line=True)
    assert sorted(map(tuple, got.collect())) == [("1", "before"), ("2", text), ("3", "after"), ("4", text[:900])]


def test_bad_files_raise(spark, small_ranges, tmp_dir):
    for name, text in {"short": 'a,b\n1,"x\ny"\n2\n', "long": 'a,b\n1,"x\ny",3\n'}.items():
        with open(f"{tmp_dir}/{name}.csv", "w") as f:
            f.write(text)
        df = files.read_csv(spark, f"{tmp_dir}/{name}.csv", multi_line=True)
        with pytest.raises(Exception):
            df.collect()
        with pytest.raises(Exception):
            df.select("a").collect()
    os.makedirs(f"{tmp_dir}/two")
    for name, text in {"1": "a,b\n1,2\n", "2": "b,a\n1,2\n"}.items():
        with open(f"{tmp_dir}/two/{name}.csv", "w") as f:
            f.write(text)
    with pytest.raises(Exception):
        files.read_csv(spark, f"{tmp_dir}/two", multi_line=True).collect()


def test_header_only_and_empty_fields(spark, tmp_dir):
    with open(f"{tmp_dir}/h.csv", "w") as f:
        f.write("a,b\n")
    assert files.read_csv(spark, f"{tmp_dir}/h.csv", multi_line=True).collect() == []
    with open(f"{tmp_dir}/e.csv", "w") as f:
        f.write('a,b\n,""\n"",\n')
    rows = files.read_csv(spark, f"{tmp_dir}/e.csv", na_tokens=(), multi_line=True).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, whole_files(spark, f"{tmp_dir}/e.csv").collect()))
