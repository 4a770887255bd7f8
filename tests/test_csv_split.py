"""The splitting CSV reader against Spark's one task for a file, with ranges of a few bytes."""

import csv
import random

import pytest

from ferrytally.sources import readers

CELLS = ["", "a", "a,b", 'say "x"', "two\nlines", '"', '""', "\n", "\n\n", ',"\n', "é世\U0001f600", " padded ", "x" * 200, 'q\n",\n"', "12", "3.5", "line\r\nbreak"]


@pytest.fixture
def tiny_ranges(spark):
    """Byte ranges of a few dozen bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: [spark.conf.set(k, v) for k, v in zip(old, (str(size), "1"))]
    for k, v in old.items():
        spark.conf.set(k, v)


def written(path, seed, rows, end="\n", sep=","):
    rng = random.Random(seed)
    with open(path, "w", encoding="utf-8", newline="") as f:
        out = csv.writer(f, lineterminator=end, delimiter=sep)
        out.writerow(["id", "a", f"two{end}lines", "n"])
        for i in range(rows):
            cells = [c if end == "\n" or "\n" not in c else c.replace("\r\n", "\n").replace("\n", end) for c in (rng.choice(CELLS), rng.choice(CELLS))]
            out.writerow([f"{seed}-{i}", *cells, rng.randint(0, 9)])
            if i % 11 == 0:
                f.write(end)


def both(spark, rows, path, **options):
    got = readers.read_csv(spark, str(path), multi_line=True, split_bytes=0, **options)
    whole = readers.read_csv(spark, str(path), multi_line=True, split_bytes=1 << 40, **options)
    assert got.schema.simpleString() == whole.schema.simpleString()
    assert sorted(rows(got), key=str) == sorted(rows(whole), key=str)
    return whole.count()


@pytest.mark.parametrize("size", [17, 64, 700, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_ranges_of_any_size(spark, rows, tmp_path, tiny_ranges, size, end):
    for seed in (1, 2):
        written(tmp_path / f"{seed}.csv", seed, 40, end)
    tiny_ranges(size)
    assert both(spark, rows, tmp_path, infer=False) == 80


@pytest.mark.parametrize("options", [{"infer": True}, {"schema": "id string, a string, b string, n double"}, {"schema": "id int, a string"}, {"infer": False, "sep": ";"}])
def test_types(spark, rows, tmp_path, tiny_ranges, options):
    written(tmp_path / "a.csv", 3, 60, sep=options.get("sep", ","))
    tiny_ranges(90)
    both(spark, rows, tmp_path / "a.csv", **options)


@pytest.mark.parametrize("text", [
    "", "a,b\n", "a,b", '\n\na,b\n1,"x\n\ny"\n\n', '"a\n\n\nq",b\n1,2\n', "﻿a,b\n1,2\n", '﻿"a\n\nb",c\n1,2\n', 'a,b\n5" pipe,"7"" pipe\n"\nx,y"\n2,z',
    'a,b\n"x"y,1\n"x\ny"z,"2\n"\n', "a,b\n1\n1,2,3\n,\n", "a,b\r1,2\r", "a,b\n1,x\ry\n", 'a,b\n1,"x\ry"\n', 'a,a\n1,"\n2"\n',
])
def test_forms(spark, rows, tmp_path, tiny_ranges, text):
    (tmp_path / "a.csv").write_bytes(text.encode())
    tiny_ranges(4)
    both(spark, rows, tmp_path / "a.csv", infer=False)


def test_encoding_and_partition_columns(spark, rows, tmp_path, tiny_ranges):
    for day in (1, 2):
        (tmp_path / f"day={day}").mkdir()
        (tmp_path / f"day={day}" / "a.csv").write_bytes('a,b\né,"ü\nö"\n'.encode("latin-1") * day)
    tiny_ranges(8)
    both(spark, rows, tmp_path / "day=1" / "a.csv", infer=False, encoding="latin-1")
    both(spark, rows, tmp_path, infer=False, encoding="latin-1")


def test_one_file_takes_many_tasks(spark, tmp_path, tiny_ranges):
    written(tmp_path / "a.csv", 5, 400)
    tiny_ranges((tmp_path / "a.csv").stat().st_size // 8 + 1)
    got = readers.read_csv(spark, str(tmp_path / "a.csv"), infer=False, multi_line=True, split_bytes=0)
    whole = readers.read_csv(spark, str(tmp_path / "a.csv"), infer=False, multi_line=True)
    assert whole.rdd.getNumPartitions() == 1 and got.rdd.getNumPartitions() >= 8
