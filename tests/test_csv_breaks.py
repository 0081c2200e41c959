"""Files with line breaks in quoted cells: split into tasks, the rows are those of the reader that takes a file at once."""

import csv
import random

import pytest

from segmenta.sources import csv_split, files


@pytest.fixture()
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def write(path, rows, terminator="\n"):
    with open(path, "w", newline="") as f:
        out = csv.writer(f, lineterminator=terminator)
        out.writerow(["id", "signo", "p1a"])
        out.writerows(rows)


def cells(seed, n):
    rng = random.Random(seed)
    words = ["a", 'say ""hi""', "line\nbreak", '"', '""', "\n\n", "x,y", "", "ü\n\"q\"\n,", " z ", "long " * 30]
    return [(i, "".join(rng.choice(words) for _ in range(rng.randint(1, 5))), rng.choice(words)) for i in range(n)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("terminator", ["\n", "\r\n"])
def test_same_rows_from_many_tasks(spark, scratch, small_ranges, terminator):
    write(f"{scratch}/one.csv", cells(1, 900), terminator)
    write(f"{scratch}/two.csv", cells(2, 5), terminator)
    records = csv_split.split_records(spark, scratch)
    assert csv_split._lines(spark, scratch).rdd.getNumPartitions() > 5
    assert records.count() == 907 and records.where("first").count() == 2
    whole, split = (files.read_csv_strings(spark, scratch, multi_line=m) for m in (True, "split"))
    assert split.columns == whole.columns and rows(split) == rows(whole)


def test_a_record_over_many_ranges(spark, scratch, small_ranges):
    huge = "\n".join(f'row {i} of a "cell"' for i in range(3000))
    write(f"{scratch}/x.csv", [(1, "a", "b"), (2, huge, "c\n"), (3, "d", huge), (4, "", "e")])
    whole, split = (files.read_csv_strings(spark, f"{scratch}/x.csv", multi_line=m) for m in (True, "split"))
    assert rows(split) == rows(whole) and split.count() == 4
    with open(f"{scratch}/y.csv", "w") as f:
        f.write('id,signo\n1,a\n\n2,"never closed\n3,b\n')
    whole, split = (files.read_csv_strings(spark, f"{scratch}/y.csv", multi_line=m) for m in (True, "split"))
    assert split.count() == whole.count()


def test_typed_survey_rows(spark, scratch, small_ranges):
    with open(f"{scratch}/s.csv", "w") as f:
        f.write("id,edad,signo,extra\n" + "".join(f'{i},{i % 60 if i % 7 else "old"},"Le\no ""{i}""",x\n' for i in range(800)))
    whole, split = (files.read_survey_csv(spark, f"{scratch}/s.csv", validate=False, multi_line=m) for m in (True, "split"))
    good = [c for c in whole.columns if c != files.CORRUPT]
    assert dict(split.dtypes) == dict(whole.dtypes) and rows(split.select(good)) == rows(whole.select(good))
    assert files.malformed_count(split) == files.malformed_count(whole) > 100
    assert files.malformed_rows(split).count() == files.malformed_rows(whole).count() == files.malformed_count(whole)
