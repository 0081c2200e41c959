"""CSV files without quoted line breaks are split by Spark when asked."""

import pytest

from segmenta.sources import files


@pytest.mark.parametrize("reader", [files.read_csv_strings, lambda s, p, **kw: files.read_survey_csv(s, p, validate=False, **kw)])
def test_large_files_are_split(spark, scratch, reader):
    path = f"{scratch}/rows.csv"
    with open(path, "w") as f:
        f.write("id,signo\n" + "".join(f'{i},"a, ""b"" {i}"\n' for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        whole, split = reader(spark, path), reader(spark, path, multi_line=False)
        assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() > 1
        assert sorted(r["signo"] for r in split.collect()) == sorted(r["signo"] for r in whole.collect())
        assert split.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
