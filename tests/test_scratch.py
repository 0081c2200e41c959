"""Working tables go with the scope they were written in, others stay."""

import os

import pytest

from segmenta.session import materialize, scratch_scope


def folder(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))


def test_scope_removes_its_tables_only(spark, scratch):
    kept = folder(materialize(spark.range(3), "kept"))
    with scratch_scope(spark):
        inner = materialize(spark.range(5), "inner")
        gone = folder(inner)
        with scratch_scope(spark):
            deeper = folder(materialize(spark.range(2), "deeper"))
        assert os.path.isdir(gone) and not os.path.isdir(deeper)
        inner.write.parquet(f"{scratch}/out")
    assert os.path.isdir(kept) and not os.path.isdir(gone)
    assert spark.read.parquet(f"{scratch}/out").count() == 5
    with pytest.raises(ValueError):
        with scratch_scope(spark):
            left = folder(materialize(spark.range(1), "left"))
            raise ValueError
    assert os.path.isdir(left)
