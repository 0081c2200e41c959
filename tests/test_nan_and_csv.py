"""NaN counts as a missing value; CSV keeps free text; a checkpoint folder is asked for off a single machine."""

import math

import pytest
from pyspark.sql import functions as F

from segmenta import session
from segmenta.operators import crosstabs as X
from segmenta.operators import scaling as SC
from segmenta.operators import stats as A
from segmenta.operators.cluster.assign import assign_nearest
from segmenta.operators.cluster.gmm import gmm_fit
from segmenta.sources import files

NAN = float("nan")


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(1, 1.0, 4.0), (2, NAN, 5.0), (3, 3.0, NAN), (4, None, 7.0), (5, 5.0, 9.0)]
    return spark.createDataFrame(rows, "id long, a double, b double")


def test_nan_is_missing_in_statistics(frame):
    plain = frame.select("id", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("a", "b")])
    for f in (lambda d: A.question_stats(d, ["a", "b"], order_col="id"), lambda d: A.basic_stats(d, ["a", "b"]),
              lambda d: A.column_bounds(d, ["a", "b"]),
              lambda d: A.relative_profile(d, ["a", "b"]), lambda d: A.first_seen_mode(d, ["a", "b"]),
              lambda d: A.dimension_means(d, {"t": ["a", "b"]}, keep=["id"]), lambda d: X.correlation_matrix(d, ["a", "b"]),
              lambda d: SC.minmax(d, ["a", "b"]), lambda d: SC.standardise(d, ["a", "b"])):
        assert sorted(map(str, f(frame).collect())) == sorted(map(str, f(plain).collect()))
    row = A.question_stats(frame, ["a"], order_col="id").first()
    assert row["n"] == 3 and row["mean"] == 3.0


def test_nan_rows_keep_their_place_in_models(spark, frame):
    out = assign_nearest(frame, ["a"], [[1.0], [5.0]]).orderBy("id").collect()
    assert [r["Cluster"] for r in out] == [0, None, 0, None, 1]
    rows = [(i, float(i % 7) + 10 * (i % 2), float(i % 5)) for i in range(60)] + [(60, NAN, 1.0), (61, None, 1.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    fitted = gmm_fit(df.where("a is not null and not isnan(a)"), ["a", "b"], k=2, restarts=1)
    labels = {r["id"]: r["Cluster"] for r in fitted.transform(df).collect()}
    assert len(labels) == 62 and labels[60] is None and labels[61] is None


def test_parse_number_rejects_type_letters(spark):
    df = spark.createDataFrame([("1d",), ("2f",), ("3.5",), (" 4 ",), ("1e3",), ("inf",), ("x",), (None,)], "s string")
    got = [r[0] for r in df.select(A.parse_number("s")).collect()]
    assert got[:2] == [None, None] and got[2:5] == [3.5, 4.0, 1000.0] and math.isinf(got[5]) and got[6:] == [None, None]


def test_csv_round_trip_of_free_text(spark, scratch):
    rows = [(1, 'dice "hola", sí'), (2, "dos\nlíneas"), (3, "a,b;c"), (4, None), (5, '"'), (6, "back\\slash")]
    df = spark.createDataFrame([(str(i), t) for i, t in rows], "id string, t string")
    path = files.write_csv(df, f"{scratch}/text.csv")
    back = files.read_csv_strings(spark, path)
    assert sorted(map(tuple, back.collect())) == [(str(i), t) for i, t in rows]


def test_upload_guard_takes_folders_anywhere():
    files.check_upload("hdfs://nn/data/surveys")
    files.check_upload("/data/x.CSV")
    for bad in ("", None, "/data/x.xlsx"):
        with pytest.raises(ValueError):
            files.check_upload(bad)


def test_checkpoint_folder_must_be_shared_off_one_machine():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.checkpoint_dir(Session())
