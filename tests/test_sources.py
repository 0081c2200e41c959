"""File sources/sinks, stored table, page extraction, streaming."""

import os

import pytest
from pyspark.sql import functions as F

from segmenta.fixtures import survey_view
from segmenta.schema import validate_columns
from segmenta.sources import files as FS
from segmenta.sources import pages as PG
from segmenta.sources import tables as TB
from data_paths import SMALL


def test_validate_columns():
    ok, msg = validate_columns(["id", "edad", "genero", "signo"] + [f"p{i}" for i in range(1, 16)]
                               + [f"p{i}a" for i in range(1, 16)])
    assert ok
    ok, msg = validate_columns(["id", "genero"] + [f"p{i}" for i in range(1, 15)])
    assert not ok and "edad, signo" in msg and "p15" in msg and " | " in msg and "p1a" in msg


def test_csv_roundtrip_and_upload_guard(spark, scratch):
    sv = survey_view(spark, SMALL)
    out = FS.write_csv(sv, f"{scratch}/survey.csv")
    back = FS.read_survey_csv(spark, out)
    assert back.count() == sv.count()
    assert FS.malformed_count(back) == 0
    assert FS.malformed_rows(back).collect() == []
    strings = FS.read_csv_strings(spark, out)
    assert all(t == "string" for _, t in strings.dtypes)
    with pytest.raises(ValueError):
        FS.check_upload(f"{scratch}/data.xlsx")
    with pytest.raises(ValueError):
        FS.check_upload(None)
    FS.write_csv(sv.select("id", "edad"), f"{scratch}/bad.csv")
    with pytest.raises(ValueError):
        FS.read_survey_csv(spark, f"{scratch}/bad.csv")


def test_table_append_ids_truncate(spark, scratch):
    TB.create_database(spark, "segmenta_t")
    TB.create_database(spark, "segmenta_t")  # duplicate tolerated
    name = "segmenta_t.encuestas"
    TB.create_survey_table(spark, name, location=f"{scratch}/encuestas")
    sv = survey_view(spark, SMALL).repartition(3)
    n = sv.count()
    assert TB.append_survey(spark, name, sv) == n
    assert TB.append_survey(spark, name, sv.limit(5)) == 5
    ids = [r["id"] for r in TB.scan(spark, name).select("id").orderBy("id").collect()]
    assert ids == list(range(1, n + 6))
    TB.truncate(spark, name)
    assert TB.scan(spark, name).count() == 0
    TB.append_survey(spark, name, sv.limit(3))
    assert sorted(r["id"] for r in TB.scan(spark, name).collect()) == [1, 2, 3]


def test_dict_rows_export(spark):
    df = spark.createDataFrame([(1, None)], "id long, signo string")
    assert [tuple(r) for r in FS.dict_rows_export(df, ["signo", "id", "elemento"]).collect()] == [("", "1", "")]


def test_form_page_literal(spark):
    html = ('<html><script>var FB_PUBLIC_LOAD_DATA_ = [null,["Encuesta",[[11,"¿Qué te motiva?",null,0],'
            '[12,"Signo",null,2]]]];\n</script></html>')
    df = spark.createDataFrame([(1, html), (2, "<html><body>no form</body></html>")], "page_id long, html string")
    rows = [tuple(r) for r in PG.form_questions(df).orderBy("position").collect()]
    assert rows == [(1, 0, "Qu te motiva?"), (1, 1, "Signo")]


def test_streaming_scoring_matches_batch(spark, scratch):
    from segmenta.fixtures import LIKERT, OPEN, survey_select_list
    from segmenta.operators import scaling as SC
    from segmenta.streaming import scoring as ST

    cust = spark.read.parquet(f"{SMALL}/customer.parquet")
    src = f"{scratch}/src"
    cust.repartition(3).write.parquet(src)
    mm = SC.minmax_fit(survey_view(spark, SMALL), LIKERT)
    cents = [[0.2] * 15, [0.8] * 15]
    stream = ST.read_stream(spark, src, cust.schema, max_files_per_trigger=1).selectExpr(*survey_select_list())
    q = ST.start_scoring(ST.score(stream, LIKERT, cents, mm, OPEN), f"{scratch}/out", f"{scratch}/chk")
    q.awaitTermination()
    got = spark.read.parquet(f"{scratch}/out")
    want = ST.score(survey_view(spark, SMALL), LIKERT, cents, mm, OPEN)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0
