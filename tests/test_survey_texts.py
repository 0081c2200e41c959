"""Survey texts are worked on by all cores, and their polarity looks only for entries that the text holds."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from data_paths import SMALL
from segmenta.functions.text import polarity, polarity_sql_expr


@pytest.mark.parametrize("name", ["sentiment_rows", "sentiment_by_group", "qualitative_export", "tfidf_terms"])
def test_a_small_file_is_dealt_over_all_cores(spark, name):
    plan = E.queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert f"Repartition {2 * spark.sparkContext.defaultParallelism}, true" in plan


def test_polarity_equals_the_plain_expression(spark):
    texts = ["Soy muy creativo", "rutinas y MALOS", "malo bueno bueno", "buenosmalos bueno", "empatica", "Empática", "", None, "  ¡!", "desaburridos ordenados ordenado_x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(polarity("t").alias("a"), polarity(F.col("t")).alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got]
    odd = df.select(F.expr(polarity_sql_expr("t", [], ["malo", "it's"])).alias("p"), polarity(F.col("t"), ["zz"], ["malo", "it's"]).alias("q")).collect()
    assert [r["p"] for r in odd] == [r["q"] for r in odd]
    assert polarity_sql_expr("t").count("regexp_extract_all") == 1
